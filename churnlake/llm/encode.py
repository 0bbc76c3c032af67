"""Token ids of whole texts, each distinct word encoded once.

The ids are those of the ``tokenizers`` library on the whole text.  Both
vocabularies used here split a text into words before any merge, so a text's
ids are the concatenation of the ids of its blank-separated chunks:

* ``drop_space`` files (word_bpe_49k) drop white space and no word spans it,
  so every chunk between blanks or line ends stands alone;
* byte-level files keep one blank in front of the next word.  A border lies
  in front of every blank whose left neighbour is no white space.  Texts with
  a blank right after other white space are encoded whole.

A batch is split and its chunks made distinct by Arrow; only chunks that the
worker has not met are encoded, and the ids of all rows are gathered with
NumPy.  Chunks of Latin letters with trailing ASCII punctuation are handed to
the library's merge model directly, many in one call; every other chunk goes
through the library's full pipeline.
"""

from __future__ import annotations

import gc
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

from .common import list_offsets, texts_of

#: Letters that every normal form leaves alone and whose case mapping is one letter to one letter.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_PLAIN = re.compile(rf"([{_LETTERS}]+)([!-&(-/:-@\[-`{{-~]*)")
#: White space of the byte-level splitting pattern, and what str methods count besides.
_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
#: Distinct chunks a worker remembers; later ones are encoded for their batch alone.
CAPACITY = 400_000


def byte_alphabet() -> dict[int, str]:
    """The printable character that stands for each byte in byte-level files:
    itself where printable, else the next unused one from U+0100."""
    keep = {b for r in (range(0x21, 0x7F), range(0xA1, 0xAD), range(0xAE, 0x100)) for b in r}
    spare = iter(range(0x100, 0x200))
    return {b: chr(b) if b in keep else chr(next(spare)) for b in range(256)}


class TextEncoder:
    """``ids, borders = TextEncoder(path, drop_space).encode(string_array)``."""

    def __init__(self, path: str, drop_space: bool, capacity: int = CAPACITY):
        self.full = Tokenizer.from_file(path)
        self.drop_space = drop_space
        self.capacity = capacity
        self.model = Tokenizer(self.full.model)
        self.model.pre_tokenizer = pre_tokenizers.CharDelimiterSplit(" ")
        vocab = self.full.get_vocab()
        self.dtype = np.uint16 if max(vocab.values()) < 1 << 16 else np.uint32
        alphabet = byte_alphabet()
        self.lead = "" if drop_space else alphabet[0x20]
        self.edge = np.zeros(max(vocab.values()) + 1, bool)   # ids that end (drop_space) or start a word
        for token, i in vocab.items():
            self.edge[i] = token.endswith("</w>") if drop_space else token.startswith(self.lead)
        self.mapped = {c: "".join(alphabet[b] for b in chr(c).encode()) for c in range(0xC0, 0x100)}
        self.known: dict[str, int] = {}
        self.first: dict[str, list[int]] = {}
        self.parts: dict[str, list[int]] = {}
        self.store = array("H" if self.dtype is np.uint16 else "I")
        self.ends = array("q")

    # ---- chunks ------------------------------------------------------------------------------------

    def _whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.full.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[str]) -> dict[str, list[int]]:
        """Ids of distinct words in the model's alphabet, thousands to a call."""
        out: dict[str, list[int]] = {}
        for i in range(0, len(words), 4000):
            part = words[i:i + 4000]
            ids = np.asarray(self.model.encode(" ".join(part), add_special_tokens=False).ids, np.int64)
            edge = np.flatnonzero(self.edge[ids])
            cut = edge[:-1] + 1 if self.drop_space else edge[1:]
            if len(edge) != len(part):
                raise ValueError("words and their ids do not line up")
            flat, at = ids.tolist(), [0, *cut.tolist(), len(ids)]
            out.update(zip(part, (flat[a:b] for a, b in zip(at, at[1:]))))
        return out

    def _part(self, text: str) -> list[int]:
        ids = self.parts.get(text)
        if ids is None:
            ids = self._whole([text])[0]
            if len(self.parts) < self.capacity // 4:
                self.parts[text] = ids
        return ids

    def _add(self, chunks: list[str]) -> None:
        """Append the ids of chunks (without their leading blank) to the store."""
        plan: list = []
        words: dict[str, None] = {}
        odd: list[str] = []
        lower, lead, mapped = self.drop_space, self.lead, self.mapped
        for c in chunks:
            line, _, rest = (c, "", "") if lower else c.partition("\n")
            m = _PLAIN.fullmatch(line)
            n = _PLAIN.fullmatch(rest) if rest and m else None
            if not m or (line != c and not n):
                plan.append(None)
                odd.append(c if lower else " " + c)
                continue
            w = m[1].lower() if lower else m[1]
            w = lead + (w if w.isascii() else w.translate(mapped))
            words[w] = None
            plan.append((w, m[2], rest))
        ids = self._words(list(words))
        whole = iter(self._whole(odd)) if odd else iter(())
        store, ends, at = self.store, self.ends, len(self.store)
        for p in plan:
            if p is None:
                x = next(whole)
            else:
                x = ids[p[0]]
                if p[1]:
                    x = x + self._part(p[1])
                if p[2]:
                    x = x + self._part("\n") + self._part(p[2])
            store.extend(x)
            at += len(x)
            ends.append(at)

    # ---- batches -----------------------------------------------------------------------------------

    def _codes(self, distinct: list[str]) -> np.ndarray:
        known = self.known
        codes = np.fromiter((known.get(w, -1) for w in distinct), np.int64, len(distinct))
        new = np.flatnonzero(codes < 0)
        if len(new):
            at = len(self.ends)
            chunks = [distinct[i] for i in new.tolist()]
            self._add(chunks)
            codes[new] = np.arange(at, at + len(new))
            if at == len(known):      # nothing temporary lies before
                for k, w in enumerate(chunks[:max(0, self.capacity - at)]):
                    known[w] = at + k
        return codes

    def _forget(self) -> None:
        n = len(self.known)
        if len(self.ends) > n:
            del self.store[self.ends[n - 1] if n else 0:], self.ends[n:]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in one array, and each text's borders in it."""
        collects = gc.isenabled()
        gc.disable()      # hundreds of thousands of small lists, none of them cyclic
        try:
            return self._encode(texts_of(texts))
        finally:
            if collects:
                gc.enable()

    def _encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        whole = np.zeros(len(texts), bool)
        if self.drop_space:
            # Lower case first, as more chunks are then equal; not where a letter might join a mark or spell a special token.
            odd = pc.or_(pc.match_substring_regex(texts, r"[\x{300}-\x{36f}]"), pc.match_substring(texts, "<|"))
            texts = pc.if_else(odd, texts, pc.ascii_lower(texts)) if pc.any(odd).as_py() else pc.ascii_lower(texts)
            texts = pc.replace_substring(texts, "\n", " ")
        else:
            odd = pc.match_substring_regex(texts, _SPACE + " ")
            whole = odd.to_numpy(zero_copy_only=False).astype(bool)
            originals = texts
            if whole.any():
                texts = pc.if_else(odd, "", texts)
        lists = pc.split_pattern(texts, " ")
        borders = list_offsets(lists)
        values = lists.flatten().dictionary_encode()
        del lists
        distinct = values.dictionary.to_pylist()
        index = values.indices.to_numpy(zero_copy_only=False)
        codes = self._codes(distinct)
        heads: list[str] = [] if self.drop_space else [distinct[i] for i in index[borders[:-1]].tolist()]
        head_ids = self._heads(heads)
        ends = np.frombuffer(self.ends, np.int64)
        store = np.frombuffer(self.store, self.dtype)
        lens = np.diff(ends, prepend=0)
        code_at, code_len = (ends - lens)[codes].astype(np.int32), lens[codes].astype(np.int32)
        if heads:      # the first chunk of a text has no blank in front
            head_len = np.fromiter(map(len, head_ids), np.int32, len(heads))
            head_at = len(store) + np.cumsum(head_len, dtype=np.int32) - head_len
            store = np.concatenate((store, np.fromiter((i for x in head_ids for i in x), self.dtype, int(head_len.sum()))))
        value_len = code_len[index]
        value_at = code_at[index]
        if heads:
            value_len[borders[:-1]], value_at[borders[:-1]] = head_len, head_at
        token_end = np.cumsum(value_len)
        total = int(token_end[-1]) if len(token_end) else 0
        # every token's place in the store: steps of one inside a chunk, a jump at the next chunk's first token
        value_at -= (token_end - value_len).astype(np.int32)
        pos = np.repeat(value_at, value_len)
        pos += np.arange(total, dtype=np.int32)
        ids = store.take(pos)
        rows = np.concatenate(([0], token_end))[borders]
        del ends, store, pos
        self._forget()
        if whole.any():
            got = self._whole(originals.filter(pa.array(whole)).to_pylist())
            n = np.diff(rows)
            n[whole] = [len(x) for x in got]
            mask = np.repeat(whole, n)
            out = np.empty(int(n.sum()), self.dtype)
            out[~mask] = ids
            out[mask] = np.fromiter((i for x in got for i in x), self.dtype, int(mask.sum()))
            ids, rows = out, np.concatenate(([0], np.cumsum(n)))
        return ids, rows

    def _heads(self, heads: list[str]) -> list[list[int]]:
        """Ids of chunks that start a text."""
        first = self.first
        new = list({w: None for w in heads if w and w not in first})
        got = dict(zip(new, self._whole(new))) if new else {}
        if len(first) < self.capacity // 4:
            first.update(got)
            got = {}
        return [(got.get(w) or first[w]) if w else [] for w in heads]


_open: dict[tuple[str, bool], TextEncoder] = {}


def encoder(path: str, drop_space: bool) -> TextEncoder:
    """The worker's encoder of a file (kept between the tasks of a worker)."""
    key = (path, drop_space)
    if key not in _open:
        _open[key] = TextEncoder(path, drop_space)
    return _open[key]


def with_end(ids: np.ndarray, rows: np.ndarray, end: int) -> tuple[np.ndarray, np.ndarray]:
    """Append the id ``end`` to every row."""
    n = len(rows) - 1
    out = np.empty(len(ids) + n, ids.dtype)
    at = rows[1:] + np.arange(n)
    keep = np.ones(len(out), bool)
    keep[at] = False
    out[at] = end
    out[keep] = ids
    return out, rows + np.arange(n + 1)
