"""Main text of web pages by a linear-chain conditional random field.

A page is parsed into leaf blocks in page order: runs of text between block
level tags, with character references decoded and white space turned into
single blanks.  Every block is labelled content or boilerplate; the chain's
scores are sums of feature weights per label plus a weight per pair of
neighbouring labels, and Viterbi finds the best labelling of the whole page.

Features: own and ancestor tags, names in the ancestors' class, id and role
attributes (whole, and their first and last words; not those of html, body and
main, nor names of states such as ``has-sidebar``), length class, share of link text, sentence punctuation, and the
position class of the block.

Training: a bounded sample of the pages with an ``article`` or ``main`` tag
(``SAMPLE`` pages at most, by hash of id and html) labelled by their own
mark-up (blocks below ``article`` or ``main`` and not below navigation, notes,
adverts or forms), plus copies of those pages (more of each, if there are few)
rewritten into other common layouts (``div`` containers named by class
or id, comment sections, side bars, notices; or no boilerplate, or no mark-up)
whose labels are known by construction.  A ``header`` is no content, the
article's own included.  Weights maximise the regularised conditional likelihood by
AdaGrad steps over exact forward-backward gradients.  The weights (a few
thousand numbers) go to the tasks as a broadcast.

Null or empty html gives an empty text.  Unclosed and wrongly nested tags are
closed where an enclosing tag ends; an open head ends at body, at text and at
the first tag that head cannot hold, and a template, noscript, svg or iframe
that is never closed hides nothing; a comment that is never closed ends with
the page.  Scripts, styles, comments and templates
are no blocks and do not split a paragraph or heading; text of math, object
and canvas is text.  Repeated pages are rows of their own.  Without any page to
learn from there is no model, and every block outside boilerplate mark-up
(``in_boilerplate``) counts as content.
"""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_tasks, steps, texts_of

SAMPLE = 120
EPOCHS = 8
L2 = 1e-4
HASH_BITS = 15

# Tags that break a line of text in HTML, tags without content, tags whose text is not shown.
BLOCK_TAGS = frozenset("""address article aside blockquote body button canvas caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe legend li main menu nav object ol optgroup
option p pre search section select summary table tbody td textarea tfoot th thead tr ul video""".split())
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
HIDDEN_TAGS = frozenset("script style template noscript title head svg iframe".split())
HEAD_TAGS = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
PARAGRAPH_TAGS = frozenset("p h1 h2 h3 h4 h5 h6 pre".split())
BOILERPLATE_TAGS = frozenset("nav footer header aside form button select textarea option menu dialog".split())
BOILERPLATE_WORDS = frozenset("""ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments cookie cookies consent
disclaimer disqus footer form header legal login masthead menu modal nav navbar navigation newsletter notice overlay pagination popup promo
promoted related replies reply respond share sharing sidebar signup social sponsor sponsored subscribe toolbar widget""".split())
# Elements that hold the page or the article (what they are called says nothing about a part of it), names by
# which an article is no article of the page, words of names that tell a state, and words of names that hold content.
OUTER_TAGS = frozenset("html body main".split())
OTHER_ARTICLES = frozenset("ad ads advert advertisement comment comments promo promoted related reply replies sponsor sponsored".split())
STATE_WORDS = frozenset("has with without".split())
STATE_FIRST = frozenset("has is no not with without".split())
STATE_LAST = frozenset("allowed closed disabled enabled open required".split())
CONTENT_WORDS = frozenset("article container content entry layout main page post story wrap wrapper".split())
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_SPACE = re.compile(r"\s+")
# Hidden tags that must be closed to hide anything (the parser itself ends script and style).
_CLOSED = frozenset("template noscript svg iframe".split())
_CLOSERS = re.compile(r"</(template|noscript|svg|iframe)(?=[\s/>])", re.IGNORECASE)


@lru_cache(20_000)
def names(value: str) -> tuple[str, ...]:
    """Names in a class, id or role attribute, each as its words joined by
    ``-``; names of states (``has-sidebar``, ``comments-open``) are left out."""
    out = []
    for token in value.split():
        words = [w for w in _WORD.findall(_CAMEL.sub("-", token).lower()) if len(w) > 1 and w != "js"]
        if not words or (len(words) > 1 and (words[0] in STATE_FIRST or words[-1] in STATE_LAST or not STATE_WORDS.isdisjoint(words))):
            continue
        out.append("-".join(words))
    return tuple(out)


@lru_cache(20_000)
def names_boilerplate(name: str) -> bool:
    """The whole name, its first or its last word, or another word unless the name is one of a container."""
    words = name.split("-")
    if "".join(words) in BOILERPLATE_WORDS or words[0] in BOILERPLATE_WORDS or words[-1] in BOILERPLATE_WORDS:
        return True
    return not BOILERPLATE_WORDS.isdisjoint(words) and CONTENT_WORDS.isdisjoint(words)


def is_boilerplate(tag: str, called: tuple[str, ...]) -> bool:
    return tag in BOILERPLATE_TAGS or any(map(names_boilerplate, called))


class _Blocks(HTMLParser):
    """Collects (text, link characters, ancestors) of leaf blocks.  ``ancestors``
    is a tuple of (tag, names)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[tuple[str, tuple[str, ...]]] = []
        self.blocks: list[tuple[str, int, tuple]] = []
        self.text: list[str] = []
        self.links = 0
        self.hidden = 0
        self.anchors = 0
        self.heads = 0
        self.ending = False
        self.closers: Counter[str] = Counter()

    def feed(self, data):
        self.closers.update(t.lower() for t in _CLOSERS.findall(data))
        super().feed(data)

    def close(self):
        self.ending = True
        super().close()

    def parse_comment(self, i, report=True):
        """A comment that is never closed ends with the page."""
        end = super().parse_comment(i, report)
        return len(self.rawdata) if end < 0 and self.ending else end

    def flush(self) -> None:
        if self.text:
            text = _SPACE.sub(" ", "".join(self.text)).strip()
            if text:
                self.blocks.append((text, self.links, tuple(self.stack)))
            self.text, self.links = [], 0

    def _pop(self) -> str:
        tag = self.stack.pop()[0]
        self.hidden -= tag in HIDDEN_TAGS
        self.anchors -= tag == "a"
        self.heads -= tag == "head"
        return tag

    def _splits(self, tag: str) -> bool:
        """Whether a text ends at this tag."""
        if self.hidden:
            return False
        if tag not in HIDDEN_TAGS:
            return tag in BLOCK_TAGS
        around = next((t for t, _ in reversed(self.stack) if t in BLOCK_TAGS and t not in HIDDEN_TAGS), "")
        return around not in PARAGRAPH_TAGS

    def _end_head(self, tag: str) -> None:
        """Close an open head at a tag that it cannot hold ("" stands for text)."""
        inner = self.stack[-1][0]
        if tag == "body" or (inner == "head" and tag not in HEAD_TAGS) or (inner == "title" and tag in BLOCK_TAGS):
            while self.heads:
                self._pop()

    def handle_starttag(self, tag, attrs):
        if self.heads:
            self._end_head(tag)
        if self._splits(tag):
            self.flush()
        if tag in _CLOSED and self.closers[tag] <= sum(t == tag for t, _ in self.stack):
            return      # never closed
        if tag in BLOCK_TAGS and tag not in HIDDEN_TAGS:
            # a paragraph or an item ends where the next block of its kind begins
            for i in range(len(self.stack) - 1, -1, -1):
                open_tag = self.stack[i][0]
                if open_tag == "p" or (open_tag == tag and tag in ("li", "dd", "dt", "tr", "td", "th", "option")):
                    while len(self.stack) > i:
                        self._pop()
                    break
                if open_tag in BLOCK_TAGS or open_tag in HIDDEN_TAGS:
                    break
        if tag == "br":
            self.text.append(" ")
        if tag in VOID_TAGS:
            return
        called = () if tag in OUTER_TAGS else tuple(w for k, v in attrs if k in ("class", "id", "role") and v for w in names(v))
        if tag == "article":
            called = tuple(w for w in called if w in OTHER_ARTICLES)
        self.stack.append((tag, called))
        self.hidden += tag in HIDDEN_TAGS
        self.anchors += tag == "a"
        self.heads += tag == "head"

    def handle_startendtag(self, tag, attrs):
        if tag in HIDDEN_TAGS:      # empty
            if self._splits(tag):
                self.flush()
            return
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if self._splits(tag):
            self.flush()
        if tag in _CLOSED:
            self.closers[tag] -= 1
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i][0] == tag:
                while len(self.stack) > i:
                    hidden = self.hidden
                    self._pop()
                    if hidden and self._splits(tag):      # the tag ends a hidden one that was left open
                        self.flush()
                return
            if tag not in BLOCK_TAGS and tag not in HIDDEN_TAGS and self.stack[i][0] in BLOCK_TAGS:
                return      # an inline end tag closes nothing outside its block

    def handle_data(self, data):
        if self.heads and not data.isspace():
            self._end_head("")
        if not self.hidden:
            self.text.append(data)
            if self.anchors:
                self.links += len(data)


def leaf_blocks(html: str) -> list[tuple[str, int, tuple]]:
    p = _Blocks()
    p.feed(html)
    p.close()
    p.flush()
    return p.blocks


def _bucket(n: int, edges: tuple[int, ...]) -> int:
    return sum(n >= e for e in edges)


def features(blocks: list[tuple[str, int, tuple]]) -> list[list[str]]:
    """Feature names of every block."""
    last = len(blocks) - 1
    return [path_features(path) + text_features(text, links, k == 0, k == last) for k, (text, links, path) in enumerate(blocks)]


def text_features(text: str, links: int, first: bool, last: bool) -> list[str]:
    return [f"len:{_bucket(len(text), (20, 60, 120, 300))}", f"link:{_bucket(100 * links // max(1, len(text)), (1, 34, 67))}",
            f"end:{text[-1] in '.!?…'}", f"comma:{_bucket(text.count(', ') + text.count('. '), (1, 3))}", f"first:{first}",
            f"last:{last}", f"sign:{'©' in text}"]


def in_boilerplate(path: tuple) -> bool:
    return any(is_boilerplate(t, ws) for t, ws in path)


@lru_cache(20_000)
def path_features(path: tuple) -> list[str]:
    tags = {t for t, _ in path}
    called = {w for _, ws in path for w in ws}
    parts = {w for name in called for w in (name.split("-")[0], name.split("-")[-1])}
    f = ["bias", f"own:{path[-1][0] if path else ''}", *[f"in:{t}" for t in sorted(tags)], *[f"name:{w}" for w in sorted(called)],
         *[f"part:{w}" for w in sorted(parts)]]
    if in_boilerplate(path):
        f.append("boilerplate")
    if tags & {"article", "main"} or parts & {"article", "content", "main", "post", "story", "entry", "body"}:
        f.append("main")
    return f


def _number(name: str) -> int:
    """A feature's hashed number (the same in every process)."""
    return zlib.crc32(name.encode()) & ((1 << HASH_BITS) - 1)


@lru_cache(20_000)
def _numbers(path: tuple, *text: str) -> np.ndarray:
    return np.array(sorted({_number(n) for n in (*path_features(path), *text)}))


def encoded(blocks: list[tuple[str, int, tuple]]) -> list[np.ndarray]:
    """Feature numbers of every block."""
    last = len(blocks) - 1
    return [_numbers(path, *text_features(text, links, k == 0, k == last)) for k, (text, links, path) in enumerate(blocks)]


class Crf:
    """Two labels: 0 boilerplate, 1 content."""

    def __init__(self, weights: np.ndarray | None = None, moves: np.ndarray | None = None):
        self.weights = np.zeros((1 << HASH_BITS, 2)) if weights is None else weights
        self.moves = np.zeros((2, 2)) if moves is None else moves

    def scores(self, page: list[np.ndarray]) -> np.ndarray:
        at = np.cumsum([0, *map(len, page[:-1])])
        return np.add.reduceat(self.weights[np.concatenate(page)], at, axis=0)

    def fit(self, pages: list[tuple[list[np.ndarray], list[int]]], epochs: int = EPOCHS, rate: float = 0.3, l2: float = L2, seed: int = 7) -> "Crf":
        gw, gm = np.full_like(self.weights, 1e-6), np.full((2, 2), 1e-6)
        rng = random.Random(seed)
        pages = [p for p in pages if p[0]]
        for _ in range(epochs):
            rng.shuffle(pages)
            for page, labels in pages:
                node, pair = marginals(self.scores(page), self.moves)
                real = np.eye(2)[labels]
                move = np.zeros((2, 2))
                np.add.at(move, (labels[:-1], labels[1:]), 1)
                step = move - pair - l2 * self.moves
                gm += step ** 2
                self.moves += rate * step / np.sqrt(gm)
                used = np.concatenate(page)
                grad = np.repeat(real - node, [len(f) for f in page], axis=0)
                which, inverse = np.unique(used, return_inverse=True)
                step = np.zeros((len(which), 2))
                np.add.at(step, inverse, grad)
                step -= l2 * self.weights[which]
                gw[which] += step ** 2
                self.weights[which] += rate * step / np.sqrt(gw[which])
        return self

    def decode(self, page: list[np.ndarray]) -> list[int]:
        """Viterbi."""
        s = self.scores(page).tolist()
        (m00, m01), (m10, m11) = self.moves.tolist()
        a, b = s[0]
        back = []
        for x, y in s[1:]:
            back.append((int(b + m10 > a + m00), int(b + m11 > a + m01)))
            a, b = max(a + m00, b + m10) + x, max(a + m01, b + m11) + y
        label = int(b > a)
        out = [label]
        for step in reversed(back):
            label = step[label]
            out.append(label)
        return out[::-1]


def _log_add(a: float, b: float) -> float:
    return max(a, b) + math.log1p(math.exp(-abs(a - b)))


def marginals(scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward-backward: label probabilities per block, expected moves."""
    s, n = scores.tolist(), len(scores)
    (m00, m01), (m10, m11) = moves.tolist()
    fwd, bwd = [tuple(s[0])], [(0.0, 0.0)]
    for x, y in s[1:]:
        a, b = fwd[-1]
        fwd.append((_log_add(a + m00, b + m10) + x, _log_add(a + m01, b + m11) + y))
    for x, y in reversed(s[1:]):
        a, b = bwd[-1]
        bwd.append((_log_add(m00 + x + a, m01 + y + b), _log_add(m10 + x + a, m11 + y + b)))
    f, g = np.array(fwd), np.array(bwd[::-1])
    z = _log_add(*fwd[-1])
    pair = np.exp(f[:-1, :, None] + moves + (scores[1:] + g[1:])[:, None, :] - z).sum(0) if n > 1 else np.zeros((2, 2))
    return np.exp(f + g - z), pair


# ---- training pages -----------------------------------------------------------------------------------


def own_labels(blocks: list[tuple[str, int, tuple]]) -> list[int] | None:
    """Labels by the page's own mark-up, or None if it has no article or main."""
    out, seen = [], False
    for _, _, path in blocks:
        tags = [t for t, _ in path]
        inside = "article" in tags or "main" in tags
        seen |= inside
        depth = max((k for k, t in enumerate(tags) if t in ("article", "main")), default=0)
        out.append(int(inside and not in_boilerplate(path[depth:])))
    return out if seen else None


_CONTAINERS = (("article", ()), ("main", ()), ("div", ("content",)), ("div", ("post-body",)), ("div", ("post", "body")), ("div", ("article",)),
               ("section", ("story",)), ("div", ("entry",)), ("div", ("entry-content",)), ("div", ()))
_WRAPPERS = (("div", ("wrapper",)), ("div", ("page",)), ("div", ("site", "container")), ("div", ("content-sidebar-wrap",)), ("section", ()), ("div", ()))
_CONTENT_TAGS = tuple(tuple((t, ()) for t in x.split()) for x in (
    "ul li", "ol li", "ul li p", "blockquote p", "blockquote", "table tr td", "table tbody tr td", "pre", "h2", "h3", "h4", "div", "section p",
    "section h2", "figure figcaption", "p b", "p em", "p a", "dl dt", "dl dd", "div p"))
_EXTRAS = (("section", ("comments",)), ("div", ("comment-list",)), ("div", ("comments",)), ("ol", ("commentlist", "comments")), ("div", ("comment-body",)),
           ("article", ("comment",)), ("ul", ("nav",)), ("aside", ()), ("aside", ("sidebar",)), ("div", ("sidebar",)), ("div", ("left-sidebar",)),
           ("div", ("notice",)), ("div", ("cookie-banner",)), ("div", ("cookie-notice",)), ("form", ()), ("form", ("newsletter",)), ("header", ()),
           ("div", ("header",)), ("div", ("site-header",)), ("div", ("footer",)), ("footer", ()), ("div", ("ad",)), ("div", ("ads",)), ("div", ("advert",)),
           ("div", ("sponsored",)), ("div", ("related",)), ("div", ("share",)), ("div", ("share-buttons",)), ("div", ("menu",)), ("ul", ("menu",)),
           ("nav", ()), ("div", ("newsletter-signup",)), ("div", ("breadcrumbs",)))
#: Shares of the rewritten pages that are text without any mark-up, and that have content alone.
BARE, PURE = 0.05, 0.15


def rewritten(blocks: list[tuple[str, int, tuple]], labels: list[int], spare: list[str], rng: random.Random) -> tuple[list, list[int]]:
    """The page in another layout: its content in a container of another
    kind, boilerplate sections around and sometimes inside it, filled with
    running text of other pages, so that text alone does not decide.  Some
    pages have no boilerplate at all, some no mark-up."""
    content = [b for b, y in zip(blocks, labels) if y]
    dice = rng.random()
    if dice < BARE:
        text = " ".join(t for t, _, _ in content)
        return [(text if rng.random() < 0.5 else content[0][0][:rng.randint(3, 60)].strip() or text, 0, ())], [1]
    pure = dice < BARE + PURE
    container = rng.choice(_CONTAINERS)
    outer = (("html", ()), ("body", ())) if rng.random() < 0.8 else ()
    if rng.random() < 0.4:
        outer = (*outer, rng.choice(_WRAPPERS))
    out, marks = [], []

    def extra(path: tuple) -> None:
        section = rng.choice(_EXTRAS)
        for _ in range(rng.randint(1, 3)):
            inner = rng.choice((("p", ()), ("div", ()), ("li", ()), ("span", ()), ("label", ())))
            text = rng.choice(spare)
            out.append((text, len(text) if rng.random() < 0.3 else 0, (*path, section, inner)))
            marks.append(0)

    for _ in range(0 if pure else rng.randint(1, 3)):
        extra(outer)
    if pure and rng.random() < 0.5:
        content = content[:rng.randint(1, 4)]
    for k, (text, links, path) in enumerate(content):
        own = path[-1][0] if path[-1][0] not in ("article", "main") else "p"
        tail = rng.choice(_CONTENT_TAGS) if rng.random() < 0.3 else ((own, ()),)
        if rng.random() < 0.2:      # headings, items and captions of content are short, and may be links
            text = text[:rng.randint(3, 60)].strip() or text
            links = len(text) if rng.random() < 0.2 else 0
        out.append((text, links, (*outer, container, *tail)))
        marks.append(1)
        if not pure and rng.random() < 0.1:
            extra((*outer, container))
    for _ in range(0 if pure else rng.randint(1, 3)):
        extra((*outer, container) if rng.random() < 0.4 else outer)
    return out, marks


def train(pages: list[str], copies: int = 3, seed: int = 11, **how) -> Crf | None:
    """None if no page has labels."""
    rng = random.Random(seed)
    known = []
    for html in pages:
        blocks = leaf_blocks(html)
        labels = own_labels(blocks)
        if labels and any(labels):
            known.append((blocks, labels))
    if not known:
        return None
    spare = [t for blocks, _ in known for t, _, _ in blocks]
    copies = max(copies, -(-copies * SAMPLE // len(known)))      # few pages make as many copies as a full sample
    data = list(known)
    for blocks, labels in known:
        data += [rewritten(blocks, labels, spare, rng) for _ in range(copies)]
    return Crf().fit([(encoded(b), y) for b, y in data], **how)


def main_text(html: str, model: Crf | None) -> str:
    """``model`` None: all but boilerplate mark-up."""
    blocks = leaf_blocks(html)
    if not blocks:
        return ""
    labels = [not in_boilerplate(path) for _, _, path in blocks] if model is None else model.decode(encoded(blocks))
    return "\n\n".join(b[0] for b, y in zip(blocks, labels) if y)


def sample_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", size: int = SAMPLE) -> list[str]:
    """At most ``size`` pages with an article or main tag, the first by hash of id and html."""
    h = F.xxhash64(F.col(id_col), F.col(html_col))
    n = pages.count()
    if n == 0:
        return []
    lot = pages.filter(F.col(html_col).rlike(r"(?i)<(?:article|main)[\s/>]")).select(F.col(html_col).alias("html"), h.alias("h"))
    # a hash range that holds about twice as many as needed, cut to the bound by order; wider where few pages have the tags
    share = min(1.0, 2.0 * size / n)
    while True:
        part = lot.filter(F.pmod("h", F.lit(1 << 20)) < int(share * (1 << 20)) + 1)
        got = part.orderBy("h", "html").limit(size).collect()
        if len(got) >= size or share >= 1.0:
            return [r["html"] for r in got]
        share = min(1.0, share * 2.0 * size / max(0.5, len(got)))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model: Crf | None = None,
            sample: int = SAMPLE) -> DataFrame:
    """Per page row: page_id, url, text, n_chars."""
    spark = pages.sparkSession
    if model is None:
        model = train(sample_pages(pages, id_col, html_col, sample))
    shared = spark.sparkContext.broadcast(model and (model.weights, model.moves))

    def rows(batches) -> Iterator[pa.RecordBatch]:
        crf = None
        for b in steps(batches, "html"):
            crf = crf or (shared.value and Crf(*shared.value))
            texts = [main_text(h, crf) for h in texts_of(b.column(2)).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             ["id", "url", "text", "n_chars"])

    kind = pages.schema[id_col].dataType.simpleString()
    src = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    out = src.transform(in_tasks(rows, f"id {kind}, url string, text string, n_chars long"))
    return out.withColumnRenamed("id", id_col)
