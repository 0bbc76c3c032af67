"""Benchmark decontamination: Wu-Manber search for benchmark windows.

A symbol is a word: a run of ASCII letters and digits (A-Z lower-cased) and
characters from U+0080 on.  A pattern is a window of 13 consecutive words of a
benchmark item; an item of fewer words, but not none, is one pattern.

Patterns of one length class form one Wu-Manber table: ``shift`` gives for a
block of the last two words how far the window may move on without missing a
pattern (unknown blocks: the longest shift), ``bucket`` lists for each block
that ends a pattern the patterns to test, keyed by their first words, and a
direct comparison of all words confirms an occurrence.  Patterns shorter than
a block are looked up word by word in their own table.

The benchmark is the side of limited size: its (pattern, item) pairs are
counted in Spark first.  Up to ``PATTERN_BLOCK`` they are broadcast.  Of a
larger benchmark the distinct patterns are numbered and written as blocks of
about that many in the shared folder; tasks gather ``BUFFER`` bytes of texts
and search them block after block, so a block is read once a buffer, and
neither the driver nor a task ever holds more than one block.  Tasks then
return pattern numbers, and a join with the (number, item) table names the
items, so a pattern that a million items share is one entry of its block.

Null text has no words and no hits.  Repeated doc_ids are judged row by row.
Null item ids are left out of the item list only (their windows still count
as hits).  An empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.dataset as ds
import pyarrow.fs as pafs

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .common import in_tasks, steps, texts_of

WINDOW = 13
BLOCK = 2
PATTERN_BLOCK = 200_000
#: Bytes of texts that a task searches with one block after another (a single longer text makes a buffer of its own).
BUFFER = 64 << 20
#: Bytes as word bytes in lower case, or a blank.
_WORDS = bytes(b if b >= 0x80 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_WORDS).split()


class WuManber:
    """Multi-pattern search over word sequences; all patterns of one table are
    cut to the table's window for shifting and compared in full."""

    def __init__(self, patterns: dict[tuple[bytes, ...], list]):
        self.single = {p[0]: ids for p, ids in patterns.items() if len(p) < BLOCK}
        self.tables = []
        # Two length classes: full windows, and the shorter items by their own shortest length.
        lengths = sorted({len(p) for p in patterns if len(p) >= BLOCK})
        classes = [[n for n in lengths if n < WINDOW], [n for n in lengths if n >= WINDOW]]
        for group in classes:
            mine = [p for p in patterns if len(p) in group]
            if not mine:
                continue
            m = min(map(len, mine))
            shift: dict[tuple[bytes, bytes], int] = {}
            bucket: dict[tuple[bytes, bytes], dict[bytes, list]] = {}
            for p in mine:
                for j in range(BLOCK, m + 1):
                    block = (p[j - 2], p[j - 1])
                    s = m - j
                    if s < shift.get(block, m):
                        shift[block] = s
                last = (p[m - 2], p[m - 1])
                bucket.setdefault(last, {}).setdefault(p[0], []).append((p, patterns[p]))
            self.tables.append((m, shift, bucket))

    def find(self, w: list[bytes]) -> Iterator[tuple[int, int, list]]:
        """(start, end, ids) of every occurrence."""
        n = len(w)
        if self.single:
            get = self.single.get
            for i, x in enumerate(w):
                ids = get(x)
                if ids is not None:
                    yield i, i + 1, ids
        for m, shift, bucket in self.tables:
            far, get, i = m - BLOCK + 1, shift.get, m - 1
            while i < n:
                block = (w[i - 1], w[i])
                s = get(block, far)
                if s:
                    i += s
                    continue
                start = i - m + 1
                for p, ids in bucket[block].get(w[start], ()):
                    k = len(p)
                    if tuple(w[start:start + k]) == p:
                        yield start, start + k, ids
                i += 1


def _patterns(benchmark: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Distinct (pattern, item ids) of the benchmark."""

    def cut(batches) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, pats = [], []
            for key, text in zip(b.column(0).to_pylist(), b.column(1).cast(pa.binary()).to_pylist()):
                w = words(text or b"")
                for i in range(max(1, len(w) - WINDOW + 1) if w else 0):
                    keys.append(key)
                    pats.append(b" ".join(w[i:i + WINDOW]))
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(pats, pa.binary())], ["item", "pattern"])

    rows = benchmark.select(F.col(id_col).cast("long").alias("item"), F.col(text_col).alias("text"))
    return rows.transform(in_tasks(cut, "item long, pattern binary")).distinct()


def find_benchmark(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text_col: str = "text", keep: bool = False,
                   pattern_block: int = PATTERN_BLOCK) -> DataFrame:
    """Per document row: n_words, n_hit, items (ids with occurring windows,
    sorted as strings), contaminated.  ``keep`` returns the document columns
    of rows that are not contaminated instead."""
    found = materialize(_patterns(benchmark, item_col, item_text_col), "benchmark_patterns")
    if found.count() <= pattern_block:
        search = _broadcast_search(found)
        links = None
    else:
        search, links = _block_search(found, pattern_block)

    def rows(batches) -> Iterator[pa.RecordBatch]:
        for b in search.gather(batches, "text"):
            n_words, n_hit, seen = search(b.column(1))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(map(sorted, seen), pa.list_(pa.int64())),
                 pa.array([h > 0 and 20 * h >= n for n, h in zip(n_words, n_hit)], pa.bool_())],
                ["id", "n_words", "n_hit", "seen", "contaminated"])

    def clean(batches) -> Iterator[pa.RecordBatch]:
        for b in search.gather(batches, text_col):
            n_words, n_hit, _ = search(b.column(b.schema.get_field_index(text_col)))
            yield b.filter(pa.array([not (h > 0 and 20 * h >= n) for n, h in zip(n_words, n_hit)], pa.bool_()))

    if keep:
        return docs.transform(in_tasks(clean, docs.schema))
    out = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).transform(in_tasks(
        rows, f"id {docs.schema[id_col].dataType.simpleString()}, n_words long, n_hit long, seen array<long>, contaminated boolean"))
    if links is None:
        items = F.array_sort(F.transform("seen", lambda i: i.cast("string")))
        return out.select(F.col("id").alias(id_col), "n_words", "n_hit", items.alias("items"), "contaminated")
    # rows are numbered once they are written, so that a lost task can't number them anew
    out = materialize(out, "pattern_hits").withColumn("row", F.monotonically_increasing_id())
    out = materialize(out, "pattern_hits")
    named = (out.select("row", F.explode("seen").alias("pattern_id")).join(links, "pattern_id").filter(F.col("item").isNotNull())
             .groupBy("row").agg(F.array_sort(F.collect_set(F.col("item").cast("string"))).alias("items")))
    return out.join(named, "row", "left").select(F.col("id").alias(id_col), "n_words", "n_hit",
                                                 F.coalesce("items", F.array().cast("array<string>")).alias("items"), "contaminated")


class _Search:
    """Counts of an array of texts: words, hit words, and the numbers (items
    or patterns) found in each."""

    def __init__(self, tables: Callable[[], Iterator[WuManber]], buffer: int | None):
        self.tables, self.buffer = tables, buffer

    def gather(self, batches, column: str) -> Iterator[pa.RecordBatch]:
        return steps(batches, column) if self.buffer is None else buffered(steps(batches, column), column, self.buffer)

    def __call__(self, texts: pa.Array) -> tuple[list[int], list[int], list[set]]:
        raw = texts_of(texts).cast(pa.large_binary())
        split = [words(x) for x in raw.to_pylist()] if self.buffer is None else None      # a buffer's words would not fit
        n_words, seen = [0] * len(raw), [set() for _ in range(len(raw))]
        marks: dict[int, np.ndarray] = {}
        for search in self.tables():
            for i in range(len(raw)):
                w = split[i] if split is not None else words(raw[i].as_py())
                n_words[i] = len(w)
                for start, end, ids in search.find(w):
                    if i not in marks:
                        marks[i] = np.zeros(len(w), bool)
                    marks[i][start:end] = True
                    seen[i].update(ids)
        n_hit = [0] * len(raw)
        for i, m in marks.items():
            n_hit[i] = int(m.sum())
        return n_words, n_hit, seen


def buffered(batches: Iterator[pa.RecordBatch], column: str, size: int) -> Iterator[pa.RecordBatch]:
    """Batches put together until ``column`` holds ``size`` bytes."""
    held, total = [], 0
    for b in batches:
        n = b.column(b.schema.get_field_index(column)).nbytes
        if held and total + n > size:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, total = [], 0
        held.append(b)
        total += n
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _broadcast_search(found: DataFrame) -> _Search:
    rows = [(r["item"], bytes(r["pattern"])) for r in found.collect()]      # at most pattern_block rows
    shared = found.sparkSession.sparkContext.broadcast(rows)
    kept: list[WuManber] = []

    def tables() -> Iterator[WuManber]:
        if not kept:
            patterns: dict[tuple[bytes, ...], list] = {}
            for item, p in shared.value:
                items = patterns.setdefault(tuple(p.split(b" ")), [])
                if item is not None:
                    items.append(item)
            kept.append(WuManber(patterns))
        yield kept[0]

    return _Search(tables, None)


def _block_search(found: DataFrame, pattern_block: int) -> tuple[_Search, DataFrame]:
    """The search, and the (pattern_id, item) table."""
    spark = found.sparkSession
    distinct = materialize(found.select("pattern").distinct(), "patterns").withColumn("pattern_id", F.monotonically_increasing_id())
    distinct = materialize(distinct, "patterns")
    blocks = max(1, -(-distinct.count() // pattern_block))
    folder = scratch_path(spark, "pattern_blocks")
    block = F.pmod(F.xxhash64("pattern"), F.lit(blocks))
    distinct.withColumn("block", block).repartition("block").write.partitionBy("block").parquet(folder)

    def tables() -> Iterator[WuManber]:
        fs, path = pafs.FileSystem.from_uri(folder if ":" in folder else f"file://{folder}")
        for k in range(blocks):
            if fs.get_file_info(f"{path}/block={k}").type == pafs.FileType.NotFound:      # no pattern fell into it
                continue
            t = ds.dataset(f"{path}/block={k}", filesystem=fs, format="parquet").to_table(columns=["pattern_id", "pattern"])
            yield WuManber({tuple(p.split(b" ")): [i] for i, p in zip(t["pattern_id"].to_pylist(), t["pattern"].to_pylist())})

    return _Search(tables, BUFFER), materialize(found.join(distinct, "pattern").select("pattern_id", "item"), "pattern_items")
