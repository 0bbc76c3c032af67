import math
import random

import numpy as np
import pytest

from churnlake.llm import topk as K

SCHEMA = "vec_id long, embedding array<double>, part long, kind int, score long, key string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v and [x if x is None else float(x) for x in v], 1, 2, 3, "x") for i, v in rows], SCHEMA)


def brute(rows, is_query, k, scale=256):
    ok = [(i, [math.floor(scale * x) for x in v]) for i, v in rows
          if i is not None and v is not None and all(x is not None and math.isfinite(x) and abs(scale * x) <= 1 << 27 for x in v)]
    out = []
    for i, q in ok:
        if is_query(i):
            got = sorted((-sum(a * b for a, b in zip(q, v)), j) for j, v in ok if j != i)[:k]
            out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(got)]
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("n,dim,levels", [(300, 7, 3), (1000, 16, 200), (90, 1, 2)])
def test_block_scores_and_selection(n, dim, levels):
    rng = np.random.default_rng(n)
    x = rng.integers(-levels, levels + 1, (n, dim))
    ids = rng.permutation(n * 3)[:n].astype(np.int64)
    block = K.Block.of_rows(ids, x)
    for k in (1, 5, n + 3):
        for q in range(0, n, 37):
            got = block.best(int(ids[q]), x[q], k)
            want = sorted((-int(s), int(i)) for i, s in zip(ids, x @ x[q]) if i != ids[q])[:k]
            assert sorted((-int(s), int(i)) for i, s in zip(*got)) == want


@pytest.mark.parametrize("block_rows,group_queries", [(32_768, 2_048), (40, 3)])
def test_matches_brute_force(spark, block_rows, group_queries):
    rng = random.Random(4)
    rows = [(i, [rng.uniform(-1, 1) for _ in range(6)]) for i in range(400)]
    rows += [(400 + i, [0.5, 0.25, -0.5, 0.0, 0.1, 0.9]) for i in range(150)]            # a third are copies
    rows += [(600, None), (650, [0.1, None, 0.2, 0, 0, 0]), (651, [float("nan")] * 6), (700, [float("inf"), 0, 0, 0, 0, 0]), (None, [0.1] * 6),
             (750, []), (751, [0.5, 0.5]), (752, [1e300] * 6), (753, [3e5, -3e5, 0.0, 1.0, 0.0, 0.0])]
    df = frame(spark, rows)
    got = K.top_k(df, df.filter("vec_id % 50 = 0"), block_rows=block_rows, group_queries=group_queries)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert rows_of(got) == brute(rows, lambda i: i % 50 == 0, 5)


def test_few_rows_repeated_rows_and_empty_tables(spark):
    rows = [(0, [0.5, 0.5]), (0, [0.5, 0.5]), (1, [0.25, -0.25]), (1, [0.25, -0.25]), (2, [0.5, 0.5])]
    df = frame(spark, rows)
    assert rows_of(K.top_k(df, df.filter("vec_id = 0"))) == sorted(2 * [(0, 1, 2, 32768), (0, 2, 1, 0), (0, 3, 1, 0)])
    none = df.filter("vec_id > 99")
    assert K.top_k(none, none).count() == 0 and K.top_k(df, none).count() == 0 and K.top_k(none, df).count() == 0
