import corpus_pipeline as CP
from churnlake.llm import decontam, pii, quality, simhash

from .conftest import SMOKE


def test_stages_take_effect(spark):
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    labels, benchmark = spark.read.parquet(f"{SMOKE}/labels.parquet"), spark.read.parquet(f"{SMOKE}/benchmark.parquet")
    ids = lambda df: sorted(r["doc_id"] for r in df.select("doc_id").collect())
    kept = CP.quality_rules(spark, docs, SMOKE)
    assert kept.columns == docs.columns and ids(kept) == ids(quality.judge(docs, labels).filter("kept"))
    one = CP.near_duplicates(spark, kept, SMOKE)
    found = simhash.near_duplicates(kept)
    assert one.columns == docs.columns and ids(one) == sorted({r["component_id"] for r in found.collect()})
    clean = CP.decontamination(spark, one, SMOKE)
    assert clean.columns == docs.columns and ids(clean) == ids(decontam.find_benchmark(one, benchmark).filter("not contaminated"))
    private = CP.personal_data(spark, clean, SMOKE)
    assert private.columns == docs.columns and private.schema == docs.schema and ids(private) == ids(clean)
    assert pii.report(private).filter("spans <> ''").count() == 0
    assert pii.report(clean).filter("spans <> ''").count() > 0


def test_run_equals_stage_by_stage(spark):
    packed = CP.run(spark, SMOKE)
    docs = spark.read.parquet(f"{SMOKE}/documents.parquet")
    for _, stage in CP.STAGES[:-1]:
        docs = stage(spark, docs, SMOKE)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in docs.collect()}
    assert [n for n, _ in CP.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "personal_data", "best_fit_packing"]


def test_awkward_rows(spark, cases, none):
    docs = cases.select("doc_id", "text", "lang", "source", "n_chars")
    for frame in (docs, none.select(*docs.columns)):
        for _, stage in CP.STAGES[:-1]:
            out = stage(spark, frame, SMOKE)
            assert out.columns == docs.columns
        CP.best_fit_packing(spark, frame, SMOKE).count()
    got = [r["doc_id"] for r in CP.near_duplicates(spark, docs, SMOKE).collect()]
    assert got.count(1) == 1 and got.count(7) == 0 and got.count(None) == 1


def test_near_duplicates_go_by_row(spark):
    """Repeated and missing ids: distinct texts all stay, of copies one stays."""
    a, b, c, d, e = (" ".join(f"{w}{k}" for k in range(60)) for w in ("red", "oak", "sea", "fog", "ivy"))
    rows = [(1, a), (5, a), (5, b), (None, c), (None, c), (None, c), (6, d), (6, e), (7, e), (None, d), (8, b), (8, b)]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t), 3) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long, _row int")
    out = CP.near_duplicates(spark, docs, SMOKE)
    assert out.columns == docs.columns
    got = sorted(((r["doc_id"] or 0, r["text"]) for r in out.collect()))
    assert got == sorted([(1, a), (5, b), (0, c), (6, d), (6, e)])
