from churnlake.llm import url_reputation as U

PAGES = "page_id long, url string, html string, host string, n long"
LABELS = "doc_id long, quality int, toxic int, host string"


def judge(spark, urls, labels=()):
    pages = spark.createDataFrame([(i, u, None, "clash", 1) for i, u in enumerate(urls)], PAGES)
    lab = spark.createDataFrame([(i, q, t, "x") for i, q, t in labels], LABELS)
    return {r["page_id"]: r for r in U.judge(pages, lab).collect()}


def test_host_path_and_rules(spark):
    urls = [None, "nothing", "", "http://A.Example.ORG/es/x?q#f", "https://example.org/en/12", "x://example.org/en/2", "http://notexample.org/es/",
            "http://a.com/fr/1", "http://a.com/de/1?x", "http://com/de/", "http://a.org", "http://a.org?x", "a://b://c.com/fr/", "http://É.org/É/?", "u://h#://x"]
    got = judge(spark, urls)
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"]) for i in range(len(urls))] == [
        ("", "", None), ("", "", None), ("", "", None), ("a.example.org", "/es/x", "example.org/es/"), ("example.org", "/en/12", "example.org/en/1"),
        ("example.org", "/en/2", "org/"), ("notexample.org", "/es/", "org/"), ("a.com", "/fr/1", "com/fr/"), ("a.com", "/de/1", "com/de/"),
        ("com", "/de/", "com/de/"), ("a.org", "", None), ("a.org", "", None), ("b:", "//c.com/fr/", None), ("É.org", "/É/", "org/"), ("h", "", None)]
    assert got[3]["verdict"] == "block" and got[7]["verdict"] == "allow"


def test_reputation_shrinks_and_blocks(spark):
    urls = [f"http://bad.net/{i}" for i in range(60)] + [f"http://good{i % 20}.net/{i}" for i in range(200)] + ["http://one.net/"]
    labels = [(i, 0, 0) for i in range(60)] + [(i, 1, 0) for i in range(60, 260)] + [(260, 0, 1)]
    got = judge(spark, urls, labels + labels[:5])
    assert got[0]["verdict"] == "block" and got[100]["verdict"] == "allow"
    # one bad page is shrunk towards its suffix, sixty are hardly
    assert got[60]["bad_rate"] < 0.1 < got[260]["bad_rate"] < got[0]["bad_rate"] < 1 and got[0]["bad_rate"] > 0.9
    assert got[260]["bound"] < got[0]["bound"]


def test_no_labels_and_no_pages(spark):
    assert {r["verdict"] for r in judge(spark, ["http://x.net/", "http://x.net/"]).values()} == {"allow"}
    assert judge(spark, []) == {}


def test_suffixes(spark):
    d = spark.createDataFrame([("a.b.co.uk",), ("b.co.uk",), ("x.example.com:80",), ("localhost",), ("",)], "h string")
    from pyspark.sql import functions as F
    got = [tuple(r) for r in d.select(*U.suffix_and_domain(F.col("h"))).collect()]
    assert got == [("co.uk", "b.co.uk"), ("co.uk", "b.co.uk"), ("com", "example.com"), ("localhost", "localhost"), ("", "")]


def test_plan_stays_small(spark):
    """Written levels: no level repeats the plans below it."""
    urls = [f"http://h{i % 9}.example{i % 3}.net/{i}" for i in range(90)]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    plan = U.judge(pages, labels)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") < 12 and plan.count("FileScan") <= 3
