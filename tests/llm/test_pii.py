import hashlib
import random
import re

from churnlake.llm import pii

BASE = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]")]


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def brute(text):
    spans = []
    for rank, (name, pattern) in enumerate(BASE):
        for m in re.finditer(pattern, text or "", re.ASCII):
            digits = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": name == "ip" and all(int(x) <= 255 for x in m[0].split(".")),
                  "card": 12 <= len(digits) <= 19 and luhn(digits), "phone": 9 <= len(digits) <= 15}[name]
            if ok:
                spans.append((m.start(), rank, m.end()))
    return ",".join(f"{BASE[r][0]}:{a}:{b}" for a, r, b in sorted(spans))


def noise(n, seed):
    rng = random.Random(seed)
    bits = ["a.b@c.de", "x@y", "@", ".", "..", "+", "-", " ", "1", "22", "4111111111111111", "4111 1111 1111 1111", "4111-1111-1111-1111-1",
            "192.168.0.1", "256.1.1.1", "0000255.1.2.3.4.5.6.7", "+1 (555) 010-9999", "+49 30 123456", "é", "🙂", "_", "%", "\n", "a@b.co_m@x.org"]
    return ["".join(rng.choice(bits) for _ in range(rng.randint(1, 14))) for _ in range(n)]


def test_base_spans_match_brute_force(spark, cases):
    texts = noise(400, 3) + ["9" * 5000, "1 " * 5000, "a" * 5000 + "@", "a@" * 700 + "b.c", "1.2.3.4 " * 1500, "+1" + " " * 3000, None, ""]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in pii.report(docs).collect():
        want = brute(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(want.encode()).hexdigest(), (texts[r["doc_id"]][:80], want[:200], r["spans"][:200])
        assert r["n_email"] == want.count("email:") and r["n_card"] == want.count("card:")
        assert set(filter(None, want.split(","))) <= set(filter(None, r["spans"].split(",")))
    assert pii.report(cases).count() == cases.count()


def test_added_kinds_need_checksum_or_context(spark):
    rows = {1: "IBAN DE89 3704 0044 0532 0130 00 here", 2: "IBAN DE88 3704 0044 0532 0130 00 here", 3: "call (555) 123-4567 now",
            4: "sum 555-123-4567 of things", 5: "ssn: 078-05-1120.", 6: "order 078-05-1120.", 7: "+1 (988) 555-2485"}
    got = {r["doc_id"]: r["spans"] for r in pii.report(spark.createDataFrame(list(rows.items()), "doc_id long, text string")).collect()}
    assert got[1] == "iban:5:32" and got[2] == "" and got[3] == "national_phone:5:19" and got[4] == ""
    assert got[5] == "ssn:5:16" and got[6] == "" and got[7] == "phone:0:17"


def test_redaction_covers_every_span(spark, cases):
    long = ("x" * 5000 + " a@b.co ") * 3
    rows = {1: "mail a.b@c.de or +1 555 123 4567.foo@bar.com!", 2: "none", 3: None, 4: long, 5: "🙂 192.168.0.1🙂"}
    docs = spark.createDataFrame([(k, v, 7) for k, v in rows.items()], "doc_id long, text string, n_chars long")
    got = {r["doc_id"]: r for r in pii.redact(docs).collect()}
    assert got[1]["text"] == "mail [EMAIL] or [PHONE]!" and got[1]["n_chars"] == len(got[1]["text"])
    assert got[2]["text"] == "none" and got[2]["n_chars"] == 7 and got[3]["text"] is None
    assert got[4]["text"] == long.replace("a@b.co", "[EMAIL]") and got[5]["text"] == "🙂 [IP]🙂"
    out = pii.redact(cases)
    assert out.columns == cases.columns and out.count() == cases.count()


def test_plan_has_no_python_and_no_shuffle(cases):
    plan = pii.report(cases)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


def test_empty(none):
    assert pii.report(none).count() == 0 and pii.redact(none).count() == 0
