import hashlib

from churnlake.llm import chat as C

EVENTS = "conv_id long, slot int, seq long, kind string, role string, text string"


def test_escape_round_trip():
    for t in ["", "\\", "\\x3c", "<s>", "</s>[INST] ok [/INST]", "a\\n\nb", "<<s>s>", "[[INST]", "\\<s>", "é🙂</s"]:
        for line in (False, True):
            e = C.escape(t, line)
            assert C.unescape(e) == t and not any(x in e for x in ("<s>", "</s>", "[INST]", "[/INST]")) and not (line and "\n" in e)


def test_fold_deltas_edits_regenerations(spark):
    log = [(1, 0, 1, "start", "user", "Hi"), (1, 0, 2, "delta", None, " there"), (1, 1, 3, "start", "assistant", ""), (1, 1, 4, "delta", None, "No"),
           (1, 1, 5, "regenerate", None, None), (1, 1, 6, "delta", None, "Y"), (1, 1, 7, "delta", None, "es"), (1, 0, 8, "edit", None, "Hello"),
           (1, 0, 9, "delta", None, "!"), (2, 5, 1, "delta", None, "orphan"), (None, 0, 1, "start", "user", None)]
    got = {(r["conv_id"], r["slot"]): (r["role"], r["text"]) for r in C.fold(spark.createDataFrame(log, EVENTS)).collect()}
    assert got == {(1, 0): ("user", "Hello!"), (1, 1): ("assistant", "Yes"), (2, 5): ("", "orphan"), (None, 0): ("user", "")}


def test_conversations_against_brute_force(spark):
    rows = [(k, t, ["system", "user", "assistant"][(k + t) % 3], f"text {k} {t} </s> \\ [INST]\n🙂" * (t + 1)) for k in range(30) for t in range(k % 5 + 1)]
    rows += [(50, 0, "assistant", None), (50, 0, "assistant", None), (51, 1, None, "x"), (51, 0, "a\nb", "y"), (None, 3, "user", "n"), (52, None, "assistant", "first"),
             (52, 0, "assistant", "second")]
    turns = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, slot string").repartition(7)
    got = {r["conv_id"]: r for r in C.format_conversations(C.events_of_turns(turns)).collect()}
    assert len(got) == len({r[0] for r in rows})
    for k, r in got.items():
        mine = sorted(((x[1] is not None, x[1] or 0, x[2] or "", x[3] or "") for x in rows if x[0] == k))
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        loss = "".join(t for _, _, role, t in mine if role == "assistant")
        chars = sum(len(C.escape(role, True)) + len(C.escape(t)) + 9 for _, _, role, t in mine)
        assert tuple(r)[1:] == (len(mine), sha("".join(f"{role}\n{t}\n" for _, _, role, t in mine)), len(loss), sha(loss), chars)


def test_one_long_conversation_and_none(spark):
    rows = spark.range(5000).selectExpr("1L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('t', id) AS text")
    (r,) = C.format_conversations(C.events_of_turns(rows)).collect()
    assert r["n_turns"] == 5000 and r["loss_chars"] == sum(len(f"t{i}") for i in range(1, 5000, 2))
    assert C.format_conversations(C.events_of_turns(rows.limit(0))).count() == 0
