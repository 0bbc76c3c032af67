import json
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from churnlake.llm import token_files as TF
from churnlake.llm.encode import TextEncoder
from churnlake.session import scratch_path

from .conftest import CASES

HARD = [t for _, t in CASES] + ["  ", "a \n b", "a\n b", " a", "a ", "don't stop", "it's 'quoted'", "x<|endoftext|>y", "<|ENDOFTEXT|>", "Å J\u030c e\u0301 É",
                               "ß ǅ İ Σας ΣΑΣ", "123 45,6", "foo.\nBar, baz!\n\nQux", "Àé. Ünï,\nÖß", "a—b “q”", "\r\n x\r\ny z", "foo.\n. bar", "ﬁ Å"]


@pytest.mark.parametrize("name,drop", [("word_bpe_49k.json", True), ("byte_bpe_50k.json", False)])
@pytest.mark.parametrize("capacity", [3, 100_000])
def test_encoder_equals_the_library(name, drop, capacity):
    path = public_tokenizers.path(name)
    enc, whole = TextEncoder(path, drop, capacity), Tokenizer.from_file(path)
    for _ in range(2):
        ids, rows = enc.encode(pa.array(HARD, pa.string()))
        for i, t in enumerate(HARD):
            assert ids[rows[i]:rows[i + 1]].tolist() == whole.encode(t or "", add_special_tokens=False).ids, t
    ids, rows = enc.encode(pa.array([], pa.string()))
    assert len(ids) == 0 and rows.tolist() == [0]


def test_files_round_trip(spark, cases):
    folder = scratch_path(spark, "tokens_test")
    path = public_tokenizers.path("word_bpe_49k.json")
    got = TF.token_files(cases.repartition(5), path, True, 2, folder).orderBy("start").collect()
    whole = Tokenizer.from_file(path)
    key = lambda c: (c[0] is not None, c[0] or 0)
    at = 0
    for r, (i, t) in zip(got, sorted(CASES, key=key), strict=True):
        ids = whole.encode(t or "", add_special_tokens=False).ids + [2]
        assert tuple(r) == (i, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    manifest = json.loads(TF._open_fs(folder)[0].open_input_stream(TF._open_fs(folder)[1] + "/manifest.json").read())
    assert manifest["n_tokens"] == at and manifest["n_docs"] == len(CASES) and all(s["width"] == 2 for s in manifest["shards"])


def test_no_documents(none):
    assert TF.token_files(none, public_tokenizers.path("word_bpe_49k.json"), True, 2).count() == 0
