import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

SMOKE = "/root/testdata/sf0.001"

#: Documents with every awkward case: null and empty texts, a null and a repeated doc_id, repeated rows, a long text,
#: other scripts, control characters, and columns whose names clash with the operators' own.
LONG = " ".join(f"w{i % 977} and{i % 13}" for i in range(40_000))
CASES = [
    (1, "The quick brown fox jumps over the lazy dog and runs away from it all day long."),
    (2, None), (3, ""), (4, "   \n\t "), (5, "one"), (6, "one two"),
    (7, "The quick brown fox jumps over the lazy dog and runs away from it all day long."),
    (7, "The quick brown fox jumps over the lazy dog and runs away from it all day long."),
    (None, "null id"), (8, LONG), (9, "日本語のテキスト です 🙂 ñandú über straße"), (10, "a\x00b\x0bc\x1cd\u2028e\xa0f"),
    (11, "a  b   c \n d\n\n\ne <|endoftext|> </s>[INST] x\\y [/INST]"), (12, "### $$$ *** %%% &&& || <<>>"),
]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words long, kept boolean, id long, fp long, key string"


@pytest.fixture(scope="session")
def cases(spark):
    rows = [(i, t, None if i == 9 else "en", "src0", len(t or ""), 99, True, 5, 6, "k") for i, t in CASES]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], SCHEMA)
