import os
import random

import pytest
from pyspark.sql import functions as F

from lumenweave.llm import tokens

pytestmark = pytest.mark.skipif(not os.path.exists(tokens.VOCABULARY), reason="no vocabulary here")


def test_cut_runs_change_nothing():
    encoding, rng = tokens.encoder(), random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choice([" ", "  ", "\n", "\t", "a", "Bc", "é", "9", ".", "'s", "   \n  "]) for _ in range(rng.randint(0, 25)))
        assert tokens.count_tokens(encoding, text, 2) == len(encoding.encode_ordinary(text)), repr(text)


def test_very_long_texts(spark):
    texts = ["x" * 300_000, " " * 400_000 + "a", "a" + "\n" * 400_000, "#" * 300_000, "7" * 300_000, " a" * 200_000, "", None]
    got = [r[0] for r in spark.createDataFrame(list(enumerate(texts)), "i int, t string").orderBy("i").select(tokens.n_tokens(F.col("t"))).collect()]
    assert all(n > 0 for n in got[:6]) and got[5] == 200_000 and got[6:] == [0, 0]
