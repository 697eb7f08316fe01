import random

import numpy as np
import pytest

from lumenweave.llm import leakage as K


def brute(docs, items, window):
    out = set()
    for d, t in docs:
        w = K.words_of(t)
        there = {tuple(w[i : i + window]) for i in range(len(w) - window + 1)}
        for i, x in items:
            v = K.words_of(x)
            if any(tuple(v[k : k + window]) in there for k in range(len(v) - window + 1)):
                out.add((d, i))
    return out


@pytest.mark.parametrize("window, shingle, limit", [(13, 5, 10**9), (13, 5, 0), (4, 2, 10**9), (4, 4, 0), (5, 1, 10**9)])
def test_both_ways(spark, window, shingle, limit):
    rng = random.Random(window * 7 + shingle)
    words = [f"w{i}" for i in range(12 if window < 9 else 40)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([3, 13, 20, 60])))) for i in range(30)]
    docs = []
    for d in range(60):
        text = rng.choices(words, k=rng.choice([0, 5, 50, 300]))
        for _ in range(rng.randint(0, 2)):
            source = rng.choice(items)[1].split()
            at, n = rng.randrange(len(source)), rng.choice([window - 1, window, window + 4])
            text[len(text) // 2 : len(text) // 2] = [x.upper() + rng.choice([".", " -", "\n"]) for x in source[at : at + n]]
        docs.append((d, " ".join(text)))
    docs += [(100, None), (101, ""), (None, items[5][1]), (5, docs[5][1])]
    items += [(200, None), (None, docs[3][1]), (3, items[3][1])]
    got = K.leaks(spark.createDataFrame([(*r, 1) for r in docs], "doc_id bigint, text string, item_id int"), spark.createDataFrame(items, "item_id bigint, text string"), window, shingle, limit)
    rows = [tuple(r) for r in got.collect()]
    known = brute([r for r in docs if r[0] is not None], [r for r in items if r[0] is not None], window)
    assert set(rows) == known and len(rows) == len(known) and known


def test_empty(spark):
    docs, items = spark.createDataFrame([], "doc_id bigint, text string"), spark.createDataFrame([(1, "a " * 20)], "item_id bigint, text string")
    assert K.leaks(docs, items).count() == 0 and K.leaks(docs, items, broadcast_words=0).count() == 0
    assert K.leaks(spark.createDataFrame([(1, "a " * 20)], "doc_id bigint, text string"), items.limit(0)).count() == 0


def test_window_minhash():
    words = np.arange(30, dtype=np.uint64) * np.uint64(12345)
    for window, shingle in ((13, 5), (4, 4), (7, 1)):
        least, hashes = K.window_minhashes(words, window, shingle), K._rolling(words, shingle)
        n = window - shingle + 1
        assert least.tolist() == [hashes[i : i + n].min() for i in range(30 - window + 1)]
    assert len(K.window_minhashes(words[:12])) == 0
