import random

import numpy as np
import pytest

from lumenweave.llm import quality as Q
from lumenweave.llm.quality_examples import EXAMPLES


def test_examples_have_their_own_kind():
    x = np.array([Q.statistics(t)[3:] for _, _, texts in EXAMPLES for t in texts])
    mixture = Q.Mixture(x.mean(axis=0), np.maximum(x.std(axis=0), 1e-3))
    shares = mixture.kind_shares(x)
    names, kinds = list(shares), [k for k, _, texts in EXAMPLES for _ in texts]
    best = np.array(names)[np.stack([shares[n] for n in names]).argmax(axis=0)]
    assert (best == np.array(kinds)).mean() > 0.97


def test_statistics():
    s = dict(zip(Q.COLUMNS, Q.statistics("The cat is on the mat.\nIt sleeps, and it purrs.")))
    assert s["n_words"] == 11 and s["n_lines"] == 2 and s["ended_line_share"] == 1 and s["common_word_share"] > 0.5
    assert Q.statistics(None)[1:] == Q.statistics("")[1:] == (0, 0, *[0.0] * len(Q.STATISTICS)) and Q.statistics(" \n\t")[2] == 0
    assert Q.same_field_share(["a,b,c", "d,e,f", "g,h,i", "x"]) == 0.75 and Q.same_field_share(["a|b"]) == 0
    assert all(np.isfinite(Q.statistics(t)).all() for t in ("​", "퟿", "x" * 300_000, "!" * 1000, "1\n2\n3"))


def _corpus(rng):
    nouns = "cat dog lamp table house boat river tree window garden".split()
    forms = ("The {} is next to the {} and it was {} when we came.", "Nobody had seen such a {} near this {}, which looked {} to all of us.", "In the evening she put her {} under a {} that her brother called {}.", "While they talked about the {}, some {} fell, and what was left of it was {}.",
             "There are two of them: one {} for him, one {} for you, both rather {}.", "Why would a {} stand behind every {} if not for being so {}?", "He says that his {} was lost on the way to our {}, but I don't think that this is {}.")
    prose = lambda: " ".join(f.format(rng.choice(nouns), rng.choice(nouns), rng.choice(["old", "new", "wet"])) for f in rng.sample(forms, rng.randint(2, 6)))
    lists = lambda: "\n".join(f"- {rng.choice(['Red', 'Old', 'Two'])} {rng.choice(nouns)}" for _ in range(rng.randint(5, 15)))
    tables = lambda: "\n".join(f"{rng.choice(nouns)},{rng.randint(0, 99)},{rng.random():.2f}" for _ in range(rng.randint(5, 15)))
    junk = lambda: "".join(rng.choice("#$%&*()_+{}|<>?~^[];:") for _ in range(rng.randint(80, 300)))
    return [(k, f()) for k, f in (("prose", prose), ("list", lists), ("table", tables), ("junk", junk)) for _ in range(60 if k == "prose" else 15)]


def test_kinds(spark):
    rng = random.Random(2)
    corpus = _corpus(rng)
    rows = [(i, t) for i, (_, t) in enumerate(corpus)] + [(900, None), (901, ""), (None, "lost"), (0, corpus[0][1])]
    df = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id bigint, text string, kind string")
    got = {r["doc_id"]: r["kind"] for r in Q.kinds(df).collect()}
    assert len(got) == len(corpus) + 2 and got[900] == got[901] == "junk"
    assert sum(got[i] == k for i, (k, _) in enumerate(corpus)) / len(corpus) > 0.97
    same = {r["doc_id"]: r["kind"] for r in Q.kinds(df.repartition(5)).collect()}
    assert sum(same[i] != got[i] for i in got) <= 1


def test_copies_of_a_corpus_have_its_kinds(spark):
    rows = [(i + 1000 * k, t) for k in range(10) for i, (_, t) in enumerate(_corpus(random.Random(3)))]
    once, ten = ({r["doc_id"]: r["kind"] for r in Q.kinds(spark.createDataFrame(part, "doc_id bigint, text string")).collect()} for part in (rows[: len(rows) // 10], rows))
    assert all(kind == once[i % 1000] for i, kind in ten.items())


def test_warning_where_the_fit_does_not_settle(spark):
    stats = Q.document_statistics(spark.createDataFrame(list(enumerate(t for _, t in _corpus(random.Random(4)))), "doc_id bigint, text string"))
    with pytest.warns(UserWarning, match="not settled after 1 steps"):
        Q.fit(stats, steps=1)


def test_one_document_and_none(spark):
    df = spark.createDataFrame([(1, "The cat is on the mat, and it sleeps there all the day.")], "doc_id bigint, text string")
    assert [r["kind"] for r in Q.kinds(df).collect()] == ["prose"]
    assert Q.kinds(df.limit(0)).count() == 0
