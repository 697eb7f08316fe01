"""Column functions over texts: sentences, transcripts, verdicts, labels, statements, flat box texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .nouns import singular_phrase

# Sentences and information lists


def sentences(items: Column) -> Column:
    """``array<struct<item, sentence>>``: sentences of a list of texts, in order, each with the place of its text.

    A sentence ends with ``.``, ``!`` or ``?`` before white space of any kind; parts without a visible character are left out.
    """
    def split(text: Column, i: Column) -> Column:
        parts = F.filter(F.transform(F.split(text, r"(?U)(?<=[.!?])\s+"), lambda t: F.trim(t)), lambda s: s != "")
        return F.transform(parts, lambda s: F.struct(i.alias("item"), s.alias("sentence")))

    return F.flatten(F.transform(F.filter(items, lambda t: t.isNotNull()), split))


def rejoin(parts: Column) -> Column:
    """Texts of sentences: those of one item joined by a blank, in order; items without sentences are gone."""
    ids = lambda x: F.array_distinct(F.transform(x, lambda p: p["item"]))
    text = lambda x, i: F.array_join(F.transform(F.filter(x, lambda p: p["item"] == i), lambda p: p["sentence"]), " ")
    return F.get(F.transform(F.array(parts), lambda x: F.transform(ids(x), lambda i: text(x, i))), F.lit(0))


def split_by_selection(items: Column, selected: Column) -> tuple[Column, Column]:
    """(kept, removed): information without, and of, the sentences whose 0-based numbers are selected; others are ignored."""
    numbered = F.transform(sentences(items), lambda s, i: F.struct(i.alias("i"), s["item"].alias("item"), s["sentence"].alias("sentence")))
    # both are bound once by a lambda; an expression inside the filter would be computed for each sentence
    once = lambda keep: F.get(F.transform(F.array(F.struct(numbered.alias("all"), selected.alias("chosen"))), lambda x: F.filter(x["all"], lambda p: keep(F.array_contains(x["chosen"], p["i"])))), F.lit(0))
    return rejoin(once(lambda inside: ~inside)), rejoin(once(lambda inside: inside))


def total_length(items: Column) -> Column:
    """Characters of all texts of a list; nulls count nothing."""
    return F.coalesce(F.aggregate(items, F.lit(0), lambda n, t: n + F.coalesce(F.length(t), F.lit(0))), F.lit(0))


def reduction_ratio(kept: Column, original: Column) -> Column:
    """Share of the original characters that is gone; null for an empty original."""
    return 1 - F.try_divide(total_length(kept).cast("double"), total_length(original))


def enough_information(items: Column, least: int = 100) -> Column:
    return total_length(items) >= least


def long_lines(text: Column, more_than: int = 10) -> Column:
    """Lines with more than that many characters without their margins (statements of a converter)."""
    return F.filter(F.split(text, "\n"), lambda t: F.length(F.trim(t)) > more_than)


def caption_lines(text: Column) -> Column:
    return F.filter(F.transform(F.split(text, "\n"), lambda t: F.trim(t)), lambda t: t != "")


# Transcripts


def parse_transcript(text: Column, word: str = "Question", answer_word: str = "Answer", turns: int = -1, lenient: bool = False) -> Column:
    """``array<struct<q, a>>`` of a generated conversation, or null if it doesn't hold to the form.

    ``Turn n`` lines are dropped. A pair is ``Question: ... Answer: ...``; an answer ends before a blank line and the next
    question, or at the end, so pairs on following lines are one pair unless ``lenient``. An answer below three words loses its
    full stop. Null: no pair, an empty side, or another number of pairs than ``turns`` (-1: any).
    """
    plain = F.regexp_replace(text, r"Turn \d{1,2}\n", "")
    gap = r"\n+" if lenient else r"\n\n"
    pattern = rf"(?s){word}:\s*(.*?)\s*\n\s*{answer_word}:\s*(.*?)(?={gap}{word}:|\z)"
    questions, answers = (F.regexp_extract_all(plain, F.lit(pattern), F.lit(i)) for i in (1, 2))
    short = lambda a: F.when(F.size(F.split(a, r"\s+")) < 3, F.regexp_replace(a, r"\.$", "")).otherwise(a)
    pairs = F.transform(F.arrays_zip(questions.alias("q"), answers.alias("a")), lambda p: F.struct(F.trim(p["q"]).alias("q"), short(F.regexp_replace(p["a"], r"^\s+|\s+$", "")).alias("a")))
    whole = (F.size(pairs) > 0) & ~F.exists(pairs, lambda p: (p["q"] == "") | (p["a"] == ""))
    return F.when(whole & (F.lit(turns) < 0) | whole & (F.size(pairs) == turns), pairs)


def flatten_pairs(pairs: Column) -> Column:
    """Questions and answers in turn."""
    return F.flatten(F.transform(pairs, lambda p: F.array(p["q"], p["a"])))


def pair_up(messages: Column) -> Column:
    """``array<struct<q, a>>`` of messages in turn; a last one without an answer is left out."""
    n = F.floor(F.size(messages) / 2).cast("int")
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(F.get(messages, 2 * i).alias("q"), F.get(messages, 2 * i + 1).alias("a")))).otherwise(F.array().cast("array<struct<q string, a string>>"))


def first_pair_gate(pairs: Column, verdicts: Column) -> Column:
    """Pairs judged right; none at all if the first isn't. A missing verdict is a wrong one."""
    right = F.filter(F.arrays_zip(pairs.alias("p"), verdicts.alias("ok")), lambda z: F.coalesce(z["ok"], F.lit(False)) & z["p"].isNotNull())
    return F.when(F.coalesce(F.get(verdicts, F.lit(0)), F.lit(False)), F.transform(right, lambda z: z["p"])).otherwise(F.slice(pairs, 1, 0))


def after_thinking(text: Column, mark: str) -> Column:
    """What comes after the last mark of the end of the thinking, or the whole text, without white space of any kind around it."""
    return F.regexp_replace(F.when(F.contains(text, F.lit(mark)), F.substring_index(text, mark, -1)).otherwise(text), r"(?U)^\s+|\s+$", "")


def verdict(text: Column) -> Column:
    """True or false by the first word; null for any other."""
    word = F.regexp_extract(F.lower(F.trim(text)), r"^(true|false)\b", 1)
    return F.when(word == "true", True).when(word == "false", False)


def selection(text: Column) -> Column:
    """Numbers in the first brackets of a text; null without brackets. Numbers that are too large for a place are left out."""
    inside = F.regexp_extract(text, r"\[([^\]]*)\]", 1)
    return F.when(F.regexp_instr(text, F.lit(r"\[[^\]]*\]")) > 0, F.filter(F.transform(F.regexp_extract_all(inside, F.lit(r"(\d+)"), F.lit(1)), lambda n: n.try_cast("int")), lambda n: n.isNotNull()))


def answer_hint(question: Column, hint: str) -> Column:
    return F.when(F.contains(F.lower(question), F.lit(hint.lower())), question).otherwise(F.concat(question, F.lit(" "), F.lit(hint)))


def keep_asking(pairs: Column, without: str = "color") -> Column:
    """Pairs whose question asks, doesn't begin with ``I see`` and doesn't hold the word."""
    return F.filter(pairs, lambda p: ~p["q"].startswith("I see") & p["q"].endswith("?") & ~F.contains(F.lower(p["q"]), F.lit(without)))


def keep_token(pairs: Column, token: str) -> Column:
    return F.filter(pairs, lambda p: F.contains(p["q"], F.lit(token)))


def seeded_order(values: Column, seed: Column | str) -> Column:
    """Elements in an order that depends on the seed, the element and its place alone; the same for every run."""
    key = F.lit(seed) if isinstance(seed, str) else seed
    keyed = F.transform(values, lambda v, i: F.struct(F.md5(F.concat_ws("|", key, i.cast("string"), v.cast("string"))).alias("k"), v.alias("v")))
    return F.transform(F.array_sort(keyed), lambda p: p["v"])


def multiple_choice(text: Column, seed: Column | str, choices: Column | int = 4) -> Column:
    """``struct<question, options, answer>`` of a question with lines ``A.`` to ``E.``, of which the first is right; null if malformed.

    The first ``choices`` options are shuffled by the seed; ``answer`` is the letter of the right one.
    """
    question = F.regexp_extract(text, r"Question:\s*([^\n]*)", 1)
    options = F.regexp_extract_all(text, F.lit(r"(?m)^[A-E]\.\s*(.+?)\s*$"), F.lit(1))
    n = F.lit(choices) if isinstance(choices, int) else choices
    taken = F.slice(options, F.lit(1), F.greatest(n, F.lit(2)))
    mixed = seeded_order(taken, seed)
    place = F.array_position(mixed, F.get(taken, F.lit(0)))
    return F.when((question != "") & (F.size(options) >= 2), F.struct(question.alias("question"), mixed.alias("options"), F.char(place + 64).alias("answer")))


# Labels

# Phrases by which a label is a relation.
RELATION_PHRASES = ("next to", "on top of", "below", "above", "beside", "near", "under", "over", "around", "in front of", "behind")


def is_relation(label: Column) -> Column:
    return label.rlike("|".join(RELATION_PHRASES))


def format_labels(labels: Column) -> Column:
    """``first (second, third)``; the first alone if it is the only one."""
    rest = F.array_join(F.transform(F.slice(labels, 2, F.greatest(F.size(labels) - 1, F.lit(0))), lambda t: F.trim(t)), ", ")
    return F.when(F.size(labels) <= 1, F.get(labels, F.lit(0))).otherwise(F.concat(F.get(labels, F.lit(0)), F.lit(" ("), rest, F.lit(")")))


def label_types(label: Column) -> Column:
    """Types of an object: what stands before a bracket, by commas."""
    return F.transform(F.split(F.split(label, r"\(")[0], ","), lambda t: F.trim(t))


def in_parentheses(label: Column) -> Column:
    return F.nullif(F.regexp_extract(label, r"\((.*?)\)", 1), F.lit(""))


def without_parentheses(label: Column) -> Column:
    return F.trim(F.regexp_replace(label, r"\(.*?\)", ""))


def flip_numbers(text: Column) -> Column:
    """Corners in brackets with y pointing up: the second and fourth of the last four numbers become one less them.

    Brackets that don't end with four numbers stay as they are.
    """
    number = r"(-?\d+(?:\.\d+)?)"
    return F.aggregate(
        F.array_distinct(F.regexp_extract_all(text, F.lit(r"(\[[^\[\]]*\])"), F.lit(1))), text,
        lambda t, b: F.when(F.size(F.regexp_extract_all(b, F.lit(number), F.lit(1))) >= 4, F.replace(t, b, _flipped(b, number))).otherwise(t))


def _flipped(bracket: Column, number: str) -> Column:
    all_numbers = F.regexp_extract_all(bracket, F.lit(number), F.lit(1))
    last = F.slice(all_numbers, -4, 4)
    up = lambda i: F.format_string("%.2f", 1 - last[i].cast("double"))
    head = F.regexp_extract(bracket, rf"^\[(.*?){number}[,\s]+{number}[,\s]+{number}[,\s]+{number}\s*\]$", 1)
    return F.concat(F.lit("["), head, F.array_join(F.array(last[0], up(1), last[2], up(3)), ", "), F.lit("]"))


# Counting questions


# Rules by which a counting question becomes a statement, in their order. Blanks that are left stay.
_COUNT_FIRST = ((r"[^\w\s]$", ""), (r"^How many\s+", ""), (r"\bare there\b", ""), (r"\bthat are in\b", "in"), (r"\bthat are\b", ""), (r"\bare\b(?!$)", "that are"), (r"\bare$", ""))
_COUNT_ONE = ((r"(?<!that)\bis\b ", ""), (r"\bare\b", "is"))
_COUNT_THEN = ((r"\bhave\b", "that have"), (r"\bdo you\b", "that you"))
_COUNT_OWNER = r"\bdoes (?:the|this) (.+?) that have\b"
_COUNT_LAST = ((r"\bcan you see\b", "that you can see"), (r"\bcan be seen\b", "that can be seen"))


def count_statement(question: Column, n: Column) -> Column:
    """A question ``How many ...`` with its answer as a statement. What one is said of stands in the singular."""
    def by(t: Column, rules: tuple[tuple[str, str], ...]) -> Column:
        for pattern, into in rules:
            t = F.regexp_replace(t, pattern, into)
        return t

    t = by(question, _COUNT_FIRST)
    one = F.regexp_replace(singular_phrase(by(by(t, _COUNT_ONE), _COUNT_THEN)), _COUNT_OWNER, "that the $1 has")
    more = F.regexp_replace(by(t, _COUNT_THEN), _COUNT_OWNER, "that the $1 have")
    said = F.concat(F.when(n == 0, "There are no ").when(n == 1, "There is 1 ").otherwise(F.concat(F.lit("There are "), n.cast("string"), F.lit(" "))), by(F.when(n == 1, one).otherwise(more), _COUNT_LAST))
    return F.trim(F.replace(said, F.lit("There are no of"), F.lit("There are none of")))


# Boxes as text


def to_step(value: Column, step: float = 0.05) -> Column:
    """The nearest multiple of the step; halves go to the even multiple."""
    return F.bround(value / F.lit(step), 0) * F.lit(step)


def box_line(b: Column) -> Column:
    """``[label, x1, y1, x2, y2]`` with two decimals and y pointing up, so that y1 is below y2; ``?`` for a missing number."""
    two = lambda c: F.when(c.isNotNull(), F.format_string("%.2f", F.floor(c * 100 + 0.5) / 100)).otherwise("?")
    return F.concat(F.lit("["), F.concat_ws(", ", F.coalesce(b["label"], F.lit("")), two(b["x1"]), two(1 - b["y2"]), two(b["x2"]), two(1 - b["y1"])), F.lit("]"))


def flat_box_text(by_dataset: Column, header: str = "Boxes with label, left, bottom, right and top, as shares of the picture's size:") -> Column:
    """One text of the boxes of ``array<struct<dataset, bboxes>>``; empty if there are none."""
    some = F.filter(by_dataset, lambda d: F.coalesce(F.size(d["bboxes"]), F.lit(0)) > 0)
    parts = F.transform(some, lambda d: F.concat(F.lit("\n\n=== "), d["dataset"], F.lit(" OCR ===\n"), F.array_join(F.transform(d["bboxes"], box_line), "\n")))
    return F.when(F.size(some) > 0, F.concat(F.lit(header), F.array_join(parts, ""), F.lit("\n=== End of OCR ==="))).otherwise("")
