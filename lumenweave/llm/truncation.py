"""Texts that were cut off, by the vocabulary of the corpus and length evidence.

A value is a case if it stops mid-word or mid-sentence. Values that end with a sentence's end are none; a value that ends
with a mark of a cut (dots, an ellipsis, a broken character) after some words is one. For all others the evidence comes
from the corpus itself, counted over all its values:

1. *Trie.* The last token is no complete word of the corpus but a proper prefix of one. The trie of the vocabulary is held
   as the table of its nodes (every proper prefix of every word); walking it is a join on the prefix.
2. *Endings.* How often the last two words, and the last word alone, stand at the end of a sentence or line against inside
   one. A value that ends where hardly any sentence ends is cut. Of a last segment of one word after other text the break is
   the word before; a value of one word only (``A``, ``Yes``) is judged by the trie alone. A letter that is a segment by itself
   names an option and is counted apart, in upper case, from the word that is spelled like it.
3. *Sentence type.* The words of the last sentence tell whether sentences like it end with a mark of punctuation (naive
   Bayes over the last sentences of all values). One that should and does not is cut, short phrases and list lines are not.
4. *Open ends*: a quote or bracket that isn't closed, or a comma, at the end of a value without an end.
5. *Length.* Lengths at which many more values without an end pile up than at the lengths around them are field limits. At a
   limit the bars of 2 and 3 are lower.

One Arrow pass over the texts gives the counts and the open ends; all joins after it are between counts of distinct words
and pairs of words and the values without an end. No vocabulary is sent to the driver or broadcast unless its counted size is
small; beyond that frequent words are broadcast and the others shuffled. Null, empty and wordless values are no cases.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, look_up, materialise

IMAGE = re.compile(r"<image>")
# Last characters of a value that is complete (ends of sentences, what closes after them), and those that
# are neither that nor, as other symbols are, an end in themselves.
ENDS = frozenset(".!?。！？\"”»“’')]")
NO_ENDS = frozenset(",;:…-–—/([{„«&#<>=+*‘\ufffd")


def mark_start(text: str) -> int | None:
    """Where the mark of a cut begins at the end of a text: three dots or more, an ellipsis, a broken character."""
    bare = text.rstrip(".")
    if len(text) - len(bare) >= 3:
        return len(bare)
    return len(text) - 1 if text[-1:] in ("…", "\ufffd") else None


def is_complete(last: str) -> bool:
    """Whether a value may end with this character: an end, or a symbol such as an emoji."""
    return last in ENDS or not (last.isalnum() or last == "_" or last.isspace() or last in NO_ENDS)


OPTION = re.compile(r"^\s*\(?[A-Z][.)]\s+(?=\S)")
#: The letter of an option on a line of its own that is announced: ``Answer:``, then ``A``.
ANNOUNCED = re.compile(r":\s*[A-Z]$")

#: Shares of ends are judged by their bounds of confidence, so many deviations from what was counted (Wilson's interval).
DEVIATIONS = 1.0
#: A token is no word if words that begin with it are this many times as frequent, and if their share of all has this lower bound.
PIECE_FACTOR, PIECE_SHARE = 200, 0.8
#: Share of ends below which no value ends: of a pair with the word's share mixed in, and the upper bounds of a word and a pair.
END_SHARE, WORD_END_SHARE, PAIR_END_SHARE = 0.01, 0.02, 0.05
#: Sentence types: a word whose share of ends has at least this lower bound stands for sentences that end; log odds; and the
#: share of ends below which the last words must be, of a pair with the word's share mixed in and the upper bound of a word.
TYPE_SHARE, TYPE_ODDS, TYPE_END_SHARE, TYPE_WORD_END_SHARE = 0.975, 2.0, 0.03, 0.05
#: A length is a limit if the lower bound of the open values that have it is this many times what the lengths within ``AROUND``
#: have on average, and one value more; at a limit a value is cut if its last words end less often than the share.
LIMIT_FACTOR, AROUND, LIMIT_END_SHARE = 4.0, 8, 0.08

#: A partition's counts are handed on when those of its batches have this many entries.
FLUSH = 5_000_000

EVIDENCE = "export_id bigint, turn_no int, image_source string, found array<string>, n_chars int, marked boolean, open_pair boolean, last_word string, word_before string, words array<string>, a string, b string, n bigint, ends bigint"
FIELDS = tuple(f.split()[0] for f in EVIDENCE.split(", "))

TOKEN = re.compile(r"[^\W_]+(?:['’-][^\W_]+)*|\n|[.!?。！？](?=\s)")
BREAK, _PLAIN_END = frozenset("\n.!?。！？"), frozenset(".!?")
PIECE = len(BREAK)


def _open_pair(text: str) -> bool:
    """Whether something in the text is open that only more text can close: a quote, a bracket, a comma."""
    return text.endswith(",") or text.count('"') % 2 == 1 or text.count("(") > text.count(")") or text.count("„") > text.count("“") + text.count("”") or text.count("«") > text.count("»") or text.count("“") > text.count("”") and "„" not in text


class Vocabulary(dict):
    """Numbers of tokens in the order in which they come; breaks have the first ones, then ``PIECE``, a word that isn't counted.

    ``letters`` has for the number of a letter that of the option it names.
    """

    def __init__(self) -> None:
        super().__init__()
        self.letters: dict[int, int] = {}
        for token in (*sorted(BREAK), ""):
            self[token]  # noqa: B018

    def __missing__(self, token: str) -> int:
        self[token] = n = len(self)
        if len(token) == 1 and token.islower():
            self.letters[n] = self[token.upper()]
        return n


class Collector:
    """Counts of words and their ends over many values, and the values without an end."""

    def __init__(self) -> None:
        self.reset()

    def reset(self) -> None:
        self.vocabulary = Vocabulary()
        self.keys: list[np.ndarray] = []  # (token before, token, whether a break follows) in one number
        self.sums: list[np.ndarray] = []
        self.types, self.closed = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.clear()

    def clear(self) -> None:
        self.tokens: list[int] = []
        self.last: list[int] = []
        self.last_closed: list[int] = []
        self.tails: list[tuple] = []

    def add(self, key: int, turn: int, source: str | None, value: str) -> list[str]:
        """Takes in a value; returns its tokens, words and breaks in lower case."""
        text = (IMAGE.sub(" ", value) if "<image>" in value else value).strip()
        tokens = TOKEN.findall(text.lower())
        at = len(tokens)
        while at and tokens[at - 1] in BREAK:
            at -= 1
        if not at:
            return []
        del tokens[at:]
        while at and tokens[at - 1] not in BREAK:
            at -= 1
        words = tokens[at:]
        if text[-1] in _PLAIN_END and not text.endswith(".."):
            mark, done = None, True
        else:
            mark = mark_start(text)
            done = mark is None and is_complete(text[-1])
        number = self.vocabulary.__getitem__
        kinds = set(map(number, words))
        kinds.add(0)  # the number of a break stands for the value itself
        self.last += kinds
        if done:
            self.last_closed += kinds
        else:
            bare = text if mark is None else text[:mark]
            start = text.rfind("\n") + 1
            option, last = OPTION.match(text[start:]), words[-1]
            own = words[1:] if option and ")" in option[0] and len(words) > 1 else words  # the break after "A." has parted it already
            if len(own) == 1 and not BREAK.issuperset(tokens[:-1]) and not ANNOUNCED.search(bare):
                own = ["", last]  # the break before it
            elif len(last) == 1 and (len(own) == 1 or next(filter(str.isalnum, reversed(bare))).isupper()):
                last = last.upper()
            self.tails.append((key, turn, source, None, len(value), mark is not None, _open_pair(bare), last, words[-2] if len(words) > 1 else "", own))
        self.tokens += map(number, tokens)
        if not done:
            self.tokens[-1] = PIECE  # the last word may be a piece of one
        self.tokens.append(0)
        return tokens

    def batch_rows(self) -> list[tuple]:
        """Values without an end so far; what was counted goes to the partition's counts."""
        tokens = np.array([0, *self.tokens, 0], dtype=np.int64)
        before, word, breaks = tokens[:-2], tokens[1:-1].copy(), len(BREAK)
        alone = np.flatnonzero((before < breaks) & (tokens[2:] < breaks))
        named = np.arange(len(self.vocabulary))
        named[list(self.vocabulary.letters)] = list(self.vocabulary.letters.values())
        word[alone] = named[word[alone]]
        key = np.where(before < breaks, 0, before) << 33 | word << 1 | (tokens[2:] < breaks)
        keys, sums = np.unique(key[word > PIECE], return_counts=True)
        self.keys.append(keys)
        self.sums.append(sums)
        n = len(self.vocabulary)
        self.types = np.bincount(self.last, minlength=n) + np.pad(self.types, (0, n - len(self.types)))
        self.closed = np.bincount(self.last_closed, minlength=n) + np.pad(self.closed, (0, n - len(self.closed)))
        tails = self.tails
        self.clear()
        return tails

    def full(self) -> bool:
        return sum(map(len, self.keys)) > FLUSH

    def counts(self) -> Iterator[pa.RecordBatch]:
        """The partition's counts: word pairs (``a`` empty where a segment begins), and words of last segments."""
        if self.keys and len(self.types):
            key, sums = np.concatenate(self.keys), np.concatenate(self.sums)
            pairs, place = np.unique(key >> 1, return_inverse=True)
            n, ends = np.bincount(place, sums, len(pairs)).astype(np.int64), np.bincount(place, sums * (key & 1), len(pairs)).astype(np.int64)
            seen = np.flatnonzero(self.types)
            names = pa.array(["", *list(self.vocabulary)[1:]], pa.string())
            first = pa.concat_arrays([names.take(pa.array(pairs >> 32)), names.take(pa.array(seen))])
            second = pa.concat_arrays([names.take(pa.array(pairs & ((1 << 32) - 1))), pa.nulls(len(seen), pa.string())])
            total, at_end = np.concatenate([n, self.types[seen]]), np.concatenate([ends, self.closed[seen]])
            if len(first):
                empty = [pa.nulls(len(first), kind) for kind in _ARROW[:-4]]
                yield pa.RecordBatch.from_arrays([*empty, first, second, pa.array(total, pa.int64()), pa.array(at_end, pa.int64())], names=list(FIELDS))
        self.reset()


_ARROW = (pa.int64(), pa.int32(), pa.string(), pa.list_(pa.string()), pa.int32(), pa.bool_(), pa.bool_(), pa.string(), pa.string(), pa.list_(pa.string()), pa.string(), pa.string(), pa.int64(), pa.int64())


def arrow_rows(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of ``EVIDENCE`` without counts."""
    columns = list(zip(*rows))
    return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(columns, _ARROW)] + [pa.nulls(len(rows), kind) for kind in _ARROW[len(columns) :]], names=list(FIELDS))


def evidence(turns: DataFrame) -> DataFrame:
    """Counts and open ends of ``turns(export_id, turn_no, image_source, value)`` in one table.

    Rows with ``n_chars`` are values without an end; rows with ``n`` are counts: of word pairs (``a`` then ``b``), or with
    ``b`` null of words of last segments (``a`` empty: of the segments). ``ends`` is the part of ``n`` at an end.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        collector = Collector()
        for batch in batches:
            for key, turn, source, value in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if value:
                    collector.add(key, turn, source, value)
            tails = collector.batch_rows()
            if tails:
                yield arrow_rows(tails)
            if collector.full():
                yield from collector.counts()
        yield from collector.counts()

    return turns.select("export_id", "turn_no", "image_source", "value").mapInArrow(count, EVIDENCE)


def limits(tails: DataFrame) -> DataFrame:
    """Lengths ``(n_chars)`` at which values without an end pile up."""
    counts = tails.where("not marked").groupBy("n_chars").agg(F.count("*").alias("n"))
    around = counts.select("n", F.explode(F.sequence(F.col("n_chars") - AROUND, F.col("n_chars") + AROUND)).alias("n_chars")).groupBy("n_chars").agg(F.sum("n").alias("all"))
    near = (F.col("all") - F.col("n")) / (2 * AROUND)
    sure = F.col("n") - DEVIATIONS * F.sqrt("n")
    return counts.join(around, "n_chars").where(sure > LIMIT_FACTOR * near + 1).select("n_chars")


def bound(part: Column, n: Column, side: int) -> Column:
    """Wilson's lower (``side`` -1) or upper (1) bound of the share ``part / n``; 0 or 1 where nothing was counted."""
    p, z2 = F.try_divide(part, n), DEVIATIONS**2
    at = (p + z2 / (2 * n) + side * DEVIATIONS * F.sqrt(p * (1 - p) / n + z2 / (4 * n * n))) / (1 + z2 / n)
    return F.when(n > 0, at).otherwise(float(side > 0))


def trie_nodes(words: DataFrame) -> DataFrame:
    """``(prefix, below)`` of ``words(word, n)``: the inner nodes of their trie with the count of the words below each."""
    prefixes = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda i: F.substring(F.col("word"), F.lit(1), i))
    return words.where(F.length("word") > 1).select("n", F.explode(prefixes).alias("prefix")).groupBy("prefix").agg(F.sum("n").alias("below"))


def cut_values(rows: DataFrame) -> DataFrame:
    """Open ends ``(export_id, turn_no, image_source, reason, ...)``, each once, with the reason why it is cut, or null.

    ``rows`` is a written table of :func:`evidence`.
    """
    tails = materialise(rows.where("n_chars is not null").drop("a", "b", "n", "ends").dropDuplicates(["export_id", "turn_no"]))
    # rows of words of last segments have no b: both counts are summed at once
    counts = materialise(rows.where("n is not null").groupBy("a", "b").agg(F.sum("n").alias("n"), F.sum("ends").alias("ends")))
    pairs, types = counts.where("b is not null"), counts.where("b is null").drop("b")
    words = pairs.groupBy(F.col("b").alias("word")).agg(F.sum("n").alias("n"), F.sum("ends").alias("ends"))
    open_tails = tails.where("not marked and not open_pair")
    nodes = trie_nodes(words.where(~F.col("word").rlike("[0-9]")))
    zero = lambda c, name: F.coalesce(F.col(c), F.lit(0)).alias(name)
    asked = open_tails.groupBy("word_before", "last_word").agg(F.count("*").alias("n_asked"))
    last = asked.select("last_word").distinct().join(words.withColumnRenamed("word", "last_word"), "last_word", "left").join(nodes.withColumnRenamed("prefix", "last_word"), "last_word", "left")
    last = last.select("last_word", zero("n", "word_n"), zero("ends", "word_ends"), zero("below", "below"))
    known = asked.join(pairs.withColumnsRenamed({"a": "word_before", "b": "last_word", "n": "pair_n", "ends": "pair_ends"}), ["word_before", "last_word"], "left")
    known = known.select("word_before", "last_word", "n_asked", zero("pair_n", "pair_n"), zero("pair_ends", "pair_ends")).join(last, "last_word")
    # sentence type: log odds of the words before the last one, and the largest share of ends among them
    one = types.where("a = ''").select("n", "ends")
    closed, open_ = one.select("ends").scalar(), one.select(F.col("n") - F.col("ends")).scalar()
    odds = F.log(((F.col("ends") + 1) / (closed + 2)) / ((F.col("n") - F.col("ends") + 1) / (open_ + 2)))
    word_odds = types.where("a != ''").select(F.col("a").alias("w"), (F.col("n") - F.col("ends")).alias("n_open"), odds.alias("odds"), bound(F.col("ends"), F.col("n"), -1).alias("closed_share"))
    each = open_tails.select("export_id", "turn_no", F.explode(F.array_distinct(F.slice("words", 1, F.size("words") - 1))).alias("w"))
    type_of = look_up(each, materialise(word_odds), ["w"], "n_open").groupBy("export_id", "turn_no").agg(F.sum("odds").alias("type_odds"), F.max("closed_share").alias("closed_share"))
    at_limit = broadcast_if_small(limits(tails).withColumn("at_limit", F.lit(True)))
    scored = look_up(open_tails, materialise(known), ["word_before", "last_word"], "n_asked").join(at_limit, "n_chars", "left").join(type_of, ["export_id", "turn_no"], "left")
    scored = scored.na.fill({"type_odds": 0.0, "closed_share": 0.0, "at_limit": False})
    word_share = F.coalesce(F.try_divide(F.col("word_ends"), F.col("word_n")), F.lit(0.0))
    share = (F.col("pair_ends") + 5 * word_share) / (F.col("pair_n") + 5)
    sentence = (F.col("closed_share") >= TYPE_SHARE) & (F.col("type_odds") > TYPE_ODDS)
    word_most, pair_most = bound(F.col("word_ends"), F.col("word_n"), 1), bound(F.col("pair_ends"), F.col("pair_n"), 1)
    never = (share < END_SHARE) & ((word_most < WORD_END_SHARE) | (pair_most < PAIR_END_SHARE) & sentence)
    several = F.size("words") > 1
    reason = (
        F.when((F.col("below") > PIECE_FACTOR * F.col("word_n")) & (bound(F.col("below"), F.col("below") + F.col("word_n"), -1) >= PIECE_SHARE), "word")
        .when(several & never, "ending")
        .when(several & sentence & ((F.col("word_n") == 0) | (word_most < TYPE_WORD_END_SHARE) & (share < TYPE_END_SHARE)), "type")
        .when(several & F.col("at_limit") & (share < LIMIT_END_SHARE), "length")
    )
    judged = scored.withColumns({"reason": reason, "share": share})
    plain = tails.where("marked or open_pair").withColumn("reason", F.when(F.col("marked"), "mark").otherwise("open"))
    return judged.unionByName(plain, allowMissingColumns=True)


def turns_of(chats: DataFrame, *more: Column) -> DataFrame:
    """``(export_id, turn_no, image_source, value)`` of every turn that has a key."""
    return chats.where("export_id is not null").select("export_id", "image_source", F.posexplode("conversations").alias("turn_no", "turn")).select("export_id", "turn_no", "image_source", F.col("turn.value").alias("value"), *more)
