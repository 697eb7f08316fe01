"""Passages of held-out items inside corpus documents, by MinHash containment search over windows.

An item leaks if a document holds ``window`` consecutive words of it. Seen as sets of word shingles, this is full
containment of one of the item's windows in the document, however long the document is, so the search partitions both
sides by size in the strictest way: every text is a series of windows of exactly ``window`` words, all of one size, and
each window has the MinHash of its ``window - shingle + 1`` shingles. A document is indexed by the distinct MinHashes of
its windows (about two for every ``window - shingle + 2`` words), an item likewise. A shared window has the same MinHash
on both sides, so a containment of 1 at window level is found with recall 1; with one signature per whole document the
passage of 13 words would drown in thousands of other shingles.

Documents and items that share a MinHash are candidates; each is verified by exact containment of a shingle of
``window`` words. Words are runs of letters and digits in lower case. Items below ``window`` words can't leak; null and
empty texts give nothing. Rows without a key are no records.

The items are sent to the tasks only if they have at most ``BROADCAST_WORDS`` words; beyond, both sides meet in a join on
the MinHash, and the windows that share one are verified in a join on their words.
"""

from __future__ import annotations

import re
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import broadcast_if_small, materialise

WINDOW, SHINGLE = 13, 5
#: Items with more words than this in all are joined, not sent to the tasks.
BROADCAST_WORDS = 2_000_000

WORD = re.compile(r"[^\W_]+")
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[str]:
    return WORD.findall(text.lower()) if text else []


class Hasher:
    """64-bit hashes of words, kept for the words of a batch."""

    def __init__(self) -> None:
        self.known: dict[str, int] = {}

    def words(self, words: list[str]) -> np.ndarray:
        import xxhash

        known = self.known
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))

    def forget(self, limit: int = 1_000_000) -> None:
        if len(self.known) > limit:
            self.known.clear()


def _rolling(words: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n consecutive words; empty if there are fewer."""
    if len(words) < n:
        return np.empty(0, dtype=np.uint64)
    out = np.zeros(len(words) - n + 1, dtype=np.uint64)
    for i in range(n):
        out = (out ^ words[i : i + len(out)]) * _MULTIPLIER
        out ^= out >> np.uint64(29)
    return out


def window_minhashes(words: np.ndarray, window: int = WINDOW, shingle: int = SHINGLE) -> np.ndarray:
    """MinHash of the shingles of every window of a text."""
    hashes, n = _rolling(words, shingle), window - shingle + 1
    if len(hashes) < n:
        return np.empty(0, dtype=np.uint64)
    least, span = hashes, 1
    while span * 2 <= n:
        least, span = np.minimum(least[:-span], least[span:]), span * 2
    if span < n:
        least = np.minimum(least[: len(hashes) - n + 1], least[n - span :])
    return least


class Items:
    """Index of the held-out items: MinHash of a window to items, and their windows for the exact check."""

    def __init__(self, texts: list[tuple[int, str]], window: int, shingle: int) -> None:
        self.window, self.shingle = window, shingle
        hasher, by_hash = Hasher(), defaultdict(set)
        self.windows: dict[tuple[str, ...], set[int]] = defaultdict(set)
        for item, text in texts:
            words = words_of(text)
            for h in set(window_minhashes(hasher.words(words), window, shingle).tolist()):
                by_hash[h].add(item)
            for i in range(len(words) - window + 1):
                self.windows[tuple(words[i : i + window])].add(item)
        self.hashes = np.sort(np.fromiter(by_hash, dtype=np.uint64, count=len(by_hash)))
        self.by_hash = dict(by_hash)

    def leaked(self, words: list[str], hashes: np.ndarray, ends: np.ndarray) -> list[tuple[int, int]]:
        """``(text, item)`` for texts laid end to end, the n-th up to ``ends[n]``: items with a window in the text.

        A window is looked at only where its MinHash is one of the items'; those across two texts are passed over.
        """
        least = window_minhashes(hashes, self.window, self.shingle)
        if not len(least) or not len(self.hashes):
            return []
        at = np.searchsorted(self.hashes, least)
        at[at == len(self.hashes)] = 0
        hits = np.flatnonzero(self.hashes[at] == least)  # window i starts with word i
        of = np.searchsorted(ends, hits, side="right")
        inside = hits + self.window <= ends[of]
        out: set[tuple[int, int]] = set()
        for i, text in zip(hits[inside].tolist(), of[inside].tolist()):
            there = self.windows.get(tuple(words[i : i + self.window]))
            if there:
                out |= {(text, item) for item in there & self.by_hash[int(least[i])]}
        return sorted(out)


def _keyed(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull() & F.col("text").isNotNull()).select(key, "text")


def leaks(documents: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE, broadcast_words: int = BROADCAST_WORDS) -> DataFrame:
    """Distinct ``(doc_id, item_id)`` for which the document holds ``window`` consecutive words of the item."""
    documents, items = _keyed(documents, "doc_id"), _keyed(items, "item_id")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    if size <= 2 * broadcast_words:  # a word takes at least two characters with what parts it from the next
        return _by_broadcast(documents, items, window, shingle)
    return _by_join(documents, items, window, shingle)


_kept: dict[str, Items] = {}


def _index(name: str, texts: list[tuple[int, str]], window: int, shingle: int) -> Items:
    """The index of that name, made once in a worker; only the last one is kept."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = Items(texts, window, shingle)
    return _kept[name]


def _by_broadcast(documents: DataFrame, items: DataFrame, window: int, shingle: int) -> DataFrame:
    spark, name = documents.sparkSession, uuid.uuid4().hex
    sent = spark.sparkContext.broadcast([(r["item_id"], r["text"]) for r in items.collect()])

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        index, hasher = _index(name, sent.value, window, shingle), Hasher()
        for batch in batches:
            docs, words, ends = batch["doc_id"].tolist(), [], []
            for text in batch["text"]:
                words += words_of(text)
                ends.append(len(words))
            pairs = [(docs[n], item) for n, item in index.leaked(words, hasher.words(words), np.array(ends))] if words else []
            hasher.forget()
            yield pd.DataFrame(pairs, columns=["doc_id", "item_id"])

    return documents.mapInPandas(search, "doc_id bigint, item_id bigint").distinct()


def _minhashes(df: DataFrame, key: str, window: int, shingle: int) -> DataFrame:
    """Distinct ``(key, minhash)`` of the windows of each text."""

    def index(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for batch in batches:
            keys, found = [], []
            for k, text in zip(batch[key].tolist(), batch["text"]):
                least = np.unique(window_minhashes(hasher.words(words_of(text)), window, shingle))
                keys.append(np.full(len(least), k, dtype=np.int64))
                found.append(least.view(np.int64))
            hasher.forget()
            yield pd.DataFrame({key: np.concatenate(keys) if keys else [], "minhash": np.concatenate(found) if found else []})

    return df.mapInPandas(index, f"{key} bigint, minhash bigint")


def _windows(df: DataFrame, key: str, window: int, shingle: int, chosen: bool = False) -> DataFrame:
    """``(key, minhash, whole)`` of the windows of each text, ``whole`` its words; ``chosen``: only of the MinHashes in ``asked``."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hasher = Hasher()
        for batch in batches:
            rows = []
            for i, (k, text) in enumerate(zip(batch[key].tolist(), batch["text"])):
                words = words_of(text)
                least = window_minhashes(hasher.words(words), window, shingle).view(np.int64)
                at = np.flatnonzero(np.isin(least, batch["asked"].iloc[i])) if chosen else np.arange(len(least))
                rows += {(k, int(least[n]), " ".join(words[n : n + window])) for n in at.tolist()}
            hasher.forget()
            yield pd.DataFrame(rows, columns=[key, "minhash", "whole"])

    return df.mapInPandas(cut, f"{key} bigint, minhash bigint, whole string")


def _by_join(documents: DataFrame, items: DataFrame, window: int, shingle: int) -> DataFrame:
    """The same for items of any number: MinHashes of both sides meet, and the windows behind them are compared as they are.

    Of a document only the windows whose MinHash an item has are moved, never its text beside an item's. A window that very
    many documents have is one key of the last join, whose rows are a number and the window's words; Spark splits it.
    """
    of_items = materialise(_windows(items, "item_id", window, shingle).distinct())
    keys = materialise(of_items.select("minhash").distinct())
    hits = _minhashes(documents, "doc_id", window, shingle).join(broadcast_if_small(keys), "minhash", "left_semi")
    asked = materialise(hits.groupBy("doc_id").agg(F.collect_set("minhash").alias("asked")))  # at most the windows of one text
    found = _windows(documents.join(broadcast_if_small(asked), "doc_id"), "doc_id", window, shingle, True).select("doc_id", "whole").distinct()
    return found.join(broadcast_if_small(of_items.select("item_id", "whole").distinct()), "whole").select("doc_id", "item_id").distinct()
