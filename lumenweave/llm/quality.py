"""Per-document text statistics, and the kind of a document by a Gaussian mixture over them.

The statistics of a text are counted in Arrow batches, whole texts always. A Gaussian mixture with diagonal covariances is
fitted by expectation-maximization on the standardized statistics of all documents: each step is one distributed pass that
sums responsibilities and moments per component, so the driver sees a few numbers per component and never documents.

The mixture starts from ``EXAMPLES``, short inspected texts of prose, lists, tables and junk in their usual forms: every
group of examples is one component, which is drawn back to its start with the weight of ``PRIOR_SHARE`` times an even share
of the corpus, so a form that is rare or missing in the corpus keeps its component and its meaning, and a corpus has the same
mixture as any number of copies of it. A document has the kind whose components have the largest share of its
responsibilities.

Texts that are null, empty or without a visible character have no statistics but their zeros, and are junk. Rows without a
key are no records; a repeated key counts once.
"""

from __future__ import annotations

import math
import re
import warnings
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .quality_examples import COMMON_WORDS, EXAMPLES

WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")
SYMBOL = re.compile(r"[^\w\s]")
DIGIT = re.compile(r"\d")
BULLET = re.compile(r"^[ \t]*(?:[-*•·+–—▪◦>]|#?\(?\d{1,3}[.):]|#\d{1,3}|\(?[a-zA-Z][.)]|\[[ xX]?\])[ \t]+", re.M)
ENDED = re.compile(r"[.!?…\"”»’')][ \t]*$", re.M)
MARKUP = re.compile(r"</?[a-zA-Z][^<>\n]*>|&[a-z]+;|[{}]|;[ \t]*$|\b(?:var|let|const|function|return|def|import)\b|==|=\"|\(\)", re.M)
MOJIBAKE = re.compile("[ÃÂâÐÑ][\u0080-¿Œ-Ÿ–-›€™]|�|[\u0080-\u009f]")
VOWEL = re.compile(r"[aeiouyàâäáãåæéèêëíìîïóòôöõøœúùûüýÿаеёиоуыэюя]|[^\x00-ɏЀ-ӿ]")
SEPARATED = re.compile(r"[,;:|\t\n]|[.!?](?=\s)|\s[-*•/]\s")
WIDE = re.compile(r"(?<=\S)[ \t]{2,}(?=\S)|\t")

#: The statistics that the mixture sees, in order; each is a number in a bounded range.
STATISTICS = ("word_count_log", "mean_word_length", "symbol_ratio", "digit_ratio", "ended_line_share", "common_word_share", "bullet_line_share", "same_field_share", "words_per_segment_log", "new_pair_share", "strange_word_share", "markup_ratio", "mojibake_ratio")
COLUMNS = ("n_chars", "n_words", "n_lines", *STATISTICS)

#: Weight of a component's start: this part of the documents that an even split of the corpus would give it.
PRIOR_SHARE = 0.5
#: The fit ends when a step raises the mean log likelihood of a document by less than this; steps after which it warns instead.
TOLERANCE, STEPS = 1e-3, 100
LEAST_DEVIATION = 0.15


_MARKS = ("<", "{", "}", ";", "&", "==", '="', "()")
_KEYWORDS = frozenset(("var", "let", "const", "function", "return", "def", "import"))


class _Strange(dict):
    """Whether a word has no vowel or more than 15 letters, found out once."""

    def __missing__(self, word: str) -> bool:
        self[word] = out = len(word) > 15 or (len(word) > 1 and not VOWEL.search(word))
        return out


_STRANGE = _Strange()


def same_field_share(lines: list[str]) -> float:
    """Largest share of lines with the same number of one separator, from two fields of a strong or three of a weak one on."""
    if len(lines) < 3:
        return 0.0
    best = 0
    for separator, least in (("|", 1), ("\t", 1), (";", 2), (",", 2), (":", 2), (None, 2)):
        if separator is None:
            counts = [len(WIDE.findall(x)) for x in lines] if any("  " in x for x in lines) else []
        else:
            counts = [x.count(separator) for x in lines]
        tally: dict[int, int] = {}
        for n in counts:
            if n >= least:
                tally[n] = tally.get(n, 0) + 1
        best = max(best, *tally.values(), 0) if tally else best
    return best / len(lines)


def statistics(text: str | None) -> tuple[float, ...]:
    """Values of ``COLUMNS`` for one text."""
    text = text or ""
    visible = len(text) - text.count(" ") - text.count("\n") - text.count("\t")
    lines = [x for x in text.split("\n") if x and not x.isspace()]
    if not lines or visible <= 0:
        return (len(text), 0, 0, *[0.0] * len(STATISTICS))
    words = WORD.findall(text.lower())
    n = len(words)
    pieces = len(text.split())
    common = sum(map(COMMON_WORDS.__contains__, words))
    distinct = set(words)
    if len(_STRANGE) > 1_000_000:
        _STRANGE.clear()
    strange = sum(_STRANGE[w] for w in distinct)
    # the patterns are run only where what they need is there
    marked = any(c in text for c in _MARKS) or not _KEYWORDS.isdisjoint(distinct)
    segments = 1 + len(SEPARATED.findall(text.strip()))
    return (
        len(text),
        n,
        len(lines),
        math.log1p(min(n, 5000)),
        min(visible / max(pieces, 1), 20.0),
        len(SYMBOL.findall(text)) / visible,
        len(DIGIT.findall(text)) / visible,
        len(ENDED.findall(text)) / len(lines) if len(lines) < 3 or max(map(len, lines)) > 100 else min(1.0, len(ENDED.findall(text)) / len(lines) * 2),
        common / max(n, 1),
        len(BULLET.findall(text)) / len(lines),
        same_field_share(lines),
        math.log1p(min(n / segments, 40)),
        len(set(zip(words, words[1:]))) / (n - 1) if n > 20 else 1.0,
        min(1.0, (strange / max(len(distinct), 1)) * 2) if n else 1.0,
        min(1.0, 20 * len(MARKUP.findall(text)) / visible) if marked else 0.0,
        0.0 if text.isascii() else min(1.0, 20 * len(MOJIBAKE.findall(text)) / visible),
    )


def document_statistics(documents: DataFrame) -> DataFrame:
    """``(doc_id, *COLUMNS)`` of ``documents(doc_id, text)``."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = pd.DataFrame([statistics(t) for t in batch["text"]], columns=COLUMNS)
            rows.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield rows

    schema = "doc_id bigint, n_chars bigint, n_words bigint, n_lines bigint, " + ", ".join(f"{c} double" for c in STATISTICS)
    return documents.where("doc_id is not null").select("doc_id", "text").mapInPandas(count, schema)


class Mixture:
    """Means, deviations and weights of the components, in standardized statistics; ``kinds`` names each component's kind."""

    def __init__(self, center: np.ndarray, scale: np.ndarray) -> None:
        self.center, self.scale = center, scale
        groups = [self.standard(np.array([statistics(t)[3:] for t in texts])) for _, _, texts in EXAMPLES]
        self.kinds = [kind for kind, _, _ in EXAMPLES]
        self.start = np.array([g.mean(axis=0) for g in groups])
        spread = np.array([g.std(axis=0) for g in groups])
        self.mean, self.deviation = self.start.copy(), np.maximum(spread, 0.5)
        self.start_deviation = self.deviation.copy()
        self.weight = np.full(len(groups), 1 / len(groups))

    def standard(self, x: np.ndarray) -> np.ndarray:
        return (x - self.center) / self.scale

    def responsibilities(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Share of each component in each row of standardized statistics, and the rows' log likelihood."""
        log = np.log(self.weight) - np.log(self.deviation).sum(axis=1) - 0.5 * (((x[:, None, :] - self.mean) / self.deviation) ** 2).sum(axis=2)
        top = log.max(axis=1, keepdims=True)
        p = np.exp(log - top)
        total = p.sum(axis=1, keepdims=True)
        return p / total, (top + np.log(total)).ravel()

    def maximize(self, n: np.ndarray, s: np.ndarray, s2: np.ndarray) -> None:
        """New parameters from the sums of responsibilities, of values and of squares, and the start with its weight."""
        prior = PRIOR_SHARE * n.sum() / len(n)
        m = n + prior
        self.mean = (s + prior * self.start) / m[:, None]
        square = (s2 + prior * (self.start_deviation**2 + self.start**2)) / m[:, None]
        self.deviation = np.maximum(np.sqrt(np.maximum(square - self.mean**2, 0)), LEAST_DEVIATION)
        self.weight = m / m.sum()

    def kind_shares(self, x: np.ndarray) -> dict[str, np.ndarray]:
        p = self.responsibilities(self.standard(x))[0]
        return {k: p[:, [i for i, own in enumerate(self.kinds) if own == k]].sum(axis=1) for k in dict.fromkeys(self.kinds)}


def fit(stats: DataFrame, steps: int = STEPS, tolerance: float = TOLERANCE) -> Mixture:
    """The mixture of all documents with text in ``stats``; as it starts if there are none.

    Warns if ``steps`` steps don't reach the tolerance.
    """
    stats = stats.where("n_lines > 0")
    moments = stats.agg(*[f(c).alias(f"{f.__name__}_{c}") for c in STATISTICS for f in (F.avg, F.stddev_pop)]).first()
    known = np.array([statistics(t)[3:] for _, _, texts in EXAMPLES for t in texts])
    if moments[0] is None:
        return Mixture(known.mean(axis=0), np.maximum(known.std(axis=0), 1e-3))
    own = np.array(moments, dtype=float).reshape(-1, 2)
    # a statistic that hardly varies in the corpus is measured on the scale of the examples
    mixture = Mixture(own[:, 0], np.maximum(own[:, 1], 0.25 * known.std(axis=0) + 1e-6))
    k, d, before = len(mixture.kinds), len(STATISTICS), -math.inf
    fields = [f"s{i}" for i in range(2 * d + 2)]

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((k, 2 * d + 2))
        for batch in batches:
            x = mixture.standard(batch[list(STATISTICS)].to_numpy())
            p, log = mixture.responsibilities(x)
            total += np.hstack([p.sum(axis=0)[:, None], p.T @ x, p.T @ x**2, np.full((k, 1), log.sum())])
        yield pd.DataFrame(total, columns=fields).assign(k=range(k))

    for _ in range(steps):
        parts = stats.select(*STATISTICS).mapInPandas(sums, ", ".join(f"{f} double" for f in fields) + ", k int")
        rows = {r["k"]: r for r in parts.groupBy("k").agg(*[F.sum(f).alias(f) for f in fields]).collect()}
        total = np.array([[rows[i][f] for f in fields] for i in range(k)])
        mixture.maximize(total[:, 0], total[:, 1 : d + 1], total[:, d + 1 : 2 * d + 1])
        mean_log = total[0, -1] / total[:, 0].sum()
        if mean_log - before < tolerance:
            break
        before = mean_log
    else:
        warnings.warn(f"the mixture has not settled after {steps} steps", stacklevel=2)
    return mixture


def kinds(documents: DataFrame, steps: int = STEPS) -> DataFrame:
    """``(doc_id, *COLUMNS, kind, confidence)``: statistics of every document, its kind and that kind's share."""
    stats = materialise(document_statistics(documents))
    mixture = fit(stats, steps)
    names = list(dict.fromkeys(mixture.kinds))

    def name(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            shares = mixture.kind_shares(batch[list(STATISTICS)].to_numpy())
            p = np.stack([shares[n] for n in names], axis=1)
            best = p.argmax(axis=1) if len(p) else np.empty(0, dtype=int)
            kind = np.where(batch["n_lines"].to_numpy() > 0, np.array(names)[best], "junk")
            yield batch.assign(kind=kind, confidence=p.max(axis=1) if len(p) else [])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in stats.schema.fields) + ", kind string, confidence double"
    return stats.dropDuplicates(["doc_id"]).mapInPandas(name, schema)
