"""Sizes of texts in tokens of a public tokenizer, counted in Arrow batches."""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Vocabulary of the byte-level tokenizer; any file of ranks in that format can be named instead.
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

# The published splitting pattern of the vocabulary's tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@lru_cache(maxsize=4)
def encoder(vocabulary: str = VOCABULARY):
    """The tokenizer, loaded once in a Python worker."""
    import tiktoken

    with open(vocabulary, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


#: Runs of white space from this length on are tokenized by themselves: the splitting pattern backtracks over a run, and the
#: library's stack doesn't hold a run of hundreds of thousands.
LONG_RUN = 1000


def count_tokens(encoding, text: str, long_run: int = LONG_RUN) -> int:
    """Number of tokens of a text; the same as of the whole text at once.

    The pattern takes of a run of white space before a word all but the last character as one piece, so a text may be cut
    there without a change.
    """
    if len(text) < long_run:
        return len(encoding.encode_ordinary(text))
    n, start = 0, 0
    for run in re.finditer(rf"\s{{{long_run},}}", text):
        end = run.end() - (run.end() < len(text))
        n += len(encoding.encode_ordinary(text[start : run.start()])) + len(encoding._encode_single_piece(text[run.start() : end]))
        start = end
    return n + len(encoding.encode_ordinary(text[start:]))


def n_tokens(text: Column, vocabulary: str = VOCABULARY) -> Column:
    """Number of tokens of the whole text; null and empty texts have 0."""

    @F.pandas_udf("bigint")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        encoding = encoder(vocabulary)
        for texts in batches:
            yield pd.Series([count_tokens(encoding, t) if t else 0 for t in texts], dtype="int64")

    return count(text)
