"""Converters that ask the model: questions and answers as statements, object trees as captions."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .model import ClientFactory
from .process import PromptFailure, ask
from .prompts import converted_lines, statement_prompt, tree_prompt

SCHEMA = "lines array<string>, error struct<type string, message string>"


def _convert(rows: DataFrame, keys: tuple[str, ...], column: str, client: ClientFactory, write: Callable[[object], str], more_than: int, tries: int) -> DataFrame:
    def each(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = client()
        for batch in batches:
            lines, errors = [], []
            for value in batch[column]:
                try:
                    lines.append(ask(model, write(value), lambda text: converted_lines(text, more_than), tries))
                    errors.append(None)
                except PromptFailure as e:
                    lines.append(None)
                    errors.append({"type": e.kind, "message": str(e)})
            yield batch[list(keys)].assign(lines=pd.Series(lines, dtype=object, index=batch.index), error=pd.Series(errors, dtype=object, index=batch.index))

    kinds = ", ".join(f"{k} {rows.schema[k].dataType.simpleString()}" for k in keys)
    return rows.select(*keys, column).mapInPandas(each, f"{kinds}, {SCHEMA}")


def statements(rows: DataFrame, client: ClientFactory, keys: tuple[str, ...] = ("image_path",), tries: int = 3) -> DataFrame:
    """``(*keys, lines, error)`` of ``rows(*keys, qa)`` with at least one question: statements of more than ten characters."""
    some = rows.withColumn("qa", F.filter("qa", lambda t: t.isNotNull() & (F.trim(t) != ""))).where("size(qa) > 0")
    return _convert(some, keys, "qa", client, lambda qa: statement_prompt(list(qa)), 10, tries)


def tree_captions(trees: DataFrame, client: ClientFactory, keys: tuple[str, ...] = ("image_path",), more_than: int = 20, tries: int = 3) -> DataFrame:
    """``(*keys, lines, error)`` of ``trees(*keys, text)`` with more than that many characters: captions, a line each."""
    return _convert(trees.where(F.length("text") > more_than), keys, "text", client, tree_prompt, 0, tries)
