"""The canonical annotation row, and what adapters share."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialise

BOXES = "array<struct<label string, x1 double, y1 double, x2 double, y2 double>>"
SCHEMA = f"image_path string, dataset string, image_id string, image_source string, bboxes {BOXES}, captions array<string>, qa array<string>, width int, height int, split string, metadata map<string,string>"
COLUMNS = ("image_path", "dataset", "image_id", "image_source", "bboxes", "captions", "qa", "width", "height", "split", "metadata")

Adapter = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Adapter] = {}


def source(name: str) -> Callable[[Adapter], Adapter]:
    """Registers an adapter: (session, root folder) to canonical rows of the data set ``name``."""

    def add(adapter: Adapter) -> Adapter:
        REGISTRY[name] = lambda spark, root: canonical(adapter(spark, root), name)
        return adapter

    return add


def canonical(df: DataFrame, dataset: str) -> DataFrame:
    """All columns of the canonical row in order; lists that the adapter doesn't make are empty, other fields null."""
    kinds = {"bboxes": BOXES, "captions": "array<string>", "qa": "array<string>", "width": "int", "height": "int", "metadata": "map<string,string>"}
    out = []
    for c in COLUMNS:
        kind = kinds.get(c, "string")
        if c == "dataset":
            value = F.lit(dataset)
        elif c in df.columns:
            value = F.col(c).cast(kind)
        else:
            value = F.lit(None).cast(kind)
        if kind in (BOXES, "array<string>"):
            value = F.coalesce(value, F.array().cast(kind))
        out.append(value.alias(c))
    return df.select(*out)


def load(spark: SparkSession, root: str, names: list[str]) -> DataFrame:
    """Rows of several data sets, one after the other."""
    unknown = [n for n in names if n not in REGISTRY]
    if unknown:
        raise KeyError(f"no such source: {', '.join(unknown)}; there are: {', '.join(sorted(REGISTRY))}")
    parts = [REGISTRY[n](spark, root) for n in names]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# Reading


def json_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A JSON file that is an array (its elements are the rows) or one object; only the named fields are parsed."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def json_map(spark: SparkSession, path: str, value: str) -> DataFrame:
    """``(pos, key, value)`` of a JSON file that is one object; ``pos`` grows in the order of the file.

    No task holds more of a file than an entry: its splits are cut between entries and the entries written; those that lie
    in several splits are joined. A first pass tells whether a split begins inside a string, and at which depth.
    """
    pieces = spark.read.option("lineSep", ",").text(path).select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    states, file, inside, depth = {}, None, 0, 0
    for at in sorted(pieces.mapInArrow(_summaries, "file string, start bigint, odd int, out bigint, `in` bigint").collect(), key=lambda x: (x["file"], x["start"])):
        if at["file"] != file:
            file, inside, depth = at["file"], 0, 0
        states[file, at["start"]] = (len(states), inside, depth)
        inside, depth = inside ^ at["odd"], depth + at["in" if inside else "out"]
    cut = materialise(pieces.mapInArrow(lambda batches: _entries(batches, states), "file string, pos bigint, whole boolean, ends boolean, text binary")).withColumn("text", F.col("text").cast("string"))
    ended = F.coalesce(F.sum(F.col("ends").cast("int")).over(Window.partitionBy("file").orderBy("pos").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = cut.where("not whole").withColumn("entry", ended).groupBy("file", "entry")
    joined = parts.agg(F.min("pos").alias("pos"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "text"))), lambda x: x["text"]), "").alias("text"))
    texts = cut.where("whole").select("pos", "text").unionByName(joined.select("pos", "text"))
    return texts.select("pos", F.explode(F.from_json(F.concat(F.lit("{"), "text", F.lit("}")), f"map<string, {value}>")).alias("key", "value"))


#: Bytes of JSON that count for its structure.
_QUOTE, _COMMA, _OPEN, _CLOSE = 1, 2, 3, 4
_KIND = np.zeros(256, dtype=np.int8)
_KIND[list(b'",{[}]')] = [_QUOTE, _COMMA, _OPEN, _OPEN, _CLOSE, _CLOSE]
_STEP = np.array([0, 0, 0, 1, -1])
_ESCAPE = re.compile(rb"\\.", re.DOTALL)


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], bytes]]:
    """``((file, start), text)`` of parts of splits, in order. Pieces end before a comma."""
    for batch in batches:
        file, start = batch.column("file").dictionary_encode().indices.to_numpy(), batch.column("start").to_numpy()
        bounds = np.flatnonzero(np.r_[True, (start[1:] != start[:-1]) | (file[1:] != file[:-1]), True]) if len(start) else []
        for a, b in zip(bounds[:-1], bounds[1:]):
            values = batch.column("value").slice(a, b - a).to_pylist()
            yield (batch.column("file")[int(a)].as_py(), int(start[a])), b",".join(values) + b","


def _structure(text: bytes, inside: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places and kinds of the structural bytes, and whether they are in a string, if the text begins in one or not."""
    kinds = _KIND[np.frombuffer(_ESCAPE.sub(b"__", text) if b"\\" in text else text, dtype=np.uint8)]
    at = np.flatnonzero(kinds)
    return at, kinds[at], (np.cumsum(kinds[at] == _QUOTE) + inside) % 2 == 1


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each split: whether its quotes are odd, and by how much the depth grows outside and inside of strings."""
    found: dict[tuple[str, int], list[int]] = {}
    for key, text in _runs(batches):
        own = found.setdefault(key, [0, 0, 0])
        _, kind, quoted = _structure(text, own[0])
        own[1] += int(_STEP[kind[~quoted]].sum())
        own[2] += int(_STEP[kind[quoted]].sum())
        own[0] = (own[0] + int((kind == _QUOTE).sum())) % 2
    rows = [(*key, *own) for key, own in found.items()]
    if rows:
        file, start, odd, out, within = zip(*rows)
        yield pa.RecordBatch.from_arrays([pa.array(file), pa.array(start), pa.array(odd, pa.int32()), pa.array(out), pa.array(within)], ["file", "start", "odd", "out", "in"])


def _entries(batches: Iterator[pa.RecordBatch], states: dict[tuple[str, int], tuple[int, int, int]]) -> Iterator[pa.RecordBatch]:
    """Entries of the object; the first and the last text of a split are parts of one."""
    now, held, n, number, inside, depth = None, [], 0, 0, 0, 0

    def rows(texts: list[bytes], ends: bool) -> pa.RecordBatch:
        nonlocal n
        whole = [n + i > 0 and ends for i in range(len(texts))]
        pos = [(number << 40) + n + i for i in range(len(texts))]
        n += len(texts)
        return pa.RecordBatch.from_arrays([pa.array([now[0]] * len(texts)), pa.array(pos), pa.array(whole), pa.array([ends] * len(texts)), pa.array(texts)], ["file", "pos", "whole", "ends", "text"])

    for key, text in _runs(batches):
        if key != now:
            if now:
                yield rows([b"".join(held)], False)
            now, held, n, (number, inside, depth) = key, [], 0, states[key]
        at, kind, quoted = _structure(text, inside)
        inside = (inside + int((kind == _QUOTE).sum())) % 2
        at, kind = at[~quoted], kind[~quoted]
        after = depth + np.cumsum(_STEP[kind])
        depth = int(after[-1]) if len(after) else depth
        cuts = at[((kind == _COMMA) | (kind == _OPEN)) & (after == 1) | (kind == _CLOSE) & (after == 0)].tolist()
        texts = [text[a:b] for a, b in zip([0, *[c + 1 for c in cuts]], [*cuts, len(text)])]
        held.append(texts[0])
        if cuts:
            yield rows([b"".join(held), *texts[1:-1]], True)
            held = [texts[-1]]
    if now:
        yield rows([b"".join(held)], False)


STORED = "struct<bboxes array<array<string>>, captions array<string>, qa array<string>, image_source string, image_id string, split string, metadata map<string,string>>"


def stored_catalogue(spark: SparkSession, path: str) -> DataFrame:
    """Canonical rows of a catalogue stored as one JSON object, from picture to data set to its fields; boxes are lists of label and corners."""
    each = json_map(spark, path, f"map<string, {STORED}>").select(F.col("key").alias("image_path"), F.explode("value").alias("dataset", "f"))
    n = lambda b, i: F.get(b, F.lit(i)).try_cast("double")
    boxes = F.transform("f.bboxes", lambda b: box(F.get(b, F.lit(0)), n(b, 1), n(b, 2), n(b, 3), n(b, 4)))
    none = F.array().cast("array<string>")
    rows = each.select("image_path", "dataset", "f.image_id", "f.image_source", F.coalesce(boxes, F.array().cast(BOXES)).alias("bboxes"), F.coalesce("f.captions", none).alias("captions"), F.coalesce("f.qa", none).alias("qa"), F.lit(None).cast("int").alias("width"), F.lit(None).cast("int").alias("height"), "f.split", "f.metadata")
    return rows.select(*COLUMNS)


def elements(df: DataFrame, column: str, *keep: str) -> DataFrame:
    """Fields of an array's structs with ``pos``, their place."""
    return df.select(*keep, F.posexplode(column).alias("pos", "_e")).select(*keep, "pos", "_e.*")


def numbered(df: DataFrame) -> DataFrame:
    """Rows with ``pos``, a number that grows in the order of the file."""
    return df.withColumn("pos", F.monotonically_increasing_id())


# Parts of rows


def box(label: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    d = lambda c: c.cast("double")
    return F.struct(label.cast("string").alias("label"), d(x1).alias("x1"), d(y1).alias("y1"), d(x2).alias("x2"), d(y2).alias("y2"))


def box_xywh(label: Column, x: Column, y: Column, w: Column, h: Column, width: Column, height: Column) -> Column:
    """A box from corner and size in pixels; coordinates are null where the picture's size is null or 0."""
    return box(label, F.try_divide(x, width), F.try_divide(y, height), F.try_divide(x + w, width), F.try_divide(y + h, height))


def in_order(value: Column, *by: Column | str) -> Column:
    """Aggregate: the values that aren't null, ordered."""
    order = [(F.col(b) if isinstance(b, str) else b).alias(f"o{i}") for i, b in enumerate(by)]
    pairs = F.sort_array(F.collect_list(F.when(value.isNotNull(), F.struct(*order, value.alias("v")))))
    return F.transform(pairs, lambda p: p.getField("v"))


def last_by(value: Column | str, by: Column | str) -> Column:
    """Aggregate: the value of the last row."""
    return F.max_by(value, by)


def pad(image_id: Column, n: int = 12) -> Column:
    """Zeros before an id up to n places; a longer one stays as it is."""
    text = image_id.cast("string")
    return F.when(F.length(text) >= n, text).otherwise(F.lpad(text, n, "0"))


def coco_path(image_id: Column) -> Column:
    return F.concat(F.lit("coco/train2017/"), pad(image_id), F.lit(".jpg"))


def majority(df: DataFrame, keys: list[str], answer: str, pos: str) -> DataFrame:
    """``(*keys, answer)``: the most frequent answer of each group; among equals the one that comes first."""
    counted = df.where(F.col(answer).isNotNull()).groupBy(*keys, answer).agg(F.count("*").alias("_n"), F.min(pos).alias("_first"))
    return counted.groupBy(*keys).agg(F.max_by(answer, F.struct("_n", -F.col("_first"))).alias(answer))


def majority_of(answers: Column) -> Column:
    """The most frequent element of an array, among equals the first; null if there is none."""
    rest = F.filter(answers, lambda a: a.isNotNull())
    ranked = F.transform(F.array_distinct(rest), lambda a: F.struct(F.size(F.filter(rest, lambda b: a == b)).alias("n"), (-F.array_position(rest, a)).alias("p"), a.alias("a")))
    return F.array_max(ranked).getField("a")
