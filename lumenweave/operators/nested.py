"""Deeply nested records as flat tables linked by Dewey labels.

Every node of a record gets an ordinal path identifier: the record's key, then one ordinal per array step, for
example ``17.3.0``. The label of the parent is the label without its last ordinal, so no link is stored twice and none
needs a join to be made. Nodes are grouped by schema path: one table for each array that occurs in the schema. All of it
is projection and ``posexplode``, so a record of any depth is flattened without a shuffle.

Null arrays and empty arrays give no rows. A null element of an array of structs or scalars keeps its ordinal and gives
a row whose value is null, so that labels stay stable. A null record key gives labels that begin with ``?``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LABEL, PARENT, VALUE, NODE = "node_label", "parent_label", "node_value", "_node"


def parent_label(label: Column) -> Column:
    """Parent link by truncation of the last ordinal."""
    return F.regexp_replace(label, r"\.[^.]*$", "")


def _child_label(parent: Column) -> Column:
    return F.concat(parent, F.lit("."), F.col("_pos").cast("string"))


def shred(df: DataFrame, key: str, column: str, keep: list[str] | None = None, carry: dict[str, str] | None = None) -> dict[str, DataFrame]:
    """Flat tables of the array ``column``, by schema path.

    ``keep`` names columns of the record that every table repeats (for example a foreign key); ``carry`` maps schema
    paths to a scalar field of their elements that the tables below repeat, which saves the join by label. A table has
    ``node_label``, ``parent_label``, the kept columns, and either the scalar fields of the element or ``node_value``.
    Names of fields that clash with these get a trailing underscore. Only the named columns of ``df`` are read.
    """
    taken = [LABEL, PARENT, *(keep or [])]
    carry = carry or {}
    root = df.select(F.coalesce(F.col(key).cast("string"), F.lit("?")).alias("_root"), *[F.col(c) for c in keep or []], F.col(column).alias(NODE))
    tables: dict[str, DataFrame] = {}
    _shred_array(root, "_root", keep or [], df.schema[column].dataType, column, taken, carry, tables)
    return tables


def _shred_array(df: DataFrame, above: str, keep: list[str], kind: T.DataType, path: str, taken: list[str], carry: dict[str, str], tables: dict[str, DataFrame]) -> None:
    if not isinstance(kind, T.ArrayType):
        raise TypeError(f"{path} is no array")
    kept = [F.col(c) for c in keep]
    rows = df.select(F.col(above), *kept, F.posexplode(NODE).alias("_pos", "_item")).select(_child_label(F.col(above)).alias(LABEL), *kept, "_item")
    rows = rows.withColumn(PARENT, parent_label(F.col(LABEL)))
    element = kind.elementType
    if isinstance(element, T.StructType):
        scalars = [f for f in element.fields if not isinstance(f.dataType, T.ArrayType)]
        tables[path] = rows.select(LABEL, PARENT, *kept, *[F.col("_item").getField(f.name).alias(f.name + "_" * (f.name in taken)) for f in scalars])
        more = [carry[path]] if path in carry else []
        below = [F.col("_item").getField(c).alias(c) for c in more]
        for f in element.fields:
            if isinstance(f.dataType, T.ArrayType):
                _shred_array(rows.select(LABEL, *kept, *below, F.col("_item").getField(f.name).alias(NODE)), LABEL, keep + more, f.dataType, f"{path}.{f.name}", taken + more, carry, tables)
    elif isinstance(element, T.ArrayType):
        _shred_array(rows.select(LABEL, *kept, F.col("_item").alias(NODE)), LABEL, keep, element, f"{path}.element", taken, carry, tables)
    else:
        tables[path] = rows.select(LABEL, PARENT, *kept, F.col("_item").alias(VALUE))


RELATIONS = "array<struct<relationship_id string, predicate string, synsets array<string>, subject struct<object_id string, name string, names array<string>, x string, y string, w string, h string>, object struct<object_id string, name string, names array<string>, x string, y string, w string, h string>>>"


def parse_relations(text: Column) -> Column:
    """Relations from JSON that is an array, or an object with the array under ``relationships``; null if neither."""
    trimmed = F.trim(text)
    array = F.when(trimmed.startswith("["), trimmed).when(trimmed.startswith("{"), F.get_json_object(trimmed, "$.relationships"))
    return F.from_json(F.when(F.trim(array).startswith("["), array), RELATIONS)


def whole(text: Column) -> Column:
    """A whole number from a number or from digits in a string, else null."""
    return F.when(F.trim(text).rlike(r"^-?\d{1,18}$"), F.trim(text)).try_cast("bigint")


def scene_graph_tables(objects: DataFrame, attributes: DataFrame, relations: DataFrame) -> dict[str, DataFrame]:
    """Flat tables of the three nested tables: objects, names, synsets, attribute lists, attributes, relations and ends.

    Each row has ``image_id``, its own label and its parent's. ``ends`` has one row per end of a relation, with the
    relation's label as its parent.
    """
    tables = shred(objects, "rec_id", "objects", ["image_id"], {"objects": "object_id"})
    out = {"objects": tables["objects"], "names": tables["objects.names"], "synsets": tables["objects.synsets"]}
    tables = shred(attributes, "rec_id", "attributes", ["image_id"], {"attributes": "object_id"})
    out |= {"attribute_lists": tables["attributes"], "attributes": tables["attributes.attributes"]}
    parsed = relations.select("rec_id", "image_id", parse_relations(F.col("relationships")).alias("relationships"))
    flat = shred(parsed, "rec_id", "relationships", ["image_id"])["relationships"]
    out["relations"] = flat.select(LABEL, PARENT, "image_id", whole(F.col("relationship_id")).alias("relationship_id"), "predicate")
    side = lambda i, name: F.struct(F.lit(i).alias("ordinal"), F.lit(name).alias("end"), F.col(name).alias("node"))
    ends = flat.select(F.col(LABEL).alias(PARENT), "image_id", whole(F.col("relationship_id")).alias("relationship_id"), F.explode(F.array(side(0, "subject"), side(1, "object"))).alias("e"))
    out["ends"] = ends.where(F.col("e.node").isNotNull()).select(
        F.concat(F.col(PARENT), F.lit("."), F.col("e.ordinal").cast("string")).alias(LABEL), PARENT, "image_id", "relationship_id", F.col("e.end").alias("end"),
        whole(F.col("e.node.object_id")).alias("object_id"), F.coalesce("e.node.name", F.get("e.node.names", F.lit(0))).alias("name"),
    )
    return out


def found(objects: DataFrame, attributes: DataFrame, relations: DataFrame) -> DataFrame:
    """Distinct ``(image_id, object_id, child, item)`` whose object is among the objects of the same image.

    Every child already carries its object's id, so the only shuffles are the semi-join on ``(image_id, object_id)`` and
    the final distinct. Null items, null ids and children without a parent give no row.
    """
    t = scene_graph_tables(objects, attributes, relations)
    pick = lambda df, child, item: df.select("image_id", "object_id", F.lit(child).alias("child"), item.alias("item"))
    children = pick(t["names"], "name", F.col(VALUE)).unionByName(pick(t["attributes"], "attribute", F.col(VALUE)))
    children = children.unionByName(t["ends"].select("image_id", "object_id", F.col("end").alias("child"), F.col("relationship_id").cast("string").alias("item")))
    parents = t["objects"].where("image_id is not null and object_id is not null").select("image_id", "object_id").distinct()
    return children.where("item is not null").distinct().join(parents, ["image_id", "object_id"], "left_semi")
