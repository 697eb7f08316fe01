"""Queries over the nested scene-graph tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import nested
from ..session import table


def _read(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return table(spark, d, "vg_objects"), table(spark, d, "vg_attributes"), table(spark, d, "vg_relationships")


def _flat(spark: SparkSession, d: str, name: str) -> DataFrame:
    """One flat table; a repeated record has the same labels and counts once."""
    return nested.scene_graph_tables(*_read(spark, d))[name].dropDuplicates([nested.LABEL])


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return nested.found(*_read(spark, d))


def p4_objects(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d, "objects")


def p4_names(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d, "names")


def p4_attributes(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d, "attributes")


def p4_relation_ends(spark: SparkSession, d: str) -> DataFrame:
    return _flat(spark, d, "ends")


def _orphans(spark: SparkSession, d: str, names: bool) -> DataFrame:
    t = nested.scene_graph_tables(*_read(spark, d))
    parents = t["objects"].where("image_id is not null and object_id is not null").select("image_id", "object_id", F.lit(True).alias("there")).distinct()
    parts = [t["attributes"].select(nested.LABEL, "image_id", "object_id", F.lit("attribute").alias("child")), t["ends"].select(nested.LABEL, "image_id", "object_id", F.col("end").alias("child"))]
    rows = parts[0].unionByName(parts[1])
    if names:
        rows = rows.unionByName(t["names"].select(nested.LABEL, "image_id", "object_id", F.lit("name").alias("child")))
    rows = rows.dropDuplicates(["child", nested.LABEL])
    return rows.join(parents, ["image_id", "object_id"], "left").groupBy("child").agg(F.count("*").alias("n"), F.count_if(F.col("there").isNull()).alias("n_orphans"))


def p4_orphans(spark: SparkSession, d: str) -> DataFrame:
    """Attributes and relation ends per kind, and those whose object is not among the objects of their image."""
    return _orphans(spark, d, False)


def p4_orphans_by_kind(spark: SparkSession, d: str) -> DataFrame:
    """The same of all four kinds of children: names too, whose object may have no id or no image."""
    return _orphans(spark, d, True)


QUERIES = {f.__name__: f for f in (p4_found, p4_objects, p4_names, p4_attributes, p4_relation_ends, p4_orphans, p4_orphans_by_kind)}

_OBJECTS = "objs AS (SELECT DISTINCT o.rec_id, o.image_id, g.i, o.objects[g.i] AS x FROM vg_objects o, range(1, 1000) g(i) WHERE g.i <= len(o.objects))"
_LISTS = "lists AS (SELECT DISTINCT a.rec_id, a.image_id, g.i, a.attributes[g.i] AS x FROM vg_attributes a, range(1, 1000) g(i) WHERE g.i <= len(a.attributes))"
_RELS = """rels AS (SELECT DISTINCT r.rec_id, r.image_id, g.i, json_extract(r.j, '$[' || (g.i - 1) || ']') AS x FROM
 (SELECT rec_id, image_id, CASE WHEN json_type(relationships::JSON) = 'ARRAY' THEN relationships::JSON ELSE json_extract(relationships::JSON, '$.relationships') END AS j FROM vg_relationships WHERE relationships IS NOT NULL) r,
 range(1, 1000) g(i) WHERE json_type(r.j) = 'ARRAY' AND g.i <= json_array_length(r.j)),
ends AS (SELECT rec_id, image_id, i, x, TRY_CAST(json_extract_string(x, '$.relationship_id') AS BIGINT) AS relationship_id, e.o, e.name AS child, json_extract(x, '$.' || e.name) AS n
 FROM rels, (VALUES (0, 'subject'), (1, 'object')) e(o, name)),
linked AS (SELECT *, CASE WHEN regexp_full_match(trim(json_extract_string(n, '$.object_id')), '-?[0-9]{1,18}') THEN trim(json_extract_string(n, '$.object_id'))::BIGINT END AS object_id FROM ends WHERE json_type(n) = 'OBJECT')"""

SQL = {
    "p4_found": f"""WITH {_OBJECTS}, {_LISTS}, {_RELS},
parents AS (SELECT DISTINCT image_id, x.object_id AS object_id FROM objs WHERE x.object_id IS NOT NULL AND image_id IS NOT NULL),
children AS (SELECT image_id, x.object_id AS object_id, 'name' AS child, unnest(x.names) AS item FROM objs
 UNION ALL SELECT image_id, x.object_id, 'attribute', unnest(x.attributes) FROM lists
 UNION ALL SELECT image_id, object_id, child, relationship_id::VARCHAR FROM linked)
SELECT DISTINCT c.image_id, c.object_id, c.child, c.item FROM children c JOIN parents p ON c.image_id = p.image_id AND c.object_id = p.object_id WHERE c.item IS NOT NULL""",
    "p4_objects": f"""WITH {_OBJECTS} SELECT rec_id || '.' || (i - 1) AS node_label, rec_id::VARCHAR AS parent_label, image_id, x.object_id AS object_id, x.x AS x, x.y AS y, x.w AS w, x.h AS h FROM objs""",
    "p4_names": f"""WITH {_OBJECTS} SELECT rec_id || '.' || (i - 1) || '.' || (g.j - 1) AS node_label, rec_id || '.' || (i - 1) AS parent_label, image_id, x.object_id AS object_id, x.names[g.j] AS node_value FROM objs, range(1, 1000) g(j) WHERE g.j <= len(x.names)""",
    "p4_attributes": f"""WITH {_LISTS} SELECT rec_id || '.' || (i - 1) || '.' || (g.j - 1) AS node_label, rec_id || '.' || (i - 1) AS parent_label, image_id, x.object_id AS object_id, x.attributes[g.j] AS node_value FROM lists, range(1, 1000) g(j) WHERE g.j <= len(x.attributes)""",
    "p4_relation_ends": f"""WITH {_RELS} SELECT rec_id || '.' || (i - 1) || '.' || o AS node_label, rec_id || '.' || (i - 1) AS parent_label, image_id, relationship_id, child AS "end", object_id, coalesce(json_extract_string(n, '$.name'), json_extract_string(n, '$.names[0]')) AS name FROM linked""",
    "p4_orphans": f"""WITH {_OBJECTS}, {_LISTS}, {_RELS},
parents AS (SELECT DISTINCT image_id, x.object_id AS object_id FROM objs WHERE x.object_id IS NOT NULL AND image_id IS NOT NULL),
children AS (SELECT image_id, x.object_id AS object_id, 'attribute' AS child FROM (SELECT *, unnest(x.attributes) FROM lists)
 UNION ALL SELECT image_id, object_id, child FROM linked)
SELECT child, count(*) AS n, count(*) FILTER (WHERE p.image_id IS NULL) AS n_orphans FROM children c LEFT JOIN parents p ON c.image_id = p.image_id AND c.object_id = p.object_id GROUP BY child""",
}
SQL["p4_orphans_by_kind"] = SQL["p4_orphans"].replace("FROM linked)", "FROM linked\n UNION ALL SELECT image_id, object_id, 'name' FROM (SELECT image_id, x.object_id AS object_id, unnest(x.names) FROM objs))")
