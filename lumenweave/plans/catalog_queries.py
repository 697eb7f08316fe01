"""Queries over the catalogue of annotations, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as G
from ..functions import text as X
from ..generation.convert import statements
from ..generation.model import EchoClient
from ..generation.process import assign_prompts
from ..generation.prompts import DISTRIBUTIONS
from ..operators import boxes, catalog, results
from ..session import shared_dir, table
from .nested_queries import _LISTS, _OBJECTS, _RELS

IMAGESET, DATASET, RUN, SEED = "coco/", "coco_captions", "run-marten-02", "7"


def six(c: Column | str) -> Column:
    """Six decimals by operations that round alike in every engine."""
    return F.floor((F.col(c) if isinstance(c, str) else c) * F.lit(1e6) + F.lit(0.5)) / F.lit(1e6)


def _annotations(spark: SparkSession, d: str) -> DataFrame:
    return catalog.records(table(spark, d, "annotations"), "ann_id")


def annotation_records(spark: SparkSession, d: str) -> DataFrame:
    """One row per record: the newest of the repeated ones."""
    rows = catalog.records(table(spark, d, "annotations").select("ann_id", "image_path", "dataset", "image_id", "loaded_at"), "ann_id", "loaded_at")
    return rows.select("ann_id", "image_path", "dataset", "image_id")


def source_counts(spark: SparkSession, d: str) -> DataFrame:
    return catalog.by_source(table(spark, d, "annotations"))


def drop_imageset(spark: SparkSession, d: str) -> DataFrame:
    return catalog.drop_imageset(table(spark, d, "annotations"), IMAGESET).select("ann_id", "image_path").distinct()


def drop_dataset(spark: SparkSession, d: str) -> DataFrame:
    return catalog.drop_dataset(table(spark, d, "annotations"), DATASET).select("ann_id", "dataset").distinct()


def drop_dataset_alone(spark: SparkSession, d: str) -> DataFrame:
    return catalog.drop_dataset(table(spark, d, "annotations"), DATASET, True).select("ann_id", "dataset").distinct()


def merged_catalogue(spark: SparkSession, d: str) -> DataFrame:
    """Data sets of each picture."""
    return catalog.nested(table(spark, d, "annotations")).select("image_path", F.array_join(F.array_sort(F.map_keys("sources")), ",").alias("datasets"), F.size("sources").alias("n"))


def _done(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "chat_exports").select(F.col("image").alias("image_path"), "run_id")


def pending_images(spark: SparkSession, d: str) -> DataFrame:
    """Pictures with annotations and without a chat."""
    return catalog.pending(table(spark, d, "annotations"), _done(spark, d))


def reserved_images(spark: SparkSession, d: str) -> DataFrame:
    """Pictures that two claims of a stored catalogue take for one run, of those without a result in it, with the claim's number."""
    folder = catalog.Catalog(spark, f"{shared_dir(spark)}/catalogue-{uuid.uuid4().hex}")
    folder.cache(table(spark, d, "annotations"))
    chats = table(spark, d, "chat_exports").where("image is not null and run_id is not null").select(F.col("image").alias("image_path"), "run_id")
    done = chats.select("image_path", F.lit(0).cast("bigint").alias("attempt"), F.lit(0).alias("step"), *[F.lit(None).cast(t).alias(c) for c, t in (("prompt_type", "string"), ("input", "array<string>"), ("output", "array<string>"), ("filtered_out", "array<string>"), ("error", "struct<type string, message string>"))], "run_id")
    results.append(done, folder.folder)
    claims = [folder.reserve(n, RUN, SEED).select("image_path").distinct().select(F.lit(k).alias("claim"), "image_path") for k, n in enumerate((60, 40))]
    return claims[0].unionByName(claims[1])


def sampled_images(spark: SparkSession, d: str) -> DataFrame:
    """Annotations of 50 pictures drawn without repetition."""
    return catalog.sample(table(spark, d, "annotations"), 50, SEED).select("ann_id", "image_path").distinct()


def images_listed(spark: SparkSession, d: str) -> DataFrame:
    """Chats whose picture is in the catalogue."""
    return catalog.having_image(table(spark, d, "chat_exports"), table(spark, d, "annotations"), "image").select("export_id", "image").distinct()


def information_lines(spark: SparkSession, d: str) -> DataFrame:
    """Information of each record: its captions with visible characters, one row each, before any grouping by picture."""
    return catalog.information_lines(_annotations(spark, d), keys=("ann_id",)).select("ann_id", "dataset", "pos", "line")


def record_information(spark: SparkSession, d: str) -> DataFrame:
    """All information of each record as one list: captions, statements by the offline model, the text of its boxes."""
    rows = _annotations(spark, d)
    box_text = box_flat_texts(spark, d).select("ann_id", F.array("text").alias("lines"))
    return catalog.information(rows, statements(rows.select("ann_id", "qa"), EchoClient, ("ann_id",)), box_text, ("ann_id",))


def enough_information(spark: SparkSession, d: str) -> DataFrame:
    rows = _annotations(spark, d)
    return rows.select("ann_id", X.total_length(F.col("captions")).alias("n"), X.enough_information(F.col("captions")).alias("enough"))


def weighted_prompts(spark: SparkSession, d: str) -> DataFrame:
    """A prompt for each record by the weights of a distribution."""
    return assign_prompts(table(spark, d, "annotations").select("ann_id").distinct(), DISTRIBUTIONS["LLaVA"], "ann_id")


def _unit_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Boxes of each record with corners in order, as shares of the picture."""
    rows = _annotations(spark, d).select("ann_id", "width", "height", F.posexplode("bboxes").alias("obj_id", "b"))
    rows = rows.select("ann_id", "obj_id", G.unit_box(F.col("b"), F.col("width"), F.col("height")).alias("u")).where("u is not null")
    return rows.select("ann_id", "obj_id", "u.*")


def unit_boxes(spark: SparkSession, d: str) -> DataFrame:
    return _unit_boxes(spark, d).select("ann_id", "obj_id", "label", *[six(c).alias(c) for c in ("x1", "y1", "x2", "y2")])


def box_overlaps(spark: SparkSession, d: str) -> DataFrame:
    """Pairs of boxes of one record with more than 0.1 overlap."""
    return boxes.overlap_pairs(_unit_boxes(spark, d), 0.1, ("ann_id",)).select("ann_id", "a", "b", six("iou").alias("iou"))


def _objects(spark: SparkSession, d: str) -> DataFrame:
    """Boxes with depths; there is no depth model here, so numbers that vary with the place in the record stand for it."""
    return _unit_boxes(spark, d).withColumn("depth_low", F.col("obj_id") * 5 % 9).withColumn("depth_high", F.col("depth_low") + 1)


def box_containment(spark: SparkSession, d: str) -> DataFrame:
    return boxes.containment_pairs(_objects(spark, d), keys=("ann_id",))


def merged_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Greedy merge of the boxes of each record."""
    return boxes.merge_boxes(_unit_boxes(spark, d), 0.5, ("ann_id",))


def box_tree_texts(spark: SparkSession, d: str) -> DataFrame:
    """Tree text of each record's boxes."""
    return boxes.box_trees(_objects(spark, d).withColumn("depths", F.sequence("depth_low", "depth_high")), ("ann_id",))


def box_flat_texts(spark: SparkSession, d: str) -> DataFrame:
    """Flat text of each record's boxes."""
    rows = _annotations(spark, d)
    return rows.select("ann_id", X.flat_box_text(F.array(F.struct("dataset", "bboxes"))).alias("text"))


def box_steps(spark: SparkSession, d: str) -> DataFrame:
    """Corners at multiples of 0.05, halves to even."""
    return _unit_boxes(spark, d).select("ann_id", "obj_id", *[F.round(X.to_step(F.col(c)), 4).alias(c) for c in ("x1", "y1")])


def type_counts(spark: SparkSession, d: str) -> DataFrame:
    """Objects of each type in each record's tree."""
    return boxes.type_counts(_unit_boxes(spark, d), ("ann_id",))


def group_averages(spark: SparkSession, d: str) -> DataFrame:
    """Region and averages, as text, of the boxes of each type of each record."""
    return boxes.group_averages(_unit_boxes(spark, d), ("ann_id",))


def merged_corners(spark: SparkSession, d: str) -> DataFrame:
    """Corners and sizes of the clusters that the greedy merge makes of each record's boxes."""
    rows = boxes.merge_boxes(_unit_boxes(spark, d), 0.5, ("ann_id",))
    return rows.select("ann_id", "obj_id", "n", *[six(c).alias(c) for c in ("x1", "y1", "x2", "y2")])


def type_averages(spark: SparkSession, d: str) -> DataFrame:
    """Mean centre and size, and extent, of the boxes of each label."""
    b = F.struct("x1", "y1", "x2", "y2")
    rows = _unit_boxes(spark, d).where("label is not null").withColumn("area", G.area(b))
    whole = lambda c: F.floor(c * F.lit(1e6) + F.lit(0.5)).cast("bigint")
    # millionths in whole numbers, whose sum is the same in any order
    rows = rows.withColumns({"x_m": whole((F.col("x1") + F.col("x2")) / 2), "y_m": whole(1 - (F.col("y1") + F.col("y2")) / 2), "size_m": whole(F.col("area"))})
    return rows.groupBy("label").agg(*[F.expr(f"(2 * sum({c}_m) + count(*)) div (2 * count(*))").alias(c) for c in ("x", "y", "size")], six(F.min("x1")).alias("left"), six(F.max("x2")).alias("right"))


def scene_graph_boxes(spark: SparkSession, d: str) -> DataFrame:
    """Labels of each object: its first name, attributes and relations, distinct, with the object's place as shares of the picture."""
    from ..operators import nested

    t = nested.scene_graph_tables(table(spark, d, "vg_objects"), table(spark, d, "vg_attributes"), table(spark, d, "vg_relationships"))
    objects = t["objects"].where("image_id is not null and object_id is not null").groupBy("image_id", "object_id").agg(F.min(F.struct(nested.LABEL, "x", "y", "w", "h")).alias("o")).select("image_id", "object_id", "o.*")
    names = t["names"].where(F.col(nested.LABEL).endswith(".0") & F.col(nested.VALUE).isNotNull()).select("image_id", "object_id", F.col(nested.VALUE).alias("label"))
    attributes = t["attributes"].where(F.col(nested.VALUE).isNotNull()).select("image_id", "object_id", F.col(nested.VALUE).alias("label"))
    subject, target = (t["ends"].where(F.col("end") == e) for e in ("subject", "object"))
    said = subject.select("image_id", "object_id", nested.PARENT).join(target.select(nested.PARENT, "name"), nested.PARENT).join(t["relations"].select(F.col(nested.LABEL).alias(nested.PARENT), "predicate"), nested.PARENT)
    said = said.where("predicate is not null and name is not null").select("image_id", "object_id", F.concat(F.lower("predicate"), F.lit(" the "), "name").alias("label"))
    labels = names.unionByName(attributes).unionByName(said).where("object_id is not null").distinct()
    images = table(spark, d, "vg_images").select("image_id", "width", "height").where("width > 0 and height > 0").dropDuplicates(["image_id"])
    rows = labels.join(objects, ["image_id", "object_id"]).join(images, "image_id")
    part = lambda a, side: six(a / F.col(side))
    return rows.select("image_id", "object_id", "label", part(F.col("x"), "width").alias("x1"), part(F.col("y"), "height").alias("y1"), part(F.col("x") + F.col("w"), "width").alias("x2"), part(F.col("y") + F.col("h"), "height").alias("y2"))


QUERIES = {
    f.__name__: f
    for f in (annotation_records, source_counts, drop_imageset, drop_dataset, drop_dataset_alone, merged_catalogue, pending_images, reserved_images, sampled_images, images_listed, information_lines, record_information, enough_information,
              weighted_prompts, unit_boxes, box_overlaps, box_containment, merged_boxes, merged_corners, box_tree_texts, box_flat_texts, box_steps, type_counts, group_averages, type_averages, scene_graph_boxes)
}

_ORDER = "('0x' || substr(md5(image_path || '|7'), 1, 8))::BIGINT"
_REC = "rec AS (SELECT * FROM annotations QUALIFY row_number() OVER (PARTITION BY ann_id ORDER BY loaded_at DESC) = 1)"
_PENDING = "pend AS (SELECT DISTINCT image_path FROM annotations WHERE image_path IS NOT NULL AND image_path NOT IN (SELECT image FROM chat_exports WHERE image IS NOT NULL))"
_HELD = "greatest(least({}, 1.0), 0.0)"
_BOXES = f"""{_REC}, raw AS (SELECT ann_id, g.i - 1 AS obj_id, width, height, bboxes[g.i] AS b FROM rec, unnest(range(1, len(bboxes) + 1)) g(i) WHERE true),
px AS (SELECT *, greatest(b.x1, b.x2, b.y1, b.y2) > 2 AS pixels FROM raw WHERE b IS NOT NULL),
sh AS (SELECT ann_id, obj_id, b.label AS label, CASE WHEN pixels THEN b.x1 / nullif(width, 0) ELSE b.x1 END AS p1, CASE WHEN pixels THEN b.x2 / nullif(width, 0) ELSE b.x2 END AS p2, CASE WHEN pixels THEN b.y1 / nullif(height, 0) ELSE b.y1 END AS q1, CASE WHEN pixels THEN b.y2 / nullif(height, 0) ELSE b.y2 END AS q2 FROM px),
ub AS (SELECT ann_id, obj_id, label, {_HELD.format("least(p1, p2)")} AS x1, {_HELD.format("least(q1, q2)")} AS y1, {_HELD.format("greatest(p1, p2)")} AS x2, {_HELD.format("greatest(q1, q2)")} AS y2 FROM sh WHERE p1 IS NOT NULL AND p2 IS NOT NULL AND q1 IS NOT NULL AND q2 IS NOT NULL)"""
_COMMON = "(greatest(least(a.x2, b.x2) - greatest(a.x1, b.x1), 0) * greatest(least(a.y2, b.y2) - greatest(a.y1, b.y1), 0))"
_AREA = "((({0}.x2 - {0}.x1) * ({0}.y2 - {0}.y1)))"
_IOU = f"coalesce({_COMMON} / nullif({_AREA.format('a')} + {_AREA.format('b')} - {_COMMON}, 0), 0)"

_TYPES = """ty AS (SELECT *, regexp_replace(CASE WHEN regexp_matches(t, '(?i)(ss|x|zz|ch|sh|[^oa]us)es$') THEN regexp_replace(t, '(?i)es$', '') WHEN regexp_matches(t, '(?i)(glas|scis|trous|jea|shor|pan|compas|harnes|dres|mattres|lens|canvas|cactus|iris)s?(es|sors|ers|ns|ts|ses|s)?$') THEN t ELSE regexp_replace(t, '(?i)([^sui])s$', '\\1') END, '(?i)(..)ies$', '\\1y') AS type
 FROM (SELECT *, trim(unnest(string_split(split_part(label, '(', 1), ','))) AS t, generate_subscripts(string_split(split_part(label, '(', 1), ','), 1) AS k FROM ub WHERE label IS NOT NULL))"""
_STEP = "printf('%.2f', round_even(({0}) / 0.05::DOUBLE, 0) * 0.05::DOUBLE)"
_MEET = "coalesce((greatest(least(a.x2, new[1].x2) - greatest(a.x1, new[1].x1), 0) * greatest(least(a.y2, new[1].y2) - greatest(a.y1, new[1].y1), 0)) / nullif((a.x2 - a.x1) * (a.y2 - a.y1) + (new[1].x2 - new[1].x1) * (new[1].y2 - new[1].y1) - greatest(least(a.x2, new[1].x2) - greatest(a.x1, new[1].x1), 0) * greatest(least(a.y2, new[1].y2) - greatest(a.y1, new[1].y1), 0), 0), 0) > 0.5"
_TWO = "CASE WHEN {0} IS NULL THEN '?' ELSE printf('%.2f', floor(({0}) * 100 + 0.5) / 100) END"
SQL = {
    "annotation_records": f"WITH {_REC} SELECT ann_id, image_path, dataset, image_id FROM rec",
    "source_counts": "SELECT dataset, count(DISTINCT image_path) AS n_images FROM annotations GROUP BY dataset UNION ALL SELECT '*', count(DISTINCT image_path) FROM annotations",
    "drop_imageset": "SELECT DISTINCT ann_id, image_path FROM annotations WHERE NOT contains(image_path, 'coco/')",
    "drop_dataset": "SELECT DISTINCT ann_id, dataset FROM annotations WHERE dataset IS DISTINCT FROM 'coco_captions'",
    "drop_dataset_alone": "SELECT DISTINCT ann_id, dataset FROM annotations a WHERE a.image_path IS NULL OR EXISTS (SELECT 1 FROM annotations b WHERE b.image_path = a.image_path AND b.dataset IS DISTINCT FROM 'coco_captions')",
    "merged_catalogue": "SELECT image_path, string_agg(dataset, ',' ORDER BY dataset) AS datasets, count(*)::INT AS n FROM (SELECT DISTINCT image_path, dataset FROM annotations WHERE image_path IS NOT NULL AND dataset IS NOT NULL) GROUP BY image_path",
    "pending_images": f"WITH {_PENDING} SELECT image_path FROM pend",
    "reserved_images": f"""WITH p AS (SELECT DISTINCT image_path FROM annotations WHERE image_path IS NOT NULL AND image_path NOT IN (SELECT image FROM chat_exports WHERE image IS NOT NULL AND run_id = '{RUN}')),
 o AS (SELECT image_path, row_number() OVER (ORDER BY {_ORDER}, image_path) AS n FROM p) SELECT CASE WHEN n <= 60 THEN 0 ELSE 1 END AS claim, image_path FROM o WHERE n <= 100""",
    "sampled_images": f"SELECT DISTINCT ann_id, image_path FROM annotations WHERE image_path IN (SELECT image_path FROM (SELECT DISTINCT image_path FROM annotations WHERE image_path IS NOT NULL) ORDER BY {_ORDER}, image_path LIMIT 50)",
    "images_listed": "SELECT DISTINCT export_id, image FROM chat_exports WHERE image IN (SELECT image_path FROM annotations WHERE image_path IS NOT NULL)",
    "information_lines": f"WITH {_REC} SELECT ann_id, dataset, (g.i - 1)::INT AS pos, captions[g.i] AS line FROM rec, unnest(range(1, len(captions) + 1)) g(i) WHERE true AND captions[g.i] IS NOT NULL AND trim(captions[g.i]) != ''",
    "enough_information": f"WITH {_REC}, s AS (SELECT ann_id, coalesce(list_sum(list_transform(captions, lambda x: coalesce(len(x), 0))), 0)::INT AS n FROM rec) SELECT ann_id, n, n >= 100 AS enough FROM s",
    "weighted_prompts": "SELECT ann_id, CASE WHEN u <= 0.4873 THEN 'llava_complex_reasoning' WHEN u <= 0.4873 + 0.3671 THEN 'llava_conversation' ELSE 'llava_detail' END AS prompt_type FROM (SELECT ann_id, ('0x' || substr(md5(ann_id::VARCHAR), 1, 8))::BIGINT / 4294967296.0::DOUBLE * (0.4873 + 0.3671 + 0.1456)::DOUBLE AS u FROM (SELECT DISTINCT ann_id FROM annotations))",
    "unit_boxes": f"WITH {_BOXES} SELECT ann_id, obj_id, label, (floor((x1) * 1e6 + 0.5) / 1e6) AS x1, (floor((y1) * 1e6 + 0.5) / 1e6) AS y1, (floor((x2) * 1e6 + 0.5) / 1e6) AS x2, (floor((y2) * 1e6 + 0.5) / 1e6) AS y2 FROM ub",
    "box_overlaps": f"WITH {_BOXES} SELECT a.ann_id, a.obj_id AS a, b.obj_id AS b, (floor(({_IOU}) * 1e6 + 0.5) / 1e6) AS iou FROM ub a JOIN ub b ON a.ann_id = b.ann_id AND a.obj_id < b.obj_id WHERE {_IOU} > 0.1",
    "box_containment": f"""WITH {_BOXES} SELECT a.ann_id, a.obj_id AS "inner", b.obj_id AS "outer" FROM ub a JOIN ub b ON a.ann_id = b.ann_id AND a.obj_id != b.obj_id
 WHERE split_part(a.label, ' (', 1) IS DISTINCT FROM split_part(b.label, ' (', 1) AND greatest(a.obj_id * 5 % 9 - 1, b.obj_id * 5 % 9 - 1) <= least(a.obj_id * 5 % 9 + 1 + 1, b.obj_id * 5 % 9 + 1 + 1) AND {_AREA.format("a")} < {_AREA.format("b")} AND coalesce({_COMMON} / nullif({_AREA.format("a")}, 0), 0) > 0.2""",
    "box_steps": f"WITH {_BOXES} SELECT ann_id, obj_id, round(round_even(x1 / 0.05::DOUBLE, 0) * 0.05::DOUBLE, 4) AS x1, round(round_even(y1 / 0.05::DOUBLE, 0) * 0.05::DOUBLE, 4) AS y1 FROM ub",
    "type_counts": f"WITH {_BOXES}, {_TYPES} SELECT ann_id, type, count(*)::INT AS n FROM ty GROUP BY ann_id, type",
    "group_averages": f"""WITH {_BOXES}, {_TYPES}, m AS (SELECT ann_id, type, count(*)::INT AS n, min(x1) AS a, min(y1) AS b, max(x2) AS c, max(y2) AS d, list_sum(list((x1 + x2) / 2 ORDER BY obj_id, k)) / count(*) AS x, list_sum(list(1 - (y1 + y2) / 2 ORDER BY obj_id, k)) / count(*) AS y,
  list_sum(list((x2 - x1) * (y2 - y1) ORDER BY obj_id, k)) / count(*) * 100 AS s FROM ty GROUP BY ann_id, type)
 SELECT ann_id, type, n, '[' || {_STEP.format("a")} || ', ' || {_STEP.format("b")} || ', ' || {_STEP.format("c")} || ', ' || {_STEP.format("d")} || '] [Average X: ' || {_STEP.format("x")} || ', Average Y: ' || {_STEP.format("y")} || ', Average Pixel Size: ' || printf('%.1f', s) || '%]' AS text FROM m""",
    "merged_corners": f"""WITH {_BOXES}, r AS (SELECT ann_id, list_reduce(list([{{'x1': x1, 'y1': y1, 'x2': x2, 'y2': y2, 'n': 1}}] ORDER BY obj_id), lambda done, new:
  CASE WHEN len(list_filter(done, lambda a: {_MEET})) = 0 THEN list_concat(done, new)
  ELSE list_transform(done, lambda a, i: CASE WHEN i = list_position(list_transform(done, lambda a: {_MEET}), true)
   THEN {{'x1': least(a.x1, new[1].x1), 'y1': least(a.y1, new[1].y1), 'x2': greatest(a.x2, new[1].x2), 'y2': greatest(a.y2, new[1].y2), 'n': a.n + 1}} ELSE a END) END) AS c FROM ub GROUP BY ann_id),
 e AS (SELECT ann_id, unnest(range(len(c)))::INT AS obj_id, unnest(c) AS c FROM r)
 SELECT ann_id, obj_id, c.n AS n, floor(c.x1 * 1e6 + 0.5) / 1e6 AS x1, floor(c.y1 * 1e6 + 0.5) / 1e6 AS y1, floor(c.x2 * 1e6 + 0.5) / 1e6 AS x2, floor(c.y2 * 1e6 + 0.5) / 1e6 AS y2 FROM e""",
    "type_averages": f"WITH {_BOXES}, m AS (SELECT label, x1, x2, floor((x1 + x2) / 2 * 1e6 + 0.5)::BIGINT AS x, floor((1 - (y1 + y2) / 2) * 1e6 + 0.5)::BIGINT AS y, floor({_AREA.format('ub')} * 1e6 + 0.5)::BIGINT AS s FROM ub WHERE label IS NOT NULL) SELECT label, ((2 * sum(x) + count(*)) // (2 * count(*)))::BIGINT AS x, ((2 * sum(y) + count(*)) // (2 * count(*)))::BIGINT AS y, ((2 * sum(s) + count(*)) // (2 * count(*)))::BIGINT AS size, floor(min(x1) * 1e6 + 0.5) / 1e6 AS \"left\", floor(max(x2) * 1e6 + 0.5) / 1e6 AS \"right\" FROM m GROUP BY label",
    "scene_graph_boxes": f"""WITH {_OBJECTS}, {_LISTS}, {_RELS},
 o AS (SELECT image_id, x.object_id AS object_id, min({{'l': rec_id || '.' || (i - 1), 'x': x.x, 'y': x.y, 'w': x.w, 'h': x.h}}) AS p FROM objs WHERE image_id IS NOT NULL AND x.object_id IS NOT NULL GROUP BY 1, 2),
 l AS (SELECT image_id, x.object_id AS object_id, x.names[1] AS label FROM objs WHERE x.names[1] IS NOT NULL UNION SELECT image_id, object_id, label FROM (SELECT image_id, x.object_id AS object_id, unnest(x.attributes) AS label FROM lists) WHERE label IS NOT NULL
  UNION SELECT s.image_id, s.object_id, lower(json_extract_string(s.x, '$.predicate')) || ' the ' || coalesce(json_extract_string(t.n, '$.name'), json_extract_string(t.n, '$.names[0]')) FROM linked s JOIN linked t ON s.rec_id = t.rec_id AND s.i = t.i AND s.child = 'subject' AND t.child = 'object'),
 v AS (SELECT image_id, any_value(width) AS width, any_value(height) AS height FROM vg_images WHERE width > 0 AND height > 0 GROUP BY image_id)
 SELECT l.image_id, l.object_id, l.label, floor(p.x / width * 1e6 + 0.5) / 1e6 AS x1, floor(p.y / height * 1e6 + 0.5) / 1e6 AS y1, floor((p.x + p.w) / width * 1e6 + 0.5) / 1e6 AS x2, floor((p.y + p.h) / height * 1e6 + 0.5) / 1e6 AS y2
 FROM (SELECT DISTINCT * FROM l WHERE label IS NOT NULL AND object_id IS NOT NULL) l JOIN o ON l.image_id = o.image_id AND l.object_id = o.object_id JOIN v ON l.image_id = v.image_id""",
    "box_flat_texts": f"""WITH {_REC}, b AS (SELECT ann_id, g.i AS i, bboxes[g.i] AS b FROM rec, unnest(range(1, len(bboxes) + 1)) g(i) WHERE true),
 l AS (SELECT ann_id, string_agg('[' || coalesce(b.label, '') || ', ' || {_TWO.format("b.x1")} || ', ' || {_TWO.format("1 - b.y2")} || ', ' || {_TWO.format("b.x2")} || ', ' || {_TWO.format("1 - b.y1")} || ']', chr(10) ORDER BY i) AS t FROM b GROUP BY ann_id)
 SELECT r.ann_id, CASE WHEN t IS NULL THEN '' ELSE 'Boxes with label, left, bottom, right and top, as shares of the picture''s size:' || chr(10) || chr(10) || '=== ' || dataset || ' OCR ===' || chr(10) || t || chr(10) || '=== End of OCR ===' END AS text FROM rec r LEFT JOIN l ON r.ann_id = l.ann_id""",
}
