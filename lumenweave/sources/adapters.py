"""Adapters: one for each annotation collection, from its published files to canonical rows.

``root`` is the folder that holds one folder per collection, as downloaded. Every adapter is a lazy plan: files are read with
a schema of the needed fields only, joined, and grouped by image. Where the collections leave an order open, text lists are
in the order of the file. Downloads are not part of this package.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .records import box, box_xywh, coco_path, elements, in_order, json_map, json_rows, last_by, majority, majority_of, numbered, pad, source

def _no_text() -> Column:
    return F.lit(None).cast("string")


def _one(value: Column) -> Column:
    """A list of one text, or an empty one."""
    return F.when(value.isNotNull() & (value != ""), F.array(value)).otherwise(F.array().cast("array<string>"))


def _base(path: Column) -> Column:
    return F.element_at(F.split(path, "/"), -1)


def _stem(path: Column) -> Column:
    return F.regexp_replace(_base(path), r"(?<=.)\.[^.]*$", "")


# Detection collections in the COCO layout


def _coco(spark: SparkSession, folder: str, year: str, file_name: Column, image_source: str) -> DataFrame:
    captions = json_rows(spark, f"{folder}/captions_train{year}.json", "images array<struct<id bigint, file_name string, width int, height int>>, annotations array<struct<image_id bigint, caption string>>")
    # the polygons of the other file are never parsed: they aren't in the schema
    instances = json_rows(spark, f"{folder}/instances_train{year}.json", "annotations array<struct<image_id bigint, category_id bigint, bbox array<double>>>, categories array<struct<id bigint, name string>>")
    images = elements(captions, "images").select(F.col("id").alias("image_id"), F.concat(F.lit("coco/train2017/"), file_name).alias("image_path"), "width", "height")
    texts = elements(captions, "annotations").groupBy("image_id").agg(in_order(F.col("caption"), "pos").alias("captions"))
    names = elements(instances, "categories").select(F.col("id").alias("category_id"), "name")
    b = F.col("bbox")
    boxes = elements(instances, "annotations").join(F.broadcast(names), "category_id", "left").join(images, "image_id")  # one row per category of the collection
    boxes = boxes.groupBy("image_id").agg(in_order(box_xywh(F.coalesce("name", F.lit("unknown")), b[0], b[1], b[2], b[3], F.col("width"), F.col("height")), "pos").alias("bboxes"))
    # an image with boxes but no caption is kept with an empty list
    return images.join(texts, "image_id", "left").join(boxes, "image_id", "left").where("captions is not null or bboxes is not null").select("image_path", "image_id", F.lit(image_source).alias("image_source"), "captions", "bboxes")


@source("coco_captions")
def coco_captions(spark: SparkSession, root: str) -> DataFrame:
    return _coco(spark, f"{root}/coco_captions/annotations", "2017", F.col("file_name"), "coco/train2017")


@source("coco_captions_2014")
def coco_captions_2014(spark: SparkSession, root: str) -> DataFrame:
    return _coco(spark, f"{root}/coco_captions_2014/annotations", "2014", F.substring_index("file_name", "_", -1), "coco/train2014")


@source("lvis")
def lvis(spark: SparkSession, root: str) -> DataFrame:
    """Names of the categories that are there, and of those known to be absent, as captions; names in alphabetical order."""
    raw = json_rows(spark, f"{root}/lvis/lvis_v1_train.json", "images array<struct<id bigint, coco_url string, width int, height int, neg_category_ids array<bigint>>>, annotations array<struct<image_id bigint, category_id bigint, bbox array<double>>>, categories array<struct<id bigint, name string>>")
    names = F.broadcast(elements(raw, "categories").select(F.col("id").alias("category_id"), F.replace("name", F.lit("_"), F.lit(" ")).alias("name")))
    images = elements(raw, "images").select(F.col("id").alias("image_id"), "coco_url", "width", "height", "neg_category_ids")
    absent = images.select("image_id", F.posexplode("neg_category_ids").alias("pos", "category_id")).join(names, "category_id").groupBy("image_id").agg(in_order(F.col("name"), "pos").alias("absent"))
    b = F.col("bbox")
    there = elements(raw, "annotations").join(names, "category_id").join(images.select("image_id", "width", "height"), "image_id")
    there = there.groupBy("image_id").agg(F.sort_array(F.collect_set("name")).alias("present"), in_order(box_xywh(F.col("name"), b[0], b[1], b[2], b[3], F.col("width"), F.col("height")), "pos").alias("bboxes"))
    said = lambda c, start: F.when(F.size(c) > 0, F.concat(F.lit(start), F.array_join(c, ", "), F.lit(".")))
    rows = images.join(absent, "image_id", "left").join(there, "image_id", "left")
    captions = F.array_compact(F.array(said("absent", "This image does not contain "), said("present", "This image contains ")))
    return rows.select(F.concat(F.lit("coco/train2017/"), _base(F.col("coco_url"))).alias("image_path"), F.substring_index(_base(F.col("coco_url")), ".", 1).alias("image_id"), F.lit("lvis").alias("image_source"), captions.alias("captions"), "bboxes")


# Scene graphs


@source("gqa")
def gqa(spark: SparkSession, root: str) -> DataFrame:
    """Boxes of objects, of their attributes and of their relations; questions with their full answers."""
    graph = "struct<width double, height double, objects map<string, struct<name string, x double, y double, w double, h double, attributes array<string>, relations array<struct<name string, object string>>>>>"
    graphs = json_map(spark, f"{root}/gqa/*_sceneGraphs.json", graph).select(F.col("key").alias("image_id"), "value.*")
    objects = graphs.select("image_id", "width", "height", F.posexplode("objects").alias("pos", "object_id", "o")).select("*", "o.*")
    place = lambda label: box_xywh(label, F.col("x"), F.col("y"), F.col("w"), F.col("h"), F.col("width"), F.col("height"))
    # the article of a relation's target depends on how many objects of the image have its name
    named = objects.select("image_id", F.col("object_id").alias("target"), F.col("name").alias("target_name"))
    counts = named.groupBy("image_id", "target_name").agg(F.count("*").alias("n"))
    article = F.when(F.col("n") == 1, "the").when(F.lower(F.substring("target_name", 1, 1)).isin(*"aeiou"), "an").otherwise("a")
    relations = objects.select("*", F.posexplode("relations").alias("k", "r")).select("*", F.col("r.object").alias("target"), F.col("r.name").alias("relation"))
    relations = relations.join(named, ["image_id", "target"]).join(counts, ["image_id", "target_name"])
    parts = objects.select("image_id", "pos", F.lit(0).alias("part"), F.lit(0).alias("k"), place(F.col("name")).alias("b"))
    parts = parts.unionByName(objects.select("*", F.posexplode("attributes").alias("k", "a")).select("image_id", "pos", F.lit(1).alias("part"), "k", place(F.col("a")).alias("b")))
    parts = parts.unionByName(relations.select("image_id", "pos", F.lit(2).alias("part"), "k", place(F.concat_ws(" ", "relation", article, "target_name")).alias("b")))
    boxes = parts.groupBy("image_id").agg(in_order(F.col("b"), "pos", "part", "k").alias("bboxes"))
    questions = json_map(spark, f"{root}/gqa/train_balanced_questions.json", "struct<imageId string, question string, fullAnswer string>").select("pos", "value.*")
    asked = questions.groupBy(F.col("imageId").alias("image_id")).agg(in_order(F.concat_ws(" ", "question", "fullAnswer"), "pos").alias("qa"))
    rows = graphs.select("image_id").join(boxes, "image_id", "left").join(asked, "image_id", "left")
    return rows.select(F.concat(F.lit("gqa/images/"), "image_id", F.lit(".jpg")).alias("image_path"), "image_id", F.lit("gqa").alias("image_source"), "bboxes", "qa")


def listing(spark: SparkSession, folder: str) -> DataFrame:
    """``(name)`` of the files of a folder; their contents aren't read."""
    return spark.read.format("binaryFile").load(folder).select(_base(F.col("path")).alias("name"))


def visual_genome_images(spark: SparkSession, root: str) -> DataFrame:
    """``(image_id, image_path, width, height)``: the COCO picture if there is one, else the file in one of the two folders."""
    images = json_rows(spark, f"{root}/visual_genome/image_data.json", "image_id bigint, coco_id bigint, width int, height int")
    coco = elements(json_rows(spark, f"{root}/coco_captions/annotations/instances_train2017.json", "images array<struct<id bigint, file_name string>>"), "images")
    coco = coco.select(F.col("id").alias("coco_id"), F.concat(F.lit("coco/train2017/"), "file_name").alias("in_coco"))
    rows = images.join(coco, "coco_id", "left")
    for column, folder in (("in_first", "VG_100K"), ("in_second", "VG_100K_2")):
        files = listing(spark, f"{root}/images/vg/{folder}").select(F.substring_index("name", ".", 1).try_cast("bigint").alias("image_id"), F.concat(F.lit(f"vg/{folder}/"), "name").alias(column))
        rows = rows.join(files.where("image_id is not null").dropDuplicates(["image_id"]), "image_id", "left")
    return rows.select("image_id", F.coalesce("in_coco", "in_first", "in_second").alias("image_path"), "width", "height").where("image_path is not null")


@source("visual_genome")
def visual_genome(spark: SparkSession, root: str) -> DataFrame:
    """A box for each object and one for each of its distinct attributes and relations, those in alphabetical order."""
    folder, images = f"{root}/visual_genome", visual_genome_images(spark, root)
    objects = elements(json_rows(spark, f"{folder}/objects.json", "image_id bigint, objects array<struct<object_id bigint, names array<string>, x double, y double, w double, h double>>"), "objects", "image_id")
    attributes = elements(json_rows(spark, f"{folder}/attributes.json", "image_id bigint, attributes array<struct<object_id bigint, attributes array<string>>>"), "attributes", "image_id")
    relations = elements(json_rows(spark, f"{folder}/relationships.json", "image_id bigint, relationships array<struct<predicate string, subject struct<object_id bigint>, object struct<name string, names array<string>>>>"), "relationships", "image_id")
    said = relations.select("image_id", F.col("subject.object_id").alias("object_id"), F.concat(F.lower("predicate"), F.lit(" the "), F.coalesce("object.name", F.get("object.names", F.lit(0)))).alias("a"))
    extra = attributes.select("image_id", "object_id", F.explode("attributes").alias("a")).unionByName(said).groupBy("image_id", "object_id").agg(F.sort_array(F.collect_set("a")).alias("extra"))
    last = objects.groupBy("image_id", "object_id").agg(last_by(F.struct("pos", "names", "x", "y", "w", "h"), "pos").alias("o"), F.min("pos").alias("first"))
    rows = last.join(extra, ["image_id", "object_id"], "left").join(images, "image_id")
    labels = F.concat(F.array(F.get("o.names", F.lit(0))), F.coalesce("extra", F.array().cast("array<string>")))
    boxes = F.transform(labels, lambda label: box_xywh(label, F.col("o.x"), F.col("o.y"), F.col("o.w"), F.col("o.h"), F.col("width"), F.col("height")))
    grouped = rows.groupBy("image_path").agg(F.flatten(in_order(boxes, "first", "object_id")).alias("bboxes"))
    return grouped.select("image_path", _stem(F.col("image_path")).alias("image_id"), F.substring_index("image_path", "/", 1).alias("image_source"), "bboxes")


# Questions and answers


@source("visual7w")
def visual7w(spark: SparkSession, root: str) -> DataFrame:
    images = elements(json_rows(spark, f"{root}/visual7w/dataset_v7w_telling.json", "images array<struct<image_id bigint, split string, qa_pairs array<struct<question string, answer string, multiple_choices array<string>>>>>"), "images")
    plain = lambda c: F.regexp_replace(F.lower(c), r"\.$", "")
    rows = elements(images.where("split = 'train'").withColumnRenamed("pos", "image_pos"), "qa_pairs", "image_id", "image_pos")
    text = F.concat(F.col("question"), F.lit(" "), plain(F.col("answer")), F.lit(" (not "), F.array_join(F.transform("multiple_choices", plain), ", nor "), F.lit(")"))
    rows = rows.select("image_id", text.alias("t"), "image_pos", "pos").join(visual_genome_images(spark, root), "image_id")
    return rows.groupBy("image_path").agg(F.min("image_id").alias("image_id"), in_order(F.col("t"), "image_pos", "pos").alias("qa")).withColumn("image_source", F.substring_index("image_path", "/", 1))


@source("a_ok_vqa")
def a_ok_vqa(spark: SparkSession, root: str, keep: str = "last") -> DataFrame:
    """Question, right choice, the others, and the reasons. Of several questions of an image the last is kept, or all of them."""
    rows = numbered(json_rows(spark, f"{root}/a_ok_vqa/aokvqa_v1p0_train.json", "image_id bigint, question string, choices array<string>, correct_choice_idx int, rationales array<string>"))
    others = F.filter("choices", lambda c, i: i != F.col("correct_choice_idx"))
    text = F.concat(F.col("question"), F.lit(" "), F.get("choices", "correct_choice_idx"), F.lit(" (not "), F.array_join(others, " nor "), F.lit(")\n"), F.replace(F.array_join("rationales", " "), F.lit("\n"), F.lit(" ")))
    return _questions(rows, text, "a_ok_vqa", keep)


def _questions(rows: DataFrame, text: Column, image_source: str, keep: str) -> DataFrame:
    qa = F.array(last_by(text, "pos")) if keep == "last" else in_order(text, "pos")
    return rows.groupBy("image_id").agg(qa.alias("qa")).select(coco_path(F.col("image_id")).alias("image_path"), "image_id", F.lit(image_source).alias("image_source"), "qa")


@source("ok_vqa")
def ok_vqa(spark: SparkSession, root: str, keep: str = "last") -> DataFrame:
    folder = f"{root}/ok_vqa"
    questions = elements(json_rows(spark, f"{folder}/OpenEnded_mscoco_train2014_questions.json", "questions array<struct<question_id bigint, image_id bigint, question string>>"), "questions")
    given = elements(json_rows(spark, f"{folder}/mscoco_train2014_annotations.json", "annotations array<struct<question_id bigint, answers array<struct<answer string>>>>"), "annotations")
    votes = given.select("question_id", F.posexplode("answers.answer").alias("place", "answer"))
    rows = questions.join(majority(votes, ["question_id"], "answer", "place"), "question_id", "left")
    return _questions(rows, F.concat_ws(" ", "question", F.coalesce("answer", F.lit("No answer"))), "ok_vqa", keep)


@source("vqa_v2")
def vqa_v2(spark: SparkSession, root: str) -> DataFrame:
    folder = f"{root}/vqa_v2"
    questions = elements(json_rows(spark, f"{folder}/v2_OpenEnded_mscoco_train2014_questions.json", "questions array<struct<question_id bigint, question string>>"), "questions").drop("pos")
    given = elements(json_rows(spark, f"{folder}/v2_mscoco_train2014_annotations.json", "annotations array<struct<question_id bigint, image_id bigint, multiple_choice_answer string>>"), "annotations")
    return _questions(given.join(questions, "question_id"), F.concat_ws(" ", "question", "multiple_choice_answer"), "coco_vqa", "all")


def explained_answer(kind: Column, answers: Column) -> Column:
    """Answer of a question with several given ones, by its kind; null where they contradict each other or none is usable.

    ``yes/no``: none if both occur, else the most frequent in lower case; ``number``: the most frequent number, printed as a
    floating-point number; others: the most frequent. Among equals the first.
    """
    low = F.transform(answers, F.lower)
    polar = F.when(F.array_contains(low, "yes") & F.array_contains(low, "no"), _no_text()).otherwise(majority_of(low))
    numbers = F.filter(answers, lambda a: F.replace(a, F.lit("."), F.lit("")).rlike("^[0-9]+$"))
    number = majority_of(F.transform(numbers, lambda a: a.try_cast("double").cast("string")))
    return F.when(kind == "yes/no", polar).when(kind == "number", number).otherwise(majority_of(answers))


@source("vqa_e")
def vqa_e(spark: SparkSession, root: str) -> DataFrame:
    rows = numbered(json_rows(spark, f"{root}/vqa_e/VQA-E_train_set.json", "img_id bigint, question string, answers array<string>, answer_type string, explanation array<string>"))
    answer = explained_answer(F.col("answer_type"), F.col("answers"))
    rows = rows.withColumn("answer", answer).where("answer is not null").withColumnRenamed("img_id", "image_id")
    return _questions(rows, F.concat(F.col("question"), F.lit(" "), F.col("answer"), F.lit(" ("), F.get("explanation", F.lit(0)), F.lit(")")), "coco", "all")


@source("text_vqa")
def text_vqa(spark: SparkSession, root: str) -> DataFrame:
    """Questions with the majority answer; the classes of the image as a caption."""
    rows = elements(json_rows(spark, f"{root}/text_vqa/TextVQA_0.5.1_train.json", "data array<struct<image_id string, question string, answers array<string>, image_classes array<string>>>"), "data")
    grouped = rows.groupBy("image_id").agg(in_order(F.concat_ws(" ", F.col("question"), majority_of(F.col("answers"))), "pos").alias("qa"), F.min_by("image_classes", "pos").alias("classes"))
    caption = F.when(F.size("classes") > 0, F.concat(F.lit("This image contains: "), F.array_join("classes", ", ")))
    return grouped.select(F.concat(F.lit("textvqa/train_images/"), "image_id", F.lit(".jpg")).alias("image_path"), "image_id", F.lit("text_vqa").alias("image_source"), _one(caption).alias("captions"), "qa")


@source("st_vqa")
def st_vqa(spark: SparkSession, root: str) -> DataFrame:
    rows = json_rows(spark, f"{root}/st_vqa/data.json", "image_path string, image_id string, qas array<struct<question string, answers array<string>>>")
    said = F.transform(F.filter("qas", lambda q: q["question"].isNotNull() & q["answers"].isNotNull()), lambda q: F.concat(F.lit("Question: "), q["question"], F.lit(" Answer: "), F.array_join(q["answers"], ", ")))
    return rows.select("image_path", "image_id", F.lit("st_vqa").alias("image_source"), said.alias("qa"))


def _document_questions(spark: SparkSession, root: str, name: str, more: str = "") -> DataFrame:
    return numbered(json_rows(spark, f"{root}/{name}/data.json", f"image_path string, image_id string, query struct<en string>, question string, answers array<string>, words array<string>, word_boxes array<array<double>>{more}"))


@source("doc_vqa")
def doc_vqa(spark: SparkSession, root: str) -> DataFrame:
    """Questions in English with a first answer, neither of them empty; the words of the page as boxes."""
    rows = _document_questions(spark, root, "doc_vqa", ", metadata map<string,string>")
    text = F.when((F.trim("query.en") != "") & (F.trim(F.get("answers", F.lit(0))) != ""), F.concat_ws(" ", "query.en", F.get("answers", F.lit(0))))
    boxes = F.transform(F.filter(F.arrays_zip("words", "word_boxes"), lambda z: F.size(z["word_boxes"]) >= 4), lambda z: box(z["words"], z["word_boxes"][0], z["word_boxes"][1], z["word_boxes"][2], z["word_boxes"][3]))
    grouped = rows.groupBy("image_path").agg(F.first("image_id").alias("image_id"), in_order(text, "pos").alias("qa"), F.min_by(boxes, "pos").alias("bboxes"), F.min_by("metadata", "pos").alias("metadata"))
    return grouped.withColumn("image_source", F.lit("doc_vqa"))


@source("info_vqa")
def info_vqa(spark: SparkSession, root: str) -> DataFrame:
    rows = _document_questions(spark, root, "info_vqa").withColumn("image_id", _stem(F.col("image_path")))
    text = F.concat_ws(" ", F.trim("question"), F.trim(F.get("answers", F.lit(0))))
    return rows.groupBy("image_id").agg(F.min_by("image_path", "pos").alias("image_path"), in_order(text, "pos").alias("qa")).withColumn("image_source", F.lit("info_vqa"))


@source("chart_qa")
def chart_qa(spark: SparkSession, root: str) -> DataFrame:
    """Pictures with the same bytes are one, named by the first 16 digits of their hash; each answer makes a question."""
    rows = numbered(json_rows(spark, f"{root}/chart_qa/data.json", "image binary, query string, label array<string>"))
    rows = rows.select(F.substring(F.sha2("image", 256), 1, 16).alias("image_id"), "pos", "query", F.posexplode("label").alias("k", "answer"))
    grouped = rows.groupBy("image_id").agg(in_order(F.concat_ws(" ", "query", "answer"), "pos", "k").alias("qa"))
    return grouped.select(F.concat(F.lit("chart_qa/images/"), "image_id", F.lit(".png")).alias("image_path"), "image_id", F.lit("chart_qa").alias("image_source"), "qa")


@source("mm_visualmrc")
def mm_visualmrc(spark: SparkSession, root: str) -> DataFrame:
    """A conversation without its picture entries, taken two by two; pairs with an empty side are left out."""
    rows = json_rows(spark, f"{root}/mm_visualmrc/data.json", "image_path string, image_id string, conversation array<struct<role string, data string, modality string>>, metadata map<string,string>")
    said = F.filter("conversation", lambda c: F.coalesce(c["modality"], F.lit("")) != "image")
    rows = rows.withColumn("said", F.transform(said, lambda c: F.trim(F.coalesce(c["data"], F.lit("")))))
    pairs = F.transform(F.sequence(F.lit(0), F.greatest(F.floor(F.size("said") / 2).cast("int") - 1, F.lit(0))), lambda i: F.struct(F.get("said", i * 2).alias("q"), F.get("said", i * 2 + 1).alias("a")))
    qa = F.transform(F.filter(pairs, lambda p: (p["q"] != "") & (p["a"] != "")), lambda p: F.concat_ws(" ", p["q"], p["a"]))
    return rows.select("image_path", "image_id", F.lit("mm_visualmrc").alias("image_source"), qa.alias("qa"), "metadata")


@source("scienceqa")
def scienceqa(spark: SparkSession, root: str) -> DataFrame:
    """Problems of the training part that have a picture: one text with lettered choices, and a caption of their context."""
    problem = "struct<split string, image string, question string, choices array<string>, answer int, solution string, lecture string, subject string, category string, skill string, topic string>"
    rows = json_map(spark, f"{root}/scienceqa/problems.json", problem).select(F.col("key").alias("image_id"), "value.*").where("split = 'train' and image is not null and image != ''")
    letters = F.transform("choices", lambda c, i: F.concat(F.lit("("), F.char(i + 65), F.lit(") "), c, F.lit("\n")))
    some = lambda label, c: F.when(F.col(c) != "", F.concat(F.lit(f"{label}: "), c))
    text = F.concat(F.lit("Question: "), "question", F.lit("\n"), F.when(F.size("choices") > 0, F.concat(F.lit("Choices:\n"), F.array_join(letters, ""))).otherwise(""), F.lit("Answer: "), F.get("choices", "answer"), F.lit("\n"), F.coalesce(some("Solution", "solution"), F.lit("")))
    context = F.nullif(F.concat_ws(" | ", some("Subject", "subject"), some("Category", "category"), some("Skill", "skill"), some("Topic", "topic")), F.lit(""))
    caption = F.concat_ws(" ", some("Background", "lecture"), context)
    return rows.select(F.concat(F.lit("scienceqa/train/"), "image_id", F.lit("/"), "image").alias("image_path"), "image_id", F.lit("scienceqa").alias("image_source"), _one(caption).alias("captions"), F.array(text).alias("qa"))


@source("tallyqa")
def tallyqa(spark: SparkSession, root: str) -> DataFrame:
    """Counting questions as statements; pictures of the validation part are left out."""
    from ..functions.text import count_statement

    rows = numbered(json_rows(spark, f"{root}/tallyqa/train.json", "image string, image_id string, question string, answer int")).where(~F.col("image").contains("val2014"))
    path = F.when(F.col("image").contains("train2014"), F.concat(F.lit("coco/train2017/"), F.substring_index(_base(F.col("image")), "_", -1))).otherwise(F.concat(F.lit("vg/"), "image"))
    rows = rows.withColumn("image_path", path).withColumn("said", count_statement(F.col("question"), F.col("answer")))
    return rows.groupBy("image_path").agg(F.min_by("image_id", "pos").alias("image_id"), in_order(F.col("said"), "pos").alias("captions")).withColumn("image_source", F.substring_index("image_path", "/", 1))


# Captions


@source("textcaps")
def textcaps(spark: SparkSession, root: str) -> DataFrame:
    """Captions and references; the words seen by the references once per entry."""
    rows = elements(json_rows(spark, f"{root}/textcaps/TextCaps_0.1_train.json", "data array<struct<image_id string, caption_str string, reference_strs array<string>, reference_tokens array<array<string>>>>"), "data")
    seen = F.transform("reference_tokens", lambda t: F.concat(F.lit("Text visible in image "), F.array_join(F.filter(t, lambda x: ~x.isin("<s>", "</s>")), " ")))
    texts = F.concat(F.array("caption_str"), F.coalesce("reference_strs", F.array().cast("array<string>")), F.coalesce(F.array_distinct(seen), F.array().cast("array<string>")))
    grouped = rows.groupBy("image_id").agg(F.flatten(in_order(texts, "pos")).alias("captions"))
    return grouped.select(F.concat(F.lit("textvqa/train_images/"), "image_id", F.lit(".jpg")).alias("image_path"), "image_id", F.lit("textcaps").alias("image_source"), "captions")


@source("vsr")
def vsr(spark: SparkSession, root: str) -> DataFrame:
    rows = numbered(spark.read.schema("image string, caption string").json(f"{root}/vsr/all_vsr_validated_data.jsonl")).withColumn("image_id", F.substring_index("image", ".", 1))
    grouped = rows.groupBy("image_id").agg(in_order(F.col("caption"), "pos").alias("captions"))
    return grouped.select(coco_path(F.col("image_id")).alias("image_path"), "image_id", F.lit("coco/train2017").alias("image_source"), "captions")


# Folder of the pictures and file of each part of the collection.
NARRATIVES = {"coco/train2017": "coco_train_captions.jsonl", "flickr30k": "flickr30k_train_captions.jsonl", "open_images": "open_images_train_v6_captions.jsonl", "ade20k": "ade20k_train_captions.jsonl"}


@source("localized_narratives")
def localized_narratives(spark: SparkSession, root: str, parts: dict[str, str] | None = None) -> DataFrame:
    out = None
    for group, name in (parts or NARRATIVES).items():
        rows = numbered(spark.read.schema("image_id string, caption string").json(f"{root}/localized_narratives/{name}"))
        rows = rows.groupBy("image_id").agg(in_order(F.col("caption"), "pos").alias("captions"))
        rows = rows.select(F.concat(F.lit(f"{group}/"), pad(F.col("image_id")), F.lit(".jpg")).alias("image_path"), "image_id", F.lit(group).alias("image_source"), "captions")
        out = rows if out is None else out.unionByName(rows)
    return out


@source("flickr")
def flickr(spark: SparkSession, root: str) -> DataFrame:
    """Lines ``name | number | caption`` after a heading; no quoting, lines with fewer parts are left out."""
    lines = numbered(spark.read.text(f"{root}/flickr/results.csv")).where("pos > 0").withColumn("p", F.transform(F.split("value", r"\|"), lambda t: F.trim(t))).where("size(p) >= 3")
    grouped = lines.groupBy(F.col("p")[0].alias("image_id")).agg(in_order(F.col("p")[2], "pos").alias("captions"))
    return grouped.select(F.concat(F.lit("flickr30k/"), "image_id").alias("image_path"), "image_id", F.lit("flickr30k").alias("image_source"), "captions")


def read_csv(spark: SparkSession, path: str, needed: tuple[str, ...]) -> DataFrame:
    """A CSV file with a heading that has the needed columns; values are texts, quotes are doubled."""
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    missing = [c for c in needed if c not in rows.columns]
    if missing:
        raise ValueError(f"{path} lacks the columns {', '.join(missing)}")
    return numbered(rows)


@source("image2paragraph")
def image2paragraph(spark: SparkSession, root: str) -> DataFrame:
    """Paragraphs of the training part; rows whose address names no known folder are left out."""
    rows = read_csv(spark, f"{root}/image2paragraph/stanford_df_rectified.csv", ("train", "url", "Paragraph")).where(F.lower("train") == "true")
    folder = F.when(F.col("url").contains("VG_100K_2"), "vg/VG_100K_2/").when(F.col("url").contains("VG_100K"), "vg/VG_100K/")
    rows = rows.withColumn("image_path", F.concat(folder, _base(F.col("url")))).where("image_path is not null")
    return rows.groupBy("image_path").agg(in_order(F.col("Paragraph"), "pos").alias("captions")).select("image_path", _base(F.col("image_path")).alias("image_id"), F.lit("vg").alias("image_source"), "captions")


@source("conceptual_captions")
def conceptual_captions(spark: SparkSession, root: str) -> DataFrame:
    rows = json_map(spark, f"{root}/conceptual_captions/metadata.json", "struct<caption string, labels array<string>, url string, status int>").select("key", "value.*").where("status is null or status = 200")
    captions = F.array("caption", F.concat(F.lit("In this image you can find "), F.array_join("labels", ", ")))
    return rows.select(F.concat(F.lit("conceptual_captions/images/"), "key").alias("image_path"), F.col("key").alias("image_id"), F.lit("conceptual_captions").alias("image_source"), F.array_compact(captions).alias("captions"))


def download_name(folder: Column, row: Column, url: Column) -> Column:
    """Name of the file of a downloaded picture: its row and the checksum of its address."""
    return F.concat(folder, F.lit("/"), row.cast("string"), F.lit("_"), F.crc32(url).cast("string"))


@source("visual_news")
def visual_news(spark: SparkSession, root: str) -> DataFrame:
    rows = numbered(json_rows(spark, f"{root}/visual_news/origin/data.json", "id string, source string, image_path string, topic string, article_path string, caption string"))
    parts = F.split("image_path", "/")
    path = F.concat(F.lit("visual_news/"), "source", F.lit("/images/"), F.element_at(parts, -2), F.lit("/"), F.element_at(parts, -1))
    grouped = rows.withColumn("p", path).groupBy("p").agg(F.min_by(F.struct("id", "topic", "source", "article_path"), "pos").alias("f"), in_order(F.when(F.col("caption") != "", F.col("caption")), "pos").alias("captions"))
    about = F.create_map(F.lit("topic"), "f.topic", F.lit("source"), "f.source", F.lit("article_path"), "f.article_path")
    return grouped.select(F.col("p").alias("image_path"), F.col("f.id").alias("image_id"), F.lit("visual_news").alias("image_source"), "captions", about.alias("metadata"))


@source("image_editing_request")
def image_editing_request(spark: SparkSession, root: str) -> DataFrame:
    rows = read_csv(spark, f"{root}/image_editing_request/metadata.csv", ("image_path", "uid", "instruction", "original_filename", "edited_filename"))
    about = F.create_map(F.lit("original_filename"), "original_filename", F.lit("edited_filename"), "edited_filename")
    return rows.groupBy("image_path").agg(last_by(F.struct(F.col("uid").alias("image_id"), _one(F.col("instruction")).alias("captions"), about.alias("metadata")), "pos").alias("r")).select("image_path", "r.*", F.lit("image_editing_request").alias("image_source"))


@source("levir_cc")
def levir_cc(spark: SparkSession, root: str) -> DataFrame:
    rows = read_csv(spark, f"{root}/levir_cc/metadata.csv", ("image_path", "captions", "split", "change_flag", "image_id"))
    said = F.transform(F.from_json("captions", "array<string>"), lambda t: F.trim(t))
    about = F.create_map(F.lit("split"), "split", F.lit("change_flag"), "change_flag")
    return rows.select("image_path", "image_id", F.lit("levir_cc").alias("image_source"), said.alias("captions"), about.alias("metadata"), "split")


@source("mm_spot_diff")
def mm_spot_diff(spark: SparkSession, root: str) -> DataFrame:
    """The first text of each side of a conversation, with a question of ours where there is none."""
    rows = read_csv(spark, f"{root}/mm_spot_diff/metadata.csv", ("image_path", "conversation", "split"))
    rows = rows.withColumn("c", F.from_json("conversation", "array<struct<role string, data string, modality string>>"))
    first = lambda role: F.get(F.filter("c", lambda x: (x["role"] == role) & (x["modality"] == "text")), F.lit(0))["data"]
    text = F.concat(F.lit("Question: "), F.coalesce(first("user"), F.lit("What are the differences between these images?")), F.lit(" Answer: "), F.coalesce(first("assistant"), F.lit("")))
    return rows.select("image_path", _base(F.col("image_path")).alias("image_id"), F.lit("mm_spot_diff").alias("image_source"), F.array(text).alias("qa"), "split")


# Boxes


def _referring(name: str) -> None:
    @source(name)
    def adapter(spark: SparkSession, root: str) -> DataFrame:
        """Every caption of an entry is a label of its box, whose corners are in pixels."""
        rows = numbered(json_rows(spark, f"{root}/{name}/{name}.json", "image_id string, raw_image_info string, image_path string, bbox array<double>, captions array<string>"))
        rows = rows.withColumn("size", F.from_json("raw_image_info", "width double, height double"))
        part = lambda i, side: F.try_divide(F.col("bbox")[i], F.col(f"size.{side}"))
        boxes = F.transform("captions", lambda c: box(c, part(0, "width"), part(1, "height"), part(2, "width"), part(3, "height")))
        path = F.concat(F.lit("coco/train2017/"), F.substring_index("image_path", "_", -1))
        grouped = rows.groupBy(path.alias("image_path")).agg(F.min_by("image_id", "pos").alias("image_id"), F.flatten(in_order(boxes, "pos")).alias("bboxes"))
        return grouped.withColumn("image_source", F.lit(name))


for _name in ("refcoco", "refcocoplus", "refcocog"):
    _referring(_name)


def _word_boxes(words: Column) -> Column:
    """Boxes of ``[text, x1, y1, x2, y2]``, the numbers perhaps in texts; shorter entries are left out."""
    n = lambda w, i: w[i].try_cast("double")
    return F.transform(F.filter(words, lambda w: F.size(w) >= 5), lambda w: box(w[0], n(w, 1), n(w, 2), n(w, 3), n(w, 4)))


@source("docowl")
def docowl(spark: SparkSession, root: str) -> DataFrame:
    rows = json_map(spark, f"{root}/docowl/ocr_results.json", "array<array<string>>")
    return rows.select(F.col("key").alias("image_path"), _stem(F.col("key")).alias("image_id"), F.lit("docowl").alias("image_source"), _word_boxes(F.col("value")).alias("bboxes"))


@source("llavar")
def llavar(spark: SparkSession, root: str) -> DataFrame:
    words = spark.read.schema("llavar_id string, ocr_results array<array<string>>").json(f"{root}/llavar/llavar_ocr_results.jsonl")
    about = json_rows(spark, f"{root}/llavar/finetune_meta.json", "llavar_id string, TEXT string, WIDTH int, HEIGHT int").dropDuplicates(["llavar_id"])
    rows = words.join(about, "llavar_id", "left")
    return rows.select(F.concat(F.lit("llavar/llavar_images/"), "llavar_id").alias("image_path"), F.col("llavar_id").alias("image_id"), F.lit("llavar").alias("image_source"), _one(F.col("TEXT")).alias("captions"), _word_boxes(F.col("ocr_results")).alias("bboxes"), F.col("WIDTH").alias("width"), F.col("HEIGHT").alias("height"))


@source("ocr_vqa")
def ocr_vqa(spark: SparkSession, root: str) -> DataFrame:
    """Book covers: words as boxes (entries without a full box are left out), title, author and genre as captions."""
    rows = json_rows(spark, f"{root}/ocr_vqa/data.json", "image_id string, image_path string, title string, authorName string, genre string, image_width double, image_height double, ocr_info array<struct<word string, bounding_box struct<x double, y double, width double, height double>>>, questions array<string>, answers array<string>")
    b = lambda o, f: o["bounding_box"][f]
    whole = lambda o: o["word"].isNotNull() & b(o, "x").isNotNull() & b(o, "y").isNotNull() & b(o, "width").isNotNull() & b(o, "height").isNotNull()
    boxes = F.transform(F.filter("ocr_info", whole), lambda o: box_xywh(o["word"], b(o, "x"), b(o, "y"), b(o, "width"), b(o, "height"), F.col("image_width"), F.col("image_height")))
    some = lambda label, c: F.when(F.col(c) != "", F.concat(F.lit(f"{label}: "), c))
    captions = F.array_compact(F.array(some("Title", "title"), some("Author", "authorName"), some("Genre", "genre")))
    n = F.least(F.size("questions"), F.size("answers"))
    qa = F.transform(F.slice(F.arrays_zip("questions", "answers"), F.lit(1), F.greatest(n, F.lit(0))), lambda z: F.concat_ws(" ", z["questions"], z["answers"]))
    return rows.select("image_path", "image_id", F.lit("ocr_vqa").alias("image_source"), captions.alias("captions"), boxes.alias("bboxes"), qa.alias("qa"))


@source("hrrsd")
def hrrsd(spark: SparkSession, root: str) -> DataFrame:
    """Boxes by file, relative to the size in the file's first row."""
    rows = read_csv(spark, f"{root}/hrrsd/Annotations.csv", ("filename", "width", "height", "xmin", "ymin", "xmax", "ymax", "class"))
    first = rows.groupBy("filename").agg(F.min_by(F.struct("width", "height"), "pos").alias("s"))
    part = lambda c, side: F.try_divide(F.col(c).try_cast("double"), F.col(f"s.{side}").try_cast("double"))
    boxes = in_order(box(F.col("class"), part("xmin", "width"), part("ymin", "height"), part("xmax", "width"), part("ymax", "height")), "pos")
    grouped = rows.drop("width", "height").join(first, "filename").groupBy("filename").agg(boxes.alias("bboxes"))
    return grouped.select(F.concat(F.lit("hrrsd/JpegImages/"), "filename").alias("image_path"), F.col("filename").alias("image_id"), F.lit("hrrsd").alias("image_source"), F.array(F.lit("An aerial image.")).alias("captions"), "bboxes")


@source("dior_rsvg")
def dior_rsvg(spark: SparkSession, root: str) -> DataFrame:
    """Category and caption of each box as labels of their own; without captions there are no boxes."""
    rows = json_rows(spark, f"{root}/dior_rsvg/data.json", "image_path string, image_id string, width double, height double, objects struct<bbox array<array<double>>, categories array<string>, captions array<string>>")
    n = F.least(F.size("objects.bbox"), F.size("objects.categories"), F.size("objects.captions"))
    zipped = F.slice(F.arrays_zip(F.col("objects.bbox").alias("b"), F.col("objects.categories").alias("k"), F.col("objects.captions").alias("c")), F.lit(1), F.greatest(n, F.lit(0)))
    part = lambda z, i, side: F.try_divide(z["b"][i], F.col(side))
    one = lambda label, z: box(label, part(z, 0, "width"), part(z, 1, "height"), part(z, 2, "width"), part(z, 3, "height"))
    boxes = F.flatten(F.transform(zipped, lambda z: F.array(one(z["k"], z), one(z["c"], z))))
    return rows.select("image_path", "image_id", F.lit("dior_rsvg").alias("image_source"), boxes.alias("bboxes"))


def _remote(name: str, file_name: str) -> None:
    @source(name)
    def adapter(spark: SparkSession, root: str) -> DataFrame:
        """Cells of captions, of which the last of a picture also names its file after a tab: the name holds for the cells before it."""
        lines = numbered(spark.read.option("escape", '"').option("multiLine", True).csv(f"{root}/{name}/{file_name}"))
        cells = lines.select("pos", F.posexplode(F.array(*[F.col(c) for c in lines.columns if c != "pos"])).alias("k", "cell")).where("cell is not null")
        cells = cells.groupBy("pos").agg(F.sort_array(F.collect_list(F.struct("k", "cell")), asc=False).alias("row"))
        # from the last cell to the first: (name so far, cells with their names)
        start = F.struct(_no_text().alias("name"), F.array().cast("array<struct<name string, caption string, k int>>").alias("out"))

        def step(acc: Column, x: Column) -> Column:
            parts = F.split(x["cell"], "\t")
            named = F.coalesce(F.get(parts, F.lit(1)), acc["name"])
            return F.struct(named.alias("name"), F.concat(acc["out"], F.array(F.struct(named.alias("name"), F.regexp_replace(parts[0], r" \.$", ".").alias("caption"), x["k"].alias("k")))).alias("out"))

        rows = cells.select("pos", F.explode(F.aggregate("row", start, step)["out"]).alias("r")).select("pos", "r.*").where("name is not null")
        texts = F.array_distinct(F.concat(F.array(F.lit("An aerial image.")), F.transform(in_order(F.col("caption"), "pos", "k"), lambda t: F.trim(t))))
        return rows.groupBy(F.col("name").alias("image_id")).agg(texts.alias("captions")).select(F.concat(F.lit(f"{name}/images/"), "image_id").alias("image_path"), "image_id", F.lit(name).alias("image_source"), "captions")


_remote("remoteclip_det10", "Det-10.csv")
_remote("remoteclip_ret3", "Ret-3_train.csv")
