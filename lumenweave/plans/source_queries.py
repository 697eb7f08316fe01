"""Queries over the adapters: annotations are laid out as the files of a collection, read by its adapter, and compared with SQL.

A row is a canonical row with its lists as text. Pictures are told by ``ann_id % 400``, so most have several entries.
"""

from __future__ import annotations

import functools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import catalog
from ..session import shared_dir, table
from ..sources.records import REGISTRY

Put = Callable[[DataFrame, str], None]


def _S(name: str) -> Column:
    return F.col(name).cast("string")


def _k() -> Column:
    return F.col("k")


def _t() -> Column:
    return F.col("t")


def _q() -> Column:
    return F.concat(F.lit("Q"), _S("k"), F.lit("?"))


def _box() -> Column:
    return F.array(_k() % 5, _k() % 7, _k() % 5 + 10, _k() % 7 + 20).cast("array<double>")


def _base(spark: SparkSession, d: str) -> DataFrame:
    """``(k, g, t)``: record, picture, and the first caption that isn't null."""
    rows = catalog.records(table(spark, d, "annotations").select("ann_id", "captions", "loaded_at"), "ann_id", "loaded_at")
    first = F.coalesce(F.get(F.filter("captions", lambda c: c.isNotNull()), F.lit(0)), F.lit("none"))
    return rows.select(F.col("ann_id").alias("k"), (F.col("ann_id") % 400).alias("g"), first.alias("t"))


def _json(rows: DataFrame, **fields: Column) -> DataFrame:
    """Entries ``(k, j)`` of a file, in the order of ``k``."""
    return rows.select("k", F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()])).alias("j"))


def _listed(entries: DataFrame) -> Column:
    return F.concat(F.lit("["), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "j"))), lambda e: e["j"]), ","), F.lit("]"))


def _array(entries: DataFrame, path: str) -> None:
    entries.agg(_listed(entries).alias("value")).coalesce(1).write.text(path)


def _object(path: str, **parts: DataFrame) -> None:
    """One object whose fields are arrays of entries."""
    out = None
    for name, entries in parts.items():
        one = entries.agg(F.concat(F.lit(f'"{name}":'), _listed(entries)).alias(name))
        out = one if out is None else out.crossJoin(one)  # one row each
    out.select(F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}")).alias("value")).coalesce(1).write.text(path)


def _map(entries: DataFrame, key: Column, path: str) -> None:
    """One object with an entry for each key."""
    ends = entries.sparkSession.createDataFrame([(0, "{"), (2, "}")], "o int, j string").select("o", F.lit(None).cast("bigint").alias("k"), "j")
    rows = entries.select(F.lit(1).alias("o"), F.col("k").cast("bigint").alias("k"), F.concat(F.lit('"'), key, F.lit('":'), "j").alias("j")).unionByName(ends)
    rows = rows.repartition(1).sortWithinPartitions("o", "k", "j").withColumn("n", F.monotonically_increasing_id())
    # the first row is the brace, the next one has no comma
    rows.select(F.concat(F.when((F.col("o") == 1) & (F.col("n") > 1), ",").otherwise(""), "j").alias("value")).write.text(path)


def _lines(entries: DataFrame, path: str) -> None:
    entries.repartition(1).sortWithinPartitions("k").select(F.col("j").alias("value")).write.text(path)


def _csv(rows: DataFrame, path: str, header: bool = True) -> None:
    rows.repartition(1).sortWithinPartitions("k").drop("k").write.option("header", header).option("quoteAll", True).option("escape", '"').csv(path)


def _arr(*items: Column) -> Column:
    return F.array(*items)




def _vsr(b: DataFrame, at: str) -> None:
    _lines(_json(b, image=F.concat(_S("g"), F.lit(".jpg")), caption=_t()), f"{at}/all_vsr_validated_data.jsonl")


def _narratives(b: DataFrame, at: str) -> None:
    for i, name in enumerate(("coco", "flickr30k", "open_images", "ade20k")):
        part = {"coco": "coco_train", "flickr30k": "flickr30k_train", "open_images": "open_images_train_v6", "ade20k": "ade20k_train"}[name]
        _lines(_json(b.where(_k() % 4 == i), image_id=_S("g"), caption=_t()), f"{at}/{part}_captions.jsonl")


def _st_vqa(b: DataFrame, at: str) -> None:
    _array(_json(b, image_path=F.concat(F.lit("p/"), _S("k")), image_id=_S("k"), qas=_arr(F.struct(_q().alias("question"), _arr(_t(), F.lit("b")).alias("answers")))), f"{at}/data.json")


def _documents(b: DataFrame, at: str) -> None:
    words = {"words": _arr(F.lit("w"), F.lit("v")), "word_boxes": _arr(_box(), F.slice(_box(), 1, 2))}
    _array(_json(b, image_path=F.concat(F.lit("d/"), _S("g"), F.lit(".png")), image_id=_S("g"), query=F.struct(F.when(_k() % 3 == 0, " ").otherwise(_q()).alias("en")), question=F.concat(F.lit(" "), _q()), answers=_arr(F.lit("yes"), F.lit("no")), **words), f"{at}/data.json")


def _chart_qa(b: DataFrame, at: str) -> None:
    _array(_json(b, image=F.base64(F.encode(F.concat(F.lit("picture "), _S("g")), "utf-8")), query=_q(), label=_arr(_t(), F.lit("x"))), f"{at}/data.json")


def _visualmrc(b: DataFrame, at: str) -> None:
    said = lambda role, text, kind="text": F.struct(F.lit(role).alias("role"), text.alias("data"), F.lit(kind).alias("modality"))
    _array(_json(b, image_path=F.concat(F.lit("p/"), _S("k")), image_id=_S("k"), conversation=_arr(said("user", F.lit("x"), "image"), said("user", _q()), said("assistant", F.lit("A ")), said("user", F.lit("R?")), said("assistant", F.when(_k() % 2 == 0, "B").otherwise(" ")))), f"{at}/data.json")


def _tallyqa(b: DataFrame, at: str) -> None:
    image = F.when(_k() % 3 == 0, F.concat(F.lit("train2014/COCO_train2014_"), _S("g"), F.lit(".jpg"))).when(_k() % 3 == 1, F.concat(F.lit("val2014/"), _S("g"))).otherwise(F.concat(F.lit("VG_100K/"), _S("g"), F.lit(".jpg")))
    _array(_json(b, image=image, image_id=_S("g"), question=F.lit("How many cups are on the table?"), answer=(_k() % 4).cast("int")), f"{at}/train.json")


def _a_ok_vqa(b: DataFrame, at: str) -> None:
    _array(_json(b, image_id=F.col("g"), question=_q(), choices=_arr(F.lit("a"), F.lit("b"), F.lit("c")), correct_choice_idx=(_k() % 3).cast("int"), rationales=_arr(F.lit("r\nx"), _S("k"))), f"{at}/aokvqa_v1p0_train.json")


def _ok_vqa(b: DataFrame, at: str) -> None:
    _object(f"{at}/OpenEnded_mscoco_train2014_questions.json", questions=_json(b, question_id=_k(), image_id=F.col("g"), question=_q()))
    votes = F.array(*[F.struct(a.alias("answer")) for a in (F.lit("b"), F.lit("a"), F.when(_k() % 2 == 0, "a").otherwise("b"), F.lit("a"), F.lit("b"))])
    _object(f"{at}/mscoco_train2014_annotations.json", annotations=_json(b.where(_k() % 5 != 0), question_id=_k(), answers=votes))


def _vqa_v2(b: DataFrame, at: str) -> None:
    _object(f"{at}/v2_OpenEnded_mscoco_train2014_questions.json", questions=_json(b, question_id=_k(), question=_q()))
    _object(f"{at}/v2_mscoco_train2014_annotations.json", annotations=_json(b, question_id=_k(), image_id=F.col("g"), multiple_choice_answer=_t()))


def _vqa_e(b: DataFrame, at: str) -> None:
    answers = F.when(_k() % 3 == 0, F.when(_k() % 2 == 0, _arr(F.lit("Yes"), F.lit("no"))).otherwise(_arr(F.lit("Yes"), F.lit("yes")))).when(_k() % 3 == 1, _arr(F.lit("2"), F.lit("3"), F.lit("x"), F.lit("3"))).otherwise(_arr(F.lit("red"), F.lit("blue")))
    kind = F.when(_k() % 3 == 0, "yes/no").when(_k() % 3 == 1, "number").otherwise("other")
    _array(_json(b, img_id=F.col("g"), question=_q(), answers=answers, answer_type=kind, explanation=_arr(F.lit("e"), F.lit("f"))), f"{at}/VQA-E_train_set.json")


def _text_vqa(b: DataFrame, at: str) -> None:
    _object(f"{at}/TextVQA_0.5.1_train.json", data=_json(b, image_id=_S("g"), question=_q(), answers=_arr(F.lit("b"), F.lit("a"), F.lit("a")), image_classes=_arr(F.lit("Car"), _S("k"))))


def _textcaps(b: DataFrame, at: str) -> None:
    tokens = _arr(_arr(F.lit("<s>"), F.lit("stop"), _S("k"), F.lit("</s>")), _arr(F.lit("stop"), _S("k")), _arr(F.lit("go")))
    _object(f"{at}/TextCaps_0.1_train.json", data=_json(b, image_id=_S("g"), caption_str=_t(), reference_strs=_arr(F.lit("r")), reference_tokens=tokens))


def _scienceqa(b: DataFrame, at: str) -> None:
    _map(_json(b, split=F.when(_k() % 4 == 0, "val").otherwise("train"), image=F.when(_k() % 5 != 0, "image.png"), question=_q(), choices=_arr(F.lit("x"), F.lit("y")), answer=(_k() % 2).cast("int"), solution=F.lit("s"), lecture=F.when(_k() % 3 == 0, "").otherwise("l"), subject=F.lit("n"), category=F.lit(""), skill=F.lit("u")), _S("k"), f"{at}/problems.json")


def _conceptual(b: DataFrame, at: str) -> None:
    _map(_json(b, caption=_t(), labels=_arr(F.lit("a"), F.lit("b")), status=F.when(_k() % 3 == 0, 404).otherwise(200)), F.concat(_S("k"), F.lit(".jpg")), f"{at}/metadata.json")


def _visual_news(b: DataFrame, at: str) -> None:
    _array(_json(b, id=_S("k"), source=F.lit("s"), image_path=F.concat(F.lit("./s/images/0001/"), _S("g"), F.lit(".jpg")), topic=F.lit("t"), article_path=F.lit("a"), caption=F.when(_k() % 3 == 0, "").otherwise(_t())), f"{at}/origin/data.json")


def _referring(name: str) -> Callable[[DataFrame, str], None]:
    def write(b: DataFrame, at: str) -> None:
        _array(_json(b, image_id=_S("g"), raw_image_info=F.to_json(F.struct(F.lit(50).alias("width"), F.lit(80).alias("height"))), image_path=F.concat(F.lit("COCO_train2014_"), _S("g"), F.lit(".jpg")), bbox=_box(), captions=_arr(_S("k"), F.lit("b"))), f"{at}/{name}.json")

    return write


def _ocr_vqa(b: DataFrame, at: str) -> None:
    spot = lambda *fields: F.struct(*[F.lit(float(v)).alias(n) for n, v in zip(("x", "y", "width", "height"), fields)])
    part = F.struct(F.lit(1.0).alias("x"), *[F.lit(None).cast("double").alias(n) for n in ("y", "width", "height")])
    words = _arr(F.struct(_S("k").alias("word"), spot(1, 2, 10, 20).alias("bounding_box")), F.struct(F.lit("v").alias("word"), part.alias("bounding_box")))
    _array(_json(b, image_id=_S("k"), image_path=F.concat(F.lit("o/"), _S("k")), title=_S("k"), authorName=F.lit(""), genre=F.lit("G"), image_width=F.lit(50), image_height=F.lit(80), ocr_info=words, questions=_arr(_q(), F.lit("R?")), answers=_arr(F.lit("A"))), f"{at}/data.json")


def _dior(b: DataFrame, at: str) -> None:
    objects = F.struct(_arr(_box()).alias("bbox"), _arr(F.lit("ship")).alias("categories"), F.when(_k() % 2 == 0, _arr(_S("k"))).otherwise(F.array().cast("array<string>")).alias("captions"))
    _array(_json(b, image_path=F.concat(F.lit("r/"), _S("k")), image_id=_S("k"), width=F.lit(50), height=F.lit(80), objects=objects), f"{at}/data.json")


def _docowl(b: DataFrame, at: str) -> None:
    words = F.concat(F.lit('[["w'), _S("k"), F.lit('",0.1,"0.2",0.5,0.75],["short",1]]'))
    _map(b.select("k", words.alias("j")), F.concat(F.lit("d/"), _S("k"), F.lit(".png")), f"{at}/ocr_results.json")


def _llavar(b: DataFrame, at: str) -> None:
    _lines(b.select("k", F.concat(F.lit('{"llavar_id":"'), _S("k"), F.lit('","ocr_results":[["w",0,0,1,0.5]]}')).alias("j")), f"{at}/llavar_ocr_results.jsonl")
    _array(_json(b.where(_k() % 2 == 0), llavar_id=_S("k"), TEXT=_S("g"), WIDTH=F.lit(5), HEIGHT=F.lit(6)), f"{at}/finetune_meta.json")


def _hrrsd(b: DataFrame, at: str) -> None:
    side = lambda n: F.lit(n) + F.when(_k() < 400, 0).otherwise(1)  # the size of the first row holds
    _csv(b.select("k", F.concat(_S("g"), F.lit(".jpg")).alias("filename"), side(50).alias("width"), side(80).alias("height"), *[F.get(_box(), F.lit(i)).alias(c) for i, c in enumerate(("xmin", "ymin", "xmax", "ymax"))], F.lit("ship").alias("class")), f"{at}/Annotations.csv")


def _levir(b: DataFrame, at: str) -> None:
    _csv(b.select("k", F.concat(F.lit("l/"), _S("k")).alias("image_path"), F.to_json(_arr(F.concat(F.lit(" "), _S("g"), F.lit(" ")), F.lit("b"))).alias("captions"), F.lit("train").alias("split"), F.lit("1").alias("change_flag"), _S("k").alias("image_id")), f"{at}/metadata.csv")


def _editing(b: DataFrame, at: str) -> None:
    _csv(b.select("k", F.concat(F.lit("e/"), _S("g")).alias("image_path"), _S("k").alias("uid"), F.concat(F.lit("do "), _S("k")).alias("instruction"), F.lit("o").alias("original_filename"), F.lit("e").alias("edited_filename")), f"{at}/metadata.csv")


def _spot_diff(b: DataFrame, at: str) -> None:
    said = F.concat(F.lit('[{"role":"assistant","data":"'), _S("k"), F.lit('","modality":"text"}]'))
    _csv(b.select("k", F.concat(F.lit("s/"), _S("k")).alias("image_path"), said.alias("conversation"), F.lit("train").alias("split")), f"{at}/metadata.csv")


def _flickr(b: DataFrame, at: str) -> None:
    head = b.limit(1).select(F.lit(-1).cast("bigint").alias("k"), F.lit("image_name| comment_number| comment").alias("j"))
    line = F.when(_k() % 5 == 0, F.concat(_S("g"), F.lit(".jpg| 1"))).otherwise(F.concat(_S("g"), F.lit(".jpg| 1| a \"dog\" "), _S("k")))
    _lines(head.unionByName(b.select("k", line.alias("j"))), f"{at}/results.csv")


def _paragraph(b: DataFrame, at: str) -> None:
    folder = F.when(_k() % 3 == 0, "other").when(_k() % 3 == 1, "VG_100K").otherwise("VG_100K_2")
    _csv(b.select("k", F.when(_k() % 5 == 0, "False").otherwise("True").alias("train"), F.concat(F.lit("http://x/"), folder, F.lit("/"), _S("g"), F.lit(".jpg")).alias("url"), F.concat(F.lit('One, "two" '), _S("k")).alias("Paragraph")), f"{at}/stanford_df_rectified.csv")


def _coco(year: str, prefix: str) -> Callable[[DataFrame, str], None]:
    def write(b: DataFrame, at: str) -> None:
        images = _json(b.groupBy("g").agg(F.min("k").alias("k")), id=F.col("g"), file_name=F.concat(F.lit(prefix), _S("g"), F.lit(".jpg")), width=F.lit(50), height=F.lit(80))
        _object(f"{at}/annotations/captions_train{year}.json", images=images, annotations=_json(b.where(_k() % 2 == 0), image_id=F.col("g"), caption=_t()))
        names = _json(b.where(_k() == _first_key(b)), id=F.lit(7), name=F.lit("cat"))
        _object(f"{at}/annotations/instances_train{year}.json", images=images, categories=names, annotations=_json(b, image_id=F.col("g"), category_id=F.when(_k() % 3 == 0, 9).otherwise(7), bbox=_box()))

    return write


def _first_key(b: DataFrame) -> Column:
    return F.lit(b.agg(F.min("k")).first()[0])


def _lvis(b: DataFrame, at: str) -> None:
    images = _json(b.groupBy("g").agg(F.min("k").alias("k")), id=F.col("g"), coco_url=F.concat(F.lit("http://x/train2017/"), _S("g"), F.lit(".jpg")), width=F.lit(50), height=F.lit(80), neg_category_ids=_arr(F.lit(3)))
    names = b.limit(1).select(F.explode(_arr(*[F.struct(F.lit(i).alias("k"), F.lit(n).alias("n")) for i, n in ((1, "tea_cup"), (2, "dog"), (3, "owl"))])).alias("c")).select("c.*")
    _object(f"{at}/lvis_v1_train.json", images=images, categories=_json(names, id=F.col("k"), name=F.col("n")), annotations=_json(b, image_id=F.col("g"), category_id=_k() % 2 + 1, bbox=_box()))


def _gqa(b: DataFrame, at: str) -> None:
    one = F.to_json(F.struct(F.when(_k() % 3 == 0, "cat").otherwise("apple").alias("name"), *[F.get(_sized(), F.lit(i)).alias(c) for i, c in enumerate("xywh")], _arr(F.lit("old")).alias("attributes"), _arr(F.struct(F.lit("near").alias("name"), _S("k").alias("object")), F.struct(F.lit("on").alias("name"), F.lit("lost").alias("object"))).alias("relations")))
    entries = b.select("k", "g", F.concat(F.lit('"'), _S("k"), F.lit('":'), one).alias("j"))
    objects = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "j"))), lambda e: e["j"]), ",")
    graphs = entries.groupBy("g").agg(F.min("k").alias("k"), F.concat(F.lit('{"width":50,"height":80,"objects":{'), objects, F.lit("}}")).alias("j"))
    _map(graphs.select("k", "j", "g"), _S("g"), f"{at}/train_sceneGraphs.json")
    _map(_json(b, imageId=_S("g"), question=_q(), fullAnswer=_t()), _S("k"), f"{at}/train_balanced_questions.json")


def _sized() -> Column:
    return F.array(_k() % 5, _k() % 7, _k() % 5 + 10, _k() % 7 + 20).cast("array<double>")


def _genome_images(b: DataFrame, at: str) -> None:
    """Pictures with an even number are in COCO, the others are files."""
    root, spark = at.rsplit("/", 1)[0], b.sparkSession
    pictures = b.groupBy("g").agg(F.min("k").alias("k"))
    _array(_json(pictures, image_id=F.col("g"), coco_id=F.when(F.col("g") % 2 == 0, F.col("g") + 1000), width=F.lit(50), height=F.lit(80)), f"{root}/visual_genome/image_data.json")
    _object(f"{root}/coco_captions/annotations/instances_train2017.json", images=_json(pictures, id=F.col("g") + 1000, file_name=F.concat(_S("g"), F.lit(".jpg"))))
    for folder, numbers in (("VG_100K", range(1, 400, 2)), ("VG_100K_2", range(1000, 1002))):
        path = spark._jvm.org.apache.hadoop.fs.Path
        files = path(root).getFileSystem(spark._jsc.hadoopConfiguration())
        for n in numbers:
            file = files.create(path(f"{root}/images/vg/{folder}/{n}.jpg"))
            file.write(0)  # a file without a byte is not listed
            file.close()


def _genome(b: DataFrame, at: str) -> None:
    _genome_images(b, at)

    def nested(name: str, entry: Column) -> None:
        rows = b.groupBy("g").agg(F.min("k").alias("k"), F.transform(F.sort_array(F.collect_list(F.struct("k", entry.alias("e")))), lambda x: x["e"]).alias("all"))
        _array(_json(rows, image_id=F.col("g"), **{name: F.col("all")}), f"{at}/{name}.json")

    nested("objects", F.struct(_k().alias("object_id"), _arr(F.concat(F.lit("n"), _S("k")), F.lit("other")).alias("names"), *[F.get(_sized(), F.lit(i)).alias(c) for i, c in enumerate("xywh")]))
    nested("attributes", F.struct(_k().alias("object_id"), _arr(F.lit("old"), F.lit("big"), F.lit("old")).alias("attributes")))
    nested("relationships", F.struct(F.lit("ON").alias("predicate"), F.struct(_k().alias("object_id")).alias("subject"), F.struct(_arr(F.lit("mat")).alias("names")).alias("object")))


def _visual7w(b: DataFrame, at: str) -> None:
    _genome_images(b, at)
    pair = F.struct(_q().alias("question"), F.lit("Me.").alias("answer"), _arr(F.lit("You."), F.lit("He")).alias("multiple_choices"))
    _object(f"{at}/dataset_v7w_telling.json", images=_json(b, image_id=F.col("g"), split=F.when(_k() % 3 == 0, "val").otherwise("train"), qa_pairs=_arr(pair)))


def _remote(file_name: str) -> Callable[[DataFrame, str], None]:
    def write(b: DataFrame, at: str) -> None:
        _csv(b.select("k", F.concat(F.lit("one "), _S("k"), F.lit(" .")).alias("a"), F.concat(F.lit("two,"), _S("k"), F.lit(" .\t"), _S("g"), F.lit(".jpg")).alias("b")), f"{at}/{file_name}", False)

    return write


WRITERS = {
    "gqa": _gqa, "visual_genome": _genome, "visual7w": _visual7w, "remoteclip_det10": _remote("Det-10.csv"), "remoteclip_ret3": _remote("Ret-3_train.csv"),
    "vsr": _vsr, "localized_narratives": _narratives, "st_vqa": _st_vqa, "doc_vqa": _documents, "info_vqa": _documents, "chart_qa": _chart_qa, "mm_visualmrc": _visualmrc, "tallyqa": _tallyqa, "a_ok_vqa": _a_ok_vqa, "ok_vqa": _ok_vqa, "vqa_v2": _vqa_v2, "vqa_e": _vqa_e, "text_vqa": _text_vqa,
    "textcaps": _textcaps, "scienceqa": _scienceqa, "conceptual_captions": _conceptual, "visual_news": _visual_news, "refcoco": _referring("refcoco"), "refcocoplus": _referring("refcocoplus"), "refcocog": _referring("refcocog"), "ocr_vqa": _ocr_vqa, "dior_rsvg": _dior, "docowl": _docowl, "llavar": _llavar,
    "hrrsd": _hrrsd, "levir_cc": _levir, "image_editing_request": _editing, "mm_spot_diff": _spot_diff, "flickr": _flickr, "image2paragraph": _paragraph, "coco_captions": _coco("2017", ""), "coco_captions_2014": _coco("2014", "COCO_train2014_"), "lvis": _lvis,
}


def read_source(spark: SparkSession, d: str, name: str) -> DataFrame:
    """Rows of one adapter over files that hold the annotations in the collection's layout."""
    root = f"{shared_dir(spark)}/sources-{uuid.uuid4().hex}"
    WRITERS[name](_base(spark, d), f"{root}/{name}")
    number = lambda c: (F.floor(c * 1e6 + 0.5) / 1e6).cast("decimal(18,6)").cast("string")
    boxes = F.transform("bboxes", lambda b: F.concat_ws(" ", b["label"], number(b["x1"]), number(b["y1"]), number(b["x2"]), number(b["y2"])))
    return REGISTRY[name](spark, root).select("image_path", "image_id", "image_source", F.array_join("captions", "|").alias("captions"), F.array_join("qa", "|").alias("qa"), F.array_join(boxes, "|").alias("boxes"))


QUERIES = {f"source_{name}": functools.partial(read_source, name=name) for name in WRITERS}
for _name, _query in QUERIES.items():
    _query.__name__, _query.__doc__ = _name, read_source.__doc__

_B = "b AS (SELECT ann_id AS k, ann_id % 400 AS g, coalesce(list_filter(captions, lambda x: x IS NOT NULL)[1], 'none') AS t, 'Q' || ann_id || '?' AS q FROM annotations WHERE ann_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY ann_id ORDER BY loaded_at DESC) = 1)"


def _place(label: str, width: int | None = 50, height: int | None = 80, size: bool = False) -> str:
    """SQL text of a box: ``label``, corners of the entry as shares of the size; ``size``: the last two numbers are a size."""
    x2, y2 = ("k % 5 + k % 5 + 10", "k % 7 + k % 7 + 20") if size else ("k % 5 + 10", "k % 7 + 20")
    return f"{label} || " + " || ".join(f"' ' || printf('%.6f', floor((({v}) / {n}::DOUBLE) * 1e6 + 0.5) / 1e6)" for v, n in (("k % 5", width), ("k % 7", height), (x2, width), (y2, height)))


def _rows(path: str, image_id: str, source: str, captions: str = "''", qa: str = "''", boxes: str = "''", where: str = "true", group: bool = True) -> str:
    listed = lambda text: f"coalesce(string_agg({text}, '|' ORDER BY k), '')" if group and text != "''" else text
    tail = " GROUP BY g" if group else ""
    return f"SELECT {path} AS image_path, {image_id} AS image_id, {source} AS image_source, {listed(captions)} AS captions, {listed(qa)} AS qa, {listed(boxes)} AS boxes FROM b WHERE {where}{tail}"


_G, _K = "g::VARCHAR", "k::VARCHAR"
_PAD = "lpad(g::VARCHAR, 12, '0') || '.jpg'"
_COCO = f"'coco/train2017/' || {_PAD}"


def _last(text: str, source: str) -> str:
    return f"SELECT {_COCO} AS image_path, {_G} AS image_id, '{source}' AS image_source, '' AS captions, arg_max({text}, k) AS qa, '' AS boxes FROM b GROUP BY g"


def _narrative(i: int, group: str) -> str:
    return _rows(f"'{group}/' || {_PAD}", _G, f"'{group}'", "t", where=f"k % 4 = {i}")


_referred = lambda name: _rows("'coco/train2017/' || g || '.jpg'", _G, f"'{name}'", boxes=f"{_place(_K)} || '|' || {_place(chr(39) + 'b' + chr(39))}")
_coco_rows = lambda source: _rows("'coco/train2017/' || g || '.jpg'", _G, f"'{source}'", "CASE WHEN k % 2 = 0 THEN t END", boxes=_place("CASE WHEN k % 3 = 0 THEN 'unknown' ELSE 'cat' END", size=True))

_GENOME = "CASE WHEN g % 2 = 0 THEN 'coco/train2017/' ELSE 'vg/VG_100K/' END || g || '.jpg'"
_remote_rows = lambda name: f"SELECT '{name}/images/' || g || '.jpg' AS image_path, g || '.jpg' AS image_id, '{name}' AS image_source, 'An aerial image.|' || string_agg('one ' || k || '.|two,' || k || '.', '|' ORDER BY k) AS captions, '' AS qa, '' AS boxes FROM b GROUP BY g"

_SQL = {
    "gqa": f"SELECT 'gqa/images/' || g || '.jpg' AS image_path, g::VARCHAR AS image_id, 'gqa' AS image_source, '' AS captions, string_agg(q || ' ' || t, '|' ORDER BY k) AS qa, string_agg({_place('name', size=True)} || '|' || {_place(chr(39) + 'old' + chr(39), size=True)} || '|' || {_place(chr(39) + 'near ' + chr(39) + ' || CASE WHEN n = 1 THEN ' + chr(39) + 'the ' + chr(39) + ' WHEN name = ' + chr(39) + 'apple' + chr(39) + ' THEN ' + chr(39) + 'an ' + chr(39) + ' ELSE ' + chr(39) + 'a ' + chr(39) + ' END || name', size=True)}, '|' ORDER BY k) AS boxes"
    " FROM (SELECT *, CASE WHEN k % 3 = 0 THEN 'cat' ELSE 'apple' END AS name, count(*) OVER (PARTITION BY g, k % 3 = 0) AS n FROM b) GROUP BY g",
    "visual_genome": _rows(_GENOME, _G, "CASE WHEN g % 2 = 0 THEN 'coco' ELSE 'vg' END", boxes=" || '|' || ".join(_place(x, size=True) for x in ("'n' || k", "'big'", "'old'", "'on the mat'"))),
    "visual7w": _rows(_GENOME, _G, "CASE WHEN g % 2 = 0 THEN 'coco' ELSE 'vg' END", qa="q || ' me (not you, nor he)'", where="k % 3 != 0"),
    "remoteclip_det10": _remote_rows("remoteclip_det10"),
    "remoteclip_ret3": _remote_rows("remoteclip_ret3"),
    "vsr": _rows(_COCO, _G, "'coco/train2017'", "t"),
    "localized_narratives": " UNION ALL ".join(_narrative(i, g) for i, g in enumerate(("coco/train2017", "flickr30k", "open_images", "ade20k"))),
    "st_vqa": _rows("'p/' || k", _K, "'st_vqa'", qa="'Question: ' || q || ' Answer: ' || t || ', b'", group=False),
    "doc_vqa": _rows("'d/' || g || '.png'", _G, "'doc_vqa'", qa="CASE WHEN k % 3 != 0 THEN q || ' yes' END", boxes=f"CASE WHEN k = (SELECT min(c.k) FROM b c WHERE c.g = b.g) THEN {_place(chr(39) + 'w' + chr(39), 1, 1)} END"),
    "info_vqa": _rows("'d/' || g || '.png'", _G, "'info_vqa'", qa="q || ' yes'"),
    "chart_qa": _rows("'chart_qa/images/' || substr(sha256('picture ' || g), 1, 16) || '.png'", "substr(sha256('picture ' || g), 1, 16)", "'chart_qa'", qa="q || ' ' || t || '|' || q || ' x'"),
    "mm_visualmrc": _rows("'p/' || k", _K, "'mm_visualmrc'", qa="q || ' A' || CASE WHEN k % 2 = 0 THEN '|R? B' ELSE '' END", group=False),
    "tallyqa": "SELECT p AS image_path, g::VARCHAR AS image_id, split_part(p, '/', 1) AS image_source, string_agg(CASE k % 4 WHEN 0 THEN 'There are no cups that are on the table' WHEN 1 THEN 'There is 1 cup that is on the table' ELSE 'There are ' || k % 4 || ' cups that are on the table' END, '|' ORDER BY k) AS captions, '' AS qa, '' AS boxes FROM (SELECT *, CASE k % 3 WHEN 0 THEN 'coco/train2017/' || g || '.jpg' ELSE 'vg/VG_100K/' || g || '.jpg' END AS p FROM b WHERE k % 3 != 1) GROUP BY p, g",
    "a_ok_vqa": _last("q || CASE k % 3 WHEN 0 THEN ' a (not b nor c)' WHEN 1 THEN ' b (not a nor c)' ELSE ' c (not a nor b)' END || chr(10) || 'r x ' || k", "a_ok_vqa"),
    "ok_vqa": _last("q || CASE WHEN k % 5 = 0 THEN ' No answer' WHEN k % 2 = 0 THEN ' a' ELSE ' b' END", "ok_vqa"),
    "vqa_v2": _rows(_COCO, _G, "'coco_vqa'", qa="q || ' ' || t"),
    "vqa_e": _rows(_COCO, _G, "'coco'", qa="q || CASE k % 3 WHEN 0 THEN ' yes' WHEN 1 THEN ' 3.0' ELSE ' red' END || ' (e)'", where="k % 6 != 0"),
    "text_vqa": _rows("'textvqa/train_images/' || g || '.jpg'", _G, "'text_vqa'", "CASE WHEN k = (SELECT min(c.k) FROM b c WHERE c.g = b.g) THEN 'This image contains: Car, ' || k END", "q || ' a'"),
    "textcaps": _rows("'textvqa/train_images/' || g || '.jpg'", _G, "'textcaps'", "t || '|r|Text visible in image stop ' || k || '|Text visible in image go'"),
    "scienceqa": _rows("'scienceqa/train/' || k || '/image.png'", _K, "'scienceqa'", "CASE WHEN k % 3 != 0 THEN 'Background: l ' ELSE '' END || 'Subject: n | Skill: u'", "'Question: ' || q || chr(10) || 'Choices:' || chr(10) || '(A) x' || chr(10) || '(B) y' || chr(10) || 'Answer: ' || CASE WHEN k % 2 = 0 THEN 'x' ELSE 'y' END || chr(10) || 'Solution: s'", where="k % 4 != 0 AND k % 5 != 0", group=False),
    "conceptual_captions": _rows("'conceptual_captions/images/' || k || '.jpg'", "k || '.jpg'", "'conceptual_captions'", "t || '|In this image you can find a, b'", where="k % 3 != 0", group=False),
    "visual_news": _rows("'visual_news/s/images/0001/' || g || '.jpg'", "min(k)::VARCHAR", "'visual_news'", "CASE WHEN k % 3 != 0 AND t != '' THEN t END"),
    **{name: _referred(name) for name in ("refcoco", "refcocoplus", "refcocog")},
    "ocr_vqa": _rows("'o/' || k", _K, "'ocr_vqa'", "'Title: ' || k || '|Genre: G'", "q || ' A'", "k || ' 0.020000 0.025000 0.220000 0.275000'", group=False),
    "dior_rsvg": _rows("'r/' || k", _K, "'dior_rsvg'", boxes=f"CASE WHEN k % 2 = 0 THEN {_place(chr(39) + 'ship' + chr(39))} || '|' || {_place(_K)} ELSE '' END", group=False),
    "docowl": _rows("'d/' || k || '.png'", _K, "'docowl'", boxes="'w' || k || ' 0.100000 0.200000 0.500000 0.750000'", group=False),
    "llavar": _rows("'llavar/llavar_images/' || k", _K, "'llavar'", "CASE WHEN k % 2 = 0 THEN g::VARCHAR ELSE '' END", boxes="'w 0.000000 0.000000 1.000000 0.500000'", group=False),
    "hrrsd": "SELECT 'hrrsd/JpegImages/' || g || '.jpg' AS image_path, g || '.jpg' AS image_id, 'hrrsd' AS image_source, 'An aerial image.' AS captions, '' AS qa, string_agg('ship' || " + " || ".join(f"' ' || printf('%.6f', floor((({v}) / ({n} + CASE WHEN first < 400 THEN 0 ELSE 1 END)::DOUBLE) * 1e6 + 0.5) / 1e6)" for v, n in (("k % 5", 50), ("k % 7", 80), ("k % 5 + 10", 50), ("k % 7 + 20", 80))) + ", '|' ORDER BY k) AS boxes FROM (SELECT *, min(k) OVER (PARTITION BY g) AS first FROM b) GROUP BY g",
    "levir_cc": _rows("'l/' || k", _K, "'levir_cc'", "g || '|b'", group=False),
    "image_editing_request": "SELECT 'e/' || g AS image_path, max(k)::VARCHAR AS image_id, 'image_editing_request' AS image_source, 'do ' || max(k) AS captions, '' AS qa, '' AS boxes FROM b GROUP BY g",
    "mm_spot_diff": _rows("'s/' || k", _K, "'mm_spot_diff'", qa="'Question: What are the differences between these images? Answer: ' || k", group=False),
    "flickr": _rows("'flickr30k/' || g || '.jpg'", "g || '.jpg'", "'flickr30k'", "'a \"dog\" ' || k", where="k % 5 != 0"),
    "image2paragraph": "SELECT p AS image_path, g || '.jpg' AS image_id, 'vg' AS image_source, string_agg('One, \"two\" ' || k, '|' ORDER BY k) AS captions, '' AS qa, '' AS boxes FROM (SELECT *, CASE k % 3 WHEN 1 THEN 'vg/VG_100K/' ELSE 'vg/VG_100K_2/' END || g || '.jpg' AS p FROM b WHERE k % 3 != 0 AND k % 5 != 0) GROUP BY p, g",
    "coco_captions": _coco_rows("coco/train2017"),
    "coco_captions_2014": _coco_rows("coco/train2014"),
    "lvis": f"SELECT 'coco/train2017/' || g || '.jpg' AS image_path, g::VARCHAR AS image_id, 'lvis' AS image_source, 'This image does not contain owl.|This image contains ' || string_agg(DISTINCT CASE k % 2 WHEN 0 THEN 'tea cup' ELSE 'dog' END, ', ' ORDER BY CASE k % 2 WHEN 0 THEN 'tea cup' ELSE 'dog' END) || '.' AS captions, '' AS qa, string_agg({_place('CASE k % 2 WHEN 0 THEN ' + chr(39) + 'tea cup' + chr(39) + ' ELSE ' + chr(39) + 'dog' + chr(39) + ' END', size=True)}, '|' ORDER BY k) AS boxes FROM b GROUP BY g",
}
SQL = {f"source_{name}": f"WITH {_B} {query}" for name, query in _SQL.items()}
