"""One small fixture for each collection; every adapter gives canonical rows."""

import json

import pytest

from lumenweave.operators import catalog  # noqa: F401  (registers the sources)
from lumenweave.plans import source_queries
from lumenweave.sources.records import COLUMNS, REGISTRY, json_map, load

COCO_CAPTIONS = {"images": [{"id": 1, "file_name": "000000000001.jpg", "width": 100, "height": 50}, {"id": 2, "file_name": "000000000002.jpg", "width": 10, "height": 10}],
                 "annotations": [{"image_id": 1, "caption": "A cat."}, {"image_id": 1, "caption": "On a mat."}]}
COCO_INSTANCES = {"images": [{"id": 1, "file_name": "000000000001.jpg"}], "categories": [{"id": 7, "name": "cat"}],
                  "annotations": [{"image_id": 1, "category_id": 7, "segmentation": [[1, 2]], "bbox": [10, 10, 20, 20]}, {"image_id": 1, "category_id": 9, "bbox": [0, 0, 100, 50]}, {"image_id": 2, "category_id": 7, "bbox": [0, 0, 5, 5]}]}


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    base = tmp_path_factory.mktemp("root")

    def put(path, data):
        file = base / path
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(data if isinstance(data, str) else json.dumps(data))

    lines = lambda rows: "\n".join(json.dumps(r) for r in rows) + "\n"
    put("coco_captions/annotations/captions_train2017.json", COCO_CAPTIONS)
    put("coco_captions/annotations/instances_train2017.json", COCO_INSTANCES)
    older = json.loads(json.dumps(COCO_CAPTIONS).replace('"000000', '"COCO_train2014_000000'))
    put("coco_captions_2014/annotations/captions_train2014.json", older)
    put("coco_captions_2014/annotations/instances_train2014.json", COCO_INSTANCES)
    put("lvis/lvis_v1_train.json", {"annotations": [{"image_id": 1, "category_id": 1, "segmentation": [], "bbox": [0, 0, 5, 5]}, {"image_id": 1, "category_id": 1, "bbox": [5, 5, 5, 5]}], "images": [{"id": 1, "coco_url": "http://x/train2017/000000000001.jpg", "width": 10, "height": 10, "neg_category_ids": [2]}], "categories": [{"id": 1, "name": "tea_cup"}, {"id": 2, "name": "dog"}]})
    put("gqa/train_sceneGraphs.json", {"5": {"width": 10, "height": 10, "objects": {"a": {"name": "cat", "x": 0, "y": 0, "w": 5, "h": 5, "attributes": ["black"], "relations": [{"name": "on", "object": "b"}, {"name": "near", "object": "zz"}]}, "b": {"name": "apple", "x": 5, "y": 5, "w": 5, "h": 5}, "c": {"name": "apple", "x": 1, "y": 1, "w": 1, "h": 1}}}})
    put("gqa/train_balanced_questions.json", {"q1": {"imageId": "5", "question": "What?", "fullAnswer": "A cat."}})
    put("visual_genome/image_data.json", [{"image_id": 1, "coco_id": 1, "width": 10, "height": 10}, {"image_id": 2, "coco_id": None, "width": 10, "height": 10}, {"image_id": 3, "coco_id": None, "width": 1, "height": 1}])
    put("images/vg/VG_100K/2.jpg", "x")
    put("images/vg/VG_100K_2/9.jpg", "x")
    put("visual_genome/objects.json", [{"image_id": 1, "objects": [{"object_id": 11, "names": ["cat"], "x": 0, "y": 0, "w": 5, "h": 5}]}, {"image_id": 2, "objects": [{"object_id": 21, "names": ["dog"], "x": 0, "y": 0, "w": 1, "h": 1}]}, {"image_id": 3, "objects": [{"object_id": 31, "names": ["x"], "x": 0, "y": 0, "w": 1, "h": 1}]}])
    put("visual_genome/attributes.json", [{"image_id": 1, "attributes": [{"object_id": 11, "attributes": ["black", "black", "small"]}]}])
    put("visual_genome/relationships.json", [{"image_id": 1, "relationships": [{"predicate": "ON", "subject": {"object_id": 11}, "object": {"names": ["mat"]}}]}])
    put("visual7w/dataset_v7w_telling.json", {"images": [{"image_id": 2, "split": "train", "qa_pairs": [{"question": "Who?", "answer": "Me.", "multiple_choices": ["You.", "He"]}]}, {"image_id": 1, "split": "val", "qa_pairs": []}]})
    put("a_ok_vqa/aokvqa_v1p0_train.json", [{"image_id": 7, "question": "Q1?", "choices": ["a", "b", "c"], "correct_choice_idx": 1, "rationales": ["r1\nx", "r2"]}, {"image_id": 7, "question": "Q2?", "choices": ["d", "e"], "correct_choice_idx": 0, "rationales": ["r"]}])
    put("ok_vqa/OpenEnded_mscoco_train2014_questions.json", {"questions": [{"question_id": 1, "image_id": 7, "question": "Q?"}, {"question_id": 2, "image_id": 8, "question": "R?"}]})
    put("ok_vqa/mscoco_train2014_annotations.json", {"annotations": [{"question_id": 1, "answers": [{"answer": "b"}, {"answer": "a"}, {"answer": "b"}, {"answer": "a"}]}]})
    put("vqa_v2/v2_OpenEnded_mscoco_train2014_questions.json", {"questions": [{"question_id": 1, "question": "Q?"}, {"question_id": 2, "question": "R?"}]})
    put("vqa_v2/v2_mscoco_train2014_annotations.json", {"annotations": [{"question_id": 2, "image_id": 7, "multiple_choice_answer": "no"}, {"question_id": 1, "image_id": 7, "multiple_choice_answer": "yes"}]})
    put("vqa_e/VQA-E_train_set.json", [{"img_id": 7, "question": "Is it?", "answers": ["Yes", "no"], "answer_type": "yes/no", "explanation": ["e"]}, {"img_id": 7, "question": "How many?", "answers": ["2", "3", "2", "x"], "answer_type": "number", "explanation": ["two"]}])
    put("text_vqa/TextVQA_0.5.1_train.json", {"data": [{"image_id": "t", "question": "Q?", "answers": ["b", "a", "a"], "image_classes": ["Car", "Bus"]}]})
    put("textcaps/TextCaps_0.1_train.json", {"data": [{"image_id": "t", "caption_str": "c", "reference_strs": ["r"], "reference_tokens": [["<s>", "stop", "</s>"], ["<s>", "stop", "</s>"]]}]})
    put("tallyqa/train.json", [{"image": "train2014/COCO_train2014_000000000001.jpg", "image_id": "1", "question": "How many cats are in the room?", "answer": 2}, {"image": "val2014/x.jpg", "image_id": "2", "question": "How many?", "answer": 1}])
    put("vsr/all_vsr_validated_data.jsonl", lines([{"image": "12.jpg", "caption": "x"}, {"image": "12.jpg", "caption": "y"}, {"image": "1234567890123.jpg", "caption": "z"}]))
    put("st_vqa/data.json", [{"image_path": "p", "image_id": "i", "qas": [{"question": "Q", "answers": ["a", "b"]}]}])
    for name in ("doc_vqa", "info_vqa"):
        put(f"{name}/data.json", [{"image_path": "d/p.png", "image_id": "i", "query": {"en": "Q?"}, "question": " Q? ", "answers": ["a"], "words": ["w"], "word_boxes": [[0, 0, 1, 1]], "metadata": {"k": "v"}}, {"image_path": "d/p.png", "image_id": "i", "query": {"en": " "}, "question": "R?", "answers": ["b"]}])
    put("chart_qa/data.json", [{"image": "QUJD", "query": "Q?", "label": ["1", "2"]}, {"image": "QUJD", "query": "R?", "label": ["3"]}])
    put("mm_visualmrc/data.json", [{"image_path": "p", "image_id": "i", "conversation": [{"role": "user", "data": "x", "modality": "image"}, {"role": "user", "data": "Q?", "modality": "text"}, {"role": "assistant", "data": "A", "modality": "text"}, {"role": "user", "data": "R?", "modality": "text"}, {"role": "assistant", "data": " ", "modality": "text"}]}])
    put("scienceqa/problems.json", {"1": {"split": "train", "image": "image.png", "question": "Q?", "choices": ["x", "y"], "answer": 1, "solution": "s", "lecture": "l", "subject": "n", "category": "", "skill": "k"}, "2": {"split": "train", "image": None}, "3": {"split": "val", "image": "image.png"}})
    put("localized_narratives/coco_train_captions.jsonl", lines([{"image_id": "5", "caption": "long"}]))
    for part in ("flickr30k_train", "open_images_train_v6", "ade20k_train"):
        put(f"localized_narratives/{part}_captions.jsonl", lines([{"image_id": "abc", "caption": part}]))
    put("flickr/results.csv", "image_name| comment_number| comment\n1.jpg| 0| A \"dog\" .\n1.jpg| 1\n1.jpg| 1| Two\n")
    put("image2paragraph/stanford_df_rectified.csv", 'train,url,Paragraph\nTrue,http://x/VG_100K_2/1.jpg,"One, two."\nFalse,http://x/VG_100K/2.jpg,no\nTrue,http://x/other/3.jpg,no\n')
    put("conceptual_captions/metadata.json", {"f.jpg": {"caption": "c", "labels": ["a", "b"], "status": 200}, "g.jpg": {"caption": "c", "labels": [], "status": 404}})
    put("visual_news/origin/data.json", [{"id": 1, "source": "s", "image_path": "./s/images/0001/2.jpg", "topic": "t", "article_path": "a", "caption": "c"}, {"id": 2, "source": "s", "image_path": "./s/images/0001/2.jpg", "topic": "t", "article_path": "a", "caption": ""}])
    put("image_editing_request/metadata.csv", "image_path,uid,instruction,original_filename,edited_filename\np,u,do it,o,e\n")
    put("levir_cc/metadata.csv", 'image_path,captions,split,change_flag,image_id\np,"["" a "", ""b""]",train,1,3\n')
    put("mm_spot_diff/metadata.csv", 'image_path,conversation,split\nd/p,"[{""role"": ""assistant"", ""data"": ""none"", ""modality"": ""text""}]",train\n')
    for name in ("refcoco", "refcocoplus", "refcocog"):
        put(f"{name}/{name}.json", [{"image_id": "1", "raw_image_info": json.dumps({"width": 10, "height": 20}), "image_path": "COCO_train2014_000000000001.jpg", "bbox": [1, 2, 5, 10], "captions": ["a", "b"]}])
    put("docowl/ocr_results.json", {"d/x.png": [["word", 0.1, 0.2, 0.3, 0.4], ["short", 1]]})
    put("llavar/llavar_ocr_results.jsonl", lines([{"llavar_id": "1", "ocr_results": [["w", 0, 0, 1, 1]]}, {"llavar_id": "2", "ocr_results": []}]))
    put("llavar/finetune_meta.json", [{"llavar_id": "1", "TEXT": "t", "WIDTH": 5, "HEIGHT": 6}])
    put("ocr_vqa/data.json", [{"image_id": "i", "image_path": "p", "title": "T", "authorName": "", "genre": "G", "image_width": 10, "image_height": 10, "ocr_info": [{"word": "w", "bounding_box": {"x": 0, "y": 0, "width": 5, "height": 5}}, {"word": "v", "bounding_box": {"x": 0}}], "questions": ["Q?", "R?"], "answers": ["A"]}])
    put("hrrsd/Annotations.csv", "filename,width,height,xmin,ymin,xmax,ymax,class\na.jpg,10,10,0,0,5,5,ship\na.jpg,99,99,5,5,10,10,car\n")
    put("dior_rsvg/data.json", [{"image_path": "p", "image_id": "i", "width": 10, "height": 10, "objects": {"bbox": [[0, 0, 5, 5]], "categories": ["ship"], "captions": ["a ship"]}}, {"image_path": "q", "image_id": "j", "width": 10, "height": 10, "objects": {"bbox": [[0, 0, 5, 5]], "categories": ["ship"], "captions": []}}])
    for name, file in (("remoteclip_det10", "Det-10.csv"), ("remoteclip_ret3", "Ret-3_train.csv")):
        put(f"{name}/{file}", "one .,two .\ta.jpg\nthree,three\tb.jpg\n")
    return str(base)


EXPECTED = {
    "coco_captions": lambda r: r[0]["captions"] == ["A cat.", "On a mat."] and [b["label"] for b in r[0]["bboxes"]] == ["cat", "unknown"] and r[0]["bboxes"][0]["x2"] == 0.3 and r[1]["captions"] == [],
    "coco_captions_2014": lambda r: r[0]["image_path"] == "coco/train2017/000000000001.jpg",
    "lvis": lambda r: r[0]["captions"] == ["This image does not contain dog.", "This image contains tea cup."] and len(r[0]["bboxes"]) == 2,
    "gqa": lambda r: [b["label"] for b in r[0]["bboxes"]] == ["cat", "black", "on an apple", "apple", "apple"] and r[0]["qa"] == ["What? A cat."],
    "visual_genome": lambda r: [x["image_path"] for x in r] == ["coco/train2017/000000000001.jpg", "vg/VG_100K/2.jpg"] and [b["label"] for b in r[0]["bboxes"]] == ["cat", "black", "on the mat", "small"] and r[1]["image_id"] == "2",
    "visual7w": lambda r: r[0]["qa"] == ["Who? me (not you, nor he)"] and len(r) == 1,
    "a_ok_vqa": lambda r: r[0]["qa"] == ["Q2? d (not e)\nr"] and r[0]["image_path"] == "coco/train2017/000000000007.jpg",
    "ok_vqa": lambda r: [x["qa"] for x in r] == [["Q? b"], ["R? No answer"]],
    "vqa_v2": lambda r: r[0]["qa"] == ["R? no", "Q? yes"],
    "vqa_e": lambda r: r[0]["qa"] == ["How many? 2.0 (two)"],
    "text_vqa": lambda r: r[0]["qa"] == ["Q? a"] and r[0]["captions"] == ["This image contains: Car, Bus"],
    "textcaps": lambda r: r[0]["captions"] == ["c", "r", "Text visible in image stop"],
    "tallyqa": lambda r: len(r) == 1 and r[0]["captions"] == ["There are 2 cats that are in the room"],
    "vsr": lambda r: [x["image_path"] for x in r] == ["coco/train2017/000000000012.jpg", "coco/train2017/1234567890123.jpg"] and r[0]["captions"] == ["x", "y"],
    "st_vqa": lambda r: r[0]["qa"] == ["Question: Q Answer: a, b"],
    "doc_vqa": lambda r: r[0]["qa"] == ["Q? a"] and r[0]["bboxes"][0]["label"] == "w" and r[0]["metadata"] == {"k": "v"},
    "info_vqa": lambda r: r[0]["qa"] == ["Q? a", "R? b"] and r[0]["image_id"] == "p",
    "chart_qa": lambda r: len(r) == 1 and r[0]["qa"] == ["Q? 1", "Q? 2", "R? 3"] and len(r[0]["image_id"]) == 16,
    "mm_visualmrc": lambda r: r[0]["qa"] == ["Q? A"],
    "scienceqa": lambda r: len(r) == 1 and r[0]["qa"] == ["Question: Q?\nChoices:\n(A) x\n(B) y\nAnswer: y\nSolution: s"] and r[0]["captions"] == ["Background: l Subject: n | Skill: k"],
    "localized_narratives": lambda r: len(r) == 4 and {x["image_source"] for x in r} == {"coco/train2017", "flickr30k", "open_images", "ade20k"},
    "flickr": lambda r: r[0]["captions"] == ['A "dog" .', "Two"],
    "image2paragraph": lambda r: len(r) == 1 and r[0]["captions"] == ["One, two."] and r[0]["image_path"] == "vg/VG_100K_2/1.jpg",
    "conceptual_captions": lambda r: len(r) == 1 and r[0]["captions"] == ["c", "In this image you can find a, b"],
    "visual_news": lambda r: r[0]["captions"] == ["c"] and r[0]["image_path"] == "visual_news/s/images/0001/2.jpg" and r[0]["metadata"]["topic"] == "t",
    "image_editing_request": lambda r: r[0]["captions"] == ["do it"] and r[0]["metadata"]["original_filename"] == "o",
    "levir_cc": lambda r: r[0]["captions"] == ["a", "b"] and r[0]["split"] == "train",
    "mm_spot_diff": lambda r: r[0]["qa"] == ["Question: What are the differences between these images? Answer: none"],
    "refcoco": lambda r: [(b["label"], b["x1"], b["y2"]) for b in r[0]["bboxes"]] == [("a", 0.1, 0.5), ("b", 0.1, 0.5)],
    "refcocoplus": lambda r: r[0]["image_source"] == "refcocoplus",
    "refcocog": lambda r: len(r[0]["bboxes"]) == 2,
    "docowl": lambda r: r[0]["image_id"] == "x" and [b["label"] for b in r[0]["bboxes"]] == ["word"],
    "llavar": lambda r: r[0]["captions"] == ["t"] and r[0]["width"] == 5 and r[1]["captions"] == [] and r[1]["width"] is None,
    "ocr_vqa": lambda r: r[0]["captions"] == ["Title: T", "Genre: G"] and len(r[0]["bboxes"]) == 1 and r[0]["qa"] == ["Q? A"],
    "hrrsd": lambda r: [b["x2"] for b in r[0]["bboxes"]] == [0.5, 1.0] and r[0]["captions"] == ["An aerial image."],
    "dior_rsvg": lambda r: [b["label"] for b in r[0]["bboxes"]] == ["ship", "a ship"] and r[1]["bboxes"] == [],
    "remoteclip_det10": lambda r: r[0]["captions"] == ["An aerial image.", "one.", "two."] and r[1]["captions"] == ["An aerial image.", "three"],
    "remoteclip_ret3": lambda r: len(r) == 2,
}


def test_all_sources_are_there():
    assert set(EXPECTED) == set(REGISTRY)


@pytest.mark.parametrize("name", sorted(EXPECTED))
def test_source(spark, root, name):
    df = load(spark, root, [name])
    assert tuple(df.columns) == COLUMNS
    rows = sorted((r.asDict(recursive=True) for r in df.collect()), key=lambda r: r["image_path"])
    assert all(r["dataset"] == name and r["bboxes"] is not None and r["captions"] is not None and r["qa"] is not None for r in rows)
    assert EXPECTED[name](rows), rows


def test_load_unknown(spark, root):
    with pytest.raises(KeyError):
        load(spark, root, ["nothing"])


def test_load_several(spark, root):
    assert load(spark, root, ["vsr", "flickr"]).count() == 3


@pytest.mark.parametrize("split", ["60", "1m"])
def test_json_map_of_any_split(spark, tmp_path, split):
    odd = ["", "a,b", '"', "\\", '\\"', "},{", "[,]", "\n", "é,ü", '\\\\",\\"{', "x" * 90]
    files = {"a": {f"k{i}{t}": {"t": t, "u": [t, f"{i}"] * (i % 3), "more": {"x": [{}, {"y": None}]}} for i, t in enumerate(odd)}, "b": {}, "c": {"one": {"t": "1"}}}
    for name, data in files.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(data, ensure_ascii=name == "c", indent=1 if name == "a" else None))
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        df = json_map(spark, f"{tmp_path}/*.json", "struct<t string, u array<string>>")
        got = [(r["key"], r["value"]["t"], r["value"]["u"]) for r in df.orderBy("pos").collect()]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert got == [(k, v["t"], v.get("u")) for data in files.values() for k, v in data.items()]


def test_maps_are_written_entry_by_entry(spark, tmp_path):
    for n in (0, 1, 5):
        entries = spark.range(n).selectExpr("id AS k", "'{\"a\":1}' AS j")
        source_queries._map(entries, source_queries._S("k"), f"{tmp_path}/{n}")
        (file,) = (tmp_path / str(n)).glob("part-*")
        assert list(json.loads(file.read_text())) == [str(i) for i in range(n)] and file.read_text().count("\n") == n + 2
