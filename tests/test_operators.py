"""Catalogue, results, boxes, nested tables and the generation loop on small tables."""

import json
import random
import urllib.error
from http.server import BaseHTTPRequestHandler, HTTPServer
from threading import Thread

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lumenweave.generation import process as P
from lumenweave.generation.model import EchoClient, HttpClient, ScriptedClient
from lumenweave.generation.prompts import DISTRIBUTIONS, OPTION_ENDS, REGISTRY, ParseError
from lumenweave.operators import boxes as B
from lumenweave.operators import catalog as C
from lumenweave.operators import nested as N
from lumenweave.operators import results as R
from lumenweave.sources.records import SCHEMA, stored_catalogue
from lumenweave.streaming import result_stream


@pytest.fixture(scope="module")
def rows(spark):
    data = [dict(image_path=p, dataset=d, image_id="i", captions=[f"{p} {d}"]) for p, d in (("x/1", "a"), ("x/1", "b"), ("x/2", "a"), ("y/3", "b"), ("y/3", "b"), (None, "a"))]
    return C.Catalog(spark, "/tmp/none").set_data(data).cache()


def test_catalogue(spark, rows):
    paths = lambda df: sorted({r["image_path"] or "" for r in df.collect()})
    assert paths(C.drop_imageset(rows, "x/")) == ["y/3"]
    assert paths(C.drop_dataset(rows, "a")) == ["x/1", "y/3"]
    alone = C.drop_dataset(rows, "a", only_when_alone=True)
    assert "x/2" not in paths(alone) and alone.where("image_path = 'x/1'").count() == 2
    assert {r["dataset"]: r["n_images"] for r in C.by_source(rows).collect()} == {"a": 2, "b": 2, "*": 3}
    assert {r["image_path"]: sorted(r["sources"]) for r in C.nested(rows).collect()} == {"x/1": ["a", "b"], "x/2": ["a"], "y/3": ["b"]}
    assert paths(C.pending(rows, spark.createDataFrame([("x/1",)], "image_path string"))) == ["x/2", "y/3"]
    assert paths(C.merge(rows, rows.limit(0))) == paths(rows)
    info = {r["image_path"]: r["information"] for r in C.information(rows, box_text=spark.createDataFrame([("x/1", ["box", " "])], "image_path string, lines array<string>")).collect()}
    assert info["x/1"] == ["x/1 a", "x/1 b", "box"] and info["x/2"] == ["x/2 a"] and None not in info
    assert C.information(rows.limit(0)).count() == 0 and C.information(rows, keys=("image_path", "dataset")).where("image_path = 'x/1'").count() == 2


def test_sample(spark, rows):
    a, b = (sorted(r["image_path"] for r in C.sample(df, 2, 5).select("image_path").distinct().collect()) for df in (rows, rows.repartition(3)))
    assert a == b and len(a) == 2
    with pytest.raises(ValueError):
        C.sample(rows, 4)


def test_records(spark):
    df = spark.createDataFrame([(1, "old", 1), (1, "new", 2), (2, "x", None), (None, "y", 1)], "k int, v string, t int")
    assert sorted((r["k"], r["v"]) for r in C.records(df, "k", "t").collect()) == [(1, "new"), (2, "x")]
    assert C.records(df, "k").count() == 2 and C.records(df.limit(0), "k", "t").count() == 0


def test_claims(spark, rows, tmp_path):
    catalog = C.Catalog(spark, str(tmp_path))
    catalog.cache(rows.where("image_path is not null"))
    first = {r["image_path"] for r in catalog.reserve(2, "r1").collect()}
    second = {r["image_path"] for r in catalog.reserve(2, "r1").collect()}
    assert len(first) == 2 and len(second) == 1 and not first & second
    assert list(catalog.claims(2, "r1")) == [] and len({r["image_path"] for r in catalog.reserve(9, "r2").collect()}) == 3


def _result(path, attempt, step, output, run="r", kind="llava_detail"):
    return (path, attempt, step, kind, [], output, None, None, run)


@pytest.fixture(scope="module")
def done(spark):
    data = [_result("x", 0, 0, ["<fill-in-the-blank> q", "a"]), _result("x", 1, 0, ["later", "b"]), _result("y", 0, 0, []), _result("z", 0, 0, None), _result("w", 0, 0, ["q", "a", "q2", "a2"], "s", None)]
    return spark.createDataFrame(data, R.SCHEMA).cache()


def test_results(spark, done, tmp_path):
    exported = {r["image"]: [tuple(m) for m in r["conversations"]] for r in R.export(done).collect()}
    assert exported == {"x": [("human", "<image>\n[blank] q"), ("gpt", "a")], "w": [("human", "<image>\nq"), ("gpt", "a"), ("human", "q2"), ("gpt", "a2")]}
    assert {r["image"] for r in R.export(done, spark.createDataFrame([("x",)], "image_path string")).collect()} == {"x"}
    assert {r["image"] for r in R.export(done, without=("llava_detail",)).collect()} == {"w"}
    assert tuple(R.statistics(done).collect()[0]) == (2, 2, 6)
    assert R.clean(done).count() == 3 and R.clean(done, "s", empty_only=False).count() == 4 and R.clean(done, "nothing").count() == 5
    claimed = spark.createDataFrame([("r", "x"), ("r", "q")], "run_id string, image_path string")
    assert {tuple(r) for r in R.count(done, claimed).collect()} == {("r", 4, 1), ("s", 1, 0)}
    assert {r["image_path"]: len(r["results"]) for r in R.collect(done, "r").collect()} == {"x": 2, "y": 1, "z": 1}
    R.append(done, str(tmp_path))
    stored = spark.read.schema(R.SCHEMA).parquet(f"{tmp_path}/results")
    assert stored.count() == 5
    R.clean_table(stored, str(tmp_path))
    assert spark.read.parquet(f"{tmp_path}/results").count() == 3
    R.write_json(R.export(done), f"{tmp_path}/json")
    assert spark.read.json(f"{tmp_path}/json").count() == 2
    for _ in range(2):
        result_stream.export(spark, str(tmp_path), f"{tmp_path}/out").awaitTermination()
    assert spark.read.parquet(f"{tmp_path}/out").count() == 3


# Boxes


def _frame(spark, data):
    return spark.createDataFrame(data, "image_path string, obj_id int, label string, x1 double, y1 double, x2 double, y2 double")


def test_merge_and_pairs(spark):
    rng = random.Random(1)
    data = []
    for p in ("p", "q"):
        for i in range(40):
            x, y = rng.random() * 0.7, rng.random() * 0.7
            data.append((p, i, f"l{i % 5}", x, y, x + rng.random() * 0.3, y + rng.random() * 0.3))
    df = _frame(spark, data)
    brute = {(a[0], a[1], b[1]) for a in data for b in data if a[0] == b[0] and a[1] < b[1] and B.box_iou(np.array(a[3:]), np.array(b[3:])) > 0.2}
    assert {(r["image_path"], r["a"], r["b"]) for r in B.overlap_pairs(df, 0.2).collect()} == brute
    merged = B.merge_boxes(df, 0.2)
    assert merged.count() < len(data) and merged.agg(F.sum("n")).collect()[0][0] == len(data)
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, B.merge_boxes(df.repartition(3, "obj_id"), 0.2).collect()))
    assert B.merge_boxes(df.limit(0)).count() == 0


def test_greedy_order():
    # b overlaps both ends of a chain whose ends don't overlap: the first cluster takes it
    a, b, c = [0, 0, 2, 1], [1, 0, 3, 1], [2, 0, 4, 1]
    assert [x.members for x in B.greedy_clusters(np.array([a, b, c], dtype=float), [["x"]] * 3, 0.3)] == [[0, 1], [2]]
    assert [x.members for x in B.greedy_clusters(np.array([b, a, c], dtype=float), [["x"]] * 3, 0.3)] == [[0, 1], [2]]
    masks = [np.array([[1, 0]], bool), np.array([[0, 1]], bool)]
    assert len(B.greedy_clusters(np.array([a, a], dtype=float), [["x"]] * 2, 0.6, masks)) == 2


coordinate = st.floats(0, 1, allow_nan=False)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(coordinate, coordinate, coordinate, coordinate), max_size=12))
def test_box_properties(data):
    boxes = np.array([[min(a, c), min(b, d), max(a, c), max(b, d)] for a, b, c, d in data], dtype=float).reshape(-1, 4)
    for a in boxes:
        for b in boxes:
            assert B.box_iou(a, b) == B.box_iou(b, a) and 0 <= B.box_iou(a, b) <= 1 + 1e-9
    assert len(B.greedy_clusters(boxes, [["x"]] * len(boxes), 0.5)) <= len(boxes)
    nodes = [B.Node(f"l{i}", b, 0.1, [0]) for i, b in enumerate(boxes)]
    roots = B.build_tree(nodes)
    walk = lambda n: 1 + sum(map(walk, n.children))
    assert sum(map(walk, roots)) == len(nodes)


def test_tree_text(spark):
    table = B.Node("table", np.array([0, 0, 1, 1.0]), 1.0, [0])
    cup = B.Node("cup", np.array([0.1, 0.1, 0.2, 0.2]), 0.01, [0])
    roots = B.build_tree([table, cup])
    assert roots == [table] and table.children == [cup]
    text = B.tree_text(roots)
    assert text.startswith("table [X: 0.50, Y: 0.50, Pixel Size: 100.0%, Relative Depths: 0], with:\n    -> cup [X: 0.15, Y: 0.85") and text.endswith("Object Counts:\n\ttables: 1\n\tcups: 1")
    flat = B.build_tree([B.Node("table", np.array([0, 0, 1, 1.0]), 1.0), B.Node("cup", np.array([0.1, 0.1, 0.2, 0.2]), 0.01)])
    assert len(flat) == 2 and B.tree_text([]) == ""
    nine = [B.Node("cup", np.array([0.1, 0.1, 0.2, 0.2]) + i / 100, 0.01, [0]) for i in range(9)]
    assert B.tree_text(nine).startswith("many (cups) [Average X:")
    assert [B.shown_count(labels, k) for labels, k in ((["cup"] * 3, "cup"), (["cup"] * 9, "cup"), (["red cups", "cup"], "cup"), (["pair of pants"] * 12, "pants"), (["tall building"] * 2, "tall building"), (["cats"] * 2, "cat"))] == ["3", "many", "several", "many", "several", "several"]
    n = B.Node("cat", [0.1, 0.2, 0.32, 0.76], 0.123, [1, 2])
    assert B.node_text(n) == "cat [X: 0.20, Y: 0.50, Pixel Size: 12.3%, Relative Depths: 1, 2]" and B.node_text(n, False) == "cat"
    assert B.node_text(n, True, True) == "cat [0.10, 0.20, 0.30, 0.75] [X: 0.20, Y: 0.50, Pixel Size: 12.3%, Relative Depths: 1, 2]"
    assert B._averages([n, B.Node("cat", [0.5, 0.1, 0.9, 0.5], 0.203)], True) == "[0.10, 0.10, 0.90, 0.75] [Average X: 0.45, Average Y: 0.60, Average Pixel Size: 16.3%]"
    assert [B._meet(B.Node("a", [], 0, [0]), B.Node("b", [], 0, [d]), 1) for d in (1, 2, 3)] == [True, True, False]
    df = _frame(spark, [("p", 0, "cup", 0.0, 0.0, 0.5, 0.5), ("p", 1, None, 0.0, 0.0, 0.5, 0.5)]).withColumn("depths", F.lit(None).cast("array<int>"))
    assert B.box_trees(df).collect()[0]["n_objects"] == 1


def test_containment(spark):
    df = _frame(spark, [("p", 0, "table", 0.0, 0.0, 1.0, 1.0), ("p", 1, "cup", 0.1, 0.1, 0.2, 0.2), ("p", 2, "table", 0.1, 0.1, 0.3, 0.3)]).withColumn("depth_low", F.lit(0)).withColumn("depth_high", F.lit(0))
    assert {(r["inner"], r["outer"]) for r in B.containment_pairs(df).collect()} == {(1, 0), (1, 2)}
    assert B.containment_pairs(df.withColumn("depth_low", F.lit(None).cast("int"))).count() == 0


def test_masks_and_depth_maps(spark):
    left, right = np.zeros((4, 8), bool), np.zeros((4, 8), bool)
    left[:, :4] = True
    right[:, 4:] = True
    pack = lambda m: bytearray(np.packbits(m).tobytes())
    data = [("p", 0, "cat", 0.0, 0.0, 1.0, 1.0, pack(left), 8), ("p", 1, "kitten", 0.0, 0.0, 1.0, 1.0, pack(left), 8), ("p", 2, "cat", 0.0, 0.0, 1.0, 1.0, pack(right), 8), ("p", 3, "cats", 0.0, 0.0, 1.0, 1.0, pack(left), 8), ("p", 4, "x", 0.0, 0.0, 1.0, 1.0, None, 8)]
    df = spark.createDataFrame(data, "image_path string, obj_id int, label string, x1 double, y1 double, x2 double, y2 double, mask binary, mask_width int")
    got = B.merge_masked(df).orderBy("obj_id").collect()
    assert [(r["label"], r["n"], r["mask_share"]) for r in got] == [("cat (kitten)", 2, 0.5), ("cat", 1, 0.5), ("cats", 1, 0.5)] and got[0]["center_x"] == 1.5 / 8
    assert (B.unpack_mask(bytes(got[0]["mask"]), 8) == left).all() and B.box_mask([0.5, 0, 1, 1], 4, 8).tolist() == right.tolist()
    depth = np.where(np.arange(32 * 32).reshape(32, 32) % 32 < 16, 10, 200) + np.arange(32 * 32).reshape(32, 32) % 3
    depth[0, 31] = 255  # a peak needs something beyond it
    maps = spark.createDataFrame([("p", depth.ravel().tolist(), 32), ("q", None, None)], "image_path string, depth array<int>, depth_width int")
    objects = _frame(spark, [("p", 0, "a", 0.0, 0.0, 0.4, 1.0), ("p", 1, "b", 0.6, 0.0, 1.0, 1.0), ("q", 0, "c", 0.0, 0.0, 1.0, 1.0), ("r", 0, "d", 0.0, 0.0, 1.0, 1.0)])
    assert {(r["image_path"], r["obj_id"]): r["depths"] for r in B.with_depths(objects, maps).collect()} == {("p", 0): [1], ("p", 1): [0], ("q", 0): [], ("r", 0): []}


def test_depths():
    depth = np.r_[np.full(500, 10), np.full(500, 200), np.arange(0, 255, 5)].reshape(1, -1)
    cuts = B.depth_cuts(depth)
    assert cuts is not None and cuts[1] == 2
    near, far = np.zeros_like(depth, bool), np.zeros_like(depth, bool)
    near[0, 500:1000] = True
    far[0, :500] = True
    assert B.object_depths(depth, near, cuts) == [0] and B.object_depths(depth, far, cuts) == [1]
    assert B.object_depths(depth, np.zeros_like(depth, bool), cuts) == [] and B.depth_cuts(np.full((4, 4), 3)) is None


# Nested tables


def test_shred(spark):
    data = [(1, 10, [("a", ["x", None]), None, ("b", None)]), (2, 20, None), (3, 30, []), (None, 40, [("c", ["y"])])]
    df = spark.createDataFrame(data, "id int, fk int, items array<struct<name string, tags array<string>>>")
    t = N.shred(df, "id", "items", ["fk"], {"items": "name"})
    assert {(r[N.LABEL], r[N.PARENT], r["name"]) for r in t["items"].collect()} == {("1.0", "1", "a"), ("1.1", "1", None), ("1.2", "1", "b"), ("?.0", "?", "c")}
    assert {(r[N.LABEL], r[N.PARENT], r["fk"], r["name"], r[N.VALUE]) for r in t["items.tags"].collect()} == {("1.0.0", "1.0", 10, "a", "x"), ("1.0.1", "1.0", 10, "a", None), ("?.0.0", "?.0", 40, "c", "y")}
    assert all(df.count() == 0 for df in N.shred(df.limit(0), "id", "items").values())


def test_shred_clash_and_depth(spark):
    df = spark.createDataFrame([(1, [[1, 2], [3]])], "id int, a array<array<int>>")
    assert {(r[N.LABEL], r[N.VALUE]) for r in N.shred(df, "id", "a")["a.element"].collect()} == {("1.0.0", 1), ("1.0.1", 2), ("1.1.0", 3)}
    df = spark.createDataFrame([(1, 5, [(7,)])], "id int, fk int, a array<struct<fk int>>")
    row = N.shred(df, "id", "a", ["fk"])["a"].collect()[0]
    assert row["fk"] == 5 and row["fk_"] == 7


def test_relations(spark):
    texts = ['[{"relationship_id": 1, "predicate": "on", "subject": {"object_id": "5", "name": "a"}, "object": {"object_id": 6, "names": ["b"]}}]', '{"relationships": [{"relationship_id": 2, "subject": null, "object": {"object_id": 5}}]}', "[]", None, '{"x": 1}', "[null]"]
    relations = spark.createDataFrame(list(enumerate(texts)), "rec_id bigint, relationships string").withColumn("image_id", F.lit(1).cast("bigint"))
    objects = spark.createDataFrame([(1, 1, [(5, ["cat "], None, 1, 1, 1, 1), (None, ["x"], None, 1, 1, 1, 1), None])], "rec_id bigint, image_id bigint, objects array<struct<object_id bigint, names array<string>, synsets array<string>, x int, y int, w int, h int>>")
    attributes = spark.createDataFrame([(1, 1, [(5, None, ["red", None]), (9, None, ["lost"])])], "rec_id bigint, image_id bigint, attributes array<struct<object_id bigint, names array<string>, attributes array<string>>>")
    assert {tuple(r) for r in N.found(objects, attributes, relations).collect()} == {(1, 5, "name", "cat "), (1, 5, "attribute", "red"), (1, 5, "subject", "1"), (1, 5, "object", "2")}


# Generation

GOOD = "Question: What is it?\nAnswer: It is a cat on a mat."
ONE = [{"name": "llava_conversation", "weight": 1.0}]


def loop(rules, information=("A cat. " * 20,), distribution=ONE, **settings):
    return P.process(list(information), ScriptedClient(rules), distribution, P.Settings(**settings), "k")


def test_loop_ends():
    accept = [("[check]", "true"), ("[reduce]", "[0]"), ("", GOOD)]
    steps = loop(accept, least_information=10)
    assert 1 < len(steps) <= 15 and steps[0]["output"] == ["What is it?", "It is a cat on a mat."] and steps[0]["filtered_out"] == ["A cat."]
    assert loop(accept, information=("short",)) == []
    assert loop([("[check]", "false"), ("", GOOD)]) == []
    assert len(loop([("[check]", "true"), ("[reduce]", "nothing"), ("", GOOD)])) == 1  # no selection: all is used
    steps = loop([("", "no form")])
    assert [s["error"]["type"] for s in steps] == ["output_parsing"]
    assert loop([("", RuntimeError("down"))])[0]["error"] == {"type": "engine", "message": "down"}
    assert loop(accept, distribution=[{"name": "nothing", "weight": 1}])[0]["error"]["type"] == "import"
    assert len(loop(accept, distribution=[{"name": "llava_conversation", "weight": 1, "max_samples": 1}], least_information=10)) == 1
    plain = loop([("", GOOD)], filtering=False, max_count=3)
    assert len(plain) == 3 and all(s["input"] == plain[0]["input"] and s["filtered_out"] is None for s in plain)


def test_sentences_are_kept_or_removed():
    kept, removed = P.reduced(["One. Two.", "Three."], ["about two", "x"], ScriptedClient([("", "[1, 99]")]), 1)
    assert (kept, removed) == (["One.", "Three."], ["Two."])


def test_pick_by_weight():
    rng = P.generator("x")
    seen = [P.pick(DISTRIBUTIONS["LVIS"], rng)["name"] for _ in range(4000)]
    assert abs(seen.count("lvis_conversation") / 4000 - 0.7) < 0.05


def test_every_prompt_draws_and_reads():
    for name, prompt in REGISTRY.items():
        for seed in range(5):
            draw = prompt.draw(random.Random(seed))
            assert "[information]" in prompt.fill(["x"], draw)
    said = lambda name, text, seed=0: REGISTRY[name].read(text, REGISTRY[name].draw(random.Random(seed)))
    assert said("lvis_detail", "[failed]") == [] and said("shikra", "Question: Where?\nAnswer: At [0.1, 0.2, 0.3, 0.4] there.")[1] == "At [0.1, 0.80, 0.3, 0.60] there."


@pytest.mark.parametrize("name, head, words, question, answer, first", [
    ("vqa_yes_no", "Question", ("Yes", "No"), "Is it {}?", None, "Is it 0? Answer with Yes or No."), ("vqa_true_false", "Statement", ("True", "False"), "It is {}.", None, "It is 0. Answer with True or False."),
    ("vqa_true_false", "Statement", ("True", "False"), "It is {}, true or false?", None, "It is 0, true or false?"), ("avoidance", "Question", None, "Who is {}?", "One can't tell that.", "Who is 0?"), ("vqa_fill_in_the_blank", "Statement", None, "A <fill-in-the-blank> here {}", "cat", None),
])
def test_prompts_hold_their_number_of_turns(name, head, words, question, answer, first):
    prompt = REGISTRY[name]
    for seed in range(4):
        draw = prompt.draw(random.Random(seed))
        pairs = [f"{head}: {question.format(i)}\nAnswer: {answer or words[i % 2]}" for i in range(6)]
        messages = prompt.read("thoughts [done]\n" + "\n\n".join(pairs[: draw.turns]), draw)
        assert len(messages) == 2 * draw.turns and (first is None or messages[0] == first) and sum("nswer with" in m for m in messages) <= 1
        for wrong in (pairs[: draw.turns - 1], pairs[: draw.turns + 1], [x.replace(head, "Other") for x in pairs[: draw.turns]]):
            with pytest.raises(ParseError):
                prompt.read("[done]\n" + "\n\n".join(wrong), draw)


def test_multiple_choice_in_all_marks():
    text, kinds = "Question: Which?\nA. right\nB. b\nC. c\nD. d\nE. e", set()
    for seed in range(200):
        draw = REGISTRY["multiple_choice"].draw(random.Random(seed))
        question, answer = REGISTRY["multiple_choice"].read(text, draw)
        head, *lines = question.split("\n")
        assert head.startswith("Which? ") and len(lines) == draw.turns and f"{answer}{draw.extra[3]} right" in lines
        kinds.add((draw.extra[2][0], draw.extra[3]))
    assert len({k for k, _ in kinds}) == 8 and {e for _, e in kinds} == set(OPTION_ENDS)
    with pytest.raises(ParseError):
        REGISTRY["multiple_choice"].read("Question: Which?\nA. right\nB. b", draw)


def test_http_client(monkeypatch):
    asked, answers = [], [(503, b""), (200, json.dumps({"choices": [{"message": {"content": "said"}}]}).encode()), (400, b"")]

    class Handler(BaseHTTPRequestHandler):
        def do_POST(self):
            asked.append((self.path, self.headers["Authorization"], json.loads(self.rfile.read(int(self.headers["Content-Length"])))))
            code, body = answers[len(asked) - 1]
            self.send_response(code)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *a):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    Thread(target=server.serve_forever, daemon=True).start()
    monkeypatch.setenv("SOME_KEY", "k")
    client = HttpClient(f"http://127.0.0.1:{server.server_port}/v1/", "m", "SOME_KEY", wait=0)
    assert client.generate([{"role": "user", "content": "x"}]) == "said" and len(asked) == 2
    assert asked[1] == ("/v1/chat/completions", "Bearer k", {"model": "m", "messages": [{"role": "user", "content": "x"}], "temperature": 0.2, "max_tokens": 1000})
    with pytest.raises(urllib.error.HTTPError):
        client.generate([])
    server.shutdown()


def test_stored_catalogue(spark, tmp_path):
    (tmp_path / "c.json").write_text(json.dumps({"a.jpg": {"coco": {"bboxes": [["cat", 0.1, 0.2, 0.3, 0.4]], "captions": ["c"], "image_id": 7}, "gqa": {"qa": ["q a"]}}, "b.jpg": {}}))
    rows = {(r["image_path"], r["dataset"]): r for r in stored_catalogue(spark, str(tmp_path / "c.json")).collect()}
    assert set(rows) == {("a.jpg", "coco"), ("a.jpg", "gqa")} and rows[("a.jpg", "coco")]["bboxes"][0]["y2"] == 0.4 and rows[("a.jpg", "coco")]["image_id"] == "7" and rows[("a.jpg", "gqa")]["captions"] == [] and rows[("a.jpg", "gqa")]["qa"] == ["q a"]
    C.merge(stored_catalogue(spark, str(tmp_path / "c.json")), spark.createDataFrame([], SCHEMA)).count()


def test_run_is_the_same_for_any_partitions(spark):
    df = spark.createDataFrame([(f"p{i}", [f"Thing {i} is here. It is big. " * 6, None]) for i in range(20)] + [("empty", []), ("null", None), (None, ["x" * 200])], "image_path string, information array<string>")
    out = [sorted(str(r) for r in P.run(df.repartition(n), EchoClient, DISTRIBUTIONS["LLaVA"], "r", P.Settings(max_count=3)).collect()) for n in (1, 5)]
    assert out[0] == out[1] and out[0]
    again = P.retry(df, P.run(df, EchoClient, DISTRIBUTIONS["LLaVA"], "r", P.Settings(max_count=3)), EchoClient, DISTRIBUTIONS["LLaVA"], "r", P.Settings(max_count=3))
    assert again.where("attempt != 1").count() == 0


def test_converters(spark):
    from lumenweave.generation import convert

    df = spark.createDataFrame([("p", ["Is it? Yes", None]), ("q", []), ("r", ["fail"])], "image_path string, qa array<string>")
    client = lambda: ScriptedClient([("fail", RuntimeError("down")), ("", "It is a big cat.\n short \n")])
    got = {r["image_path"]: (r["lines"], r["error"] and r["error"]["type"]) for r in convert.statements(df, client).collect()}
    assert got == {"p": (["It is a big cat."], None), "r": (None, "engine")}
    trees = spark.createDataFrame([("p", "x" * 21), ("q", "x" * 20), ("r", None)], "image_path string, text string")
    assert {r["image_path"]: r["lines"] for r in convert.tree_captions(trees, client).collect()} == {"p": ["It is a big cat.", "short"]}


def test_assigned_prompts(spark):
    shares = {r["prompt_type"]: r["count"] / 5000 for r in P.assign_prompts(spark.range(5000), DISTRIBUTIONS["LLaVA"], "id").groupBy("prompt_type").count().collect()}
    assert all(abs(shares[d["name"]] - d["weight"]) < 0.03 for d in DISTRIBUTIONS["LLaVA"])


def test_cleaning_that_was_broken_off(spark, tmp_path):
    rows = spark.createDataFrame([_result("a", 0, 0, ["q", "a"]), _result("b", 0, 0, [])], R.SCHEMA)
    R.append(rows, str(tmp_path))
    (tmp_path / "results").rename(tmp_path / "results-before")
    R.restore(spark, str(tmp_path))
    stored = lambda: spark.read.schema(R.SCHEMA).parquet(str(tmp_path / "results"))
    assert stored().count() == 2
    R.clean_table(stored(), str(tmp_path))
    assert [r["image_path"] for r in stored().collect()] == ["a"] and not (tmp_path / "results-before").exists()


def test_steps_and_json_array(spark, tmp_path):
    rows = spark.createDataFrame([_result("b", 1, 0, ["q", "a"]), _result("a", 0, 1, ["q"]), _result("a", 0, 0, ["q", "a"]), _result(None, 0, 0, ["q"])], R.SCHEMA)
    assert [(r["image_path"], r["step"]) for r in R.steps(rows).collect()] == [("a", 0), ("a", 1), ("b", 0)]
    R.write_json_array(R.export(rows), str(tmp_path / "x.json"))
    assert len(json.loads((tmp_path / "x.json").read_text())) == 3
    R.write_json_array(R.export(rows.limit(0)), str(tmp_path / "y.json"))
    assert json.loads((tmp_path / "y.json").read_text()) == []


def test_depths_by_masks(spark):
    depth = [[i * 10 + (j >= 8) * 1000 + j for j in range(16)] for i in range(16)]
    flat = [v for row in depth for v in row]
    mask = np.zeros((16, 16), dtype=bool)
    mask[:, 8:] = True
    objects = spark.createDataFrame([("p", 0, 0.0, 0.0, 0.5, 1.0, None, None), ("p", 1, 0.0, 0.0, 0.5, 1.0, bytearray(np.packbits(mask).tobytes()), 16), ("q", 0, 0.0, 0.0, 1.0, 1.0, None, None)], "image_path string, obj_id int, x1 double, y1 double, x2 double, y2 double, mask binary, mask_width int")
    maps = spark.createDataFrame([("p", flat, 16), ("p", flat, 16), ("r", [], 0)], "image_path string, depth array<int>, depth_width int")
    got = {(r["image_path"], r["obj_id"]): r["depths"] for r in B.with_depths(objects, maps).collect()}
    assert got[("q", 0)] == [] and got[("p", 0)] and got[("p", 1)] and max(got[("p", 1)]) < min(got[("p", 0)])


def test_types_of_pictures(spark):
    boxes = spark.createDataFrame([("p", 0, "cats, dog", 0.0, 0.0, 0.5, 0.5), ("p", 1, "cat (black)", 0.5, 0.5, 1.0, 1.0), ("p", 2, None, 0.0, 0.0, 1.0, 1.0)], "image_path string, obj_id int, label string, x1 double, y1 double, x2 double, y2 double")
    assert sorted((r["type"], r["n"]) for r in B.type_counts(boxes).collect()) == [("cat", 2), ("dog", 1)]
    got = {r["type"]: (r["n"], r["text"]) for r in B.group_averages(boxes).collect()}
    assert got["cat"] == (2, "[0.00, 0.00, 1.00, 1.00] [Average X: 0.50, Average Y: 0.50, Average Pixel Size: 25.0%]") and got["dog"][0] == 1
    assert B.type_counts(boxes.limit(0)).count() == 0
