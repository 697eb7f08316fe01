"""Queries that run whole operators, against the same made by hand from the test tables."""

import os

import pytest

import __spark_entry__ as entry
from lumenweave.generation.convert import statements
from lumenweave.generation.model import EchoClient

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data here")


def test_record_information(spark):
    run = lambda name: entry.queries()[name](spark, DATA)
    want = {r["ann_id"]: [] for r in run("annotation_records").collect()}
    for r in sorted(run("information_lines").collect(), key=lambda r: (r["ann_id"], r["pos"])):
        want[r["ann_id"]].append(r["line"])
    rows = spark.read.parquet(f"{DATA}/annotations.parquet").dropDuplicates(["ann_id"]).select("ann_id", "qa")
    stated = {r["ann_id"]: r["lines"] for r in statements(rows, EchoClient, ("ann_id",)).collect() if r["lines"]}
    boxes = {r["ann_id"]: r["text"] for r in run("box_flat_texts").collect() if r["text"]}
    assert stated and boxes
    for k in want:
        want[k] += stated.get(k, []) + ([boxes[k]] if k in boxes else [])
    assert {r["ann_id"]: r["information"] for r in run("record_information").collect()} == want


def test_picture_results(spark):
    chats = {r["export_id"]: r for r in spark.read.parquet(f"{DATA}/chat_exports.parquet").collect()}
    lists: dict[str, list] = {}
    for r in sorted(chats.values(), key=lambda r: (r["run_id"], r["export_id"])):
        lists.setdefault(r["image"], []).append((r["run_id"], r["export_id"], r["prompt_type"], len(r["conversations"])))
    got = {(r["image_path"], r["pos"]): (r["run_id"], r["attempt"], r["prompt_type"], r["n_messages"]) for r in entry.queries()["picture_results"](spark, DATA).collect()}
    assert got == {(image, i): x for image, rows in lists.items() for i, x in enumerate(rows)}


def test_orphans_of_all_kinds(spark):
    names = entry.queries()["p4_names"](spark, DATA).collect()
    got = {r["child"]: (r["n"], r["n_orphans"]) for r in entry.queries()["p4_orphans_by_kind"](spark, DATA).collect()}
    assert got.pop("name") == (len(names), sum(r["image_id"] is None or r["object_id"] is None for r in names))
    assert got == {r["child"]: (r["n"], r["n_orphans"]) for r in entry.queries()["p4_orphans"](spark, DATA).collect()} and len(got) == 3
