from collections import defaultdict

from lumenweave.llm import mixing as M


def test_shares_and_caps(spark):
    rows = [(i, s, ["x" * (1 + i % 9), None, ""]) for i, s in enumerate(["a"] * 600 + [" A/"] * 300 + ["b"] * 60 + ["tiny"] * 3 + ["none"] * 100)]
    rows += [rows[0], (5000, None, ["y"]), (5001, "b", None), (None, "b", ["lost"]), (5002, "c", []), (5003, "/", ["q"])]
    ann = spark.createDataFrame([(*r, "clash") for r in rows], "ann_id bigint, image_source string, captions array<string>, size string")
    targets = spark.createDataFrame([("m", "a", 3.0, None, 0.5), ("m", "b", 1.0, 2, 0.5), ("m", "tiny", 1.0, 2, 0.5), ("m", "gone", 1.0, 5, 0.5), ("m", "c", 0.0, 1, 0.5), ("n", "A", -1.0, 1, 0.1)], "mix_name string, image_source string, weight double, max_repeats int, size_ratio double")
    mixed, report = M.mix(ann, targets, buckets=8)
    used = {r["ann_id"]: r for r in mixed.where("mix_name = 'm'").collect()}
    size = lambda cs: sum(len(c) for c in cs or [] if c)
    sizes = {r[0]: size(r[2]) for r in rows if r[0] is not None}
    assert all(u["size"] == sizes[i] for i, u in used.items())
    total = sum(sizes.values())
    rep = {r["image_source"]: r for r in report.where("mix_name = 'm'").collect()}
    assert set(rep) == {"a", "b", "tiny", "gone", "c"} and abs(rep["a"]["budget"] - total * 0.5 * 3 / 6) < 1e-6
    assert abs(rep["a"]["actual_size"] - rep["a"]["budget"]) <= 5  # within half a record
    assert rep["tiny"]["most_repeats"] == 2 and rep["tiny"]["actual_size"] == 2 * sum(sizes[i] for i in range(960, 963)) < rep["tiny"]["budget"]
    assert rep["gone"]["n_records"] == 0 and rep["gone"]["actual_share"] == 0 and abs(sum(r["actual_share"] for r in rep.values()) - 1) < 1e-9
    by = defaultdict(int)
    for u in used.values():
        by[u["image_source"]] += u["size"] * u["repeats"]
    assert by == {k: r["actual_size"] for k, r in rep.items() if r["actual_size"]}
    assert [r["n_records"] for r in report.where("mix_name = 'n'").collect()] == [0]
    again = M.mix(ann.repartition(7), targets, buckets=64)[0]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, mixed.collect()))


def test_prefix_sums(spark):
    rows = [(i, "s" if i % 3 else "t", i % 5, (i * 7919) % 2**32) for i in range(200)] + [(500, "s", 3, 7919), (501, "s", 2, 2**32 - 1)]
    df = spark.createDataFrame(rows, "id bigint, source string, size bigint, key bigint")
    got = {r["id"]: (r["start"], r["source_size"]) for r in M.prefix_sums(df, 4).collect()}
    for s in "st":
        own, start = sorted((r for r in rows if r[1] == s), key=lambda r: (r[3], r[0])), 0
        for r in own:
            assert got[r[0]] == (start, sum(x[2] for x in own))
            start += r[2]


def test_empty(spark):
    ann = spark.createDataFrame([], "ann_id bigint, image_source string, captions array<string>")
    targets = spark.createDataFrame([("m", "a", 1.0, 1, 0.5)], "mix_name string, image_source string, weight double, max_repeats int, size_ratio double")
    mixed, report = M.mix(ann, targets)
    assert mixed.count() == 0 and report.collect()[0]["actual_size"] == 0
    assert M.mix(ann, targets.limit(0))[1].count() == 0
