"""Known answers for tracks, names, decisions, splits and integrity."""

import pytest
from pyspark.sql import functions as F

from strataline.functions import geometry, names, vectors
from strataline.operators import constraints, curate, encoders, profile, sampling
from strataline.schema import GALLERY, QUERY, TRAIN
from strataline.sources import listings, sinks, tables, tracks

C = F.col


def lines(spark, *rows):
    return spark.createDataFrame([(r,) for r in rows], "value string")


def test_track_lines(spark):
    got = tracks.parsed(lines(spark, "55,1,10.5,20,50.42,150,1,1,0.5", "54.9,1,10.5,20,50.42,150,1,8,0.5", "")).orderBy("frame").collect()
    assert [(r.frame, r.w, r.vis, r.cls) for r in got] == [(54, 50.42, 0.5, 8), (55, 50.42, 0.5, 1)]


def test_short_line_raises(spark):
    bad = lines(spark, "1,2,3,4,5")
    with pytest.raises(Exception, match="expected 9 fields"):
        tracks.parsed(bad).collect()
    assert tracks.malformed(bad).first().n_fields == 5
    assert tracks.parsed(bad, strict=False).count() == 0


def test_track_file(spark, tmp_path):
    (tmp_path / "a.txt").write_text("2,1,0,0,5,5,1,1,1\n\n1,1,0,0,5,5,1,1,1\n")
    assert [r.frame for r in tracks.read(spark, str(tmp_path)).orderBy("frame", "tid").collect()] == [1, 2]


@pytest.mark.parametrize(("change", "ok"), [({}, True), ({"h": 79}, False), ({"w": 31}, False), ({"vis": 0.64}, False), ({"x": 0}, False), ({"y": 1}, False), ({"x": 1860}, False), ({"y": 930}, False), ({"vis": float("nan")}, True), ({"x": float("nan")}, True)])
def test_floors(spark, change, ok):
    box = {"x": 500.0, "y": 300.0, "w": 60.0, "h": 150.0, "vis": 1.0} | {k: float(v) for k, v in change.items()}
    df = spark.createDataFrame([tuple(box.values())], ", ".join(f"{k} double" for k in box))
    cols = [C(k) for k in box]
    assert df.select(geometry.CropFloors().accepts(*cols)).first()[0] is ok
    if change == {"x": 0}:
        assert df.select(geometry.CropFloors(edge_margin=0).accepts(*cols)).first()[0] is True


def track(spark, frames, tids=(1,)):
    rows = [(1, 1, t, f, i) for t in tids for i, f in enumerate(frames)]
    return spark.createDataFrame(rows, "sequence bigint, camera bigint, tid bigint, frame bigint, position bigint")


def test_stride(spark):
    got = sampling.keep_stride(track(spark, range(1, 100), (1, 2)), 30)
    assert sorted((r.tid, r.frame) for r in got.collect()) == [(t, f) for t in (1, 2) for f in (1, 31, 61, 91)]
    assert sorted(r.frame for r in sampling.keep_stride(track(spark, range(41, 100)), 30).collect()) == [41, 71]
    assert sampling.keep_stride(track(spark, range(1, 6)), 1).count() == 5
    # a repeated frame has a gap of 0; the first in the input order stays
    twice = sampling.keep_stride(track(spark, [7, 7, 8]), 1).collect()
    assert sorted((r.frame, r.position) for r in twice) == [(7, 0), (8, 2)]
    assert sampling.keep_stride(track(spark, [7, 7, 8]), 0).count() == 3
    assert sampling.keep_stride(track(spark, []), 3).count() == 0


def test_stride_of_other_videos_is_apart(spark):
    rows = spark.createDataFrame([(1, 1, 1, 5, 0), (2, 1, 1, 6, 1)], "sequence bigint, camera bigint, tid bigint, frame bigint, position bigint")
    assert sampling.keep_stride(rows, 30).count() == 2


def test_names(spark):
    df = spark.createDataFrame([("0042_c15_f0001250.jpg",), ("-1_c3s2_012345_00.jpg",), ("bad.jpg",), (None,)], "name string")
    got = df.select(names.pid_of(C("name")), names.cam_of(C("name"))).collect()
    assert [tuple(r) for r in got] == [(42, 15), (-1, 3), (None, None), (None, None)]
    one = spark.range(1).select(names.crop_name(F.lit(10), F.lit(4), F.lit(8), F.lit(1234)), names.combined_name(F.lit(1), F.lit(2), F.lit("t"), F.lit("x.y.png")))
    assert tuple(one.first()) == ("10_c4_s08_f001234.jpg", "1_c2_t_x.y.jpg")


def test_listing_readers(spark):
    found = spark.createDataFrame([("1_c1.jpg",), ("2_c1.JPG",), ("3_c1.png",), ("bad.jpeg",), ("4_c1.bmp",)], "name string")
    assert listings.lenient(found).filter("NOT ok").count() == 1
    with pytest.raises(Exception, match="does not parse"):
        listings.strict(found).collect()
    assert [r.name for r in listings.loader(found).collect()] == ["1_c1.jpg", "3_c1.png"]
    assert listings.prediction_sources(found).count() == 5


def test_market_tree(spark, tmp_path):
    for split, pids in ((TRAIN, (100, 101, 102, -1)), (QUERY, (500,)), (GALLERY, (500, -1))):
        (tmp_path / split).mkdir()
        for p in pids:
            for cam in (1, 2):
                (tmp_path / split / f"{p}_c{cam}_f1.jpg").write_bytes(b"x")
    got = listings.read_market(spark, str(tmp_path))
    assert got.filter(C("split") == TRAIN).count() == 6
    assert {r.label for r in got.filter(C("split") == TRAIN).collect()} == {0, 1, 2}
    assert got.filter(C("split") == GALLERY).count() == 4
    with pytest.raises(Exception, match="[Pp]ath"):
        listings.read_market(spark, str(tmp_path / "none")).count()


def test_decisions(spark, tmp_path):
    df = spark.createDataFrame([(2,), (3,), (5,)], "pid bigint")
    acts = spark.createDataFrame([(2, "drop"), (3, "merge:17")], "pid bigint, action string")
    assert {r.pid: r.resolved for r in curate.decided(df, acts).collect()} == {2: None, 3: 17, 5: 5}
    wrong = spark.createDataFrame([(2, "kepe")], "pid bigint, action string")
    with pytest.raises(Exception, match="unknown action"):
        curate.decided(df, wrong).collect()
    assert constraints.unknown_actions(wrong).count() == 1 and constraints.unknown_actions(acts).count() == 0
    path = tmp_path / "d.csv"
    path.write_text("pid,action\n1,drop\n1, keep \n2,drop\n")
    assert {r.pid: r.action for r in tables.read_decisions(spark, str(path)).collect()} == {1: "keep", 2: "drop"}
    assert tables.read_decisions(spark, str(tmp_path / "none.csv")).count() == 0
    with pytest.raises(FileNotFoundError):
        tables.read_scores(spark, str(tmp_path / "none.csv"))


def test_routing(spark):
    df = spark.createDataFrame([(8, 1), (8, 3), (1, 1)], "pid bigint, camid bigint")
    assert [r[0] for r in df.select(curate.routed(C("pid"), C("camid"), (8,), 1)).collect()] == [QUERY, GALLERY, TRAIN]


def crops(spark, *rows):
    return spark.createDataFrame([(*r, f"n{i}") for i, r in enumerate(rows)], "split string, pid bigint, camid bigint, name string")


GOOD = ((TRAIN, 1, 1), (QUERY, 2, 1), (GALLERY, 2, 2), (GALLERY, -1, 1))


def test_integrity(spark):
    good = crops(spark, *GOOD)
    constraints.verify_build(good)
    for find in (constraints.leaking, constraints.missing_from_gallery, constraints.unanswerable_crops, constraints.unanswerable_identities, constraints.unknown_splits, constraints.repeated_names, constraints.empty_train):
        assert find(good).count() == 0, find.__name__
    assert [r.pid for r in constraints.leaking(crops(spark, *GOOD, (TRAIN, 2, 1))).collect()] == [2]
    junk = crops(spark, *GOOD, (TRAIN, -1, 1))
    assert constraints.leaking(junk).count() == 0 and constraints.leaking(junk, exclude_junk=False).count() == 1
    assert [r.pid for r in constraints.missing_from_gallery(crops(spark, *GOOD, (QUERY, 9, 1))).collect()] == [9]
    # one query camera is answered by the other query's camera alone: fine for each crop, not for the identity
    both = crops(spark, (QUERY, 2, 1), (QUERY, 2, 2), (GALLERY, 2, 1), (GALLERY, 2, 2))
    assert constraints.unanswerable_crops(both).count() == 0 and constraints.unanswerable_identities(both).count() == 1
    assert constraints.unanswerable_crops(crops(spark, (QUERY, -1, 1))).count() == 1
    assert constraints.unknown_splits(crops(spark, ("val", 1, 1))).count() == 1
    with pytest.raises(ValueError, match="such as"):
        constraints.enforce(constraints.unknown_splits(crops(spark, ("val", 1, 1))), "split not known")


def test_layout(spark, tmp_path):
    out = str(tmp_path / "out")
    for _ in range(2):
        assert sinks.write_layout(crops(spark, *GOOD), out) == {TRAIN: 1, QUERY: 1, GALLERY: 2}
    assert spark.read.parquet(out).count() == 4
    with pytest.raises(ValueError):
        sinks.write_layout(crops(spark, *GOOD, (TRAIN, 2, 1)), str(tmp_path / "bad"))
    assert not (tmp_path / "bad").exists()
    with pytest.raises(ValueError):
        sinks.write_manifest(spark.createDataFrame([], "file string, split string, source string, pid int, camid int, orig_pid int, orig_camid int, orig_file string"), out)


def test_scores_round_trip(spark, tmp_path):
    out = str(tmp_path / "s")
    sinks.write_scores(spark.createDataFrame([("b", 0.5), ("a", 0.9)], "file string, self_sim double"), out)
    assert {r.file: r.self_sim for r in tables.read_scores(spark, out).collect()} == {"a": 0.9, "b": 0.5}


@pytest.mark.parametrize(("score", "threshold", "pruned"), [(0.2, 0.45, True), (0.45, 0.45, False), (None, 0.45, False), (0.2, 0.0, False), (float("nan"), 0.45, False)])
def test_prune(spark, score, threshold, pruned):
    df = spark.createDataFrame([(score,)], "s double")
    assert df.select(vectors.is_pruned(C("s"), threshold)).first()[0] is pruned


def test_recipe(spark):
    one = {"name": "a", "tag": "a", "pid_offset": 0, "cam_offset": 0}
    assert tables.recipe(spark, {"name": "n", "sources": [one]})[1].first().use_eval is True
    for bad in ({"name": "n"}, {"name": "n", "sources": []}, {"name": "n", "sources": [one, one]}, {"name": "n", "sources": [{"name": "a"}]}):
        with pytest.raises(ValueError):
            tables.recipe(spark, bad)


def test_combine_keeps_junk(spark):
    rows = spark.createDataFrame([("a", TRAIN, -1, 1, "x.png"), ("a", TRAIN, 5, 1, "y.png"), ("b", QUERY, 5, 1, "z.png")], "source string, split string, pid bigint, camid bigint, file string")
    sources = spark.createDataFrame([("a", "ta", 100, 10, False), ("b", "tb", 0, 0, False)], tables.RECIPE_FIELDS)
    assert sorted((r.pid, r.camid, r.file) for r in curate.combined(rows, sources).collect()) == [(-1, 11, "-1_c11_ta_x.jpg"), (105, 11, "105_c11_ta_y.jpg")]
    assert profile.readme(curate.combined(rows, sources), "t").startswith("# t")


def test_upper_median(spark):
    rows = [(TRAIN, p, 1, f"{p}-{k}") for p, n in ((1, 1), (2, 2), (3, 3), (4, 10)) for k in range(n)]
    df = spark.createDataFrame(rows, "split string, pid bigint, camid bigint, name string")
    r = profile.crops_per_identity(df).first()
    assert (r.least, r["median"], r.most, r.below_2, r.below_4) == (1, 3, 10, 1, 3)


def test_batches(spark):
    df = spark.createDataFrame([(p, 100 * p + k) for p in range(6) for k in range(8 if p else 2)], "pid bigint, vec_id bigint")
    rows = sampling.batches(df, 16, 4).collect()
    by = {}
    for r in rows:
        by.setdefault(r.batch, {}).setdefault(r.pid, []).append(r.slot)
    assert all(len(b) == 4 and all(sorted(s) == [0, 1, 2, 3] for s in b.values()) for b in by.values())
    assert len(rows) <= sampling.epoch_length(df, 4).first().length
    with pytest.raises(ValueError):
        sampling.batches(df, 10, 4)
    with pytest.raises(ValueError):
        sampling.batches(df.filter("pid < 2"), 16, 4)


def test_rectangle_outside_is_empty(spark):
    df = spark.createDataFrame([(3000.0, 10.0, 50.0, 50.0)], "x double, y double, w double, h double")
    r = df.select(*geometry.crop_rectangle(C("x"), C("y"), C("w"), C("h"), 1920, 1080)).first()
    assert r.right == r.left


def test_streaming_stride(spark, tmp_path):
    from strataline.streaming import stride

    src = str(tmp_path / "in")
    track(spark, range(1, 100), (1, 2)).coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("sequence bigint, camera bigint, tid bigint, frame bigint, position bigint").parquet(src)
    q = stride.keep_stride(stream, 30).writeStream.format("memory").queryName("kept").outputMode("append").option("checkpointLocation", str(tmp_path / "cp")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r.frame for r in spark.table("kept").filter("tid = 2").collect()) == [1, 31, 61, 91]


def test_contiguous_by_ranges(spark, monkeypatch):
    from strataline.functions import ranges
    from strataline.sources import listings

    monkeypatch.setattr(ranges, "SMALL", 50)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        for key in ((F.col("id") * 7919 % 1009), F.concat(F.lit("k"), (F.col("id") * 31 % 400).cast("string"))):
            rows = spark.range(2000).select(key.alias("pid")).unionByName(spark.range(1).select(key.alias("pid")).filter("pid IS NULL"))
            keys = sorted({r.pid for r in rows.collect()})
            got = {r.pid: r.label for r in listings.contiguous(rows, "pid").collect()}
            assert got == {k: i for i, k in enumerate(keys)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_stride_across_batches_and_nulls(spark):
    rows = spark.createDataFrame([(1, 1, t, f, i, 2**53 + 1) for i, (t, f) in enumerate([(1, 5), (1, None), (1, 9), (None, 5), (None, 6), (None, 40), (2, 5)])], "sequence int, camera int, tid int, frame int, position int, extra bigint")
    got = sorted((r.position, r.extra) for r in sampling.keep_stride(rows, 30).collect())
    assert got == [(i, 2**53 + 1) for i in (0, 1, 3, 5, 6)]
    many = spark.range(3000).select(F.lit(1).alias("sequence"), F.lit(1).alias("camera"), F.lit(1).alias("tid"), F.col("id").alias("frame"), F.col("id").alias("position"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        assert sorted(r.frame for r in sampling.keep_stride(many, 30).collect()) == list(range(0, 3000, 30))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_batches_are_as_many_as_can_be(spark):
    """Against the definition, for many distributions: no batch has an identity twice, none more could be drawn."""
    import random

    draw = random.Random(12)
    for case in range(6):
        sizes = [draw.choice([1, 2, 3, 4, 9, 40, 130]) for _ in range(draw.randint(3, 30))]
        rows = [(1000 * p + j, p) for p, n in enumerate(sizes) for j in range(n)] + [(-1, None)]
        df = spark.createDataFrame(rows, "vec_id bigint, pid bigint")
        got = sampling.batches(df, 6, 2, seed=case).select("batch", "place", "pid", "chunk").distinct().collect()
        chunks = {p: max(1, n // 2) for p, n in enumerate(sizes)}
        by_batch, by_pid = {}, {}
        for r in got:
            by_batch.setdefault(r.batch, []).append((r.place, r.pid))
            by_pid.setdefault(r.pid, []).append((r.batch, r.chunk))
        assert sorted(by_batch) == list(range(len(by_batch)))
        assert all(sorted(x for x, _ in v) == [0, 1, 2] and len({p for _, p in v}) == 3 for v in by_batch.values())
        assert all([c for _, c in sorted(v)] == list(range(len(v))) for v in by_pid.values())
        assert sum(chunks[p] > len(by_pid.get(p, [])) for p in chunks) < 3
    assert sampling.batch_count({5: 1, 2: 1}, 2) == 2 and sampling.batch_count({}, 3) == 0
    assert [sampling.stride_of(n) for n in (1, 2, 10, 12)] == [1, 1, 3, 7]


def test_batches_by_ranges(spark, monkeypatch):
    from strataline.functions import ranges

    df = spark.createDataFrame([(100 * p + j, p) for p in range(80) for j in range(p % 11 + 1)], "vec_id bigint, pid bigint")
    one = sorted(map(tuple, sampling.batches(df, 12, 3).select("batch", "place", "pid", "chunk", "slot", "vec_id").collect()))
    monkeypatch.setattr(ranges, "SMALL", 10)
    assert sorted(map(tuple, sampling.batches(df.repartition(5), 12, 3).select("batch", "place", "pid", "chunk", "slot", "vec_id").collect())) == one


def test_page_of_a_build_with_its_sources(spark):
    from strataline.operators import profile
    from strataline.sources import tables

    rows = [(TRAIN, "a", p, c, p, f"{p}{c}") for p in (1, 2) for c in (1, 2)] + [("query", "a", 3, 1, 3, "q"), ("bounding_box_test", "a", 3, 2, 3, "g"), ("bounding_box_test", "a", -1, 2, -1, "j"), (TRAIN, "b", 1001, 11, 1, "x")]
    build = spark.createDataFrame(rows, "split string, source string, pid bigint, camid bigint, orig_pid bigint, orig_file string")
    sources = tables.recipe(spark, {"name": "n", "sources": [{"name": "a", "tag": "a", "pid_offset": 0, "cam_offset": 0}, {"name": "b", "tag": "b", "pid_offset": 1000, "cam_offset": 10, "use_eval": False}, {"name": "c", "tag": "c", "pid_offset": 5000, "cam_offset": 50}]})[1]
    got = {r.source: r for r in profile.composition(build, sources).collect()}
    assert (got["a"].train_ids, got["a"].train_crops, got["a"].eval_ids, got["a"].query_crops, got["a"].gallery_crops) == (2, 4, 1, 1, 2)
    assert (got["b"].percent, got["b"].one_in, got["c"].train_ids, got["c"].percent) == (33.3333, 3, 0, 0.0)
    page = profile.readme(build, "A build", sources)
    assert "| b | 1,000 | 10 | 1 identities, 1 crops | none | 33.33%, one in 3 |" in page and "not evaluated: b" in page
    assert "Offsets" not in profile.readme(build, "A build")


def test_recipe_problems(spark):
    full = '{"name": "a", "tag": "t", "pid_offset": 0, "cam_offset": 0}'
    texts = [(1, f'{{"name": "r", "sources": [{full}]}}'), (2, None), (3, "no recipe"), (4, '{"name": "r", "sources": []}'), (5, f'{{"sources": [{full}, {{"name": "b"}}, null]}}')]
    got = sorted((r.k, r.place, r.problem) for r in tables.recipe_problems(spark.createDataFrame(texts, "k int, value string")).collect() if r.k != 5)
    both = ["recipe lacks name", "recipe lacks sources"]
    assert got == [(2, None, both[0]), (2, None, both[1]), (3, None, both[0]), (3, None, both[1]), (4, None, "recipe has no sources")]
    five = {(r.place, r.problem) for r in tables.recipe_problems(spark.createDataFrame(texts[4:], "k int, value string")).collect()}
    fields = ("name", "tag", "pid_offset", "cam_offset")
    assert five == {(None, both[0])} | {(1, f"source lacks {f}") for f in fields[1:]} | {(2, f"source lacks {f}") for f in fields}
    assert tables.recipe_problems(spark.createDataFrame([], "k int, value string")).count() == 0


def test_missing_splits(spark, tmp_path):
    paths = spark.createDataFrame([("a/train/1.jpg",), ("a/query/1.jpg",), ("x/b/query/2.jpg",), ("loose.jpg",), (None,)], "path string")
    builds = spark.createDataFrame([("a",), ("a",), ("x/b",), ("c",), (None,)], "build string")
    got = sorted(tuple(r) for r in listings.missing_splits(paths, builds, ("query", "train")).collect())
    assert got == [("c", "query"), ("c", "train"), ("x/b", "train")]
    (tmp_path / listings.SPLITS[0]).mkdir()
    with pytest.raises(FileNotFoundError, match=listings.SPLITS[1]):
        listings.read_market(spark, str(tmp_path))


def test_batch_problems(spark):
    crops = spark.createDataFrame([(k % 3,) for k in range(9)] + [(None,)], "pid bigint")
    plans = spark.createDataFrame([(6, 2), (7, 2), (8, 2), (0, 2), (4, None), (4, 0)], "batch_size int, k int")
    got = {(r.batch_size, r.k): r.problem for r in sampling.batch_problems(crops, plans).collect()}
    positive = "sizes are not positive"
    assert got == {(7, 2): "the batch size is not a multiple of k", (8, 2): "there are fewer identities than a batch needs", (0, 2): positive, (4, None): positive, (4, 0): positive}


def test_unevaluable_groups_and_report(spark):
    q, g, t = QUERY, GALLERY, TRAIN
    rows = [("a", q, 1, 1), ("a", g, 1, 1), ("b", q, 2, 1), ("b", g, 2, 2), ("b", q, 3, 1), ("c", q, None, 1), ("c", q, 4, None), ("c", g, 4, 2), ("d", g, 5, 1)]
    crops = spark.createDataFrame(rows, "shop string, split string, pid bigint, camid bigint")
    assert sorted(tuple(r) for r in constraints.unevaluable(crops, ("shop",)).collect()) == [("a", 1), ("c", 2)]
    sound = spark.createDataFrame([("b", q, 2, 1), ("b", g, 2, 2), ("b", t, 7, 2)], crops.schema)
    assert constraints.build_report(sound).count() == 0
    broken = sound.unionByName(spark.createDataFrame([("b", t, 2, 1), ("b", q, 8, 1), ("b", q, 8, 1)], crops.schema))
    found = sorted(tuple(r) for r in constraints.build_report(broken).collect())
    assert found == [("leaking", 2, None, None), ("missing from gallery", 8, None, None), ("without a second camera", 8, 1, 2)]
    with pytest.raises(ValueError, match="train and evaluation"):
        constraints.verify_build(broken)


def test_registered_by_name(spark):
    encoders.register("by name", join="posixpath:join", broken="posixpath:nothing")
    assert encoders.action("by name", "join")("a", "b") == "a/b"
    assert callable(encoders.REGISTRY["by name"]["join"])
    with pytest.raises(AttributeError):
        encoders.action("by name", "broken")
    with pytest.raises(ValueError):
        encoders.action("by name", "train")
