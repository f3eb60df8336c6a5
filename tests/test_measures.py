"""Known answers for retrieval, detection, mining, schedules and checkpoints."""

import math

import pytest
from pyspark.sql import functions as F

from strataline.functions import checkpoints, schedules, vectors
from strataline.operators import coherence, detection, encoders, mining, retrieval

C = F.col
CROPS = "vec_id bigint, pid bigint, camid bigint, embedding array<float>"


def crops(spark, *rows):
    return spark.createDataFrame([(i, p, c, [float(x) for x in v]) for i, (p, c, v) in enumerate(rows)], CROPS)


def unit(deg):
    return (math.cos(math.radians(deg)), math.sin(math.radians(deg)))


def test_perfect(spark):
    axes = [(1, 0, 0), (0, 1, 0), (0, 0, 1)]
    q = crops(spark, *[(p, 1, a) for p, a in enumerate(axes)])
    g = crops(spark, *[(p, c, a) for p, a in enumerate(axes) for c in (2, 3)])
    r = retrieval.checked(retrieval.evaluate(q, g))
    assert (r["map"], r["rank1"], r["queries"]) == (1.0, 1.0, 3)


def test_same_camera_alone_does_not_count(spark):
    q, g = crops(spark, (5, 3, (1, 0))), crops(spark, (5, 3, (1, 0)), (9, 1, (0, 1)))
    with pytest.raises(ValueError, match="cross-camera"):
        retrieval.checked(retrieval.evaluate(q, g))


def test_known_precision(spark):
    q = crops(spark, (1, 1, unit(0)))
    g = crops(spark, (2, 2, unit(5)), (1, 2, unit(10)), (1, 3, unit(20)), (-1, 2, unit(90)))
    r = retrieval.evaluate(q, g, (1, 5)).first()
    assert r["map"] == pytest.approx((1 / 2 + 2 / 3) / 2) and r["rank1"] == 0 and r["rank5"] == 1
    pairs = retrieval.ranked_pairs(q, g).filter("matched").orderBy("rank").collect()
    assert [p["rank"] for p in pairs] == [2, 3]


def test_hit_beyond_the_curve(spark):
    q = crops(spark, (1, 1, unit(0)))
    g = crops(spark, (2, 2, unit(5)), (3, 2, unit(10)), (1, 3, unit(20)))
    r = retrieval.evaluate(q, g, (1, 2)).first()
    assert (r["rank1"], r["rank2"]) == (0, 0)


def test_ties_go_by_gallery_id(spark):
    q = crops(spark, (1, 1, (1, 0)))
    g = crops(spark, (2, 2, (1, 0)), (1, 2, (1, 0)))
    assert retrieval.match_ranks(q, g).first()["rank"] == 2


def test_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [0.0, 1.0])], "a array<float>, b array<float>")
    assert [r[0] for r in df.select(vectors.cosine_distance("a", "b")).collect()] == [0.0, 1.0]
    zero = spark.createDataFrame([([0.0, 0.0],)], "a array<float>")
    assert zero.select(vectors.normalised("a", 0)).first()[0] == [0.0, 0.0]


def test_coherence(spark):
    rows = crops(spark, (1, 1, unit(0)), (1, 2, unit(20)), (2, 1, unit(180)))
    got = {r.pid: r for r in coherence.report(rows).collect()}
    assert got[1].coherence == pytest.approx(math.cos(math.radians(10)), abs=1e-6) and got[1].cameras == 2
    assert got[2].least == pytest.approx(1, abs=1e-6)
    assert coherence.closest_identities(rows).first().check is False
    assert coherence.across_groups(rows, "camid").first().sim == pytest.approx(math.cos(math.radians(20)), abs=1e-6)


BOX = "image_id bigint, category_id bigint, {} bigint, x double, y double, w double, h double"


def test_identity_pairs_query_has_no_limit(spark, monkeypatch):
    from strataline.plans import measures

    crops = spark.createDataFrame([(p, [1.0, float(p)]) for p in range(5)], "pid int, embedding array<double>")
    monkeypatch.setattr(measures.fx, "crops", lambda s, d: crops)
    out = measures.jn5(spark, "")
    assert out.count() == 10 and "Limit" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_detection_summary(spark):
    gt = spark.createDataFrame([(1, 1, 1, 0.0, 0.0, 10.0, 10.0), (1, 1, 2, 100.0, 0.0, 50.0, 50.0), (2, 1, 3, 0.0, 0.0, 200.0, 200.0)], BOX.format("gt_id"))
    exact = gt.withColumnRenamed("gt_id", "dt_id").withColumn("score", F.lit(0.9))
    r = detection.summary(exact, gt).first()
    assert all(r[n] == pytest.approx(1.0) for n in detection.NAMES if n != "AR1") and r.AR1 == pytest.approx(2 / 3)
    none = detection.summary(exact.filter("score < 0"), gt).first()
    assert all(none[n] == 0.0 for n in detection.NAMES)
    # a better-scored wrong detection halves the precision from there on; small and large have their own share
    wrong = exact.unionByName(spark.createDataFrame([(2, 1, 9, 500.0, 500.0, 10.0, 10.0, 0.95)], BOX.format("dt_id") + ", score double"))
    assert detection.summary(wrong, gt).first().AP == pytest.approx(0.75)
    # only the large object is found: the small range has no hit, ranges without objects would be -1
    large = exact.filter("dt_id = 3")
    r = detection.summary(large, gt).first()
    assert r.AP_large == pytest.approx(1.0) and r.AP_small == 0.0 and r.AP == pytest.approx(34 / 101)
    assert detection.summary(large, gt.filter("gt_id = 3")).first().AP_small == -1.0


def test_greedy_claims(spark):
    gt = spark.createDataFrame([(1, 1, 1, 0.0, 0.0, 100.0, 100.0)], BOX.format("gt_id"))
    dt = spark.createDataFrame([(1, 1, 1, 0.0, 0.0, 100.0, 100.0, 0.8), (1, 1, 2, 1.0, 0.0, 100.0, 100.0, 0.9)], BOX.format("dt_id") + ", score double")
    hits = {r.dt_id: r.hit for r in detection.matched(dt, gt).filter("threshold = 0.5 AND area = 'all'").collect()}
    assert hits == {2: True, 1: False}


def test_triplets(spark):
    def loss(points, margin):
        rows = [(0, i, label, [float(x)]) for i, (label, x) in enumerate(points)]
        df = spark.createDataFrame(rows, "batch bigint, item bigint, label bigint, embedding array<float>")
        return mining.triplet_loss(df, margin).first().loss

    spread = [(0, 0), (0, 1), (1, 3), (1, 4)]
    assert loss(spread, 0.3) == pytest.approx(0.0) and loss(spread, 2.0) == pytest.approx(0.5)
    assert loss([(0, 1), (0, 1), (1, 1), (1, 1)], None) == pytest.approx(math.log(2), abs=1e-4)
    with pytest.raises(ValueError):
        loss([(0, 0), (1, 1), (2, 2)], None)


def test_cosine_schedule(spark):
    r = [x[0] for x in spark.range(121).select(schedules.cosine_rate(C("id"), 4e-4, 120, 20)).collect()]
    assert r[0] == pytest.approx(4e-6) and r[120] == pytest.approx(8e-7)
    assert all(a < b for a, b in zip(r[:19], r[1:20], strict=True)) and all(a > b for a, b in zip(r[20:119], r[21:120], strict=True))


def test_checkpoint_keys(spark):
    df = spark.createDataFrame([("base.cls_token", [1, 1, 64]), ("base.blocks.1.x", [1]), ("base.patch_embed.proj.weight", [64, 3, 8, 8]), ("bottleneck.w", [64]), ("classifier.w", [9])], "key string, shape array<bigint>")
    parts = checkpoints.split_keys(df, ("classifier",))
    assert {(r.group, r.key) for r in parts.collect()} == {("backbone", "cls_token"), ("backbone", "blocks.1.x"), ("backbone", "patch_embed.proj.weight"), ("neck", "w")}
    assert tuple(checkpoints.architecture(parts.filter("group = 'backbone'")).first()) == (64, 2, 8)
    for bad in ("other.w", "base.sie_embed"):
        with pytest.raises(Exception):  # noqa: B017
            checkpoints.split_keys(spark.createDataFrame([(bad, [1])], "key string, shape array<bigint>"), ()).collect()


def test_registry():
    encoders.register("toy", predict=len)
    assert encoders.action("toy", "predict") is len
    with pytest.raises(ValueError):
        encoders.action("toy", "train")


def test_curves_by_ranges_equal_one_range(spark, monkeypatch):
    from strataline.functions import ranges

    rows = spark.range(3000).select(
        F.when(C("id") % 3 == 0, C("id") % 7).alias("category_id"), F.lit("all").alias("area"), F.lit(0.5).alias("threshold"), C("id").alias("dt_id"),
        F.when(C("id") % 50 == 0, None).otherwise((C("id") * 31 % 40) / 40).alias("score"), (C("id") % 3 != 0).alias("hit"), F.lit(2000).alias("n_gt"),
    )
    columns = ["dt_id", "tp", "fp", "precision", "recall", "envelope"]
    one = sorted(detection.curves(rows).select(*columns).collect())
    monkeypatch.setattr(ranges, "SMALL", 100)
    spark.conf.set("spark.sql.shuffle.partitions", "9")
    try:
        assert sorted(detection.curves(rows).select(*columns).collect()) == one and len(one) == 3000
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_claims_keep_ids_beside_nulls(spark):
    big = 2**53 + 1
    gt = spark.createDataFrame([(big, 1, 1, 0.0, 0.0, 10.0, 10.0), (None, 1, 2, 0.0, 0.0, 10.0, 10.0)], BOX.format("gt_id"))
    dt = spark.createDataFrame([(big, 1, big, 0.0, 0.0, 10.0, 10.0, 0.8), (big - 1, 1, 5, 0.0, 0.0, 10.0, 10.0, 0.7), (None, 1, None, 0.0, 0.0, 10.0, 10.0, 0.9)], BOX.format("dt_id") + ", score double")
    hits = {r.dt_id: r.hit for r in detection.matched(dt, gt).filter("threshold = 0.5 AND area = 'all'").collect()}
    assert hits == {big: True, 5: False, None: True}


def test_match_ranks_in_small_blocks(spark, monkeypatch):
    rows = [(i % 5, 1 + i % 3, unit(37 * i % 90)) for i in range(60)]
    q, g = crops(spark, *rows[:20]), crops(spark, *rows[20:], rows[21])
    g = g.unionByName(g.filter("vec_id = 7"))  # a repeated row
    want = sorted(tuple(r) for r in retrieval.ranked_pairs(q, g).filter("matched").select("q_id", "g_id", "rank").collect())
    whole = sorted(tuple(r) for r in retrieval.match_ranks(q, g).collect())
    for name, size in (("PART", 7), ("BLOCK", 3), ("TOGETHER", 2), ("STRIP", 2)):
        monkeypatch.setattr(retrieval, name, size)
    got = sorted(tuple(r) for r in retrieval.match_ranks(q, g).collect())
    assert got == whole and len(got) == len(want)
    assert [r for r in got if r[1] != 7][:1] and {r[:2] for r in got} == {r[:2] for r in want}


def test_matches_are_counted_where_they_are_held(spark, monkeypatch):
    """Nothing is shuffled after the gallery has passed the queries; measures of queries are those of the ranks."""
    rows = [(i % 4, 1 + i % 3, unit(10 * (i % 5))) for i in range(60)]  # many ties
    q, g = crops(spark, *rows[:12]), crops(spark, *rows[12:])
    for found in (retrieval.match_ranks(q, g), retrieval.per_query(q, g)):
        assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString().split("MapInArrow")[0]
    pairs = retrieval.ranked_pairs(q, g).filter("matched").collect()
    want = {k: sorted(p["rank"] for p in pairs if p["q_id"] == k) for k in range(12)}
    assert sorted((r.q_id, r.g_id, r["rank"]) for r in retrieval.match_ranks(q, g).collect()) == sorted((p["q_id"], p["g_id"], p["rank"]) for p in pairs)
    for together in (retrieval.TOGETHER, 5):
        monkeypatch.setattr(retrieval, "TOGETHER", together)
        got = {r.q_id: (r.matches, r.first_hit, round(r.ap, 9)) for r in retrieval.per_query(q, g).collect()}
        assert got == {k: (len(x), x[0], round(sum((i + 1) / r for i, r in enumerate(x)) / len(x), 9)) for k, x in want.items()}


def test_near_crops_are_looked_at_in_turns(monkeypatch):
    import numpy as np

    v, d = np.ones((40, 2)), np.full(30, -2.0)
    for turn in (1 << 20, 50):
        monkeypatch.setattr(retrieval, "AT_ONCE", turn)
        n = retrieval.closer(v, np.arange(40), np.ones((2, 2)), [d, d], [np.arange(30), np.arange(5, 35)])
        assert [x.tolist() for x in n] == [list(range(30)), list(range(5, 35))]


def test_closest_identities_in_small_blocks(spark, monkeypatch):
    rows = crops(spark, *[(p, 1, unit(7 * p * p % 180)) for p in range(23)])
    want = [tuple(r) for r in coherence.closest_identities(rows, 6).select("pid_a", "pid_b").collect()]
    plain = coherence.identity_pairs(rows, floor=None).select("pid_a", "pid_b", F.round("sim", 9).alias("sim")).collect()
    least = sorted((r.sim for r in plain), reverse=True)[5]
    assert len(want) == 6 and set(want) <= {(r.pid_a, r.pid_b) for r in plain if r.sim >= least}
    monkeypatch.setattr(coherence, "BLOCK", 5)
    monkeypatch.setattr(coherence, "STRIP", 2)
    assert {tuple(r) for r in coherence.closest_identities(rows, 6).select("pid_a", "pid_b").collect()} == set(want)


@pytest.mark.parametrize("seed, dims", [(1, 2), (2, 6), (3, 24)])
def test_pruned_counts_are_full_counts(spark, monkeypatch, seed, dims):
    """Parts that are counted whole or not at all give the ranks of a full sort, with ties and repeated crops."""
    import numpy as np

    draw = np.random.default_rng(seed)
    centres = draw.normal(size=(9, dims))
    v = centres[draw.integers(0, 9, 400)] + draw.normal(size=(400, dims)) * 0.05
    v[200:260] = v[140:200]  # equal vectors of other identities
    v = (v / np.linalg.norm(v, axis=1, keepdims=True)).round(6) * (1 + draw.random(400) / 50)[:, None]  # not quite of one length
    rows = crops(spark, *[(int(draw.integers(-1, 12)), int(draw.integers(1, 4)), list(x)) for x in v])
    q, g = rows.filter("vec_id % 6 = 0"), rows.filter("vec_id % 6 <> 0")
    want = sorted(tuple(r) for r in retrieval.ranked_pairs(q, g).filter("matched").select("q_id", "g_id", "rank").collect())
    reads = []
    monkeypatch.setattr(retrieval, "decide", lambda d, vec, b, f=retrieval.decide: f(d, vec, b))
    for part, ring in ((10, 1 / 512), (25, 1 / 4)):
        monkeypatch.setattr(retrieval, "PART", part)
        monkeypatch.setattr(retrieval, "RING", ring)
        monkeypatch.setattr(retrieval, "BLOCK", 7)
        assert sorted(tuple(r) for r in retrieval.match_ranks(q, g).collect()) == want
        index, bounds = retrieval.indexed(g.select(C("vec_id").alias("g_id"), C("embedding").cast("array<double>").alias("g_vec")), retrieval.pivots_of(v))
        held = {r.part: r.n for r in index.groupBy("part").agg(F.count("*").alias("n")).collect()}
        assert held == dict(zip(bounds.parts.tolist(), bounds.rows.tolist(), strict=True)) and len(held) > 5
        for row in index.limit(40).collect():
            low, high = bounds.of(v[0])
            at = bounds.parts.tolist().index(row.part)
            assert low[at] <= -float(v[0] @ np.array(row.g_vec)) <= high[at]
        counts, read = retrieval.decide(np.sort(-(v[:1] @ v.T)[0][:5]), v[0], bounds)
        reads.append((len(read), len(held)))
    if dims == 2:  # clusters in the plane: most parts are never read
        assert reads[0][0] < reads[0][1] / 2


def test_pairs_above_a_floor_in_pruned_blocks(spark, monkeypatch):
    """Blocks of centroids that cannot hold a close pair never meet; pairs and their order are those of all pairs."""
    import numpy as np

    from strataline.operators import pivots

    draw = np.random.default_rng(11)
    v = np.repeat(draw.normal(size=(20, 3)), 12, axis=0) + draw.normal(size=(240, 3)) * 0.02
    v[100:112] = v[100]
    rows = crops(spark, *[(p, 1, list(x)) for p, x in enumerate((v / np.linalg.norm(v, axis=1, keepdims=True)).round(5))])
    every = sorted(map(tuple, coherence.identity_pairs(rows, floor=None).collect()), key=lambda r: (-r[2], -r[0], -r[1]))
    assert len(every) == 240 * 239 // 2
    monkeypatch.setattr(coherence, "BLOCK", 9)
    monkeypatch.setattr(coherence, "STRIP", 4)
    assert sorted(map(tuple, coherence.identity_pairs(rows, floor=None).collect())) == sorted(every)
    above = coherence.identity_pairs(rows, floor=0.9)
    assert "Cartesian" not in above._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, above.collect())) == sorted(r for r in every if r[2] >= 0.9)
    got = [tuple(r)[:3] for r in coherence.closest_identities(rows, 50).collect()]
    assert got == every[:50]
    blocks, bounds, _ = coherence._blocks(rows, "embedding")
    met = sum(int((bounds.between(k) >= 0.9).sum()) for k in range(len(bounds.parts)))
    assert len(bounds.parts) > 15 and met < len(bounds.parts) ** 2 / 2
    assert pivots.PIVOTS >= 1


def test_pairs_of_two_blocks_go_on_strip_by_strip(spark, monkeypatch):
    """A block's pairs are never one table in a task: no group is handed to Python whole, ids may be of any type."""
    rows = crops(spark, *[(p, 1, (1, p / 1000)) for p in range(40)]).withColumn("pid", C("pid").cast("string"))
    monkeypatch.setattr(coherence, "BLOCK", 15)
    pairs = coherence.identity_pairs(rows)
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan and "MapInArrow" in plan
    assert sorted((r.pid_a, r.pid_b) for r in pairs.collect()) == sorted((a, b) for a in map(str, range(40)) for b in map(str, range(40)) if a < b)


def test_quantiles_by_refined_histograms(spark, monkeypatch):
    import numpy as np

    from strataline.operators import selection

    draw = np.random.default_rng(4)
    rows = [(k % 3, float(x)) for k, x in enumerate(draw.normal(size=900))] + [(3, 0.5)] * 50 + [(4, float(x)) for x in 1 / np.arange(1, 200) ** 9]
    rows += [(5, None), (6, 1.0), (7, 1.0), (7, 3.0), (None, 2.0), (None, 4.0), (8, float("nan")), (8, 1.0), (8, None)] + [(9, float("nan"))] * 30 + [(9, 2.0)]
    df = spark.createDataFrame(rows, "k bigint, x double")
    want = {r.k: r.q for r in df.groupBy("k").agg(F.percentile("x", 0.05).alias("q")).collect() if r.q is not None}
    for buckets, gathered in ((1024, 1024), (16, 5), (4, 1)):
        monkeypatch.setattr(selection, "BUCKETS", buckets)
        monkeypatch.setattr(selection, "GATHERED", gathered)
        got = {r.k: r.q for r in selection.quantiles(df, "k", "x", 0.05).collect()}
        assert got == pytest.approx(want, nan_ok=True) and len(got) == 10


def test_coherence_of_large_identities(spark, monkeypatch):
    from strataline.operators import selection

    rows = crops(spark, *[(p % 4 if p % 9 else None, p % 3, unit(p * p % 97)) for p in range(300)])
    few = sorted(map(tuple, coherence.report(rows).collect()), key=repr)
    monkeypatch.setattr(selection, "GATHERED", 3)
    monkeypatch.setattr(selection, "BUCKETS", 8)
    many = sorted(map(tuple, coherence.report(rows).collect()), key=repr)
    assert [r[:3] for r in many] == [r[:3] for r in few]
    assert [r[3:] for r in many] == [pytest.approx(r[3:]) for r in few]
    assert "percentile" not in coherence.report(rows)._jdf.queryExecution().optimizedPlan().toString()


def walked(boxes, scores_first, crowd, detections):
    """Claims cell by cell, for one image: what bit-parallel claims have to give."""
    def iou(d, g, c):
        w = max(0, min(d[0] + d[2], g[0] + g[2]) - max(d[0], g[0]))
        h = max(0, min(d[1] + d[3], g[1] + g[3]) - max(d[1], g[1]))
        over = d[2] * d[3] if c else d[2] * d[3] + g[2] * g[3] - w * h
        return w * h / over if over > 0 else 0

    hits, out = [0] * len(detections), [0] * len(detections)
    for bit, (area, t) in enumerate(detection.CELLS):
        low, high = detection.AREAS[area]
        skip = [c or not low <= g[2] * g[3] <= high for g, c in zip(boxes, crowd, strict=True)]
        taken = set()
        for i, d in enumerate(detections):
            best, at = t, None
            for ignored in (False, True):
                if at is not None:
                    break
                for j, g in enumerate(boxes):
                    v = iou(d, g, crowd[j])
                    if skip[j] == ignored and v >= best and (j not in taken or crowd[j]):
                        best, at = v, j
            if at is not None:
                taken.add(at)
                hits[i] |= 1 << bit
            if skip[at] if at is not None else not low <= d[2] * d[3] <= high:
                out[i] |= 1 << bit
    return hits, out


@pytest.mark.parametrize("pairs", [1, 40, 1 << 20])
def test_bit_parallel_claims_are_those_of_each_cell(monkeypatch, pairs):
    import numpy as np

    monkeypatch.setattr(detection, "PAIRS", pairs)
    draw = np.random.default_rng(7)
    groups, rows, crowds, edge = [], [], [], [0]
    for _ in range(25):
        g = [tuple(draw.integers(0, 12, 2)) + tuple(draw.choice([10, 30, 31, 32, 33, 95, 96, 97], 2)) for _ in range(draw.integers(0, 7))]
        d = [tuple(np.array(g[draw.integers(len(g))]) + [*draw.integers(-2, 3, 2), 0, 0]) if g and draw.random() < 0.8 else (0, 0, *draw.integers(0, 40, 2)) for _ in range(draw.integers(0, 9))]
        c = [bool(x) for x in draw.random(len(g)) < 0.2]
        groups.append((g, c, d))
        if g or d:
            rows += [*g, *d]
            crowds += [*c, *[False] * len(d)]
            edge.append(len(rows))
    kept = [x for x in groups if x[0] or x[2]]
    first, end = np.array(edge[:-1]), np.array(edge[1:])
    middle = first + np.array([len(g) for g, _, _ in kept])
    _, hits, out = detection._claimed(np.array(rows, float), np.array(crowds), first, middle, end)
    for (g, c, d), m, b in zip(kept, middle, end, strict=True):
        want = walked([tuple(map(float, x)) for x in g], None, c, [tuple(map(float, x)) for x in d])
        assert (hits[m:b].tolist(), out[m:b].tolist()) == want


def test_summary_by_ranges_and_categories(spark, monkeypatch):
    """Steps of several ranges and categories are those of curves computed row by row."""
    from strataline.functions import ranges

    rows = spark.range(1200).select((C("id") % 40).alias("image_id"), F.when(C("id") % 11 == 0, None).otherwise(C("id") % 3).alias("category_id"), C("id").alias("gt_id"), (C("id") * 37 % 500).cast("double").alias("x"), (C("id") * 53 % 500).cast("double").alias("y"), (10 + C("id") * 7 % 120).cast("double").alias("w"), (10 + C("id") * 5 % 110).cast("double").alias("h"))
    truth = rows.filter("category_id < 2")
    dt = rows.filter("gt_id % 4 <> 0").withColumnRenamed("gt_id", "dt_id").withColumns({"x": C("x") + C("dt_id") % 9, "score": F.when(C("dt_id") % 50 == 0, None).otherwise(C("dt_id") * 31 % 97 / 97)})
    one = detection.summary(dt, truth).first()
    monkeypatch.setattr(ranges, "SMALL", 60)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        assert detection.summary(dt, truth).first() == one
        claims = detection.claims(dt, truth).cache()
        objects = detection._objects(claims).filter("n_gt > 0")
        run = detection.curves(detection._by_cell(claims).filter("NOT ignored").join(objects, ["category_id", "area"]))
        ap = {}
        for r in run.collect():
            at = int(r.recall * 100 + 1e-9)
            points = ap.setdefault((r.category_id, r.area, r.threshold), [0] * 101)
            for k in range(at + 1):
                points[k] = max(points[k], r.precision)
        cells = {(r.category_id, r.area, t) for r in objects.filter("category_id IS NOT NULL").collect() for t in detection.THRESHOLDS}
        mean = lambda keep: sum(sum(ap.get(c, [0])) / 101 for c in cells if keep(c)) / sum(1 for c in cells if keep(c))
        assert one.AP == pytest.approx(mean(lambda c: c[1] == "all")) and one.AP_medium == pytest.approx(mean(lambda c: c[1] == "medium"))
        assert one.AP75 == pytest.approx(mean(lambda c: c[1] == "all" and c[2] == 0.75))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "2")


def test_pairs_of_blocks_shuffle_no_vectors(spark, monkeypatch):
    """Only numbers of blocks are dealt, whatever their vectors and pairs: tasks read the blocks themselves."""
    rows = crops(spark, *[(p, 1, unit(p)) for p in range(60)])
    monkeypatch.setattr(coherence, "BLOCK", 7)
    pairs = coherence.identity_pairs(rows, floor=0.5)
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" in plan and "g_vec" not in plan
    want = {(a, b) for a in range(60) for b in range(a + 1, 60) if b - a < 60}
    assert sorted((r.pid_a, r.pid_b) for r in pairs.collect()) == sorted(want)


def test_blocks_of_queries_shuffle_no_gallery(spark, monkeypatch):
    """However many blocks the queries lie in, only queries are dealt to them: tasks read the gallery themselves."""
    rows = [(i % 5, 1 + i % 3, unit(7 * i % 180)) for i in range(60)]
    q, g = crops(spark, *rows[:9]), crops(spark, *rows[9:])
    want = sorted(tuple(r) for r in retrieval.ranked_pairs(q, g).filter("matched").select("q_id", "g_id", "rank").collect())
    for name, size in (("PART", 20), ("BLOCK", 2)):
        monkeypatch.setattr(retrieval, name, size)
    found = retrieval.match_ranks(q, g)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and "g_vec" not in plan and "parts-" not in plan
    assert sorted(map(tuple, found.collect())) == want


@pytest.mark.parametrize("side", ["left", "right"])
def test_places_of_many_among_few(side):
    import numpy as np

    draw = np.random.default_rng(5)
    for few, many in ((0, 9), (1, 3), (4, 100), (30, 4)):
        line, places = np.sort(draw.integers(0, 12, few)).astype(float), np.sort(draw.integers(0, 12, many)).astype(float)
        assert retrieval._before(line, places, side).tolist() == np.searchsorted(line, places, side).tolist()
