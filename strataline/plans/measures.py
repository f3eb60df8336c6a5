"""Queries over vectors and detections: coherence, retrieval, overlap, mining."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from strataline.operators import coherence, detection, mining, retrieval
from strataline.plans import fixtures as fx
from strataline.plans.fixtures import given
from strataline.plans.inventory import ORACLE_SQL, QUERIES, C, query  # noqa: F401  one registry
from strataline.session import shared_dir


def _dot(a: str, b: str) -> str:
    return f"list_sum(list_transform(range(1, 65), lambda k: {a}[k] * {b}[k]))"


_MEANS = """, means AS (SELECT {keys}, pos, avg(v) AS m FROM (SELECT {keys}, unnest(embedding) AS v, unnest(range(1, 65)) AS pos FROM {rows}) GROUP BY {keys}, pos),
    vecs AS (SELECT {keys}, list(m ORDER BY pos) AS v FROM means GROUP BY {keys}),
    cents AS (SELECT {keys}, list_transform(v, lambda x: x / (sqrt(list_sum(list_transform(v, lambda y: y * y))) + 1e-9)) AS c FROM vecs) """
_BY_PID = given("crops") + _MEANS.format(keys="pid", rows="crops")
_SELF = _BY_PID + f", sims AS (SELECT crops.pid, camid, vec_id, {_dot('embedding', 'c')} AS sim FROM crops JOIN cents ON crops.pid = cents.pid) "


@query("ag9_centroids", _BY_PID + "SELECT pid, round(c[1], 6) AS v0, round(c[2], 6) AS v1, round(c[64], 6) AS v63 FROM cents")
def ag9(s, d):
    c = coherence.centroids(fx.crops(s, d), "pid")
    return c.select("pid", *[F.round(F.element_at("centroid", k + 1), 6).alias(f"v{k}") for k in (0, 1, 63)])


@query("ag10_self_similarity", _SELF + "SELECT vec_id, pid, round(sim, 6) AS self_sim FROM sims")
def ag10(s, d):
    return coherence.self_similarity(fx.crops(s, d)).select("vec_id", "pid", F.round("self_sim", 6).alias("self_sim"))


@query("jn7_own_centroid", _SELF + "SELECT vec_id, sim < 0.10 AS pruned FROM sims")
def jn7(s, d):
    from strataline.functions import vectors

    return coherence.self_similarity(fx.crops(s, d)).select("vec_id", vectors.is_pruned(C("self_sim"), 0.10).alias("pruned"))


@query("ag11_coherence", _SELF + "SELECT pid, count(*) AS crops, count(DISTINCT camid) AS cameras, round(avg(sim), 5) AS coherence, round(quantile_cont(sim, 0.05), 5) AS p5, round(min(sim), 5) AS least FROM sims GROUP BY pid")
def ag11(s, d):
    r = coherence.report(fx.crops(s, d))
    return r.select("pid", "crops", "cameras", *[F.round(c, 5).alias(c) for c in ("coherence", "p5", "least")])


@query("ag12_across_groups", given("crops").rstrip() + ", grouped AS (SELECT *, CAST(vec_id % 3 AS VARCHAR) AS grp FROM crops)" + _MEANS.format(keys="pid, grp", rows="grouped")
       + f"SELECT a.pid, a.grp AS group_a, b.grp AS group_b, round({_dot('a.c', 'b.c')}, 5) AS sim FROM cents a JOIN cents b ON a.pid = b.pid AND a.grp < b.grp")
def ag12(s, d):
    out = coherence.across_groups(fx.crops(s, d).withColumn("session", C("vec_id") % 3), "session")
    return out.withColumn("sim", F.round("sim", 5))


_PAIRS = _BY_PID + f", pairs AS (SELECT a.pid AS pid_a, b.pid AS pid_b, {_dot('a.c', 'b.c')} AS sim FROM cents a JOIN cents b ON a.pid < b.pid) "


@query("st3_closest_identities", _PAIRS + "SELECT pid_a, pid_b, round(sim, 5) AS sim, sim >= 0.93 AS \"check\" FROM pairs ORDER BY pairs.sim DESC, pid_a DESC, pid_b DESC LIMIT 10")
def st3(s, d):
    return coherence.closest_identities(fx.crops(s, d)).withColumn("sim", F.round("sim", 5))


@query("jn5_identity_pairs", _PAIRS + "SELECT pid_a, pid_b, round(sim, 5) AS sim FROM pairs")
def jn5(s, d):
    return coherence.identity_pairs(fx.crops(s, d), floor=None).select("pid_a", "pid_b", F.round("sim", 5).alias("sim"))


# Users of the events, placed by their days: many identities, of which few are alike.
_USERS = """WITH seen AS (SELECT user_id AS pid, CAST(extract('hour' FROM ts) AS BIGINT) % 8 AS slot, value FROM events), means AS (SELECT pid, slot, count(*) * (1 + pid % 5) AS m FROM seen GROUP BY pid, slot),
    vecs AS (SELECT p.pid, list(coalesce(m, 0) ORDER BY s.slot) AS v FROM (SELECT DISTINCT pid FROM seen) p CROSS JOIN (SELECT unnest(range(8)) AS slot) s LEFT JOIN means ON means.pid = p.pid AND means.slot = s.slot GROUP BY p.pid),
    cents AS (SELECT pid, list_transform(v, lambda x: x / (sqrt(list_sum(list_transform(v, lambda y: y * y))) + 1e-9)) AS c FROM vecs) """


@query("jn5_pairs_above", _USERS + """SELECT pid_a, pid_b, round(sim, 5) AS sim FROM (SELECT a.pid AS pid_a, b.pid AS pid_b, list_sum(list_transform(range(1, 9), lambda k: a.c[k] * b.c[k])) AS sim FROM cents a JOIN cents b ON a.pid < b.pid) WHERE sim >= 0.93""")
def jn5_above(s, d):
    rows = fx.table(s, d, "events").select(C("user_id").alias("pid"), (F.hour("ts") % 8).alias("slot"))
    grid = rows.groupBy("pid").pivot("slot", list(range(8))).count().fillna(0)
    users = grid.select("pid", F.array(*[C(str(k)).cast("double") * (1 + C("pid") % 5) for k in range(8)]).alias("embedding"))
    return coherence.identity_pairs(users).select("pid_a", "pid_b", F.round("sim", 5).alias("sim"))


_RANKED = given("crops") + f""", pairs AS (SELECT q.vec_id AS q_id, g.vec_id AS g_id, q.pid = g.pid AS matched, row_number() OVER (PARTITION BY q.vec_id ORDER BY -{_dot('q.embedding', 'g.embedding')}, g.vec_id) AS rank
    FROM crops q JOIN crops g ON q.vec_id % 5 = 0 AND g.vec_id % 5 <> 0 AND NOT (q.pid = g.pid AND q.camid = g.camid)),
    hits AS (SELECT q_id, g_id, rank, row_number() OVER (PARTITION BY q_id ORDER BY rank) AS hit FROM pairs WHERE matched),
    per_query AS (SELECT q_id, count(*) AS matches, min(rank) AS first_hit, avg(hit / rank) AS ap FROM hits GROUP BY q_id) """


@query("wn2_match_ranks", _RANKED + "SELECT q_id, g_id, rank FROM hits")
def wn2(s, d):
    return retrieval.match_ranks(*fx.retrieval(s, d))


@query("jn4_counted_pairs", given("crops") + "SELECT q.vec_id AS q_id, count(*) AS counted, count(*) FILTER (WHERE q.pid = g.pid) AS matches FROM crops q JOIN crops g ON q.vec_id % 5 = 0 AND g.vec_id % 5 <> 0 AND NOT (q.pid = g.pid AND q.camid = g.camid) GROUP BY q.vec_id")
def jn4(s, d):
    q, g = fx.retrieval(s, d)
    # counts by identity and camera stand for the pairs
    cells = g.groupBy("pid", "camid").agg(F.count("*").alias("n"))
    all_of = g.agg(F.count("*").alias("total"))
    of_pid = cells.groupBy("pid").agg(F.sum("n").alias("of_pid"))
    out = q.select("vec_id", "pid", "camid").join(of_pid, "pid", "left").join(cells, ["pid", "camid"], "left").join(all_of)
    own = F.coalesce("n", F.lit(0))
    return out.select(C("vec_id").alias("q_id"), (C("total") - own).alias("counted"), (F.coalesce("of_pid", F.lit(0)) - own).alias("matches"))


@query("wn3_wn4_per_query", _RANKED + "SELECT q_id, matches, first_hit, round(ap, 6) AS ap FROM per_query")
def wn34(s, d):
    return retrieval.per_query(*fx.retrieval(s, d)).withColumn("ap", F.round("ap", 6))


@query("retrieval_map", _RANKED + "SELECT count(*) AS queries, round(avg(ap), 6) AS map, round(avg(CAST(first_hit <= 1 AS INTEGER)), 6) AS rank1, round(avg(CAST(first_hit <= 5 AS INTEGER)), 6) AS rank5, round(avg(CAST(first_hit <= 10 AS INTEGER)), 6) AS rank10 FROM per_query")
def retrieval_map(s, d):
    out = retrieval.evaluate(*fx.retrieval(s, d))
    return out.select("queries", *[F.round(c, 6).alias(c) for c in ("map", "rank1", "rank5", "rank10")])


_IOU = """, ov AS (SELECT d.image_id, d.dt_id, g.gt_id, d.score, greatest(0.0, least(d.x + d.w, g.x + g.w) - greatest(d.x, g.x)) * greatest(0.0, least(d.y + d.h, g.y + g.h) - greatest(d.y, g.y)) AS shared, d.w * d.h AS da, g.w * g.h AS ga
    FROM detections d JOIN truth g USING (image_id, category_id)), iou AS (SELECT image_id, dt_id, gt_id, score, shared / (da + ga - shared) AS iou FROM ov) """


@query("jn16_overlaps", given("truth", "detections") + _IOU + "SELECT image_id, dt_id, gt_id, round(iou, 6) AS iou FROM iou WHERE iou >= 0.5")
def jn16(s, d):
    return detection.overlaps(fx.detections(s, d), fx.truth(s, d)).select("image_id", "dt_id", "gt_id", F.round("iou", 6).alias("iou"))


@query("fi8_confident", given("detections") + "SELECT dt_id FROM detections WHERE score >= 0.25")
def fi8(s, d):
    return detection.confident(fx.detections(s, d), 0.25).select("dt_id")


# A detection hits here if it overlaps its own object enough, so that the curve alone is compared.
@query("wn8_precision_curve", given("truth", "detections") + """, r AS (SELECT d.dt_id, d.score, d.dt_id % 3 <> 0 AS hit FROM detections d), n AS (SELECT count(*) AS n_gt FROM truth),
    run AS (SELECT *, sum(CAST(hit AS BIGINT)) OVER o AS tp, sum(CAST(NOT hit AS BIGINT)) OVER o AS fp FROM r, n WINDOW o AS (ORDER BY score DESC, dt_id ROWS UNBOUNDED PRECEDING)),
    p AS (SELECT *, tp / (tp + fp) AS prec FROM run)
    SELECT dt_id, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, round(prec, 9) AS precision, round(tp / n_gt, 9) AS recall, round(max(prec) OVER (ORDER BY score DESC, dt_id ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 9) AS envelope FROM p""")
def wn8(s, d):
    n = fx.truth(s, d).agg(F.count("*").alias("n_gt"))
    rows = fx.detections(s, d).select(C("category_id"), F.lit("all").alias("area"), F.lit(0.5).alias("threshold"), "dt_id", "score", (C("dt_id") % 3 != 0).alias("hit")).join(F.broadcast(n))
    return detection.curves(rows).select("dt_id", "tp", "fp", *[F.round(c, 9).alias(c) for c in ("precision", "recall", "envelope")])


# Detections claim objects in turn, in all images at once: the n-th of each image at the n-th step.
_SUMMARY = given("truth", "detections").replace("WITH ", "WITH RECURSIVE ", 1) + _IOU + """, areas(area, low, high) AS (VALUES ('all', 0.0, 1e10), ('small', 0.0, 1024.0), ('medium', 1024.0, 9216.0), ('large', 9216.0, 1e10)),
    cells AS (SELECT *, (50 + 5 * k) / 100 AS t FROM areas, range(10) r(k)),
    n AS (SELECT area, count(*) FILTER (WHERE w * h BETWEEN low AND high) AS n_gt FROM areas, truth GROUP BY area),
    near AS (SELECT area, dt_id, list({'gt': gt_id, 'iou': iou, 'skip': skip} ORDER BY skip, iou DESC, gt_id DESC) AS cands
        FROM (SELECT area, dt_id, iou.gt_id, iou.iou, NOT (t.w * t.h BETWEEN low AND high) AS skip FROM areas, iou JOIN truth t ON t.gt_id = iou.gt_id WHERE iou.iou >= 0.5) GROUP BY area, dt_id),
    dets AS (SELECT area, low, high, image_id, d.dt_id, score, d.w * d.h AS size, row_number() OVER (PARTITION BY area, image_id ORDER BY score DESC, d.dt_id) - 1 AS place, coalesce(cands, []) AS cands
        FROM areas CROSS JOIN detections d LEFT JOIN near USING (area, dt_id)),
    walk AS (SELECT area, t, image_id, CAST(-1 AS BIGINT) AS place, CAST([] AS BIGINT[]) AS taken, CAST(NULL AS BIGINT) AS dt_id, CAST(NULL AS DOUBLE) AS score, false AS hit, true AS ignored FROM cells, (SELECT DISTINCT image_id FROM detections)
        UNION ALL SELECT area, t, image_id, place, CASE WHEN c IS NULL THEN taken ELSE list_append(taken, c.gt) END, dt_id, score, c IS NOT NULL, CASE WHEN c IS NULL THEN size NOT BETWEEN low AND high ELSE c.skip END
        FROM (SELECT w.area, w.t, w.image_id, d.place, w.taken, d.dt_id, d.score, d.size, d.low, d.high, list_filter(d.cands, lambda c: c.iou >= w.t AND NOT list_contains(w.taken, c.gt))[1] AS c
            FROM walk w JOIN dets d ON d.area = w.area AND d.image_id = w.image_id AND d.place = w.place + 1 WHERE d.place < 100)),
    run AS (SELECT area, t, place, hit, n_gt, sum(CAST(hit AS BIGINT)) OVER o AS tp, row_number() OVER o AS seen FROM walk JOIN n USING (area) WHERE NOT ignored AND n_gt > 0 WINDOW o AS (PARTITION BY area, t ORDER BY score DESC, dt_id ROWS UNBOUNDED PRECEDING)),
    points AS (SELECT area, t, i, max(tp / seen) FILTER (WHERE tp / n_gt >= i / 100) AS p FROM run, range(101) r(i) GROUP BY area, t, i),
    ap AS (SELECT area, t, sum(coalesce(p, 0)) / 101 AS ap FROM points GROUP BY area, t),
    ar AS (SELECT area, t, max(n_gt) AS n_gt, count(*) FILTER (WHERE hit AND place < 1) AS tp1, count(*) FILTER (WHERE hit AND place < 10) AS tp10, count(*) FILTER (WHERE hit AND place < 100) AS tp100 FROM run GROUP BY area, t),
    each AS (SELECT area, t, coalesce(ap, 0) AS ap, coalesce(tp1, 0) / n.n_gt AS r1, coalesce(tp10, 0) / n.n_gt AS r10, coalesce(tp100, 0) / n.n_gt AS r100 FROM cells JOIN n USING (area) LEFT JOIN ap USING (area, t) LEFT JOIN ar USING (area, t) WHERE n.n_gt > 0)
    SELECT """ + ", ".join(f'round(coalesce({x}, -1), 6) AS "{n}"' for n, x in {
        "AP": "avg(ap) FILTER (WHERE area = 'all')", "AP50": "avg(ap) FILTER (WHERE area = 'all' AND t = 0.5)", "AP75": "avg(ap) FILTER (WHERE area = 'all' AND t = 0.75)",
        **{f"AP_{a}": f"avg(ap) FILTER (WHERE area = '{a}')" for a in ("small", "medium", "large")},
        **{f"AR{m}": f"avg(r{m}) FILTER (WHERE area = 'all')" for m in (1, 10, 100)},
        **{f"AR_{a}": f"avg(r100) FILTER (WHERE area = '{a}')" for a in ("small", "medium", "large")},
    }.items()) + " FROM each"


@query("ag16_detection_summary", _SUMMARY)
def ag16(s, d):
    out = detection.summary(fx.detections(s, d), fx.truth(s, d))
    return out.select(*[F.round(n, 6).alias(n) for n in detection.NAMES])


@query("ag17_no_detections", "SELECT " + ", ".join(f'CAST(0 AS DOUBLE) AS "{n}"' for n in detection.NAMES))
def ag17(s, d):
    return detection.summary(fx.detections(s, d).filter("score < 0"), fx.truth(s, d))


def _batch(s, d):
    return fx.crops(s, d).select(F.floor(C("vec_id") / 64).cast("bigint").alias("batch"), C("vec_id").alias("item"), C("pid").alias("label"), "embedding")


_HARD = given("crops") + f""", b AS (SELECT vec_id // 64 AS batch, vec_id AS item, pid AS label, embedding AS v FROM crops),
    pairs AS (SELECT x.batch, x.item, x.label = y.label AS same, sqrt(greatest({_dot('x.v', 'x.v')} + {_dot('y.v', 'y.v')} - 2 * {_dot('x.v', 'y.v')}, 1e-12)) AS dist FROM b x JOIN b y ON x.batch = y.batch),
    hard AS (SELECT batch, item, max(dist) FILTER (WHERE same) AS positive, min(dist) FILTER (WHERE NOT same) AS negative FROM pairs GROUP BY batch, item) """


@query("jn17_hardest", _HARD + "SELECT batch, item, round(positive, 4) AS positive, round(negative, 4) AS negative FROM hard")
def jn17(s, d):
    # a lone positive is the anchor itself, at a distance that rounding decides; four places hide it
    return mining.hardest(_batch(s, d)).select("batch", "item", F.round("positive", 4).alias("positive"), F.round("negative", 4).alias("negative"))


@query("ag20_triplet_soft", _HARD + "SELECT batch, round(avg(ln(1 + exp(positive - negative))), 5) AS loss FROM hard GROUP BY batch")
def ag20(s, d):
    return mining.triplet_loss(_batch(s, d), strict=False).withColumn("loss", F.round("loss", 5))


@query("ag20_triplet_hinge", _HARD + "SELECT batch, round(avg(greatest(positive - negative + 0.3, 0)), 5) AS loss FROM hard GROUP BY batch")
def ag20_hinge(s, d):
    return mining.triplet_loss(_batch(s, d), 0.3, strict=False).withColumn("loss", F.round("loss", 5))


@query("ud4_registered_family", _HARD + "SELECT batch, round(avg(greatest(positive - negative + 0.3, 0)), 5) AS loss FROM hard GROUP BY batch")
def ud4(s, d):
    from strataline.operators import encoders

    encoders.register("triplets", evaluate="strataline.operators.mining:triplet_loss")
    return encoders.action("triplets", "evaluate")(_batch(s, d), 0.3, strict=False).withColumn("loss", F.round("loss", 5))


@query("ud2_toy_encoder", "SELECT doc_id, round(len / sqrt(len * len + 1), 5) AS v0 FROM (SELECT doc_id, CAST(n_chars AS DOUBLE) AS len FROM documents)")
def ud2(s, d):
    from strataline.operators import encoders

    def factory():
        import numpy as np

        return lambda items: np.array([[float(x), 1.0] for x in items])

    rows = encoders.embedded(fx.table(s, d, "documents").select("doc_id", "n_chars"), factory, "n_chars")
    return rows.select("doc_id", F.round(F.element_at("embedding", 1).cast("double"), 5).alias("v0"))


@query("ud1_toy_detector", "SELECT event_id AS image_id, CAST(2 + event_id % 3 AS BIGINT) AS category_id, CAST(event_id % 100 AS DOUBLE) AS x, CAST(5 AS DOUBLE) AS y, CAST(10 AS DOUBLE) AS w, CAST(20 AS DOUBLE) AS h, CAST(0.5 AS DOUBLE) AS score FROM events")
def ud1(s, d):
    from strataline.operators import encoders

    def factory():
        import numpy as np

        return lambda path: (np.array([[int(path) % 100, 5, int(path) % 100 + 10, 25]]), np.array([0.5]), np.array([1 + int(path) % 3]))

    images = fx.table(s, d, "events").select(C("event_id").alias("image_id"), C("event_id").cast("string").alias("path"))
    return encoders.detections(images, factory, [1, 2, 3])


@query("ud1_detector_in_sql", "SELECT event_id AS image_id, CAST(2 + event_id % 3 AS BIGINT) AS category_id, CAST(k * (event_id % 100) AS DOUBLE) AS x, CAST(10 + k AS DOUBLE) AS w, CAST(0.5 / k AS DOUBLE) AS score FROM events, range(1, 3) r(k) WHERE k <= event_id % 3")
def ud1_sql(s, d):
    from strataline.operators import encoders

    def factory():
        import numpy as np

        def detect(path):
            n = int(path)
            boxes = [(k * (n % 100), 5, k * (n % 100) + 10 + k, 25) for k in range(1, n % 3 + 1)]
            return np.array(boxes).reshape(-1, 4), np.array([0.5 / k for k in range(1, n % 3 + 1)]), np.full(len(boxes), 1 + n % 3)

        return detect

    encoders.register_detector(s, "toy_detections", factory, [1, 2, 3])
    images = fx.table(s, d, "events").select(C("event_id").alias("image_id"), C("event_id").cast("string").alias("path"))
    return s.sql("SELECT image_id, f.category_id, f.x, f.w, f.score FROM {images}, LATERAL toy_detections(path) AS f", images=images)


# Pixels of the toy video are made of their place and the frame, so that SQL knows them too.
_CUT = given("boxes") + """, c AS (SELECT position, frame, greatest(0, trunc(x / 10 - w / 10 * 0.08)) AS l, greatest(0, trunc(y / 10 - h / 10 * 0.08)) AS t,
    least(192, trunc(x / 10 + w / 10 + w / 10 * 0.08)) AS r, least(108, trunc(y / 10 + h / 10 + h / 10 * 0.08)) AS b FROM boxes)
    SELECT position, CAST(r - l AS BIGINT) AS width, CAST(b - t AS BIGINT) AS height, CAST((l + 2 * t + frame) % 256 AS BIGINT) AS first, CAST((r - 1 + 2 * (b - 1) + frame) % 256 AS BIGINT) AS last FROM c WHERE l < r AND t < b"""


def _opener():
    import numpy as np

    base = (np.arange(192)[None, :] + 2 * np.arange(108)[:, None])[:, :, None].repeat(3, axis=2)

    def frames(video, start=1):
        frame = start - 1
        while True:
            frame += 1
            yield lambda frame=frame: ((base + frame) % 256).astype(np.uint8)

    return frames, lambda crop: f"{crop.shape[1]},{crop.shape[0]},{crop[0, 0, 0]},{crop[-1, -1, 0]}".encode()


def _crops_of_videos(s, d):
    """The toy videos can be opened at every 10,000th frame."""
    from strataline.sources import images

    specs = fx.boxes(s, d).select("position", C("camera").cast("string").alias("video"), "frame", *[(C(c) / 10).alias(c) for c in "xywh"])
    starts = specs.select("video", (F.floor((C("frame") - 1) / 10_000) * 10_000 + 1).alias("start")).distinct()
    return images.cut_from_videos(specs, _opener, starts=starts)


def _told(content):
    return [F.get(F.split(content.cast("string"), ","), k).cast("bigint").alias(n) for k, n in enumerate(("width", "height", "first", "last"))]


@query("sc13_video_crops", _CUT)
def sc13(s, d):
    return _crops_of_videos(s, d).select("position", *_told(C("content")))


# The same crops as files, written and read back.
@query("sk6_written_crops", _CUT.replace("SELECT position, CAST(r - l", "SELECT position || '.txt' AS name, CAST(r - l"))
def sk6(s, d):
    from strataline.sources import files, images

    path = f"{shared_dir(s)}/crops-{uuid.uuid4().hex}"
    images.write(_crops_of_videos(s, d).select(F.concat(F.lit("all/"), C("position").cast("string"), F.lit(".txt")).alias("name"), "content"), path, spread=1_024)
    return files.read_files(s, path).select("name", *_told(C("content")))


# Black images of 24 by 16 with the outlines of their boxes, a sixtieth in size; how many pixels are in some outline.
@query("sk8_outlines", given("detections") + """, c AS (SELECT image_id, trunc(x / 60) AS l, trunc(y / 60) AS t, least(24, trunc(x / 60 + w / 60)) AS r, least(16, trunc(y / 60 + h / 60)) AS b FROM detections WHERE score >= 0.3),
    p AS (SELECT DISTINCT image_id, px, py FROM c, range(24) i(px), range(16) j(py) WHERE px >= l AND px < r AND py >= t AND py < b AND (px < l + 2 OR px >= r - 2 OR py < t + 2 OR py >= b - 2))
    SELECT image_id, count(px) AS pixels FROM (SELECT DISTINCT event_id // 10 AS image_id FROM events) LEFT JOIN p USING (image_id) GROUP BY image_id""")
def sk8(s, d):
    from strataline.sources import images

    def codec():
        import numpy as np

        return (lambda data: np.zeros((16, 24, 3), np.uint8)), (lambda image: str(int((image[:, :, 0] == 255).sum())).encode())

    boxes = fx.detections(s, d).select("image_id", *[(C(c) / 60).alias(c) for c in "xywh"], "score")
    pics = fx.table(s, d, "events").select(F.floor(C("event_id") / 10).cast("bigint").alias("image_id")).distinct().withColumn("content", F.lit("0").cast("binary"))
    return images.annotated(pics, boxes, codec, 0.3).select("image_id", C("content").cast("string").cast("bigint").alias("pixels"))


# Each image is one pixel of three channels; a resize of it is flat.
@query("sc12_crop_tensors", "SELECT event_id, round(((event_id % 256) / 255 - 0.5) / 0.5, 5) AS v, 24 AS n FROM events")
def sc12(s, d):
    from strataline.functions import pixels
    from strataline.sources import images

    def decoder():
        import numpy as np

        return lambda data: np.full((1, 1, 3), int(data) % 256, np.uint8)

    rows = fx.table(s, d, "events").select("event_id", C("event_id").cast("string").cast("binary").alias("content"))
    out = images.tensors(rows, decoder, lambda: pixels.evaluation(4, 2, "bilinear", pixels.EVEN), key="event_id")
    return out.select("event_id", F.round(F.element_at("tensor", 24).cast("double"), 5).alias("v"), F.size("tensor").alias("n"))


# Images of three rows and four columns, made larger by one kernel and smaller by the other. What a kernel gives each
# old place in a new one is a small relation, joined for columns and then for rows; pixels have 251 phases.
_RESIZED = """WITH axes(kernel, axis, size, n) AS (VALUES ('bilinear', 'x', 4, 7), ('bilinear', 'y', 3, 5), ('bicubic', 'x', 4, 3), ('bicubic', 'y', 3, 2)),
    away AS (SELECT kernel, axis, o, i, abs((i + 0.5::DOUBLE - (o + 0.5::DOUBLE) * size / n) / greatest(size / n, 1)) AS d FROM (SELECT *, unnest(range(size)) AS i FROM (SELECT *, unnest(range(n)) AS o FROM axes))),
    shape AS (SELECT kernel, axis, o, i, CASE WHEN kernel = 'bilinear' THEN greatest(1 - d, 0) WHEN d < 1 THEN (1.5 * d - 2.5) * d * d + 1 WHEN d < 2 THEN ((-0.5 * d + 2.5) * d - 4) * d + 2 ELSE 0 END AS w FROM away),
    weights AS (SELECT kernel, axis, o, i, w / sum(w) OVER (PARTITION BY kernel, axis, o) AS w FROM shape),
    pixels AS (SELECT p, y, x, c, (7 * p + 31 * y + 17 * x + 53 * c) % 251 AS v FROM range(251) a(p), range(3) b(y), range(4) e(x), range(3) f(c)),
    across AS (SELECT kernel, p, y, c, o AS x, least(greatest(floor(sum(w * v) + 0.500000001), 0), 255) AS v FROM pixels JOIN weights ON axis = 'x' AND i = x GROUP BY ALL),
    down AS (SELECT a.kernel, p, c, x, o AS y, least(greatest(floor(sum(w * v) + 0.500000001), 0), 255) AS v FROM across a JOIN weights k ON k.kernel = a.kernel AND k.axis = 'y' AND k.i = a.y GROUP BY ALL),
    sums AS (SELECT d.kernel, p, CAST(sum(v * (1 + (c * h.n + y) * w.n + x)) AS BIGINT) AS digest FROM down d JOIN axes h ON h.kernel = d.kernel AND h.axis = 'y' JOIN axes w ON w.kernel = d.kernel AND w.axis = 'x' GROUP BY d.kernel, p)
    SELECT event_id, kernel, digest FROM events JOIN sums ON p = event_id % 251"""


@query("fn23_resized", _RESIZED)
def fn23(s, d):
    from strataline.functions import pixels
    from strataline.sources import images

    def decoder():
        import numpy as np

        y, x, c = np.ogrid[:3, :4, :3]
        return lambda data: ((7 * int(data) + 31 * y + 17 * x + 53 * c) % 251).astype(np.uint8)

    rows = fx.table(s, d, "events").select("event_id", C("event_id").cast("string").cast("binary").alias("content"))

    def of(kernel, height, width):
        out = images.tensors(rows, decoder, lambda: pixels.evaluation(height, width, kernel, pixels.EVEN), key="event_id")
        whole = F.transform("tensor", lambda t, k: F.round((t.cast("double") * 0.5 + 0.5) * 255) * (k + 1))
        return out.select("event_id", F.lit(kernel).alias("kernel"), F.aggregate(whole, F.lit(0.0), lambda a, v: a + v).cast("bigint").alias("digest"))

    return of("bilinear", 5, 7).unionByName(of("bicubic", 2, 3))


# The module's vector of an image is the mean of each channel.
@query("ud3_extracted", """WITH pixels AS (SELECT p, c, ((7 * p + 31 * y + 17 * x + 53 * c) % 251 / 255 - 0.5) / 0.5 AS v FROM range(251) a(p), range(3) b(y), range(4) e(x), range(3) f(c)),
    means AS (SELECT p, c, avg(v) AS m FROM pixels GROUP BY p, c), vecs AS (SELECT p, list(m ORDER BY c) AS m, sqrt(sum(m * m)) AS n FROM means GROUP BY p)
    SELECT event_id, round(m[1] / n, 4) AS v0, round(m[2] / n, 4) AS v1, round(m[3] / n, 4) AS v2 FROM events JOIN vecs ON p = event_id % 251""")
def ud3(s, d):
    from strataline.functions import pixels
    from strataline.operators import encoders

    def decoder():
        import numpy as np

        y, x, c = np.ogrid[:3, :4, :3]
        return lambda data: ((7 * int(data) + 31 * y + 17 * x + 53 * c) % 251).astype(np.uint8)

    rows = fx.table(s, d, "events").select("event_id", C("event_id").cast("string").cast("binary").alias("content"))
    out = encoders.extracted(rows, decoder, lambda: pixels.evaluation(3, 4, "bilinear", pixels.EVEN), lambda: lambda x: x.mean(axis=(2, 3)), f"{shared_dir(s)}/features-{uuid.uuid4().hex}", "event_id", 3)
    return out.select("event_id", *[F.round(F.element_at("embedding", k + 1).cast("double"), 4).alias(f"v{k}") for k in range(3)])
