"""Detection quality: matching by overlap, precision over recall, and the usual twelve numbers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataline.functions import geometry, ranges
from strataline.session import discard, materialise

THRESHOLDS = tuple(round(0.5 + 0.05 * k, 2) for k in range(10))
#: Area bounds in square pixels, and detections for each image.
AREAS = {"all": (0.0, 1e10), "small": (0.0, 32.0**2), "medium": (32.0**2, 96.0**2), "large": (96.0**2, 1e10)}
MOST = (1, 10, 100)
NAMES = ("AP", "AP50", "AP75", "AP_small", "AP_medium", "AP_large", "AR1", "AR10", "AR100", "AR_small", "AR_medium", "AR_large")


def dealt(rows: DataFrame, *keys: str) -> DataFrame:
    """Rows by key in as many partitions as a shuffle has: few bytes may be much work, so they are not put together."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def confident(detections: DataFrame, floor: float = 0.05) -> DataFrame:
    return detections.filter(F.col("score") >= floor)


def overlaps(detections: DataFrame, truth: DataFrame, least: float = 0.5) -> DataFrame:
    """Pairs of one image and category with their overlap, where it reaches ``least``."""
    d = detections.select("image_id", "category_id", "dt_id", "score", *[F.col(c).alias(f"d{c}") for c in "xywh"])
    g = truth.select("image_id", "category_id", "gt_id", *[F.col(c).alias(f"g{c}") for c in "xywh"])
    value = geometry.iou([F.col(f"d{c}") for c in "xywh"], [F.col(f"g{c}") for c in "xywh"])
    return d.join(g, ["image_id", "category_id"]).select("image_id", "category_id", "dt_id", "gt_id", "score", value.alias("iou")).filter(F.col("iou") >= least)


#: Area and threshold of each bit of a mask: all thresholds of the first area come first.
CELLS = tuple((a, t) for a in AREAS for t in THRESHOLDS)


#: Cells that each overlap reaches, by how many thresholds are at most the overlap.
_REACH = [sum(((1 << k) - 1) << (a * len(THRESHOLDS)) for a in range(len(AREAS))) for k in range(len(THRESHOLDS) + 1)]
_LOW, _HIGH = (np.array(x) for x in zip(*AREAS.values(), strict=True))
#: Pairs of a detection and an object whose overlaps are computed at once, more or less.
PAIRS = 1 << 20


def _inside(size: np.ndarray) -> np.ndarray:
    """For each box whether its size lies in each of AREAS."""
    return (size[:, None] >= _LOW) & (size[:, None] <= _HIGH)


def _cells(inside: np.ndarray) -> list[int]:
    """The cells of the areas that hold, as bits."""
    of_area = (1 << len(THRESHOLDS)) - 1
    weights = np.array([of_area << (a * len(THRESHOLDS)) for a in range(len(AREAS))], np.int64)
    return (inside @ weights).tolist()


def _near(boxes: np.ndarray, crowd: np.ndarray, first: np.ndarray, middle: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Detection, object and overlap of pairs that reach the least threshold: by detection, then falling by overlap,
    then by object, later ones first. Rows of a group are its objects, from ``first``, and from ``middle`` on its
    detections."""
    found = []
    upto = np.cumsum((middle - first) * (end - middle))
    k = 0
    while k < len(first):
        stop = max(k + 1, int(np.searchsorted(upto, (upto[k - 1] if k else 0) + PAIRS, "right")))
        each = np.repeat(np.arange(k, stop), end[k:stop] - middle[k:stop])  # a row for each detection of the groups
        begin = np.cumsum(end[k:stop] - middle[k:stop]) - (end[k:stop] - middle[k:stop])
        row = np.arange(len(each)) - begin[each - k] + middle[each]
        many = middle[each] - first[each]
        i = np.repeat(row, many)
        j = np.arange(len(i)) - np.repeat(np.cumsum(many) - many, many) + np.repeat(first[each], many)
        (x, y, w, h), (u, v, p, q) = boxes[i].T, boxes[j].T
        wide, high = np.maximum(0, np.minimum(x + w, u + p) - np.maximum(x, u)), np.maximum(0, np.minimum(y + h, v + q) - np.maximum(y, v))
        shared = wide * high
        over = np.where(crowd[j], w * h, w * h + p * q - shared)
        iou = np.divide(shared, over, out=np.zeros_like(shared), where=over > 0)
        near = iou >= THRESHOLDS[0]
        found.append((i[near], j[near], iou[near]))
        k = stop
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
    i, j, iou = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort([-j, -iou, i])
    return i[order], j[order], iou[order]


def _claimed(boxes: np.ndarray, crowd: np.ndarray, first: np.ndarray, middle: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For groups of rows (see _near), detections in order: for each row the areas in which it counts as an object, and
    the cells of CELLS in which it hits as a detection and those in which it is left out, as bits.

    An object holds in which cells it is taken; a detection claims it in all cells at once that are left to both.
    """
    inside = _inside(boxes[:, 2] * boxes[:, 3])
    counts = inside & ~crowd[:, None]
    hits, left_out = [0] * len(boxes), [0] * len(boxes)
    every = (1 << len(CELLS)) - 1
    outside = [every & ~c for c in _cells(inside)]
    i, j, iou = _near(boxes, crowd, first, middle, end)
    reach = [_REACH[k] for k in np.searchsorted(THRESHOLDS, iou, "right").tolist()]
    countable = _cells(counts)
    free = [every] * len(boxes)
    crowds = crowd.tolist()
    rows, at = i.tolist(), j.tolist()
    edge = [*np.flatnonzero(i[1:] != i[:-1]) + 1]
    for a, b in zip([0, *edge], [*edge, len(rows)], strict=True) if rows else ():
        d, open_, ignored = rows[a], every, 0
        for k in range(a, b):  # objects that count come first
            o = at[k]
            cells = open_ & reach[k] & free[o] & countable[o]
            if cells:
                open_ ^= cells
                free[o] ^= cells
        for k in range(a, b):
            o = at[k]
            cells = open_ & reach[k] & (every if crowds[o] else free[o]) & ~countable[o]
            if cells:
                open_ ^= cells
                ignored |= cells
                free[o] &= ~cells
        hits[d], left_out[d] = every ^ open_, ignored
    hits = np.array(hits, np.int64)
    return counts, hits, np.array(left_out, np.int64) | (np.array(outside, np.int64) & ~hits)


def claims(detections: DataFrame, truth: DataFrame) -> DataFrame:
    """One row per detection: category_id, dt_id, score, place (by score in its image, from 0), hits and ignored as
    bits of CELLS; and one row per category and image with n, the objects that count for each of AREAS.

    Images stream through their tasks one after the other; an image's detections beyond the largest number that
    counts are cut before.
    """
    order = W.partitionBy("image_id", "category_id").orderBy(F.desc("score"), "dt_id")
    top = detections.withColumn("place", F.row_number().over(order) - 1).filter(F.col("place") < max(MOST))
    crowd = F.col("iscrowd") if "iscrowd" in truth.columns else F.lit(0)
    box = [F.col(c).cast("double").alias(c) for c in "xywh"]
    objects = truth.select("image_id", "category_id", F.lit(0).alias("kind"), F.col("gt_id").alias("id"), F.lit(None).cast("double").alias("score"), F.lit(0).alias("place"), crowd.cast("int").alias("crowd"), *box)
    both = objects.unionByName(top.select("image_id", "category_id", F.lit(1).alias("kind"), F.col("dt_id").alias("id"), "score", F.col("place").cast("int").alias("place"), F.lit(0).alias("crowd"), *box))
    schema = "category_id bigint, dt_id bigint, score double, place int, hits bigint, ignored bigint, n array<bigint>"
    fields = [("category_id", pa.int64()), ("dt_id", pa.int64()), ("score", pa.float64()), ("place", pa.int32()), ("hits", pa.int64()), ("ignored", pa.int64()), ("n", pa.list_(pa.int64()))]

    def numbers(table: pa.Table, name: str) -> np.ndarray:
        column = table.column(name)
        return column.fill_null(np.iinfo(np.int64).min if pa.types.is_int64(column.type) else 0).to_numpy()

    def edges(table: pa.Table) -> np.ndarray:
        image, category = numbers(table, "image_id"), numbers(table, "category_id")
        return np.flatnonzero(np.concatenate([[True], (image[1:] != image[:-1]) | (category[1:] != category[:-1]), [True]]))

    def solve(table: pa.Table) -> pa.RecordBatch:
        kind, crowds = numbers(table, "kind"), numbers(table, "crowd") == 1
        boxes = np.column_stack([numbers(table, c) for c in "xywh"])
        edge = edges(table)
        first, end = edge[:-1], edge[1:]
        middle = first + np.add.reduceat((kind == 0).astype(np.int64), first)
        counts, hit, skip = _claimed(boxes, crowds, first, middle, end)
        totals = np.add.reduceat((counts & (kind == 0)[:, None]).astype(np.int64), first, axis=0)
        # a row for each group, which takes the category alone from its first row, and one for each detection
        rows = np.concatenate([first, np.flatnonzero(kind == 1)])
        image = pa.array(np.arange(len(rows)) < len(first))
        taken = table.take(pa.array(rows))
        ids, score, place = (pc.if_else(image, None, taken.column(c).combine_chunks()) for c in ("id", "score", "place"))
        offsets = np.minimum(np.arange(len(rows) + 1), len(first)) * len(AREAS)
        n = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(totals.reshape(-1)), mask=pc.invert(image))
        columns = [taken.column("category_id").combine_chunks(), ids, score, place, pc.if_else(image, None, pa.array(hit[rows])), pc.if_else(image, None, pa.array(skip[rows])), n]
        return pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            # the last image of a batch may go on in the next one
            at = int(edges(pa.Table.from_batches([batch]))[-2])
            joined = bool(held) and any(held[-1].column(c)[-1] != batch.column(c)[0] for c in ("image_id", "category_id"))
            if at or joined:
                whole = [*held, batch.slice(0, at)]
                held = []
                if any(x.num_rows for x in whole):
                    yield solve(pa.Table.from_batches(whole))
            held.append(batch.slice(at))
        if held:
            yield solve(pa.Table.from_batches(held))

    ordered = dealt(both, "image_id", "category_id").sortWithinPartitions("image_id", "category_id", "kind", "place", "id")
    return ordered.mapInArrow(run, schema)


def _by_cell(rows: DataFrame) -> DataFrame:
    """Detections of claims() once for each area and threshold: hit, ignored."""
    cells = F.array(*[F.struct(F.lit(a).alias("area"), F.lit(t).alias("threshold"), F.lit(k).alias("bit")) for k, (a, t) in enumerate(CELLS)])
    out = rows.filter("n IS NULL").withColumn("cell", F.explode(cells))
    bits = {c: F.expr(f"shiftright({c}, cell.bit) & 1") == 1 for c in ("hits", "ignored")}
    kept = [c for c in rows.columns if c not in (*bits, "n")]
    return out.select(*kept, "cell.area", "cell.threshold", bits["hits"].alias("hit"), bits["ignored"].alias("ignored"))


def _objects(rows: DataFrame) -> DataFrame:
    """Objects that count: category_id, area, n_gt."""
    sums = rows.filter("n IS NOT NULL").groupBy("category_id").agg(*[F.sum(F.element_at("n", k + 1)).alias(a) for k, a in enumerate(AREAS)])
    return sums.unpivot("category_id", list(AREAS), "area", "n_gt")


def matched(detections: DataFrame, truth: DataFrame) -> DataFrame:
    """What each detection is, for every area and threshold: category_id, area, threshold, dt_id, score, place (by
    score in its image, from 0), hit, ignored."""
    return _by_cell(claims(detections, truth))


_CELL = ("category_id", "area", "threshold")


def _placed(rows: DataFrame) -> tuple[DataFrame, bool]:
    """``rows`` with their place by falling score, __fall, and their __range in it; and whether there are several."""
    score = F.col("score")
    fall = F.when(score.isNull(), F.lit(float("inf"))).when(F.isnan(score), F.lit(float("-inf"))).otherwise(-score)
    rows = rows.withColumn("__fall", fall)
    cuts = ranges.bounds(rows, ["__fall", "dt_id"])
    return rows.withColumn("__range", ranges.number(rows, ["__fall", "dt_id"], cuts)), bool(cuts)


def _running(placed: DataFrame, several: bool) -> DataFrame:
    """curves() of _placed() rows without the envelope.

    A curve is summed range by range: each range on its own, then with the totals of those before it.
    """
    upto = W.partitionBy(*_CELL, "__range").orderBy("__fall", "dt_id").rowsBetween(W.unboundedPreceding, 0)
    counts = {"tp": F.col("hit").cast("bigint"), "fp": (~F.col("hit")).cast("bigint")}
    run = placed.select("*", *[F.sum(v).over(upto).alias(c) for c, v in counts.items()])
    if several:
        before = W.partitionBy(*_CELL).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
        totals = placed.groupBy(*_CELL, "__range").agg(*[F.sum(v).alias(c) for c, v in counts.items()])
        run = _with_ranges(run, totals.select(*_CELL, "__range", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"__{c}") for c in counts]))
        run = run.withColumn("tp", F.col("tp") + F.col("__tp")).withColumn("fp", F.col("fp") + F.col("__fp")).drop("__tp", "__fp")
    run = run.withColumn("precision", F.col("tp") / (F.col("tp") + F.col("fp"))).withColumn("recall", F.col("tp") / F.col("n_gt"))
    return run


def _with_ranges(rows: DataFrame, of_range: DataFrame) -> DataFrame:
    """``rows`` with what is known of their range; both are partitioned by it already, and categories may be null."""
    keys = [*_CELL, "__range"]
    other = of_range.select(*[F.col(c).alias(f"__r_{c}") for c in keys], *[c for c in of_range.columns if c not in keys])
    same = F.lit(True)
    for c in keys:
        same &= F.col(c).eqNullSafe(F.col(f"__r_{c}"))
    return rows.join(other, same).drop(*[f"__r_{c}" for c in keys])


def curves(rows: DataFrame) -> DataFrame:
    """Running true and false positives of detections (category_id, area, threshold, score, dt_id, hit) by
    falling score: tp, fp, precision, recall for n_gt objects; envelope, the best precision from there on."""
    placed, several = _placed(rows)
    run = _running(placed, several)
    # The best that is still to come is a running best in the opposite order.
    back = W.partitionBy(*_CELL, "__range").orderBy(F.desc("__fall"), F.desc("dt_id")).rowsBetween(W.unboundedPreceding, 0)
    out = run.withColumn("envelope", F.max("precision").over(back))
    if several:
        after = W.partitionBy(*_CELL).orderBy(F.desc("__range")).rowsBetween(W.unboundedPreceding, -1)
        best = run.groupBy(*_CELL, "__range").agg(F.max("precision").alias("__best"))
        out = _with_ranges(out, best.select(*_CELL, "__range", F.max("__best").over(after).alias("__later")))
        out = out.withColumn("envelope", F.greatest("envelope", "__later")).drop("__later")
    return out.drop("__fall", "__range")


def _range_counts(placed: DataFrame) -> DataFrame:
    """category_id, __range, cell, tp, fp: sums over a batch of rows at a time, a row for each cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.arange(len(CELLS))
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.column_stack([batch.column(c).to_numpy() for c in ("category_id", "__range")])
            order = np.lexsort(keys.T[::-1])
            keys = keys[order]
            first = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(axis=1)))
            hit, out = ((batch.column(c).to_numpy()[order][:, None] >> bits) & 1 for c in ("hits", "ignored"))
            sums = [np.add.reduceat(x, first, axis=0).reshape(-1) for x in (hit & ~out, ~(hit | out) & 1)]
            category, where = np.repeat(keys[first], len(CELLS), axis=0).T
            columns = [category, where, np.tile(bits, len(first)), *sums]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()), strict=True)], ["category_id", "__range", "cell", "tp", "fp"])

    slim = placed.select("category_id", F.col("__range").cast("int").alias("__range"), "hits", "ignored")
    return slim.mapInArrow(run, "category_id bigint, __range int, cell int, tp bigint, fp bigint")


def _steps(rows: DataFrame) -> DataFrame:
    """For rows of claims(): category_id, area, threshold, last (the last of 101 recall points that is reached), best
    precision there and tp<m> of detections among the first m of their image.

    The best precision at or beyond a recall point is the best of the detections from there on, and each of them
    lies at the last point that its recall reaches. Detections stream by in order, range by range, with one row before
    each range that has the counts of all cells so far; what comes back is 101 rows a curve and range at most.
    """
    n_gt = rows.filter("n IS NOT NULL").groupBy("category_id").agg(F.array(*[F.sum(F.element_at("n", k + 1)) for k in range(len(AREAS))]).alias("n_gt"))
    placed, several = _placed(rows.filter("n IS NULL AND category_id IS NOT NULL"))
    if several:
        here = W.partitionBy("category_id", "cell").orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
        of_range = _range_counts(placed).groupBy("category_id", "__range", "cell").agg(F.sum("tp").alias("tp"), F.sum("fp").alias("fp"))
        before = of_range.select("category_id", "__range", "cell", *[F.coalesce(F.sum(n).over(here), F.lit(0)).alias(n) for n in ("tp", "fp")])
        ordered = before.groupBy("category_id", "__range").agg(F.array_sort(F.collect_list(F.struct("cell", "tp", "fp"))).alias("c"))
        heads = ordered.select("category_id", "__range", F.col("c.tp").alias("tp"), F.col("c.fp").alias("fp"))
    else:
        none = F.array_repeat(F.lit(0).cast("bigint"), len(CELLS))
        heads = placed.select("category_id", "__range").distinct().withColumns({"tp": none, "fp": none})
    heads = heads.join(n_gt, "category_id")
    null = F.lit(None)
    head = heads.select("category_id", "__range", F.lit(0).alias("kind"), null.cast("double").alias("__fall"), null.cast("bigint").alias("dt_id"), null.cast("int").alias("place"), null.cast("bigint").alias("hits"), null.cast("bigint").alias("ignored"), "tp", "fp", "n_gt")
    body = placed.select("category_id", "__range", F.lit(1).alias("kind"), "__fall", "dt_id", "place", "hits", "ignored", *[null.cast("array<bigint>").alias(c) for c in ("tp", "fp", "n_gt")])
    names = ["category_id", "cell", "last", "best", *[f"tp{m}" for m in MOST]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, best = None, None
        bits = np.arange(len(CELLS))
        area = bits // len(THRESHOLDS)

        def told() -> pa.RecordBatch:
            cell, last = np.nonzero(best >= 0)
            columns = [np.full(len(cell), now), cell, last, best[cell, last], *found[:, cell, last]]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.float64() if n == "best" else pa.int64()) for c, n in zip(columns, names, strict=True)], names)

        for batch in batches:
            kind = batch.column("kind").to_numpy()
            edge = np.unique(np.concatenate([[0], np.flatnonzero(kind == 0), np.flatnonzero(kind == 0) + 1, [len(kind)]]))
            for a, b in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
                some = batch.slice(a, b - a)
                if kind[a] == 0:
                    if best is not None:
                        yield told()
                    now = some.column("category_id")[0].as_py()
                    tp, fp, objects = (np.array(some.column(c)[0].as_py(), np.int64) for c in ("tp", "fp", "n_gt"))
                    best, found = np.full((len(CELLS), 102), -1.0), np.zeros((len(MOST), len(CELLS), 102), np.int64)
                    continue
                if now != some.column("category_id")[0].as_py():
                    continue  # a category without objects
                hit, out = ((some.column(c).to_numpy()[:, None] >> bits) & 1 == 1 for c in ("hits", "ignored"))
                hit &= ~out
                run_tp, run_fp = tp + np.cumsum(hit, axis=0), fp + np.cumsum(~hit & ~out, axis=0)
                tp, fp = run_tp[-1], run_fp[-1]
                # Between two hits precision only falls, at the same recall: hits alone are told.
                row, cell = np.nonzero(hit & (objects[area] > 0))
                recall = run_tp[row, cell] / objects[area[cell]]
                near = np.floor(recall * 100).astype(np.int64)
                last = near + ((near + 1) / 100 <= recall) - (near / 100 > recall)
                at = cell * best.shape[1] + last
                np.maximum.at(best.reshape(-1), at, run_tp[row, cell] / (run_tp[row, cell] + run_fp[row, cell]))
                place = some.column("place").to_numpy()[row]
                for k, m in enumerate(MOST):
                    found[k] += np.bincount(at[place < m], minlength=best.size).reshape(best.shape)
        if best is not None:
            yield told()

    both = dealt(head.unionByName(body), "category_id", "__range").sortWithinPartitions("category_id", "__range", "kind", "__fall", "dt_id")
    found = both.mapInArrow(run, "category_id bigint, cell bigint, last bigint, best double, " + ", ".join(f"tp{m} bigint" for m in MOST))
    found = found.groupBy("category_id", "cell", "last").agg(F.max("best").alias("best"), *[F.sum(f"tp{m}").alias(f"tp{m}") for m in MOST])
    cell = F.element_at(F.array(*[F.struct(F.lit(a).alias("area"), F.lit(t).alias("threshold")) for a, t in CELLS]), (F.col("cell") + 1).cast("int"))
    return found.withColumn("c", cell).select("category_id", "c.area", "c.threshold", "last", "best", *[f"tp{m}" for m in MOST])


def summary(detections: DataFrame, truth: DataFrame) -> DataFrame:
    """One row of the twelve numbers NAMES, computed at once. Without detections all are 0; a range without objects is -1."""
    spark = detections.sparkSession
    if detections.isEmpty():
        return spark.createDataFrame([(0.0,) * len(NAMES)], ", ".join(f"{n} double" for n in NAMES))
    rows = materialise(claims(detections, truth), "detection-claims")
    objects = _objects(rows).filter("n_gt > 0")
    cells = objects.withColumn("threshold", F.explode(F.array(*[F.lit(t) for t in THRESHOLDS])))
    steps = _steps(rows)
    rising, falling = (W.partitionBy(*_CELL).orderBy(o) for o in ("last", F.desc("last")))
    best = F.max("best").over(falling.rowsBetween(W.unboundedPreceding, 0))
    points = F.col("last") - F.coalesce(F.lag("last").over(rising), F.lit(-1))
    curve = steps.withColumn("area_under", best * points).groupBy(*_CELL).agg((F.sum("area_under") / 101).alias("ap"), *[F.sum(f"tp{m}").alias(f"tp{m}") for m in MOST])
    each = cells.join(curve, list(_CELL), "left").fillna(0)
    p = [F.avg(F.when(F.col("area") == a, F.col("ap"))).alias("AP" if a == "all" else f"AP_{a}") for a in AREAS]
    p += [F.avg(F.when((F.col("area") == "all") & (F.col("threshold") == t), F.col("ap"))).alias(f"AP{round(100 * t)}") for t in (0.5, 0.75)]
    r = [F.avg(F.when(F.col("area") == "all", F.col(f"tp{m}") / F.col("n_gt"))).alias(f"AR{m}") for m in MOST]
    r += [F.avg(F.when(F.col("area") == a, F.col("tp100") / F.col("n_gt"))).alias(f"AR_{a}") for a in ("small", "medium", "large")]
    out = each.agg(*p, *r).select(*[F.coalesce(n, F.lit(-1.0)).alias(n) for n in NAMES])
    row = out.first()
    discard(rows)
    return spark.createDataFrame([tuple(row)], ", ".join(f"{n} double" for n in NAMES))
