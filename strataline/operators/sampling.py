"""Greedy temporal sampling, seeded samples, and batches of identities."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataline.functions import ranges

def keep_stride(boxes: DataFrame, stride: int, keys: tuple[str, ...] = ("sequence", "camera", "tid"), frame: str = "frame", position: str = "position") -> DataFrame:
    """Of each track, by (frame, position), the boxes at least ``stride`` frames after the last one kept.

    What is kept depends on what was kept before, so no window function can say it. Tracks stream in order
    through their tasks, which carry the frame last kept and search for the next: no track is ever gathered.
    Boxes without a frame all stay. ``stride`` of 0 or less keeps all. All columns stay.
    """
    if stride <= 0:
        return boxes
    placed = boxes.select("*", F.col(frame).cast("bigint").alias("__frame"))
    change = F.struct(*[F.col(k) for k in keys])
    placed = placed.repartition(*keys).withColumn("__key", F.to_json(change, {"ignoreNullFields": "false"})).sortWithinPartitions(*keys, frame, position)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        track, last = None, None
        for batch in batches:
            key, at = batch.column("__key"), batch.column("__frame")
            known = at.is_valid().to_numpy(zero_copy_only=False)
            frames = at.fill_null(0).to_numpy()
            first = pc.not_equal(key.slice(1), key.slice(0, max(len(key) - 1, 0))).to_numpy(zero_copy_only=False)
            edges = [0, *(np.flatnonzero(first) + 1).tolist(), len(key)] if len(key) else []
            kept = ~known
            for a, b in zip(edges, edges[1:], strict=False):
                if key[a].as_py() != track:
                    track, last = key[a].as_py(), None
                i = a + int((~known[a:b]).sum())  # unknown frames come first
                while i < b:
                    if last is not None:
                        i += int(np.searchsorted(frames[i:b], last + stride, "left"))
                    if i < b:
                        kept[i] = True
                        last = int(frames[i])
                        i += 1
            yield batch.filter(pa.array(kept)).select(boxes_columns)

    boxes_columns, schema = boxes.columns, boxes.schema
    return placed.mapInArrow(run, schema)


def seeded_order(seed: int, key: Column) -> Column:
    """A chance order that no partitioning changes."""
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")).cast("binary"))


def seeded_sample(df: DataFrame, key: str, n: int = 600, seed: int = 42) -> DataFrame:
    """The first n rows in the seed's order."""
    return df.orderBy(seeded_order(seed, F.col(key)), key).limit(n)


def fraction(df: DataFrame, key: str, share: float, seed: int = 42) -> DataFrame:
    """The rows whose place by chance, which depends on seed and key alone, is below ``share``; null keys stay out."""
    if not 0 < share <= 1:
        raise ValueError("a fraction lies above 0 and is 1 at most")
    place = F.conv(F.substring(seeded_order(seed, F.col(key)), 1, 8), 16, 10).cast("bigint")
    return df.filter(place < int(share * 2**32))


def chunks(crops: DataFrame, k: int, key: str = "vec_id", seed: int = 42) -> DataFrame:
    """Full chunks of k crops of each identity, in the seed's order: chunk, slot.

    An identity with fewer than k crops is filled up by repeating its own, so that it has one chunk.
    """
    order = W.partitionBy("pid").orderBy(seeded_order(seed, F.col(key)), key)
    size = F.count("*").over(W.partitionBy("pid"))
    placed = crops.withColumn("__n", F.row_number().over(order) - 1).withColumn("__size", size)
    full = F.when(F.col("__n") < F.col("__size") - F.col("__size") % k, F.array(F.col("__n").cast("bigint"))).otherwise(F.array().cast("array<bigint>"))
    filled = F.expr(f"filter(sequence(0L, {k - 1}L), s -> s % __size = __n)")
    places = placed.withColumn("__place", F.explode(F.when(F.col("__size") >= k, full).otherwise(filled)))
    return places.withColumn("chunk", F.floor(F.col("__place") / k).cast("bigint")).withColumn("slot", F.col("__place") % k).drop("__n", "__size", "__place")


def epoch_length(crops: DataFrame, k: int) -> DataFrame:
    """Items an epoch can have at most: of each identity the full chunks, one at least."""
    n = F.greatest(F.col("n"), F.lit(k))
    return crops.groupBy("pid").agg(F.count("*").alias("n")).agg(F.coalesce(F.sum(n - n % k), F.lit(0)).cast("bigint").alias("length"))


def batch_count(sizes: dict[int, int], per_batch: int) -> int:
    """How many batches of ``per_batch`` identities can be drawn, each identity at most once in a batch.

    ``sizes``: identities by their number of chunks. It is the most B for which the identities have B batches' worth
    of chunks, with no more than B of each; beyond it fewer identities are left than a batch needs.
    """
    low, high = 0, sum(n * c for c, n in sizes.items()) // per_batch
    while low < high:
        mid = (low + high + 1) // 2
        low, high = (mid, high) if sum(n * min(c, mid) for c, n in sizes.items()) >= per_batch * mid else (low, mid - 1)
    return low


def stride_of(batches: int) -> int:
    """A step through all batches, about 0.618 of their number and without a common divisor with it."""
    return next(a for a in range(max(1, batches * 618 // 1000), 0, -1) if math.gcd(a, batches) == 1)


def batch_problems(crops: DataFrame, plans: DataFrame) -> DataFrame:
    """Why plans (batch_size, k) cannot be drawn from the crops by batches(): the plan's columns, identities, problem.

    A plan without sizes, or with one below 1, is told too; a plan that can be drawn gives no row.
    """
    identities = crops.agg(F.count_distinct("pid")).first()[0]  # one number
    size, k, n = F.col("batch_size"), F.col("k"), F.lit(identities).cast("bigint")
    whole = F.coalesce((size >= 1) & (k >= 1), F.lit(False))
    per_batch = F.when(whole, F.floor(size / k))
    problem = (
        F.when(~whole, "sizes are not positive").when(per_batch * k != size, "the batch size is not a multiple of k")
        .when(per_batch > n, "there are fewer identities than a batch needs")
    )
    return plans.withColumn("identities", n).withColumn("problem", problem).filter("problem IS NOT NULL")


def batches(crops: DataFrame, batch_size: int, k: int, key: str = "vec_id", seed: int = 42) -> DataFrame:
    """Batches of batch_size / k identities with one chunk each: batch, place, pid, chunk, slot and the crop.

    Identities stand in the seed's order, each with its chunks, and chunk after chunk is dealt to batch after batch, so
    that no batch gets an identity twice; batches are numbered anew in strides, and an identity's chunks come in turn.
    Everything is computed where the rows are: the driver sees how many identities have how many chunks.
    """
    if batch_size % k:
        raise ValueError("the batch size is not a multiple of k")
    per_batch = batch_size // k
    cut = chunks(crops, k, key, seed)
    n = F.greatest(F.floor(F.count("*") / k), F.lit(1))
    identities = crops.filter("pid IS NOT NULL").groupBy("pid").agg(n.alias("__chunks"))
    sizes = {r["__chunks"]: r["count"] for r in identities.groupBy("__chunks").count().collect()}
    if sum(sizes.values()) < per_batch:
        raise ValueError("there are fewer identities than a batch needs")
    count = batch_count(sizes, per_batch)
    order = ["__order", "pid"]
    placed = identities.select("pid", F.least("__chunks", F.lit(count)).alias("__chunks"), seeded_order(seed, F.col("pid")).alias("__order"))
    cuts = ranges.bounds(placed, order)
    placed = placed.withColumn("__range", ranges.number(placed, order, cuts))
    before = W.partitionBy("__range").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    first = F.coalesce(F.sum("__chunks").over(before), F.lit(0))
    # A row for each range of identities, of which there are as many as a shuffle has partitions.
    sums = placed.groupBy("__range").agg(F.sum("__chunks").alias("__sum"))
    offsets = sums.select("__range", F.coalesce(F.sum("__sum").over(W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("__offset"))
    dealt = placed.withColumn("__first", first).join(offsets, "__range")
    turn = F.explode(F.sequence(F.col("__offset") + F.col("__first"), F.col("__offset") + F.col("__first") + F.col("__chunks") - 1))
    dealt = dealt.select("pid", turn.alias("__turn")).filter(F.col("__turn") < count * per_batch)
    batch = (F.col("__turn") * stride_of(count) + seed) % count
    plan = dealt.select("pid", batch.alias("batch"), F.floor(F.col("__turn") / count).alias("place"))
    plan = plan.withColumn("chunk", (F.row_number().over(W.partitionBy("pid").orderBy("batch")) - 1).cast("bigint"))
    return cut.join(plan, ["pid", "chunk"])
