"""Batch-hard triplets: for each anchor its farthest positive and its nearest negative."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataline.functions import vectors
from strataline.operators import constraints

LEAST = 1e-12


def hardest(batch: DataFrame, vector: str = "embedding") -> DataFrame:
    """batch, item: positive and negative distance. A batch is a bounded group."""
    a = batch.select("batch", F.col("item").alias("item"), F.col("label").alias("la"), F.col(vector).alias("va"), vectors.dot(vector, vector).alias("na"))
    b = batch.select("batch", F.col("label").alias("lb"), F.col(vector).alias("vb"), vectors.dot(vector, vector).alias("nb"))
    squared = F.col("na") + F.col("nb") - 2 * vectors.dot("va", "vb")
    pairs = a.join(b, "batch").select("batch", "item", (F.col("la") == F.col("lb")).alias("same"), F.sqrt(F.greatest(squared, F.lit(LEAST))).alias("d"))
    return pairs.groupBy("batch", "item").agg(F.max(F.when(F.col("same"), F.col("d"))).alias("positive"), F.min(F.when(~F.col("same"), F.col("d"))).alias("negative"))


def triplet_loss(batch: DataFrame, margin: float | None = None, vector: str = "embedding", strict: bool = True) -> DataFrame:
    """Per batch the mean loss: soft margin log(1 + exp(p - n)), or hinge with a margin."""
    if strict:
        constraints.enforce(constraints.lone_anchors(batch), "anchors without a positive or a negative")
    gap = F.col("positive") - F.col("negative")
    loss = F.log1p(F.exp(gap)) if margin is None else F.greatest(gap + margin, F.lit(0.0))
    return hardest(batch, vector).groupBy("batch").agg(F.avg(loss).alias("loss"))
