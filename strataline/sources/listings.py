"""Crop inventories from file names; only names are read, never pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataline.functions import names, ranges
from strataline.schema import JUNK, SPLITS, TRAIN
from strataline.sources.tables import exists

STRICT_SUFFIXES = (".jpg", ".jpeg", ".png")
SOURCE_SUFFIXES = (".jpg", ".jpeg", ".png", ".bmp", ".webp")


def files(spark: SparkSession, path: str) -> DataFrame:
    """path and name of the files in a folder. Contents are pruned from the scan."""
    found = spark.read.format("binaryFile").load(path).select("path")
    return found.withColumn("name", F.element_at(F.split("path", "/"), -1))


def lenient(listing: DataFrame) -> DataFrame:
    """Images with pid and camid, null in both where the name does not parse, and ok."""
    image = listing.filter(names.has_suffix(F.col("name"), STRICT_SUFFIXES))
    return image.withColumn("pid", names.pid_of(F.col("name"))).withColumn("camid", names.cam_of(F.col("name"))).withColumn("ok", names.is_parsable(F.col("name")))


def strict(listing: DataFrame) -> DataFrame:
    """Images with pid and camid; a name that does not parse raises when it is reached."""
    complain = F.raise_error(F.concat(F.lit("name does not parse: "), F.col("name"))).cast("bigint")
    return lenient(listing).withColumn("pid", F.when(F.col("ok"), F.col("pid")).otherwise(complain)).drop("ok")


def loader(listing: DataFrame) -> DataFrame:
    """Files in .jpg, then in .png, by path, with their place; suffixes are matched as written."""
    image = strict(listing.filter(names.suffix(F.col("name")).isin(".jpg", ".png")))
    return image.withColumn("kind", names.suffix(F.col("name"))).orderBy("kind", "name")


def prediction_sources(listing: DataFrame) -> DataFrame:
    return listing.filter(names.has_suffix(F.col("name"), SOURCE_SUFFIXES)).orderBy("name")


def labelled_train(crops: DataFrame) -> DataFrame:
    """Crops (split, pid, ...): junk leaves the train split alone; train identities get labels from 0.

    Labels are ranks of distinct identities: one small row each, not one for each crop.
    """
    kept = crops.filter((F.col("split") != TRAIN) | (F.col("pid") != JUNK))
    return kept.join(contiguous(kept.filter(F.col("split") == TRAIN), "pid"), "pid", "left").withColumn("label", F.when(F.col("split") == TRAIN, F.col("label")))


def contiguous(df: DataFrame, key: str, to: str = "label") -> DataFrame:
    """The distinct keys with their rank from 0.

    Ranked inside ranges of keys, to which the numbers of keys before are added: one row for each range.
    """
    keys = df.select(key).distinct()
    cuts = ranges.bounds(keys, [key])
    placed = keys.withColumn("__range", ranges.number(keys, [key], cuts))
    inside = placed.withColumn("__n", F.row_number().over(W.partitionBy("__range").orderBy(key)) - 1)
    before = placed.groupBy("__range").agg(F.count("*").alias("__size")).withColumn("__before", F.coalesce(F.sum("__size").over(W.orderBy("__range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)))
    return inside.join(F.broadcast(before), "__range").select(key, (F.col("__n") + F.col("__before")).cast("bigint").alias(to))


def missing_splits(paths: DataFrame, builds: DataFrame, splits: tuple[str, ...] = SPLITS) -> DataFrame:
    """build and split for each split of ``builds`` (build) that has no file among ``paths`` (path: build/split/file).

    A build without files lacks all splits; null builds are none.
    """
    there = paths.select(F.regexp_extract("path", "^(.*)/([^/]+)/[^/]+$", 1).alias("build"), F.regexp_extract("path", "^(.*)/([^/]+)/[^/]+$", 2).alias("split")).distinct()
    wanted = builds.filter("build IS NOT NULL").select(F.col("build").cast("string").alias("build")).distinct()
    return wanted.withColumn("split", F.explode(F.array(*[F.lit(x) for x in splits]))).join(there, ["build", "split"], "left_anti")


def require_splits(spark: SparkSession, path: str, splits: tuple[str, ...] = SPLITS) -> None:
    """Raise FileNotFoundError with the split folders that a layout lacks."""
    lacking = [x for x in splits if not exists(spark, f"{path}/{x}")]
    if lacking:
        raise FileNotFoundError(f"path {path} lacks {', '.join(lacking)}")


def read_market(spark: SparkSession, path: str, require_train: bool = True) -> DataFrame:
    """All three splits of a layout. A missing folder raises; so does an empty train split if required."""
    require_splits(spark, path)
    parts = None
    for split in SPLITS:
        part = strict(files(spark, f"{path}/{split}")).withColumn("split", F.lit(split))
        parts = part if parts is None else parts.unionByName(part)
    out = labelled_train(parts)
    if require_train and out.filter(F.col("split") == TRAIN).isEmpty():
        raise ValueError("the train split is empty")
    return out
