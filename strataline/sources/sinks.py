"""Writers. Checks come first: nothing is written if they fail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataline.operators import constraints
from strataline.schema import MANIFEST, SPLITS
from strataline.sources import files


def split_counts(crops: DataFrame) -> DataFrame:
    return crops.groupBy("split").agg(F.count("*").alias("crops"))


def checked_layout(crops: DataFrame, strict: bool = True) -> DataFrame:
    """The crops (split, pid, camid, name, ...), if they may be written as a layout; raises otherwise."""
    constraints.enforce(constraints.unknown_splits(crops), "split not known")
    if strict:
        constraints.enforce(constraints.leaking(crops, exclude_junk=False), "identities in train and evaluation")
        constraints.enforce(constraints.unanswerable_identities(crops), "identities without a second camera")
    constraints.enforce(constraints.repeated_names(crops), "names are not unique in a split")
    return crops


def write_layout(crops: DataFrame, path: str, strict: bool = True) -> dict[str, int]:
    """Crops (split, pid, camid, name, ...) by split; running it again replaces what is there."""
    checked_layout(crops, strict)
    crops.write.mode("overwrite").partitionBy("split").parquet(path)
    return {r.split: r.crops for r in split_counts(crops).collect()}


def write_layout_files(crops: DataFrame, path: str, strict: bool = True) -> dict[str, int]:
    """Crops (split, pid, camid, name, content) as image files in a folder for each split; all splits' folders are
    emptied first. Returns the files of each split, as the commit counted them."""
    rows = checked_layout(crops, strict).select(F.col("split").alias("folder"), "name", "content")
    return files.write_files(rows, path, SPLITS)


def write_manifest(rows: DataFrame, path: str) -> None:
    if rows.isEmpty():
        raise ValueError("nothing to write")
    rows.select(*MANIFEST).write.mode("overwrite").option("header", True).csv(path)


def score_rows(scores: DataFrame) -> DataFrame:
    return scores.select("file", "self_sim").orderBy("file", "self_sim")


def write_scores(scores: DataFrame, path: str) -> None:
    score_rows(scores).write.mode("overwrite").option("header", True).csv(path)


def write_features(features: DataFrame, path: str) -> None:
    """path and embedding in one table, so that no order has to hold the two together."""
    features.select("path", "embedding").write.mode("overwrite").parquet(path)


def contact_rows(crops: DataFrame, per_row: int = 24) -> DataFrame:
    """Per camera the first crops by path with their place in the row; the image itself is drawn elsewhere."""
    from pyspark.sql import Window as W

    place = F.row_number().over(W.partitionBy("camid").orderBy("path"))
    return crops.withColumn("place", place).filter(F.col("place") <= per_row)
