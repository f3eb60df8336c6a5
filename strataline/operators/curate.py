"""From reviewed crops to splits, and from several sources to one inventory."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline.functions import names
from strataline.schema import GALLERY, QUERY, TRAIN

MERGE = r"^merge:(-?[0-9]+)$"


def resolved(pid: Column, action: Column) -> Column:
    """Identity after review: keep (or none) as it is, drop null, merge:<pid> the other, one hop; else raises."""
    other = F.regexp_extract(action, MERGE, 1).try_cast("bigint")
    return F.when(action.isNull() | (action == "keep"), pid).when(action == "drop", F.lit(None).cast("bigint")).when(action.rlike(MERGE), other).otherwise(F.raise_error(F.concat(F.lit("unknown action "), action)).cast("bigint"))


def decided(crops: DataFrame, decisions: DataFrame) -> DataFrame:
    """``crops`` with resolved, the identity after review; identities without a decision stay."""
    # decisions have a row for each identity; the planner broadcasts them where they are small
    return crops.join(decisions.select(F.col("pid").alias("__pid"), "action"), F.col("pid") == F.col("__pid"), "left").withColumn("resolved", resolved(F.col("pid"), F.col("action"))).drop("__pid", "action")


def scored(crops: DataFrame, scores: DataFrame) -> DataFrame:
    """``crops`` with self_sim, null where a file has no score."""
    return crops.join(scores.select("file", "self_sim"), "file", "left")


def routed(pid: Column, camera: Column, held_out: tuple[int, ...], query_camera: int) -> Column:
    return F.when(~pid.isin(list(held_out)), TRAIN).when(camera == query_camera, QUERY).otherwise(GALLERY)


def combined(crops: DataFrame, sources: DataFrame) -> DataFrame:
    """Rows of all sources in one id space, as manifest rows.

    ``crops``: source, split, pid, camid, file. A source gives its evaluation splits only if it says so.
    """
    s = sources.select(F.col("name").alias("source"), "tag", "pid_offset", "cam_offset", "use_eval")
    taken = crops.join(F.broadcast(s), "source").filter((F.col("split") == TRAIN) | F.col("use_eval"))
    pid, cam = names.remapped_pid(F.col("pid"), F.col("pid_offset")), F.col("camid") + F.col("cam_offset")
    return taken.select(
        names.combined_name(pid, cam, F.col("tag"), F.col("file")).alias("file"), "split", "source", pid.alias("pid"), cam.alias("camid"),
        F.col("pid").alias("orig_pid"), F.col("camid").alias("orig_camid"), F.col("file").alias("orig_file"),
    )


def camera_index(rows: DataFrame, train: DataFrame, to: str = "cam_index") -> DataFrame:
    """Cameras of the train rows by rank from 0; all others share the next number."""
    from strataline.sources.listings import contiguous

    known = contiguous(train, "camid", to)
    n = known.agg(F.count("*").alias("__n"))
    return rows.join(known, "camid", "left").join(F.broadcast(n)).withColumn(to, F.coalesce(to, "__n")).drop("__n")
