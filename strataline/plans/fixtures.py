"""Tables of the domain, projected from the plain ones, for Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strataline.functions import names
from strataline.operators import curate
from strataline.schema import GALLERY, JUNK, QUERY, TRAIN

HELD_OUT, QUERY_CAMERA, STRIDE = (7, 8, 9), 1, 4320


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def boxes(spark: SparkSession, sf: str) -> DataFrame:
    e = F.col("event_id")
    return table(spark, sf, "events").select(
        e.alias("position"), F.lit(1).cast("bigint").alias("sequence"), (1 + e % 5).alias("camera"), F.col("user_id").alias("tid"),
        (F.expr("timestampdiff(MINUTE, TIMESTAMP_NTZ '2024-01-01 00:00:00', ts)") + 1).alias("frame"),
        ((e * 53) % 1920).cast("double").alias("x"), ((e * 71) % 1080).cast("double").alias("y"),
        (16 + (e * 13) % 180).cast("double").alias("w"), (60 + (e * 29) % 300).cast("double").alias("h"),
        (((e * 37) % 101) / F.lit(100)).cast("double").alias("vis"), F.when(e % 25 == 0, 8).otherwise(1).alias("cls"),
    )


def track_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Boxes as lines of text; every eleventh has too few fields."""
    def n(c: str):
        return F.col(c).cast("string")

    full = F.concat_ws(",", n("frame"), n("tid"), n("x"), n("y"), n("w"), n("h"), F.lit("1"), n("cls"), n("vis"))
    short = F.concat_ws(",", n("frame"), n("tid"), n("x"), n("y"), n("w"))
    return boxes(spark, sf).select("position", F.when(F.col("position") % 11 == 0, short).otherwise(full).alias("value"))


def crops(spark: SparkSession, sf: str) -> DataFrame:
    v = F.col("vec_id")
    rows = table(spark, sf, "embeddings").select("vec_id", F.col("label").cast("bigint").alias("pid"), (1 + v % 6).alias("camid"), "embedding")
    return rows.withColumn("split", curate.routed(F.col("pid"), F.col("camid"), HELD_OUT, QUERY_CAMERA)).withColumn("path", F.format_string("%06d.jpg", v))


def retrieval(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    c = crops(spark, sf)
    return c.filter("vec_id % 5 = 0"), c.filter("vec_id % 5 <> 0")


def listing(spark: SparkSession, sf: str) -> DataFrame:
    """Names of crops: some of junk, some that do not parse, with several suffixes."""
    p = F.col("position")
    pid = F.when(p % 17 == 0, F.lit(JUNK)).otherwise(F.col("tid"))
    stem = F.substring_index(names.crop_name(pid, F.col("camera"), F.col("sequence"), F.col("frame")), ".", 1)
    ext = F.element_at(F.array(*[F.lit(x) for x in (".jpg", ".png", ".jpeg", ".JPG", ".bmp")]), (p % 5 + 1).cast("int"))
    return boxes(spark, sf).select("position", F.concat(F.when(p % 101 == 0, F.lit("bad_")).otherwise(F.lit("")), stem, ext).alias("name"))


def decisions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").select(F.col("doc_id").alias("pid"), F.when(F.col("toxic") == 1, "drop").when(F.col("quality") == 0, F.concat(F.lit("merge:"), (F.col("doc_id") % 10).cast("string"))).otherwise("keep").alias("action"))


def source_rows(spark: SparkSession, sf: str) -> DataFrame:
    def of(name: str, key: str, cam: str) -> DataFrame:
        k = F.col(key)
        split = F.when(k % 5 != 0, TRAIN).when(k % 2 == 0, QUERY).otherwise(GALLERY)
        return table(spark, sf, name).select(F.lit(name).alias("source"), split.alias("split"), F.when(k % 97 == 13, F.lit(JUNK)).otherwise(k).cast("bigint").alias("pid"), F.col(cam).cast("bigint").alias("camid"), F.concat(k.cast("string"), F.lit(".png")).alias("file"))

    return of("customer", "c_custkey", "c_nationkey").unionByName(of("supplier", "s_suppkey", "s_nationkey"))


RECIPE = {"name": "both", "sources": [
    {"name": "customer", "tag": "cu", "pid_offset": 0, "cam_offset": 0, "use_eval": True},
    {"name": "supplier", "tag": "su", "pid_offset": 1_000_000, "cam_offset": 100, "use_eval": False},
]}


def leaky(spark: SparkSession, sf: str) -> DataFrame:
    v = F.col("vec_id")
    which = ((v * 7) % 11) % 3
    return table(spark, sf, "embeddings").select("vec_id", F.floor(v / 4).cast("bigint").alias("pid"), (1 + ((v * 3) % 7) % 3).alias("camid"), F.when(which == 0, TRAIN).when(which == 1, QUERY).otherwise(GALLERY).alias("split"))


def truth(spark: SparkSession, sf: str) -> DataFrame:
    return boxes(spark, sf).filter("cls = 1").select(F.floor(F.col("position") / 10).cast("bigint").alias("image_id"), F.lit(1).cast("bigint").alias("category_id"), F.col("position").alias("gt_id"), "x", "y", "w", "h")


def detections(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("position")
    return boxes(spark, sf).filter("position % 9 <> 0").select(
        F.floor(p / 10).cast("bigint").alias("image_id"), F.lit(1).cast("bigint").alias("category_id"), p.alias("dt_id"),
        (F.col("x") + 2 * (p % 7 - 3)).alias("x"), (F.col("y") + 3 * (p % 5 - 2)).alias("y"), "w", "h", (((p * 31) % 1000) / F.lit(1000)).cast("double").alias("score"),
    )


_PID = "CASE WHEN position % 17 = 0 THEN -1 ELSE tid END"
SQL = {
    "boxes": """boxes AS (SELECT event_id AS position, CAST(1 AS BIGINT) AS sequence, 1 + event_id % 5 AS camera, user_id AS tid,
        date_diff('minute', TIMESTAMP '2024-01-01 00:00:00', ts) + 1 AS frame, CAST((event_id * 53) % 1920 AS DOUBLE) AS x, CAST((event_id * 71) % 1080 AS DOUBLE) AS y,
        CAST(16 + (event_id * 13) % 180 AS DOUBLE) AS w, CAST(60 + (event_id * 29) % 300 AS DOUBLE) AS h, CAST((event_id * 37) % 101 AS DOUBLE) / 100 AS vis,
        CASE WHEN event_id % 25 = 0 THEN 8 ELSE 1 END AS cls FROM events)""",
    "crops": f"""crops AS (SELECT *, CASE WHEN pid NOT IN {HELD_OUT} THEN '{TRAIN}' WHEN camid = {QUERY_CAMERA} THEN '{QUERY}' ELSE '{GALLERY}' END AS split, format('{{:06d}}.jpg', vec_id) AS path
        FROM (SELECT vec_id, CAST(label AS BIGINT) AS pid, 1 + vec_id % 6 AS camid, list_transform(embedding, lambda v: CAST(v AS DOUBLE)) AS embedding FROM embeddings))""",
    "listing": f"""listing AS (SELECT position, CASE WHEN position % 101 = 0 THEN 'bad_' ELSE '' END || format('{{}}_c{{}}_s{{:02d}}_f{{:06d}}', {_PID}, camera, sequence, frame)
        || (['.jpg', '.png', '.jpeg', '.JPG', '.bmp'])[CAST(position % 5 + 1 AS INTEGER)] AS name FROM boxes)""",
    "decisions": """decisions AS (SELECT doc_id AS pid, CASE WHEN toxic = 1 THEN 'drop' WHEN quality = 0 THEN 'merge:' || (doc_id % 10) ELSE 'keep' END AS action FROM labels)""",
    "source_rows": f"""source_rows AS (SELECT source, CASE WHEN k % 5 <> 0 THEN '{TRAIN}' WHEN k % 2 = 0 THEN '{QUERY}' ELSE '{GALLERY}' END AS split,
        CASE WHEN k % 97 = 13 THEN -1 ELSE k END AS pid, CAST(camid AS BIGINT) AS camid, k || '.png' AS file
        FROM (SELECT 'customer' AS source, c_custkey AS k, c_nationkey AS camid FROM customer UNION ALL SELECT 'supplier', s_suppkey, s_nationkey FROM supplier))""",
    "manifest": f"""manifest AS (SELECT pid || '_c' || camid || '_' || tag || '_' || regexp_replace(orig_file, '\\.[^.]+$', '') || '.jpg' AS file, split, source, pid, camid, orig_pid, orig_camid, orig_file
        FROM (SELECT split, source, CASE WHEN pid = -1 THEN -1 ELSE pid + CASE WHEN source = 'supplier' THEN 1000000 ELSE 0 END END AS pid, camid + CASE WHEN source = 'supplier' THEN 100 ELSE 0 END AS camid,
        CASE WHEN source = 'supplier' THEN 'su' ELSE 'cu' END AS tag, pid AS orig_pid, camid AS orig_camid, file AS orig_file FROM source_rows WHERE split = '{TRAIN}' OR source = 'customer'))""",
    "leaky": f"""leaky AS (SELECT vec_id, vec_id // 4 AS pid, 1 + ((vec_id * 3) % 7) % 3 AS camid, CASE ((vec_id * 7) % 11) % 3 WHEN 0 THEN '{TRAIN}' WHEN 1 THEN '{QUERY}' ELSE '{GALLERY}' END AS split FROM embeddings)""",
    "truth": """truth AS (SELECT position // 10 AS image_id, CAST(1 AS BIGINT) AS category_id, position AS gt_id, x, y, w, h FROM boxes WHERE cls = 1)""",
    "detections": """detections AS (SELECT position // 10 AS image_id, CAST(1 AS BIGINT) AS category_id, position AS dt_id, x + 2 * (position % 7 - 3) AS x, y + 3 * (position % 5 - 2) AS y, w, h,
        CAST((position * 31) % 1000 AS DOUBLE) / 1000 AS score FROM boxes WHERE position % 9 <> 0)""",
}
_NEEDS = {"listing": ("boxes",), "manifest": ("source_rows",), "truth": ("boxes",), "detections": ("boxes",)}


def given(*wanted: str) -> str:
    """A WITH list of projections, each after those it needs."""
    out: dict[str, str] = {}
    for name in wanted:
        for need in (*_NEEDS.get(name, ()), name):
            out[need] = SQL[need]
    return "WITH " + ", ".join(out.values()) + " "
