"""Integrity rules as tables of violations; an empty table means that the rule holds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataline.schema import GALLERY, JUNK, QUERY, SPLITS, TRAIN


def enforce(violations: DataFrame, message: str, show: int = 8) -> None:
    """Raise ValueError with the number of violations and the first few."""
    listed = violations.select(F.struct(*violations.columns).cast("string").alias("v"))
    some = [r.v for r in listed.distinct().orderBy("v").limit(show).collect()]
    if some:
        raise ValueError(f"{message}: {violations.count()}, such as {', '.join(some)}")


def _ids(crops: DataFrame, *splits: str) -> DataFrame:
    return crops.filter(F.col("split").isin(list(splits))).select("pid").distinct()


def leaking(crops: DataFrame, exclude_junk: bool = True) -> DataFrame:
    """Identities in train and in evaluation."""
    rows = crops.filter(F.col("pid") != JUNK) if exclude_junk else crops
    return _ids(rows, TRAIN).intersect(_ids(rows, QUERY, GALLERY))


def missing_from_gallery(crops: DataFrame) -> DataFrame:
    """Query identities that the gallery lacks, junk aside."""
    rows = crops.filter(F.col("pid") != JUNK)
    return _ids(rows, QUERY).subtract(_ids(rows, GALLERY))


def unanswerable_crops(crops: DataFrame) -> DataFrame:
    """Query crops without a gallery crop of the same identity in another camera, one row each."""
    q, g = crops.filter(F.col("split") == QUERY).alias("q"), crops.filter(F.col("split") == GALLERY).select("pid", "camid").distinct().alias("g")
    return q.join(g, (F.col("q.pid") == F.col("g.pid")) & (F.col("q.camid") != F.col("g.camid")), "left_anti")


def unanswerable_identities(crops: DataFrame) -> DataFrame:
    """Query identities all of whose gallery cameras are query cameras of theirs too."""
    sets = crops.groupBy("pid").agg(F.collect_set(F.when(F.col("split") == QUERY, F.col("camid"))).alias("q"), F.collect_set(F.when(F.col("split") == GALLERY, F.col("camid"))).alias("g"))
    return sets.filter((F.size("q") > 0) & (F.size(F.array_except("g", "q")) == 0)).select("pid")


def unevaluable(crops: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """Groups of query crops, by ``keys``, that cannot be evaluated, as none has a gallery crop of its identity in another
    camera: the keys and queries, their number."""
    g = crops.filter((F.col("split") == GALLERY) & F.col("camid").isNotNull()).groupBy(F.col("pid").alias("__pid")).agg(F.min("camid").alias("__low"), F.max("camid").alias("__high"))
    q = crops.filter(F.col("split") == QUERY).join(g, F.col("pid") == F.col("__pid"), "left")
    counts = F.coalesce((F.col("__low") != F.col("camid")) | (F.col("__high") != F.col("camid")), F.lit(False))
    return q.groupBy(*keys).agg(F.count("*").alias("queries"), F.count_if(counts).alias("__counting")).filter("__counting = 0").drop("__counting")


def unknown_splits(crops: DataFrame) -> DataFrame:
    return crops.filter(~F.coalesce(F.col("split").isin(list(SPLITS)), F.lit(False))).select("split").distinct()


def clashing_sources(sources: DataFrame) -> DataFrame:
    """Tags and offsets that two sources have: field, value."""
    fields = sources.select(F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).cast("string").alias("value")) for c in ("tag", "pid_offset", "cam_offset")])).alias("x"))
    return fields.groupBy("x.field", "x.value").agg(F.count("*").alias("n")).filter("n > 1")


def overlapping_ranges(crops: DataFrame, sources: DataFrame) -> DataFrame:
    """Pairs of sources whose identities would share numbers although their offsets differ.

    One row for each source on either side.
    """
    spans = crops.filter(F.col("pid") != JUNK).groupBy("source").agg(F.min("pid").alias("low"), F.max("pid").alias("high"))
    s = spans.join(sources.select(F.col("name").alias("source"), "pid_offset"), "source").select("source", (F.col("low") + F.col("pid_offset")).alias("low"), (F.col("high") + F.col("pid_offset")).alias("high"))
    return s.alias("a").join(s.alias("b"), (F.col("a.source") < F.col("b.source")) & (F.col("a.low") <= F.col("b.high")) & (F.col("b.low") <= F.col("a.high"))).select(F.col("a.source").alias("source_a"), F.col("b.source").alias("source_b"))


def repeated_names(crops: DataFrame, name: str = "name") -> DataFrame:
    return crops.groupBy("split", name).agg(F.count("*").alias("n")).filter("n > 1")


def unparsable(listing: DataFrame) -> DataFrame:
    from strataline.functions import names

    return listing.filter(~names.is_parsable(F.col("name"))).select("name")


def empty_train(crops: DataFrame) -> DataFrame:
    """One row if the train split has no identity but junk."""
    return crops.agg(F.count(F.when((F.col("split") == TRAIN) & (F.col("pid") != JUNK), 1)).alias("n")).filter("n = 0")


def unknown_actions(decisions: DataFrame) -> DataFrame:
    from strataline.operators.curate import MERGE

    return decisions.filter(~F.coalesce((F.col("action").isin("keep", "drop")) | F.col("action").rlike(MERGE), F.lit(True)))


def lone_anchors(batch: DataFrame, keys: tuple[str, ...] = ("batch",)) -> DataFrame:
    """Batches in which some anchor lacks a positive or a negative: size, labels and singles."""
    by_label = batch.groupBy(*keys, "label").agg(F.count("*").alias("n"))
    sums = by_label.groupBy(*keys).agg(F.count("*").alias("labels"), F.count(F.when(F.col("n") == 1, 1)).alias("singles"))
    return sums.filter((F.col("labels") < 2) | (F.col("singles") > 0))


def uneven_detections(detections: DataFrame) -> DataFrame:
    """Images whose boxes, scores and classes differ in number."""
    return detections.filter((F.size("boxes") != F.size("scores")) | (F.size("boxes") != F.size("classes"))).select("image_id")


def build_report(crops: DataFrame) -> DataFrame:
    """All violations of a build that verify_build() would raise for: rule, pid, camid (null where the rule is about an
    identity) and n, the crops concerned (null likewise)."""
    none = F.lit(None).cast("bigint")

    def of(rule: str, found: DataFrame) -> DataFrame:
        return found.select(F.lit(rule).alias("rule"), "pid", none.alias("camid"), none.alias("n"))

    single = unanswerable_crops(crops).groupBy("pid", F.col("camid").cast("bigint").alias("camid")).agg(F.count("*").alias("n"))
    return of("leaking", leaking(crops)).unionByName(of("missing from gallery", missing_from_gallery(crops))).unionByName(single.select(F.lit("without a second camera").alias("rule"), "pid", "camid", "n"))


def verify_build(crops: DataFrame) -> None:
    """The checks on a build that is already there."""
    enforce(leaking(crops), "identities in train and evaluation")
    enforce(missing_from_gallery(crops), "query identities without a gallery crop")
    enforce(unanswerable_crops(crops), "query crops without a second camera")
