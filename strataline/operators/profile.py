"""Profiles of an inventory (split, pid, camid, ...): counts, distributions, shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strataline.functions import schedules
from strataline.schema import JUNK, QUERY, TRAIN

def real(pid: Column | None = None) -> Column:
    return (F.col("pid") if pid is None else pid) != JUNK


def upper_median(values: Column) -> Column:
    """The middle of the sorted values, the upper of two."""
    ordered = F.sort_array(values)
    return F.element_at(ordered, (F.floor(F.size(values) / 2) + 1).cast("int"))


def counts(crops: DataFrame) -> DataFrame:
    """Crops by source and split, and by split alone (source null), from one aggregation."""
    return crops.groupingSets([["source", "split"], ["split"]], "source", "split").agg(F.count("*").alias("crops"), F.grouping("source").cast("bigint").alias("all_sources"))


def by_split(crops: DataFrame) -> DataFrame:
    """Per split: crops, identities and junk crops, cameras."""
    return crops.groupBy("split").agg(
        F.count("*").alias("crops"), F.count_distinct(F.when(real(), F.col("pid"))).alias("identities"), F.count_if(~real()).alias("junk"),
        F.count_distinct("camid").alias("cameras"), F.array_join(F.transform(F.sort_array(F.collect_set("camid")), lambda c: c.cast("string")), ",").alias("camera_list"),
    )


def cameras_of_identities(crops: DataFrame) -> DataFrame:
    """Per split and identity the number of cameras, junk aside."""
    return crops.filter(real()).groupBy("split", "pid").agg(F.count_distinct("camid").alias("cameras"))


def single_camera(crops: DataFrame) -> DataFrame:
    """Per split: identities, those of one camera, and their percentage."""
    one = F.count_if(F.col("cameras") == 1)
    return cameras_of_identities(crops).groupBy("split").agg(F.count("*").alias("identities"), one.alias("single"), F.round(schedules.percent(one, F.count("*")), 4).alias("percent"))


def crops_per_identity(crops: DataFrame) -> DataFrame:
    """Per split: least, upper median and most crops of an identity; identities with fewer than 2 and 4.

    The median is of counts: one number for each identity is gathered, by value, so that a split's group
    holds no more rows than there are different counts.
    """
    sizes = crops.filter(real()).groupBy("split", "pid").agg(F.count("*").alias("n"))
    return _spread(sizes, "split", "n").join(sizes.groupBy("split").agg(F.count_if(F.col("n") < 2).alias("below_2"), F.count_if(F.col("n") < 4).alias("below_4")), "split")


def _spread(rows: DataFrame, key: str, value: str) -> DataFrame:
    """Per key: least, upper median, most of a value, from its histogram."""
    from pyspark.sql import Window as W

    histogram = rows.groupBy(key, value).agg(F.count("*").alias("times"))
    order = W.partitionBy(key).orderBy(value).rowsBetween(W.unboundedPreceding, 0)
    run = histogram.withColumn("upto", F.sum("times").over(order)).withColumn("total", F.sum("times").over(W.partitionBy(key)))
    middle = F.min(F.when(F.col("upto") > F.floor(F.col("total") / 2), F.col(value)))
    return run.groupBy(key).agg(F.min(value).alias("least"), middle.alias("median"), F.max(value).alias("most"))


def image_sizes(images: DataFrame) -> DataFrame:
    """Least, upper median and most of height and width: dimension, least, median, most."""
    both = images.select(F.explode(F.array(F.struct(F.lit("h").alias("dimension"), F.col("h").alias("v")), F.struct(F.lit("w").alias("dimension"), F.col("w").alias("v")))).alias("x")).select("x.dimension", "x.v")
    return _spread(both, "dimension", "v")


def source_table(crops: DataFrame) -> DataFrame:
    """Per source: train identities and crops, evaluation identities, query and gallery crops."""
    def ids(split: str) -> Column:
        return F.count_distinct(F.when((F.col("split") == split) & real(), F.col("pid")))

    return crops.groupBy("source").agg(
        ids(TRAIN).alias("train_ids"), F.count_if(F.col("split") == TRAIN).alias("train_crops"), ids(QUERY).alias("eval_ids"),
        F.count_if(F.col("split") == QUERY).alias("query_crops"), F.count_if(~F.col("split").isin(TRAIN, QUERY)).alias("gallery_crops"),
    )


def share_of_sources(manifest: DataFrame, prefix: str, per_step: int = 64) -> DataFrame:
    """How much of the train identities the sources of a name prefix give.

    The part is the sum over those sources of identities in their own numbering; the whole counts the
    identities of the combined numbering.
    """
    train = manifest.filter((F.col("split") == TRAIN) & (F.col("pid") != JUNK))
    part = train.filter(F.col("source").startswith(prefix)).groupBy("source").agg(F.count_distinct("orig_pid").alias("n")).agg(F.coalesce(F.sum("n"), F.lit(0)).alias("part"))
    whole = train.agg(F.count_distinct("pid").alias("whole"))
    crops = manifest.filter(F.col("split") == TRAIN).agg(F.count("*").alias("crops"))
    return part.join(whole).join(crops).select("part", "whole", F.round(schedules.percent(F.col("part"), F.col("whole")), 4).alias("percent"), schedules.one_in(F.col("whole"), F.col("part")).alias("one_in"), F.floor(F.col("crops") / per_step).cast("bigint").alias("steps"))


def composition(manifest: DataFrame, sources: DataFrame) -> DataFrame:
    """What each source (a row of a recipe) gives a build: its offsets and whether it takes part in evaluation,
    identities and crops by use, and its percent of the build's train identities, with one in how many that is.

    Identities of a source are counted in its own numbering, those of the build in the combined one.
    """
    whole = manifest.filter((F.col("split") == TRAIN) & (F.col("pid") != JUNK)).agg(F.count_distinct("pid").alias("whole"))
    given = source_table(manifest.select("source", "split", F.col("orig_pid").alias("pid")))
    rows = sources.select(F.col("name").alias("source"), "pid_offset", "cam_offset", "use_eval").join(given, "source", "left").fillna(0)
    share = [F.round(schedules.percent(F.col("train_ids"), F.col("whole")), 4).alias("percent"), schedules.one_in(F.col("whole"), F.col("train_ids")).alias("one_in")]
    return rows.join(F.broadcast(whole)).select(*rows.columns, *share)


def readme(manifest: DataFrame, title: str, sources: DataFrame | None = None) -> str:
    """A page on a build, with its figures read from the manifest; with the recipe's sources also on what each gives."""
    rows = by_split(manifest).orderBy("split").collect()
    lines = [f"# {title}", "", "| split | crops | identities | junk | cameras |", "|-|-|-|-|-|"]
    lines += [f"| {r.split} | {r.crops:,} | {r.identities:,} | {r.junk:,} | {r.cameras} |" for r in rows]
    lines += ["", "| source | split | crops |", "|-|-|-|"]
    lines += [f"| {r.source} | {r.split} | {r.crops:,} |" for r in counts(manifest).filter("all_sources = 0").orderBy("source", "split").collect()]
    if sources is not None:
        found = composition(manifest, sources).orderBy("pid_offset", "source").collect()
        lines += ["", "| source | identities + | cameras + | train | evaluation | of train identities |", "|-|-|-|-|-|-|"]
        for r in found:
            tested = f"{r.eval_ids:,} identities, {r.query_crops:,} queries, {r.gallery_crops:,} gallery" if r.use_eval else "none"
            share = f"{r.percent:.2f}%, one in {r.one_in:,}" if r.train_ids else "none"
            lines.append(f"| {r.source} | {r.pid_offset:,} | {r.cam_offset:,} | {r.train_ids:,} identities, {r.train_crops:,} crops | {tested} | {share} |")
        alone = [r.source for r in found if not r.use_eval]
        if alone:
            lines += ["", f"Trained on, but not evaluated: {', '.join(alone)}; the split between identities is not theirs to break."]
        lines += ["", "Offsets keep identities and cameras of the sources apart; junk keeps its own number in all of them."]
    return "\n".join(lines) + "\n"


def label_count(crops: DataFrame) -> DataFrame:
    return crops.filter((F.col("split") == TRAIN) & real()).agg(F.count_distinct("pid").alias("identities"))


def epoch_means(log: DataFrame) -> DataFrame:
    """Means of loss and accuracy by epoch from rows (epoch, loss, acc)."""
    return log.groupBy("epoch").agg(F.avg("loss").alias("loss"), F.avg("acc").alias("acc"))
