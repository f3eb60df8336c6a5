"""Checkpoint metadata as a table (key, shape): key groups, architecture, re-prefixing, warm starts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BACKBONE, NECK = "base.", "bottleneck."


def group_of(key: Column, skipped: tuple[str, ...]) -> Column:
    """backbone, neck, skipped or unexpected."""
    skip = F.lit(False)
    for p in skipped:
        skip = skip | key.startswith(p)
    return F.when(skip, "skipped").when(key.startswith(NECK), "neck").when(key.startswith(BACKBONE), "backbone").otherwise("unexpected")


def split_keys(state: DataFrame, skipped: tuple[str, ...]) -> DataFrame:
    """group, key without its prefix, shape. Unexpected keys and camera side information raise on evaluation."""
    group = group_of(F.col("key"), skipped)
    bare = F.when(F.col("group") == "backbone", F.substring("key", len(BACKBONE) + 1, 1 << 20)).otherwise(F.substring("key", len(NECK) + 1, 1 << 20))
    checked = F.when(F.col("group") == "unexpected", F.raise_error(F.concat(F.lit("unexpected checkpoint key "), "key")).cast("string")).when(
        (F.col("group") == "backbone") & bare.startswith("sie_embed"), F.raise_error(F.lit("side information cannot be deployed")).cast("string")
    ).otherwise(bare)
    return state.withColumn("group", group).filter("group <> 'skipped'").select("group", checked.alias("key"), "shape")


def architecture(backbone: DataFrame) -> DataFrame:
    """embed_dim, depth and patch_size in one row; null where the keys they are read from are missing."""
    last = F.element_at("shape", -1)
    block = F.when(F.col("key").startswith("blocks."), F.split_part("key", F.lit("."), F.lit(2)).try_cast("bigint"))
    return backbone.agg(F.max(F.when(F.col("key") == "cls_token", last)).alias("embed_dim"), (1 + F.max(block)).alias("depth"), F.max(F.when(F.col("key") == "patch_embed.proj.weight", last)).alias("patch_size"))


def token_count(height: int, width: int, patch: Column) -> Column:
    """Positions a model of this patch size must have: one class token and one for each patch."""
    return 1 + F.floor(F.lit(height) / patch) * F.floor(F.lit(width) / patch)


def reprefixed(state: DataFrame, old: str, new: str) -> DataFrame:
    """The keys with the old prefix, under the new one."""
    return state.filter(F.col("key").startswith(old)).withColumn("key", F.concat(F.lit(new), F.substring("key", len(old) + 1, 1 << 20)))


def warm_start(own: DataFrame, given: DataFrame) -> DataFrame:
    """key and loaded: whether the given state has the same key in the same shape."""
    have = given.select("key", F.col("shape").alias("given_shape"))
    return own.join(have, "key", "left").select("key", F.coalesce(F.col("shape") == F.col("given_shape"), F.lit(False)).alias("loaded"))
