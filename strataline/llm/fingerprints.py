"""Document fingerprints: an exact digest of the canonical text.

A text is canonical in normal form NFKC, with full case folding (sharp s, final sigma) and with runs of white space
as one space, none at the ends. Its fingerprint is two 64-bit xxhash values of different seeds in hexadecimal.
Documents of one fingerprint are compared byte by byte before they count as copies.

Null texts are treated as empty. Ids of any type that sorts may be null, null first. Rows of one id stand in the
order of the hashes of their texts; equal rows are followed by each other and reported each. Of ties in the
smallest id there is no need to choose. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataline.session import discard, materialise

KEY = ("r1", "r2")
NEXT = ("s1", "s2")

Digest = Callable[[Column], Column]


def canonical(text: Column) -> Column:
    """Normalised, case-folded and with white space folded; null: empty."""
    def form(c: Column) -> Column:
        return F.reflect(F.lit("com.ibm.icu.text.Normalizer"), F.lit("compose"), c, F.lit(True))

    folded = F.reflect(F.lit("com.ibm.icu.lang.UCharacter"), F.lit("foldCase"), form(F.coalesce(text, F.lit(""))), F.lit(True))
    return F.trim(F.regexp_replace(form(folded), r"[\s\u0085\u2028\u2029]+", " "))


def digest(canon: Column) -> Column:
    """128 bits in hexadecimal of a canonical text."""
    return F.concat(*[F.lpad(F.lower(F.hex(F.xxhash64(F.lit(seed), canon))), 16, "0") for seed in (0, 1)])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fingerprint of each row; repeated rows stay."""
    return docs.select(docs[id_col].alias("doc_id"), canonical(docs[text_col]).alias("canon")).select("doc_id", digest(F.col("canon")).alias("fingerprint"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text and 128 hash bits of both; rows of one key are equal."""
    slim = docs.select(docs[id_col].alias("doc_id"), F.coalesce(docs[text_col], F.lit("")).alias("text"))
    return slim.select(*[F.xxhash64(F.lit(seed), F.col("doc_id").isNull(), "doc_id", "text").alias(k) for seed, k in enumerate(KEY)], "doc_id", "text")


def _classes(keyed: DataFrame, prints: DataFrame, digest: Digest) -> DataFrame:
    """For each row key of a fingerprint that several rows have: first_id, the smallest id of the same canonical
    text, and own, null unless texts of one fingerprint differ: then a key of the rows of one text. Written.

    ``prints`` has key, fingerprint and doc_id. Groups are reduced before the shuffle, however large.
    """
    several = prints.groupBy("fingerprint").agg(F.count("*").alias("n")).filter("n > 1").select("fingerprint")
    several = materialise(several, "shared-prints")
    texts = keyed.select(*KEY, "doc_id", canonical(F.col("text")).alias("canon")).select("*", digest(F.col("canon")).alias("fingerprint")).join(several.hint("merge"), "fingerprint")
    by_print = materialise(texts.groupBy("fingerprint").agg((F.min("canon") != F.max("canon")).alias("clash"), F.min("doc_id").alias("first_id")), "print-groups")
    alike = prints.select(*KEY, "fingerprint").join(by_print.filter("NOT clash"), "fingerprint").select(*KEY, "first_id", F.lit(None).cast("string").alias("own"))
    clashes = by_print.filter("clash").select("fingerprint")
    if not clashes.isEmpty():
        told = texts.join(clashes, "fingerprint", "left_semi")
        by_text = told.groupBy("fingerprint", "canon").agg(F.min("doc_id").alias("first_id"), F.min(F.concat_ws("/", *KEY)).alias("own"))
        alike = alike.union(told.select(*KEY, "fingerprint", "canon").join(by_text, ["fingerprint", "canon"]).select(*KEY, "first_id", "own"))
    out = materialise(alike.distinct(), "text-classes")
    discard(several, by_print)
    return out


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Digest = digest) -> DataFrame:
    """Per row: doc_id, fingerprint and first_id, the smallest id among rows of the same canonical text."""
    keyed = _keyed(docs, id_col, text_col)
    prints = materialise(keyed.select(*KEY, "doc_id", digest(canonical(F.col("text"))).alias("fingerprint")), "prints")
    out = prints.join(_classes(keyed, prints, digest), list(KEY), "left")
    return out.select("doc_id", "fingerprint", F.coalesce("first_id", "doc_id").alias("first_id"))


def successors(keyed: DataFrame) -> DataFrame:
    """Row keys with the key of the next row by ascending (id, key), after the last the first's; doc_id, n (code
    points of the text) and times, how often this pair is there.

    Only ids, keys and lengths are ordered: in ranges, as many as the session's shuffles have, and one row of
    each range, its first, tells the range before how to go on.
    """
    order = [F.col("doc_id").isNotNull(), F.col("doc_id"), *[F.col(k) for k in KEY]]
    slim = keyed.select("doc_id", *KEY, F.length("text").cast("bigint").alias("n"))
    placed = materialise(slim.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "ordered-ids")
    heads = placed.groupBy("part").agg(F.min(F.struct(*[c.alias(f"o{k}") for k, c in enumerate(order)])).alias("head"))
    # A row for each range, not for each document.
    by_part = W.partitionBy(F.lit(0)).orderBy("part")
    follow = heads.select("part", F.coalesce(F.lead("head").over(by_part), F.first("head").over(by_part)).alias("follow"))
    ahead = F.lead(F.struct(*KEY)).over(W.partitionBy("part").orderBy(*order))
    pairs = placed.withColumn("ahead", ahead).join(follow, "part")
    named = [F.coalesce(F.col(f"ahead.{k}"), F.col(f"follow.o{i + 2}")).alias(s) for i, (k, s) in enumerate(zip(KEY, NEXT, strict=True))]
    out = materialise(pairs.select("doc_id", *KEY, "n", *named).groupBy(*KEY, *NEXT, "n").agg(F.first("doc_id").alias("doc_id"), F.count("*").alias("times")), "successors")
    discard(placed)
    return out


def edited_report(docs: DataFrame, digest: Digest = digest) -> DataFrame:
    """Fingerprints of each text and of its edited text: its last half replaced by the start of the next.

    near_* is 1 where two fingerprints and the canonical texts behind them are equal, else 0. first_id is the
    smallest id of the same canonical text. A text travels once, and as much of its start as the text before takes.
    """
    keyed = _keyed(docs, "doc_id", "text")
    pairs = successors(keyed)
    texts = keyed.groupBy(*KEY).agg(F.first("text").alias("text"))
    half = F.floor(F.col("n") / 2).cast("int")
    starts = texts.select(*[F.col(k).alias(s) for k, s in zip(KEY, NEXT, strict=True)], "text").join(pairs.select(*KEY, *NEXT, "n"), list(NEXT)).select(*KEY, *NEXT, F.substring("text", F.lit(1), half).alias("start"))
    # Written so that the texts, which lie by their keys already, need not move again for the keys of the next.
    starts = starts.select(*KEY, *[F.col(k).alias(f"{k}_") for k in NEXT], "start")
    apart = F.col("s1").bitwiseXOR(F.col("s1_")).bitwiseOR(F.col("s2").bitwiseXOR(F.col("s2_")))
    both = texts.join(pairs, list(KEY)).join(starts, list(KEY)).filter(apart == 0)
    edited = both.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n").cast("int") - half), F.col("start")))
    columns = ["doc_id", F.col("n").alias("n_chars"), *KEY, *NEXT, "times"]
    canon = edited.select(*columns, F.sha2("edited", 256).alias("edited_sha256"), canonical(F.col("text")).alias("a"), canonical(F.col("edited")).alias("b"))
    prints = canon.withColumns({"fingerprint": digest(F.col("a")), "edited_fingerprint": digest(F.col("b"))})
    same = (F.col("fingerprint") == F.col("edited_fingerprint")) & (F.col("a") == F.col("b"))
    report = materialise(prints.withColumn("near_edited", same.cast("double")).drop("a", "b"), "edited")
    discard(pairs)
    classes = _classes(keyed, report.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int")))), digest)
    known = report.join(classes, list(KEY), "left")
    ahead = known.select(*[F.col(k).alias(s) for k, s in zip(KEY, NEXT, strict=True)], F.col("fingerprint").alias("f"), F.col("own").alias("o")).distinct()
    near = (F.col("fingerprint") == F.col("f")) & F.col("own").eqNullSafe(F.col("o"))
    out = known.join(ahead, list(NEXT)).withColumn("near_next", near.cast("double")).withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    return out.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", F.coalesce("first_id", "doc_id").alias("first_id"))
