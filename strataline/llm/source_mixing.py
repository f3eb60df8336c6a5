"""Mixing sources to target weights by hash thresholds.

Sizes are summed by source and hash bucket. Running sums over the buckets of a source find the bucket in
which its budget ends; only that bucket is divided again, by the next bits of the hash, until one hash is
left. What lies below the threshold is taken by a filter; documents are never sorted.

A document's hash is the first 48 bits of the MD5 of the MD5 of its source, id and text, and of a number that
tells equal rows apart, so reruns agree whatever the partitions, and rows of one id, or of none, are taken or left
each for itself. Rows that are equal in source, id and text are counted before they move. A null text has size 0,
a null source is a source of its own, a null id is a value like any other. An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataline.llm.quality_rules import words_of
from strataline.session import discard, materialise

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
HASH_BITS = 48
STEP_BITS = 12


def size_of(text: Column) -> Column:
    """Number of words of a text, by white space; null: 0."""
    return F.size(words_of(F.coalesce(text, F.lit("")))).cast("bigint")


def key_of(source: Column, doc_id: Column, text: Column) -> Column:
    """The MD5 of what makes a row: 32 hex digits."""
    return F.md5(F.concat(*[F.when(c.isNull(), F.lit(f"{mark}-")).otherwise(F.concat(F.lit(mark), c.cast("string"))) for mark, c in (("s:", source), ("\ni:", doc_id), ("\nt:", text))]).cast("binary"))


def hash_of(key: Column, nth: Column) -> Column:
    """The hash of the ``nth`` (from 1) of the rows of a key."""
    return F.conv(F.substring(F.md5(F.concat(key, F.lit(":"), nth.cast("string")).cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("bigint")


def sizes(docs: DataFrame, id_col: str, source_col: str, text_col: str) -> DataFrame:
    """A row for each of ``docs``: doc_id, source, size, key, many (equal rows), nth (of them) and hash."""
    source, doc_id, text = docs[source_col], docs[id_col], docs[text_col]
    slim = docs.select(doc_id.alias("doc_id"), source.alias("source"), size_of(text).alias("size"), key_of(source, doc_id, text).alias("key"))
    counted = slim.groupBy("doc_id", "source", "size", "key").agg(F.count(F.lit(1)).alias("many"))
    return counted.withColumn("nth", F.explode(F.sequence(F.lit(1).cast("bigint"), "many"))).withColumn("hash", hash_of(F.col("key"), F.col("nth")))


def targets(totals: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """``totals`` (source, source_size; a row per source) with target.

    Weights go round over the sources by code point, null last. A target stops at ``most`` times its
    source's size and the rest is shared again by weight: with the sources in the order in which they
    reach their limit, the rate of those that do not is found in one pass over running sums. This
    handles one row per source, not the documents, in one partition.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("rank", F.row_number().over(by_name) - 1).withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")))
    ranked = ranked.withColumn("limit", F.col("source_size") * most).withColumn("reach", F.col("limit") / F.col("weight"))
    order = W.orderBy("reach", "rank")
    before, after = order.rowsBetween(W.unboundedPreceding, -1), order.rowsBetween(0, W.unboundedFollowing)
    rate = (F.lit(share) * F.sum("source_size").over(W.partitionBy()) - F.coalesce(F.sum("limit").over(before), F.lit(0))) / F.sum("weight").over(after)
    # The first source, in this order, whose limit is not below the rate ends the limited ones.
    rated = ranked.withColumn("rate", rate).withColumn("free", F.col("rate") <= F.col("reach"))
    found = F.min_by(F.when(F.col("free"), F.col("rate")), F.when(F.col("free"), F.struct("reach", "rank"))).over(W.partitionBy())
    return rated.withColumn("found", found).select("source", "source_size", F.when(F.col("found").isNull() | (F.col("reach") < F.col("found")), F.col("limit").cast("double")).otherwise(F.col("weight") * F.col("found")).alias("target"))


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def plan(sized: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Per source: source_size, target, full (whole copies of all its documents) and threshold.

    ``sized`` has source, size and hash. One copy more is due to documents of a hash below the
    threshold. The hash at which the budget ends counts as below if half of it lies within the budget.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    wanted = targets(totals, weights, share, most)
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("bigint")
    wanted = wanted.withColumn("full", full).withColumn("budget", F.col("target") - F.col("full") * F.col("source_size"))
    # low: first hash of the bucket under study; done: tokens of all hashes below it.
    edge = materialise(wanted.withColumn("low", F.lit(0).cast("bigint")).withColumn("done", F.lit(0).cast("bigint")), "mix-plan")
    before = edge
    for shift in range(HASH_BITS - STEP_BITS, -1, -STEP_BITS):
        e = edge.select(F.col("source").alias("e_source"), "budget", "low", "done")
        inside = (F.col("hash") >= F.col("low")) & (F.col("hash") < F.col("low") + (1 << (shift + STEP_BITS)))
        bucket = F.shiftright("hash", shift)
        histogram = sized.join(e, _same(F.col("source"), F.col("e_source"))).filter(inside).groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("size"), F.first("budget").alias("budget"), F.first("done").alias("done"))
        run = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, 0)
        summed = histogram.withColumn("upto", F.col("done") + F.sum("size").over(run))
        over = summed.filter(F.col("upto") > F.col("budget")).groupBy("source").agg(F.min(F.struct("bucket", (F.col("upto") - F.col("size")).alias("done"), "size")).alias("x"))
        over = over.select(F.col("source").alias("o_source"), F.shiftleft("x.bucket", shift).alias("o_low"), F.col("x.done").alias("o_done"), F.col("x.size").alias("o_size"))
        # A source whose budget is not used up takes all: its threshold lies above every hash.
        edge = edge.join(over, _same(F.col("source"), F.col("o_source")), "left").select(
            "source", "source_size", "target", "full", "budget",
            F.coalesce("o_low", F.lit(1 << HASH_BITS)).alias("low"), F.coalesce("o_done", "done").alias("done"), F.coalesce("o_size", F.lit(0)).alias("last"),
        )
        edge = materialise(edge, "mix-plan")
        discard(before)
        before = edge
    threshold = F.col("low") + F.when(F.col("budget") - F.col("done") >= F.col("last") / 2, 1).otherwise(0)
    return edge.select("source", "source_size", "target", "full", threshold.alias("threshold"))


def _copies(most: int) -> Column:
    """Copies of a document. Empty ones, which fit any budget, stop at ``most`` like all others."""
    return F.least(F.col("full") + (F.col("hash") < F.col("threshold")).cast("bigint"), F.lit(most).cast("bigint"))


def counted(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Per document: doc_id, size, source_size, target, taken and copies (0 to ``most``)."""
    sized = materialise(sizes(docs, id_col, source_col, text_col).select("doc_id", "source", "size", "hash"), "mix-sizes")
    plans = plan(sized, weights, share, most).withColumnRenamed("source", "p_source")
    out = sized.join(plans, _same(F.col("source"), F.col("p_source")))
    copies = _copies(most)
    return out.select("doc_id", "size", "source_size", "target", (copies * F.col("size")).alias("taken"), copies.alias("copies"), "source")


def mixed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it; columns are those of ``docs``, none of them a map.

    A row that is alone with its source, id and text needs no number to tell it apart; the others are counted as
    whole rows first and numbered then.
    """
    sized = materialise(sizes(docs, id_col, source_col, text_col).select("source", "size", "hash", "key", "many", "nth"), "mix-sizes")
    plans = plan(sized.select("source", "size", "hash"), weights, share, most).withColumnRenamed("source", "p_source")
    again = materialise(sized.filter("many > 1 AND nth = 1").select(F.col("key").alias("again")), "mix-repeated")
    discard(sized)
    row = F.struct(*[docs[c] for c in docs.columns]).alias("__row")
    source, key = docs[source_col], key_of(docs[source_col], docs[id_col], docs[text_col])
    keyed = docs.select(row, source.alias("__source"), key.alias("__key"))
    numbered = keyed.withColumn("nth", F.lit(1).cast("bigint"))
    if not again.isEmpty():
        equal = keyed.join(again, F.col("__key") == F.col("again"), "left_semi").groupBy("__row", "__source", "__key").agg(F.count(F.lit(1)).alias("many"))
        upto = F.sum("many").over(W.partitionBy("__key").orderBy("__row").rowsBetween(W.unboundedPreceding, 0))
        equal = equal.withColumn("upto", upto).withColumn("nth", F.explode(F.sequence(F.col("upto") - F.col("many") + 1, "upto")))
        alone = numbered.join(again, F.col("__key") == F.col("again"), "left_anti")
        numbered = alone.unionByName(equal.select("__row", "__source", "__key", "nth"))
    hashed = numbered.select("__row", "__source", hash_of(F.col("__key"), F.col("nth")).alias("hash"))
    out = hashed.join(plans, _same(F.col("__source"), F.col("p_source"))).select("__row", _copies(most).cast("int").alias("n")).filter("n > 0")
    return out.select("__row", F.explode(F.sequence(F.lit(1), "n"))).select("__row.*")


WORDS_SQL = r"len(list_filter(regexp_split_to_array(coalesce({0}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> ''))"


def mix_sql(table: str) -> str:
    """A WITH list (without the word) that ends in ``mix``: the columns of counted()."""
    weights = ", ".join(map(str, WEIGHTS))
    return f"""
keyed AS (SELECT doc_id, source, {WORDS_SQL.format('text')} AS size,
    md5(coalesce('s:' || source, 's:-') || coalesce(chr(10) || 'i:' || CAST(doc_id AS VARCHAR), chr(10) || 'i:-') || coalesce(chr(10) || 't:' || text, chr(10) || 't:-')) AS key FROM {table}),
numbered AS (SELECT *, row_number() OVER (PARTITION BY key) AS nth FROM keyed),
sized AS (SELECT doc_id, source, size, ('0x' || substr(md5(key || ':' || nth), 1, 12))::BIGINT AS hash FROM numbered),
totals AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rnk FROM totals),
weighed AS (SELECT *, ([{weights}])[CAST(rnk % {len(WEIGHTS)} AS INTEGER) + 1] AS weight, source_size * {MOST} AS lim FROM ranked),
reached AS (SELECT *, lim / weight AS reach FROM weighed),
rated AS (SELECT *, ({SHARE} * sum(source_size) OVER () - coalesce(sum(lim) OVER (ORDER BY reach, rnk ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY reach, rnk ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate FROM reached),
found AS (SELECT rate AS f FROM rated WHERE rate <= reach ORDER BY reach, rnk LIMIT 1),
wanted AS (SELECT source, source_size, CASE WHEN f IS NULL OR reach < f THEN CAST(lim AS DOUBLE) ELSE CAST(weight * f AS DOUBLE) END AS target
    FROM rated LEFT JOIN found ON true),
planned AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS full_copies FROM wanted),
hashes AS (SELECT source, hash, sum(size) AS size FROM sized GROUP BY source, hash),
summed AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY hash) AS upto FROM hashes),
below AS (SELECT s.source, s.hash, CASE WHEN s.upto <= p.target - p.full_copies * p.source_size
        OR (s.upto - s.size <= p.target - p.full_copies * p.source_size AND p.target - p.full_copies * p.source_size - (s.upto - s.size) >= s.size / 2) THEN 1 ELSE 0 END AS more
    FROM summed s JOIN planned p ON s.source IS NOT DISTINCT FROM p.source),
mix AS (SELECT d.doc_id, CAST(d.size AS BIGINT) AS size, p.source_size, p.target, CAST(least(p.full_copies + b.more, {MOST}) * d.size AS BIGINT) AS taken, least(p.full_copies + b.more, {MOST}) AS copies, d.source
    FROM sized d JOIN planned p ON d.source IS NOT DISTINCT FROM p.source JOIN below b ON d.source IS NOT DISTINCT FROM b.source AND d.hash = b.hash)"""
