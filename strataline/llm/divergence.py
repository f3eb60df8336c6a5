"""How far the sources of a language differ in their words, and by which words.

First pass: in how many documents of its language each term occurs, exactly; terms in LEAST_DOCUMENTS or more are
kept. Second pass: an automaton of the kept terms, each between delimiters, runs over the texts, written as terms
with one delimiter between, and recounts occurrences by language and source. Both passes add up in the task before
anything moves. Automata hold at most BLOCK_TERMS terms: so many go to all tasks at once, and a larger vocabulary
takes more passes over the texts.

What is counted stays sparse: postings of (language, source, term) with a count above 0. A term that a source
has not has the same smoothed share there whatever the term, so distances of two sources need their own terms and
those that they have in common alone.

Shares are whole numbers, of a thousand million; counts are exact, in decimals where they are multiplied.

A null text, language or source is the empty string. Texts are read whole; one without terms counts for nothing
but its group. Repeated rows are documents of their own. A language without kept terms gives pairs of distance 0
and no terms; an empty table gives an empty result. Other columns are not read, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataline.session import discard, materialise

LEAST_DOCUMENTS = 30
SMOOTH = 5
SCALE = 1_000_000_000
TOP = 50
#: Terms of an automaton, which goes to all tasks.
BLOCK_TERMS = 250_000
#: Different counts that a task holds before it hands them on.
HELD = 200_000
#: Postings of a language that meet in one task for distances, more or less, and pairs of them held at once there.
TOGETHER, PAIRS_HELD = 1 << 17, 1 << 20

#: Bytes of terms stay, A-Z lower-cased; all others become the delimiter.
_TERMS = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))


def _groups(docs: DataFrame, lang_col: str, source_col: str, text_col: str) -> DataFrame:
    return docs.select(*[F.coalesce(docs[c].cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])


def _counted(groups: DataFrame, by: tuple[str, ...], count) -> DataFrame:
    """Sums of what ``count`` adds to a counter for each text, by the group's columns and term: *by, term, n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        add = count()
        held: dict[tuple, Counter] = {}
        size = 0

        def handed_on() -> pa.RecordBatch:
            keys = [k for k, c in held.items() for _ in c]
            columns = [pa.array([k[n] for k in keys], pa.string()) for n in range(len(by))]
            terms = pa.array([t for c in held.values() for t in c], pa.string())
            return pa.RecordBatch.from_arrays([*columns, terms, pa.array([n for c in held.values() for n in c.values()], pa.int64())], [*by, "term", "n"])

        for batch in batches:
            for *key, text in zip(*[batch.column(c).to_pylist() for c in by], batch.column("text").to_pylist(), strict=True):
                own = held.setdefault(tuple(key), Counter())
                before = len(own)
                add(own, text.encode("utf-8", "replace").translate(_TERMS))
                size += len(own) - before
                if size >= HELD:
                    yield handed_on()
                    held.clear()
                    size = 0
        yield handed_on()

    fields = ", ".join(f"{c} string" for c in (*by, "term"))
    return groups.select(*by, "text").mapInArrow(run, f"{fields}, n bigint").groupBy(*by, "term").agg(F.sum("n").alias("n"))


def document_frequencies(groups: DataFrame) -> DataFrame:
    """lang, term, n: documents of the language that have the term."""

    def count():
        def add(own: Counter, text: bytes) -> None:
            own.update([t.decode("utf-8", "replace") for t in set(text.split())])

        return add

    return _counted(groups, ("lang",), count)


def automaton(terms: list[str]):
    """Finds whole terms in text that has one delimiter between terms and at both ends."""
    import ahocorasick

    made = ahocorasick.Automaton()
    for t in terms:
        made.add_word(f" {t} ", t)
    if terms:
        made.make_automaton()
    return made


def occurrences(groups: DataFrame, terms: list[str]) -> DataFrame:
    """lang, source, term, n: occurrences of the given terms, which all tasks get."""
    told = groups.sparkSession.sparkContext.broadcast(terms)

    def count():
        known = automaton(told.value)

        def add(own: Counter, text: bytes) -> None:
            # split and join leave one delimiter between terms; a match takes both of its own, which neighbours share.
            line = (b" " + b" ".join(text.split()) + b" ").decode("utf-8", "replace")
            own.update([t for _, t in known.iter(line)])

        return add

    return _counted(groups, ("lang", "source"), count)


def postings(groups: DataFrame, kept: DataFrame) -> DataFrame:
    """lang, source, term, n of the terms that the language keeps, n > 0."""
    names = materialise(kept.select("term").distinct(), "divergence-terms")
    many = -(-names.count() // BLOCK_TERMS)
    out = None
    for k in range(many):
        part = names.filter(F.pmod(F.xxhash64("term"), F.lit(many)) == k) if many > 1 else names
        found = occurrences(groups, sorted(r.term for r in part.collect()))
        out = found if out is None else out.unionAll(found)
    if out is None:
        return groups.sparkSession.createDataFrame([], "lang string, source string, term string, n bigint")
    discard(names)
    return out.join(kept.select("lang", "term"), ["lang", "term"]).select("lang", "source", "term", "n")


def share(count: str, total: str, terms: str) -> Column:
    """The smoothed share of a count, from 1; null where there are no terms."""
    return F.expr(f"1 + ({SCALE}BD * ({count} + {SMOOTH})) div nullif({total} + {SMOOTH} * {terms}, 0)")


def _in_common(frame: pd.DataFrame) -> pd.DataFrame:
    """Over terms that two sources share: |p - q| less what each one's own share adds against the other's zero.

    ``frame``: lang, term, place (of the source), p and zero. Gives lang, a, b (places, a < b) and value.
    """
    frame = frame.assign(code=pd.factorize(frame["term"])[0]).sort_values(["code", "place"])
    code, place, p, zero = (frame[c].to_numpy() for c in ("code", "place", "p", "zero"))
    end = np.searchsorted(code, code, side="right")
    later = end - np.arange(len(code)) - 1  # each posting meets those of its term after it
    upto = np.append(0, np.cumsum(later))
    out, a = [], 0
    while a < len(code):
        b = max(a + 1, int(np.searchsorted(upto, upto[a] + PAIRS_HELD, "right")) - 1)
        left = np.repeat(np.arange(a, b), later[a:b])
        right = left + 1 + np.arange(len(left)) - (upto[left] - upto[a])
        pl, pr, zl, zr = p[left], p[right], zero[left], zero[right]
        value = np.abs(pl - pr) - np.abs(pl - zr) - np.abs(zl - pr) + np.abs(zl - zr)
        out.append(pd.DataFrame({"a": place[left], "b": place[right], "value": value}).groupby(["a", "b"], as_index=False).sum())
        a = b
    both = pd.concat(out).groupby(["a", "b"], as_index=False).sum()
    return both.assign(lang=frame["lang"].iloc[0])[["lang", "a", "b", "value"]]


def pair_distances(found: DataFrame, sources: DataFrame) -> DataFrame:
    """lang, a, b (places, a < b), value: the sum of |p - q| over all kept terms of the language.

    ``found``: postings with place, p, zero and blocks, into how many their language's are dealt by term;
    ``sources``: lang, place, zero, terms (kept in the language).
    With z the share of a count of 0, the sum is V|z - z'|, for each source alone the sum over its own terms of
    |p - z'| - |z - z'|, and what terms in common add. The second comes from running sums over its shares.
    """
    # Written, so that what tasks have of a share is added up before a source's shares meet.
    shares = materialise(found.groupBy("lang", "place", "zero", F.col("p").alias("at")).agg(F.count(F.lit(1)).alias("n")), "divergence-histogram")
    other = sources.select("lang", F.col("place").alias("other"), F.col("zero").alias("at"))
    points = sources.join(other, "lang").filter(F.col("place") != F.col("other"))
    rows = shares.select("lang", "place", "zero", "at", "n", F.lit(None).cast("int").alias("other"), F.lit(None).cast("bigint").alias("terms"))
    rows = rows.unionByName(points.select("lang", "place", "zero", "at", F.lit(0).cast("bigint").alias("n"), "other", "terms"))
    own = W.partitionBy("lang", "place")
    below = own.orderBy("at").rangeBetween(W.unboundedPreceding, 0)
    rows = rows.withColumns({"n_below": F.sum("n").over(below), "sum_below": F.sum(F.col("n") * F.col("at")).over(below), "n_all": F.sum("n").over(own), "sum_all": F.sum(F.col("n") * F.col("at")).over(own)})
    at, gap = F.col("at"), F.abs(F.col("zero") - F.col("at"))
    alone = at * F.col("n_below") - F.col("sum_below") + F.col("sum_all") - F.col("sum_below") - at * (F.col("n_all") - F.col("n_below")) - F.col("n_all") * gap
    first = F.col("place") < F.col("other")
    alone = rows.filter("other IS NOT NULL").select("lang", F.least("place", "other").alias("a"), F.greatest("place", "other").alias("b"), (F.coalesce(alone, F.lit(0)) + F.when(first, F.coalesce(F.col("terms") * gap, F.lit(0))).otherwise(0)).alias("value"))
    dealt = found.select("lang", "term", "place", "p", "zero", F.pmod(F.xxhash64("term"), "blocks").alias("block"))
    common = dealt.groupBy("lang", "block").applyInPandas(_in_common, "lang string, a int, b int, value bigint")
    return alone.unionByName(common).groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", least: int = LEAST_DOCUMENTS, top: int = TOP) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part ``pair``: each other source of the language by distance; part ``term``: the ``top`` kept terms that have
    most more of a share in the source than in its language. Ranks begin at 1; of equal values the item first by
    bytes comes first.
    """
    groups = _groups(docs, lang_col, source_col, text_col)
    names = materialise(groups.select("lang", "source").distinct(), "divergence-groups")
    kept = materialise(document_frequencies(groups).filter(F.col("n") >= least).select("lang", "term"), "divergence-kept")
    found = materialise(postings(groups, kept), "divergence-postings")
    terms = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    totals = found.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    by_name = W.partitionBy("lang").orderBy("source")
    sources = names.join(totals, ["lang", "source"], "left").join(terms, "lang", "left").fillna(0, ["total", "terms"])
    sources = sources.select("lang", "source", "total", "terms", F.row_number().over(by_name).alias("place"), share("0", "total", "terms").alias("zero"), F.sum("total").over(W.partitionBy("lang")).alias("lang_total"), (F.col("terms") * F.count(F.lit(1)).over(W.partitionBy("lang")) / TOGETHER + 1).cast("int").alias("blocks"))
    sources = materialise(sources, "divergence-sources")
    told = found.join(sources, ["lang", "source"]).withColumn("lang_n", F.sum("n").over(W.partitionBy("lang", "term")))
    told = materialise(told.select("lang", "source", "term", "place", "zero", "blocks", share("n", "total", "terms").alias("p"), share("lang_n", "lang_total", "terms").alias("q")), "divergence-shares")
    discard(names, kept, found)

    pairs = pair_distances(told, sources.select("lang", "place", "zero", "terms"))
    both = pairs.select("lang", "value", F.explode(F.array(F.struct(F.col("a").alias("place"), F.col("b").alias("other")), F.struct(F.col("b").alias("place"), F.col("a").alias("other")))).alias("s")).select("lang", "value", "s.*")
    name = sources.select("lang", "place", "source")
    both = both.join(name, ["lang", "place"]).join(name.select("lang", F.col("place").alias("other"), F.col("source").alias("item")), ["lang", "other"])
    order = W.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair_rows = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(order).alias("rank"))
    over = told.filter("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return pair_rows.unionByName(over.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top))


def audit_sql(table: str) -> str:
    """SQL for the rows of audit()."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{lower}'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM {table}),
seen AS (SELECT row_id, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term FROM seen GROUP BY lang, term HAVING count(DISTINCT row_id) >= {LEAST_DOCUMENTS}),
names AS (SELECT DISTINCT lang, source FROM docs),
sizes AS (SELECT n.lang, count(term) AS v FROM (SELECT DISTINCT lang FROM names) n LEFT JOIN kept USING (lang) GROUP BY n.lang),
counts AS (SELECT lang, source, term, count(*) AS n FROM seen JOIN kept USING (lang, term) GROUP BY lang, source, term),
dense AS (SELECT k.lang, k.term, g.source, coalesce(c.n, 0) AS n FROM kept k JOIN names g USING (lang) LEFT JOIN counts c ON c.lang = k.lang AND c.source = g.source AND c.term = k.term),
shares AS (SELECT d.lang, term, source, n, 1 + (CAST({SCALE} AS HUGEINT) * (n + {SMOOTH})) // (sum(n) OVER (PARTITION BY d.lang, source) + {SMOOTH} * v) AS p,
    1 + (CAST({SCALE} AS HUGEINT) * (sum(n) OVER (PARTITION BY d.lang, term) + {SMOOTH})) // (sum(n) OVER (PARTITION BY d.lang) + {SMOOTH} * v) AS q FROM dense d JOIN sizes USING (lang)),
sums AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value FROM names a JOIN names b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
both_parts AS (SELECT * FROM pairs UNION ALL SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM both_parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}"""
