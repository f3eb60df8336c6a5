"""Line dedup by a deletion-neighbourhood join.

Lines are the parts of a text between line feeds that hold a word. A line goes if an earlier line, by
(document id, line number, row key), has the same bytes, or lies within one word of it: one word inserted, deleted
or replaced. Near matches are sought between lines of at least MIN_WORDS words (the shorter one may have
one less); the earliest of what matches stays. Whether the earlier line stays itself makes no difference.

1. Lines are reduced to distinct ones, by 128 hash bits, with their first place.
2. Two lines within one edit have their first or their last half in common. Only lines that share such a
   half with another go on.
3. Each of these emits its variants with one word deleted, as hashed keys. Lines of one length that share
   a variant and the place of the deletion differ in that word alone, so the smallest place in each group
   is an earlier match of all others, and no pairs are made. A line that equals a variant of a longer one
   matches it; it is the only line with that key, so there is one pair for each variant at most.
4. The edit distance of what was found is verified on the words.

The row key is 128 hash bits of id and text, so rows that share an id, or have none, keep their own lines.
Null texts have no lines. Rows of one id and one text are taken as one document: a line does not go because
of its own repetition in an equal row. A null id comes first. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataline.llm.quality_rules import words_of
from strataline.session import discard, materialise

MIN_WORDS = 8
#: Rows are compared where one in so many lines of one, or more, stands in the other.
FEW = 20
#: What addresses a line, in order.
PLACE = ("doc_id", "line_no", "r1", "r2")


def row_key(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """128 bits of id and text, never null; rows of one key are equal in both."""
    return [F.xxhash64(F.lit(seed), docs[id_col].isNull(), docs[id_col], docs[text_col]).alias(f"r{seed + 1}") for seed in (0, 1)]


def _places(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, row key, line_no and line of each line that holds a word."""
    lines = docs.select(docs[id_col].alias("doc_id"), *row_key(docs, id_col, text_col), F.posexplode(F.split(docs[text_col], "\n")).alias("line_no", "line"))
    return lines.filter(F.col("line").rlike(r"[^\x20\x09-\x0D]"))


def _hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per line: its place, 128 bits of its bytes, number of words and keys of its halves."""
    n, w = F.size("w"), F.col("w")

    def half(end: str, size: Column) -> Column:
        part = F.slice(w, F.lit(1), size) if end == "head" else F.slice(w, n - size + 1, size)
        return F.when(n >= MIN_WORDS - 1, F.xxhash64(F.lit(end), size, part))

    with_words = _places(docs, id_col, text_col).select(*PLACE, F.xxhash64(F.lit(0), "line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), words_of(F.col("line")).alias("w"))
    same, less = F.floor(n / 2).cast("int"), F.floor((n - 1) / 2).cast("int")
    # As the longer of two lines, a line of an even number of words has a shorter half to share.
    odd = n % 2 == 1
    return with_words.select(
        *PLACE, "h1", "h2", n.alias("n"),
        half("head", same).alias("a"), half("tail", same).alias("b"),
        F.when(~odd, half("head", less)).alias("c"), F.when(~odd, half("tail", less)).alias("d"),
    )


def _survivors(distinct: DataFrame) -> DataFrame:
    """The places of distinct lines that share a half with another line."""
    keys = distinct.filter(F.col("n") >= MIN_WORDS - 1).select("first", F.explode(F.array("a", "b", "c", "d")).alias("key")).filter("key IS NOT NULL")
    shared = keys.groupBy("key").count().filter("count > 1").select("key")
    return keys.join(shared, "key", "left_semi").select(*[f"first.{c}" for c in PLACE]).distinct()


def _variants(lines: DataFrame) -> DataFrame:
    """For each word of the lines (place and w, the words): the key of the line without it, and up to it."""
    word = lines.select("place", F.size("w").alias("n"), F.posexplode("w").alias("pos", "word"))
    # A variant's key: the words before the place as they stand, those after it one further left.
    for seed in (1, 2):
        word = word.withColumn(f"a{seed}", F.xxhash64(F.lit(seed), "word", "pos")).withColumn(f"b{seed}", F.xxhash64(F.lit(seed), "word", F.col("pos") - 1))
    by_line = W.partitionBy("place")
    upto = by_line.orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    for seed in (1, 2):
        a, b = F.col(f"a{seed}"), F.col(f"b{seed}")
        before = F.bit_xor(a).over(upto).bitwiseXOR(a)
        after = F.bit_xor(b).over(by_line.orderBy("pos").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)).bitwiseXOR(F.bit_xor(b).over(upto))
        word = word.withColumn(f"k{seed}", before.bitwiseXOR(after)).withColumn(f"whole{seed}", F.bit_xor(a).over(upto))
    return word.select("place", "n", "pos", "k1", "k2", "whole1", "whole2")


def _neighbours(word: DataFrame) -> DataFrame:
    """(later, earlier) places of lines that may be within one word of each other, from their variants."""
    cut = word.filter(F.col("n") >= MIN_WORDS).select("place", "pos", "k1", "k2")
    groups = cut.groupBy("k1", "k2", "pos").agg(F.min("place").alias("earlier"), F.max("place").alias("last")).filter("earlier < last").select("k1", "k2", "pos", "earlier")
    replaced = cut.join(groups, ["k1", "k2", "pos"]).filter("earlier < place").select(F.col("place").alias("later"), "earlier")
    whole = word.filter(F.col("pos") == F.col("n") - 1).select(F.col("place").alias("short"), F.col("whole1").alias("k1"), F.col("whole2").alias("k2"))
    deleted = cut.join(whole, ["k1", "k2"]).select(F.greatest("place", "short").alias("later"), F.least("place", "short").alias("earlier")).filter("earlier < later")
    return replaced.union(deleted)


def _within_one(a: str, b: str) -> Column:
    """Whether two arrays of words are one word apart at most; ``b`` is not the shorter one."""
    same = F.expr(f"size(filter(zip_with({a}, {b}, (x, y) -> x <=> y), e -> NOT e)) <= 1")
    first = f"coalesce(nullif(array_position(zip_with({a}, {b}, (x, y) -> x <=> y), false), 0), size({a}) + 1)"
    longer = F.expr(f"slice({a}, cast({first} AS int), size({a}) + 1) = slice({b}, cast({first} AS int) + 1, size({b}) + 1)")
    return F.when(F.size(a) == F.size(b), same).when(F.size(b) == F.size(a) + 1, longer).otherwise(False)


def _gone(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(later, earlier, edits) for each line that goes; places are those of PLACE."""
    lines = materialise(_hashed(docs, id_col, text_col), "lines")
    place = F.struct(*PLACE)
    distinct = materialise(
        lines.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("times"), F.min("n").alias("n"), *[F.min(c).alias(c) for c in "abcd"]), "distinct-lines"
    )
    repeated = distinct.filter("times > 1").select("h1", "h2", "first")
    exact = lines.join(repeated, ["h1", "h2"]).select(place.alias("later"), F.col("first").alias("earlier"), F.lit(0).alias("edits")).filter("earlier < later")
    near_docs = materialise(_survivors(distinct).groupBy("r1", "r2").agg(F.collect_list("line_no").alias("line_nos")), "near-places")
    texts = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), *row_key(docs, id_col, text_col))
    # The parts are bound once for each text, inside the outer transform.
    picked = F.expr(r"flatten(transform(array(split(text, '\n')), parts -> transform(line_nos, n -> named_struct('line_no', n, 'line', get(parts, n)))))")
    # Places of near lines grow with the texts: they are never broadcast.
    found = texts.join(near_docs.hint("merge"), ["r1", "r2"]).select("doc_id", "r1", "r2", F.explode(picked).alias("x")).select("doc_id", "x.line_no", "r1", "r2", "x.line")
    found = found.select(place.alias("place"), words_of(F.col("line")).alias("w"))
    # Equal rows bring their lines again; one of each is enough.
    near_lines = materialise(found.dropDuplicates(["place"]), "near-lines")
    exact = materialise(exact, "exact-lines")
    discard(lines, distinct, near_docs)
    variants = materialise(_variants(near_lines), "line-variants")
    pairs = materialise(_neighbours(variants).groupBy("later").agg(F.min("earlier").alias("earlier")), "near-pairs")
    discard(variants)
    left = near_lines.select(F.col("place").alias("later"), F.col("w").alias("x"))
    right = near_lines.select(F.col("place").alias("earlier"), F.col("w").alias("y"))
    swapped = F.size("x") > F.size("y")
    checked = pairs.join(left, "later").join(right, "earlier").select("later", "earlier", F.when(swapped, F.col("y")).otherwise(F.col("x")).alias("p"), F.when(swapped, F.col("x")).otherwise(F.col("y")).alias("q"))
    near = materialise(checked.filter(_within_one("p", "q")).select("later", "earlier", F.lit(1).alias("edits")), "near-gone")
    discard(near_lines, pairs)
    return exact.union(near)


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Lines that go: doc_id, line_no (from 0), edits (0 or 1), first_doc_id, first_line_no; equal ones once."""
    gone = _gone(docs, id_col, text_col)
    return gone.select(F.col("later.doc_id").alias("doc_id"), F.col("later.line_no").alias("line_no"), "edits", F.col("earlier.doc_id").alias("first_doc_id"), F.col("earlier.line_no").alias("first_line_no")).distinct()


def _shingles(w: Column) -> Column:
    """The distinct five-word shingles of an array of words as numbers; fewer words make one."""
    places = F.sequence(F.lit(0), F.size(w) - 5)
    long = F.array_distinct(F.transform(places, lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(5)])))
    return F.when(F.size(w) < 5, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(long)


def _alike(docs: DataFrame, gone: DataFrame, id_col: str, text_col: str, percent: int) -> DataFrame:
    """Pairs (l1, l2, e1, e2) of a row that loses lines and the row where they stand first, if the two are alike.

    Pairs in which few of the row's lines stand in the other are not compared: without these lines it is still
    what it was.
    """
    lost = gone.select(*[F.col(f"{end}.r{k}").alias(f"{end[0]}{k}") for end in ("later", "earlier") for k in (1, 2)]).filter("l1 <> e1 OR l2 <> e2").groupBy("l1", "l2", "e1", "e2").count()
    key = row_key(docs, id_col, text_col)
    n = docs.select(*key, F.size(F.split(docs[text_col], "\n")).alias("n")).withColumnsRenamed({"r1": "l1", "r2": "l2"})
    pairs = materialise(lost.join(n, ["l1", "l2"]).filter(F.col("count") * FEW >= F.col("n")).select("l1", "l2", "e1", "e2").distinct(), "row-pairs")
    rows = pairs.select(F.col("l1").alias("r1"), F.col("l2").alias("r2")).union(pairs.select("e1", "e2")).distinct()
    texts = docs.select(*key, docs[text_col].alias("text")).join(rows.hint("merge"), ["r1", "r2"], "left_semi").dropDuplicates(["r1", "r2"])
    # ASCII case is ignored. The words are bound once for each text.
    lowered = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = materialise(texts.select("r1", "r2", words_of(lowered).alias("w")).select("r1", "r2", _shingles(F.col("w")).alias("x")), "row-shingles")
    joined = pairs
    for end in "le":
        joined = joined.join(sets.select(F.col("r1").alias(f"{end}1"), F.col("r2").alias(f"{end}2"), F.col("x").alias(f"x{end}")), [f"{end}1", f"{end}2"])
    both = joined.select("l1", "l2", "e1", "e2", F.size("xl").alias("n"), F.size("xe").alias("m"), F.size(F.array_intersect("xl", "xe")).alias("both"))
    out = materialise(both.filter(100 * F.col("both") >= percent * (F.col("n") + F.col("m") - F.col("both"))).select("l1", "l2", "e1", "e2"), "alike")
    discard(pairs, sets)
    return out


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unless_alike: int | None = None) -> DataFrame:
    """``docs`` without the lines that go in each row's own text; all rows and columns stay.

    With ``unless_alike``, a line stays if the row where it stands first is a near copy of its own: of that
    many percent likeness in five-word shingles, or more.
    """
    gone = _gone(docs, id_col, text_col)
    if unless_alike is not None:
        alike = _alike(docs, gone, id_col, text_col, unless_alike)
        gone = gone.withColumns({f"{end[0]}{k}": F.col(f"{end}.r{k}") for end in ("later", "earlier") for k in (1, 2)}).join(alike, ["l1", "l2", "e1", "e2"], "left_anti")
    gone = materialise(gone.groupBy("later.r1", "later.r2").agg(F.collect_set("later.line_no").alias("gone")), "gone-lines")
    row = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text_col].alias("__text"), *row_key(docs, id_col, text_col))
    joined = row.join(gone, ["r1", "r2"], "left").select("row", "__text", "gone", F.split("__text", "\n").alias("lines"))
    stay = joined.withColumn("stay", F.when(F.col("gone").isNotNull(), F.expr("array_except(sequence(0, size(lines) - 1), gone)")))
    text = F.when(F.col("gone").isNull(), F.col("__text")).otherwise(F.array_join(F.expr("transform(stay, i -> get(lines, i))"), "\n"))
    return stay.select(*[text.alias(c) if c == text_col else F.col("row")[c].alias(c) for c in docs.columns])
