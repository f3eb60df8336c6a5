"""A Merkle manifest of a table: a hash tree of its rows for each source, and one over the sources.

A row is a leaf. Leaves of a source ascend by id; every ARITY consecutive nodes become one until one is left,
the source's subroot; subroots ascend by source (null first) and become the root likewise.

Nodes are numbered in ranges of their order and dealt into blocks of BLOCK consecutive ones. A block is an
ordered array that `transform`, `slice` and `aggregate` collapse level by level; its root is a node of the next
height, which is dealt into blocks again, so that a table of any size is a few rounds of small rows. Way back
down, each block gets the siblings above it once and gives its nodes theirs.

Null ids come first and are a value like any other; a null field is hashed as `-`. Rows of one id stand in the
order of their leaves. Equal rows are counted before they move, and each is a leaf of its own. Empty texts and
texts of any length are hashed whole. A lone leaf is its source's subroot. An empty table has no root and gives
an empty result. Other columns of a table are not read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataline.functions import ranges
from strataline.session import discard, materialise

ARITY, DEPTH = 3, 6
#: Nodes in a block: full ones collapse to one node in DEPTH levels.
BLOCK = ARITY**DEPTH
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: The one tree over the subroots.
_TOP = "top"


def digest_of(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts, one after the other."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def framed(value: Column) -> Column:
    """A value with its length in bytes, so that fields cannot run into each other."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(docs: DataFrame, fields: tuple[str, ...] = FIELDS, instead: dict[str, Column] | None = None) -> Column:
    """The leaf of a row, or what it would be with other values in some fields."""
    return digest_of(*[framed((instead or {}).get(f, docs[f])) for f in fields])


def _levels(nodes: Column, rounds: Column) -> Column:
    """The array of nodes, then the array of each level above, up to ``rounds`` levels."""

    def above(level: Column) -> Column:
        runs = F.sequence(F.lit(0), F.floor((F.size(level) - 1) / ARITY).cast("int"))
        return F.transform(runs, lambda r: F.sha2(F.array_join(F.slice(level, r * ARITY + 1, ARITY), "").cast("binary"), 256))

    steps = F.slice(F.array(*[F.lit(k) for k in range(DEPTH)]), F.lit(1), rounds)
    return F.aggregate(steps, F.array(nodes), lambda levels, _: F.concat(levels, F.array(above(F.element_at(levels, -1)))))


def _siblings(k: int, place: Column) -> Column:
    """The others in the run of a block's node on level ``k``, left and right of it, as text."""
    level, at = F.get("levels", F.lit(k)), F.floor(place / ARITY**k).cast("int")
    nth = at % ARITY

    def node(step: int) -> Column:
        return F.coalesce(F.get(level, at + step), F.lit(""))

    left = F.when(nth == 0, "").when(nth == 1, node(-1)).otherwise(F.concat(node(-2), node(-1)))
    right = F.when(nth == 0, F.concat(node(1), node(2))).when(nth == 1, node(1)).otherwise("")
    return F.struct(left.alias("left"), right.alias("right"))


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` (tree, node, copies and more), one for each copy, with pos (from 0, in its tree) and nodes (of the tree).

    Ranges of the order are numbered apart and begin after the sum of those before them; a tree of any size is
    spread over ranges.
    """
    keys = ["tree", *order]
    ranged = rows.withColumn("range", ranges.number(rows, keys, ranges.bounds(rows, keys)))
    before = W.partitionBy("range", "tree").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    sums = ranged.groupBy("tree", "range").agg(F.sum("copies").alias("sum"))
    tree = W.partitionBy("tree")
    offsets = sums.select(
        "tree", "range", F.sum("sum").over(tree).alias("nodes"),
        F.coalesce(F.sum("sum").over(tree.orderBy("range").rowsBetween(W.unboundedPreceding, -1)), F.lit(0)).alias("offset"),
    )
    first = F.col("offset") + F.coalesce("within", F.lit(0))
    return ranged.withColumn("within", F.sum("copies").over(before)).join(offsets, ["tree", "range"]).withColumn("pos", F.explode(F.sequence(first, first + F.col("copies") - 1)))


def _blocks(placed: DataFrame, carried: list[str]) -> DataFrame:
    """tree, nodes, block, members (ordered structs of pos, node and what is carried) and levels."""
    member = F.struct("pos", "node", *carried)
    grouped = placed.groupBy("tree", "nodes", F.expr(f"pos div {BLOCK}").alias("block")).agg(F.array_sort(F.collect_list(member)).alias("members"))
    # A tree of one block ends at its root; blocks of a larger tree all give a node of the same level.
    rounds = sum(((F.col("nodes") > ARITY**k).cast("int") for k in range(DEPTH)), F.lit(0))
    return grouped.withColumn("levels", _levels(F.transform("members", lambda m: m["node"]), rounds))


def _roots(blocks: DataFrame) -> DataFrame:
    return blocks.select("tree", F.expr(f"(nodes + {BLOCK - 1}) div {BLOCK}").alias("nodes"), F.col("block").alias("pos"), F.get(F.element_at("levels", -1), F.lit(0)).alias("node"))


def _heights(placed: DataFrame, carried: list[str]) -> list[DataFrame]:
    """Written tables of blocks, from the nodes given up to the height at which each tree is one block."""
    out = [materialise(_blocks(placed, carried), "merkle-blocks")]
    while (out[-1].agg(F.max("nodes")).first()[0] or 0) > BLOCK:
        out.append(materialise(_blocks(_roots(out[-1]), []), "merkle-blocks"))
    return out


def _down(heights: list[DataFrame], above: DataFrame, carried: list[str]) -> DataFrame:
    """The nodes of the lowest height with their paths. ``above``: tree, block, path and more, for the highest."""
    for k, blocks in enumerate(reversed(heights)):
        lowest = k + 1 == len(heights)
        own = lambda m, i: F.struct(m["pos"].alias("pos"), m["node"].alias("node"), *[m[c].alias(c) for c in (carried if lowest else [])], F.slice(F.array(*[_siblings(n, i) for n in range(DEPTH)]), F.lit(1), F.size("levels") - 1).alias("own"))  # noqa: E731, B023
        rest = [c for c in above.columns if c not in ("tree", "block", "path")]
        rows = blocks.join(above, ["tree", "block"]).select("tree", "path", *rest, F.inline(F.transform("members", own)))
        path = F.concat("own", "path").alias("path")
        above = rows.select("tree", F.col("pos").alias("block"), path, *rest) if not lowest else rows.select("tree", "node", path, *carried, *rest)
    return above


class Manifest:
    """The written trees of a table of leaves (source, leaf, and more that its leaves carry)."""

    def __init__(self, leaves: DataFrame, order: list[str], carried: list[str]) -> None:
        # Null first, and then by bytes.
        tree = F.when(F.col("source").isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), "source"))
        more = [c for c in carried if c not in order]
        counted = leaves.select(tree.alias("tree"), F.col("leaf").alias("node"), *dict.fromkeys([*order, *carried])).groupBy("tree", *order, "node").agg(F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in more])
        counted = materialise(counted, "merkle-leaves")
        self.carried = carried
        self.low = _heights(_numbered(counted, [*order, "node"]), carried)
        discard(counted)
        tops = materialise(_roots(self.low[-1]).select(F.lit(_TOP).alias("tree"), F.col("tree").alias("child"), "node", F.lit(1).cast("bigint").alias("copies")), "merkle-subroots")
        self.high = _heights(_numbered(tops, ["child"]), ["child"])
        discard(tops)

    def root(self) -> DataFrame:
        """One row: root; none for an empty table."""
        return _roots(self.high[-1]).select(F.col("node").alias("root"))

    def subroots(self) -> DataFrame:
        """A row for each source: source, subroot."""
        return _roots(self.low[-1]).select(F.when(F.col("tree") != "n", F.substr("tree", F.lit(2))).alias("source"), F.col("node").alias("subroot"))

    def proofs(self) -> DataFrame:
        """A row for each leaf: leaf, what it carries, subroot, root and path, the siblings (left, right) by level."""
        none = F.array().cast("array<struct<left:string,right:string>>")
        peak = _roots(self.high[-1]).select("tree", F.lit(0).cast("bigint").alias("block"), none.alias("path"), F.col("node").alias("root"))
        top = _down(self.high, peak, ["child"]).select(F.col("child").alias("tree"), F.lit(0).cast("bigint").alias("block"), "path", F.col("node").alias("subroot"), "root")
        return _down(self.low, top, self.carried).withColumnRenamed("node", "leaf")


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the siblings on its path give."""
    return F.aggregate(path, leaf, lambda node, s: digest_of(s["left"], node, s["right"]))


def proof_digest(path: Column) -> Column:
    return F.sha2(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), "").cast("binary"), 256)


def tamper_report(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """Per row: doc_id, leaf, subroot, root, proof_sha256, folded_root and verified.

    Where 2 divides the CRC-32 of the id as text, the row is checked as if its text had lost its line feeds.
    """
    text = docs[text_col]
    hit = (F.crc32(docs[id_col].cast("string").cast("binary")) % 2 == 0) & F.contains(text, F.lit("\n"))
    changed = leaf_of(docs, fields, {text_col: F.replace(text, F.lit("\n"), F.lit(""))})
    leaves = docs.select(docs[id_col].alias("doc_id"), docs[source_col].alias("source"), leaf_of(docs, fields).alias("leaf"), F.when(hit, changed).alias("tampered"))
    proofs = Manifest(leaves, ["doc_id"], ["doc_id", "tampered"]).proofs()
    out = proofs.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"), folded(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


def manifest_sql(table: str) -> str:
    """SQL for the columns of tamper_report()."""
    leaf = " || ".join(f"coalesce(strlen(CAST({{{f}}} AS VARCHAR)) || ':' || {{{f}}}, '-')" for f in FIELDS)
    plain = {f: f for f in FIELDS}
    return f"""
WITH RECURSIVE crc_table AS (SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
hashed AS (SELECT doc_id, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS tree, sha256({leaf.format(**plain)}) AS leaf, sha256({leaf.format(**plain | {"text": "replace(text, chr(10), '')"})}) AS changed,
    xor(4294967295, list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)), lambda c, b: xor(c >> 8, t[CAST(xor(c, b) & 255 AS INTEGER) + 1]), 4294967295)) AS crc FROM {table}, crc_table),
leaves AS (SELECT row_number() OVER () AS row_id, doc_id, tree, leaf, CASE WHEN crc % 2 = 0 THEN changed ELSE leaf END AS tampered,
    row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM hashed),
low AS (SELECT 0 AS level, tree, pos, leaf AS node FROM leaves
    UNION ALL SELECT level + 1, tree, pos // {ARITY}, sha256(string_agg(node, '' ORDER BY pos)) FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM low) WHERE n > 1 GROUP BY level, tree, pos // {ARITY}),
tops AS (SELECT tree, max(level) AS levels, arg_max(node, level) AS subroot, row_number() OVER (ORDER BY tree) - 1 AS spot FROM low GROUP BY tree),
high AS (SELECT 0 AS level, spot AS pos, subroot AS node FROM tops
    UNION ALL SELECT level + 1, pos // {ARITY}, sha256(string_agg(node, '' ORDER BY pos)) FROM (SELECT *, count(*) OVER () AS n FROM high) WHERE n > 1 GROUP BY level, pos // {ARITY}),
peak AS (SELECT max(level) AS top_levels, arg_max(node, level) AS root FROM high),
nodes AS (SELECT 0 AS part, tree, level, pos, node FROM low UNION ALL SELECT 1, '', level, pos, node FROM high),
steps AS (SELECT row_id, 0 AS part, tree, pos, unnest(range(levels)) AS level FROM leaves JOIN tops USING (tree)
    UNION ALL SELECT row_id, 1, '', spot, unnest(range(top_levels)) FROM leaves JOIN tops USING (tree), peak),
own AS (SELECT *, pos // CAST(pow({ARITY}, level) AS BIGINT) AS place FROM steps),
sides AS (SELECT o.row_id, o.part, o.level, coalesce(string_agg(n.node, '' ORDER BY n.pos) FILTER (n.pos < o.place), '') AS l, coalesce(string_agg(n.node, '' ORDER BY n.pos) FILTER (n.pos > o.place), '') AS r
    FROM own o JOIN nodes n ON n.part = o.part AND n.tree = o.tree AND n.level = o.level AND n.pos // {ARITY} = o.place // {ARITY} GROUP BY o.row_id, o.part, o.level),
paths AS (SELECT row_id, list(l || '|' || r ORDER BY part, level) AS path FROM sides GROUP BY row_id),
told AS (SELECT doc_id, leaf, subroot, root, coalesce(path, []) AS path, tampered FROM leaves JOIN tops USING (tree) CROSS JOIN peak LEFT JOIN paths USING (row_id)),
folds AS (SELECT *, list_reduce(path, lambda a, s: sha256(split_part(s, '|', 1) || a || split_part(s, '|', 2)), tampered) AS folded_root FROM told)
SELECT doc_id, leaf, subroot, root, sha256(replace(list_aggregate(list_concat([''], path), 'string_agg', ''), '|', '')) AS proof_sha256, folded_root, folded_root = root AS verified FROM folds"""
