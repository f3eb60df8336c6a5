"""Size-aware heavy-light join of documents by the Jaccard likeness of their five-word shingles.

Two documents link if 100 * |A & B| >= 75 * |A | B|. Documents of one set are one class, so that copies
are never paired. Classes are light up to a size, heavy beyond it:

* Two light sets of sizes s and t link just if they have ceil(75 (s + t) / 175) shingles in common. All
  subsets of that size are enumerated as keys of 96 hash bits; equal keys are links, checked like the others.
* A pair with a heavy set is found by scanning inverted lists. All shingles have one order, rare ones
  first; linked sets then share one among the first few of each. The order is read from counters of a
  fixed number into which all documents are counted; whatever they hold, no link is lost.

The boundary is the size for which the enumerated keys and the scanned entries cost least.

Pairs are not enumerated within long lists. Each list has a hub, the class that has most entries in common with
others. What links with its hub is connected and needs no further pairs. All classes of a long list are compared
with its hub h. Two of them, x and y, share min(|x & h|, |y & h|) shingles at most that h has. So if that is less than
a link needs, they also share one that h has not: x - h and y - h, first few again, form further lists, in which
edits that two near copies have in common are rare. So a large group of near copies costs a few comparisons for
each member, while every link between two parts is still found. Pairs are counted over the lists before
their sets are read: linked sets share a known number of first shingles. All links are checked on whole sets.

Before whole sets are read, pairs are compared by bits: each shingle of a set flips one of some 2 to 4 bits for each
shingle, so the bits in which two sets differ are no more than the shingles in which they do. A pair that differs in
more bits than a link allows is dropped. So the pairs that meet by chance or in common passages, whose number may grow
faster than the texts, carry a thirtieth of their sets, and whole sets are carried for links and near misses alone.

A class is a digest of 128 bits. It is written as a number of 64 bits, the digest's first 63; the few digests that
agree in these get odd numbers of their own.

Null and empty texts have no shingles and no links. Rows of one id are reported each. A null id takes part;
it is never the smallest id of a component with others. One row of each component is chosen by row, not by id.
Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import combinations
from math import ceil, comb

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from strataline.llm.shingles import digest, mix, shingle_sets
from strataline.session import discard, materialise

#: Counters of the sketch, as a power of two. It is broadcast: 4 bytes each, whatever the input.
SKETCH_BITS = 18
CHUNKS = 16
#: Sizes above this are heavy in any case.
MOST_LIGHT = 16
#: A list of a shingle that is counted more often is dealt to several tasks.
LIST_ROWS = 20_000
#: A list of so many classes is searched by way of its hub.
LONG = 64
#: So many times at most are lists searched by way of hubs; after that all pairs of a list are compared.
DEPTH = 4
#: Bits of the filter that tells tasks which sets are wanted, as powers of two: at least and at most. Where it
#: is full, more sets are sent than needed and the join drops them.
FILTER_BITS = (20, 28)
#: Texts whose keys a Python worker sends on at once.
BATCH_ROWS = 500
PERCENT = 75

#: Bits for each shingle of a set, at least; the number is rounded up to a power of two.
BITS_PER_SHINGLE = 2

Digest = Callable[[np.ndarray], tuple[int, int]]


def least_overlap(s: int, t: int, percent: int = PERCENT) -> int:
    return -(-percent * (s + t) // (100 + percent))


def partner_sizes(s: int, percent: int = PERCENT) -> range:
    return range(-(-percent * s // 100), 100 * s // percent + 1)


def probe_length(s: int, percent: int = PERCENT) -> int:
    """So many first shingles hold one that any linked set has too."""
    return s - ceil(percent * s / 100) + 1


def index_length(s: int, percent: int = PERCENT) -> int:
    """The same if the linked set is not smaller."""
    return s - least_overlap(s, s, percent) + 1


def boundary(counts: dict[int, int], percent: int = PERCENT) -> int:
    """The largest light size of least cost, for so many sets of each size."""

    def light(s: int, most: int) -> int:
        return sum(comb(s, o) for t in partner_sizes(s, percent) if 1 <= t <= most and (o := least_overlap(s, t, percent)) <= min(s, t))

    def heavy(s: int) -> int:
        return probe_length(s, percent) * (1 + s)

    def cost(most: int) -> int:
        return sum(n * (light(s, most) if s <= most else heavy(s)) for s, n in counts.items() if s <= MOST_LIGHT)

    return min(range(MOST_LIGHT + 1), key=lambda b: (cost(b), b))


def flipped_bits(shingles: np.ndarray) -> bytes:
    """Bits of a set, each flipped as often as a shingle falls on it."""
    bits = 1 << max(6, (BITS_PER_SHINGLE * len(shingles) - 1).bit_length())
    slots = (shingles & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(slots, minlength=bits) & 1).astype(bool), bitorder="little").tobytes()


def least_difference(x: bytes, y: bytes) -> int:
    """So many shingles at least are in one of two sets alone. The bits of the larger are folded to the smaller's number."""
    a, b = (np.frombuffer(z, np.uint64) for z in sorted((x, y), key=len))
    return int(np.bitwise_count(a ^ np.bitwise_xor.reduce(b.reshape(-1, len(a)), axis=0)).sum())


def _texts(docs: DataFrame, id_col: str, text_col: str, *more: Column) -> DataFrame:
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"), *more)


def _row_key(docs: DataFrame) -> list[Column]:
    """128 bits of all columns of a row: rows of one key are equal. Nulls are told apart by their places."""
    columns = [docs[c] for c in docs.columns]
    return [F.xxhash64(F.lit(seed), *[c.isNull() for c in columns], *columns).alias(f"__k{seed + 1}") for seed in (0, 1)]


def _strings(column: Iterable) -> list[str | None]:
    return [x if isinstance(x, str) else None for x in column]


@dataclass(frozen=True)
class Source:
    """Texts, what _profiles() finds in them, and the numbers of digests that agree in 63 bits."""

    texts: DataFrame
    profiles: DataFrame
    digest: Digest
    clashes: dict[tuple[int, int], int]

    def class_of(self) -> Callable[[np.ndarray], int]:
        """The number of a set's class, as a function that can be sent to tasks."""
        digest, clashes = self.digest, self.clashes

        def number(shingles: np.ndarray) -> int:
            d1, d2 = digest(shingles)
            return clashes.get((d1, d2), d1 & -2) if clashes else d1 & -2

        return number


def _source(texts: DataFrame, digest: Digest) -> Source:
    """The profiles of the texts, written. Of n digests n**2 / 2**64 clash: some 500 of 10**11."""
    profiles = materialise(_profiles(texts, digest), "profiles")
    digests = profiles.filter("chunk < 0 AND n > 0").select(F.col("d1").bitwiseAND(F.lit(-2)).alias("c"), F.struct("d1", "d2").alias("d"))
    twice = digests.groupBy("c").agg(F.min("d").alias("low"), F.max("d").alias("high")).filter("low <> high").select("c")
    found = digests.join(twice, "c", "left_semi").select("d.d1", "d.d2").distinct().orderBy("d1", "d2").collect()
    return Source(texts, profiles, digest, {(r.d1, r.d2): 2 * k + 1 for k, r in enumerate(found)})


def _profiles(texts: DataFrame, digest: Digest) -> DataFrame:
    """Rows of two kinds: doc_id, n, digest and bits of each document, and the partial counters of each task.

    Further columns of ``texts``, long numbers that are never null, go with the documents. Ids of any type pass
    as Arrow columns and are never converted.
    """
    keys = [c for c in texts.columns if c not in ("doc_id", "text")]
    names = ["doc_id", "n", "d1", "d2", "chunk", "counts", "bits", *keys]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counters, kind = np.zeros(1 << SKETCH_BITS, np.int64), None
        for batch in batches:
            n, d1, d2, bits = [], [], [], []
            for s in shingle_sets(_strings(batch.column("text").to_pylist())):
                np.add.at(counters, (s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), 1)
                a, b = digest(s)
                n.append(len(s)), d1.append(a), d2.append(b), bits.append(flipped_bits(s) if len(s) else None)
            ids, rows = batch.column("doc_id"), batch.num_rows
            kind = ids.type
            numbers = [pa.array(x, pa.int64()) for x in (n, d1, d2)]
            yield pa.RecordBatch.from_arrays([ids, *numbers, pa.array([-1] * rows, pa.int32()), pa.nulls(rows, pa.binary()), pa.array(bits, pa.binary()), *[batch.column(k) for k in keys]], names)
        if counters.any():
            parts = [x.astype("<u4").tobytes() for x in np.split(np.minimum(counters, (1 << 32) - 1), CHUNKS)]
            zero = pa.array([0] * CHUNKS, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.nulls(CHUNKS, kind), zero, zero, zero, pa.array(range(CHUNKS), pa.int32()), pa.array(parts, pa.binary()), pa.nulls(CHUNKS, pa.binary()), *[zero for _ in keys]], names)

    more = "".join(f", {k} bigint" for k in keys)
    return texts.mapInArrow(run, f"doc_id {texts.schema['doc_id'].dataType.simpleString()}, n bigint, d1 bigint, d2 bigint, chunk int, counts binary, bits binary{more}")


def _sketch(profiles: DataFrame) -> np.ndarray:
    """The counters summed over all tasks, in two steps; their number is fixed."""

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        total = np.zeros((1 << SKETCH_BITS) // CHUNKS, np.uint64)
        for raw in pdf["counts"]:
            total += np.frombuffer(raw, "<u4")
        return pd.DataFrame({"chunk": [pdf["chunk"].iloc[0]], "part": [0], "counts": [np.minimum(total, (1 << 32) - 1).astype("<u4").tobytes()]})

    parts = profiles.filter("chunk >= 0").select("chunk", (F.xxhash64("counts") % 16).cast("int").alias("part"), "counts")
    schema = "chunk int, part int, counts binary"
    summed = parts.groupBy("chunk", "part").applyInPandas(add, schema).groupBy("chunk").applyInPandas(add, schema)
    out = np.zeros((CHUNKS, (1 << SKETCH_BITS) // CHUNKS), np.uint32)
    for r in summed.collect():
        out[r.chunk] = np.frombuffer(r.counts, "<u4")
    return out.ravel()


def _entries(source: Source, sketch: np.ndarray, most_light: int, percent: int) -> DataFrame:
    """Keys of each set: key, part, c (class), n, pos. In lists pos is 0; for a key of a subset it is -1 minus the
    partner's size, and part has more bits of the key.

    A counter holds what all shingles have by chance, which grows with the texts, besides what a frequent one adds; so
    a list is dealt to several tasks by what its counter has beyond the middle one.
    """
    texts, class_of, middle = source.texts, source.class_of(), int(np.median(sketch))
    shared = texts.sparkSession.sparkContext.broadcast(sketch)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counters, done = shared.value, set()
        for some in (pdf["text"].iloc[k : k + BATCH_ROWS] for pdf in batches for k in range(0, len(pdf), BATCH_ROWS)):
            keys, parts, cs, ns, places = [], [], [], [], []
            for s in shingle_sets(_strings(some)):
                n = len(s)
                if not n:
                    continue
                c = class_of(s)
                if c in done:  # a copy; those of other tasks are dropped in the lists
                    continue
                if len(done) >= 100_000:
                    done.clear()
                done.add(c)
                if n <= most_light:
                    for t in partner_sizes(n, percent):
                        if 1 <= t <= most_light and (o := least_overlap(n, t, percent)) <= min(n, t):
                            salt = np.uint64(min(n, t) * 64 + max(n, t)) * np.uint64(0xD6E8FEB86659FD93)
                            with np.errstate(over="ignore"):
                                picked = np.array(list(combinations(s, o)), np.uint64)
                                found, more = (np.sum(mix(mix(picked ^ salt) + np.uint64(k)), axis=1, dtype=np.uint64) for k in (0, 1))
                            keys.append(found.view(np.int64))
                            parts.append((more >> np.uint64(33)).astype(np.int32))
                            places.append(np.full(len(found), -1 - t, np.int32))
                            cs.append(np.full(len(found), c)), ns.append(np.full(len(found), n, np.int32))
                if partner_sizes(n, percent)[-1] > most_light:
                    load = counters[(s >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
                    first = np.argsort(load, kind="stable")[: probe_length(n, percent)]
                    split = (load[first].astype(np.int64) - middle + LIST_ROWS - 1) // LIST_ROWS
                    keys.append(s[first].view(np.int64))
                    # 0: the whole list is in one part
                    parts.append(np.where(split > 1, 1 + abs(c) % np.maximum(split, 1), 0).astype(np.int32))
                    places.append(np.zeros(len(first), np.int32))
                    cs.append(np.full(len(first), c)), ns.append(np.full(len(first), n, np.int32))
            if keys:
                yield pd.DataFrame({"key": np.concatenate(keys), "part": np.concatenate(parts), "c": np.concatenate(cs), "n": np.concatenate(ns), "pos": np.concatenate(places)})

    return texts.select("text").mapInPandas(run, "key bigint, part int, c bigint, n int, pos int")


def _in_lists(entries: DataFrame) -> DataFrame:
    """Entries of keys that two classes have or that are dealt to several tasks, once each.

    Rows stream through in order of their key; only the last row of a batch is carried over.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for pdf in batches:
            if held is not None:
                pdf = pd.concat([held, pdf], ignore_index=True)
            key, part, c, pos = (pdf[x].to_numpy() for x in ("key", "part", "c", "pos"))
            same_list = (key[1:] == key[:-1]) & (part[1:] == part[:-1])
            same_row = same_list & (c[1:] == c[:-1]) & (pos[1:] == pos[:-1])
            fresh = np.ones(len(pdf), bool)
            fresh[1:] = ~same_row
            other = np.zeros(len(pdf), bool)  # another class stands beside it
            beside = same_list & (c[1:] != c[:-1])
            other[1:] |= beside
            other[:-1] |= beside
            if held is not None:
                fresh[0], other[0] = not held_told, other[0] or held_other
            # A row's copies stand together: what is found beside the last copy holds for the first.
            runs = np.cumsum(np.concatenate([[True], ~same_row])) - 1
            other = np.bincount(runs, other)[runs] > 0
            part_of_many = (part > 0) & (pos >= 0)
            ready = fresh & (other | part_of_many)
            last_run = runs == runs[-1]
            out = pdf[ready]
            held_told = bool(ready[last_run].any()) or (held is not None and runs[-1] == 0 and held_told)
            held_other = bool(other[-1])
            held = pdf.iloc[-1:]
            if len(out):
                yield out

    ordered = entries.repartition("key", "part").sortWithinPartitions("key", "part", "n", "c", "pos")
    return ordered.mapInPandas(run, "key bigint, part int, c bigint, n int, pos int")


def _light_pairs(lists: DataFrame) -> DataFrame:
    """Pairs of light sets, as a star in each key: every set with the smallest class of the partner's size."""
    rows = lists.filter("pos < 0").withColumn("t", -F.col("pos") - 1)
    stars = rows.groupBy("key", "part").agg(F.min(F.when(F.expr("n < t"), F.col("c"))).alias("small"), F.min(F.when(F.expr("n > t"), F.col("c"))).alias("large"), F.min(F.when(F.expr("n = t"), F.col("c"))).alias("equal"))
    other = F.when(F.expr("n < t"), F.col("large")).when(F.expr("n > t"), F.col("small")).otherwise(F.col("equal"))
    pairs = rows.join(stars, ["key", "part"]).select("c", other.alias("other")).filter("other IS NOT NULL AND c <> other")
    return pairs.select(F.least("c", "other").alias("a"), F.greatest("c", "other").alias("b")).distinct()


def _filter(classes: DataFrame) -> np.ndarray:
    """Bits, eight for each class where the bound allows, gathered in chunks."""
    bits = min(max((8 * classes.count()).bit_length(), FILTER_BITS[0]), FILTER_BITS[1])
    per_chunk = (1 << bits) // CHUNKS

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        found = np.zeros(per_chunk, bool)
        found[pdf["slot"].to_numpy() % per_chunk] = True
        return pd.DataFrame({"chunk": [int(pdf["slot"].iloc[0]) // per_chunk], "bits": [np.packbits(found).tobytes()]})

    slots = classes.select(F.pmod(F.shiftright("c", 1), F.lit(1 << bits)).alias("slot")).distinct()
    out = np.zeros((CHUNKS, per_chunk), bool)
    for r in slots.groupBy(F.floor(F.col("slot") / per_chunk)).applyInPandas(fold, "chunk int, bits binary").collect():
        out[r.chunk] = np.unpackbits(np.frombuffer(r.bits, np.uint8))
    return np.packbits(out.ravel())


def _sets(source: Source, classes: DataFrame) -> DataFrame:
    """c and the shingles, as bytes, of the wanted classes.

    The texts are read where they lie and not shuffled: each task keeps what the filter lets through.
    """
    shared, class_of = source.texts.sparkSession.sparkContext.broadcast(_filter(classes)), source.class_of()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        packed, done = shared.value, set()
        for pdf in batches:
            cs, found = [], []
            for s in shingle_sets(_strings(pdf["text"])):
                if not len(s):
                    continue
                c = class_of(s)
                slot = (c >> 1) % (8 * len(packed))
                if packed[slot >> 3] >> (7 - (slot & 7)) & 1 and c not in done:
                    if len(done) >= 100_000:
                        done.clear()
                    done.add(c)
                    cs.append(c), found.append(s.tobytes())
            yield pd.DataFrame({"c": np.array(cs, np.int64), "shingles": found})

    sets = source.texts.select("text").mapInPandas(run, "c bigint, shingles binary")
    # Copies in several tasks give one set each; the least is taken as any would do.
    return sets.join(classes, "c", "left_semi").dropDuplicates(["c"])


def _may_link(pairs: DataFrame, source: Source, percent: int) -> DataFrame:
    """Pairs (a, b) without those that differ in more bits than a link allows, written."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            differ = np.fromiter(map(least_difference, pdf["x"], pdf["y"]), np.int64, len(pdf))
            both = (pdf["n"] + pdf["m"]).to_numpy()
            yield pdf.loc[(100 + percent) * (both - differ) >= 2 * percent * both, ["a", "b"]]

    pairs = materialise(pairs.select("a", "b"), "candidates")
    classes = pairs.select(F.col("a").alias("c")).union(pairs.select("b")).distinct()
    bits = materialise(_numbered(source).select("c", "n", "bits").join(classes, "c", "left_semi").dropDuplicates(["c"]), "bits")
    x = bits.select(F.col("c").alias("a"), "n", F.col("bits").alias("x"))
    y = bits.select(F.col("c").alias("b"), F.col("n").alias("m"), F.col("bits").alias("y"))
    out = materialise(pairs.join(x, "a").join(y, "b").mapInPandas(run, "a bigint, b bigint"), "pairs")
    discard(pairs, bits)
    return out


def _overlaps(pairs: DataFrame, source: Source, percent: int, rest: bool = False) -> DataFrame:
    """(a, b, n, both, linked) of pairs (a, b), written: size of a's set, of the overlap, and whether they link.

    Without ``rest``, pairs whose bits rule out a link are left out. With it, all are told, and also the first
    shingles of a that are not in b: so many that any set that overlaps with b no more than it needs to link with
    a shares one of them.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            n, found, linked, rests = [], [], [], []
            for x, y in zip(pdf["x"], pdf["y"], strict=True):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                there = y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x
                both = int(np.count_nonzero(there))
                n.append(len(x)), found.append(both), linked.append(100 * both >= percent * (len(x) + len(y) - both))
                if rest:
                    need = -(-percent * len(x) // 100) - both
                    own = x[~there]
                    rests.append(own[: len(own) - max(need, 1) + 1].view(np.int64))
            yield pd.DataFrame({"a": pdf["a"], "b": pdf["b"], "n": np.array(n, np.int64), "both": np.array(found, np.int64), "linked": np.array(linked, bool), **({"rest": rests} if rest else {})})

    pairs = materialise(pairs.select("a", "b"), "pairs") if rest else _may_link(pairs, source, percent)
    classes = materialise(pairs.select(F.col("a").alias("c")).union(pairs.select("b")).distinct(), "classes")
    sets = materialise(_sets(source, classes), "sets")
    x = sets.select(F.col("c").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("c").alias("b"), F.col("shingles").alias("y"))
    found = pairs.join(x, "a").join(y, "b").mapInPandas(run, "a bigint, b bigint, n bigint, both bigint, linked boolean" + ", rest array<bigint>" * rest)
    found = materialise(found, "overlaps")
    discard(pairs, classes, sets)
    return found


def components(links: DataFrame) -> DataFrame:
    """(c, label) of all ends of links (a, b): label is the smallest c in reach.

    Each round every end takes the smallest label among its neighbours, then that one's own label; rounds
    end when nothing changes. Each is written to the shared folder.
    """
    both = materialise(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = materialise(both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("c"), F.least("a", "m").alias("label")), "labels")
    while True:
        seen = both.join(labels.select(F.col("c").alias("b"), "label"), "b").groupBy("a").agg(F.min("label").alias("m"))
        nearer = labels.join(seen, labels["c"] == seen["a"]).select("c", "label", F.least("label", "m").alias("next"))
        jumped = nearer.join(labels.select(F.col("c").alias("next"), F.col("label").alias("far")), "next", "left")
        moved = materialise(jumped.select("c", F.col("label").alias("old"), F.least("next", F.coalesce("far", "next")).alias("label")), "labels")
        discard(labels)
        labels = moved
        if moved.filter("old <> label").isEmpty():
            discard(both)
            return moved.select("c", "label")


def _fits(n: Column, m: Column, percent: int) -> Column:
    return (100 * F.least(n, m) >= percent * F.greatest(n, m))


def _rest(n: Column, percent: int) -> Column:
    """Shingles of a set beyond its first few."""
    return F.ceil(percent * n / 100) - 1


def _least_shared(n: Column, m: Column, percent: int) -> Column:
    """So many of their first few shingles two linked sets have in common.

    Of two sets, take the one whose first few end earlier in the order: what both have up to there is
    among the first few of both, and what they have beyond is not more than the rest of that set.
    """
    need = F.ceil(percent * (n + m) / (100 + percent))
    return F.greatest(F.lit(1), need - F.greatest(_rest(n, percent), _rest(m, percent)))


def _weighed(lists: DataFrame) -> DataFrame:
    """Entries (key, c, n) of lists of two classes or more, written, with the list's size ``rows``, the sum of
    these over the class's entries, ``weight``, and ``long``: how many of its lists are long ones."""
    shared = materialise(lists.groupBy("key").agg(F.min("c").alias("low"), F.max("c").alias("high"), F.count("*").alias("rows")).filter("low <> high").select("key", "rows"), "list-sizes")
    by_class = W.partitionBy("c")
    out = lists.join(shared, "key").withColumns({"weight": F.sum("rows").over(by_class), "long": F.count(F.when(F.col("rows") >= LONG, 1)).over(by_class)})
    out = materialise(out, "lists")
    discard(shared)
    return out


def _hub_pairs(weighed: DataFrame, percent: int) -> DataFrame:
    """Each class with the hub that it meets most: a list's hub is its class of the largest weight.

    A class with few shingles of its own has the most entries in long lists, so of a group of near copies the
    hub is the one that most others link with. A guess, not a search: what it misses is left to the search.
    """
    hubs = weighed.groupBy("key").agg(F.max(F.struct("weight", "c", "n")).alias("hub")).select("key", F.col("hub.c").alias("h"), F.col("hub.n").alias("m"))
    met = weighed.join(hubs, "key").filter((F.col("c") != F.col("h")) & _fits(F.col("n"), F.col("m"), percent))
    met = met.groupBy("c", "h").agg(F.count("*").alias("times"), F.first(_least_shared(F.col("n"), F.col("m"), percent)).alias("least")).filter("4 * times >= least")
    return met.groupBy("c").agg(F.max(F.struct("times", "h")).alias("x")).select(F.least("c", "x.h").alias("a"), F.greatest("c", "x.h").alias("b")).distinct()


def _crossing(weighed: DataFrame, labels: DataFrame) -> DataFrame:
    """Entries of lists that hold two labels or more, with the label that most entries have, written."""
    parts = weighed.join(labels, "c", "left").withColumn("label", F.coalesce("label", "c"))
    by_part = parts.groupBy("key", "label").agg(F.count("*").alias("part_rows"))
    largest = by_part.groupBy("key").agg(F.max(F.struct("part_rows", "label")).alias("x"), F.count("*").alias("parts")).filter("parts > 1").select("key", F.col("x.label").alias("largest"))
    largest = materialise(largest, "largest")
    out = materialise(parts.join(largest, "key"), "crossing")
    discard(largest)
    return out


def _against_hubs(crossing: DataFrame, source: Source, percent: int) -> tuple[DataFrame, DataFrame]:
    """The hubs (key, h) of long lists, and all classes of these lists compared with them."""
    long = crossing.filter(F.col("rows") >= LONG)
    hubs = materialise(long.filter("label = largest").groupBy("key").agg(F.max(F.struct("weight", "c")).alias("hub")).select("key", F.col("hub.c").alias("h")), "hubs")
    pairs = long.join(hubs, "key").filter("c <> h").select(F.col("c").alias("a"), F.col("h").alias("b")).distinct()
    return hubs, _overlaps(pairs, source, percent, rest=True)


def _list_pairs(crossing: DataFrame, hubs: DataFrame | None, compared: DataFrame | None, percent: int, first: bool) -> DataFrame:
    """Pairs (a, b) of two labels that may link, from lists that are not long; of long ones those pairs whose
    overlaps with the list's hub are large enough for a link."""
    columns = ["key", "c", "n", "label", "largest", "long"]
    entries = crossing.select(*columns, F.lit(None).cast("bigint").alias("both"), F.lit(0).alias("fewest"))
    if compared is not None:
        entries = entries.filter(crossing["rows"] < LONG)
        near = crossing.filter(F.col("rows") >= LONG).join(hubs, "key").join(compared.select(F.col("a").alias("c"), F.col("b").alias("h"), "both"), ["c", "h"])
        near = materialise(near.filter(100 * F.col("both") >= percent * F.col("n")).select(*columns, "both"), "near-hubs")
        fewest = materialise(near.groupBy("key").agg(F.min("n").alias("fewest")), "fewest")
        entries = entries.union(near.join(fewest, "key").select(*columns, "both", "fewest"))
    # A class outside the largest part needs a partner of the list's least size or more.
    reach = F.col("both").isNull() | ((100 + percent) * F.col("both") >= percent * (F.col("n") + F.greatest(F.col("fewest"), F.ceil(percent * F.col("n") / 100))))
    left = entries.filter((F.col("label") != F.col("largest")) & reach).select("key", *[F.col(x).alias(f"{x}1") for x in ("c", "n", "label", "both", "long")])
    right = entries.select("key", *[F.col(x).alias(f"{x}2") for x in ("c", "n", "label", "both", "long")], (F.col("label") == F.col("largest")).alias("main"))
    n, m = F.col("n1"), F.col("n2")
    enough = F.col("both1").isNull() | ((100 + percent) * F.least("both1", "both2") >= percent * (n + m))
    # Two entries besides the main label meet twice; one of the meetings counts.
    pairs = left.join(right, "key").filter((F.col("label1") != F.col("label2")) & (F.col("main") | (F.col("c1") < F.col("c2"))) & _fits(n, m, percent) & enough)
    # Their meetings in long lists are not counted; there are as many at most as either has entries there.
    least = _least_shared(n, m, percent) - F.least("long1", "long2") if first else F.lit(1)
    shared = pairs.groupBy(F.least("c1", "c2").alias("a"), F.greatest("c1", "c2").alias("b")).agg(F.count("*").alias("times"), F.first(least).alias("least"))
    return shared.filter("times >= least").select("a", "b")


def _between_labels(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs that components do not join yet."""
    a = labels.select(F.col("c").alias("a"), F.col("label").alias("l"))
    b = labels.select(F.col("c").alias("b"), F.col("label").alias("m"))
    named = pairs.distinct().join(a, "a", "left").join(b, "b", "left")
    return named.filter(F.coalesce("l", "a") != F.coalesce("m", "b")).select("a", "b")


def links(source: Source, percent: int = PERCENT) -> DataFrame:
    """Links (a, b) between classes whose components are those of all links."""
    classes = source.profiles.filter("chunk < 0 AND n > 0").groupBy("d1", "d2").agg(F.min("n").alias("n"))
    sizes = {r.n: r["count"] for r in classes.filter(F.col("n") <= MOST_LIGHT).groupBy("n").count().collect()}
    lists = materialise(_in_lists(_entries(source, _sketch(source.profiles), boundary(sizes, percent), percent)), "lists")
    # n as long numbers from here on, so that products cannot overflow
    weighed = _weighed(lists.filter("pos >= 0").select("key", "c", F.col("n").cast("bigint").alias("n")))
    guessed = _overlaps(_light_pairs(lists).union(_hub_pairs(weighed, percent)).distinct(), source, percent)
    discard(lists)
    found, searched = guessed.filter("linked").select("a", "b"), []
    for depth in range(DEPTH):
        crossing = _crossing(weighed, components(found))
        discard(weighed)
        if depth + 1 == DEPTH or crossing.filter(F.col("rows") >= LONG).isEmpty():
            hubs = compared = None
        else:
            hubs, compared = _against_hubs(crossing, source, percent)
            found = found.union(compared.filter("linked").select("a", "b"))
        searched.append(materialise(_list_pairs(crossing, hubs, compared, percent, depth == 0), "pairs"))
        discard(crossing)
        if compared is None:
            break
        discard(hubs)
        # Beside its hub, a pair meets in what both have and the hub has not.
        rest = compared.select(F.col("a").alias("c"), "n", "b", F.explode("rest").alias("shingle"))
        weighed = _weighed(rest.select(F.xxhash64("b", "shingle").alias("key"), "c", "n").distinct())
    pairs = searched[0]
    for more in searched[1:]:
        pairs = pairs.union(more)
    return found.union(_overlaps(_between_labels(pairs, components(found)), source, percent).filter("linked").select("a", "b"))


def _numbered(source: Source) -> DataFrame:
    """The rows of the documents that have shingles, with their class c."""
    rows = source.profiles.filter("chunk < 0 AND n > 0").withColumn("c", F.col("d1").bitwiseAND(F.lit(-2)))
    if not source.clashes:
        return rows.drop("chunk", "counts")
    told = rows.sparkSession.createDataFrame([(*k, v) for k, v in source.clashes.items()], "d1 bigint, d2 bigint, own bigint")
    return rows.join(told, ["d1", "d2"], "left").withColumn("c", F.coalesce("own", "c")).drop("chunk", "counts", "own")


def _chosen(rows: DataFrame, labels: DataFrame, order: Column) -> DataFrame:
    """(c, chosen): for each class the least ``order`` among the rows of its component."""
    classes = materialise(rows.groupBy("c").agg(F.min(order).alias("first")).join(labels, "c", "left").withColumn("label", F.coalesce("label", "c")), "components")
    # Written, so that the join can split the classes of a large component.
    least = materialise(classes.groupBy("label").agg(F.min("first").alias("chosen")), "chosen")
    return classes.join(least, "label").select("c", "chosen")


def linked_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, digest: Digest = digest) -> DataFrame:
    """Per document: doc_id, n_shingles and component_id, the smallest id that links reach, its own included."""
    source = _source(_texts(docs, id_col, text_col), digest)
    by_class = materialise(_chosen(_numbered(source), components(links(source, percent)), F.struct(F.col("doc_id").isNull(), "doc_id")), "classes")
    some = _numbered(source).join(by_class, "c").select("doc_id", F.col("n").alias("n_shingles"), F.col("chosen.doc_id").alias("component_id"))
    none = source.profiles.filter("chunk < 0 AND n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return some.union(none)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, digest: Digest = digest) -> DataFrame:
    """One row of ``docs`` for each component: of the smallest id, nulls last, then of the least row key.

    Of equal rows one stays; rows without shingles all stay. Columns are those of ``docs``, whatever their names.
    """
    key = ["__k1", "__k2"]
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("__row"), *_row_key(docs))
    source = _source(_texts(docs, id_col, text_col, *_row_key(docs)), digest)
    rows = _numbered(source)
    by_class = _chosen(rows, components(links(source, percent)), F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", *key))
    by_class = materialise(by_class.select("c", *[F.col(f"chosen.{k}").alias(f"chosen{k}") for k in key]), "classes")
    stays = F.col("__k1").eqNullSafe(F.col("chosen__k1")) & F.col("__k2").eqNullSafe(F.col("chosen__k2"))
    # Keys of rows that go, and of chosen rows that are there more than once.
    marked = rows.join(by_class, "c").groupBy(*key).agg(F.bool_and(stays).alias("one"), F.count("*").alias("times")).filter("NOT one OR times > 1")
    marked = materialise(marked.select(*key, "one"), "row-marks")
    out = keyed.join(marked.select(*key), key, "left_anti")
    repeated = marked.filter("one").select(*key)
    if not repeated.isEmpty():
        out = out.unionByName(keyed.join(repeated, key, "left_semi").dropDuplicates(key))
    return out.select(*[F.col("__row")[c].alias(c) for c in docs.columns])
