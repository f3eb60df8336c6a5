"""Benchmark passages in training text, found by suffix arrays over the training words.

Documents are sharded as they lie: each shard of a task's texts becomes one sequence of word codes and gets a
suffix array. Every suffix of a benchmark item is looked up in each array by binary search, which gives the range
of training suffixes that share its first WINDOW words (all its words, if the item is shorter), so all places in
the shard, and by neighbouring places the longest verbatim matches. Words that the benchmark has not have code 0:
no match goes past one, so suffixes end there, and those that begin with one cannot match and are not sorted.

The benchmark is searched in blocks of at most BLOCK_BYTES of text, each of which goes to all tasks; a larger one
takes more passes over the documents. Words meet by 64 hash bits; words of a match are compared with the
benchmark's by bytes.

A null or empty text, or one without words, has no words and no matches; so has an item. Equal items are told
apart by their ids; repeated ids of items are one item, null ids are the id of an empty name. Each row of the
documents stands alone, whatever its id; other columns are not read, whatever their names. An empty benchmark
matches nothing, an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strataline.llm.shingles import blocks, word_runs
from strataline.session import materialise

WINDOW = 10
#: Benchmark text that goes to all tasks at once; in tasks it takes some ten times as much.
BLOCK_BYTES = 4 << 20
#: Words of a shard, more or less: it ends with a block of texts, and with a batch.
SHARD_WORDS = 1 << 20

_BLANK = np.ones(256, bool)
_BLANK[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False


def _lowered(texts: list[str | None]) -> tuple[bytes, np.ndarray]:
    """The texts in bytes, A-Z lower-cased, each with a blank after it, and where each begins, and the end."""
    coded = [(t or "").encode("utf-8", "replace") + b" " for t in texts]
    return b"".join(coded).lower(), np.cumsum([0, *map(len, coded)])


@dataclass
class Items:
    """A block of the benchmark: distinct windows as rows of word codes (0 beyond a short one), and where they are."""

    names: list[str]
    vocabulary: np.ndarray  # hashes of words, ascending; the code of the n-th is n + 1
    spellings: list[bytes]  # by code
    windows: np.ndarray  # distinct, ascending
    lengths: np.ndarray
    first: np.ndarray  # where each window's places begin, and the end
    items: np.ndarray  # of the windows' places, window by window
    offsets: np.ndarray  # word of the item at which the place is


def items_of(rows: list[tuple[str | None, str | None]], window: int = WINDOW) -> Items:
    """Rows of (id, text); ids ascend by bytes in what is made."""
    names = sorted({n or "" for n, _ in rows}, key=lambda n: n.encode("utf-8"))
    order = {n: k for k, n in enumerate(names)}
    raw, begin = _lowered([t for _, t in rows])
    with np.errstate(over="ignore"):
        starts, ends, hashes = word_runs(np.frombuffer(raw, np.uint8), _BLANK)
    vocabulary, at, codes = np.unique(hashes, return_index=True, return_inverse=True)
    codes = codes.astype(np.int32) + 1
    spellings = [b"", *[raw[a:b] for a, b in zip(starts[at].tolist(), ends[at].tolist(), strict=True)]]
    bounds = np.searchsorted(starts, begin)
    grids, owners = [np.zeros((0, window), np.int32)], [np.zeros((0, 2), np.int64)]
    for (name, _), a, b in zip(rows, bounds[:-1], bounds[1:], strict=True):
        if b > a:
            padded = np.zeros(max(window, b - a), np.int32)
            padded[: b - a] = codes[a:b]
            grids.append(np.lib.stride_tricks.sliding_window_view(padded, window))
            owners.append(np.stack([np.full(len(grids[-1]), order[name or ""]), np.arange(len(grids[-1]))], axis=1))
    windows, which = np.unique(np.concatenate(grids), axis=0, return_inverse=True)
    places = np.unique(np.column_stack([which.reshape(-1), np.concatenate(owners)]), axis=0)
    first = np.searchsorted(places[:, 0], np.arange(len(windows) + 1))
    return Items(names, vocabulary, spellings, windows, np.count_nonzero(windows, axis=1), first, places[:, 1], places[:, 2])


class Shard:
    """The suffix array of a sequence of word codes, sorted as far as ``depth`` words; 0 ends a suffix."""

    def __init__(self, codes: np.ndarray, most: int, depth: int = WINDOW) -> None:
        self.bits = max(1, int(most).bit_length())
        self.together = min(depth, max(1, 63 // self.bits))  # words in one key
        self.steps = -(-depth // self.together)
        codes = np.concatenate([codes, np.zeros(self.together * (self.steps + 1), codes.dtype)])
        self.key = np.zeros(len(codes) - self.together + 1, np.int64)
        going = np.ones(len(self.key), bool)
        for k in range(self.together):
            here = codes[k : k + len(self.key)].astype(np.int64)
            going &= here != 0
            self.key += np.where(going, here, 0) << (self.bits * (self.together - 1 - k))
        # Each suffix by its first key; those that share it by the keys after it.
        places = np.flatnonzero(self.key)
        self.array = places[np.argsort(self.key[places])]
        ranks = self.key[self.array]
        same = ranks[1:] == ranks[:-1]
        tied = np.flatnonzero(np.append(same, False) | np.append(False, same)) if len(ranks) else ranks
        if len(tied) and self.steps > 1:
            some = self.array[tied]
            later = [self.after(some, k) for k in range(self.steps - 1, 0, -1)]
            self.array[tied] = some[np.lexsort([*later, ranks[tied]])]

    def after(self, places: np.ndarray, step: int) -> np.ndarray:
        """The keys ``step`` keys on, 0 where the suffix ends before."""
        out, going = np.zeros(len(places), np.int64), np.ones(len(places), bool)
        for k in range(step):
            going &= (self.key[places + k * self.together] & ((1 << self.bits) - 1)) != 0
        out[going] = self.key[places[going] + step * self.together]
        return out

    def ranges(self, windows: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each window the range of the array whose suffixes begin with it, by binary search key after key."""
        low, high = np.zeros(len(windows), np.int64), np.full(len(windows), len(self.array), np.int64)
        for step in range(self.steps):
            least, most = np.zeros(len(windows), np.int64), np.zeros(len(windows), np.int64)
            for k in range(self.together):
                n, shift = step * self.together + k, self.bits * (self.together - 1 - k)
                inside = n < lengths
                word = windows[:, n].astype(np.int64) if n < windows.shape[1] else 0
                least += np.where(inside, word, 0) << shift
                most += np.where(inside, word, (1 << self.bits) - 1) << shift
            going = np.flatnonzero((high > low) & (step * self.together < lengths))
            a, b = low[going], high[going]
            low[going] = self._bound(a, b, least[going], step, np.less)
            high[going] = self._bound(a, b, most[going], step, np.less_equal)
        return low, high

    def _bound(self, low: np.ndarray, high: np.ndarray, wanted: np.ndarray, step: int, passes) -> np.ndarray:
        """The first place of each range whose key does not pass before the one wanted."""
        low, high = low.copy(), high.copy()
        while len(going := np.flatnonzero(low < high)):
            mid = (low[going] + high[going]) // 2
            right = passes(self.after(self.array[mid], step), wanted[going])
            low[going[right]] = mid[right] + 1
            high[going[~right]] = mid[~right]
        return low


def spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(range, place) for each place of each range."""
    sizes = high - low
    which = np.repeat(np.arange(len(low)), sizes)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[which]


def occurrences(texts: list[str | None], items: Items) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For each text in order its number of words, and the first word and the window of all occurrences in it."""
    some: list[list[int]] = []
    size = 0
    for block in blocks(texts):
        some.append(block)
        size += sum(len(texts[i] or "") for i in block) // 6
        if size >= SHARD_WORDS:
            yield from _searched(texts, some, items)
            some, size = [], 0
    if some:
        yield from _searched(texts, some, items)


def _searched(texts: list[str | None], some: list[list[int]], items: Items) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    raws, word_at, coded, counts = [], [], [], []
    base = 0
    for block in some:
        raw, begin = _lowered([texts[i] for i in block])
        with np.errstate(over="ignore"):
            starts, ends, hashes = word_runs(np.frombuffer(raw, np.uint8), _BLANK)
        at = np.searchsorted(items.vocabulary, hashes)
        at[at == len(items.vocabulary)] = 0
        known = items.vocabulary[at] == hashes if len(items.vocabulary) else np.zeros(len(hashes), bool)
        coded.append(np.where(known, at + 1, 0).astype(np.int32))
        word_at.append(np.column_stack([starts, ends]) + base)
        counts.append(np.diff(np.searchsorted(starts, begin)))
        raws.append(raw)
        base += len(raw)
    counts, codes, word_at, raw = np.concatenate(counts), np.concatenate(coded), np.concatenate(word_at), b"".join(raws)
    # A code 0 after each text, so that no match goes from one into the next.
    begin = np.concatenate([[0], np.cumsum(counts + 1)])
    slots = np.arange(len(codes)) + np.repeat(np.arange(len(counts)), counts)
    while True:
        sequence = np.zeros(begin[-1], np.int32)
        sequence[slots] = codes
        shard = Shard(sequence, len(items.vocabulary), items.windows.shape[1])
        window, place = spread(*shard.ranges(items.windows, items.lengths))
        place = shard.array[place]
        # Words that only share a hash with the benchmark's match nothing.
        change = np.zeros(len(sequence) + 1, np.int64)
        np.add.at(change, place, 1)
        np.add.at(change, place + items.lengths[window], -1)
        hit = np.flatnonzero(np.cumsum(change)[:-1][slots])
        false = [n for n in hit.tolist() if raw[word_at[n, 0] : word_at[n, 1]] != items.spellings[codes[n]]]
        if not false:
            break
        codes[false] = 0
    order = np.argsort(place, kind="stable")
    window, place = window[order], place[order]
    cuts = np.searchsorted(place, begin)
    for k, n in enumerate(counts.tolist()):
        yield n, place[cuts[k] : cuts[k + 1]] - begin[k], window[cuts[k] : cuts[k + 1]]


def runs(first: np.ndarray, lengths: np.ndarray) -> list[tuple[int, int]]:
    """The words covered by runs that begin in ascending order, as maximal (begin, end)."""
    out: list[tuple[int, int]] = []
    for a, n in zip(first.tolist(), lengths.tolist(), strict=True):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], a + n))
        else:
            out.append((a, a + n))
    return out


def longest(first: np.ndarray, window: np.ndarray, items: Items) -> list[tuple[str, int, int, int]]:
    """The maximal verbatim matches of a text: (item, first word of the item, first word of the text, words)."""
    which, at = spread(items.first[window], items.first[window + 1])
    found = np.column_stack([items.items[at], first[which] - items.offsets[at], first[which], items.lengths[window[which]]])
    found = found[np.lexsort([found[:, 2], found[:, 1], found[:, 0]])]
    new = np.ones(len(found), bool)
    new[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1) | (found[1:, 2] != found[:-1, 2] + 1)
    begin = np.flatnonzero(new)
    last = np.append(begin[1:], len(found)) - 1
    return [(items.names[i], int(a - d), int(a), int(b + n - a)) for (i, d, a, _), (b, n) in zip(found[begin], found[last][:, 2:], strict=True)] if len(found) else []


_SPAN = T.StructType([T.StructField("begin", T.LongType()), T.StructField("end", T.LongType())])
_FOUND = [T.StructField("n_words", T.LongType()), T.StructField("spans", T.ArrayType(_SPAN)), T.StructField("items", T.ArrayType(T.StringType()))]
_MATCH = [T.StructField("item_id", T.StringType()), T.StructField("item_word", T.LongType()), T.StructField("word", T.LongType()), T.StructField("n_words", T.LongType())]


def benchmark_blocks(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text", most: int = BLOCK_BYTES) -> Iterator[Items]:
    """The distinct items in blocks of about ``most`` bytes of text, one after the other."""
    rows = benchmark.select(benchmark[id_col].cast("string").alias("id"), benchmark[text_col].alias("text")).filter(F.length("text") > 0).distinct()
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    many = -(-size // most)
    for k in range(many):
        part = rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(many)) == k) if many > 1 else rows
        yield items_of(sorted(((r.id, r.text) for r in part.collect()), key=repr))


def _one_pass(keyed: DataFrame, items: Items, last: bool) -> DataFrame:
    """``keyed`` (key, text and what earlier passes found) with what this block of items adds."""
    told = keyed.sparkSession.sparkContext.broadcast(items)
    fields = [keyed.schema["key"], *([] if last else [keyed.schema["text"]]), *_FOUND]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = told.value
        for batch in batches:
            earlier = {c: batch.column(c).to_pylist() for c in ("spans", "items") if c in batch.schema.names}
            n_words, spans, names = [], [], []
            for k, (n, first, window) in enumerate(occurrences(batch.column("text").to_pylist(), items)):
                own, of = runs(first, items.lengths[window]), set()
                if len(window):
                    which = np.unique(window)
                    of = {items.names[i] for i in np.unique(items.items[spread(items.first[which], items.first[which + 1])[1]]).tolist()}
                if earlier:
                    both = np.array(sorted([(s["begin"], s["end"]) for s in earlier["spans"][k]] + own), np.int64).reshape(-1, 2)
                    own, of = runs(both[:, 0], both[:, 1] - both[:, 0]), of | set(earlier["items"][k])
                n_words.append(n)
                spans.append([{"begin": a, "end": b} for a, b in own])
                names.append(sorted(of, key=lambda x: x.encode("utf-8")))
            span = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
            found = [pa.array(n_words, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(names, pa.list_(pa.string()))]
            kept = [batch.column(f.name) for f in fields[: -len(_FOUND)]]
            yield pa.RecordBatch.from_arrays([*kept, *found], [f.name for f in fields])

    return keyed.mapInArrow(run, T.StructType(fields))


def found_in(keyed: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``keyed`` (key, of any type, and text): key, n_words, spans of hit words, items with occurring windows."""
    parts = list(benchmark_blocks(benchmark)) or [items_of([])]
    for k, items in enumerate(parts):
        keyed = _one_pass(keyed, items, k + 1 == len(parts))
    return keyed


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The longest verbatim matches and where they are: doc_id, item_id, item_word, word, n_words.

    Words count from 0; a match is of WINDOW words at least, or of a whole shorter item.
    """
    slim = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    fields = [slim.schema["doc_id"], *_MATCH]
    out = None
    for items in benchmark_blocks(benchmark):
        told = slim.sparkSession.sparkContext.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], told=told) -> Iterator[pa.RecordBatch]:
            items = told.value
            for batch in batches:
                rows, found = [], []
                for k, (_, first, window) in enumerate(occurrences(batch.column("text").to_pylist(), items)):
                    own = longest(first, window, items)
                    rows += [k] * len(own)
                    found += own
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
                columns = [pa.array([m[c] for m in found], kind) for c, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(rows, pa.int64())), *columns], [f.name for f in fields])

        part = slim.mapInArrow(run, T.StructType(fields))
        out = part if out is None else out.unionAll(part)
    return slim.sparkSession.createDataFrame([], T.StructType(fields)) if out is None else out


def decontaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` without any hit word; columns are those of ``docs``."""
    keyed = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("key"), docs[text_col].alias("text"))
    return found_in(keyed, benchmark).filter(F.size("spans") == 0).select("key.*")


def report(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    keyed = docs.select(docs[id_col].alias("key"), docs[text_col].alias("text"))
    found = materialise(found_in(keyed, benchmark), "benchmark-hits")
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["begin"])
    digest = F.sha2(F.array_join("items", ",").cast("binary"), 256)
    return found.select(F.col("key").alias("doc_id"), "n_words", n_hit.alias("n_hit"), F.size("items").cast("bigint").alias("n_items"), digest.alias("items_sha256"), (n_hit > 0).alias("contaminated"))
