"""Exact removal of byte strings that start more than once, by hash-compared suffix sorts.

Every byte covered by a WINDOW-byte string that also starts anywhere else, in the same text or another, goes.

1. Each window of a text belongs to one anchor: the leftmost of its K-byte strings with the least hash.
   Equal windows have equal anchors at equal offsets, so only texts around equal anchors need comparing.
   The windows of one anchor are neighbours; the bytes they cover are the anchor's context.
2. Anchors are counted. What is under an anchor that occurs once is unique. Contexts of one hash that occur
   twice or more, whole, are repeated, whole: each is compared byte by byte with the first of them, in runs of
   contexts that two texts share. Where one differs, all contexts of its anchor are left to the next step.
3. The other contexts of an anchor are brought together, a bounded number at a time, and the suffixes at
   their window starts are sorted: a merge sort whose comparisons find the common extension of two
   suffixes by binary search over prefix polynomial hashes. Neighbours in the order that agree over a
   window are verified byte by byte.
4. Anchors with more contexts than fit are sorted in several parts. Their distinct windows then meet once
   more, by 128 hash bits, each reduced to a count.

Texts are read whole as UTF-8; a null text is empty. Rows of one id and one text count as two texts: each
repeats the other, whole. Null ids are allowed. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strataline.llm.shingles import blocks, mix, powers
from strataline.session import discard, materialise

WINDOW = 200
K = 64
#: Contexts of one anchor that are sorted together.
MOST_CONTEXTS = 4096
#: Bytes of contexts sorted in one go; a larger single part is still bounded by MOST_CONTEXTS.
BATCH_BYTES = 1 << 19
#: Texts that are compared with one copy of a first text; more get further copies.
FOLLOWERS = 256

_BYTES = [np.random.default_rng(s).integers(1, 1 << 63, 256, dtype=np.uint64) for s in (21, 22)]


class Prefixes:
    """Prefix polynomial hashes of a buffer, for the hash of any of its substrings."""

    def __init__(self, data: np.ndarray, seed: int = 0) -> None:
        up, self.down = powers(len(data))
        self.total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTES[seed][data] * up[: len(data)], out=self.total[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self.total[ends] - self.total[starts]) * self.down[starts]


def extension(p: Prefixes, i: np.ndarray, j: np.ndarray, most: int) -> np.ndarray:
    """Length of the common prefix of the suffixes at i and j, up to ``most``, by binary search."""
    low, high = np.zeros(len(i), np.int64), np.full(len(i), most, np.int64)
    while True:
        open_ = low < high
        if not open_.any():
            return low
        middle = (low + high + 1) >> 1
        same = p.of(i, i + middle) == p.of(j, j + middle)
        low = np.where(same, middle, low)
        high = np.where(same, high, middle - 1)


def suffix_order(data: np.ndarray, p: Prefixes, starts: np.ndarray, segment: np.ndarray, most: int) -> np.ndarray:
    """Order of the suffixes at ``starts`` by segment, then by their first ``most`` bytes; stable.

    A merge sort of all segments at once. When two sorted runs meet, each element's rank in the other run
    is found by binary search; a comparison looks for the common extension and then at one byte.
    """
    order = np.argsort(segment, kind="stable")
    seg = segment[order]
    first = np.flatnonzero(np.concatenate([[True], seg[1:] != seg[:-1]])) if len(seg) else np.zeros(0, np.int64)
    size = np.diff(np.append(first, len(seg)))
    base, count = np.repeat(first, size), np.repeat(size, size)
    at = np.arange(len(seg)) - base
    padded = np.append(data, np.uint8(0))
    width = 1
    largest = int(size.max()) if len(size) else 0
    while width < largest:
        here = np.flatnonzero(count > (at // (2 * width)) * 2 * width + width)  # runs that have another to meet
        a, n, b = at[here], count[here], base[here]
        run = a // width
        left = run % 2 == 0
        other_low = np.where(left, (run + 1) * width, (run - 1) * width)
        other_high = np.minimum(other_low + width, n)
        low, high = other_low.copy(), other_high.copy()
        mine = starts[order[b + a]]
        while True:
            todo = np.flatnonzero(low < high)
            if not len(todo):
                break
            middle = (low[todo] + high[todo]) >> 1
            i, j = mine[todo], starts[order[b[todo] + middle]]
            ext = extension(p, i, j, most)
            x, y = padded[i + ext].astype(np.int16), padded[j + ext].astype(np.int16)
            equal = ext >= most
            # A left element goes before equals of the right run, a right one behind equals of the left run.
            after = np.where(equal, ~left[todo], x > y)
            low[todo] = np.where(after, middle + 1, low[todo])
            high[todo] = np.where(after, high[todo], middle)
        moved = (run // 2) * 2 * width + (a - run * width) + (low - other_low)
        merged = order.copy()
        merged[b + moved] = order[b + a]
        order = merged
        width *= 2
    return order


def repeated_windows(contexts: list[bytes], groups: np.ndarray, offsets: np.ndarray, owned: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(context, start, is repeated) of all windows, for contexts grouped by anchor.

    ``offsets``: where the anchor lies in its context; ``owned``: how many windows it has. Windows can only
    be equal in one group and at one distance from the anchor.
    """
    data = np.frombuffer(b"".join(contexts), np.uint8)
    begin = np.cumsum([0, *map(len, contexts)])[:-1]
    which = np.repeat(np.arange(len(contexts)), owned)
    start = np.arange(len(which)) - np.repeat(np.cumsum(owned) - owned, owned)
    distance = offsets[which] - start
    starts = begin[which] + start
    p = Prefixes(data)
    segment = groups[which].astype(np.int64) * WINDOW + distance
    order = suffix_order(data, p, starts, segment, WINDOW)
    s = starts[order]
    alike = np.flatnonzero((segment[order][1:] == segment[order][:-1]) & (p.of(s[1:], s[1:] + WINDOW) == p.of(s[:-1], s[:-1] + WINDOW))) if len(s) > 1 else np.zeros(0, np.int64)
    # What the hashes say is verified, in blocks of bounded size.
    sure = np.ones(len(alike), bool)
    for k in range(0, len(alike), 4096):
        pair = alike[k : k + 4096]
        span = np.arange(WINDOW)
        sure[k : k + 4096] = (data[s[pair][:, None] + span] == data[s[pair + 1][:, None] + span]).all(axis=1)
    repeated = np.zeros(len(which), bool)
    repeated[order[alike[sure]]] = True
    repeated[order[alike[sure] + 1]] = True
    return which, start, repeated


def anchor_runs(coded: list[bytes]) -> tuple[np.ndarray, ...]:
    """For texts in a row: text, first and last window, anchor place, hash of anchor and of context."""
    data = np.frombuffer(b"".join(coded), np.uint8)
    bounds = np.cumsum([0, *map(len, coded)])
    n_windows = len(data) - WINDOW + 1
    if n_windows <= 0:
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, np.uint64),) * 2
    p = Prefixes(data)
    spots = np.arange(len(data) - K + 1)
    grams = mix(p.of(spots, spots + K))
    span = WINDOW - K + 1
    key = (grams >> np.uint64(32) << np.uint64(32)) | spots.astype(np.uint64)
    rows = -(-len(key) // span)
    table = np.full(rows * span, np.iinfo(np.uint64).max)
    table[: len(key)] = key
    table = table.reshape(rows, span)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    w = np.arange(n_windows)
    anchor = (np.minimum(behind[w], ahead[w + span - 1]) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    whole = np.zeros(n_windows + 1, np.int8)  # windows that lie in one text
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        if b - a >= WINDOW:
            whole[a : b - WINDOW + 1] = 1
    text = np.searchsorted(bounds, w, side="right") - 1
    new = np.ones(n_windows, bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | (whole[1:-1] != whole[:-2])
    low = np.flatnonzero(new)
    high = np.append(low[1:], n_windows) - 1
    good = whole[low] == 1
    low, high = low[good], high[good]
    spot, t = anchor[low], text[low]
    context = mix(p.of(low, high + WINDOW) + (spot - low).astype(np.uint64) * np.uint64(1 << 20) + (high - low).astype(np.uint64))
    return t, low - bounds[t], high - bounds[t], spot - bounds[t], grams[spot], context


def _utf8(x: object) -> bytes:
    return x.encode("utf-8", "replace") if isinstance(x, str) else b""


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id and text with a key that is never null; rows of one key are equal."""
    slim = docs.select(docs[id_col].alias("doc_id"), docs[text_col].alias("text"))
    return slim.select(F.xxhash64(F.lit(0), "doc_id", "text").alias("k1"), F.xxhash64(F.lit(1), "doc_id", "text").alias("k2"), "doc_id", "text")


def _anchors(keyed: DataFrame, context_bits: int) -> DataFrame:
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        with np.errstate(over="ignore"):
            for pdf in batches:
                k1, k2, texts = pdf["k1"].to_numpy(), pdf["k2"].to_numpy(), pdf["text"].tolist()
                for some in blocks([x if isinstance(x, str) else None for x in texts]):
                    t, low, high, spot, gram, context = anchor_runs([_utf8(texts[i]) for i in some])
                    rows = np.array(some)[t]
                    context = context & np.uint64((1 << context_bits) - 1)
                    yield pd.DataFrame({"anchor": gram.view(np.int64), "context": context.view(np.int64), "k1": k1[rows], "k2": k2[rows], "low": low.astype(np.int32), "high": high.astype(np.int32), "spot": spot.astype(np.int32)})

    return keyed.select("k1", "k2", "text").mapInPandas(run, "anchor bigint, context bigint, k1 bigint, k2 bigint, low int, high int, spot int")


def _sorted_parts(contexts: DataFrame) -> DataFrame:
    """Repeated windows of lone contexts, as runs of starts, and the distinct windows of anchors in parts."""
    schema = "k1 bigint, k2 bigint, first int, last int, h1 bigint, h2 bigint, weight int"

    def solve(pdf: pd.DataFrame) -> Iterator[pd.DataFrame]:
        texts = [bytes(x) for x in pdf["bytes"]]
        pair = pdf["anchor"].to_numpy(), pdf["part"].to_numpy()
        groups = np.cumsum(np.concatenate([[False], (pair[0][1:] != pair[0][:-1]) | (pair[1][1:] != pair[1][:-1])]))
        low = pdf["low"].to_numpy()
        which, start, repeated = repeated_windows(texts, groups, pdf["spot"].to_numpy() - low, (pdf["high"].to_numpy() - low + 1))
        lone = pdf["times"].to_numpy()[which] == 1
        k1, k2 = pdf["k1"].to_numpy(), pdf["k2"].to_numpy()
        hit = repeated & lone
        at = np.flatnonzero(hit & ~np.concatenate([[False], hit[:-1] & (which[1:] == which[:-1])]))
        end = np.flatnonzero(hit & ~np.concatenate([hit[1:] & (which[1:] == which[:-1]), [False]]))
        c = which[at]
        yield pd.DataFrame({"k1": k1[c], "k2": k2[c], "first": low[c] + start[at], "last": low[c] + start[end], "h1": 0, "h2": 0, "weight": 0})
        split = pdf["parts"].to_numpy()[which] > 1
        if split.any():
            data = np.frombuffer(b"".join(texts), np.uint8)
            s = (np.cumsum([0, *map(len, texts)])[:-1][which] + start)[split]
            h = [mix(Prefixes(data, seed).of(s, s + WINDOW)).view(np.int64) for seed in (0, 1)]
            c = which[split]
            out = pd.DataFrame({"k1": k1[c], "k2": k2[c], "first": low[c] + start[split], "last": low[c] + start[split], "h1": h[0], "h2": h[1], "weight": np.where(repeated[split] | ~lone[split], 2, 1)})
            yield out.drop_duplicates(["h1", "h2", "k1", "k2", "first"])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        with np.errstate(over="ignore"):
            for pdf in batches:
                size += int(pdf["bytes"].map(len).sum())
                held.append(pdf)
                if size >= BATCH_BYTES:
                    whole = pd.concat(held, ignore_index=True)
                    # The last anchor may go on in the next batch.
                    ends = (whole["anchor"] == whole["anchor"].iloc[-1]) & (whole["part"] == whole["part"].iloc[-1])
                    done, rest = whole[~ends].reset_index(drop=True), whole[ends].reset_index(drop=True)
                    if len(done):
                        yield from solve(done)
                    held, size = [rest], int(rest["bytes"].map(len).sum()) if len(done) else 0
            if held and len(whole := pd.concat(held, ignore_index=True)):
                yield from solve(whole)

    ordered = contexts.repartition("anchor", "part").sortWithinPartitions("anchor", "part")
    return ordered.mapInPandas(run, schema)


def shared_runs(cuts: list) -> list[tuple[int, int, int, list[int]]]:
    """(begin, end, begin in the first text, anchors) of cuts (low, high, its low in the first text, anchor)."""
    out: list[tuple[int, int, int, list[int]]] = []
    for low, high, there, anchor in sorted(cuts, key=lambda c: (c[0] - c[2], c[0])):
        if out and low - there == out[-1][0] - out[-1][2] and low <= out[-1][1]:
            begin, end, first, anchors = out[-1]
            anchors.append(anchor)
            out[-1] = begin, max(end, high + WINDOW), first, anchors
        else:
            out.append((low, high + WINDOW, there, [anchor]))
    return out


def _clashing(keyed: DataFrame, members: DataFrame) -> DataFrame:
    """Anchors with a context whose bytes are not those of the first context of its hash, written."""
    follow = members.filter("NOT (k1 = r1 AND k2 = r2 AND low = there)")
    by_first = follow.groupBy("k1", "k2", "r1", "r2").agg(F.collect_list(F.struct("low", "high", "there", "anchor")).alias("cuts"))
    by_first = materialise(by_first, "copies")
    firsts = materialise(by_first.groupBy("r1", "r2").agg(F.ceil(F.count("*") / FOLLOWERS).cast("int").alias("copies")), "firsts")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for text, r1, r2, copy, cuts in zip(pdf["text"], pdf["r1"], pdf["r2"], pdf["copy"], pdf["cuts"], strict=True):
                raw = _utf8(text)
                runs = shared_runs([(c["low"], c["high"], c["there"], c["anchor"]) for c in cuts])
                rows.append((r1, r2, copy, [{"there": there, "bytes": raw[a:b], "anchors": anchors} for a, b, there, anchors in runs]))
            yield pd.DataFrame(rows, columns=["r1", "r2", "copy", "runs"])

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            bad: set[int] = set()
            for first, runs in zip(pdf["first"], pdf["runs"], strict=True):
                raw = _utf8(first)
                for r in runs:
                    if raw[r["there"] : r["there"] + len(r["bytes"])] != r["bytes"]:
                        bad.update(int(x) for x in r["anchors"])
            yield pd.DataFrame({"anchor": np.array(sorted(bad), np.int64)})

    # The texts that follow one first text are dealt to as many copies of it as they need.
    dealt = by_first.join(firsts, ["r1", "r2"]).withColumn("copy", F.pmod(F.xxhash64("k1", "k2"), "copies").cast("int"))
    runs = keyed.select("k1", "k2", "text").join(dealt, ["k1", "k2"]).mapInPandas(cut, "r1 bigint, r2 bigint, copy int, runs array<struct<there:int,bytes:binary,anchors:array<bigint>>>")
    texts = keyed.select(F.col("k1").alias("r1"), F.col("k2").alias("r2"), F.col("text").alias("first")).join(firsts, ["r1", "r2"])
    texts = texts.select("r1", "r2", "first", F.explode(F.expr("sequence(0, copies - 1)")).alias("copy"))
    bad = runs.join(texts, ["r1", "r2", "copy"]).select("first", "runs").mapInPandas(compare, "anchor bigint").distinct()
    bad = materialise(bad, "clashing")
    discard(by_first, firsts)
    return bad


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", context_bits: int = 64) -> DataFrame:
    """Per text with repeated bytes: k1, k2 (its key) and runs, an array of (begin, end) that may overlap.

    ``context_bits``: how many bits the hashes of contexts have; fewer cost time and change no result.
    """
    keyed = _keyed(docs, id_col, text_col)
    # Equal rows repeat each other whole. They are counted before anything is gathered; one speaks for them all.
    equal = keyed.groupBy("k1", "k2").agg(F.count("*").alias("n"), F.max(F.octet_length("text")).alias("end")).filter("n > 1")
    equal = materialise(equal.select("k1", "k2", "end"), "equal-rows")
    speakers = [] if equal.isEmpty() else [materialise(keyed.join(equal, ["k1", "k2"], "left_semi").groupBy("k1", "k2").agg(F.first("text").alias("text")), "of-equal-rows")]
    for one in speakers:
        keyed = keyed.join(equal, ["k1", "k2"], "left_anti").select("k1", "k2", "text").unionByName(one)
    found = _anchors(keyed, context_bits)
    counts = found.groupBy("anchor").agg(F.count("*").alias("n")).filter("n > 1").select("anchor")
    # Written, so that the join reads two shuffles and a frequent anchor's rows can be split among tasks.
    counts = materialise(counts, "anchor-counts")
    several = materialise(found.join(counts, "anchor"), "anchors")
    discard(counts)
    place = F.struct("k1", "k2", "low", "high", "spot")
    kinds = materialise(several.groupBy("anchor", "context").agg(F.count("*").alias("times"), F.min(place).alias("x")), "contexts")
    firsts = kinds.filter("times > 1").select("anchor", "context", F.col("x.k1").alias("r1"), F.col("x.k2").alias("r2"), F.col("x.low").alias("there"))
    members = materialise(several.join(firsts, ["anchor", "context"]).drop("context", "spot"), "members")
    bad = _clashing(keyed, members)
    whole, lone = members, kinds
    if not bad.isEmpty():
        whole = members.join(bad, "anchor", "left_anti")
        alone = several.join(bad, "anchor", "left_semi").select("anchor", "context", F.lit(1).cast("bigint").alias("times"), place.alias("x"))
        lone = kinds.join(bad, "anchor", "left_anti").union(alone)
    # An anchor with one context, or whose contexts all occur twice, has nothing left to compare.
    parts = lone.groupBy("anchor").agg(F.count("*").alias("n"), F.min("times").alias("least")).filter("n > 1 AND least = 1").select("anchor", F.ceil(F.col("n") / MOST_CONTEXTS).alias("parts"))
    parts = materialise(parts, "anchor-parts")
    wanted = lone.join(parts, "anchor").select("anchor", F.pmod(F.xxhash64("x"), F.col("parts")).cast("int").alias("part"), "parts", F.least("times", F.lit(2)).alias("times"), "x.*")
    by_text = wanted.groupBy("k1", "k2").agg(F.collect_list(F.struct("anchor", "part", "parts", "times", "low", "high", "spot")).alias("cuts"))

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for k1, k2, text, cuts in zip(pdf["k1"], pdf["k2"], pdf["text"], pdf["cuts"], strict=True):
                raw = _utf8(text)
                rows += [(c["anchor"], c["part"], c["parts"], c["times"], k1, k2, c["low"], c["high"], c["spot"], raw[c["low"] : c["high"] + WINDOW]) for c in cuts]
            yield pd.DataFrame(rows, columns=["anchor", "part", "parts", "times", "k1", "k2", "low", "high", "spot", "bytes"])

    schema = "anchor bigint, part int, parts bigint, times bigint, k1 bigint, k2 bigint, low int, high int, spot int, bytes binary"
    one = keyed.select("k1", "k2", "text").join(by_text, ["k1", "k2"]).mapInPandas(cut, schema)
    solved = materialise(_sorted_parts(one), "windows")
    alone = solved.filter("weight = 0").select("k1", "k2", F.col("first").alias("begin"), (F.col("last") + WINDOW).alias("end"))
    meeting = solved.filter("weight > 0")
    again = meeting.groupBy("h1", "h2").agg(F.sum("weight").alias("w")).filter("w > 1").select("h1", "h2")
    across = meeting.join(again, ["h1", "h2"]).select("k1", "k2", F.col("first").alias("begin"), (F.col("last") + WINDOW).alias("end"))
    repeated = whole.select("k1", "k2", F.col("low").alias("begin"), (F.col("high") + WINDOW).alias("end"))
    copies = equal.filter(F.col("end") >= WINDOW).select("k1", "k2", F.lit(0).alias("begin"), "end")
    spans = repeated.union(alone).union(across).union(copies)
    out = materialise(spans.groupBy("k1", "k2").agg(F.collect_list(F.struct("begin", "end")).alias("runs")), "runs")
    discard(equal, *speakers, several, kinds, members, bad, parts, solved)
    return out


def merged(runs: object) -> list[tuple[int, int]]:
    """Sorted, disjoint runs; runs that touch are one."""
    out: list[list[int]] = []
    for begin, end in sorted((r["begin"], r["end"]) for r in (runs if runs is not None else ())):
        if out and begin <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([begin, end])
    return [(a, b) for a, b in out]


def _applied(docs: DataFrame, id_col: str, text_col: str, of: Callable, fields: dict[str, tuple[str, pa.DataType]], context_bits: int = 64) -> DataFrame:
    """doc_id of any type, passed on as it is, and ``fields`` of (bytes, spans that go, bytes that stay)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text, runs in zip(batch.column("text").to_pylist(), batch.column("runs").to_pylist(), strict=True):
                raw, spans = _utf8(text), merged(runs)
                kept, at = [], 0
                for a, b in spans:
                    kept.append(raw[at:a])
                    at = b
                rows.append(of(raw, spans, b"".join([*kept, raw[at:]])))
            made = [pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(fields.values())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *made], ["doc_id", *fields])

    joined = _keyed(docs, id_col, text_col).join(repeats(docs, id_col, text_col, context_bits), ["k1", "k2"], "left").select("doc_id", "text", "runs")
    return joined.mapInArrow(run, ", ".join([f"doc_id {docs.schema[id_col].dataType.simpleString()}", *[f"{n} {t}" for n, (t, _) in fields.items()]]))


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, spans (begin, end in bytes) that go, and kept, the bytes that stay."""
    span = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
    fields = {"spans": ("array<struct<begin:int,end:int>>", span), "kept": ("binary", pa.binary())}
    return _applied(docs, id_col, text_col, lambda raw, spans, kept: ([{"begin": a, "end": b} for a, b in spans], kept), fields)


def removal_digests(docs: DataFrame, context_bits: int = 64) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans and the SHA-256 of the bytes that stay."""
    fields = {n: ("bigint", pa.int64()) for n in ("n_bytes", "n_removed", "n_spans")} | {"kept_sha256": ("string", pa.string())}
    return _applied(docs, "doc_id", "text", lambda raw, spans, kept: (len(raw), len(raw) - len(kept), len(spans), hashlib.sha256(kept).hexdigest()), fields, context_bits)
