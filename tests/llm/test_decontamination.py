"""Benchmark passages against a plain search for windows in lists of words."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from strataline.llm import decontamination as dec
from strataline.llm import queries

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
DOC, ITEM = "doc_id long, text string, lang string", "item_id long, text string"


def words(text):
    return WORDS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def windows(w):
    return [tuple(w[k : k + 10]) for k in range(max(1, len(w) - 9))] if w else []


def plain(docs, items):
    out = []
    owners = {}
    for i, t in items:
        for v in windows(words(t)):
            owners.setdefault(v, set()).add(str(i) if i is not None else "")
    lengths = {len(v) for v in owners}
    for doc_id, text, *_ in docs:
        w, hit, of = words(text), set(), set()
        for n in lengths:
            for k in range(len(w) - n + 1):
                if (v := tuple(w[k : k + n])) in owners:
                    hit |= set(range(k, k + n))
                    of |= owners[v]
        out.append((doc_id, len(w), len(hit), len(of), hashlib.sha256(",".join(sorted(of)).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=repr)


def reported(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()), key=repr)


def hard_case():
    draw = random.Random(8)
    own = "red Blue GREEN x1 ñandú 42 o k über ça".split()
    other = "zebra yak other word 7".split()
    items = [(k, " ".join(draw.choice(own) for _ in range(draw.choice([5, 9, 10, 11, 12, 30])))) for k in range(40)]
    items += [(94, "Solo"), (95, "solo two"), (3, "a second text of item three"), (None, "nameless item"), (90, None), (91, " .-! "), (10, items[10][1]), (92, items[20][1] + " and more")]
    docs = []
    for k in range(120):
        w = [draw.choice(own + other[: k % 5]) for _ in range(draw.randint(0, 60))]
        if k % 3 == 0:
            passage = words(draw.choice(items)[1])
            at = draw.randint(0, len(w))
            w[at:at] = passage
        docs.append((k if k % 9 else None, draw.choice([" ", "-", ", ", "\x00"]).join(w), "en"))
    docs += [(500, None, "en"), (501, "", "en"), (502, "...", "en"), (7, "nameless ITEM", "en"), (7, "nameless item", "en"), (7, "nameless item", "en")]
    docs += [(503, "filler yak " * 40_000 + items[20][1] + " filler" * 10, "en")]
    # A passage that begins in one document and ends in the next is no occurrence.
    whole = items[5][1].split() + ["red"] * 12
    items.append((93, " ".join(whole)))
    docs += [(504, " ".join(whole[:6]), "en"), (505, " ".join(whole[6:]), "en")]
    return docs, items


@pytest.fixture(scope="module")
def tables(spark):
    docs, items = hard_case()
    return docs, items, spark.createDataFrame(docs, DOC), spark.createDataFrame(items, ITEM)


def test_report(tables):
    docs, items, d, i = tables
    more = d.withColumns({"key": F.lit(1), "spans": F.lit("x"), "items": F.lit(2), "item_id": F.lit(3)})
    want = plain(docs, items)
    assert reported(dec.report(more.repartition(3), i.withColumn("doc_id", F.lit(1)))) == want
    assert 20 < sum(r[-1] for r in want) < len(want) - 10


def test_blocks_of_the_benchmark_and_small_shards(tables, monkeypatch):
    docs, items, d, i = tables
    monkeypatch.setattr(dec, "benchmark_blocks", lambda b, f=dec.benchmark_blocks: f(b, most=300))
    assert len(list(dec.benchmark_blocks(i))) > 3
    assert reported(dec.report(d, i)) == plain(docs, items)


def test_empty_tables(spark, tables):
    docs, _, d, i = tables
    assert reported(dec.report(d, spark.createDataFrame([], ITEM))) == plain(docs, [])
    assert dec.report(spark.createDataFrame([], DOC), i).count() == 0
    assert dec.matches(d, spark.createDataFrame([], ITEM)).count() == 0


def test_shards_of_few_words(monkeypatch):
    docs, items = hard_case()
    monkeypatch.setattr(dec, "SHARD_WORDS", 50)
    made = dec.items_of([(None if n is None else str(n), t) for n, t in items])
    found = list(dec.occurrences([t for _, t, _ in docs], made))
    assert [n for n, _, _ in found] == [len(words(t)) for _, t, _ in docs]
    got = [sum(b - a for a, b in dec.runs(f, made.lengths[w])) for _, f, w in found]
    assert got == [plain([row], items)[0][2] for row in docs]


def test_suffix_array_is_sorted_and_searched():
    draw = np.random.default_rng(5)
    for most, depth in ((3, 10), (1000, 10), (1 << 31, 4), (1, 3)):
        codes = draw.integers(0, min(most, 4) + 1, 400).astype(np.int64)
        shard = dec.Shard(codes, most, depth)
        suffixes = []
        for p in shard.array.tolist():
            s = codes[p : p + depth].tolist()
            suffixes.append(s[: s.index(0)] if 0 in s else s)
        assert suffixes == sorted(suffixes) and len(suffixes) == np.count_nonzero(codes)
        wanted = np.array([(s + [0] * depth)[:depth] for s in suffixes[::7]] + [[most] * depth])
        lengths = np.count_nonzero(wanted, axis=1)
        for w, n, low, high in zip(wanted.tolist(), lengths, *shard.ranges(wanted, lengths), strict=True):
            assert sorted(shard.array[low:high]) == [p for p in range(len(codes)) if codes[p : p + n].tolist() == w[:n]]


def test_words_that_share_a_hash(monkeypatch):
    """Where two words get one hash, bytes tell them apart."""
    docs, items = hard_case()
    plain_runs = dec.word_runs
    with np.errstate(over="ignore"):
        red, yak = plain_runs(np.frombuffer(b"red yak ", np.uint8), dec._BLANK)[2]

    def clashing(data, blank):
        starts, ends, hashes = plain_runs(data, blank)
        return starts, ends, np.where(hashes == yak, red, hashes)

    monkeypatch.setattr(dec, "word_runs", clashing)
    made = dec.items_of([(str(n), t) for n, t in items])
    red_item = next(t for _, t in items if t and "red" in t.split() and len(t.split()) == 30)
    texts = [t for _, t, _ in docs] + [red_item.replace("red", "yak"), red_item]
    got = [sum(b - a for a, b in dec.runs(f, made.lengths[w])) for _, f, w in dec.occurrences(texts, made)]
    assert got == [plain([(0, t)], items)[0][2] for t in texts]


def test_matches_and_locations(spark):
    item = " ".join(f"w{k}" for k in range(30))
    docs = [(1, "x " + " ".join(f"W{k}" for k in range(3, 25)) + " y"), (2, " ".join(f"w{k}" for k in range(9))), (3, item + " " + item), (4, "tiny thing"), (5, None)]
    got = dec.matches(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame([(7, item), (8, "Tiny, thing!")], ITEM))
    assert sorted(map(tuple, got.collect())) == [(1, "7", 3, 1, 22), (3, "7", 0, 0, 30), (3, "7", 0, 30, 30), (4, "8", 0, 0, 2)]


def test_decontaminated_keeps_clean_rows(tables):
    docs, items, d, i = tables
    kept = dec.decontaminated(d, i)
    assert kept.columns == d.columns
    assert sorted(map(repr, map(tuple, kept.collect()))) == sorted(repr(row) for row in docs if not plain([row], items)[0][-1])


def test_query_on_given_tables(spark):
    sf = "/root/testdata/sf0.001"
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    assert reported(queries.QUERIES["op12_decontamination"](spark, sf)) == plain(docs, items)
