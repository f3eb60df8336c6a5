"""The Merkle manifest against a plain tree of nested lists, and against its SQL."""

import hashlib
import random
import zlib

from pyspark.sql import functions as F

from strataline.functions import ranges
from strataline.llm import merkle, queries
from test_rules_lines_mix import FIELDS, check_sql


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def framed(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def leaf(row, text):
    doc_id, _, lang, source, n_chars = row
    return sha(*map(framed, (doc_id, source, lang, n_chars, text)))


def climb(nodes):
    """The root, and for each node its path of (left, right)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for n, k in enumerate(at):
            run = k - k % 3
            paths[n].append(("".join(nodes[run:k]), "".join(nodes[k + 1 : run + 3])))
        nodes, at = [sha(*nodes[k : k + 3]) for k in range(0, len(nodes), 3)], [k // 3 for k in at]
    return nodes[0], paths


def plain(rows):
    sources = sorted({r[3] for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    leaves = {s: sorted(((r[0] is not None, r[0] or 0, leaf(r, r[1]), r) for r in rows if r[3] == s), key=lambda x: x[:3]) for s in sources}
    climbed = {s: climb([x[2] for x in leaves[s]]) for s in sources}
    root, tops = climb([climbed[s][0] for s in sources])
    out = []
    for s, top in zip(sources, tops, strict=True):
        for (_, _, own, row), low in zip(leaves[s], climbed[s][1], strict=True):
            bad = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0 and row[1] is not None
            node = leaf(row, row[1].replace("\n", "")) if bad else own
            for left, right in low + top:
                node = sha(left, node, right)
            out.append((row[0], own, climbed[s][0], root, sha(*[x for p in low + top for x in p]), node, node == root))
    return sorted(out, key=repr)


def reported(df):
    return sorted((tuple(r) for r in df.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect()), key=repr)


def hard_rows(many=60):
    draw = random.Random(3)
    texts = [None, "", "\n", "a\nb", "long " * 30_000 + "\n", "wörter\nñ€𝄞"]
    rows = [(k if k % 7 else None, draw.choice(texts), draw.choice([None, "en"]), draw.choice([None, "", "n", "s", "hot", "hot", "ü", "zz"]), draw.choice([None, 5])) for k in range(many)]
    rows += [(3, "same\n", "en", "hot", 5)] * 5 + [(3, "other", "en", "hot", 5)] + [(None, None, None, None, None)] * 4 + [(-12, "alone\n", "de", "lone", 6)]
    return rows


def test_tamper_report(spark):
    rows = hard_rows()
    docs = spark.createDataFrame(rows, FIELDS).withColumns({"leaf": F.lit("x"), "root": F.lit(0), "tree": F.lit("y"), "pos": F.lit(1)})
    assert reported(merkle.tamper_report(docs.repartition(5))) == plain(rows)


def test_blocks_of_blocks_and_ranges(spark, monkeypatch):
    """Small blocks and ranges: several heights for leaves and for sources, orders cut inside one id."""
    monkeypatch.setattr(merkle, "DEPTH", 1)
    monkeypatch.setattr(merkle, "BLOCK", 3)
    monkeypatch.setattr(ranges, "SMALL", 10)
    rows = hard_rows(40) + [(k, f"t\n{k}", "en", f"src{k % 13}", k) for k in range(60)]
    assert reported(merkle.tamper_report(spark.createDataFrame(rows, FIELDS))) == plain(rows)


def test_every_size_of_tree(spark):
    rows = [(k, f"t\n{k}", "en", f"of{n}", k) for n in (1, 2, 3, 4, 9, 10, 27, 28, 82) for k in range(n)]
    assert reported(merkle.tamper_report(spark.createDataFrame(rows, FIELDS))) == plain(rows)


def test_manifest_root_and_subroots(spark):
    rows = [(k, "x", "en", [None, "b"][k % 2], 1) for k in range(7)]
    docs = spark.createDataFrame(rows, FIELDS)
    made = merkle.Manifest(docs.select("doc_id", "source", merkle.leaf_of(docs).alias("leaf")), ["doc_id"], ["doc_id"])
    want = {r[3]: p[2] for r, p in zip(sorted(rows, key=lambda r: (r[3] or "", r[0])), sorted(plain(rows), key=lambda p: (rows[p[0]][3] or "", p[0])), strict=True)}
    assert {r.source: r.subroot for r in made.subroots().collect()} == want
    assert [r.root for r in made.root().collect()] == [plain(rows)[0][3]]


def test_no_rows(spark):
    assert merkle.tamper_report(spark.createDataFrame([], FIELDS)).count() == 0


def test_sql(spark, tmp_path):
    docs = spark.createDataFrame(hard_rows(), FIELDS)
    got = check_sql(spark, tmp_path, "op11_merkle_manifest", docs)
    assert got.num_rows == 71 and "op11_merkle_manifest" in queries.QUERIES
