"""The divergence audit against dense plain arithmetic, and against its SQL."""

import random
import re
from collections import Counter, defaultdict

import pandas as pd
from pyspark.sql import functions as F

from strataline.llm import divergence
from test_rules_lines_mix import FIELDS, check_sql

TERMS = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERMS.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain(rows, least=30, top=50):
    docs = [(r[2] or "", r[3] or "", terms(r[1])) for r in rows]
    seen = defaultdict(Counter)
    for lang, _, t in docs:
        seen[lang].update(set(t))
    out = []
    for lang in {d[0] for d in docs}:
        kept = [t for t, n in seen[lang].items() if n >= least]
        counts = defaultdict(Counter)
        for where, source, t in docs:
            if where == lang:
                counts[source].update(x for x in t if x in set(kept))
        whole = sum(counts.values(), Counter())

        def shares(c):
            n = sum(c.values())
            return {t: 1 + 1_000_000_000 * (c[t] + 5) // (n + 5 * len(kept)) for t in kept}

        p, q = {s: shares(c) for s, c in counts.items()}, shares(whole)
        for s in counts:
            far = sorted(((-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o) for o in counts if o != s))
            more = sorted((q[t] - p[s][t], t.encode(), t) for t in kept if counts[s][t] and p[s][t] > q[t])[:top]
            for part, found in (("pair", far), ("term", more)):
                out += [(lang, s, part, item, -value, k + 1) for k, (value, _, item) in enumerate(found)]
    return sorted(out)


def reported(df):
    return sorted(tuple(r) for r in df.select("lang", "source", "part", "item", "value", "rank").collect())


def hard_rows(many=300):
    draw = random.Random(2)
    words = "the of Ñandú über a b c d ça word9word x-y z_z Grüße 漢字 end".split()
    rows = []
    for k in range(many):
        lang, source = draw.choice(["en", "en", "en", "de", None]), draw.choice(["a", "b", "hot", "hot", "hot", None, "", "ü", "B"])
        mine = words[: 4 + len(source or "") * 3] if source != "hot" else words
        rows.append((k, draw.choice([" ", "\n", ". ", "5"]).join(draw.choice(mine) for _ in range(draw.randint(0, 40))), lang, source, 1))
    rows += [(1, None, "en", "a", 1), (1, "", "fr", "only", 1), (2, "the the the", "en", "b", 1), (2, "the the the", "en", "b", 1)]
    rows += [(3, "rare words here", "fr", "other", 1), (4, "... 77 ...", "fr", "third", 1), (5, "aaa " * 50_000 + "the", "en", "long", 1), (6, None, "lone", None, None)]
    return rows


def test_audit(spark):
    rows = hard_rows()
    docs = spark.createDataFrame(rows, FIELDS).withColumns({"term": F.lit("x"), "n": F.lit(1), "place": F.lit(2), "part": F.lit("y")})
    want = plain(rows)
    assert reported(divergence.audit(docs.repartition(4))) == want
    assert {r[2] for r in want} == {"pair", "term"} and any(r[4] == 0 for r in want)


def test_small_blocks_of_terms_counts_and_pairs(spark, monkeypatch):
    for name, value in (("BLOCK_TERMS", 4), ("HELD", 3), ("TOGETHER", 5), ("PAIRS_HELD", 2)):
        monkeypatch.setattr(divergence, name, value)
    rows = hard_rows(150)
    assert reported(divergence.audit(spark.createDataFrame(rows, FIELDS), least=20, top=3)) == plain(rows, 20, 3)


def test_nothing_kept_and_no_rows(spark):
    rows = hard_rows(40)
    assert reported(divergence.audit(spark.createDataFrame(rows, FIELDS), least=10_000)) == plain(rows, 10_000)
    assert divergence.audit(spark.createDataFrame([], FIELDS)).count() == 0


def test_counts_beyond_64_bits_stay_exact(spark):
    one = spark.createDataFrame([(12_345_678_901_234, 98_765_432_109_876_543, 7)], "n long, total long, terms long")
    got = one.select(divergence.share("n", "total", "terms").alias("p")).first().p
    assert got == 1 + 1_000_000_000 * (12_345_678_901_234 + 5) // (98_765_432_109_876_543 + 35)


def test_automaton_counts_neighbours():
    assert Counter(t for _, t in divergence.automaton(["a", "ab", "b a"]).iter(" a a ab a b ")) == {"a": 3, "ab": 1}


def test_pairs_in_common_by_strips(monkeypatch):
    draw = random.Random(6)
    rows = [("en", f"t{t}", s, draw.randint(1, 90), 3 * s + 1) for t in range(12) for s in range(9) if draw.random() < 0.6]
    want = Counter()
    for _, t, s, p, z in rows:
        for _, t2, s2, p2, z2 in rows:
            if t == t2 and s < s2:
                want[s, s2] += abs(p - p2) - abs(p - z2) - abs(z - p2) + abs(z - z2)
    frame = pd.DataFrame(rows, columns=["lang", "term", "place", "p", "zero"])
    for held in (1, 7, 1 << 20):
        monkeypatch.setattr(divergence, "PAIRS_HELD", held)
        got = divergence._in_common(frame)
        assert {(r.a, r.b): r.value for r in got.itertuples()} == dict(want)


def test_sql(spark, tmp_path):
    assert check_sql(spark, tmp_path, "op13_source_divergence", spark.createDataFrame(hard_rows(), FIELDS)).num_rows > 50
