"""Quality rules, line dedup, fingerprints and source mixing against SQL and plain code."""

import hashlib
import os
import random
import unicodedata

import duckdb
import pytest
import xxhash  # noqa: F401  the library the digests rest on is there
from pyspark.sql import functions as F

from strataline.llm import fingerprints, line_dedup, quality_rules, queries, source_mixing
from tests_llm_brute import words

SF = "/root/testdata/sf0.001"


def rows(table):
    columns = [table.column(c).to_pylist() for c in sorted(table.column_names)]
    return sorted((tuple(repr(v) for v in r) for r in zip(*columns, strict=True)), key=str)


def check_sql(spark, tmp_path, name, docs):
    """The query and its SQL over a folder that holds ``docs``."""
    docs.coalesce(1).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    got, want = queries.QUERIES[name](spark, str(tmp_path)).toArrow(), con.sql(queries.ORACLE_SQL[name]).to_arrow_table()
    assert sorted(got.column_names) == sorted(want.column_names)
    assert rows(got) == rows(want)
    return got


FIELDS = "doc_id long, text string, lang string, source string, n_chars long"


def fixture(spark, many=60):
    draw = random.Random(4)
    texts = [None, "", " \n\t", "a", "the of and", "x y z " * 40, "one\ntwo\none\n\nTWO\none", "# $ % | <>" * 9, "\x0b\x0c a \r\n b", "THE!! OF!! " * 30, "wörter ñandú çà " * 30]
    for _ in range(many):
        base = [draw.choice("the of and to a b c d e f g h ij kl".split()) for _ in range(draw.randint(1, 70))]
        texts.append("\n".join(" ".join(base[i : i + 12]) for i in range(0, len(base), 12)))
        near = list(base)
        near[draw.randrange(len(near))] = "new"
        texts.append("\n".join(" ".join(near[i : i + 12]) for i in range(0, len(near), 12)))
        if len(base) > 12:
            texts.append(" ".join(base[:11]) + "\n" + " ".join(["more", *base[:12]]))
    return spark.createDataFrame([(i, t, "en", [None, "b", "a", "ü", "hot", "hot", "hot"][i % 7], 0) for i, t in enumerate(texts)], FIELDS)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_on_hard_cases(spark, tmp_path, name):
    check_sql(spark, tmp_path, name, fixture(spark))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_empty_table(spark, tmp_path, name):
    spark.createDataFrame([], FIELDS).write.parquet(f"{tmp_path}/documents.parquet")
    assert queries.QUERIES[name](spark, str(tmp_path)).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")
@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_on_documents(spark, tmp_path, name):
    check_sql(spark, tmp_path, name, spark.read.parquet(f"{SF}/documents.parquet"))


def test_repeated_words_by_hand(spark):
    df = spark.createDataFrame([("a b c x a b c",), ("a a a a",), ("a b c",), (None,)], "text string")
    assert [r.n_repeat_words for r in quality_rules.statistics(df).collect()] == [6, 4, 0, 0]


def test_filter_keeps_columns_and_clean_documents(spark):
    # No window of three words is there twice: such windows may cover half of a text at most.
    clean = " ".join("the words%d of a%d text that says%d things" % (k, k, k) for k in range(20))
    df = spark.createDataFrame([(1, clean, 9), (2, "### " * 100, 9), (None, None, None)], "doc_id long, text string, n_words int")
    got = quality_rules.filtered(df)
    assert got.columns == df.columns and [tuple(r) for r in got.collect()] == [(1, clean, 9)]


def near_lines(docs):
    """(doc, line) -> earliest earlier line within one word, or the same."""
    lines = [(d, i, line) for d, t in sorted(docs, key=lambda r: r[0]) for i, line in enumerate((t or "").split("\n")) if words(line)]

    def close(a, b):
        if a == b:
            return True
        x, y = sorted((words(a), words(b)), key=len)
        if len(y) < line_dedup.MIN_WORDS or len(y) - len(x) > 1:
            return False
        if len(x) == len(y):
            return sum(p != q for p, q in zip(x, y, strict=True)) <= 1
        return any(x == y[:k] + y[k + 1 :] for k in range(len(y)))

    return {(d, i) for k, (d, i, line) in enumerate(lines) if any(close(line, other) for _, _, other in lines[:k])}


def test_line_dedup_plain(spark):
    docs = [(r.doc_id, r.text) for r in fixture(spark, 12).collect()]
    want = near_lines(docs)
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert {(r.doc_id, r.line_no) for r in line_dedup.removals(df).collect()} == want
    kept = {r.doc_id: r.text for r in line_dedup.deduplicated(df).collect()}
    for d, t in docs:
        stay = None if t is None else "\n".join(x for i, x in enumerate(t.split("\n")) if (d, i) not in want)
        assert kept[d] == stay


def test_line_dedup_at_the_least_length(spark):
    eight, seven, six = "a b c d e f g h", "a b c d e f g", "a b c d e f"
    for docs, gone in ((((1, seven), (2, eight)), {(2, 0)}), (((1, eight), (2, seven)), {(2, 0)}), (((1, seven), (2, six)), set()), (((1, eight), (2, "a b c x e f g h")), {(2, 0)}), (((1, seven), (2, "a b c x e f g")), set())):
        assert {(r.doc_id, r.line_no) for r in line_dedup.removals(spark.createDataFrame(docs, "doc_id long, text string")).collect()} == gone


def test_line_dedup_null_id_and_repeats(spark):
    df = spark.createDataFrame([(None, "same line"), (1, "same line\nother"), (1, "same line\nother"), (2, "other")], "doc_id long, text string")
    assert {(r.doc_id, r.line_no) for r in line_dedup.removals(df).collect()} == {(1, 0), (2, 0)}
    assert sorted(r.text for r in line_dedup.deduplicated(df).collect()) == ["", "other", "other", "same line"]


def test_line_dedup_rows_that_share_an_id(spark):
    """Null ids, and one id with two texts: each row keeps and loses its own lines."""
    long, near = "a b c d e f g h i", "a b c x e f g h i"
    first, second = "k l m n o p q r s t", "k l m n o p q r s"
    docs = [(None, "same\nclean one"), (None, "same\nclean two"), (1, f"{long}\nmine"), (1, f"{near}\nyours"), (2, "same\nleft"), (2, "right\nleft too"), (3, f"short\n{first}"), (None, second)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = sorted(((r.doc_id, r.text) for r in line_dedup.deduplicated(df).collect()), key=str)
    nulls = [t for d, t in got if d is None]
    assert sorted(t for d, t in got if d == 2) == ["left", "right\nleft too"] and (3, "short") in got
    assert len(nulls) == 3 and second in nulls and sum(t.startswith("same\n") for t in nulls) == 1
    assert {t.split("\n")[-1] for t in nulls} == {"clean one", "clean two", second}
    ones = [t for d, t in got if d == 1]
    assert sorted(t.split("\n")[-1] for t in ones) == ["mine", "yours"] and sorted(t.count("\n") for t in ones) == [0, 1]
    assert got == sorted(((r.doc_id, r.text) for r in line_dedup.deduplicated(df.repartition(5)).collect()), key=str)


def test_fingerprints(spark):
    texts = ["Café  au\tlait", "café AU LAIT", "ﬁne", "FINE", None, "", "   ", "other"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.fingerprint for r in fingerprints.fingerprints(docs).collect()}
    assert got[0] == got[1] and got[2] == got[3] and got[4] == got[5] == got[6] and len(set(got.values())) == 4
    canon = " ".join(unicodedata.normalize("NFKC", texts[0]).lower().split())
    assert got[0] == "".join(f"{xxhash_spark(canon, seed) & (2**64 - 1):016x}" for seed in (0, 1))
    for digest in (fingerprints.digest, lambda c: F.substring(fingerprints.digest(c), 1, 1), lambda c: F.lit("all")):
        assert {r.doc_id: r.first_id for r in fingerprints.copies(docs, digest=digest).collect()} == {0: 0, 1: 0, 2: 2, 3: 2, 4: 4, 5: 4, 6: 4, 7: 7}


def xxhash_spark(text, seed):
    """The engine hashes its columns in turn, each value seeding the next."""
    first = xxhash.xxh64((seed).to_bytes(4, "little", signed=True), seed=42).intdigest()
    return xxhash.xxh64(text.encode(), seed=first).intdigest()


def test_case_is_folded(spark):
    texts = ["Straße", "STRASSE", "ΟΔΟΣ", "οδος", "οδοσ", "straSSe "]
    got = {r.doc_id: r.first_id for r in fingerprints.copies(spark.createDataFrame([(f"d{i}", t) for i, t in enumerate(texts)], "doc_id string, text string")).collect()}
    assert got == {"d0": "d0", "d1": "d0", "d2": "d2", "d3": "d2", "d4": "d2", "d5": "d0"}


@pytest.mark.parametrize("bits", [128, 4, 0])
def test_edited_report_of_clashing_prints(spark, bits):
    """Texts of one fingerprint are told apart by their bytes; ids are strings, some null, some repeated."""
    draw = random.Random(15)
    base = ["Alpha beta", "alpha  BETA", "gamma", "", None, "Γάμμα", "delta delta"]
    docs = [(draw.choice([None, *"abcdefghij"]), draw.choice(base)) for _ in range(40)]
    digest = (lambda c: F.substring(fingerprints.digest(c), 1, bits // 4)) if bits < 128 else fingerprints.digest
    df = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id string, text string, r1 int").repartition(3)
    got = fingerprints.edited_report(df, digest).collect()
    assert len(got) == 40
    canon = lambda t: " ".join(unicodedata.normalize("NFKC", t or "").casefold().split())
    firsts = {}
    for i, t in docs:
        firsts.setdefault(canon(t), []).append(i)
    want = sorted((i, len(t or ""), min((x for x in firsts[canon(t)] if x is not None), default=None)) for i, t in docs if i is not None)
    assert sorted((r.doc_id, r.n_chars, r.first_id) for r in got if r.doc_id is not None) == want
    plain = sorted((str(r.doc_id), r.edited_sha256, r.near_edited, r.near_next) for r in fingerprints.edited_report(df).collect())
    assert sorted((str(r.doc_id), r.edited_sha256, r.near_edited, r.near_next) for r in got) == plain


def test_edited_report_plain(spark):
    draw = random.Random(5)
    texts = [None, "", "aé🙂b", "x"] + ["".join(draw.choice("ab é🙂\n") for _ in range(draw.randint(0, 30))) for _ in range(60)] + ["same", "same"]
    ids = draw.sample(range(10**6), len(texts))
    docs = sorted(zip(ids, texts, strict=True))
    got = {r.doc_id: r for r in fingerprints.edited_report(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect()}
    for k, (d, t) in enumerate(docs):
        t, nxt = t or "", docs[(k + 1) % len(docs)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        assert got[d].n_chars == len(t)
        assert got[d].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        canon = [" ".join(unicodedata.normalize("NFKC", x).casefold().split()) for x in (t, edited, nxt)]
        for c, found in zip(canon, (got[d].fingerprint, got[d].edited_fingerprint), strict=False):
            assert found == "".join(f"{xxhash_spark(c, seed) & (2**64 - 1):016x}" for seed in (0, 1))
        assert (got[d].near_edited, got[d].near_next) == (float(canon[0] == canon[1]), float(canon[0] == canon[2]))
    assert fingerprints.edited_report(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    one = fingerprints.edited_report(spark.createDataFrame([(7, "abcd")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0


def test_mix_comes_near_targets(spark):
    draw = random.Random(6)
    rows = [(i, " ".join("w" for _ in range(draw.randint(0, 40))), draw.choice(["a", "b", "c", "hot", "hot", "hot", None])) for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = source_mixing.counted(docs).toPandas()
    assert (got["taken"] <= 2 * got["size"]).all()
    for _, part in got.groupby("source", dropna=False):
        assert abs(part["taken"].sum() - part["target"].iloc[0]) <= 40
    assert got.drop_duplicates("source")["target"].sum() == pytest.approx(1.5 * got["size"].sum())
    again = source_mixing.counted(docs.repartition(7)).toPandas()
    assert got.sort_values("doc_id").reset_index(drop=True).equals(again.sort_values("doc_id").reset_index(drop=True))
    assert source_mixing.mixed(docs).count() == int(got["copies"].sum()) and source_mixing.mixed(docs).columns == docs.columns


def test_mix_of_empty_texts_stops_at_most(spark):
    """A source that is taken twice as a whole gives its empty documents twice, not three times."""
    docs = spark.createDataFrame([(1, "w " * 20, "small"), (2, "", "small"), (3, None, "small"), *[(i, "w " * 500, "large") for i in range(4, 9)]], "doc_id long, text string, source string")
    got = {r.doc_id: r.copies for r in source_mixing.counted(docs, weights=(1,)).collect()}
    assert got[1] == got[2] == got[3] == 2 and max(got.values()) == 2
    assert source_mixing.mixed(docs, weights=(1,)).filter("doc_id < 4").count() == 6


def test_line_dedup_unless_alike(spark):
    """Lines of near copies stay; those of other rows, and repetitions inside a row, go."""
    body = [" ".join(f"w{i}.{j}" for j in range(9)) for i in range(12)]
    near = [*body[:11], "another last line of the text"]
    docs = spark.createDataFrame([(1, "\n".join(body)), (2, "\n".join(near)), (3, f"{body[0]}\nits own\nits own"), (4, "\n".join(body)), (5, None)], "doc_id long, text string")
    got = {r.doc_id: r.text for r in line_dedup.deduplicated(docs, unless_alike=75).collect()}
    assert got == {1: "\n".join(body), 2: "\n".join(near), 3: "its own", 4: "\n".join(body), 5: None}


def test_mix_of_empty_texts(spark):
    docs = spark.createDataFrame([(1, None, None), (2, "", "a"), (None, " ", "a")], "doc_id long, text string, source string")
    assert [r.taken for r in source_mixing.counted(docs).collect()] == [0, 0, 0]


def unlucky_rows():
    """Sources of null ids, of one id with many texts, and of equal rows; others make the targets end inside them."""
    rows = [(None, f"w{k} " * 10, "en", "null ids", 0) for k in range(300)]
    rows += [(7, f"v{k} " * 10, "en", "one id", 0) for k in range(300)]
    rows += [(8, "same words ten times over are what all hold here", "en", "equal", 0)] * 300
    rows += [(None, "no id and the same words in all of these rows", "de", None, 0)] * 300
    return rows + [(1000 + k, f"u{k} " * 10, "en", f"other{k % 3}", 0) for k in range(300)]


@pytest.mark.parametrize("share", [1.5, 0.7, 0.31])
def test_mix_tells_rows_of_one_id_apart(spark, share):
    docs = spark.createDataFrame(unlucky_rows(), FIELDS)
    got = source_mixing.counted(docs, share=share).toPandas()
    for _, own in got.groupby("source", dropna=False):
        assert abs(own["taken"].sum() - own["target"].iloc[0]) <= 10, own["source"].iloc[0]
    again = source_mixing.counted(docs.repartition(7), share=share).toPandas()
    by = ["source", "doc_id", "taken"]
    assert got.sort_values(by)[by].values.tolist().__repr__() == again.sort_values(by)[by].values.tolist().__repr__()
    mixed = source_mixing.mixed(docs, share=share)
    counts = {(r.source, r.doc_id): r["count"] for r in mixed.groupBy("source", "doc_id").count().collect()}
    want = {(r.source, r.doc_id): r.n for r in source_mixing.counted(docs, share=share).groupBy("source", "doc_id").agg(F.sum("copies").alias("n")).collect() if r.n}
    assert counts == want


def test_mix_of_rows_that_differ_in_other_columns_only(spark):
    rows = [(1, "a b c", "en", "s", k % 3) for k in range(9)]
    out = source_mixing.mixed(spark.createDataFrame(rows, FIELDS).withColumn("nth", F.lit("x")).withColumn("hash", F.lit(None).cast("int")))
    assert out.columns == [*"doc_id text lang source n_chars nth hash".split()]
    assert abs(out.count() - 13.5) <= 1 and out.groupBy("n_chars").count().count() == 3


def test_mix_sql_on_rows_of_one_id(spark, tmp_path):
    check_sql(spark, tmp_path, "op9_source_mixing", spark.createDataFrame(unlucky_rows(), FIELDS))
