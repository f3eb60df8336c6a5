"""Every query on hard tables: nulls, long texts, repeated rows, no rows, and extra columns with names of the library's own."""

import re
from pathlib import Path

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from strataline.llm import license_scan, queries

COLUMNS = {"doc_id", "text", "source", "lang", "n_chars"}
QUERIES = queries.QUERIES | {"pipeline": corpus_pipeline.run}
HELD = "a hundred words and more of one long line " * 40
LONG = HELD + " ".join(f"w{k % 977} x{k % 31}" for k in range(20_000)) + "\n" + "a" * 20_000
PLAIN = [
    (None, "text of a row without an id, which stands here for itself " * 9, None, None, None), (10_001, None, "web", "en", None), (10_002, "", "web", "en", 0),
    (10_003, LONG, "web", "en", len(LONG)), (10_003, LONG, "web", "en", len(LONG)), (10_004, "\x00 é \U0001f600 \n\n\n", "books", "xx", 9),
    (10_005, "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.", "code", "en", 120),
]


def own_names():
    """The names of columns that the operators' code makes."""
    found = set()
    for file in Path(queries.__file__).parent.glob("*.py"):
        code = file.read_text()
        found |= set(re.findall(r'(?:alias|withColumn|col)\(\s*"([A-Za-z_]\w*)"', code)) | set(re.findall(r"([a-z_0-9]+) (?:bigint|string|int|double|binary|array)\b", code))
    return sorted(found - COLUMNS)


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    given = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{given}/documents.parquet")
    some = docs.filter("doc_id < 40").select("doc_id", "text", "source", "lang", "n_chars")
    rows = some.union(some.filter("doc_id < 9")).union(some.filter("doc_id < 9")).union(spark.createDataFrame(PLAIN, some.schema))
    tables = {"documents": rows, "labels": spark.read.parquet(f"{given}/labels.parquet").filter("doc_id < 40"), "benchmark": spark.read.parquet(f"{given}/benchmark.parquet")}
    top = tmp_path_factory.mktemp("edges")
    for name, table in tables.items():
        more = [F.lit(k).cast("string" if k % 2 else "int").alias(n) for k, n in enumerate(own_names()) if n not in table.columns]
        for kind, df in (("plain", table), ("more", table.select(*table.columns, *more)), ("none", table.limit(0))):
            df.write.parquet(f"{top}/{kind}/{name}.parquet")
    return top


def rows_of(df):
    table = df.toArrow()
    names = sorted(table.column_names)
    return names, sorted(tuple(repr(v) for v in r) for r in zip(*[table.column(c).to_pylist() for c in names], strict=True))


@pytest.fixture(scope="module")
def plain(spark, folders):
    """What a query says of the plain tables, asked once."""
    said = {}

    def of(name):
        if name not in said:
            said[name] = rows_of(QUERIES[name](spark, str(folders / "plain")))
        return said[name]

    return of


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_extra_columns_and_no_rows(spark, folders, plain, name):
    names, rows = plain(name)
    assert rows
    assert rows_of(QUERIES[name](spark, str(folders / "more"))) == (names, rows)
    assert rows_of(QUERIES[name](spark, str(folders / "none"))) == (names, [])


@pytest.mark.parametrize("name", [n for n in sorted(queries.QUERIES) if n not in ("op4_line_dedup", "op10_license_scan", "op13_source_divergence")])
def test_one_row_for_each_row(spark, folders, plain, name):
    """Repeated rows are told each for itself, and alike."""
    names, rows = plain(name)
    ids = [r[names.index("doc_id")] for r in rows]
    docs = spark.read.parquet(str(folders / "plain" / "documents.parquet"))
    assert sorted(ids) == sorted(repr(r.doc_id) for r in docs.select("doc_id").collect())
    if name not in ("op5_fingerprints", "op9_source_mixing", "op11_merkle_manifest"):  # next documents, numbers and siblings differ
        assert len({r for r, i in zip(rows, ids, strict=True) if i == "10003"}) == 1


def test_licenses_of_repeated_rows(spark, folders):
    docs = spark.read.parquet(str(folders / "plain" / "documents.parquet")).filter("doc_id = 10005").select("doc_id", "text")
    once = rows_of(license_scan.scan(docs))[1]
    assert rows_of(license_scan.scan(docs.union(docs)))[1] == sorted(once + once)
