"""The operators as queries over the documents table, with SQL for a second engine where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strataline.llm import decontamination, divergence, fingerprints, jaccard_join, license_scan, line_dedup, merkle, quality_rules, rule_ensemble, sentencepiece_codec, source_mixing, suffix_dedup, toxicity


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_codec.encode_digests(documents(spark, sf_dir), sentencepiece_codec.default_model_path())


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.report(documents(spark, sf_dir))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_digests(documents(spark, sf_dir))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.removals(documents(spark, sf_dir))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_report(documents(spark, sf_dir))


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return rule_ensemble.scored(docs, rule_ensemble.train(docs, labels(spark, sf_dir)))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return toxicity.scored(docs, toxicity.train(docs, labels(spark, sf_dir)))


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.linked_classes(documents(spark, sf_dir))


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_mixing.counted(documents(spark, sf_dir))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(documents(spark, sf_dir))


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_report(documents(spark, sf_dir))


def op12_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.report(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op13_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(documents(spark, sf_dir))


_STOPS = ", ".join(f"'{w}'" for w in sorted({w for words in quality_rules.STOP_WORDS.values() for w in words}))

#: A WITH list that ends in ``quality``: the columns of quality_rules.report() and the text.
QUALITY_SQL = rf"""
split_texts AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS t, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM documents),
windows AS (SELECT row_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS v FROM (SELECT row_id, w, unnest(range(1, len(w) - 1)) AS i FROM split_texts)),
twice AS (SELECT row_id, i FROM (SELECT row_id, i, count(*) OVER (PARTITION BY row_id, v) AS n FROM windows) WHERE n > 1),
covered AS (SELECT row_id, sum(least(3, i - coalesce(before, i - 3))) AS n FROM (SELECT row_id, i, lag(i) OVER (PARTITION BY row_id ORDER BY i) AS before FROM twice) GROUP BY row_id),
counts AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
    CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
    CAST(len(list_filter(w, lambda x: lower(x) IN ({_STOPS}))) AS BIGINT) AS n_stop_words, CAST(len(list_filter(w, lambda x: suffix(x, '!'))) AS BIGINT) AS n_shouted
    FROM split_texts LEFT JOIN covered USING (row_id)),
quality AS (SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEATED} * n_words AS base_failed FROM counts)"""
_PASSED = " AND ".join(f"100 * {r.numerator} {op} {v} * {r.denominator}" for r in quality_rules.RULES for op, v in ((">=", r.low), ("<=", r.high)) if v is not None)
QUALITY_COLUMNS = "doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, n_lines, n_stop_words, n_shouted"

_LINE_SQL = rf"""
WITH ln AS (SELECT doc_id, i - 1 AS line_no, l[i] AS line FROM (SELECT doc_id, l, unnest(range(1, len(l) + 1)) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))
    WHERE regexp_matches(l[i], '[^\x20\x09-\x0D]')),
uniq AS (SELECT line, min((doc_id, line_no)) AS place, list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM ln GROUP BY line),
cut AS (SELECT place, len(w) AS n, i AS pos, array_to_string(w[1:i - 1] || [''] || w[i + 1:], ' ') AS v, array_to_string(w[1:i - 1] || w[i + 1:], ' ') AS d
    FROM (SELECT place, w, unnest(range(1, len(w) + 1)) AS i FROM uniq WHERE len(w) >= {line_dedup.MIN_WORDS})),
near AS (SELECT a.place AS later, b.first AS earlier FROM cut a JOIN (SELECT v, pos, min(place) AS first FROM cut GROUP BY v, pos) b ON a.v = b.v AND a.pos = b.pos WHERE b.first < a.place
    UNION ALL SELECT greatest(c.place, u.place), least(c.place, u.place) FROM cut c JOIN uniq u ON array_to_string(u.w, ' ') = c.d WHERE c.place <> u.place),
gone AS (SELECT (ln.doc_id, ln.line_no) AS later, uniq.place AS earlier, 0 AS edits FROM ln JOIN uniq USING (line) WHERE (ln.doc_id, ln.line_no) > uniq.place
    UNION ALL SELECT later, min(earlier), 1 FROM near GROUP BY later)
SELECT DISTINCT later[1] AS doc_id, CAST(later[2] AS INTEGER) AS line_no, edits, earlier[1] AS first_doc_id, CAST(earlier[2] AS INTEGER) AS first_line_no FROM gone"""

QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_quality_rules": op2_quality_rules,
    "op3_suffix_dedup": op3_suffix_dedup,
    "op4_line_dedup": op4_line_dedup,
    "op5_fingerprints": op5_fingerprints,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_toxicity": op7_toxicity,
    "op8_jaccard_join": op8_jaccard_join,
    "op9_source_mixing": op9_source_mixing,
    "op10_license_scan": op10_license_scan,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_decontamination": op12_decontamination,
    "op13_source_divergence": op13_source_divergence,
}
ORACLE_SQL = {
    "op2_quality_rules": f"WITH {QUALITY_SQL} SELECT {QUALITY_COLUMNS} FROM (SELECT *, NOT base_failed AND {_PASSED} AS kept FROM quality)",
    "op4_line_dedup": _LINE_SQL,
    "op9_source_mixing": f"WITH {source_mixing.mix_sql('documents')} SELECT doc_id, size, source_size, target, taken, CAST(copies AS BIGINT) AS copies, source FROM mix",
    "op11_merkle_manifest": merkle.manifest_sql("documents"),
    "op13_source_divergence": divergence.audit_sql("documents"),
}
