"""Track labels: nine comma-separated fields a line, without a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FIELDS = 9


def split_lines(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """``lines`` without blank ones, with fields."""
    return lines.filter(F.trim(line_col) != "").withColumn("fields", F.split(F.trim(line_col), ","))


def malformed(lines: DataFrame, line_col: str = "value") -> DataFrame:
    """Lines of too few fields, with the number they have."""
    return split_lines(lines, line_col).withColumn("n_fields", F.size("fields").cast("bigint")).filter(F.col("n_fields") < FIELDS).drop("fields")


def parsed(lines: DataFrame, line_col: str = "value", strict: bool = True) -> DataFrame:
    """Boxes of the lines. Numbers truncate toward zero where whole ones are wanted; field 7 is not read.

    A line of too few fields raises when it is reached, or is left out if not ``strict``.
    """
    cut = split_lines(lines, line_col)
    if strict:
        complain = F.raise_error(F.concat(F.lit(f"expected {FIELDS} fields: "), F.col(line_col))).cast("array<string>")
        cut = cut.withColumn("fields", F.when(F.size("fields") < FIELDS, complain).otherwise(F.col("fields")))
    else:
        cut = cut.filter(F.size("fields") >= FIELDS)

    def field(k: int, kind: str):
        number = F.trim(F.element_at("fields", k)).cast("double")
        return number.cast(kind) if kind != "double" else number

    kept = [c for c in lines.columns if c != line_col]
    return cut.select(*kept, field(1, "bigint").alias("frame"), field(2, "bigint").alias("tid"), field(3, "double").alias("x"), field(4, "double").alias("y"), field(5, "double").alias("w"), field(6, "double").alias("h"), field(9, "double").alias("vis"), field(8, "int").alias("cls"))


def read(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """Boxes of the files at a path, with the file each is from."""
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    return parsed(lines, strict=strict)
