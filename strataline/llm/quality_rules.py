"""Quality rules: a table of thresholds compiled into one projection, without user functions.

Texts are read whole. A null or empty text has no words, lines or symbols; every ratio over nothing is 0.
Each row stands alone: repeated rows give repeated results, an empty table an empty one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space between words: space, tab to carriage return.
BLANKS = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Frequent short words of four languages.
STOP_WORDS = {
    "en": ("the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "are", "as", "with", "be", "by", "at"),
    "de": ("der", "die", "das", "und", "in", "zu", "den", "ist", "von", "mit", "ein", "eine", "auf", "nicht", "sich", "im"),
    "fr": ("le", "la", "les", "de", "des", "et", "en", "un", "une", "que", "qui", "dans", "pour", "par", "sur", "du", "aux"),
    "es": ("el", "la", "los", "las", "de", "y", "en", "un", "una", "que", "por", "con", "para", "del", "se", "al", "es"),
}


@dataclass(frozen=True)
class Rule:
    """A document passes if ``low <= 100 * numerator / denominator <= high``; None leaves a side open."""

    name: str
    numerator: str
    denominator: str
    low: int | None = None
    high: int | None = None

    def passed(self) -> Column:
        ratio, over = 100 * F.col(self.numerator), F.col(self.denominator)
        out = F.lit(True)
        if self.low is not None:
            out = out & (ratio >= self.low * over)
        if self.high is not None:
            out = out & (ratio <= self.high * over)
        return out


#: The table of thresholds, in hundredths.
RULES = (
    Rule("word_length", "word_chars", "n_words", 200, 1500),
    Rule("symbols", "n_symbols", "n_words", None, 30),
    Rule("stop_words", "n_stop_words", "n_words", 2, None),
    Rule("shouted", "n_shouted", "n_words", None, 30),
    Rule("repeated_lines", "n_dup_lines", "n_lines", None, 50),
)
MIN_WORDS = 50
MAX_REPEATED = 50

STATISTICS = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_shouted")


def words_of(text: Column) -> Column:
    """The words of a text that is not null."""
    return F.array_remove(F.split(text, BLANKS), "")


def statistics(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with the columns STATISTICS (bigint) of each whole text; columns of these names are replaced.

    n_repeat_words counts the words that lie in a window of three words found twice or more in the text.
    Windows are first compared by 32 hash bits beside their position in one sorted array of numbers, then
    those that look alike by their words.
    """
    w, t, k, c, p = ("__words", "__text", "__keys", "__likely", "__places")
    stops = sorted({x for words in STOP_WORDS.values() for x in words})
    quoted = ", ".join(f"'{x}'" for x in stops)
    # The hash takes the upper half of a number and the position the lower, so that sorting brings like windows together.
    keys = f"""CASE WHEN size({w}) < 4 THEN cast(array() AS array<bigint>) ELSE sort_array(transform(sequence(0, size({w}) - 3),
        i -> (xxhash64(get({w}, i), get({w}, i + 1), get({w}, i + 2)) & -4294967296L) | i)) END"""
    likely = f"""filter({k}, (x, i) -> (i > 0 AND shiftright(x, 32) = shiftright(get({k}, i - 1), 32))
        OR (i < size({k}) - 1 AND shiftright(x, 32) = shiftright(get({k}, i + 1), 32)))"""
    sure = f"""CASE WHEN size({c}) = 0 THEN cast(array() AS array<struct<v:string,i:int>>) ELSE array_sort(transform({c}, x -> named_struct(
        'v', concat_ws(' ', slice({w}, cast(x & 4294967295L AS int) + 1, 3)), 'i', cast(x & 4294967295L AS int)))) END"""
    places = f"""sort_array(transform(filter({p}, (x, i) -> (i > 0 AND x.v = get({p}, i - 1).v) OR (i < size({p}) - 1 AND x.v = get({p}, i + 1).v)), x -> x.i))"""
    covered = f"""aggregate({places}, named_struct('n', 0L, 'last', -3), (a, i) -> named_struct('n', a.n + least(3, i - a.last), 'last', i), a -> a.n)"""
    lines = "__lines"
    base = [x for x in df.columns if x not in STATISTICS]
    kept = [f"`{x}`" for x in base]
    return (
        df.select(*kept, F.coalesce(df[text_col], F.lit("")).alias(t))
        .select(
            *kept, t,
            words_of(F.col(t)).alias(w),
            # A line counts if it holds a word.
            F.expr(rf"filter(split({t}, '\n'), x -> x RLIKE '[^\\x20\\x09-\\x0D]')").alias(lines),
        )
        .select(*kept, t, w, lines, F.expr(keys).alias(k))
        .select(*kept, t, w, lines, F.expr(likely).alias(c))
        .select(*kept, t, w, lines, F.expr(sure).alias(p))
        .select(
            *kept,
            # Adds nothing. A filter on the statistics stops at a column that is not deterministic; pushed
            # further down it would copy the expressions above into each other many times over.
            (F.size(w) + (0 * F.rand(0)).cast("int")).cast("bigint").alias("n_words"),
            F.length(F.array_join(w, "")).cast("bigint").alias("word_chars"),
            (F.length(t) - F.length(F.regexp_replace(t, f"[{SYMBOLS}]", ""))).cast("bigint").alias("n_symbols"),
            F.size(lines).cast("bigint").alias("n_lines"),
            (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
            F.expr(covered).cast("bigint").alias("n_repeat_words"),
            F.expr(f"size(filter({w}, x -> lower(x) IN ({quoted})))").cast("bigint").alias("n_stop_words"),
            F.expr(f"size(filter({w}, x -> endswith(x, '!')))").cast("bigint").alias("n_shouted"),
        )
    )


def judged(df: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``df``, which has the columns STATISTICS, with base_failed, failed_rules and kept."""
    failed = F.array_compact(F.array(*[F.when(~r.passed(), F.lit(r.name)) for r in rules]))
    base = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    return df.withColumn("base_failed", base).withColumn("failed_rules", failed).withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0))


def filtered(df: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``df`` that are kept, with its columns alone, whatever their names."""
    row = F.struct(*[df[c] for c in df.columns]).alias("__row")
    out = judged(statistics(df.select(row, df[text_col].alias("__body")), "__body"), rules)
    return out.filter("kept").select("__row.*")


def report(df: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """One row per document: id, statistics, base_failed and kept; judged() also names the rules that are broken."""
    slim = df.select("doc_id", "text")
    out = judged(statistics(slim), rules)
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_lines", "n_stop_words", "n_shouted")
