"""Orders over a whole table without one task that holds all of it.

Rows are dealt into ranges of their order by bounds that a sample of the rows gives. Bounds are values in the
plan, so all branches of a query and all retries agree on them; they decide balance only, never a result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Sampled rows for each range; their number is bounded by the number of shuffle partitions, not by the input.
PER_RANGE = 20
#: Tables of fewer rows are one range.
SMALL = 10_000


def bounds(df: DataFrame, keys: list[str]) -> list[tuple]:
    """Rising places that cut ``df`` by ``keys`` into as many ranges as a shuffle has partitions; none if it is small."""
    parts = max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    most = max(SMALL, PER_RANGE * parts)
    sample = df.select(*keys).orderBy(F.rand(7)).limit(most)
    # Sorted by Spark: its order of nulls and strings is the one that counts.
    found = [tuple(r) for r in sample.orderBy(*keys).collect()]
    if len(found) < SMALL:
        return []
    cut = [found[k * len(found) // parts] for k in range(1, parts)]
    return [b for b, before in zip(cut, [None, *cut], strict=False) if b != before]


def number(df: DataFrame, keys: list[str], cuts: list[tuple]) -> Column:
    """The range of a row, from 0: how many bounds are at most its keys. Looked up in two steps."""
    if not cuts:
        return F.lit(0)
    types = [df.schema[k].dataType for k in keys]
    here = F.struct(*[F.col(k) for k in keys])

    def place(b: tuple) -> Column:
        return F.struct(*[F.lit(v).cast(t).alias(k) for v, t, k in zip(b, types, keys, strict=True)])

    wide = math.isqrt(len(cuts) - 1) + 1
    groups = [cuts[k : k + wide] for k in range(0, len(cuts), wide)]
    heads = F.array(*[place(g[0]) for g in groups])
    inner = F.array(*[F.array(*[place(b) for b in g]) for g in groups])
    group = F.size(F.filter(heads, lambda b: b <= here))
    fine = F.size(F.filter(F.element_at(inner, F.greatest(group, F.lit(1))), lambda b: b <= here))
    return F.when(group == 0, F.lit(0)).otherwise((group - 1) * wide + fine)
