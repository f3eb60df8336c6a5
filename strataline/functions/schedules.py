"""Learning rates by epoch, and the rounding used in reports."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def cosine_rate(epoch: Column, base: float, epochs: int, warmup: int) -> Column:
    """Linear warm-up from 1 % of the base, then a cosine over the whole span down to 0.2 %."""
    lowest, start = 0.002 * base, 0.01 * base
    rising = F.lit(start) + epoch * F.lit(base - start) / F.lit(warmup) if warmup else F.lit(base)
    falling = F.lit(lowest) + F.lit(0.5 * (base - lowest)) * (1 + F.cos(F.pi() * epoch / F.lit(epochs)))
    return F.when(epoch < warmup, rising).when(epoch >= epochs, F.lit(lowest)).otherwise(falling)


def step_rate(epoch: Column, iteration: Column, base: float, per_epoch: int, warmup_epochs: int, step: int, gamma: float) -> Column:
    """Linear warm-up by iteration (0-based), else the base times gamma for each full step of epochs (from 1)."""
    warm = warmup_epochs * max(1, per_epoch)
    decayed = F.lit(base) * F.pow(F.lit(gamma), F.floor((epoch - 1) / step))
    return F.when(iteration < warm, F.lit(base) * (iteration + 1) / max(1, warm)).otherwise(decayed)


def percent(part: Column, whole: Column) -> Column:
    return 100.0 * part / F.greatest(whole, F.lit(1))


def one_in(whole: Column, part: Column) -> Column:
    """How many there are for each of the part, rounded half to even, 1 at least."""
    return F.greatest(F.bround(whole / F.greatest(part, F.lit(1)), 0).cast("bigint"), F.lit(1))
