"""Greedy sampling of tracks as their boxes arrive."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame


def keep_stride(boxes: DataFrame, stride: int, keys: tuple[str, ...] = ("sequence", "camera", "tid"), frame: str = "frame") -> DataFrame:
    """As the operator of that name, for boxes that arrive in order of frame in each track.

    The state of a track is its last kept frame. Inside a micro-batch boxes are put in order; a box that
    comes late, in a later batch than a kept one of a higher frame, is within the stride and is not kept.
    """
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in boxes.schema.fields)

    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        last = state.get[0] if state.exists else None
        pdf = pd.concat(list(batches)).sort_values(frame, kind="stable")
        kept = []
        for i, f in enumerate(pdf[frame]):
            if stride <= 0 or last is None or f - last >= stride:
                kept.append(i)
                last = int(f)
        if last is not None:
            state.update((last,))
        yield pdf.iloc[kept]

    return boxes.groupBy(*keys).applyInPandasWithState(step, fields, "last bigint", "append", "NoTimeout")
