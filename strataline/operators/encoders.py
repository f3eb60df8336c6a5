"""Seams for models: a detector makes rows of images, an encoder makes vectors of crops.

Both are made once in each worker by a factory, and see batches.
"""

from __future__ import annotations

import importlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, StructField, StructType

BATCH = 64
Detector = Callable[[str], tuple[np.ndarray, np.ndarray, np.ndarray]]
Encoder = Callable[[list], np.ndarray]
REGISTRY: dict[str, dict[str, Callable | str]] = {}


def register(family: str, **actions: Callable | str) -> None:
    """Name the train, evaluate and predict functions of a family, each a function or "module:function", which is imported
    when it is first asked for."""
    REGISTRY[family] = actions


def action(family: str, name: str) -> Callable:
    if family not in REGISTRY or name not in REGISTRY[family]:
        raise ValueError(f"unknown family or action {family!r}, {name!r}")
    found = REGISTRY[family][name]
    if isinstance(found, str):
        module, _, function = found.partition(":")
        found = REGISTRY[family][name] = getattr(importlib.import_module(module), function)
    return found


def detections(images: DataFrame, factory: Callable[[], Detector], categories: list[int]) -> DataFrame:
    """One row per detection of images (image_id, path): category, box as x, y, w, h, and score.

    Boxes come as corners. Arrays of unequal length raise.
    """
    lone = categories[0] if len(categories) == 1 and categories[0] else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        detect = factory()
        for pdf in batches:
            rows = []
            for image_id, path in zip(pdf["image_id"], pdf["path"], strict=True):
                boxes, scores, classes = detect(path)
                for (x1, y1, x2, y2), score, c in zip(boxes, scores, classes, strict=True):
                    rows.append((image_id, lone or int(c) + 1, float(x1), float(y1), float(x2 - x1), float(y2 - y1), float(score)))
            yield pd.DataFrame(rows, columns=["image_id", "category_id", "x", "y", "w", "h", "score"])

    return images.select("image_id", "path").mapInPandas(run, "image_id bigint, category_id bigint, x double, y double, w double, h double, score double")


def register_detector(spark: SparkSession, name: str, factory: Callable[[], Detector], categories: list[int]) -> None:
    """A table function for SQL: ``SELECT ... FROM images, LATERAL name(path)`` gives category_id, x, y, w, h and score
    of each detection, as detections() does. The detector is made once in each task. Rows go to and fro in batches
    without Arrow, which would make a table for each image."""
    lone = categories[0] if len(categories) == 1 and categories[0] else None

    class Detected:
        def __init__(self) -> None:
            self.detect = factory()

        def eval(self, path: str) -> Iterator[tuple]:
            boxes, scores, classes = self.detect(path)
            for (x1, y1, x2, y2), score, c in zip(boxes, scores, classes, strict=True):
                yield lone or int(c) + 1, float(x1), float(y1), float(x2 - x1), float(y2 - y1), float(score)

    kind = "category_id bigint, x double, y double, w double, h double, score double"
    spark.udtf.register(name, F.udtf(Detected, returnType=kind, useArrow=False))


def _unit(v: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(v, axis=1, keepdims=True)
    return (v / np.where(length == 0, 1, length)).astype(np.float32)


def embedded(crops: DataFrame, factory: Callable[[], Encoder], source: str = "content", to: str = "embedding", mirror: bool = False, size: int = BATCH) -> DataFrame:
    """``crops`` with unit vectors. With ``mirror`` the encoder is asked for (items, mirrored) too and both are added."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encode = factory()
        for pdf in batches:
            items, found = pdf[source].tolist(), []
            for k in range(0, len(items), size):
                part = items[k : k + size]
                v = np.asarray(encode(part), np.float64)
                if mirror:
                    v = v + np.asarray(encode([mirrored(x) for x in part]), np.float64)
                found += list(_unit(v))
            yield pdf.assign(**{to: found})

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in crops.schema.fields)
    return crops.mapInPandas(run, f"{fields}, `{to}` array<float>")


def extracted(images: DataFrame, decoder: Callable, transform: Callable, module: Callable[[], Encoder], path: str, key: str = "path", parts: int = 16) -> DataFrame:
    """``images`` (key, content, ...) with the unit vectors that a module gives of their transformed pixels, written to
    ``path`` in as many parts by hash of the key; a part that an earlier run has finished is kept as it is.

    ``decoder`` and ``transform`` are those of images.tensors(), and ``module`` makes a function of batches of arrays
    (channel, height, width). An image that cannot be decoded has no vector.
    """
    from strataline.sources.images import HELD
    from strataline.sources.tables import exists

    kept = [c for c in images.columns if c != "content"]
    schema = StructType([*[images.schema[c] for c in kept], StructField("embedding", ArrayType(FloatType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """At most BATCH images are pixels at a time, and some 8 MB of vectors wait."""
        decode, change, encode = decoder(), transform(), module()
        for batch in batches:
            contents, keys = batch.column("content"), batch.column(key)
            taken, pixels, vectors, held = [], [], [], 0
            for k in range(batch.num_rows):
                data = contents[k].as_py()
                image = None if data is None else decode(data)
                if image is not None:
                    taken.append(k)
                    pixels.append(np.asarray(change(image, str(keys[k].as_py())), np.float32))
                if pixels and (len(pixels) == BATCH or k + 1 == batch.num_rows):
                    vectors.append(_unit(np.asarray(encode(np.stack(pixels)), np.float64)))
                    held, pixels = held + vectors[-1].nbytes, []
                if taken and not pixels and (held >= HELD or k + 1 == batch.num_rows):
                    v = np.concatenate(vectors)
                    ends = pa.array(np.arange(len(v) + 1) * v.shape[1], pa.int32())
                    some = batch.take(pa.array(taken, pa.int64()))
                    yield pa.RecordBatch.from_arrays([*[some.column(c) for c in kept], pa.ListArray.from_arrays(ends, pa.array(v.ravel()))], schema.names)
                    taken, vectors, held = [], [], 0

    dealt = images.withColumn("__part", F.pmod(F.xxhash64(key), F.lit(parts)))
    for part in range(parts):
        to = f"{path.rstrip('/')}/part={part}"
        if exists(images.sparkSession, f"{to}/_SUCCESS"):  # left when all of a part is written
            continue
        rows = dealt.filter(F.col("__part") == part).select(*kept, "content")
        rows.mapInArrow(run, schema).write.mode("overwrite").parquet(to)
    return images.sparkSession.read.option("basePath", path).parquet(path).drop("part")


def mirrored(item):
    """An item turned left to right: arrays by their second axis, others as they are."""
    return item[:, ::-1] if isinstance(item, np.ndarray) and item.ndim > 1 else item


def crops_by_frame(frames: DataFrame, specs: DataFrame) -> DataFrame:
    """The planned crops of the frames that are decoded: frames (video, frame, ...) with their specs."""
    return frames.join(specs, ["video", "frame"])


def count_of_detections(rows: DataFrame) -> DataFrame:
    """All detections of images that hold arrays of boxes."""
    return rows.agg(F.coalesce(F.sum(F.size("boxes")), F.lit(0)).cast("bigint").alias("detections"))
