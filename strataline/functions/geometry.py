"""Boxes: acceptance floors, crop rectangles, overlaps."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


def _known(c: Column) -> Column:
    """Comparisons with NaN are false; Spark alone would order NaN above all numbers."""
    return ~F.isnan(c)


@dataclass(frozen=True)
class CropFloors:
    """What a box must have to be worth cropping; a floor of 0 is off."""

    min_w: float = 32
    min_h: float = 80
    min_visibility: float = 0.65
    edge_margin: float = 2
    frame_w: float = 1920
    frame_h: float = 1080

    def too_small(self, w: Column, h: Column) -> Column:
        return (_known(w) & (w < self.min_w)) | (_known(h) & (h < self.min_h))

    def too_hidden(self, vis: Column) -> Column:
        return _known(vis) & (vis < self.min_visibility)

    def at_edge(self, x: Column, y: Column, w: Column, h: Column) -> Column:
        if self.edge_margin <= 0:
            return F.lit(False)
        m = self.edge_margin
        right, bottom = x + w, y + h
        return (_known(x) & (x <= m)) | (_known(y) & (y <= m)) | (_known(right) & (right >= self.frame_w - m)) | (_known(bottom) & (bottom >= self.frame_h - m))

    def accepts(self, x: Column, y: Column, w: Column, h: Column, vis: Column) -> Column:
        return ~(self.too_small(w, h) | self.too_hidden(vis) | self.at_edge(x, y, w, h))


def is_degenerate(w: Column, h: Column, min_w: int = 24, min_h: int = 64) -> Column:
    return (h < min_h) | (w < min_w)


def crop_rectangle(x: Column, y: Column, w: Column, h: Column, image_w: int, image_h: int, pad: float = 0.08) -> list[Column]:
    """left, top, right, bottom of a padded box, truncated and clamped to the image; empty if outside."""
    pw, ph = w * pad, h * pad

    def whole(c: Column) -> Column:
        return c.cast("bigint")

    left, top = F.greatest(F.lit(0), whole(x - pw)), F.greatest(F.lit(0), whole(y - ph))
    right, bottom = F.least(F.lit(image_w), whole(x + w + pw)), F.least(F.lit(image_h), whole(y + h + ph))
    return [left.alias("left"), top.alias("top"), F.greatest(left, right).alias("right"), F.greatest(top, bottom).alias("bottom")]


def xywh(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    return F.array(x1, y1, x2 - x1, y2 - y1)


def category_of(class_id: Column, categories: list[int]) -> Column:
    """The only category where there is one and it is not 0; else the class id plus one."""
    if len(categories) == 1 and categories[0] != 0:
        return F.lit(categories[0]).cast("bigint")
    return class_id.cast("bigint") + 1


def iou(a: list[Column], b: list[Column]) -> Column:
    """Overlap of two boxes (x, y, w, h): shared area over the area of both."""
    w = F.greatest(F.lit(0.0), F.least(a[0] + a[2], b[0] + b[2]) - F.greatest(a[0], b[0]))
    h = F.greatest(F.lit(0.0), F.least(a[1] + a[3], b[1] + b[3]) - F.greatest(a[1], b[1]))
    shared = w * h
    both = a[2] * a[3] + b[2] * b[3] - shared
    return F.when(both > 0, shared / both).otherwise(0.0)
