"""Crop names: identity, camera, sequence and frame written into and read from a file name."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from strataline.schema import JUNK

NAME = r"^(-?[0-9]+)_c([0-9]+)"


def crop_name(pid: Column, cam: Column, sequence: Column, frame: Column) -> Column:
    """``<pid>_c<cam>_s<seq:02>_f<frame:06>.jpg``"""
    return F.format_string("%d_c%d_s%02d_f%06d.jpg", pid.cast("bigint"), cam.cast("bigint"), sequence.cast("bigint"), frame.cast("bigint"))


def is_parsable(name: Column) -> Column:
    return F.coalesce(name.rlike(NAME), F.lit(False))


def pid_of(name: Column) -> Column:
    """Identity in a name; null where the name has none."""
    return F.when(is_parsable(name), F.regexp_extract(name, NAME, 1).try_cast("bigint"))


def cam_of(name: Column) -> Column:
    return F.when(is_parsable(name), F.regexp_extract(name, NAME, 2).try_cast("bigint"))


def stem(name: Column) -> Column:
    return F.regexp_replace(name, r"\.[^.]+$", "")


def suffix(name: Column) -> Column:
    """Suffix with its dot, in the case it has; empty without one."""
    return F.regexp_extract(name, r"(\.[^.]+)$", 1)


def has_suffix(name: Column, suffixes: tuple[str, ...]) -> Column:
    return F.lower(suffix(name)).isin([s.lower() for s in suffixes])


def combined_name(pid: Column, cam: Column, tag: Column, name: Column) -> Column:
    """``<pid>_c<cam>_<tag>_<stem>.jpg``; the suffix is .jpg whatever the input's was."""
    return F.concat(pid.cast("string"), F.lit("_c"), cam.cast("string"), F.lit("_"), tag, F.lit("_"), stem(name), F.lit(".jpg"))


def remapped_pid(pid: Column, offset: Column) -> Column:
    """Junk stays junk; other identities are moved by the offset."""
    return F.when(pid == JUNK, F.lit(JUNK).cast("bigint")).otherwise(pid + offset)
