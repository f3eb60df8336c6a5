"""Names and row types that the rest of the library shares."""

from __future__ import annotations

#: Identity of distractors; it is a value of its own, never null, and never remapped.
JUNK = -1
TRAIN, QUERY, GALLERY = "bounding_box_train", "query", "bounding_box_test"
SPLITS = (TRAIN, QUERY, GALLERY)
TRACK_BOX = "frame bigint, tid bigint, x double, y double, w double, h double, vis double, cls int"
CROP = "path string, pid bigint, camid bigint"
MANIFEST = ("file", "split", "source", "pid", "camid", "orig_pid", "orig_camid", "orig_file")
EPS = 1e-9
