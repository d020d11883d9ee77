"""Box arithmetic as Column expressions: ratio, margins, rescaling, patterns, vetoes.

A box is struct<x:int,y:int,w:int,h:int>; a face is struct<bbox:box,chin_y:int,confidence:double>.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SIDES = ("top", "bottom", "left", "right")
TOLERANCE = 0.15


def box(x: Column, y: Column, w: Column, h: Column) -> Column:
    return F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"), w.cast("int").alias("w"), h.cast("int").alias("h"))


# fixed values: named ratios, first match wins
RATIOS = ((0.75, "3:4 (Retrato Cédula)"), (1.0, "1:1 (Cuadrado)"), (0.8, "4:5 (Foto Estudio)"), (1.33, "4:3 (Paisaje)"))


def ratio_label(width: Column, height: Column) -> Column:
    """The name of the first ratio that is less than 0.05 away, else width and height."""
    near = F.filter(F.array(*(F.struct(F.lit(r).alias("r"), F.lit(n).alias("n")) for r, n in RATIOS)), lambda x: F.abs(width / height - x["r"]) < 0.05)
    return F.coalesce(F.get(near, F.lit(0))["n"], F.concat(width.cast("int").cast("string"), F.lit(":"), height.cast("int").cast("string"), F.lit(" (Otro)")))


def fit_ratio(b: Column, rw: float, rh: float, inside: Column, face: Column | None = None) -> Column:
    """The box trimmed to the ratio ``rw:rh``, kept within ``inside``.

    Too wide: the width shrinks about the face's centre, else the box's; too high: the
    height shrinks below some headroom over the face, else about the box's centre.
    """
    target = rw / rh
    cur = b["w"] / b["h"]
    clamp = lambda v, lo, hi: F.greatest(lo, F.least(v, hi))
    nw = F.least(inside["w"], F.greatest(F.lit(1), F.bround(b["h"] * F.lit(target)).cast("int")))
    nh = F.least(inside["h"], F.greatest(F.lit(1), F.bround(b["w"] / F.lit(target)).cast("int")))
    mid_x, mid_y = b["x"] + F.floor((b["w"] - nw) / 2), b["y"] + F.floor((b["h"] - nh) / 2)
    if face is not None:
        f = face["bbox"]
        mid_x = F.when(face.isNotNull(), f["x"] + F.floor(f["w"] / 2) - F.floor(nw / 2)).otherwise(mid_x)
        mid_y = F.when(face.isNotNull(), F.greatest(F.lit(0), f["y"] - F.greatest(F.lit(15), F.floor(f["h"] * 0.15)))).otherwise(mid_y)
    wide = box(clamp(mid_x, inside["x"], inside["x"] + inside["w"] - nw), b["y"], nw, b["h"])
    high = box(b["x"], clamp(mid_y, inside["y"], inside["y"] + inside["h"] - nh), b["w"], nh)
    as_is = (b["w"] <= 0) | (b["h"] <= 0) | (F.abs(cur - target) < 1e-3)
    return F.when(as_is, b).when(cur > target, wide).otherwise(high)


def face_violation(b: Column, face: Column, width: Column, height: Column, margin: int = 15) -> Column:
    """Which edge of the crop comes too close to the face, first one found; null if none or no face."""
    f = face["bbox"]
    bottom, right = b["y"] + b["h"], b["x"] + b["w"]
    return (
        F.when(face.isNull(), None)
        .when((bottom < height) & (bottom < face["chin_y"] + max(margin, 10)), "bottom")
        .when((b["y"] > 0) & (b["y"] > F.greatest(F.lit(0), f["y"] - margin)), "top")
        .when((b["x"] > 0) & (b["x"] > F.greatest(F.lit(0), f["x"] - margin)), "left")
        .when((right < width) & (right < f["x"] + f["w"] + margin), "right")
    )


def rescale(b: Column, from_w: Column, from_h: Column, to_w: Column, to_h: Column) -> Column:
    """A thumbnail's box on the original, rounding half to even."""
    sx, sy = to_w / from_w, to_h / from_h
    return box(F.bround(b["x"] * sx), F.bround(b["y"] * sy), F.bround(b["w"] * sx), F.bround(b["h"] * sy))


def max_disagreement(a: Column, b: Column, width: Column, height: Column) -> Column:
    """The largest difference of two boxes, relative to the image."""
    return F.greatest(F.abs(a["x"] - b["x"]) / width, F.abs(a["y"] - b["y"]) / height, F.abs(a["w"] - b["w"]) / width, F.abs(a["h"] - b["h"]) / height)


def veto(status: Column, disagreement: Column, limit: float = 0.03) -> Column:
    """A second opinion can only turn a crop into a quarantine."""
    return F.when((status == "crop") & (disagreement > limit), "quarantine").otherwise(status)


def pattern(status: Column, b: Column, width: Column, height: Column) -> Column:
    """side -> relative thickness of what was cut away (over 2 px); null unless the status is ok."""
    cut = {"top": (b["y"], height), "bottom": (height - b["y"] - b["h"], height), "left": (b["x"], width), "right": (width - b["x"] - b["w"], width)}
    entries = F.array(*(F.struct(F.lit(s).alias("key"), (px / dim).alias("value"), px.alias("px")) for s, (px, dim) in cut.items()))
    kept = F.transform(F.filter(entries, lambda e: e["px"] > 2), lambda e: F.struct(e["key"], e["value"]))
    return F.when(status == "ok", F.map_from_entries(kept))


def compatible(a: Column, b: Column) -> Column:
    """Both null, or the same sides with thicknesses within the tolerance."""
    same = (F.array_sort(F.map_keys(a)) == F.array_sort(F.map_keys(b))) & F.forall(F.map_keys(a), lambda k: F.abs(F.element_at(a, k) - F.element_at(b, k)) <= TOLERANCE)
    return F.when(a.isNull() | b.isNull(), a.isNull() & b.isNull()).otherwise(same)


def valid_opinion(reply: Column) -> Column:
    """True of a JSON reply with exactly bbox_xywh (4 integers, none negative), kind and confidence in [0, 1]."""
    keys = F.json_object_keys(reply)
    raw = F.get_json_object(reply, "$.bbox_xywh")
    ints = F.regexp_replace(raw, r"\s+", "").rlike(r"^\[[0-9]+,[0-9]+,[0-9]+,[0-9]+\]$")
    kind = F.get_json_object(reply, "$.kind").isin("blackbar", "text", "unknown")
    conf = F.get_json_object(reply, "$.confidence")
    number = conf.rlike(r"^-?[0-9]+(\.[0-9]+)?([eE][+-]?[0-9]+)?$") & conf.try_cast("double").between(0, 1)
    return F.coalesce((F.array_sort(keys) == F.array(F.lit("bbox_xywh"), F.lit("confidence"), F.lit("kind"))) & ints & kind & number, F.lit(False))


# fixed values: folders and prefixes of copies that hold no personal data
TEST_FOLDERS = ("tests", "test", "out", "fixtures", "synthetic", "sample")
TEST_PREFIXES = ("test_", "sample_", "synth_", "synthetic_")


def is_test_copy(path: Column) -> Column:
    """True of files that may leave the machine: below a folder of copies, or with such a prefix."""
    parts = F.split(F.lower(path), r"[/\\]+")
    name = F.element_at(parts, -1)
    folders = F.slice(parts, F.lit(1), F.size(parts) - 1)
    prefixed = F.exists(F.array(*(F.lit(x) for x in TEST_PREFIXES)), lambda x: F.startswith(name, x))
    return F.coalesce(F.arrays_overlap(folders, F.array(*(F.lit(x) for x in TEST_FOLDERS))) | prefixed, F.lit(False))


def only_test_copies(rows, path: str = "source"):  # noqa: ANN001, ANN201
    """The rows as they are; a row whose file isn't a test copy fails the job before anything is sent."""
    refused = F.concat(F.lit("not a test copy, refusing to send it: "), F.coalesce(F.col(path), F.lit("null")))
    return rows.withColumn(path, F.when(is_test_copy(F.col(path)), F.col(path)).otherwise(F.raise_error(refused).cast("string")))
