"""The decision: gates, assembly and confidence over a profile row, all in Catalyst."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orilla.functions.boxes import SIDES, box, face_violation

DETECTION = ("status", "crop_box", "sides", "method", "confidence", "quarantine_reason", "face_safety_ok")


def uniform_dark(mean: Column, bright: Column) -> Column:
    return (mean < 0.15) & (bright < 0.005)


def _gate(c: Column, dim: Column) -> Column:
    """The gates of one side, in the order of their cost in the cascade."""
    evidence = (c["mean_strict"] >= 0.5) | ((c["contrast"] >= 0.18) & (c["shoulder"] < 0.3))
    deep = (c["run"] <= 0.2 * dim) | (c["mean_strict"] >= 0.15)
    return F.coalesce((c["run"] >= F.greatest(F.lit(3), F.floor(dim * 0.004))) & (c["run"] <= 0.5 * dim) & evidence & deep & ~c["content_hit"], F.lit(False))


def decide(profiles: DataFrame, allowed: tuple[str, ...] = SIDES) -> DataFrame:
    """Adds the detection's columns to profile rows."""
    w, h = F.col("width"), F.col("height")
    dims = {"top": h, "bottom": h, "left": w, "right": w}
    cand = {s: F.element_at("candidates", F.lit(s)) for s in SIDES}
    ok = {s: _gate(cand[s], dims[s]) if s in allowed else F.lit(False) for s in SIDES}
    cut = {s: F.when(ok[s], F.coalesce(cand[s]["t_glyph"], cand[s]["run"])).otherwise(0) for s in SIDES}
    df = profiles.select("*", *(ok[s].alias(f"_ok_{s}") for s in SIDES), *(cut[s].alias(f"_cut_{s}") for s in SIDES))
    any_side = reduce(Column.__or__, (F.col(f"_ok_{s}") for s in SIDES))
    new_w, new_h = w - F.col("_cut_left") - F.col("_cut_right"), h - F.col("_cut_top") - F.col("_cut_bottom")
    fits = (new_w >= 1) & (new_h >= 1)
    dark = uniform_dark(F.col("luma_mean"), F.col("bright_frac"))
    crop = any_side & fits
    most = crop & (1 - new_w * new_h / (w * h) > 0.5)
    glyphs = reduce(Column.__or__, (F.col(f"_ok_{s}") & cand[s]["t_glyph"].isNotNull() for s in SIDES))
    worst = F.least(*(F.when(F.col(f"_ok_{s}"), cand[s]["mean_dark"]) for s in SIDES))
    conf = F.bround(F.least(F.lit(1.0), (0.6 + 0.4 * worst) * F.when(glyphs, 0.92).otherwise(1.0)), 3)
    status = F.when(dark, "quarantine").when(~crop, "noop").when(most, "quarantine").otherwise("crop")
    whole = box(F.lit(0), F.lit(0), w, h)
    df = df.withColumn("status", status)
    is_crop = F.col("status") == "crop"
    return (
        df.withColumn("crop_box", F.when(is_crop, box(F.col("_cut_left"), F.col("_cut_top"), new_w, new_h)).otherwise(whole))
        .withColumn("sides", F.when(is_crop, F.filter(F.array(*(F.when(F.col(f"_ok_{s}"), F.lit(s)) for s in SIDES)), lambda s: s.isNotNull())).otherwise(F.array().cast("array<string>")))
        .withColumn("method", F.when(dark, "none").when(is_crop & glyphs, "projection+glyphs").otherwise("projection"))
        .withColumn("confidence", F.when(is_crop, conf).otherwise(0.0))
        .withColumn("quarantine_reason", F.when(dark, "uniform_dark_image").when(F.col("status") == "quarantine", "crop_removes_majority"))
        .withColumn("face_safety_ok", F.col("status") != "quarantine")
        .drop(*(f"_ok_{s}" for s in SIDES), *(f"_cut_{s}" for s in SIDES))
    )


def frozen_check(width: Column, height: Column, step: Column, mean: Column, bright: Column, lines: Column, thickness: Column) -> Column:
    """A frozen pattern's verdict on an image: struct<status, crop_box, reason>; null where it doesn't verify.

    thickness: map side -> relative thickness. An empty map is a noop pattern. The strips'
    means are means over line profiles, as all lines are equally long.
    """
    dims = {"top": height, "bottom": height, "left": width, "right": width}
    t = {s: F.coalesce(F.bround(F.element_at(thickness, F.lit(s)) * dims[s]).cast("int"), F.lit(0)) for s in SIDES}
    has = {s: F.map_contains_key(thickness, F.lit(s)) for s in SIDES}
    new_w, new_h = width - t["left"] - t["right"], height - t["top"] - t["bottom"]

    def strip(s: str, what: str) -> Column:
        own = F.element_at(lines, F.lit("rows" if s in ("top", "bottom") else "cols"))[what]
        if s in ("top", "left"):
            part = F.slice(own, F.lit(1), F.greatest(F.lit(1), F.floor(t[s] / step).cast("int")))
        else:
            start = F.floor((dims[s] - t[s]) / step).cast("int")
            part = F.slice(own, start + 1, F.greatest(F.size(own) - start, F.lit(0)))
        return F.aggregate(part, F.lit(0.0), lambda a, x: a + x) / F.size(part)

    good = reduce(Column.__and__, (~has[s] | ((t[s] > 0) & (strip(s, "dark") >= 0.5) & (strip(s, "bright") <= 0.10)) for s in SIDES))
    positive = reduce(Column.__and__, (~has[s] | (t[s] > 0) for s in SIDES))
    whole = box(F.lit(0), F.lit(0), width, height)
    verdict = lambda status, b, reason: F.struct(F.lit(status).alias("status"), b.alias("crop_box"), F.lit(reason).cast("string").alias("reason"))
    return (
        F.when(thickness.isNull(), None)
        .when(F.size(thickness) == 0, verdict("noop", whole, None))
        .when(~positive | (new_w < 1) | (new_h < 1), None)
        .when(1 - new_w * new_h / (width * height) > 0.5, verdict("quarantine", whole, "crop_removes_majority"))
        .when(uniform_dark(mean, bright), verdict("quarantine", whole, "uniform_dark_image"))
        .when(good, verdict("crop", box(t["left"], t["top"], new_w, new_h), None))
    )


def face_gate(decided: DataFrame) -> DataFrame:
    """A crop that comes too close to the face goes to quarantine; adds face_detected."""
    bad = F.when(F.col("status") == "crop", face_violation(F.col("crop_box"), F.col("face"), F.col("width"), F.col("height")))
    out = decided.withColumn("_bad", bad).withColumn("face_detected", (F.col("status") == "crop") & F.col("face").isNotNull())
    return (
        out.withColumn("status", F.when(F.col("_bad").isNotNull(), "quarantine").otherwise(F.col("status")))
        .withColumn("quarantine_reason", F.when(F.col("_bad").isNotNull(), F.concat(F.lit("face_safety_violation: "), F.col("_bad"))).otherwise(F.col("quarantine_reason")))
        .withColumn("face_safety_ok", F.col("face_safety_ok") & F.col("_bad").isNull())
        .drop("_bad")
    )
