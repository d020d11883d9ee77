"""Pixels to a narrow profile row: the only place where Python sees an image.

Every side is looked at through the same window: the raster is turned (a view,
no copy) so that the side's edge is line 0 and lines run inward. What needs
pixels is measured here, per side, in one pass; every gate and the decision are
Column expressions in ``decide``.

Float32 luma (Rec. 709) and the grid's exposure anchors follow the data model.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from orilla.operators.faces import FACE, head

# fixed values of the detector
DARK, STRICT, BRIGHT = 48 / 255, 16 / 255, 0.60
WEIGHTS = np.array([0.2126, 0.7152, 0.0722], np.float32)
LINE_DARK, WALK_DARK = 0.85, 0.55
EXPOSURE_TRIGGER = 0.55
MARGIN = 5
SIDES = ("top", "bottom", "left", "right")
CELLS, MOST = 6, 400
CHUNK = 256

SIDE = "struct<run:int,t_glyph:int,mean_dark:double,mean_strict:double,contrast:double,shoulder:double,content_hit:boolean>"
CHECK = "struct<dark:array<float>,bright:array<float>>"
#: what the decision needs of an image, and what a frozen pattern is checked on
DETECTION = f"width int, height int, luma_mean double, bright_frac double, candidates map<string,{SIDE}>"
FROZEN = f"frozen_step int, frozen_luma_mean double, frozen_bright_frac double, frozen_lines map<string,{CHECK}>"
PROFILE = f"{DETECTION}, {FROZEN}, face {FACE}"


COLUMNS = ("width", "height", "luma_mean", "bright_frac", "candidates", "frozen_step", "frozen_luma_mean", "frozen_bright_frac", "frozen_lines", "face")


def luma(rgb: np.ndarray) -> np.ndarray:
    return rgb.astype(np.float32) @ WEIGHTS / 255.0


def anchors(grid: np.ndarray) -> tuple[float, float] | None:
    """The 2nd and 98th percentile of an under-exposed grid; None if it is bright enough."""
    n = grid.size
    # the value below the 98th percentile is bright enough: nothing needs to be put in order
    if not n or np.count_nonzero(grid >= EXPOSURE_TRIGGER) > n - int(0.98 * (n - 1)):
        return None
    lo, hi = (float(x) for x in np.percentile(grid, (2, 98)))
    return None if hi >= EXPOSURE_TRIGGER or hi - lo < 1e-3 else (lo, hi)


def stretch(grid: np.ndarray, ends: tuple[float, float] | None) -> np.ndarray:
    return grid if ends is None else np.clip((grid - ends[0]) / (ends[1] - ends[0]), 0.0, 1.0)


def turned(rgb: np.ndarray, side: str) -> np.ndarray:
    """A view whose line 0 is the side's edge."""
    if side in ("left", "right"):
        rgb = rgb.swapaxes(0, 1)
    return rgb[::-1] if side in ("bottom", "right") else rgb


def line_profile(lines: np.ndarray, ends: tuple[float, float] | None) -> dict[str, np.ndarray]:
    """Per line: share of dark and of near-black pixels, and mean luma; in chunks."""
    n = len(lines)
    out = {k: np.empty(n, np.float32) for k in ("dark", "strict", "mean")}
    for a in range(0, n, CHUNK):
        part = stretch(luma(lines[a : a + CHUNK]), ends)
        out["dark"][a : a + CHUNK] = (part < DARK).mean(1)
        out["strict"][a : a + CHUNK] = (part < STRICT).mean(1)
        out["mean"][a : a + CHUNK] = part.mean(1, dtype=np.float64)
    return out


def all_line_profiles(rgb: np.ndarray, ends: tuple[float, float] | None, light: np.ndarray | None = None) -> dict[str, dict[str, np.ndarray]]:
    """``line_profile`` of all lines ("rows") and all columns ("cols"); every pixel is looked at once, in chunks.

    light: the stretched luma, where it is known.
    """
    height, width = rgb.shape[:2]
    rows = {k: np.empty(height, np.float32) for k in ("dark", "strict", "mean")}
    cols = {k: np.zeros(width) for k in rows}
    for a in range(0, height, CHUNK):
        part = stretch(luma(rgb[a : a + CHUNK]), ends) if light is None else light[a : a + CHUNK]
        for k, below in (("dark", DARK), ("strict", STRICT)):
            flags = part < below
            rows[k][a : a + CHUNK] = np.count_nonzero(flags, 1) / width
            cols[k] += np.count_nonzero(flags, 0)
        rows["mean"][a : a + CHUNK] = part.sum(1, dtype=np.float64) / width
        cols["mean"] += part.sum(0, dtype=np.float64)
    return {"rows": rows, "cols": {k: (v / height).astype(np.float32) for k, v in cols.items()}}


def leading(flags: np.ndarray) -> int:
    """How many flags are true from the start on."""
    return int(len(flags) if flags.all() else np.argmin(flags))


def share(flags: np.ndarray) -> float:
    """The share of true flags: their mean, without turning them into numbers."""
    return float(np.count_nonzero(flags) / flags.size) if flags.size else float("nan")


def contacts(mask: np.ndarray, corners: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The horizontal runs (y, first x, last x) of a mask, and the pairs (above, below) of runs that touch.

    Runs are in reading order, so those that a run touches above are a contiguous range: a band
    join of neighbouring lines inside the row.
    """
    # one after another, with a gap behind each line: beginnings and ends take turns
    height, apart = mask.shape[0], mask.shape[1] + 1
    flat = np.zeros(height * apart + 1, bool)
    flat[1:].reshape(height, apart)[:, :-1] = mask
    turn = np.flatnonzero(flat[1:] != flat[:-1])
    y = turn[::2] // apart
    x0, x1 = turn[::2] - y * apart, turn[1::2] - 1 - y * apart
    width, reach = apart + 1, int(corners)
    lo = np.searchsorted(y * width + x1, (y - 1) * width + x0 - reach, "left")
    hi = np.searchsorted(y * width + x0, (y - 1) * width + x1 + reach, "right")
    count = np.maximum(hi - lo, 0)
    above = np.repeat(lo - (np.cumsum(count) - count), count) + np.arange(count.sum())
    return y, x0, x1, above, np.repeat(np.arange(len(y)), count)


def region_boxes(mask: np.ndarray, corners: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(x, y, w, h) and the number of pixels of each connected region, by its first run.

    Of two labels that touch the greater one becomes the lesser one, with pointer jumping, until
    runs that touch bear one label each.
    """
    y, x0, x1, above, below = contacts(mask, corners)
    label = np.arange(len(y))
    one, other = above, below
    while len(one):
        np.minimum.at(label, np.maximum(one, other), np.minimum(one, other))
        while ((further := label[label]) != label).any():
            label = further
        one, other = label[above], label[below]
        apart = one != other
        one, other = one[apart], other[apart]
    # a region's first run bears its own number, and is in its first line
    first = label == np.arange(len(label))
    root, of = np.flatnonzero(first), (np.cumsum(first) - 1)[label]
    far = max(mask.shape, default=0) + 1
    left, right, bottom = (np.full(len(root), v) for v in (far, -1, -1))
    np.minimum.at(left, of, x0)
    np.maximum.at(right, of, x1)
    np.maximum.at(bottom, of, y)
    top = y[root]
    return np.stack([left, top, right - left + 1, bottom - top + 1], 1), np.bincount(of, x1 - x0 + 1, minlength=len(root)).astype(np.int64)


def regions(mask: np.ndarray) -> np.ndarray:
    """(x, y, w, h) of the 8-connected regions whose box has enough cells, by (y, x)."""
    out = region_boxes(mask)[0]
    out = out[out[:, 2] * out[:, 3] >= CELLS]
    return out[np.lexsort((out[:, 0], out[:, 1]))][:MOST]


def kinds(boxes: np.ndarray, width: int, height: int) -> tuple[np.ndarray, np.ndarray]:
    """Which regions are glyphs, which are content; the rest is noise."""
    w, h = boxes[:, 2], boxes[:, 3]
    glyph = (w >= 8) & (h >= 8) & (w <= 0.30 * width) & (h <= 0.15 * height)
    return boxes[glyph], boxes[~glyph & (w >= 12) & (h >= 12)]


def spans(boxes: np.ndarray, side: str, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """How far from the edge boxes begin and end."""
    k = 1 if side in ("top", "bottom") else 0
    a, z = boxes[:, k], boxes[:, k] + boxes[:, k + 2]
    return (dim - z, dim - a) if side in ("bottom", "right") else (a, z)


def hits(content: np.ndarray, side: str, dim: int, lo: int, hi: int) -> bool:
    """Does content reach more than 4 px into the strip?"""
    a, z = spans(content, side, dim)
    return bool((np.minimum(z, hi) - np.maximum(a, lo) > 4).any())


def side_candidate(rgb: np.ndarray, side: str, ends: tuple[float, float] | None, grid: dict) -> dict | None:
    """What the gates need to know of one side; None without any bar line."""
    far_side = side in ("bottom", "right")
    p = grid["lines"]["rows" if side in ("top", "bottom") else "cols"]
    dim = len(p["dark"])
    depth = max(1, min(int(0.35 * dim), 480))
    extra = min(int(0.25 * dim), 600)
    if p["dark"][-1 if far_side else 0] < LINE_DARK:
        return None
    if far_side:
        p = {k: v[::-1].copy() for k, v in p.items()}
    solid = leading(p["dark"] >= LINE_DARK)
    run = min(solid, depth)
    while run + extra > depth and depth < dim:
        depth = min(max(run + extra, 2 * depth), dim)
        run = min(solid, depth)
    inner, after = p["mean"][run : min(dim, 2 * run)], p["dark"][run : run + 3]
    out = {
        "run": run, "t_glyph": None, "mean_dark": float(p["dark"][:run].mean()), "mean_strict": float(p["strict"][:run].mean()),
        "contrast": float(inner.mean() - p["mean"][:run].mean()) if len(inner) else None, "shoulder": float(after.mean()) if len(after) else None,
        "content_hit": hits(grid["content"], side, dim, 0, run),
    }
    # the walk: lines that stay mostly dark, their bright pixels not being content's
    if run == depth or p["dark"][run] < WALK_DARK:
        return out
    place = np.arange(run, depth)
    cell = (dim - 1 - place if far_side else place) // grid["step"]
    clear = grid["clear_rows" if side in ("top", "bottom") else "clear_cols"]
    free = np.ones(len(cell), bool)
    known = cell < len(clear)
    free[known] = clear[cell[known]]
    pos = run + leading((p["dark"][run:depth] >= WALK_DARK) & free)
    if pos == run:
        return out
    shift = int(far_side)
    glyphs = grid["glyphs"]
    begin, stop = spans(glyphs, side, dim)
    zone = glyphs[stop <= pos + shift]
    if not len(zone):
        return out
    far = int(stop[stop <= pos + shift].max())
    # at full resolution, within the glyphs' hull
    k = 0 if side in ("top", "bottom") else 1
    h0, h1 = int(zone[:, k].min()), int((zone[:, k] + zone[:, k + 2]).max())
    first = max(0, far - 6 - shift)
    window = stretch(luma(turned(rgb, side)[first : far + 7 - shift, h0:h1]), ends)
    lit = np.flatnonzero((window > BRIGHT).any(1))
    if len(lit):
        far = first + int(lit[-1]) + shift
    lo, hi = (dim - far, dim - run) if far_side else (run, far)
    a = lo // grid["step"]
    z = max(a + 1, hi // grid["step"])
    strip = grid["dark"][a:z] if side in ("top", "bottom") else grid["dark"][:, a:z]
    if far >= run - MARGIN and strip.size and float(strip.mean()) >= 0.5 and not hits(grid["content"], side, dim, run, far):
        t = far + MARGIN
        if t <= 0.9 * dim:
            out["t_glyph"] = max(t, run)
    return out


def detection(rgb: np.ndarray, sides: tuple[str, ...] = SIDES) -> dict:
    """DETECTION of an H x W x 3 raster."""
    height, width = rgb.shape[:2]
    step = max(1, max(height, width) // 500)
    grid = luma(rgb[::step, ::step])
    ends = anchors(grid)
    grid = stretch(grid, ends)
    bright = grid > BRIGHT
    glyphs, content = kinds(regions(bright) * step, width, height)
    rows, cols = bright.any(1), bright.any(0)
    clear_rows, clear_cols = np.ones(len(rows), bool), np.ones(len(cols), bool)
    for x, y, w, h in content.tolist():
        clear_rows[y // step : (y + h) // step + 1] &= ~rows[y // step : (y + h) // step + 1]
        clear_cols[x // step : (x + w) // step + 1] &= ~cols[x // step : (x + w) // step + 1]
    shared = {"step": step, "dark": grid < DARK, "glyphs": glyphs, "content": content, "clear_rows": clear_rows, "clear_cols": clear_cols, "lines": all_line_profiles(rgb, ends, grid if step == 1 else None)}
    found = {s: c for s in sides if (c := side_candidate(rgb, s, ends, shared)) is not None}
    return {"width": width, "height": height, "luma_mean": float(grid.mean()), "bright_frac": share(bright), "candidates": found}


def frozen(rgb: np.ndarray) -> dict:
    """FROZEN of an H x W x 3 raster."""
    height, width = rgb.shape[:2]
    fine = max(1, max(height, width) // 2000)
    check = luma(rgb[::fine, ::fine])
    check = stretch(check, anchors(check))
    dark, lit = check < DARK, check > BRIGHT
    lines = {"rows": {"dark": dark.mean(1).astype(np.float32).tolist(), "bright": lit.mean(1).astype(np.float32).tolist()}, "cols": {"dark": dark.mean(0).astype(np.float32).tolist(), "bright": lit.mean(0).astype(np.float32).tolist()}}
    return {"frozen_step": fine, "frozen_luma_mean": float(check.mean()), "frozen_bright_frac": float(lit.mean()), "frozen_lines": lines}


def profile(rgb: np.ndarray, sides: tuple[str, ...] = SIDES) -> dict:
    """The profile row of an H x W x 3 raster."""
    return {**detection(rgb, sides), **frozen(rgb), "face": head(rgb)}


def to_rgb(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """RGB of the JVM decoder's BGR, BGRA (laid over white) or grey bytes."""
    a = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    if channels == 1:
        return np.repeat(a, 3, 2)
    rgb = a[:, :, 2::-1]
    if channels == 4:
        alpha = a[:, :, 3:].astype(np.float32) / 255
        rgb = (rgb * alpha + 255 * (1 - alpha) + 0.5).astype(np.uint8)
    return rgb


def upright(rgb: np.ndarray, orientation: int) -> np.ndarray:
    """The raster as its EXIF orientation (1 to 8) wants it shown."""
    if orientation in (5, 6, 7, 8):
        rgb = rgb.swapaxes(0, 1)
    if orientation in (2, 3, 6, 7):
        rgb = rgb[:, ::-1]
    if orientation in (3, 4, 7, 8):
        rgb = rgb[::-1]
    return rgb


def profile_images(images: DataFrame, key: str = "source", image: str = "image", sides: tuple[str, ...] = SIDES) -> DataFrame:
    """key and profile of (key, image struct) rows; pixels don't leave the scan's task."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for k, h, w, c, d, o in zip(f["key"], f["height"], f["width"], f["channels"], f["data"], f["orientation"]):
                rows.append({"key": k, **profile(upright(to_rgb(d, h, w, c), o), sides)})
            yield pd.DataFrame(rows, columns=["key", *COLUMNS])

    orientation = "orientation" if "orientation" in images.columns else "1"

    flat = images.selectExpr(f"{key} AS key", f"{image}.height AS height", f"{image}.width AS width", f"{image}.nChannels AS channels", f"{image}.data AS data", f"{orientation} AS orientation")
    return flat.mapInPandas(run, f"key string, {PROFILE}").withColumnRenamed("key", key)
