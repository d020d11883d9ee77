"""Probes of single rasters for calibration: line bands, borders, regions, and a per-side summary.

They measure and decide nothing. Regions are found on a grid of at most some 256 cells a side and
given in pixels; ``raster.regions`` does the same for the detector, with its own limits.
"""

from __future__ import annotations

import numpy as np

from orilla.operators import raster
from orilla.operators.faces import head

# fixed values of the probes
GRID, LEAST_AREA = 256, 200
TOP_DARK, TOP_BRIGHT = 8, 12
SCAN_SHARE, SCAN_MOST = 0.35, 480
ANCHOR_SHARE = 0.001
GRAY = (54, 183, 19)  # Rec. 709 weights over 256


def gray_threshold(rgb: np.ndarray, threshold: int = 48) -> tuple[np.ndarray, np.ndarray]:
    """(which pixels are dark, 8-bit gray) by integer luma."""
    gray = (rgb[..., :3].astype(np.uint32) @ np.array(GRAY, np.uint32) >> 8).astype(np.uint8)
    return gray < threshold, gray


def largest(mask: np.ndarray) -> tuple[int, int, int, int] | None:
    """The box of the region with most pixels; the first of several."""
    boxes, area = raster.region_boxes(mask)
    return tuple(boxes[int(area.argmax())].tolist()) if len(area) else None


def _thinned(light: np.ndarray) -> tuple[np.ndarray, int]:
    """The raster's cells on the grid, and how far they are apart."""
    step = max(1, max(light.shape) // GRID)
    return light[::step, ::step], step


def _on_grid(cells: np.ndarray, step: int, least_area: int, most: int) -> list[tuple[int, int, int, int]]:
    """Boxes of the 4-connected regions of a thinned mask, in pixels, the largest boxes first."""
    boxes = raster.region_boxes(cells, corners=False)[0] * step
    area = boxes[:, 2] * boxes[:, 3]
    order = np.argsort(-area, kind="stable")
    return [tuple(boxes[k].tolist()) for k in order if area[k] >= least_area][:most]


def bright_regions(light: np.ndarray, least_area: int = LEAST_AREA) -> list[dict]:
    """The 12 largest bright regions of a luma raster, with the share of bright pixels in their boxes.

    Pixels are compared where they are asked for: on the grid, and in the boxes.
    """
    cells, step = _thinned(light)
    found = _on_grid(cells > raster.BRIGHT, step, least_area, TOP_BRIGHT)
    return [{"bbox_xywh": [x, y, w, h], "bright_frac": round(raster.share(light[y : y + h, x : x + w] > raster.BRIGHT), 4)} for x, y, w, h in found]


def dark_regions(light: np.ndarray, threshold: float = raster.DARK, least_area: int = LEAST_AREA) -> list[dict]:
    """The 8 largest dark regions: fill, mean luma, the borders they touch, and the bright text in them."""
    high, wide = light.shape
    cells, step = _thinned(light)
    out = []
    for x, y, w, h in _on_grid(cells < threshold, step, least_area, TOP_DARK):
        part = np.s_[y : y + h, x : x + w]
        touch = {"top": y == 0, "bottom": y + h >= high - step, "left": x == 0, "right": x + w >= wide - step}
        out.append({"bbox_xywh": [x, y, w, h], "fill_frac": round(raster.share(light[part] < threshold), 4), "mean_luma": round(float(light[part].mean()), 4), "touches": [s for s, yes in touch.items() if yes], "anchor": anchor(light[part], x, y)})
    return out


def anchor(light: np.ndarray, x: int, y: int) -> dict | None:
    """Where the bright pixels of a dark region stand, which may be text; None below a thousandth of it."""
    bright = light > raster.BRIGHT
    if not bright.size or bright.mean() < ANCHOR_SHARE:
        return None
    rows, cols = np.flatnonzero(bright.any(1)), np.flatnonzero(bright.any(0))
    inside = [int(cols[0]), int(rows[0]), int(cols[-1] - cols[0]), int(rows[-1] - rows[0])]
    return {"bbox_xywh_in_region": inside, "bbox_xywh_abs": [x + inside[0], y + inside[1], *inside[2:]], "bright_frac": round(float(bright.mean()), 4)}


def row_bands(rgb: np.ndarray, high: int = 10) -> list[dict]:
    """Mean luma and the shares of near-black, dark and bright pixels of every band of lines."""
    light = raster.luma(rgb)
    return [
        {"y0": a, "y1": min(a + high, len(light)), "mean_luma": round(float(p.mean(dtype=np.float64)), 4), "strict_frac": round(float((p < raster.STRICT).mean()), 4), "dark_frac": round(float((p < raster.DARK).mean()), 4), "bright_frac": round(float((p > raster.BRIGHT).mean()), 4)}
        for a in range(0, len(light), high)
        for p in [light[a : a + high]]
    ]


def interior(light: np.ndarray) -> np.ndarray:
    """The middle half of a raster in both directions."""
    h, w = light.shape
    return light[h // 4 : 3 * h // 4, w // 4 : 3 * w // 4]


def border_side(light: np.ndarray, side: str) -> dict:
    """One side's margin (a twentieth of its depth) and how far its dark lines reach."""
    lines = raster.turned(light, side)
    depth = min(int(min(light.shape) * SCAN_SHARE), SCAN_MOST)
    margin = lines[: max(1, len(lines) // 20)]
    share = {k: (lines[:depth] < t).mean(1) for k, t in (("strict", raster.STRICT), ("dark", raster.DARK))}
    return {
        "side": side, "scan_depth": depth, "edge_strict_frac": round(float((margin < raster.STRICT).mean()), 4), "edge_dark_frac": round(float((margin < raster.DARK).mean()), 4),
        "edge_mean_luma": round(float(margin.mean()), 4), "first_strict_lines": [round(float(v), 3) for v in share["strict"][:20]],
        "strict_run_50": raster.leading(share["strict"] >= 0.5), "strict_run_90": raster.leading(share["strict"] >= 0.9), "dark_run_90": raster.leading(share["dark"] >= 0.9),
    }


def border_probe(rgb: np.ndarray) -> dict:
    """All sides' margins, dark regions with their text, and the interior."""
    light = raster.luma(rgb)
    core = interior(light)
    return {"sides": [border_side(light, s) for s in raster.SIDES], "dark_regions": dark_regions(light), "interior_mean_luma": round(float(core.mean()), 4), "interior_strict_frac": round(float((core < raster.STRICT).mean()), 4)}


def inspect(rgb: np.ndarray) -> dict:
    """Per side the dark run in pixels and as a share, and its first line; the interior's luma; skew (0 without OpenCV) and face.

    Exposure isn't normalised here.
    """
    height, width = rgb.shape[:2]
    sides = {}
    for s in raster.SIDES:
        dim = height if s in ("top", "bottom") else width
        p = raster.line_profile(raster.turned(rgb, s)[: max(1, min(int(SCAN_SHARE * dim), SCAN_MOST))], None)
        run = raster.leading(p["dark"] >= raster.LINE_DARK)
        sides[s] = {"bar_run_px": run, "bar_run_frac": round(run / dim, 4), "first_line_dark_frac": round(float(p["dark"][0]), 4), "first_line_strict_frac": round(float(p["strict"][0]), 4)}
    face = head(rgb)
    return {"width": width, "height": height, "opencv_available": False, "skew_angle_deg": 0.0, "face_detected": face is not None, "face_info": face, "interior_mean_luma": round(float(interior(raster.luma(rgb)).mean()), 4), "sides": sides}


def thumbnail(rgb: np.ndarray, most: int = 512) -> np.ndarray:
    """The raster with its longer side at most ``most`` pixels, by means over the pixels that each new one covers."""
    scale = min(1.0, most / max(rgb.shape[:2]))
    sizes = [max(1, round(n * scale)) for n in rgb.shape[:2]]
    out = rgb.astype(np.float64)
    for axis, new in enumerate(sizes):
        cut = np.arange(new) * out.shape[axis] // new
        n = np.diff(np.append(cut, out.shape[axis]))
        out = np.add.reduceat(out, cut, axis) / n.reshape([-1 if k == axis else 1 for k in range(3)])
    return (out + 0.5).astype(np.uint8)
