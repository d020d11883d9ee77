"""The lot's frozen pattern: an ordered fold over narrow rows, batch or streaming.

Order is the source name. A lot's images are seen in chunks, of 5 while nothing
is frozen and of 25 after; all images of a chunk see the pattern from its start.
After 5 compatible patterns the first of them is frozen; 25 cached hits, or a
fresh incompatible pattern, unfreeze it. The fold of one lot is sequential by
its nature; rows stream through it in sorted order, so memory doesn't grow with
the lot, and different lots run side by side.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FREEZE, RECALIBRATE, WINDOW, CHUNK, TOLERANCE = 5, 25, 10, 25, 0.15
SIDES = ("top", "bottom", "left", "right")
OUT = "lot string, source string, status string, method string, x int, y int, w int, h int, confidence double, quarantine_reason string, frozen boolean, seq long"


Pattern = tuple[float, float, float, float]  # what is cut away of each of SIDES, as a share; 0 where a side stays


def pattern_of(status: str, box: tuple[int, int, int, int], width: int, height: int) -> Pattern | None:
    """The shares cut away, those of more than 2 px; None unless the status is ok."""
    if status not in ("ok", "crop") or not (width and height):
        return None
    x, y, w, h = box
    cut = ((y, height), (height - y - h, height), (x, width), (width - x - w, width))
    return tuple(px / dim if px > 2 else 0.0 for px, dim in cut)


def compatible(a: Pattern | None, b: Pattern | None) -> bool:
    """Both none, or the same sides with shares within the tolerance."""
    if a is None or b is None:
        return a is b
    return all((p > 0) == (q > 0) and abs(p - q) <= TOLERANCE for p, q in zip(a, b))


class Fold:
    """The state of one lot; ``state`` is JSON, for streaming.

    What an image means for the pattern is an event; what an event does depends on nothing else:

    event     when                                     then
    hit       the frozen pattern cut it                one more since; after RECALIBRATE of them the pattern is let go
    sample    nothing is frozen                        joins the window; if the last FREEZE agree, the first of them freezes
    agree     fresh, and as frozen, or without a cut   joins the window
    clash     fresh, and other than frozen             the pattern is let go, and this one begins the window
    """

    def __init__(self, state: str | None = None) -> None:
        kept = json.loads(state) if state else {}
        self.frozen: Pattern | None = None
        self.window: list[Pattern | None] = []
        self.shown: Pattern | None = None
        self.since = self.left = self.seq = 0
        for name, value in kept.items():
            setattr(self, name, value)

    @property
    def state(self) -> str:
        return json.dumps(vars(self))

    def current(self) -> Pattern | None:
        """The pattern that the next image sees; begins a chunk where the last one ended."""
        if self.left == 0:
            self.shown, self.left = self.frozen, FREEZE if self.frozen is None else CHUNK
        self.left -= 1
        self.seq += 1
        return self.shown

    def event(self, status: str, method: str | None, found: Pattern | None) -> str:
        """A record without a method, as after a crash, counts as fresh."""
        if self.frozen is None:
            return "sample"
        if method == "d0-cache" and status in ("ok", "crop"):
            return "hit"
        return "agree" if found is None or compatible(found, self.frozen) else "clash"

    def learn(self, status: str, method: str | None, found: Pattern | None) -> None:
        """Takes in one image's outcome."""
        event = self.event(status, method, found)
        if event == "hit":
            self.since += 1
            if self.since >= RECALIBRATE:
                self._let_go([])
        elif event == "clash":
            self._let_go([found])
        else:
            self.window = [*self.window, found][-WINDOW:]
            first, *rest = self.window[-FREEZE:]
            if event == "sample" and len(rest) == FREEZE - 1 and first is not None and all(compatible(first, p) for p in rest):
                self.frozen = first

    def _let_go(self, window: list[Pattern | None]) -> None:
        self.frozen, self.window, self.since = None, window, 0


def cached(frozen: Pattern | None, row: dict) -> tuple[str, tuple[int, int, int, int], str | None] | None:
    """The frozen pattern's verdict on an image, from its line profiles; None where it doesn't verify."""
    if frozen is None:
        return None
    width, height, step = row["width"], row["height"], row["frozen_step"]
    whole = (0, 0, width, height)
    if not any(frozen):
        return "noop", whole, None
    px = [round(f * dim) for f, dim in zip(frozen, (height, height, width, width))]
    top, bottom, left, right = px
    w, h = width - left - right, height - top - bottom
    if any(f and not n for f, n in zip(frozen, px)) or min(w, h) < 1:
        return None
    if w * h < 0.5 * width * height:
        return "quarantine", whole, "crop_removes_majority"
    if row["frozen_luma_mean"] < 0.15 and row["frozen_bright_frac"] < 0.005:
        return "quarantine", whole, "uniform_dark_image"
    strips = {"rows": (height, top, bottom), "cols": (width, left, right)}
    for axis, (dim, near, far) in strips.items():
        dark, bright = (np.asarray(row["frozen_lines"][axis][k]) for k in ("dark", "bright"))
        for n, part in ((near, slice(0, max(1, near // step))), (far, slice((dim - far) // step, None))):
            if n and (dark[part].mean() < 0.5 or bright[part].mean() > 0.10):
                return None
    return "crop", (left, top, w, h), None


def outcome(fold: Fold, row: dict) -> dict:
    """One image's final detection, and the state after it. A deeper fresh crop beats the cached one."""
    shown = fold.current()
    fresh = (row["x"], row["y"], row["w"], row["h"])
    status, method, box, conf, reason = row["status"], row["method"], fresh, row["confidence"], row["quarantine_reason"]
    hit = cached(shown, row) if row.get("frozen_lines") is not None else None
    if hit is not None:
        b, (w, h) = hit[1], (row["width"], row["height"])
        deeper = status == "crop" and (fresh[1] > b[1] or h - fresh[1] - fresh[3] > h - b[1] - b[3] or fresh[0] > b[0] or w - fresh[0] - fresh[2] > w - b[0] - b[2])
        if not deeper:
            status, method, box, conf, reason = hit[0], "d0-cache", b, 0.0 if hit[0] == "quarantine" else 0.9, hit[2]
    fold.learn(status, method, pattern_of(status, box, row["width"], row["height"]))
    found = {"status": status, "method": method, **dict(zip("xywh", box)), "confidence": conf, "quarantine_reason": reason}
    return {"lot": row["lot"], "source": row["source"], **found, "frozen": shown is not None, "seq": fold.seq}


NARROW = ("lot", "source", "width", "height", "status", "method", "x", "y", "w", "h", "confidence", "quarantine_reason", "frozen_step", "frozen_luma_mean", "frozen_bright_frac", "frozen_lines")


def narrow(decided: DataFrame, lot: str = "lot", source: str = "source") -> DataFrame:
    """Decided profile rows in the fold's shape: no pixels."""
    return decided.select(F.col(lot).alias("lot"), F.col(source).alias("source"), "width", "height", "status", "method", "crop_box.*", "confidence", "quarantine_reason", "frozen_step", "frozen_luma_mean", "frozen_bright_frac", "frozen_lines")


def fold_lots(rows: DataFrame) -> DataFrame:
    """The final detections of all lots (rows as from ``narrow``)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fold, lot = Fold(), None
        for f in frames:
            out = []
            for row in f.to_dict("records"):
                if row["lot"] != lot:
                    fold, lot = Fold(), row["lot"]
                out.append(outcome(fold, row))
            yield pd.DataFrame(out, columns=[c.split()[0] for c in OUT.split(", ")])

    return rows.repartition("lot").sortWithinPartitions("lot", "source").mapInPandas(run, OUT)
