"""Best-fit packing by bin completion (operator 8).

Pieces of equal length are interchangeable, so the search runs on a histogram of
lengths: at most ``capacity`` numbers, however many documents there are. A greedy
completion and best fit give the first incumbent, whose fillings are used as often
as the histogram allows, so a few thousand patterns describe all sequences. If it
needs more sequences than the lower bound, bins are completed by branch and bound:
the largest length left branches over its undominated fillings, least waste first,
each as often as it can be used, half as often and once; a branch ends where its
bound reaches the incumbent, or at a histogram that was seen with as few bins. The
search is exact unless it stops at ``SEARCH`` nodes; ``gap`` gives what it may then
have left. Pieces then find their place by their rank among those of equal length,
which is counted in salted groups.

Defined cases: a null or empty text is one piece of the end token alone. Rows
that repeat are packed as often as they occur. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import itertools
import logging
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql import Window

from orilla.llm import pieces as units
from orilla.llm import textkernel as tk
from orilla.llm import workspace

log = logging.getLogger(__name__)

# limits of the greedy completion, which only sets the incumbent
NODES = 4000
DEPTH = 4
# nodes of the search over bins: far more than small tables need, some minutes where thousands of lengths stay open
SEARCH = 20_000
LIVE = 32  # levels of the search that hold the tables of their fillings: about 1 MB each


def cut_pieces(docs: DataFrame, path: str, capacity: int, end_id: int, id_col: str = "doc_id", text_col: str = "text", keep_space: bool = False, lower: bool = True) -> DataFrame:
    """id, piece, start, length, ids_crc32 of every document's token pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = units.encoder(path, keep_space, lower)
        for b in batches:
            text, ids_of = b.column(1), b.column(0)
            for a, z in units.row_slices(text, 1_500_000):
                counts, ids = enc.encode(text.slice(a, z - a))
                at = np.concatenate([[0], np.cumsum(counts)])
                row, piece, start, length, crc = [], [], [], [], []
                for i in range(z - a):
                    own = np.append(ids[at[i] : at[i + 1]], np.uint32(end_id)).astype("<u4")
                    for k, s in enumerate(range(0, len(own), capacity)):
                        part = own[s : s + capacity]
                        row.append(a + i)
                        piece.append(k)
                        start.append(s)
                        length.append(len(part))
                        crc.append(zlib.crc32(part.tobytes()))
                yield pa.RecordBatch.from_arrays([ids_of.take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())], [id_col, "piece", "start", "length", "ids_crc32"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col), F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(tk.released(run), f"`{id_col}` {kind}, piece int, start long, length long, ids_crc32 long")


def completion(count: np.ndarray, room: int) -> list[int]:
    """The best filling of ``room`` found: least waste, then the largest first item.

    count: how many pieces of each length are left. Branches take lengths in
    descending order; a branch whose waste can't come under the incumbent's is cut,
    and so is one dominated by a single piece that fills as much.
    """
    best: list[int] = []
    best_fill = 0
    nodes = 0

    def search(left: int, most: int, used: list[int], fill: int, depth: int) -> bool:
        nonlocal best, best_fill, nodes
        top = min(left, most)
        if top <= 0:
            return False
        if count[left] - used.count(left) > 0 and left <= most:
            best, best_fill = [*used, left], fill + left
            return True
        lengths = np.flatnonzero(count[1 : top + 1]) + 1
        if depth == 1 or not len(lengths):
            for x in lengths[::-1][:2].tolist():
                if count[x] > used.count(x):
                    if fill + x > best_fill:
                        best, best_fill = [*used, x], fill + x
                    break
            return False
        # two pieces that fill the room exactly
        pair = lengths[(left - lengths <= lengths) & (lengths < left)]
        pair = pair[count[left - pair] > 0]
        for x in pair[::-1].tolist():
            y = left - x
            if count[x] - used.count(x) >= 1 + (x == y) and count[y] - used.count(y) >= 1 + (x == y):
                best, best_fill = [*used, x, y], fill + left
                return True
        for x in lengths[::-1].tolist():
            if count[x] <= used.count(x):
                continue
            nodes += 1
            if nodes > NODES:
                return False
            if fill + x > best_fill:
                best, best_fill = [*used, x], fill + x
            if fill + x * depth <= best_fill:  # even as many as may follow can't fill more
                return False
            if search(left - x, x, [*used, x], fill + x, depth - 1):
                return True
        return False

    search(room, room, [], 0, DEPTH)
    return best


def best_fit(count: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """Best-fit decreasing over the histogram: the incumbent for the whole packing."""
    left = count.copy()
    out = []
    for big in range(capacity, 0, -1):
        while left[big] > 0:
            left[big] -= 1
            items, room = [big], capacity - big
            while room > 0:
                fits = np.flatnonzero(left[1 : room + 1])
                if not len(fits):
                    break
                x = int(fits[-1]) + 1
                left[x] -= 1
                items.append(x)
                room -= x
            times = 1 + int(min(left[x] // items.count(x) for x in set(items)))
            for x in items:
                left[x] -= times - 1
            out.append((items, times))
    return out


def greedy(count: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """One completion of the largest length after the other: another incumbent."""
    left = count.copy()
    out: list[tuple[list[int], int]] = []
    for big in range(capacity, 0, -1):
        while left[big] > 0:
            left[big] -= 1
            items = [big]
            room = capacity - big
            while room > 0 and (more := completion(left, room)):
                for x in more:
                    left[x] -= 1
                items += more
                room -= sum(more)
            times = 1 + int(min(left[x] // items.count(x) for x in set(items)))
            for x in items:
                left[x] -= times - 1
            out.append((items, times))
    return out


def lower_bound(count: np.ndarray, capacity: int) -> int:
    """The least number of sequences: the total's, or that of the pieces that can't share one (Martello and Toth)."""
    size = np.arange(len(count))
    n, total = np.cumsum(count), np.cumsum(count * size)
    half = capacity // 2
    a = np.arange(half + 1)  # pieces under ``a`` are left aside
    above = n[-1] - n[half]
    mid_n, mid = n[capacity - a] - n[half], total[capacity - a] - total[half]
    small = total[half] - np.where(a > 0, total[a - 1], 0)
    more = -(-(small - (mid_n * capacity - mid)) // capacity)
    return int(above + max(0, int(more.max())))


def fillings(count: np.ndarray, room: int, waste: int) -> Iterator[list[int] | None]:
    """The undominated fillings of ``room`` that leave at most ``waste``, least waste first; None for each dominated one."""
    sizes = (np.flatnonzero(count[1 : room + 1]) + 1).tolist()
    have = {x: int(min(count[x], room // x)) for x in sizes}
    full = (1 << (room + 1)) - 1
    reach = [1]  # bit s of reach[k]: the k smallest lengths can fill s
    for x in sizes:
        bits, left, step = reach[-1], have[x], 1
        while left:
            step = min(step, left)
            bits |= (bits << (x * step)) & full
            left -= step
            step *= 2
        reach.append(bits)

    def exact(k: int, target: int) -> Iterator[list[int]]:
        if not target:
            yield []
        while target and (reach[k] >> target) & 1:
            x = sizes[k - 1]
            for n in range(min(have[x], target // x), 0, -1):
                if (reach[k - 1] >> (target - n * x)) & 1:
                    for rest in exact(k - 1, target - n * x):
                        yield [x] * n + rest
            k -= 1

    def dominated(items: list[int], left: int) -> bool:
        """Does a piece that isn't used fit in the place of some of the items, or in what is left?"""
        free = [x for x in sizes if have[x] > items.count(x)]
        if not free:
            return False
        if free[0] <= left:
            return True
        at = np.array(free)
        sums = {(sum(c), len(c)) for r in range(1, len(items) + 1 if len(items) <= 6 else 3) for c in itertools.combinations(items, r)}
        for total, n in sums:
            k = int(np.searchsorted(at, total + left, "right")) - 1
            if k >= 0 and (at[k] > total or (at[k] == total and n > 1)):
                return True
        return False

    for left in range(min(waste, room) + 1):
        if (reach[-1] >> (room - left)) & 1:
            for items in exact(len(sizes), room - left):
                yield None if dominated(items, left) else items


def branch(count: np.ndarray, capacity: int, best: int, least: int, nodes: int) -> tuple[list[tuple[list[int], int]] | None, bool]:
    """Fewer than ``best`` sequences by branch and bound over bins, if there are any; and whether the search was whole."""
    left = count.copy()
    total = int((count * np.arange(len(count))).sum())
    found: list[tuple[list[int], int]] | None = None
    seen: dict[bytes, int] = {}

    def children(used: int) -> Iterator[tuple[list[int], int] | None]:
        big = int(np.flatnonzero(left)[-1])
        left[big] -= 1
        rest = int((left * np.arange(len(left))).sum()) + big
        # the sequences yet allowed, less what they must hold
        spare = (best - 1 - used) * capacity - rest
        ways = fillings(left.copy(), capacity - big, spare) if spare >= 0 else iter(())
        left[big] += 1
        for more in ways:
            if more is None:
                yield None
                continue
            items = [big, *more]
            most = int(min(left[x] // items.count(x) for x in set(items)))
            for times in dict.fromkeys((most, -(-most // 2), 1)):
                yield items, times

    path: list[tuple[list[int], int]] = []
    used = 0
    # (its children, how many of them were seen) of each level; only the last levels hold their tables, the others'
    # children are enumerated anew when the search comes back: they come in the same order
    stack: list[list] = [[children(0), 0]] if total else []
    visited = 0
    while stack:
        level = stack[-1]
        if level[0] is None:
            level[0] = itertools.islice(children(used), level[1], None)
        step = next(level[0], "end")
        level[1] += 1
        if step == "end":
            stack.pop()
            if path:
                items, times = path.pop()
                used -= times
                for x in items:
                    left[x] += times
            continue
        visited += 1
        if visited > nodes:
            return found, False
        if step is None:
            continue
        items, times = step
        for x in items:
            left[x] -= times
        used += times
        if not left.any():
            if used < best:
                best, found = used, [*path, step]
                if best <= least:
                    return found, True
        elif used + lower_bound(left, capacity) < best:
            key = hashlib.blake2b(left.tobytes(), digest_size=16).digest()
            if seen.get(key, best) > used:
                seen[key] = used
                path.append(step)
                if len(stack) >= LIVE:
                    stack[-LIVE][0] = None
                stack.append([children(used), 0])
                continue
        used -= times
        for x in items:
            left[x] += times
    return found, True


def solve(count: np.ndarray, capacity: int, nodes: int = SEARCH) -> tuple[list[tuple[list[int], int]], int]:
    """(lengths, times) of the sequences, and the gap: 0 if no packing has fewer, else by how many one might."""
    least = lower_bound(count, capacity)
    size = lambda p: sum(n for _, n in p)
    out = min((greedy(count, capacity), best_fit(count, capacity)), key=size)
    if size(out) <= least:
        return out, 0
    fewer, whole = branch(count, capacity, size(out), least, nodes)
    out = fewer or out
    return out, 0 if whole else size(out) - least


def patterns(count: np.ndarray, capacity: int) -> list[tuple[list[int], int]]:
    """(lengths, times) of the sequences."""
    out, gap = solve(count, capacity)
    if gap:
        log.warning("packing: the search stopped at %d nodes; a packing may have up to %d sequences fewer", SEARCH, gap)
    return out


def pack(docs: DataFrame, path: str, capacity: int = 4096, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of all documents with sequence_id and offset, gapless from 0 in each sequence."""
    spark = docs.sparkSession
    cut = workspace.materialize(cut_pieces(docs, path, capacity, end_id, id_col, text_col), "pieces")
    sizes = cut.groupBy("length").count().collect()  # at most ``capacity`` rows
    count = np.zeros(capacity + 1, np.int64)
    for r in sizes:
        count[r["length"]] = r["count"]
    slots: dict[int, list[tuple[int, int, int]]] = {}
    seen = np.zeros(capacity + 1, np.int64)
    base = 0
    for items, times in patterns(count, capacity):
        at = 0
        for x in items:
            slots.setdefault(x, []).append((int(seen[x]), base, at))
            seen[x] += times
            at += x
        base += times
    table = {x: tuple(np.array(v, np.int64).T) for x, v in slots.items()}  # a few entries for each of ``capacity`` lengths
    held = spark.sparkContext.broadcast(table)
    salts = max(1, int(count.sum()) // 20_000)
    salted = cut.withColumn("salt", F.pmod(F.xxhash64(id_col, "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    groups = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    groups = groups.withColumn("before", F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("n")
    within = F.row_number().over(Window.partitionBy("length", "salt").orderBy(id_col, "piece", "start", "ids_crc32")) - 1
    ranked = salted.withColumn("within", within).join(groups, ["length", "salt"]).withColumn("rank", F.col("before") + F.col("within"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of = held.value
        for b in batches:
            length, rank = b.column("length").to_numpy(), b.column("rank").to_numpy()
            seq, off = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for x in np.unique(length).tolist():
                here = np.flatnonzero(length == x)
                first, start, offset = of[x]
                k = np.searchsorted(first, rank[here], "right") - 1
                seq[here], off[here] = start[k] + rank[here] - first[k], offset[k]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.array(seq), pa.array(off)], [*b.schema.names[:-1], "sequence_id", "offset"])

    schema = T.StructType([*cut.schema.fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    return ranked.select(*cut.columns, "rank").mapInArrow(tk.released(place), schema)
