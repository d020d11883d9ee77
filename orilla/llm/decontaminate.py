"""Benchmark decontamination by greedy string tiling (operator 3).

Words are lower-cased, ASCII punctuation separates them. Documents and benchmark
items that share a seed, a run of ``min_match`` words, are joined; for each such
pair the longest common runs that don't overlap earlier ones are marked again
and again, Karp-Rabin hashes finding the matches, until none of ``min_match``
words is left. The share of the item's words under tiles is its coverage; order
doesn't matter, so reordered passages are caught. Tiles are found on hashes of words and
then held against the words themselves.

The benchmark is sent to the executors in blocks of a checked size, and each
block meets all documents; no documents are shuffled.

Defined cases: null or empty texts match nothing. Items with fewer words than
``min_match`` use their own length; those with fewer than ``least_words`` (a word or two say
nothing about where a text is from) take no part, and 1 lets all of them. Items that
repeat are reported each. Ids may have any type. Rows that repeat, null ids and further columns
change nothing. Empty tables give no pairs.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from orilla.llm import pieces
from orilla.llm import textkernel as tk

_FOLD = tk._LOWER.copy()
for _c in [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]:
    _FOLD[_c] = 32
BLOCK_BYTES = 16_000_000  # of text; some 3 million words, and 120 MB as built


class Tokens:
    """The words of a string column: hash, row, and where they stand in the folded bytes."""

    def __init__(self, text: pa.Array) -> None:
        data, offsets = tk.utf8(text)
        # folding before the split makes blocks end at white space of the folded text too
        self.data = _FOLD[data]
        self.start, self.end, self.row, self.hash = tk.words(self.data, offsets)
        self.rows = len(offsets) - 1
        self.cut = np.searchsorted(self.row, np.arange(self.rows + 1))

    def words(self, row: int, a: int, n: int) -> list[bytes]:
        """``n`` words of a row from its word ``a``."""
        k = int(self.cut[row]) + a
        return [self.data[s:e].tobytes() for s, e in zip(self.start[k : k + n], self.end[k : k + n])]


def grams(h: np.ndarray, width: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``width`` words."""
    if len(h) < width:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        acc = np.zeros(len(h) - width + 1, np.uint64)
        for k in range(width):
            acc = acc * tk._P + h[k : len(h) - width + 1 + k]
        return tk.mix(acc)


def _free_runs(h: np.ndarray, used: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of the runs of ``width`` words of which none is used."""
    g = grams(h, width)
    taken = np.concatenate([[0], np.cumsum(used)])
    at = np.flatnonzero(taken[width:] == taken[: len(taken) - width])[: len(g)]
    return g[at], at


def tile(item: np.ndarray, doc: np.ndarray, least: int, candidates: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """(place in item, place in doc, length) of the greedy tiles, longest first, then by place.

    Each round finds the longest common free run by bisection over its length and marks all
    runs of that length that don't overlap. ``candidates`` marks the words of doc that may be in one.
    """
    used_i = np.zeros(len(item), bool)
    used_d = np.zeros(len(doc), bool) if candidates is None else ~candidates
    tiles: list[tuple[int, int, int]] = []
    most = min(len(item), len(doc))
    while True:
        lo, hi = least - 1, most
        while lo < hi:
            mid = (lo + hi + 1) // 2
            if len(np.intersect1d(_free_runs(item, used_i, mid)[0], _free_runs(doc, used_d, mid)[0])):
                lo = mid
            else:
                hi = mid - 1
        if lo < least:
            return tiles
        most = lo
        gi, pi = _free_runs(item, used_i, lo)
        gd, pd = _free_runs(doc, used_d, lo)
        both = np.isin(gd, gi)
        places: dict[int, list[int]] = defaultdict(list)
        for g, j in zip(gd[both][::-1].tolist(), pd[both][::-1].tolist()):
            places[g].append(j)
        for g, i in zip(gi.tolist(), pi.tolist()):
            own = places.get(g)
            if not own or used_i[i : i + lo].any():
                continue
            while own and used_d[own[-1] : own[-1] + lo].any():
                own.pop()
            if own:
                j = own.pop()
                used_i[i : i + lo] = used_d[j : j + lo] = True
                tiles.append((i, j, lo))


class Seeds:
    """The distinct runs of one width of a block's items: their hashes, and the items of each."""

    def __init__(self, of_item: dict[int, np.ndarray]) -> None:
        items = np.repeat(np.fromiter(of_item, np.int64, len(of_item)), [len(g) for g in of_item.values()])
        self.hash, k = np.unique(np.concatenate(list(of_item.values())), return_inverse=True)
        pair = np.unique(k * (items.max() + 1) + items)
        self.item = pair % (items.max() + 1)
        self.cut = np.searchsorted(pair // (items.max() + 1), np.arange(len(self.hash) + 1))
        self.of_item = dict(zip(of_item, np.split(k, np.cumsum([len(g) for g in of_item.values()])[:-1])))


class Block:
    """Benchmark items with an index of their seeds: some 40 bytes a word."""

    def __init__(self, ids: list, texts: list[str], min_match: int, least_words: int) -> None:
        self.tokens = t = Tokens(pa.array(texts, pa.string()))
        self.ids = ids
        self.least: dict[int, int] = {}
        by_width: dict[int, dict[int, np.ndarray]] = defaultdict(dict)
        for k in range(t.rows):
            own = t.hash[t.cut[k] : t.cut[k + 1]]
            if len(own) >= max(1, least_words):
                self.least[k] = min(min_match, len(own))
                by_width[self.least[k]][k] = grams(own, self.least[k])
        self.seeds = {w: Seeds(v) for w, v in by_width.items()}

    def pairs(self, text: pa.Array, coverage: float) -> list[tuple[int, int, int, int, int]]:
        """(row, place of the item, words, covered, tiles) of the pairs that reach the coverage."""
        t, own = Tokens(text), self.tokens
        out = []
        for width, seeds in self.seeds.items():
            g = grams(t.hash, width)
            if not len(g):
                continue
            k = np.minimum(np.searchsorted(seeds.hash, g), len(seeds.hash) - 1)
            at = np.flatnonzero((seeds.hash[k] == g) & (t.row[: len(g)] == t.row[width - 1 :]))
            if not len(at):
                continue
            # each seed of a document once, with each of its items
            n = len(seeds.hash)
            seen = np.unique(t.row[at] * n + k[at])
            times = (seeds.cut[1:] - seeds.cut[:-1])[seen % n]
            place = np.repeat(seeds.cut[:-1][seen % n], times) + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            row, item, seed = np.repeat(seen // n, times), seeds.item[place], np.repeat(seen % n, times)
            order = np.lexsort((item, row))
            row, item, seed = row[order], item[order], seed[order]
            edge = np.concatenate([[0], np.flatnonzero((row[1:] != row[:-1]) | (item[1:] != item[:-1])) + 1, [len(row)]])
            for a, z in zip(edge[:-1].tolist(), edge[1:].tolist()):
                r, i = int(row[a]), int(item[a])
                words = int(own.cut[i + 1] - own.cut[i])
                if _covered(np.flatnonzero(np.isin(seeds.of_item[i], seed[a:z])), width, words).sum() < coverage * words:
                    continue  # the seeds' words bound the coverage
                lo, hi = np.searchsorted(at, [t.cut[r], t.cut[r + 1]])
                spots = at[lo:hi][np.isin(k[at[lo:hi]], seed[a:z])] - t.cut[r]
                may = _covered(spots, width, int(t.cut[r + 1] - t.cut[r]))
                # the words of seeds alone, one unused word between what doesn't adjoin
                keep = np.flatnonzero(may | np.concatenate([[False], may[:-1]]))
                tiles = [(x, int(keep[y]), m) for x, y, m in tile(own.hash[own.cut[i] : own.cut[i + 1]], t.hash[t.cut[r] : t.cut[r + 1]][keep], self.least[i], may[keep])]
                tiles = [x for x in tiles if own.words(i, x[0], x[2]) == t.words(r, x[1], x[2])]
                covered = sum(x[2] for x in tiles)
                if covered >= coverage * words:
                    out.append((r, i, words, covered, len(tiles)))
        return sorted(out)


def _covered(starts: np.ndarray, width: int, n: int) -> np.ndarray:
    """Marks of the words that runs of ``width`` from these starts cover."""
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, starts, 1)
    np.add.at(step, starts + width, -1)
    return np.cumsum(step)[:-1] > 0


def _blocks(benchmark: DataFrame, min_match: int, least_words: int, id_col: str, text_col: str) -> Iterator[Block]:
    """The benchmark in blocks of a bounded size; how many follows from its measured size."""
    rows = benchmark.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    n = int(total // BLOCK_BYTES) + 1
    for k in range(n):
        part = rows if n == 1 else rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k)
        got = part.orderBy("id", "text").toArrow()
        yield Block(got.column("id").to_pylist(), got.column("text").to_pylist(), min_match, least_words)


def leaks(docs: DataFrame, benchmark: DataFrame, min_match: int = 5, coverage: float = 0.5, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", least_words: int = 3) -> DataFrame:
    """id, item id, item_words, covered_words, n_tiles, coverage of every contaminated pair."""
    spark = docs.sparkSession

    def one(block: Block) -> DataFrame:
        held = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                for a, z in pieces.row_slices(b.column(1), 4_000_000):
                    got = held.value.pairs(b.column(1).slice(a, z - a), coverage)
                    if got:
                        r, item, words, covered, tiles = (list(x) for x in zip(*got))
                        yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array([a + x for x in r])), pa.array([held.value.ids[i] for i in item], item_type), pa.array(words, pa.int64()), pa.array(covered, pa.int64()), pa.array(tiles, pa.int64()), pa.array([c / w for c, w in zip(covered, words)], pa.float64())], [id_col, item_col, "item_words", "covered_words", "n_tiles", "coverage"])

        kind, item_kind = docs.schema[id_col].dataType.simpleString(), benchmark.schema[item_col].dataType
        item_type = to_arrow_type(item_kind)
        return docs.select(id_col, text_col).mapInArrow(tk.released(run), f"`{id_col}` {kind}, `{item_col}` {item_kind.simpleString()}, item_words long, covered_words long, n_tiles long, coverage double")

    return reduce(DataFrame.unionByName, [one(b) for b in _blocks(benchmark, min_match, least_words, item_col, "text")])


def clean(docs: DataFrame, benchmark: DataFrame, min_match: int = 5, coverage: float = 0.5, text_col: str = "text", item_col: str = "item_id", least_words: int = 3) -> DataFrame:
    """The documents that no item contaminates, as they are."""
    for block in _blocks(benchmark, min_match, least_words, item_col, "text"):
        held = docs.sparkSession.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], held=held) -> Iterator[pa.RecordBatch]:  # noqa: ANN001
            for b in batches:
                bad = np.zeros(b.num_rows, bool)
                text = b.column(text_col)
                for a, z in pieces.row_slices(text, 4_000_000):
                    for r, *_ in held.value.pairs(text.slice(a, z - a), coverage):
                        bad[a + r] = True
                yield b.filter(pa.array(~bad))

        docs = docs.mapInArrow(tk.released(run), docs.schema)
    return docs
