"""Line dedup by pairwise alignment (operator 7).

Documents are ordered by id. What may go from a later one is a block: lines of
``min_words`` words or more that follow each other in it and, as the same lines
in the same order, in one earlier document. (Lines without a word don't count.)

Pairs come from shared line hashes that are rare. A line alone may stand in any
number of documents, so it is indexed with the shortest run of ``min_words`` words
that it begins, and with that which it ends: every line of a block stands in such
a run inside the block, and such a run is as rare as the block itself. Each later
document meets the first one that has the run, so there are no more pairs than
runs, however many documents share one, and no line is left out for being
frequent. Equal texts form a class beforehand; its later members are one block.

Each pair is aligned by patience diff: lines that occur once on either side, in
their longest common order, then the gaps between them. Aligned blocks are taken
out of the later one and its rest is aligned again until no block is found, so that
blocks that moved or stand twice are found too. Runs of lines below ``min_words`` stay, also
where several earlier documents have one part each, and so does what is left of a
block that overlaps an aligned one, if it is shorter than that.

Defined cases: a null text stays null; an empty one has no lines. Lines without
a word are deleted only between two lines of a deleted block. Rows of one id and
one text are one document, and rows of one id with different texts are ordered by
a hash of the text. Null ids come last. Ids may have any type that has an order.
Columns of the names n_removed_lines and n_removed_words are replaced, all others
kept, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orilla.llm import textkernel as tk
from orilla.llm import workspace

RANGES = T.ArrayType(T.StructType([T.StructField("at", T.IntegerType()), T.StructField("n", T.IntegerType())]))
_RANGES = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())]))


def anchors(a: list, b: list) -> list[tuple[int, int]]:
    """Places of lines that occur once in a and once in b, in their longest common order."""
    once_a, once_b = Counter(a), Counter(b)
    where = {h: j for j, h in enumerate(b) if once_b[h] == 1}
    pairs = [(i, where[h]) for i, h in enumerate(a) if once_a[h] == 1 and h in where]
    # longest increasing subsequence by patience sorting
    tops: list[int] = []
    at: list[int] = []
    back: list[int] = []
    for k, (_, j) in enumerate(pairs):
        p = bisect_left(tops, j)
        if p == len(tops):
            tops.append(j)
            at.append(k)
        else:
            tops[p], at[p] = j, k
        back.append(at[p - 1] if p else -1)
    out, k = [], at[-1] if at else -1
    while k >= 0:
        out.append(pairs[k])
        k = back[k]
    return out[::-1]


def in_turn(a: list, b: list) -> list[tuple[int, int]]:
    """Places of a gap without anchors: each line of a with the next one of b that equals it."""
    places: dict = {}
    for j, h in enumerate(b):
        places.setdefault(h, []).append(j)
    out, at = [], 0
    for i, h in enumerate(a):
        own = places.get(h, ())
        k = bisect_left(own, at)
        if k < len(own):
            out.append((i, own[k]))
            at = own[k] + 1
    return out


def patience(a: list, b: list) -> list[tuple[int, int]]:
    """Aligned places of two sequences of line hashes."""
    out: list[tuple[int, int]] = []
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i0, i1, j0, j1 = todo.pop()
        while i0 < i1 and j0 < j1 and a[i0] == b[j0]:
            out.append((i0, j0))
            i0, j0 = i0 + 1, j0 + 1
        while i0 < i1 and j0 < j1 and a[i1 - 1] == b[j1 - 1]:
            i1, j1 = i1 - 1, j1 - 1
            out.append((i1, j1))
        if i0 >= i1 or j0 >= j1:
            continue
        got = anchors(a[i0:i1], b[j0:j1])
        if not got:
            out += [(i0 + i, j0 + j) for i, j in in_turn(a[i0:i1], b[j0:j1])]
            continue
        pi, pj = i0, j0
        for i, j in got:
            out.append((i0 + i, j0 + j))
            todo.append((pi, i0 + i, pj, j0 + j))
            pi, pj = i0 + i + 1, j0 + j + 1
        todo.append((pi, i1, pj, j1))
    return sorted(out)


def aligned_blocks(later: list, earlier: list, words: list[int], min_words: int) -> list[tuple[int, int]]:
    """(start, end) of the blocks of ``later`` that align with ``earlier``, moved ones included."""
    a = list(later)
    found: list[tuple[int, int]] = []
    while True:
        pairs = patience(a, earlier)
        new = []
        k = 0
        while k < len(pairs):
            z = k + 1
            while z < len(pairs) and pairs[z] == (pairs[z - 1][0] + 1, pairs[z - 1][1] + 1):
                z += 1
            (i, _), n = pairs[k], z - k
            if sum(words[i : i + n]) >= min_words:
                new.append((i, i + n))
                a[i : i + n] = [None] * n  # what was taken equals nothing any more
            k = z
        if not new:
            return sorted(found)
        found += new


def runs(hashes: np.ndarray, words: np.ndarray, at: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of the shortest runs of ``min_words`` words that begin or end at a line."""
    n = len(hashes)
    row = np.repeat(np.arange(len(at) - 1), np.diff(at))
    so_far = np.concatenate([[0], np.cumsum(words)])
    first, last = at[:-1][row], at[1:][row]
    place = np.arange(n)
    end = np.searchsorted(so_far, so_far[place] + min_words)
    ahead = end <= last
    start = np.searchsorted(so_far, so_far[place + 1] - min_words, "right") - 1
    behind = (start >= first) & (so_far[place + 1] - so_far[first] >= min_words)
    s = np.concatenate([place[ahead], start[behind]])
    e = np.concatenate([end[ahead], place[behind] + 1])
    r = np.concatenate([row[ahead], row[behind]])
    with np.errstate(over="ignore"):
        # a rolling sum of the lines' hashes by their place in the run
        up, down = tk._powers(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(hashes.view(np.uint64) * up[:n], out=total[1:])
        h = tk.mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
    return tk.row_sets(h, r, len(at) - 1)


def _flat(lists: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(kind), offsets - offsets[0]


def _runs_of(min_words: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes, at = _flat(b.column("hashes"), np.int64)
            words, _ = _flat(b.column("words"), np.int64)
            h, cut = runs(hashes, words, at, min_words)
            row = np.repeat(np.arange(len(cut) - 1), np.diff(cut))
            yield pa.RecordBatch.from_arrays([b.column("key").take(pa.array(row)), pa.array(h.view(np.int64))], ["key", "run"])

    return run


def _align(min_words: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for later, earlier, words in zip(*(b.column(c) for c in ("later", "earlier", "words"))):
                got = aligned_blocks(later.as_py(), earlier.as_py(), words.as_py(), min_words)
                out.append([{"at": i, "n": z - i} for i, z in got])
            yield pa.RecordBatch.from_arrays([b.column("key"), pa.array(out, _RANGES)], ["key", "blocks"])

    return run


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of lines with a word to marks of all lines that stay, and numbers of what goes."""
    for b in batches:
        stay, n_lines, n_words = [], [], []
        for k in range(b.num_rows):
            words, solid, total = (np.array(b.column(c)[k].as_py(), np.int64) for c in ("words", "solid", "n_lines"))
            gone = np.zeros(int(total), bool)
            lost = np.zeros(len(words), bool)
            for x in b.column("blocks")[k].as_py():
                lost[x["at"] : x["at"] + x["n"]] = True
                gone[solid[x["at"]] : solid[x["at"] + x["n"] - 1] + 1] = True
            stay.append(~gone)
            n_lines.append(int(gone.sum()))
            n_words.append(int(words[lost].sum()))
        yield pa.RecordBatch.from_arrays([b.column("cls"), b.column("head"), b.column("of_copies"), pa.array(stay, pa.list_(pa.bool_())), pa.array(n_lines, pa.int64()), pa.array(n_words, pa.int64())], ["cls", "head", "of_copies", "stay", "n_lines", "n_words"])


def _key(docs: DataFrame, id_col: str, text_col: str) -> Column:
    of = docs[id_col]
    return F.struct(of.isNull().alias("none"), of.alias("id"), F.xxhash64(docs[text_col]).alias("h"))


def _class(docs: DataFrame, text_col: str) -> Column:
    return F.unhex(F.md5(docs[text_col].cast("binary")))


def _line(x: Column, i: Column) -> Column:
    words = F.size(F.filter(F.split(x, r"[\x20\x09-\x0D]+"), lambda w: w != ""))
    return F.struct(words.alias("words"), i.alias("place"), F.xxhash64(x).alias("hash"))


def sequences(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """For each class of equal texts its first key, whether there are others, and its lines: hash, number of words and
    place of those that have a word, and the number of all."""
    own = docs.where(docs[text_col].isNotNull()).select(_key(docs, id_col, text_col).alias("key"), _class(docs, text_col).alias("cls"), F.split(docs[text_col], "\n", -1).alias("lines"))
    # one lambda over the lines: a column of another one would be worked out again for each line
    solid = own.withColumn("solid", F.filter(F.transform("lines", _line), lambda x: x["words"] > 0))
    slim = solid.select("cls", "key", F.col("solid.hash").alias("hashes"), F.col("solid.words").alias("words"), F.col("solid.place").alias("solid"), F.size("lines").alias("n_lines"))
    first = slim.groupBy("cls").agg(F.min(F.struct("key", "hashes", "words", "solid", "n_lines")).alias("first"), F.max("key").alias("last"))
    return first.select("cls", "first.*", (F.col("last") != F.col("first.key")).alias("copied"))


def removals(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 30) -> DataFrame:
    """cls, head, of_copies, stay, n_lines, n_words: what stays and goes of each class's first document (head), if it loses
    a block, and of the class's later documents (of_copies)."""
    seq = workspace.materialize(sequences(docs, id_col, text_col), "lines")
    kind = seq.schema["key"]
    some = seq.where(F.size("hashes") > 0)
    found = some.select("key", "hashes", "words").mapInArrow(_runs_of(min_words), T.StructType([kind, T.StructField("run", T.LongType())]))
    # written, so that the join reads nothing but exchanges and hot runs are split
    shared = workspace.materialize(found.groupBy("run").agg(F.min("key").alias("first"), F.max("key").alias("last")).where("first <> last").select("run", "first"), "runs")
    pairs = found.hint("merge").join(shared, "run").where(F.col("key") != F.col("first")).select("key", "first").distinct()
    one = seq.select("key", "hashes", "words")
    both = pairs.join(one.select(F.col("key").alias("first"), F.col("hashes").alias("earlier")).hint("merge"), "first")
    both = both.join(one.select("key", F.col("hashes").alias("later"), "words").hint("merge"), "key")
    blocks = both.select("key", "later", "earlier", "words").mapInArrow(_align(min_words), T.StructType([kind, T.StructField("blocks", RANGES)]))
    union = blocks.where(F.size("blocks") > 0).groupBy("key").agg(F.flatten(F.collect_list("blocks")).alias("blocks"))
    lines = ("words", "solid", "n_lines")
    parts = union.join(seq.select("key", "cls", *lines).hint("merge"), "key").select("cls", F.col("key").alias("head"), F.lit(False).alias("of_copies"), "blocks", *lines)
    whole = F.array(F.struct(F.lit(0).alias("at"), F.size("words").alias("n")))
    total = F.aggregate("words", F.lit(0).cast("long"), lambda a, x: a + x)
    copies = some.where("copied").where(total >= min_words).select("cls", F.col("key").alias("head"), F.lit(True).alias("of_copies"), whole.alias("blocks"), *lines)
    shape = T.StructType([seq.schema["cls"], T.StructField("head", kind.dataType), T.StructField("of_copies", T.BooleanType()), T.StructField("stay", T.ArrayType(T.BooleanType())), T.StructField("n_lines", T.LongType()), T.StructField("n_words", T.LongType())])
    return parts.unionByName(copies).mapInArrow(_kept, shape)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 30) -> DataFrame:
    """All columns, the text without the deleted lines, n_removed_lines and n_removed_words."""
    what = F.struct("stay", "n_lines", "n_words")
    # one row a class: what its first document loses, and what the others do
    gone = removals(docs, id_col, text_col, min_words).groupBy("cls").agg(
        F.first("head").alias("head"), F.first(F.when(~F.col("of_copies"), what), True).alias("own"), F.first(F.when(F.col("of_copies"), what), True).alias("others")
    )
    gone = workspace.materialize(gone, "removals")
    names = [c for c in docs.columns if c not in ("n_removed_lines", "n_removed_words")]
    rows = docs.select(F.struct(*(docs[c] for c in names)).alias("row"), _key(docs, id_col, text_col).alias("key"), _class(docs, text_col).alias("cls"))
    # always the same plan: a broadcast on small inputs alone would hide what the join moves on large ones
    lost = rows.join(gone.hint("merge"), "cls", "left").select("row", F.when(F.col("key") == F.col("head"), F.col("own")).otherwise(F.col("others")).alias("lost"))
    lines = F.split(F.col("row")[text_col], "\n", -1)
    kept = F.array_join(F.filter(lines, lambda _, i: F.get("lost.stay", i)), "\n")
    columns = [F.when(F.col("lost").isNull(), F.col("row")[c]).otherwise(kept).alias(c) if c == text_col else F.col("row")[c].alias(c) for c in names]
    return lost.select(*columns, F.coalesce("lost.n_lines", F.lit(0).cast("long")).alias("n_removed_lines"), F.coalesce("lost.n_words", F.lit(0).cast("long")).alias("n_removed_words"))
