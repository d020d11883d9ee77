"""N-gram Jaccard join with token-combination prefixes (operator 1).

A document is the set of its word shingles; two documents link when
``100 * |intersection| >= percent * |union|``. Equal sets form a class first.

Tokens are in one global order: rare ones by hash, then frequent ones by hash.
With ``e = n - ceil(t * n)`` at most e tokens of a set miss from a linked one,
and with ``d = floor(n * (1 - t) / t)`` at most d tokens differ in all. A set is
indexed under its first e + 1 rare tokens. Where it has only r <= e rare ones,
the prefix is extended by ``d + e - 2 * r + 2`` frequent tokens, and every two
neighbours among these are one signature: if no rare token is shared, at most
``(e - r) + (d - r)`` of the neighbourhoods can be broken, so one is shared.
The set whose prefix ends first finds its signature in the other's prefix.

Candidates are verified on whole sets, after an exact upper bound from
histograms of token hashes. Classes of one signature are first compared with one
of them, then with their likeliest partners, then with all others, each time only
across components, as what is linked by then needs no further comparison. What an
earlier round has settled isn't moved again: signatures of two classes are done with
the first round, groups that gave out all their pairs with the second. All joins
are merge joins at every size: broadcasts on small inputs alone would hide what they move. Large
groups are compared block by block inside tasks, which give out only the pairs
that the bound allows. No candidate is dropped.

Which tokens count as frequent is a matter of cost alone, not of results: those
with the highest counts in chunks of the corpus, at most ``frequent`` of them.

Defined cases: a null text, or one without words, has an empty set and links
with nothing; with fewer words than a shingle has, the whole sequence is one
shingle. Rows that repeat are copies of one class. A null id stays null, and its
row counts for its class with no id. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orilla.llm import pieces, workspace
from orilla.llm import textkernel as tk
from orilla.llm.components import components

BUCKETS = 256
FEW, SMALL = 64, 512  # buckets of sets of at most so many tokens
CHUNK = 2_500_000
_U = np.uint64


def _sets(text: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The distinct shingles of each row, ascending, and the rows' offsets."""
    data, offsets = tk.utf8(text)
    _, _, row, h = tk.words(data, offsets, lower=True)
    n = len(offsets) - 1
    return tk.row_sets(*tk.shingles(h, row, n, width), n)


def _set_ids(tokens: np.ndarray, at: np.ndarray) -> list[bytes | None]:
    """128 bits that name each row's set; None for an empty one."""
    with np.errstate(over="ignore"):
        sums = []
        for odd in (_U(0xD6E8FEB86659FD93), _U(0xA0761D6478BD642F)):
            c = np.zeros(len(tokens) + 1, np.uint64)
            np.cumsum(tk.mix(tokens * odd), out=c[1:])
            sums.append(tk.mix(c[at[1:]] - c[at[:-1]] + (at[1:] - at[:-1]).astype(np.uint64)))
    both = np.stack(sums, 1).tobytes()
    return [both[16 * i : 16 * i + 16] if at[i + 1] > at[i] else None for i in range(len(at) - 1)]


def signatures(tokens: np.ndarray, at: np.ndarray, frequent: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """The signatures of each row's set and their offsets."""
    n = at[1:] - at[:-1]
    rows = len(n)
    row = np.repeat(np.arange(rows), n)
    k = np.minimum(np.searchsorted(frequent, tokens), max(len(frequent) - 1, 0))
    heavy = frequent[k] == tokens if len(frequent) else np.zeros(len(tokens), bool)
    order = np.argsort(2 * row + heavy, kind="stable")
    t, heavy = tokens[order], heavy[order]
    rare = np.bincount(row, ~heavy, minlength=rows).astype(np.int64)
    e = (100 - percent) * n // 100
    d = (100 - percent) * n // percent
    rank = np.arange(len(t)) - at[:-1][row]
    single = ~heavy & (rank <= e[row])
    second = np.where(rare <= e, np.minimum(n - rare, d + e - 2 * rare + 2), 0)
    place = rank - rare[row]
    pair = heavy & (place + 1 < second[row])
    left = np.flatnonzero(pair)
    with np.errstate(over="ignore"):
        sig = np.concatenate([t[single], tk.mix(t[left] * tk._P + t[np.minimum(left + 1, max(len(t) - 1, 0))])])
    of = np.concatenate([row[single], row[left]])
    order = np.argsort(of, kind="stable")
    return sig[order], np.concatenate([[0], np.cumsum(np.bincount(of, minlength=rows))]).astype(np.int64)


def _histograms(tokens: np.ndarray, at: np.ndarray) -> list[bytes]:
    """Counts of each row's tokens in buckets, as bytes; 255 stands for that or more. Small sets have fewer buckets."""
    n = at[1:] - at[:-1]
    rows = len(n)
    row = np.repeat(np.arange(rows), n)
    few = np.bincount(row * FEW + (tokens >> _U(58)).astype(np.int64), minlength=rows * FEW).reshape(rows, FEW)
    out = [h.tobytes() for h in np.minimum(few, 255).astype(np.uint8)]
    for r in np.flatnonzero(n > SMALL).tolist():
        own = np.bincount((tokens[at[r] : at[r + 1]] >> _U(56)).astype(np.int64), minlength=BUCKETS)
        out[r] = np.minimum(own, 255).astype(np.uint8).tobytes()
    return out


class Histograms:
    """Histograms of rows, those with all buckets also folded to the fewer."""

    def __init__(self, raw: list[bytes]) -> None:
        wide = np.array([len(h) == BUCKETS for h in raw], bool)
        self.place = np.where(wide, np.cumsum(wide) - 1, -1)
        self.all = np.frombuffer(b"".join(h for h, w in zip(raw, wide) if w), np.uint8).reshape(-1, BUCKETS)
        self.few = np.empty((len(raw), FEW), np.uint8)
        self.few[~wide] = np.frombuffer(b"".join(h for h, w in zip(raw, wide) if not w), np.uint8).reshape(-1, FEW)
        self.few[wide] = np.minimum(self.all.reshape(-1, FEW, BUCKETS // FEW).sum(2, dtype=np.int64), 255)

    def bound(self, x: np.ndarray, other: Histograms, y: np.ndarray) -> np.ndarray:
        """At most so many tokens are common to row x and the other's row y; a large number where buckets are full."""
        both = np.minimum(self.few[x], other.few[y])
        most = both.sum(1, dtype=np.int64)
        most[(both == 255).any(1)] = 1 << 40
        wide = np.flatnonzero((self.place[x] >= 0) & (other.place[y] >= 0))
        if len(wide):
            both = np.minimum(self.all[self.place[x[wide]]], other.all[other.place[y[wide]]])
            most[wide] = np.where((both == 255).any(1), 1 << 40, both.sum(1, dtype=np.int64))
        return most


def frequent_tokens(docs: DataFrame, text_col: str, width: int, most: int, least: int) -> np.ndarray:
    """The most frequent tokens: a bounded number, from counts over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, z in pieces.row_slices(b.column(0), CHUNK):
                t, c = np.unique(_sets(b.column(0).slice(a, z - a), width)[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(t[c > 1].view(np.int64)), pa.array(c[c > 1])], ["token", "n"])

    counts = docs.select(F.coalesce(F.col(text_col), F.lit("")).alias("text")).mapInArrow(tk.released(run), "token long, n long")
    top = counts.groupBy("token").agg(F.sum("n").alias("n")).where(F.col("n") >= least).orderBy(F.desc("n"), "token").limit(most)
    return np.sort(top.select("token").toArrow().column(0).to_numpy().astype(np.int64).view(np.uint64))


def _index(docs: DataFrame, id_col: str, text_col: str, width: int, percent: int, frequent: np.ndarray) -> DataFrame:
    """id, text_key, set_id, n, sigs, hist of every row."""
    held = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, z in pieces.row_slices(b.column(2), CHUNK):
                tokens, at = _sets(b.column(2).slice(a, z - a), width)
                sig, cut = signatures(tokens, at, held.value, percent)
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, z - a), b.column(1).slice(a, z - a), pa.array(_set_ids(tokens, at), pa.binary()), pa.array(at[1:] - at[:-1]), tk.list_array(sig.view(np.int64), cut, pa.int64()), pa.array(_histograms(tokens, at), pa.binary())], ["id", "text_key", "set_id", "n", "sigs", "hist"])

    kind = docs.schema[id_col].dataType.simpleString()
    own = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return own.mapInArrow(tk.released(run), f"id {kind}, text_key long, set_id binary, n long, sigs array<long>, hist binary")


def _tokens_of(docs: DataFrame, wanted: DataFrame, id_col: str, text_col: str, width: int, broadcast_rows: int = 500_000) -> DataFrame:
    """(c, tokens) of the wanted (c, id, text_key); ids are sent to all executors only if their number is small."""
    own = docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_key"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    small = wanted.count() <= broadcast_rows
    texts = own.join(F.broadcast(wanted) if small else wanted, own["id"].eqNullSafe(wanted["id"]) & (own["text_key"] == wanted["text_key"])).select("c", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, z in pieces.row_slices(b.column(1), CHUNK):
                tokens, at = _sets(b.column(1).slice(a, z - a), width)
                raw = tokens.tobytes()
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, z - a), pa.array([raw[8 * i : 8 * j] for i, j in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())], ["c", "tokens"])

    return texts.mapInArrow(tk.released(run), "c long, tokens binary").dropDuplicates(["c"])


def _bounded(percent: int):  # noqa: ANN202
    """Keeps the pairs whose histograms allow a link: an upper bound of the intersection, never too low."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (Histograms(b.column(c).to_pylist()) for c in ("hx", "hy"))
            n = b.column("nx").to_numpy() + b.column("ny").to_numpy()
            same = np.arange(b.num_rows)
            most = np.minimum(x.bound(same, y, same), n // 2)
            ok = 100 * most >= percent * (n - most)
            yield b.select(["x", "y"]).filter(pa.array(ok))

    return run


def _verified(percent: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ok = np.zeros(b.num_rows, bool)
            tx, ty = b.column("tx"), b.column("ty")
            for i in range(b.num_rows):  # one pair's sets at a time in Python's own memory
                x, y = (np.frombuffer(t[i].as_buffer(), np.uint64) for t in (tx, ty))
                s = np.sort(np.concatenate([x, y]), kind="stable")
                both = int((s[1:] == s[:-1]).sum())
                ok[i] = 100 * both >= percent * (len(x) + len(y) - both)
            yield b.select(["x", "y"]).filter(pa.array(ok))

    return run


def _links(pairs: DataFrame, classes: DataFrame, docs: DataFrame, id_col: str, text_col: str, width: int, percent: int) -> tuple[DataFrame, DataFrame]:
    """The pairs (x, y) of classes whose sizes and histograms allow a link, and those that link."""
    one = classes.select("c", "n", "hist", "id", "text_key")
    # most pairs go by their sizes, so the histograms meet only what is left
    sized = pairs.join(one.select(F.col("c").alias("x"), F.col("n").alias("nx")).hint("merge"), "x").join(one.select(F.col("c").alias("y"), F.col("n").alias("ny")).hint("merge"), "y")
    sized = sized.where(F.least("nx", "ny") * 100 >= F.greatest("nx", "ny") * percent)
    sized = sized.join(one.select(F.col("c").alias("y"), F.col("hist").alias("hy")).hint("merge"), "y").join(one.select(F.col("c").alias("x"), F.col("hist").alias("hx")).hint("merge"), "x")
    likely = workspace.materialize(sized.mapInArrow(tk.released(_bounded(percent)), "x long, y long"), "likely")
    ends = likely.select(F.col("x").alias("c")).union(likely.select(F.col("y").alias("c"))).distinct()
    sets = workspace.materialize(_tokens_of(docs, one.join(ends.hint("merge"), "c", "left_semi").select("c", "id", "text_key"), id_col, text_col, width), "tokens")
    full = likely.join(sets.select(F.col("c").alias("x"), F.col("tokens").alias("tx")).hint("merge"), "x")
    full = full.join(sets.select(F.col("c").alias("y"), F.col("tokens").alias("ty")).hint("merge"), "y")
    found = workspace.materialize(full.mapInArrow(tk.released(_verified(percent)), "x long, y long"), "links")
    workspace.discard(sets)
    return likely, found


def _rows_of_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The groups of sorted batches, one table each; a group may span batches."""
    held: pa.Table | None = None
    for b in batches:
        if not b.num_rows:
            continue
        t = pa.Table.from_batches([b])
        held = t if held is None else pa.concat_tables([held, t])
        k = np.stack([held.column(c).to_numpy() for c in keys], 1)
        edge = np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1
        at = 0
        for z in edge.tolist():
            yield held.slice(at, z - at)
            at = z
        held = held.slice(at)
    if held is not None and held.num_rows:
        yield held


def _group_pairs(t: pa.Table, percent: int, most: int | None, chunk: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray, bool]]:
    """Pairs (x, y) of one group of blocks that share a signature, differ in root, and may link.

    Members meet all others ``chunk`` at a time, so memory grows with the group's size alone.
    With ``most``, each member's likeliest partners come out, and whether others wait.
    """
    t = t.combine_chunks()
    i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
    c, root, n, block = (t.column(k).to_numpy() for k in ("c", "root", "n", "block"))
    m = len(c)
    sigs = t.column("sigs").combine_chunks()
    if isinstance(sigs, pa.ChunkedArray):
        sigs = pa.concat_arrays(sigs.chunks)
    flat, at = sigs.flatten().to_numpy(), np.diff(sigs.offsets.to_numpy())
    owner = np.repeat(np.arange(m), at)
    order = np.argsort(flat, kind="stable")
    owners = [x for x in np.split(owner[order], np.flatnonzero(np.diff(flat[order])) + 1) if len(x) > 1]
    hist = Histograms(t.column("hist").to_pylist())
    for a in range(0, m, chunk):
        z = min(m, a + chunk)
        share = np.zeros((z - a, m), bool)
        for own in owners:  # ascending, as the sort is stable
            lo, hi = np.searchsorted(own, [a, z])
            if hi > lo:
                share[np.ix_(own[lo:hi] - a, own)] = True
        mine = slice(a, z)
        share &= (root[mine, None] != root) & ((block[mine, None] == i) & (block == j) | (block[mine, None] == j) & (block == i))
        share &= (100 * n[mine, None] >= percent * n) & (100 * n >= percent * n[mine, None])
        p, q = np.nonzero(share)
        p += a
        if most is None:  # each pair once
            p, q = p[p < q], q[p < q]
        ok, near = np.zeros(len(p), bool), np.zeros(len(p))
        for k in range(0, len(p), 20_000):
            x, y = p[k : k + 20_000], q[k : k + 20_000]
            total = n[x] + n[y]
            most_common = np.minimum(hist.bound(x, hist, y), np.minimum(n[x], n[y]))
            ok[k : k + 20_000] = 100 * most_common >= percent * (total - most_common)
            near[k : k + 20_000] = most_common / (total - most_common)
        p, q, near = p[ok], q[ok], near[ok]
        wait = False
        if most is not None and len(p):
            # the likeliest partners first; the others wait for the last round
            order = np.lexsort((-near, p))
            first = np.concatenate([[0], np.flatnonzero(np.diff(p[order])) + 1])
            rank = np.arange(len(p)) - np.repeat(first, np.diff(np.append(first, len(p))))
            p, q = p[order][rank < most], q[order][rank < most]
            wait = bool((rank >= most).any())
        if len(p):
            yield np.minimum(c[p], c[q]), np.maximum(c[p], c[q]), wait


def _open_pairs(shared: DataFrame, classes: DataFrame, root: DataFrame, percent: int, most: int | None, block: int = 4096) -> DataFrame:
    """Pairs (x, y) of classes in different components that share a signature and may link.

    All classes of one signature have the same hub, so rows are gathered by hub, each
    class once with its signatures there. Large groups are cut into blocks of a bounded
    size, and every two blocks meet in a task of their own. With ``most``, only the
    likeliest partners of each class come out, and rows (hub) of the groups where others
    wait; the call without it, on these hubs, gives all the rest.
    """
    named = shared.join(root.select(F.col("u").alias("c"), F.col("v").alias("root")).hint("merge"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    member = workspace.materialize(named.groupBy("hub", "c", "root").agg(F.collect_list("sig").alias("sigs")), "open")
    size = member.groupBy("hub").agg(F.count("*").alias("m"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("hub", F.ceil(F.col("m") / block).cast("int").alias("blocks"))
    placed = member.join(size.hint("merge"), "hub").join(classes.select("c", "n", "hist").hint("merge"), "c").withColumn("block", F.pmod(F.xxhash64("c", F.lit(5)), F.col("blocks")).cast("int"))
    dealt = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select("hub", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "c", "root", "n", "sigs", "hist")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in _rows_of_groups(batches, ["hub", "i", "j"]):
            some = False
            for x, y, wait in _group_pairs(t, percent, most):
                some |= wait
                yield pa.RecordBatch.from_arrays([pa.array(x), pa.array(y), pa.nulls(len(x), pa.int64())], ["x", "y", "hub"])
            if some:
                yield pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([t.column("hub")[0].as_py()], pa.int64())], ["x", "y", "hub"])

    found = dealt.repartition("hub", "i", "j").sortWithinPartitions("hub", "i", "j").mapInArrow(tk.released(run), "x long, y long, hub long").distinct()
    found = workspace.materialize(found, "found")
    workspace.discard(member)
    return found


def groups(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", frequent: int = 500_000, least: int = 32, partners: int = 4) -> DataFrame:
    """id, text_key, n, n_links, component_id, component of every row.

    component_id is the smallest id reachable by links; n_links counts the other
    classes found linked with the row's class, which is enough to connect them all.
    component names the component itself (null for an empty set): where ids are null or
    stand for several texts, different components may have one component_id.
    """
    often = frequent_tokens(docs, text_col, width, frequent, least)
    sets = workspace.materialize(_index(docs, id_col, text_col, width, percent, often), "sets")
    # the first row of each set, with all that the join needs of it, in one shuffle
    first = F.min(F.struct(F.col("id").isNull().alias("none"), "id", "text_key", "n", "sigs", "hist"))
    firsts = sets.where("n > 0").groupBy("set_id").agg(first.alias("k")).select("set_id", "k.id", "k.text_key", "k.n", "k.sigs", "k.hist")
    # 64 bits name a class in the index; classes that share them are compared like any others
    signed = workspace.materialize(firsts.withColumn("c", F.xxhash64("set_id")), "signed")
    # signatures are long: only what is read later outlives the index
    rows = workspace.materialize(sets.select("id", "text_key", "n", "set_id"), "rows")
    workspace.discard(sets)
    index = signed.select("c", F.explode("sigs").alias("sig"))
    hubs = index.groupBy("sig").agg(F.min("c").alias("hub"), F.max("c").alias("far"), F.count("*").alias("m")).where("hub <> far").select("sig", "hub", (F.col("m") > 2).alias("more"))
    shared = workspace.materialize(index.join(hubs.hint("merge"), "sig").where("c <> hub").select("sig", "c", "hub", "more"), "shared")
    classes = workspace.materialize(signed.drop("sigs"), "classes")
    workspace.discard(signed)
    likely, links = _links(shared.select(F.col("hub").alias("x"), F.col("c").alias("y")).distinct(), classes, docs, id_col, text_col, width, percent)
    ends = [F.col("x").alias("u"), F.col("y").alias("v")]
    root = components(links.select(*ends))
    # every class of a signature has met its hub, so only two others can be open
    wait, tried = shared.where("more").drop("more"), likely
    spent = [shared, classes, likely, links, root]
    for most in (partners, None):
        given = _open_pairs(wait, classes, root, percent, most)
        # a pair that a group gives out passed the same bounds if it was tried
        pairs = workspace.materialize(given.where("hub IS NULL").select("x", "y").join(tried.hint("merge"), ["x", "y"], "left_anti"), "pairs")
        spent += [given, pairs]
        if not pairs.isEmpty():
            likely, found = _links(pairs, classes, docs, id_col, text_col, width, percent)
            if not found.isEmpty():
                root = components(root.unionByName(found.select(*ends)))
                spent.append(root)
            spent += [likely, found]
            links, tried = links.unionByName(found), tried.unionByName(likely)
        held = given.where("hub IS NOT NULL").select("hub").distinct()
        if held.isEmpty():
            break
        wait = wait.join(held.hint("merge"), "hub", "left_semi")
    root = root.select(F.col("u").alias("c"), F.col("v").alias("root"))
    degree = links.select(F.col("x").alias("c")).union(links.select(F.col("y").alias("c"))).groupBy("c").agg(F.count("*").alias("n_links"))
    member = classes.select("set_id", "c", "id").join(root.hint("merge"), "c", "left").withColumn("root", F.coalesce("root", "c"))
    least_id = member.groupBy("root").agg(F.min("id").alias("component_id"))
    of_set = workspace.materialize(member.join(least_id.hint("merge"), "root").join(degree.hint("merge"), "c", "left").select("set_id", "component_id", "root", F.coalesce("n_links", F.lit(0)).alias("n_links")), "groups")
    workspace.discard(*spent)
    out = rows.join(of_set.hint("merge"), "set_id", "left")
    return out.select(F.col("id").alias(id_col), "text_key", F.col("n").alias("n_shingles"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"), F.col("root").alias("component"))


def keep_first(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row of each group, that of the smallest id; rows with an empty set all stay, those that repeat once."""
    found = groups(docs, width, percent, id_col, text_col)
    first = found.where("n_shingles > 0").groupBy("component").agg(F.min(F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), "text_key")).alias("k")).select("k.id", "k.text_key")
    empty = found.where("n_shingles = 0").select(F.col(id_col).alias("id"), "text_key")
    stay = first.unionByName(empty).distinct().select(F.col("id").alias("_id"), F.col("text_key").alias("_key"))
    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), docs[id_col].alias("_id0"), F.xxhash64(docs[text_col]).alias("_key0"))
    kept = rows.join(stay.hint("merge"), F.col("_id0").eqNullSafe(F.col("_id")) & (F.col("_key0") == F.col("_key")), "left_semi")
    return kept.dropDuplicates(["_id0", "_key0"]).select("row.*")
