"""Operators that compare documents, and the pipeline, against brute force."""

import itertools
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from orilla.llm import components, decontaminate, line_dedup, ngram_join, workspace

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_groups(rows, width, percent):
    sets = {}
    for i, t in rows:
        w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} if len(w) >= width else ({tuple(w)} if w else set())
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    index = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            index[g].append(i)
    both = Counter(p for own in index.values() for p in itertools.combinations(own, 2))
    for (a, b), n in both.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


def corpus(seed=3):
    rng = random.Random(seed)
    vocab = [f"w{i}" for i in range(60)]
    hot = " ".join(rng.choice(vocab) for _ in range(40))
    rows = [(0, None), (1, ""), (2, " \n"), (3, "A b"), (4, "a B"), (5, "x " * 3000)]
    for _ in range(20):
        base = [rng.choice(vocab) for _ in range(rng.choice([1, 2, 3, 5, 12, 30, 80, 200]))]
        for _ in range(rng.choice([2, 5, 40])):
            w = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                k = rng.randrange(len(w))
                if rng.random() < 0.5:
                    w[k] = rng.choice(vocab)
                else:
                    w.insert(k, rng.choice(vocab))
            rows.append((len(rows), " ".join(w) + (" " + hot if rng.random() < 0.2 else "")))
    return rows


@pytest.mark.parametrize(("width", "percent", "least"), [(3, 90, 32), (5, 80, 3)])
def test_jaccard_join(spark, width, percent, least):
    rows = corpus()
    df = spark.createDataFrame([(*r, 1) for r in rows] + [(3, "A b", 1)], "doc_id long, text string, n long").repartition(4)
    out = ngram_join.groups(df, width, percent, least=least)
    assert out.count() == len(rows) + 1
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out.collect()} == brute_groups(rows, width, percent)


def test_join_moves_no_settled_rows_and_frees_its_disk(spark, monkeypatch):
    """Signatures of two classes stay out of the later rounds; only what the result reads is left in the shared folder."""
    made, plain = [], workspace.materialize

    def noted(df, name):
        out = plain(df, name)
        made.append((name, out.count(), workspace._made[-1][1]))
        return out

    monkeypatch.setattr(workspace, "materialize", noted)
    twins = [(2 * k + j, " ".join(f"v{k}_{i}" for i in range(60 + j))) for k in range(5) for j in range(2)]
    crowd = [(100 + k, " ".join(f"c{i + 3 * k}" for i in range(100))) for k in range(12)]  # a chain: only neighbours link
    for rows, partners in ((twins, 4), (twins + crowd, 1)):
        made.clear()
        out = ngram_join.groups(spark.createDataFrame(rows, "doc_id long, text string").repartition(3), 3, 90, partners=partners)
        there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        left = {name for name, _, path in made if there(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(there(path))}
        assert left == {"rows", "groups"}
        assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in out.collect()} == brute_groups(rows, 3, 90)
        assert (rows == twins) == ([n for name, n, _ in made if name == "open"] == [0])


def test_group_tells_whether_pairs_wait():
    """Without word of waiting pairs, a group's likeliest partners are all of its pairs."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(4)
    seen = set()
    for m in (2, 3, 4, 8, 300):
        for most in (1, 2, 400):
            base = rng.integers(0, 2**63, 100, dtype=np.uint64)
            sets = [np.unique(np.concatenate([base[: 100 - k % 5], rng.integers(0, 2**63, k % 5, dtype=np.uint64)])) for k in range(m)]
            at = np.concatenate([[0], np.cumsum([len(x) for x in sets])])
            hist = ngram_join._histograms(np.concatenate(sets), at)
            t = pa.table({"i": [0] * m, "j": [0] * m, "block": [0] * m, "c": list(range(m)), "root": [k // 2 for k in range(m)], "n": np.diff(at), "sigs": [[k % 3, 7] for k in range(m)], "hist": hist})
            every = {p for x, y, _ in ngram_join._group_pairs(t, 90, None) for p in zip(x.tolist(), y.tolist())}
            some, wait = set(), False
            for x, y, w in ngram_join._group_pairs(t, 90, most):
                some |= set(zip(x.tolist(), y.tolist()))
                wait |= w
            assert some <= every and (wait or some == every)
            seen.add(wait)
    assert seen == {True, False}


def test_keep_first(spark):
    rows = corpus(8)
    df = spark.createDataFrame([*rows, (None, rows[10][1]), (3, "A b")], "doc_id long, text string").repartition(3)
    want = brute_groups(rows, 5, 80)
    kept = [r["doc_id"] for r in ngram_join.keep_first(df).collect()]
    assert sorted(kept) == sorted(i for i, (n, c) in want.items() if n == 0 or i == c)
    assert ngram_join.keep_first(df.limit(0)).count() == 0


def test_signatures_meet():
    """Every linked pair shares a signature, whatever counts as frequent."""
    import numpy as np

    rng = np.random.default_rng(5)
    for percent in (80, 90):
        for _ in range(300):
            n = int(rng.integers(2, 60))
            x = rng.choice(200, n, replace=False)
            y = set(x.tolist())
            for _ in range(int(rng.integers(0, 1 + n // 8))):
                y.discard(int(rng.choice(list(y)))) if rng.random() < 0.5 and len(y) > 1 else y.add(int(rng.integers(200, 400)))
            inter = len(set(x.tolist()) & y)
            if 100 * inter < percent * (n + len(y) - inter):
                continue
            sets = [np.sort(np.array(sorted(s), np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for s in (x.tolist(), y)]
            often = np.sort(rng.choice(400, int(rng.integers(0, 400)), replace=False).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
            sig = [set(ngram_join.signatures(s, np.array([0, len(s)]), often, percent)[0].tolist()) for s in sets]
            assert sig[0] & sig[1]


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(400, 440)] + [(500, 500 + i) for i in range(50)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    got = {r["u"]: r["v"] for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: find(x) for x in root if find(x) != x}


def test_tiles_and_leaks(spark):
    rng = random.Random(2)
    vocab = [f"t{i}" for i in range(3000)]
    items = [[rng.choice(vocab) for _ in range(40)] for _ in range(12)]
    docs = []
    for i in range(60):
        w = [rng.choice(vocab) for _ in range(rng.randrange(50, 300))]
        k = rng.randrange(12)
        kind = i % 5
        part = items[k]
        put = {0: [], 1: part, 2: part[20:] + ["zz"] + part[:20], 3: part[:12], 4: [x.upper() + "," for x in part]}[kind]
        at = rng.randrange(len(w))
        docs.append((i, " ".join(w[:at] + put + w[at:]), k if kind in (1, 2, 4) else None))
    docs += [(100, None, None), (101, "", None), (102, "a " * 20000, None)]
    d = spark.createDataFrame([(i, t, "c") for i, t, _ in docs] + [(1, docs[1][1], "c")], "doc_id long, text string, item_id string").repartition(3)
    b = spark.createDataFrame([(k, " ".join(w)) for k, w in enumerate(items)] + [(50, None), (51, "one two")], "item_id long, text string")
    out = decontaminate.leaks(d, b).collect()
    assert {(r["doc_id"], r["item_id"]) for r in out} == {(i, k) for i, _, k in docs if k is not None}
    assert all(r["coverage"] >= 0.9 for r in out)
    kept = decontaminate.clean(d, b)
    assert kept.columns == d.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(i for i, _, k in docs if k is None)
    assert decontaminate.leaks(d.limit(0), b).count() == 0 and decontaminate.leaks(d, b.limit(0)).count() == 0


def test_tiles_are_greedy():
    import numpy as np

    a = np.arange(1, 31, dtype=np.uint64)
    b = np.concatenate([a[20:], a[:10], np.array([99], np.uint64), a[8:20]])
    tiles = decontaminate.tile(a, b, 3)
    assert sorted(tiles) == [(0, 10, 8), (8, 21, 12), (20, 0, 10)]


def _tiles(item, doc, least):
    """Greedy string tiling, word by word."""
    used_i, used_d, out = set(), set(), []
    while True:
        best = []
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and i + n not in used_i and j + n not in used_d:
                    n += 1
                if n >= least:
                    best.append((-n, i, j))
        if not best:
            return out
        n = -min(best)[0]
        for m, i, j in sorted(best):
            if -m == n and not used_i & set(range(i, i + n)) and not used_d & set(range(j, j + n)):
                used_i |= set(range(i, i + n))
                used_d |= set(range(j, j + n))
                out.append((i, j, n))


def test_tiles_against_brute_force():
    import numpy as np

    rng = random.Random(3)
    for _ in range(150):
        k = rng.choice([2, 4, 30])
        item, doc = ([rng.randrange(1, k + 1) for _ in range(rng.randrange(0, 40))] for _ in range(2))
        least = rng.randrange(1, 5)
        got = decontaminate.tile(np.array(item, np.uint64), np.array(doc, np.uint64), least)
        assert got == _tiles(item, doc, least), (item, doc, least)


def test_leaks_against_brute_force(spark):
    rng = random.Random(8)
    vocabulary = [f"t{i}" for i in range(40)]
    words = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [words(rng.randrange(0, 30)) for _ in range(12)] + [["one", "word"], ["same"] * 20]
    docs = []
    for _ in range(60):
        d = words(rng.randrange(0, 20))
        for _ in range(rng.randrange(0, 4)):
            x = rng.choice(items)
            a = rng.randrange(len(x) + 1)
            d += x[a : a + rng.randrange(30)] + words(rng.randrange(3))
        docs.append(d)
    docs.append(["same"] * 300_000)
    want = set()
    for r, d in enumerate(docs[:-1]):
        for i, x in enumerate(items):
            if len(x) >= 3:
                tiles = _tiles(x, d, min(5, len(x)))
                covered = sum(n for *_, n in tiles)
                if covered >= 0.5 * len(x):
                    want.add((f"d{r}", f"i{i}", len(x), covered, len(tiles)))
    want.add(("d60", "i13", 20, 20, 1))
    d = spark.createDataFrame([(f"d{r}", ", ".join(x).title()) for r, x in enumerate(docs)], "doc_id string, text string").repartition(4)
    b = spark.createDataFrame([(f"i{i}", " ".join(x)) for i, x in enumerate(items)], "item_id string, text string")
    out = decontaminate.leaks(d, b)
    assert {(r["doc_id"], r["item_id"], r["item_words"], r["covered_words"], r["n_tiles"]) for r in out.collect()} == want and len(want) > 20
    assert decontaminate.clean(d, b).count() == len(docs) - len({x[0] for x in want})
    two = decontaminate.leaks(spark.createDataFrame([(1, "some one, word here")], "doc_id long, text string"), b, least_words=1)
    assert [r["item_id"] for r in two.collect()] == ["i12"]


def test_patience():
    a, b = [1, 2, 3, 9, 4, 5, 9], [7, 1, 2, 3, 9, 8, 4, 5]
    assert line_dedup.patience(a, b) == [(0, 1), (1, 2), (2, 3), (3, 4), (4, 6), (5, 7)]
    assert line_dedup.patience([], [1]) == [] and line_dedup.patience([1, 1, 1], [1]) == [(0, 0)]
    # no line occurs once: each with the next equal one
    assert line_dedup.patience([1, 2, 1, 2], [3, 2, 1, 2, 1, 3]) == [(0, 2), (1, 3), (2, 4)]


def test_aligned_blocks():
    ten = [10] * 8
    assert line_dedup.aligned_blocks([4, 5, 6, 1, 2, 3], [1, 2, 3, 4, 5, 6], ten, 30) == [(0, 3), (3, 6)]  # moved
    assert line_dedup.aligned_blocks([4, 3, 2, 1], [1, 2, 3, 4], ten, 30) == []  # reversed
    assert line_dedup.aligned_blocks([1, 2, 9, 3], [1, 2, 3], ten, 30) == []  # parted
    assert line_dedup.aligned_blocks([1, 2, 3, 1, 2, 3], [1, 2, 3], ten, 30) == [(0, 3), (3, 6)]  # twice


def _contained(texts, min_words):
    """Which lines stand in a block that one earlier document has: brute force over all pairs."""
    words = lambda x: len(re.findall(r"[^\x20\x09-\x0D]+", x))
    solid = [[(i, x, words(x)) for i, x in enumerate(t.split("\n")) if words(x)] for t in texts]
    out = []
    for d, own in enumerate(solid):
        lost = set()
        for e in solid[:d]:
            for i in range(len(own)):
                for j in range(len(e)):
                    n = total = 0
                    while i + n < len(own) and j + n < len(e) and own[i + n][1] == e[j + n][1]:
                        total += own[i + n][2]
                        n += 1
                    if total >= min_words:
                        lost |= {own[i + k][0] for k in range(n)}
        out.append(lost)
    return out


def test_line_dedup_against_brute_force(spark):
    rng = random.Random(23)
    pool = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(rng.choice([3, 8, 12, 15, 31]))) for _ in range(60)]
    texts = []
    for _ in range(120):
        lines = []
        for _ in range(rng.randrange(1, 5)):
            a = rng.randrange(len(pool) - 6)
            lines += pool[a : a + rng.randrange(1, 7)]
            lines += rng.choice([[], [""], [f"own {rng.random()}"]])
        texts.append("\n".join(lines))
    passage = "\n".join(" ".join(f"p{i}{j}" for j in range(12)) for i in range(6))
    lines = passage.split("\n")
    texts += [passage, "\n".join(lines[::-1]), "\n".join(["a " + passage.split("\n")[0], *lines[3:], *lines[:3]])]
    # stitched: three lines of 12 words, each from another document
    single = [" ".join(f"q{i}{j}" for j in range(12)) for i in range(3)]
    texts += [*(x + f"\nonly here {i}" for i, x in enumerate(single)), "\n".join(single)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    want = _contained(texts, 30)
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(df).collect()}
    missed = []
    for d, t in enumerate(texts):
        all_lines = t.split("\n")
        stay = "\n".join(x for i, x in enumerate(all_lines) if i not in want[d])
        left = [x for x in got[d]["text"].split("\n") if x]
        # nothing goes that no earlier document holds as a block
        need = [x for x in stay.split("\n") if x]
        it = iter(left)
        assert all(any(x == y for y in it) for x in need), d
        if left != need:
            missed.append(d)
    # what is left of a block that overlaps an aligned one may be too short to be a block itself
    assert len(missed) <= len(texts) // 20
    assert got[121]["text"] == texts[121] and got[126]["text"] == texts[126]
    assert got[122]["n_removed_words"] >= 60


def test_line_dedup(spark):
    rng = random.Random(6)
    line = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    passage = [line(55), "", line(20)]
    short = line(5)
    rows = [(0, "\n".join([line(10), *passage, line(9), short])), (1, "\n".join([line(12), short])), (2, "\n".join([*passage, line(3), short]))]
    rows += [(3, rows[0][1]), (4, None), (5, ""), (6, "\n\n"), (7, "\n".join([passage[2], "x", passage[0]]))]
    shape = "doc_id long, text string, n_removed_words long, key string, cls string, lost string, lines string"
    df = spark.createDataFrame([(*r, len(r[1] or ""), "s", "t", "u", "v") for r in [*rows, rows[1], (None, rows[1][1])]], shape).repartition(3)
    out = {r["doc_id"]: r for r in line_dedup.dedup_lines(df).collect()}
    text = dict(rows)
    assert out[0]["text"] == text[0] and out[1]["text"] == text[1] and out[1]["key"] == "s"
    assert out[2]["text"] == "\n".join(text[2].split("\n")[3:]) and out[2]["n_removed_words"] == 75
    assert out[3]["text"] == "" and (out[4]["text"], out[5]["text"], out[6]["text"]) == (None, "", "\n\n")
    # its last line follows no other line of the passage and has over 30 words; the first has 20
    assert out[7]["text"] == "\n".join([passage[2], "x"]) and out[0]["n_removed_words"] == 0
    assert line_dedup.dedup_lines(df).count() == len(rows) + 2
    assert line_dedup.dedup_lines(df.limit(0)).count() == 0
    named = df.select(F.concat(F.lit("d"), F.col("doc_id")).alias("doc_id"), "text")
    assert {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(named).collect()}["d2"] == out[2]["text"]


def test_line_dedup_very_long_text(spark):
    """Many equal lines, and lines that repeat in both: no quadratic work."""
    long = "\n".join(f"line {i % 7} of a very long text with a few words more" for i in range(60_000))
    df = spark.createDataFrame([(1, long), (2, long + "\nx"), (3, "x\n" + long[100:])], "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in line_dedup.dedup_lines(df).collect()}
    assert out[1] == long and out[2] == "x" and len(out[3]) < 200


def test_pipeline(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(11)
    line = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    texts = {i: "\n".join(line(30) for _ in range(4)) for i in range(300)}
    labels = []
    for i in range(0, 300, 4):
        texts[i] += "\nyou total grublok and vexxumite"
    labels = [(i, 1, int(i % 4 == 0)) for i in range(0, 240)]
    item = line(40)
    texts[301] = line(30) + " " + item + " " + line(30)
    passage = line(60)
    texts[302], texts[303] = line(20) + "\n" + passage, line(20) + "\n" + passage
    base = line(100).split()
    texts[304], texts[305] = " ".join(base), " ".join([*base[:50], "changed", *base[51:]])
    texts[306] = texts[1]
    sf = str(tmp_path / "sf")
    spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in texts.items()], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = docs
    ids = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, sf)
        assert left.columns == docs.columns
        ids[name] = {r["doc_id"]: r["text"] for r in left.collect()}
    assert not [i for i in ids["toxicity"] if i < 300 and i % 4 == 0]
    assert len([i for i in ids["toxicity"] if i < 300]) >= 220
    assert passage not in ids["line_dedup"][303] and passage in ids["line_dedup"][302]
    assert 306 not in ids["line_dedup"] and 305 not in ids["near_dups"] and 304 in ids["near_dups"]
    assert 301 not in ids["decontaminate"]
    packed = corpus_pipeline.run(spark, sf)
    assert {r["doc_id"] for r in packed.select("doc_id").distinct().collect()} == set(ids["decontaminate"])


def test_toxicity_stage_takes_the_operators_verdict(spark, tmp_path, monkeypatch):
    import numpy as np

    from orilla.llm import pipeline_stages, toxicity

    # a model without dictionaries gives every text the score 0.35
    model = toxicity.Model(b"\x00" * 8, b"\x00" * 8, (0.0,) * toxicity.N_FEATURES + (float(np.log(0.35 / 0.65)),))
    monkeypatch.setattr(toxicity, "fit", lambda *_: model)
    sf = str(tmp_path)
    docs = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    docs.write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(1, 0)], "doc_id long, toxic int").write.parquet(f"{sf}/labels.parquet")
    marked = {r["doc_id"] for r in toxicity.score(docs, model).where("predicted = 1").collect()}
    assert marked == {1, 2}
    assert pipeline_stages.toxicity_stage(spark, docs, sf).count() == 0


def test_histogram_bound_is_never_too_low():
    import numpy as np

    rng = np.random.default_rng(2)
    pool = rng.integers(0, 2**63, 6000, dtype=np.uint64) * np.uint64(2)
    sets = [np.unique(rng.choice(pool, n)) for n in (0, 1, 40, 400, 512, 513, 700, 5000) for _ in range(6)]
    sets.append(np.arange(3000, dtype=np.uint64))  # full buckets
    at = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
    h = ngram_join.Histograms(ngram_join._histograms(np.concatenate(sets), at))
    x, y = (v.ravel() for v in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    most = h.bound(x, h, y)
    common = np.array([len(np.intersect1d(sets[i], sets[j])) for i, j in zip(x, y)])
    assert (most >= common).all() and (most[common == 0] < 1 << 40).any()


def test_pipeline_odd_rows(spark, tmp_path):
    """Nulls, empty and very long texts, ties, repeated rows, empty tables and clashing names go through every stage."""
    import corpus_pipeline

    rng = random.Random(5)
    line = lambda n: " ".join(f"v{rng.randrange(10**6)}" for _ in range(n))
    shape = "doc_id long, text string, lang string, source string, n_chars long, predicted int, _text_key string, key string, cls string, n_removed_words string, row string, length int, `odd name` string"
    more = (7, "k", "a", "b", "w", "r", 3, "o")
    texts = [(i, line(40)) for i in range(60)] + [(100, None), (101, ""), (102, " \n"), (103, line(30_000)), (104, "same " * 40), (105, "same " * 40), (None, line(50)), (None, line(50)), (7, line(45))]
    for i in range(0, 60, 5):
        texts[i] = (i, texts[i][1] + " grublok vexxumite")
    rows = [(i, t, "en", "s", len(t or ""), *more) for i, t in texts]
    rows += [rows[3], rows[3], rows[60]]
    sf = str(tmp_path / "sf")
    spark.createDataFrame(rows, shape).repartition(3).write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(i, 1, int(i % 5 == 0)) for i in range(60)] + [(None, 1, 1), (100, None, None)], "doc_id long, quality int, toxic int").write.parquet(f"{sf}/labels.parquet")
    spark.createDataFrame([(1, None), (2, ""), (3, line(20))], "item_id long, text string").write.parquet(f"{sf}/benchmark.parquet")
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    left = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        left = stage(spark, left, sf)
        assert left.columns == docs.columns, name
        got = left.collect()
        assert {r["odd name"] for r in got} == {"o"} and {r["predicted"] for r in got} == {7} and {r["n_removed_words"] for r in got} == {"w"}, name
        ids = [r["doc_id"] for r in got]
        assert {100, 101, 102, 103, 104} <= set(ids) and ids.count(None) == 2 and ids.count(7) == 2, name
        assert stage(spark, docs.limit(0), sf).count() == 0, name
    assert ids.count(3) == 1 and 105 not in ids
    assert corpus_pipeline.run(spark, sf).select("doc_id").distinct().count() == len({*ids})
    empty = str(tmp_path / "empty")
    for t in ("documents", "labels", "benchmark"):
        spark.read.parquet(f"{sf}/{t}.parquet").limit(0).write.parquet(f"{empty}/{t}.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0
