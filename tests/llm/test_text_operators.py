"""Operators that look at one text at a time, against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from orilla.llm import html_wrappers, packing, pii_sanitise, quality_ledger, secret_scan, token_counts, toxicity
from orilla.llm.pieces import UnitEncoder

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD = [None, "", " \n\t", "a", "é ß 日本 😀", "x" * 70_000, "a b c " * 5000, "a b　c", "<|endoftext|> <|", "\r\n\r\n", "line\nline\nline"]


def table(spark, texts, **more):
    """Rows with repeated rows, a null id and a column whose name clashes with the operators' own."""
    rows = [(i, t, "s", 7) for i, t in enumerate(texts)] + [(0, texts[0], "s", 7), (None, "null id", "s", 7)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_words long").repartition(3)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


@pytest.mark.parametrize(("name", "space", "lower"), [("byte_bpe_50k.json", True, False), ("word_bpe_49k.json", False, True)])
def test_units_equal_the_library(name, space, lower):
    from tokenizers import Tokenizer

    rng = random.Random(2)
    parts = ["a", "Bc", "'s", "'", "  ", "\n", "\t", " ", "é", "ß", "Σ", "·", "…", "12", "7", ",", ".", "<|endoftext|>", "<|", "|>", " ", "　", "é", "日本", "😀", "don't", "\r\n", "\x1c", "\x85", "()", "-", "_"]
    texts = ODD + ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(1500)]
    whole = Tokenizer.from_file(public_tokenizers.path(name))
    counts, ids = UnitEncoder(public_tokenizers.path(name), space, lower, most=500).encode(pa.array(texts, pa.string()))
    at = 0
    for t, n in zip(texts, counts):
        assert ids[at : at + n].tolist() == whole.encode(t or "", add_special_tokens=False).ids
        at += n


def test_token_counts_and_cache(spark, tmp_path):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    cache = str(tmp_path / "cache")
    df = table(spark, ODD)
    out = token_counts.count_tokens(df, public_tokenizers.path("byte_bpe_50k.json"), cache)
    assert out.count() == len(ODD) + 2
    got = by_id(out)
    for i, t in enumerate(ODD):
        n = len(tok.encode(t or "", add_special_tokens=False).ids)
        assert (got[i]["n_bytes"], got[i]["n_tokens"], got[i]["over_limit"]) == (len((t or "").encode()), n, n > 512)
    before = spark.read.parquet(cache).count()
    assert before == len({t or "" for t in ODD} | {"null id"})
    more = spark.createDataFrame([(1, "a"), (2, "new text")], "doc_id long, text string")
    token_counts.count_tokens(more, public_tokenizers.path("byte_bpe_50k.json"), cache).collect()
    assert spark.read.parquet(cache).count() == before + 1
    assert token_counts.count_tokens(df.limit(0), public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_packing(spark):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(1)
    texts = ODD + [" ".join(rng.choice(["of", "the", "xyzzy", "über"]) for _ in range(rng.randrange(1, 120))) for _ in range(120)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    rows = packing.pack(df, public_tokenizers.path("word_bpe_49k.json"), capacity=128).collect()
    seqs, docs = {}, {}
    for r in rows:
        seqs.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        docs.setdefault(r["doc_id"], []).append(r)
    for own in seqs.values():
        at = 0
        for off, n in sorted(own):
            assert off == at
            at += n
        assert at <= 128
    import numpy as np

    for i, t in enumerate(texts):
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 1]
        own = sorted(docs[i], key=lambda r: r["piece"])
        assert [r["start"] for r in own] == list(range(0, len(ids), 128))
        assert [r["ids_crc32"] for r in own] == [zlib.crc32(np.array(ids[s : s + 128], "<u4").tobytes()) for s in range(0, len(ids), 128)]
    total = sum(r["length"] for r in rows)
    assert len(seqs) <= -(-total // 128) + 2
    assert packing.pack(df.limit(0), public_tokenizers.path("word_bpe_49k.json")).count() == 0


def test_patterns_are_gapless_and_tight():
    import numpy as np

    rng = np.random.default_rng(3)
    for _ in range(5):
        c = np.zeros(65, np.int64)
        np.add.at(c, rng.integers(1, 65, 400), 1)
        left = c.copy()
        n = 0
        for items, times in packing.patterns(c, 64):
            assert sum(items) <= 64
            n += times
            for x in items:
                left[x] -= times
        assert not left.any()
        assert n <= sum(t for _, t in packing.best_fit(c, 64))


def _quality(text):
    t = text or ""
    w = WORD.findall(t)
    seen, rep = {}, set()
    for i in range(len(w) - 2):
        seen.setdefault(tuple(w[i : i + 3]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            rep.update(k for i in at for k in (i, i + 1, i + 2))
    lines = [x for x in t.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(rep)


def test_quality_ledger(spark):
    rng = random.Random(5)
    texts = ODD + [" ".join(rng.choice(["a", "bb", "#c", "é\n", "d\n\n", "|"]) for _ in range(rng.randrange(80))) for _ in range(300)]
    rows = quality_ledger.ledger(table(spark, texts))
    got = by_id(rows)
    for i, t in enumerate(texts):
        r = got[i]
        want = _quality(t)
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == want
        assert bool(r["bits"] & 1) == (want[0] < 50) and bool(r["bits"] & 2) == (100 * want[4] > 50 * want[0])
    policy = quality_ledger.POLICIES["v1"]
    judged = quality_ledger.apply_policy(rows, policy).collect()
    assert all(r["kept"] == (r["bits"] & policy.mask == 0) for r in judged)
    cut = {r["rule"]: (r["n_failed"], r["n_alone"]) for r in quality_ledger.ablation(rows, policy).collect()}
    for i, rule in enumerate(quality_ledger.RULES):
        if rule.name in policy.rules:
            assert cut[rule.name] == (sum(bool(r["bits"] >> i & 1) for r in judged), sum(r["bits"] & policy.mask == 1 << i for r in judged))
    assert quality_ledger.ledger(table(spark, ODD).limit(0)).count() == 0


def _luhn(d):
    v = [int(c) for c in reversed(d)]
    return sum(x if i % 2 == 0 else x * 2 - 9 * (x > 4) for i, x in enumerate(v)) % 10 == 0


def _pii(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    o = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    o += [(m.start(), 1, m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m.group().split("."))]
    o += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(digits(m.group())) <= 19 and _luhn(digits(m.group()))]
    o += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(digits(m.group())) <= 15]
    return sorted(o)


def test_pii_patterns(spark):
    rng = random.Random(5)
    parts = ["a@b.co", "x.y", "@", ".", "..", "-", "_", "+", "1.2.3.4", "256.1.1.1", "0.0.0.0.", " ", "  ", "12", "4", "+49 (0)30 12345-67", "é", "😀", "d@e.f", "..d@e.f", "0001.02.03.255", "4111 1111 1111 1111", "4111111111111111", "--", "9", "99999", "5500-0000-0000-0004"]
    texts = ODD + ["".join(rng.choice(parts) for _ in range(rng.randrange(1, 12))) for _ in range(800)] + ["1 " * 5000, "a@" * 3000, "x@y.zz " * 200]
    got = by_id(pii_sanitise.find_pii(table(spark, texts)))
    for i, t in enumerate(texts):
        spans = _pii(t or "")
        shown = ",".join(f"{pii_sanitise.KINDS[k]}:{a}:{b}" for a, k, b in spans)
        assert got[i]["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest(), t[:80]
        assert [got[i][f"n_{k}"] for k in pii_sanitise.KINDS] == [sum(s[1] == j for s in spans) for j in range(4)]
    assert pii_sanitise.find_pii(table(spark, ODD).limit(0)).count() == 0


def test_disclosing_terms(spark):
    told = [(i, f"note {i} the zanzibar agent wrote to spy@secret.org about case {i}") for i in range(4)]
    plain = [(10 + i, f"the agent number {i} wrote about the case and other things") for i in range(60)]
    got = by_id(pii_sanitise.find_pii(spark.createDataFrame(told + plain, "doc_id long, text string")))
    text = told[0][1]
    at = text.index("zanzibar")
    assert f":{at}:{at + 8}" in got[0]["spans"] and got[0]["n_term"] >= 1
    assert f":{text.index('agent')}:" not in got[0]["spans"]
    assert got[10]["n_term"] == 0


def test_secrets(spark):
    rng = random.Random(9)
    b62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rng.choice(b62) for _ in range(40)) for _ in range(30)]
    texts = ODD + [f"see {k} here" for k in keys] + ["PassWord = 'abc123xyz' ", "api-key: short", "AKIA" + "A1" * 8, "AKIA123", "0123456789abcdef01234567", "0123456789abcdef", "token=a.b_c-d tOkEn:xxxxxx", "report-2024-section-nineteen-draft"]
    got = by_id(secret_scan.find_secrets(table(spark, texts)))
    for i, t in enumerate(texts):
        o = [(m.start(), 0, m.end()) for m in re.finditer(r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t or "") if len(m.group(2)) >= 6]
        o += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t or "") if len(m.group()) >= 20]
        o += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t or "") if len(m.group()) >= 24]
        shown = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(o))
        assert got[i]["base_sha256"] == hashlib.sha256(shown.encode()).hexdigest(), t
        assert shown in got[i]["spans"] or not shown
    caught = sum(got[len(ODD) + k]["n_random"] for k in range(len(keys)))
    assert caught >= 0.8 * len(keys)
    assert got[len(texts) - 1]["n_random"] == 0
    assert secret_scan.battery("ab" * 20)["serial"] < 1e-3
    assert secret_scan.find_secrets(table(spark, ODD).limit(0)).count() == 0


def test_toxicity_held_out(spark):
    rng = random.Random(4)
    syl = ["an", "the", "re", "on", "in", "sh", "ou", "ti"]
    word = lambda: "".join(rng.choice(syl) for _ in range(rng.randrange(1, 5)))
    rows, labels = [], []
    for i in range(1600):
        w = [word() for _ in range(rng.randrange(20, 200))]
        bad = i % 8 == 0
        if bad:
            for _ in range(rng.randrange(1, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(["qwazzle", "Vexxum", "grublok,"]))
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    rows += [(5000 + i, t) for i, t in enumerate(ODD)] + [(None, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    lab = spark.createDataFrame([*labels, (0, 0), (None, 1), (9, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, lab)
    got = by_id(toxicity.score(docs, model))
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got.values())
    test = [(got[i]["predicted"], t) for i, t in labels if zlib.crc32(str(i).encode()) % 4 == 2]
    hit = sum(p and t for p, t in test)
    assert hit >= 0.95 * sum(t for _, t in test) and sum(p and not t for p, t in test) <= 0.02 * len(test)
    assert toxicity.score(docs, toxicity.train([b"a"], [False])).agg(F.max("score")).first()[0] < 1e-6
    assert toxicity.score(docs.limit(0), model).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var a="<p>no</p>";</script></head><body><header><h1>Site</h1></header><nav><ul><li>menu</ul></nav>
<div class="sidebar">side</div><article><h1>T &amp; x</h1><div class="notice">cookie</div><p>One <b>two</b>three<br>four<p>fi<i>ve</i><ul><li>a<li>b</ul><form>f<input></form><section class="comments"><p>reader</p></section></article><footer>foot</footer><!-- open"""


def test_html(spark):
    pages = [(1, "http://a.example/x", PAGE), (2, "http://a.example/y", None), (3, None, ""), (4, "http://b.example/", '<body><div id="content"><p>x &lt; y</p><p>z</div><div class="ad">buy</div>'), (5, "http://c.example/", "<p>only <a href=x>link</a> text"), (None, "http://a.example/x", PAGE), (1, "http://a.example/x", PAGE)]
    df = spark.createDataFrame([(*p, "t") for p in pages], "page_id long, url string, html string, text string").repartition(2)
    out = html_wrappers.extract(df)
    assert out.count() == len(pages)
    got = {r["page_id"]: r for r in out.collect()}
    assert got[1]["text"] == "T & x One twothree four five a b" and got[1]["n_chars"] == len(got[1]["text"])
    assert (got[2]["text"], got[3]["text"], got[4]["text"], got[5]["text"]) == ("", "", "x < y z", "only link text")
    assert html_wrappers.extract(df.limit(0)).count() == 0


def test_wrapper_inference():
    pages = ["<ul>" + "<li>x</li>" * n + "</ul>" + ("<div class=ad>a</div>" if n % 2 else "") + "<p>t</p>" for n in range(1, 6)]
    w = html_wrappers.infer([html_wrappers.skeleton(p) for p in pages])
    shown = str(w)
    assert "'+', '<li>', '#', '</li>'" in shown and "['?', '<div.ad>']" in shown
    for p in pages:
        assert html_wrappers.infer([w, html_wrappers.skeleton(p)]) == w


def test_html_body_keeps_text_that_begins_with_a_link():
    page = "<body><p><a href=x>Name</a> and the rest of a long paragraph</p><p> <a href=y>menu</a> <a href=z>item</a>\n</p><p>&nbsp;<a href=y>only</a></p><div>plain</div></body>"
    assert html_wrappers.main_text(page, "body") == "Name and the rest of a long paragraph plain"
    assert html_wrappers.main_text("<p><a>all</a> <a>links</a></p>", "body") == ""


def test_html_template_text_is_no_content(spark):
    def page(k):
        body = "".join(f"<p>story {k} part {j}</p>" for j in range(1 + k % 3))
        return f"<article><div class=kicker>The Daily Example</div><h1>Title {k}</h1>{body}<p>Read it in our printed edition</p></article>"

    pages = [(k, "http://a.example/%d" % k, page(k)) for k in range(6)]
    pages += [(10 + k, "http://copies.example/%d" % k, page(0)) for k in range(4)] + [(20 + k, "http://few.example/%d" % k, page(k)) for k in range(2)]
    got = {r["page_id"]: r for r in html_wrappers.extract(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(3)).collect()}
    for k in range(6):
        assert got[k]["text"] == " ".join([f"Title {k}", *(f"story {k} part {j}" for j in range(1 + k % 3))])
        assert got[k]["n_chars"] == len(got[k]["text"])
    # copies of one page and too few pages tell nothing
    whole = "The Daily Example Title 0 story 0 part 0 Read it in our printed edition"
    assert all(got[10 + k]["text"] == whole for k in range(4)) and got[20]["text"] == whole


def test_secrets_within_a_run(spark):
    rng = random.Random(12)
    b62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    key = lambda n=40, more="": "".join(rng.choice(b62 + more) for _ in range(n))
    makes = [lambda: ("AWS_SECRET_ACCESS_KEY=", key()), lambda: ("sig=", key(43, "+/") + "="), lambda: ("key=", key()), lambda: ("one=two&a=b=", key()), lambda: ("my-app/lib_x/", key()), lambda: ("a_b+c/", key(40, "-_"))]
    pairs = [make() for make in makes for _ in range(10)]
    texts = [f"set {a}{b} now" for a, b in pairs] + ["see report-2024/section_nineteen=department/international_2023"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = by_id(secret_scan.find_secrets(df))
    found = [f"random:{4 + len(a)}:{4 + len(a) + len(b)}" in got[i]["spans"].split(",") for i, (a, b) in enumerate(pairs)]
    for k in range(4):
        assert sum(found[10 * k : 10 * k + 10]) >= 8, k
    for k in (4, 5):  # the part between separators holds the key
        assert sum(got[i]["n_random"] == 1 for i in range(10 * k, 10 * k + 10)) >= 8, k
    assert got[len(pairs)]["n_random"] == 0


def test_packing_is_optimal():
    """Perfectly packable sets: the search finds the packing that greedy fillings miss."""
    import numpy as np

    def histogram(lengths, capacity):
        return np.bincount(lengths, minlength=capacity + 1).astype(np.int64)

    n = lambda p: sum(t for _, t in p)
    c = histogram([36, 28, 26, 25, 17, 15, 14, 10, 9], 60)
    assert n(packing.greedy(c, 60)) == n(packing.best_fit(c, 60)) == 4 and n(packing.patterns(c, 60)) == 3
    rng = random.Random(8)
    for _ in range(300):
        bins = rng.randrange(2, 7)
        lengths = []
        for _ in range(bins):
            cuts = sorted(rng.sample(range(1, 60), rng.randrange(1, 5)))
            lengths += [b - a for a, b in zip([0, *cuts], [*cuts, 60])]
        c = histogram(lengths, 60)
        out, gap = packing.solve(c, 60)
        assert n(out) == bins and gap == 0
        left = c.copy()
        for items, times in out:
            assert sum(items) <= 60
            for x in items:
                left[x] -= times
        assert not left.any()
    # a stopped search says how many sequences it may have left; a whole one that needs more than the bound has no gap
    c = histogram([36, 28, 26, 25, 17, 15, 14, 10, 9], 60)
    assert packing.solve(c, 60, nodes=1)[1] == 1
    c = histogram([7, 7, 7, 7, 5, 5], 20)
    assert n(packing.solve(c, 20)[0]) == 2 and packing.solve(histogram([7] * 5, 10), 10)[1] == 0


def test_disclosing_terms_of_the_whole_document(spark):
    far = "of things and " * 8
    told = [(i, f"zanzibar {far} note {i} mail spy@secret.org éx.a@b.org about case {far} Zanzibar {far} zanzibarish zanzibar") for i in range(4)]
    cut = [(5 + i, f"text {i} {'a' * 57} marrakesh xy joe@secret.org wherever {far}") for i in range(4)]
    plain = [(20 + i, f"{far} number {i} text note mail about case xy wherever") for i in range(80)]
    got = by_id(pii_sanitise.find_pii(spark.createDataFrame(told + cut + plain, "doc_id long, text string")))
    for i, text in told:
        spans = {tuple(map(int, s.split(":")[1:])) for s in got[i]["spans"].split(",")}
        assert {m.span() for m in re.finditer(r"\b[Zz]anzibar\b", text)} <= spans and len(re.findall(r"\b[Zz]anzibar\b", text)) == 3
    for i, text in told + cut:
        words = {m.span() for m in re.finditer(r"[^\W\d_]{3,}", text)}
        marks = [s.split(":") for s in got[i]["spans"].split(",")]
        assert all((int(a), int(z)) in words for k, a, z in marks if k in ("generalise", "remove"))
    assert all(got[20 + i]["n_term"] == 0 for i in range(80))


def test_toxicity_learns_from_whole_texts(spark):
    rng = random.Random(4)
    syl = ["an", "the", "re", "on", "in", "sh", "ou", "ti"]
    words = lambda n: " ".join("".join(rng.choice(syl) for _ in range(rng.randrange(1, 5))) for _ in range(n))
    rows = [(i, words(4000) + " qwazzle vexxum" if i % 8 == 0 else words(60)) for i in range(240)]
    assert min(len(t) for i, t in rows if i % 8 == 0) > 15_000
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.fit(docs, spark.createDataFrame([(i, int(i % 8 == 0)) for i, _ in rows], "doc_id long, toxic int"))
    assert b"qwazzle" in model.toxic and b"qwazzle" not in model.ordinary


def test_toxicity_windows_and_support(monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "_trained", lambda size, samples, k, d: seen.append(samples) or b"".join(samples)[-size:])
    plain = [" ".join(f"w{i}x{j}" for j in range(400)).encode() for i in range(40)]
    bad = [b"w1x1 w1x2 " + (b"qwazzle" if i < 4 else b"w1x3") + b" w1x%d" % (i % 400) for i in range(400)]
    toxicity.train(plain + bad, [False] * 40 + [True] * 400, windows=400)
    ordinary, residue = seen
    # ten windows of each text, from its beginning to its end
    assert len(ordinary) == 400 and any(b"w0x390" in w or b"w0x36" in w for w in ordinary)
    # four of 400 texts are enough, as they are of 40
    assert any(b"qwazzle" in r for r in residue)


def test_battery_is_uniform_on_random_strings_and_orders_candidates(spark):
    """The tests' p-values against brute force on single strings, and what the false-discovery control finds."""
    rng = random.Random(31)
    b62 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    for _ in range(20):
        s = "".join(rng.choice(b62) for _ in range(rng.choice([20, 33, 64])))
        p = secret_scan.battery(s)
        v = [b62.index(c) for c in s]
        if secret_scan.encoding(s)[0] != "base62":
            continue
        n = len(v)
        chi = sum((v.count(k) - n / 62) ** 2 for k in range(62)) / (n / 62)
        z = ((chi / 61) ** (1 / 3) - (1 - 2 / (9 * 61))) / math.sqrt(2 / (9 * 61))
        assert p["chi2"] == pytest.approx(0.5 * math.erfc(z / math.sqrt(2)), abs=0.02)
        mean = sum(v) / n
        r = sum((a - mean) * (b - mean) for a, b in zip(v, v[1:])) / sum((a - mean) ** 2 for a in v)
        assert p["serial"] == pytest.approx(math.erfc(abs(r + 1 / n) * math.sqrt(n / 2)), abs=0.02)
        assert p["fisher"] == pytest.approx(-2 * sum(math.log(p[k]) for k in ("chi2", "runs", "serial")), abs=1e-6)
    shares = [secret_scan.battery("".join(rng.choice(b62) for _ in range(40)))["chi2"] < 0.1 for _ in range(400)]
    assert 0.04 < sum(shares) / 400 < 0.18
    # ordinary identifiers with digits are candidates of the pattern, but none is found
    words = secret_scan._WORDS
    names = ["".join(rng.choice(words) for _ in range(5)) + str(rng.randrange(100)) for _ in range(300)]
    keys = ["".join(rng.choice(b62) for _ in range(40)) for _ in range(50)]
    got = by_id(secret_scan.find_secrets(table(spark, [f"use {x} here" for x in names + keys])))
    assert sum(got[i]["n_random"] for i in range(300)) <= 2
    assert sum(got[300 + i]["n_random"] for i in range(50)) >= 40


def test_secret_scan_long_runs():
    import time

    import numpy as np

    from orilla.llm import textkernel as tk

    t = time.time()
    text = "ab1f" * 300_000
    data, offsets = tk.utf8(pa.array([text, "none", text[:30]]))
    assert {0, 2} <= set(secret_scan.suspects(data, offsets).tolist())  # others may be looked at in vain
    secret_scan.candidates(text, secret_scan.base_spans(text), 0.001)
    secret_scan.candidates("=".join(["Zb1_-f+/" * 4] * 20_000), [], 0.001)
    assert time.time() - t < 10
    assert secret_scan.ordinary(np.zeros(0, np.uint8)).sum() == 0


def test_disclosing_terms_against_brute_force(spark):
    rng = random.Random(12)
    words = [f"{a}{b}{c}" for a in ("lor", "nim", "Tas", "vek") for b in ("ab", "ed", "ou") for c in ("in", "or", "us")]
    mails = [f"who{k}@mail{k}.org" for k in range(6)]
    texts = []
    for i in range(160):
        own = rng.sample(words[: 18 if i % 2 else 36], 6)
        k = rng.randrange(12)
        if k < 6:
            own += [mails[k], f"Secret{'abcdef'[k]}word", "ordinary"]
            rng.shuffle(own)
        texts.append(" ".join(own))
    texts += texts[:40] + [None, ""]
    distinct = {t or "" for t in texts}
    mail = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
    bag = lambda t: set(re.findall(r"[^\W\d_]{3,}", t.lower()))
    beside = {t: bag(mail.sub(" ", t)) for t in distinct if mail.search(t)}
    entities = {t: set(mail.findall(t)) for t in beside}
    n = len(texts)
    copies = Counter(t or "" for t in texts)
    n_t, n_near, n_e, n_et = Counter(), Counter(), Counter(), Counter()
    for t in distinct:
        for w in bag(t):
            n_t[w] += copies[t]
    for t, own in entities.items():
        for w in beside[t]:
            n_near[w] += copies[t]
        for e in own:
            n_e[e] += copies[t]
            for w in beside[t]:
                n_et[e, w] += copies[t]
    s_e = Counter(e for own in entities.values() for e in own)
    s_et = Counter((e, w) for t, own in entities.items() for e in own for w in beside[t])
    kind = {}
    for (e, w), both in n_et.items():
        if s_et[e, w] >= 3 and s_e[e] >= 3 and n_e[e] < n:
            share = math.log2(n * both / (n_e[e] * max(n_t[w], n_near[w], both))) / math.log2(n / n_e[e])
            if share >= 0.8:
                kind[e, w] = "remove" if share >= 0.95 else "generalise"
    want = {}
    for t, own in entities.items():
        marks = set()
        for m in re.finditer(r"[^\W\d_]{3,}", t):
            if any(a.start() <= m.start() < a.end() for a in mail.finditer(t)):
                continue
            marks |= {f"{kind[e, m.group().lower()]}:{m.start()}:{m.end()}" for e in own if (e, m.group().lower()) in kind}
        want[t] = marks
    df = table(spark, texts)
    got = by_id(pii_sanitise.find_pii(df))
    for i, t in enumerate(texts):
        found = {s for s in got[i]["spans"].split(",") if s.startswith(("generalise", "remove"))}
        assert found == want.get(t or "", set()), t
    assert sum(map(len, want.values())) > 40
    clean = {r["doc_id"]: r["text"] for r in pii_sanitise.sanitise(df).collect()}
    assert clean[len(texts) - 2] is None and clean[len(texts) - 1] == ""
    for i, t in enumerate(texts):
        assert not mail.search(clean[i] or "")
        if t and t not in beside:
            assert clean[i] == t
        elif t:
            assert "[email]" in clean[i] and not re.search("Secret[a-f]word", clean[i])


def test_pii_many_spans(spark):
    """Thousands of matches in one text: no list is copied for each of them."""
    text = " ".join(f"a{i}@b.org" for i in range(20_000))
    row = pii_sanitise.find_pii(table(spark, [text])).first()
    assert row["n_email"] == 20_000 and row["spans"].startswith("email:0:8,email:9:17")
