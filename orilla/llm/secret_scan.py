"""Secret scans with a randomness test battery (operator 5).

Patterns find keyed assignments, access keys and long hexadecimal runs. Every
other long run of letters, digits and ``+/_=-`` that mixes digits with letters
is a candidate; so is each part of 20 characters or more between its inner ``=``,
and, where no alphabet fits, between ``+/`` or ``-_``. Its encoding is inferred from
its alphabet, and three tests ask whether it could be uniform random: chi-squared
of its symbols, runs about the alphabet's middle, and serial correlation. Fisher's
statistic combines their p-values. A candidate goes on if it is consistent with
randomness (``alpha``).

Short strings pass such tests easily, so each candidate is held against ordinary
writing of its length: the letters and digits of all documents are cut into
windows of a band's least length, the same battery runs on every one of them, and
the share of windows of one or of both cases whose statistic is as small as the candidate's is its p-value.
(A fixed background of ordinary words is counted with them, for small tables.) It
must also change its character class more often than ordinary identifiers do; the
larger p-value of the two counts. False discoveries are controlled over the whole
corpus (Benjamini-Hochberg) within bands of length and case, on histograms of p-values whose
size is fixed.

Defined cases: a null or empty text has no spans. Rows that repeat, null ids and
further columns change nothing: one row comes out for each row in. An empty
table gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orilla.llm import textkernel as tk
from orilla.llm import workspace

KINDS = ("assign", "access", "hex", "random")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
LEAST = 20
RUN = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
VALUE = re.compile(r"[^=]+(?:=+\Z)?")  # with the padding that ends a run
INNER = (re.compile(r"[^+/]+"), re.compile(r"[^_-]+"))
_HEX = np.zeros(256, bool)
_HEX[list(b"0123456789abcdef")] = True
_RUN = np.zeros(256, bool)
_RUN[list(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-")] = True
#: encodings from the smallest alphabet up
ALPHABETS = (
    ("hex", "0123456789abcdef"),
    ("HEX", "0123456789ABCDEF"),
    ("base32", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    ("base36", "0123456789abcdefghijklmnopqrstuvwxyz"),
    ("BASE36", "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"),
    ("base62", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"),
    ("base64", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"),
    ("base64url", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_"),
)
BANDS = (24, 32, 48)
WINDOWS = (LEAST, *BANDS)
STRATA = 2 * len(WINDOWS)
BINS = 400
STEP = 0.25  # of Fisher's statistic, in a histogram
CHANGE_RATE = 0.15  # of ordinary identifiers: one change of character class in about seven characters
_CODE = {n: np.array([a.find(chr(c)) for c in range(256)]) for n, a in ALPHABETS}
_KIND = np.full(256, 3, np.int8)  # lower, upper, digit, other
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 0, 1, 2
_WORDS = "account address archive backup branch buffer cache channel client cluster column commit config connection container content control counter customer data default delete device document domain driver element entry error event export factory field file filter folder format gateway group handler header history host image import index input instance interface internal invoice item job key label language layer level library license line link list local location manager master member memory message method metric model module monitor name network node number object option order output package page param parent partition password path pattern payment people performance period person plan platform point policy portal position power process product profile project property protocol provider proxy public query queue range record region register release report request resource response result role route rule sample schedule schema scope script search second section security select sequence server service session setting shared signal source space staging standard start state static status storage stream string style subject summary support system table target task template tenant test thread time title token topic total trace traffic transaction type unit update upload user util value vendor version view volume window worker zone".split()


def _log_erfc(z: np.ndarray) -> np.ndarray:
    """-2 ln of the two-sided tail of a normal variable."""
    return np.interp(z, _Z, _LOGS)


_Z = np.arange(0, 38, 0.01)
_LOGS = np.array([-2 * math.log(max(math.erfc(z / math.sqrt(2)), 1e-300)) for z in _Z])


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, place of the kind, end) of the pattern matches, in order."""
    out = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text) if m.end() - m.start() >= 24]
    return sorted(out)


def encoding(s: str) -> tuple[str, str] | None:
    """The smallest known alphabet that has all the symbols, padding aside."""
    have = set(s.rstrip("="))
    return next(((n, a) for n, a in ALPHABETS if have <= set(a)), None)


def statistics(v: np.ndarray, k: np.ndarray) -> np.ndarray:
    """-2 ln p of chi-squared, runs and serial correlation, by row of symbols ``v`` over alphabets of ``k`` symbols."""
    m, n = v.shape
    top = int(k.max()) if m else 1
    each = np.bincount((np.arange(m)[:, None] * top + v).ravel(), minlength=m * top).reshape(m, top)
    chi = (each.astype(float) ** 2).sum(1) * k / n - n
    # Wilson and Hilferty's normal form; the upper tail
    spread = np.sqrt(2 / (9 * (k - 1)))
    z = (np.cbrt(np.maximum(chi, 0) / (k - 1)) - (1 - 2 / (9 * (k - 1)))) / spread
    upper = np.where(z > 0, _log_erfc(np.maximum(z, 0)) + 2 * math.log(2), -2 * np.log1p(-np.exp(-_log_erfc(np.maximum(-z, 0)) / 2) / 2))
    high = v >= (k / 2)[:, None]
    a = high.sum(1).astype(float)
    b = n - a
    runs = 1 + (high[:, 1:] != high[:, :-1]).sum(1)
    mean = 2 * a * b / n + 1
    var = np.maximum((mean - 1) * (mean - 2) / (n - 1), 1e-9)
    one_sided = 2 * math.log(2) * (n - 1)
    of_runs = np.where((a > 0) & (b > 0), _log_erfc(np.abs(runs - mean) / np.sqrt(var)), min(one_sided, _LOGS[-1]))
    d = v - v.mean(1, keepdims=True)
    total = (d**2).sum(1)
    r = np.divide((d[:, 1:] * d[:, :-1]).sum(1), total, out=np.ones(m), where=total > 0)
    return np.stack([upper, of_runs, _log_erfc(np.abs(r + 1 / n) * math.sqrt(n))], 1)


def battery(s: str) -> dict[str, float] | None:
    """The p-values of uniform randomness, by test, and Fisher's statistic of them; None if no encoding fits."""
    found = encoding(s)
    body = s.rstrip("=")
    if not found or len(body) < 8:
        return None
    v = _CODE[found[0]][np.frombuffer(body.encode(), np.uint8)]
    logs = statistics(v[None, :], np.array([len(found[1])]))[0]
    return {**dict(zip(("chi2", "runs", "serial"), np.exp(-logs / 2).tolist())), "fisher": float(logs.sum())}


def _fisher_tail(x: float) -> float:
    """Upper tail of the chi-squared distribution with 6 degrees of freedom."""
    h = x / 2
    return math.exp(-h) * (1 + h + h * h / 2)


def stratum(n: int, name: str) -> int:
    """The place of a length and an encoding among the histograms: those of both cases are kept apart."""
    return 2 * sum(n >= x for x in BANDS) + name.startswith("base6")


def long_runs(on: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of at least ``least`` marks."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], on.view(np.int8), [0]])))
    lo, hi = edge[::2], edge[1::2]
    return lo[hi - lo >= least], hi[hi - lo >= least]


def ordinary(raw: np.ndarray) -> np.ndarray:
    """Histograms (stratum, bin) of Fisher's statistic over windows of the letters and digits of ``raw``, candidates aside,
    of each band's length in turn."""
    out = np.zeros((STRATA, BINS), np.int64)
    digit = np.concatenate([[0], np.cumsum(_KIND[raw] == 2)])
    lo, hi = long_runs(_RUN[raw], LEAST)
    held = digit[hi] > digit[lo]
    # what may be a secret is no ordinary text
    beside = np.zeros(len(raw) + 1, np.int64)
    beside[lo[held]] += 1
    beside[hi[held]] -= 1
    plain = raw[(_KIND[raw] < 3) & (np.cumsum(beside)[:-1] == 0)]
    turn = sum(WINDOWS)
    full = len(plain) // turn
    if not full:
        return out
    rows, at = plain[: full * turn].reshape(full, turn), 0
    for n in WINDOWS:
        w = rows[:, at : at + n]
        at += n
        left = np.ones(full, bool)
        for name, alphabet in ALPHABETS[:6]:  # letters and digits alone fit none but these
            v = _CODE[name][w]
            own = left & (v >= 0).all(1)
            left &= ~own
            if own.any():
                x = statistics(v[own], np.full(int(own.sum()), len(alphabet))).sum(1)
                out[stratum(n, name)] += np.bincount(np.minimum(x / STEP, BINS - 1).astype(np.int64), minlength=BINS)
    return out


@functools.cache
def background(n: int = 3000) -> np.ndarray:
    """The same histograms of a fixed text of ordinary words."""
    rng = np.random.default_rng(41)
    words = [_WORDS[i] for i in rng.integers(0, len(_WORDS), n * sum(WINDOWS) // 6)]
    return sum(ordinary(np.frombuffer("".join(x).encode(), np.uint8)) for x in (words, [w.title() for w in words]))


def change_p(s: str) -> float:
    """log10 of the chance that an ordinary identifier of this length changes its character class so often."""
    n = len(s) - 1
    kind = _KIND[np.frombuffer(s.encode(), np.uint8)]
    k = int((kind[1:] != kind[:-1]).sum())
    if k <= n * CHANGE_RATE:
        return 0.0
    logs, top = [], -math.inf
    for i in range(k, n + 1):
        x = math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(CHANGE_RATE) + (n - i) * math.log1p(-CHANGE_RATE)
        logs.append(x)
        top = max(top, x)
        if x < top - 40:  # beyond the rate the terms only fall
            break
    return min(0.0, (top + math.log(sum(math.exp(x - top) for x in logs))) / math.log(10))


def parts(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """(start, end) of what may be a value in a run: its parts between inner ``=``, and of a part that no
    alphabet fits the parts between the separators that one alphabet or the other has, the longest first."""
    for m in VALUE.finditer(text, start, end):
        if m.end() - m.start() < LEAST:
            continue
        if encoding(m.group()):
            yield m.start(), m.end()
        else:
            inner = {(x.start(), x.end()) for p in INNER for x in p.finditer(text, m.start(), m.end()) if x.end() - x.start() >= LEAST}
            yield from sorted(inner, key=lambda x: (x[0] - x[1], x))


def candidates(text: str, taken: list[tuple[int, int, int]], alpha: float) -> list[tuple[int, int, int, int, int]]:
    """(start, end, stratum, bin of Fisher's statistic, bin of the changes) of the runs beside the pattern matches that the battery calls random."""
    out = []
    used = bytearray(len(text))
    for a, _, z in taken:
        used[a:z] = b"\x01" * (z - a)
    for m in RUN.finditer(text):
        for a, z in parts(text, m.start(), m.end()):
            s = text[a:z]
            if used.find(1, a, z) >= 0 or s.isalpha() or not any(c.isdigit() for c in s) or not any(c.isalpha() for c in s):
                continue
            p = battery(s)
            if p and _fisher_tail(p["fisher"]) >= alpha:
                used[a:z] = b"\x01" * (z - a)
                out.append((a, z, stratum(z - a, encoding(s)[0]), min(BINS - 1, int(p["fisher"] / STEP)), min(BINS - 1, int(-change_p(s) * 8))))
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = 0.001) -> DataFrame:
    """id, n_*, base_sha256, base spans and candidates of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = hashlib.sha256(b"").hexdigest()
        for b in batches:
            data, offsets = tk.utf8(b.column(1))
            n = len(offsets) - 1
            maybe = suspects(data, offsets)
            counts = np.zeros((3, n), np.int64)
            sha, base, cand = [empty] * n, [[] for _ in range(n)], [[] for _ in range(n)]
            for i in maybe.tolist():
                text = data[offsets[i] : offsets[i + 1]].tobytes().decode()
                spans = base_spans(text)
                for _, k, _ in spans:
                    counts[k, i] += 1
                base[i] = [{"start": s, "kind": k, "end": e} for s, k, e in spans]
                sha[i] = hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()
                cand[i] = [{"start": s, "end": e, "band": g, "bin": x, "change": c} for s, e, g, x, c in candidates(text, spans, alpha)]
            span = pa.list_(pa.struct([("start", pa.int32()), ("kind", pa.int32()), ("end", pa.int32())]))
            more = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("band", pa.int32()), ("bin", pa.int32()), ("change", pa.int32())]))
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(c) for c in counts), pa.array(sha), pa.array(base, span), pa.array(cand, more)], [id_col, "n_assign", "n_access", "n_hex", "base_sha256", "base", "cand"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, base array<struct<start:int,kind:int,end:int>>, cand array<struct<start:int,end:int,band:int,bin:int,change:int>>")


def suspects(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Rows that may have a span: with a keyword, AKIA, or a long enough run with a digit or of hex digits."""
    hits = []
    for a, z in tk.blocks(data, offsets, 4_000_000):
        # a block ends at white space, which neither keywords nor runs hold
        piece = data[a:z]
        raw = tk._LOWER[piece].tobytes()
        for word in (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key", b"akia"):
            at = raw.find(word)
            while at >= 0:
                hits.append(a + at)
                at = raw.find(word, at + 1)
        digit = np.concatenate([[0], np.cumsum((piece >= 48) & (piece <= 57))])
        for table, least, digits in ((_HEX, 24, False), (_RUN, LEAST, True)):
            lo, hi = long_runs(table[piece], least)
            # a run may go on over the end of a text: each text that it touches counts
            for x, y in zip(lo.tolist(), hi.tolist()):
                if not digits or digit[y] > digit[x]:
                    hits += (a + offsets[np.searchsorted(offsets, a + x, "right") : np.searchsorted(offsets, a + y, "left")] - a).tolist()
                    hits.append(a + x)
    return np.unique(np.searchsorted(offsets[1:], np.array(hits, np.int64), "right")) if hits else np.zeros(0, np.int64)


def null_table(docs: DataFrame, text_col: str) -> np.ndarray:
    """For each stratum and bin of Fisher's statistic the bin of -log10 p: the share of ordinary windows with as small a statistic."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((STRATA, BINS), np.int64)
        for b in batches:
            data, offsets = tk.utf8(b.column(0))
            for a, z in tk.blocks(data, offsets):
                total += ordinary(data[a:z])
        slot = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slot), pa.array(total.ravel()[slot])], ["slot", "n"])

    count = background().ravel().copy()
    for r in docs.select(text_col).mapInArrow(run, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).collect():  # at most STRATA x BINS rows
        count[r["slot"]] += r["n"]
    count = count.reshape(STRATA, BINS)
    p = (1 + np.cumsum(count, 1)) / (1 + count.sum(1, keepdims=True))
    return np.minimum(-np.log10(p) * 8, BINS - 1).astype(np.int64)


def thresholds(cands: DataFrame, q: float) -> list[int]:
    """For each stratum the smallest bin that Benjamini and Hochberg's procedure accepts at level ``q``."""
    rows = cands.groupBy("band", "p").count().collect()  # at most STRATA x BINS rows
    count = np.zeros((STRATA, BINS), np.int64)
    for r in rows:
        count[r["band"], r["p"]] = r["count"]
    out = []
    for own in count:
        m = max(int(own.sum()), 1)
        as_small = np.cumsum(own[::-1])[::-1]  # how many have a p-value in this bin or a smaller one
        ok = [k for k in range(BINS) if as_small[k] and 10 ** (-k / 8) <= q * as_small[k] / m]
        out.append(min(ok) if ok else BINS)
    return out


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = 0.001, q: float = 0.01) -> DataFrame:
    """id, n_assign, n_access, n_hex, n_random, base_sha256, spans of every row."""
    scanned = workspace.materialize(scan(docs, id_col, text_col, alpha), "secrets")
    null = F.array(*(F.lit(x) for x in null_table(docs, text_col).ravel().tolist()))
    p_of = lambda c: F.least(F.get(null, c["band"] * BINS + c["bin"]), c["change"].cast("long"))
    cands = scanned.select(F.explode("cand").alias("c")).select(F.col("c.band").alias("band"), p_of(F.col("c")).alias("p"))
    limit = F.array(*(F.lit(x) for x in thresholds(cands, q)))
    extra = F.transform(F.filter("cand", lambda c: p_of(c) >= F.get(limit, c["band"])), lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("kind"), c["end"].alias("end")))
    names = F.array(*(F.lit(k) for k in KINDS))
    spans = F.transform(F.array_sort(F.concat("base", extra)), lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"]))
    return scanned.select(id_col, "n_assign", "n_access", "n_hex", F.size(extra).cast("long").alias("n_random"), "base_sha256", F.array_join(spans, ",").alias("spans"))
