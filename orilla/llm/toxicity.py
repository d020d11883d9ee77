"""Toxicity by compression distance (operator 9).

Two zstandard dictionaries are trained, one on ordinary and one on toxic text.
The toxic one is trained on the residue of toxic training texts: the stretches
made of byte n-grams that no ordinary training text has and that recur in toxic
ones; it is laid before the ordinary one's content, so that both dictionaries
explain ordinary text alike. A window is a word between two fixed carriers,
which keep zstandard's block large enough to be compressed and its last bytes
out of the word. The gain of a window is the number of bytes by which the toxic
dictionary compresses it better. The counts of gains over several thresholds,
calibrated by logistic regression on the training texts, give the score.

Every window of a whole text counts; equal windows are compressed once.
Only labels and texts of the training rows are learnt from; id, language and
source are never inputs.

Defined cases: a null or empty text has no windows, and its score is that of a
text without any gain. Labels that are null are left out; of several labels for
one id the highest counts. Without a toxic and an ordinary training text every
score is 0. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orilla.llm import textkernel as tk

WORD = re.compile(rb"[^\x20\x09-\x0d]+")
GRAM = 4
SUPPORT = 3  # toxic training texts that must share a telling n-gram, however many there are
HEAD = b"1234567890 abcdefghijklmn"
TAIL = b"\x01\x02\x03\x04\x05\x06\x07\x08"
STEPS = (1, 2, 3, 4, 5)
N_FEATURES = 2 * len(STEPS) + 2


@dataclass(frozen=True)
class Model:
    """What scoring needs: a few KB."""

    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]  # the last is the constant

    @property
    def key(self) -> str:
        return hashlib.sha256(self.ordinary + self.toxic).hexdigest()


def _compressor(content: bytes):  # noqa: ANN202
    import zstandard as zs

    p = zs.ZstdCompressionParameters.from_level(5, dict_size=len(content), source_size=64, window_log=18, hash_log=17, chain_log=17, search_log=6, min_match=4, strategy=zs.STRATEGY_LAZY2, format=zs.FORMAT_ZSTD1_MAGICLESS, write_content_size=0, write_checksum=0, write_dict_id=0)
    d = zs.ZstdCompressionDict(content, dict_type=zs.DICT_TYPE_RAWCONTENT)
    d.precompute_compress(compression_params=p)
    return zs.ZstdCompressor(dict_data=d, compression_params=p)


class Gains:
    """Gains of windows under one model, each distinct window compressed once."""

    def __init__(self, ordinary: bytes, toxic: bytes, most: int = 2_000_000) -> None:
        self.pair = _compressor(ordinary), _compressor(toxic)
        self.most = most
        self.known, self.gain = np.zeros(0, np.uint64), np.zeros(0, np.int8)

    def of(self, words: list[bytes]) -> np.ndarray:
        """The gain of each word's window."""
        import zstandard as zs

        out = np.zeros(len(words), np.int64)
        for k in range(0, len(words), 20_000):
            part = [HEAD + b" " + w + b" " + TAIL for w in words[k : k + 20_000]]
            size = np.array([len(w) for w in part], np.uint64)
            start = np.concatenate([[0], np.cumsum(size)[:-1]]).astype(np.uint64)
            held = zs.BufferWithSegments(b"".join(part), np.stack([start, size], 1).tobytes())
            a, b = (c.multi_compress_to_buffer(held, threads=1) for c in self.pair)
            out[k : k + len(part)] = [len(a[i]) - len(b[i]) for i in range(len(part))]
        return np.clip(out, -100, 100)

    def rows(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The gain of every word of the rows, and its row."""
        s, e, row, h = tk.words(data, offsets, lower=True)
        u, at, back = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) + len(u) > self.most:
            self.known, self.gain = np.zeros(0, np.uint64), np.zeros(0, np.int8)
        k = np.minimum(np.searchsorted(self.known, u), max(len(self.known) - 1, 0))
        new = self.known[k] != u if len(self.known) else np.ones(len(u), bool)
        if new.any():
            raw = tk._LOWER[data].tobytes()
            got = self.of([raw[i:j] for i, j in zip(s[at[new]].tolist(), e[at[new]].tolist())])
            known = np.concatenate([self.known, u[new]])
            order = np.argsort(known, kind="stable")
            self.known, self.gain = known[order], np.concatenate([self.gain, got.astype(np.int8)])[order]
            k = np.searchsorted(self.known, u)
        return self.gain[k][back], row


def features(gain: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """For each row: is there a gain of at least each step, how many (log), how many words (log), their share."""
    out = np.zeros((n, N_FEATURES))
    words = np.bincount(row, minlength=n)
    for i, t in enumerate(STEPS):
        c = np.bincount(row[gain >= t], minlength=n)
        out[:, 2 * i] = c > 0
        out[:, 2 * i + 1] = np.log1p(c)
    out[:, -2] = np.log1p(words) / 5
    out[:, -1] = np.sqrt(np.bincount(row[gain >= 2], minlength=n) / np.maximum(words, 1))
    return out


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.3) -> np.ndarray:
    """Ridge logistic regression by Newton's method; the last weight is the constant."""
    a = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(a.shape[1])
    pull = np.full(a.shape[1], ridge)
    pull[-1] = 1e-3
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        step = np.linalg.solve((a * (p * (1 - p) + 1e-9)[:, None]).T @ a + np.diag(pull), a.T @ (y - p) - pull * w)
        w += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-7:
            break
    return w


def _trained(size: int, samples: list[bytes], k: int, d: int) -> bytes:
    import zstandard as zs

    try:
        return zs.train_dictionary(size, samples, k=k, d=d).as_bytes()
    except zs.ZstdError:  # too few samples for training: their own bytes serve
        return b"".join(samples)[-size:] or b"\x00" * 8


def train(texts: list[bytes], toxic: list[bool], ordinary_size: int = 8192, toxic_size: int = 4096, windows: int = 60_000) -> Model:
    """Dictionaries and weights from labelled texts (UTF-8)."""
    if not any(toxic) or all(toxic):
        return Model(b"\x00" * 8, b"\x00" * 8, (0.0,) * N_FEATURES + (-30.0,))
    bag_of = lambda t: dict.fromkeys(WORD.findall(tk._LOWER[np.frombuffer(t, np.uint8)].tobytes()))
    common: set[bytes] = set()
    plain: list[bytes] = []
    each = max(1, windows // max(1, len(texts) - sum(toxic)))
    for t, bad in zip(texts, toxic):
        if not bad:
            bag = list(bag_of(t))
            common.update(bag)
            groups = [b" ".join(bag[i : i + 8]) for i in range(0, len(bag), 8)]
            # where a text has more than its share, windows from all over it
            plain += [groups[i * len(groups) // each] for i in range(each)] if len(groups) > each else groups
    grams = lambda w: {w[i : i + GRAM] for i in range(len(w) - GRAM + 1)}
    usual: set[bytes] = set()
    for w in common:
        usual |= grams(b" " + w + b" ")
    own = dict.fromkeys(t for t, bad in zip(texts, toxic) if bad)  # each distinct text once
    df: Counter[bytes] = Counter()
    fresh = [[b" " + w + b" " for w in bag_of(t) if w not in common] for t in own]
    del common
    for bag in fresh:
        df.update(set().union(*(grams(w) for w in bag)) - usual if bag else ())
    telling = {g for g, n in df.items() if n >= SUPPORT}
    residue = []
    for bag in fresh:
        runs = []
        for w in bag:
            keep = np.zeros(len(w), bool)
            for i in range(len(w) - GRAM + 1):
                if w[i : i + GRAM] in telling:
                    keep[i : i + GRAM] = True
            runs += [r for r in bytes(c if k else 10 for c, k in zip(w, keep)).split(b"\n") if len(r) >= GRAM]
        if runs:
            residue.append(b"\n".join(runs) + b"\n")
    base = _trained(ordinary_size, plain, 64, 8) + HEAD
    model = Model(base, _trained(toxic_size, residue, 16, 6) + base, ()) if residue else Model(base, base, ())
    gains = Gains(model.ordinary, model.toxic)
    x = np.zeros((len(texts), N_FEATURES))
    ends = np.cumsum([len(t) for t in texts])
    k = 0
    while k < len(texts):
        # about 4 MB at a time, one text at least
        z = max(k + 1, int(np.searchsorted(ends, (ends[k - 1] if k else 0) + 4_000_000, "right")))
        data, offsets = tk.utf8(pa.array(texts[k:z], pa.binary()))
        x[k:z] = features(*gains.rows(data, offsets), len(offsets) - 1)
        k = z
    return Model(model.ordinary, model.toxic, tuple(_logistic(x, np.array(toxic, float))))


def held_out(doc_id):  # noqa: ANN001, ANN201
    """True of rows that are kept for testing."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", n_toxic: int = 3000, n_ordinary: int = 12_000) -> Model:
    """A model from a bounded sample of labelled rows.

    At most ``n_toxic`` and ``n_ordinary`` rows that are not held out, by the order
    of a hash of their ids, are learnt from, each with its whole text.
    """
    rated = labels.where(F.col("toxic").isNotNull() & F.col(id_col).isNotNull() & ~held_out(F.col(id_col))).groupBy(id_col).agg(F.max("toxic").alias("toxic"))
    order = F.xxhash64(F.col(id_col), F.lit(17))
    pick = rated.where("toxic = 1").orderBy(order, id_col).limit(n_toxic).unionByName(rated.where("toxic = 0").orderBy(order, id_col).limit(n_ordinary))
    # at most n_toxic + n_ordinary rows: a bounded broadcast, and one bounded task that learns
    rows = docs.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(pick), id_col).select("text", "toxic").dropDuplicates()

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = sorted({(t, y) for b in batches for t, y in zip(b.column(0).cast(pa.binary()).to_pylist(), b.column(1).to_pylist())})
        m = train([t for t, _ in seen], [y == 1 for _, y in seen])
        yield pa.RecordBatch.from_arrays([pa.array([m.ordinary], pa.binary()), pa.array([m.toxic], pa.binary()), pa.array([list(m.weights)], pa.list_(pa.float64()))], ["ordinary", "toxic", "weights"])

    m = rows.coalesce(1).mapInArrow(learn, "ordinary binary, toxic binary, weights array<double>").first()
    if m is None:  # no labelled text at all: no task has run
        return train([], [])
    return Model(bytes(m["ordinary"]), bytes(m["toxic"]), tuple(m["weights"]))


_gains: dict[str, Gains] = {}


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.3, carry: str | None = None) -> DataFrame:
    """id, score, predicted of every row; with ``carry`` all columns and the prediction under that name, which must be free."""
    held = docs.sparkSession.sparkContext.broadcast(model)
    step = 4_000_000

    def scores(text: pa.Array) -> np.ndarray:
        m = held.value
        if m.key not in _gains:
            _gains.clear()
            _gains[m.key] = Gains(m.ordinary, m.toxic)
        g, w = _gains[m.key], np.array(m.weights)
        data, offsets = tk.utf8(text)
        out, a, n = np.zeros(len(text)), 0, len(text)
        while a < n:
            z = min(n, max(a + 1, int(np.searchsorted(offsets, offsets[a] + step, "right")) - 1))
            x = features(*g.rows(data[offsets[a] : offsets[z]], offsets[a : z + 1] - offsets[a]), z - a)
            out[a:z] = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
            a = z
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = scores(b.column(text_col))
            flag = pa.array((p >= threshold).astype(np.int32))
            if carry:
                yield pa.RecordBatch.from_arrays([*b.columns, flag], [*b.schema.names, carry])
            else:
                yield pa.RecordBatch.from_arrays([b.column(id_col), pa.array(p), flag], [id_col, "score", "predicted"])

    if carry:
        return docs.mapInArrow(tk.released(run), T.StructType([*docs.schema.fields, T.StructField(carry, T.IntegerType())]))
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(tk.released(run), f"`{id_col}` {kind}, score double, predicted int")
