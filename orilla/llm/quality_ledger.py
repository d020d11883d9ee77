"""Quality rules in a bitmask ledger (operator 2).

Every text is measured once; every rule is evaluated once on the measurements,
and the ledger keeps the measurements and one failure bit per rule. A policy is
a version and a mask of rules; applying it, or working out what each rule alone
rejects, is bitwise arithmetic on the ledger and reads no text.

Defined cases: a null or empty text has no words and fails ``few_words``. Rows
that repeat, null ids and further columns change nothing: one row comes out for
each row in. An empty table gives an empty ledger.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orilla.llm import pieces
from orilla.llm import textkernel as tk

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letter_words", "longest_word")


@dataclass(frozen=True)
class Rule:
    """A rule fails where ``fails`` (SQL over the measurements, integers only) is true."""

    name: str
    fails: str


#: The place of a rule is its bit; new rules are added at the end.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > 3 * n_words"),
    Rule("duplicate_lines", "n_dup_lines >= 5 AND 2 * n_dup_lines > n_lines"),
    Rule("word_length", "word_chars < 2 * n_words OR word_chars > 20 * n_words"),
    Rule("letters", "2 * n_letter_words < n_words"),
    Rule("many_words", "n_words > 10000000"),
    Rule("giant_word", "longest_word > 1000"),
)
BASE = ("few_words", "repeated_words")


@dataclass(frozen=True)
class Policy:
    """A version of the verdict: the rules that reject."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return mask_of(self.rules)


def mask_of(names: tuple[str, ...]) -> int:
    at = {r.name: i for i, r in enumerate(RULES)}
    return sum(1 << at[n] for n in names)


POLICIES = {p.version: p for p in (Policy("base", BASE), Policy("v1", (*BASE, "symbols", "duplicate_lines", "word_length", "letters")), Policy("strict", tuple(r.name for r in RULES)))}


def measure(text: pa.Array) -> dict[str, np.ndarray]:
    """The measurements of a string column's rows."""
    data, offsets = tk.utf8(text)
    n = len(offsets) - 1
    s, e, row, h = tk.words(data, offsets)
    out = {"n_words": np.bincount(row, minlength=n)}

    def per_row(flag: np.ndarray) -> np.ndarray:
        c = np.zeros(len(flag) + 1, np.int64)
        np.cumsum(flag, out=c[1:])
        return c[offsets[1:]] - c[offsets[:-1]]

    lead = (data & 0xC0) != 0x80
    out["word_chars"] = per_row(lead & ~tk.SPACE[data])
    out["n_symbols"] = per_row(_SYMBOL[data])
    c = np.zeros(len(data) + 1, np.int64)
    np.cumsum(_LETTER[data], out=c[1:])
    out["n_letter_words"] = np.bincount(row[c[e] > c[s]], minlength=n)
    np.cumsum(lead, out=c[1:])
    longest = np.zeros(n, np.int64)
    np.maximum.at(longest, row, c[e] - c[s])
    out["longest_word"] = longest
    m = len(h)
    repeat = np.zeros(m, bool)
    if m >= 3:
        with np.errstate(over="ignore"):
            w = tk.mix((h[:-2] * tk._P + h[1:-1]) * tk._P + h[2:])
        at = np.flatnonzero(row[:-2] == row[2:])
        order = at[np.lexsort((w[at], row[at]))]
        same = (w[order][1:] == w[order][:-1]) & (row[order][1:] == row[order][:-1])
        twice = np.zeros(len(order), bool)
        twice[1:] |= same
        twice[:-1] |= same
        for k in range(3):
            repeat[order[twice] + k] = True
    out["n_repeat_words"] = np.bincount(row[repeat], minlength=n)
    lines, dups = np.zeros(n, np.int64), np.zeros(n, np.int64)
    raw = data.tobytes()
    for i in range(n):
        own = [x for x in raw[offsets[i] : offsets[i + 1]].split(b"\n") if x.strip(b" \t\n\r\x0b\x0c")]
        lines[i], dups[i] = len(own), len(own) - len(set(own))
    out["n_lines"], out["n_dup_lines"] = lines, dups
    return out


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, the measurements and ``bits``: one failure bit per rule."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for a, z in pieces.row_slices(b.column(1), 4_000_000):
                got = measure(b.column(1).slice(a, z - a))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(a, z - a), *(pa.array(got[m].astype(np.int64)) for m in MEASURES)], [id_col, *MEASURES])

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, " + ", ".join(f"{m} long" for m in MEASURES))
    bits = " | ".join(f"CASE WHEN {r.fails} THEN {1 << i}L ELSE 0L END" for i, r in enumerate(RULES))
    return rows.withColumn("bits", F.expr(bits))


def fails(mask: int, bits: Column | str = "bits") -> Column:
    """True where any rule of the mask fails."""
    return (F.col(bits) if isinstance(bits, str) else bits).bitwiseAND(F.lit(mask)) != 0


def apply_policy(rows: DataFrame, policy: Policy) -> DataFrame:
    """The ledger with the policy's version and verdict."""
    return rows.withColumn("policy", F.lit(policy.version)).withColumn("kept", ~fails(policy.mask))


def ablation(rows: DataFrame, policy: Policy) -> DataFrame:
    """For each rule of the policy: how many rows fail it, and how many fail it alone."""
    seen = rows.groupBy("bits").agg(F.count("*").alias("n"))  # at most 2 ** len(RULES) rows
    one = [(r.name, 1 << i) for i, r in enumerate(RULES) if policy.mask >> i & 1]
    sums = [F.sum(F.when(F.col("bits").bitwiseAND(F.lit(b)) != 0, F.col("n")).otherwise(0)).alias(f"{name}_failed") for name, b in one]
    sums += [F.sum(F.when(F.col("bits").bitwiseAND(F.lit(policy.mask)) == b, F.col("n")).otherwise(0)).alias(f"{name}_alone") for name, b in one]
    wide = seen.agg(*sums)
    entries = ", ".join(f"'{name}', {name}_failed, {name}_alone" for name, _ in one)
    return wide.selectExpr(f"stack({len(one)}, {entries}) AS (rule, n_failed, n_alone)").select(F.lit(policy.version).alias("policy"), "rule", F.coalesce("n_failed", F.lit(0)).alias("n_failed"), F.coalesce("n_alone", F.lit(0)).alias("n_alone"))
