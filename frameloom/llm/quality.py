"""Quality rules as a ledger of bits and measurements.

Every rule is evaluated once for every document. The ledger keeps what was
measured and one bit for each rule that failed. A policy is a version with the
mask of the rules that it enforces: applying another version, or asking what a
rule costs, reads the ledger's integers and never the texts.

Words are runs of other characters than space and U+0009 to U+000D; letters are
Unicode's categories L, upper-case ones Lu. Null text counts as empty: no words,
which fails the base rules. Each row of the input has a row of the ledger,
repeated ones too; texts are measured whole, however long; an empty table has an
empty ledger. Columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from unicodedata import category

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

WORD = re.compile(r"[^ \t-\r]+")
SYMBOL = re.compile(r"[#*$%&|<>]")
MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_letters"]


@dataclass(frozen=True)
class Rule:
    name: str
    #: SQL over the measurements; true: the document fails.
    fails: str


#: A rule's bit is its place here. Append only: old ledgers keep their meaning.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("shouting", "10 * n_upper > 7 * n_letters"),
    Rule("no_letters", "n_letters = 0"),
)
BASE = 0b11


@dataclass(frozen=True)
class Policy:
    version: str
    mask: int

    @classmethod
    def of(cls, version: str, *names: str) -> Policy:
        bits = {rule.name: 1 << k for k, rule in enumerate(RULES)}
        return cls(version, sum(bits[n] for n in names))


POLICIES = (
    Policy.of("v1", "few_words", "repeated_windows"),
    Policy.of("v2", "few_words", "repeated_windows", "symbols", "duplicate_lines"),
    Policy.of("v3", *(rule.name for rule in RULES)),
)


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of a whole text, in the order of MEASURES."""
    text = text or ""
    words = WORD.findall(text)
    n = len(words)
    repeated = 0
    if n >= 4:  # two windows of three words at least
        seen: dict[str, int] = {}
        ids = np.array([seen.setdefault(w, len(seen)) for w in words], dtype=np.int64)
        if len(seen) < n:
            pairs = ids[:-1] * len(seen) + ids[1:]
            pairs = np.unique(pairs, return_inverse=True)[1]
            windows = np.unique(pairs[:-1] * len(seen) + ids[2:], return_inverse=True, return_counts=True)
            twice = windows[2][windows[1]] > 1
            inside = np.zeros(n, dtype=bool)
            for k in range(3):
                inside[k : n - 2 + k] |= twice
            repeated = int(inside.sum())
    lines, dup, known = 0, 0, set()
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            if line in known:
                dup += 1
            known.add(line)
    letters = upper = 0
    if text:
        points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
        letters, upper = (int(table[points].sum()) for table in _classes())
    return n, sum(map(len, words)), len(SYMBOL.findall(text)), dup, repeated, lines, upper, letters


_CLASSES: list[np.ndarray] = []


def _classes() -> list[np.ndarray]:
    """Which code points are letters, and upper-case ones."""
    if not _CLASSES:
        every = [chr(c) for c in range(0x110000)]
        _CLASSES.extend([np.array([c.isalpha() for c in every]), np.array([category(c) == "Lu" for c in every])])
    return _CLASSES


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, the measurements and ``failed``, the bits of the rules that
    the document fails."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([measure(t.as_py()) for t in batch.column(1)], dtype=np.int64).reshape(-1, len(MEASURES))
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(found[:, k]) for k in range(len(MEASURES)))], ["doc_id", *MEASURES])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = rows.mapInArrow(common.tidy(run), "doc_id long, " + ", ".join(f"{m} long" for m in MEASURES))
    bits = [f"if({rule.fails}, {1 << k}L, 0L)" for k, rule in enumerate(rules)]
    return found.withColumn("failed", F.expr(" | ".join(bits)))


def passes(policy: Policy) -> Column:
    """Whether a ledger row satisfies the policy."""
    return F.col("failed").bitwiseAND(F.lit(policy.mask)) == 0


def apply_policies(found: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """The ledger with a column kept_<version> for each policy."""
    return found.withColumns({f"kept_{p.version}": passes(p) for p in policies})


def ablations(found: DataFrame, policies: tuple[Policy, ...] = POLICIES, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """A row for each policy and rule of it: n_docs, n_kept, n_failed (fail
    the rule) and n_alone (would be kept without it). The ledger first shrinks
    to a count for each pattern of bits."""
    patterns = found.groupBy("failed").agg(F.count("*").alias("n"))
    every = F.array(*(F.struct(F.lit(p.version).alias("policy"), F.lit(p.mask).cast("long").alias("mask"), F.lit(r.name).alias("rule"), F.lit(1 << k).cast("long").alias("bit")) for p in policies for k, r in enumerate(rules) if p.mask >> k & 1))
    rows = patterns.select("failed", "n", F.explode(every).alias("x")).select("failed", "n", "x.*").withColumn("hit", F.col("failed").bitwiseAND(F.col("mask")))
    total = lambda when: F.coalesce(F.sum(F.when(when, F.col("n"))), F.lit(0))
    return rows.groupBy("policy", "rule").agg(F.sum("n").alias("n_docs"), total(F.col("hit") == 0).alias("n_kept"), total(F.col("hit").bitwiseAND(F.col("bit")) != 0).alias("n_failed"), total(F.col("hit") == F.col("bit")).alias("n_alone"))
