"""Quality rules as a ledger of failure bits.

Every rule is evaluated once for each document; the ledger keeps the measurements and one bit for each rule that failed.
A policy is a set of rules (a mask) with a version.  Applying a policy, changing it, or asking what one rule alone removes are
bitwise operations on the ledger; texts are not read again.

Measurements come from one pass over whole texts: word counts, symbols, repeated lines, words in repeated 3-word windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import textops as tx

WINDOW = 3
SYMBOLS = "#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_upper")


@dataclass(frozen=True)
class Rule:
    bit: int
    name: str
    fails: str      # SQL over the measurements; exact integer arithmetic


#: Bits are never reused, so ledgers of different versions stay comparable.
RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "repeated_lines", "n_lines >= 4 AND 100 * n_dup_lines > 30 * n_lines"),
    Rule(4, "short_words", "2 * word_chars < 5 * n_words"),
    Rule(5, "long_words", "word_chars > 15 * n_words"),
    Rule(6, "few_letters", "100 * n_letters < 60 * word_chars"),
    Rule(7, "upper_case", "2 * n_upper > n_letters"),
)
#: Versioned policies: the rules that reject.  v1 is the base alone.
POLICIES = {"v1": ("few_words", "repeated_windows"),
            "v2": ("few_words", "repeated_windows", "symbols", "repeated_lines", "short_words", "long_words", "few_letters",
                   "upper_case")}
BASE, CURRENT = "v1", "v2"


def mask(policy: str) -> int:
    return sum(1 << r.bit for r in RULES if r.name in POLICIES[policy])


def _measure(part: pa.RecordBatch, hasher: tx.Hasher, symbols: np.ndarray, letters: np.ndarray) -> list[np.ndarray]:
    data, bounds = tx.raw(part.column(part.num_columns - 1))
    rows = part.num_rows
    starts, ends, first = tx.word_bounds(data, bounds)
    n_words = np.diff(first)

    def per_row(flag: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(flag)])
        return total[bounds[1:]] - total[bounds[:-1]]

    white = (data == 32) | ((data >= 9) & (data <= 13))
    lead = (data & 0xC0) != 0x80
    word_chars, n_symbols, n_letters, n_upper = (per_row(x) for x in (lead & ~white, symbols[data], letters[data],
                                                                      (data >= 65) & (data <= 90)))

    h = hasher.segments(data, starts, ends)
    row, windows, at = tx.shingles(h, first, WINDOW, short=False)
    key = windows ^ tx.mix(row)
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    twice = np.zeros(len(key), bool)
    twice[order[1:]] |= same
    twice[order[:-1]] |= same
    hit = np.zeros(len(h) + 1, np.int64)
    np.add.at(hit, at[twice], 1)
    np.add.at(hit, at[twice] + WINDOW, -1)
    covered = np.concatenate([[0], np.cumsum(np.cumsum(hit[:-1]) > 0)])
    n_repeat = covered[first[1:]] - covered[first[:-1]]

    # Lines: the pieces between line feeds and row bounds; those with a word count.
    feeds = np.flatnonzero(data == 10)
    line_start = np.union1d(bounds[:-1], feeds + 1)
    line_start = line_start[line_start < len(data)]
    stop = np.sort(np.concatenate([feeds, bounds[1:]]))
    # A row's first line starts where the row before it stops, so a stop at the start counts only if it is a line feed.
    line_end = np.where(data[line_start] == 10, line_start, stop[np.searchsorted(stop, line_start, side="right")])
    has_word = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_start, line_end = line_start[has_word], line_end[has_word]
    line_row = np.searchsorted(bounds, line_start, side="right") - 1
    key = hasher.segments(data, line_start, line_end) ^ tx.mix(line_row)
    _, once = np.unique(key, return_index=True)
    earlier = np.ones(len(key), bool)
    earlier[once] = False
    n_lines, n_dup = np.bincount(line_row, minlength=rows), np.bincount(line_row[earlier], minlength=rows)
    return [n_words, word_chars, n_symbols, n_lines, n_dup, n_repeat, n_letters, n_upper]


def measurements(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, *MEASURES)`` of every row; null and empty texts measure zero."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = tx.Hasher()
        symbols = np.array([chr(c) in SYMBOLS for c in range(256)])
        # Letters: ASCII letters and every code point from U+00C0 on, which a byte from 0xC3 on starts.
        letters = np.array([c < 128 and chr(c).isalpha() or c >= 0xC3 for c in range(256)])
        for batch in batches:
            for part in tx.slices(batch, "text"):
                found = _measure(part, hasher, symbols, letters)
                yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(x, pa.int64()) for x in found)],
                                                 [id_col, *MEASURES])

    src = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, f"`{id_col}` {src.dtypes[0][1]}, " + ", ".join(f"{m} long" for m in MEASURES))


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, *MEASURES, fail_bits)``: bit ``r.bit`` is set where rule ``r`` failed.  One row for each row of ``docs``, repeated
    ones included; other columns are ignored."""
    bits = F.lit(0).cast("long")
    for r in RULES:
        bits = bits.bitwiseOR(F.when(F.expr(r.fails), F.lit(1 << r.bit).cast("long")).otherwise(F.lit(0).cast("long")))
    return measurements(docs, id_col, text_col).withColumn("fail_bits", bits)


def rejected(policy: str) -> Column:
    """Whether a ledger row fails the policy."""
    return F.col("fail_bits").bitwiseAND(F.lit(mask(policy)).cast("long")) != 0


def ablation(rows: DataFrame, policy: str = CURRENT) -> DataFrame:
    """For every rule of a policy: rows that fail it, that fail it alone (so dropping the rule would keep them), and
    rows kept without it.  One pass over ledger rows, summed before the shuffle."""
    bits = F.col("fail_bits").bitwiseAND(F.lit(mask(policy)).cast("long"))
    used = [r for r in RULES if r.name in POLICIES[policy]]
    sums = [F.sum(bits.bitwiseAND(F.lit(1 << r.bit).cast("long")).isin(1 << r.bit).cast("long")).alias(f"f{r.bit}") for r in used] \
        + [F.sum((bits == (1 << r.bit)).cast("long")).alias(f"a{r.bit}") for r in used] \
        + [F.sum((bits == 0).cast("long")).alias("kept")]
    one = rows.agg(*sums)
    stack = ", ".join(f"'{r.name}', coalesce(f{r.bit}, 0), coalesce(a{r.bit}, 0), coalesce(kept + a{r.bit}, 0)" for r in used)
    return one.selectExpr(f"stack({len(used)}, {stack}) AS (rule, failed, failed_alone, kept_without)")
