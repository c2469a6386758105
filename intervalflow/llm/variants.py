"""Spelling variants by PartEnum signatures.

A word's letters are a multiset, that is a binary vector: the entry (letter, k) is one if the letter occurs at least k times.  One inserted,
deleted or replaced letter changes at most two entries, so near words are vectors of Hamming distance two at most.  PartEnum finds these with
exact signatures: the entries are partitioned twice, and of the second-level parts of a first-level one all but a few are enumerated; two
vectors within the distance agree in at least one such choice.  Words are joined on equal signatures and every candidate is verified.

Letters alone do not tell anagrams apart, and corpora are full of them.  One edit leaves the first or the last half of the shorter word as it is, so
a signature is joined with the word's first letters and again with its last ones, half as many as the shortest word has.  No near pair is
lost by that, and fewer than a tenth of the candidates remain.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .storage import stage

LETTERS = "a-zÀ-ÿ"
MIN_LENGTH, MIN_COUNT, RATIO, DELETE = 7, 2, 10, 31
#: Hamming distance of near words' vectors; first-level parts, and second-level parts of each.
DISTANCE, FIRST, SECOND = 2, 1, 4
#: Distinct words that a counting task holds.
HELD_WORDS = 200_000


def count_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, delete: int = DELETE) -> DataFrame:
    """``(word, n)`` of the words with at least ``min_length`` letters: maximal runs of letters in lower case (A-Z alone are lowered), of which
    those whose crc32 with the document's id ``delete`` divides have lost one letter.  Null texts have no words; a null id counts as empty."""
    runs = re.compile(f"[{LETTERS}]{{{min_length},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], ["word", "n"])

        for batch in batches:
            for i in range(batch.num_rows):
                text = batch.column(1)[i].as_buffer()
                if text is None:
                    continue
                start = zlib.crc32((batch.column(0)[i].as_py() or "").encode() + b":")
                for word, n in Counter(runs.findall(bytes(text).lower().decode())).items():
                    h = zlib.crc32(word.encode(), start)
                    if not h % delete:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < min_length:
                            continue
                    held[word] += n
                if len(held) > HELD_WORDS:
                    yield out()
                    held.clear()
        yield out()

    src = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def choices(distance: int = DISTANCE, first: int = FIRST, second: int = SECOND) -> list[tuple[int, ...]]:
    """The sets of parts, numbered over both levels, that make a signature each."""
    within = math.ceil((distance + 1) / first) - 1          # some first-level part differs in so many entries at most
    if second <= within:
        raise ValueError("needs more second-level parts than entries that may differ")
    return [tuple(p * second + s for s in kept) for p in range(first) for kept in itertools.combinations(range(second), second - within)]


def parts_of(word: Column, parts: int) -> Column:
    """For each part the hash of the word's entries in it: entries are combined by exclusive or, which no order changes."""
    letters = F.array_sort(F.filter(F.split(word, ""), lambda c: c != ""))
    zero = F.struct(F.lit("").alias("c"), F.lit(0).alias("k"), F.array_repeat(F.lit(0).cast("long"), parts).alias("p"))

    def add(s: Column, c: Column) -> Column:
        k = F.when(s["c"] == c, s["k"] + 1).otherwise(F.lit(0))
        h = F.xxhash64(c, k)
        return F.struct(c.alias("c"), k.alias("k"),
                        F.transform(s["p"], lambda x, i: F.when(i == F.pmod(h, F.lit(parts)), x.bitwiseXOR(h)).otherwise(x)).alias("p"))

    return F.aggregate(letters, zero, add, lambda s: s["p"])


def signatures(word: Column, parts: Column, anchor: int, sets: list[tuple[int, ...]]) -> Column:
    """The signatures of a word as 64-bit hashes, each with its first and with its last ``anchor`` letters.  Equal hashes by chance add
    candidates only."""
    ends = (F.left(word, F.lit(anchor)), F.right(word, F.lit(anchor)))
    return F.array(*(F.xxhash64(F.lit(k), F.lit(side), end, *(F.get(parts, F.lit(p)) for p in kept))
                     for k, kept in enumerate(sets) for side, end in enumerate(ends)))


def near_pairs(words: DataFrame, min_length: int = MIN_LENGTH, first: int = FIRST, second: int = SECOND) -> DataFrame:
    """``(a, b, na, nb)`` with ``a < b``: words of ``words(word, n)`` that differ by exactly one inserted, deleted or replaced code point.  A pair
    stands once for each signature that it shares."""
    sets = choices(DISTANCE, first, second)
    signed = (words.select("word", "n", parts_of(F.col("word"), first * second).alias("parts"))
              .select("word", "n", F.explode(signatures(F.col("word"), F.col("parts"), max(min_length // 2, 1), sets)).alias("sig")))
    a, b = signed.alias("a"), signed.alias("b")
    near = (F.col("a.sig") == F.col("b.sig")) & (F.col("a.word") < F.col("b.word")) & \
        (F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1)
    return a.join(b, near).select(F.col("a.word").alias("a"), F.col("b.word").alias("b"), F.col("a.n").alias("na"), F.col("b.n").alias("nb"))


def variants(words: DataFrame, min_length: int = MIN_LENGTH, ratio: int = RATIO) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of a staged table ``words(word, n)`` of distinct words with at least ``min_length`` letters.

    A word's form is its near word of largest n, of equal ones the first in code-point order, if that n is at least ``ratio`` times its own;
    else null.  The root follows the forms to the last.  An empty table gives an empty one."""
    pairs = stage(near_pairs(words, min_length), "near")
    both = pairs.select(F.col("a").alias("word"), F.col("na").alias("n"), F.col("b").alias("near"), F.col("nb").alias("near_n")).unionByName(
        pairs.select(F.col("b").alias("word"), F.col("nb").alias("n"), F.col("a").alias("near"), F.col("na").alias("near_n")))
    # A word of L letters over K has fewer than 2 * K * (L + 1) near words, so no list grows with the corpus.
    best = both.groupBy("word", "n").agg(F.collect_set(F.struct((-F.col("near_n")).alias("rank"), "near")).alias("nears")).select(
        "word", F.size("nears").cast("long").alias("n_near"), F.array_min("nears").alias("top"), "n")
    best = stage(best.select("word", "n_near", F.when(-F.col("top.rank") >= ratio * F.col("n"), F.col("top")).alias("top")), "best")
    roots = _roots(best.where("top IS NOT NULL").select("word", F.col("top.near").alias("root")), words.agg(F.max("n")).first()[0] or 0, ratio)
    return (words.join(best, "word", "left").join(roots, "word", "left")
            .select("word", F.col("top.near").alias("form"), F.coalesce("root", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), (-F.col("top.rank")).alias("form_n")))


def _roots(forms: DataFrame, largest: int, ratio: int) -> DataFrame:
    """The end of each chain of ``(word, root)`` links, by doubling.  Along a chain n grows ``ratio`` times a step, so its length is bounded by the
    largest n."""
    length = 1
    while largest >= ratio:
        largest, length = largest // ratio, length + 1
    for _ in range(max(0, length - 1).bit_length()):
        step = stage(forms, "forms")
        onward = step.select(F.col("word").alias("root"), F.col("root").alias("next"))
        forms = step.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"))
    return stage(forms, "forms")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
                      ratio: int = RATIO, delete: int = DELETE) -> DataFrame:
    """``variants`` of the words of whole texts that occur at least ``min_count`` times.  Repeated rows count each time."""
    words = stage(count_words(docs, id_col, text_col, min_length, delete).where(F.col("n") >= min_count), "words")
    return variants(words, min_length, ratio)
