"""Token ids in Parquet list columns.

One row for each document, in ascending id order over the files of a folder: id, number of the file's part, position of its first
token in the part, token count, and the ids as ``array<int>``.  The ids are dictionary encoded (a vocabulary fits one dictionary page),
or delta encoded on request; row-group and page sizes are set so that the page index of the sorted id column finds one document's
page, and readers that ask for metadata only read no token page.

Spark writes and commits the files, so a lost executor costs its tasks alone and any store that Spark writes will do.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from intervalflow.operators.ranges import group_bounds, group_of

from . import textops as tx
from . import wordmap
from .storage import stage

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
#: Text bytes of one written part.
PART_BYTES = 64 << 20
ROW_GROUP_BYTES, PAGE_BYTES, PAGE_ROWS = 32 << 20, 256 << 10, 2000
SCHEMA = "doc_id long, part int, part_start long, n_tokens long, ids array<int>"


#: For ``bytes.translate``: 1 for ASCII letters, 2 for ASCII punctuation at which the pre-tokenizer always splits.  The apostrophe
#: (contractions) and the characters of the special tokens are neither.
_KIND = bytes(1 if chr(c).isalpha() and c < 128 else 2 if 33 <= c < 127 and not chr(c).isalnum() and chr(c) not in "'<|>" else 0
              for c in range(256))
_LETTER, _MARK = 1, 2


def word_cut(texts: list[bytes]) -> wordmap.Cut:
    """Words at ASCII white space, cut between ASCII letters and punctuation; words of ASCII alone are lower-cased, as the vocabulary's
    normalizer does.  Words with ``<`` or ``|``, which may hold a special token, stay as they are."""
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    joined = b"".join(texts)
    data = np.frombuffer(joined, np.uint8)
    plain, first, last = tx.word_edges(data, bounds)
    odd = (data >= 128) | (data == 60) | (data == 124)
    if odd.any():
        starts = np.flatnonzero(first)
        # White space is not odd, so a word's bytes and those up to the next word count alike.
        strange = np.logical_or.reduceat(odd, starts)
        plain[starts[0]:] &= np.repeat(~strange, np.diff(starts, append=len(data)))
    kind = np.frombuffer(joined.translate(_KIND), np.uint8) * plain
    turn = (kind[1:] ^ kind[:-1]) == _LETTER ^ _MARK
    first[1:] |= turn
    last[:-1] |= turn
    data = data | ((data >= 65) & (data <= 90) & plain).view(np.uint8) << 5
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return data, starts, ends, np.searchsorted(starts, bounds)


#: What ``VOCABULARY`` does to a text before its merges.  A numeral is split off on both sides whatever stands beside it, and the normalizer
#: neither joins it with a neighbour nor makes one of other characters.
_NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
_SPLITTER = {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True}


def _separators(coder) -> list[tuple[str, int]]:
    """Texts of one id each that may stand between words without changing the words' ids: numerals for a vocabulary like ``VOCABULARY``
    (between words that do not hold them), else none."""
    made = json.loads(coder.to_str())
    steps = (made["pre_tokenizer"] or {}).get("pretokenizers", [])
    if made["normalizer"] != _NORMALIZER or len(steps) != 2 or steps[0] != _SPLITTER or steps[1]["type"] != "ByteLevel" \
            or steps[1]["add_prefix_space"] or steps[1]["use_regex"] or any(t.normalized for t in coder.get_added_tokens_decoder().values()):
        return []
    coded = [(c, coder.encode(c, add_special_tokens=False).ids) for c in "\u00b2\u00bd0123456789"]
    return [(c, ids[0]) for c, ids in coded if len(ids) == 1]


def encode_words(words: DataFrame, tokenizer: str) -> DataFrame:
    """``(chunk, n, ids)`` of ``(chunk, n)``.  Many words go through the tokenizer as one text, between numerals that none of them holds or else
    between special tokens (which costs half as much again)."""
    @tx.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        coder = Tokenizer.from_file(tokenizer)
        special = [t.content for t in coder.get_added_tokens_decoder().values()]
        mark = next(((t.content, coder.token_to_id(t.content)) for t in coder.get_added_tokens_decoder().values() if t.special), None)
        numerals = _separators(coder)
        if hasattr(coder.model, "_resize_cache"):
            coder.model._resize_cache(0)                    # the words are distinct
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                todo = part.column(0).to_pylist()
                text = "\n".join(todo)
                between = next((s for s in numerals if s[0] not in text), None) if not any(t in text for t in special) else None
                if between is None and "<" not in text and "|" not in text:
                    between = mark
                joined = between is not None
                if joined:
                    ids = np.array(coder.encode_batch_fast([between[0].join(todo)], add_special_tokens=False)[0].ids, np.int32)
                    gap = ids == between[1]
                    joined = gap.sum() == len(todo) - 1
                if joined:
                    to = np.concatenate([[0], np.cumsum(~gap)])[np.concatenate([[0], np.flatnonzero(gap), [len(ids)]])]
                    lists = pa.ListArray.from_arrays(pa.array(to.astype(np.int32)), pa.array(ids[~gap]))
                else:
                    lists = pa.array([e.ids for e in coder.encode_batch_fast(todo, add_special_tokens=False)], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([*part.columns, lists], ["chunk", "n", "ids"])

    return words.mapInArrow(run, "chunk string, n long, ids array<int>")


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, id_col: str = "doc_id", text_col: str = "text",
                 end_id: int = END_ID, delta: bool = False, dictionary_words: int = wordmap.DICTIONARY_WORDS) -> None:
    """Encode every row and write the folder ``path``.  A null text is empty and has the end id alone; null ids come first; rows that
    repeat an id stand in the order of their text's hash.  An empty table writes an empty folder.

    The vocabulary file's pre-tokenizer drops white space and its merges stay inside a word, so the ids of a text are those of its words
    in order; each distinct word is encoded once (``wordmap``).  Words are cut only where that tokenizer cuts (``word_cut``)."""
    from tokenizers import Tokenizer
    tokenizer = tokenizer or public_tokenizers.path(VOCABULARY)
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    words = stage(encode_words(wordmap.count(src, "text", word_cut), tokenizer), "words")
    wide = Tokenizer.from_file(tokenizer).get_vocab_size() > 1 << 16
    key, tie = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).alias("key"), F.coalesce(F.xxhash64("text"), F.lit(0).cast("long")).alias("tie")
    # The hash is taken before the encoding, so the texts need not come back from it.
    coded = wordmap.encode(src.select("doc_id", "text", tie), "text", "packed", words, word_cut, wide, dictionary_words, packed=True, keep_text=False)
    keys = stage(src.select(key, tie, F.octet_length("text").alias("size")), "keys")
    rows, size = keys.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    parts = max(-(-size // PART_BYTES), min(src.sparkSession.sparkContext.defaultParallelism, size // (1 << 20)), 1)
    kind = np.dtype("<u4" if wide else "<u2")
    end = np.array([end_id], kind).tobytes()

    @tx.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            for piece in tx.slices(batch, "packed"):
                ids = [x + end for x in piece.column(1).to_pylist()]
                n = np.array([len(x) // kind.itemsize for x in ids])
                to = np.concatenate([[0], np.cumsum(n)])
                values = pa.array(np.frombuffer(b"".join(ids), kind).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), pa.array(np.full(len(n), part, np.int32)), pa.array(at + to[:-1]), pa.array(n),
                     pa.ListArray.from_arrays(pa.array(to.astype(np.int32)), values)],
                    ["doc_id", "part", "part_start", "n_tokens", "ids"])
                at += int(to[-1])

    # The parts' bounds come from ids and hashes, so the encoding runs once (a range exchange of its result would sample that first).
    bounds = group_bounds(keys, ["key", "tie"], max(-(-rows // int(parts)), 1))
    placed = coded.select("doc_id", "packed", key, "tie").withColumn("part", group_of(bounds, [F.col("key"), F.col("tie")]))
    writer = (placed.repartitionById(len(bounds), "part").sortWithinPartitions("key", "tie")
              .select("doc_id", "packed").mapInArrow(run, SCHEMA).write
              .option("compression", "zstd").option("parquet.block.size", ROW_GROUP_BYTES)
              .option("parquet.page.size", PAGE_BYTES).option("parquet.page.row.count.limit", PAGE_ROWS))
    if delta:
        writer = writer.option("parquet.writer.version", "PARQUET_2_0").option("parquet.enable.dictionary", "false")
    writer.parquet(path)


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_id, start, n_tokens)``: ``start`` counts the tokens of all documents before.  Reads no token page.  The rows that come
    together are one for each part."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    return _with_start(rows).select("doc_id", "start", "n_tokens")


def read_tokens(spark: SparkSession, path: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """``(doc_id, start, n_tokens, ids)``, of the ids from ``first`` to ``last`` if given; the bounds reach the row groups and pages."""
    rows = spark.read.schema(SCHEMA).parquet(path)
    picked = rows
    if first is not None:
        picked = picked.where(F.col("doc_id") >= first)
    if last is not None:
        picked = picked.where(F.col("doc_id") <= last)
    return _with_start(picked, rows).select("doc_id", "start", "n_tokens", "ids")


def _with_start(rows: DataFrame, whole: DataFrame | None = None) -> DataFrame:
    ends = (whole or rows).groupBy("part").agg(F.max(F.col("part_start") + F.col("n_tokens")).alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = ends.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    # One row for each written part of PART_BYTES of text: 24 MB of rows for 100 TB.
    return rows.join(F.broadcast(base), "part").withColumn("start", F.col("base") + F.col("part_start"))


def digests(tokens: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of ``read_tokens`` rows: the unsigned crc32 of the ids as little-endian 32-bit integers."""
    @tx.tidy
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            to = lists.offsets.to_numpy()
            raw = memoryview(np.ascontiguousarray(lists.values.to_numpy(zero_copy_only=False), "<i4")).cast("B")
            crc = [zlib.crc32(raw[4 * a:4 * b]) for a, b in zip(to.tolist(), to[1:].tolist())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")
