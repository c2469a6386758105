"""SentencePiece encoding and decoding as a relational lattice.

Texts fall into chunks: a run of spaces and what follows up to the next one (no piece of a model that splits at white space reaches
across).  The distinct chunks of the corpus are encoded once, as relations:

1. every chunk is exploded into its substrings of bounded length;
2. an equi-join with the piece table keeps those that are pieces: the edges of the chunk's lattice;
3. edges are grouped by chunk (the rows are still partitioned by chunk, so nothing is shuffled again);
4. a higher-order ``aggregate`` folds each chunk's edges into its segmentation.

For a unigram model the fold is Viterbi: the best path by the sum of scores.  A BPE model does not define its result as a best
path, so there the same edges are folded in order of score, then of their end, then from the shortest: an edge is taken if both
its ends are symbol bounds and exactly one bound lies between, which it removes.  This replays the merges, since a BPE
piece's own merges all have better scores; among equal scores (the runs of spaces) it takes the leftmost first.

Chunks map back to documents through ``wordmap``.  Characters that the model does not know become byte pieces, or the unknown piece if the model has none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import wordmap
from .storage import stage

MODEL = "piece_bpe_32k.model"
SPACE = "▁"
UNIGRAM, BPE = 1, 2
_WIDE = 32          # symbol bounds in one element of a long chunk's state
_SHORT = 61         # characters whose bounds fit one 64-bit state


# ---------------------------------------------------------------- model

def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(field number, value) of a protocol-buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        out = shift = 0
        while True:
            b = data[at]
            at += 1
            out |= (b & 127) << shift
            shift += 7
            if b < 128:
                return out

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        else:
            n = varint() if key & 7 == 2 else 8 if key & 7 == 1 else 4
            yield key >> 3, data[at:at + n]
            at += n


@dataclass
class Model:
    """What encoding needs of a SentencePiece model file."""

    pieces: list[str]
    scores: list[float]
    kinds: list[str]                    # piece, byte, unknown, control or unused
    algorithm: int                      # UNIGRAM or BPE
    dummy_prefix: bool = True
    byte_ids: list[int] = field(default_factory=list)       # of the bytes 0 to 255; empty without byte pieces
    unknown_id: int = 0

    @classmethod
    def load(cls, path: str | None = None, proto: bytes | None = None) -> Model:
        import sentencepiece
        if proto is None:
            with open(path or public_tokenizers.path(MODEL), "rb") as f:
                proto = f.read()
        sp = sentencepiece.SentencePieceProcessor(model_proto=proto)
        ids = range(sp.get_piece_size())
        kinds = ["byte" if sp.is_byte(i) else "unknown" if sp.is_unknown(i) else "control" if sp.is_control(i)
                 else "unused" if sp.is_unused(i) else "piece" for i in ids]
        trainer = [v for k, v in _fields(proto) if k == 2]
        normalizer = [v for k, v in _fields(proto) if k == 3]
        algorithm = next((v for k, v in _fields(trainer[0]) if k == 3), UNIGRAM) if trainer else UNIGRAM
        rules = dict(_fields(normalizer[0])) if normalizer else {}
        pieces = [sp.id_to_piece(i) for i in ids]
        usable = [p for p, k in zip(pieces, kinds) if k == "piece"]
        if algorithm not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models are supported")
        if rules.get(2) or rules.get(4, 1) or not rules.get(5, 1):
            raise ValueError("only models that keep text and white space as they are, and escape spaces, are supported")
        if any(a != SPACE and b == SPACE for p in usable for a, b in zip(p, p[1:])) or max(map(len, usable)) > 31:
            raise ValueError("a piece reaches across a space, or is longer than 31 characters")
        bytes_ = [i for i in ids if kinds[i] == "byte"]
        return cls(pieces, [sp.get_score(i) for i in ids], kinds, algorithm, bool(rules.get(3, 1)),
                   bytes_ if len(bytes_) == 256 else [], sp.unk_id())

    def table(self, spark: SparkSession) -> DataFrame:
        """``(piece, id, rank, score)``; equal scores have equal ranks, the best is 0."""
        use = [i for i, k in enumerate(self.kinds) if k == "piece"]
        rank = {s: r for r, s in enumerate(sorted({self.scores[i] for i in use}, reverse=True))}
        return spark.createDataFrame([(self.pieces[i], i, rank[self.scores[i]], float(self.scores[i])) for i in use],
                                     "piece string, id int, rank long, score float")

    def longest(self) -> int:
        return max(len(p) for p, k in zip(self.pieces, self.kinds) if k == "piece")

    def alone(self) -> bytes:
        """White-space characters other than the space that no longer piece holds: chunks end at them."""
        held = set("".join(p for p, k in zip(self.pieces, self.kinds) if k == "piece" and len(p) > 1))
        return bytes(ord(c) for c in "\n\t\r" if c not in held)


# ---------------------------------------------------------------- chunks

def chunk_bounds(texts: list[bytes], prefix: bool, alone: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, first chunk of every row) of texts, each after a space if ``prefix`` and it is not empty."""
    parts = [b" " + t if t and prefix else t for t in texts]
    bounds = np.zeros(len(parts) + 1, np.int64)
    np.cumsum([len(p) for p in parts], out=bounds[1:])
    data = np.frombuffer(b"".join(parts), np.uint8)
    space, single = data == 32, np.isin(data, np.frombuffer(alone, np.uint8))
    start = single.copy()
    start[1:] |= single[:-1] | space[1:] & ~space[:-1]
    start[bounds[:-1][bounds[:-1] < len(data)]] = True
    starts = np.flatnonzero(start)
    return data, starts, np.append(starts[1:], len(data)) if len(starts) else starts, np.searchsorted(starts, bounds)


# ---------------------------------------------------------------- lattice

#: An edge in one number that sorts as it is to be folded: rank, end, length.
_EDGE = "shiftleft(rank, 32) | shiftleft(CAST(start + len AS BIGINT), 8) | CAST(len AS BIGINT)"
_START, _LEN = "((shiftright(e, 8) & 16777215) - (e & 255))", "CAST(e & 255 AS INT)"


def _bpe_short() -> str:
    """Fold of a chunk of up to ``_SHORT`` characters: bit p of the state says that a symbol starts at p (or the chunk ends)."""
    s, n = f"CAST({_START} AS INT)", _LEN
    inner = f"(shiftright(m, {s} + 1) & (shiftleft(1L, {n} - 1) - 1))"
    ends = f"(shiftright(m, {s}) & shiftright(m, {s} + {n}) & 1L) = 1L"
    return (f"aggregate(edges, shiftleft(1L, size + 1) - 1, (m, e) -> CASE WHEN {ends} AND {inner} <> 0 AND ({inner} & ({inner} - 1)) = 0 "
            f"THEN m & ~shiftleft({inner}, {s} + 1) ELSE m END)")


def _bpe_long() -> str:
    """The same for longer chunks: the bounds lie in an array, ``_WIDE`` to an element; an edge spans two elements at most."""
    w, o, n = f"CAST({_START} DIV {_WIDE} AS INT)", f"CAST({_START} % {_WIDE} AS INT)", _LEN
    pair = f"(a[{w}] | shiftleft(coalesce(get(a, {w} + 1), 0L), {_WIDE}))"
    inner = f"(shiftright({pair}, {o} + 1) & (shiftleft(1L, {n} - 1) - 1))"
    ends = f"(shiftright({pair}, {o}) & shiftright({pair}, {o} + {n}) & 1L) = 1L"
    low = (1 << _WIDE) - 1
    start = f"transform(sequence(0, size DIV {_WIDE}), k -> CASE WHEN k < size DIV {_WIDE} THEN {low}L ELSE shiftleft(1L, size % {_WIDE} + 1) - 1 END)"
    gone = f"shiftleft({inner}, {o} + 1)"
    return (f"aggregate(edges, {start}, (a, e) -> CASE WHEN {ends} AND {inner} <> 0 AND ({inner} & ({inner} - 1)) = 0 THEN "
            f"transform(a, (x, k) -> CASE WHEN k = {w} THEN x & ~({gone} & {low}L) WHEN k = {w} + 1 THEN x & ~shiftright({gone}, {_WIDE}) ELSE x END) "
            f"ELSE a END)")


def _viterbi() -> str:
    """Start of the best piece that ends at each position.  Edges come by end, then start; scores add as floats; of equal sums the first
    stays."""
    step = ("CASE WHEN s.best[e.start] + e.score > coalesce(get(s.best, e.stop), CAST('-Infinity' AS FLOAT)) THEN "
            "named_struct('best', transform(s.best, (x, k) -> CASE WHEN k = e.stop THEN CAST(s.best[e.start] + e.score AS FLOAT) ELSE x END), "
            "'back', transform(s.back, (x, k) -> CASE WHEN k = e.stop THEN e.start ELSE x END)) ELSE s END")
    zero = ("named_struct('best', transform(sequence(0, size), k -> CASE WHEN k = 0 THEN CAST(0 AS FLOAT) ELSE CAST('-Infinity' AS FLOAT) END), "
            "'back', transform(sequence(0, size), k -> -1))")
    return f"aggregate(edges, {zero}, (s, e) -> {step}, s -> s.back)"


def encode_chunks(chunks: DataFrame, model: Model) -> DataFrame:
    """``(chunk, n, ids)`` of ``(chunk, n)`` rows that are partitioned by chunk."""
    spark = chunks.sparkSession
    pieces = F.broadcast(model.table(spark))                   # as many rows as the model has pieces
    size = F.length("chunk")
    spans = (chunks.withColumn("start", F.explode(F.sequence(F.lit(0), size - 1)))
             .withColumn("len", F.explode(F.sequence(F.lit(1), F.least(F.lit(model.longest()), size - F.col("start"))))))
    sub = F.translate(F.substring("chunk", F.col("start") + 1, F.col("len")), " ", SPACE)
    if model.algorithm == BPE:
        # The span of length 1 at the start carries no edge; it keeps chunks that have none.
        edges = (spans.where("len > 1 OR start = 0").withColumn("piece", sub).join(pieces, "piece", "left")
                 .where("len = 1 OR rank IS NOT NULL").withColumn("e", F.when(F.col("len") > 1, F.expr(_EDGE))))
        state = edges.groupBy("chunk", "n").agg(F.array_sort(F.collect_list("e")).alias("edges")).withColumn("size", size)
        short = F.col("size") <= _SHORT
        state = state.withColumn("bits", F.when(short, F.array(F.expr(_bpe_short()))).otherwise(F.expr(_bpe_long())))
        state = state.withColumn("w", F.when(short, F.lit(64)).otherwise(F.lit(_WIDE)))
        state = state.withColumn("starts", F.expr(
            "filter(sequence(0, size - 1), p -> (shiftright(bits[CAST(p DIV w AS INT)], CAST(p % w AS INT)) & 1L) = 1L)"))
    else:
        unknown = min(s for s, k in zip(model.scores, model.kinds) if k == "piece") - 10.0
        edges = spans.withColumn("piece", sub).join(pieces, "piece", "left").where("len = 1 OR score IS NOT NULL")
        edge = F.struct((F.col("start") + F.col("len")).alias("stop"), F.col("start"),
                        F.coalesce("score", F.lit(unknown).cast("float")).alias("score"))
        state = edges.groupBy("chunk", "n").agg(F.array_sort(F.collect_list(edge)).alias("edges")).withColumn("size", size)
        state = state.withColumn("back", F.expr(_viterbi()))
        state = state.withColumn("starts", F.expr(
            "aggregate(sequence(1, size), array(size), (s, k) -> CASE WHEN s[0] > 0 THEN concat(array(back[s[0]]), s) ELSE s END, "
            "s -> slice(s, 1, cardinality(s) - 1))"))
    tokens = state.select("chunk", "n", F.posexplode(F.expr(
        "transform(starts, (p, i) -> substring(chunk, p + 1, coalesce(get(starts, i + 1), size) - p))")).alias("at", "piece"))
    named = tokens.withColumn("piece", F.translate("piece", " ", SPACE)).join(pieces.select("piece", "id"), "piece", "left")
    ids = F.when(F.col("id").isNotNull(), F.array("id")).otherwise(_unknown_ids(model))
    ordered = named.groupBy("chunk", "n").agg(F.array_sort(F.collect_list(F.struct("at", ids.alias("ids")))).alias("t"))
    return ordered.select("chunk", "n", F.flatten(F.col("t.ids")).alias("ids"))


def _unknown_ids(model: Model) -> Column:
    """Ids of a character that is no piece."""
    if not model.byte_ids:
        return F.array(F.lit(model.unknown_id))
    ids = ", ".join(map(str, model.byte_ids))
    return F.expr(f"transform(sequence(1, octet_length(piece)), k -> element_at(array({ids}), "
                  "CAST(conv(hex(substring(encode(piece, 'UTF-8'), k, 1)), 16, 10) AS INT) + 1))")


# ---------------------------------------------------------------- documents

def encode(docs: DataFrame, text_col: str = "text", out_col: str = "ids", model: Model | None = None,
           dictionary_words: int = wordmap.DICTIONARY_WORDS, decoded_col: str | None = None, keep_text: bool = True) -> DataFrame:
    """``docs`` with the ids of the whole text in ``out_col`` (array of int, replacing a column of that name), and with the text that
    they decode to in ``decoded_col``, if given (in the same tasks, so no second set of Python workers is needed).  Without ``keep_text`` the
    column ``text_col`` is not in the result.

    Null and empty texts have no ids.  Repeated rows are encoded alike.  Work on a chunk grows with its length; chunks longer than
    61 characters keep their state in an array."""
    model = model or Model.load()
    prefix, alone = model.dummy_prefix, model.alone()

    def cut(texts: list[bytes]) -> wordmap.Cut:
        return chunk_bounds(texts, prefix, alone)

    words = stage(encode_chunks(wordmap.count(docs, text_col, cut), model), "chunks")
    src = docs.drop(decoded_col) if decoded_col else docs
    then = (_decoder(model, out_col, decoded_col), f"`{decoded_col}` string") if decoded_col else None
    return wordmap.encode(src, text_col, out_col, words, cut, len(model.pieces) > 1 << 16, dictionary_words, then=then, keep_text=keep_text)


def _decoder(model: Model, ids_col: str, out_col: str):
    """A function that adds the decoded text to Arrow batches."""
    texts = [bytes([model.byte_ids.index(i)]) if k == "byte" else b"" if k in ("control", "unused") else
             " \u2047 ".encode() if k == "unknown" else p.replace(SPACE, " ").encode() for i, (p, k) in enumerate(zip(model.pieces, model.kinds))]
    bounds = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    flat, prefix = np.frombuffer(b"".join(texts), np.uint8), model.dummy_prefix

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 500):
                part = batch.slice(lo, 500)
                lists = part.column(part.schema.get_field_index(ids_col))
                ids = lists.flatten().to_numpy().astype(np.int64)
                if len(ids) and not 0 <= ids.min() <= ids.max() < len(bounds) - 1:
                    raise ValueError("an id that the model does not have")
                n = bounds[ids + 1] - bounds[ids]
                stop = np.concatenate([[0], np.cumsum(n)])
                data = flat[np.arange(stop[-1]) - np.repeat(stop[:-1] - bounds[ids], n)].tobytes()
                rows = np.concatenate([[0], np.cumsum([0 if v is None else v for v in lists.value_lengths().to_pylist()])])
                out = [data[stop[a]:stop[b]].decode(errors="replace") for a, b in zip(rows, rows[1:])]
                out = [None if not ok else t[1:] if prefix and t[:1] == " " else t for t, ok in zip(out, lists.is_valid().to_pylist())]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(out, pa.string())], [*part.schema.names, out_col])

    return run


def decode(coded: DataFrame, ids_col: str = "ids", out_col: str = "decoded", model: Model | None = None) -> DataFrame:
    """``coded`` with the text of ``ids_col`` in ``out_col``; null ids give null.  Control pieces have no text; ids that the model
    does not have are an error.  Byte pieces that are not UTF-8 become replacement characters."""
    src = coded.drop(out_col)
    schema = ", ".join([f"`{c}` {t}" for c, t in src.dtypes] + [f"`{out_col}` string"])
    return src.mapInArrow(_decoder(model or Model.load(), ids_col, out_col), schema)
