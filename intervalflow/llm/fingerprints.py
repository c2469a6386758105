"""Document fingerprints: a Merkle tree over sections, paragraphs and pieces, built from built-in SQL functions alone.

A text's lines are its paragraphs.  A paragraph falls into pieces: the words up to the end of a sentence, eight at most, with the white space
that follows.  Consecutive paragraphs form a section, which ends at a blank line or after a paragraph whose digest begins with 0 or 1 (one in
eight), so an edit moves no section bound but its own.  The digest of a piece is the SHA-256 of its bytes; that of a paragraph, a section or
the root is the SHA-256 of its children's digests; a leading character tells the levels apart.  Nothing of the text is left out, so two texts
have one root only if they are equal, and where the roots differ, the differing branches lead to the edit.

``with_next`` puts beside each document the next one in ascending id order with a single exchange of the texts.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: White space is space and tab to carriage return.  Up to seven words that end no sentence, then one word; or white space alone.
PIECE = r"(?:[^\x20\x09-\x0D]*[^\x20\x09-\x0D.!?][\x20\x09-\x0D]+){0,7}(?:[^\x20\x09-\x0D]+[\x20\x09-\x0D]*|[\x20\x09-\x0D]+)"
#: First digits of a paragraph's digest after which its section ends.
SECTION_ENDS = "01"
#: Documents in a group that one task puts in order, and the most groups that there are.
GROUP_ROWS, MAX_GROUPS, GROUPS_A_TASK = 1000, 1 << 18, 4
_LEAST = -(1 << 63)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _digest(level: str, parts: Column) -> Column:
    return F.sha2(F.concat(F.lit(level), F.array_join(parts, "")), 256)


def tree(text: str | Column) -> Column:
    """``struct<root, sections: array<struct<digest, paragraphs: array<struct<digest, pieces: array<digest>>>>>>``.  A null text counts as empty:
    one section of one blank paragraph."""
    text = F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))
    pieces = F.transform(F.split(text, "\n", -1), lambda line: F.transform(
        F.regexp_extract_all(line, F.lit(PIECE), F.lit(0)), lambda x: F.sha2(F.concat(F.lit("0"), x), 256)))
    paragraphs = F.transform(pieces, lambda p: F.struct(_digest("1", p).alias("digest"), p.alias("pieces")))

    def sections(ps: Column) -> Column:
        last = F.size(ps) - 1
        ends = F.filter(F.sequence(F.lit(0), last), lambda i: (i == last) | (F.size(F.get(ps, i)["pieces"]) == 0) | F.substring(
            F.get(ps, i)["digest"], 1, 1).isin(*SECTION_ENDS))
        return _let(ends, lambda es: F.transform(es, lambda e, k: _let(
            F.when(k == 0, F.lit(0)).otherwise(F.get(es, k - 1) + 1), lambda at: F.slice(ps, at + 1, e - at + 1))))

    marked = F.transform(_let(paragraphs, sections),
                         lambda s: F.struct(_digest("2", F.transform(s, lambda p: p["digest"])).alias("digest"), s.alias("paragraphs")))
    return _let(marked, lambda m: F.struct(_digest("3", F.transform(m, lambda s: s["digest"])).alias("root"), m.alias("sections")))


def leaves(tree_col: str | Column) -> Column:
    """The distinct piece digests of a tree."""
    t = F.col(tree_col) if isinstance(tree_col, str) else tree_col
    return F.array_distinct(F.flatten(F.flatten(F.transform(t["sections"], lambda s: F.transform(s["paragraphs"], lambda p: p["pieces"])))))


def likeness(root_a: Column, leaves_a: Column, root_b: Column, leaves_b: Column) -> Column:
    """1 for equal roots; else the share of the two trees' distinct pieces that both have (0 if one has none)."""
    both = F.size(leaves_a) + F.size(leaves_b)
    common = F.size(F.array_intersect(leaves_a, leaves_b))
    return F.when(root_a == root_b, F.lit(1.0)).when(both == 0, F.lit(0.0)).otherwise(2.0 * common / both)


def first_edit(a: str, b: str) -> Column:
    """Where tree ``b`` first leaves tree ``a``: ``struct<section, paragraph, piece>``, numbered from 1, the paragraph within the text and the
    piece within the paragraph.  The branches are walked from the root; equal ones are passed over by their digests.  Null for equal roots."""
    def equal_before(x: Column, y: Column) -> Column:
        """How many leading elements are equal."""
        n = F.least(F.size(x), F.size(y))
        return F.coalesce(F.nullif(F.array_position(F.transform(F.slice(x, F.lit(1), n), lambda e, i: e == F.get(y, i)), False), F.lit(0)) - 1, n).cast("int")

    def digests(nodes: Column) -> Column:
        return F.transform(nodes, lambda s: s["digest"])

    def children(sections: Column, s: Column) -> Column:
        return F.coalesce(F.get(sections, s)["paragraphs"], F.array().cast("array<struct<digest: string, pieces: array<string>>>"))

    def pieces(paragraphs: Column, p: Column) -> Column:
        return F.coalesce(F.get(paragraphs, p)["pieces"], F.array().cast("array<string>"))

    sa, sb = F.col(a)["sections"], F.col(b)["sections"]

    def in_section(s: Column) -> Column:
        pa, pb = children(sa, s), children(sb, s)
        before = F.aggregate(F.slice(sa, F.lit(1), s), F.lit(0), lambda n, x: n + F.size(x["paragraphs"]))
        return _let(equal_before(digests(pa), digests(pb)), lambda p: F.struct(
            (s + 1).alias("section"), (before + p + 1).alias("paragraph"), (equal_before(pieces(pa, p), pieces(pb, p)) + 1).alias("piece")))

    return F.when(F.col(a)["root"] != F.col(b)["root"], _let(equal_before(digests(sa), digests(sb)), in_section))


# ---------------------------------------------------------------- order

def _bounds(docs: DataFrame) -> tuple[list[int], list[int] | None]:
    """Least (key, tie) of each group of about ``GROUP_ROWS`` documents in order, ``MAX_GROUPS`` at most.  Ids alone are read; only where one id
    fills several groups do the texts' hashes split it, else there are no ties."""
    rows = docs.count()
    groups = max(1, min(MAX_GROUPS, rows // GROUP_ROWS))

    def least(*cols: str) -> list:
        parts = docs.select(*cols).repartitionByRange(groups, *cols).groupBy(F.spark_partition_id().alias("part"))
        return sorted(parts.agg(F.min(F.struct(*cols)).alias("first"), F.count(F.lit(1)).alias("n")).collect(), key=lambda r: r["first"])

    found = least("__key")
    if len(found) == 0 or max(r["n"] for r in found) <= 4 * max(rows / len(found), GROUP_ROWS):
        return [r["first"][0] for r in found], None
    found = least("__key", "__tie")
    return [r["first"][0] for r in found], [r["first"][1] for r in found]


def with_next(docs: DataFrame, id_col: str, text_col: str, values: dict[str, Column]) -> DataFrame:
    """``docs`` with the columns ``values`` (expressions of a document) and ``next_<name>`` of each: its value in the next document in ascending
    order of the id, after the last one the first.

    Null ids come first (as the least 64-bit number); rows that repeat an id stand in the order of their text's hash, so the next document of a repeated row may be its
    repeat.  A single document is its own next one.  Documents are dealt into groups of consecutive ids; each group's first documents also
    go to the group before as guards, so one exchange is enough.  Documents that repeat both id and text share a group."""
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(_LEAST))
    keyed = docs.withColumn("__key", key).withColumn("__tie", F.xxhash64(F.col(text_col)))
    ids, ties = _bounds(keyed)
    last = max(len(ids) - 1, 0)

    def fixed(numbers: list[int]) -> Column:
        return F.from_json(F.lit(json.dumps(numbers)), "array<bigint>")

    def own_group(at: Column) -> Column:
        """Whether a document's place is at or after the start of group ``at``."""
        first = F.get(fixed(ids), at)
        return first <= F.col("__key") if ties is None else (first < F.col("__key")) | (first == F.col("__key")) & (F.get(fixed(ties), at) <= F.col("__tie"))

    def halve(state: Column, _: Column) -> Column:
        mid = F.floor((state["lo"] + state["hi"] + 1) / 2).cast("int")
        return _let(mid, lambda m: F.when(own_group(m), F.struct(m.alias("lo"), state["hi"].alias("hi")))
                    .otherwise(F.struct(state["lo"].alias("lo"), F.greatest(m - 1, state["lo"]).alias("hi"))))

    steps = F.sequence(F.lit(1), F.lit(max(1, last.bit_length())))
    group = F.aggregate(steps, F.struct(F.lit(0).alias("lo"), F.lit(last).alias("hi")), halve, lambda s: s["lo"])
    leads = F.get(fixed(ids), F.col("__group")) == F.col("__key")
    if ties is not None:
        leads &= F.get(fixed(ties), F.col("__group")) == F.col("__tie")
    before = F.when(F.col("__group") == 0, F.lit(last)).otherwise(F.col("__group") - 1)
    place = F.struct(F.col("__group").alias("group"), F.lit(False).alias("guard"))
    places = F.when(leads, F.array(place, F.struct(before.alias("group"), F.lit(True).alias("guard")))).otherwise(F.array(place))
    dealt = (keyed.withColumn("__group", group).withColumn("__place", F.explode(places))
             .withColumns({"__group": F.col("__place.group"), "__guard": F.col("__place.guard")}).drop("__place")
             .repartition(max(1, -(-len(ids) // GROUPS_A_TASK)), "__group").sortWithinPartitions("__group", "__guard", "__key", "__tie"))
    order = Window.partitionBy("__group").orderBy("__guard", "__key", "__tie")
    out = dealt.withColumns(values).withColumns({f"next_{name}": F.lead(name).over(order) for name in values})
    return out.where("NOT __guard").drop("__key", "__tie", "__group", "__guard")


def edited(text: Column, next_text: Column) -> Column:
    """``text`` with its last quarter (rounded down, in code points) replaced by as many leading ones of ``next_text``, or all it has."""
    n = F.floor(F.length(text) / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), F.length(text) - n), F.substring(next_text, F.lit(1), n))


def fingerprints(docs: DataFrame, text_col: str = "text", out_col: str = "tree") -> DataFrame:
    """``docs`` with the tree of the whole text in ``out_col`` (which replaces a column of that name).  Null and empty texts have the tree of
    one blank paragraph; equal texts have equal trees; repeated rows stay; an empty table stays empty."""
    return docs.withColumn(out_col, tree(text_col))
