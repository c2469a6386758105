"""Merkle fingerprints against a plain version."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from intervalflow.llm import fingerprints as fp

SCHEMA = "doc_id long, text string, tree int, next_text int"


def sha(s):
    return hashlib.sha256(s.encode()).hexdigest()


def plain_tree(text):
    paras = []
    for line in (text or "").split("\n"):
        pieces = [sha("0" + x) for x in re.findall(fp.PIECE, line)]
        paras.append((sha("1" + "".join(pieces)), pieces))
    sections, held = [], []
    for i, (digest, pieces) in enumerate(paras):
        held.append(digest)
        if i == len(paras) - 1 or not pieces or digest[0] in "01":
            sections.append(sha("2" + "".join(held)))
            held = []
    return sha("3" + "".join(sections)), {x for _, p in paras for x in p}, [d for d, _ in paras]


def texts():
    rng = random.Random(2)
    words = ["a", "the.", "fox!", "x" * 30, "été", "𝒳y", "\t", "q?\r"]
    out = ["", None, "\n\n", " ", "one", "w" * 200_000, "a\nb\n\nc", "a\nb\n\nc"]
    out += ["".join(rng.choice(words) + rng.choice([" ", "  ", "\n", "\n\n"]) for _ in range(rng.choice([1, 7, 40, 900]))) for _ in range(30)]
    return out


def test_trees_match_the_plain_version(spark):
    rows = list(enumerate(texts()))
    df = fp.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"))
    got = {r.doc_id: r for r in df.select("doc_id", "tree.root", fp.leaves("tree").alias("leaves"), F.flatten(
        F.transform("tree.sections", lambda s: s["paragraphs"])).alias("p")).collect()}
    for i, t in rows:
        root, leaves, paras = plain_tree(t)
        assert (got[i].root, set(got[i].leaves), [p.digest for p in got[i].p]) == (root, leaves, paras)
        assert "".join(x for line in (t or "").split("\n") for x in re.findall(fp.PIECE, line)) == (t or "").replace("\n", "")
    roots = {}
    for i, t in rows:
        assert roots.setdefault(got[i].root, t or "") == (t or "")


def test_first_edit_and_likeness(spark):
    base = "\n".join(f"Line {i} of the text has a few words. And one more sentence here." for i in range(60))
    lines = base.split("\n")
    changed = "\n".join([*lines[:41], lines[41].replace("more", "other"), *lines[42:]])
    longer = base + "\nmore"
    rows = spark.createDataFrame([(1, base, changed), (2, base, longer), (3, base, base), (4, longer, base), (5, "", "x"), (6, None, "")], "k int, a string, b string")
    df = rows.withColumns({"ta": fp.tree("a"), "tb": fp.tree("b")}).withColumns({"la": fp.leaves("ta"), "lb": fp.leaves("tb")})
    got = {r.k: r for r in df.select("k", fp.first_edit("ta", "tb").alias("e"), fp.likeness(
        F.col("ta.root"), F.col("la"), F.col("tb.root"), F.col("lb")).alias("like")).collect()}
    assert (got[1].e.paragraph, got[1].e.piece) == (42, 3) and 0.9 < got[1].like < 1
    assert (got[2].e.paragraph, got[4].e.paragraph, got[5].e.paragraph, got[5].e.piece) == (61, 61, 1, 1)
    assert got[3].e is None and got[6].e is None and got[3].like == got[6].like == 1.0 and got[5].like == 0.0


@pytest.mark.parametrize("group", [1, 7, 1000])
def test_next_document(spark, monkeypatch, group):
    monkeypatch.setattr(fp, "GROUP_ROWS", group)
    rng = random.Random(group)
    rows = [(rng.randrange(-10**17, 10**17), f"t{i}", 1, 2) for i in range(120)] + [(None, "n", 1, 2), (5, "x", 1, 2), (5, "x", 1, 2), (5, None, 1, 2)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = fp.with_next(df, "doc_id", "text", {"id2": F.col("doc_id"), "body": F.col("text")}).collect()
    assert len(got) == len(rows)
    ids = sorted(r[0] for r in rows if r[0] is not None and r[0] != 5)
    after = {a: b for a, b in zip(ids, ids[1:])}
    text_of = {r[0]: r[1] for r in rows if r[0] is not None}
    for r in got:
        if r.doc_id in after and not r.doc_id < 5 < after[r.doc_id]:      # the repeated id stands between no two others
            assert (r.next_id2, r.next_body) == (after[r.doc_id], text_of[after[r.doc_id]])
    assert [r.next_body for r in got if r.doc_id == ids[-1]] == ["n"]         # the null id is first
    assert sorted(str(r.next_body) for r in got if r.next_id2 == 5) == ["None", "x", "x"]
    assert "next_text" in got[0].asDict() and got[0].tree == 1


def test_hot_id_is_split_and_small_tables(spark, monkeypatch):
    monkeypatch.setattr(fp, "GROUP_ROWS", 10)
    df = spark.createDataFrame([(7, f"t{i}") for i in range(400)] + [(i, "o") for i in range(50, 90)], "doc_id long, text string")
    keyed = df.withColumns({"__key": F.col("doc_id"), "__tie": F.xxhash64("text")})
    assert fp._bounds(keyed)[1] is not None
    got = fp.with_next(df, "doc_id", "text", {"body": F.col("text")}).collect()
    assert len(got) == 440 and sorted(r.next_body for r in got) == sorted(r.body for r in got)
    assert fp.with_next(df.limit(0), "doc_id", "text", {"body": F.col("text")}).count() == 0
    assert fp.with_next(df.limit(1), "doc_id", "text", {"body": F.col("text")}).first().next_body == df.first().text
