"""Spelling variants against brute force."""

import random
import re
import zlib
from collections import Counter

import duckdb
import pytest

from conftest import SF_SMALL
from intervalflow.llm import queries, variants

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def one_edit(a, b):
    """Whether one edit leads from one word to the other: what is left between their common start and end is that edit."""
    a, b = sorted((a, b), key=len)
    start = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a != b and (a[start + 1:] == b[start + 1:] if len(a) == len(b) else a[start:] == b[start + 1:])


def near(word, words, letters):
    """Near words, by trying every edit; of very long words by looking at every word."""
    if len(word) > 100:
        return {x for x in words if abs(len(x) - len(word)) < 2 and one_edit(word, x)}
    cuts = [(word[:i], word[i:]) for i in range(len(word) + 1)]
    tries = {a + b[1:] for a, b in cuts if b} | {a + c + b for a, b in cuts for c in letters} | {a + c + b[1:] for a, b in cuts if b for c in letters}
    return (tries & words.keys()) - {word}


def brute(rows, min_length=7, delete=31):
    count = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m.group().lower(), run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % delete == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            count[run] += 1
    words = {w: n for w, n in count.items() if len(w) >= min_length and n >= 2}
    letters, form, found = set("".join(words)), {}, {}
    for w, n in words.items():
        found[w] = near(w, words, letters)
        best = min(found[w], key=lambda x: (-words[x], x), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None
    out = set()
    for w, n in words.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.add((w, form[w], root, n, len(found[w]), None if form[w] is None else words[form[w]]))
    return out


def test_query_matches_brute_force(spark):
    rows = duckdb.connect().execute(f"SELECT doc_id, text FROM '{SF_SMALL}/documents.parquet'").fetchall()
    got = queries.op13_spelling_variants(spark, SF_SMALL)
    assert got.columns == COLUMNS
    assert {tuple(r) for r in got.collect()} == brute(rows)


@pytest.mark.parametrize("levels", [(1, 4), (1, 3), (2, 3), (3, 1)])
def test_no_near_pair_is_lost(spark, levels):
    rng = random.Random(1)
    words = {"".join(rng.choice("abÿé") for _ in range(rng.choice([7, 7, 8, 9]))) for _ in range(700)} | {"a" * 3000, "a" * 3001}
    df = spark.createDataFrame([(w, 2) for w in words], "word string, n long")
    got = {(r.a, r.b) for r in variants.near_pairs(df, first=levels[0], second=levels[1]).collect()}
    table = dict.fromkeys(words, 2)
    want = {tuple(sorted((w, x))) for w in words for x in near(w, table, "abÿé")}
    assert got == want


def test_chains_ties_and_edges(spark):
    text = " ".join(["Harbours"] * 2 + ["harbour"] * 30 + ["harboure"] * 400 + ["harbourx"] * 400 + ["HarboureX"] * 5000 + ["ÀÉÎÕÜñç"] * 3 + ["àÉÎÕÜñç"] * 3 + ["short"] * 9)
    schema = "doc_id long, text string, word int, n string"
    rows = [(1, text), (1, None), (2, ""), (None, "lonelyword lonelyword"), (None, "lonelyword lonelyword"), (3, "x" * 50_000 + " " + "x" * 50_000)]
    df = spark.createDataFrame([(i, t, 1, "n") for i, t in rows], schema)
    got = variants.spelling_variants(df)
    assert {tuple(r) for r in got.collect()} == brute(rows)
    assert variants.spelling_variants(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        variants.choices(2, 1, 2)
