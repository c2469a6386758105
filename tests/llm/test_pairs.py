"""Near-duplicates and components against brute force."""

import itertools
import random
import re

import numpy as np
import pytest

from intervalflow.llm import capfilter, minhash
from intervalflow.llm.graph import components


def brute_components(ids, links):
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 400)] + [(5, 5), (None, 3), (9, 8), (8, 9), (9, 8)]
    edges += [(rng.randrange(1000, 1400), rng.randrange(1000, 1400)) for _ in range(260)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    clean = [(a, b) for a, b in edges if a is not None and a != b]
    want = brute_components({x for e in clean for x in e}, clean)
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def word_set(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()


def near_texts():
    rng = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    out = []
    for _ in range(12):
        base = [rng.choice(words) for _ in range(rng.choice([3, 8, 40, 120]))]
        out.append(" ".join(base))
        for _ in range(rng.choice([0, 1, 6])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            out.append("  ".join(copy).replace("w1", "W1"))
    hot = [rng.choice(words) for _ in range(60)]
    out += [" ".join(hot[:i] + ["q"] + hot[i:]) for i in range(0, 60, 2)] + ["same text here now ok"] * 9 + ["", None, " \n", "x" * 100_000, "x" * 100_000]
    return out


@pytest.mark.parametrize("k", [4, 5])
def test_minhash_matches_brute_force(spark, k):
    texts = dict(enumerate(near_texts()))
    docs = spark.createDataFrame([(i, t, 1, "c") for i, t in texts.items()], "doc_id long, text string, id int, component_id string")
    sets = {i: word_set(t, k) for i, t in texts.items()}
    links = [(a, b) for a, b in itertools.combinations(texts, 2) if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b])]
    want = brute_components(texts, links)
    got = {r.id: r for r in minhash.near_duplicates(docs, k=k).collect()}
    assert {i: r.component_id for i, r in got.items()} == want
    assert all(r.n_shingles == len(sets[i]) and r.kept == (want[i] == i) for i, r in got.items())


def test_minhash_edge_tables(spark):
    schema = "doc_id long, text string"
    assert minhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    got = minhash.near_duplicates(spark.createDataFrame([(3, "a b c"), (3, "a b c"), (None, "a b c"), (1, "A b  c"), (None, None)], schema)).collect()
    assert sorted((r.id, r.component_id, r.kept) for r in got if r.id is not None) == [(1, 1, True), (3, 1, False), (3, 1, False)]
    assert [(r.component_id, r.kept) for r in got if r.id is None] == [(None, True)] * 2


def test_sketch_fills_every_bin_and_estimates_similarity():
    rng = np.random.default_rng(1)
    a = np.unique(rng.integers(0, 2**63, 300).astype(np.uint64))
    b = np.unique(np.concatenate([a[:240], rng.integers(0, 2**63, 60).astype(np.uint64)]))
    one = np.array([5], np.uint64)
    sk = minhash.sketches(np.concatenate([a, b, one]), np.cumsum([0, len(a), len(b), 1]), 240)
    assert (sk != ~np.uint64(0)).all()
    assert abs((sk[0] == sk[1]).mean() - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.1


def vectors():
    rng = np.random.default_rng(2)
    out = []
    for label in (0, 1, None):
        for _ in range(60):
            base = rng.normal(size=32)
            for s in rng.choice([0.0, 0.02, 0.05, 0.08], size=rng.integers(1, 4)):
                out.append((base + s * rng.normal(size=32), label))
    crowd = rng.normal(size=32)
    out += [(crowd + 0.03 * rng.normal(size=32), 1) for _ in range(150)] + [(crowd, 1)] * 5
    return out


def test_cap_filters_match_brute_force(spark, monkeypatch):
    monkeypatch.setattr(capfilter, "TILE", 50)      # several tiles for the crowd
    data = [(i, [float(x) for x in v], label) for i, (v, label) in enumerate(vectors())]
    n = len(data)
    bad = [(n, None, 1), (n + 1, [0.0] * 32, 1), (n + 2, [float("nan")] * 32, 1), (n + 3, [float("inf")] * 32, 1), (n + 4, [], 1), (n + 5, [None] * 32, 1),
           (None, data[0][1], 0), (n + 6, [1e300] * 32, 3), (n + 7, [1e-300] * 32, 3), (n + 8, [1.0] * 8, 3)]
    table = spark.createDataFrame([(*r, "clash") for r in data + bad], "vec_id long, embedding array<double>, label int, weight string")
    got = {r.id: r for r in capfilter.similar(table).collect()}
    u = np.array([r[1] for r in data])
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    hit = (u @ u.T >= 0.93) & np.array([[a[2] is not None and a[2] == b[2] for b in data] for a in data])
    np.fill_diagonal(hit, False)
    links = [(int(a), int(b)) for a, b in zip(*np.nonzero(np.triu(hit)))]
    found = sum(got[i].n_links for i in range(n))
    assert all(got[i].n_links <= hit[i].sum() for i in range(n)) and found >= 0.97 * hit.sum()
    want = brute_components(range(n), links)
    assert sum(got[i].component_id == want[i] for i in range(n)) >= 0.97 * n
    assert all(got[n + k].n_links == 0 and got[n + k].kept for k in (0, 1, 2, 3, 4, 5, 8)) and got[None].n_links == 0
    assert got[n + 6].n_links == got[n + 7].n_links == 1 and got[n + 7].component_id == n + 6
    assert capfilter.similar(table.limit(0)).count() == 0


def pairs_at(cosine, n, dim, seed=4):
    rng = np.random.default_rng([seed, dim])
    u = rng.normal(size=(n, dim))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    w = rng.normal(size=u.shape)
    w -= (w * u).sum(1, keepdims=True) * u
    return u, cosine * u + np.sqrt(1 - cosine ** 2) * w / np.linalg.norm(w, axis=1, keepdims=True)


@pytest.mark.parametrize("rows", [1_000, 100_000, 1_000_000])
@pytest.mark.parametrize("dim", [24, 64])
def test_filters_have_the_recall_the_readme_states(dim, rows):
    """Random pairs just at the threshold, with the settings of small and large labels; few unrelated vectors pass a filter."""
    u, v = pairs_at(0.93, 200, dim)
    height, codes = capfilter.settings(dim, rows, 0.93)
    shared, passed = np.zeros(200, bool), 0
    for k in range(capfilter.STRUCTURES):
        rot, books = capfilter.codebooks(dim, capfilter.BLOCKS, codes, capfilter.SEED + k)
        a, b = (capfilter.list_decode(x, rot, books, height) for x in (u, v))
        shared |= [len(np.intersect1d(x, y)) > 0 for x, y in zip(a, b)]
        passed += sum(map(len, a)) / 200
    assert shared.mean() >= 0.97 and passed < 150


@pytest.mark.parametrize("dim", [1, 4, 8, 12, 16, 23, 32])
def test_no_link_is_lost_in_few_dimensions(spark, dim):
    u, v = pairs_at(0.95, 150, dim) if dim > 1 else (np.ones((150, 1)), np.full((150, 1), 3.0))
    x = np.concatenate([u, v])
    got = {r.id: r.n_links for r in capfilter.similar(spark.createDataFrame([(i, r.tolist(), 1) for i, r in enumerate(x)], "vec_id long, embedding array<double>, label int")).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.93).sum(axis=1) - 1
    found = sum(got.values()) / want.sum()
    assert found == 1 if dim < capfilter.EXACT_BELOW else found >= 0.97


def test_list_decoding_is_complete():
    rng = np.random.default_rng(6)
    u = rng.normal(size=(50, 16))
    u /= np.linalg.norm(u, axis=1, keepdims=True)
    rot, books = capfilter.codebooks(16, 2, 10, 3)
    v = u @ rot
    total = (v[:, :8] @ books[0].T)[:, :, None] + (v[:, 8:] @ books[1].T)[:, None, :]
    want = total.reshape(50, -1) >= 2.0 * np.sqrt(2 / 16)
    assert [list(np.flatnonzero(w)) for w in want] == [list(f) for f in capfilter.list_decode(u, rot, books, 2.0)]
