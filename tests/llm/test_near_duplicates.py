import random

import numpy as np
import pyarrow as pa
import pytest

from silverline.llm import flat_text as ft, superminhash as S
from silverline.llm.components import components


def sets_of(texts):
    out = []
    for t in texts:
        w = (t or "").encode().lower().split()
        out.append({tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    return out


def brute(rows):
    sets = {}
    for (i, _), s in zip(rows, sets_of([t for _, t in rows])):
        sets.setdefault(i, []).append(s)
    ids, label = sorted(sets), {}
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a in ids:
        for b in ids:
            if a < b and any(x and y and 100 * len(x & y) >= 75 * len(x | y) for x in sets[a] for y in sets[b]):
                r, s = find(a), find(b)
                parent[max(r, s)] = min(r, s)
    for i in ids:
        label[i] = find(i)
    return label


def near_copies(rng, n, words=60, edits=3):
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(words)] = f"e{rng.randrange(10_000)}"
        yield " ".join(w)


def test_components_against_brute_force(spark, frame):
    rng = random.Random(5)
    texts = [t for g in range(6) for t in near_copies(rng, 12, edits=6)]
    texts += [None, "", " \n", "one two", "ONE two", "one two three", "a b c d e", "A b c d e", "x " * 3000, "x " * 3001]
    rows = list(enumerate(texts)) + [(len(texts) + k, texts[0]) for k in range(5)]
    got = {r["doc_id"]: r for r in S.near_duplicates(frame(rows)).collect()}
    want = brute(rows)
    sizes = dict(zip((i for i, _ in rows), map(len, sets_of([t for _, t in rows]))))
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["n_shingles"] for i, r in got.items()} == sizes
    assert all(r["kept"] == (i == want[i]) for i, r in got.items())


def test_hot_group_goes_through_heads(spark, frame, monkeypatch):
    monkeypatch.setattr(S, "PAIRS_PER_MEMBER", 0)
    rng = random.Random(9)
    rows = list(enumerate(near_copies(rng, 60, edits=9)))
    got = {r["doc_id"]: r["component_id"] for r in S.near_duplicates(frame(rows)).collect()}
    assert got == brute(rows)


def test_rest_of_a_large_group_is_not_compared_by_all_pairs(spark, frame, monkeypatch):
    left, across = [], S._across

    def counted(rest):
        pairs = across(rest)
        left.append(pairs.count())
        return pairs
    monkeypatch.setattr(S, "_across", counted)
    rng = random.Random(4)
    rows = [(i * 7919 % 400, t) for i, t in enumerate(near_copies(rng, 400, words=200, edits=8))]
    got = {r["doc_id"]: r["component_id"] for r in S.near_duplicates(frame(rows)).collect()}
    assert got == brute(rows)
    assert sum(left) < 3 * len(rows)


def test_repeated_and_null_ids_and_empty_table(spark, frame):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "a b c d e f"), (None, "a b c d e f")]
    got = S.near_duplicates(frame(rows)).collect()
    assert sorted((r["doc_id"] or 0, r["component_id"] or 0, r["kept"]) for r in got) == [(0, 0, True), (1, 1, True), (1, 1, True), (2, 1, False)]
    assert S.near_duplicates(frame([(1, "x")]).limit(0)).collect() == []


def test_estimate_has_lower_variance_than_independent_hashes():
    rng = np.random.default_rng(3)
    errors = []
    for _ in range(200):
        x = rng.integers(0, 1 << 62, 60, dtype=np.int64).astype(np.uint64)
        a, b = np.sort(x[:50]), np.sort(x[10:])          # similarity 40 / 60
        held = S.superminhash(np.repeat([0, 1], 50), np.concatenate([a, b]), 2)
        errors.append((held[0] == held[1]).mean() - 40 / 60)
    assert abs(np.mean(errors)) < 0.02
    assert np.var(errors) < 0.9 * (2 / 3) * (1 / 3) / S.M


def test_signature_does_not_depend_on_chunks(monkeypatch):
    rng = np.random.default_rng(1)
    doc = np.repeat(np.arange(4), [3, 0, 900, 40])
    x = rng.integers(0, 1 << 62, len(doc), dtype=np.int64).astype(np.uint64)
    whole = S.superminhash(doc, x, 4)
    monkeypatch.setattr(S, "CHUNK", 64)
    assert (S.superminhash(doc, x, 4) == whole).all()
    assert (whole[1] == np.uint64(0xFFFFFFFFFFFFFFFF)).all()


def test_odd_sketch_never_exceeds_the_difference():
    rng = np.random.default_rng(2)
    for n in (5, 100, 3000):
        x = rng.integers(0, 1 << 62, n + n // 3, dtype=np.int64).astype(np.uint64)
        p = S.parities(np.repeat([0, 1], n), np.concatenate([x[:n], x[-n:]]), 2).view(np.uint64)
        assert sum(int(v).bit_count() for v in p[0] ^ p[1]) <= 2 * (n // 3)


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(200, 200), (301, 300)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "u bigint, v bigint").repartition(7)).collect()}
    assert {got[i] for i in range(1, 41)} == {0} and {got[100 + k] for k in range(1, 30)} == {100} and got[301] == 300


@pytest.mark.parametrize("text", [None, "", "one", "one two three four five"])
def test_shingles_of_short_texts(text):
    doc, x = S.shingles(*ft.flatten(pa.array([text], pa.string())))
    assert len(x) == len(sets_of([text])[0])
