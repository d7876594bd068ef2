"""Spelling variants, hard negatives and line bitmaps against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverline.llm import bit_planes as B, line_bitmaps as L, spelling_chunks as S

# ---------------------------------------------------------------- spelling


def words_brute(rows, least=3):
    n = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 5:
                n[run] += 1
    return {w: c for w, c in n.items() if c >= least}


def is_near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def variants_brute(n):
    out, form = {}, {}
    for w in n:
        near = [x for x in n if x != w and is_near(w, x)]
        best = min(near, key=lambda x: (-n[x], x.encode()), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
        out[w] = [form[w], None, n[w], len(near), n[best] if form[w] else None]
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w][1] = root
    return out


def told(df):
    return {r["word"]: [r["form"], r["root"], r["n"], r["n_near"], r["form_n"]] for r in df.collect()}


def edited(rng, w):
    k, c = rng.randrange(len(w)), rng.choice("abcdeéÿ×")
    return rng.choice([w[:k] + w[k + 1:], w[:k] + c + w[k:], w[:k] + c + w[k + 1:]])


def test_variants_against_brute_force(spark, frame):
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdeé") for _ in range(rng.randrange(5, 13))) for _ in range(25)] + ["aaaaa", "aaaaaa", "ababab", "z" * 70, "z" * 71]
    words = base + [edited(rng, rng.choice(base)) for _ in range(120)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(200))) for i in range(20)]
    rows += [(100, None), (101, ""), (102, "12 -- Āā"), (None, " ".join(base)), (103, "Base BASE bäse " + "x" * 5000), (104, "x" * 5000), (105, "X" * 5000)]
    rows += [rows[0], rows[0], (0, rows[1][1])]         # repeated rows and a shared id
    n = words_brute(rows)
    got = S.word_counts(frame(rows))
    assert {r["word"]: r["n"] for r in got.collect()} == n
    assert told(S.variants(got)) == variants_brute(n)


def test_every_edit_is_found(spark):
    """All one-edit neighbours of words of each length, and their chains."""
    rng = random.Random(8)
    words = {}
    for size in range(1, 15):
        w = "".join(rng.choice("ab") for _ in range(size))
        near = {w[:k] + w[k + 1:] for k in range(size)} | {w[:k] + c + w[k:] for k in range(size + 1) for c in "ab"} | {w[:k] + "c" + w[k + 1:] for k in range(size)}
        for k, x in enumerate(sorted((near | {w}) - {""})):
            words.setdefault(x, 2 ** (k % 9) + k)
    df = spark.createDataFrame(list(words.items()), "word string, n bigint")
    assert told(S.variants(df)) == variants_brute(words)
    assert S.variants(df.limit(0)).count() == 0


def test_altered_runs_are_those_of_crc32(spark, frame):
    """Enough runs that some lose a code point, words shortened below the minimum included."""
    rows = [(i, "hello world straße naïveté " * 3) for i in range(300)]
    n = words_brute(rows)
    assert any(len(w) < 5 or w not in {"hello", "world", "straße", "naïveté"} for w in words_brute(rows, 1))
    assert {r["word"]: r["n"] for r in S.word_counts(frame(rows)).collect()} == n


def test_crc_of_spans():
    data = np.frombuffer("abcdé".encode() * 40, np.uint8)
    start, end = np.array([0, 0, 3, 7, 0]), np.array([0, 1, 9, 7, 200])
    state = np.array([0, 5, 1 << 31, 9, 77], np.uint32)
    want = [zlib.crc32(data[a:b].tobytes(), int(s)) for a, b, s in zip(start, end, state)]
    assert S.crc32_from(state, data, start, end).tolist() == want


def test_plan_has_no_cross_join(spark):
    words = spark.createDataFrame([("abcde", 3)], "word string, n bigint")
    plan = S.near_pairs(words)._jdf.queryExecution().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


# ---------------------------------------------------------------- hard negatives


def test_scores_are_inner_products():
    rng = np.random.default_rng(1)
    for dims, top in ((0, 1), (1, 1), (7, 100), (16, 3), (64, 300), (9, 1 << 20)):
        anchors, rows = rng.integers(-top, top + 1, (5, dims)), rng.integers(-top, top + 1, (40, dims))
        assert (B.scores(B.subset_sums(anchors), B.bit_planes(rows)) == rows @ anchors.T).all()
    assert (B.scores(B.subset_sums(np.array([[3, -2]])), B.bit_planes(np.array([[-1, -1], [0, 0]]))) == [[-1], [0]]).all()


def negatives_brute(rows, every):
    seen, usable = set(), []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        usable.append((i, np.floor(256 * np.array(v, np.float32).astype(np.float64)), (label + 1) % 10 if i % 7 == 0 else label))
    out = set()
    for i, v, label in usable:
        if i % every:
            continue
        same, other = set(), set()
        for j, u, m in usable:
            if i != j:
                d = min(len(u), len(v))
                (same if m == label else other).add((-int(u[:d] @ v[:d]), j))
        for ps, p in sorted(same)[:5]:
            fit = [x for x in sorted(other) if 80 * -ps <= 100 * -x[0] <= 100 * -ps][:5]
            out |= {(i, p, k, x[1], -ps, -x[0]) for k, x in enumerate(fit, 1)}
    return out


SCHEMA = "vec_id bigint, embedding array<float>, label int"


def mined(df, **more):
    rows = [tuple(r) for r in B.hard_negatives(df, **more).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_negatives_against_brute_force(spark):
    rng = np.random.default_rng(4)
    rows = [(i, (rng.normal(size=12) + np.eye(12)[0]).astype(np.float32).tolist(), int(rng.integers(3))) for i in range(300)]
    rows += [(1000 + i, rows[5][1], 0) for i in range(60)]                                    # ties
    rows += [(2000, None, 1), (2010, [1.0, None], 1), (2020, [float("nan")], 1), (2030, [float("inf")], 2), (2040, [1.0], None), (None, [1.0], 1)]
    rows += [(2050, [], 1), (2060, [2.0, 3.0], 0), (2070, [0.5] * 20, 1), (2080, [-0.001] * 12, 1)]
    rows += [rows[10]] * 30 + [rows[20], rows[33]]                                            # repeated rows
    df = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit("x")).withColumn("score", F.lit("y")).repartition(5)
    want = negatives_brute(rows, 10)
    assert len(want) > 300
    assert mined(df, every=10) == want
    assert mined(df.coalesce(1), every=10, cell=7, block=3) == want       # many cells and blocks


def test_best_sees_past_copies():
    score, ids = np.array([9] * 100 + [7, 8, 8, 1]), np.array([4] * 100 + [1, 3, 2, 0])
    best = B._best(score, ids, 3)
    assert [(score[k], ids[k]) for k in best] == [(9, 4), (8, 2), (8, 3)]


def test_negatives_of_empty_and_one_label_tables(spark):
    rows = [(i, [1.0, float(i)], 1) for i in range(1, 30) if i % 7]
    df = spark.createDataFrame(rows, SCHEMA)
    assert mined(df, every=10) == set()
    assert mined(df.limit(0)) == set()


def test_scores_beyond_a_long_are_refused(spark):
    df = spark.createDataFrame([(100, [1e30], 1), (200, [1e30], 1)], SCHEMA)
    with pytest.raises(Exception, match="too large|outgrow"):
        mined(df)


# ---------------------------------------------------------------- lines


def lines_brute(rows):
    key = lambda line: line.strip(" \t\n\v\f\r").translate({c: c + 32 for c in range(65, 91)})
    found = {}
    for i, text in rows:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 40:
                found.setdefault(key(line), set()).add(i)
    out = []
    for i, text in rows:
        lines = (text or "").split("\n")
        gone = [len(key(x)) >= 40 and len(found[key(x)]) >= 5 and i != max((j for j in found[key(x)] if j is not None), default=None) for x in lines]
        kept = "\n".join(x for x, g in zip(lines, gone) if not g)
        out.append((i, len(lines), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def line_rows():
    rng = random.Random(6)
    common = [f"line {k} that stands in many documents of the corpus é" for k in range(12)]
    hot = "this one line is in every third document, whatever else is there"
    rows = []
    for i in range(160):
        lines = [rng.choice(common) if rng.random() < .3 else f"own line {i} {rng.random()} with quite some more text" for _ in range(8)]
        lines += [hot, hot.upper(), f"  {hot}\t\r"] if i % 3 == 0 else ["short", "", "short"]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines)))
    edge = "é" * 39
    rows += [(200 + i, f"{edge}\n{edge}x\nİ{edge}") for i in range(6)]
    rows += [(300, None), (301, ""), (302, "\n"), (303, "\n".join([hot] * 5000)), (None, hot), (None, hot + "\nmore"), (None, None)]
    rows += [(304 + k % 2, f"one line of four documents, two of them by one id{k}\n" + "four documents only hold this line, by two ids" + "." * 9) for k in range(4)]
    rows += [rows[0]] * 40 + [(1, rows[2][1])]
    return rows


@pytest.mark.parametrize("partitions", [1, 3, 64])
def test_lines_against_brute_force(spark, frame, partitions):
    rows = line_rows()
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        docs = frame(rows).repartition(5)
        maps = L.keep_bitmaps(docs)
        got = sorted([tuple(r) for r in L.kept_digests(docs, maps).collect()], key=repr)
        assert got == lines_brute(rows)
        texts = L.kept_texts(docs, maps).collect()
        assert sorted([(r["doc_id"], r["n_lines"], r["n_dropped"], hashlib.sha256(r["text"].encode()).hexdigest()) for r in texts], key=repr) == got
        for r in maps.collect():
            assert (~L.stays(r["keep"], r["n_lines"])).sum() == r["n_dropped"] > 0
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", 8)


def test_lines_of_small_batches(spark, frame):
    """Keys that span Arrow batches."""
    rows = line_rows()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 3)
    try:
        docs = frame(rows)
        assert sorted([tuple(r) for r in L.kept_digests(docs, L.keep_bitmaps(docs)).collect()], key=repr) == lines_brute(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_lines_of_an_empty_table(spark, frame):
    docs = frame([(1, "a")]).limit(0)
    assert L.keep_bitmaps(docs).count() == 0 and L.kept_digests(docs, L.keep_bitmaps(docs)).count() == 0


# ---------------------------------------------------------------- nothing is gathered on the driver


def plans_of(monkeypatch, module):
    """The plans of all that the module stores from here on."""
    plans, store = [], module.stored

    def noted(df, *more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return store(df, *more)
    monkeypatch.setattr(module, "stored", noted)
    return plans


def test_spelling_joins_are_no_broadcasts(spark, monkeypatch):
    plans = plans_of(monkeypatch, S)
    words = S.stored(spark.createDataFrame([("words", 9), ("word", 4), ("sword", 2), ("swords", 1)], "word string, n bigint"), "words")
    out = S.variants(words)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert told(out)["swords"] == ["words", "words", 1, 2, 9]
    assert sum("Join" in p for p in plans) >= 3 and not any("Broadcast" in p for p in plans)


def test_anchors_meet_cells_without_a_broadcast_and_in_shared_lanes(spark, monkeypatch):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8)], int(i % 3)) for i in range(400)]
    rows = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    whole = sorted(map(tuple, B.hard_negatives(rows, every=20).collect()))
    monkeypatch.setattr(B, "LANES", 2, raising=False)
    monkeypatch.setattr(B, "LANE_CELLS", 3, raising=False)
    plans = plans_of(monkeypatch, B)
    out = B.hard_negatives(rows, every=20, cell=16, block=4)
    plans.append(out._jdf.queryExecution().executedPlan().toString())
    assert sorted(map(tuple, out.collect())) == whole and len(whole) > 50
    assert sum("Join" in p for p in plans) >= 2 and not any("Broadcast" in p for p in plans)
