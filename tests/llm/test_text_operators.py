"""Decontamination, quality ledger, toxicity and language against brute force or held-out accuracy."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from silverline.llm import crf_language as C, flat_text as ft, positional_index as P, rule_ledger as R, toxicity_pu as T

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def low(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


# ---------------------------------------------------------------- positional index

def contamination(docs, items, size=10):
    windows = {}
    for item, text in items:
        w = re.findall(WORD, low(text))
        n = min(size, len(w))
        for i in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[i:i + n]), set()).add(item)
    out = []
    for doc, text in docs:
        w, hit, found = re.findall(WORD, low(text)), set(), set()
        for n in {len(k) for k in windows}:
            for i in range(len(w) - n + 1):
                if tuple(w[i:i + n]) in windows:
                    hit.update(range(i, i + n))
                    found |= windows[tuple(w[i:i + n])]
        ids = ",".join(sorted(str(x) for x in found if x is not None))
        out.append((doc, len(w), len(hit), len([x for x in found if x is not None]), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def bench_cases():
    rng = random.Random(4)
    passage = [f"p{k}" for k in range(14)]
    items = [(1, " ".join(passage)), (2, "Short ITEM"), (3, None), (4, "--- !"), (5, " ".join(passage[3:])), (5, "the the the"), (None, "null item words")]
    docs = [(0, None), (1, ""), (2, "x " * 30 + " ".join(passage) + " y" * 5), (3, " ".join(passage[:9])), (4, "short,item short-item"),
            (5, "the the the the"), (5, "the the"), (None, " ".join(passage)), (7, "a null item words b"), (8, "é" + " ".join(passage[2:13]))]
    docs += [(10 + k, " ".join(rng.choice(passage + ["the", "short", "item"]) for _ in range(rng.randrange(40)))) for k in range(30)]
    return docs, items


@pytest.mark.parametrize("block", [200_000, 12])
def test_decontamination_against_brute_force(spark, frame, block):
    docs, items = bench_cases()
    bench = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id bigint, text string, doc_id string")
    got = P.digest(P.decontaminate(frame(docs), bench, block_words=block)).collect()
    assert sorted((tuple(r) for r in got), key=str) == contamination(docs, items)


def test_decontamination_of_empty_tables(spark, frame):
    bench = spark.createDataFrame([(1, "a b c")], "item_id bigint, text string")
    assert P.decontaminate(frame([(1, "a b c")]).limit(0), bench).collect() == []
    rows = P.digest(P.decontaminate(frame([(1, "a b c")]), bench.limit(0))).collect()
    assert [(r["n_words"], r["n_hit"], r["contaminated"]) for r in rows] == [(3, 0, False)]


def test_full_index_and_proximity(spark, frame):
    docs = frame([(1, "alpha x x beta"), (2, "alpha x x x x x beta"), (3, "beta alpha"), (4, "alpha"), (5, "beta")])
    index = P.build_index(docs)
    near = P.search(index, P.windows_of([(9, "alpha beta")]), slack=3).collect()
    assert sorted(r["doc_id"] for r in near if r["item_ids"]) == [1, 3]
    exact = P.search(index, P.windows_of([(9, "beta alpha")])).collect()
    assert [(r["doc_id"], r["spans"][0]["lo"], r["spans"][0]["hi"]) for r in exact if r["spans"]] == [(3, 0, 2)]


# ---------------------------------------------------------------- ledger

def measures(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    grams = [tuple(w[i:i + 8]) for i in range(len(w) - 7)]
    cover = {p for i, g in enumerate(grams) if grams.count(g) > 1 for p in range(i, i + 8)}
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(cover), "n_lines": len(lines),
            "n_caps": len(re.findall("[A-Z]", text)), "n_letters": len(re.findall(r"[A-Za-z]|[^\x00-\x7F]", text))}


LEDGER_TEXTS = [None, "", " \n\t", "a", "one\ntwo\none\n\n \none", "日本 é # $\n" * 3, "a b c d e f g h " * 4, "x " * 50, "SHOUT LOUD " * 15,
                "w1 w2 w3 w4 w5 w6 w7 w8 z w1 w2 w3 w4 w5 w6 w7 w8", "line\rstill\nline\rstill", "| a " * 40, "word " * 3000]


def test_measurements_against_brute_force(spark, frame):
    rng = random.Random(2)
    texts = LEDGER_TEXTS + ["".join(rng.choice("ab \n#A") for _ in range(rng.randrange(120))) for _ in range(60)]
    got = {r["doc_id"]: r for r in R.ledger(frame(list(enumerate(texts)))).collect()}
    for i, t in enumerate(texts):
        want = measures(t)
        assert {k: got[i][k] for k in want} == want, repr(t)[:60]


def test_policies_and_ablation(spark, frame):
    entries = R.ledger(frame(list(enumerate(LEDGER_TEXTS)) + [(99, " ".join(f"word{k}" for k in range(40)))]))
    rows = R.apply_policy(R.apply_policy(entries, "base", "b"), "v1").collect()
    mask = R.policy_mask("v1")
    assert all(r["kept"] == (r["failures"] & mask == 0) and (r["b"] or not r["kept"]) for r in rows)
    assert any(r["kept"] for r in rows)
    table = {r["rule"]: r for r in R.ablation(entries, "v1").collect()}
    for rule in R.RULES:
        bit = 1 << rule.bit
        fails = [r["failures"] & mask for r in rows]
        assert table[rule.name]["rejected"] == sum(bool(f & bit) for f in fails)
        assert table[rule.name]["rejected_alone"] == sum(f == bit for f in fails)
        assert table[rule.name]["kept_without"] == sum(f & ~bit == 0 for f in fails)


def test_empty_ledger(spark, frame):
    assert R.ledger(frame([(1, "a")]).limit(0)).collect() == []


# ---------------------------------------------------------------- toxicity

def toxic_corpus(n=600):
    rng = random.Random(8)
    bad = ["grotnak", "vilespit", "hurlscum"]
    rows, labels = [], []
    for i in range(n):
        w = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(20, 80))]
        toxic = i % 6 == 0
        if toxic:
            for _ in range(3):
                w.insert(rng.randrange(len(w)), rng.choice(bad))
        rows.append((i, " ".join(w)))
        if i % 2 == 0:
            labels.append((i, int(toxic)))
    return rows, labels


def test_pu_learning_finds_hidden_positives(spark, frame):
    from pyspark.sql import functions as F
    from silverline.llm.frames import held_out

    rows, labels = toxic_corpus()
    table = spark.createDataFrame(labels + [(None, 1), (5, None)], "doc_id bigint, toxic int")
    docs = frame(rows + [(None, None), (9_000, ""), (9_001, "w1 " * 9000)])
    model = T.train(docs, table, ~held_out(F.col("doc_id"), 4, 2))
    got = {r["doc_id"]: r["score"] for r in T.score(docs, model).collect()}
    assert all(0 <= s <= 1 for s in got.values()) and len(got) == len(rows) + 3
    wrong = sum((got[i] >= T.THRESHOLD) != (i % 6 == 0) for i, _ in rows)
    assert wrong <= 6
    assert got[9_000] == got[None] < T.THRESHOLD
    kept = T.not_toxic(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(s < T.THRESHOLD for s in got.values())


def test_non_negative_risk_keeps_the_corrected_part_up():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 400))           # more inputs than rows: an unchecked risk would dive
    positive = np.arange(300) < 60
    w, b = T.fit_nnpu(x, positive, 0.3, steps=300, l2=0.0)
    g = 1 / (1 + np.exp(-(x @ w + b)))
    negative = -np.log(np.maximum(1 - g[~positive], 1e-12)).mean() + 0.3 * np.log(np.maximum(1 - g[positive], 1e-12)).mean()
    assert negative > -0.5


def test_toxicity_without_labels(spark, frame):
    none = spark.createDataFrame([(1, 0)], "doc_id bigint, toxic int")
    from pyspark.sql import functions as F
    model = T.train(frame([(1, "a b")]), none, F.lit(True))
    assert [r["score"] for r in T.score(frame([(1, "a b"), (2, None)]), model).collect()] == [0.0, 0.0]
    assert T.score(frame([(1, "a")]).limit(0), model).collect() == []


# ---------------------------------------------------------------- language

def test_forward_backward_is_exact_across_segments():
    rng = np.random.default_rng(0)
    per = [0, 1, 5, 32, 33, 64, 100, 2, 97]
    first = np.concatenate([[0], np.cumsum(per)])
    scores, trans = rng.normal(size=(first[-1], 3)) * 2, rng.normal(size=(3, 3))
    got = C.posteriors(scores, first, trans)
    a = np.exp(trans)
    for d, n in enumerate(per):
        if not n:
            continue
        e = np.exp(scores[first[d]:first[d + 1]])
        alpha, beta = [(np.ones(3) @ a) * e[0]], [np.ones(3)]
        for t in range(1, n):
            alpha.append((alpha[-1] @ a) * e[t])
            alpha[-1] /= alpha[-1].sum()
        for t in range(n - 1, 0, -1):
            beta.append(a @ (e[t] * beta[-1]))
            beta[-1] /= beta[-1].sum()
        p = np.array(alpha) * np.array(beta[::-1])
        assert np.allclose(p / p.sum(axis=1, keepdims=True), got[first[d]:first[d + 1]])


LEXICON = {"aa": ["strag", "blonk", "witch", "thump", "grown"], "bb": ["liora", "melia", "sonea", "taria", "voila"]}


def test_language_of_held_out_and_switched_text(spark, frame):
    from pyspark.sql import functions as F

    rng = random.Random(3)

    def text(lang, n):
        return " ".join(rng.choice(LEXICON[lang]) + rng.choice(["", "s", "n"]) for _ in range(n))

    rows = [(i, text(lang, 30), lang) for i, lang in enumerate(["aa", "bb"] * 40)]
    model = C.train(frame(rows + [(900, "blonk", None), (901, None, "aa")]), F.col("doc_id") < 60)
    docs = frame(rows + [(100, None), (101, ""), (102, "12 34 !"), (103, "、。 😀"), (104, "ж"), (None, text("aa", 5)), (105, text("bb", 6000))])
    got = {r["doc_id"]: r for r in C.label(docs, model).collect()}
    assert all(got[i]["lang_pred"] == lang and got[i]["score"] > 0.8 for i, _, lang in rows)
    assert [got[i]["lang_pred"] for i in (100, 101, 102, 103)] == ["und"] * 4 and got[104]["lang_pred"] in LEXICON
    assert got[None]["lang_pred"] == "aa" and got[105]["lang_pred"] == "bb"
    # words of a switched text get their own labels
    data, offsets = ft.flatten(pa.array([text("aa", 20) + " " + text("bb", 20)]))
    w = ft.words_of(data, offsets, ft.LETTERS_LOWER)
    best = C.posteriors(model.word_scores(w), w.first, model.trans).argmax(axis=1)
    assert (best[:20] == 0).mean() > 0.9 and (best[20:] == 1).mean() > 0.9
    kept = C.identified(docs, model, 0.5)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.select("doc_id").collect()}.isdisjoint({100, 101, 102, 103})


def test_clean_text_of_three_languages_stays(spark, frame):
    from pyspark.sql import functions as F

    rng = random.Random(4)
    lexicon = {"aa": ["blonk", "trazu", "mivvo"], "bb": ["sheque", "dorphy", "lunth"], "cc": ["gjikra", "wexxa", "pazzo"]}
    run = {lang: lambda n, words=words: " ".join(rng.choice(words) for _ in range(n)) for lang, words in lexicon.items()}
    model = C.train(frame([(i, run[lang](30), lang) for i, lang in enumerate(list(lexicon) * 30)]), F.lit(True))
    mixed = " ".join([run["aa"](40), run["bb"](35), run["cc"](25)])
    docs = frame([(1, mixed), (2, "12 34"), (3, None), (4, run["bb"](20))])
    score = {r["doc_id"]: r["score"] for r in C.label(docs, model).collect()}
    assert 0.3 < score[1] < 0.5
    assert {r["doc_id"] for r in C.identified(docs, model, 0.5).collect()} == {1, 4}


def test_language_without_training_rows(spark, frame):
    from pyspark.sql import functions as F
    model = C.train(frame([(1, "a", None)]), F.lit(True))
    assert [tuple(r) for r in C.label(frame([(1, "abc")]), model).collect()] == [(1, "und", 0.0)]


def test_language_sample_holds_every_language_when_an_id_repeats(spark, frame):
    """2,000 texts of one doc_id do not crowd out the other language; repeated rows count once."""
    import random

    from pyspark.sql import functions as F

    rng = random.Random(3)
    word = {"aa": lambda: "".join(rng.choice("aeiou") for _ in range(5)), "bb": lambda: "".join(rng.choice("bcdfg") for _ in range(5))}
    text = lambda lang: " ".join(word[lang]() for _ in range(12))
    rows = [(3139, text("aa"), "aa") for _ in range(2000)] + [(i, text("bb"), "bb") for i in range(5000, 5200)]
    rows += [rows[0]] * 50
    docs = frame(rows)
    model = C.train(docs, F.lit(True))
    assert model.languages == ["aa", "bb"]
    got = C.label(docs, model).groupBy("doc_id", "lang_pred").count().collect()
    assert {r["lang_pred"] for r in got if r["doc_id"] == 3139} == {"aa"}
    assert {r["lang_pred"] for r in got if r["doc_id"] >= 5000} == {"bb"}


def test_toxicity_rows_that_repeat(spark, frame):
    """Repeated rows and ids are scored each, and alike."""
    from pyspark.sql import functions as F

    rows = [(i, ("vile " if i % 3 == 0 else "kind ") * 3 + f"text number {i}") for i in range(60)]
    labels = spark.createDataFrame([(i, 0, int(i % 3 == 0)) for i in range(60)], "doc_id bigint, quality int, toxic int")
    docs = frame(rows + [rows[0]] * 5 + [(0, rows[1][1])])
    model = T.train(docs, labels, F.lit(True))
    got = T.score(docs, model).where("doc_id = 0").collect()
    assert len(got) == 7 and len({r["score"] for r in got}) <= 2
