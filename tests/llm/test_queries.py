"""The registered training-data queries and the pipeline on the driver tables."""

import hashlib
import subprocess
import sys
import zlib

import pytest

import __spark_entry__ as E
from tests.conftest import ROOT, SF_SMALL
from tests.test_contract import _rows

corpus_pipeline = pytest.importorskip("corpus_pipeline")


def test_one_query_per_operator():
    numbers = sorted(int(k[2:].split("_")[0]) for k in E.LLM_QUERIES if k.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in E.LLM_QUERIES


@pytest.mark.parametrize("key", sorted(E.LLM_ORACLES))
def test_query_matches_oracle(spark, duck, key):
    got, want = E.LLM_QUERIES[key](spark, SF_SMALL), duck.sql(E.LLM_ORACLES[key])
    rows = [tuple(r) for r in got.collect()]
    assert sorted(got.columns) == sorted(want.columns)
    assert _rows(rows, got.columns) == _rows(want.fetchall(), want.columns)


@pytest.mark.parametrize("key", sorted(set(E.LLM_QUERIES) - set(E.LLM_ORACLES) - {"pipeline"}))
def test_query_covers_its_table(spark, key):
    df = E.LLM_QUERIES[key](spark, SF_SMALL)
    if "conv_id" in df.columns:
        table, extra = spark.read.parquet(f"{SF_SMALL}/conversations.parquet").select("conv_id").distinct(), 1
        assert sorted(r[0] for r in df.select("conv_id").collect()) == sorted([r[0] for r in table.collect()] + [-1])
    else:
        table, extra = spark.read.parquet(f"{SF_SMALL}/documents.parquet"), 0
        assert sorted(r[0] for r in df.select("doc_id").collect()) == sorted(r[0] for r in table.select("doc_id").collect())
    assert df.count() == table.count() + extra


def test_folds_follow_crc32(spark):
    from pyspark.sql import functions as F
    from silverline.llm.frames import held_out

    got = spark.range(200).select("id", held_out(F.col("id"), 7, 2).alias("out")).collect()
    assert all(r["out"] == (zlib.crc32(str(r["id"]).encode()) % 7 == 2) for r in got)


def test_pipeline_stages_against_brute_force(spark, frame, monkeypatch):
    """Near-duplicates, decontamination and encoding by brute force; the two
    learned stages drop what their models reject and nothing else."""
    from silverline.llm import piece_bpe
    from tests.llm.test_near_duplicates import brute
    from tests.llm.test_text_operators import contamination

    bench = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").collect()]
    base = [r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").orderBy("doc_id").limit(40).collect()]
    rows = list(enumerate(base)) + [(100 + i, t) for i, t in enumerate(base[:6])] + [(200, None), (201, ""), (202, "prose " + bench[0][1])]
    rows += [(None, base[0]), (203, "1 2 3")]
    docs = frame(rows)
    stages = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "language", "near_duplicates", "decontaminate", "encode"]

    for name in ("toxicity", "language"):
        out = stages[name](spark, docs, SF_SMALL)
        assert out.columns == corpus_pipeline.COLUMNS
        assert {r["doc_id"] for r in out.collect()} <= {i for i, _ in rows}
    languages = {r["doc_id"] for r in stages["language"](spark, docs, SF_SMALL).collect()}
    assert languages.isdisjoint({200, 201, 203})

    label = brute([r for r in rows if r[0] is not None])
    kept = sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in stages["near_duplicates"](spark, docs, SF_SMALL).collect())
    assert kept == sorted([(False, i) for i, c in label.items() if i == c] + [(True, 0)])

    hit = {r[0] for r in contamination([r for r in rows if r[0] is not None], bench) if r[5]}
    clean = {r["doc_id"] for r in stages["decontaminate"](spark, docs, SF_SMALL).collect()}
    assert 202 in hit and clean - {None} == {i for i, _ in rows if i is not None} - hit

    library = pytest.importorskip("sentencepiece").SentencePieceProcessor(model_file=piece_bpe.model_path())
    for r in stages["encode"](spark, docs, SF_SMALL).where("doc_id IS NOT NULL").collect():
        ids = library.encode(dict(rows)[r["doc_id"]] or "")
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_near_duplicate_rows_that_share_an_id(spark, frame):
    """Each (id, text) is decided on its own: no clean text goes, no copy stays."""
    t1 = "a text of quite some words that stands in two rows of the table and is long enough"
    t2 = "nothing like the other one at all here are other words altogether about the sea and the ships"
    rows = [(3, t1), (5, t2), (5, t1), (5, t2), (None, t1), (None, t1), (None, t2), (None, None), (None, None), (9, None), (8, "")]
    near = dict(corpus_pipeline.STAGES)["near_duplicates"]
    for order in (rows, rows[::-1]):
        got = sorted([(r["doc_id"], r["text"]) for r in near(spark, frame(order), SF_SMALL).collect()], key=repr)
        assert got == sorted([(3, t1), (5, t2), (None, t1), (None, t2), (None, None), (9, None), (8, "")], key=repr)


def test_pipeline_of_an_empty_table(spark, frame):
    docs = frame([(1, "a")]).limit(0)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF_SMALL)
        assert out.count() == 0
        assert name == "encode" or out.columns == corpus_pipeline.COLUMNS


def test_rest_imports_without_the_subpackage(tmp_path):
    code = ("import sys, importlib.abc\n"
            "class Gone(importlib.abc.MetaPathFinder):\n"
            "    def find_spec(self, name, path=None, target=None):\n"
            "        if name.startswith('silverline.llm') or name == 'corpus_pipeline':\n"
            "            raise ModuleNotFoundError(name)\n"
            f"sys.path.insert(0, {ROOT!r})\n"
            "import importlib.util\n"
            "real = importlib.util.find_spec\n"
            "importlib.util.find_spec = lambda n, p=None: None if n.startswith('silverline.llm') or n == 'corpus_pipeline' else real(n, p)\n"
            "sys.meta_path.insert(0, Gone())\n"
            "import __spark_entry__ as E\n"
            "assert not any(k.startswith('op1_') or k == 'pipeline' for k in E.queries()) and len(E.queries()) > 100\n")
    subprocess.run([sys.executable, "-c", code], check=True, cwd=tmp_path)
