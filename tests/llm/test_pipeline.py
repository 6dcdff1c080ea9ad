"""The pipeline's stages against plain code, and what its rows must satisfy."""

from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from hackney.llm import packing, quality, toxicity
from tests.llm.conftest import CLASHING, rows
from tests.llm.test_decontaminate import brute as hits_by_hand
from tests.llm.test_near_dup import brute as classes_by_hand

DATA = "/root/testdata/sf0.01"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What each stage kept, written and read again as the next one's documents."""
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    kept = [("documents", docs)]
    for name, function in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("pipeline") / name)
        function(spark, docs, DATA).write.parquet(path)
        docs = spark.read.parquet(path)
        kept.append((name, docs))
    return dict(kept)


def test_stages_are_named_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality", "toxicity", "near_duplicates", "decontamination", "packing"
    ]
    assert corpus_pipeline.ORACLE_SQL is None


def test_documents_keep_their_columns(stages):
    names = list(stages)
    for before, after in zip(names[:-2], names[1:-1], strict=True):
        assert stages[after].columns == stages["documents"].columns
        assert stages[after].exceptAll(stages[before]).count() == 0


@pytest.mark.parametrize(
    "before, after, module, label",
    [("documents", "quality", quality, "quality"), ("quality", "toxicity", toxicity, "toxic")],
)
def test_classifiers_decide(spark, stages, before, after, module, label):
    """A stage keeps what its classifier, fitted to its own input, does not reject."""
    docs = stages[before]
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    predicted = {r.doc_id: r.predicted for r in module.classify(docs, labels).collect()}
    kept = {r.doc_id for r in stages[after].select("doc_id").collect()}
    good = 1 if label == "quality" else 0
    assert kept == {i for i, p in predicted.items() if p == good}
    marked = {r.doc_id: r[label] for r in labels.collect()}
    clean = [i for i in predicted if marked.get(i) == good]
    assert sum(i in kept for i in clean) >= 0.99 * len(clean)


def test_one_document_of_each_class_stays(stages):
    docs = [tuple(r) for r in stages["toxicity"].select("doc_id", "text").collect()]
    want = sorted({c for _, c in classes_by_hand(docs)})
    assert [i for (i,) in rows(stages["near_duplicates"], "doc_id")] == want


def test_contaminated_documents_go(spark, stages):
    docs = [tuple(r) for r in stages["near_duplicates"].select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{DATA}/benchmark.parquet").collect()]
    # Only documents that hold an item's first or last words can be contaminated by long windows.
    marks = [w for _, t in items for w in t.split() if len(w) > 9]
    some = [(i, t) for i, t in docs if any(m in t for m in marks)]
    bad = {r[0] for r in hits_by_hand(some[:120], items) if r[-1]}
    kept = {i for (i,) in rows(stages["decontamination"], "doc_id")}
    assert not bad & kept
    assert {i for i, _ in some[:120]} - bad <= kept
    assert kept < {i for i, _ in docs}


def test_pieces_hold_what_is_left(spark, stages):
    library = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    lengths = {
        r.doc_id: len(library.encode(r.text, add_special_tokens=False).ids) + 1
        for r in stages["decontamination"].collect()
    }
    got = {}
    for r in stages["packing"].collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + r.length
    assert got == lengths


def test_run_gives_the_last_stages_rows(spark, stages):
    columns = ["doc_id", "doc_tokens"]
    found = corpus_pipeline.run(spark, DATA).groupBy(*columns).agg(F.sum("length"))
    assert rows(found) == rows(stages["packing"].groupBy(*columns).agg(F.sum("length")))


@pytest.fixture
def odd(make_docs):
    good = "The committee read the report and thanked its authors for their careful work"
    docs = make_docs(
        (1, None), (2, ""), (None, good), (3, good), (3, good), (4, good + " indeed"), (5, "w " * 30_000)
    )
    return docs.withColumns({c: F.lit("x") for c in [*CLASHING, "component", "candidates"]})


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_take_odd_rows(spark, odd, name):
    found = STAGES[name](spark, odd, DATA)
    found.collect()
    if name != "packing":
        assert found.columns == odd.columns
        assert found.exceptAll(odd).count() == 0
    if name == "near_duplicates":
        assert rows(found, "doc_id") == [(None,), (1,), (2,), (3,), (5,)]
    if name == "packing":
        assert found.groupBy("doc_id").agg(F.sum("length")).count() == 6


@pytest.mark.parametrize("name", list(STAGES))
def test_stages_take_empty_tables(spark, odd, name):
    assert STAGES[name](spark, odd.limit(0), DATA).count() == 0


def test_without_labels_nothing_is_rejected(spark, make_docs, tmp_path):
    docs = make_docs((1, "BUY!! NOW!!"), (2, "some text"))
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    for name in ("quality", "toxicity"):
        assert STAGES[name](spark, docs, str(tmp_path)).count() == 2


def test_examples_are_bounded(spark):
    """The classifiers' samples follow their documented bound, and both classes are in them."""
    from hackney.llm.labelled import labelled_sample

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    labels = spark.read.parquet(f"{DATA}/labels.parquet")
    sample = labelled_sample(docs, labels, "quality", 4, 2, 40).collect()
    assert np.bincount([r.label for r in sample]).tolist() == [20, 20]
