import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from caseflow.operators import features as fx
from caseflow.operators import grams, models, solver

SPECS = [fx.TermSpec("word", 1, 3, fx.WORD_MONEY_MARKS, (), True, 2, 40), fx.TermSpec("char", 3, 5, fx.WORD, (), True, 3, 60)]


@pytest.fixture(scope="module")
def docs(spark):
    """Ids that repeat or are null, texts that are null, empty, or a character that is no letter of the plane of most."""
    draw = random.Random(3)
    words = ["late", "parcel", "a", "$5", "!!", "ärger", "kettle", "𝒳y", "refund"]
    texts = [" ".join(draw.choices(words, range(9, 0, -1), k=draw.randrange(12))) for _ in range(80)]
    rows = [(None if i % 19 == 0 else i - (i % 13 == 0), None if i % 23 == 0 else x, f"l{i % 3}") for i, x in enumerate(texts)]
    return spark.createDataFrame(rows, "id long, text string, label string").persist()


def test_arrays_count_what_rows_of_terms_count(docs, monkeypatch):
    monkeypatch.setattr(fx, "TASK_CHARACTERS", 500)
    n_docs = fx.count_docs(docs)
    vocabs = grams.vocabularies(grams.placed(docs, "id", "text", SPECS), n_docs, SPECS)
    found = grams.vectors(docs, "id", "text", vocabs, SPECS, [("i0", "v0"), ("i1", "v1")]).persist()
    digits = lambda v: F.transform(v, lambda x: F.round(x, 12))
    for n, (spec, vocab) in enumerate(zip(SPECS, vocabs)):
        counts, old = fx.fit_terms(docs, "id", "text", spec)
        assert sorted(vocab.collect()) == sorted(old.collect()) and vocab.count() == spec.max_features
        want = docs.join(fx.weights(counts, old, "id", spec), "id", "left").select("id", "label", "idx", digits("val").alias("val"))
        got = found.select("id", "label", F.col(f"i{n}").alias("idx"), digits(f"v{n}").alias("val"))
        assert want.exceptAll(got).isEmpty() and got.exceptAll(want).isEmpty() and got.count() == 80


def test_slices_hold_whole_documents(monkeypatch):
    monkeypatch.setattr(grams, "SLICE", 10)
    ids, texts = [None, None, 1, 1, 1, 2, 3, 3], ["abcdef", "gh", None, "ij kl", "mn", "op", "qrstuvwxyz", "a"]
    batches = [pa.record_batch([pa.array(ids[i : i + 3], pa.int64()), pa.array(texts[i : i + 3], pa.string())], ["_id", "_s0"]) for i in (0, 3, 6)]
    found = [(table.column("_id").to_pylist(), doc.tolist()) for table, doc in grams._slices(iter(batches), 1)]
    assert sum((x for x, _ in found), []) == ids and len(found) == 2
    assert [d for _, d in found] == [[0, 0, 1, 1, 1], [0, 1, 1]]


def test_terms_without_a_text(spark, docs):
    none = docs.where("false")
    vocabs = fx.fit_vocabularies(none, "id", "text", SPECS)
    assert [v.count() for v in vocabs] == [0, 0]
    told = grams.vectors(docs, "id", "text", vocabs, SPECS, [("i0", "v0"), ("i1", "v1")])
    assert told.where("i0 is null and i1 is null").count() == 80


def test_fits_begin_at_their_optima(docs, monkeypatch):
    """Spark's solver has nothing left to do: it took a job a step and some hundred steps for each fold."""
    steps, ended = [], models._converged
    monkeypatch.setattr(models, "_converged", lambda model, most: steps.append(model.summary.totalIterations) or ended(model, most))
    known = docs.where("id is not null").dropDuplicates(["id"])
    model = models.IntentClassifier(folds=2).fit(known, "id", "text", "label")
    assert steps == [0, 0]
    proof = models.IntentClassifier(folds=2).certificate(model, known, "id", "text", "label").collect()
    assert all(r.largest_gradient < 1e-5 for r in proof)


def test_passes_sum_all_packed_rows():
    rng = np.random.default_rng(1)
    n, k, folds, sizes = 700, 3, 2, [30, 50]
    parts, whole, shift = [], np.zeros((n, sum(sizes))), 0
    idf = rng.random(sum(sizes)) + 1
    for size in sizes:
        tf = rng.integers(0, 300, (n, size)) * (rng.random((n, size)) < 0.2)
        weight = np.where(tf > 0, 1 + np.log(np.maximum(tf, 1)), 0) * idf[shift : shift + size]
        length = np.sqrt((weight**2).sum(axis=1))
        whole[:, shift : shift + size] = weight / np.maximum(length, 1e-9)[:, None]
        row, place = np.nonzero(tf)
        parts.append((np.searchsorted(row, np.arange(n + 1)), place, tf[row, place], length))
        shift += size
    y, fold = rng.integers(0, k, n), rng.integers(0, folds, n)
    raws = list(solver.pack(y, fold, parts, [0, sizes[0]]))
    assert len(raws) == 3
    matrix, weight = rng.normal(size=(80, 2 * k)), rng.random((2, folds, k))
    loss, top, low = solver.Pass(matrix, np.zeros((2, k)), weight, idf, [True, True]).sums(raws)
    for f in range(2):
        margin = whole @ matrix[:, f * k : (f + 1) * k]
        chance = np.exp(margin) / np.exp(margin).sum(axis=1, keepdims=True)
        own = weight[f, fold, y]
        off = (chance - np.eye(k)[y]) * own[:, None]
        assert np.isclose(loss[f], -(own * np.log(chance[np.arange(n), y])).sum())
        assert np.allclose(top[f], off.sum(axis=0)) and np.allclose(low[:, f * k : (f + 1) * k], whole.T @ off)
