import base64
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from caseflow.llm import mixing, neighbours, packing
from caseflow.llm.queries import ORACLES, QUERIES, VOCABULARY
from tests.llm.test_text_operators import near_by_brute_force, words
from tools.check_oracles import connect, differences

TABLES = ("documents", "benchmark", "embeddings", "labels")


@pytest.mark.parametrize("name", list(ORACLES))
def test_queries_equal_sql(spark, sf_dir, name):
    assert differences(QUERIES[name](spark, sf_dir).toPandas(), connect(sf_dir).execute(ORACLES[name]).df()) is None


def test_mixing_keeps_its_bounds(spark, edge):
    docs = [(k, "w " * (k % 7 + 1), s) for k in range(300) for s in [("a", "b", "c", None)[k % 4 if k < 80 else 0]]]
    found = mixing.report(spark.createDataFrame(docs, "doc_id long, text string, source string"), block=4, shard_words=100).toPandas()
    assert (found.taken <= 3 * found["size"]).all() and found.target.groupby(found.target).size().sum() == 300
    by_source = found.assign(source=["x" if s is None else s for s in [dict((d, s) for d, _, s in docs)[d] for d in found.doc_id]]).groupby("source")
    taken, target, size = by_source.taken.sum(), by_source.target.first(), by_source["size"].sum()
    assert (abs(taken - target) <= 8).all() and abs(target.sum() - size.sum()) < 1e-6 and (target <= 3 * size + 1e-9).all()
    edge_found = mixing.report(edge)
    assert edge_found.count() == edge.count() and edge_found.where("size = 0 AND taken <> 0").count() == 0
    assert mixing.mix(edge).columns == edge.columns and mixing.report(edge.limit(0)).count() == 0


def test_mixed_texts_hold_the_taken_words(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = {r["doc_id"]: r["taken"] for r in mixing.report(docs).collect()}
    given = Counter()
    for r in mixing.mix(docs).collect():
        given[r["doc_id"]] += len(r["text"].split())
        assert r["n_chars"] == len(r["text"])
    assert all(given[k] == n for k, n in plan.items())


def test_apportionment_by_highest_quotients(spark):
    draw = np.random.default_rng(4)
    for n, seats in ((1, 5), (6, 3), (7, 100), (9, 41)):
        weights = [float(x) for x in draw.integers(0, 50, n)]
        frame = spark.createDataFrame([(0, k, w, seats) for k, w in enumerate(weights)], "g int, k int, w double, s long")
        got = {r["k"]: r["q"] for r in mixing.apportion(frame, ["g"], ["k"], "w", "s", "q").collect()}
        expected = [0] * n
        for _ in range(seats if sum(weights) else 0):
            best = max(range(n), key=lambda k: (weights[k] / (2 * expected[k] + 1), -k))
            expected[best] += 1
        assert [got[k] for k in range(n)] == expected


def test_packed_rows_read_back(spark, edge):
    ranks = packing.read_ranks(spark, VOCABULARY)
    texts = [(k, "Überall café " * k) for k in range(40)] + [(50, None), (51, ""), (None, "no id"), (7, "again")]
    packed = packing.pack(spark.createDataFrame(texts, "doc_id long, text string"), VOCABULARY, length=32, group_tokens=500).collect()
    table = {v: k for k, v in ranks.items()}
    docs = {}
    for r in packed:
        ids, ends = np.frombuffer(r["ids"], "<u2"), r["cu_seqlens"]
        assert len(ids) == 32 and ends[-1] == r["n_tokens"] and r["position_resets"] == ends[:-1] and not ids[r["n_tokens"] :].any()
        assert packing.position_ids(ends, 32)[: ends[1]].tolist() == list(range(ends[1]))
        for s, e, doc, row, start in zip(ends[:-1], ends[1:], r["doc_ids"], r["doc_rows"], r["piece_starts"], strict=True):
            docs.setdefault((row, doc), []).append((start, ids[s:e].tolist()))
    read = Counter((doc, b"".join(table[i] for _, piece in sorted(pieces) for i in piece).decode()) for (_, doc), pieces in docs.items())
    assert read == Counter((k, t) for k, t in texts if t)
    again = packing.unpack(spark.createDataFrame(packed, packing.SCHEMA), 32).collect()
    assert len(again) == len(docs)
    assert packing.pack(edge, VOCABULARY).count() > 0 and packing.pack(edge.limit(0), VOCABULARY).count() == 0


def test_neighbours_reach_their_recall(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    x, ids = np.array(rows.embedding.tolist(), float), rows.vec_id.to_numpy()
    found = QUERIES["op7_neighbours"](spark, sf_dir).toPandas()
    hits = []
    for k in np.flatnonzero(ids % 20 == 0):
        score = (x * x[k]).sum(axis=1)
        score[k] = -np.inf
        own = found[found.query_id == ids[k]].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 21)) and own.score.is_monotonic_decreasing
        np.testing.assert_allclose(own.score, score[[np.flatnonzero(ids == v)[0] for v in own.vec_id]], rtol=1e-12)
        hits.append(len({*own.vec_id} & {*ids[np.lexsort((ids, -score))[:20]]}))
    assert np.mean(hits) / 20 >= 0.9


def test_neighbours_among_equal_vectors(spark):
    x = np.random.default_rng(4).normal(size=(900, 8)).astype(np.float32)
    x[np.random.default_rng(5).permutation(900)[:300]] = x[0] * 2
    rows = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<float>")
    found = neighbours.nearest(rows, F.col("id") % 10 == 0, 20).toPandas()
    x, hits, copies = x.astype(float), [], (x == x[0] * 2).all(axis=1) | (x == x[0]).all(axis=1)
    for k in range(0, 900, 10):
        score = (x * x[k]).sum(axis=1)
        score[k] = -np.inf
        best = np.lexsort((np.arange(900), -score))[:20]
        own = found[found.query_id == k].sort_values("rank")
        assert own["rank"].tolist() == list(range(1, 21))
        hits.append((copies[k], len({*own.vec_id} & {*best})))
    assert np.mean([h for _, h in hits]) / 20 >= 0.9 and np.mean([h for c, h in hits if c]) / 20 >= 0.9


def test_neighbours_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [2.0, 0.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, None]), (None, [1.0, 1.0]), (20, [0.0, 1.0]), (20, [0.0, 1.0]), (8, [1.0, 1.0, 1.0])]
    found = neighbours.report(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in found.orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 2.0), (0, 2, 2, 2.0), (0, 3, 20, 0.0), (20, 1, 0, 0.0), (20, 2, 1, 0.0), (20, 3, 2, 0.0)]
    assert neighbours.report(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_hilbert_curve_visits_neighbours():
    for d, bits in ((2, 4), (3, 3)):
        cells = np.stack(np.meshgrid(*[np.arange(1 << bits)] * d, indexing="ij"), axis=-1).reshape(-1, d)
        key = neighbours.hilbert_key(cells, bits)
        assert sorted(key) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[np.argsort(key)], axis=0)).sum(axis=1) == 1).all()


def test_pipeline_by_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    stages = dict(corpus_pipeline.STAGES)
    told = stages["language"](spark, docs, sf_dir)
    assert told.columns == docs.columns and told.count() == docs.where(F.col("text").rlike(r"\p{L}")).count()
    kept = {r["doc_id"] for r in stages["near_dedup"](spark, told, sf_dir).collect()}
    texts = {r["doc_id"]: r["text"] for r in told.collect()}
    assert kept == {d for d, _, _, keep in near_by_brute_force(list(texts.items()), 5, 80) if keep}
    items = [words(r["text"]) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    windows = {tuple(i[k : k + 10]) for i in items for k in range(max(1, len(i) - 9))}

    def clean(text):
        own = words(text)
        return not any(tuple(own[k : k + 10]) in windows for k in range(len(own)))

    clean_ids = {d for d in kept if clean(texts[d])}
    near = told.where(F.col("doc_id").isin(list(kept)))
    left = stages["decontaminate"](spark, near, sf_dir)
    assert {r["doc_id"] for r in left.collect()} == clean_ids
    table = {v: k for k, v in {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(VOCABULARY, "rb"))}.items()}
    expected = Counter(r["text"] for r in stages["mix"](spark, left, sf_dir).collect())
    read = {}
    for r in corpus_pipeline.run(spark, sf_dir).collect():
        ids = np.frombuffer(r["ids"], "<u2")
        for s, e, row, start in zip(r["cu_seqlens"][:-1], r["cu_seqlens"][1:], r["doc_rows"], r["piece_starts"], strict=True):
            read.setdefault(row, []).append((start, ids[s:e].tolist()))
    assert Counter(b"".join(table[i] for _, p in sorted(x) for i in p).decode() for x in read.values()) == expected


def test_language_stage_drops_what_is_stated_wrongly(spark):
    english, german = "the quick brown fox was with them and that dog", "die katze und der hund sind nicht hier geblieben"
    rows = [(k, f"{(english, german)[k % 2]} {k}", ("en", "de")[k % 2]) for k in range(40)]
    rows += [(100, german, "en"), (101, english, "de"), (102, german, None), (103, "...", "en"), (104, None, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept = corpus_pipeline.language_stage(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [*range(40), 102]
