import math
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from caseflow import schemas
from caseflow.operators import features as fx
from caseflow.operators import postings, retrieval
from caseflow.plans.queries import search as queries

CASES = {
    "case_1": ("my parcel is late again today", "Delivery Issue"),
    "case_2": ("my parcel is late again today", "Refund Request"),
    "case_3": ("refund my broken kettle please", "Refund Request"),
    "case_4": ("the kettle is broken refund it", "Return / Wrong or Damaged Item"),
    "case_5": ("cannot log in a", "Account Access / Security"),
    "case_6": ("late parcel late refund", "Delivery Issue"),
}
WORDS = fx.TermSpec("word", 1, 2, fx.WORD, (), True, 1, 500)
CHARS = fx.TermSpec("char", 3, 5, fx.WORD, (), True, 1, 2000)


@pytest.fixture(scope="module")
def index(spark):
    rows = [(k, i, x, x, "reply " + k, label) for i, (k, (x, label)) in enumerate(CASES.items())]
    return retrieval.fit_index(spark.createDataFrame(rows, schemas.CORPUS), WORDS, CHARS)


def word_terms(text):
    toks = re.findall(r"\b\w\w+\b", text.lower())
    return Counter(toks + [" ".join(p) for p in zip(toks, toks[1:])])


def char_terms(text):
    out = Counter()
    for w in text.lower().split():
        p = f" {w} "
        for n in (3, 4, 5):
            if n <= len(p):
                out.update(p[i:i + n] for i in range(len(p) - n + 1))
    return out


def vectors(terms, texts, known=None):
    counts = [terms(x) for x in texts]
    if known is None:
        df = Counter(t for c in counts for t in c)
        known = {t: math.log((1 + len(texts)) / (1 + d)) + 1 for t, d in df.items()}
    out = []
    for c in counts:
        w = {t: (1 + math.log(n)) * known[t] for t, n in c.items() if t in known}
        size = math.sqrt(sum(x * x for x in w.values())) or 1
        out.append({t: x / size for t, x in w.items()})
    return out, known


def brute(query, intent, k):
    texts = [x for x, _ in CASES.values()]
    scores = []
    parts = []
    for terms in (word_terms, char_terms):
        docs, known = vectors(terms, texts)
        q = vectors(terms, [query], known)[0][0]
        parts.append([sum(q.get(t, 0) * w for t, w in d.items()) for d in docs])
    for (case, (_, label)), lex, sem in zip(CASES.items(), *parts):
        scores.append((-round(0.45 * lex + 0.55 * sem + (0.15 * sem if label == intent else 0), 9), case))
    return [(c, round(-s, 4)) for s, c in sorted(scores)[:k]]


QUERIES = [
    ("q1", "my parcel is late again today", None), ("q2", "zzzz qqqq", None), ("q3", "@bob https://x.y", None),
    ("q4", "broken kettle", "Return / Wrong or Damaged Item"), ("q5", "my parcel is late again today", "Refund Request"),
    ("q6", "a", None),
]


def search(spark, index, **kw):
    rows = spark.createDataFrame(QUERIES, "q_id string, text string, want string")
    found = retrieval.topk(rows, index, 3, intent="want", **kw).orderBy("q_id", "rank").collect()
    return {q: [(r.case_id, r.score) for r in found if r.q_id == q] for q, _, _ in QUERIES}


def test_matches_brute_force(spark, index):
    got = search(spark, index)
    for q, text, want in QUERIES:
        assert got[q] == ([] if q == "q3" else brute(text, want, 3)), q
    assert got["q1"][0] == ("case_1", 1.0) and got["q1"][1] == ("case_2", 1.0)      # tie by case id
    assert got["q5"][0] == ("case_2", 1.15)                                        # the bonus turns it
    assert got["q2"] == [("case_1", 0.0), ("case_2", 0.0), ("case_3", 0.0)]        # zero fill


def test_blocks_and_chunks_change_nothing(spark, index, monkeypatch):
    whole = search(spark, index)
    for block, chunk in ((1, 1), (2, 10), (4, 10**6)):
        monkeypatch.setattr(postings, "BLOCK", block)
        monkeypatch.setattr(postings, "CHUNK_POSTINGS", chunk)
        rows = [(k, i, x, x, "reply " + k, label) for i, (k, (x, label)) in enumerate(CASES.items())]
        cut = retrieval.fit_index(spark.createDataFrame(rows, schemas.CORPUS), WORDS, CHARS)
        assert cut.members.count() == -(-len(CASES) // block) and search(spark, cut) == whole


def test_bounds_skip_blocks_and_lose_nothing():
    """Random sparse cases: the same best cases as a full product, with blocks left out."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(4)
    n, terms, k = 4000, 300, 3
    topic = np.sort(rng.integers(0, 30, n))
    weights = np.zeros((n, terms))
    for c in range(n):
        own = np.concatenate([topic[c] * 8 + rng.integers(0, 8, 5), 240 + rng.integers(0, 60, 3)])
        weights[c, own] = rng.random(8)
    weights /= np.linalg.norm(weights, axis=1)[:, None]
    intents = [f"i{x % 4}" for x in topic]
    rows, members = [], []
    for b in range(-(-n // postings.BLOCK)):
        part = weights[b * postings.BLOCK : (b + 1) * postings.BLOCK]
        members.append((b, [f"{c:05d}" for c in range(b * postings.BLOCK, b * postings.BLOCK + len(part))], intents[b * postings.BLOCK :][: len(part)]))
        for t in np.flatnonzero(part.any(axis=0)):
            slots = [int(s) for s in np.argsort(-part[:, t], kind="stable") if part[s, t] > 0]
            rows.append((b, int(t), float(part[:, t].max()), slots, [float(part[s, t]) for s in slots]))
    columns = [pa.array(x) for x in zip(*rows)]
    table = pa.table([columns[0], columns[1], columns[2], columns[3], columns[4]], ["block", "term", "top", "slots", "weights"])
    chunk = postings.Chunk(table, pa.table([pa.array(x) for x in zip(*members)], ["block", "case_ids", "intents"]))
    kind, visited = np.arange(terms) % 2, 0
    for q in range(0, n, 200):
        own = np.flatnonzero(weights[q])
        lex, sem = (weights[:, own[kind[own] == x]] @ weights[q, own[kind[own] == x]] for x in (0, 1))
        wanted = "i1" if q % 400 else None
        score = 0.45 * lex + 0.55 * sem + 0.15 * sem * (np.array(intents) == wanted)
        want = sorted(range(n), key=lambda c: (-round(score[c], 9), c))[:k]
        held = [(0.0, 0.0, 0.0, f"{c:05d}") for c in range(k)]
        found, blocks = chunk.search(own, weights[q, own], wanted, held, k, 0.45, 0.55, 0.15)
        assert [int(r[3]) for r in found] == want and [round(r[0], 9) for r in found] == [round(score[c], 9) for c in want]
        visited += blocks
    assert visited < 0.7 * 20 * chunk.n_blocks


def test_groups_of_queries_go_by_product(monkeypatch):
    """Cases that share terms, so that bounds rule out nothing: most queries meet all cases at once, with the same results."""
    import numpy as np
    import pyarrow as pa

    rng = np.random.default_rng(5)
    n, terms, k = 700, 90, 4
    weights = rng.random((n, terms)) * (rng.random((n, terms)) < np.linspace(0.9, 0.01, terms))
    weights[-1] = weights[3]
    intents = [f"i{c % 3}" for c in range(n)]
    rows, members = [], []
    for b in range(-(-n // postings.BLOCK)):
        part = weights[b * postings.BLOCK : (b + 1) * postings.BLOCK]
        members.append((b, [f"{b * postings.BLOCK + i:05d}" for i in range(len(part))], intents[b * postings.BLOCK :][: len(part)]))
        for t in np.flatnonzero(part.any(axis=0)):
            slots = [int(s) for s in np.argsort(-part[:, t], kind="stable") if part[s, t] > 0]
            rows.append((b, int(t), float(part[:, t].max()), slots, [float(part[s, t]) for s in slots]))
    table = pa.table([pa.array(x) for x in zip(*rows)], ["block", "term", "top", "slots", "weights"])
    chunk = postings.Chunk(table, pa.table([pa.array(x) for x in zip(*members)], ["block", "case_ids", "intents"]))
    queries = [(np.flatnonzero(w), w[w > 0]) for w in weights[:40]] + [(np.array([terms + 5]), np.array([1.0])), (np.empty(0, int), np.empty(0))]
    wanted, held = ["i1", None, "none"] * 14, [[(0.0, 0.0, 0.0, f"{c:05d}") for c in range(k)] for _ in queries]
    single = [chunk.search(*q, w, h, k, 0.45, 0.55, 0.15)[0] for q, w, h in zip(queries, wanted, held)]
    search, asked = postings.Chunk.search, []
    monkeypatch.setattr(postings.Chunk, "search", lambda self, *a: asked.append(1) or search(self, *a))
    told = [best for best, _ in chunk.search_all(queries, wanted, held, k, 0.45, 0.55, 0.15)]
    digits = lambda found: [[(r[3], *(round(x, 9) for x in r[:3])) for r in best] for best in found]
    assert digits(told) == digits(single) and told[3][0][3] == "00003" and len(asked) == postings.PROBES


def test_saved_index(spark, index, tmp_path):
    retrieval.save_index(index, str(tmp_path / "index"))
    loaded = retrieval.load_index(spark, str(tmp_path / "index"))
    assert search(spark, loaded) == search(spark, index)
    plan = loaded.postings.where("chunk = 0")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "PartitionFilters: [isnotnull(chunk" in plan


def test_equal_texts_are_searched_once(spark, index):
    texts = spark.createDataFrame([(str(i), "late parcel" if i % 3 else f"broken kettle {i}") for i in range(60)], "q_id string, text string")
    found = retrieval.topk(texts, index, 2)
    same = {(r.rank, r.case_id, r.score) for r in found.collect() if int(r.q_id) % 3}
    assert found.count() == 120 and len(same) == 2


def test_metrics_count_missing_queries(spark):
    queries = spark.createDataFrame([("a", "X"), ("b", "X"), ("c", "X")], "q_id string, gold string")
    best = spark.createDataFrame(
        [("a", 1, "X", True), ("b", 1, "Y", False), ("b", 2, "X", True)], "q_id string, rank int, intent string, is_sufficient boolean")
    row = retrieval.retrieval_metrics(best, queries, "gold").first()
    assert (row.recall_at_1, row.recall_at_3, row.mrr, row.evidence_sufficiency_pct) == (0.3333, 0.6667, 0.5, 33.33)
    assert retrieval.retrieval_metrics(best, queries.where("false"), "gold").count() == 0


def test_tokens_and_short_words(spark):
    df = spark.createDataFrame([(1, "A $99 wow!! x_y")], "id int, text string")
    toks = df.select(fx.tokens(F.col("text"), fx.CLASSIFIER_WORDS).alias("t")).first().t
    assert toks == ["a", "$99", "wow", "!!", "x_y"]
    grams = fx.term_counts(spark.createDataFrame([(1, "a a bc")], "id int, text string"), "id", "text", fx.SEARCH_CHARS)
    assert {r.term: r.tf for r in grams.collect()} == {" a ": 2, " bc": 1, "bc ": 1, " bc ": 1}
    runs = df.select(fx.word_ngrams(F.array(*[F.lit(x) for x in "pqr"]), 1, 3).alias("g")).first().g
    assert runs == ["p", "q", "r", "p q", "q r", "p q r"]


def test_registered_searches_ask_every_message(spark, tmp_path):
    """Messages whose numbers are divisible by 41, 43 or 47 are asked with their own texts too."""
    told = lambda c, t: f"parcel {c % 3} and refund of order number {t} that is late"
    rows = [(c, t, ("user", "assistant")[t % 2], told(c, t)) for c in range(30, 50) for t in range(2)]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    for query, k in ((queries.hybrid_topk, 3), (queries.conditioned_topk, 5)):
        assert {r.q_id: r["count"] for r in query(spark, str(tmp_path)).groupBy("q_id").count().collect()} == {str(c * 1000): k for c in range(30, 50)}


def test_tasks_that_cut_up_texts_grow_in_number(spark, monkeypatch):
    """A task holds a bounded stretch of text, whatever the session's number of partitions; the counts are the same."""
    docs = spark.createDataFrame([(i, f"late parcel number {i % 7}" if i % 5 else None) for i in range(60)], "id int, text string")
    for spec in (WORDS, CHARS):
        few = fx.term_counts(docs, "id", "text", spec)
        with monkeypatch.context() as m:
            m.setattr(fx, "TASK_CHARACTERS", 100)
            many = fx.term_counts(docs, "id", "text", spec)
        assert few.rdd.getNumPartitions() == 4 and many.rdd.getNumPartitions() == 10
        assert few.exceptAll(many).isEmpty() and many.exceptAll(few).isEmpty()
    assert fx.term_counts(docs.where("false"), "id", "text", WORDS).count() == 0
