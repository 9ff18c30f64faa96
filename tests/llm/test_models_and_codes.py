"""Context trees, vector codes and spelling variants against brute force on small tables."""

import math
import random
import zlib

import pytest
from pyspark.sql import functions as F

from caseflow.llm import context_tree, orchard, spelling
from caseflow.llm.kdtree import KdTree
from tests.llm.conftest import EXTRA

DOC = "doc_id long, text string, score string, key string, slice string, n string"


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "x", "y", "z", "w") for i, t in rows], DOC)


# --- context trees -------------------------------------------------------------------------------------------------


class PlainTree:
    """Counts in dictionaries, and the mix by recursion over all contexts."""

    def __init__(self, texts, depth):
        self.depth, self.counts = depth, {}
        for text in texts:
            for context, node, bit in self.decisions(text):
                for d in range(depth + 1):
                    self.counts.setdefault((context[depth - d :], node), [0, 0])[bit] += 1
        self.kids = {}
        for context, node in self.counts:
            if context:
                self.kids.setdefault((context[1:], node), []).append((context, node))

    def decisions(self, text):
        data = bytes([255] * self.depth) + "".join(c.lower() if c < "\x80" else c for c in text).encode() + b"\xff"
        for p in range(self.depth, len(data)):
            node = 1
            for k in range(7, -1, -1):
                bit = data[p] >> k & 1
                yield data[p - self.depth : p], node, bit
                node = node << 1 | bit

    def own(self, key):
        a, b = self.counts[key]
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    def mixed(self, key):
        if len(key[0]) == self.depth:
            return self.own(key)
        below = sum(self.mixed(k) for k in self.kids[key])
        return math.log(0.5 * math.exp(self.own(key)) + 0.5 * math.exp(below))

    def ratio(self, key, bit):
        """Probability of a bit: the weighted probability after it over the one before it."""
        context, node = key
        chain = [(context[self.depth - d :], node) for d in range(self.depth + 1)]
        old = {k: list(v) for k, v in self.counts.items()}, {k: list(v) for k, v in self.kids.items()}
        before = self.mixed(chain[0]) if chain[0] in self.counts else 0.0
        for k in chain:
            if k not in self.counts:
                self.counts[k] = [0, 0]
                if k[0]:
                    self.kids.setdefault((k[0][1:], node), []).append(k)
            self.counts[k][bit] += 1
        after = self.mixed(chain[0])
        self.counts, self.kids = old
        return after - before

    def score(self, text):
        return sum(self.ratio((c, n), b) for c, n, b in self.decisions(text)) / math.log(10)


@pytest.mark.parametrize("depth", [0, 2])
def test_context_tree_equals_the_weighted_tree(spark, depth):
    rows = [(1, "abab ABa"), (2, "abbé"), (3, None), (4, ""), (5, "zz ab"), (5, "zz ab"), (None, "b")]
    scored, tokens = context_tree.score_texts(docs_of(spark, rows), F.coalesce(F.col("doc_id") != 5, F.lit(True)), depth=depth)
    plain = PlainTree([t or "" for i, t in rows if i != 5], depth)
    found = scored.collect()
    assert len(found) == len(rows) and tokens == 2 + 1 + 1 + 5
    text = {i: t for i, t in rows}
    for r in found:
        assert r["score"] == pytest.approx(plain.score(text[r["id"]] or ""), rel=1e-9)
        assert r["learnt"] == (r["id"] != 5)
    five = [r for r in found if r["id"] == 5]
    assert [(r["n_tokens"], r["n_known"]) for r in five] == [(3, 1)] * 2  # neither word is learnt, the end is
    # learnt tokens: abab, aba, abbé, b, and five ends: N = 9, V = 5
    assert five[0]["base_score"] == pytest.approx(2 * math.log10(1 / 15) + math.log10(6 / 15))


def test_context_tree_values_are_probabilities(spark):
    """The probabilities of all bytes after one context sum to one, met or not."""
    runs = [(c << 8 | b, n) for c, own in ((97, {98: 5, 99: 1}), (98, {97: 4})) for b in range(256) for n in [own.get(b, 0)]]
    values = context_tree.run_values(spark.createDataFrame(runs, "key long, n long"), depth=1).collect()
    for context in (97, 98):
        assert sum(10 ** r["value"] for r in values if r["key"] >> 8 == context) == pytest.approx(1)


def test_context_tree_edges(spark, edge, monkeypatch):
    told = context_tree.report(edge).collect()
    assert len(told) == edge.count()
    by_id = {r["doc_id"]: r for r in told}
    assert by_id[5]["n_tokens"] == 60_001 and by_id[5]["score"] > -10_000
    assert by_id[1]["n_tokens"] == by_id[2]["n_tokens"] == by_id[3]["n_tokens"] == 1
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2) for r in told)
    assert context_tree.report(edge.limit(0)).collect() == []
    # small slices, packs and windows change nothing
    monkeypatch.setattr(context_tree, "WINDOW", 1000)
    monkeypatch.setattr(context_tree, "PACK_BYTES", 100)
    monkeypatch.setattr(context_tree, "SLICE_BYTES", 10)
    source = edge.select(F.col("doc_id").alias("id"), "text", F.lit(True).alias("learn"))
    cut = context_tree._gather(source, 4).where("blob IS NULL").groupBy("key").agg(F.sum("n").alias("n"))
    monkeypatch.undo()
    whole = context_tree._gather(source, 4).where("blob IS NULL").groupBy("key").agg(F.sum("n").alias("n"))
    assert cut.exceptAll(whole).isEmpty() and whole.exceptAll(cut).isEmpty()


def test_counts_of_a_slice_take_little_memory(monkeypatch):
    """Merging copies the keys once; before, it took several times what the counts hold."""
    import tracemalloc

    import numpy as np

    monkeypatch.setattr(context_tree, "PENDING", 1 << 13)
    keys = np.random.default_rng(1).permutation(1 << 19).reshape(64, -1) - 99
    counts = context_tree._Counts()
    tracemalloc.start()
    for part in (*keys, keys[0], keys[0]):
        counts.add(part, part % 2 == 0)
    found, n = counts.total()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (found == np.arange(1 << 19) - 99).all() and n.sum() == (1 << 18) + (keys[0] % 2 == 0).sum() * 2
    assert most < 3 * (found.nbytes + n.nbytes)


def test_context_tree_without_learnt_texts(spark):
    scored, tokens = context_tree.score_texts(docs_of(spark, [(1, "ab"), (2, None)]), F.lit(False))
    found = {r["id"]: r for r in scored.collect()}
    assert tokens == 0 and found[1]["score"] == pytest.approx(3 * 8 * math.log10(0.5)) and found[1]["base_score"] == 0
    assert found[2]["score"] == pytest.approx(8 * math.log10(0.5)) and found[2]["n_known"] == 0


# --- vector codes --------------------------------------------------------------------------------------------------


def plain_codes(rows, parts=8, entries=16, rounds=6):
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    whole = [[math.floor(4096 * x) for x in v] for _, v in rows]
    width = len(whole[0]) // parts
    cut = [[v[p * width : (p + 1) * width] for v in whole] for p in range(parts)]
    books = [[list(x) for x in cut[p][:entries]] for p in range(parts)]

    def nearest(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            of = [nearest(p, x)[1] for x in cut[p]]
            for e in range(len(books[p])):
                own = [x for x, k in zip(cut[p], of) if k == e]
                if own:
                    books[p][e] = [sum(c) // len(own) for c in zip(*own)]
    found = {}
    for k, (i, _) in enumerate(rows):
        best = [nearest(p, cut[p][k]) for p in range(parts)]
        found.setdefault(i, []).append(("".join(f"{e:02x}" for _, e in best), sum(d for d, _ in best)))
    return found, books


VECTORS = "vec_id long, embedding array<float>, label int, code string, part string"


def test_vector_codes_equal_plain_rounds(spark):
    rng = random.Random(3)
    near = [[rng.choice([-1.0, 0.25, 0.5, 2.0]) for _ in range(16)] for _ in range(60)]  # many ties
    rows = [(i, near[i % 45], i % 3 if i % 4 else None) for i in range(60)]
    bad = [(100, None, 1), (101, [1.0] * 15 + [None], 1), (102, [1.0] * 15 + [float("nan")], 2), (103, [1.0] * 15 + [float("inf")], 2), (104, [1.0] * 8, 0)]
    extra = [(None, near[0], None), (7, near[7], 1)]
    df = spark.createDataFrame([(*r, "a", "b") for r in rows + extra + bad], VECTORS)
    expected, books = plain_codes([(i, v) for i, v, _ in rows + extra])
    found = orchard.report(df).collect()
    told = {}
    for r in found:
        told.setdefault(r["vec_id"], []).append((r["code"], r["error"]))
    assert {k: sorted(v) for k, v in told.items()} == {k: sorted(v) for k, v in expected.items()}
    flat = ",".join(str(x) for b in books for e in b for x in e)
    assert {r["codebooks_sha256"] for r in found} == {__import__("hashlib").sha256(flat.encode()).hexdigest()}
    label = {i: lab for i, _, lab in rows}
    nulls = sum(r["error"] for r in found if r["vec_id"] is None or (r["vec_id"] in label and label[r["vec_id"]] is None))
    assert {r["label_error"] for r in found if r["vec_id"] in (None, 0, 4)} == {nulls}


def test_vector_code_edges(spark):
    empty = spark.createDataFrame([(1, None, 1, "a", "b")], VECTORS)
    assert orchard.report(empty).collect() == [] and orchard.report(empty.limit(0)).columns[0] == "vec_id"
    none = spark.createDataFrame([(2, [], 1, "a", "b"), (3, [1.0], 1, "a", "b")], VECTORS)
    assert [(r["vec_id"], r["code"], r["error"]) for r in orchard.report(none).collect()] == [(2, "00" * 8, 0)]
    odd = spark.createDataFrame([(1, [1.0, -3e38, 3e38], 1, "a", "b"), (2, [1.0, 0.0, 0.0], 1, "a", "b")], VECTORS)
    assert {r["error"] for r in orchard.report(odd).collect()} == {0}


def test_orchard_finds_the_nearest_entry():
    import numpy as np

    rng = np.random.default_rng(5)
    for width, high in ((1, 4), (3, 3), (8, 5000)):
        entries, rows = rng.integers(-high, high, (16, width)), rng.integers(-high, high, (500, width))
        gaps = ((rows[:, None] - entries[None]) ** 2).sum(axis=2)
        best, distance = orchard.Orchard(entries).nearest(rows)
        assert (best == gaps.argmin(axis=1)).all() and (distance == gaps.min(axis=1)).all()


# --- spelling variants ---------------------------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


def plain_variants(counts):
    told = {}
    for w, n in counts.items():
        near = [x for x in counts if x != w and one_edit(w, x)]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        told[w] = (n, len(near), best if best and counts[best] >= 10 * n else None)
    return told


def random_words(rng, n):
    stems = ["thonanble", "eéaouïra", "aabbaabb", "ÀÆÌÒabcd"]
    words = set(stems)
    while len(words) < n:
        w = list(rng.choice(sorted(words)))
        k, kind = rng.randrange(len(w)), rng.randrange(4)
        if kind == 0:
            w[k] = rng.choice("abeéïÿÀ")
        elif kind == 1 and len(w) > 7:
            del w[k]
        elif kind == 2 and len(w) < 11:
            w.insert(k, rng.choice("abeéïÿÀ"))
        else:
            rng.shuffle(w)
        words.add("".join(w))
    return sorted(words)


@pytest.mark.parametrize("cell, tile", [(4096, 1 << 14), (8, 1 << 14), (16, 5)])
def test_near_words_equal_all_pairs(spark, monkeypatch, cell, tile):
    monkeypatch.setattr(spelling, "CELL", cell)
    monkeypatch.setattr(spelling, "TILE_WORDS", tile)
    monkeypatch.setattr(spelling, "SAMPLE", 200)
    rng = random.Random(11)
    counts = {w: rng.choice([2, 3, 20, 200, 2000]) for w in [*random_words(rng, 400), "x" * 3000, "x" * 2999 + "y"]}
    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    found = [(r["word"], r["other"], r["other_n"]) for r in spelling.near_words(words).collect()]
    expected = {(a, b, counts[b]) for a in counts for b in counts if a != b and one_edit(a, b)}
    assert len(found) == len(set(found)) and set(found) == expected


def test_variants_of_documents(spark):
    rows = [(k, "Thonanble thonanble THONANBLE wordsée") for k in range(40)] + [(None, "thonable thonable, short thonanblé1thonanblé"), (90, None), (91, "")]
    rows += [(91, "wordsée")] * 2
    counts = {}
    for i, text in rows:
        for run in __import__("re").findall("[A-Za-zÀ-ÿ]+", text or ""):
            low = "".join(c.lower() if c < "\x80" else c for c in run)
            h = zlib.crc32(f"{'' if i is None else i}:{low}".encode())
            if h % 31 == 0:
                low = low[: h % len(low)] + low[h % len(low) + 1 :]
            if len(low) >= 7:
                counts[low] = counts.get(low, 0) + 1
    counts = {w: n for w, n in counts.items() if n >= 2}
    expected = plain_variants(counts)
    found = {r["word"]: r for r in spelling.variants(docs_of(spark, rows)).collect()}
    assert {w: (r["n"], r["n_near"], r["form"]) for w, r in found.items()} == expected
    assert found["thonable"]["form"] == found["thonable"]["root"] == "thonanble" and found["thonanble"]["root"] == "thonanble"
    assert spelling.variants(docs_of(spark, rows).limit(0)).collect() == []
    assert spelling.variants(docs_of(spark, [(1, None), (2, "short words only")])).collect() == []


def test_roots_follow_long_chains(spark):
    forms = spark.createDataFrame([(f"w{k}", f"w{k + 1}") for k in range(19)], "word string, form string")
    assert {r["root"] for r in spelling._roots(forms).collect()} == {"w19"}


def test_range_search_reaches_every_near_point():
    import numpy as np

    rng = np.random.default_rng(2)
    points, asked = rng.integers(0, 3, (300, 6)), rng.integers(0, 3, (50, 6))
    tree = KdTree(points, 8)
    near = np.abs(asked[:, None] - points[None]).sum(axis=2) <= 2
    home = np.empty(300, np.int64)
    for k, own in enumerate(tree.leaves):
        home[own] = k
    assert (tree.place(points) == home).all()
    reached = {(int(a), leaf) for leaf, rows in tree.reached(asked, 2) for a in rows}
    assert {(int(a), int(home[b])) for a, b in zip(*np.nonzero(near))} <= reached
    assert len(KdTree(np.ones((50, 3), np.int64), 4).leaves) == 1


def test_variants_ignore_clashing_columns(spark, edge):
    assert set(EXTRA) <= set(edge.columns)
    found = spelling.variants(edge.withColumn("text", F.concat_ws(" ", "text", F.lit("Variants"))))
    assert {"variants"} <= {r["word"] for r in found.collect()}
    one = spelling.variants(spark.createDataFrame([(None, "x" * 50_000 + " " + "x" * 50_000)], "doc_id long, text string")).collect()
    assert [(len(r["word"]), r["n"], r["root"] == r["word"]) for r in one] == [(len(one[0]["word"]), 2, True)]


# --- language vectors of long texts --------------------------------------------------------------------------------


@pytest.mark.parametrize("part", [1, 2, 7, 50])
def test_pieces_of_a_long_text_add_up(monkeypatch, part):
    import numpy as np

    from caseflow.llm import language

    vectors = language.Vectors(64, 3)
    for text in ("", " ", "a", "ab", "  Ab, cd\x00 ef--  gh ", "x" * 120, "Ünï cödé, " * 9, ",;" * 40 + "q"):
        whole, lettered = language.text_vectors([text], vectors)
        monkeypatch.setattr(language, "PART_CHARS", part)
        found, has = language._long_vector(text, vectors)
        monkeypatch.undo()
        assert (found == whole[0]).all() and has == bool(lettered[0]), text
    long = "the quick brown fox, " * 60_000  # beyond 2 ** 20 characters, as it is cut in use
    (_, found, _), = language._vectors_of([long], vectors)
    assert (found == language.text_vectors([long], vectors)[0]).all() and np.abs(found).sum() > 0


def test_language_vectors_take_little_memory():
    """Runs of texts, and blocks of their n-grams, are small; before, one run took over 40 MB."""
    import tracemalloc

    import numpy as np

    from caseflow.llm import language

    rng = np.random.default_rng(3)
    texts = ["".join(chr(c) for c in rng.choice([32, *range(97, 123), *range(0x430, 0x440)], 2500)) for _ in range(300)]
    vectors, found = language.Vectors(language.DIM, language.GRAM), np.zeros((300, language.DIM))
    language.text_vectors(texts[:1], vectors)
    tracemalloc.start()
    for first, part, lettered in language._vectors_of(texts, vectors):
        found[first : first + len(part)] = part
        assert lettered.all()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    for k in (0, 104, 299):
        assert (found[k] == language.text_vectors([texts[k]], vectors)[0][0]).all()
    assert most < 25e6


def test_small_batches_give_memory_back(monkeypatch):
    import pyarrow as pa

    from caseflow.llm import words

    done = []
    monkeypatch.setattr(words, "give_back", lambda: done.append(len(seen)))
    seen = []
    for part in words.small_batches(iter([pa.RecordBatch.from_pydict({"text": ["aa", None, "b"]})] * 2), "text", 2):
        seen += part.column(0).to_pylist()
    assert seen == ["aa", None, "b"] * 2 and done == [0, 3, 6]
