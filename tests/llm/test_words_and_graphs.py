import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from caseflow.llm import words as w
from caseflow.llm.components import connected_components
from caseflow.llm.packing import best_fit_decreasing

TEXT = st.lists(st.one_of(st.none(), st.text("abAZ09 é_-.\n\t", max_size=40)), max_size=8)


@settings(max_examples=60, deadline=None)
@given(TEXT)
def test_words_equal_the_pattern(texts):
    for table, pattern in ((w.ALPHANUMERIC, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"), (w.NON_SPACE, r"[^\x20\x09-\x0D]+")):
        hashes, at = w.word_hashes(pa.array(texts, pa.string()), table)
        lower = [(t or "").translate({c: c + 32 for c in range(65, 91)}) for t in texts]
        expected = [re.findall(pattern, t) for t in lower]
        assert np.diff(at).tolist() == [len(e) for e in expected]
        named = dict(zip([x for e in expected for x in e], hashes.tolist(), strict=True))
        assert [named[x] for e in expected for x in e] == hashes.tolist()
        assert len(set(named.values())) == len(named)


def test_chunks_change_nothing(monkeypatch):
    texts = pa.array(["alpha beta " * 50, None, "gamma" * 40, "delta"], pa.string())
    whole, at = w.word_hashes(texts, w.ALPHANUMERIC)
    monkeypatch.setattr(w, "CHUNK_BYTES", 16)
    parts, again = w.word_hashes(texts, w.ALPHANUMERIC)
    assert whole.tolist() == parts.tolist() and at.tolist() == again.tolist()


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["a" * n for n in (5, 0, 50, 7, 7)] + [None])], ["text"])
    rows = [x for b in w.small_batches(iter([batch]), "text", 12) for x in b.column(0).to_pylist()]
    assert rows == batch.column(0).to_pylist()


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 16), max_size=40))
def test_best_fit_decreasing(sizes):
    rows = best_fit_decreasing(sizes, 16)
    assert sorted(k for row in rows for k in row) == list(range(len(sizes)))
    assert all(sum(sizes[k] for k in row) <= 16 for row in rows)
    open_: list[int] = []  # the same by plain search
    for size in sorted(sizes, reverse=True):
        fits = [c for c in open_ if c >= size]
        if fits:
            open_.remove(min(fits))
            open_.append(min(fits) - size)
        else:
            open_.append(16 - size)
    assert sorted(16 - sum(sizes[k] for k in row) for row in rows) == sorted(open_)


def test_components(spark):
    draw = np.random.default_rng(3)
    links = [(int(a), int(b)) for a, b in draw.integers(0, 120, (90, 2))] + [(200 + k, 201 + k) for k in range(17)] + [(300, 300 + k) for k in range(9)] + [(5, None)]
    parent = {}

    def top(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if b is not None and a != b:
            low, high = sorted((top(a), top(b)))
            parent[high] = low
    found = {r["node"]: r["component"] for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert found == {x: top(x) for x in parent}
