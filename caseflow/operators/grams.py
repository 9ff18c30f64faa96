"""Terms of texts counted by arrays, in Arrow batches: vocabularies and vectors as in ``operators.features``, without a row for each term of a document.

Tokens are cut by the same column expressions. Within a slice of some million characters, tokens and characters get numbers, and runs of them
are numbers too, so that terms are counted by sorting numbers; strings are made for what leaves the slice. Nothing is estimated:

- Shortest runs of words and all runs of characters are counted as they are; a slice sends one row for each of its terms.
- Longer runs of words are as many as the words, and hardly any is frequent. A run among the ``max_features`` most frequent occurs at least
  ``least`` times, the count of the last of the most frequent shortest runs. So in some slice it occurs at least ``least`` times the slice's share of the words:
  what does so nowhere is left out, and what does so somewhere and can still be among the most frequent is counted in all slices.

Rows that share an id are one document, as in ``term_counts``; they stand side by side and are held together.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from caseflow.operators import features as fx
from caseflow.operators import solver
from caseflow.session import materialize

# Characters of text that are counted at a time, and cells or pairs of document and term.
SLICE = 2_000_000
PAIRS = 300_000
# Up to so many cells of documents and terms a pair are counted in place, which costs less than sorting the pairs.
CELLS_A_PAIR = 30
# Rows whose products are made at a time.
PRODUCT_ROWS = 128
# Shares of slices are sums of floats; this is far above what that can change.
SLACK = 1e-6


def _joined(spec: fx.TermSpec) -> Column:
    """Tokens (or, for runs of characters, what white space parts) with one space between them."""
    if spec.kind == "word":
        return F.array_join(fx.tokens(F.col("_text"), spec), " ")
    return F.regexp_replace(F.lower("_text"), r"(?U)\s+", " ")


def placed(docs: DataFrame, row_id: str, text: str, specs: list[fx.TermSpec], keep: tuple[str, ...] = ()) -> DataFrame:
    """``keep..., _id, _s0, _s1, ...``: rows of an id side by side, with the tokens for each spec. Tasks are those of ``term_counts``."""
    size = docs.agg(F.sum(F.length(text))).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // fx.TASK_CHARACTERS))
    rows = docs.select(*keep, F.col(row_id).alias("_id"), F.col(text).alias("_text"))
    rows = rows.repartition(parts, "_id").sortWithinPartitions("_id")
    return rows.select(*keep, "_id", *[_joined(spec).alias(f"_s{n}") for n, spec in enumerate(specs)])


def _starts(ids: pa.Array) -> np.ndarray:
    """Whether a row's id is another than that of the row before; nulls are one id."""
    if not len(ids):
        return np.empty(0, bool)
    a, b = ids.slice(1), ids.slice(0, len(ids) - 1)
    other = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
    return np.concatenate([[True], other.to_numpy(zero_copy_only=False).astype(bool)])


def _slices(batches: Iterator[pa.RecordBatch], n_specs: int) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Tables of whole documents, with about ``SLICE`` bytes of tokens for a spec or one document, and each row's document."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = (table if held is None else pa.concat_tables([held, table])).combine_chunks()
        sizes = sum(pc.fill_null(pc.binary_length(held.column(f"_s{n}")), 0).to_numpy() for n in range(n_specs)) / n_specs
        begin = np.flatnonzero(_starts(held.column("_id").combine_chunks()))
        group = (np.cumsum(sizes) - sizes)[begin] // SLICE
        cuts = [0, *begin[1:][group[1:] != group[:-1]]]
        for low, high in zip(cuts, cuts[1:]):
            yield _numbered(held.slice(low, high - low))
        held = held.slice(cuts[-1])
    if held is not None and held.num_rows:
        yield _numbered(held)


def _numbered(table: pa.Table) -> tuple[pa.Table, np.ndarray]:
    return table, np.cumsum(_starts(table.column("_id").combine_chunks())) - 1


def _ranges(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which range, and every number in it."""
    size = stops - starts
    which = np.repeat(np.arange(len(size)), size)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(size) - size - starts, size)


def _tokens(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Number of each token, its row, and the tokens by number."""
    lists = pc.split_pattern(pc.fill_null(column, "").combine_chunks(), " ")
    coded = pc.list_flatten(lists).dictionary_encode()
    code, names = coded.indices.to_numpy().astype(np.int64), coded.dictionary
    row = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
    blank = pc.index(names, "").as_py()
    return code[code != blank], row[code != blank], names


def _runs(symbol: np.ndarray, segment: np.ndarray, low: int, high: int, base: int, known: dict[int, np.ndarray], short: bool):
    """For each length ``n``: where runs of ``n`` symbols within a segment begin, their codes, and codes of the ``known`` rows of ``n`` symbols.

    Symbols are below ``base``. With ``short`` a segment of fewer than ``low`` symbols is a run itself.
    """
    at, code = np.arange(len(symbol)), symbol.astype(np.int64)
    size = np.bincount(segment, minlength=1) if len(segment) else np.zeros(1, int)
    told = {n: rows[:, 0].astype(np.int64) for n, rows in known.items()}
    for n in range(1, high + 1):
        if n > 1:
            if max((int(x.max()) for x in (code, *told.values()) if len(x)), default=0) >= 2**62 // base:  # ranks are as good as codes
                names, parts = [k for k in told if k >= n], [code, *[told[k] for k in told if k >= n]]
                ranks = np.unique(np.concatenate(parts), return_inverse=True)[1]
                code, *rest = np.split(ranks, np.cumsum([len(x) for x in parts])[:-1])
                told |= dict(zip(names, rest))
            fits = at + n - 1 < len(symbol)
            at, code = at[fits], code[fits]
            fits = segment[at] == segment[at + n - 1]
            at, code = at[fits], code[fits] * base + symbol[at[fits] + n - 1]
            told = {k: v * base + known[k][:, n - 1] if k >= n else v for k, v in told.items()}
        if n >= low:
            yield n, at, code, told.get(n, np.empty(0, np.int64))
        elif short:
            own = size[segment[at]] == n
            yield n, at[own], code[own], told.get(n, np.empty(0, np.int64))


def _matched(code: np.ndarray, known: np.ndarray) -> np.ndarray:
    """The place of each code in ``known``, or -1."""
    if not len(known):
        return np.full(len(code), -1)
    order = np.argsort(known, kind="stable")
    place = np.minimum(np.searchsorted(known[order], code), len(known) - 1)
    return np.where(known[order[place]] == code, order[place], -1)


def _sums(doc: np.ndarray, term: np.ndarray, weight: np.ndarray, n_terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Documents, terms and sums of weights, in order of document and term. Documents come in order."""
    if not len(doc):
        return doc, term, weight
    first = doc[0]
    key = (doc - first) * n_terms + term
    cells = int(doc[-1] - first + 1) * n_terms
    if cells <= CELLS_A_PAIR * len(key):
        total = np.bincount(key, weight, cells)
        key = np.flatnonzero(total > 0)
        total = total[key]
    else:
        order = np.argsort(key, kind="stable")
        key = key[order]
        start = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        key, total = key[start], np.add.reduceat(weight[order], start)
    return key // n_terms + first, key % n_terms, total


def _blocks(doc: np.ndarray, sizes: np.ndarray, most: int) -> Iterator[tuple[int, int]]:
    """Stretches of entries with about ``most`` in ``sizes``, or one document; documents come in order."""
    if not len(doc):
        return
    begin = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    group = (np.cumsum(sizes) - sizes)[begin] // most
    cuts = [0, *begin[1:][group[1:] != group[:-1]], len(doc)]
    yield from zip(cuts, cuts[1:])


class WordRuns:
    """Runs of tokens in a slice."""

    def __init__(self, column: pa.ChunkedArray, doc: np.ndarray, spec: fx.TermSpec):
        self.code, row, self.names = _tokens(column)
        self.row, self.doc, self.spec = row, doc[row], spec

    def counted(self, lengths: range, share_of: float | None = None, least: float = 0.0):
        """Terms of these lengths that occur at least ``least`` times the slice's share of ``share_of`` tokens: ``term, df, cf`` and the share."""
        share = 1.0 if share_of is None else max(0, len(self.code)) / share_of
        for n, at, code, _ in _runs(self.code, self.row, lengths.start, lengths.stop - 1, len(self.names) + 1, {}, False):
            if not len(at):
                continue
            _, first, which, cf = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
            often = np.flatnonzero(cf >= least * share - SLACK)
            place = np.full(len(cf), -1)
            place[often] = np.arange(len(often))
            which = place[which]
            pair = np.unique(which[which >= 0] * (int(self.doc[-1]) + 1) + self.doc[at[which >= 0]])
            df = np.bincount(pair // (int(self.doc[-1]) + 1), minlength=len(often))
            parts = [self.names.take(pa.array(self.code[at[first[often]] + j])) for j in range(n)]
            yield pc.binary_join_element_wise(*parts, " ") if n > 1 else parts[0], df, cf[often], share

    def terms(self, vocab: "Known") -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Documents, places in ``vocab`` and counts."""
        found = {n: np.stack([pc.fill_null(pc.index_in(p, self.names), -1).to_numpy() for p in parts], 1) for n, parts in vocab.parts.items()}
        docs, places = [], []
        for n, at, code, told in _runs(self.code, self.row, self.spec.low, self.spec.high, len(self.names) + 1, found, False):
            if n in found:
                told = np.where((found[n] >= 0).all(axis=1), told, -1 - np.arange(len(told)))
                place = _matched(code, told)
                docs.append(self.doc[at[place >= 0]])
                places.append(vocab.place[n][place[place >= 0]])
        if docs:
            doc, place = np.concatenate(docs), np.concatenate(places)
            order = np.argsort(doc, kind="stable")
            doc, place = doc[order], place[order]
            for low, high in _blocks(doc, np.ones(len(doc), np.int64), PAIRS):
                yield _sums(doc[low:high], place[low:high], np.ones(high - low), vocab.size)


class CharRuns:
    """Runs of characters of the words in a slice; a word is cut up once, and its runs count as often as it occurs."""

    def __init__(self, column: pa.ChunkedArray, doc: np.ndarray, spec: fx.TermSpec):
        code, row, names = _tokens(column)
        self.spec, n = spec, len(names)
        doc, self.word, self.times = _sums(doc[row], code, np.ones(len(code)), max(1, n)) if len(code) else (code, code, np.empty(0))
        self.doc, self.total = doc, np.bincount(code, minlength=n)
        text = "".join(f" {w} " for w in names.to_pylist())
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        self.seen = np.zeros(0x110000, np.int64)
        self.seen[points] = 1
        self.seen = np.cumsum(self.seen) * self.seen  # numbers of the slice's own characters, from 1
        self.base, self.symbol, self.points = int(self.seen.max(initial=0)) + 1, self.seen[points], points
        self.segment = np.repeat(np.arange(n), pc.utf8_length(names).to_numpy() + 2) if n else np.empty(0, int)

    def _pairs(self, word: np.ndarray, term: np.ndarray, n_terms: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Documents, terms and counts from the terms of each word."""
        order = np.argsort(word, kind="stable")
        word, term = word[order], term[order]
        start = np.searchsorted(word, np.arange(len(self.total) + 1))
        sizes = start[self.word + 1] - start[self.word]
        for low, high in _blocks(self.doc, sizes, PAIRS):
            which, at = _ranges(start[self.word[low:high]], start[self.word[low:high] + 1])
            yield _sums(self.doc[low:high][which], term[at], self.times[low:high][which], n_terms)

    def counted(self):
        """``term, df, cf`` of all terms, and a share of 1."""
        words, terms, strings, shift = [], [], [], 0
        for n, at, code, _ in _runs(self.symbol, self.segment, self.spec.low, self.spec.high, self.base, {}, True):
            if len(at):
                own, first, which = np.unique(code, return_index=True, return_inverse=True)
                words.append(self.segment[at])
                terms.append(which + shift)
                shift += len(own)
                each = np.ascontiguousarray(self.points[at[first][:, None] + np.arange(n)]).view(f"<U{n}").ravel()
                strings.append(pa.array(each.tolist(), pa.string()))
        if not words:
            return
        word, term = np.concatenate(words), np.concatenate(terms)
        cf = np.bincount(term, self.total[word], shift).astype(np.int64)
        df = np.zeros(shift, np.int64)
        for _, found, _ in self._pairs(word, term, shift):
            df += np.bincount(found, minlength=shift)
        used = np.flatnonzero(cf)  # a blank between words is no word
        yield pa.concat_arrays(strings).take(pa.array(used)), df[used], cf[used], 1.0

    def terms(self, vocab: "Known") -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        found = {n: self.seen[rows] for n, rows in vocab.parts.items()}
        words, places = [], []
        for n, at, code, told in _runs(self.symbol, self.segment, self.spec.low, self.spec.high, self.base, found, True):
            if n in found:
                told = np.where((found[n] > 0).all(axis=1), told, -1 - np.arange(len(told)))
                place = _matched(code, told)
                words.append(self.segment[at[place >= 0]])
                places.append(vocab.place[n][place[place >= 0]])
        if words:
            yield from self._pairs(np.concatenate(words), np.concatenate(places), vocab.size)


@dataclass
class Known:
    """Terms by length, as tokens or characters, with their place; and each place's ``idf``."""

    parts: dict
    place: dict[int, np.ndarray]
    size: int
    idf: np.ndarray

    @staticmethod
    def of(spec: fx.TermSpec, terms: list[str], places: np.ndarray, idf: np.ndarray) -> "Known":
        cut = [x.split(" ") if spec.kind == "word" else x for x in terms]
        parts, place = {}, {}
        for n in {len(x) for x in cut}:
            own = [i for i, x in enumerate(cut) if len(x) == n]
            if spec.kind == "word":
                parts[n] = [pa.array([cut[i][j] for i in own], pa.string()) for j in range(n)]
            else:
                parts[n] = np.array([[ord(c) for c in cut[i]] for i in own], np.int64)
            place[n] = places[own]
        return Known(parts, place, len(terms), idf)


def _read(column: pa.ChunkedArray, doc: np.ndarray, spec: fx.TermSpec) -> WordRuns | CharRuns:
    return (WordRuns if spec.kind == "word" else CharRuns)(column, doc, spec)


_COUNTS = "spec int, term string, df long, cf long, share double"


def _counting(specs: list[fx.TermSpec], step):
    """A map over ``placed`` rows that sends what ``step(spec number, slice's runs)`` yields: ``term, df, cf, share``."""

    def run(batches):
        for table, doc in _slices(batches, len(specs)):
            for n, spec in enumerate(specs):
                for term, df, cf, share in step(n, lambda n=n, spec=spec: _read(table.column(f"_s{n}"), doc, spec)):
                    yield pa.record_batch(
                        [pa.array(np.full(len(df), n, np.int32)), term, pa.array(df.astype(np.int64)), pa.array(cf.astype(np.int64)), pa.array(np.full(len(df), share))],
                        ["spec", "term", "df", "cf", "share"])

    return run


def _totals(rows: DataFrame, specs: list[fx.TermSpec], step, min_df: int = 0) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("df", "cf", "share")]
    told = rows.mapInArrow(_counting(specs, step), _COUNTS).groupBy("spec", "term").agg(*sums)
    return materialize(told.where(F.col("df") >= min_df), "term-totals")


def _last_count(totals: DataFrame, spec: fx.TermSpec) -> int:
    """The count of the last of the most frequent terms; if there are fewer, the least that a term may have."""
    top = totals.where(F.col("df") >= spec.min_df).orderBy(F.desc("cf")).limit(spec.max_features)
    found = top.agg(F.count("*").alias("n"), F.min("cf").alias("least")).first()
    return found["least"] if found["n"] == spec.max_features else max(1, spec.min_df)


def vocabularies(rows: DataFrame, doc_count: DataFrame, specs: list[fx.TermSpec]) -> list[DataFrame]:
    """What ``features.vocabulary`` gives, for each spec; ``rows`` are ``placed`` and, as they are read up to four times, best held. All specs limit their terms."""
    rows = rows.select("_id", *[f"_s{n}" for n in range(len(specs))])
    short = lambda n, runs: runs().counted(range(specs[n].low, specs[n].low + 1)) if specs[n].kind == "word" else runs().counted()
    first = _totals(rows, specs, short, min(spec.min_df for spec in specs))
    found = [first.where(F.col("spec") == n).drop("spec", "share") for n in range(len(specs))]
    longer = [n for n, spec in enumerate(specs) if spec.kind == "word" and spec.high > spec.low]
    if longer:
        for n, more in _longer(rows, specs, longer, found).items():
            found[n] = found[n].unionByName(more)
    return [materialize(fx.chosen(totals, doc_count, spec), "vocabulary") for totals, spec in zip(found, specs)]


def _longer(rows: DataFrame, specs: list[fx.TermSpec], which: list[int], found: list[DataFrame]) -> dict[int, DataFrame]:
    """``term, df, cf`` of the longer runs of words that may be among the most frequent terms."""
    rest = {n: range(specs[n].low + 1, specs[n].high + 1) for n in which}
    least = {n: _last_count(found[n], specs[n]) for n in which}
    tokens = _token_counts(rows, specs, which)
    some = _totals(rows, specs, lambda n, runs: runs().counted(rest[n], max(1.0, tokens[n]), least[n]) if n in rest else ())
    out, known = {}, {}
    for n in which:
        own = some.where(F.col("spec") == n).drop("spec")
        floor = _last_count(found[n].unionByName(own.drop("share")), specs[n])
        highest = F.col("cf") + least[n] * F.greatest(F.lit(0.0), 1.0 - F.col("share"))
        terms = [r[0] for r in own.where(highest >= floor - SLACK).select("term").toLocalIterator()]
        known[n] = Known.of(specs[n], terms, np.arange(len(terms)), np.empty(0))
        known[n].names = pa.array(terms, pa.string())
    shared = rows.sparkSession.sparkContext.broadcast(known)

    def exact(n, runs):
        if n in shared.value and shared.value[n].size:
            vocab = shared.value[n]
            df, cf = np.zeros(vocab.size, np.int64), np.zeros(vocab.size, np.int64)
            for _, place, times in runs().terms(vocab):
                df += np.bincount(place, minlength=vocab.size)
                cf += np.bincount(place, times, vocab.size).astype(np.int64)
            used = np.flatnonzero(cf)
            yield vocab.names.take(pa.array(used)), df[used], cf[used], 1.0

    whole = _totals(rows, specs, exact)
    return {n: whole.where(F.col("spec") == n).drop("spec", "share") for n in which}


def _token_counts(rows: DataFrame, specs: list[fx.TermSpec], which: list[int]) -> dict[int, int]:
    def run(batches):
        for table, doc in _slices(batches, len(specs)):
            yield pa.record_batch([pa.array(which, pa.int32()), pa.array([len(_tokens(table.column(f"_s{n}"))[0]) for n in which], pa.int64())], ["spec", "n"])

    counted = rows.mapInArrow(run, "spec int, n long").groupBy("spec").agg(F.sum("n").alias("n")).collect()
    return {n: 0 for n in which} | {r["spec"]: r["n"] for r in counted}


def _weighed(vocab: Known, spec: fx.TermSpec, runs, n_docs: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Where each document's entries begin, places, counts and unit-length weights; and the lengths of documents before that."""
    parts = list(runs.terms(vocab)) if vocab.size else []
    doc, place, tf = (np.concatenate(x) for x in zip(*parts)) if parts else (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))
    weight = (1.0 + np.log(tf) if spec.sublinear else tf) * vocab.idf[place]
    size = np.sqrt(np.bincount(doc, weight * weight, n_docs))
    return np.searchsorted(doc, np.arange(n_docs + 1)), place, tf, weight / size[doc], size


def broadcast_known(vocabs: list[DataFrame], specs: list[fx.TermSpec]):
    """The vocabularies, at most ``max_features`` terms each, for the tasks."""
    known = []
    for vocab, spec in zip(vocabs, specs):
        rows = vocab.select("term", "idx", "idf").orderBy("idx").toArrow()
        idx = rows.column("idx").to_numpy().astype(np.int64)
        idf = rows.column("idf").to_numpy().astype(float)
        known.append(Known.of(spec, rows.column("term").to_pylist(), idx, idf))
    return vocabs[0].sparkSession.sparkContext.broadcast(known)


def weighed_slices(batches, shared, specs: list[fx.TermSpec]):
    """For ``placed`` rows of a task: tables, each row's document, whether its id is null, and what ``_weighed`` tells for each spec."""
    for table, doc in _slices(batches, len(specs)):
        n_docs = int(doc[-1]) + 1
        each = [_weighed(vocab, spec, _read(table.column(f"_s{n}"), doc, spec), n_docs) for n, (vocab, spec) in enumerate(zip(shared.value, specs))]
        yield table, doc, table.column("_id").is_null().to_numpy(), each


def _by_row(start: np.ndarray, doc: np.ndarray, gone: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, ...]:
    """Where each row's entries begin, and its parts of ``values``: those of its document, or none where the id is null."""
    if len(doc) == len(start) - 1 and not gone.any():
        return start, *values
    high = np.where(gone, start[doc], start[doc + 1])
    _, at = _ranges(start[doc], high)
    return np.concatenate([[0], np.cumsum(high - start[doc])]), *(x[at] for x in values)


def _list(start: np.ndarray, values: np.ndarray) -> pa.Array:
    """A list for each row; null for an empty one."""
    offsets = pa.array(start.astype(np.int32), mask=np.concatenate([start[1:] == start[:-1], [False]]))
    return pa.ListArray.from_arrays(offsets, pa.array(values))


def vectors(docs: DataFrame, row_id: str, text: str, vocabs: list[DataFrame], specs: list[fx.TermSpec], names: list[tuple[str, str]]) -> DataFrame:
    """``docs`` without the text, with places and unit-length weights for each spec, null where no term is known or the id is null."""
    keep = tuple(c for c in docs.columns if c != text)
    shared = broadcast_known(vocabs, specs)

    def run(batches):
        for table, doc, gone, each in weighed_slices(batches, shared, specs):
            out = {c: table.column(c).combine_chunks() for c in keep}
            for (idx, val), (start, place, _, weight, _) in zip(names, each):
                start, place, weight = _by_row(start, doc, gone, place.astype(np.int32), weight)
                out[idx], out[val] = _list(start, place), _list(start, weight)
            yield from pa.table(out).to_batches(max_chunksize=1_000)

    rows = placed(docs, row_id, text, specs, keep)
    schema = docs.select(*keep).schema
    for idx, val in names:
        schema = schema.add(idx, T.ArrayType(T.IntegerType())).add(val, T.ArrayType(T.DoubleType()))
    return rows.mapInArrow(run, schema)


def _side_by_side(doc: np.ndarray, gone: np.ndarray, each: list, sizes: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where each row's entries begin, places and weights, with the specs' places one after another."""
    starts, places, weights, shift = [], [], [], 0
    for (start, place, _, weight, _), size in zip(each, sizes):
        start, place, weight = _by_row(start, doc, gone, place + shift, weight)
        starts.append(start)
        places.append(place)
        weights.append(weight)
        shift += size
    row = np.concatenate([np.repeat(np.arange(len(doc)), np.diff(start)) for start in starts])
    order = np.argsort(row, kind="stable")
    return sum(starts), np.concatenate(places)[order], np.concatenate(weights)[order]


def packed(rows: DataFrame, vocabs: list[DataFrame], specs: list[fx.TermSpec], label: str, fold: str) -> DataFrame:
    """``rows``: ``placed`` documents as ``solver.pack`` packs them; ``label`` and ``fold`` are whole numbers."""
    shared = broadcast_known(vocabs, specs)

    def run(batches):
        for table, doc, gone, each in weighed_slices(batches, shared, specs):
            shift, parts, offsets = 0, [], []
            for (start, place, tf, _, length), vocab in zip(each, shared.value):
                start, place, tf = _by_row(start, doc, gone, place, tf)
                parts.append((start, place, tf, length[doc]))
                offsets.append(shift)
                shift += vocab.size
            y, f = (table.column(c).to_numpy().astype(np.int64) for c in (label, fold))
            yield pa.record_batch([pa.array(list(solver.pack(y, f, parts, offsets)), pa.binary())], ["rows"])

    return rows.mapInArrow(run, "rows binary")


def unpacked(rows: DataFrame, idf: np.ndarray, sublinear: list[bool]) -> DataFrame:
    """``y, fold, features`` of packed rows, one sparse vector each."""
    schema = T.StructType([T.StructField("y", T.DoubleType()), T.StructField("fold", T.IntegerType()), T.StructField("features", VectorUDT())])
    shared, size = rows.sparkSession.sparkContext.broadcast(idf), len(idf)

    def run(batches):
        for batch in batches:
            for raw in batch.column(0):
                y, fold, start, place, weight = solver.unpack(raw.as_py(), shared.value, sublinear)
                offsets, n = pa.array(start.astype(np.int32)), len(y)
                parts = [
                    pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, size, np.int32)),
                    pa.ListArray.from_arrays(offsets, pa.array(place.astype(np.int32))), pa.ListArray.from_arrays(offsets, pa.array(weight)),
                ]
                vector = pa.StructArray.from_arrays(parts, ["type", "size", "indices", "values"])
                yield pa.record_batch([pa.array(y.astype(float)), pa.array(fold.astype(np.int32)), vector], ["y", "fold", "features"])

    return rows.mapInArrow(run, schema)


def margins(docs: DataFrame, row_id: str, text: str, vocabs: list[DataFrame], specs: list[fx.TermSpec], matrix: np.ndarray, shift: np.ndarray, output: str) -> DataFrame:
    """``docs`` with the products of their vectors and the columns of ``matrix``, one for each, with ``shift`` added."""
    names = [c for c in docs.columns if c != text]
    shared, linear = broadcast_known(vocabs, specs), docs.sparkSession.sparkContext.broadcast((matrix, shift))

    def run(batches):
        matrix, shift = linear.value
        for table, doc, gone, each in weighed_slices(batches, shared, specs):
            start, place, weight = _side_by_side(doc, gone, each, [v.size for v in shared.value])
            told = _products(start, place, weight, matrix, shift)
            values = pa.ListArray.from_arrays(pa.array(np.arange(len(doc) + 1, dtype=np.int32) * len(shift)), pa.array(told.ravel()))
            out = {c: table.column(c).combine_chunks() for c in names} | {output: values}
            yield from pa.table(out).to_batches(max_chunksize=10_000)

    return placed(docs, row_id, text, specs, tuple(names)).mapInArrow(run, docs.select(*names).schema.add(output, T.ArrayType(T.DoubleType())))


def held_out(rows: DataFrame, matrix: np.ndarray, shift: np.ndarray, k: int, idf: np.ndarray, sublinear: list[bool]) -> DataFrame:
    """``y, fold, m``: the margins of packed rows for the ``k`` classes of the fit that left their fold out."""
    shared = rows.sparkSession.sparkContext.broadcast((matrix, shift, idf))

    def run(batches):
        matrix, shift, idf = shared.value
        for batch in batches:
            for raw in batch.column(0):
                y, fold, start, place, weight = solver.unpack(raw.as_py(), idf, sublinear)
                told = _products(start, place, weight, matrix, shift).reshape(len(y), -1, k)[np.arange(len(y)), fold]
                values = pa.ListArray.from_arrays(pa.array(np.arange(len(y) + 1, dtype=np.int32) * k), pa.array(told.ravel()))
                yield pa.record_batch([pa.array(y.astype(float)), pa.array(fold.astype(np.int32)), values], ["y", "fold", "m"])

    return rows.mapInArrow(run, "y double, fold int, m array<double>")


def _products(start: np.ndarray, place: np.ndarray, weight: np.ndarray, matrix: np.ndarray, shift: np.ndarray) -> np.ndarray:
    told = np.tile(shift, (len(start) - 1, 1))
    for low in range(0, len(told), PRODUCT_ROWS):
        begin = start[low : low + PRODUCT_ROWS + 1]
        own = np.flatnonzero(begin[1:] > begin[:-1])
        if len(own):
            part = slice(begin[0], begin[-1])
            told[low + own] += np.add.reduceat(matrix[place[part]] * weight[part, None], (begin[:-1] - begin[0])[own])
    return told
