"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1. An n-gram's vector binds its letters' vectors: each is permuted
(rotated) by its place and they are multiplied. A text's vector is the bundle (sum) of its n-grams' vectors, a
language's prototype that of all its texts in training. A text gets the language with the largest cosine.

Letters are lower-cased; every run of other characters counts as one blank, and each text begins and ends with one.
Before the comparison the mean of the unit prototypes is taken from each of them, so that what all languages share
does not decide. Vectors are whole numbers throughout, hence the order in which rows arrive changes nothing.

What is broadcast is one vector for each language; ``max_languages`` bounds it, and fitting fails beyond it.

Defined results. A text that is null or has no letter gets ``und`` with score 0. Training skips such texts, rows with
a null language and rows that ``use`` leaves out (null included). Very long texts are whole. Repeated rows count each time; columns that are
not named do not matter, and added ones are renamed where they clash. An empty table gives an empty result. Without any training row all texts get ``und``.
Ties go to the language that sorts first. The score is the cosine between the text and the centred prototype,
0 where it is negative.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseflow.llm.tables import distinct_name, materialize
from caseflow.llm.words import small_batches

DIM = 1024
GRAM = 3
PART_CHARS = 1 << 19
RUN_CHARS = 1 << 18
SLICE = 1 << 20
TEXTS = 48
GRAMS = 1024
UNKNOWN = "und"


@lru_cache(1)
def _letters() -> np.ndarray:
    """A flag for each code point: is it a letter?"""
    return np.fromiter((unicodedata.category(chr(c))[0] == "L" for c in range(0x110000)), bool, 0x110000)


class Vectors:
    """Random vectors of letters and bound vectors of n-grams, alike in every process."""

    def __init__(self, dim: int, gram: int):
        self.dim, self.gram = dim, gram
        self.known: dict[int, np.ndarray] = {}

    def letter(self, code: int) -> np.ndarray:
        if code not in self.known:
            bits = np.random.Generator(np.random.PCG64(1_000_003 * code + 17)).integers(0, 2, self.dim, dtype=np.int8)
            self.known[code] = (bits * 2 - 1).astype(np.int8)
        return self.known[code]

    def bound(self, codes: np.ndarray) -> np.ndarray:
        """Vectors (rows) of n-grams given as rows of code points."""
        alphabet, place = np.unique(codes, return_inverse=True)
        table = np.stack([self.letter(int(c)) for c in alphabet])
        place = place.reshape(codes.shape)
        result = np.roll(table, self.gram - 1, axis=1)[place[:, 0]]
        for k in range(1, self.gram):
            result = result * np.roll(table, self.gram - 1 - k, axis=1)[place[:, k]]
        return result


def _code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased texts as code points, other characters as single blanks; where each text starts."""
    joined = "\x00" + "\x00".join(t.replace("\x00", " ") for t in texts).lower() + "\x00"
    codes = np.frombuffer(joined.encode("utf-32-le", "replace"), np.uint32).astype(np.int32)
    ends = codes == 0
    codes[~_letters()[codes]] = 32
    keep = (codes != 32) | ends | ~np.r_[False, codes[:-1] == 32]
    codes, ends = codes[keep], ends[keep]
    return codes, np.flatnonzero(ends)


def _packed(place: np.ndarray, base: int, gram: int) -> np.ndarray:
    """One number for each run of ``gram`` places in an alphabet of ``base`` letters."""
    size = len(place) - gram + 1
    packed = np.zeros(size, np.int64)
    for k in range(gram):
        packed *= base
        packed += place[k : k + size]
    return packed


def _gram_counts(codes: np.ndarray, at: np.ndarray, gram: int) -> tuple[np.ndarray, ...]:
    """The alphabet, the different n-grams over it, and how often each text has which of them, by text.

    What is needed on the way is free once this returns, before any vectors are made.
    """
    n, size = len(at) - 1, len(codes) - gram + 1
    alphabet, place = np.unique(codes, return_inverse=True)
    packed = _packed(place, len(alphabet), gram)
    del place
    starts = np.arange(size, dtype=np.int32)
    text = (np.searchsorted(at, starts, "right") - 1).astype(np.int32)
    inside = starts + np.int32(gram - 1) <= at.astype(np.int32)[np.minimum(text + 1, n)]
    packed, text = packed[inside], text[inside]
    del starts, inside
    grams, which = np.unique(packed, return_inverse=True)
    del packed
    which += text.astype(np.int64) * len(grams)
    del text
    pair, count = np.unique(which, return_counts=True)
    del which
    return alphabet, grams, (pair // len(grams)).astype(np.int32), (pair % len(grams)).astype(np.int32), count.astype(np.int32)


def text_vectors(texts: list[str], vectors: Vectors) -> tuple[np.ndarray, np.ndarray]:
    """A vector for each text (float64, whole numbers), and which texts have a letter."""
    codes, at = _code_points(texts)
    n, g = len(texts), vectors.gram
    result = np.zeros((n, vectors.dim))
    lettered = np.add.reduceat(codes != 32, at[:-1]) > 0 if n else np.zeros(0, bool)
    if len(codes) < g:
        return result, lettered
    alphabet, grams, whose, which, count = _gram_counts(codes, at, g)
    del codes
    for low in range(0, len(grams), GRAMS):
        own = grams[low : low + GRAMS]
        letters = np.stack([alphabet[(own // len(alphabet) ** (g - 1 - k)) % len(alphabet)] for k in range(g)], axis=1)
        bound = vectors.bound(letters).astype(np.float32)
        for first in range(0, n, TEXTS):
            last = min(n, first + TEXTS)
            a, b = np.searchsorted(whose, [first, last])
            chosen = slice(a, b)
            here = (which[chosen] >= low) & (which[chosen] < low + len(own))
            counts = np.zeros((last - first, len(own)), np.float32)
            counts[whose[chosen][here] - first, which[chosen][here] - low] = count[chosen][here]
            result[first:last] += counts @ bound  # exact: whole numbers below 2**24
    return result, lettered


def _long_vector(text: str, vectors: Vectors) -> tuple[np.ndarray, bool]:
    """The same vector for one long text, from pieces: the last letters of a piece are carried to the next one."""
    g, total, lettered = vectors.gram, np.zeros(vectors.dim), False
    held = np.array([32], np.int32)
    for low in range(0, len(text) + 1, PART_CHARS):
        codes = np.frombuffer(text[low : low + PART_CHARS].lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int32)
        codes[~_letters()[codes]] = 32
        codes = codes[(codes != 32) | (np.r_[held[-1], codes[:-1]] != 32)]
        if low + PART_CHARS > len(text):
            codes = np.r_[codes, np.int32(32)]
        lettered = lettered or bool((codes != 32).any())
        held = np.r_[held, codes]
        if len(held) < g:
            continue
        alphabet, place = np.unique(held, return_inverse=True)
        packed = np.zeros(len(held) - g + 1, np.int64)
        for k in range(g):
            packed = packed * len(alphabet) + place[k : k + len(packed)]
        grams, count = np.unique(packed, return_counts=True)
        for first in range(0, len(grams), GRAMS):
            own = grams[first : first + GRAMS]
            letters = np.stack([alphabet[(own // len(alphabet) ** (g - 1 - k)) % len(alphabet)] for k in range(g)], axis=1)
            total += count[first : first + GRAMS].astype(np.float32) @ vectors.bound(letters).astype(np.float32)
        held = held[len(held) - g + 1 :]
    return total, lettered


def _parts(texts: list[str | None]):
    """Runs of texts of about RUN_CHARS characters; a longer text is a run of its own."""
    run, first, total = [], 0, 0
    for k, text in enumerate(texts):
        text = text or ""
        if run and total + len(text) > RUN_CHARS:
            yield first, run
            run, first, total = [], k, 0
        run.append(text)
        total += len(text)
    if run:
        yield first, run


def _vectors_of(texts: list[str | None], vectors: Vectors):
    """``first, vectors, has a letter`` for runs of texts. A very long text is taken in pieces, with the same result."""
    for first, run in _parts(texts):
        if len(run) == 1 and len(run[0]) > 2 * PART_CHARS:
            total, lettered = _long_vector(run[0], vectors)
            yield first, total[None, :], np.array([lettered])
        else:
            yield (first, *text_vectors(run, vectors))


class LanguageModel:
    """Prototypes by language, in the order of the names."""

    def __init__(self, names: list[str], prototypes: np.ndarray, dim: int, gram: int):
        self.names, self.dim, self.gram = names, dim, gram
        unit = prototypes / np.maximum(np.linalg.norm(prototypes, axis=1, keepdims=True), 1e-12)
        centred = unit - unit.mean(axis=0) if len(names) > 1 else unit
        self.prototypes = np.rint(centred * 2**20)  # whole numbers: dot products are exact
        self.norms = np.maximum(np.linalg.norm(self.prototypes, axis=1), 1e-12)

    def predict(self, docs: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
        """The documents' columns with ``lang_pred`` and ``score`` (renamed if the names are taken)."""
        keep = list(docs.columns) if keep is None else keep
        names = [distinct_name(keep, x) for x in ("lang_pred", "score")]
        carried = list(dict.fromkeys([*keep, text_col]))
        source = docs.select(*carried)
        schema = source.select(*keep).withColumn(names[0], F.lit("")).withColumn(names[1], F.lit(0.0)).schema
        shared = docs.sparkSession.sparkContext.broadcast((self.names, self.prototypes, self.norms, self.dim, self.gram))

        def tell(batches):
            languages, prototypes, norms, dim, gram = shared.value
            vectors = Vectors(dim, gram)
            for batch in small_batches(batches, text_col, SLICE):
                best = [UNKNOWN] * batch.num_rows
                score = np.zeros(batch.num_rows)
                texts = batch.column(batch.schema.get_field_index(text_col)).to_pylist()
                for first, found, lettered in _vectors_of(texts, vectors) if languages else ():
                    cosine = (found @ prototypes.T) / norms / np.maximum(np.sqrt((found * found).sum(axis=1)), 1e-12)[:, None]
                    for k in np.flatnonzero(lettered):
                        top = int(np.argmax(cosine[k]))
                        best[first + k], score[first + k] = languages[top], min(1.0, max(0.0, float(cosine[k, top])))
                columns = [batch.column(batch.schema.get_field_index(c)) for c in keep]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(best, pa.string()), pa.array(score)], [*keep, *names])

        return source.mapInArrow(tell, schema)


def fit(
    docs: DataFrame, use: Column | None = None, text_col: str = "text", lang_col: str = "lang", dim: int = DIM,
    gram: int = GRAM, max_languages: int = 1000,
) -> LanguageModel:
    """Prototypes from all rows with a language for which ``use`` holds. Sums are exact and need no order."""
    rows = docs.where(F.col(lang_col).isNotNull() if use is None else F.col(lang_col).isNotNull() & use)
    rows = rows.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))

    def bundle(batches):
        vectors, totals = Vectors(dim, gram), {}
        for batch in small_batches(batches, "text", SLICE):
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            for first, found, lettered in _vectors_of(batch.column(1).to_pylist(), vectors):
                for lang in set(langs[first : first + len(found)][lettered]):
                    own = lettered & (langs[first : first + len(found)] == lang)
                    totals[lang] = totals.get(lang, 0) + found[own].sum(axis=0)
        for lang, total in totals.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * dim), pa.array(np.arange(dim, dtype=np.int32)), pa.array(total.astype(np.int64))], ["lang", "k", "v"]
            )

    sums = materialize(rows.mapInArrow(bundle, "lang string, k int, v long").groupBy("lang", "k").agg(F.sum("v").alias("v")), "prototypes")
    names = [r["lang"] for r in sums.where("k = 0").select("lang").limit(max_languages + 1).collect()]
    if len(names) > max_languages:
        raise ValueError(f"more than {max_languages} languages; raise max_languages if that many prototypes fit a task")
    names.sort()
    prototypes, place = np.zeros((len(names), dim)), {name: k for k, name in enumerate(names)}
    for row in sums.collect():
        prototypes[place[row["lang"]], row["k"]] = row["v"]
    return LanguageModel(names, prototypes, dim, gram)


def fold(folds: int, id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``folds``; null for a null id."""
    return F.pmod(F.crc32(F.col(id_col).cast("string").cast("binary")), F.lit(folds))


def report(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, lang_pred, score``; learns from the rows outside fold 2 of 4."""
    model = fit(docs, use=fold(4) != 2)
    told = model.predict(docs.select("doc_id", "text"), keep=["doc_id"])
    return told.select("doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def keep_identified(docs: DataFrame, min_score: float = 0.0, as_stated: bool = False) -> DataFrame:
    """The documents whose language could be told with at least ``min_score``; whole rows, columns as they were.

    With ``as_stated``, documents go too whose ``lang`` names another language than the text is told to be in.

    Learns from the documents' own ``lang`` column. Without any such row nothing can be told apart, and
    the documents with a letter stay.
    """
    model = fit(docs)
    if not model.names:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    told = model.predict(docs)
    pred, score = told.columns[-2:]
    kept = (F.col(pred) != UNKNOWN) & (F.col(score) >= min_score)
    if as_stated:
        kept &= F.col("lang").isNull() | (F.col("lang").cast("string") == F.col(pred))
    return told.where(kept).select(*docs.columns)
