"""Spelling variants: words one edit apart, and the frequent form behind each.

One inserted, deleted or replaced letter changes a word's letter counts by an L1 distance of one or two, so the words near
a word lie in a small box around its letter counts. K-d trees over the counts, one a word length, find them: a search for
replaced letters goes through the tree of the word's own length with radius two, one for inserted letters through the tree
of the next length with radius one, and boxes further away are pruned. Whether the letters also stand in the right order is
then checked: without the letter that only one has, both words must be the same, with that letter at the same place.

How it runs: a bounded sample of the words (``SAMPLE``, by hash) splits each length into cells of about ``CELL`` words; the split only says
where a word goes, every word is placed and searched for. The boxes of cells are exact, taken over all words. A word goes to
its own cell, and as a question to each cell whose box its search reaches. In a cell's task a K-d tree over
the different letter counts answers all questions. A cell with more words than the sample foretold, for instance of
anagrams, which no split can part, is cut into tiles by hash, and its questions go to each tile. Order is checked by looking up hashes of words without a letter,
so words with the same letters are not compared pair by pair. Forms are followed by joining the table of forms with itself, as many times
as the logarithm of the longest chain.

The trees (at most ``SAMPLE`` leaves) and the boxes and tile numbers of their cells are sent to the tasks with the code. Nothing is
broadcast by the word.

Defined results:

- Null and empty texts have no words; very long texts and very long words are whole. A null id counts as the empty string.
- A word's near words are different words, so repeated rows only raise counts. Among near words of equal counts the form is the smallest in code-point order.
- Forms have at least ten times the count, so following them ends.
- An empty table gives an empty result. Only the named columns are read, whatever the others are called.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseflow.llm.kdtree import KdTree
from caseflow.llm.tables import materialize

LEAST_LENGTH = 7
LEAST_COUNT = 2
DAMAGE = 31
FACTOR = 10
#: Words at most from which cells are split, words expected a cell, and a tile's words and letters at most.
SAMPLE = 1 << 16
CELL = 4096
TILE_WORDS = 1 << 14
TILE_LETTERS = 1 << 20
#: Letters a-z have a dimension each; the others share six.
WIDTH = 32
LEAF = 16
ASKED = 1 << 15
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

_DIM = np.zeros(256, np.int64)
_DIM[97:123] = np.arange(26)
_DIM[0xC0:] = 26 + np.arange(64) % 6
_U = np.uint64
BASE = 0x9E3779B97F4A7C15


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, n`` of all damaged runs of at least ``LEAST_LENGTH`` letters that occur ``LEAST_COUNT`` times."""
    run = rf"regexp_extract_all(text, '[A-Za-z\\u00C0-\\u00FF]{{{LEAST_LENGTH},}}', 0)"
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.col(text_col).cast("string").alias("text"))
    runs = runs.select("id", F.explode(F.expr(run)).alias("run"))
    low = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run"))
    hashed = runs.select(low.alias("run"), F.crc32(F.concat("id", F.lit(":"), low).cast("binary")).alias("h"))
    damaged = F.expr(f"if(h % {DAMAGE} = 0, concat(left(run, int(h % length(run))), substring(run, int(h % length(run)) + 2)), run)")
    words = hashed.select(damaged.alias("word")).where(F.length("word") >= LEAST_LENGTH)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


class _Words:
    """Letters of words, longest buffer first: ``rows(length)`` gives those of one length as a matrix."""

    def __init__(self, column: pa.Array):
        texts = column.to_pylist()
        self.sizes = np.array([len(t) for t in texts], np.int64)
        self.flat = np.frombuffer("".join(texts).encode("latin-1"), np.uint8)
        self.starts = np.cumsum(self.sizes) - self.sizes

    def lengths(self):
        """``length, rows, letters`` for each length."""
        for length in np.unique(self.sizes).tolist():
            rows = np.flatnonzero(self.sizes == length)
            yield length, rows, self.flat[self.starts[rows][:, None] + np.arange(length)]


def _vectors(letters: np.ndarray) -> np.ndarray:
    n, length = letters.shape
    return np.bincount((np.arange(n)[:, None] * WIDTH + _DIM[letters]).ravel(), minlength=n * WIDTH).reshape(n, WIDTH).astype(np.int32)


class Cells:
    """K-d trees by word length over a sample. A cell is a leaf's number over all trees, or -length where there is no tree."""

    def __init__(self, sample: pa.Array, total: int):
        self.trees, self.first, self.tiles, number = {}, {}, {}, 0
        leaf = max(1, CELL * len(sample) // max(1, total))
        for length, _, letters in _Words(sample).lengths():
            self.trees[length], self.first[length] = KdTree(_vectors(letters), leaf), number
            number += len(self.trees[length].leaves)

    def home(self, length: int, vectors: np.ndarray) -> np.ndarray:
        tree = self.trees.get(length)
        return np.full(len(vectors), -length) if tree is None else tree.place(vectors) + self.first[length]

    def reached(self, length: int, vectors: np.ndarray, radius: int):
        """``cell, rows``: the cells of words of a length that may hold a vector within ``radius``."""
        if length not in self.trees:
            yield -length, np.arange(len(vectors))
            return
        for leaf, rows in self.trees[length].reached(vectors, radius):
            yield leaf + self.first[length], rows

    def sizes(self, words: DataFrame) -> DataFrame:
        """``cell, n, letters, low0.., high0..``: size and box of each cell, over all words."""
        names = [f"{kind}{k}" for kind in ("low", "high") for k in range(WIDTH)]

        def measure(batches):
            for batch in batches:
                for length, _, letters in _Words(batch.column(0)).lengths():
                    vectors = _vectors(letters)
                    homes = self.home(length, vectors)
                    order = np.argsort(homes, kind="stable")
                    cells, at = np.unique(homes[order], return_index=True)
                    n = np.diff(np.append(at, len(homes)))
                    low, high = (f.reduceat(vectors[order], at, axis=0) for f in (np.minimum, np.maximum))
                    columns = [cells, n, n * length, *low.T, *high.T]
                    yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], ["cell", "n", "letters", *names])

        found = words.select("word").mapInArrow(measure, ", ".join(f"{c} long" for c in ("cell", "n", "letters", *names)))
        sums = [F.sum("n").alias("n"), F.sum("letters").alias("letters")]
        return found.groupBy("cell").agg(*sums, *((F.min if c[0] == "l" else F.max)(c).alias(c) for c in names))

    def measure(self, words: DataFrame) -> None:
        """Takes exact boxes of all leaves, and the number of tiles of each cell that needs more than one."""
        large = (F.col("n") > TILE_WORDS) | (F.col("letters") > TILE_LETTERS)
        found = {r["cell"]: r for r in self.sizes(words).where((F.col("cell") >= 0) | large).collect()}
        for length, tree in self.trees.items():
            own = [found[self.first[length] + k] for k in range(len(tree.leaves))]
            tree.set_boxes(*(np.array([[r[f"{kind}{k}"] for k in range(WIDTH)] for r in own]) for kind in ("low", "high")))
        for cell, r in found.items():
            tiles = max(-(-r["n"] // TILE_WORDS), -(-r["letters"] // TILE_LETTERS))
            if tiles > 1:
                self.tiles[cell] = int(min(tiles, r["n"]))


def _tile(letters: np.ndarray) -> np.ndarray:
    total = np.zeros(len(letters), _U)
    for k in range(letters.shape[1]):
        total = (total ^ letters[:, k]) * _U(0x9E3779B97F4A7C15)
        total ^= total >> _U(29)
    return (total >> _U(8)).astype(np.int64)


def _deal(words: DataFrame, cells: Cells) -> DataFrame:
    """``cell, tile, role, word, n``: role 0 in a word's own tile, 1 where it asks for replaced and 2 for inserted letters."""

    def deal(batches):
        for batch in batches:
            for length, at, letters in _Words(batch.column(0)).lengths():
                vectors, out = _vectors(letters), []
                homes, mark = cells.home(length, vectors), _tile(letters)
                own = mark % np.array([cells.tiles.get(c, 1) for c in homes.tolist()])
                out.append((np.arange(len(at)), homes, own, 0))
                for cell, rows in cells.reached(length, vectors, 2):  # two cells, or tiles of one, ask in one direction
                    tiles = cells.tiles.get(cell, 1)
                    rows = rows[homes[rows] <= cell]
                    for tile in range(tiles):
                        ask = rows[(homes[rows] < cell) | (own[rows] < tile)]
                        out.append((ask, np.full(len(ask), cell), np.full(len(ask), tile), 1))
                for cell, rows in cells.reached(length + 1, vectors, 1):
                    for tile in range(cells.tiles.get(cell, 1)):
                        out.append((rows, np.full(len(rows), cell), np.full(len(rows), tile), 2))
                rows = at[np.concatenate([o[0] for o in out])]
                columns = [np.concatenate([o[k] for o in out]).astype(np.int64) for k in (1, 2)]
                role = np.concatenate([np.full(len(o[0]), o[3], np.int8) for o in out])
                for k in range(0, len(rows), ASKED):
                    cut = slice(k, k + ASKED)
                    chosen = batch.take(pa.array(rows[cut]))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(columns[0][cut]), pa.array(columns[1][cut]), pa.array(role[cut]), chosen.column(0), chosen.column(1)],
                        ["cell", "tile", "role", "word", "n"],
                    )

    return words.select("word", "n").mapInArrow(deal, "cell long, tile long, role byte, word string, n long")


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x7FB5D329728EA185)
    x = (x ^ (x >> _U(27))) * _U(0x81DADEF4BC2DD44D)
    return x ^ (x >> _U(33))


def _powers(n: int) -> np.ndarray:
    return np.multiply.accumulate(np.concatenate([np.ones(1, _U), np.full(n, BASE, _U)]))


def _without(letters: np.ndarray) -> np.ndarray:
    """Hashes of each row without the letter at each place."""
    power, value = _powers(letters.shape[1]), letters.astype(_U) + _U(1)
    before = np.cumsum(value * power[: letters.shape[1]], axis=1)
    after = np.cumsum((value * power[: letters.shape[1]])[:, ::-1], axis=1)[:, ::-1]
    inverse = _U(pow(BASE, -1, 1 << 64))
    before = before - value * power[: letters.shape[1]]
    return before + (after - value * power[: letters.shape[1]]) * inverse


def _ranges(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which range, and every number in it."""
    size = ends - starts
    which = np.repeat(np.arange(len(size)), size)
    return which, np.arange(size.sum()) - np.repeat(np.cumsum(size) - size - starts, size)


class Variants:
    """Words of one length, ready for the question which of them are one edit from others."""

    def __init__(self, letters: np.ndarray):
        self.letters = letters
        self.points, self.node = np.unique(_vectors(letters), axis=0, return_inverse=True)
        self.node = self.node.ravel()
        self.tree = KdTree(self.points, LEAF)
        n, length = letters.shape
        self.gone = _without(letters)
        place, dim = np.tile(np.arange(length), n), _DIM[letters].ravel()
        row = np.repeat(np.arange(n), length)
        self.replaced = self._table(row, self._key(self.node[row], dim, self.gone.ravel() + _spread(place.astype(_U) + _U(1))))
        self.inserted = self._table(row, self._key(self.node[row], dim, self.gone.ravel()))

    @staticmethod
    def _table(row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        order = np.argsort(key, kind="stable")
        return key[order], row[order]

    @staticmethod
    def _key(node: np.ndarray, dim: np.ndarray, hashed: np.ndarray) -> np.ndarray:
        return _spread(hashed ^ _spread((node * WIDTH + dim).astype(_U) + _U(1)))

    def _near_points(self, points: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a row of ``points`` and a row of ``self.points`` within ``radius``."""
        asked, found = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for leaf, rows in self.tree.reached(points, radius):
            own = self.tree.leaves[leaf]
            near = np.abs(points[rows][:, None] - self.points[own][None]).sum(axis=2) <= radius
            a, b = np.nonzero(near)
            asked.append(rows[a])
            found.append(own[b])
        return np.concatenate(asked), np.concatenate(found)

    def replaced_pairs(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of an asked row and an own row of the same length that differ in exactly one letter."""
        points, node = np.unique(_vectors(asked), axis=0, return_inverse=True)
        node, length = node.ravel(), asked.shape[1]
        u, v = self._near_points(points, 2)
        change = points[u] - self.points[v]
        lost, gained = change.argmax(axis=1), change.argmin(axis=1)
        same = ~change.any(axis=1)  # letters that share a dimension, or the same letters in another order
        steps = [(u[~same], v[~same], lost[~same], gained[~same])]
        for dim in range(26, WIDTH):
            with_it = np.flatnonzero(same & (points[u, dim] > 0))
            steps.append((u[with_it], v[with_it], np.full(len(with_it), dim), np.full(len(with_it), dim)))
        u, v, lost, gained = (np.concatenate(x) for x in zip(*steps))
        # the places of asked words by letter counts and letter
        slot = (node[:, None] * WIDTH + _DIM[asked]).ravel()
        order = np.argsort(slot, kind="stable")
        slot = slot[order]
        pair, at = _ranges(np.searchsorted(slot, u * WIDTH + lost), np.searchsorted(slot, u * WIDTH + lost, "right"))
        entry = order[at]
        row, place = entry // length, entry % length
        hashed = _without(asked).ravel()[entry] + _spread(place.astype(_U) + _U(1))
        row, own = self._look_up(self.replaced, row, self._key(v[pair], gained[pair], hashed))
        right = (asked[row] != self.letters[own]).sum(axis=1) == 1
        return row[right], own[right]

    def inserted_pairs(self, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of an asked row that is one letter shorter and an own row that holds it with one letter more."""
        points, node = np.unique(_vectors(asked), axis=0, return_inverse=True)
        node, length = node.ravel(), asked.shape[1]
        u, v = self._near_points(points, 1)
        gained = (self.points[v] - points[u]).argmax(axis=1)
        order = np.argsort(node, kind="stable")
        pair, at = _ranges(np.searchsorted(node[order], u), np.searchsorted(node[order], u, "right"))
        row = order[at]
        hashed = ((asked.astype(_U) + _U(1)) * _powers(length)[:length]).sum(axis=1, dtype=_U)
        row, own = self._look_up(self.inserted, row, self._key(v[pair], gained[pair], hashed[row]))
        both = np.unique(row * len(self.letters) + own)  # a doubled letter is found at both its places
        row, own = both // len(self.letters), both % len(self.letters)
        ahead = np.cumprod(asked[row] == self.letters[own][:, :-1], axis=1).sum(axis=1)
        behind = np.cumprod((asked[row] == self.letters[own][:, 1:])[:, ::-1], axis=1).sum(axis=1)
        right = ahead + behind >= length
        return row[right], own[right]

    @staticmethod
    def _look_up(table: tuple[np.ndarray, np.ndarray], row: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        keys, rows = table
        first = np.searchsorted(keys, key)
        hit = np.flatnonzero(keys[np.minimum(first, len(keys) - 1)] == key)
        which, at = _ranges(first[hit], np.searchsorted(keys, key[hit], "right"))
        return row[hit][which], rows[at]


def _links(dealt: DataFrame) -> DataFrame:
    """``word, other, other_n``: both directions of each pair of near words, once."""

    def answer(group: pa.Table) -> pa.Table:
        names, out = ["word", "other", "other_n"], []
        role = group.column("role").to_numpy()
        parts = [group.filter(pa.array(role == k)).combine_chunks() for k in range(3)]
        own = parts[0]
        if own.num_rows:
            (_, _, letters), = _Words(own.column("word")).lengths()
            variants = Variants(letters)
            for k, part in enumerate(parts):
                for low in range(0, part.num_rows, ASKED):
                    asked = part.slice(low, ASKED)
                    (_, _, rows), = _Words(asked.column("word")).lengths()
                    a, b = variants.inserted_pairs(rows) if k == 2 else variants.replaced_pairs(rows)
                    left, right = asked.take(pa.array(a)), own.take(pa.array(b))
                    out.append(pa.table([left.column("word"), right.column("word"), right.column("n")], names))
                    if k:
                        out.append(pa.table([right.column("word"), left.column("word"), left.column("n")], names))
        empty = pa.table([pa.array([], pa.string()), pa.array([], pa.string()), pa.array([], pa.int64())], names)
        return pa.concat_tables([empty, *out])

    return dealt.groupBy("cell", "tile").applyInArrow(answer, "word string, other string, other_n long")


def near_words(words: DataFrame) -> DataFrame:
    """``word, other, other_n`` for all ordered pairs of ``word, n`` rows that are one edit apart. Words must be different."""
    total = words.count()
    sample = words.select("word").orderBy(F.xxhash64("word"), "word").limit(SAMPLE).toArrow() if total else None
    if not total:
        return words.select("word", F.col("word").alias("other"), F.col("n").alias("other_n"))
    cells = Cells(sample.column(0).combine_chunks(), total)
    cells.measure(words)
    return _links(_deal(words, cells))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form``: each round doubles how far a form has been followed."""
    found = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        next_step = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        step = found.join(next_step, "root", "left").select("word", F.coalesce("further", "root").alias("root"), "further")
        step = materialize(step, "roots")
        found = step.select("word", "root")
        if step.where("further IS NOT NULL").isEmpty():
            return found


def variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", factor: int = FACTOR) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word."""
    words = materialize(word_counts(docs, id_col, text_col), "words")
    best = F.min(F.struct((-F.col("other_n")).alias("m"), "other"))
    near = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best"))
    is_form = -F.col("best.m") >= factor * F.col("n")
    told = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(is_form, F.col("best.other")).alias("form"),
        F.when(is_form, -F.col("best.m")).alias("form_n"),
    )
    told = materialize(told, "forms")
    roots = _roots(told.where("form IS NOT NULL"))
    return told.join(roots, "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))


def report(docs: DataFrame) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of every word of at least seven letters that occurs twice."""
    return variants(docs)
