"""Spelling variants of words: k-d trees over letter counts, then letter order.

One inserted or deleted letter moves one letter count by one, one replaced letter moves
one up and one down. So near words are points at an L1 distance of one (lengths that
differ by one) or two (equal lengths). The upper levels of a tree for each length are
placed from a bounded sample; they deal all words out to cells, and a word visits those
cells whose box is within reach. Each cell then has its own tree.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.workspace import materialize

# A word is a run of these, of which only A-Z are lower-cased.
RUN = "[A-Za-zÀ-ÿ]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Letters a to z have an axis each, all others share the rest. Counts stop at 255.
# Both only shorten distances, so that no near word is lost.
AXES = 32
AXIS_OF = np.array([c - 97 if 97 <= c < 123 else 26 + c % 6 for c in range(256)])

# Words of a cell that is searched by one task, as estimated from the sample; words
# sampled for each cell, and in all; points of a leaf; bytes of letters compared at once.
CELL_WORDS = 20_000
SAMPLED_PER_CELL = 64
MOST_SAMPLED = 500_000
LEAF = 96
BLOCK_BYTES = 16 << 20

#: What a near word may lack and have more of each, by how much longer it is.
REACH = {0: (1, 1), 1: (0, 1)}


class Tree(NamedTuple):
    """Cuts of one length: ``axis`` is -1 at a leaf, whose number is ``cell``."""

    axis: np.ndarray
    value: np.ndarray
    left: np.ndarray
    right: np.ndarray
    cell: np.ndarray


def changed_words(docs: DataFrame, least: int = 7, every: int = 31) -> DataFrame:
    """``word, n``: runs of letters of whole texts, some of which have lost a letter.

    The unsigned crc32 of ``<doc_id>:<run>`` decides: where ``every`` divides it, the
    letter at its remainder by the length goes. Shorter results than ``least`` are left out.
    """
    text = F.translate(F.coalesce("text", F.lit("")), UPPER, LOWER)
    run = F.col("run")
    digest = F.crc32(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), run))
    at = (F.col("digest") % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return (
        docs.select("doc_id", F.explode(F.regexp_extract_all(text, F.lit(f"({RUN}{{{least},}})"), F.lit(1))).alias("run"))
        .select(run, digest.alias("digest"))
        .select(F.when(F.col("digest") % every == 0, cut).otherwise(run).alias("word"))
        .where(F.length("word") >= least)
        .groupBy("word")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def letters_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All letters in a row, a byte each, and where each word starts; the end comes last."""
    starts = np.zeros(len(words) + 1, np.int64)
    np.cumsum(pc.utf8_length(words).to_numpy(zero_copy_only=False), out=starts[1:])
    return np.frombuffer("".join(words.to_pylist()).encode("latin-1"), np.uint8), starts


def letter_counts(letters: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """A point of ``AXES`` counts for each word."""
    rows = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
    counts = np.bincount(rows * AXES + AXIS_OF[letters], minlength=(len(starts) - 1) * AXES)
    return np.minimum(counts, 255).astype(np.int16).reshape(-1, AXES)


def best_cut(points: np.ndarray) -> tuple[int, int] | None:
    """The axis and value that split the points most evenly, None if all are the same."""
    low, high = points.min(axis=0), points.max(axis=0)
    axes = np.flatnonzero(high > low)
    if not len(axes):
        return None
    middle = np.sort(points[:, axes], axis=0)[(len(points) - 1) // 2]
    best = None
    for shift in (0, -1):
        value = np.clip(middle + shift, low[axes], high[axes] - 1)
        uneven = np.abs((points[:, axes] <= value).sum(axis=0) * 2 - len(points))
        i = int(uneven.argmin())
        if best is None or uneven[i] < best[0]:
            best = (uneven[i], int(axes[i]), int(value[i]))
    return best[1], best[2]


def grow(points: np.ndarray, leaves: int) -> Tree:
    """Cuts into ``leaves`` parts of about as many points each."""
    nodes: list[list[int]] = []
    cells = 0
    stack = [(points, leaves, 0, 0)]
    while stack:
        held, wanted, parent, side = stack.pop()
        if nodes:
            nodes[parent][side] = len(nodes)
        cut = best_cut(held) if wanted > 1 and len(held) > 1 else None
        if cut is None:
            nodes.append([-1, 0, 0, 0, cells])
            cells += 1
            continue
        below = held[:, cut[0]] <= cut[1]
        share = min(max(round(wanted * below.mean()), 1), wanted - 1)
        stack.append((held[~below], wanted - share, len(nodes), 3))
        stack.append((held[below], share, len(nodes), 2))
        nodes.append([*cut, 0, 0, -1])
    return Tree(*np.array(nodes).T)


ONE_CELL = Tree(*np.array([[-1, 0, 0, 0, 0]]).T)


def reached(
    tree: Tree, points: np.ndarray, less: int, more: int
) -> Iterator[tuple[int, np.ndarray]]:
    """Cells whose box a point may reach, losing and gaining so many letters, and its rows.

    A box lies between cuts; each that is crossed costs its distance, on the side of
    ``less`` or of ``more``. No reach at all finds the one cell a point lies in.
    """
    along = np.ascontiguousarray(points.T)
    nothing = np.zeros(len(points), np.int16)
    stack = [(0, np.arange(len(points)), nothing, nothing)]
    while stack:
        at, here, down, up = stack.pop()
        axis = tree.axis[at]
        if axis < 0:
            yield int(tree.cell[at]), here
            continue
        beyond = along[axis][here] - tree.value[at]
        for child, lost, gained in (
            (tree.left[at], down + np.maximum(beyond, 0), up),
            (tree.right[at], down, up + np.maximum(1 - beyond, 0)),
        ):
            near = np.flatnonzero((lost <= less) & (gained <= more))
            if len(near):
                stack.append((child, here[near], lost[near], gained[near]))


def cells_within(tree: Tree, points: np.ndarray, less: int, more: int) -> tuple[np.ndarray, np.ndarray]:
    """:func:`reached` as rows of ``points`` and cells."""
    found = list(reached(tree, points, less, more))
    cells = [np.full(len(rows), cell) for cell, rows in found]
    return np.concatenate([rows for _, rows in found]), np.concatenate(cells)


def upper_trees(words: DataFrame, cell_words: int, most_sampled: int) -> dict[int, Tree]:
    """Trees of those lengths that need more than one cell.

    They are placed from about ``SAMPLED_PER_CELL`` words a cell, drawn by a hash over all
    words, ``most_sampled`` in all on average (words are distinct, so that none swamps it).
    The sample has no bearing on results.
    """
    total = words.count()
    wanted = min(most_sampled, total * SAMPLED_PER_CELL // cell_words + SAMPLED_PER_CELL)
    share = min(1.0, wanted / max(total, 1))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters, starts = letters_of(batch.column(0))
            points = [point.tobytes() for point in letter_counts(letters, starts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.diff(starts)), pa.array(points, pa.binary())], names=["size", "point"]
            )

    drawn = words.where(F.abs(F.xxhash64("word", F.lit("cells")) / 2.0**63) <= share)
    sample = drawn.select("word").mapInArrow(measure, "size long, point binary").toArrow()
    sizes = sample.column("size").to_numpy()
    points = np.frombuffer(b"".join(sample.column("point").to_pylist()), np.int16).reshape(-1, AXES)
    trees = {}
    for size in np.unique(sizes):
        own = points[sizes == size]
        cells = round(len(own) / share / cell_words)
        if cells > 1:
            trees[int(size)] = grow(own, cells)
    return trees


def visits(words: DataFrame, trees: dict[int, Tree]) -> DataFrame:
    """``size, cell, guest, word, n``: each word in its own cell and as a guest in others.

    Words of one length meet once, in the later of their cells; a shorter word goes to the
    longer ones.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            letters, starts = letters_of(batch.column(0))
            points, sizes = letter_counts(letters, starts), np.diff(starts)
            for size in np.unique(sizes):
                here = np.flatnonzero(sizes == size)
                own = np.zeros(len(here), np.int64)
                at, cells = cells_within(trees.get(size, ONE_CELL), points[here], 0, 0)
                own[at] = cells
                yield row(batch, here, size, own, False)
                for longer, (less, more) in REACH.items():
                    at, cells = cells_within(trees.get(size + longer, ONE_CELL), points[here], less, more)
                    if longer == 0:
                        later = cells > own[at]
                        at, cells = at[later], cells[later]
                    yield row(batch, here[at], size + longer, cells, True)

    def row(batch, rows, size, cells, guest) -> pa.RecordBatch:
        taken = batch.take(pa.array(rows))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(rows), size), pa.int64()), pa.array(cells, pa.int64()),
             pa.array(np.full(len(rows), guest)), *taken.columns],
            names=["size", "cell", "guest", "word", "n"],
        )

    return words.select("word", "n").mapInArrow(
        deal, "size long, cell long, guest boolean, word string, n long"
    )


class Cell:
    """The words of one cell below a tree of their own."""

    def __init__(self, words: pa.Array, counts: pa.Array):
        letters, starts = letters_of(words)
        points = letter_counts(letters, starts)
        self.tree = grow(points, -(-len(words) // LEAF))
        rows, leaves = cells_within(self.tree, points, 0, 0)
        # Words leaf by leaf, so that a leaf is a slice.
        order = rows[np.argsort(leaves, kind="stable")]
        self.firsts = np.r_[0, np.cumsum(np.bincount(leaves, minlength=self.tree.cell.max() + 1))]
        self.words, self.n = words.take(pa.array(order)), counts.take(pa.array(order))
        self.letters = letters.reshape(len(words), -1)[order]
        self.points = points[order].astype(np.float32)
        self.squares = (self.points**2).sum(axis=1)

    def near(self, guests: pa.Array, after: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows, of ``guests`` and of the cell, of near words.

        Guests that are words of the cell from row ``after`` on meet only later ones.
        """
        letters, starts = letters_of(guests)
        points, sizes = letter_counts(letters, starts), np.diff(starts)
        for size in np.unique(sizes):
            rows = np.flatnonzero(sizes == size)
            spelled = letters[starts[rows][:, None] + np.arange(size)]
            longer = int(self.letters.shape[1] - size)
            for i, j in self._candidates(points[rows], *REACH[longer], after):
                yield from self._in_order(rows, spelled, i, j, longer)

    def _candidates(self, points: np.ndarray, less: int, more: int, after: int | None):
        """Rows whose letter counts are within reach."""
        wide = points.astype(np.float32)
        squares = (wide**2).sum(axis=1)
        wide *= -2
        for leaf, rows in reached(self.tree, points, less, more):
            first, last = self.firsts[leaf : leaf + 2]
            if after is not None:
                rows = rows[rows + after < last]
            # Steps of one along one or two axes: the squared distance is 1 or 2 at most.
            step = max(1, BLOCK_BYTES // (4 * max(1, last - first)))
            for at in range(0, len(rows), step):
                some = rows[at : at + step]
                gaps = wide[some] @ self.points[first:last].T
                gaps += squares[some][:, None]
                i, j = np.nonzero(gaps <= less + more - self.squares[first:last])
                i, j = some[i], first + j
                if after is not None:
                    later = i + after < j
                    i, j = i[later], j[later]
                yield i, j

    def _in_order(self, rows, spelled, i, j, longer):
        """Of the candidates those that one edit makes equal, letter by letter."""
        step = max(1, BLOCK_BYTES // self.letters.shape[1])
        for at in range(0, len(i), step):
            a, b = i[at : at + step], j[at : at + step]
            short, long_ = spelled[a], self.letters[b]
            if longer:
                same = short == long_[:, :-1]
                head = np.where(same.all(axis=1), same.shape[1], same.argmin(axis=1))
                same = (short == long_[:, 1:])[:, ::-1]
                tail = np.where(same.all(axis=1), same.shape[1], same.argmin(axis=1))
                good = head + tail >= same.shape[1]
            else:
                good = (short != long_).sum(axis=1) == 1
            if good.any():
                yield rows[a[good]], b[good]


def near_words(words: DataFrame, cell_words: int = CELL_WORDS, most_sampled: int = MOST_SAMPLED) -> DataFrame:
    """``a, a_n, b, b_n``: every pair of near words once. ``words`` has distinct ``word, n``."""
    trees = upper_trees(words, cell_words, most_sampled)
    dealt = visits(words, trees)
    cells = sum(int(t.cell.max()) + 1 for t in trees.values())
    spark = words.sparkSession
    tasks = max(2 * cells, int(spark.conf.get("spark.sql.shuffle.partitions")))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held, cell = None, [], None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            keys = np.stack([batch.column(c).cast(pa.int64()).to_numpy() for c in range(3)], axis=1)
            firsts = np.flatnonzero(np.r_[len(keys) > 0, (keys[1:] != keys[:-1]).any(axis=1)])
            for start, end in zip(firsts, [*firsts[1:], len(keys)]):
                part = table.slice(start, end - start).select(["word", "n"])
                *own, guest = keys[start].tolist()
                if own != key:
                    yield from within(cell, held)
                    key, held, cell = own, [], None
                if not guest:
                    held.append(part)
                    continue
                if held:
                    cell = build(held)
                    yield from within(cell, held)
                    held = []
                if cell is not None:
                    yield from pairs(cell, part, False)
        yield from within(build(held) if held else None, held)

    def build(held: list[pa.Table]) -> Cell:
        rows = pa.concat_tables(held).combine_chunks()
        return Cell(rows.column("word").combine_chunks(), rows.column("n").combine_chunks())

    def within(cell: Cell | None, held: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        """Pairs among the words of a cell, once all of them are there."""
        if held:
            cell = cell or build(held)
            yield from pairs(cell, pa.table({"word": cell.words, "n": cell.n}), True)

    def pairs(cell: Cell, guests: pa.Table, own: bool) -> Iterator[pa.RecordBatch]:
        for at in range(0, len(guests), 4096):
            some = guests.slice(at, 4096).combine_chunks()
            word, n = (some.column(c).combine_chunks() for c in ("word", "n"))
            found = list(cell.near(word, at if own else None))
            if found:
                i, j = (pa.array(np.concatenate(x)) for x in zip(*found))
                yield pa.RecordBatch.from_arrays(
                    [word.take(i), n.take(i), cell.words.take(j), cell.n.take(j)],
                    names=["a", "a_n", "b", "b_n"],
                )

    return (
        dealt.repartition(tasks, "size", "cell")
        .sortWithinPartitions("size", "cell", "guest")
        .mapInArrow(search, "a string, a_n long, b string, b_n long")
    )


def last_forms(forms: DataFrame) -> DataFrame:
    """``word, root``: the end of the chain that starts with ``word, form``.

    A form is ten times as frequent as its word, so chains are short and have an end;
    steps double each round.
    """
    steps = materialize(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        onward = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = steps.join(onward, "root", "left")
        moved = materialize(further.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        if moved.where("moved").isEmpty():
            return moved.select("word", "root")
        steps = moved.select("word", "root")


def spelling_variants(
    docs: DataFrame,
    least: int = 7,
    every: int = 31,
    rare: int = 2,
    times: int = 10,
    cell_words: int = CELL_WORDS,
    most_sampled: int = MOST_SAMPLED,
) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` of every word of whole texts.

    Words are runs of letters (:func:`changed_words`) that occur ``rare`` times or more.
    Near words differ by one letter inserted, deleted or replaced. ``form`` is the most
    frequent near word (of equals the first in code-point order) if it is ``times`` as
    frequent as the word, else null; ``root`` is where the chain of forms ends.

    Null and empty texts have no words; a null ``doc_id`` counts as an empty one; repeated
    rows count each time; an empty table gives no rows. Other columns are not read.
    """
    words = materialize(changed_words(docs, least, every).where(F.col("n") >= rare), "words")
    near = materialize(near_words(words, cell_words, most_sampled), "near-words")
    links = near.select("a", "b", "b_n").union(near.select("b", "a", "a_n")).toDF("word", "near", "near_n")
    best = (
        links.groupBy("word")
        .agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("n"), "near")).alias("best"))
    )
    is_form = -F.col("best.n") >= times * F.col("n")
    judged = materialize(
        words.join(best, "word", "left").select(
            "word",
            F.when(is_form, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, -F.col("best.n")).alias("form_n"),
        ),
        "judged-words",
    )
    roots = last_forms(judged.where("form IS NOT NULL"))
    return judged.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
