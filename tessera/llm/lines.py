"""Line dedup by an exact set-similarity join.

The tokens of a line are ordered by rarity. Two lines of similarity t share a token
among the first n - ceil(2t/(1+t) n) + 1 of the smaller and n - ceil(t n) + 1 of the
larger set, so lines meet on these; the sizes of the sets, the places of the shared
token and bits of parity rule out most of them before the full sets are compared.
Lines with similar sets, directly or over others, are one class; all but its first
line are removed.

Rarity is read from a table of hashed token counts over all lines; any order that
is the same everywhere is right, and a token that was counted once meets nothing.

Near copies are first linked to one of them: the tokens of a line are dealt into a few
parts, and lines that agree on a part meet the first of them. After that only lines
of different components meet, so a group of copies is not expanded into its pairs.
The lines of a token that many have first meet a few of them, for the same reason.

Where every link is asked for (``linked_lines``), all sets that share a token of their
prefixes meet, by what their postings tell: sizes, places and bits of parity. A token of
many sets yields pairs as long as few are left; where its sets are alike, they are held
against each other in blocks, which yield numbers of links and roots of linked sets instead.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.blocks import SET_BYTES, blocks, large_texts
from tessera.llm.components import components
from tessera.llm.linking import ends, verified
from tessera.llm.minhash import mix
from tessera.workspace import materialize, materialize_alone

COUNT_BITS = 23
SIMILAR = 80  # percent
PARTS = 4
BITS = ["bits", "half", "third", "fourth"]  # longs of parity of a line
HALVED, QUARTERED = 64, 128  # tokens from which the halves and quarters of a set have bits of their own
SIGN_WORDS = 4  # longs of parity bits that tell pairs apart before they are verified
SLOT_BITS = 23  # of the bitmap by which rows without wanted lines are left out before their texts are sent
PASSES = 2  # over the shares of the tokens by which lines meet, one after the other
CROWD = 1_000  # members of a token that meet without being split by component
LEADERS = 8  # members of such a token that all others meet first
LINK_CROWD = 256  # members of a token from which it is a crowd, where all links count
MEET_SETS = 1 << 15  # members of a crowd that one task goes through, or twice as many of two parts
MEET_ROWS = 1 << 15  # postings, and pairs of them, that are gone through at once
MEET_CELLS = 1 << 17
DENSE = 16  # pairs a member from which a crowd yields its members instead, to meet in blocks
BLOCK_SETS = 1024  # sets that are held against each other in a matrix
BLOCK_PARTS = 8  # such shares of sets in a block, and its tokens
BLOCK_TOKENS = 1 << 20
COLUMNS = 4096
HASHED_BYTES = 1 << 20
SEPARATORS = np.isin(np.arange(256), [32, *range(9, 14)])
LOWERED = np.arange(256) + 32 * np.isin(np.arange(256), range(65, 91))
LETTERS = mix(LOWERED.astype(np.uint64) + np.uint64(1))
LINES = (
    "doc_id bigint, content bigint, n_lines int, line bigint, set_key binary, n int, skipped int, "
    "prefix array<int>, common int, bits bigint, half bigint, third bigint, fourth bigint, parts array<int>"
)
POSTINGS = (
    "key bigint, rep bigint, told bigint, "
    "bits bigint, half bigint, third bigint, fourth bigint, crowds array<int>"
)
MEETINGS = "a bigint, b bigint, token int, cell int, role tinyint, n int, crowds array<int>"
NO_ROLE, SHORT, WITHIN, LEFT, RIGHT = range(5)  # of a posting: the last three are those of crowds
KEY_BITS, PLACE_BITS, ROLE_BITS = 31, 32, 3  # of a posting: token over cell, size over place over role


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z lower-cased, and the number of each text.

    A word is the sum of its bytes' values times the factors of their places.
    """
    texts = large_texts(texts)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[: len(texts) + 1]
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8) if held is not None else np.zeros(0, np.uint8)
    data = data[: offsets[-1]]
    real = ~SEPARATORS[data]
    border = np.zeros(len(data) + 1, bool)
    border[offsets] = True
    starts = np.flatnonzero(real & (border[:-1] | np.r_[True, ~real[:-1]]))
    stops = np.flatnonzero(real & (border[1:] | np.r_[~real[1:], True])) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    sizes = stops - starts
    factors = mix(np.arange(1, 1 + sizes.max(initial=0), dtype=np.uint64)) | np.uint64(1)
    words = np.zeros(len(starts), np.uint64)
    cuts = np.searchsorted(starts, np.arange(0, len(data) + HASHED_BYTES, HASHED_BYTES))
    for a, b in zip(cuts, cuts[1:]):
        if a < b:
            size = sizes[a:b]
            first = np.cumsum(size) - size
            place = np.arange(size.sum()) - np.repeat(first, size)
            at = place + np.repeat(starts[a:b], size)
            words[a:b] = mix(np.add.reduceat(LETTERS[data[at]] * factors[place], first))
    return words, counts


def line_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of all lines in order, tokens per line, and lines per text."""
    split = pc.split_pattern(large_texts(texts), "\n")
    words, counts = word_hashes(split.flatten())
    lines = pc.list_value_length(split).to_numpy(zero_copy_only=False).astype(np.int64)
    return words, counts, lines


def by_rarity(words: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """Tokens as numbers that are ordered by the level of their count first."""
    level = levels[(words >> np.uint64(64 - COUNT_BITS)).astype(np.int64)]
    return (words >> np.uint64(8)) | (level.astype(np.uint64) << np.uint64(56))


def sorted_sets(words: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sorted distinct tokens of each line (all have some), and their number."""
    starts = np.cumsum(counts) - counts
    order = np.argsort(counts, kind="stable")
    size, first = np.unique(counts[order], return_index=True)
    out = words.copy()
    for n, same in zip(size.tolist(), np.split(order, first[1:])):
        at = starts[same][:, None] + np.arange(n)
        out[at] = np.sort(words[at], axis=1)
    if not len(out):
        return out, counts
    new = np.r_[True, out[1:] != out[:-1]]
    new[starts] = True
    return out[new], np.add.reduceat(new.astype(np.int64), starts)


def prefix_lengths(n: np.ndarray) -> np.ndarray:
    return n - -(-SIMILAR * n // 100) + 1


def least_prefix(n: Column) -> Column:
    """Tokens of a set that meet the prefixes of larger ones."""
    return n - F.ceil(F.lit(2 * SIMILAR) * n / F.lit(100 + SIMILAR)) + 1


def token_levels(rows: DataFrame) -> np.ndarray:
    """The level of the count of each slot of a table of fixed size; 0 for once or never."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        times = np.zeros(1 << COUNT_BITS, np.int32)
        for block in blocks(batches, "text", SET_BYTES):
            words, _, _ = line_words(block.column("text"))
            slot, found = np.unique(words >> np.uint64(64 - COUNT_BITS), return_counts=True)
            times[slot.astype(np.int64)] += found.astype(np.int32)
        slot = np.flatnonzero(times)
        for at in range(0, len(slot), 1 << 16):
            some = slot[at : at + (1 << 16)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(some.astype(np.int32)), pa.array(times[some].astype(np.int64))],
                names=["slot", "times"],
            )

    counted = (
        rows.select("text")
        .mapInArrow(count, "slot int, times bigint")
        .groupBy("slot")
        .agg(F.sum("times").alias("times"))
        .where("times > 1")
        .select("slot", F.expr("cast(least(120, round(4 * log2(times))) AS tinyint)").alias("level"))
    )
    counted = materialize(counted, "token-levels").toArrow()
    levels = np.zeros(1 << COUNT_BITS, np.uint8)
    if counted.num_rows:
        levels[counted.column("slot").to_numpy()] = counted.column("level").to_numpy()
    return levels


def line_rows(rows: DataFrame) -> DataFrame:
    """Every line that has a word: the key and size of its set, and the prefix that can meet.

    The last ``common`` tokens of ``prefix`` may be in over ``LINK_CROWD`` sets.
    ``n_lines`` is the number of such lines in the text. ``bits`` has a bit of parity for each
    sixty-fourth of the tokens; of large sets, ``half`` has them for one half of the tokens,
    ``third`` and ``fourth`` for two quarters, null for others. ``parts`` has a hash for each
    quarter that is not empty.
    """
    known = rows.sparkSession.sparkContext.broadcast(token_levels(rows))
    crowded = int(min(120, 4 * np.log2(LINK_CROWD)))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = known.value
        for block in blocks(batches, "text", SET_BYTES):
            words, counts, lines = line_words(block.column("text"))
            real = np.flatnonzero(counts)
            if not len(real):
                continue
            owner = np.repeat(np.arange(len(lines)), lines)
            number = np.arange(len(owner)) - np.repeat(np.cumsum(lines) - lines, lines)
            tokens, n = sorted_sets(by_rarity(words, levels), counts[real])
            stops = np.cumsum(n)
            starts = stops - n
            held = memoryview(tokens.tobytes())
            keys = [
                xxhash.xxh3_128_digest(held[8 * a : 8 * b])
                for a, b in zip(starts.tolist(), stops.tolist())
            ]
            lone = np.add.reduceat((tokens < np.uint64(1 << 56)).astype(np.int64), starts)
            length = prefix_lengths(n)
            skipped = np.minimum(lone, length)
            left = length - skipped
            till = np.cumsum(left)
            at = np.arange(left.sum()) + np.repeat(starts + skipped - (till - left), left)
            often = np.cumsum(np.r_[0, tokens[at] >= np.uint64(crowded << 56)])
            bit, quarter = np.uint64(1) << (tokens & np.uint64(63)), (tokens >> np.uint64(8)) & np.uint64(3)
            parity = [
                (np.bitwise_xor.reduceat(np.where(own, bit, np.uint64(0)), starts), n < least)
                for own, least in (
                    (np.ones(len(tokens), bool), 0),
                    ((quarter & np.uint64(1)) == 1, HALVED),
                    (quarter == 2, QUARTERED),
                    (quarter == 3, QUARTERED),
                )
            ]
            mixed, part = mix(tokens), (tokens >> np.uint64(6)) % np.uint64(PARTS)
            parts = np.stack(
                [
                    np.bitwise_xor.reduceat(np.where(part == k, mixed, np.uint64(0)), starts)
                    for k in range(PARTS)
                ],
                axis=1,
            ).astype(np.uint32)
            some = parts != 0
            row = pa.array(owner[real])
            worded = np.bincount(owner[real], minlength=len(lines))
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id").take(row),
                    block.column("content").take(row),
                    pa.array(worded[owner[real]], pa.int32()),
                    pa.array(number[real]),
                    pa.array(keys, pa.binary()),
                    pa.array(n, pa.int32()),
                    pa.array(skipped, pa.int32()),
                    pa.ListArray.from_arrays(
                        pa.array(np.r_[0, till], pa.int32()),
                        pa.array(tokens[at].astype(np.uint32).view(np.int32)),
                    ),
                    pa.array(often[till] - often[till - left], pa.int32()),
                    *(pa.array(found.view(np.int64), mask=none) for found, none in parity),
                    pa.ListArray.from_arrays(
                        pa.array(np.r_[0, np.cumsum(some.sum(1))], pa.int32()),
                        pa.array(parts[some].view(np.int32)),
                    ),
                ],
                names=LINES_NAMES,
            )

    return rows.mapInArrow(split, LINES)


LINES_NAMES = [column.split()[0] for column in LINES.split(", ")]


def sizes_fit() -> Column:
    """Length filter, and sets differ in as many tokens at least as their parities in bits.

    Of a pair, one has columns that end in ``_a``. Its bits are compared in as many shares
    of the tokens as both have.
    """
    n_a, n = F.col("n_a"), F.col("n")
    whole, half, third, fourth = (F.col(f"{c}_a").bitwiseXOR(F.col(c)) for c in BITS)
    halves = F.bit_count(whole.bitwiseXOR(half)) + F.bit_count(half)
    quarters = (
        F.bit_count(whole.bitwiseXOR(half).bitwiseXOR(third))
        + F.bit_count(half.bitwiseXOR(fourth))
        + F.bit_count(third)
        + F.bit_count(fourth)
    )
    near = lambda apart: (100 + SIMILAR) * apart <= (100 - SIMILAR) * (n_a + n)
    return (
        (100 * F.least(n_a, n) >= SIMILAR * F.greatest(n_a, n))
        & near(F.bit_count(whole))
        & near(F.coalesce(quarters, halves, F.lit(0)))
    )


def places_fit() -> Column:
    """Positional filter for a pair that shares a token at these places."""
    n_a, pos_a, n, pos = (F.col(c) for c in ("n_a", "pos_a", "n", "pos"))
    rest = F.least(n_a - pos_a, n - pos) + F.least(pos_a, pos)
    return (100 + SIMILAR) * rest >= SIMILAR * (n_a + n)


def sided(*columns: str) -> list[Column]:
    """Columns of the one side of pairs."""
    return [F.col(c).alias(f"{c}_a") for c in columns]


def in_passes(placed: DataFrame, pairs: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``pairs`` makes of rows that share a token, for one share of the tokens after the other."""
    found = [
        materialize(pairs(placed.where(F.expr(f"pmod(token, {PASSES}) = {k}"))).distinct(), "line-pairs")
        for k in range(PASSES)
    ]
    return materialize(reduce(DataFrame.union, found).distinct(), "line-pairs")


def token_sets(texts: pa.Array) -> list[np.ndarray]:
    words, counts = word_hashes(texts)
    return [np.unique(w) for w in np.split(words, np.cumsum(counts)[:-1])]


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("content"), text.alias("text")
    )


def maybe_in(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """``rows`` without most of those whose ``key``, a hash, is not in ``wanted``: by a bitmap of bounded size."""
    word = F.expr(f"pmod({key}, {1 << SLOT_BITS}L) div 64").alias("__word")
    bit = F.expr(f"shiftleft(1L, cast(pmod({key}, 64L) AS int))").alias("__bit")
    words = wanted.select(word, bit).groupBy("__word").agg(F.expr("bit_or(__bit)").alias("__bits"))
    return (
        rows.select("*", word, bit)
        .join(F.broadcast(words), "__word")
        .where("__bits & __bit <> 0")
        .select(rows.columns)
    )


def copies(classes: DataFrame) -> DataFrame:
    """Pairs of lines that agree on a part of their tokens, one of them the first of all that do."""
    dealt = classes.select("rep", "n", *BITS, F.explode("parts").alias("part"))
    heads = (
        dealt.groupBy("part")
        .agg(
            F.min(F.struct(F.col("rep").alias("a"), *sided("n", *BITS))).alias("head"),
            F.count(F.lit(1)).alias("members"),
        )
        .where("members > 1")
        .select("part", "head.*")
    )
    return (
        dealt.join(heads, "part")
        .where((F.col("a") != F.col("rep")) & sizes_fit())
        .select("a", F.col("rep").alias("b"))
        .distinct()
    )


def met(placed: DataFrame) -> DataFrame:
    """Pairs of lines of different components that share a token of their prefixes."""
    short = placed.where(F.col("pos") < least_prefix(F.col("n"))).select(
        "token", F.col("rep").alias("a"), *sided("component", "n", "pos", *BITS)
    )
    apart = (
        (F.col("component_a") != F.col("component"))
        & ((F.col("n_a") < F.col("n")) | ((F.col("n_a") == F.col("n")) & (F.col("a") < F.col("rep"))))
        & sizes_fit()
        & places_fit()
    )
    return short.join(placed, "token").where(apart).select("a", F.col("rep").alias("b"))


def met_leaders(placed: DataFrame) -> DataFrame:
    """Pairs of the members of a token with a few of them, of other components."""
    slot = F.expr(f"pmod(xxhash64(rep), {LEADERS})").alias("slot")
    own = F.struct(F.col("rep").alias("a"), *sided("component", "n", "pos", *BITS))
    leaders = placed.groupBy("token", slot).agg(F.min(own).alias("leader")).select("token", "leader.*")
    apart = (F.col("component_a") != F.col("component")) & sizes_fit() & places_fit()
    return placed.join(leaders, "token").where(apart).select("a", F.col("rep").alias("b"))


def met_in_crowds(placed: DataFrame) -> DataFrame:
    """As :func:`met` for tokens of many lines: those outside a token's main component meet all."""
    sizes = placed.groupBy("token", "component").agg(F.count(F.lit(1)).alias("members"))
    major = sizes.groupBy("token").agg(
        F.max(F.struct("members", "component")).getField("component").alias("major")
    )
    minor = (
        placed.join(major, "token")
        .where("component <> major")
        .select("token", "major", F.col("rep").alias("a"), *sided("component", "n", "pos", *BITS))
    )
    apart = (
        (F.col("component_a") != F.col("component"))
        & ((F.col("component") == F.col("major")) | (F.col("rep") < F.col("a")))
        & sizes_fit()
        & places_fit()
    )
    return minor.join(placed, "token").where(apart).select("a", F.col("rep").alias("b"))


def lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The values of all lists of numbers, where each starts, and their lengths."""
    lengths = pc.fill_null(pc.list_value_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False), np.cumsum(lengths) - lengths, lengths


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers from each start on, one after the other."""
    return np.arange(lengths.sum()) + np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)


def postings(classes: DataFrame, crowded: pa.Table, share: int) -> DataFrame:
    """A row for each token of a prefix that is in this share of the tokens (``PASSES``).

    Tokens of ``crowded`` (``token, members``) have cells: one for all members, or one for
    each pair of parts of ``MEET_SETS`` members. ``crowds`` are all such tokens of the set, null for
    none. ``key`` holds token and cell, ``told`` the size of the set, the token's place and the role.
    """
    order = np.argsort(crowded.column("token").to_numpy())
    known = classes.sparkSession.sparkContext.broadcast(
        (
            crowded.column("token").to_numpy()[order],
            -(-crowded.column("members").to_numpy()[order] // MEET_SETS),
        )
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often, parts = (np.r_[x, x[:1]] for x in known.value)
        for batch in batches:
            rep, n, skipped, common = (batch.column(c).to_numpy() for c in ("rep", "n", "skipped", "common"))
            token, starts, sizes = lists(batch.column("prefix"))
            row = np.repeat(np.arange(len(rep)), sizes)
            at = np.arange(len(row)) - starts[row]
            nearest = np.searchsorted(often[: len(known.value[0])], token)
            crowd = (at >= (sizes - common)[row]) & (len(often) > 0)
            if len(often):
                crowd &= often[nearest] == token
            held, value = np.divmod(
                np.unique((row[crowd] << 32) + (token[crowd].astype(np.int64) + (1 << 31))), 1 << 32
            )
            crowds = pa.ListArray.from_arrays(
                pa.array(np.r_[0, np.cumsum(np.bincount(held, minlength=len(rep)))], pa.int32()),
                pa.array((value - (1 << 31)).astype(np.int32)),
                mask=pa.array(np.bincount(held, minlength=len(rep)) == 0),
            )
            short = skipped[row] + at < n[row] - -(-2 * SIMILAR * n[row] // (100 + SIMILAR)) + 1
            own = token.astype(np.int64) % PASSES == share
            plain, crowd = np.flatnonzero(own & ~crowd), np.flatnonzero(own & crowd)
            total = parts[nearest[crowd]] if len(parts) else np.zeros(0, np.int64)
            part = (mix(rep[row[crowd]].view(np.uint64)) % np.maximum(total, 1).astype(np.uint64)).astype(np.int64)
            other = ranges(np.zeros(len(total), np.int64), total)
            crowd, part, total = (np.repeat(x, total) for x in (crowd, part, total))
            cell = np.minimum(part, other) * total + np.maximum(part, other)
            role = np.where(part == other, WITHIN, np.where(part < other, LEFT, RIGHT))
            where = np.r_[plain, crowd]
            of = row[where]
            key = (token[where].astype(np.int64) << KEY_BITS) + np.r_[np.zeros(len(plain), np.int64), cell + 1]
            role = np.r_[np.where(short[plain], SHORT, NO_ROLE), role]
            told = (n[of].astype(np.int64) << PLACE_BITS) + ((skipped[of] + at[where]) << ROLE_BITS) + role
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key), pa.array(rep[of]), pa.array(told),
                    *(batch.column(c).take(pa.array(of)) for c in BITS), crowds.take(pa.array(of)),
                ],
                names=[column.split()[0] for column in POSTINGS.split(", ")],
            )

    return classes.select("rep", "n", "skipped", "common", "prefix", *BITS).mapInArrow(place, POSTINGS)


class Postings:
    """Postings as arrays, in order of token, cell, size and set; rows come in order of token and cell."""

    def __init__(self, rows: pa.Table):
        told = rows.column("told").to_numpy()
        order = np.lexsort((rows.column("rep").to_numpy(), told >> PLACE_BITS, rows.column("key").to_numpy()))
        rows = rows.take(pa.array(order)).combine_chunks()
        self.key, self.rep, told = (rows.column(c).to_numpy() for c in ("key", "rep", "told"))
        self.token = self.key >> KEY_BITS
        self.n = told >> PLACE_BITS
        self.pos = (told & ((1 << PLACE_BITS) - 1)) >> ROLE_BITS
        self.role = told & ((1 << ROLE_BITS) - 1)
        nulls = [rows.column(c).combine_chunks() for c in BITS]
        self.bits = [pc.fill_null(x, 0).to_numpy().view(np.uint64) for x in nulls]
        self.halved, self.quartered = (~nulls[k].is_null().to_numpy(zero_copy_only=False) for k in (1, 2))
        self.crowds = rows.column("crowds").combine_chunks()
        self.value, self.start, self.held = lists(self.crowds)
        self.first = np.full(len(self.rep), np.iinfo(np.int64).max)
        some = self.held > 0
        self.first[some] = self.value[self.start[some]]
        new = np.r_[True, self.key[1:] != self.key[:-1]][: len(self.rep)]
        self.run = np.cumsum(new) - 1
        self.starts = np.flatnonzero(new)

    def near(self, apart: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return (100 + SIMILAR) * apart.astype(np.int64) <= (100 - SIMILAR) * (self.n[x] + self.n[y])

    def meeting(self, rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of rows of one token and cell that can be similar, ``rows`` among them first or as the smaller."""
        key = (self.run << 32) + self.n
        most = np.searchsorted(key, (self.run[rows] << 32) + 100 * self.n[rows] // SIMILAR, "right") - rows - 1
        ends = np.cumsum(most)
        start = 0
        while start < len(rows):
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] - most[start] + MEET_CELLS, "right")))
            x = np.repeat(rows[start:stop], most[start:stop])
            y = ranges(rows[start:stop] + 1, most[start:stop])
            start = stop
            left = self.near(np.bitwise_count(self.bits[0][x] ^ self.bits[0][y]), x, y)
            x, y = x[left], y[left]
            rest = np.minimum(self.n[x] - self.pos[x], self.n[y] - self.pos[y]) + np.minimum(self.pos[x], self.pos[y])
            left = (100 + SIMILAR) * rest >= SIMILAR * (self.n[x] + self.n[y])
            left &= (self.rep[x] != self.rep[y]) & ((self.role[x] <= WITHIN) | (self.role[x] != self.role[y]))
            x, y = x[left], y[left]
            whole, half, third, fourth = (b[x] ^ b[y] for b in self.bits)
            halves = np.bitwise_count(whole ^ half).astype(np.int64) + np.bitwise_count(half)
            quarters = (
                np.bitwise_count(whole ^ half ^ third).astype(np.int64)
                + np.bitwise_count(half ^ fourth)
                + np.bitwise_count(third)
                + np.bitwise_count(fourth)
            )
            halved, quartered = self.halved[x] & self.halved[y], self.quartered[x] & self.quartered[y]
            left = self.near(np.where(quartered, quarters, np.where(halved, halves, 0)), x, y)
            yield x[left], y[left]

    def below(self, x: np.ndarray) -> np.ndarray:
        """Up to which token another crowd takes a pair of these rows: any does where the token is no crowd."""
        return np.where(self.role[x] < WITHIN, np.iinfo(np.int64).max, self.token[x])

    def surely_elsewhere(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Pairs whose sets have the same least crowd, if that takes them."""
        return (self.first[x] == self.first[y]) & (self.first[x] < self.below(x))

    def elsewhere(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Pairs that another crowd takes, one that both sets are in."""
        taken = self.surely_elsewhere(x, y)
        open_ = np.flatnonzero(~taken & (np.maximum(self.first[x], self.first[y]) < self.below(x)))
        found = []
        for rows in (x[open_], y[open_]):
            number = np.repeat(np.arange(len(open_)), self.held[rows])
            value = self.value[ranges(self.start[rows], self.held[rows])].astype(np.int64)
            left = value < self.below(x[open_])[number]
            found.append((number[left] << 32) + value[left] + (1 << 31))
        both = np.sort(np.concatenate(found))
        taken[open_[both[1:][both[1:] == both[:-1]] >> 32]] = True
        return taken


def meetings(rows: DataFrame) -> DataFrame:
    """Pairs (``a, b``) of sets that share a token of their prefixes and may be similar.

    Pairs with crowds in common come from the least of these only, and where that has over ``DENSE`` a
    member, its members come instead: ``a`` with ``token, cell, role, n, crowds``, ``b`` is null.
    """

    def answer(p: Postings) -> Iterator[pa.RecordBatch]:
        none = lambda k, kind: pa.nulls(k, kind)
        kinds = [pa.int32(), pa.int32(), pa.int8(), pa.int32(), pa.list_(pa.int32())]
        names = [column.split()[0] for column in MEETINGS.split(", ")]

        def pairs(found: list[tuple[np.ndarray, np.ndarray]]) -> pa.RecordBatch:
            x, y = (np.concatenate([np.zeros(0, np.int64), *side]) for side in zip(*found, strict=True))
            sides = np.sort(np.stack([p.rep[x], p.rep[y]], axis=1), axis=1)
            sides = sides[np.lexsort(sides.T[::-1])]
            sides = sides[np.r_[True, (sides[1:] != sides[:-1]).any(1)][: len(sides)]]
            return pa.RecordBatch.from_arrays(
                [*(pa.array(side, pa.int64()) for side in sides.T), *(none(len(sides), k) for k in kinds)], names=names
            )

        crowd = p.role >= WITHIN
        for x, y in p.meeting(np.flatnonzero(p.role == SHORT)):
            left = ~p.elsewhere(x, y)
            yield pairs([(x[left], y[left])])
        stops = np.r_[p.starts[1:], len(p.rep)]
        few: list[tuple[np.ndarray, np.ndarray]] = []
        for start, stop in zip(p.starts[crowd[p.starts]].tolist(), stops[crowd[p.starts]].tolist()):
            own, count, met_ = [], 0, np.zeros(stop - start, bool)
            dense = False
            for x, y in p.meeting(np.arange(start, stop)):
                left = ~(p.surely_elsewhere(x, y) if dense else p.elsewhere(x, y))
                x, y = x[left], y[left]
                met_[x - start] = met_[y - start] = True
                count += len(x)
                dense = dense or count > DENSE * (stop - start)
                own = [] if dense else [*own, (x, y)]
            if count <= DENSE * int(met_.sum()):
                few += own
            else:
                at = np.flatnonzero(met_) + start
                at = at[np.unique(p.rep[at], return_index=True)[1]]
                cell = (p.key[at] & ((1 << KEY_BITS) - 1)) - 1
                columns = [p.token[at], cell, p.role[at], p.n[at], p.crowds.take(pa.array(at))]
                columns = [pa.array(c).cast(k) for c, k in zip(columns, kinds)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(p.rep[at]), none(len(at), pa.int64()), *columns], names=names
                )
        if few:
            yield pairs(few)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count < MEET_ROWS:
                continue
            rows = pa.Table.from_batches(held)
            key = rows.column("key").to_numpy()
            whole = int(np.searchsorted(key, key[-1]))
            if whole:
                yield from answer(Postings(rows.slice(0, whole)))
            held, count = rows.slice(whole).to_batches(), rows.num_rows - whole
        if count:
            yield from answer(Postings(pa.Table.from_batches(held)))

    dealt = rows.repartition("key").sortWithinPartitions("key")
    return materialize(dealt.mapInArrow(meet, MEETINGS), "meetings")


def common_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """The number of common elements of each set on the left with each on the right."""
    found = np.zeros((len(left), len(right)), np.int64)
    sides = [np.concatenate([np.zeros(0, np.uint64), *sets]) for sets in (left, right)]
    both = np.intersect1d(*sides)
    if not len(both):
        return found
    places = []
    for sets, values in zip((left, right), sides):
        row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
        at = np.minimum(np.searchsorted(both, values), len(both) - 1)
        held = both[at] == values
        places.append((len(sets), row[held], at[held]))
    for first in range(0, len(both), COLUMNS):
        marks = []
        for n, row, at in places:
            here = (at >= first) & (at < first + COLUMNS)
            mark = np.zeros((n, min(COLUMNS, len(both) - first)), np.float32)
            mark[row[here], at[here] - first] = 1
            marks.append(mark)
        found += (marks[0] @ marks[1].T).astype(np.int64)
    return found


def block_links(
    token: int, reps: list[np.ndarray], sets: list[list], crowds: list[list], roles: list[np.ndarray]
) -> list[tuple]:
    """``a, root, links`` of the sets of two shares of a crowd, or of one against itself.

    A pair that is in several crowds counts in that of the least token. ``root`` is the
    least set that ``a`` is joined to here.
    """
    same = len(sets) == 1
    sizes = [np.array([len(s) for s in side], np.int64) for side in sets]
    common = common_counts(sets[0], sets[-1])
    alike = 100 * common >= SIMILAR * (sizes[0][:, None] + sizes[-1][None] - common)
    lower = [
        [np.array([c for c in own if c < token], np.int64).view(np.uint64) for own in side]
        for side in crowds
    ]
    alike &= common_counts(lower[0], lower[-1]) == 0
    alike &= (roles[0][:, None] == WITHIN) | (roles[0][:, None] != roles[-1][None])
    if same:
        np.fill_diagonal(alike, False)
    far = np.iinfo(np.int64).max
    roots = [r.copy() for r in reps]
    while True:
        before = [r.copy() for r in roots]
        roots[0] = np.minimum(roots[0], np.where(alike, roots[-1][None], far).min(1))
        roots[-1] = np.minimum(roots[-1], np.where(alike, roots[0][:, None], far).min(0))
        if all((x == y).all() for x, y in zip(before, roots)):
            break
    links = [alike.sum(1)] if same else [alike.sum(1), alike.sum(0)]
    return [
        (a, root, n)
        for side in zip(reps, roots, links)
        for a, root, n in zip(*(column.tolist() for column in side))
        if n
    ]


def crowd_links(members: DataFrame, texts: DataFrame) -> DataFrame:
    """``a, root, links`` of sets in crowds: all members of a cell in blocks, each against each.

    ``members`` has ``token, cell, role, rep, n, crowds``, ``texts`` has ``rep, text``. A set that
    has links in several blocks, or shares of one, has a row for each.
    """
    parts = members.groupBy("token", "cell").agg(
        F.expr(
            f"greatest(ceil(count(1) / {BLOCK_PARTS * BLOCK_SETS}), ceil(sum(n) / {BLOCK_TOKENS}))"
        ).alias("parts")
    )
    dealt = (
        members.join(parts, ["token", "cell"])
        .withColumn("part", F.expr("pmod(xxhash64(rep), parts)"))
        .withColumn("other", F.explode(F.expr("sequence(0L, parts - 1)")))
        .select(
            "token", "cell", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"),
            "part", "rep", "role", "crowds",
        )
    )

    def compare(group: pa.Table) -> pa.Table:
        part, (token, i, j) = group.column("part").to_numpy(), (group.column(c)[0].as_py() for c in ("token", "i", "j"))
        reps, roles = group.column("rep").to_numpy(), group.column("role").to_numpy()
        sets, crowds = token_sets(group.column("text").combine_chunks()), group.column("crowds").to_pylist()
        shares = [
            [at[k : k + BLOCK_SETS] for k in range(0, len(at), BLOCK_SETS)]
            for at in (np.flatnonzero(part == p) for p in sorted({i, j}))
        ]
        if i == j:
            met_ = [(x, y) for k, x in enumerate(shares[0]) for y in shares[0][k:]]
        else:
            met_ = [(x, y) for x in shares[0] for y in shares[1]]
        rows = []
        for x, y in met_:
            sides = [x] if x is y else [x, y]
            rows += block_links(
                token,
                [reps[at] for at in sides],
                [[sets[k] for k in at] for at in sides],
                [[crowds[k] for k in at] for at in sides],
                [roles[at] for at in sides],
            )
        columns = list(zip(*rows)) or [[], [], []]
        return pa.table([pa.array(c, pa.int64()) for c in columns], names=["a", "root", "links"])

    return materialize(
        dealt.join(texts.dropDuplicates(["rep"]), "rep")
        .groupBy("token", "cell", "i", "j")
        .applyInArrow(compare, "a bigint, root bigint, links bigint"),
        "crowd-links",
    )


def signs(texts: DataFrame) -> DataFrame:
    """``rep, n, sign`` of ``texts``: the size of the set, and a parity bit for each of 256 shares of it."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", SET_BYTES):
            words, counts = word_hashes(block.column("text"))
            row = np.repeat(np.arange(len(counts)), counts)
            order = np.lexsort((words, row))
            words, row = words[order], row[order]
            new = np.r_[True, (words[1:] != words[:-1]) | (row[1:] != row[:-1])][: len(words)]
            words, row = words[new], row[new]
            place = row * 64 * SIGN_WORDS + (words % np.uint64(64 * SIGN_WORDS)).astype(np.int64)
            odd = np.bincount(place, minlength=len(counts) * 64 * SIGN_WORDS) & 1
            bits = np.packbits(odd.astype(np.uint8)).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("rep"),
                    pa.array(np.bincount(row, minlength=len(counts)), pa.int32()),
                    pa.ListArray.from_arrays(
                        pa.array(np.arange(0, len(bits) + 1, SIGN_WORDS), pa.int32()), pa.array(bits)
                    ),
                ],
                names=["rep", "n", "sign"],
            )

    return texts.mapInArrow(judge, "rep bigint, n int, sign array<bigint>")


def close(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Those of ``pairs`` whose sets can be similar: they differ in as many tokens at least as signs in bits."""
    known = materialize(signs(texts), "line-signs")
    sides = pairs
    for side in ("a", "b"):
        sides = sides.join(
            known.select(
                F.col("rep").alias(side), F.col("n").alias(f"n_{side}"), F.col("sign").alias(f"s_{side}")
            ),
            side,
        )
    apart = F.expr(" + ".join(f"bit_count(s_a[{i}] ^ s_b[{i}])" for i in range(SIGN_WORDS)))
    both = F.col("n_a") + F.col("n_b")
    return sides.where((100 + SIMILAR) * apart <= (100 - SIMILAR) * both).select("a", "b")


def later_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every_link: bool = False
) -> DataFrame:
    """``doc_id, content, n_lines, removed``: lines with words, and numbers of the removed ones.

    ``content`` is the hash of the text; one row per distinct pair of both. Lines
    are ordered by doc_id (null last), content and number; lines without words
    are neither counted nor removed. Rows that repeat id and text are one.

    With ``every_link`` two columns follow. ``n_links``: of each line, the other sets of words
    that are similar to its own, summed over the lines. ``linked``: line, first line of its
    class (``class_doc, class_content, class_line``) and links, of lines that have links or are removed.
    """
    return materialize_alone(
        lambda: _later_lines(keyed(docs, id_col, text_col), every_link), "later-lines"
    )


def _later_lines(rows: DataFrame, every_link: bool) -> DataFrame:
    features = ["n", "skipped", "prefix", *BITS, "common" if every_link else "parts"]
    lines = materialize(
        line_rows(rows).select("doc_id", "content", "n_lines", "line", "set_key", *features), "lines"
    )
    place = F.struct(F.isnull("doc_id").alias("last"), "doc_id", "content", "line")
    classes = materialize(
        lines.groupBy("set_key")
        .agg(
            F.min(place).alias("first"),
            F.count(F.lit(1)).alias("times"),
            *(F.first(c).alias(c) for c in features),
        )
        .withColumn("rep", F.monotonically_increasing_id()),
        "line-classes",
    )

    def texts_for(reps: DataFrame) -> DataFrame:
        wanted = (
            classes.select("rep", "first")
            .join(reps, "rep")
            .groupBy(F.col("first.doc_id").alias("w_id"), F.col("first.content").alias("w_content"))
            .agg(F.collect_list(F.struct(F.col("first.line").alias("line"), "rep")).alias("wanted"))
        )
        same = (F.col("content") == F.col("w_content")) & F.col("doc_id").eqNullSafe(F.col("w_id"))
        wanted = materialize(wanted, "wanted-lines")
        return (
            maybe_in(rows, "content", wanted.select(F.col("w_content").alias("content")))
            .join(wanted, same)
            .withColumn("lines", F.split("text", "\n", -1))
            .select(F.explode(F.expr("transform(wanted, w -> struct(w.rep, get(lines, cast(w.line AS int)) AS text))")).alias("w"))
            .select("w.rep", "w.text")
        )

    def similar(pairs: DataFrame) -> DataFrame:
        def judge() -> DataFrame:
            texts = materialize(texts_for(ends(pairs)), "line-texts")
            return verified(materialize(close(pairs, texts), "close-pairs"), texts, token_sets, SIMILAR)

        return materialize_alone(judge, "similar-lines")

    def joining() -> DataFrame:
        """Links that join all similar sets."""
        near = similar(materialize(copies(classes), "copies"))
        parts = materialize(components(near), "copy-components").withColumnRenamed("id", "rep")
        joined = materialize(
            classes.join(parts, "rep", "left").select(
                "rep", F.coalesce("component", "rep").alias("component"), "n", "skipped", *BITS, "prefix"
            ),
            "joined-classes",
        )
        placed = joined.select(
            "rep", "component", "n", "skipped", *BITS, F.posexplode("prefix").alias("at", "token")
        ).select("token", "rep", "component", "n", (F.col("skipped") + F.col("at")).alias("pos"), *BITS)
        crowded = materialize(
            placed.groupBy("token").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > CROWD).select("token"),
            "crowded-tokens",
        )
        crowds = materialize(placed.join(crowded, "token", "left_semi"), "crowds")
        led = similar(materialize(met_leaders(crowds).distinct(), "leader-pairs"))
        # Linked to leaders, components are fewer and larger; what is still apart meets as before.
        merged = materialize(
            components(
                led.join(joined.select(F.col("rep").alias("a"), F.col("component").alias("c")), "a")
                .join(joined.select(F.col("rep").alias("b"), F.col("component").alias("d")), "b")
                .select(F.col("c").alias("a"), F.col("d").alias("b"))
            ),
            "merged-components",
        ).select(F.col("id").alias("component"), F.col("component").alias("merged"))
        crowds = materialize(
            crowds.join(merged, "component", "left")
            .withColumn("component", F.coalesce("merged", "component"))
            .drop("merged"),
            "crowds",
        )
        open_ = in_passes(placed, lambda some: met(some.join(crowded, "token", "left_anti")))
        pairs = materialize(open_.union(met_in_crowds(crowds)).distinct(), "line-pairs")
        return near.union(led).union(similar(pairs))

    def all_links() -> tuple[DataFrame, DataFrame]:
        """Links that join all similar sets, and the number of links of each set that has some."""
        at = F.posexplode("prefix").alias("at", "token")
        often = classes.select(F.size("prefix").alias("size"), "common", at).where("at >= size - common")
        crowded = often.groupBy("token").agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > LINK_CROWD)
        crowded = materialize(crowded, "crowded-tokens").toArrow()
        found = [meetings(postings(classes, crowded, k)) for k in range(PASSES)]
        found = reduce(DataFrame.union, found)
        pairs = materialize(found.where("b IS NOT NULL").select("a", "b").distinct(), "line-pairs")
        members = materialize(
            found.where("b IS NULL").select("token", "cell", "role", F.col("a").alias("rep"), "n", "crowds"),
            "crowd-members",
        )
        blocked = crowd_links(members, texts_for(members.select("rep").distinct()))
        links = similar(pairs).distinct()
        numbers = links.select(F.explode(F.array("a", "b")).alias("rep"), F.lit(1).alias("links")).union(
            blocked.select("a", "links")
        )
        counted = materialize(numbers.groupBy("rep").agg(F.sum("links").alias("links")), "link-counts")
        return links.union(blocked.select("a", F.col("root").alias("b"))), counted

    links, counted = all_links() if every_link else (joining(), None)
    joined = materialize(components(links), "line-components").withColumnRenamed("id", "rep")
    # A line whose set is its own and linked with none is neither removed nor marked.
    grouped = materialize(
        classes.select("rep", "set_key", "first", "times")
        .join(joined, "rep", "left")
        .where("component IS NOT NULL OR times > 1")
        .withColumn("component", F.coalesce("component", "rep"))
        .drop("times"),
        "grouped-classes",
    )
    earliest = grouped.groupBy("component").agg(F.min("first").alias("earliest"))
    kept = grouped.join(earliest, "component").select("set_key", "rep", "earliest")
    none = F.lit(None).cast("bigint")
    kept = kept.join(counted, "rep", "left") if every_link else kept.withColumn("links", none)
    judged = (
        lines.select("doc_id", "content", "n_lines", "line", "set_key")
        .join(kept.drop("rep"), "set_key")
        .withColumn("later", place != F.col("earliest"))
        .withColumn("links", F.coalesce("links", F.lit(0)))
        .where("later OR links > 0")
    )
    class_ = F.struct(
        "line",
        F.col("earliest.doc_id").alias("class_doc"),
        F.col("earliest.content").alias("class_content"),
        F.col("earliest.line").alias("class_line"),
        F.col("links").alias("n_links"),
    )
    key = ["doc_id", "content", "n_lines"]
    removed = F.when(F.col("later"), F.col("line")).alias("gone")
    marked = judged.select(*key, removed, class_.alias("mark"))
    plain = lines.select(*key).distinct()
    nothing = [F.lit(None).cast(marked.schema[c].dataType).alias(c) for c in ("gone", "mark")]
    found = (
        marked.union(plain.select(*key, *nothing))
        .groupBy("doc_id", "content")
        .agg(
            F.max("n_lines").cast("bigint").alias("n_lines"),
            F.array_sort(F.collect_set("gone")).alias("removed"),
            *([F.array_sort(F.collect_set("mark")).alias("linked")] if every_link else []),
        )
    )
    if not every_link:
        return found
    total = F.expr("aggregate(linked, 0L, (s, x) -> s + x.n_links)").alias("n_links")
    return found.select("doc_id", "content", "n_lines", "removed", total, "linked")


def linked_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """:func:`later_lines` with the class and the number of links of every line."""
    return later_lines(docs, id_col, text_col, every_link=True)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with the later lines of each class taken out of its text.

    A text that loses all lines with words goes with them; a text that had none
    from the start (or is null) stays as it is, as do all other columns.
    """
    found = later_lines(docs, id_col, text_col).select(
        F.col("doc_id").alias("__l_id"),
        F.col("content").alias("__l_content"),
        F.col("n_lines").alias("__n"),
        F.col("removed").alias("__removed"),
    )
    text = F.coalesce(F.col(text_col), F.lit(""))
    same = (F.xxhash64(text) == F.col("__l_content")) & F.col(id_col).cast("bigint").eqNullSafe(
        F.col("__l_id")
    )
    left = F.expr(
        f"array_join(filter(split(`{text_col}`, '\\n', -1), "
        "(l, i) -> NOT array_contains(__removed, cast(i AS bigint))), '\\n')"
    )
    return (
        docs.join(found, same, "left")
        .where("__n IS NULL OR size(__removed) < __n")
        .withColumn(text_col, F.when(F.size("__removed") > 0, left).otherwise(F.col(text_col)))
        .select(*(f"`{c}`" for c in docs.columns))
    )
