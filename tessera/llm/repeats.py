"""Removal of repeated byte strings by a column-wise Burrows-Wheeler construction.

Equal windows have equal anchors at equal places, so a repeated window only ever
meets segments with its anchor. The distinct segments of an anchor are lined up on
it and inserted together, from the last column to the first, one symbol per
segment and round. A round turns the order of all suffixes of one column into that
of the next: the column of symbols in the present order (the transform) is dealt
out by symbol, front to back, and the common prefixes of neighbours are carried
along as minima over what lies between them. A window is repeated if its suffix
shares its whole length with a neighbour, or if its segment occurs twice.

Lined up on anchors, columns never meet each other's suffixes; a round reads and
writes one column and not all that came before it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.anchors import GRAM, WINDOW, Segments, segments
from tessera.llm.blocks import blocks
from tessera.workspace import materialize

FILTER_BITS = 27
BLOCK_BYTES = 2 << 20  # some 80 bytes of arrays for each
STRINGS = 20_000  # lined up at once
CROWDED = 20_000  # distinct segments of an anchor that are cut into shorter ones
NARROW = (16, 1)  # windows of a segment after each cut

FOUND = "anchor bigint, segment bigint, content bigint, first int, windows int, shift int"
STRINGS_DDL = (
    "anchor bigint, part bigint, of_anchor bigint, of_segment bigint, skipped bigint, copies bigint, "
    "windows bigint, shift bigint, data binary"
)


def flat_bytes(texts: pa.Array) -> tuple[bytes, np.ndarray]:
    parts = [(t or "").encode() for t in texts.to_pylist()]
    return b"".join(parts), np.array([len(p) for p in parts], np.int64)


def repeated_windows(
    data: np.ndarray, start: np.ndarray, size: np.ndarray, shift: np.ndarray, windows: np.ndarray,
    window: int,
) -> np.ndarray:
    """For all windows of all strings, one after the other: whether another string has it
    at the same distance from its anchor. Distinct strings begin at ``start`` in ``data``.
    """
    base = np.cumsum(windows) - windows
    repeated = np.zeros(int(windows.sum()), bool)
    last = size - shift - 1
    enter = np.argsort(-last, kind="stable")
    entered = 0
    order = np.zeros(0, np.int64)
    common = np.zeros(0, np.int32)
    for column in range(int(last.max()), -int(shift.max()) - 1, -1):
        gone = -shift[order] > column
        if gone.any():
            kept = np.flatnonzero(~gone)
            order = order[kept]
            if len(kept):
                common = np.minimum.reduceat(common, np.r_[0, kept[:-1] + 1])
                common[0] = 0
            else:
                common = common[:0]
        stop = entered
        while stop < len(enter) and last[enter[stop]] == column:
            stop += 1
        if stop > entered:
            # Nothing follows the last symbol of a string: it comes first and shares nothing.
            order = np.r_[enter[entered:stop], order]
            common = np.r_[np.zeros(stop - entered, np.int32), common]
            if len(common) > stop - entered:
                common[stop - entered] = 0
            entered = stop
        if not len(order):
            continue
        symbol = data[start[order] + shift[order] + column]
        turn = np.argsort(symbol, kind="stable")
        between = np.minimum.reduceat(np.r_[common, np.int32(0)], turn + 1)
        order, symbol = order[turn], symbol[turn]
        common = np.zeros(len(turn), np.int32)
        common[1:] = np.where(symbol[1:] == symbol[:-1], between[:-1] + 1, 0)
        equal = common >= window
        equal[:-1] |= equal[1:]
        hit = order[equal]
        at = shift[hit] + column
        real = at < windows[hit]
        repeated[base[hit[real]] + at[real]] = True
    return repeated


def runs(flags: np.ndarray) -> list[list[int]]:
    """First and past-the-last place of every run of true flags."""
    edge = np.flatnonzero(np.diff(np.r_[False, flags, False]))
    return edge.reshape(-1, 2).tolist()


def slot_of(anchor: np.ndarray) -> np.ndarray:
    """The place of an anchor in the filter; anchors are small hashes, so they are mixed again."""
    return ((anchor * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def segment_rows(block: pa.RecordBatch, window: int, keep: np.ndarray) -> pa.RecordBatch:
    """Segments of a block whose anchor passes the filter."""
    flat, sizes = flat_bytes(block.column("text"))
    found = segments(np.frombuffer(flat, np.uint8), sizes, window)
    slot = slot_of(found.anchor)
    passes = (keep[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1) == 1
    found = Segments(*(x[passes] for x in found))
    begin = np.cumsum(sizes) - sizes
    row = np.searchsorted(begin, found.first, side="right") - 1
    keys = [
        xxhash.xxh3_64_intdigest(flat[a : a + n + window - 1]) - 2**63
        for a, n in zip(found.first.tolist(), found.windows.tolist())
    ]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(found.anchor.view(np.int64)),
            pa.array(keys, pa.int64()),
            block.column("content").take(pa.array(row)),
            pa.array((found.first - begin[row]).astype(np.int32)),
            pa.array(found.windows.astype(np.int32)),
            pa.array(found.shift.astype(np.int32)),
        ],
        names=["anchor", "segment", "content", "first", "windows", "shift"],
    )


def repeated_anchors(rows: DataFrame, window: int) -> np.ndarray:
    """A bitmap of fixed size of the anchors that may occur twice."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK_BYTES):
            flat, sizes = flat_bytes(block.column("text"))
            anchor = segments(np.frombuffer(flat, np.uint8), sizes, window).anchor
            slot, times = np.unique(slot_of(anchor).astype(np.int32), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot), pa.array(np.minimum(times, 2).astype(np.int32))],
                names=["slot", "times"],
            )

    words = (
        rows.select("text")
        .mapInArrow(count, "slot int, times int")
        .groupBy("slot")
        .agg(F.sum("times").alias("times"))
        .where("times > 1")
        .groupBy(F.expr("slot div 64").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, slot % 64))").alias("bits"))
        .toArrow()
    )
    keep = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    if words.num_rows:
        at = words.column("word").to_numpy()
        keep[at] = words.column("bits").to_numpy().view(np.uint64)
    return keep


def narrower(strings: DataFrame, width: int, window: int) -> DataFrame:
    """Segments cut into parts of ``width`` windows, keyed by all bytes that these share."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "data"):
            rows = []
            for r in block.to_pylist():
                # Windows by their distance from the anchor, in groups that are the same everywhere.
                for group in range((r["shift"] - r["windows"] + 1) // width, r["shift"] // width + 1):
                    a = max(0, r["shift"] - (group + 1) * width + 1)
                    b = min(r["windows"], r["shift"] - group * width + 1)
                    core = r["shift"] - group * width
                    shared = r["data"][core : core - width + 1 + window]
                    part = r["data"][a : b + window - 1]
                    rows.append(
                        {
                            "anchor": xxhash.xxh3_64_intdigest(shared, seed=group % 2**32) - 2**63,
                            "part": xxhash.xxh3_64_intdigest(part) - 2**63,
                            "of_anchor": r["of_anchor"],
                            "of_segment": r["of_segment"],
                            "skipped": r["skipped"] + a,
                            "copies": r["copies"],
                            "windows": b - a,
                            "shift": core - a,
                            "data": part,
                        }
                    )
            yield pa.RecordBatch.from_pylist(rows, schema=CUT)

    return strings.select(*CUT.names).mapInArrow(cut, STRINGS_DDL)


CUT = pa.schema(
    [("anchor", pa.int64()), ("part", pa.int64()), ("of_anchor", pa.int64()),
     ("of_segment", pa.int64()), ("skipped", pa.int64()), ("copies", pa.int64()),
     ("windows", pa.int64()), ("shift", pa.int64()), ("data", pa.binary())]
)


def judged(strings: DataFrame, window: int) -> DataFrame:
    """Repeated windows of strings, as ``spans`` of first and past-the-last.

    Strings of one anchor come together and equal parts of it one after the other.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        owners: list[list[dict]] = []

        def out() -> pa.RecordBatch:
            data = b"".join(r["data"] for r in held)
            size = np.array([len(r["data"]) for r in held], np.int64)
            windows = np.array([r["windows"] for r in held], np.int64)
            flags = repeated_windows(
                np.frombuffer(data, np.uint8),
                np.cumsum(size) - size,
                size,
                np.array([r["shift"] for r in held], np.int64),
                windows,
                window,
            )
            rows = []
            for r, of, own in zip(held, owners, np.split(flags, np.cumsum(windows)[:-1])):
                twice = sum(o["copies"] for o in of) > 1
                spans = [[0, r["windows"]]] if twice else runs(own)
                if spans:
                    rows += [
                        {
                            "anchor": o["of_anchor"],
                            "segment": o["of_segment"],
                            "spans": [[a + o["skipped"], b + o["skipped"]] for a, b in spans],
                        }
                        for o in of
                    ]
            held.clear()
            owners.clear()
            return pa.RecordBatch.from_pylist(rows, schema=JUDGED)

        for batch in batches:
            for row in batch.to_pylist():
                new_anchor = not held or row["anchor"] != held[-1]["anchor"]
                if not new_anchor and row["part"] == held[-1]["part"]:
                    row.pop("data")
                    owners[-1].append(row)
                    continue
                if new_anchor and len(held) >= STRINGS:
                    yield out()
                held.append(row)
                owners.append([row])
        if held:
            yield out()

    return (
        strings.repartition("anchor")
        .sortWithinPartitions("anchor", "part")
        .mapInArrow(judge, "anchor bigint, segment bigint, spans array<array<bigint>>")
    )


JUDGED = pa.schema(
    [("anchor", pa.int64()), ("segment", pa.int64()), ("spans", pa.list_(pa.list_(pa.int64())))]
)


def packed(rows: DataFrame) -> DataFrame:
    """``text`` as compressed UTF-8, for the way through a shuffle."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for block in blocks(batches, "text", BLOCK_BYTES):
            data = [squeeze.compress(t.encode()) for t in block.column("text").to_pylist()]
            columns = [*(block.column(c) for c in ("doc_id", "content")), pa.array(data, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "content", "packed"])

    return rows.select("doc_id", "content", "text").mapInArrow(
        pack, "doc_id bigint, content bigint, packed binary"
    )


def cut_out(found: DataFrame, rows: DataFrame, window: int) -> DataFrame:
    """The distinct segments with their bytes, each taken from one of the texts that have it."""
    chosen = (
        found.groupBy("anchor", "segment")
        .agg(
            F.count(F.lit(1)).alias("copies"),
            F.min(F.struct("content", "first", "windows", "shift")).alias("at"),
        )
        .groupBy(F.col("at.content").alias("content"))
        .agg(
            F.collect_list(
                F.struct("anchor", "segment", "copies", "at.first", "at.windows", "at.shift")
            ).alias("wanted")
        )
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread = zstandard.ZstdDecompressor()
        for block in blocks(batches, "packed", 1 << 20):
            out = []
            for row in block.to_pylist():
                data = spread.decompress(row["packed"])
                for w in row["wanted"]:
                    end = w["first"] + w["windows"] + window - 1
                    out.append(
                        {
                            "anchor": w["anchor"], "part": w["segment"], "of_anchor": w["anchor"],
                            "of_segment": w["segment"], "skipped": 0, "copies": w["copies"],
                            "windows": w["windows"], "shift": w["shift"],
                            "data": data[w["first"] : end],
                        }
                    )
            yield pa.RecordBatch.from_pylist(out, schema=CUT)

    return (
        packed(rows)
        .groupBy("content")
        .agg(F.first("packed").alias("packed"))
        .join(chosen, "content")
        .select("packed", "wanted")
        .mapInArrow(cut, STRINGS_DDL)
    )


def repeated_spans(rows: DataFrame, window: int) -> DataFrame:
    """Repeated windows of texts: ``content, from, to`` in bytes, past the last."""
    spark = rows.sparkSession
    keep = spark.sparkContext.broadcast(repeated_anchors(rows, window))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", BLOCK_BYTES):
            yield segment_rows(block, window, keep.value)

    found = materialize(rows.select("content", "text").mapInArrow(find, FOUND), "segments")
    strings = cut_out(found, rows, window)
    parts = found.select("anchor", "segment").distinct()
    decided = None
    for width in (*NARROW, None):
        crowded = materialize(
            parts.groupBy("anchor").count().where(f"count > {CROWDED}").select("anchor"), "crowded"
        )
        if width is None or crowded.isEmpty():
            spans = judged(strings, window)
            decided = spans if decided is None else decided.union(spans)
            break
        spans = judged(strings.join(crowded, "anchor", "left_anti"), window)
        decided = spans if decided is None else decided.union(spans)
        strings = materialize(
            narrower(strings.join(crowded, "anchor", "left_semi"), width, window), "strings"
        )
        parts = strings.select("anchor", "part").distinct()
    return (
        found.select("anchor", "segment", "content", "first")
        .join(decided, ["anchor", "segment"])
        .select("content", "first", F.explode("spans").alias("span"))
        .select(
            "content",
            (F.col("first") + F.col("span")[0]).alias("from"),
            (F.col("first") + F.col("span")[1] + (window - 1)).alias("to"),
        )
    )


def remove_repeats(
    docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Bytes left of every whole text once all repeated strings of ``window`` bytes are gone.

    Returns ``doc_id, n_bytes, n_removed, n_spans, kept`` (binary), one row per
    input row. Null is empty. A row that occurs twice repeats itself; equal texts
    get equal results whatever their ids.
    """
    if window < GRAM:
        raise ValueError(f"windows must have {GRAM} bytes or more")
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("content")
    )
    spans = (
        repeated_spans(rows, window)
        .groupBy("content")
        .agg(F.collect_set(F.struct("from", "to")).alias("spans"))
    )

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spread = zstandard.ZstdDecompressor()
        for block in blocks(batches, "packed", 1 << 20):
            out: list[tuple[int, int, int, bytes]] = []
            for text, spans in zip(
                block.column("packed").to_pylist(), block.column("spans").to_pylist()
            ):
                data, kept, at, n = spread.decompress(text), [], 0, 0
                end = -1
                for span in sorted((s["from"], s["to"]) for s in spans or []):
                    if span[0] > end:
                        kept.append(data[at : span[0]])
                        n += 1
                    at = end = max(end, span[1])
                kept.append(data[max(at, 0) :])
                left = b"".join(kept)
                out.append((len(data), len(data) - len(left), n, left))
            columns = list(zip(*out)) or [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"),
                    *(pa.array(c, pa.int64()) for c in columns[:3]),
                    pa.array(columns[3], pa.binary()),
                ],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"],
            )

    return (
        packed(rows)
        .join(spans, "content", "left")
        .select("doc_id", "packed", "spans")
        .mapInArrow(cut, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    )
