"""Links between members of shared buckets without expanding groups into pairs.

All members of a bucket are first held against two leaders. What is verified is
joined to components, and only pairs of members that are still in different
components are then held against each other, so no link between components is
lost and a group of near copies is not expanded into its pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.blocks import SET_BYTES, blocks
from tessera.llm.components import components
from tessera.workspace import materialize

TOGETHER = 128  # members held against a leader in one task
SLOT_BITS = 27
PARITY_BITS = 512

Fits = Callable[[Column, Column], Column]
Sets = Callable[[pa.Array], list[np.ndarray]]


def verified(pairs: DataFrame, texts: DataFrame, sets: Sets, percent: int) -> DataFrame:
    """Those of ``pairs`` (``a, b``) whose full sets, made from ``texts`` (``rep, text``), are similar.

    The members ``b`` of a leader ``a`` are dealt out in parts of bounded size,
    each with the leader's text.
    """
    sizes = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / TOGETHER).alias("parts"))
    dealt = materialize(
        pairs.join(sizes, "a").select("a", "b", F.expr("pmod(xxhash64(b), parts)").alias("part")),
        "pairs",
    )
    members = dealt.join(texts.withColumnRenamed("rep", "b"), "b").select(
        "a", "part", F.lit(1).alias("place"), "b", "text"
    )
    leaders = (
        dealt.select("a", "part")
        .distinct()
        .join(texts.withColumnRenamed("rep", "a"), "a")
        .select("a", "part", F.lit(0).alias("place"), F.col("a").alias("b"), "text")
    )

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        leader, own = None, np.zeros(0, np.uint64)
        for block in blocks(batches, "text", SET_BYTES):
            found_sets = sets(block.column("text"))
            out_a, out_b = [], []
            places = zip(
                block.column("a").to_pylist(), block.column("b").to_pylist(),
                block.column("place").to_pylist(), found_sets,
            )
            for a, b, place, found in places:
                if place == 0:
                    leader, own = a, found
                    continue
                if a != leader:
                    raise ValueError("a member came before its leader")
                both = np.r_[own, found]
                both.sort()
                common = int((both[1:] == both[:-1]).sum())
                if 100 * common >= percent * (len(both) - common):
                    out_a.append(a)
                    out_b.append(b)
            yield pa.RecordBatch.from_arrays(
                [pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64())], names=["a", "b"]
            )

    rows = members.unionByName(leaders).repartition("a", "part")
    return materialize(
        rows.sortWithinPartitions("a", "part", "place").mapInArrow(compare, "a bigint, b bigint"),
        "similar-pairs",
    )


def shared_slots(texts: DataFrame, sets: Sets) -> np.ndarray:
    """A bitmap of fixed size of the elements that may be in two of the sets."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", SET_BYTES):
            found = sets(block.column("text"))
            values = np.concatenate([np.zeros(0, np.uint64), *found])
            slot = (values >> np.uint64(64 - SLOT_BITS)).astype(np.int32)
            slot, times = np.unique(slot, return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(slot), pa.array(np.minimum(times, 2).astype(np.int32))],
                names=["slot", "times"],
            )

    words = (
        texts.select("text")
        .mapInArrow(count, "slot int, times int")
        .groupBy("slot")
        .agg(F.sum("times").alias("times"))
        .where("times > 1")
        .groupBy(F.expr("slot div 64").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, slot % 64))").alias("bits"))
        .toArrow()
    )
    shared = np.zeros(1 << (SLOT_BITS - 6), np.uint64)
    if words.num_rows:
        shared[words.column("word").to_numpy()] = words.column("bits").to_numpy().view(np.uint64)
    return shared


def measured(texts: DataFrame, sets: Sets, percent: int) -> DataFrame:
    """``rep, shared, parity`` of ``texts`` that can be similar to another of them.

    ``shared`` is the number of elements that may occur in others; with fewer than
    ``percent`` of its own a text is similar to none and left out. ``parity`` has a bit
    for each of 512 shares of the elements.
    """
    known = texts.sparkSession.sparkContext.broadcast(shared_slots(texts, sets))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = known.value
        for block in blocks(batches, "text", SET_BYTES):
            reps, shared, parity = [], [], []
            for rep, found in zip(block.column("rep").to_pylist(), sets(block.column("text"))):
                slot = (found >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
                common = (slots[slot >> 6] >> (slot & 63).astype(np.uint64)) & np.uint64(1)
                if 100 * int(common.sum()) >= percent * len(found):
                    odd = np.bincount((found & np.uint64(PARITY_BITS - 1)).astype(np.int64), minlength=PARITY_BITS)
                    reps.append(rep)
                    shared.append(int(common.sum()))
                    parity.append(np.packbits((odd & 1).astype(np.uint8)).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(reps, pa.int64()),
                    pa.array(shared, pa.int64()),
                    pa.array(parity, pa.list_(pa.int64())),
                ],
                names=["rep", "shared", "parity"],
            )

    return texts.mapInArrow(judge, "rep bigint, shared bigint, parity array<bigint>")


def ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()


def parted(members: DataFrame) -> DataFrame:
    """``bucket, major`` of buckets in several components, with that of most members."""
    sizes = members.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("members"))
    return (
        sizes.groupBy("bucket")
        .agg(
            F.count(F.lit(1)).alias("parts"),
            F.max(F.struct("members", "component")).getField("component").alias("major"),
        )
        .where("parts > 1")
        .drop("parts")
    )


def crossing(open_: DataFrame, fits: Fits, percent: int) -> DataFrame:
    """Pairs (``a, b``) of members of different components that may be similar, each from one bucket.

    Of the buckets that both are in (``buckets`` of each), the least forms the pair.
    """
    minor = open_.where("component <> major").select(
        "bucket",
        F.col("rep").alias("a"),
        F.col("n").alias("n_a"),
        F.col("component").alias("c_a"),
        F.col("shared").alias("s_a"),
        F.col("parity").alias("p_a"),
        F.col("buckets").alias("in_a"),
    )
    # What both share is no more than what either shares with any; sets differ in as
    # many elements at least as their parities in bits.
    both = F.col("n_a") + F.col("n")
    apart = F.expr(" + ".join(f"bit_count(p_a[{i}] ^ parity[{i}])" for i in range(PARITY_BITS // 64)))
    return (
        minor.join(open_, "bucket")
        .where(
            (F.col("c_a") != F.col("component"))
            & ((F.col("component") == F.col("major")) | (F.col("rep") < F.col("a")))
            & fits(F.col("n_a"), F.col("n"))
            & ((100 + percent) * F.least("s_a", "shared") >= percent * both)
            & ((100 + percent) * apart <= (100 - percent) * both)
            & (F.col("bucket") == F.array_min(F.array_intersect("in_a", "buckets")))
        )
        .select("a", F.col("rep").alias("b"))
    )


def linked(
    placed: DataFrame,
    fits: Fits,
    texts_for: Callable[[DataFrame], DataFrame],
    sets: Sets,
    percent: int,
) -> DataFrame:
    """Links (``a, b``) that join all similar members of ``placed`` (``bucket, rep, n``).

    ``fits(n_a, n_b)`` says which members of a bucket can be similar at all, by the
    sizes of their sets; ``texts_for`` gives ``rep, text`` for a table of ``rep``.
    """
    heads = (
        placed.groupBy("bucket")
        .agg(F.min("rep").alias("low"), F.max("rep").alias("high"))
        .where("low < high")
    )
    met = materialize(placed.join(heads, "bucket"), "bucket-members")
    leader = met.where("rep = low OR rep = high").select(
        "bucket", F.col("rep").alias("a"), F.col("n").alias("n_a")
    )
    can = fits(F.col("n_a"), F.col("n"))
    tested = materialize(
        met.join(leader, "bucket")
        .where((F.col("a") != F.col("rep")) & can)
        .select("a", F.col("rep").alias("b"))
        .distinct(),
        "leader-pairs",
    )
    links = verified(tested, materialize(texts_for(ends(tested)), "texts"), sets, percent)

    joined = components(links)
    where = materialize(
        met.select("bucket", "rep", "n")
        .join(joined.withColumnRenamed("id", "rep"), "rep", "left")
        .withColumn("component", F.coalesce("component", "rep")),
        "placed-members",
    )
    divided = materialize(
        where.join(parted(where).select("bucket"), "bucket", "left_semi"), "divided-members"
    )
    texts = materialize(texts_for(divided.select("rep").distinct()), "open-texts")
    known = materialize(measured(texts, sets, percent), "measured")
    possible = materialize(divided.join(known, "rep", "left_semi"), "possible-members")
    shared = materialize(possible.join(parted(possible), "bucket"), "shared-members")
    open_ = materialize(
        shared.join(known, "rep").join(shared.groupBy("rep").agg(F.collect_set("bucket").alias("buckets")), "rep"),
        "open-members",
    )
    untested = crossing(open_, fits, percent).join(tested, ["a", "b"], "left_anti").join(
        tested.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_anti"
    )
    untested = materialize(untested, "crossing-pairs")
    texts = materialize(texts_for(ends(untested)), "texts")
    return links.union(verified(untested, texts, sets, percent))
