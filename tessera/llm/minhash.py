"""Near duplicates by fast similarity sketching, banding and exact verification.

A sketch has a fixed number of bins. In each round every shingle is hashed into
one bin with a value that grows with the round, and each bin keeps its minimum;
after as many rounds as there are bins, each further round fills one given bin
with all shingles, so that every bin fills in the end. Rounds stop as soon as all
bins of a text are filled, which large sets need one or two rounds for.

Texts with equal sets are one class. Classes that agree on all bins of a band
share a bucket, whose members are linked after a comparison of their full sets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.blocks import SET_BYTES, blocks, large_texts
from tessera.llm.components import components
from tessera.llm.linking import linked
from tessera.workspace import materialize, materialize_alone

BANDS = 32
ROWS = 4
SIMILAR = 80  # percent

ODD = np.uint64(0x9E3779B97F4A7C15)
SKETCHED = "doc_id bigint, content bigint, n_shingles bigint, set_key string, bands array<bigint>"


def mix(x: np.ndarray) -> np.ndarray:
    """A fixed mixing of 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts, A-Z lower-cased, and the number of each text."""
    texts = pc.ascii_lower(large_texts(texts))
    split = pc.split_pattern_regex(texts, r"[\t-\r ]+")
    flat = split.flatten()
    real = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    ends = np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))
    held = np.r_[0, np.cumsum(real)][np.r_[0, ends]]
    coded = flat.filter(pa.array(real)).dictionary_encode()
    known = np.array(
        [xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64
    )
    return known[coded.indices.to_numpy()] if len(known) else known, np.diff(held)


def shingle_sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """The sorted distinct shingles of every text; one for all words if they are fewer."""
    words, counts = hashed_words(texts)
    sets = []
    for text in np.split(words, np.cumsum(counts)[:-1]):
        width = min(size, len(text))
        if not width:
            sets.append(text)
            continue
        n = len(text) - width + 1
        value = np.full(n, width, np.uint64)
        for k in range(width):
            value = mix((value ^ text[k : k + n]) + ODD)
        sets.append(np.unique(value))
    return sets


def sketches(sets: list[np.ndarray], bins: int) -> np.ndarray:
    """Fast similarity sketches of non-empty sets, a row for each."""
    out = np.full(len(sets) * bins, np.iinfo(np.uint64).max, np.uint64)
    values = np.concatenate(sets) if sets else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    empty = out[0] if len(out) else None
    low = np.uint64(0xFFFFFFFF)
    for turn in range(2 * bins):
        if not len(values):
            break
        hashed = mix(values + np.uint64((turn + 1) * int(ODD) % 2**64))
        if turn < bins:
            bin_of = ((hashed >> np.uint64(32)) % np.uint64(bins)).astype(np.int64)
        else:
            bin_of = np.full(len(values), turn - bins)
        np.minimum.at(out, owner * bins + bin_of, (np.uint64(turn) << np.uint64(32)) | (hashed & low))
        open_ = (out.reshape(-1, bins) == empty).any(1)
        left = open_[owner]
        if not left.all():
            values, owner = values[left], owner[left]
    return out.reshape(-1, bins)


def banded(sketch: np.ndarray, rows: int) -> np.ndarray:
    """A hash of each band of each sketch."""
    value = np.arange(sketch.shape[1] // rows, dtype=np.uint64)[None].repeat(len(sketch), 0)
    for k in range(rows):
        value = mix((value ^ sketch[:, k::rows]) + ODD)
    return value.astype(np.int64)


def sketched(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "text", SET_BYTES):
            sets = shingle_sets(block.column("text"), shingle)
            full = [i for i, s in enumerate(sets) if len(s)]
            keys: list[str | None] = [None] * len(sets)
            found: list[np.ndarray | None] = [None] * len(sets)
            for i, value in zip(full, banded(sketches([sets[i] for i in full], bands * rows), rows)):
                keys[i], found[i] = xxhash.xxh3_128_hexdigest(sets[i].tobytes()), value
            yield pa.RecordBatch.from_arrays(
                [
                    block.column("doc_id"),
                    block.column("content"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(keys, pa.string()),
                    pa.array(found, pa.list_(pa.int64())),
                ],
                names=["doc_id", "content", "n_shingles", "set_key", "bands"],
            )

    return docs.mapInArrow(sketch, SKETCHED)


def close_enough(n_a: Column, n_b: Column) -> Column:
    """Set sizes that can be similar at all."""
    return 100 * F.least(n_a, n_b) >= SIMILAR * F.greatest(n_a, n_b)


def near_duplicates(
    docs: DataFrame,
    shingle: int = 5,
    bands: int = BANDS,
    rows: int = ROWS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row.

    Texts are linked from 80 percent of common shingles on; the component is the
    smallest linked id, directly or over others, and is kept. A text without
    words is linked with nothing. Rows that share an id count as one document
    with several texts; a row without id is not linked and stays. With 32 bands of
    4 bins a pair at the threshold shares no bucket with probability 5e-8.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    source = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"), F.xxhash64(text).alias("content"), text.alias("text")
    )
    return materialize_alone(lambda: _near_duplicates(source, shingle, bands, rows), "near-duplicates")


def _near_duplicates(source: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    found = materialize(sketched(source, shingle, bands, rows), "sketches")
    worded = found.where("doc_id IS NOT NULL AND n_shingles > 0")
    classes = materialize(
        worded.groupBy("set_key")
        .agg(
            F.min(F.struct("doc_id", "content")).alias("first"),
            F.first("n_shingles").alias("n"),
            F.first("bands").alias("bands"),
        )
        .withColumn("rep", F.monotonically_increasing_id()),
        "set-classes",
    )
    placed = classes.select("rep", "n", F.posexplode("bands").alias("band", "bin")).select(
        F.xxhash64("band", "bin").alias("bucket"), "rep", "n"
    )

    def texts_for(reps: DataFrame) -> DataFrame:
        wanted = classes.join(reps, "rep").select("rep", "first.*")
        return source.join(wanted, ["doc_id", "content"]).select("rep", "text")

    links = linked(placed, close_enough, texts_for, lambda t: shingle_sets(t, shingle), SIMILAR)
    # An id with several texts links their classes.
    shared = (
        worded.join(classes.select("set_key", "rep"), "set_key")
        .groupBy("doc_id")
        .agg(F.min("rep").alias("a"), F.max("rep").alias("last"), F.collect_set("rep").alias("reps"))
        .where("a < last")
        .select("a", F.explode("reps").alias("b"))
    )
    joined = components(links.union(shared)).withColumnRenamed("id", "rep")
    numbered = materialize(
        classes.select("set_key", "rep", F.col("first.doc_id").alias("least"))
        .join(joined, "rep", "left")
        .withColumn("component", F.coalesce("component", "rep")),
        "class-components",
    )
    smallest = numbered.groupBy("component").agg(F.min("least").alias("component_id"))
    named = numbered.join(smallest, "component").select("set_key", "component_id")
    alone = F.col("doc_id").isNull() | (F.col("n_shingles") == 0)
    return (
        found.join(named, "set_key", "left")
        .withColumn("component_id", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")))
        .select(
            "doc_id",
            "n_shingles",
            "component_id",
            F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept"),
        )
    )
