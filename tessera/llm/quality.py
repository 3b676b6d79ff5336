"""Quality rules: counts of words and lines, and the fertility of a public vocabulary.

A text that passes the base rules is measured by a public vocabulary: characters
per token, share of tokens that are bytes because no piece fits, and entropy of
the tokens in bits. It is rejected outside the wide limits of its main script, and
outside the fences of its own kind: texts of one language label, main script and
size, as powers of two of tokens, since entropy grows with the length. The fences
are Tukey's, from the quartiles of all distinct texts of a kind that pass so far.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.llm.blocks import texts_of
from tessera.llm.pieces import PieceModel, encoded_blocks
from tessera.llm.scripts import main_script, script_table
from tessera.workspace import materialize

SYMBOLS = "#*$%&|<>"
WHITE = " \t\n\v\f\r"


class Band(NamedTuple):
    """What a script's texts may measure, both ends included."""

    chars_per_token: tuple[float, float]
    byte_share: float
    entropy: float


# Wide on purpose: scripts that the vocabulary spells in bytes have few characters per token.
BANDS = {
    "latin": Band((1.5, 12.0), 0.15, 3.5),
    "greek": Band((0.6, 8.0), 0.5, 3.0),
    "cyrillic": Band((0.8, 8.0), 0.15, 3.0),
    "hangul": Band((0.25, 6.0), 0.95, 3.0),
    "kana": Band((0.3, 6.0), 0.8, 3.0),
    "han": Band((0.25, 6.0), 0.95, 3.0),
}
OTHER = Band((0.2, 12.0), 1.0, 3.0)

# Quartile distances that a text may lie below or above the middle half of its kind: Tukey's
# inner fence on the side of noise, the outer one on the other. A quartile distance counts as
# a share of the median at least, lest near copies narrow their kind to themselves.
BELOW, ABOVE = 1.5, 3.0
LEAST_SPREAD = 0.02
DIGITS = 3  # measures are rounded to so many for the quartiles
KIND = ["__lang", "__script", "__size"]

MEASURED = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("word_chars", pa.int64()),
        ("n_symbols", pa.int64()),
        ("n_dup_lines", pa.int64()),
        ("n_repeat_words", pa.int64()),
        ("base_failed", pa.bool_()),
        ("kept", pa.bool_()),
        ("script", pa.string()),
        ("chars_per_token", pa.float64()),
        ("byte_share", pa.float64()),
        ("token_entropy", pa.float64()),
    ]
)
MEASURED_DDL = (
    "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, "
    "n_repeat_words bigint, base_failed boolean, kept boolean, script string, "
    "chars_per_token double, byte_share double, token_entropy double"
)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three found at least twice."""
    if len(words) < 4:
        return 0
    seen: dict[bytes, int] = {}
    number = np.array([seen.setdefault(w, len(seen)) for w in words], np.int64)
    base = len(seen)
    if base < 2_000_000:
        windows = (number[:-2] * base + number[1:-1]) * base + number[2:]
    else:
        _, pairs = np.unique(number[:-1] * base + number[1:], return_inverse=True)
        windows = pairs[:-1] * base + number[2:]
    order = np.sort(windows)
    twice = order[1:][order[1:] == order[:-1]]
    if not len(twice):
        return 0
    at = np.isin(windows, twice)
    inside = np.zeros(len(words), bool)
    inside[:-2] |= at
    inside[1:-1] |= at
    inside[2:] |= at
    return int(inside.sum())


def base_counts(text: str) -> tuple[int, int, int, int, int]:
    words = text.encode().split()
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    return (
        len(words),
        len(text) - sum(map(text.count, WHITE)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(words),
    )


def fertility(text: str, ids: np.ndarray, model: PieceModel) -> tuple[float, float, float]:
    """Characters per token, share of byte tokens (white space apart), entropy in bits."""
    if not len(ids):
        return 0.0, 0.0, 0.0
    counts = np.bincount(ids, minlength=model.n_pieces)
    spelled = counts[model.is_byte].sum() - counts[model.byte_id[list(WHITE.encode())]].sum()
    counts = counts[counts > 0]
    total = len(ids)
    entropy = np.log2(total) - (counts * np.log2(counts)).sum() / total
    return len(text) / total, float(spelled) / total, max(0.0, float(entropy))


def measured(
    batches: Iterable[pa.RecordBatch], model_path: str, bands: dict[str, Band], other: Band
) -> Iterator[tuple[pa.RecordBatch, list[tuple]]]:
    model, table = PieceModel(model_path), script_table()
    for block, rows, cache in encoded_blocks(batches, model):
        out = []
        ids = cache.flat(np.concatenate(rows))
        end = np.cumsum([cache.size[r].sum() for r in rows]).tolist()
        for text, a, b in zip(texts_of(block, "text"), [0, *end], end):
            counts = base_counts(text)
            failed = counts[0] < 50 or 100 * counts[4] > 50 * counts[0]
            script = main_script(text, table)
            chars, spelled, entropy = fertility(text, ids[a:b], model)
            band = bands.get(script, other)
            fits = (
                band.chars_per_token[0] <= chars <= band.chars_per_token[1]
                and spelled <= band.byte_share
                and entropy >= band.entropy
            )
            passed = not failed and fits
            size = (b - a).bit_length()
            out.append((*counts, failed, passed, script, chars, spelled, entropy, size))
        yield block, out


def fences(passed: DataFrame) -> DataFrame:
    """For each kind the least and most characters per token, and the least entropy.

    ``passed`` has the kind, ``__content``, ``__chars`` and ``__entropy`` of all texts
    that pass the base rules and the limits of their script. Equal texts count once.
    Where noise is over a quarter of a kind, it widens the fences of that kind.
    """
    once = passed.dropDuplicates([*KIND, "__content"])
    values = F.explode(
        F.create_map(F.lit("chars"), F.col("__chars"), F.lit("entropy"), F.col("__entropy"))
    )
    counted = (
        once.select(*KIND, values.alias("name", "value"))
        .groupBy(*KIND, "name", F.round("value", DIGITS).alias("value"))
        .agg(F.count("*").alias("n"))
    )
    quartile = F.percentile("value", F.array(*map(F.lit, (0.25, 0.5, 0.75))), F.col("n"))
    found = counted.groupBy(*KIND, "name").agg(quartile.alias("q"))
    q = F.col("q")
    spread = F.greatest(q[2] - q[0], LEAST_SPREAD * q[1])

    def of(name: str, value: Column) -> Column:
        return F.max(F.when(F.col("name") == name, value))

    return materialize(
        found.groupBy(*KIND).agg(
            of("chars", q[0] - BELOW * spread).alias("__least_chars"),
            of("chars", q[2] + ABOVE * spread).alias("__most_chars"),
            of("entropy", q[0] - BELOW * spread).alias("__least_entropy"),
        ),
        "quality-fences",
    )


INSIDE = "__chars BETWEEN __least_chars AND __most_chars AND __entropy >= __least_entropy"


def kind_of(docs: DataFrame, text_col: str) -> list[Column]:
    """``__lang`` and ``__content``; without a column ``lang``, or where it is null, an empty label."""
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    return [
        F.coalesce(lang, F.lit("")).alias("__lang"),
        F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("__content"),
    ]


def quality(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    bands: dict[str, Band] = BANDS,
    other: Band = OTHER,
) -> DataFrame:
    """Counts, measures and verdict of every whole text, one row per input row.

    A null or empty text has no words, measures zero and is not kept. Null ids
    and repeated rows stay as they are; other columns than ``lang`` are not read.
    """
    schema = pa.schema(
        [*MEASURED, ("__size", pa.int32()), ("__lang", pa.string()), ("__content", pa.int64())]
    )

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in measured(batches, model_path, bands, other):
            columns = [pa.array(c, f.type) for c, f in zip(zip(*rows), list(schema)[1:])]
            yield pa.RecordBatch.from_arrays(
                [block.column("doc_id"), *columns, block.column("__lang"), block.column("__content")],
                schema=schema,
            )

    rows = docs.select(
        F.col(id_col).cast("bigint").alias("doc_id"),
        F.col(text_col).alias("text"),
        *kind_of(docs, text_col),
    )
    ddl = f"{MEASURED_DDL}, __size int, __lang string, __content bigint"
    found = materialize(
        rows.mapInArrow(measure, ddl).withColumns(
            {
                "__script": F.col("script"),
                "__chars": F.col("chars_per_token"),
                "__entropy": F.col("token_entropy"),
            }
        ),
        "quality-measures",
    )
    return (
        found.join(fences(found.where("kept")), KIND, "left")
        .withColumn("kept", F.col("kept") & F.coalesce(F.expr(INSIDE), F.lit(False)))
        .select(*MEASURED.names)
    )


def keep_quality(
    docs: DataFrame,
    model_path: str,
    bands: dict[str, Band] = BANDS,
    other: Band = OTHER,
) -> DataFrame:
    """The rows of ``docs`` whose ``text`` is kept, with all their columns.

    Rows that pass the base rules and the limits of their script are written once,
    measured, so that no text is encoded twice or shuffled.
    """

    def passing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, rows in measured(batches, model_path, bands, other):
            # script, characters per token, entropy, size
            kinds = [
                pa.array([row[k] for row in rows], kind)
                for k, kind in ((7, pa.string()), (8, pa.float64()), (10, pa.float64()), (11, pa.int32()))
            ]
            names = [*block.schema.names, "__script", "__chars", "__entropy", "__size"]
            whole = pa.RecordBatch.from_arrays([*block.columns, *kinds], names=names)
            yield whole.filter(pa.array([row[6] for row in rows], pa.bool_()))

    # Arrow functions take no names with dots.
    names = [c if c in ("text", "lang") else f"__c{i}" for i, c in enumerate(docs.columns)]
    plain = docs.toDF(*names)
    rows = plain.select("*", *kind_of(plain, "text"))
    added = StructType.fromDDL("__script string, __chars double, __entropy double, __size int")
    schema = StructType([*rows.schema, *added])
    found = materialize(rows.mapInArrow(passing, schema), "quality-passing")
    return found.join(fences(found), KIND).where(INSIDE).select(*names).toDF(*docs.columns)
