"""Token counts of flat, unindexed token files by a scan for separators.

A flat file holds 16-bit token ids, each document followed by the id of the end
of a document, and nothing else. The scan reads blocks of any file in parallel,
finds the separators of a block with one vectorised comparison, and stitches
documents that cross blocks with a prefix scan over block summaries: first over
runs of blocks, then within each run.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.files import new_file, open_input, open_output
from tessera.llm.pieces import PieceModel, encoded_blocks
from tessera.workspace import materialize, scratch_path

END_OF_DOCUMENT = 2  # the id of </s>
ID_BYTES = 2
BLOCK_BYTES = 1 << 20
RUN = 1024
BLOCKS_PER_TASK = 8

WRITTEN = pa.schema(
    [("file", pa.string()), ("ordinal", pa.int64()), ("doc_id", pa.int64()), ("bytes", pa.int64())]
)


def write_flat(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Writes one flat file per task; returns the files with their sizes, and the documents.

    The documents (``file, ordinal, doc_id``) only name what was written where.
    A null or empty text is written as a separator alone.
    """
    spark = docs.sparkSession
    folder = scratch_path(spark, "flat-tokens")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, ordinal, held = new_file(folder, ".bin"), 0, 0
        with open_output(name) as out:
            for block, rows, cache in encoded_blocks(batches, PieceModel(model_path)):
                size = np.array([cache.size[r].sum() for r in rows], np.int64)
                ends = np.cumsum(size + 1) - 1
                tokens = np.full(int(size.sum()) + len(rows), END_OF_DOCUMENT, "<u2")
                inside = np.ones(len(tokens), bool)
                inside[ends] = False
                tokens[inside] = cache.flat(np.concatenate(rows))
                out.write(tokens.tobytes())
                n = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([name] * n),
                        pa.array(np.arange(ordinal, ordinal + n)),
                        block.column("doc_id"),
                        pa.nulls(n, pa.int64()),
                    ],
                    schema=WRITTEN,
                )
                ordinal, held = ordinal + n, held + tokens.nbytes
        yield pa.RecordBatch.from_pylist([{"file": name, "bytes": held}], schema=WRITTEN)

    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    written = materialize(
        rows.mapInArrow(write, "file string, ordinal bigint, doc_id bigint, bytes bigint"),
        "flat-documents",
    )
    files = written.where("bytes > 0").select("file", "bytes")
    return files, written.where("bytes IS NULL").select("file", "ordinal", "doc_id")


def dealt_blocks(files: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``file, bytes, block``, dealt out to a stated number of tasks.

    Rows this small would else be merged into one. Each task has ``BLOCKS_PER_TASK`` blocks,
    or fewer while cores are free.
    """
    blocks = files.select(
        "file",
        "bytes",
        F.explode(F.expr(f"sequence(0L, (bytes - 1) div {block_bytes})")).alias("block"),
    ).where("bytes > 0")
    n = blocks.count()
    least = files.sparkSession.sparkContext.defaultParallelism
    return blocks.repartition(max(1, min(n, max(least, n // BLOCKS_PER_TASK))), "file", "block")


def scan_flat(
    files: DataFrame,
    separator: int = END_OF_DOCUMENT,
    block_bytes: int = BLOCK_BYTES,
    run: int = RUN,
) -> DataFrame:
    """Documents of flat files (``file, bytes``): ``ordinal, start, n_tokens, terminated``.

    ``start`` counts tokens from the beginning of the file. Tokens after the last
    separator are a document that is not terminated. An empty file has none;
    two separators in a row enclose a document without tokens.
    """
    if block_bytes % ID_BYTES:
        raise ValueError("block_bytes must hold whole ids")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with open_input(row["file"]) as file:
                    file.seek(row["block"] * block_bytes)
                    data = file.read(min(block_bytes, row["bytes"] - row["block"] * block_bytes))
                first = row["block"] * (block_bytes // ID_BYTES)
                tokens = np.frombuffer(data, "<u2")
                ends = np.flatnonzero(tokens == separator) + first
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["file"]]),
                        pa.array([row["block"]], pa.int64()),
                        pa.array([row["block"] // run], pa.int64()),
                        pa.array([first + len(tokens)], pa.int64()),
                        pa.array([len(ends)], pa.int64()),
                        pa.array([ends[-1] if len(ends) else -1], pa.int64()),
                        pa.array([ends], pa.list_(pa.int64())),
                    ],
                    names=["file", "block", "run", "stop", "n_ends", "last_end", "ends"],
                )

    found = materialize(
        dealt_blocks(files, block_bytes).mapInArrow(
            search,
            "file string, block bigint, run bigint, stop bigint, n_ends bigint, "
            "last_end bigint, ends array<bigint>",
        ),
        "flat-blocks",
    )
    summary = found.drop("ends")
    by_file = Window.partitionBy("file").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = (
        summary.groupBy("file", "run")
        .agg(F.sum("n_ends").alias("run_ends"), F.max("last_end").alias("run_last"))
        .select(
            "file",
            "run",
            F.coalesce(F.sum("run_ends").over(by_file), F.lit(0)).alias("ends_before"),
            F.coalesce(F.max("run_last").over(by_file), F.lit(-1)).alias("last_before"),
            F.lead("run").over(Window.partitionBy("file").orderBy("run")).alias("next_run"),
        )
    )
    in_run = Window.partitionBy("file", "run").orderBy("block")
    earlier = in_run.rowsBetween(Window.unboundedPreceding, -1)
    stitched = summary.join(runs, ["file", "run"]).select(
        "file",
        "block",
        "stop",
        (F.col("ends_before") + F.coalesce(F.sum("n_ends").over(earlier), F.lit(0))).alias("first"),
        F.greatest("last_before", F.coalesce(F.max("last_end").over(earlier), F.lit(-1))).alias(
            "before"
        ),
        "n_ends",
        "last_end",
        (F.col("next_run").isNull() & F.lead("block").over(in_run).isNull()).alias("is_last"),
    )
    # The last block closes what follows the last separator.
    rest = F.when(
        F.col("is_last") & (F.greatest("before", "last_end") < F.col("stop") - 1),
        F.array(F.col("stop")),
    ).otherwise(F.array().cast("array<bigint>"))
    return (
        stitched.join(found.select("file", "block", "ends"), ["file", "block"])
        .withColumn("closes", F.concat("ends", rest))
        .withColumn("opens", F.concat(F.array("before"), F.col("ends")))
        .select(
            "file",
            "first",
            "n_ends",
            F.posexplode(
                F.expr(
                    "transform(closes, (close, i) -> named_struct('open', opens[i] + 1, 'close', close))"
                )
            ).alias("at", "span"),
        )
        .select(
            "file",
            (F.col("first") + F.col("at")).alias("ordinal"),
            F.col("span.open").alias("start"),
            (F.col("span.close") - F.col("span.open")).alias("n_tokens"),
            (F.col("at") < F.col("n_ends")).alias("terminated"),
        )
    )


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """Tokens of every document, counted by a scan of the flat files written from them.

    One row per input row; null ids and repeated rows stay as they are.
    """
    files, written = write_flat(docs, model_path)
    return written.join(scan_flat(files), ["file", "ordinal"]).select(
        "doc_id", "n_tokens", "start", "file", "ordinal"
    )
