"""Benchmark decontamination by winnowing, as DataFrame and SQL expressions only.

A shared span of ten words holds six runs of five words. Of every six successive
runs the one of smallest hash is kept, on both sides, so that equal spans always
keep an equal fingerprint. Documents and items meet on fingerprints; each hit is
extended to the ten-word windows around it, which are compared as text. An item
of fewer words is one window, met by runs of its own length.
"""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.workspace import materialize

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW = 10
RUN = 5
RUNS = WINDOW - RUN + 1
MARK = -1  # stands for the document itself among its fingerprints


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def lower_ascii(text: Column) -> Column:
    return F.translate(text, ascii_uppercase, ascii_lowercase)


def runs(array: str, length: int) -> str:
    """Hashes of all runs of ``length`` words."""
    parts = ", ".join(f"{array}[i + {k}]" for k in range(length))
    return (
        f"if(size({array}) >= {length}, transform(sequence(0, size({array}) - {length}), "
        f"i -> xxhash64({length}, {parts})), cast(array() AS array<bigint>))"
    )


def smallest(array: str, size: int) -> str:
    """The minimum of every ``size`` successive values."""
    parts = ", ".join(f"{array}[i + {k}]" for k in range(size))
    return (
        f"if(size({array}) >= {size}, transform(sequence(0, size({array}) - {size}), "
        f"i -> least({parts})), cast(array() AS array<bigint>))"
    )


def fingerprints(rows: DataFrame, lengths: list[int]) -> DataFrame:
    """Adds ``prints``: kept hashes of ``ws``, and all runs of each of ``lengths`` words."""
    rows = rows.withColumn("grams", F.expr(runs("ws", RUN)))
    kept = [F.expr(smallest("grams", RUNS)), *(F.expr(runs("ws", n)) for n in lengths)]
    return rows.withColumn("prints", F.array_distinct(F.concat(*kept))).drop("grams")


def item_windows(items: DataFrame) -> DataFrame:
    """``item_id, window, n``: windows of every item; items without words have none."""
    spans = f"""
        if(size(ws) >= {WINDOW},
           transform(sequence(1, size(ws) - {WINDOW - 1}),
                     s -> struct(array_join(slice(ws, s, {WINDOW}), ' ') AS window,
                                 {WINDOW} AS n)),
           array(struct(array_join(ws, ' ') AS window, size(ws) AS n)))
    """
    return (
        items.where("size(ws) > 0")
        .select("item_id", F.explode(F.expr(spans)).alias("w"))
        .select("item_id", "w.window", "w.n")
    )


def candidate_windows(lengths: list[int]) -> Column:
    """Windows around the matched runs of a document: ``at, n, window``, each once."""
    full = f"""
        array_distinct(flatten(transform(
            filter(sequence(0, size(grams) - 1), i -> array_contains(matched, grams[i])),
            i -> sequence(greatest(0, i - {RUNS - 1}), least(i, size(ws) - {WINDOW})))))
    """
    found = [
        f"if(size(ws) >= {WINDOW}, transform({full}, at -> struct(at, {WINDOW} AS n)), "
        "cast(array() AS array<struct<at:int,n:int>>))"
    ]
    found += [
        f"if(size(ws) >= {n}, transform(filter(sequence(0, size(ws) - {n}), "
        f"i -> array_contains(matched, runs{n}[i])), at -> struct(at, {n} AS n)), "
        "cast(array() AS array<struct<at:int,n:int>>))"
        for n in lengths
    ]
    return F.expr(
        f"transform(concat({', '.join(found)}), w -> struct(w.at AS at, w.n AS n, "
        "array_join(slice(ws, w.at + 1, w.n), ' ') AS window))"
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, **columns: str) -> DataFrame:
    """``judged_rows`` without the hash of the text."""
    return judged_rows(docs, benchmark, **columns).drop("content")


def judged_rows(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Words of every whole document that lie in a window of a benchmark item.

    One row per input row, with ``content``, a hash of its text. Null and empty
    texts have no words; items without
    words match nothing, items of equal text all count, an item with a null id
    hits words but is not listed. Rows that repeat get equal results, rows of one
    id with different texts are judged apart.
    """
    items = materialize(
        benchmark.select(
            F.col(item_col).alias("item_id"),
            words(lower_ascii(F.coalesce(F.col(item_text_col), F.lit("")))).alias("ws"),
        ),
        "benchmark-words",
    )
    short = items.where(f"size(ws) > 0 AND size(ws) < {WINDOW}").select(F.size("ws").alias("n"))
    lengths = sorted(row["n"] for row in short.distinct().collect())  # nine at most
    whole = "xxhash64(size(ws), {})".format
    item_prints = fingerprints(items.where(f"size(ws) >= {WINDOW}"), []).select(
        F.explode("prints").alias("print")
    )
    for n in lengths:
        parts = ", ".join(f"ws[{k}]" for k in range(n))
        item_prints = item_prints.union(
            items.where(f"size(ws) = {n}").select(F.expr(whole(parts)).alias("print"))
        )
    mark = items.sparkSession.range(1).select(F.lit(MARK).cast("bigint").alias("print"))
    item_prints = materialize(item_prints.union(mark).distinct(), "benchmark-prints")

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("content")
    )
    printed = fingerprints(
        rows.select("doc_id", "content", words(lower_ascii(F.col("text"))).alias("ws")), lengths
    )
    met = materialize(
        printed.select(
            "doc_id",
            "content",
            F.size("ws").cast("bigint").alias("n_words"),
            F.explode(F.array_union("prints", F.array(F.lit(MARK).cast("bigint")))).alias("print"),
        ).join(item_prints, "print"),
        "met-prints",
    )
    matched = (
        met.where(F.col("print") != MARK)
        .groupBy("doc_id", "content")
        .agg(F.collect_set("print").alias("matched"))
        .withColumnsRenamed({"doc_id": "m_doc_id", "content": "m_content"})
    )
    windows = item_windows(items).groupBy("window").agg(F.collect_set("item_id").alias("items"))
    hits = (
        rows.join(
            matched,
            (F.col("content") == F.col("m_content")) & F.col("doc_id").eqNullSafe(F.col("m_doc_id")),
        )
        .select("doc_id", "content", "matched", words(lower_ascii(F.col("text"))).alias("ws"))
        .withColumns(
            {"grams": F.expr(runs("ws", RUN)), **{f"runs{n}": F.expr(runs("ws", n)) for n in lengths}}
        )
        .select("doc_id", "content", F.explode(candidate_windows(lengths)).alias("w"))
        .select("doc_id", "content", "w.at", "w.n", "w.window")
        .distinct()
        .join(windows, "window")
        .groupBy("doc_id", "content")
        .agg(
            F.collect_set(F.struct("at", "n")).alias("spans"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"),
        )
        .select(
            F.col("doc_id").alias("h_doc_id"),
            F.col("content").alias("h_content"),
            F.expr(
                "size(array_distinct(flatten(transform(spans, s -> sequence(s.at, s.at + s.n - 1)))))"
            ).alias("n_hit"),
            F.expr("array_sort(transform(items, i -> cast(i AS string)))").alias("items"),
        )
    )
    return (
        met.where(F.col("print") == MARK)
        .join(
            hits,
            (F.col("content") == F.col("h_content")) & F.col("doc_id").eqNullSafe(F.col("h_doc_id")),
            "left",
        )
        .select(
            "doc_id",
            "content",
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
            F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
            F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")).cast("binary"), 256).alias(
                "items_sha256"
            ),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )
