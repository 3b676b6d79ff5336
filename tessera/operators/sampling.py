"""Class counts and exact-size, repeatable stratified samples.

Rows are drawn in the order of ``md5(seed:key)``. Instead of ranking every class, the
draw finds for each class the hash at which its quota is reached. As hashes are spread
evenly, that hash lies near ``quota / n`` of their range: one pass counts the rows below
a narrow interval around it and puts only those inside in order, which are of the order
of the square root of the class. The sample is then a filter over the full rows, which
are never shuffled, and a class with most of the rows is no burden to one task.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from tessera.functions.paths import path_label
from tessera.sources import listed_files, with_contents
from tessera.workspace import materialize_observed

# Half widths of the interval in standard deviations, tried in turn. Rows with unique
# keys miss the first about once in a thousand million draws.
SLACKS = (6.0, 30.0, 150.0)

# Drawn files that one task opens.
FILES_PER_TASK = 32

# Longest array folded in one row; more classes are folded in several levels.
FOLD_ROWS = 1_000


class Sample(NamedTuple):
    rows: DataFrame
    plan: DataFrame


def strata(df: DataFrame, label: str = "label") -> DataFrame:
    return df.select(label).distinct()


def class_counts(df: DataFrame, label: str = "label") -> DataFrame:
    """``label, n``"""
    return df.groupBy(label).agg(F.count("*").alias("n"))


def class_counts_with_total(df: DataFrame, label: str = "label") -> DataFrame:
    """``label, n, is_total``; the rollup runs over the counts, not over the rows."""
    return (
        class_counts(df, label)
        .rollup(label)
        .agg(F.sum("n").alias("n"), (F.grouping(label) == 1).alias("is_total"))
    )


def class_counts_of(
    df: DataFrame, wanted: Sequence[str], label: str = "label"
) -> DataFrame:
    """Counts of the wanted classes only, each once, zero for those without rows; null is one."""
    kind = StructType([StructField("_wanted", df.schema[label].dataType)])
    rows = [(name,) for name in dict.fromkeys(wanted)]
    listed = df.sparkSession.createDataFrame(rows, kind)
    same = F.col(label).eqNullSafe(F.col("_wanted"))
    return listed.join(class_counts(df, label), same, "left").select(
        F.col("_wanted").alias(label), F.coalesce("n", F.lit(0)).alias("n")
    )


def draw_order(key: str | Sequence[str], seed: int) -> Column:
    """The hash that fixes the order in which rows are drawn.

    Parts of a composite key go in with their lengths, and null as itself, so that
    different keys are never the same text.
    """
    if isinstance(key, str):
        parts = [F.col(key).cast("string")]
    else:
        texts = [F.col(c).cast("string") for c in key]
        parts = [
            F.coalesce(F.concat(F.length(t), F.lit("."), t), F.lit("null")) for t in texts
        ]
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))


def proportional_plan(
    counts: DataFrame, size: int, label: str = "label", seed: int = 42
) -> DataFrame:
    """``label, n, quota`` with quotas in proportion to ``n`` that add up to ``size``.

    Shares are rounded half to even. What rounding leaves over is at most half a row
    per class, and every class rounded down (up) can give (take) one row, so moving
    one row in as many classes as needed, chosen by hash, settles it at once.
    """
    counts, seen = materialize_observed(
        counts.select(label, "n"), "class-counts", available=F.coalesce(F.sum("n"), F.lit(0))
    )
    available = seen["available"]
    if size > available:
        raise ValueError(f"cannot draw {size} rows, only {available} are there")
    if size == 0:
        return counts.withColumn("quota", F.lit(0).cast("long"))

    share = F.bround(F.lit(size) / F.lit(available) * F.col("n")).cast("long")
    quota = F.col("quota")
    drafted, seen = materialize_observed(
        counts.withColumn("quota", share).withColumn("_order", draw_order(label, seed)),
        "drafted-plan",
        drafted=F.sum("quota"),
        can_take=F.count_if(quota < F.col("n")),
        can_give=F.count_if(quota > 0),
    )
    left_over = size - seen["drafted"]
    if left_over == 0:
        return drafted.drop("_order")

    movable = quota < F.col("n") if left_over > 0 else quota > 0
    candidates = drafted.where(movable).select(F.lit(0).alias("all"), "_order")
    wanted = drafted.sparkSession.range(1).select(
        F.col("id").cast("int").alias("all"),
        F.lit(seen["can_take" if left_over > 0 else "can_give"]).alias("n"),
        F.lit(abs(left_over)).alias("quota"),
    )
    cutoff = _cutoffs(candidates, wanted, "all", 1).first()["cutoff"]
    step = F.lit(1 if left_over > 0 else -1)
    moved = F.when(movable & (F.col("_order") <= cutoff), step).otherwise(0)
    return drafted.select(label, "n", (quota + moved).alias("quota"))


def draw(
    df: DataFrame, plan: DataFrame, label: str, key: str | Sequence[str], seed: int = 42
) -> DataFrame:
    """The first ``quota`` rows of every class in hash order.

    ``plan`` is ``label, n, quota`` with ``n`` the rows of the class. ``key`` must be
    unique within a class.
    """
    return _draw(df, plan, label, key, seed)[0]


def _draw(
    df: DataFrame, plan: DataFrame, label: str, key: str | Sequence[str], seed: int
) -> tuple[DataFrame, DataFrame]:
    """:func:`draw`, and the plan as a written table, whose size is known to Spark."""
    plan, seen = materialize_observed(plan, "sample-plan", drawn=F.count_if(F.col("quota") > 0))
    order = draw_order(key, seed)
    keyed = df.select(label, order.alias("_order"))
    cutoffs = _cutoffs(keyed, plan, label, seen["drawn"]).withColumnsRenamed({label: "_label", "cutoff": "_cutoff"})
    in_class = F.col(label).eqNullSafe(F.col("_label"))
    return df.join(cutoffs, in_class & (order <= F.col("_cutoff"))).select(*df.columns), plan


def sample_proportional(
    df: DataFrame, size: int, label: str, key: str | Sequence[str], seed: int = 42
) -> Sample:
    """Exactly ``size`` rows, classes in proportion, and the plan behind them."""
    return Sample(*_draw(df, proportional_plan(class_counts(df, label), size, label, seed), label, key, seed))


def sample_equal(
    df: DataFrame, size: int, label: str, key: str | Sequence[str], seed: int = 42
) -> Sample:
    """A sample by :func:`equal_plan`."""
    return Sample(*_draw(df, equal_plan(class_counts(df, label), size, label), label, key, seed))


def sample_images(
    spark: SparkSession, root: str, size: int, pattern: str = "*.jpg", seed: int = 42
) -> Sample:
    """:func:`sample_proportional` of the images below ``root``, with their bytes.

    The draw needs paths only, which tasks list; each task then opens the files that it was dealt,
    ``FILES_PER_TASK`` on average.
    """
    listed = listed_files(spark, root, pattern).withColumn("label", path_label("path"))
    rows, plan = sample_proportional(listed, size, "label", "path", seed)
    # A stated number: a repartition by a column alone is merged to few tasks, as paths are short.
    drawn = rows.repartition(max(1, -(-size // FILES_PER_TASK)), "path")
    names = ["path", "modificationTime", "length", "content", "label"]
    return Sample(with_contents(drawn).select(*names), plan)


def _cutoffs(keyed: DataFrame, plan: DataFrame, group: str, groups: int) -> DataFrame:
    """``group, cutoff``: the hash of the last row within the quota of each group.

    ``groups`` have a quota above 0, the others have no cut-off. Fails if two rows share that hash, for then the key
    is not unique and the quota cannot be met exactly.
    """
    asked = plan.where(F.col("quota") > 0).select(F.col(group).alias("_group"), "n", "quota")
    found, met = None, 0
    for slack in SLACKS:
        reached, seen = materialize_observed(
            _quota_reached(keyed, asked, group, slack), "cutoffs", n=F.count(F.lit(1))
        )
        found = reached if found is None else found.unionByName(reached)
        met += seen["n"]
        if met == groups:
            return found
        done = reached.select(F.col(group).alias("_met"))
        asked = asked.join(done, F.col("_group").eqNullSafe(F.col("_met")), "left_anti")
    raise ValueError("the key to sample by is not unique or the plan is not of these rows")


def _quota_reached(keyed: DataFrame, asked: DataFrame, group: str, slack: float) -> DataFrame:
    """:func:`_cutoffs` of the groups whose cut-off lies within ``slack``."""
    digits = 12
    share = F.col("quota") / F.col("n")
    width = slack * F.sqrt(share * (1 - share) / F.col("n")) + 2 * slack / F.col("n")
    low = F.greatest(F.floor((share - width) * 16**digits), F.lit(0))
    high = F.ceil((share + width) * 16**digits)

    def as_digits(number: Column) -> Column:
        return F.lpad(F.lower(F.hex(number.cast("long"))), digits, "0")

    # "g" comes after every hash.
    bounds = asked.select(
        "_group",
        "quota",
        as_digits(low).alias("low"),
        F.when(high < 16**digits, as_digits(high)).otherwise("g").alias("high"),
    )
    in_group = F.col(group).eqNullSafe(F.col("_group"))
    inside = F.when(F.col("_order") >= F.col("low"), F.col("_order"))
    along = Window.partitionBy(group).orderBy(F.asc_nulls_first("cutoff"))
    upto, quota = F.col("upto"), F.col("quota")
    unique = F.when(upto == quota, F.col("cutoff")).otherwise(
        F.raise_error(F.lit("the key to sample by is not unique")).cast("string")
    )
    # All rows below the interval are one count, without a hash, before the others.
    return (
        keyed.join(bounds, in_group & (F.col("_order") < F.col("high")))
        .groupBy(group, "quota", inside.alias("cutoff"))
        .agg(F.count("*").alias("here"))
        .withColumn("upto", F.sum("here").over(along))
        .where((upto >= quota) & (upto - F.col("here") < quota) & F.col("cutoff").isNotNull())
        .select(group, unique.alias("cutoff"))
    )


def equal_plan(
    counts: DataFrame, size: int, label: str = "label", fold_rows: int = FOLD_ROWS
) -> DataFrame:
    """``label, n, quota`` with equal shares and a carry along the order of labels.

    Every class is asked for ``size // classes`` rows, plus one while the carry is
    positive. A class that gives what it is asked for lowers the carry by one, down
    to zero; one that has fewer rows raises it by what is missing. The rule does not
    ensure that the quotas add up to ``size``.
    """
    counts, seen = materialize_observed(
        counts.select(label, "n"), "class-counts", classes=F.count(F.lit(1))
    )
    classes = seen["classes"]
    if classes == 0:
        return counts.withColumn("quota", F.lit(0).cast("long"))
    base, extra = divmod(size, classes)
    n = F.col("n")

    # What a class does to the carry r: bottom if r <= edge, else r + shift.
    effect = counts.select(
        label,
        F.greatest(F.lit(base) - n, F.lit(0)).cast("long").alias("bottom"),
        F.lit(0).cast("long").alias("edge"),
        F.when(n > base, F.lit(-1)).otherwise(F.lit(base + 1) - n).cast("long").alias("shift"),
    )
    carries = _carry_before(effect, classes, label, extra, fold_rows)
    asked = F.lit(base) + F.when(F.col("carry") > 0, 1).otherwise(0)
    return counts.join(
        carries.withColumnRenamed(label, "_label"), F.col(label).eqNullSafe(F.col("_label"))
    ).select(label, "n", F.least(n, asked).cast("long").alias("quota"))


def _carry_before(
    effect: DataFrame, rows: int, order: str, start: int, fold_rows: int
) -> DataFrame:
    """``order, carry``: the carry that reaches each row, rows taken in order.

    Effects of this shape stay so when one follows another, so each run of
    neighbouring rows acts on the carry like a single row. Runs are summarised, the
    carry is followed over the summaries by the same rule, then within each run.
    """
    runs = -(-rows // fold_rows)
    if runs == 1:
        ranged = effect.withColumn("run", F.lit(0))
    else:
        ranged = effect.repartitionByRange(runs, order).withColumn("run", F.spark_partition_id())
    packed, seen = materialize_observed(
        ranged.groupBy("run").agg(
            F.array_sort(F.collect_list(F.struct(order, "bottom", "edge", "shift"))).alias("steps")
        ),
        "runs",
        n=F.count(F.lit(1)),
    )
    if runs == 1:
        opened = packed.withColumn("carry", F.lit(start).cast("long"))
    else:
        whole = packed.select(F.col("run").alias("place"), _as_one("steps").alias("one"))
        followed = _carry_before(
            whole.select("place", "one.*"), seen["n"], "place", start, fold_rows
        )
        opened = packed.join(followed, F.col("run") == F.col("place"))

    def follow(state: Column, step: Column) -> Column:
        carry = state["carry"]
        after = F.when(carry <= step["edge"], step["bottom"]).otherwise(carry + step["shift"])
        seen = F.struct(step[order].alias(order), carry.alias("carry"))
        return F.struct(after.alias("carry"), F.array_append(state["seen"], seen).alias("seen"))

    kind = effect.schema[order].dataType.simpleString()
    nothing = F.expr(f"CAST(array() AS array<struct<`{order}`:{kind},carry:bigint>>)")
    first = F.struct(F.col("carry"), nothing.alias("seen"))
    return opened.select(F.inline(F.aggregate("steps", first, follow)["seen"]))


def _as_one(steps: str) -> Column:
    """The effect of a whole run."""

    def then(so_far: Column, step: Column) -> Column:
        reach = step["edge"] - so_far["shift"]
        bottom = F.when(
            (reach > so_far["edge"]) | (so_far["bottom"] <= step["edge"]), step["bottom"]
        ).otherwise(so_far["bottom"] + step["shift"])
        return F.struct(
            bottom.alias("bottom"),
            F.greatest(so_far["edge"], reach).alias("edge"),
            (so_far["shift"] + step["shift"]).alias("shift"),
        )

    nothing_yet = F.expr(
        "named_struct('bottom', CAST(0 AS bigint), 'edge', CAST(-1 AS bigint), "
        "'shift', CAST(0 AS bigint))"
    )
    return F.aggregate(steps, nothing_yet, then)
