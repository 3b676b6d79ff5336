"""Session set-up. The master is left to spark-submit unless the caller names one."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def get_session(
    app_name: str = "tessera",
    conf: Mapping[str, str] | None = None,
    *,
    master: str | None = None,
    case_sensitive: bool | None = None,
    legacy_parquet: bool = False,
    arrow_batch_rows: int | None = None,
    arrow_batch_bytes: int | None = None,
) -> SparkSession:
    """Get or create the session; ``conf`` wins over every named option."""
    settings = dict(SESSION_DEFAULTS)
    if case_sensitive is not None:
        settings["spark.sql.caseSensitive"] = str(case_sensitive).lower()
    if legacy_parquet:
        settings["spark.sql.parquet.writeLegacyFormat"] = "true"
    if arrow_batch_rows is not None:
        settings["spark.sql.execution.arrow.maxRecordsPerBatch"] = str(arrow_batch_rows)
    if arrow_batch_bytes is not None:
        settings["spark.sql.execution.arrow.maxBytesPerBatch"] = str(arrow_batch_bytes)
    settings.update(conf or {})

    builder = SparkSession.builder.appName(app_name)
    if master is not None:
        builder = builder.master(master)
    return builder.config(map=settings).getOrCreate()


def list_settings(spark: SparkSession) -> dict[str, str]:
    """Every setting the running context was started with."""
    return dict(spark.sparkContext.getConf().getAll())


def register_view(df: DataFrame, name: str) -> DataFrame:
    """Make ``df`` queryable from SQL as ``name``."""
    df.createOrReplaceTempView(name)
    return df
