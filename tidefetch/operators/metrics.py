"""Download figures per task, and the 13 metrics made from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidefetch.functions.formats import fmt_bytes, fmt_bytes_rate, fmt_count, fmt_duration, fmt_records_rate

# Shown for a metric that no task reported, and the names of the metrics.
NOT_AVAILABLE = "N/A"
METRICS = {
    "max files downloaded": ("max", "files"),
    "avg files downloaded": ("avg", "files"),
    "min files downloaded": ("min", "files"),
    "total bytes downloaded": ("total", "bytes"),
    "avg download duration": ("avg", "ms"),
    "max download duration": ("max", "ms"),
    "min download duration": ("min", "ms"),
    "avg records throughput": ("avg", "records_rate"),
    "max records throughput": ("max", "records_rate"),
    "min records throughput": ("min", "records_rate"),
    "avg bytes throughput": ("avg", "bytes_rate"),
    "max bytes throughput": ("max", "bytes_rate"),
    "min bytes throughput": ("min", "bytes_rate"),
}


def per_second(amount: str, ms: str) -> Column:
    """Whole units per second, 0 for no time."""
    return F.expr(f"case when {ms} > 0 then ({amount} * 1000) div {ms} else 0 end")


def task_metrics(outcomes: DataFrame, task: str = "task_id") -> DataFrame:
    """Figures per task from one row per file: ``ok`` (0/1), ``bytes``, ``records``, ``ms``.

    Failed files add a record, but no file and no bytes.
    """
    return (
        outcomes.groupBy(task)
        .agg(
            F.sum(F.col("ok").cast("bigint")).alias("files"),
            F.count_if(F.col("ok") == 0).alias("failed"),
            F.sum("records").alias("records"),
            F.sum(F.when(F.col("ok") == 1, F.col("bytes")).otherwise(0)).alias("bytes"),
            F.sum("ms").alias("ms"),
        )
        .withColumns(
            {"records_rate": per_second("records", "ms"), "bytes_rate": per_second("bytes", "ms")}
        )
    )


def task_figures(downloaded: DataFrame) -> DataFrame:
    """Figures per task of a ``download``: its last rows carry them."""
    return downloaded.where("task_ms is not null").select(
        F.col("task_files").alias("files"),
        F.col("task_failed").alias("failed"),
        F.col("task_records").alias("records"),
        F.col("task_bytes").alias("bytes"),
        F.col("task_ms").alias("ms"),
        per_second("task_records", "task_ms").alias("records_rate"),
        per_second("task_bytes", "task_ms").alias("bytes_rate"),
    )


def failed_files(outcomes: DataFrame, task: str = "task_id") -> DataFrame:
    """Names of failed files with their task, one row each."""
    return outcomes.where("ok = 0").select(task, "name")


def avg_max_min(column: str) -> dict[str, Column]:
    """Average (whole), largest and smallest figure of all tasks; null without a task."""
    return {
        "avg": F.expr(f"sum({column}) div count({column})"),
        "max": F.max(column),
        "min": F.min(column),
    }


def summary(figures: DataFrame, column: str) -> DataFrame:
    """One row with avg, max and min of a figure."""
    return figures.agg(*[v.alias(k) for k, v in avg_max_min(column).items()])


def _aggregate(kind: str, column: str) -> Column:
    return F.sum(column) if kind == "total" else avg_max_min(column)[kind]


def _key(name: str) -> str:
    return name.replace(" ", "_")


def _shown(kind: str, column: str, value: Column) -> Column:
    if column == "files":
        return fmt_count(value) if kind == "avg" else value.cast("string")
    return {
        "bytes": fmt_bytes,
        "ms": fmt_duration,
        "records_rate": fmt_records_rate,
        "bytes_rate": fmt_bytes_rate,
    }[column](value)


def metrics_report(figures: DataFrame) -> DataFrame:
    """The 13 metrics as rows (``metric``, ``value``), computed in one pass over the tasks."""
    wide = figures.agg(*[_aggregate(*m).alias(_key(name)) for name, m in METRICS.items()])
    shown = wide.select(
        *[
            F.coalesce(_shown(*m, F.col(_key(name))), F.lit(NOT_AVAILABLE)).alias(_key(name))
            for name, m in METRICS.items()
        ]
    )
    pairs = ", ".join(f"'{name}', {_key(name)}" for name in METRICS)
    return shown.select(F.expr(f"stack({len(METRICS)}, {pairs}) as (metric, value)"))


def observe_metrics(downloaded: DataFrame, observation: Observation | str) -> DataFrame:
    """Collect the metrics while ``downloaded`` is read, without a second run.

    ``observation`` is an ``Observation`` for a batch read, or a name under which a
    ``StreamingQueryListener`` and ``lastProgress`` report each micro-batch.
    """
    named = downloaded.withColumns(
        {
            "_files": F.col("task_files"),
            "_bytes": F.col("task_bytes"),
            "_ms": F.col("task_ms"),
            "_records_rate": F.when(F.col("task_ms").isNotNull(), per_second("task_records", "task_ms")),
            "_bytes_rate": F.when(F.col("task_ms").isNotNull(), per_second("task_bytes", "task_ms")),
        }
    )
    figures = [_aggregate(kind, f"_{column}").alias(_key(name)) for name, (kind, column) in METRICS.items()]
    return named.observe(observation, *figures).select(*downloaded.columns)
