from __future__ import annotations

import pytest

from tidefetch.operators import metrics

FIGURES = "files long, failed long, records long, bytes long, ms long, records_rate long, bytes_rate long"


def report(spark, rows):
    return {r["metric"]: r["value"] for r in metrics.metrics_report(spark.createDataFrame(rows, FIGURES)).collect()}


def test_task_metrics_count_failures_as_records_only(spark):
    rows = [(1, "a", 1, 50, 1, 100), (1, "b", 1, 75, 1, 150), (1, "c", 0, 999, 1, 0), (2, "d", 0, 10, 1, 0)]
    log = spark.createDataFrame(rows, "task_id int, name string, ok int, bytes long, records long, ms long")
    found = {r["task_id"]: tuple(r)[1:] for r in metrics.task_metrics(log).collect()}
    # files, failed, records, bytes, ms, records/s, bytes/s
    assert found == {1: (2, 1, 3, 125, 250, 12, 500), 2: (0, 1, 1, 0, 0, 0, 0)}
    assert sorted(tuple(r) for r in metrics.failed_files(log).collect()) == [(1, "c"), (2, "d")]


def test_report_without_tasks(spark):
    found = report(spark, [])
    assert len(found) == 13
    assert set(found.values()) == {"N/A"}


def test_report(spark):
    mib = 1 << 20
    rows = [
        (10, 0, 10, 1 * mib, 1_000, 1_000, 1 * mib),
        (15, 0, 15, 2 * mib, 2_000, 2_000, 2 * mib),
        (2_800, 1, 28, 3 * mib, 60_500, 3_001, 3 * mib),
    ]
    assert report(spark, rows) == {
        "max files downloaded": "2800",
        "avg files downloaded": "941",
        "min files downloaded": "10",
        "total bytes downloaded": "6.00 MB",
        "avg download duration": "21166 milliseconds",
        "max download duration": "60500 milliseconds",
        "min download duration": "1 second",
        "avg records throughput": "2,000 records/sec",
        "max records throughput": "3,001 records/sec",
        "min records throughput": "1,000 records/sec",
        "avg bytes throughput": "2.00 MB/s",
        "max bytes throughput": "3.00 MB/s",
        "min bytes throughput": "1.00 MB/s",
    }


@pytest.mark.parametrize(("files", "average"), [([10, 15, 28], 17), ([1_000, 2_000, 3_000], 2_000), ([7], 7)])
def test_averages_are_whole(spark, files, average):
    figures = spark.createDataFrame([(f, 0, 0, 0, 0, 0, 0) for f in files], FIGURES)
    row = metrics.summary(figures, "files").first()
    assert (row["avg"], row["max"], row["min"]) == (average, max(files), min(files))
    assert metrics.metrics_report(figures).where("metric = 'avg files downloaded'").first()["value"] == f"{average:,}"
