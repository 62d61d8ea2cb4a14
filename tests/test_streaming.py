from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from postura.operators.rollups import summarise
from postura.streaming.publish import (
    accumulated_summary,
    replaced_summary,
    stream_publish,
    stream_rows,
)
from postura.workload import report_queries
from tests.conftest import rows
from tests.test_tables import detail

D1, D2 = dt.date(2001, 1, 1), dt.date(2001, 1, 2)


@pytest.fixture
def places(tmp_path):
    return {n: str(tmp_path / n) for n in ("landed", "log", "state")}


def arrive(df, places):
    df.coalesce(1).write.mode("append").json(places["landed"])


def run(spark, places, files=None):
    rows_in = stream_rows(spark, places["landed"], files_per_batch=files)
    stream_publish(rows_in, places["log"], places["state"]).awaitTermination()


def test_late_file_replaces_its_metric_day(spark, places):
    arrive(detail(spark, (D1, "a", "h1", 1.0), (D1, "b", "h1", 1.0)), places)
    run(spark, places)
    arrive(detail(spark, (D2, "a", "h1", 0.0)), places)
    run(spark, places)
    arrive(detail(spark, (D1, "a", "h1", 0.0), (D1, "a", "h2", 0.0)), places)
    run(spark, places)
    assert rows(replaced_summary(spark, places["log"]), "datestamp", "metric_id", "totalok", "total") == [
        (D1, "a", 0.0, 2),
        (D1, "b", 1.0, 1),
        (D2, "a", 0.0, 1),
    ]
    run(spark, places)
    assert replaced_summary(spark, places["log"]).count() == 3


@pytest.mark.parametrize("files", [1, 2, 10])
def test_parts_of_a_metric_day_add_up(spark, places, files):
    parts = [detail(spark, (D1, "a", f"h{i}", float(i % 2)), (D2, "b", "h", 1.0)) for i in range(4)]
    for part in parts:
        arrive(part, places)
    run(spark, places, files)
    everything = parts[0].unionAll(parts[1]).unionAll(parts[2]).unionAll(parts[3])
    assert rows(accumulated_summary(spark, places["log"])) == rows(summarise(everything))


def test_replayed_batch_overwrites_itself(spark, places, tmp_path):
    """A lost commit log makes Spark run the batch again."""
    arrive(detail(spark, (D1, "a", "h1", 1.0)), places)
    run(spark, places)
    again = {**places, "state": str(tmp_path / "other state")}
    run(spark, again)
    assert rows(accumulated_summary(spark, places["log"]), "totalok", "total") == [(1.0, 1)]


def test_deliveries_come_in_several_files_and_in_the_same_again(spark, tmp_path, monkeypatch):
    """A delivery is not one file of one task, however large; its files are compressed."""
    monkeypatch.setattr(report_queries, "FILE_ROWS", 100)
    users = spark.range(1000).select(F.struct(F.col("id").alias("login")).alias("profile"), F.lit("x").alias("status"))

    def files(rows_in, name):
        report_queries.deliver_json(report_queries.in_files(rows_in, 1000), str(tmp_path / name))
        found = spark.read.json(str(tmp_path / name))
        assert all(f.endswith(".json.gz") for f in found.inputFiles())
        by_file = found.groupBy(F.input_file_name()).agg(F.sort_array(F.collect_list("profile.login")).alias("rows"))
        return sorted(r["rows"] for r in by_file.collect())

    once = files(users, "once")
    assert len(once) == 10 and max(map(len, once)) < 200 and sum(map(len, once)) == 1000
    assert files(users.repartition(3), "again") == once
