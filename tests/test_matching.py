from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from postura.operators import matching
from postura.operators.assets import enrich_assets
from postura.operators.matching import entity_vs_findings, expand, match_counts
from postura.operators.rollups import metric_scores, summarise
from tests.conftest import rows


@pytest.fixture(scope="module")
def hosts(spark):
    return spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C"), (None, "N")], "id string, name string")


@pytest.fixture(scope="module")
def findings(spark):
    data = [("a", "open"), ("a", "open"), ("a", "closed"), ("b", "closed"), ("b", None), (None, "open"), ("z", "open")]
    return spark.createDataFrame(data, "host string, state string")


def test_one_row_per_match_and_one_without(hosts, findings):
    found = expand(entity_vs_findings(hosts, findings, "id", "host", F.col("state") == "open"))
    assert rows(found, "name", "matched") == [
        ("A", True),
        ("A", True),
        ("B", False),
        ("C", False),
        ("N", False),
    ]


def test_per_entity(hosts, findings):
    found = entity_vs_findings(hosts, findings, "id", "host", F.col("state") == "open", per_entity=True)
    assert rows(found, "name", "matched") == [("A", True), ("B", False), ("C", False), ("N", False)]


def test_several_conditions_are_counted_in_one_scan(hosts, findings):
    found = match_counts(
        hosts,
        findings,
        "id",
        "host",
        {"open": F.col("state") == "open", "closed": F.col("state") == "closed"},
    )
    assert rows(found, "name", "open", "closed") == [
        ("A", 2, 1),
        ("B", 0, 1),
        ("C", 0, 0),
        ("N", 0, 0),
    ]


@pytest.mark.parametrize("piece", [1, 3, 7, 10_000])
def test_hot_key_against_brute_force(spark, monkeypatch, piece):
    """A third of all findings on one host; row counts equal those of the plain join."""
    monkeypatch.setattr(matching, "COPIES_PER_PIECE", piece)
    rng = random.Random(piece)
    keys = [0 if rng.random() < 0.34 else rng.randrange(50) for _ in range(600)]
    findings = spark.createDataFrame([(k, k % 3) for k in keys], "host int, level int")
    hosts = spark.range(60).select(F.col("id").cast("int").alias("id"))
    plain = hosts.join(findings, (F.col("id") == F.col("host")) & (F.col("level") == 0), "left").select(
        "id", F.col("host").isNotNull().alias("matched")
    )
    ours = expand(entity_vs_findings(hosts, findings, "id", "host", F.col("level") == 0))
    assert rows(ours, "id", "matched") == rows(plain)


def test_expanding_spreads_a_hot_row(spark, monkeypatch):
    monkeypatch.setattr(matching, "COPIES_PER_PIECE", 100)
    one = spark.createDataFrame([("hot", 80_000)], f"name string, {matching.COPIES} long")
    parts = expand(one, 8).groupBy(F.spark_partition_id()).count().collect()
    assert len(parts) == 8
    assert sum(r[1] for r in parts) == 80_000
    assert max(r[1] for r in parts) <= 15_000


def test_plain_rows_pass_unchanged(hosts):
    assert expand(hosts) is hosts


def test_sums_of_compact_rows_equal_sums_of_expanded_rows(spark):
    schema = (
        "datestamp date, metric_id string, title string, category string, slo double, slo_min double,"
        "weight double, business_unit string, team string, location string, compliance double, _copies long"
    )
    base = (None, "m", "M", "C", 0.9, 0.8, 1.0, "u", "t", "l")
    compact = spark.createDataFrame(
        [(*base, 1.0, 3), (*base, 0.0, 5), (*base, 0.5, 2), (*base, None, 7), (*base, 1.0, None)], schema
    )
    for roll_up in (summarise, metric_scores):
        assert rows(roll_up(compact)) == rows(roll_up(expand(compact)))
    assert rows(summarise(compact), "totalok", "total") == [(5.0, 11)]


def test_owner_lookup(spark):
    measured = spark.createDataFrame(
        [("a", "host"), ("a", "user"), ("b", "host"), (None, "host")], "resource string, resource_type string"
    )
    assets = spark.createDataFrame(
        [("a", "host", "u2", "t", "l"), ("a", "host", "u1", "t", "l"), ("b", "host", None, "t", "l")],
        "resource string, resource_type string, business_unit string, team string, location string",
    )
    got = rows(enrich_assets(measured, assets), "resource", "resource_type", "business_unit", "team")
    assert got == [
        ("a", "host", "u1", "t"),
        ("a", "user", "undefined", "undefined"),
        ("b", "host", "undefined", "t"),
        (None, "host", "undefined", "undefined"),
    ]
    assert {r[2] for r in rows(enrich_assets(measured))} == {"undefined"}
