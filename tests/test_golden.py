"""Known results on the sf0.01 data."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from postura.operators.sampling import v_summary
from postura.operators.scoring import weighted_categories
from postura.plans.catalogue import shipped_metrics
from postura.plans.runner import plan_metrics
from postura.workload.fixtures import AS_OF, YEAR_END, Fixtures
from tests.conftest import rows


@pytest.fixture(scope="module")
def f(spark):
    return Fixtures(spark, "/root/testdata/sf0.01")


def test_metrics(f):
    run = plan_metrics(shipped_metrics(), f.raw, AS_OF)
    counts = run.detail.groupBy("metric_id").agg(
        F.sum("compliance").cast("int"), F.count(F.lit(1))
    )
    found = {m: (ok, n) for m, ok, n in rows(counts)}
    found.pop("identity_credentials")
    assert found == {
        "vulnerabilities_critical": (109, 4114),
        "vulnerabilities_critical_patching": (110, 4055),
        "vulnerabilities_explot_patchable": (490, 2175),
        "identity_dormant": (376, 1214),
        "user_awareness": (344, 1263),
        "development_vulnerabilities": (2371, 2988),
    }


def test_sampled_dates_and_category_scores(f):
    sampled = v_summary(f.stored_summary, YEAR_END)
    dates = {str(r[0]) for r in rows(sampled.select("datestamp").distinct())}
    assert len(dates) == 12
    assert max(dates) == "2001-10-10"
    scores = rows(weighted_categories(sampled).select("category", F.round("score", 6)))
    assert scores == [
        ("Identity Management", 0.516667),
        ("Software Development", 0.4),
        ("User Security", 1.0),
        ("Vulnerability Management", 0.95),
    ]
