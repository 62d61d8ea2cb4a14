"""Who owns a resource: the asset register joined to the detail rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postura import schemas

# Fixed value: the owner of a resource the register does not know.
UNDEFINED = "undefined"

_KEY = ("resource", "resource_type")


def unique_assets(assets: DataFrame) -> DataFrame:
    """One row per resource: the most complete; of equally complete rows the lowest by value."""
    gaps = sum((F.col(d).isNull().cast("int") for d in schemas.DIMENSIONS), F.lit(0))
    picked = F.min(F.struct(gaps.alias("_gaps"), *schemas.DIMENSIONS)).alias("_owner")
    return assets.groupBy(*_KEY).agg(picked).select(*_KEY, *[f"_owner.{d}" for d in schemas.DIMENSIONS])


def enrich_assets(df: DataFrame, assets: DataFrame | None = None) -> DataFrame:
    """Add business_unit, team and location; ``'undefined'`` where the register is silent.

    The register is the build side.  It is small enough to broadcast by Spark's check
    or it is not, in which case a hot resource sits on the left of a left outer join,
    the side skew splitting can divide.
    """
    bare = df.drop(*schemas.DIMENSIONS)
    if assets is None:
        return bare.withColumns({d: F.lit(UNDEFINED) for d in schemas.DIMENSIONS})
    joined = bare.join(unique_assets(assets), list(_KEY), "left")
    return joined.withColumns({d: F.coalesce(d, F.lit(UNDEFINED)) for d in schemas.DIMENSIONS})
