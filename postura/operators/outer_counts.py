"""Left joins of a user's own SQL, with the right side counted instead of shuffled.

``SELECT ... FROM entities LEFT JOIN findings ON ...`` needs of the findings only the columns it names,
and how many findings have them.  So the findings are filtered by the conditions that speak of them
alone and counted by the columns still needed, where they lie; the counts are joined, and a result row
carries for how many rows it stands (``COPIES``).  The rows are those of the plain join, whatever the
query does with the columns.  A host with a third of all findings costs one counter per map task,
where the plain join sends them all to one task: Spark never splits the right side of a left join.

Where the query is of another shape (a grouping, a window, several joins, an expression that is not
the same for equal rows), it is left as it stands.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postura.operators.matching import COPIES


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _children(seq) -> list:
    return [seq.apply(i) for i in range(seq.size())]


def _conjuncts(condition) -> list:
    if _kind(condition) != "And":
        return [condition]
    return _conjuncts(condition.left()) + _conjuncts(condition.right())


class _Catalyst:
    """Frames and columns of parts of an analysed plan."""

    def __init__(self, df: DataFrame) -> None:
        self.spark = df.sparkSession
        self.sql = self.spark._jvm.org.apache.spark.sql.classic

    def frame(self, plan) -> DataFrame:
        from pyspark.sql.classic.dataframe import DataFrame as Classic

        return Classic(self.sql.Dataset.ofRows(self.spark._jsparkSession, plan), self.spark)

    def column(self, expression) -> Column:
        from pyspark.sql.classic.column import Column as Classic

        return Classic(self.sql.ExpressionUtils.column(expression))

    def all(self, expressions: list) -> Column:
        return reduce(lambda a, b: a & b, [self.column(e) for e in expressions])


def _parts(df: DataFrame):
    """Projected columns, filters and join of a plan that is just these, or None."""
    if not hasattr(df, "_jdf"):
        return None
    project = df._jdf.queryExecution().analyzed()
    if _kind(project) != "Project":
        return None
    columns = _children(project.projectList())
    node, filters = project.child(), []
    while _kind(node) in ("Filter", "SubqueryAlias"):
        if _kind(node) == "Filter":
            filters.append(node.condition())
        node = node.child()
    if _kind(node) != "Join" or node.joinType().toString() != "LeftOuter" or node.condition().isEmpty():
        return None
    everything = [*columns, *filters, node.condition().get()]
    if not all(e.deterministic() for e in everything) or any(_has_subquery(e) for e in everything):
        return None
    return columns, filters, node


def _has_subquery(expression) -> bool:
    return "Subquery" in _kind(expression) or any(map(_has_subquery, _children(expression.children())))


def count_right_side(df: DataFrame) -> DataFrame:
    """``df`` as compact rows where it is a plain left join; else as it is."""
    parts = _parts(df)
    if parts is None or COPIES in df.columns:
        return df
    columns, filters, join = parts
    catalyst = _Catalyst(df)
    right = join.right().outputSet()
    conditions = _conjuncts(join.condition().get())
    own = [c for c in conditions if not c.references().isEmpty() and c.references().subsetOf(right)]
    both = [c for c in conditions if c not in own]
    if not both:
        return df
    findings = catalyst.frame(join.right())
    if own:
        findings = findings.filter(catalyst.all(own))
    needed = [
        a for a in _children(join.right().output()) if any(e.references().contains(a) for e in (*both, *columns, *filters))
    ]
    counts = findings.groupBy(*[catalyst.column(a) for a in needed]).agg(F.count(F.lit(1)).alias(COPIES))
    joined = catalyst.frame(join.left()).join(counts, catalyst.all(both), "left")
    if filters:
        joined = joined.filter(catalyst.all(filters))
    copies = F.coalesce(F.col(COPIES), F.lit(1).cast("bigint")).alias(COPIES)
    return joined.select(*[catalyst.column(c) for c in columns], copies)
