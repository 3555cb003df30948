from __future__ import annotations

from pyspark.sql import functions as F


def apply(spark, function, values, kind="string"):
    """Values of a column function, one per input value."""
    df = spark.createDataFrame(list(enumerate(values)), f"place int, v {kind}")
    rows = df.select("place", function(F.col("v")).alias("r")).orderBy("place").collect()
    return [row.r for row in rows]


def _nodes(plan):
    """All nodes of a physical plan, those of subqueries too."""
    kind = plan.getClass().getSimpleName()
    if kind == "AdaptiveSparkPlanExec":
        yield from _nodes(plan.initialPlan())
        return
    yield kind, plan
    for seq in (plan.children(), plan.subqueries()):
        for k in range(seq.size()):
            yield from _nodes(seq.apply(k))


def shuffled_columns(df) -> list[set[str]]:
    """The columns that each shuffle of a plan carries."""
    found = []
    for kind, node in _nodes(df._jdf.queryExecution().executedPlan()):
        if kind == "ShuffleExchangeExec":
            out = node.output()
            found.append({out.apply(k).name() for k in range(out.size())})
    return found
