"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripflow.session import materialise


def components(links: DataFrame) -> DataFrame:
    """(id, component) for every id in links (a, b); the component is its smallest id.

    Labels spread along links and then jump to the label of their label, so
    the rounds grow with the logarithm of a component's width. Every round is
    a table in the shared folder; nothing gathers in one place.
    """
    both = materialise(
        links.select("a", "b").union(links.select("b", "a")).filter("a IS NOT NULL AND b IS NOT NULL").distinct()
    )
    labels = materialise(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("component")))
    while True:
        of = labels.select(F.col("id").alias("b"), F.col("component").alias("near"))
        heard = both.join(of, "b").groupBy(F.col("a").alias("id")).agg(F.min("near").alias("near"))
        spread = labels.join(heard, "id").select(
            "id", F.col("component").alias("before"), F.least("component", "near").alias("component")
        )
        spread = materialise(spread)
        root = spread.select(F.col("id").alias("component"), F.col("component").alias("root"))
        jumped = spread.join(root, "component", "left").select(
            "id", "before", F.least(F.col("component"), F.coalesce("root", "component")).alias("component")
        )
        jumped = materialise(jumped)
        labels = jumped.drop("before")
        if jumped.filter("before <> component").isEmpty():
            return labels
