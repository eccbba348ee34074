"""Connected components of a link table, as a loop of joins over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stash


def connected_components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest id reachable from each id that has a link.

    Each round takes the smallest label among the neighbours, then follows the
    label's own label, so the rounds grow with the logarithm of a chain's
    length.  A hub with very many links is one join key with one row on the
    label side, which the skew join splits; the minimum is combined before the
    shuffle.  Null ids and self links are ignored; no links give no rows.
    """
    pairs = links.select(F.col(a).alias("u"), F.col(b).alias("v")).where("u <> v")
    arcs = stash(pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))).distinct(), "arcs")
    labels = stash(arcs.groupBy(F.col("u").alias("id"))
                   .agg(F.min("v").alias("m"))
                   .select("id", F.least("id", "m").alias("component")), "labels")
    changed = not labels.isEmpty()
    while changed:
        near = (arcs.join(labels, arcs.v == labels.id)
                .groupBy("u").agg(F.min("component").alias("m")))
        step = stash(labels.join(near, labels.id == near.u)
                     .select("id", F.col("component").alias("before"), F.least("component", "m").alias("component")), "labels")
        up = step.select(F.col("id").alias("root"), F.col("component").alias("above"))
        now = stash(step.join(up, step.component == up.root)
                    .select("id", "before", F.least("component", "above").alias("component")), "labels")
        changed = not now.where("component <> before").isEmpty()
        labels = now.select("id", "component")
    return labels
