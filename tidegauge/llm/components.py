"""Connected components of a link table, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidegauge.session import materialize


def components(links: DataFrame) -> DataFrame:
    """Rows (node, label) from links (u, v); the label is the least node of the component.

    A round takes the least label of all neighbours and then the label of that
    label, so long chains shrink by halves. Links and labels stay tables in the
    shared folder; a round brings back one number. Links of one hub combine
    before they are shuffled. Links with a null end are left out.
    """
    links = links.filter(F.col("u").isNotNull() & F.col("v").isNotNull() & (F.col("u") != F.col("v")))
    turned = links.select(F.col("v").alias("u"), F.col("u").alias("v"))
    both = materialize(links.select("u", "v").unionByName(turned).distinct(), "links")
    labels = materialize(
        both.groupBy(F.col("u").alias("node")).agg(F.least(F.min("v"), F.first("u")).alias("label")),
        "labels",
    )
    while True:
        seen = both.join(labels.select(F.col("node").alias("v"), "label"), "v").select(
            F.col("u").alias("node"), "label"
        )
        least = materialize(
            seen.unionByName(labels).groupBy("node").agg(F.min("label").alias("near")), "near"
        )
        jumped = least.join(
            least.select(F.col("node").alias("near"), F.col("near").alias("far")), "near"
        ).select("node", F.least("near", "far").alias("new"))
        step = materialize(jumped.join(labels, "node"), "step")
        changed = step.filter("new < label").limit(1).count()
        labels = step.select("node", F.col("new").alias("label"))
        if not changed:
            return labels
