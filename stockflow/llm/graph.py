"""Connected components of a link table, by least labels with pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockflow.session import materialize


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every end of the links ``a, b``: root is the least node it reaches.

    Labels live in tables written to the shared folder. A round takes the least label of all
    neighbours and then the label of that label, so long chains shrink by squaring. Nothing but
    the count of changed labels comes to the driver.
    """
    both = materialize(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
                       .where("a <> b").distinct(), "links")
    labels = materialize(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
                         .select(F.col("a").alias("node"), "root"), "labels")
    while True:
        near = (both.join(labels, both.b == labels.node).groupBy("a").agg(F.min("root").alias("near")))
        step = (labels.join(near, labels.node == near.a)
                .select("node", F.least("root", "near").alias("new"), F.col("root").alias("old")))
        up = labels.select(F.col("node").alias("via"), F.col("root").alias("jump"))
        step = (step.join(up, step.new == up.via, "left")
                .select("node", F.least("new", "jump").alias("root"), "old"))
        written = materialize(step, "labels")
        labels = written.select("node", "root")
        if not written.where("root <> old").limit(1).count():
            return labels
