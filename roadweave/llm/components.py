"""Connected components of a table of links, by least labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadweave.runtime import discard, stored


def components(links: DataFrame) -> DataFrame:
    """``id`` and ``label`` (the least id of its component) of every id in ``links`` (``a``, ``b``), read several times.

    A round takes the least label among a node's neighbours and then that label's own label, so long chains halve; each
    round's labels are written to the shared folder, and a round that changes nothing is the last.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).where("a <> b").distinct(), "links")
    labels = stored(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "id").withColumn("changed", F.lit(True)), "labels")
    while labels.where("changed").limit(1).count():
        old = labels.select("id", F.col("label").alias("old"))
        near = both.join(old.withColumnRenamed("id", "b"), "b").groupBy("a").agg(F.min("old").alias("near")).withColumnRenamed("a", "id")
        least = old.join(near, "id").select("id", "old", F.least("old", "near").alias("least"))
        jump = old.select(F.col("id").alias("least"), F.col("old").alias("jump"))
        label = F.least("least", F.coalesce("jump", "least"))
        before, labels = labels, stored(least.join(jump, "least", "left").select("id", label.alias("label"), (label < F.col("old")).alias("changed")), "labels")
        discard(before)
    discard(both)
    return labels.select("id", "label")
