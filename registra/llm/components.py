"""Connected components of a graph that is kept in tables."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from registra.llm.common import written


def components(links: DataFrame) -> DataFrame:
    """id, label for every end of a link; the label is the smallest id of the component.

    `links` has columns a and b. Labels fall to the smallest of a node's and its neighbours' until nothing
    changes. Stars, the common case, take two rounds; from the third on a label also falls to the label
    of the label, so that long paths take a number of rounds that grows with the logarithm of their length.
    Every round is a written table; the driver sees one flag.
    """
    ends = F.explode(F.array(*[F.struct(F.col(x).alias("a"), F.col(y).alias("b")) for x, y in ("ab", "ba", "aa", "bb")]))
    both = written(links.select(ends.alias("end")).select("end.*").distinct(), "links")
    labels = written(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("label")), "labels")
    for number in itertools.count(1):
        near = both.join(labels.select(F.col("id").alias("b"), "label"), "b")
        own = F.max(F.when(F.col("a") == F.col("b"), F.col("label")))
        lower = near.groupBy(F.col("a").alias("id")).agg(F.min("label").alias("low"), own.alias("label"))
        if number > 2:
            lower = written(lower, "lower")  # read twice
            of_label = lower.select(F.col("id").alias("low"), F.col("low").alias("lowest"))
            lower = lower.join(of_label, "low").select("id", F.least("low", "lowest").alias("low"), "label")
        stepped = written(lower, "labels")
        labels = stepped.select("id", F.col("low").alias("label"))
        if stepped.filter("low < label").isEmpty():
            return labels
