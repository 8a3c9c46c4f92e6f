"""A node that holds most links is split in the joins of the components."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakebook.llm import components
from lakebook.llm.shared import stored

SKEW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
}


@pytest.mark.parametrize("star", ["_large_star", "_small_star"])
def test_a_hot_node_is_split(spark, star):
    """Two thirds of all links on one node: the smaller of each link, or the larger."""
    session = spark.newSession()
    for key, value in SKEW.items():
        session.conf.set(key, value)
    hot, other = F.col("id") < 200_000, F.col("id") + 1_000_000
    if star == "_large_star":
        links = [other.alias("a"), F.when(hot, 0).otherwise(F.col("id")).alias("b")]
    else:
        links = [F.when(hot, 9_000_000).otherwise(other).alias("a"), F.col("id").alias("b")]
    found = getattr(components, star)(stored(session.range(300_000).select(*links), "links"))
    found.collect()
    assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
