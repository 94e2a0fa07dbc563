"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# A join whose one side has a unique key may still meet a key that holds a large share
# of the other side. Adaptive execution then splits that partition, also where the
# split costs one more shuffle before a following aggregate.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Joins on long receipt keys sort slowly; hash a side whose partitions turn out small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
}

# Only a new session takes these. A week's plan compiles more stages than the default
# cache of 100 holds, so repeated runs in one session would compile them all again.
STATIC = {"spark.sql.codegen.cache.maxEntries": "2000"}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session; memory, cores and partition counts stay with the caller."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
