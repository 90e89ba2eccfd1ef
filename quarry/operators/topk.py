"""Top-k rows per group that stays bounded when one group holds a large share of the rows.

One ``row_number() <= k`` window over the group key would send every surviving row of a hot
group to one task: after the map-side partial limit that is still ``k`` rows per map
partition.  With many input partitions we first rank inside ``(group, salt)`` where the
salt is the input partition folded into ``S`` buckets, so the partial limit already keeps
``k`` per group per map partition, each salted task receives ``k * M / S`` rows and the
final task ``k * S``; ``S = sqrt(M)`` balances both.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Below this many input partitions a single ranking level is already small.
SALT_MIN_PARTITIONS = 64


def top_k_per_group(df: DataFrame, keys: list[str], order: list[Column], k: int,
                    rank_col: str = "rank", salt_buckets: int | None = None) -> DataFrame:
    """Rows with ``rank_col`` = 1..k per group in ``order`` (which must be a total order)."""
    if salt_buckets is None:
        # The map side of the ranking exchange runs on about as many partitions as the
        # cluster's shuffle width; planning the child just to count them would execute
        # its stages early under AQE.
        spark = df.sparkSession
        parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
        try:
            parts = max(parts, spark.sparkContext.defaultParallelism)
        except Exception:  # remote session: the shuffle width is the estimate
            pass
        buckets = int(math.ceil(math.sqrt(parts))) if parts >= SALT_MIN_PARTITIONS else 1
    else:
        buckets = salt_buckets
    staged = df
    if buckets > 1:
        staged = (df.withColumn("_salt", F.pmod(F.spark_partition_id(), F.lit(buckets)))
                  .withColumn("_r", F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order)))
                  .filter(F.col("_r") <= k).drop("_salt", "_r"))
    ranked = staged.withColumn(rank_col, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.filter(F.col(rank_col) <= k)
