"""Operational tables over JDBC.

Connection options (url, user, password, driver) are an argument and are
never stored. The incremental predicate is a DataFrame ``filter``: Catalyst
pushes it into the JDBC query (``PushedFilters``), no SQL is built by string
interpolation. Large tables are read in parallel with the JDBC partitioning
options (range of a numeric/date column split into ``num_partitions``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, options: dict[str, str], table: str,
               partition_column: str | None = None, lower_bound=None, upper_bound=None,
               num_partitions: int | None = None, fetch_size: int = 10_000) -> DataFrame:
    # source DATETIME columns are zone-less: read them as timestamp_ntz
    r = (spark.read.format("jdbc").options(**options).option("dbtable", table)
         .option("fetchsize", str(fetch_size)).option("preferTimestampNTZ", "true"))
    if partition_column:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partitioned JDBC reads need lower_bound, upper_bound and num_partitions")
        r = (r.option("partitionColumn", partition_column)
             .option("lowerBound", str(lower_bound)).option("upperBound", str(upper_bound))
             .option("numPartitions", str(num_partitions)))
    return r.load()
