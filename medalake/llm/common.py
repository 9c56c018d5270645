"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from medalake.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def positional(df: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``df`` with columns renamed by position, and exact name -> new name (first of equal names).

    Extra columns that repeat a name, also in other letter case, can then not make a reference ambiguous.
    """
    names = {}
    for i, c in enumerate(df.columns):
        names.setdefault(c, f"_{i}")
    return df.toDF(*[f"_{i}" for i in range(len(df.columns))]), names


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Just the named columns, matched exactly; further columns, clashing ones too, are ignored."""
    renamed, at = positional(df)
    return renamed.select(*[F.col(at[n]).alias(n) for n in names])


def saved(df: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    """Write ``df`` to the cluster's shared folder and read it back: lineage ends at files that every executor
    sees, so a lost executor costs no recomputation of what stands before."""
    path = shared_dir(spark, "llm", name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def rows(batch: pa.RecordBatch, *names: str) -> Iterator[tuple]:
    """Rows of a batch one at a time, so that only one text is a Python object at once."""
    cols = [batch.column(batch.schema.get_field_index(n)) for n in names]
    for i in range(batch.num_rows):
        yield tuple(c[i].as_py() for c in cols)
