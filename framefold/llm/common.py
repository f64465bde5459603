"""What the corpus operators share: reading documents, landing results, row identity."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from framefold.session import apply_settings, scratch_dir, ship_package

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

def prepare(spark: SparkSession) -> None:
    """The session settings and the code that the operators rely on."""
    apply_settings(spark)
    ship_package(spark)


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query of this subpackage; without ``sql`` tests compare it with brute force."""

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            prepare(spark)
            return fn(spark, sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def land(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` below the shared scratch folder and read it back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def id_remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


def id_remainder_of(doc_id, modulus: int) -> int:
    """The same for a Python value."""
    return zlib.crc32(b"" if doc_id is None else str(int(doc_id)).encode()) % modulus
