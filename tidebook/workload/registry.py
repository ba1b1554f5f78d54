"""Registration of queries over the shared test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}

#: Load and build times differ from run to run, ``ordinal`` and ``absent`` only tell an upsert how
#: to merge rows: none is part of a compared result.
LEFT_OUT = ("dbt_loaded_at", "dbt_updated_at", "dbt_built_at", "ordinal", "absent")


#: Read schemas of the test tables: no job has to look into the files for them.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
              "o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
              "value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


class Tables:
    """The Parquet tables of one directory."""

    def __init__(self, spark: SparkSession, directory: str):
        self.spark = spark
        self.directory = directory

    def __getattr__(self, name: str) -> DataFrame:
        if name not in SCHEMAS:
            raise AttributeError(name)
        reader = self.spark.read.schema(SCHEMAS[name])
        return reader.parquet(f"{self.directory}/{name}.parquet")


def comparable(df: DataFrame) -> DataFrame:
    """Results as both engines print them: decimals as doubles, without clock or order columns."""
    return df.select([
        F.col(f.name).cast("double").alias(f.name)
        if isinstance(f.dataType, T.DecimalType)
        else F.col(f.name)
        for f in df.schema.fields
        if f.name not in LEFT_OUT
    ])


def query(name: str, sql: str | None = None):
    """Register ``fn(tables)`` under ``name``, with its SQL twin if it has one."""

    def register(fn: Callable[[Tables], DataFrame]):
        @wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(fn(Tables(spark, sf_dir)))

        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register
