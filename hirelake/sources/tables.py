"""Reading and writing tables: Parquet files and JDBC databases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


# The given tables. With a declared schema no job has to read file footers before a query starts.
GIVEN_TABLES = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "pages": "page_id BIGINT, url STRING, html STRING",
}


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(GIVEN_TABLES[name]).parquet(f"{folder.rstrip('/')}/{name}.parquet")


def jdbc_options(
    url: str,
    table: str,
    user: str,
    password: str,
    driver: str = "org.postgresql.Driver",
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 1,
) -> dict[str, str]:
    """Options of a JDBC scan. With a partition column the table is read in parallel ranges.

    ``lower`` and ``upper`` only set the stride of the ranges; rows outside are read too.
    """
    options = {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "driver": driver,
        "fetchsize": "10000",
    }
    if partition_column is not None:
        if lower is None or upper is None:
            raise ValueError("a partitioned scan needs the lower and upper bound of its column")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, **scan) -> DataFrame:
    return spark.read.format("jdbc").options(**jdbc_options(**scan)).load()


def append_jdbc(df: DataFrame, **sink) -> None:
    """Append rows to a database table."""
    df.write.format("jdbc").mode("append").options(**jdbc_options(**sink)).save()


def reload_jdbc(df: DataFrame, **sink) -> None:
    """Truncate a database table, keeping its definition and keys, and load it anew."""
    options = jdbc_options(**sink) | {"truncate": "true"}
    df.write.format("jdbc").mode("overwrite").options(**options).save()
