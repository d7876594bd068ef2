"""Access to the driver tables and to scratch folders.

`Tables` is a thin name -> DataFrame mapping over one directory of Parquet
files. Reads are lazy, so a query only scans the columns and row groups its
plan needs (ReadSchema / PushedFilters in `explain`).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from silverline.session import ensure_checkpoint_dir

DRIVER_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


# Declared schemas of the driver tables. Reading with a declared schema skips
# the footer-inference job each `read.parquet` otherwise runs, and pins the
# types every query and oracle relies on.
TABLE_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


class Tables:
    """Lazy readers for `<root>/<name>.parquet`."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or name not in DRIVER_TABLES:
            raise AttributeError(name)
        return self.spark.read.schema(TABLE_SCHEMAS[name]).parquet(self.path(name))

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh folder under the session's shared checkpoint directory.

    Queries that write (sinks, versioned datasets, streaming) put their output
    here and return a DataFrame that reads it back, so the result stays valid
    after the call and survives executor loss (it is on shared storage, not a
    machine-local temp dir)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/silverline-scratch/{label}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write `df` once as Parquet under the shared checkpoint folder and
    return a frame that reads it back: lineage is cut by a written table, the
    rows survive executor loss, and later consumers read columnar files
    instead of recomputing the plan."""
    path = scratch_path(df.sparkSession, label)
    df.write.mode("overwrite").parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
