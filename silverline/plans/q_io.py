"""Registered source / sink queries (2.1, 2.2).

Queries that write use a fresh folder under the session's shared checkpoint
directory and return a DataFrame that reads the written data back, so the
result stays valid after the call.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType, DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
    TimestampNTZType,
)

from silverline.functions.reference import UUID_PATTERN
from silverline.catalog import DRIVER_TABLES, Tables, scratch_path, stored
from silverline.operators import casting as C
from silverline.operators import reconcile as R
from silverline.plans import silver
from silverline.plans.registry import query
from silverline.plans.views import Views
from silverline.operators.dedupe import latest_per_key
from silverline.sinks import bucketed as BK
from silverline.sinks import files as K
from silverline.sources import csv_split as CS
from silverline.sources import landing as L
from silverline.sources import ranges as RG
from silverline.sources import text as T

BRONZE_USERS_SCHEMA = StructType([
    StructField("uuid", LongType()), StructField("username", StringType()), StructField("name", StringType()),
    StructField("sex", StringType()), StructField("address", StringType()), StructField("mail", StringType()),
    StructField("birthdate", DateType()),
])
BRONZE_ORDERS_SCHEMA = StructType([
    StructField("uuid", LongType()), StructField("user_uuid", LongType()), StructField("date", TimestampNTZType()),
    StructField("quantity", IntegerType()), StructField("product", StringType()), StructField("l_partkey", LongType()),
    StructField("l_suppkey", LongType()), StructField("l_extendedprice", DoubleType()),
])
STG_USERS_SCHEMA = StructType([
    StructField("user_id", LongType()), StructField("username", StringType()),
    StructField("username_normalized", StringType()), StructField("name", StringType()),
    StructField("sex", StringType()), StructField("email", StringType()),
    StructField("birthdate_original", DateType()), StructField("birthdate", DateType()),
    StructField("birthdate_is_valid", BooleanType()), StructField("street", StringType()),
    StructField("city", StringType()), StructField("state", StringType()), StructField("zip_code", StringType()),
])
USERS_HEADER = ",".join(BRONZE_USERS_SCHEMA.fieldNames())
RECORD_START = r"^[0-9]+,"  # a bronze users record starts with its numeric key


def _users_csv(spark, sf_dir, label="users-csv") -> str:
    path = scratch_path(spark, label)
    T.write_csv(Views(spark, sf_dir).bronze_users, path)
    return path


# ---------------------------------------------------------------- CSV / JSON / text


@query("csv_inferred_read", oracle="""
SELECT CAST(uuid AS INTEGER) AS uuid, username, name, sex, address, mail, birthdate FROM bronze_users""",
       views=("bronze_users",))
def q_csv_inferred_read(spark, sf_dir):
    """Header + inferred types over a multi-line quoted CSV (the key is
    inferred as int at this scale; dates as date)."""
    return T.read_csv_inferred(spark, _users_csv(spark, sf_dir))


@query("csv_typed_read", oracle="SELECT * FROM bronze_orders", views=("bronze_orders",))
def q_csv_typed_read(spark, sf_dir):
    """Explicit schema, FAILFAST."""
    path = scratch_path(spark, "orders-csv")
    T.write_csv(Views(spark, sf_dir).bronze_orders, path)
    return T.read_csv_typed(spark, path, BRONZE_ORDERS_SCHEMA, multiline=False)


DOCUMENTS_SCHEMA = StructType([
    StructField("doc_id", LongType()), StructField("text", StringType()), StructField("lang", StringType()),
    StructField("source", StringType()), StructField("n_chars", LongType()),
])


@query("csv_split_multiline", oracle="SELECT doc_id, text, lang, source, n_chars FROM documents")
def q_csv_split_multiline(spark, sf_dir):
    """Whole documents as CSV with quoted newlines and quotes, each file
    read by as many tasks as it has blocks."""
    path = scratch_path(spark, "documents-csv")
    T.write_csv(Tables(spark, sf_dir).documents.select(*DOCUMENTS_SCHEMA.fieldNames()), path)
    return CS.read_csv_split(spark, path, DOCUMENTS_SCHEMA)


@query("csv_record_lines", oracle="""
SELECT least(n, 4) AS lines, count(*) AS records FROM (SELECT len(string_split(text, chr(10))) AS n FROM documents) GROUP BY 1""")
def q_csv_record_lines(spark, sf_dir):
    """Records of a multi-line CSV by their number of physical lines (four and more together)."""
    path = scratch_path(spark, "documents-csv")
    T.write_csv(Tables(spark, sf_dir).documents.select("doc_id", "text"), path)
    records, _long = CS.csv_records(spark, path)
    return records.groupBy(F.least("n_lines", F.lit(4)).alias("lines")).agg(F.count("*").alias("records"))


@query("csv_lines_without_header", oracle="""
SELECT o_orderkey || ',' || o_custkey || ',' || o_orderpriority AS line FROM orders""")
def q_csv_lines_without_header(spark, sf_dir):
    """S3: lines of headed CSV files and of a file of blank ones, without header and blank lines."""
    path = scratch_path(spark, "orders-lines")
    T.write_csv(Tables(spark, sf_dir).orders.select("o_orderkey", "o_custkey", "o_orderpriority"), path)
    spark.sql("SELECT explode(array('', '  ')) AS value").write.mode("append").text(path)
    lines = T.drop_header_and_blank(T.read_lines(spark, path), header="o_orderkey,o_custkey,o_orderpriority")
    return lines.select(F.col("value").alias("line"))


@query("uuid_record_starts", oracle="""
SELECT CAST(sum(len(string_split(address, chr(10)))) AS BIGINT) AS physical_lines, count(*) AS records FROM bronze_users""",
       views=("bronze_users",))
def q_uuid_record_starts(spark, sf_dir):
    """Physical lines and the records that a UUID key begins, of text with two-line addresses."""
    digest = F.md5(F.col("uuid").cast("string"))
    key = F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-")
    path = scratch_path(spark, "users-uuid-text")
    Views(spark, sf_dir).bronze_users.select(F.concat(key, F.lit(","), "address").alias("value")).write.text(path)
    return T.record_start_counts(T.read_lines(spark, path), f"^{UUID_PATTERN},")


@query("seed_from_file", oracle="""
SELECT lpad(CAST(c_custkey * 37 % 100000 AS VARCHAR), 5, '0') AS zip_code, c_name AS name, c_nationkey AS nation, c_acctbal AS balance FROM customer""")
def q_seed_from_file(spark, sf_dir):
    """A seed from CSV files; the ZIP code stays text with its zeros, other columns are inferred."""
    path = scratch_path(spark, "seed")
    k = F.col("c_custkey")
    T.write_csv(Tables(spark, sf_dir).customer.select(
        F.lpad((k * 37 % 100000).cast("string"), 5, "0").alias("zip_code"), F.col("c_name").alias("name"),
        F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance")), path)
    return T.read_seed(spark, path, {"zip_code": "string"})


@query("csv_dialect_quoted", oracle="""
SELECT ';' AS delimiter, '"' AS quote, 4 AS fields, count(*) AS records, true AS consistent FROM bronze_users""", views=("bronze_users",))
def q_csv_dialect_quoted(spark, sf_dir):
    """The dialect of a CSV whose quoted texts hold more commas, pipes and newlines than there are delimiters."""
    users = Views(spark, sf_dir).bronze_users
    noisy = F.concat(F.lit("a, b, c | d; "), "address", F.lit(', said "x"; 1,2,3'))
    path = scratch_path(spark, "dialect-csv")
    rows = users.select("uuid", "name", noisy.alias("note"), "birthdate")
    rows.write.options(**T.CSV_OPTIONS | {"header": "false"}).option("sep", ";").csv(path)
    best = CS.sniff_quoted_dialect(spark, path)
    return best.select("delimiter", "quote", "fields", "records", (F.col("share") == 1).alias("consistent"))


@query("csv_round_trip", oracle="SELECT * FROM bronze_users", views=("bronze_users",))
def q_csv_round_trip(spark, sf_dir):
    """K6: CSV write + typed read gives back every row unchanged (padding,
    quotes and embedded newlines included)."""
    return T.read_csv_typed(spark, _users_csv(spark, sf_dir), BRONZE_USERS_SCHEMA)


@query("jsonl_round_trip", oracle="SELECT * FROM stg_users", views=("stg_users",))
def q_jsonl_round_trip(spark, sf_dir):
    """K6: JSON Lines write + read with schema."""
    path = scratch_path(spark, "users-jsonl")
    T.write_rows(Views(spark, sf_dir).stg_users, path, "jsonl")
    return spark.read.schema(STG_USERS_SCHEMA).json(path)


@query("text_lines_without_header", oracle="""
SELECT count(*) AS lines FROM (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)
WHERE trim(line) <> ''""")
def q_text_lines_without_header(spark, sf_dir):
    """S3: land whole document texts as text files, read physical lines back,
    drop blank lines (text files have no header line)."""
    path = scratch_path(spark, "documents-text")
    Tables(spark, sf_dir).documents.select("text").write.mode("overwrite").text(path)
    lines = T.read_lines(spark, path)
    return T.drop_header_and_blank(lines, header="\u0000").agg(F.count(F.lit(1)).alias("lines"))


@query("record_start_lines", oracle="""
SELECT 2 * count(*) AS physical_lines, count(*) AS records FROM customer""")
def q_record_start_lines(spark, sf_dir):
    """A multi-line CSV read as physical lines has two lines per record;
    only record-start lines match the key pattern."""
    lines = T.drop_header_and_blank(T.read_lines(spark, _users_csv(spark, sf_dir)), USERS_HEADER)
    return T.record_start_counts(lines, RECORD_START)


@query("parse_delimited_lines", oracle="SELECT * FROM bronze_orders", views=("bronze_orders",))
def q_parse_delimited_lines(spark, sf_dir):
    """Delimited lines parsed to typed records with from_csv."""
    path = scratch_path(spark, "orders-lines")
    T.write_csv(Views(spark, sf_dir).bronze_orders, path)
    header = ",".join(BRONZE_ORDERS_SCHEMA.fieldNames())
    lines = T.drop_header_and_blank(T.read_lines(spark, path), header)
    good, _bad = T.split_quarantine(T.parse_delimited(lines, BRONZE_ORDERS_SCHEMA))
    return good


@query("quarantine_malformed", oracle="""
SELECT 'multiline' AS reader, count(*) AS parsed, CAST(0 AS BIGINT) AS quarantined FROM customer
UNION ALL SELECT 'line_by_line', CAST(0 AS BIGINT), 2 * count(*) FROM customer""")
def q_quarantine_malformed(spark, sf_dir):
    """The same users CSV parsed record-aware (multiLine) and line by line.
    Line by line every physical line has the wrong arity, so each goes to the
    quarantine instead of failing the job."""
    path = _users_csv(spark, sf_dir)
    whole = T.read_csv_typed(spark, path, T.string_schema(BRONZE_USERS_SCHEMA.fieldNames()).add("_corrupt_record", StringType()),
                             multiline=True, mode="PERMISSIVE")
    lines = T.drop_header_and_blank(T.read_lines(spark, path), USERS_HEADER)
    parsed = T.parse_delimited(lines, T.string_schema(BRONZE_USERS_SCHEMA.fieldNames()))

    def counts(df, label):
        # A data column is referenced too: Spark refuses plans that read only
        # the corrupt-record column of a raw CSV.
        return df.agg(F.lit(label).alias("reader"),
                      F.count_if(F.col("_corrupt_record").isNull() & F.col("uuid").isNotNull()).alias("parsed"),
                      F.count_if(F.col("_corrupt_record").isNotNull()).alias("quarantined"))

    return counts(whole, "multiline").unionByName(counts(parsed, "line_by_line"))


@query("csv_dialect_profile", oracle="""
SELECT * FROM (VALUES ('orders', ',', '', true), ('users', ',', '"', true))
  AS t(dataset, delimiter, quote, has_header)""")
def q_csv_dialect_profile(spark, sf_dir):
    """Sniff delimiter / quote / header of every landed file, reported
    per dataset (the distinct dialects of its files: one row when they
    agree, whatever the number of part files)."""
    users = _users_csv(spark, sf_dir)
    orders = scratch_path(spark, "orders-csv-dialect")
    T.write_csv(Views(spark, sf_dir).bronze_orders, orders)
    per_file = T.sniff_dialect(T.read_lines(spark, users).unionByName(T.read_lines(spark, orders)))
    dataset = F.when(F.col("file_path").contains("/users-csv-"), F.lit("users")).otherwise(F.lit("orders"))
    return per_file.select(dataset.alias("dataset"), "delimiter", "quote", "has_header").distinct()


# The silver users schema contract: position, name, Spark type, nullability.
_USER_TYPES = (("user_id", "bigint"), ("username", "string"), ("username_normalized", "string"), ("name", "string"), ("sex", "string"),
               ("email", "string"), ("birthdate_original", "date"), ("birthdate", "date"), ("birthdate_is_valid", "boolean"),
               ("street", "string"), ("city", "string"), ("state", "string"), ("zip_code", "string"))


@query("describe_schema", oracle="\nUNION ALL ".join(
    f"SELECT {i} AS position, '{c}' AS column_name, '{t}' AS column_type, count({c}) AS filled, CAST(any_value({c}) AS VARCHAR) IS NOT NULL AS used "
    f"FROM stg_users" for i, (c, t) in enumerate(_USER_TYPES, 1)), views=("stg_users",))
def q_describe_schema(spark, sf_dir):
    """A stored relation's columns in order, with type and filled values,
    from one aggregation over the data."""
    df = stored(Views(spark, sf_dir).stg_users, "described")
    rows = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(f.name).alias("column_name"),
                              F.lit(f.dataType.simpleString()).alias("column_type"), F.count(f.name).alias("filled"),
                              (F.count(f.name) > 0).alias("used")) for i, f in enumerate(df.schema.fields, 1)])
    return df.agg(rows.alias("r")).select(F.explode("r").alias("r")).select("r.*")


# ---------------------------------------------------------------- Parquet


@query("parquet_scan", oracle="""
SELECT l_returnflag, CAST(sum(l_quantity) AS DOUBLE) AS sum_quantity, count(*) AS lines
FROM lineitem GROUP BY l_returnflag""")
def q_parquet_scan(spark, sf_dir):
    """Read Parquet through a glob; only the two used columns are read
    (ReadSchema) and the sum is partial-aggregated per task."""
    li = spark.read.parquet(f"{sf_dir.rstrip('/')}/line*.parquet")
    return li.groupBy("l_returnflag").agg(F.sum("l_quantity").alias("sum_quantity"), F.count(F.lit(1)).alias("lines"))


def _write_by_product(spark, sf_dir) -> str:
    path = scratch_path(spark, "orders-by-product")
    K.write_partitioned(Views(spark, sf_dir).stg_orders, path, ["product"])
    return path


@query("partitioned_write", oracle="SELECT product, count(*) AS orders FROM stg_orders GROUP BY product",
       views=("stg_orders",))
def q_partitioned_write(spark, sf_dir):
    """K4: Hive-partitioned write by product; the product column comes back
    from the directory names."""
    back = spark.read.parquet(_write_by_product(spark, sf_dir))
    return back.groupBy("product").agg(F.count(F.lit(1)).alias("orders"))


@query("partitioned_scan_filtered", oracle="SELECT count(*) AS orders FROM stg_orders WHERE product = 'large'",
       views=("stg_orders",))
def q_partitioned_scan_filtered(spark, sf_dir):
    """Equality filter on the partition column -> PartitionFilters,
    only one directory is listed and read."""
    back = spark.read.parquet(_write_by_product(spark, sf_dir))
    return back.filter(F.col("product") == "large").agg(F.count(F.lit(1)).alias("orders"))


@query("partitioned_write_by_month", oracle="""
SELECT CAST(date_trunc('month', ordered_at) AS DATE) AS month, count(*) AS orders FROM stg_orders GROUP BY 1""",
       views=("stg_orders",))
def q_partitioned_write_by_month(spark, sf_dir):
    """K5: partition growing data by month (salted so a hot month still has
    several writers)."""
    path = scratch_path(spark, "orders-by-month")
    K.write_partitioned(K.with_month(Views(spark, sf_dir).stg_orders, "ordered_at"), path, ["month"])
    back = spark.read.parquet(path)
    return back.groupBy("month").agg(F.count(F.lit(1)).alias("orders"))


@query("parquet_round_trip", oracle="SELECT * FROM stg_users", views=("stg_users",))
def q_parquet_round_trip(spark, sf_dir):
    """K1/K2: overwrite, read back, assert identical rows both ways."""
    users = Views(spark, sf_dir).stg_users
    path = scratch_path(spark, "users-parquet")
    K.write_parquet(users, path)
    back = spark.read.parquet(path)
    R.assert_identical(users, back, "users Parquet round trip")
    return back


@query("parquet_append", oracle="""
SELECT * FROM stg_orders
UNION ALL SELECT -order_id, user_id, ordered_at, quantity, product FROM (SELECT * FROM stg_orders ORDER BY order_id LIMIT 3)""",
       views=("stg_orders",))
def q_parquet_append(spark, sf_dir):
    """K3: append new rows to a Parquet directory; earlier files stay."""
    orders = Views(spark, sf_dir).stg_orders
    path = scratch_path(spark, "orders-append")
    K.write_parquet(orders, path)
    new = orders.orderBy("order_id").limit(3).withColumn("order_id", -F.col("order_id"))
    K.write_parquet(new, path, mode="append")
    return spark.read.parquet(path)


@query("range_clustered_write", oracle="SELECT * FROM stg_orders", views=("stg_orders",))
def q_range_clustered_write(spark, sf_dir):
    """K9: range-partition + sort on the timestamp before writing."""
    path = scratch_path(spark, "orders-clustered")
    K.write_range_clustered(Views(spark, sf_dir).stg_orders, path, "ordered_at")
    return spark.read.parquet(path)


@query("file_inventory", oracle="SELECT product, true AS has_bytes, count(*) AS record_count FROM stg_orders GROUP BY product",
       views=("stg_orders",))
def q_file_inventory(spark, sf_dir):
    """K7: files of a partitioned output with size and records, summed per partition folder."""
    files = K.file_inventory(spark, _write_by_product(spark, sf_dir))
    product = F.regexp_extract("file_path", "product=([^/]+)/", 1)
    return files.groupBy(product.alias("product")).agg(
        (F.min("file_size_in_bytes") > 0).alias("has_bytes"), F.sum("record_count").alias("record_count"))


@query("parquet_footer_profile", oracle="""
WITH t AS (SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer)
SELECT 'c_custkey' AS column_name, 'bigint' AS column_type, count(*) AS rows, count(*) - count(c_custkey) AS nulls, CAST(min(c_custkey) AS VARCHAR) AS least, CAST(max(c_custkey) AS VARCHAR) AS largest FROM t
UNION ALL SELECT 'c_name', 'string', count(*), count(*) - count(c_name), min(c_name), max(c_name) FROM t
UNION ALL SELECT 'c_nationkey', 'int', count(*), count(*) - count(c_nationkey), CAST(min(c_nationkey) AS VARCHAR), CAST(max(c_nationkey) AS VARCHAR) FROM t
UNION ALL SELECT 'c_mktsegment', 'string', count(*), count(*) - count(c_mktsegment), min(c_mktsegment), max(c_mktsegment) FROM t""")
def q_parquet_footer_profile(spark, sf_dir):
    """K8: rows, nulls and extremes of each file of a table by column (the table is one file)."""
    return K.file_profile(spark, f"{sf_dir}/customer.parquet").where("column_name <> 'c_acctbal'").drop("file_path")


@query("footer_row_counts", oracle="\nUNION ALL ".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in DRIVER_TABLES))
def q_footer_row_counts(spark, sf_dir):
    """K8: rows of every table's files, counted by the file they are read from."""
    tables = [K.rows_per_file(spark, f"{sf_dir}/{t}.parquet").agg(F.lit(t).alias("table_name"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"))
              for t in DRIVER_TABLES]
    return reduce(lambda a, b: a.unionByName(b), tables)


@query("partition_balance", oracle="""
SELECT 'repartition' AS method, true AS within_four, count(*) AS rows FROM stg_orders
UNION ALL SELECT 'coalesce', true, count(*) FROM stg_orders""", views=("stg_orders",))
def q_partition_balance(spark, sf_dir):
    """Repartition (shuffle) versus coalesce (no shuffle): at most four
    partitions either way, and no row lost."""
    per = K.partition_balance(Views(spark, sf_dir).stg_orders, 4)
    return per.groupBy("method").agg((F.count(F.lit(1)) <= 4).alias("within_four"), F.sum("rows").alias("rows"))


@query("persisted_reuse", oracle="""
SELECT 'by product' AS report, count(DISTINCT product) AS groups, count(*) AS orders FROM stg_orders
UNION ALL SELECT 'by user', count(DISTINCT user_id), count(*) FROM stg_orders""", views=("stg_orders",))
def q_persisted_reuse(spark, sf_dir):
    """A frame persisted for two actions (memory, then executor disk) and
    released after them; the results are stored, so they outlive it."""
    orders = Views(spark, sf_dir).stg_orders.persist()
    try:
        def report(label, key):
            per = orders.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
            return stored(per.agg(F.lit(label).alias("report"), F.count(F.lit(1)).alias("groups"), F.sum("n").alias("orders")), "persisted")
        return report("by product", "product").unionByName(report("by user", "user_id"))
    finally:
        orders.unpersist()


@query("view_table_equal", oracle="SELECT CAST(0 AS BIGINT) AS different_rows")
def q_view_table_equal(spark, sf_dir):
    """The same model materialised as a view and as a table agree."""
    users = Views(spark, sf_dir).stg_users
    view = K.materialize(users, "silverline_stg_users_view", "view")
    table = K.materialize(users, "stg_users", "table")
    return R.diff_rows(view, table).agg(F.count(F.lit(1)).alias("different_rows"))


# ---------------------------------------------------------------- landing


INGEST_DATE = "2024-02-01"


def _land(spark, sf_dir):
    v = Views(spark, sf_dir)
    root = scratch_path(spark, "landing")
    sources = {"users": f"{root}/local/users", "orders": f"{root}/local/orders"}
    T.write_csv(v.bronze_users, sources["users"])
    T.write_csv(v.bronze_orders, sources["orders"])
    bronze = f"{root}/bronze"
    for name, src in sources.items():
        L.land_files(spark, src, bronze, name, INGEST_DATE)
    return sources, bronze


@query("land_bronze", oracle=f"SELECT *, DATE '{INGEST_DATE}' AS ingest_date FROM bronze_orders",
       views=("bronze_orders",))
def q_land_bronze(spark, sf_dir):
    """Landing copy into bronze/<dataset>/ingest_date=<d>/, read back
    with partition discovery."""
    _sources, bronze = _land(spark, sf_dir)
    schema = StructType(BRONZE_ORDERS_SCHEMA.fields + [StructField("ingest_date", DateType())])
    return T.read_csv_typed(spark, f"{bronze}/orders", schema, multiline=False)


@query("verify_landing", oracle="""
SELECT 'users' AS dataset, true AS identical, count(*) AS records, CAST(0 AS BIGINT) AS orphan_records FROM bronze_users
UNION ALL
SELECT 'orders', true, count(*),
       (SELECT count(*) FROM bronze_orders o ANTI JOIN bronze_users u ON o.user_uuid = u.uuid) FROM bronze_orders""",
       views=("bronze_users", "bronze_orders"))
def q_verify_landing(spark, sf_dir):
    """Bytes equal (SHA-256 per file), record counts, every order's
    user present (anti join)."""
    sources, bronze = _land(spark, sf_dir)
    users = T.read_csv_typed(spark, f"{bronze}/users", BRONZE_USERS_SCHEMA)
    orders = T.read_csv_typed(spark, f"{bronze}/orders", BRONZE_ORDERS_SCHEMA, multiline=False)
    orphans = orders.join(users.select(F.col("uuid").alias("user_uuid")), "user_uuid", "left_anti")

    def row(name, records, orphan_count):
        same = L.identical_files(spark, sources[name], f"{bronze}/{name}/ingest_date={INGEST_DATE}")
        ident = same.select(((F.col("source_files") == F.col("identical_files"))
                             & (F.col("landed_files") == F.col("identical_files"))).alias("identical"))
        return ident.select(F.lit(name).alias("dataset"), "identical",
                            records.alias("records"), orphan_count.alias("orphan_records"))

    u_count = users.select(T.parsed_count(users)).scalar()
    o_count = orders.select(T.parsed_count(orders)).scalar()
    orphan_count = orphans.select(F.count(F.lit(1))).scalar()
    return row("users", u_count, F.lit(0).cast("long")).unionByName(row("orders", o_count, orphan_count))


@query("verify_ranges", oracle="""
SELECT count(*) AS lines, count(*) FILTER (o_orderkey % 500 = 1) AS altered_lines, CAST(0 AS BIGINT) AS missed_ranges,
       CAST(0 AS BIGINT) AS wrongly_reported FROM orders""")
def q_verify_ranges(spark, sf_dir):
    """Landed lines of which some had one byte altered. Every range with
    such a line is reported, and no other."""
    size = 4_096
    o = stored(Tables(spark, sf_dir).orders.select("o_orderkey", F.concat_ws(",", "o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate").alias("line")), "orders-lines")
    source, landed = scratch_path(spark, "ranges-source"), scratch_path(spark, "ranges-landed")
    o.select("line").write.text(source)
    altered = F.concat(F.expr("substring(line, 1, length(line) - 1)"), F.lit("#"))
    o.select(F.when(F.col("o_orderkey") % 500 == 1, altered).otherwise(F.col("line")).alias("line")).write.text(landed)
    name = r"(part-[0-9]+)"
    left = RG.line_places(spark, source, size, name, also={"chosen": F.split_part("value", F.lit(","), F.lit(1)).cast("bigint") % 500 == 1})
    found = RG.compared_ranges(RG.range_digests(left), RG.range_digests(RG.line_places(spark, landed, size, name)), size)
    held = left.groupBy("file", "range").agg(F.count_if("chosen").alias("chosen"))
    both = found.join(held, ["file", "range"], "left")
    reported, touched = F.col("status") != "equal", F.coalesce(F.col("chosen") > 0, F.lit(False))
    return both.agg(F.sum("lines").alias("lines"), F.sum("chosen").alias("altered_lines"),
                    F.count_if(touched & ~reported).alias("missed_ranges"), F.count_if(reported & ~touched).alias("wrongly_reported"))


# ---------------------------------------------------------------- typed from text


@query("cast_text_columns", oracle="""
WITH t AS (
  SELECT o_orderkey AS k,
    CASE WHEN o_orderkey % 11 = 0 THEN 'x' || o_orderkey ELSE ' ' || o_orderkey || ' ' END AS key_text,
    CASE WHEN o_orderkey % 13 = 0 THEN '1996-02-31' ELSE strftime(o_orderdate, '%Y-%m-%d') END AS day_text,
    CASE WHEN o_orderkey % 17 = 0 THEN 'yesterday' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') || '+02:00' END AS at_text,
    CASE WHEN o_orderkey % 7 = 0 THEN md5(CAST(o_orderkey AS VARCHAR))
         ELSE regexp_replace(md5(CAST(o_orderkey AS VARCHAR)), '^(.{8})(.{4})(.{4})(.{4})', '\\1-\\2-\\3-\\4-') END AS id_text
  FROM orders)
SELECT k, TRY_CAST(trim(key_text) AS BIGINT) AS key, TRY_CAST(day_text AS DATE) AS day,
  TRY_CAST(at_text AS TIMESTAMPTZ) AT TIME ZONE 'UTC' AS at,
  len(string_split(id_text, '-')) = 5 AS is_uuid FROM t""")
def q_cast_text_columns(spark, sf_dir):
    """Text to bigint, date, offset timestamp and UUID shape, bad values included."""
    k = F.col("o_orderkey")
    digest = F.md5(k.cast("string"))
    text = Tables(spark, sf_dir).orders.select(
        k.alias("k"),
        F.when(k % 11 == 0, F.concat(F.lit("x"), k)).otherwise(F.concat(F.lit(" "), k, F.lit(" "))).alias("key"),
        F.when(k % 13 == 0, "1996-02-31").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("day"),
        F.when(k % 17 == 0, "yesterday").otherwise(F.concat(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00"))).alias("at"),
        F.when(k % 7 == 0, digest).otherwise(F.regexp_replace(digest, "^(.{8})(.{4})(.{4})(.{4})", "$1-$2-$3-$4-")).alias("id"))
    return text.select("k", C.try_long("key").alias("key"), C.try_day("day").alias("day"), C.try_instant("at").alias("at"),
                       C.is_uuid("id").alias("is_uuid"))


@query("silver_from_bronze_csv", oracle="SELECT * FROM stg_orders WHERE order_id % 29 <> 0", views=("stg_orders",))
def q_silver_from_bronze_csv(spark, sf_dir):
    """M6: silver orders from landed text: CSV with string columns, padded
    texts and offset timestamps; rows whose quantity is no number are
    quarantined, the rest is cast and deduplicated."""
    v = Views(spark, sf_dir)
    path = scratch_path(spark, "bronze-text")
    names = v.bronze_orders.columns
    text = v.bronze_orders.select(*[F.col(c).cast("string").alias(c) for c in names if c not in ("date", "quantity")], 
        F.concat(F.date_format(F.col("date") + F.expr("INTERVAL 2 HOURS"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")).alias("date"),
        F.when(F.col("uuid") % 29 == 0, "many").otherwise(F.concat(F.lit(" "), F.col("quantity"))).alias("quantity"))
    T.write_csv(text, path)
    landed = T.read_csv_typed(spark, path, T.string_schema(text.columns), multiline=False)
    casts = {"uuid": C.try_long("uuid"), "user_uuid": C.try_long("user_uuid"), "date": C.try_instant("date"),
             "quantity": C.try_int("quantity"), "l_partkey": C.try_long("l_partkey"), "l_suppkey": C.try_long("l_suppkey"),
             "l_extendedprice": C.try_double("l_extendedprice")}
    good, _bad = C.cast_columns(landed, casts)
    return silver.stg_orders(good)


@query("silver_users_from_bronze_csv", oracle="SELECT * FROM stg_users WHERE user_id % 31 <> 0", views=("stg_users",))
def q_silver_users_from_bronze_csv(spark, sf_dir):
    """M6: silver users from landed text: CSV with two-line addresses, padded
    keys and dates as text; rows whose birthdate is no date are quarantined,
    the rest is cast and joined to the silver orders."""
    v = Views(spark, sf_dir)
    text = v.bronze_users.select(
        F.concat(F.lit(" "), F.col("uuid")).alias("uuid"), "username", "name", "sex", "address", "mail",
        F.when(F.col("uuid") % 31 == 0, "1990-02-30").otherwise(F.col("birthdate").cast("string")).alias("birthdate"))
    path = scratch_path(spark, "bronze-users-text")
    T.write_csv(text, path)
    landed = CS.read_csv_split(spark, path, T.string_schema(text.columns))
    good, _bad = C.cast_columns(landed, {"uuid": C.try_long("uuid"), "birthdate": C.try_day("birthdate")})
    return silver.stg_users(good, v.stg_orders)


@query("quarantined_text_rows", oracle="SELECT CAST(uuid AS VARCHAR) AS uuid, 'many' AS quantity FROM bronze_orders WHERE uuid % 29 = 0",
       views=("bronze_orders",))
def q_quarantined_text_rows(spark, sf_dir):
    """Q11: the rows that a cast refuses, stored as they came and read back."""
    orders = Views(spark, sf_dir).bronze_orders.select(
        F.col("uuid").cast("string").alias("uuid"),
        F.when(F.col("uuid") % 29 == 0, "many").otherwise(F.col("quantity").cast("string")).alias("quantity"))
    _good, bad = C.cast_columns(orders, {"uuid": C.try_long("uuid"), "quantity": C.try_int("quantity")})
    return stored(bad, "quarantine")


# ---------------------------------------------------------------- bucketed tables

BUCKETS = 16


@query("bucketed_dedupe", oracle="SELECT * FROM stg_orders", views=("stg_orders",))
def q_bucketed_dedupe(spark, sf_dir):
    """W1/M1 on bronze orders bucketed by their id: no exchange above the table."""
    orders = BK.write_bucketed(Views(spark, sf_dir).bronze_orders, "uuid", BUCKETS, "bronze-orders")
    return silver.typed_orders(orders.by_key(lambda part: latest_per_key(part, ["uuid"], silver.ORDER_TIES)))


@query("bucketed_dedupe_join", oracle="""
SELECT user_id, order_id, ordered_at, quantity, product, username, birthdate FROM stg_orders JOIN stg_users USING (user_id)""",
       views=("stg_users",))
def q_bucketed_dedupe_join(spark, sf_dir):
    """Deduplicated orders and users, both bucketed by user: no exchange below the join."""
    v = Views(spark, sf_dir)
    bronze = BK.write_bucketed(v.bronze_orders, "uuid", BUCKETS, "bronze-orders")
    latest = silver.typed_orders(bronze.by_key(lambda part: latest_per_key(part, ["uuid"], silver.ORDER_TIES)))
    orders = BK.write_bucketed(latest, "user_id", BUCKETS, "orders-by-user")
    users = BK.write_bucketed(silver.stg_users(v.bronze_users, orders.rows()).select("user_id", "username", "birthdate"), "user_id", BUCKETS, "users")
    return BK.join_bucketed(orders, users).select("user_id", "order_id", "ordered_at", "quantity", "product", "username", "birthdate")
