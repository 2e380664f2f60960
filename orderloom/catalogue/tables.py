"""Table queries: writes, row-level changes, versions, statistics, maintenance.

Every table lies in the shared folder, under a schema or root of its own run.
"""

from __future__ import annotations

import uuid
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.catalogue.registry import doubles, mean_of_cents, money, query, sum_of_cents, table
from orderloom.operators.joins import lookup
from orderloom.operators.quality import reconcile_written
from orderloom.operators import changes
from orderloom.operators.changes import change
from orderloom.operators.rows import add_columns, drop_where, set_where
from orderloom.plans import layers_sql
from orderloom.session import work_area
from orderloom.tables import ddl, maintenance

DAYS = [datetime(2024, 3, d) for d in range(1, 13)]


def _schema(spark) -> str:
    name = f"loom_{uuid.uuid4().hex[:12]}"
    ddl.create_schema(spark, name, work_area(spark, "schema"))
    return name


COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority"]
EARLY = "(o_orderdate < TIMESTAMP '1998-05-01')"


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(*COLUMNS)


# --- writes ------------------------------------------------------------------


def _sale_rows(spark, sf_dir):
    """Order lines as sale events."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", F.col("l_quantity").cast("int").alias("quantity"),
        money("l_extendedprice").alias("total"),
    )
    placed = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    joined = lines.join(placed, F.col("l_orderkey") == F.col("o_orderkey"))
    named = lookup(joined, parts, F.col("l_partkey") == F.col("p_partkey"), how="inner")
    return named.select(
        F.col("l_orderkey").cast("string").alias("order_id"),
        F.col("o_custkey").cast("string").alias("customer_id"),
        F.col("l_partkey").cast("string").alias("product_id"),
        F.col("p_name").alias("product_name"),
        "quantity",
        (F.col("total") / F.col("quantity")).cast("double").alias("unit_price"),
        "total",
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
        F.current_timestamp().alias("ingested_at"),
    )


def _sale_layers(spark, sf_dir, gold: bool = True):
    """Bronze, silver and, where asked for, gold tables of the order lines."""
    schema = _schema(spark)
    names = [f"{schema}.{layer}" for layer in ("bronze_sales", "silver_sales", "gold_customers")]
    ddl.replace(_sale_rows(spark, sf_dir), names[0])
    layers = [spark.table(names[0]), layers_sql.silver_sales(spark, names[0], names[1])]
    return [*layers, layers_sql.gold_customers(spark, names[1], names[2])] if gold else layers


SALES_SQL = """WITH sales AS (
  SELECT l_orderkey, l_partkey, l_extendedprice, o_custkey, o_orderdate
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey)"""


@query(
    "A14 K1 K4 F4 F5",
    f"""{SALES_SQL} SELECT CAST(o_orderdate AS DATE) AS order_date, CAST(hour(o_orderdate) AS INTEGER) AS order_hour,
          count(*) AS lines, count(DISTINCT l_orderkey) AS orders FROM sales GROUP BY 1, 2""",
)
def silver_sales(spark, sf_dir):
    _, silver = _sale_layers(spark, sf_dir, gold=False)
    return silver.groupBy("order_date", "order_hour").agg(
        F.count("processed_at").alias("lines"), F.countDistinct("order_id").alias("orders")
    )


@query(
    "A13 K4 O4",
    f"""{SALES_SQL} SELECT CAST(o_custkey AS VARCHAR) AS customer_id, count(*) AS total_orders,
          {sum_of_cents("l_extendedprice")} AS total_revenue, {mean_of_cents("l_extendedprice")} AS avg_order_value,
          count(DISTINCT l_partkey) AS unique_products, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order
        FROM sales GROUP BY o_custkey""",
)
def gold_customers(spark, sf_dir):
    _, _, gold = _sale_layers(spark, sf_dir)
    ranked = gold.drop("aggregated_at").orderBy(F.desc("total_revenue"))
    return doubles(ranked, "total_revenue", "avg_order_value")


@query(
    "Q7 K13",
    f"""{SALES_SQL}, per_customer AS (SELECT CAST(sum(CAST(round(l_extendedprice * 100) AS BIGINT)) AS BIGINT) AS cents FROM sales GROUP BY o_custkey)
        SELECT count(*) AS bronze_rows, count(l_orderkey) AS silver_rows,
          {sum_of_cents("l_extendedprice")} AS bronze_total, {sum_of_cents("l_extendedprice")} AS silver_total,
          (SELECT CAST(sum(cents) AS BIGINT) / 100.0::DOUBLE FROM per_customer) AS gold_total, count(*) = count(l_orderkey) AS counts_match,
          abs({sum_of_cents("l_extendedprice")} - (SELECT CAST(sum(cents) AS BIGINT) / 100.0::DOUBLE FROM per_customer)) < 0.01 AS totals_match FROM sales""",
)
def sales_reconciliation(spark, sf_dir):
    """The three layers against each other, by what their writes counted and summed."""
    schema, rows = _schema(spark), F.count(F.lit(1))
    names = [f"{schema}.{layer}" for layer in ("bronze_sales", "silver_sales", "gold_customers")]
    bronze = ddl.replace_measured(_sale_rows(spark, sf_dir), names[0], rows=rows, total=F.sum("total"))
    _, silver = layers_sql.silver_sales(spark, names[0], names[1], {"rows": rows, "total": F.sum("total")})
    _, gold = layers_sql.gold_customers(spark, names[1], names[2], {"rows": rows, "total": F.sum("total_revenue")})
    return reconcile_written(spark, bronze, silver, gold)


BUCKETS = 32  # for the given tables; a large one takes as many as it has files of its own


@query(
    "J4 A13",
    f"""{SALES_SQL} SELECT o_custkey AS customer_id, count(*) AS lines, count(DISTINCT l_orderkey) AS orders,
          {sum_of_cents("l_extendedprice")} AS total_revenue FROM sales GROUP BY o_custkey""",
)
def customers_of_bucketed_tables(spark, sf_dir):
    """Lines and orders that lie by the order's key join without a shuffle."""
    joined = _bucketed_sales(spark, sf_dir)
    found = joined.groupBy(F.col("o_custkey").alias("customer_id")).agg(
        F.count("*").alias("lines"), F.countDistinct("l_orderkey").alias("orders"), F.sum("total").alias("total_revenue")
    )
    return doubles(found, "total_revenue")


def _bucketed_sales(spark, sf_dir):
    schema = _schema(spark)
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", money("l_extendedprice").alias("total"))
    ddl.write_bucketed(lines, f"{schema}.lines", "l_orderkey", BUCKETS)
    ddl.write_bucketed(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), f"{schema}.orders", "o_orderkey", BUCKETS)
    return spark.table(f"{schema}.lines").join(spark.table(f"{schema}.orders"), F.col("l_orderkey") == F.col("o_orderkey"))


@query(
    "A12 K4",
    f"""SELECT o_custkey AS customer_id, count(*) AS total_orders, {sum_of_cents("o_totalprice")} AS total_spent,
          {mean_of_cents("o_totalprice")} AS avg_order_value, min(CAST(o_orderdate AS DATE)) AS first_order,
          max(CAST(o_orderdate AS DATE)) AS last_order FROM orders GROUP BY o_custkey""",
)
def customer_summary(spark, sf_dir):
    schema = _schema(spark)
    placed = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_totalprice").cast("decimal(10,2)").alias("total"),
        F.to_date("o_orderdate").alias("order_date"),
    )
    ddl.replace(placed, f"{schema}.orders")
    summary = layers_sql.customer_summary(spark, f"{schema}.orders", f"{schema}.customer_summary")
    return doubles(summary, "total_spent", "avg_order_value")


@query(
    "K6 A15 D3",
    f"""SELECT count(*) AS total_orders, {sum_of_cents("value")} AS total_amount
        FROM events WHERE event_type = 'purchase'""",
)
def raw_to_gold(spark, sf_dir):
    """Raw JSON rows to orders to one row of totals, each step an INSERT."""
    schema = _schema(spark)
    raw, silver, gold = (f"{schema}.{n}" for n in ("raw_events", "orders", "order_summary"))
    ddl.replace(
        table(spark, sf_dir, "events").select(
            F.col("event_id").cast("string").alias("event_id"),
            F.when(F.col("event_type") == "purchase", "order").otherwise("click").alias("event_type"),
            F.to_json(F.struct(F.concat(F.lit("o"), F.col("event_id").cast("string")).alias("order_id"),
                               F.col("value").alias("amount"))).alias("raw_data"),
        ),
        raw,
    )
    ddl.create_table(spark, silver, "order_id string, amount double, processed_at timestamp")
    ddl.create_table(
        spark, gold, "total_orders bigint, total_amount double, avg_amount double, computed_at timestamp"
    )
    layers_sql.insert_orders_from_raw(spark, raw, silver)
    layers_sql.insert_order_totals(spark, silver, gold)
    return spark.table(gold).select("total_orders", F.round("total_amount", 2).alias("total_amount"))


@query(
    "K2 K8 K3",
    """SELECT n_regionkey, count(*) AS customers FROM customer JOIN nation ON n_nationkey = c_nationkey
       GROUP BY n_regionkey""",
)
def appended_and_copied(spark, sf_dir):
    """Customers written by balance in two parts, the table copied, then counted."""
    schema = _schema(spark)
    customers = table(spark, sf_dir, "customer")
    ddl.replace(customers.where("c_acctbal >= 5000"), f"{schema}.customers")
    ddl.append(customers.where("c_acctbal < 5000"), f"{schema}.customers")
    copied = ddl.copy_table(spark, f"{schema}.customers", f"{schema}.customers_copy")
    regions = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    joined = lookup(copied, regions, F.col("c_nationkey") == F.col("n_nationkey"), how="inner")
    return joined.groupBy("n_regionkey").agg(F.count("*").alias("customers"))


@query(
    "D2 D3",
    """SELECT 'orders' AS table_name, count(*) AS rows, false AS missing FROM orders
       UNION ALL SELECT 'customer', count(*), false FROM customer
       UNION ALL SELECT 'returns', 0, true""",
)
def table_inventory(spark, sf_dir):
    """Tables a schema should hold, with rows; one of them was never made."""
    schema = _schema(spark)
    for name in ("orders", "customer"):
        ddl.replace(table(spark, sf_dir, name), f"{schema}.{name}")
    absent = ddl.missing_tables(spark, schema, ["orders", "customer", "returns"])
    present = [
        spark.table(f"{schema}.{n}").agg(F.count("*").alias("rows"))
        .select(F.lit(n).alias("table_name"), "rows", F.lit(False).alias("missing"))
        for n in ("orders", "customer")
    ]
    gone = absent.select(F.col("tableName").alias("table_name"), F.lit(0).cast("long").alias("rows"), F.lit(True).alias("missing"))
    return present[0].unionByName(present[1]).unionByName(gone)


@query(
    "K5 D7 D3",
    """SELECT * FROM (VALUES ('r_name', 'string', 'MANAGED'), ('r_regionkey', 'bigint', 'MANAGED')) AS c(col_name, data_type, table_type),
       (SELECT count(*) + 1 AS rows, CAST(max(r_regionkey) + 1 AS BIGINT) AS newest FROM region)""",
)
def described_table(spark, sf_dir):
    """A table of the regions, one more added by value, described, counted, dropped."""
    name = f"{_schema(spark)}.regions"
    regions = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    ddl.create_table(spark, name, "r_regionkey bigint, r_name string")
    ddl.append(regions, name)
    last = regions.agg(F.max("r_regionkey")).first()[0]
    ddl.insert_values(spark, name, f"({last + 1}, 'ELSEWHERE')")
    facts = ddl.describe(spark, name).select("col_name", "data_type").withColumn("table_type", F.lit(ddl.table_type(spark, name)))
    counted = spark.table(name).agg(F.count("*").alias("rows"), F.max("r_regionkey").alias("newest")).first()
    ddl.drop_table(spark, name)
    return facts.withColumns({c: F.lit(counted[c]).cast("bigint") for c in ("rows", "newest")})


@query("D1 D2", "SELECT count(*) AS rows, true AS listed, true AS gone FROM nation")
def schema_life(spark, sf_dir):
    """A schema is made, listed, filled and dropped with what it holds."""
    name = _schema(spark)
    ddl.replace(table(spark, sf_dir, "nation"), f"{name}.nation")
    rows = spark.table(f"{name}.nation").count()
    listed = ddl.schemas(spark).where(F.col("namespace") == name).count() == 1 and ddl.tables(spark, name).count() == 1
    ddl.drop_schema(spark, name)
    left = ddl.schemas(spark).where(F.col("namespace") == name)
    return left.agg((F.count("*") == 0).alias("gone")).select(
        F.lit(rows).cast("bigint").alias("rows"), F.lit(listed).alias("listed"), "gone"
    )


@query(
    "S16",
    "SELECT count(*) AS table_rows, count(*) AS file_rows, true AS matches FROM lineitem",
)
def storage_reconciliation(spark, sf_dir):
    name = f"{_schema(spark)}.lineitem"
    ddl.replace(table(spark, sf_dir, "lineitem"), name)
    return ddl.storage_matches(spark, name)


# --- partitioning --------------------------------------------------------------


@query(
    "D4 D15",
    "SELECT event_type, count(*) AS rows FROM events GROUP BY event_type",
)
def partitions_by_value(spark, sf_dir):
    name = f"{_schema(spark)}.events"
    ddl.write_partitioned(table(spark, sf_dir, "events"), name, ["event_type"])
    return maintenance.partition_statistics(spark.table(name), "event_type")


@query(
    "D5 D15",
    "SELECT CAST(ts AS DATE) AS day, count(*) AS rows FROM events WHERE ts >= TIMESTAMP '2024-01-10' GROUP BY 1",
)
def partitions_by_day(spark, sf_dir):
    """Days from the tenth on; the filter prunes partitions."""
    name = f"{_schema(spark)}.events"
    ddl.write_partitioned(table(spark, sf_dir, "events"), name, ddl.by_day("ts"))
    recent = spark.table(name).where(F.col("day") >= F.lit("2024-01-10").cast("date"))
    return maintenance.partition_statistics(recent, "day")


@query(
    "D6 D15",
    "SELECT strftime(ts, '%Y-%m-%d-%H') AS hour, count(*) AS rows FROM events GROUP BY 1",
)
def partitions_by_hour(spark, sf_dir):
    name = f"{_schema(spark)}.events"
    ddl.write_partitioned(table(spark, sf_dir, "events"), name, ddl.by_hour("ts"))
    return maintenance.partition_statistics(spark.table(name), "hour")


# --- row-level changes and their log --------------------------------------------


def _stored(spark, df, purpose):
    """A frame written to a folder of its own and read again."""
    folder = work_area(spark, purpose)
    df.write.parquet(folder)
    return spark.read.parquet(folder)


UPDATED_SQL = """SELECT * REPLACE (
  CASE WHEN o_orderstatus = 'O' AND o_totalprice > 200000 THEN '1-URGENT' ELSE o_orderpriority END AS o_orderpriority)
  FROM (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders)"""


@query("D9", UPDATED_SQL)
def update_where(spark, sf_dir):
    urgent = F.expr("o_orderstatus = 'O' AND o_totalprice > 200000")
    changed = set_where(_orders(spark, sf_dir), {"o_orderpriority": F.lit("1-URGENT")}, urgent)
    return _stored(spark, changed, "updated")


@query(
    "D9 P16",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'completed' ELSE 'pending' END AS status FROM orders""",
)
def update_after_evolution(spark, sf_dir):
    """A status column is added, filled for some rows, then for those still NULL."""
    orders = add_columns(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), status="string")
    orders = set_where(orders, {"status": F.lit("completed")}, F.col("o_orderstatus").isin("F"))
    orders = set_where(orders, {"status": F.lit("pending")}, F.col("status").isNull())
    return _stored(spark, orders.drop("o_orderstatus"), "evolved")


MARKED = "CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderstatus END AS o_orderstatus"


@query(
    "D10",
    f"""SELECT * FROM (SELECT o_orderkey, {MARKED} FROM orders)
        WHERE NOT coalesce(o_orderstatus = 'F', false)""",
)
def delete_where(spark, sf_dir):
    """Rows whose status is unknown are kept."""
    orders = table(spark, sf_dir, "orders").selectExpr("o_orderkey", MARKED)
    return _stored(spark, drop_where(orders, F.col("o_orderstatus") == "F"), "deleted")


def _logged(spark, log):
    """A stored log of changes."""
    folder = work_area(spark, "changes")
    changes.append_changes(log, folder)
    return changes.stored_changes(spark, folder, log.schema)


def _three_versions(spark, sf_dir):
    """The early orders, the later ones added, the open ones deleted."""
    placed = table(spark, sf_dir, "orders")
    log = [
        change(placed.where(EARLY).select(*COLUMNS), 1, "insert", DAYS[0]),
        change(placed.where(f"NOT {EARLY}").select(*COLUMNS), 2, "insert", DAYS[1]),
        change(placed.where("o_orderstatus = 'O'").select(*COLUMNS), 3, "delete", DAYS[2]),
    ]
    return _logged(spark, reduce(DataFrame.unionByName, log))


FIVE = f"SELECT {', '.join(COLUMNS)} FROM orders"
KEY = ["o_orderkey"]


@query("D11", f"{FIVE} WHERE {EARLY}")
def as_of_version(spark, sf_dir):
    return changes.as_of_version(_three_versions(spark, sf_dir), KEY, 1)


@query("D12", FIVE)
def as_of_time(spark, sf_dir):
    """Between the later orders and the deletion."""
    return changes.as_of_time(_three_versions(spark, sf_dir), KEY, datetime(2024, 3, 2, 12))


@query(
    "D13",
    f"""SELECT 1 AS version, 'insert' AS operation, TIMESTAMP '2024-03-01' AS committed_at,
         count(*) AS rows_changed FROM orders WHERE {EARLY}
       UNION ALL SELECT 2, 'insert', TIMESTAMP '2024-03-02', count(*) FROM orders WHERE NOT {EARLY}
       UNION ALL SELECT 3, 'delete', TIMESTAMP '2024-03-03', count(*) FROM orders WHERE o_orderstatus = 'O'""",
)
def version_history(spark, sf_dir):
    return changes.history(_three_versions(spark, sf_dir))


def _twelve_versions(spark, sf_dir):
    """A version a day: all orders, then eleven times some of them, in two steps of which the second is a deletion for some."""
    placed = table(spark, sf_dir, "orders").select(*COLUMNS)
    log = [change(placed, 1, "insert", DAYS[0])]
    for version in range(2, 13):
        touched = placed.where(f"o_orderkey % 12 = {version - 1} OR o_orderkey % 7 = {version - 2}")
        log.append(change(touched.withColumn("o_orderpriority", F.lit(f"v{version}")), version, "update", DAYS[version - 1], 1))
        log.append(change(touched.where("o_orderkey % 5 = 0"), version, "delete", DAYS[version - 1], 2))
    return _logged(spark, reduce(DataFrame.unionByName, log))


TWELVE_SQL = f"""log AS (
  SELECT o_orderkey AS k, 1 AS version, 'insert' AS operation, 0 AS place FROM orders
  UNION ALL SELECT o_orderkey, CAST(v AS INTEGER), 'update', 1 FROM orders, range(2, 13) t(v)
    WHERE o_orderkey % 12 = v - 1 OR o_orderkey % 7 = v - 2
  UNION ALL SELECT o_orderkey, CAST(v AS INTEGER), 'delete', 2 FROM orders, range(2, 13) t(v)
    WHERE (o_orderkey % 12 = v - 1 OR o_orderkey % 7 = v - 2) AND o_orderkey % 5 = 0
), versions AS (
  SELECT version, TIMESTAMP '2024-02-29' + to_days(version) AS committed_at FROM (SELECT DISTINCT version FROM log)
), gone AS (
  SELECT max(version) AS last FROM versions
  WHERE committed_at < TIMESTAMP '2024-03-12 12:00:00' - INTERVAL '{maintenance.KEEP_DAYS} days'
    AND version NOT IN (SELECT version FROM versions ORDER BY version DESC LIMIT {maintenance.KEEP_LAST})
), kept AS (
  SELECT min(version) AS first FROM versions, gone WHERE version > last
), ranked AS (
  SELECT log.*, row_number() OVER (PARTITION BY k ORDER BY version DESC, place DESC) AS r FROM log, kept WHERE version <= first
)"""


@query(
    "D18",
    f"""WITH {TWELVE_SQL}
        SELECT version, operation, count(*) AS rows, (SELECT first FROM kept) AS readable_from
        FROM (SELECT version, operation FROM ranked WHERE r = 1 AND operation <> 'delete'
              UNION ALL SELECT version, operation FROM log, kept WHERE version > first) GROUP BY version, operation""",
)
def expiry(spark, sf_dir):
    """Twelve versions, of which those older than a week go, but for the newest five."""
    log, now = _twelve_versions(spark, sf_dir), datetime(2024, 3, 12, 12)
    kept = changes.expire(log, KEY, now, maintenance.KEEP_DAYS, maintenance.KEEP_LAST)
    first = changes.first_kept(log, now, maintenance.KEEP_DAYS, maintenance.KEEP_LAST)
    return kept.groupBy("version", "operation").agg(F.count("*").alias("rows")).withColumn("readable_from", F.lit(first))


@query(
    "D9 D10 D11",
    f"""WITH {TWELVE_SQL}, last AS (SELECT k, version, operation,
            row_number() OVER (PARTITION BY k ORDER BY version DESC, place DESC) AS r FROM log WHERE version <= 9)
        SELECT CASE WHEN version = 1 THEN o_orderpriority ELSE 'v' || version END AS o_orderpriority, count(*) AS rows
        FROM last JOIN orders ON o_orderkey = k WHERE r = 1 AND operation <> 'delete' GROUP BY 1""",
)
def changed_twice_in_a_version(spark, sf_dir):
    """The ninth version, in which and before which orders were updated and then deleted within one version."""
    state = changes.as_of_version(_twelve_versions(spark, sf_dir), KEY, 9)
    return state.groupBy("o_orderpriority").agg(F.count("*").alias("rows"))


@query(
    "D8",
    f"SELECT o_orderkey, CASE WHEN NOT {EARLY} THEN o_totalprice END AS tip_amount FROM orders",
)
def schema_evolution(spark, sf_dir):
    """A catalog table gets a column between two inserts; the older rows read NULL."""
    name = f"{_schema(spark)}.orders"
    source = table(spark, sf_dir, "orders")
    ddl.replace(source.where(EARLY).select("o_orderkey"), name)
    ddl.add_column(spark, name, "tip_amount", "double")
    later = source.where(f"NOT {EARLY}")
    ddl.append(later.select("o_orderkey", F.col("o_totalprice").alias("tip_amount")), name)
    return spark.table(name)


# --- statistics and maintenance ---------------------------------------------------


def _many_files(spark, df, key: str, *partition_by: str) -> str:
    """A folder that six writers have appended to, each its share of the rows."""
    folder = work_area(spark, "files")
    for share in range(6):
        part = df.where(F.pmod(F.xxhash64(key), F.lit(6)) == share)
        part.write.mode("append").partitionBy(*partition_by).parquet(folder)
    return folder


@query("D14", "SELECT count(*) AS rows, count(*) AS rows_by_file, true AS sized FROM lineitem")
def file_statistics(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    files = maintenance.file_statistics(lines)
    return files.agg(
        lines.agg(F.count("*")).scalar().alias("rows"),
        F.sum("rows").alias("rows_by_file"),
        (F.min("bytes") > 0).alias("sized"),
    )


@query("D16", "SELECT l_returnflag, count(*) AS rows, true AS fewer_files FROM lineitem GROUP BY l_returnflag")
def compaction(spark, sf_dir):
    """A table partitioned by return flag."""
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_extendedprice", "l_returnflag")
    folder = _many_files(spark, lines, "l_orderkey", "l_returnflag")
    done = maintenance.compact(spark, folder, work_area(spark, "compacted"))
    counts = maintenance.partition_statistics(maintenance.compacted(spark, done), "l_returnflag")
    return counts.withColumn("fewer_files", F.lit(done.files_after < done.files_before))


@query("D17", "SELECT o_orderstatus, count(*) AS rows FROM orders GROUP BY o_orderstatus")
def compaction_on_demand(spark, sf_dir):
    """The rows and partitions stay what they were."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus")
    folder = _many_files(spark, orders, "o_orderkey", "o_orderstatus")
    done = maintenance.compact_on_demand(spark, folder, work_area(spark, "compacted"), target_size_mb=64)
    return maintenance.partition_statistics(maintenance.compacted(spark, done), "o_orderstatus")


@query(
    "D19",
    "SELECT count(*) AS orphan_rows, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS live_rows FROM orders",
)
def orphans(spark, sf_dir):
    """Files of an older version, once a newer one has taken over."""
    folder = work_area(spark, "files")
    rows = _orders(spark, sf_dir)
    rows.write.parquet(f"{folder}/old")
    rows.where("o_orderstatus = 'O'").write.parquet(f"{folder}/new")
    live = spark.read.parquet(f"{folder}/new")
    found = maintenance.orphan_files(spark, folder, live, datetime(2100, 1, 1))
    held = maintenance.file_statistics(spark.read.parquet(f"{folder}/old", f"{folder}/new"))
    counted = found.join(held, found["path"] == held["file_path"]).agg(F.sum("rows").alias("orphan_rows"))
    return counted.select("orphan_rows", live.agg(F.count("*")).scalar().alias("live_rows"))
