"""Batch queries: projections, filters, joins, aggregates, windows, top-k."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from orderloom.catalogue import fixture
from orderloom.catalogue.fixture import BRONZE_SQL, DIMS_CTE, EVENTS_CTE, LIFECYCLE_SQL, SILVER_SQL
from orderloom.catalogue.registry import doubles, mean_of_cents, money, query, sum_of_cents, table
from orderloom.functions.payload import as_message
from orderloom.operators.joins import lookup, missing_keys, shuffle_join
from orderloom.operators.quality import profile
from orderloom.operators.rows import one_per_key, present, top
from orderloom.operators.running import running_orders
from orderloom.plans import sales, silver
from orderloom.plans.medallion import written_counts
from orderloom.session import work_area
from orderloom.sources.files import dimension, first_existing, json_directory
from orderloom.sources.messages import EVENT_MESSAGE, as_text, replay
from orderloom.sources.synthetic import click_events, sale_events


def orders(spark, sf_dir):
    """Orders in the shape of the sales queries, with exact amounts."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        money("o_totalprice").alias("amount"),
        F.to_date("o_orderdate").alias("order_date"),
    )


# --- projections and filters -------------------------------------------------


@query("P1", "SELECT p_name AS name, p_brand AS category, p_retailprice AS price FROM part")
def product_columns(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        F.col("p_name").alias("name"),
        F.col("p_brand").alias("category"),
        F.col("p_retailprice").alias("price"),
    )


@query(
    "P2 F16",
    """SELECT p_partkey, p_retailprice, p_retailprice * 1.1::DOUBLE AS price_with_tax,
         p_retailprice * 2 AS price_doubled FROM part""",
)
def price_with_tax(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_retailprice")
    taxed = sales.taxed(parts, "p_retailprice", 0.10, "price_with_tax")
    return taxed.withColumn("price_doubled", F.col("p_retailprice") * 2)


@query(
    "P3",
    """SELECT l_orderkey, l_linenumber, l_extendedprice * l_quantity AS revenue FROM lineitem""",
)
def line_revenue(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        "l_orderkey", "l_linenumber", (F.col("l_extendedprice") * F.col("l_quantity")).alias("revenue")
    )


@query("P13", "SELECT * FROM part WHERE p_type = 'ECONOMY'")
def category_filter(spark, sf_dir):
    return table(spark, sf_dir, "part").where(F.col("p_type") == "ECONOMY")


@query("P14", "SELECT p_name AS name, p_retailprice AS price FROM part WHERE p_retailprice > 950")
def price_filter(spark, sf_dir):
    parts = table(spark, sf_dir, "part").where(F.col("p_retailprice") > 950)
    return parts.select(F.col("p_name").alias("name"), F.col("p_retailprice").alias("price"))


@query("P15", "SELECT * FROM orders WHERE o_orderstatus = 'O' AND o_totalprice > 100000")
def conjunction_filter(spark, sf_dir):
    return table(spark, sf_dir, "orders").where(
        (F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 100000)
    )


@query("P16", "SELECT * FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')")
def membership_filter(spark, sf_dir):
    return table(spark, sf_dir, "orders").where(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))


@query(
    "P18",
    """SELECT o_orderkey, o_orderpriority, o_totalprice, o_totalprice * 1.1::DOUBLE AS amount_with_tax
       FROM orders WHERE o_totalprice > 50000""",
)
def narrow_chain(spark, sf_dir):
    """Filter, compute, select: one stage without a shuffle."""
    large = table(spark, sf_dir, "orders").where(F.col("o_totalprice") > 50000)
    taxed = sales.taxed(large, "o_totalprice", 0.1, "amount_with_tax")
    return taxed.select("o_orderkey", "o_orderpriority", "o_totalprice", "amount_with_tax")


@query(
    "P11 P12",
    f"""WITH {EVENTS_CTE} SELECT event_id, order_id, location_id FROM bronze
        WHERE event_id IS NOT NULL AND order_id IS NOT NULL AND location_id IS NOT NULL""",
)
def complete_events(spark, sf_dir):
    events = fixture.event_log(spark, sf_dir).select("event_id", "order_id", "location_id")
    return present(events, "event_id", "order_id", "location_id")


MESSAGE_SQL = """json_object('event_id', event_id, 'event_type', event_type, 'ts', ts,
    'ts_seconds', ts_seconds, 'location_id', location_id, 'order_id', order_id,
    'sequence', sequence, 'body', body)"""

@query(
    "P19",
    f"""WITH {EVENTS_CTE} SELECT order_id AS key, CAST({MESSAGE_SQL} AS VARCHAR) AS value FROM bronze
        WHERE ts_seconds >= (SELECT min(ts_seconds) FROM bronze) + 1500 * 86400""",
)
def replay_messages(spark, sf_dir):
    """The log from day 1500 on, as keyed JSON messages."""
    return replay(fixture.event_log(spark, sf_dir), start_day=1500)


@query(
    "S10 P9",
    f"""WITH {EVENTS_CTE} SELECT order_id AS key, CAST({MESSAGE_SQL} AS VARCHAR) AS value FROM bronze""",
)
def raw_messages(spark, sf_dir):
    """Messages as a topic holds them, in binary, read back as text."""
    messages = as_message(fixture.event_log(spark, sf_dir), F.col("order_id"), EVENT_MESSAGE)
    binary = messages.select(*(F.col(c).cast("binary").alias(c) for c in messages.columns))
    return as_text(binary)


@query(
    "S12 P17 F14 F16",
    """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'click' ELSE 'view' END AS event_type,
         event_id % 10 + 1 AS user_id, event_id * 10 AS event_value, ts AS timestamp FROM events""",
)
def synthetic_clicks(spark, sf_dir):
    ticks = table(spark, sf_dir, "events").selectExpr("ts AS timestamp", "event_id AS value")
    return click_events(ticks)


@query(
    "S12",
    """SELECT 'RATE-' || CAST(event_id AS VARCHAR) AS order_id, 'CUST-' || CAST(event_id % 10 + 100 AS VARCHAR) AS customer_id,
         CAST(event_id % 3 + 1 AS INTEGER) AS quantity, ts AS event_timestamp,
         round(99.99::DOUBLE * (event_id % 3 + 1), 2) AS total FROM events""",
)
def synthetic_sales(spark, sf_dir):
    """Order-shaped rows over ticks, without their random id."""
    ticks = table(spark, sf_dir, "events").selectExpr("ts AS timestamp", "event_id AS value")
    sold = sale_events(ticks).select("order_id", "customer_id", "quantity", "event_timestamp", "total")
    return sold.withColumn("total", F.round("total", 2))


# --- sources ------------------------------------------------------------------


@query("S2 K7", "SELECT c_mktsegment, count(*) AS customers FROM customer GROUP BY c_mktsegment")
def dimension_view(spark, sf_dir):
    view = f"loom_customer_{uuid.uuid4().hex[:8]}"
    dimension(spark, f"{sf_dir}/customer.parquet", view=view)
    return spark.sql(f"SELECT c_mktsegment, count(*) AS customers FROM {view} GROUP BY 1")


@query("S5", "SELECT event_type, count(*) AS events FROM events GROUP BY event_type")
def sample_or_full(spark, sf_dir):
    """No one-day sample lies there, so the full table is read."""
    found = first_existing(spark, [f"{sf_dir}/events_1d.parquet", f"{sf_dir}/events.parquet"])
    return found.groupBy("event_type").agg(F.count("*").alias("events"))


@query("S5", "SELECT event_type, count(*) AS events FROM events WHERE ts < TIMESTAMP '2024-01-02' GROUP BY event_type")
def sample_first(spark, sf_dir):
    """A one-day sample lies there and is preferred to the full table."""
    sample = f"{work_area(spark, 'sample')}/events_1d.parquet"
    table(spark, sf_dir, "events").where("ts < TIMESTAMP_NTZ'2024-01-02'").write.parquet(sample)
    found = first_existing(spark, [sample, f"{sf_dir}/events.parquet"])
    return found.groupBy("event_type").agg(F.count("*").alias("events"))


@query(
    "S14 A19 A23 F8",
    f"""SELECT date_trunc('day', o_orderdate)::TIMESTAMP AS date, count(*) AS order_count,
          {sum_of_cents("o_totalprice")} AS revenue, {mean_of_cents("o_totalprice")} AS avg_order_value
        FROM orders GROUP BY 1""",
)
def daily_sales_from_json(spark, sf_dir):
    """Orders stored as JSON with a third of them twice; copies removed by key, then by day."""
    source = table(spark, sf_dir, "orders").selectExpr(
        "concat('O', o_orderkey) AS order_id",
        "o_totalprice AS total",
        "date_format(o_orderdate, 'yyyy-MM-dd HH:mm:ss') AS created_at",
        "explode(CASE WHEN o_orderkey % 3 = 0 THEN array(0, 1) ELSE array(0) END) AS copy",
    )
    folder = work_area(spark, "raw-orders")
    source.write.json(folder)
    raw = json_directory(spark, folder, "order_id string, total double, created_at string")
    clean = one_per_key(raw.where(F.col("order_id").isNotNull()), ["order_id"]).select(
        "order_id",
        F.col("total").cast("decimal(10,2)").alias("total"),
        F.to_timestamp("created_at").alias("created_at"),
    )
    return doubles(sales.daily_sales(clean, "created_at", "total"), "revenue", "avg_order_value")


# --- joins ----------------------------------------------------------------------


JOIN_SQL = """SELECT o_orderkey AS order_id, o_totalprice AS amount, c_name AS name,
  c_mktsegment AS segment FROM orders JOIN customer ON c_custkey = o_custkey"""


def _order_amounts(spark, sf_dir):
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id", "o_custkey AS customer_id", "o_totalprice AS amount"
    )


def _customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS customer_id", "c_name AS name", "c_mktsegment AS segment"
    )


@query("J4 P8", JOIN_SQL)
def join_by_shuffle(spark, sf_dir):
    joined = shuffle_join(_order_amounts(spark, sf_dir), _customers(spark, sf_dir), "customer_id")
    return joined.drop("customer_id")


@query("J5", JOIN_SQL)
def join_by_broadcast(spark, sf_dir):
    joined = lookup(
        _order_amounts(spark, sf_dir), _customers(spark, sf_dir), "customer_id", how="inner"
    )
    return joined.drop("customer_id")


@query(
    "J1",
    """SELECT c_custkey, c_name, n_name AS nation FROM customer
       LEFT JOIN nation ON n_nationkey = c_nationkey AND n_regionkey <> 4""",
)
def join_left_lookup(spark, sf_dir):
    """Customers of nations the dimension lacks keep a NULL nation."""
    known = table(spark, sf_dir, "nation").where("n_regionkey <> 4")
    facts = table(spark, sf_dir, "customer").select(
        "c_custkey", "c_name", F.col("c_nationkey").alias("n_nationkey")
    )
    joined = lookup(facts, known.select("n_nationkey", F.col("n_name").alias("nation")), "n_nationkey")
    return joined.drop("n_nationkey")


@query(
    "J3",
    """SELECT s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
)
def join_inner_renamed(spark, sf_dir):
    suppliers = table(spark, sf_dir, "supplier")
    nations = table(spark, sf_dir, "nation")
    joined = lookup(suppliers, nations, F.col("s_nationkey") == F.col("n_nationkey"), how="inner")
    return joined.select("s_suppkey", "s_name", "n_name")


@query(
    "J6",
    f"""WITH {EVENTS_CTE}, {DIMS_CTE} SELECT DISTINCT location_id FROM bronze
        WHERE location_id IS NOT NULL AND location_id NOT IN (SELECT id FROM locations WHERE city <> 'MIDDLE EAST')""",
)
def orphan_locations(spark, sf_dir):
    """Locations the events use and a shortened dimension lacks."""
    known = fixture.locations(spark, sf_dir).where("city <> 'MIDDLE EAST'")
    return missing_keys(fixture.event_log(spark, sf_dir), "location_id", known, "id")


# --- aggregates -----------------------------------------------------------------


@query(
    "A8",
    f"""SELECT o_custkey AS customer_id, count(*) AS order_count,
          {sum_of_cents("o_totalprice")} AS total_spent, {mean_of_cents("o_totalprice")} AS avg_order
        FROM orders GROUP BY o_custkey""",
)
def customer_spending(spark, sf_dir):
    spent = sales.customer_spending(orders(spark, sf_dir), "customer_id", "amount")
    return doubles(spent, "total_spent", "avg_order")


@query(
    "A9",
    f"""SELECT l_partkey AS product, count(*) AS times_ordered,
          {sum_of_cents("l_extendedprice")} AS total_revenue FROM lineitem GROUP BY l_partkey""",
)
def product_revenue(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("product"), money("l_extendedprice").alias("amount")
    )
    return doubles(sales.product_revenue(lines, "product", "amount"), "total_revenue")


@query(
    "A10",
    f"""SELECT CAST(o_orderdate AS DATE) AS order_date, count(*) AS orders,
          {sum_of_cents("o_totalprice")} AS daily_revenue FROM orders GROUP BY 1""",
)
def daily_revenue(spark, sf_dir):
    return doubles(sales.daily_revenue(orders(spark, sf_dir), "order_date", "amount"), "daily_revenue")


@query(
    "A15",
    f"""SELECT count(*) AS total_orders, {sum_of_cents("o_totalprice")} AS total_amount,
          {mean_of_cents("o_totalprice")} AS avg_amount FROM orders""",
)
def order_totals(spark, sf_dir):
    return doubles(sales.totals(orders(spark, sf_dir), "amount"), "total_amount", "avg_amount")


@query(
    "A16",
    f"SELECT {sum_of_cents('value')} AS total FROM events WHERE event_type = 'purchase'",
)
def purchase_total(spark, sf_dir):
    bought = table(spark, sf_dir, "events").where("event_type = 'purchase'")
    return doubles(bought.agg(F.sum(money("value")).alias("total")), "total")


@query(
    "A18",
    f"""SELECT min(o_totalprice) AS lowest, max(o_totalprice) AS highest,
          {mean_of_cents("o_totalprice")} AS mean FROM orders""",
)
def order_value_range(spark, sf_dir):
    amounts = sales.value_range(orders(spark, sf_dir), "amount")
    return doubles(amounts, "lowest", "highest", "mean")


@query("A22", "SELECT DISTINCT user_id, event_type FROM events")
def distinct_actions(spark, sf_dir):
    return table(spark, sf_dir, "events").select("user_id", "event_type").distinct()


@query("A22", "SELECT count(*) AS n, count(DISTINCT event_id) AS event_ids FROM events")
def distinct_count(spark, sf_dir):
    return table(spark, sf_dir, "events").agg(
        F.count("*").alias("n"), F.countDistinct("event_id").alias("event_ids")
    )


@query(
    "A23",
    f"""WITH {EVENTS_CTE} SELECT event_id, event_type, ts, location_id, order_id FROM bronze
        QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY ts_seconds, ts, event_type, location_id NULLS FIRST, order_id NULLS FIRST) = 1""",
)
def deduplicated_events(spark, sf_dir):
    """The first copy of every event."""
    events = fixture.event_log(spark, sf_dir).select(
        "event_id", "event_type", "ts", "ts_seconds", "location_id", "order_id"
    )
    first = ["ts_seconds", "ts", "event_type", "location_id", "order_id"]  # copies of one second may differ elsewhere
    return one_per_key(events, ["event_id"], first_by=first).drop("ts_seconds")


# --- windows, sorting, top-k ---------------------------------------------------


@query(
    "W1 W2",
    """SELECT o_custkey AS customer_id, CAST(o_orderdate AS DATE) AS order_date,
         o_orderkey AS order_id, o_totalprice AS amount,
         CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) OVER (
           PARTITION BY o_custkey ORDER BY o_orderdate) AS BIGINT) / 100.0::DOUBLE AS running_total,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS order_rank
       FROM orders""",
)
def running_total(spark, sf_dir):
    ranked = running_orders(
        orders(spark, sf_dir), key="customer_id", day="order_date", unique_id="order_id", amount="amount"
    )
    return doubles(ranked, "running_total", "amount")


@query("O1", "SELECT o_custkey, o_orderdate, o_orderkey FROM orders")
def sorted_orders(spark, sf_dir):
    """The order key as last sort column lets a hot customer span several ranges."""
    wanted = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_orderkey")
    return wanted.orderBy("o_custkey", "o_orderdate", "o_orderkey")


@query(
    "O3",
    "SELECT event_id, event_type, value, ts FROM events ORDER BY ts DESC, event_id LIMIT 5",
)
def latest_events(spark, sf_dir):
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value", "ts")
    return top(events, 5, "ts", "event_id")


@query(
    "O4 O2",
    f"""SELECT l_suppkey, {sum_of_cents("l_extendedprice")} AS total_revenue FROM lineitem
        GROUP BY l_suppkey ORDER BY total_revenue DESC, l_suppkey LIMIT 10""",
)
def top_suppliers(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", money("l_extendedprice").alias("amount"))
    revenue = lines.groupBy("l_suppkey").agg(F.sum("amount").alias("total_revenue"))
    return doubles(top(revenue, 10, "total_revenue", "l_suppkey"), "total_revenue")


@query(
    "O5",
    """SELECT DISTINCT o_orderkey AS order_id FROM orders ORDER BY order_id LIMIT 100""",
)
def distinct_sample(spark, sf_dir):
    """A hundred different ids; the smallest, so that the sample can be repeated."""
    ids = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("order_id"))
    return ids.distinct().orderBy("order_id").limit(100)


# --- set operations --------------------------------------------------------------


@query(
    "U1",
    f"""{LIFECYCLE_SQL} SELECT 'bronze.orders' AS table_name, count(*) AS row_count FROM bronze
        UNION ALL SELECT 'silver.orders_enriched', count(*) FROM enriched
        UNION ALL SELECT 'silver.order_lifecycle', count(*) FROM lifecycle""",
)
def layer_counts(spark, sf_dir):
    """Each layer is stored, and counted as it is written; the counts of the layers, one below the other."""
    counts = []

    def stored(name, df):
        folder, seen = work_area(spark, name), Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(folder)
        counts.append(written_counts(spark, {name: seen.get["rows"]}))
        return spark.read.parquet(folder)

    bronze = stored("bronze.orders", fixture.bronze(spark, sf_dir))
    silver_rows = stored("silver.orders_enriched", silver.enrich(bronze, fixture.locations(spark, sf_dir), "decimal(12,2)"))
    stored("silver.order_lifecycle", silver.lifecycle(silver_rows))
    return reduce(DataFrame.unionByName, counts)


@query(
    "A14 P12",
    f"""{SILVER_SQL} SELECT order_id, event_timestamp AS order_timestamp, event_date AS order_date,
          event_hour AS order_hour FROM enriched WHERE event_type = 'order_created'""",
)
def created_times(spark, sf_dir):
    """The SQL form of the calendar columns, over a view."""
    view = f"loom_log_{uuid.uuid4().hex[:8]}"
    fixture.event_log(spark, sf_dir).createOrReplaceTempView(view)
    return spark.sql(
        f"""SELECT order_id, moment AS order_timestamp, date(moment) AS order_date,
                  hour(moment) AS order_hour
           FROM (SELECT order_id, to_timestamp(ts) AS moment FROM {view}
                 WHERE order_id IS NOT NULL AND event_type = 'order_created')"""
    )


@query(
    "A21",
    f"""{BRONZE_SQL}, orders_seen AS (SELECT DISTINCT order_id FROM bronze)
        SELECT 'all' AS section, NULL::VARCHAR AS item, count(*) AS events,
          (SELECT count(*) FROM orders_seen) AS orders, min(ts) AS first_ts, max(ts) AS last_ts FROM bronze
        UNION ALL SELECT 'event_type', event_type, count(*), NULL, min(ts), max(ts) FROM bronze GROUP BY event_type
        UNION ALL SELECT 'location', CAST(location_id AS VARCHAR), count(*), NULL, min(ts), max(ts)
        FROM bronze WHERE location_id IS NOT NULL GROUP BY location_id""",
)
def dataset_profile(spark, sf_dir):
    return profile(fixture.event_log(spark, sf_dir))
