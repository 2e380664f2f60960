"""Data-quality checks; each returns a DataFrame of findings or measures."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def missing_columns(df: DataFrame, required: list[str]) -> list[str]:
    return [c for c in required if c not in df.columns]


def column_presence(df: DataFrame, required: list[str]) -> DataFrame:
    """Each required column: does it exist, and how many rows fill it."""
    absent = missing_columns(df, required)
    filled = df.agg(
        *(F.count(F.lit(None) if c in absent else F.col(c)).alias(c) for c in required)
    )
    tall = filled.unpivot([], required, "column_name", "filled")
    return tall.withColumn("present", ~F.col("column_name").isin(absent) if absent else F.lit(True))


def null_ratios(
    df: DataFrame, tolerances: dict[str, float], only: dict[str, Column] | None = None
) -> DataFrame:
    """Share of NULLs per column against what is tolerated, in one pass; no rows at all pass.

    `only` names, for a column, the rows it is asked of.
    """
    lacking = {c: F.col(c).isNull().cast("int") for c in tolerances}
    lacking |= {c: F.when(rows, lacking[c]) for c, rows in (only or {}).items()}
    shares = df.agg(*(F.avg(v).alias(c) for c, v in lacking.items()))
    allowed = reduce(
        lambda rest, item: rest.when(F.col("column_name") == item[0], item[1]), tolerances.items(), F
    )
    tall = shares.unpivot([], list(tolerances), "column_name", "null_ratio")
    return tall.withColumn(
        "passed", F.coalesce(F.col("null_ratio") < allowed, F.lit(True))
    )


def filter_effect(df: DataFrame, condition: Column) -> DataFrame:
    """Rows before and after a filter, in one pass."""
    return df.agg(F.count("*").alias("rows"), F.count_if(condition).alias("kept"))


def cardinalities(expected: dict[str, tuple[DataFrame, int]]) -> DataFrame:
    """Row counts of dimensions against the expected ones."""
    parts = [
        df.agg(F.count("*").alias("actual")).select(
            F.lit(name).alias("table_name"),
            F.lit(n).cast("long").alias("expected"),
            "actual",
            (F.col("actual") == n).alias("passed"),
        )
        for name, (df, n) in expected.items()
    ]
    return reduce(DataFrame.unionByName, parts)


Bounds = tuple[float | None, float | None]


def range_checks(
    df: DataFrame, bounds: dict[str, Bounds], exclusive: tuple[str, ...] = (), means: dict[str, Bounds] | None = None
) -> DataFrame:
    """Least, greatest and mean value per column and whether they keep the bounds.

    Bounds are inclusive, or exclusive for the columns named so; those on the mean are
    exclusive. One pass over the data; a column without values passes.
    """
    kinds = {"lowest": F.min, "highest": F.max, "mean": F.avg}
    row = df.agg(*(agg(F.col(c).cast("double")).alias(f"{c}:{kind}") for c in bounds for kind, agg in kinds.items()))
    structs = []
    for c, (low, high) in bounds.items():
        value = {kind: F.col(f"`{c}:{kind}`") for kind in kinds}
        kept = _between(value["lowest"], value["highest"], low, high, c in exclusive)
        kept &= _between(value["mean"], value["mean"], *(means or {}).get(c, (None, None)), True)
        structs.append(F.struct(F.lit(c).alias("column_name"), *(v.alias(k) for k, v in value.items()), kept.alias("passed")))
    return row.select(F.inline(F.array(*structs)))


def _between(least: Column, most: Column, low: float | None, high: float | None, exclusive: bool) -> Column:
    verdicts = []
    if low is not None:
        verdicts.append(least > low if exclusive else least >= low)
    if high is not None:
        verdicts.append(most < high if exclusive else most <= high)
    return F.coalesce(reduce(lambda a, b: a & b, verdicts, F.lit(True)), F.lit(True))


def blank_ids(df: DataFrame, column: str) -> DataFrame:
    """Rows whose id is NULL or empty."""
    return df.where(F.col(column).isNull() | (F.length(column) == 0))


def unknown_values(df: DataFrame, column: str, valid: list[str]) -> DataFrame:
    """Values outside the valid set, each once; NULL is a value."""
    known = df.sparkSession.createDataFrame([(v,) for v in valid], f"{column} string")
    return df.select(column).distinct().exceptAll(known)


def readable(text: Column) -> Column:
    """Whether a text is one JSON object and nothing else; NULL for no text.

    One parse. The parser stops after the first value, so the text is read as a member of an
    object whose other member, named by the text's own hash, comes after it: both are found, and
    no third, only if the text is one value that ends where it ends.
    """
    seal = F.xxhash64(text).cast("string")
    sealed = F.concat(F.lit('{"it": '), text, F.lit(', "'), seal, F.lit('": 1}'))
    strict = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false"}
    members = F.map_keys(F.from_json(sealed, "map<string,string>", strict))
    whole = F.coalesce(members == F.array(F.lit("it"), seal), F.lit(False))
    return F.when(text.isNotNull(), whole & text.rlike(r"^[ \t\r\n]*\{"))


def quarantine(events: DataFrame, text: str = "body") -> tuple[DataFrame, DataFrame]:
    """Events with a readable body, and those whose body is broken.

    Readable is a JSON object with nothing but white space around it; no body at all is
    not broken, an empty one is.
    """
    marked = events.withColumn("broken", F.coalesce(~readable(F.col(text)), F.lit(False)))
    return marked.where(~F.col("broken")).drop("broken"), marked.where("broken").drop("broken")


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """Keys that occur more than once, counted with map-side combine."""
    return df.groupBy(key).agg(F.count("*").alias("copies")).where("copies > 1")


def null_profile(events: DataFrame, columns: list[str], body_keys: list[str]) -> DataFrame:
    """How many rows lack each column, and each key of the JSON body."""
    fields = ", ".join(f"`{k}` string" for k in body_keys)
    parsed = events.select(*columns, F.from_json("body", fields).alias("payload"))
    tests = {c: F.col(c) for c in columns}
    tests |= {f"body_{k}": F.col(f"payload.`{k}`") for k in body_keys}
    counted = parsed.agg(*(F.count_if(v.isNull()).alias(k) for k, v in tests.items()))
    return counted.unpivot([], list(tests), "field", "nulls")


def reconcile(
    bronze: DataFrame, silver: DataFrame, gold: DataFrame, amount: str, gold_amount: str
) -> DataFrame:
    """One row: counts and sums of three layers and whether they agree.

    The three aggregates are scalar subqueries: no join brings the layers together.
    """
    total = F.sum(amount).cast("double")
    first = bronze.agg(F.count("*").alias("bronze_rows"), total.alias("bronze_total"))
    figures = first.select(
        "bronze_rows",
        silver.agg(F.count("*")).scalar().alias("silver_rows"),
        "bronze_total",
        silver.agg(total).scalar().alias("silver_total"),
        gold.agg(F.sum(gold_amount).cast("double")).scalar().alias("gold_total"),
    )
    gap = F.abs(F.col("bronze_total") - F.col("gold_total"))
    return figures.withColumns(
        {
            "counts_match": F.col("bronze_rows") == F.col("silver_rows"),
            "totals_match": F.coalesce(gap < 0.01, F.lit(False)),
        }
    )


def reconcile_written(spark: SparkSession, bronze: dict, silver: dict, gold: dict) -> DataFrame:
    """The same row from what the writes of the layers have measured: `rows` and `total` of each; no layer is read."""
    as_double = lambda total: None if total is None else float(total)
    totals = [as_double(layer["total"]) for layer in (bronze, silver, gold)]
    agree = totals[0] is not None and totals[2] is not None and abs(totals[0] - totals[2]) < 0.01
    row = (bronze["rows"], silver["rows"], *totals, bronze["rows"] == silver["rows"], agree)
    names = "bronze_rows long, silver_rows long, bronze_total double, silver_total double, gold_total double"
    return spark.createDataFrame([row], f"{names}, counts_match boolean, totals_match boolean")


def repeated_ids(df: DataFrame, key: str) -> DataFrame:
    """One row: rows, different ids, and whether every id is there once."""
    counted = df.agg(F.count("*").alias("rows"), F.countDistinct(key).alias("ids"))
    return counted.withColumn("exactly_once", F.col("rows") == F.col("ids"))


def profile(events: DataFrame) -> DataFrame:
    """Size and span of an event log: overall, by type and by known location.

    The log is read twice: once for a small table of counts, which all three
    sections share, and once for the number of different orders. Times are compared as
    numbers and written out at the end.
    """
    written = lambda c: F.date_format(F.timestamp_seconds(c), "yyyy-MM-dd'T'HH:mm:ss")
    span = [written(F.min("first")).alias("first_ts"), written(F.max("last")).alias("last_ts")]
    cells = events.groupBy("event_type", "location_id").agg(
        F.count("*").alias("events"), F.min("ts_seconds").alias("first"), F.max("ts_seconds").alias("last")
    )
    total = F.sum("events").alias("events")
    none = F.lit(None).cast("long").alias("orders")
    orders = events.select("order_id").distinct().agg(F.count("*")).scalar().alias("orders")
    overall = cells.agg(total, *span).select(
        F.lit("all").alias("section"), F.lit(None).cast("string").alias("item"), "events", orders,
        "first_ts", "last_ts",
    )

    def section(name: str, column: str) -> DataFrame:
        return (
            cells.groupBy(column)
            .agg(total, *span)
            .select(
                F.lit(name).alias("section"), F.col(column).cast("string").alias("item"), "events", none,
                "first_ts", "last_ts",
            )
        )

    places = section("location", "location_id").where(F.col("item").isNotNull())
    return overall.unionByName(section("event_type", "event_type")).unionByName(places)
