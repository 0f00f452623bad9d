"""Star-schema views over the given tables, and the same views as SQL text.

Orders with their lines are the deliveries, nations the cities, suppliers the agents,
documents with their labels the reviews. A view joins only the tables its requested
columns come from, so a question about lines alone never touches orders.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelsight.functions.columns import (
    at_least,
    case_when,
    cut_right,
    date_id,
    days_before,
    uniform,
)
from parcelsight.operators.enrich import complaint
from parcelsight.operators.olap import PART_COLUMNS, measure_parts
from parcelsight.operators.warehouse import date_parts
from parcelsight.sources.scratch import staged

# The day reviews are dated back from: a parameter, since "today" cannot be reproduced.
REFERENCE_DATE = "2001-08-01"
LINE_KEY = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")

_ORDER_COLUMNS = {"time_id", "order_date", "delivery_time_raw", "traffic_level"}
_CITY_COLUMNS = {"city_id"}
_AGENT_COLUMNS = {"agent_id"}


def _line_key() -> Column:
    return F.concat_ws("|", *[F.col(k).cast("string") for k in LINE_KEY])


def _delivery_columns() -> dict[str, Column]:
    order_day = F.to_date("o_orderdate")
    time = F.lit(10.0) + F.col("l_quantity")
    sla = F.lit(30) + F.lit(2) * F.col("l_linenumber")
    return {
        "delivery_id": _line_key(),
        "delivery_time_min": time,
        "sla_min": sla,
        "delayed_flag": (time > sla).cast("int"),
        "distance_km": F.col("l_quantity") / F.lit(2.5),
        "order_value": F.col("l_extendedprice") / F.lit(1000.0),
        "order_value_raw": F.when(
            F.col("l_linenumber") != 7, F.col("l_extendedprice") / F.lit(1000.0)
        ),
        "agent_experience_years": F.lit(0.5) + (F.col("l_suppkey") % 46) / F.lit(10.0),
        "traffic_density_index": F.col("l_discount") * F.lit(10.0),
        "weather": F.when(F.col("l_returnflag") == "A", "Clear")
        .when(F.col("l_returnflag") == "N", "Rainy")
        .when(F.col("l_returnflag") == "R", "Stormy"),
        "vehicle_type": F.when(F.col("l_linestatus") == "F", "Bike").otherwise("Van"),
        "is_festival": F.col("l_tax") >= 0.07,
        "customer_complaint": complaint((time > sla).cast("int"), LINE_KEY),
        "time_id": date_id(order_day),
        "order_date": order_day,
        "delivery_time_raw": F.date_diff(F.to_date("l_shipdate"), order_day).cast("double"),
        "traffic_level": case_when(
            [
                (F.substring("o_orderpriority", 1, 1).isin("1", "2"), F.lit("High")),
                (F.substring("o_orderpriority", 1, 1) == "3", F.lit("Medium")),
            ],
            F.lit("Low"),
        ),
        "city_id": F.col("c_nationkey"),
        "agent_id": F.col("s_name"),
        "agent_number": F.col("l_suppkey"),
    }


class DeliveryStar:
    """The views of one data folder."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def _size_of(self, name: str) -> Column:
        return self.table(name).agg(F.count(F.lit(1)).alias("n")).scalar()

    @cached_property
    def dim_city(self) -> DataFrame:
        return self.table("nation").select(
            F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city")
        )

    @cached_property
    def dim_place(self) -> DataFrame:
        """Cities with the region above them."""
        regions = self.table("region").select(
            F.col("r_regionkey").alias("n_regionkey"), F.col("r_name").alias("region")
        )
        return (
            self.table("nation")
            .join(regions, "n_regionkey")
            .select(F.col("n_nationkey").alias("city_id"), F.col("n_name").alias("city"), "region")
        )

    @cached_property
    def dim_agent(self) -> DataFrame:
        return self.table("supplier").select(
            F.col("s_suppkey").cast("int").alias("agent_key"),
            F.col("s_name").alias("agent_id"),
            F.col("s_name").alias("agent_name"),
        )

    @cached_property
    def dim_time(self) -> DataFrame:
        days = self.table("orders").select(F.to_date("o_orderdate").alias("d")).distinct()
        return days.select(*[c.alias(n) for n, c in date_parts(F.col("d")).items()])

    @cached_property
    def stored_dim_time(self) -> DataFrame:
        """The date dimension as a table of known size, for joins with single deliveries."""
        return staged(self.dim_time, "dim-time")

    def agent_parts(self, *keys: str) -> DataFrame:
        """Measure parts per agent (and more keys): the agent is named after the summing."""
        facts = self.deliveries("agent_number", *keys, "delivery_time_min", "delayed_flag")
        agents = self.table("supplier").select(
            F.col("s_suppkey").alias("agent_number"), F.col("s_name").alias("agent_id")
        )
        return measure_parts(facts, ["agent_number", *keys]).join(agents, "agent_number")

    def order_parts(self, *keys: str) -> DataFrame:
        """Measure parts per order, with attributes of the order (and of its lines) as keys.

        The lines are summed per order on the way to the join with orders: the join's own
        shuffle carries the sums, and an order with very many lines is one row in it.
        """
        known = _delivery_columns()
        own = [k for k in keys if k not in _ORDER_COLUMNS | _CITY_COLUMNS]
        lines = self.table("lineitem").select(
            "l_orderkey", *[known[c].alias(c) for c in (*own, "delivery_time_min", "delayed_flag")]
        )
        if own:
            # One exchange by order serves the sums by order and more, and the join after them.
            lines = lines.repartition("l_orderkey")
        parts = measure_parts(lines, ["l_orderkey", *own])
        orders = self._orders(bool(_CITY_COLUMNS & set(keys)))
        joined = parts.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        named = [F.col(k) if k in own else known[k].alias(k) for k in keys]
        return joined.select(*named, *PART_COLUMNS)

    def _orders(self, with_city: bool) -> DataFrame:
        orders = self.table("orders")
        if not with_city:
            return orders
        places = self.table("customer").select("c_custkey", "c_nationkey")
        return orders.join(places, F.col("o_custkey") == F.col("c_custkey"))

    @cached_property
    def delivered_cities(self) -> DataFrame:
        """Cities with a delivery. Lines are reduced to their different orders before any join,
        and every join after that only asks whether a key is there."""
        lines = self.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey")).distinct()
        orders = self.table("orders").join(lines, "o_orderkey", "left_semi")
        customers = orders.select(F.col("o_custkey").alias("c_custkey")).distinct()
        used = self.table("customer").join(customers, "c_custkey", "left_semi")
        cities = used.select(F.col("c_nationkey").alias("city_id")).distinct()
        return self.dim_city.join(cities, "city_id", "left_semi")

    @cached_property
    def lone_lines(self) -> DataFrame:
        """Lines whose order, customer or supplier is missing."""
        whole = self._orders(with_city=True).select(F.col("o_orderkey").alias("l_orderkey"))
        agents = self.table("supplier").select(F.col("s_suppkey").alias("l_suppkey"))
        lines = self.table("lineitem").select("l_orderkey", "l_suppkey")
        placed = lines.join(whole, "l_orderkey", "left_semi")
        return lines.join(whole, "l_orderkey", "left_anti").unionByName(
            placed.join(agents, "l_suppkey", "left_anti")
        )

    @cached_property
    def delivered_agents(self) -> DataFrame:
        """Names of the agents with a delivery."""
        used = self.table("lineitem").select(F.col("l_suppkey").alias("s_suppkey")).distinct()
        agents = self.table("supplier").join(used, "s_suppkey", "left_semi")
        return agents.select(F.col("s_name").alias("agent_name"))

    def deliveries(self, *columns: str) -> DataFrame:
        """fact_delivery with the given columns.

        Tables are joined only where a column needs them. Every line has its order, customer
        and supplier, as ``warehouse_summary`` checks; else totals would hang on the columns.
        """
        wanted = set(columns)
        rows = self.table("lineitem")
        if wanted & (_ORDER_COLUMNS | _CITY_COLUMNS):
            orders = self._orders(bool(wanted & _CITY_COLUMNS))
            rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        if wanted & _AGENT_COLUMNS:
            agents = self.table("supplier").select("s_suppkey", "s_name")
            rows = rows.join(agents, F.col("l_suppkey") == F.col("s_suppkey"))
        known = _delivery_columns()
        return rows.select(*[known[c].alias(c) for c in columns])

    @cached_property
    def reviews(self) -> DataFrame:
        """fact_review; Catalyst drops what a query does not read, but not the labels join."""
        labels = self.table("labels")
        doc = F.col("doc_id")
        quality, toxic = F.coalesce("quality", F.lit(0)), F.coalesce("toxic", F.lit(0))
        return self._plain_reviews().join(labels, "doc_id", "left").select(
            *self._plain_columns,
            (F.lit(1.0) + F.lit(4.0) * quality).alias("order_accuracy"),
            toxic.alias("discount_applied"),
        )

    _plain_columns = (
        "review_id", "time_id", "order_date", "city_id", "agent_key", "rating",
        "product_availability", "price_range", "review_text", "source",
    )

    def _plain_reviews(self) -> DataFrame:
        doc = F.col("doc_id")
        day = days_before(
            REFERENCE_DATE, F.floor(uniform(["doc_id"], "order_date") * 61).cast("int")
        )
        return self.table("documents").select(
            "doc_id",
            doc.alias("review_id"),
            date_id(day).alias("time_id"),
            day.alias("order_date"),
            (doc % self._size_of("nation")).cast("int").alias("city_id"),
            (doc % self._size_of("supplier")).cast("int").alias("agent_key"),
            (F.lit(1.0) + ((doc * 7) % 41) / F.lit(10.0)).alias("rating"),
            (F.lit(1.0) + F.col("n_chars") % 5).alias("product_availability"),
            cut_right("n_chars", (500, 2000), ("Low", "Medium", "Premium")).alias("price_range"),
            F.col("text").alias("review_text"),
            "source",
        )

    @cached_property
    def plain_reviews(self) -> DataFrame:
        """fact_review without the two columns that need the labels."""
        return self._plain_reviews().select(*self._plain_columns)

    @cached_property
    def raw_reviews(self) -> DataFrame:
        """Reviews as the raw file has them: all text, with gaps and junk."""
        doc = F.col("doc_id")
        names = self.table("supplier").select(F.col("s_suppkey").alias("_k"), "s_name")
        places = self.table("nation").select(F.col("n_nationkey").alias("_c"), "n_name")
        base = self.table("documents").join(self.table("labels"), "doc_id", "left")
        base = base.withColumn("_agent", doc % self._size_of("supplier")).withColumn(
            "_city", (doc % self._size_of("nation")).cast("int")
        )
        rated = (F.lit(1.0) + ((doc * 7) % 41) / F.lit(10.0)).cast("string")
        return (
            base.join(names, F.col("_agent") == F.col("_k"))
            .join(places, F.col("_city") == F.col("_c"), "left")
            .select(
                F.lpad(doc.cast("string"), 12, "0").alias("Row Key"),
                F.col("s_name").alias("Agent Name"),
                F.when(doc % 13 == 0, F.lit("n/a")).when(doc % 17 == 0, F.lit(None)).otherwise(
                    rated
                ).alias("Rating"),
                F.col("text").alias("Review Text"),
                (F.col("n_chars") % 50 + 10).cast("string").alias("Delivery Time (min)"),
                F.when(doc % 29 != 0, F.col("n_name")).alias("Location"),
                F.when(doc % 2 == 0, F.lit("Grocery")).otherwise(F.lit("Food")).alias("Order Type"),
                F.when(doc % 3 == 0, F.lit("Positive"))
                .otherwise(F.lit("Neutral"))
                .alias("Customer Feedback Type"),
                cut_right("n_chars", (500, 2000), ("Low", "Medium", "Premium")).alias("Price Range"),
                F.when(F.col("toxic") == 1, F.lit("Yes"))
                .when(doc % 5 == 0, F.lit("TRUE"))
                .when(doc % 7 == 0, F.lit("1"))
                .when(doc % 11 != 0, F.lit("no"))
                .alias("Discount Applied"),
                (F.col("n_chars") % 5 + 1).cast("string").alias("Product Availability"),
                at_least("n_chars", 1000, "4", "3").alias("Customer Service Rating"),
                F.when(doc % 19 == 0, F.lit("")).otherwise(
                    (F.lit(1) + F.lit(4) * F.col("quality")).cast("string")
                ).alias("Order Accuracy"),
            )
        )

    @cached_property
    def raw_deliveries(self) -> DataFrame:
        """Deliveries before the warehouse: names instead of keys."""
        known = _delivery_columns()
        nations = self.table("nation").select(
            F.col("n_nationkey").alias("c_nationkey"), F.col("n_name").alias("city")
        )
        orders = (
            self.table("orders")
            .join(self.table("customer"), F.col("o_custkey") == F.col("c_custkey"))
            .join(nations, "c_nationkey")
        )
        plain = (
            "order_date", "distance_km", "delivery_time_min", "sla_min", "traffic_density_index",
            "weather", "vehicle_type", "is_festival",
        )
        return (
            self.table("lineitem")
            .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .join(self.table("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
            .select(
                *LINE_KEY,
                "city",
                F.col("s_name").alias("agent_name"),
                *[known[c].alias(c) for c in plain],
            )
        )

    @cached_property
    def web_events(self) -> DataFrame:
        return self.table("events").select(
            F.to_date("ts").alias("day"), "event_type", F.col("value").alias("volume")
        )


def sql_uniform(key: str, salt: str) -> str:
    """SQL text of the key-based number in [0, 1)."""
    return f"(('0x' || substr(md5({key} || '|{salt}'), 1, 13))::BIGINT / 4503599627370496.0)"


_KEY = "concat_ws('|', l_orderkey, l_partkey, l_suppkey, l_linenumber)"
_DAY = "CAST(o_orderdate AS DATE)"
_REVIEW_DAY = (
    f"CAST(DATE '{REFERENCE_DATE}' - CAST(floor({sql_uniform('doc_id', 'order_date')} * 61) AS INTEGER)"
    " AS DATE)"
)


def sql_date_id(day: str) -> str:
    return f"CAST(year({day}) * 10000 + month({day}) * 100 + day({day}) AS INTEGER)"


def sql_price_range(chars: str) -> str:
    return (
        f"CASE WHEN {chars} IS NULL THEN NULL WHEN {chars} <= 500 THEN 'Low' "
        f"WHEN {chars} <= 2000 THEN 'Medium' ELSE 'Premium' END"
    )


# The same views for a plain SQL engine over the same tables.
SQL_VIEWS = {
    "dim_city": "SELECT n_nationkey AS city_id, n_name AS city FROM nation",
    "dim_place": """SELECT n_nationkey AS city_id, n_name AS city, r_name AS region
        FROM nation JOIN region ON n_regionkey = r_regionkey""",
    "dim_agent": """SELECT CAST(s_suppkey AS INTEGER) AS agent_key, s_name AS agent_id,
        s_name AS agent_name FROM supplier""",
    "dim_time": f"""SELECT DISTINCT {sql_date_id(_DAY)} AS time_id, {_DAY} AS order_date,
        CAST(year({_DAY}) AS INTEGER) AS year, CAST(month({_DAY}) AS INTEGER) AS month,
        CAST(day({_DAY}) AS INTEGER) AS day, strftime({_DAY}, '%Y-%m') AS year_month,
        strftime({_DAY}, '%A') AS weekday FROM orders""",
    "fact_delivery": f"""SELECT {_KEY} AS delivery_id, l_orderkey, l_partkey, l_suppkey,
        l_linenumber, 10.0::DOUBLE + l_quantity AS delivery_time_min,
        CAST(30 + 2 * l_linenumber AS INTEGER) AS sla_min,
        CAST(10.0 + l_quantity > 30 + 2 * l_linenumber AS INTEGER) AS delayed_flag,
        l_quantity / 2.5::DOUBLE AS distance_km,
        l_extendedprice / 1000.0::DOUBLE AS order_value,
        CASE WHEN l_linenumber <> 7 THEN l_extendedprice / 1000.0::DOUBLE END AS order_value_raw,
        0.5::DOUBLE + (l_suppkey % 46) / 10.0::DOUBLE AS agent_experience_years,
        l_discount * 10.0::DOUBLE AS traffic_density_index,
        CASE l_returnflag WHEN 'A' THEN 'Clear' WHEN 'N' THEN 'Rainy' WHEN 'R' THEN 'Stormy' END
            AS weather,
        CASE WHEN l_linestatus = 'F' THEN 'Bike' ELSE 'Van' END AS vehicle_type,
        l_tax >= 0.07 AS is_festival,
        CASE WHEN 10.0 + l_quantity > 30 + 2 * l_linenumber
            AND {sql_uniform(_KEY, "complaint")} > 0.4 THEN 1 ELSE 0 END AS customer_complaint,
        {sql_date_id(_DAY)} AS time_id, {_DAY} AS order_date,
        CAST(date_diff('day', {_DAY}, CAST(l_shipdate AS DATE)) AS DOUBLE) AS delivery_time_raw,
        CASE WHEN o_orderpriority[1] IN ('1', '2') THEN 'High'
            WHEN o_orderpriority[1] = '3' THEN 'Medium' ELSE 'Low' END AS traffic_level,
        c_nationkey AS city_id, s_name AS agent_id
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey
        JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey""",
    "fact_review": f"""SELECT doc_id AS review_id, {sql_date_id(_REVIEW_DAY)} AS time_id,
        {_REVIEW_DAY} AS order_date,
        CAST(doc_id % (SELECT count(*) FROM nation) AS INTEGER) AS city_id,
        CAST(doc_id % (SELECT count(*) FROM supplier) AS INTEGER) AS agent_key,
        1.0::DOUBLE + ((doc_id * 7) % 41) / 10.0::DOUBLE AS rating,
        1.0::DOUBLE + 4 * coalesce(quality, 0) AS order_accuracy,
        1.0::DOUBLE + n_chars % 5 AS product_availability,
        coalesce(toxic, 0) AS discount_applied, {sql_price_range("n_chars")} AS price_range,
        text AS review_text, source FROM documents LEFT JOIN labels USING (doc_id)""",
    "raw_review": f"""SELECT lpad(doc_id::VARCHAR, 12, '0') AS row_key, s_name AS agent_name,
        CASE WHEN doc_id % 13 = 0 THEN 'n/a' WHEN doc_id % 17 = 0 THEN NULL
            ELSE (1.0::DOUBLE + ((doc_id * 7) % 41) / 10.0::DOUBLE)::VARCHAR END AS rating,
        text AS review_text, CASE WHEN doc_id % 29 <> 0 THEN n_name END AS location,
        {sql_price_range("n_chars")} AS price_range,
        CASE WHEN toxic = 1 THEN 'Yes' WHEN doc_id % 5 = 0 THEN 'TRUE' WHEN doc_id % 7 = 0 THEN '1'
            WHEN doc_id % 11 <> 0 THEN 'no' END AS discount_applied,
        (n_chars % 5 + 1)::VARCHAR AS product_availability,
        CASE WHEN doc_id % 19 = 0 THEN '' ELSE (1 + 4 * quality)::VARCHAR END AS order_accuracy
        FROM documents LEFT JOIN labels USING (doc_id)
        JOIN supplier ON doc_id % (SELECT count(*) FROM supplier) = s_suppkey
        LEFT JOIN nation ON doc_id % (SELECT count(*) FROM nation) = n_nationkey""",
}


def with_views(sql: str) -> str:
    """Put the views a statement names in front of it as common table expressions."""
    used = [name for name in SQL_VIEWS if name in sql]
    if not used:
        return sql
    views = ",\n".join(f"{name} AS ({SQL_VIEWS[name]})" for name in used)
    body = sql.strip()
    for opening in ("WITH RECURSIVE ", "WITH "):
        if body.startswith(opening):
            return f"{opening}{views},\n{body[len(opening):]}"
    return f"WITH {views}\n{body}"
