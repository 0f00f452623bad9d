"""Queries for sources, sinks, cleaning, warehouse building, enrichment and input checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelsight.functions import columns as C
from parcelsight.operators import enrich, etl, numbering, olap, quality, warehouse
from parcelsight.plans.registry import query, rounded
from parcelsight.plans.star import LINE_KEY, DeliveryStar, sql_uniform
from parcelsight.sources.readers import read_current, read_delimited, read_stage
from parcelsight.sources.scratch import scratch_path, staged
from parcelsight.sources.writers import replace_table, write_delimited, write_stage


@query(
    "review_scan",
    "SRC-02",
    """SELECT review_id, order_date, city_id, agent_key, rating, order_accuracy,
        product_availability, discount_applied, price_range, review_text, source FROM fact_review""",
)
def review_scan(star: DeliveryStar):
    return star.reviews.drop("time_id")


@query(
    "csv_round_trip",
    "SRC-01 SNK-01",
    """SELECT row_key, agent_name, rating, review_text, location, price_range, discount_applied,
        product_availability, nullif(order_accuracy, '') AS order_accuracy FROM raw_review""",
)
def csv_round_trip(star: DeliveryStar):
    """All raw reviews out to CSV and back; an empty cell reads as missing."""
    raw = star.raw_reviews
    path = write_delimited(raw, scratch_path(star.spark, "raw-reviews"))
    back = read_delimited(star.spark, path, raw.schema, multiline=True, trim=False)
    return back.select(
        F.col("Row Key").alias("row_key"),
        F.col("Agent Name").alias("agent_name"),
        F.col("Rating").alias("rating"),
        F.col("Review Text").alias("review_text"),
        F.col("Location").alias("location"),
        F.col("Price Range").alias("price_range"),
        F.col("Discount Applied").alias("discount_applied"),
        F.col("Product Availability").alias("product_availability"),
        F.col("Order Accuracy").alias("order_accuracy"),
    )


@query(
    "stage_round_trip",
    "SRC-04 SNK-02",
    """SELECT delivery_id, time_id, order_value, weather FROM fact_delivery""",
)
def stage_round_trip(star: DeliveryStar):
    facts = star.deliveries("delivery_id", "time_id", "order_value", "weather")
    path = write_stage(facts, scratch_path(star.spark, "stage"), ("weather",))
    return read_stage(star.spark, path).select(*facts.columns)


_CLEANED = f"""WITH numbered AS (
        SELECT *, row_number() OVER (ORDER BY row_key) AS review_id FROM raw_review),
    cleaned AS (SELECT review_id,
        CAST(DATE '2001-08-01' - CAST(floor({sql_uniform("review_id", "order_date")} * 61) AS INTEGER)
            AS DATE) AS order_date,
        try_cast(rating AS DOUBLE) AS rating, try_cast(order_accuracy AS DOUBLE) AS order_accuracy,
        try_cast(product_availability AS DOUBLE) AS product_availability,
        CASE WHEN lower(discount_applied) IN ('yes', '1', 'true') THEN 1 ELSE 0 END
            AS discount_applied,
        price_range, location AS city, agent_name, agent_name AS agent_id, review_text
        FROM numbered)"""


@query(
    "cleaned_reviews",
    "ETL-01 ETL-02 ETL-03 WIN-01 FLT-01 FLT-05 FN-01 FN-02 FN-03 FN-05 FN-07 PRJ-02 PRJ-03",
    _CLEANED + """ SELECT * FROM cleaned WHERE review_id IS NOT NULL AND order_date IS NOT NULL
        AND rating IS NOT NULL AND city IS NOT NULL""",
)
def cleaned_reviews(star: DeliveryStar):
    return etl.clean_reviews(star.raw_reviews, ["Row Key"], "2001-08-01", unique=True).select(
        "review_id", "order_date", "rating", "order_accuracy", "product_availability",
        "discount_applied", "price_range", "city", "agent_name", "agent_id", "review_text",
    )


@query(
    "numbered_deliveries",
    "WIN-01",
    """SELECT row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber,
        l_quantity, l_extendedprice) AS row_id, l_orderkey, l_partkey, l_suppkey, l_linenumber,
        l_quantity, l_extendedprice FROM lineitem""",
)
def numbered_deliveries(star: DeliveryStar):
    lines = star.table("lineitem").select(*LINE_KEY, "l_quantity", "l_extendedprice")
    return numbering.dense_ids(lines, list(LINE_KEY))


@query(
    "file_ordered_deliveries",
    "WIN-01 SRC-01",
    """SELECT row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber,
        l_quantity, l_extendedprice) AS row_id, l_orderkey, l_partkey, l_suppkey, l_linenumber,
        l_quantity, l_extendedprice FROM lineitem""",
)
def file_ordered_deliveries(star: DeliveryStar):
    """Lines written in order to CSV files, and numbered as they come in the files."""
    lines = star.table("lineitem").select(*LINE_KEY, "l_quantity", "l_extendedprice")
    ordered = lines.repartitionByRange(*lines.columns).sortWithinPartitions(*lines.columns)
    path = write_delimited(ordered, scratch_path(star.spark, "ordered-lines"))
    return numbering.file_order_ids(read_delimited(star.spark, path, lines.schema))


@query(
    "price_range_codes",
    "WIN-02",
    """SELECT review_id, price_range,
        CAST(CASE WHEN price_range IS NOT NULL THEN dense_rank() OVER (ORDER BY price_range) END
            AS BIGINT) AS price_code FROM fact_review""",
)
def price_range_codes(star: DeliveryStar):
    reviews = star.plain_reviews.select("review_id", "price_range")
    return numbering.level_codes(reviews, "price_range", "price_code")


@query(
    "warehouse_time",
    "WH-02",
    """SELECT * FROM dim_time
    WHERE order_date IN (SELECT order_date FROM fact_delivery)""",
)
def warehouse_time(star: DeliveryStar):
    return warehouse.time_dimension(star.deliveries("order_date"))


@query(
    "warehouse_agents",
    "WH-01",
    """SELECT CAST(row_number() OVER (ORDER BY agent_name) AS INTEGER) AS agent_key,
        agent_name AS agent_id, agent_name
    FROM (SELECT DISTINCT agent_id AS agent_name FROM fact_delivery UNION
        SELECT DISTINCT agent_name FROM raw_review)""",
)
def warehouse_agents(star: DeliveryStar):
    raw = star.delivered_agents
    reviews = star.raw_reviews.select(F.col("Agent Name").alias("agent_name"))
    return warehouse.agent_dimension(raw, reviews)


_CITY_KEYS = """city_keys AS (SELECT CAST(row_number() OVER (ORDER BY city) AS INTEGER) AS city_id,
    city FROM (SELECT DISTINCT city FROM fact_delivery JOIN dim_city USING (city_id) UNION
        SELECT DISTINCT location FROM raw_review WHERE location IS NOT NULL))"""


@query(
    "warehouse_deliveries",
    "WH-01 WIN-01",
    f"""WITH {_CITY_KEYS}
    SELECT row_number() OVER (ORDER BY l_orderkey, l_partkey, l_suppkey, l_linenumber, c.city,
        agent_id, f.order_date, distance_km, delivery_time_min) AS delivery_id,
        time_id, k.city_id, agent_id, distance_km, delivery_time_min, sla_min,
        delayed_flag, CASE WHEN traffic_density_index <= 1.0::DOUBLE / 3 THEN 'Low'
            WHEN traffic_density_index <= 2.0::DOUBLE / 3 THEN 'Medium' ELSE 'High' END
            AS traffic_level,
        weather, vehicle_type, is_festival
    FROM fact_delivery f JOIN dim_city c USING (city_id) JOIN city_keys k ON c.city = k.city""",
)
def warehouse_deliveries(star: DeliveryStar):
    stored = staged(star.raw_deliveries, "raw-deliveries")
    raw = etl.traffic_levels(etl.delay_flags(stored))
    cities = warehouse.city_dimension(
        stored.select("city"),
        star.raw_reviews.select(F.col("Location").alias("city")),
    )
    keep = [
        "distance_km", "delivery_time_min", "sla_min", "delayed_flag", "traffic_level", "weather",
        "vehicle_type", "is_festival",
    ]
    return warehouse.delivery_facts(raw, cities, list(LINE_KEY), keep)


@query(
    "warehouse_reviews",
    "WH-01 ETL-01",
    _CLEANED
    + f""", {_CITY_KEYS}, agent_keys AS (
        SELECT CAST(row_number() OVER (ORDER BY agent_name) AS INTEGER) AS agent_key, agent_name
        FROM (SELECT DISTINCT agent_id AS agent_name FROM fact_delivery UNION
            SELECT DISTINCT agent_name FROM raw_review))
    SELECT review_id, CAST(year(order_date) * 10000 + month(order_date) * 100 + day(order_date)
        AS INTEGER) AS time_id, city_id, agent_key, rating, order_accuracy, product_availability,
        discount_applied, price_range, review_text
    FROM cleaned JOIN city_keys USING (city) LEFT JOIN agent_keys USING (agent_name)
    WHERE rating IS NOT NULL""",
)
def warehouse_reviews(star: DeliveryStar):
    cleaned = etl.clean_reviews(star.raw_reviews, ["Row Key"], "2001-08-01", unique=True)
    cities = warehouse.city_dimension(
        star.delivered_cities.select("city"),
        star.raw_reviews.select(F.col("Location").alias("city")),
    )
    agents = warehouse.agent_dimension(
        star.delivered_agents, star.raw_reviews.select(F.col("Agent Name").alias("agent_name"))
    )
    keep = [
        "rating", "order_accuracy", "product_availability", "discount_applied", "price_range",
        "review_text",
    ]
    return warehouse.review_facts(cleaned, cities, agents, keep)


@query(
    "delay_flags",
    "WH-03",
    """SELECT delayed_flag, CASE WHEN traffic_density_index <= 1.0::DOUBLE / 3 THEN 'Low'
        WHEN traffic_density_index <= 2.0::DOUBLE / 3 THEN 'Medium' ELSE 'High' END AS traffic_level,
        count(*) AS n FROM fact_delivery GROUP BY 1, 2""",
)
def delay_flags(star: DeliveryStar):
    raw = star.deliveries("delivery_time_min", "sla_min", "traffic_density_index")
    return olap.count_by(
        etl.traffic_levels(etl.delay_flags(raw)), "delayed_flag", "traffic_level"
    )


@query(
    "warehouse_summary",
    "DQ-02 AGG-05",
    """SELECT 'dim_agent' AS table_name, count(*) AS total, NULL::DOUBLE AS average FROM dim_agent
    UNION ALL SELECT 'dim_city', count(*), NULL FROM dim_city
    UNION ALL SELECT 'dim_time', count(*), NULL FROM dim_time
    UNION ALL SELECT 'fact_delivery', count(*), round(avg(delivery_time_min), 9) FROM fact_delivery
    UNION ALL SELECT 'fact_review', count(*), round(avg(rating), 9) FROM fact_review
    UNION ALL SELECT 'lines without order, customer or supplier', count(*), NULL FROM lineitem
        LEFT JOIN orders ON l_orderkey = o_orderkey LEFT JOIN customer ON o_custkey = c_custkey
        LEFT JOIN supplier ON l_suppkey = s_suppkey
        WHERE o_orderkey IS NULL OR c_custkey IS NULL OR s_suppkey IS NULL""",
)
def warehouse_summary(star: DeliveryStar):
    summary = quality.warehouse_summary(
        {
            "dim_agent": (star.dim_agent, None),
            "dim_city": (star.dim_city, None),
            "dim_time": (star.dim_time, None),
            "fact_delivery": (star.deliveries("delivery_time_min"), "delivery_time_min"),
            "fact_review": (star.plain_reviews, "rating"),
            "lines without order, customer or supplier": (star.lone_lines, None),
        }
    )
    return rounded(summary, 9, "average")


@query(
    "checked_reviews",
    "DQ-01",
    "SELECT review_id, rating FROM fact_review WHERE rating IS NOT NULL",
)
def checked_reviews(star: DeliveryStar):
    path = f"{star.folder}/documents.parquet"
    quality.require_rows(quality.require_path(star.spark, path), 1, "reviews")
    rated = star.plain_reviews.select("review_id", "rating").na.drop("any", subset=["rating"])
    return quality.require_rows(rated, 3, "rated reviews")


@query(
    "conformed_deliveries",
    "DQ-03 JOIN-09",
    """SELECT delivery_id, city_id, city, order_value, 'Unknown' AS carrier FROM fact_delivery
    LEFT JOIN dim_city USING (city_id)""",
)
def conformed_deliveries(star: DeliveryStar):
    return quality.conform(
        star.deliveries("delivery_id", "city_id", "order_value"),
        ["delivery_id", "city_id", "city", "order_value", "carrier"],
        lookups={"city": (star.dim_city, "city_id")},
        defaults={"carrier": "Unknown"},
    )


_U = sql_uniform
_D = "delivery_id"


@query(
    "enriched_deliveries",
    "ENR-01 ENR-02 ENR-03 ENR-04 FN-08 FN-11 FN-16",
    f"""SELECT delivery_id, round(5.0::DOUBLE + 95.0 * {_U(_D, "order_value")}, 2) AS order_value,
        round(0.5::DOUBLE + 4.5 * {_U(_D, "agent_experience_years")}, 1) AS agent_experience_years,
        round(0.0::DOUBLE + 1.0 * {_U(_D, "traffic_density_index")}, 2) AS traffic_density_index,
        round(distance_km * (0.9::DOUBLE + 0.3 * {_U(_D, "actual_distance")}), 9) AS actual_distance,
        round(CASE weather WHEN 'Clear' THEN 3.0 * {_U(_D, "weather_severity")}
            WHEN 'Rainy' THEN 4.0 + 3.0 * {_U(_D, "weather_severity")}
            WHEN 'Stormy' THEN 8.0 + 2.0 * {_U(_D, "weather_severity")}
            ELSE 5.0 * {_U(_D, "weather_severity")} END, 9) AS weather_severity,
        CASE WHEN delayed_flag = 1 AND {_U(_D, "complaint")} > 0.4 THEN 1 ELSE 0 END
            AS customer_complaint FROM fact_delivery""",
)
def enriched_deliveries(star: DeliveryStar):
    facts = star.deliveries("delivery_id", "distance_km", "weather", "delayed_flag")
    added = enrich.enrich_deliveries(facts, ["delivery_id"])
    return rounded(added, 9, "actual_distance", "weather_severity").drop(
        "distance_km", "weather", "delayed_flag"
    )


_PHRASE_LIST = ", ".join(f"'{p}'" for p in enrich.PHRASES)
_ENRICHED_REVIEWS = f"""SELECT review_id,
    CASE WHEN {_U("review_id", "source")} < 0.2::DOUBLE THEN 'Web'
        WHEN {_U("review_id", "source")} < 0.2::DOUBLE + 0.4::DOUBLE THEN 'Android' ELSE 'iOS' END
        AS source,
    concat_ws(' ', review_text, list_value({_PHRASE_LIST})[
        CAST(floor({_U("review_id", "phrase")} * 6) AS INTEGER) + 1]) AS review_text
    FROM fact_review"""


@query("enriched_reviews", "ENR-05 ENR-06 FN-12", _ENRICHED_REVIEWS)
def enriched_reviews(star: DeliveryStar):
    reviews = star.plain_reviews.select("review_id", "source", "review_text")
    return enrich.enrich_reviews(reviews, ["review_id"])


@query(
    "replaced_review_table",
    "SNK-04 SRC-02",
    f"""SELECT source, count(*) AS n, sum(length(review_text))::BIGINT AS characters
    FROM ({_ENRICHED_REVIEWS}) GROUP BY source""",
)
def replaced_review_table(star: DeliveryStar):
    """Store the reviews, replace the table by its enriched self, and read the current version."""
    root = scratch_path(star.spark, "warehouse")
    stored, _ = replace_table(
        star.plain_reviews.select("review_id", "source", "review_text"), root, "stored_review"
    )
    replace_table(enrich.enrich_reviews(stored, ["review_id"]), root, "stored_review")
    return read_current(star.spark, root, "stored_review").groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.length("review_text")).alias("characters")
    )


@query(
    "scalar_functions",
    "FN-01 FN-02 FN-03 FN-04 FN-05 FN-06 FN-07 FN-13 FN-15",
    """SELECT row_key, lower(agent_name) AS lower_name, try_cast(rating AS DOUBLE) AS rating_number,
        CAST(try_cast(rating AS DOUBLE) IS NULL AS INTEGER) AS rating_missing,
        coalesce(try_cast(order_accuracy AS DOUBLE), 0) AS accuracy_or_zero,
        CAST(DATE '2001-08-01' - CAST(product_availability AS INTEGER) AS DATE) AS days_back,
        try_cast(substr(row_key, 1, 4) || '-13-01' AS DATE) AS bad_day,
        CASE product_availability WHEN '1' THEN 'Scarce' WHEN '5' THEN 'Plenty' END AS recoded,
        greatest(3.0::DOUBLE - try_cast(product_availability AS DOUBLE), 0.0::DOUBLE) AS floored
    FROM raw_review""",
)
def scalar_functions(star: DeliveryStar):
    availability = C.to_number("Product Availability")
    return star.raw_reviews.select(
        F.col("Row Key").alias("row_key"),
        F.lower("Agent Name").alias("lower_name"),
        C.to_number("Rating").alias("rating_number"),
        C.if_else(C.to_number("Rating").isNull(), F.lit(1), F.lit(0)).alias("rating_missing"),
        F.coalesce(C.to_number("Order Accuracy"), F.lit(0.0)).alias("accuracy_or_zero"),
        C.days_before("2001-08-01", F.col("Product Availability").cast("int")).alias("days_back"),
        C.to_day(F.concat(F.substring("Row Key", 1, 4), F.lit("-13-01"))).alias("bad_day"),
        C.recode("Product Availability", {"1": "Scarce", "5": "Plenty"}).alias("recoded"),
        C.floor_at_zero(F.lit(3.0) - availability).alias("floored"),
    )


@query(
    "staged_review_count",
    "SRC-02 AGG-05",
    "SELECT count(*) AS n, count(DISTINCT agent_key) AS agents FROM fact_review",
)
def staged_review_count(star: DeliveryStar):
    stored = staged(star.plain_reviews.select("review_id", "agent_key"), "reviews")
    return stored.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("agent_key").alias("agents")
    )
