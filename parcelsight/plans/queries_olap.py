"""Queries over the star schema: joins, measures, roll-ups, slices, key figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelsight.functions.columns import percent_label
from parcelsight.operators import olap, standing
from parcelsight.plans.registry import query, rounded
from parcelsight.plans.star import DeliveryStar
from parcelsight.sources.readers import run_sql
from parcelsight.sources.scratch import scratch_path, staged
from parcelsight.sources.writers import replace_folders, write_stage

MEASURES = """round(avg(delivery_time_min), 9) AS avg_delivery_time,
    round(sum(delayed_flag) * 1.0::DOUBLE / count(*), 9) AS delay_rate"""
CITIES = ["NATION_1", "NATION_3", "NATION_7", "NATION_20"]
CITY_LIST = ", ".join(f"'{c}'" for c in CITIES)
START, END = "1996-03-01", "1998-09-30"


def _measured(df):
    return rounded(df, 9, "avg_delivery_time", "delay_rate")


@query(
    "city_traffic_delays",
    "AGG-01 AGG-03 JOIN-01 FN-16",
    f"""SELECT city, traffic_level, {MEASURES} FROM fact_delivery JOIN dim_city USING (city_id)
    GROUP BY city, traffic_level""",
)
def city_traffic_delays(star: DeliveryStar):
    return _measured(olap.city_traffic(star.order_parts("city_id", "traffic_level"), star.dim_city))


@query(
    "city_month_delays",
    "AGG-02 AGG-03 JOIN-02",
    f"""SELECT city, year, month, {MEASURES} FROM fact_delivery JOIN dim_city USING (city_id)
    JOIN dim_time USING (time_id) GROUP BY city, year, month""",
)
def city_month_delays(star: DeliveryStar):
    parts = star.order_parts("city_id", "time_id")
    return _measured(olap.city_month(parts, star.dim_city, star.dim_time))


@query(
    "city_traffic_sql",
    "SRC-03 AGG-01 JOIN-01",
    """SELECT city, traffic_level, count(*) AS lines, sum(delayed_flag)::BIGINT AS late,
        rank() OVER (PARTITION BY traffic_level ORDER BY sum(delayed_flag) DESC, city) AS place
    FROM fact_delivery JOIN dim_city USING (city_id) GROUP BY city, traffic_level""",
)
def city_traffic_sql(star: DeliveryStar):
    """Cities by late lines within each traffic level, put as SQL text over measure parts."""
    return run_sql(
        star.spark,
        """WITH summed AS (
            SELECT city_id, traffic_level, sum(row_count) AS lines, sum(delayed_sum) AS late
            FROM {parts} GROUP BY city_id, traffic_level)
        SELECT city, traffic_level, lines, late,
            CAST(rank() OVER (PARTITION BY traffic_level ORDER BY late DESC, city) AS BIGINT) AS place
        FROM summed JOIN {cities} USING (city_id)""",
        parts=star.order_parts("city_id", "traffic_level"),
        cities=star.dim_city,
    )


STAR_COLUMNS = ("delivery_id", "agent_id", "city_id", "time_id", "delivery_time_min", "order_value",
                "distance_km", "delayed_flag", "traffic_level", "customer_complaint")


def _frame(star: DeliveryStar, *columns: str):
    """Deliveries with date and city."""
    facts = star.deliveries("city_id", "time_id", *columns)
    return olap.star_frame(facts, star.stored_dim_time, star.dim_city)


@query(
    "star_join",
    "JOIN-03 FN-04 PRJ-01",
    """SELECT delivery_id, f.agent_id, f.city_id, f.time_id, delivery_time_min, order_value,
        distance_km, delayed_flag, traffic_level, customer_complaint, t.order_date, city, agent_name
    FROM fact_delivery f JOIN dim_time t USING (time_id) JOIN dim_city USING (city_id)
    LEFT JOIN dim_agent a ON f.agent_id = a.agent_id""",
)
def star_join(star: DeliveryStar):
    facts = star.deliveries(*STAR_COLUMNS)
    return olap.star_frame(facts, star.stored_dim_time, star.dim_city, star.dim_agent)


@query(
    "agent_performance",
    "AGG-04 AGG-03 JOIN-04",
    """SELECT agent_key, agent_id, agent_name, round(avg(delivery_time_min), 9) AS avg_delivery_time,
        round(sum(delayed_flag) * 1.0::DOUBLE / count(*), 9) AS delay_rate,
        round(avg(rating), 9) AS avg_rating
    FROM (SELECT a.*, delivery_time_min, delayed_flag, rating FROM dim_agent a
        JOIN fact_delivery f ON a.agent_id = f.agent_id
        LEFT JOIN fact_review r ON a.agent_key = r.agent_key)
    GROUP BY agent_key, agent_id, agent_name""",
)
def agent_performance(star: DeliveryStar):
    return rounded(performance(star), 9, "avg_delivery_time", "delay_rate", "avg_rating")


def performance(star: DeliveryStar):
    return olap.agent_performance(
        star.dim_agent,
        star.agent_parts(),
        star.plain_reviews.select("agent_key", "rating"),
    )


@query(
    "delivery_totals",
    "AGG-05",
    """SELECT count(*) AS total_deliveries, round(avg(delivery_time_min), 9) AS avg_time
    FROM fact_delivery""",
)
def delivery_totals(star: DeliveryStar):
    facts = star.deliveries("delivery_time_min")
    totals = olap.global_measure(facts, "delivery_time_min", "total_deliveries", "avg_time")
    return rounded(totals, 9, "avg_time")


@query(
    "review_totals",
    "AGG-05",
    "SELECT count(*) AS total_reviews, round(avg(rating), 9) AS avg_rating FROM fact_review",
)
def review_totals(star: DeliveryStar):
    totals = olap.global_measure(star.plain_reviews, "rating", "total_reviews", "avg_rating")
    return rounded(totals, 9, "avg_rating")


@query(
    "source_summary",
    "AGG-09",
    """SELECT source, round(avg(rating), 9) AS avg_rating, count(*) AS reviews FROM fact_review
    GROUP BY source""",
)
def source_summary(star: DeliveryStar):
    return rounded(olap.source_summary(star.plain_reviews), 9, "avg_rating")


@query(
    "daily_orders",
    "AGG-10",
    """SELECT t.order_date, count(*)::BIGINT AS orders FROM fact_delivery f
    JOIN dim_time t USING (time_id) GROUP BY t.order_date""",
)
def daily_orders(star: DeliveryStar):
    return olap.daily_orders(star.order_parts("time_id"), star.dim_time)


@query(
    "drill_to_city",
    "AGG-11 PRJ-05",
    """SELECT city AS label, round(avg(delivery_time_min), 9) AS avg_delivery_time
    FROM fact_delivery JOIN dim_city USING (city_id) GROUP BY city""",
)
def drill_to_city(star: DeliveryStar):
    parts = olap.measure_parts(star.order_parts("city_id"), ["city_id"])
    parts = olap.star_frame(parts, dim_city=star.dim_city)
    return rounded(olap.drill(parts, "city"), 9, "avg_delivery_time")


@query(
    "drill_to_agent",
    "AGG-11 PRJ-05",
    """SELECT agent_name AS label, round(avg(delivery_time_min), 9) AS avg_delivery_time
    FROM fact_delivery f LEFT JOIN dim_agent a ON f.agent_id = a.agent_id GROUP BY agent_name""",
)
def drill_to_agent(star: DeliveryStar):
    parts = olap.star_frame(star.agent_parts(), dim_agent=star.dim_agent)
    return rounded(olap.drill(parts, "agent_name"), 9, "avg_delivery_time")


LEVELS = """count(*)::BIGINT AS deliveries, round(avg(delivery_time_min), 9) AS avg_delivery_time,
    round(sum(delayed_flag) * 1.0::DOUBLE / count(*), 9) AS delay_rate"""


@query(
    "place_agent_rollup",
    "AGG-12",
    f"""SELECT region, city, agent_id, grouping(region, city, agent_id)::BIGINT AS level_id, {LEVELS}
    FROM fact_delivery JOIN dim_place USING (city_id) GROUP BY ROLLUP (region, city, agent_id)""",
)
def place_agent_rollup(star: DeliveryStar):
    parts = star.agent_parts("city_id").join(star.dim_place, "city_id")
    return _measured(olap.hierarchy_rollup(parts, ["region", "city", "agent_id"]))


@query(
    "city_traffic_weather_cube",
    "AGG-13",
    f"""SELECT city, traffic_level, weather, grouping(city, traffic_level, weather)::BIGINT
        AS level_id, {LEVELS}
    FROM fact_delivery JOIN dim_city USING (city_id) GROUP BY CUBE (city, traffic_level, weather)""",
)
def city_traffic_weather_cube(star: DeliveryStar):
    keys = ["city_id", "traffic_level", "weather"]
    parts = olap.measure_parts(star.order_parts(*keys), keys)
    parts = parts.join(star.dim_city, "city_id")
    return _measured(olap.dimension_cube(parts, ["city", "traffic_level", "weather"]))


def _refreshed(star: DeliveryStar, name: str) -> DataFrame:
    """Stored parts of a report: summed once over facts whose odd months still lack the delays,
    and then again for those months, after they were replaced by the right ones."""
    keys = standing.REPORTS[name]
    facts = star.deliveries(*dict.fromkeys(["time_id", *keys]), "delivery_time_min", "delayed_flag")
    facts = staged(facts.withColumn("month_id", (F.col("time_id") / 100).cast("int")), "facts")
    path, root = (scratch_path(star.spark, n) for n in ("month-facts", "month-parts"))
    odd = F.col("month_id") % 2 == 1
    first = facts.withColumn("delayed_flag", F.when(odd, F.lit(0)).otherwise(F.col("delayed_flag")))
    write_stage(first, path, ("month_id",))
    standing.refresh(star.spark, path, root, {name: keys})
    replace_folders(facts.where(odd), path, "month_id")
    standing.refresh(star.spark, path, root, {name: keys})
    return standing.parts_of(star.spark, root, name)


@query(
    "refreshed_city_months",
    "AGG-02 AGG-10 SNK-04",
    f"""SELECT city, year, month, {LEVELS} FROM fact_delivery JOIN dim_city USING (city_id)
    JOIN dim_time USING (time_id) GROUP BY city, year, month""",
)
def refreshed_city_months(star: DeliveryStar):
    named = _refreshed(star, "days").join(star.dim_city, "city_id").join(star.dim_time, "time_id")
    found = named.groupBy("city", "year", "month").agg(
        F.sum("row_count").alias("deliveries"), *olap.merged_measures()
    )
    return _measured(found)


@query(
    "refreshed_cube",
    "AGG-13",
    f"""SELECT city, traffic_level, weather, grouping(city, traffic_level, weather)::BIGINT
        AS level_id, {LEVELS}
    FROM fact_delivery JOIN dim_city USING (city_id) GROUP BY CUBE (city, traffic_level, weather)""",
)
def refreshed_cube(star: DeliveryStar):
    parts = _refreshed(star, "cells").join(star.dim_city, "city_id")
    return _measured(olap.dimension_cube(parts, ["city", "traffic_level", "weather"]))


@query(
    "diced_orders",
    "FLT-03 JOIN-03",
    f"""SELECT delivery_id, t.order_date, city, delivery_time_min FROM fact_delivery f
    JOIN dim_time t USING (time_id) JOIN dim_city USING (city_id)
    WHERE city IN ({CITY_LIST}) AND t.order_date BETWEEN DATE '{START}' AND DATE '{END}'""",
)
def diced_orders(star: DeliveryStar):
    frame = _frame(star, "delivery_id", "delivery_time_min")
    rows = olap.dice(frame, CITIES, START, END, dated_ids=True)
    return rows.select("delivery_id", "order_date", "city", "delivery_time_min")


@query(
    "key_figures",
    "AGG-15 FLT-03 FN-11 FN-12",
    f"""WITH figures AS (SELECT count(*) AS orders, round(avg(delayed_flag) * 100, 1) AS delay_pct,
        round(avg(customer_complaint) * 100, 1) AS complaint_pct
        FROM fact_delivery f JOIN dim_time t USING (time_id) JOIN dim_city USING (city_id)
        WHERE city IN ({CITY_LIST}) AND t.order_date BETWEEN DATE '{START}' AND DATE '{END}')
    SELECT orders, delay_pct, complaint_pct,
        regexp_replace(delay_pct::VARCHAR, '\\.0$', '') || '%' AS delay_label,
        regexp_replace(complaint_pct::VARCHAR, '\\.0$', '') || '%' AS complaint_label FROM figures""",
)
def key_figures(star: DeliveryStar):
    frame = _frame(star, "delayed_flag", "customer_complaint")
    figures = olap.key_figures(olap.dice(frame, CITIES, START, END, dated_ids=True))
    return figures.select(
        "orders",
        "delay_pct",
        "complaint_pct",
        percent_label(F.col("delay_pct")).alias("delay_label"),
        percent_label(F.col("complaint_pct")).alias("complaint_label"),
    )


@query(
    "filtered_rating",
    "AGG-16 FLT-03",
    f"""SELECT round(avg(rating), 1) AS avg_rating, count(rating) AS rated FROM fact_review
    JOIN dim_city USING (city_id) WHERE city IN ({CITY_LIST})
    AND order_date BETWEEN DATE '2001-06-10' AND DATE '2001-07-20'""",
)
def filtered_rating(star: DeliveryStar):
    reviews = star.plain_reviews.join(star.dim_city, "city_id")
    return olap.average_rating(olap.dice(reviews, CITIES, "2001-06-10", "2001-07-20"))


@query(
    "sliced_order_value",
    "FLT-04 PRJ-05",
    """SELECT t.order_date, city, traffic_level, order_value AS picked FROM fact_delivery f
    JOIN dim_time t USING (time_id) JOIN dim_city USING (city_id)
    WHERE traffic_level IN ('High', 'Low')""",
)
def sliced_order_value(star: DeliveryStar):
    frame = _frame(star, "traffic_level", "order_value")
    return olap.slice_and_pick(frame, ["High", "Low"], "order_value")


@query(
    "sliced_delivery_time",
    "FLT-04 PRJ-05",
    """SELECT t.order_date, city, traffic_level, delivery_time_min AS picked FROM fact_delivery f
    JOIN dim_time t USING (time_id) JOIN dim_city USING (city_id) WHERE traffic_level = 'Medium'""",
)
def sliced_delivery_time(star: DeliveryStar):
    frame = _frame(star, "traffic_level", "delivery_time_min")
    return olap.slice_and_pick(frame, ["Medium"], "delivery_time_min")


@query("city_choices", "AGG-17", "SELECT DISTINCT city FROM dim_city JOIN fact_delivery USING (city_id)")
def city_choices(star: DeliveryStar):
    return olap.choices(star.delivered_cities, "city")


@query(
    "event_volume",
    "AGG-19",
    """SELECT CAST(ts AS DATE) AS day, event_type, round(sum(value), 6) AS volume FROM events
    GROUP BY 1, 2""",
)
def event_volume(star: DeliveryStar):
    return rounded(olap.volume_by(star.web_events, ["day", "event_type"], "volume"), 6, "volume")


@query(
    "ranked_cities",
    "TOP-06 AGG-01",
    """SELECT city, round(avg(delivery_time_min), 9) AS avg_delivery_time FROM fact_delivery
    JOIN dim_city USING (city_id) GROUP BY city ORDER BY avg_delivery_time, city""",
)
def ranked_cities(star: DeliveryStar):
    parts = olap.measure_parts(star.order_parts("city_id"), ["city_id"])
    named = parts.join(star.dim_city, "city_id").groupBy("city").agg(*olap.merged_measures())
    means = rounded(named.select("city", "avg_delivery_time"), 9, "avg_delivery_time")
    return means.orderBy("avg_delivery_time", "city")


@query(
    "latest_orders_preview",
    "TOP-05 PRJ-04",
    """SELECT city_id, order_value, traffic_level FROM fact_delivery
    ORDER BY delivery_id, order_value, traffic_level, city_id LIMIT 50""",
)
def latest_orders_preview(star: DeliveryStar):
    wanted = ["city_id", "order_value", "order_segment", "traffic_level", "PC1", "PC2"]
    frame = star.deliveries("delivery_id", "city_id", "order_value", "traffic_level")
    first = frame.orderBy("delivery_id", "order_value", "traffic_level", "city_id").limit(50)
    return olap.keep_known(first, wanted)


@query(
    "orders_with_city_lookup",
    "JOIN-09 JOIN-08",
    """SELECT delivery_id, city_id, city FROM fact_delivery LEFT JOIN dim_city USING (city_id)""",
)
def orders_with_city_lookup(star: DeliveryStar):
    facts = star.deliveries("delivery_id", "city_id")
    return olap.natural_left_join(facts, star.dim_city).select("delivery_id", "city_id", "city")
