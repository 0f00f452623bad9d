"""Explicit schemas of the star schema and of the raw review file."""

from __future__ import annotations

from pyspark.sql import types as T

INT, LONG, DOUBLE = T.IntegerType(), T.LongType(), T.DoubleType()
STRING, DATE, BOOLEAN = T.StringType(), T.DateType(), T.BooleanType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


DIM_TIME = _struct(
    time_id=INT, order_date=DATE, year=INT, month=INT, day=INT, year_month=STRING, weekday=STRING
)
DIM_CITY = _struct(city_id=INT, city=STRING)
DIM_AGENT = _struct(agent_key=INT, agent_id=STRING, agent_name=STRING)
FACT_DELIVERY = _struct(
    delivery_id=LONG,
    time_id=INT,
    city_id=INT,
    agent_id=STRING,
    distance_km=DOUBLE,
    delivery_time_min=DOUBLE,
    sla_min=INT,
    delayed_flag=INT,
    traffic_level=STRING,
    weather=STRING,
    vehicle_type=STRING,
    is_festival=BOOLEAN,
)
FACT_REVIEW = _struct(
    review_id=LONG,
    time_id=INT,
    city_id=INT,
    agent_key=INT,
    rating=DOUBLE,
    order_accuracy=DOUBLE,
    product_availability=DOUBLE,
    discount_applied=INT,
    price_range=STRING,
    review_text=STRING,
)

# Column titles of the raw review file: fixed values. Everything is read as text
# and converted later, so that one bad cell costs one NULL and not the row.
RAW_REVIEW_COLUMNS = (
    "Agent Name",
    "Rating",
    "Review Text",
    "Delivery Time (min)",
    "Location",
    "Order Type",
    "Customer Feedback Type",
    "Price Range",
    "Discount Applied",
    "Product Availability",
    "Customer Service Rating",
    "Order Accuracy",
)
RAW_REVIEW = T.StructType([T.StructField(name, STRING) for name in RAW_REVIEW_COLUMNS])
