"""Generated tables, computed from row ids.

Each function takes a table with an ``id`` column, so it can fill in data for
existing keys or, over ``id_range``, make a table of any size. Values depend
on the id alone: the result is the same for any number of partitions and when
a lost task runs again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rowcast.functions import draws
from rowcast.operators.bank import risk_class

# Names, places and codes to choose from.
FIRST_NAMES = ["Jan", "Anna", "Ewa", "Piotr", "Krzysztof", "Maria", "Tomasz", "Agnieszka"]
LAST_NAMES = [
    "Nowak", "Kowalski", "Wiśniewski", "Wójcik", "Kamińska", "Lewandowski", "Zieliński",
]
CITIES = ["Warszawa", "Kraków", "Gdańsk", "Poznań", "Wrocław", "Lublin", "Szczecin", "Katowice"]
SEGMENTS = ["RETAIL", "VIP", "SME"]
CHANNELS = ["ATM", "POS", "ONLINE"]
COUNTRIES = ["PL", "DE", "US", "GB", "FR", "CZ"]
CATEGORIES = ["A", "B", "C"]
DAY = "2025-11-27"
MAX_ITEMS = 5
# Product, lowest and highest price.
PRODUCTS = [
    ("Laptop", 3200, 6500),
    ("Telefon", 1200, 4200),
    ("Mysz", 40, 200),
    ("Klawiatura", 80, 600),
    ("Monitor", 500, 2500),
    ("Słuchawki", 100, 900),
    ("Powerbank", 50, 400),
    ("Kabel USB", 10, 80),
]


def id_range(spark: SparkSession, count: int, start: int = 1) -> DataFrame:
    return spark.range(start, start + count)


def customers(ids: DataFrame) -> DataFrame:
    """Customers with a city and a segment."""
    return ids.select(
        F.col("id").alias("customer_id"),
        draws.pick(FIRST_NAMES, "id", 1).alias("first_name"),
        draws.pick(LAST_NAMES, "id", 2).alias("last_name"),
        draws.pick(CITIES, "id", 3).alias("city"),
        draws.pick(SEGMENTS, "id", 4).alias("segment"),
    )


def _cents(stream: int, low: int, high: int):
    return (draws.below("id", stream, (high - low) * 100 + 1) + low * 100) / 100.0


def orders(ids: DataFrame, customer_count: int) -> DataFrame:
    """Orders of 100 to 2000 spread evenly over customers."""
    return ids.select(
        F.col("id").alias("order_id"),
        (draws.below("id", 11, customer_count) + 1).cast("int").alias("customer_id"),
        _cents(12, 100, 2000).alias("order_amount"),
    )


def payments(ids: DataFrame) -> DataFrame:
    """One payment per order: a tenth unpaid, a tenth half paid, the rest in full."""
    share = draws.below("id", 21, 1000)
    return ids.select(
        F.col("id").alias("order_id"),
        F.when(share < 100, 0.0).when(share < 200, 0.5).otherwise(1.0).alias("paid_ratio"),
    )


def transactions(ids: DataFrame, customer_count: int) -> DataFrame:
    """Transactions of 10 to 10000 within one day."""
    return ids.select(
        F.col("id").alias("tx_id"),
        (draws.below("id", 31, customer_count) + 1).cast("int").alias("customer_id"),
        _cents(32, 10, 10000).alias("amount"),
        draws.pick(CHANNELS, "id", 33).alias("channel"),
        draws.pick(COUNTRIES, "id", 34).alias("country"),
        F.to_timestamp_ntz(draws.clock_text(DAY, "id", 35)).alias("tx_timestamp"),
    )


def alerts(ids: DataFrame, customer_count: int) -> DataFrame:
    """Alerts scored 0 to 1 in thousandths, with their class."""
    scored = ids.select(
        F.col("id").alias("alert_id"),
        (draws.below("id", 41, customer_count) + 1).cast("int").alias("customer_id"),
        (draws.below("id", 42, 1001) / 1000.0).alias("risk_score"),
        F.to_timestamp_ntz(draws.clock_text(DAY, "id", 43)).alias("created_at"),
    )
    return scored.withColumn("risk_class", risk_class(F.col("risk_score")))


def nested_orders(ids: DataFrame) -> DataFrame:
    """Orders with one to five items; one in twenty has none.

    Five items are drawn as plain columns and the array is cut to the drawn
    length, which keeps the work in generated code.
    """
    names = F.array(*[F.lit(name) for name, _, _ in PRODUCTS])
    lows = F.array(*[F.lit(low * 100).cast("bigint") for _, low, _ in PRODUCTS])
    spans = F.array(*[F.lit((high - low) * 100 + 1).cast("bigint") for _, low, high in PRODUCTS])
    slots = range(1, MAX_ITEMS + 1)

    # One draw per item gives its product, quantity and price in turn, and one
    # per order its names, city and item count. Fewer draws keep the generated
    # method short enough to be compiled at run time.
    drawn = {f"_item{i}": draws.draw(F.col("id") * 8 + i, 51) for i in slots}
    drawn["_head"] = draws.draw("id", 55)
    head = F.col("_head")

    def whole(value, divisor):
        return F.call_function("div", value, F.lit(divisor).cast("bigint"))

    def item(i):
        value = F.col(f"_item{i}")
        kind = (value % len(PRODUCTS)).cast("int")
        above = whole(value, 5 * len(PRODUCTS)) % F.get(spans, kind)
        return F.struct(
            F.get(names, kind).alias("product"),
            (whole(value, len(PRODUCTS)) % 5 + 1).alias("qty"),
            ((F.get(lows, kind) + above) / 100.0).alias("price"),
        )

    def listed(values, before):
        position = whole(head, before) % len(values)
        return F.get(F.array(*[F.lit(value) for value in values]), position.cast("int"))

    cities_from = len(FIRST_NAMES) * len(LAST_NAMES)
    count_from = cities_from * len(CITIES)
    filled = whole(head, count_from) % MAX_ITEMS + 1
    count = F.when(whole(head, count_from * MAX_ITEMS) % 20 == 0, 0).otherwise(filled)

    return (
        ids.select("id")
        .withColumns(drawn)
        .select(
            F.col("id").alias("order_id"),
            F.struct(
                (draws.below("id", 56, 900_000) + 100_000).alias("id"),
                listed(FIRST_NAMES, 1).alias("name"),
                listed(LAST_NAMES, len(FIRST_NAMES)).alias("surname"),
            ).alias("customer"),
            F.slice(F.array(*[item(i) for i in slots]), F.lit(1), count.cast("int")).alias("items"),
            listed(CITIES, cities_from).alias("city"),
        )
    )


def numeric(ids: DataFrame, mean: float = 100.0, deviation: float = 20.0) -> DataFrame:
    """A normally distributed value and a category."""
    return ids.select(
        "id",
        draws.normal("id", 61, mean, deviation).alias("value"),
        draws.pick(CATEGORIES, "id", 63).alias("category"),
    )
