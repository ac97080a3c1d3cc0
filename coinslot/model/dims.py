"""The two reference dimensions.

They are SQL ``VALUES`` relations, so the planner knows their exact size, folds projections into
them and broadcasts them by its own size check; nothing has to be shipped from Python.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from coinslot.functions.expr import launch_era

# Console code, family, generation, launch year.
CONSOLES = [
    ("PS", "PlayStation", 5, 1994),
    ("PS2", "PlayStation", 6, 2000),
    ("PS3", "PlayStation", 7, 2006),
    ("PS4", "PlayStation", 8, 2013),
    ("PS5", "PlayStation", 9, 2020),
    ("PSP", "PlayStation", None, 2004),
    ("PSV", "PlayStation", None, 2011),
    ("XB", "Xbox", 6, 2001),
    ("X360", "Xbox", 7, 2005),
    ("XOne", "Xbox", 8, 2013),
    ("XS", "Xbox", 9, 2020),
    ("XBL", "Xbox", None, None),
]

# Channel code, type, description, shippable.
CHANNELS = [
    ("physical_retail", "PHYSICAL", "Boxed disc/cartridge bought in store", True),
    ("physical_online", "PHYSICAL", "Boxed copy shipped from an online retailer", True),
    ("digital_store", "DIGITAL", "PS Store / Microsoft Store download", False),
    ("membership_included", "MEMBERSHIP", "Title claimed via PS Plus / Game Pass", False),
    ("membership_fee", "MEMBERSHIP", "Recurring subscription charge", False),
    ("console_hardware", "HARDWARE", "Console purchase (PS/Xbox SKU)", True),
]


def _literal(value) -> str:
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).lower()
    return f"'{value}'" if isinstance(value, str) else str(value)


def _values(spark: SparkSession, rows: list[tuple], columns: str) -> DataFrame:
    body = ", ".join("(" + ", ".join(map(_literal, row)) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({columns})")


def dim_console(spark: SparkSession) -> DataFrame:
    return _values(spark, CONSOLES, "platform_code, console_family, generation, launch_year").select(
        "platform_code",
        "console_family",
        F.col("generation").cast("smallint").alias("generation"),
        F.col("launch_year").cast("smallint").alias("launch_year"),
        launch_era("launch_year").alias("era"),
    )


def dim_channel(spark: SparkSession) -> DataFrame:
    return _values(spark, CHANNELS, "channel_code, channel_type, description, is_shippable")
