"""Column expressions shared by the marts, features and streams. All stay inside codegen."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

MONEY = "decimal(18,4)"

# First year after each era.
ERA_ENDS = [(2000, "90s"), (2010, "00s"), (2020, "10s")]
LAST_ERA = "20s"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def release_era(year: Column | str) -> Column:
    """Open-ended bins; an unknown year falls to the last era, as a CASE without a NULL branch does."""
    ladder = reduce(lambda acc, end: acc.when(col(year) < end[0], end[1]), ERA_ENDS, F)
    return ladder.otherwise(LAST_ERA)


def launch_era(year: Column | str) -> Column:
    """Right-closed bins (1989, 1999] ... (2019, 2029]; anything outside, or unknown, is NULL."""
    return F.when(col(year).between(1990, 2029), release_era(year))


def net_revenue(price: Column | str, quantity: Column | str, discount: Column | str) -> Column:
    kept = F.lit(1) - F.coalesce(col(discount), F.lit(0.0))
    return F.round(col(price) * col(quantity) * kept, 4)


def exact_sum(c: Column | str) -> Column:
    """Sum in decimal, so the result does not depend on the order of partial sums."""
    return F.sum(col(c).cast(MONEY))


def as_double(c: Column | str) -> Column:
    return col(c).cast("double")


def ratio(top: Column | str, bottom: Column | str) -> Column:
    """Double division that yields NULL on a zero denominator."""
    return F.try_divide(as_double(top), as_double(bottom))


def upper_trim(c: Column | str) -> Column:
    return F.upper(F.trim(col(c)))


def confidence(purchases: Column | str, spend: Column | str) -> Column:
    return F.log1p(col(purchases)) + F.log1p(col(spend) / F.lit(10.0))


def risk_band(probability: Column | str) -> Column:
    p = col(probability)
    return F.when(p > 0.7, "HIGH").when(p > 0.4, "MEDIUM").otherwise("LOW")


def document_text(*columns: str) -> Column:
    """Catalog text for embedding; a missing part stays as an empty part."""
    return F.concat_ws(" — ", *[F.coalesce(F.col(c), F.lit("")) for c in columns])


def parsed_once(text: Column | str, schema: StructType, options: dict[str, str] | None = None) -> Column:
    """``from_json`` as a generator of one row.

    Later filters on the parsed fields stop at a generator. Through a plain projection they would
    be pushed down with a copy of the parser for every field they test.
    """
    return F.explode(F.array(F.from_json(text, schema, options)))
