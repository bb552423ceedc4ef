"""Catalog metadata, flat prices and column layout of observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from almanac.operators.joins import lookup_join
from almanac.schemas import OBSERVATION, PRICE_COLUMNS

META = ["symbol", "indicator_name", "category", "region", "refresh", "source", "unit"]


def flat_prices(df: DataFrame) -> DataFrame:
    """A one-value observation: all prices equal ``close``, no volume."""
    flat = {c: F.col("close") for c in ("open", "high", "low", "adj_close")}
    return df.withColumns({**flat, "volume": F.lit(None).cast("double")})


def with_constants(df: DataFrame, values: dict[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(value) for name, value in values.items()})


def align(df: DataFrame, schema=OBSERVATION, keep: tuple[str, ...] = ()) -> DataFrame:
    """Exactly the columns of ``schema``, in order; absent ones become NULL, others go."""
    have = set(df.columns)
    wanted = [
        F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
        for f in schema.fields
    ]
    return df.select(*wanted, *[c for c in keep if c in have])


def metadata(catalog: DataFrame, key: str = "symbol") -> DataFrame:
    """The catalog columns an observation carries; ``refresh`` and ``unit`` default to ''."""
    return catalog.select(
        key,
        F.col("name").alias("indicator_name"),
        "category",
        "region",
        F.coalesce("refresh", F.lit("")).alias("refresh"),
        "source",
        F.coalesce("unit", F.lit("")).alias("unit"),
    )


def enrich(raw: DataFrame, catalog: DataFrame, small: bool = False) -> DataFrame:
    """Attach metadata by ``symbol`` and project to the observation layout (``seq`` stays)."""
    raw = raw.drop(*[c for c in META if c != "symbol"])
    joined = lookup_join(raw, metadata(catalog), "symbol", "inner", small)
    missing = {c: F.lit(None).cast("double") for c in PRICE_COLUMNS if c not in joined.columns}
    return align(joined.withColumns(missing) if missing else joined, keep=("seq",))
