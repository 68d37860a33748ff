"""Query registry: one Spark query and one DuckDB oracle per inventory row.

Every query reads the given parquet tables (or tables Spark derives from
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .plans import price
from .session import tune
from .sources import tables as src
from .sql import fixtures as fx
from .sql import price as price_sql

Query = Callable[[SparkSession, str], DataFrame]

_QUERIES: dict[str, Query] = {}
_ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(tune(spark), sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        _QUERIES[name] = run
        if sql is not None:
            _ORACLE[name] = sql
        return fn

    return deco


def queries() -> dict[str, Query]:
    _load()
    return dict(_QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(_ORACLE)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price.price_features(src.bars(tune(spark), sf_dir))


_LOADED = False


def _load() -> None:
    global _LOADED
    if _LOADED:
        return
    _LOADED = True
    from . import queries_catalog, queries_learning  # noqa: F401  (register everything)


# ---------------------------------------------------------------- sources


def _source(name: str, fn, sql: str):
    register(name, sql)(lambda spark, d: fn(spark, d))


_source("S01_src_bars", src.bars, fx.bars("type"))
_source("S02_src_listing", src.listing, fx.LISTING)
_source("S10_src_macro", src.macro, fx.MACRO)
_source("S11_src_market", src.market, fx.MARKET)
_source("S03_src_statements", src.statements, fx.STATEMENTS)
_source("S04_src_profile", src.profile, fx.PROFILE)
_source("S05_src_holders", src.holders, fx.HOLDERS)
_source("S09_src_esg", src.esg, fx.ESG)
_source("S06_src_recommendations", src.recommendations, fx.RECOMMENDATIONS)
_source("S07_src_dividends", src.dividends, fx.DIVIDENDS)
_source("S08_src_calendar", src.calendar, fx.CALENDAR)
_source("src_predictions", src.predictions, fx.PREDICTIONS)
_source("src_vectors", src.vectors, fx.VECTORS)


# ---------------------------------------------------------------- C01


@register("C01_price_features", price_sql.price_sql("type"))
def _c01(spark, d):
    return price.price_features(src.bars(spark, d))


@register(
    "G01_month_end_resample",
    fx.with_tables(
        "SELECT ticker, date, "
        + ", ".join(fx.r6(c) + f" AS {c}" for c in price_sql.AGG_COLS)
        + " FROM monthly",
        **price_sql.monthly_agg_ctes("type"),
    ),
)
def _g01(spark, d):
    m = price.month_end_resample(price.daily_features(price.by_ticker(src.bars(spark, d))))
    return m.select("ticker", "date", *[price.round6(c).alias(c) for c in price.MONTHLY_AGG_COLUMNS])
