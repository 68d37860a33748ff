"""The ticker universe -- top N listings by market cap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import clean_market_cap


def top_tickers(listing: DataFrame, n: int = 24, scale_suffix: bool = False) -> DataFrame:
    """P05 + T01: clean the market-cap text, keep the N largest (nulls last;
    ties broken by symbol, the reference's sort is unstable).  Planned as
    TakeOrderedAndProject: each task keeps its own top N, the driver merges
    N rows per task -- no global sort."""
    return (
        listing.withColumn("market_cap_value", clean_market_cap("market_cap", scale_suffix))
        .orderBy(F.col("market_cap_value").desc_nulls_last(), "symbol")
        .limit(n)
    )


def ticker_list(listing: DataFrame, n: int = 24) -> DataFrame:
    """The universe as a one-column DataFrame, for ``left_semi`` filters."""
    return top_tickers(listing, n).select(F.col("symbol").alias("ticker"))
