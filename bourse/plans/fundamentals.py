"""Per-ticker fundamental features.

Each source is reduced to one row per ticker by a partial (map-side)
aggregation; the per-source rows are then stacked with ``unionByName`` and
collapsed by ONE ``groupBy(ticker)`` -- one shuffle for all sources instead
of a chain of outer joins.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import days_to_first, guarded_margin, round6, safe_div

# Statement line items the reference reads, by role.
STATEMENT_ITEMS = {
    "total_assets": "TotalAssets",
    "total_liabilities": "TotalLiabilitiesNetMinorityInterest",
    "total_equity": "StockholdersEquity",
    "long_term_debt": "LongTermDebt",
    "current_assets": "CurrentAssets",
    "current_liabilities": "CurrentLiabilities",
    "cash": "CashAndCashEquivalents",
    "retained_earnings": "RetainedEarnings",
    "working_capital": "WorkingCapital",
    "operating_cf": "OperatingCashFlow",
    "free_cf": "FreeCashFlow",
    "revenue": "TotalRevenue",
}
# Roles read as "latest value including null" (W11); the rest use the
# latest non-null value.
LATEST_WITH_NULL = ("operating_cf", "free_cf")
RECENT_PERIODS = ("0m", "-1m", "-2m", "-3m")
RATING_COLUMNS = ("strong_buy", "buy", "hold", "sell", "strong_sell")

# The statements fixture names its items by return flag + line status.
FIXTURE_ITEMS = {
    "total_assets": "NF",
    "total_liabilities": "RF",
    "total_equity": "NO",
    "long_term_debt": "RO",
    "current_assets": "AF",
    "current_liabilities": "AO",
    "cash": "RF",
    "retained_earnings": "NO",
    "working_capital": "NF",
    "operating_cf": "AF",
    "free_cf": "NF",
    "revenue": "AO",
}
# For the per-ticker sources the cash flow is an item whose newest value is known.
TICKER_ITEMS = FIXTURE_ITEMS | {"operating_cf": "RO"}

FUNDAMENTAL_COLUMNS = [
    "debt_to_equity", "current_ratio", "cash_ratio", "working_capital", "working_capital_ratio",
    "retained_earnings_to_assets", "long_term_debt_to_equity", "operating_cf_margin",
    "free_cf_margin", "pct_held_by_inst", "institutional_holders_count", "recent_rating_changes",
    "strong_to_total_reco_ratio", "days_to_next_earnings", "dividend_stability",
]


def latest_items(statements: DataFrame, items: dict[str, str] = STATEMENT_ITEMS) -> DataFrame:
    """W10 / W11 for every role in one pass: ``max_by(value, asof)`` with and
    without the non-null filter, one conditional aggregate per role."""
    aggs = []
    for role, item in items.items():
        is_item = F.col("item") == item
        if role in LATEST_WITH_NULL:
            order = F.when(is_item, F.col("asof"))
        else:
            order = F.when(is_item & F.col("value").isNotNull(), F.col("asof"))
        aggs.append(F.max_by("value", order).alias(role))
    return (
        statements.where(F.col("item").isin(list(set(items.values()))))
        .groupBy("ticker")
        .agg(*aggs)
    )


def statement_ratios(latest: DataFrame) -> DataFrame:
    """F03 guarded ratios and F04 guarded margins."""
    c = F.col
    return latest.select(
        "ticker",
        safe_div("total_liabilities", "total_equity").alias("debt_to_equity"),
        safe_div("current_assets", "current_liabilities").alias("current_ratio"),
        safe_div("cash", "current_liabilities").alias("cash_ratio"),
        c("working_capital"),
        safe_div("working_capital", "total_assets").alias("working_capital_ratio"),
        safe_div("retained_earnings", "total_assets").alias("retained_earnings_to_assets"),
        safe_div("long_term_debt", "total_equity").alias("long_term_debt_to_equity"),
        guarded_margin("operating_cf", "revenue").alias("operating_cf_margin"),
        guarded_margin("free_cf", "revenue").alias("free_cf_margin"),
    )


# The ESG items the reference reads, by output column.
ESG_ITEMS = {"esg_env": "environmentScore", "esg_soc": "socialScore", "esg_gov": "governanceScore"}


def esg_scores(esg: DataFrame, items: dict[str, str] = ESG_ITEMS) -> DataFrame:
    """S09 + W11: one row per ticker with each item's value (null kept);
    one conditional aggregate per item in a single pass."""
    return esg.groupBy("ticker").agg(
        *[F.max(F.when(F.col("item") == item, F.col("value"))).alias(name) for name, item in items.items()]
    )


def holder_stats(holders: DataFrame) -> DataFrame:
    """Mean share held and number of holders."""
    return holders.groupBy("ticker").agg(
        F.avg("pct_held").alias("pct_held_by_inst"),
        F.count(F.lit(1)).alias("institutional_holders_count"),
    )


def rating_stats(recs: DataFrame) -> DataFrame:
    """Ratings over the recent periods and the strong-buy share.

    The reference leaves the share unbound when a ticker has no rating rows
    (and then loses all its fundamentals); we return null.
    """
    recent = F.col("period").isin(*RECENT_PERIODS)
    total = sum(F.col(c) for c in RATING_COLUMNS)
    g = recs.groupBy("ticker").agg(
        F.sum(F.when(recent, total).otherwise(0)).alias("_total"),
        F.sum(F.when(recent, F.col("strong_buy")).otherwise(0)).alias("_strong"),
    )
    return g.select(
        "ticker",
        F.col("_total").alias("recent_rating_changes"),
        F.when(F.col("_total") != 0, F.try_divide(F.col("_strong"), F.col("_total"))).alias("strong_to_total_reco_ratio"),
    )


def earnings_days(calendar: DataFrame, end_date: str) -> DataFrame:
    """days from the end date to the first listed earnings date.

    Long calendar ``(ticker, earnings_date)``: the first date is a ``min``
    (partial aggregate).  An array column ``earnings_dates`` (the reference's
    shape) is read at element 0 instead."""
    end = F.to_date(F.lit(end_date))
    if "earnings_dates" in calendar.columns:
        return calendar.select("ticker", days_to_first("earnings_dates", end).alias("days_to_next_earnings"))
    first = calendar.groupBy("ticker").agg(F.min("earnings_date").alias("_first"))
    return first.select("ticker", F.datediff("_first", end).cast("double").alias("days_to_next_earnings"))


def yearly_dividends(dividends: DataFrame) -> DataFrame:
    """Dividend sum per calendar year, dense -- a year without a
    dividend between a ticker's first and last dividend year counts as 0."""
    yearly = dividends.groupBy("ticker", F.year("date").alias("year")).agg(F.sum("amount").alias("amount"))
    rng = yearly.groupBy("ticker").agg(F.min("year").alias("lo"), F.max("year").alias("hi"))
    years = rng.select("ticker", F.explode(F.sequence("lo", "hi")).alias("year"))
    return years.join(yearly, ["ticker", "year"], "left").select(
        "ticker", "year", F.coalesce("amount", F.lit(0.0)).alias("amount")
    )


def dividend_stability(dividends: DataFrame) -> DataFrame:
    """Coefficient of variation of the dense yearly sums (std with
    n - 1); null with one year or a zero mean."""
    y = yearly_dividends(dividends)
    g = y.groupBy("ticker").agg(
        F.count("amount").alias("n"), F.stddev_samp("amount").alias("sd"), F.avg("amount").alias("mean")
    )
    return g.select(
        "ticker",
        F.when((F.col("n") > 1) & (F.col("mean") != 0), F.try_divide(F.col("sd"), F.col("mean"))).alias("dividend_stability"),
    )


def fundamental_features(
    statements: DataFrame,
    profile: DataFrame,
    holders: DataFrame,
    recommendations: DataFrame,
    dividends: DataFrame,
    calendar: DataFrame,
    end_date: str,
    items: dict[str, str] = STATEMENT_ITEMS,
    esg: DataFrame | None = None,
) -> DataFrame:
    """One row per ticker seen in any source.  The cash-flow margins
    divide by the profile's revenue where the profile has one."""
    latest = latest_items(statements, items)
    ratios = statement_ratios(latest)
    by_profile = "revenue" in profile.columns
    if by_profile:
        ratios = ratios.drop("operating_cf_margin", "free_cf_margin")
    parts = [
        ratios,
        holder_stats(holders),
        rating_stats(recommendations),
        earnings_days(calendar, end_date),
        dividend_stability(dividends),
        profile.drop("days_to_next_earnings"),
    ]
    if by_profile:
        parts.append(latest.select("ticker", "operating_cf", "free_cf"))
    if esg is not None:
        parts.append(esg_scores(esg))
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    value_cols = [c for c in stacked.columns if c != "ticker"]
    out = stacked.groupBy("ticker").agg(*[F.max(c).alias(c) for c in value_cols])
    if by_profile:
        out = out.withColumns({f"{c}_margin": guarded_margin(c, "revenue") for c in ("operating_cf", "free_cf")}).drop(
            "operating_cf", "free_cf", "revenue")
    out = out.withColumn("recent_rating_changes", F.coalesce("recent_rating_changes", F.lit(0).cast("bigint")))
    return out.withColumns({c: round6(c) for c, t in out.dtypes if t == "double"})


def missing_per_ticker(fund: DataFrame) -> DataFrame:
    """Number of missing fundamentals per ticker."""
    cols = [c for c in fund.columns if c != "ticker"]
    return fund.select("ticker", sum(F.col(c).isNull().cast("int") for c in cols).alias("missing_count"))

