"""Input tables of the engine, derived from the given parquet tables.

The engine's inputs are long, keyed tables (see the schemas below).  For the
test data they are derived from the TPC-H-like tables with plain DataFrame
code; every derivation is a scan + join + partial aggregation, so its cost
grows with the scanned tables and it never funnels a key through one task
(aggregates are partial, joins are left to AQE: it broadcasts only what the
runtime statistics show to be small and splits skewed partitions).

Schemas (all dates are DATE, all measures DOUBLE, NaN never enters):

* bars(ticker, date, open, high, low, close, volume)
* listing(symbol, company, market_cap string)
* macro(series, date, value) -- monthly / quarterly, first-of-period dates
* market(series, date, value) -- daily
* statements(ticker, item, asof, value)
* profile(ticker, sector, industry, country, trailing_peg, esg_env,
  dividend_yield, days_to_next_earnings)
* esg(ticker, item, value)
* holders(ticker, holder, pct_held)
* recommendations(ticker, period, strong_buy, buy, hold, sell, strong_sell)
* dividends(ticker, date, amount)
* calendar(ticker, earnings_date) -- long form of the reference's date list
* predictions(id, label, prediction, probability)
* vectors(id, features array<float>, label, split)
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Ticker domains for the bars derivation: one ticker per part type (6 keys,
# correctness runs) or per brand and type (150 keys, bench).
TICKER_KEYS = {
    "type": lambda: F.col("p_type"),
    "brand_type": lambda: F.concat(F.col("p_brand"), F.lit("/"), F.col("p_type")),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _nan_to_null(df: DataFrame, cols) -> DataFrame:
    """NaN never enters the engine: every double source column goes through
    ``nanvl(c, null)`` once."""
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in cols})


# Largest value of each line key that fits its digits of the order key.
SEQ_DIGITS = {"l_orderkey": 14, "l_linenumber": 4, "l_partkey": 10, "l_suppkey": 10}


def trade_order() -> Column:
    """The four line keys as one decimal(38,0) with the same order.  A key that
    is negative or has more digits than its field raises instead of wrapping."""
    out = None
    for c, digits in SEQ_DIGITS.items():
        key = F.col(c).cast("bigint")
        fits = key.between(0, 10 ** digits - 1) | key.isNull()
        key = F.when(fits, key).otherwise(F.raise_error(F.lit(f"{c} does not fit {digits} digits")).cast("bigint")).cast(f"decimal({digits},0)")
        out = key if out is None else (out * F.lit(Decimal(10 ** digits)) + key).cast("decimal(38,0)")
    return out


def bars(spark: SparkSession, sf_dir: str, ticker: str = "type") -> DataFrame:
    """Daily OHLCV bars: one row per (ticker, day).

    open/close are the first/last trade of the day under a total order of the
    four line keys; a ticker therefore never has more than one row per
    calendar day, which bounds every per-ticker window downstream.  First and
    last are the minimum and maximum of (order key, price), both of fixed
    width, so the partial aggregate hashes and no task sorts its trades.
    """
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        "l_quantity", "l_extendedprice", "l_shipdate",
    )
    part = table(spark, sf_dir, "part").select(
        "p_partkey", TICKER_KEYS[ticker]().alias("ticker")
    )
    trades = li.join(part, li.l_partkey == part.p_partkey).select(
        "ticker",
        F.to_date("l_shipdate").alias("date"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("px"),
        F.col("l_quantity").alias("qty"),
        trade_order().alias("seq"),
    )
    out = trades.groupBy("ticker", "date").agg(
        F.min_by("px", "seq").alias("open"),
        F.max("px").alias("high"),
        F.min("px").alias("low"),
        F.max_by("px", "seq").alias("close"),
        F.sum("qty").alias("volume"),
    )
    return _nan_to_null(out, ["open", "high", "low", "close", "volume"])


def listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing table with market cap as text; one in ten does not parse."""
    s = table(spark, sf_dir, "supplier")
    cap = F.when(F.col("s_suppkey") % 10 == 9, F.lit("n/a")).otherwise(
        F.concat(
            F.lit("$"),
            F.floor("s_acctbal").cast("bigint").cast("string"),
            F.when(F.col("s_suppkey") % 2 == 0, F.lit("B")).otherwise(F.lit("M")),
        )
    )
    return s.select(
        F.col("s_name").alias("symbol"),
        F.concat(F.lit("Company "), F.col("s_suppkey").cast("string")).alias("company"),
        cap.alias("market_cap"),
    )


def macro(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly macro series; two series are quarterly so forward fill has work."""
    o = table(spark, sf_dir, "orders")
    keep = (~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")) | F.month("o_orderdate").isin(1, 4, 7, 10)
    return (
        o.filter(keep)
        .groupBy(
            F.col("o_orderpriority").alias("series"),
            F.trunc(F.to_date("o_orderdate"), "month").alias("date"),
        )
        .agg(F.round(F.sum("o_totalprice"), 2).alias("value"))
    )


def market(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily market / index series."""
    o = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return (
        o.join(c, o.o_custkey == c.c_custkey)
        .groupBy(F.col("c_mktsegment").alias("series"), F.to_date("o_orderdate").alias("date"))
        .agg(F.max("o_totalprice").alias("value"))
    )


def statements(spark: SparkSession, sf_dir: str, ticker: str = "type") -> DataFrame:
    """Long statement table; the newest value of the A-items is null."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_returnflag", "l_linestatus", "l_shipdate", "l_extendedprice"
    )
    part = table(spark, sf_dir, "part").select("p_partkey", TICKER_KEYS[ticker]().alias("ticker"))
    j = li.join(part, li.l_partkey == part.p_partkey).select(
        "ticker",
        "l_returnflag",
        "l_linestatus",
        F.year("l_shipdate").alias("yr"),
        "l_extendedprice",
    )
    g = j.groupBy("ticker", "l_returnflag", "l_linestatus", "yr").agg(
        F.max("l_extendedprice").alias("mx")
    )
    return g.select(
        "ticker",
        F.concat("l_returnflag", "l_linestatus").alias("item"),
        F.make_date("yr", F.lit(12), F.lit(31)).alias("asof"),
        F.when((F.col("l_returnflag") == "A") & (F.col("yr") == 2001), F.lit(None).cast("double"))
        .otherwise(F.col("mx"))
        .alias("value"),
    )


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    k = F.col("c_custkey")

    def nullable(mod: int, expr: Column) -> Column:
        return F.when(k % mod == 0, F.lit(None).cast("double")).otherwise(expr)

    return (
        c.join(n, c.c_nationkey == n.n_nationkey)
        .join(r, n.n_regionkey == r.r_regionkey)
        .select(
            k.cast("string").alias("ticker"),
            F.col("r_name").alias("sector"),
            F.col("c_mktsegment").alias("industry"),
            F.col("n_name").alias("country"),
            nullable(7, F.col("c_acctbal") / 1000).alias("trailing_peg"),
            nullable(5, F.col("c_acctbal") / 500).alias("esg_env"),
            nullable(3, F.col("c_acctbal") / 10000).alias("dividend_yield"),
            nullable(11, (k % 66).cast("double")).alias("days_to_next_earnings"),
        )
    )


ESG_ITEMS = [("environmentScore", 1, 500.0), ("socialScore", 2, 700.0), ("governanceScore", 3, 900.0)]


def esg(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ESG scores in long form (ticker, item, value); about one score in four
    is missing.  One row per customer exploded into three -- no join."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    rows = F.array(*[
        F.struct(
            F.lit(item).alias("item"),
            F.when((k + shift) % 4 == 0, F.lit(None).cast("double")).otherwise(F.col("c_acctbal") / div).alias("value"),
        )
        for item, shift, div in ESG_ITEMS
    ])
    return c.select(k.cast("string").alias("ticker"), F.explode(rows).alias("r")).select("ticker", "r.item", "r.value")


def holders(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    n = table(spark, sf_dir, "nation")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        F.col("n_name").alias("ticker"),
        F.col("s_name").alias("holder"),
        (F.col("s_acctbal") / 100000).alias("pct_held"),
    )


def _period(ts: Column) -> Column:
    d = F.dayofmonth(ts)
    return (
        F.when(d > 28, "-4m").when(d > 21, "-3m").when(d > 14, "-2m").when(d > 7, "-1m").otherwise("0m")
    )


def recommendations(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")

    def n(kind: str) -> Column:
        return F.count(F.when(F.col("event_type") == kind, 1))

    return e.groupBy(
        F.col("user_id").cast("string").alias("ticker"), _period(F.col("ts")).alias("period")
    ).agg(
        n("purchase").alias("strong_buy"),
        n("click").alias("buy"),
        n("view").alias("hold"),
        n("error").alias("sell"),
        n("signup").alias("strong_sell"),
    )


def dividends(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).select(
        F.col("o_custkey").cast("string").alias("ticker"),
        F.to_date("o_orderdate").alias("date"),
        (F.col("o_totalprice") / 1000).alias("amount"),
    )


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earnings calendar in long form: one row per (ticker, earnings date).

    The reference holds a list of dates per ticker and reads element 0; the
    long form keeps a hot ticker from becoming one huge array row, and
    "element 0 of the sorted list" becomes ``min`` (a partial aggregate)."""
    o = table(spark, sf_dir, "orders")
    return o.select(
        F.col("o_custkey").cast("string").alias("ticker"), F.to_date("o_orderdate").alias("earnings_date")
    )


# ---------------------------------------------------------------- one ticker domain
# The company sources above keep the keys of their tables.  Those below carry
# the tickers of the bars, so that they join them: ticker number i stands for
# the keys k with k % (number of tickers) = i.


def ticker_index(spark: SparkSession, sf_dir: str, ticker: str = "type") -> DataFrame:
    """(ticker, i, n): the tickers of the bars, numbered in order."""
    names = table(spark, sf_dir, "part").select(TICKER_KEYS[ticker]().alias("ticker")).distinct()
    every = Window.partitionBy(F.lit(0))  # of the ticker names only
    return names.select("ticker", (F.row_number().over(every.orderBy("ticker")) - 1).cast("bigint").alias("i"), F.count(F.lit(1)).over(every).alias("n"))


def _by_ticker(rows: DataFrame, key: str, index: DataFrame) -> DataFrame:
    """``rows`` with the ticker of their ``key``.  The rows are spread over
    few tickers, so the small index is what AQE broadcasts."""
    n = index.agg(F.max("n")).first()[0] or 1
    return rows.withColumn("i", F.pmod(F.col(key).cast("bigint"), F.lit(n))).join(index.select("ticker", "i"), "i").drop("i")


def company_profiles(spark: SparkSession, sf_dir: str, ticker: str = "type") -> DataFrame:
    """S04 with all profile fields, one row per bar ticker."""
    t = ticker_index(spark, sf_dir, ticker)
    c = table(spark, sf_dir, "customer").select((F.col("c_custkey") - 1).alias("i"), "c_acctbal")
    n = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("_n"), F.col("n_name").alias("country"))
    r = table(spark, sf_dir, "region").select(F.col("r_regionkey").alias("_r"), F.col("r_name").alias("sector"))
    b, k = F.col("c_acctbal"), F.col("i") + 1
    return (
        t.join(c, "i").join(n, F.col("i") % 3 == F.col("_n")).join(r, F.col("i") % 2 == F.col("_r"))
        .select(
            "ticker", F.concat(F.lit("Company "), "ticker").alias("company_name"), "sector",
            F.when(F.col("i") % 2 == 0, "BUILDING").otherwise("MACHINERY").alias("industry"), "country",
            (F.abs(b) * 1e6 + 1e9).alias("market_cap"), ((k % 5) / 2 + 0.5).alias("beta"), (b / 100).alias("trailing_pe"),
            (b / 120).alias("forward_pe"), F.when(k % 7 == 0, F.lit(None)).otherwise(b / 1000).alias("trailing_peg"),
            (b / 700).alias("price_to_book"), F.when(k % 3 == 0, F.lit(None)).otherwise(b / 10000).alias("dividend_yield"),
            (F.abs(b) * 10 + 1000).alias("revenue"), (k * 100).alias("full_time_employees"),
        )
    )


def company_esg(spark: SparkSession, sf_dir: str, ticker: str = "type") -> DataFrame:
    """S09 per bar ticker."""
    t = ticker_index(spark, sf_dir, ticker).select(F.col("ticker").alias("name"), (F.col("i") + 1).cast("string").alias("ticker"))
    return esg(spark, sf_dir).join(t, "ticker").select(F.col("name").alias("ticker"), "item", "value")


def company_holders(spark: SparkSession, sf_dir: str, ticker: str = "type") -> DataFrame:
    """S05 per bar ticker."""
    s = _by_ticker(table(spark, sf_dir, "supplier"), "s_suppkey", ticker_index(spark, sf_dir, ticker))
    return s.select("ticker", F.col("s_name").alias("holder"), (F.col("s_acctbal") / 100000).alias("pct_held"))


def company_recommendations(spark: SparkSession, sf_dir: str, ticker: str = "type") -> DataFrame:
    """S06 per bar ticker, from the per-user counts."""
    r = _by_ticker(recommendations(spark, sf_dir).withColumnRenamed("ticker", "user"), "user", ticker_index(spark, sf_dir, ticker))
    kinds = ["strong_buy", "buy", "hold", "sell", "strong_sell"]
    return r.groupBy("ticker", "period").agg(*[F.sum(c).alias(c) for c in kinds])


def company_dividends(spark: SparkSession, sf_dir: str, ticker: str = "type") -> DataFrame:
    """S07 per bar ticker."""
    return _by_ticker(dividends(spark, sf_dir).withColumnRenamed("ticker", "key"), "key", ticker_index(spark, sf_dir, ticker)).select(
        "ticker", "date", "amount")


def company_calendar(spark: SparkSession, sf_dir: str, ticker: str = "type") -> DataFrame:
    """S08 per bar ticker."""
    return _by_ticker(calendar(spark, sf_dir).withColumnRenamed("ticker", "key"), "key", ticker_index(spark, sf_dir, ticker)).select(
        "ticker", "earnings_date")


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    lab = table(spark, sf_dir, "labels")
    return lab.select(
        F.col("doc_id").alias("id"),
        F.col("quality").alias("label"),
        F.col("toxic").alias("prediction"),
        ((F.col("doc_id") * 37) % 1000).cast("double").__truediv__(F.lit(1000.0)).alias("probability"),
    )


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb = table(spark, sf_dir, "embeddings")
    m = F.col("vec_id") % 20
    return emb.select(
        F.col("vec_id").alias("id"),
        F.col("embedding").alias("features"),
        (F.col("label") % 2).alias("label"),
        F.when(m < 14, "train").when(m < 17, "validation").otherwise("test").alias("split"),
    )
