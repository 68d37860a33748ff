"""Registrations beyond the first slice (imported lazily by the registry)."""

from __future__ import annotations

from .functions.scalar import round6
from .plans import momentum as mom
from .plans import price
from .registry import register
from .sources import tables as src
from .sql import momentum as mom_sql


def _bars(spark, d, ticker="type"):
    return price.by_ticker(src.bars(spark, d, ticker))


# ---------------------------------------------------------------- M01-M38

_M_IDS = {
    "adx": "M01", "adxr": "M02", "apo": "M03", "aroon_1": "M04", "aroon_2": "M05",
    "aroonosc": "M06", "bop": "M07", "cci": "M08", "cmo": "M09", "dx": "M10", "macd": "M11",
    "macdsignal": "M12", "macdhist": "M13", "macd_ext": "M14", "macdsignal_ext": "M15",
    "macdhist_ext": "M16", "macd_fix": "M17", "macdsignal_fix": "M18", "macdhist_fix": "M19",
    "minus_di": "M20", "mom": "M21", "plus_di": "M22", "dm": "M23", "ppo": "M24", "roc": "M25",
    "rocp": "M26", "rocr": "M27", "rocr100": "M28", "rsi": "M29", "slowk": "M30", "slowd": "M31",
    "fastk": "M32", "fastd": "M33", "fastk_rsi": "M34", "fastd_rsi": "M35", "trix": "M36",
    "ultosc": "M37", "willr": "M38",
}


def _indicator_query(name):
    def q(spark, d):
        return mom.momentum_daily(_bars(spark, d)).select("ticker", "date", round6(name).alias(name))

    return q


for _name, _id in _M_IDS.items():
    register(f"{_id}_{_name}", mom_sql.indicator_sql(_name))(_indicator_query(_name))


@register("C03_momentum", mom_sql.momentum_daily_sql())
def _c03(spark, d):
    daily = mom.momentum_daily(_bars(spark, d))
    return daily.select("ticker", "date", *[round6(c).alias(c) for c in mom.MOMENTUM_COLUMNS])


@register("G02_momentum_month_median", mom_sql.momentum_monthly_sql())
def _g02(spark, d):
    m = mom.momentum_monthly(mom.momentum_daily(_bars(spark, d)))
    return m.select("ticker", "date", *[round6(c).alias(c) for c in mom.MOMENTUM_COLUMNS])


# ---------------------------------------------------------------- K01-K61

from .plans import candles  # noqa: E402
from .plans import patterns as pat  # noqa: E402
from .sql import patterns as pat_sql  # noqa: E402


def _pattern_query(name):
    def q(spark, d):
        return pat.patterns_daily(_bars(spark, d)).select("ticker", "date", name)

    return q


for _i, _name in enumerate(candles.PATTERN_COLUMNS, start=1):
    register(f"K{_i:02d}_{_name}", pat_sql.pattern_sql(_name))(_pattern_query(_name))


@register("C04_patterns", pat_sql.patterns_daily_sql())
def _c04(spark, d):
    return pat.patterns_daily(_bars(spark, d))


@register("G03_patterns_month_median", pat_sql.patterns_monthly_sql())
def _g03(spark, d):
    return pat.patterns_monthly(pat.patterns_daily(_bars(spark, d)))


# ---------------------------------------------------------------- C05, C06, C02, C12

from pyspark.sql import functions as F  # noqa: E402

from .functions import scalar as fn  # noqa: E402
from .plans import fundamentals as fu  # noqa: E402
from .plans import series as se  # noqa: E402
from .plans import universe as un  # noqa: E402
from .sql import features as feat_sql  # noqa: E402
from .sql import fixtures as fx  # noqa: E402

END_DATE = "2001-12-31"  # F07 of a fixed "today" (2002-01-15); never current_date in tests


def _round_doubles(df):
    return df.withColumns({c: round6(c) for c, t in df.dtypes if t == "double"})


@register("C05_macro_features", feat_sql.macro_sql())
def _c05(spark, d):
    return _round_doubles(se.macro_features(src.macro(spark, d), se.FIXTURE_MACRO))


@register("C06_market_features", feat_sql.market_sql())
def _c06(spark, d):
    return _round_doubles(se.market_features(src.market(spark, d), se.FIXTURE_MARKET))


@register("J06_market_outer_join_fold", feat_sql.market_sql())
def _j06(spark, d):
    return _round_doubles(se.market_features(src.market(spark, d), se.FIXTURE_MARKET))


def _fund(spark, d, ticker="type"):
    return fu.fundamental_features(
        src.statements(spark, d, ticker), src.company_profiles(spark, d, ticker), src.company_holders(spark, d, ticker),
        src.company_recommendations(spark, d, ticker), src.company_dividends(spark, d, ticker), src.company_calendar(spark, d, ticker),
        END_DATE, fu.TICKER_ITEMS, src.company_esg(spark, d, ticker),
    )


@register("C02_fundamentals", feat_sql.fundamentals_sql(END_DATE))
def _c02(spark, d):
    return _fund(spark, d)


@register(
    "W10_W11_latest_statement_items",
    fx.with_tables(
        "SELECT ticker, " + ", ".join(f"{fx.r6(r)} AS {r}" for r in fu.FIXTURE_ITEMS) + " FROM latest",
        statements=fx.STATEMENTS, latest=feat_sql.latest_items_sql(),
    ),
)
def _w10(spark, d):
    return _round_doubles(fu.latest_items(src.statements(spark, d), fu.FIXTURE_ITEMS))


@register(
    "G05_G06_dividend_stability",
    fx.with_tables(
        "SELECT ticker, " + fx.r6("CASE WHEN count(amount) > 1 AND avg(amount) <> 0 "
                                  "THEN stddev_samp(amount) / avg(amount) END") + " AS dividend_stability "
        "FROM divs GROUP BY ticker",
        dividends=fx.DIVIDENDS,
        divs="""SELECT y.ticker, y.year, coalesce(d.amount, 0.0) AS amount FROM (
  SELECT ticker, unnest(range(min(year(date)), max(year(date)) + 1)) AS year FROM dividends GROUP BY ticker) y
  LEFT JOIN (SELECT ticker, year(date) AS year, sum(amount) AS amount FROM dividends GROUP BY ticker, year(date)) d
  ON y.ticker = d.ticker AND y.year = d.year""",
    ),
)
def _g05(spark, d):
    return _round_doubles(fu.dividend_stability(src.dividends(spark, d)))


@register(
    "G07_holder_stats",
    fx.with_tables(
        f"SELECT ticker, {fx.r6('avg(pct_held)')} AS pct_held_by_inst, count(*) AS institutional_holders_count "
        "FROM holders GROUP BY ticker",
        holders=fx.HOLDERS,
    ),
)
def _g07(spark, d):
    return _round_doubles(fu.holder_stats(src.holders(spark, d)))


@register(
    "G08_rating_stats",
    fx.with_tables(
        "SELECT ticker, t AS recent_rating_changes, "
        + fx.r6("CASE WHEN t <> 0 THEN CAST(sb AS DOUBLE) / t END") + " AS strong_to_total_reco_ratio FROM ("
        "SELECT ticker, sum(CASE WHEN period IN ('0m', '-1m', '-2m', '-3m') "
        "THEN strong_buy + buy + hold + sell + strong_sell ELSE 0 END) AS t, "
        "sum(CASE WHEN period IN ('0m', '-1m', '-2m', '-3m') THEN strong_buy ELSE 0 END) AS sb "
        "FROM recommendations GROUP BY ticker)",
        recommendations=fx.RECOMMENDATIONS,
    ),
)
def _g08(spark, d):
    return _round_doubles(fu.rating_stats(src.recommendations(spark, d)))


@register(
    "F08_days_to_earnings",
    fx.with_tables(
        f"SELECT ticker, CAST(datediff('day', DATE '{END_DATE}', min(earnings_date)) AS DOUBLE) "
        "AS days_to_next_earnings FROM calendar GROUP BY ticker",
        calendar=fx.CALENDAR,
    ),
)
def _f08(spark, d):
    return fu.earnings_days(src.calendar(spark, d), END_DATE)


@register(
    "G14_missing_per_ticker",
    fx.with_tables(
        "SELECT ticker, CAST(" + " + ".join(
            f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END"
            for c in ["debt_to_equity", "current_ratio", "cash_ratio", "working_capital", "working_capital_ratio",
                      "retained_earnings_to_assets", "long_term_debt_to_equity", "operating_cf_margin",
                      "free_cf_margin", "pct_held_by_inst", "strong_to_total_reco_ratio", "days_to_next_earnings",
                      "dividend_stability", "trailing_peg", "esg_env", "esg_soc", "esg_gov", "dividend_yield",
                      "institutional_holders_count", "recent_rating_changes", "company_name", "sector", "industry", "country",
                      "market_cap", "beta", "trailing_pe", "forward_pe", "price_to_book", "full_time_employees"]
        ) + " AS INTEGER) AS missing_count FROM fund",
        fund="(" + feat_sql.fundamentals_sql(END_DATE) + ")",
    ),
)
def _g14(spark, d):
    return fu.missing_per_ticker(_fund(spark, d))


@register("C12_T01_top_tickers", feat_sql.top_tickers_sql(24))
def _c12(spark, d):
    return un.top_tickers(src.listing(spark, d), 24)


@register("P05_top_tickers_scaled_caps", feat_sql.top_tickers_sql(5, scale_suffix=True))
def _p05(spark, d):
    return un.top_tickers(src.listing(spark, d), 5, scale_suffix=True)


# ---------------------------------------------------------------- C07-C09, J, W07, F10-F13

from .operators.persist import materialize  # noqa: E402
from .plans import dataset as ds  # noqa: E402
from .sql import price as price_sql  # noqa: E402


def _monthly_parts(spark, d, ticker="type"):
    # the bars feed three window plans: materialise them once (the
    # checkpoint keeps the ticker partitioning, so no exchange is added)
    bars = materialize(_bars(spark, d, ticker))
    price_m = price.price_features(bars, partitioned=True)
    mom_m = _round_doubles(mom.momentum_monthly(mom.momentum_daily(bars)))
    pat_m = pat.patterns_monthly(pat.patterns_daily(bars))
    macro = se.macro_features(src.macro(spark, d), se.FIXTURE_MACRO)
    market = se.market_features(src.market(spark, d), se.FIXTURE_MARKET)
    return price_m, mom_m, pat_m, macro, market


def full_dataset_query(spark, d, ticker="type"):
    price_m, mom_m, pat_m, macro, market = _monthly_parts(spark, d, ticker)
    return _round_doubles(ds.full_dataset(price_m, _fund(spark, d, ticker), mom_m, pat_m, macro, market))


def _c07_sql(ticker="type"):
    return fx.with_tables(
        "SELECT * FROM c_t WHERE target IS NOT NULL",
        c_price=price_sql.price_sql(ticker),
        c_fund=feat_sql.fundamentals_sql(END_DATE, ticker=ticker),
        c_mom=mom_sql.momentum_monthly_sql(ticker),
        c_pat=pat_sql.patterns_monthly_sql(ticker),
        c_macro=feat_sql.macro_sql(),
        c_market=feat_sql.market_sql(),
        c_j="""SELECT p.*, f.* EXCLUDE (ticker), m.* EXCLUDE (ticker, date), k.* EXCLUDE (ticker, date),
  ma.* EXCLUDE (date), mk.* EXCLUDE (date)
FROM c_price p LEFT JOIN c_fund f ON p.ticker = f.ticker
  LEFT JOIN c_mom m ON p.ticker = m.ticker AND p.date = m.date
  LEFT JOIN c_pat k ON p.ticker = k.ticker AND p.date = k.date
  LEFT JOIN c_macro ma ON p.date = ma.date
  LEFT JOIN c_market mk ON p.date = mk.date""",
        c_t="SELECT *, lead(close, 3) OVER (PARTITION BY ticker ORDER BY date) AS target FROM c_j",
    )


register("C07_full_dataset", _c07_sql())(full_dataset_query)


# C08 / C09 work on complete months: the indicators are past their warm-up and
# the macro and market calendars cover the month.
_SERIES = [*mom.MOMENTUM_COLUMNS, *se.FIXTURE_MACRO, *se.FIXTURE_MARKET]
_FILL_STEPS = [(c, g) for c, groups in ds.GROUP_FILL.items() for g in groups]


def complete_dataset_query(spark, d, ticker="type"):
    return ds.complete_months(full_dataset_query(spark, d, ticker), _SERIES)


def _fill_ctes():
    fills = [f"coalesce({c}, 0.0) AS {c}" for c in ds.ZERO_FILL] + [f"coalesce({c}, {v}) AS {c}" for c, v in ds.CONSTANT_FILL.items()]
    ctes = {"c07": _c07_sql(),
            "s0": f"SELECT * REPLACE ({', '.join(fills)}) FROM c07 WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in _SERIES)}
    for i, (col, group) in enumerate(_FILL_STEPS, start=1):
        ctes[f"m{i}"] = f"SELECT {group}, median({col}) AS m FROM s{i - 1} WHERE {group} IS NOT NULL GROUP BY {group}"
        ctes[f"s{i}"] = (f"SELECT p.* REPLACE (coalesce(p.{col}, m{i}.m) AS {col}) FROM s{i - 1} p LEFT JOIN m{i} ON p.{group} = m{i}.{group}")
    rounded = ", ".join(f"{fx.r6(c)} AS {c}" for c in ds.GROUP_FILL)
    ctes["filled"] = f"SELECT * REPLACE ({rounded}) FROM s{len(_FILL_STEPS)}"
    return ctes


@register("C08_impute", fx.with_tables("SELECT * FROM filled", **_fill_ctes()))
def _c08(spark, d):
    return _round_doubles(ds.impute(complete_dataset_query(spark, d)))


_SPLIT_DAYS = "CAST(date - (SELECT min(date) FROM filled) AS INTEGER)"
_SPAN = "(SELECT CAST(max(date) - min(date) AS INTEGER) FROM filled)"


@register("C09_preprocess", fx.with_tables(
    f"""SELECT f.* EXCLUDE (ticker, sector, industry, date, target, company_name, country, year), t.ticker_index,
  {fx.r6('sin(2 * pi() * month / 12)')} AS month_sin, {fx.r6('cos(2 * pi() * month / 12)')} AS month_cos,
  CASE WHEN sector = 'AMERICA' THEN 1 ELSE 0 END AS "sector_AMERICA", CASE WHEN industry = 'MACHINERY' THEN 1 ELSE 0 END AS "industry_MACHINERY",
  CASE WHEN target >= close * 1.10 THEN 1 ELSE 0 END AS {ds.LABEL},
  CASE WHEN {_SPLIT_DAYS} <= {_SPAN} * 0.7 THEN 'train' WHEN {_SPLIT_DAYS} <= {_SPAN} * 0.7 + {_SPAN} * 0.15 THEN 'validation' ELSE 'test' END AS split
FROM filled f JOIN (SELECT ticker, CAST(row_number() OVER (ORDER BY ticker) - 1 AS INTEGER) AS ticker_index
  FROM (SELECT DISTINCT ticker FROM filled)) t ON f.ticker = t.ticker""", **_fill_ctes()))
def _c09(spark, d):
    return _round_doubles(ds.preprocess(complete_dataset_query(spark, d)))


@register("C09_C10_features", fx.with_tables(
    f"""SELECT CASE WHEN target >= close * 1.10 THEN 1 ELSE 0 END AS label, count(*) AS n,
  round(sum(close + trailing_peg + esg_env + esg_soc + esg_gov), 2) AS checked FROM filled GROUP BY 1""", **_fill_ctes()))
def _c09_c10(spark, d):
    """Feature rows per label, and a checksum of five features by position."""
    table = ds.preprocess(complete_dataset_query(spark, d))
    rows = ds.features(table)
    numeric = [c for c, t in table.dtypes if t not in ("string", "date", "boolean") and c not in (ds.LABEL, "split", "ticker_index")]
    some = sum(F.col("features")[numeric.index(c)] for c in ("close", "trailing_peg", "esg_env", "esg_soc", "esg_gov"))
    return rows.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum(some), 2).alias("checked"))


def _price_m(spark, d):
    return price.price_features(_bars(spark, d), partitioned=True)


def _join_sql(right_sql: str, on: str, exclude: str) -> str:
    return fx.with_tables(
        f"SELECT p.*, r.* EXCLUDE ({exclude}) FROM c_price p LEFT JOIN c_r r ON {on}",
        c_price=price_sql.price_sql(), c_r=right_sql,
    )


@register("J01_join_monthly_momentum",
          _join_sql(mom_sql.momentum_monthly_sql(), "p.ticker = r.ticker AND p.date = r.date", "ticker, date"))
def _j01(spark, d):
    bars = _bars(spark, d)
    right = _round_doubles(mom.momentum_monthly(mom.momentum_daily(bars)))
    # unique by construction: a groupBy on the keys (J05 checks it)
    return ds.left_join_many_to_one(price.price_features(bars, partitioned=True), right, ["ticker", "date"], validate=False)


@register("J02_join_monthly_patterns",
          _join_sql(pat_sql.patterns_monthly_sql(), "p.ticker = r.ticker AND p.date = r.date", "ticker, date"))
def _j02(spark, d):
    bars = _bars(spark, d)
    right = pat.patterns_monthly(pat.patterns_daily(bars))
    # unique by construction: a groupBy on the keys (J05 checks it)
    return ds.left_join_many_to_one(price.price_features(bars, partitioned=True), right, ["ticker", "date"], validate=False)


@register("J03_join_macro", _join_sql(feat_sql.macro_sql(), "p.date = r.date", "date"))
def _j03(spark, d):
    right = se.macro_features(src.macro(spark, d), se.FIXTURE_MACRO)
    return ds.left_join_many_to_one(_price_m(spark, d), right, ["date"], broadcast=True)


@register("J04_join_market", _join_sql(feat_sql.market_sql(), "p.date = r.date", "date"))
def _j04(spark, d):
    right = se.market_features(src.market(spark, d), se.FIXTURE_MARKET)
    return ds.left_join_many_to_one(_price_m(spark, d), right, ["date"], broadcast=True)


@register(
    "J05_cardinality_check",
    fx.with_tables("SELECT ticker, date, count(*) AS count FROM c_m GROUP BY ticker, date HAVING count(*) > 1",
                   c_m=mom_sql.momentum_monthly_sql()),
)
def _j05(spark, d):
    return ds.duplicate_keys(mom.momentum_monthly(mom.momentum_daily(_bars(spark, d))), ["ticker", "date"])


@register("J08_join_fundamentals", _join_sql(feat_sql.fundamentals_sql(END_DATE), "p.ticker = r.ticker", "ticker"))
def _j08(spark, d):
    return ds.left_join_many_to_one(_price_m(spark, d), _fund(spark, d), ["ticker"])


@register(
    "J09_fundamentals_of_priced_tickers",
    fx.with_tables("SELECT * FROM c_f f WHERE f.ticker IN (SELECT ticker FROM c_b)",
                   c_f=feat_sql.fundamentals_sql(END_DATE), c_b=fx.bars()),
)
def _j09(spark, d):
    return _fund(spark, d).join(src.bars(spark, d).select("ticker"), "ticker", "left_semi")


@register(
    "W07_P07_target",
    fx.with_tables(
        "SELECT * FROM (SELECT *, lead(close, 3) OVER (PARTITION BY ticker ORDER BY date) AS target FROM c_p) "
        "WHERE target IS NOT NULL",
        c_p=price_sql.price_sql(),
    ),
)
def _w07(spark, d):
    return ds.with_target(_price_m(spark, d))


_IMPUTE_SQL = fx.with_tables(
    "SELECT ticker, " + ", ".join(
        f"{fx.r6(c)} AS {c}" for c in ["trailing_peg", "esg_env", "dividend_yield", "days_to_next_earnings"]
    ) + " FROM s4",
    profile=fx.PROFILE,
    s0="""SELECT ticker, sector, industry, country, trailing_peg, esg_env,
  coalesce(dividend_yield, 0.0) AS dividend_yield, coalesce(days_to_next_earnings, 66.0) AS days_to_next_earnings
FROM profile""",
    m1="SELECT industry, median(trailing_peg) AS m FROM s0 WHERE industry IS NOT NULL GROUP BY industry",
    s1="SELECT s0.* REPLACE (coalesce(s0.trailing_peg, m1.m) AS trailing_peg) FROM s0 LEFT JOIN m1 ON s0.industry = m1.industry",
    m2="SELECT sector, median(esg_env) AS m FROM s1 WHERE sector IS NOT NULL GROUP BY sector",
    s2="SELECT s1.* REPLACE (coalesce(s1.esg_env, m2.m) AS esg_env) FROM s1 LEFT JOIN m2 ON s1.sector = m2.sector",
    m3="SELECT industry, median(esg_env) AS m FROM s2 WHERE industry IS NOT NULL GROUP BY industry",
    s3="SELECT s2.* REPLACE (coalesce(s2.esg_env, m3.m) AS esg_env) FROM s2 LEFT JOIN m3 ON s2.industry = m3.industry",
    m4="SELECT country, median(esg_env) AS m FROM s3 WHERE country IS NOT NULL GROUP BY country",
    s4="SELECT s3.* REPLACE (coalesce(s3.esg_env, m4.m) AS esg_env) FROM s3 LEFT JOIN m4 ON s3.country = m4.country",
)


@register("F10_F11_G09_profile_imputation", _IMPUTE_SQL)
def _f11(spark, d):
    out = ds.impute(src.profile(spark, d))
    return _round_doubles(out.select("ticker", "trailing_peg", "esg_env", "dividend_yield", "days_to_next_earnings"))


_PROFILE_COLS = ["ticker", "sector", "industry", "country", "trailing_peg", "esg_env", "dividend_yield",
                 "days_to_next_earnings"]


@register(
    "G13_P13_null_counts",
    fx.with_tables(
        " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(*) - count({c}) AS null_count FROM profile"
                           for c in _PROFILE_COLS),
        profile=fx.PROFILE,
    ),
)
def _g13(spark, d):
    return ds.null_counts(src.profile(spark, d))


@register("P17_rows_with_null", fx.with_tables("SELECT * FROM profile WHERE trailing_peg IS NULL", profile=fx.PROFILE))
def _p17(spark, d):
    return src.profile(spark, d).where(F.col("trailing_peg").isNull())


@register(
    "F09_cyclical_month",
    fx.with_tables(
        f"SELECT ticker, date, {fx.r6('sin(2 * pi() * month / 12)')} AS month_sin, "
        f"{fx.r6('cos(2 * pi() * month / 12)')} AS month_cos FROM c_p",
        c_p=price_sql.price_sql(),
    ),
)
def _f09(spark, d):
    df = ds.add_cyclical(_price_m(spark, d))
    return df.select("ticker", "date", round6("month_sin").alias("month_sin"), round6("month_cos").alias("month_cos"))


@register(
    "P14_growth_label",
    fx.with_tables(
        "SELECT ticker, date, CASE WHEN target >= close * 1.10 THEN 1 ELSE 0 END AS is_positive_growth_3m_future "
        "FROM (SELECT *, lead(close, 3) OVER (PARTITION BY ticker ORDER BY date) AS target FROM c_p) "
        "WHERE target IS NOT NULL",
        c_p=price_sql.price_sql(),
    ),
)
def _p14(spark, d):
    df = ds.with_target(_price_m(spark, d))
    return df.select("ticker", "date", fn.growth_label("target", "close").alias(ds.LABEL))


@register(
    "F13_temporal_split",
    fx.with_tables(
        """SELECT ticker, date, CASE WHEN datediff('day', lo, date) <= d * 0.7 THEN 'train'
  WHEN datediff('day', lo, date) <= d * 0.7 + d * 0.15 THEN 'validation' ELSE 'test' END AS split
FROM c_p, (SELECT min(date) AS lo, datediff('day', min(date), max(date)) AS d FROM c_p) b""",
        c_p=price_sql.price_sql(),
    ),
)
def _f13(spark, d):
    return ds.temporal_split(_price_m(spark, d)).select("ticker", "date", "split")


@register(
    "P08_drop_columns",
    fx.with_tables("SELECT * EXCLUDE (date, year) FROM c_p", c_p=price_sql.price_sql()),
)
def _p08(spark, d):
    return _price_m(spark, d).drop(*[c for c in ds.DROP_VARIABLES if c != "ticker"])


# ---------------------------------------------------------------- G10-G23, T03, T04, U01, C11, C13

from .plans import evaluate as ev  # noqa: E402
from .plans import learn as ln  # noqa: E402
from .plans import profile as pf  # noqa: E402

_PRED = {"predictions": fx.PREDICTIONS}


@register(
    "G10_value_counts",
    fx.with_tables(
        "SELECT ticker, count(*) AS count, count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM c_p) AS share "
        "FROM c_p GROUP BY ticker",
        c_p=price_sql.price_sql(),
    ),
)
def _g10(spark, d):
    return pf.value_counts(_price_m(spark, d), "ticker")


_N_PRICE_COLS = len(price.PRICE_COLUMNS)


@register(
    "C11_G11_G12_G19_profile",
    fx.with_tables(
        f"SELECT count(*) AS rows, {_N_PRICE_COLS} AS columns, count(DISTINCT ticker) AS tickers, "
        "min(date) AS min_date, max(date) AS max_date, "
        "CAST(0 AS BIGINT) AS nulls FROM c_p",
        c_p=price_sql.price_sql(),
    ),
)
def _c11(spark, d):
    return pf.summary(_price_m(spark, d))


@register(
    "G15_pattern_zero_share",
    fx.with_tables(
        "SELECT (" + " + ".join(f"count_if({c} = 0)" for c in candles.PATTERN_COLUMNS) + ") / "
        f"(count(*) * {len(candles.PATTERN_COLUMNS)}.0) AS zero_share FROM c_k",
        c_k=pat_sql.patterns_daily_sql(),
    ),
)
def _g15(spark, d):
    return pf.zero_share(pat.patterns_daily(_bars(spark, d)), candles.PATTERN_COLUMNS)


_CORR_COLS = [c for c in price.PRICE_COLUMNS if c not in ("date", "ticker")]


def _labelled_price(spark, d):
    df = ds.with_target(_price_m(spark, d))
    return df.withColumn(ds.LABEL, fn.growth_label("target", "close"))


_LABELLED_SQL = {
    "c_p": price_sql.price_sql(),
    "c_l": "SELECT *, CASE WHEN target >= close * 1.10 THEN 1 ELSE 0 END AS is_positive_growth_3m_future FROM "
           "(SELECT *, lead(close, 3) OVER (PARTITION BY ticker ORDER BY date) AS target FROM c_p) "
           "WHERE target IS NOT NULL",
}
_CORR_SQL = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {fx.r6(f'corr({c}, is_positive_growth_3m_future)')} AS corr FROM c_l"
    for c in _CORR_COLS
)


@register("G16_label_correlations", fx.with_tables(_CORR_SQL, **_LABELLED_SQL))
def _g16(spark, d):
    c = pf.label_correlations(_labelled_price(spark, d), ds.LABEL, _CORR_COLS)
    return c.withColumn("corr", round6(F.nanvl("corr", F.lit(None).cast("double"))))


@register(
    "T03_top_correlations",
    fx.with_tables(
        "SELECT * FROM (" + _CORR_SQL + ") ORDER BY corr DESC NULLS LAST, \"column\" LIMIT 25", **_LABELLED_SQL
    ),
)
def _t03(spark, d):
    c = pf.label_correlations(_labelled_price(spark, d), ds.LABEL, _CORR_COLS)
    c = c.withColumn("corr", round6(F.nanvl("corr", F.lit(None).cast("double"))))
    return pf.top_correlations(c, 25)


_HIST_EDGES = (0.0, 3.0, 29)


@register(
    "G17_histogram_by_label",
    fx.with_tables(
        f"""SELECT is_positive_growth_3m_future, bin, count(*) AS count,
  {fx.r6('0.0 + bin * (3.0 / 29)')} AS bin_lo, {fx.r6('0.0 + (bin + 1) * (3.0 / 29)')} AS bin_hi
FROM (SELECT is_positive_growth_3m_future,
        CAST(least(floor((mma_6_scaled - 0.0) / (3.0 / 29)), 28) AS INTEGER) AS bin
      FROM c_l WHERE mma_6_scaled >= 0.0 AND mma_6_scaled <= 3.0)
GROUP BY is_positive_growth_3m_future, bin""",
        **_LABELLED_SQL,
    ),
)
def _g17(spark, d):
    h = pf.histogram(_labelled_price(spark, d), "mma_6_scaled", *_HIST_EDGES, by=ds.LABEL)
    return h.withColumns({"bin_lo": round6("bin_lo"), "bin_hi": round6("bin_hi")})


@register(
    "G17_target_histogram_20",
    fx.with_tables(
        f"""SELECT bin, count(*) AS count, {fx.r6('lo + bin * ((hi - lo) / 20)')} AS bin_lo,
  {fx.r6('lo + (bin + 1) * ((hi - lo) / 20)')} AS bin_hi
FROM (SELECT CAST(least(floor((target - lo) / ((hi - lo) / 20)), 19) AS INTEGER) AS bin, lo, hi
      FROM c_l, (SELECT min(target) AS lo, max(target) AS hi FROM c_l) b)
GROUP BY bin, lo, hi""",
        **_LABELLED_SQL,
    ),
)
def _g17b(spark, d):
    h = pf.histogram_auto(_labelled_price(spark, d), "target", 20)
    return h.withColumns({"bin_lo": round6("bin_lo"), "bin_hi": round6("bin_hi")})


@register(
    "G18_five_numbers",
    fx.with_tables(
        "SELECT label, q[1] AS min, q[2] AS q1, q[3] AS median, q[4] AS q3, q[5] AS max FROM ("
        "SELECT label, quantile_cont(probability, [0.0, 0.25, 0.5, 0.75, 1.0]) AS q FROM predictions GROUP BY label)",
        **_PRED,
    ),
)
def _g18(spark, d):
    f5 = pf.five_numbers(src.predictions(spark, d), "probability", "label")
    return f5.withColumns({c: round6(c) for c in ("min", "q1", "median", "q3", "max")})


@register(
    "G20_prediction_correctness",
    fx.with_tables(
        "SELECT CAST(label = prediction AS INTEGER) AS is_correct, count(*) AS count, "
        "count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM predictions) AS share FROM predictions "
        "GROUP BY label = prediction",
        **_PRED,
    ),
)
def _g20(spark, d):
    return ev.correctness(src.predictions(spark, d))


_CM_SQL = """SELECT g.label, g.prediction, coalesce(c.n, 0) AS count
FROM (SELECT * FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) v(label, prediction)) g
LEFT JOIN (SELECT label, prediction, count(*) AS n FROM predictions GROUP BY label, prediction) c
  ON g.label = c.label AND g.prediction = c.prediction"""


@register("G21_confusion_matrix", fx.with_tables(_CM_SQL, **_PRED))
def _g21(spark, d):
    return ev.confusion_matrix(src.predictions(spark, d))


def _report_sql():
    return fx.with_tables(
        """SELECT class, precision, recall, f1_score, support FROM (
  SELECT '0' AS class, p0 AS precision, r0 AS recall, f0 AS f1_score, s0 AS support FROM m
  UNION ALL SELECT '1', p1, r1, f1, s1 FROM m
  UNION ALL SELECT 'accuracy', acc, acc, acc, n FROM m
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n FROM m
  UNION ALL SELECT 'weighted avg', CASE WHEN n = 0 THEN 0.0 ELSE (p0 * s0 + p1 * s1) / n END,
    CASE WHEN n = 0 THEN 0.0 ELSE (r0 * s0 + r1 * s1) / n END,
    CASE WHEN n = 0 THEN 0.0 ELSE (f0 * s0 + f1 * s1) / n END, n FROM m)""",
        **_PRED,
        k="""SELECT CAST(count_if(label = 0 AND prediction = 0) AS DOUBLE) AS tn,
  CAST(count_if(label = 0 AND prediction = 1) AS DOUBLE) AS fp,
  CAST(count_if(label = 1 AND prediction = 0) AS DOUBLE) AS fn,
  CAST(count_if(label = 1 AND prediction = 1) AS DOUBLE) AS tp FROM predictions""",
        pr="""SELECT *, tn + fp + fn + tp AS n, tn + fp AS s0, fn + tp AS s1,
  CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p1,
  CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r1,
  CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END AS p0,
  CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END AS r0 FROM k""",
        m="""SELECT *, CASE WHEN p1 + r1 = 0 THEN 0.0 ELSE 2 * p1 * r1 / (p1 + r1) END AS f1,
  CASE WHEN p0 + r0 = 0 THEN 0.0 ELSE 2 * p0 * r0 / (p0 + r0) END AS f0,
  CASE WHEN n = 0 THEN 0.0 ELSE (tn + tp) / n END AS acc FROM pr""",
    )


def _report(spark, d):
    r = ev.classification_report(src.predictions(spark, d))
    return r.withColumns({c: round6(c) for c in ("precision", "recall", "f1_score")})


_REPORT_SQL = _report_sql().replace(
    "SELECT class, precision, recall, f1_score, support FROM (",
    f"SELECT class, {fx.r6('precision')} AS precision, {fx.r6('recall')} AS recall, "
    f"{fx.r6('f1_score')} AS f1_score, support FROM (",
)
register("G22_classification_report", _REPORT_SQL)(_report)
register("C13_evaluate", _REPORT_SQL)(_report)


@register(
    "G23_headline_metrics",
    fx.with_tables(
        "SELECT round(CASE WHEN n = 0 THEN 0.0 ELSE (tn + tp) / n END, 3) AS accuracy, "
        "round(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END, 3) AS precision_1 FROM ("
        "SELECT CAST(count_if(label = 0 AND prediction = 0) AS DOUBLE) AS tn, "
        "CAST(count_if(label = 0 AND prediction = 1) AS DOUBLE) AS fp, "
        "CAST(count_if(label = 1 AND prediction = 1) AS DOUBLE) AS tp, CAST(count(*) AS DOUBLE) AS n "
        "FROM predictions)",
        **_PRED,
    ),
)
def _g23(spark, d):
    return ev.headline(src.predictions(spark, d))


@register(
    "T04_L08_best_model",
    fx.with_tables(
        """SELECT model, model_order, metric FROM m ORDER BY metric DESC, model_order LIMIT 1""",
        labels_pred="SELECT quality AS label, toxic AS p_a, 1 - toxic AS p_b FROM labels",
        m="""SELECT 'toxic_flag' AS model, 0 AS model_order,
  round(CASE WHEN count_if(p_a = 1) = 0 THEN 0.0 ELSE count_if(p_a = 1 AND label = 1) / count_if(p_a = 1) END, 3) AS metric
  FROM labels_pred
UNION ALL SELECT 'inverted_flag', 1,
  round(CASE WHEN count_if(p_b = 1) = 0 THEN 0.0 ELSE count_if(p_b = 1 AND label = 1) / count_if(p_b = 1) END, 3)
  FROM labels_pred""",
    ),
)
def _t04(spark, d):
    lab = src.table(spark, d, "labels")
    rows = []
    for order, (name, pcol) in enumerate((("toxic_flag", F.col("toxic")), ("inverted_flag", 1 - F.col("toxic")))):
        h = ev.headline(lab.select(F.col("quality").alias("label"), pcol.alias("prediction")))
        rows.append(h.select(F.lit(name).alias("model"), F.lit(order).alias("model_order"),
                             F.col("precision_1").alias("metric")))
    return ev.best_model(pf.append_all(rows))


@register(
    "U01_append_by_name",
    fx.with_tables("SELECT * FROM c_p UNION ALL BY NAME SELECT * FROM c_m",
                   c_p=price_sql.price_sql(), c_m=mom_sql.momentum_monthly_sql()),
)
def _u01(spark, d):
    bars = _bars(spark, d)
    m = _round_doubles(mom.momentum_monthly(mom.momentum_daily(bars)))
    return pf.append_all([price.price_features(bars, partitioned=True), m])


@register(
    "P15_threshold_label",
    fx.with_tables("SELECT id, CASE WHEN probability >= 0.475 THEN 1 ELSE 0 END AS prediction FROM predictions",
                   **_PRED),
)
def _p15(spark, d):
    return src.predictions(spark, d).select("id", fn.proba_label("probability").alias("prediction"))


@register(
    "P04_numeric_coercion",
    fx.with_tables("SELECT symbol, TRY_CAST(market_cap AS DOUBLE) AS market_cap FROM listing", listing=fx.LISTING),
)
def _p04(spark, d):
    return src.listing(spark, d).select("symbol", fn.to_number("market_cap").alias("market_cap"))


@register(
    "F07_previous_month_end",
    "SELECT o_orderkey, last_day(CAST(o_orderdate AS DATE) - INTERVAL 1 MONTH) AS end_date FROM orders",
)
def _f07(spark, d):
    o = src.table(spark, d, "orders")
    return o.select("o_orderkey", fn.prev_month_end(F.to_date("o_orderdate")).alias("end_date"))


_DAILY_COLS = ["ln_volume", "daily_growth", "weekly_growth", "biweekly_growth", "monthly_growth",
               "rel_spread_oc", "rel_spread_hl", "vol_10d_mean", "vol_10d_std", "vol_10d_min", "vol_10d_max"]


@register(
    "W01_W02_F01_F02_daily_features",
    fx.with_tables(
        "SELECT ticker, date, " + ", ".join(f"{fx.r6(c)} AS {c}" for c in _DAILY_COLS) + " FROM daily",
        **price_sql.daily_ctes(),
    ),
)
def _w01(spark, d):
    df = price.daily_features(_bars(spark, d))
    return df.select("ticker", "date", *[round6(c).alias(c) for c in _DAILY_COLS])


_RATIO_COLS = ["debt_to_equity", "current_ratio", "cash_ratio", "working_capital", "working_capital_ratio",
               "retained_earnings_to_assets", "long_term_debt_to_equity", "operating_cf_margin", "free_cf_margin"]


@register(
    "F03_F04_statement_ratios",
    fx.with_tables(
        "SELECT ticker, " + ", ".join(f"{fx.r6(c)} AS {c}" for c in _RATIO_COLS) + " FROM ratios",
        statements=fx.STATEMENTS,
        latest=feat_sql.latest_items_sql(),
        ratios=f"""SELECT ticker,
  {fx.div('total_liabilities', 'total_equity')} AS debt_to_equity,
  {fx.div('current_assets', 'current_liabilities')} AS current_ratio,
  {fx.div('cash', 'current_liabilities')} AS cash_ratio, working_capital,
  {fx.div('working_capital', 'total_assets')} AS working_capital_ratio,
  {fx.div('retained_earnings', 'total_assets')} AS retained_earnings_to_assets,
  {fx.div('long_term_debt', 'total_equity')} AS long_term_debt_to_equity,
  CASE WHEN operating_cf <> 0 AND revenue <> 0 THEN operating_cf / revenue END AS operating_cf_margin,
  CASE WHEN free_cf <> 0 AND revenue <> 0 THEN free_cf / revenue END AS free_cf_margin FROM latest""",
    ),
)
def _f03(spark, d):
    return _round_doubles(fu.statement_ratios(fu.latest_items(src.statements(spark, d), fu.FIXTURE_ITEMS)))


# ---------------------------------------------------------------- L01, L02, L07

_VEC = {"vectors": fx.VECTORS}


@register("L01_P10_P16_split_sets",
          fx.with_tables("SELECT id, label, split FROM vectors WHERE split IN ('train', 'validation')", **_VEC))
def _l01(spark, d):
    train, _ = ln.split_sets(src.vectors(spark, d))
    return train.select("id", "label", "split")


@register(
    "L02_standardize",
    fx.with_tables(
        "SELECT id, split, list_transform(features, lambda x, i: "
        + fx.r6("(CAST(x AS DOUBLE) - means[i]) / stds[i]") + ") AS features FROM vectors, sl",
        **_VEC,
        tv="SELECT * FROM vectors WHERE split IN ('train', 'validation')",
        e="SELECT unnest(range(1, len(features) + 1)) AS pos, unnest(features) AS x FROM tv",
        st="SELECT pos, avg(CAST(x AS DOUBLE)) AS mean, stddev_pop(CAST(x AS DOUBLE)) AS std FROM e GROUP BY pos",
        sl="SELECT list(mean ORDER BY pos) AS means, "
           "list(CASE WHEN std > 1e-15 THEN std ELSE 1.0 END ORDER BY pos) AS stds FROM st",
    ),
)
def _l02(spark, d):
    v = src.vectors(spark, d)
    train, _ = ln.split_sets(v)
    out = ln.standardize(v, ln.scaling_stats(train))
    return out.select("id", "split", F.transform("features", lambda x: round6(x)).alias("features"))


@register(
    "L07_expanding_folds",
    fx.with_tables(
        "SELECT id, row_idx, CASE WHEN row_idx >= first THEN CAST(floor((row_idx - first) / ts) AS INTEGER) END "
        "AS test_fold FROM (SELECT id, row_number() OVER (ORDER BY id) - 1 AS row_idx FROM tv), "
        "(SELECT count(*) - 3 * (count(*) // 4) AS first, count(*) // 4 AS ts FROM tv)",
        **_VEC,
        tv="SELECT * FROM vectors WHERE split IN ('train', 'validation')",
    ),
)
def _l07(spark, d):
    train, _ = ln.split_sets(src.vectors(spark, d))
    return ln.fold_ids(train.select("id"), 3).select("id", "row_idx", "test_fold")


# ---------------------------------------------------------------- S01, S12, S13

import uuid  # noqa: E402

from .sources import io as sio  # noqa: E402


_TOP = {"bars": fx.bars(), **{k: v for k, v in fx.company_tables().items() if k in ("tk", "profile")},
        "top": "SELECT ticker FROM profile ORDER BY market_cap DESC NULLS LAST, ticker LIMIT 3"}


@register("S01_bar_scan_range", fx.with_tables(
    "SELECT * FROM bars WHERE date >= DATE '1996-01-01' AND date < DATE '2000-01-01' AND ticker IN (SELECT ticker FROM top)", **_TOP))
def _s01(spark, d):
    """Bars of a date range for the three tickers with the largest market cap."""
    who = src.company_profiles(spark, d).orderBy(F.desc_nulls_last("market_cap"), "ticker").limit(3).select("ticker")
    return sio.scan_bars(src.bars(spark, d), who, "1996-01-01", "2000-01-01")


@register("P01_adjusted_close", fx.with_tables(
    f"""SELECT ticker, date, close / 2 AS close, {fx.r6('CASE WHEN lag(close) OVER (PARTITION BY ticker ORDER BY date) <> 0 THEN close / lag(close) OVER (PARTITION BY ticker ORDER BY date) - 1 END')}
  AS daily_growth FROM bars""", bars=fx.bars()))
def _p01(spark, d):
    """Daily growth of bars with an adjusted close, which replaces the close."""
    adjusted = src.bars(spark, d).withColumns({"adj_close": F.col("close") / 2, "close": F.lit(-1.0)})
    return price.daily_features(price.by_ticker(adjusted)).select("ticker", "date", "close", round6("daily_growth").alias("daily_growth"))


@register("P09_drop_unfilled_columns", fx.with_tables(
    f"""SELECT p.ticker, {fx.r6('coalesce(p.trailing_peg, m.med)')} AS trailing_peg, {fx.r6('coalesce(p.dividend_yield, 0.0)')} AS dividend_yield,
  {fx.r6('coalesce(p.days_to_next_earnings, 66.0)')} AS days_to_next_earnings, 'note,remark' AS dropped
FROM profile p LEFT JOIN (SELECT industry, median(trailing_peg) AS med FROM profile GROUP BY industry) m ON p.industry = m.industry""", profile=fx.PROFILE))
def _p09(spark, d):
    """Columns that no rule fills go, and are named."""
    prof = src.profile(spark, d).withColumns({"note": F.col("esg_env"), "remark": F.when(F.length("ticker") > 1, F.col("sector"))})
    out, dropped = ds.impute_dropping(prof.select("ticker", "industry", "trailing_peg", "dividend_yield", "days_to_next_earnings", "note", "remark"))
    return out.select("ticker", *[round6(c).alias(c) for c in ("trailing_peg", "dividend_yield", "days_to_next_earnings")],
                      F.lit(",".join(sorted(dropped))).alias("dropped"))


@register("S12_S13_csv_roundtrip", price_sql.price_sql())
def _s12(spark, d):
    df = _price_m(spark, d)
    schema = ", ".join(f"`{n}` {t}" for n, t in df.dtypes)
    path = sio.write_table(df, sio.scratch_path(spark, "price-csv"), "csv")
    return sio.read_csv(spark, path, schema)


@register("S13_bucketed_bars", price_sql.price_sql())
def _s13_bucketed(spark, d):
    """C01 over bars stored in buckets by ticker: no exchange for its windows."""
    stored = sio.write_bucketed(src.bars(spark, d), f"bars_{uuid.uuid4().hex}", 16)
    return price.price_features(stored, partitioned=True)


_BROKEN = "(o_orderkey % 100 = 3 OR o_orderkey % 100 = 7)"


@register("S12_csv_rejected_rows", f"""SELECT CASE WHEN o_orderkey % 100 = 3 THEN 'o_totalprice: not a double' ELSE 'another number of fields' END AS reason,
  count(*) AS rows, sum(o_orderkey) AS keys FROM orders WHERE {_BROKEN} GROUP BY 1
UNION ALL SELECT 'read', count(*), sum(o_orderkey) FROM orders WHERE NOT {_BROKEN}""")
def _s12_rejected(spark, d):
    """Orders as CSV lines, some of them broken: what is read, what is not and
    why."""
    o = src.table(spark, d, "orders")
    price_ = F.when(F.col("o_orderkey") % 100 == 3, F.lit("n/a")).otherwise(F.col("o_totalprice").cast("string"))
    line = F.concat_ws(",", F.col("o_orderkey").cast("string"), price_, "o_orderpriority", F.when(F.col("o_orderkey") % 100 == 7, F.lit("too,many")))
    path = sio.scratch_path(spark, "orders-csv")
    o.select(line.alias("value")).write.text(path)
    rows, rejected = sio.read_csv_rejecting(spark, path, "o_orderkey bigint, o_totalprice double, o_orderpriority string", 0.5, header=False)
    key = F.split("line", ",")[0].cast("bigint")
    out = rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("rows"), F.sum(key).alias("keys"))
    return out.unionByName(rows.agg(F.lit("read").alias("reason"), F.count(F.lit(1)).alias("rows"), F.sum("o_orderkey").alias("keys")))


@register("S13_parquet_roundtrip", price_sql.price_sql())
def _s13(spark, d):
    path = sio.write_table(_price_m(spark, d), sio.scratch_path(spark, "price-parquet"), "parquet", ["year"])
    return spark.read.parquet(path).select(*price.PRICE_COLUMNS)


# ---------------------------------------------------------------- step-level aliases

_MONTHLY_COLS = ["return_1m", "return_2m", "return_3m", "vol_3m", "momentum_3m", "mma_3_scaled", "mma_6_scaled"]


@register(
    "W03_W06_W09_W12_monthly_windows",
    fx.with_tables("SELECT ticker, date, " + ", ".join(_MONTHLY_COLS) + " FROM c_p", c_p=price_sql.price_sql()),
)
def _w03(spark, d):
    return _price_m(spark, d).select("ticker", "date", *_MONTHLY_COLS)


@register(
    "G04_month_end_last_non_null",
    fx.with_tables(feat_sql._pivot(se.FIXTURE_MARKET, "market"), market=fx.MARKET),
)
def _g04(spark, d):
    return se.month_end_last(src.market(spark, d), se.FIXTURE_MARKET)


register("J07_W08_macro_alignment", feat_sql.macro_sql())(_c05)


@register("F12_one_hot", fx.with_tables(
    """SELECT p.date, p.close, t.i AS ticker_index, CASE WHEN f.sector = 'AMERICA' THEN 1 ELSE 0 END AS "sector_AMERICA",
  CASE WHEN f.industry = 'MACHINERY' THEN 1 ELSE 0 END AS "industry_MACHINERY"
FROM c_p p JOIN profile f ON p.ticker = f.ticker JOIN (SELECT ticker, CAST(row_number() OVER (ORDER BY ticker) - 1 AS INTEGER) AS i
  FROM (SELECT DISTINCT ticker FROM c_p)) t ON p.ticker = t.ticker""",
    c_p=price_sql.price_sql(), **{k: v for k, v in fx.company_tables().items() if k in ("tk", "profile")}))
def _f12(spark, d):
    who = src.company_profiles(spark, d).select("ticker", "sector", "industry")
    return ds.one_hot(_price_m(spark, d).select("ticker", "date", "close").join(who, "ticker"))


@register(
    "S09_W11_esg_scores",
    fx.with_tables(
        "SELECT ticker, " + ", ".join(
            f"{fx.r6(f'max(CASE WHEN item = {item!r} THEN value END)')} AS {name}"
            for name, item in fu.ESG_ITEMS.items()
        ) + " FROM esg GROUP BY ticker",
        esg=fx.ESG,
    ),
)
def _s09(spark, d):
    return _round_doubles(fu.esg_scores(src.esg(spark, d)))


def _chained_fill_sql(base_sql: str, steps: list[tuple[str, str]], out_cols: list[str]) -> str:
    """DuckDB twin of the F11 chain: each step fills ``col`` with the median
    of its ``group`` computed on the previous step's output."""
    ctes = {"s0": base_sql}
    for i, (col, group) in enumerate(steps, start=1):
        prev = f"s{i - 1}"
        ctes[f"m{i}"] = f"SELECT {group}, median({col}) AS m FROM {prev} WHERE {group} IS NOT NULL GROUP BY {group}"
        ctes[f"s{i}"] = (f"SELECT {prev}.* REPLACE (coalesce({prev}.{col}, m{i}.m) AS {col}) "
                         f"FROM {prev} LEFT JOIN m{i} ON {prev}.{group} = m{i}.{group}")
    last = f"s{len(steps)}"
    return fx.with_tables(
        "SELECT ticker, " + ", ".join(f"{fx.r6(c)} AS {c}" for c in out_cols) + f" FROM {last}",
        **({"profile": fx.PROFILE, "esg": fx.ESG} | ctes),
    )


_ESG_STEPS = [(c, g) for c in ("esg_env", "esg_soc", "esg_gov") for g in ("sector", "industry", "country")]
_ESG_BASE = """SELECT p.ticker, p.sector, p.industry, p.country, p.trailing_peg,
  coalesce(p.dividend_yield, 0.0) AS dividend_yield, coalesce(p.days_to_next_earnings, 66.0) AS days_to_next_earnings,
  e.esg_env, e.esg_soc, e.esg_gov
FROM profile p LEFT JOIN (SELECT ticker,
  max(CASE WHEN item = 'environmentScore' THEN value END) AS esg_env,
  max(CASE WHEN item = 'socialScore' THEN value END) AS esg_soc,
  max(CASE WHEN item = 'governanceScore' THEN value END) AS esg_gov FROM esg GROUP BY ticker) e
ON p.ticker = e.ticker"""
_IMPUTE_COLS = ["trailing_peg", "esg_env", "esg_soc", "esg_gov", "dividend_yield", "days_to_next_earnings"]


@register(
    "C08_F11_esg_chain_imputation",
    _chained_fill_sql(_ESG_BASE, [("trailing_peg", "industry")] + _ESG_STEPS, _IMPUTE_COLS),
)
def _c08_esg(spark, d):
    prof = src.profile(spark, d).drop("esg_env")
    both = prof.join(fu.esg_scores(src.esg(spark, d)), "ticker", "left")
    return _round_doubles(ds.impute(both).select("ticker", *_IMPUTE_COLS))
