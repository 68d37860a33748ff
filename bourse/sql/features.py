"""Oracle SQL for series alignment (C05 / C06), fundamentals (C02) and the
universe (C12)."""

from __future__ import annotations

from ..plans import fundamentals as fu
from ..plans import series as se
from . import fixtures as fx
from .fixtures import r6


def _pivot(names: dict[str, str], src: str) -> str:
    cols = ", ".join(
        f"arg_max(value, date) FILTER (WHERE series = '{code}' AND value IS NOT NULL) AS {name}"
        for name, code in names.items()
    )
    return f"SELECT last_day(date) AS date, {cols} FROM {src} GROUP BY last_day(date)"


def macro_sql(names: dict[str, str] = se.FIXTURE_MACRO) -> str:
    codes = ", ".join(f"'{c}'" for c in names.values())
    fills = ", ".join(
        f"last_value({n} IGNORE NULLS) OVER (ORDER BY g.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS {n}"
        for n in names
    )
    return fx.with_tables(
        f"SELECT g.date, {fills} FROM grid g LEFT JOIN wide w ON g.date = w.date",
        macro=fx.MACRO,
        m=f"SELECT * FROM macro WHERE series IN ({codes})",
        wide=_pivot(names, "m"),
        grid="""SELECT last_day(CAST(unnest(generate_series(CAST(date_trunc('month', min(date)) AS DATE),
  CAST(date_trunc('month', max(date)) AS DATE), INTERVAL 1 MONTH)) AS DATE)) AS date FROM wide""",
    )


def market_sql(names: dict[str, str] = se.FIXTURE_MARKET) -> str:
    codes = ", ".join(f"'{c}'" for c in names.values())
    return fx.with_tables(
        f"SELECT g.date, {', '.join('w.' + n for n in names)} FROM months g LEFT JOIN wide w ON g.date = w.date",
        market=fx.MARKET,
        m=f"SELECT * FROM market WHERE series IN ({codes})",
        wide=_pivot(names, "m"),
        months="""SELECT DISTINCT last_day(CAST(g AS DATE)) AS date FROM (
  SELECT unnest(generate_series(CAST(date_trunc('month', min(date)) AS DATE),
                                CAST(date_trunc('month', max(date)) AS DATE), INTERVAL 1 MONTH)) AS g
  FROM m GROUP BY series)""",
    )


def latest_items_sql(items: dict[str, str] = fu.FIXTURE_ITEMS) -> str:
    cols = []
    for role, item in items.items():
        cond = f"item = '{item}'" if role in fu.LATEST_WITH_NULL else f"item = '{item}' AND value IS NOT NULL"
        # arg_max ignores a null value; pick the value at the newest asof instead
        cols.append(
            f"max(CASE WHEN {cond} THEN \"asof\" END) AS {role}_asof"
        )
    picks = ", ".join(
        f"max(CASE WHEN s.item = '{item}' AND s.\"asof\" = l.{role}_asof THEN s.value END) AS {role}"
        for role, item in items.items()
    )
    return f"""SELECT s.ticker, {picks}
FROM statements s JOIN (SELECT ticker, {', '.join(cols)} FROM statements GROUP BY ticker) l ON s.ticker = l.ticker
GROUP BY s.ticker"""


def _div(a, b):
    return fx.div(a, b)


def fundamentals_sql(end_date: str, items: dict[str, str] = fu.TICKER_ITEMS, ticker: str = "type") -> str:
    ratios = f"""SELECT ticker,
  {_div('total_liabilities', 'total_equity')} AS debt_to_equity,
  {_div('current_assets', 'current_liabilities')} AS current_ratio,
  {_div('cash', 'current_liabilities')} AS cash_ratio,
  working_capital,
  {_div('working_capital', 'total_assets')} AS working_capital_ratio,
  {_div('retained_earnings', 'total_assets')} AS retained_earnings_to_assets,
  {_div('long_term_debt', 'total_equity')} AS long_term_debt_to_equity, operating_cf, free_cf
FROM latest"""
    recent = ", ".join(f"'{p}'" for p in fu.RECENT_PERIODS)
    tot = " + ".join(fu.RATING_COLUMNS)
    ratings = f"""SELECT ticker, sum(CASE WHEN period IN ({recent}) THEN {tot} ELSE 0 END) AS t,
  sum(CASE WHEN period IN ({recent}) THEN strong_buy ELSE 0 END) AS sb FROM recommendations GROUP BY ticker"""
    divs = """SELECT y.ticker, y.year, coalesce(d.amount, 0.0) AS amount FROM (
  SELECT ticker, unnest(range(min(year(date)), max(year(date)) + 1)) AS year FROM dividends GROUP BY ticker) y
  LEFT JOIN (SELECT ticker, year(date) AS year, sum(amount) AS amount FROM dividends GROUP BY ticker, year(date)) d
  ON y.ticker = d.ticker AND y.year = d.year"""
    stab = """SELECT ticker, CASE WHEN count(amount) > 1 AND avg(amount) <> 0 THEN stddev_samp(amount) / avg(amount) END
  AS dividend_stability FROM divs GROUP BY ticker"""
    parts = [
        "SELECT * FROM ratios",
        "SELECT ticker, avg(pct_held) AS pct_held_by_inst, count(*) AS institutional_holders_count FROM holders GROUP BY ticker",
        "SELECT ticker, t AS recent_rating_changes, CASE WHEN t <> 0 THEN CAST(sb AS DOUBLE) / t END AS strong_to_total_reco_ratio FROM ratings",
        f"SELECT ticker, CAST(datediff('day', DATE '{end_date}', min(earnings_date)) AS DOUBLE) AS days_to_next_earnings FROM calendar GROUP BY ticker",
        "SELECT * FROM stab",
        "SELECT * FROM profile",
        "SELECT ticker, " + ", ".join(f"max(CASE WHEN item = '{i}' THEN value END) AS {c}" for c, i in fu.ESG_ITEMS.items()) + " FROM esg GROUP BY ticker",
    ]
    stacked = "\nUNION ALL BY NAME\n".join(f"({p})" for p in parts)
    dbl = ["debt_to_equity", "current_ratio", "cash_ratio", "working_capital", "working_capital_ratio",
           "retained_earnings_to_assets", "long_term_debt_to_equity",
           "pct_held_by_inst", "strong_to_total_reco_ratio", "days_to_next_earnings", "dividend_stability",
           "market_cap", "beta", "trailing_pe", "forward_pe", "trailing_peg", "price_to_book", "dividend_yield",
           "esg_env", "esg_soc", "esg_gov"]
    margins = [f"{r6(f'CASE WHEN max({c}) <> 0 AND max(revenue) <> 0 THEN max({c}) / max(revenue) END')} AS {c}_margin"
               for c in ("operating_cf", "free_cf")]
    sel = ["ticker"] + [f"{r6('max(' + c + ')')} AS {c}" for c in dbl] + margins + [
        "max(company_name) AS company_name", "max(full_time_employees) AS full_time_employees",
        "max(institutional_holders_count) AS institutional_holders_count",
        "coalesce(max(recent_rating_changes), 0) AS recent_rating_changes",
        "max(sector) AS sector", "max(industry) AS industry", "max(country) AS country",
    ]
    return fx.with_tables(
        f"SELECT {', '.join(sel)} FROM stacked GROUP BY ticker",
        **fx.company_tables(ticker), latest=latest_items_sql(items), ratios=ratios, ratings=ratings, divs=divs, stab=stab,
        stacked=stacked,
    )


def top_tickers_sql(n: int, scale_suffix: bool = False) -> str:
    num = "TRY_CAST(replace(replace(replace(replace(market_cap, '$', ''), 'B', ''), 'M', ''), ',', '') AS DOUBLE)"
    cap = num
    if scale_suffix:
        cap = f"CASE WHEN market_cap LIKE '%B' THEN {num} * 1e9 WHEN market_cap LIKE '%M' THEN {num} * 1e6 ELSE {num} END"
    return fx.with_tables(
        f"SELECT symbol, company, market_cap, {cap} AS market_cap_value FROM listing "
        f"ORDER BY market_cap_value DESC NULLS LAST, symbol LIMIT {n}",
        listing=fx.LISTING,
    )
