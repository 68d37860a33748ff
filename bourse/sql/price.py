"""Oracle SQL for C01 (monthly price features) and its steps."""

from .fixtures import bars, div, r6

GROWTH_LAGS = {"daily_growth": 1, "weekly_growth": 5, "biweekly_growth": 10, "monthly_growth": 21}
MIN_MED_MAX = ["ln_volume", *GROWTH_LAGS]
MEDIAN_ONLY = ["rel_spread_oc", "rel_spread_hl", "vol_10d_mean", "vol_10d_std", "vol_10d_min", "vol_10d_max"]
AGG_COLS = ["close"] + [f"{c}_{f}" for c in MIN_MED_MAX for f in ("min", "median", "max")] + [
    f"{c}_median" for c in MEDIAN_ONLY
]
TAIL = ["return_1m", "return_2m", "return_3m", "vol_3m", "momentum_3m", "mma_3_scaled", "mma_6_scaled"]

W = "(PARTITION BY ticker ORDER BY date)"


def framed(n: int) -> str:
    return f"(PARTITION BY ticker ORDER BY date ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def masked(agg: str, x: str, n: int) -> str:
    return f"CASE WHEN count({x}) OVER {framed(n)} = {n} THEN {agg}({x}) OVER {framed(n)} END"


def daily_ctes(ticker: str = "type") -> dict:
    growth = ",\n  ".join(
        f"{div('cff', f'lag(cff, {n}) OVER {W}')} - 1 AS {name}" for name, n in GROWTH_LAGS.items()
    )
    return {
        "bars": bars(ticker),
        "d0": f"""SELECT *, last_value(close IGNORE NULLS) OVER
  (PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cff FROM bars""",
        "d1": f"""SELECT ticker, date, open, high, low, close, volume,
  ln(CASE WHEN volume = 0 THEN NULL ELSE volume END) AS ln_volume,
  {growth},
  {div('open - close', 'close')} AS rel_spread_oc,
  {div('high - low', 'close')} AS rel_spread_hl
FROM d0""",
        "daily": f"""SELECT *,
  {masked('avg', 'daily_growth', 10)} AS vol_10d_mean,
  {masked('stddev_samp', 'daily_growth', 10)} AS vol_10d_std,
  {masked('min', 'daily_growth', 10)} AS vol_10d_min,
  {masked('max', 'daily_growth', 10)} AS vol_10d_max
FROM d1""",
    }


def monthly_agg_ctes(ticker: str = "type") -> dict:
    aggs = ["arg_max(close, date) FILTER (WHERE close IS NOT NULL) AS close"]
    for c in MIN_MED_MAX:
        aggs += [f"min({c}) AS {c}_min", f"median({c}) AS {c}_median", f"max({c}) AS {c}_max"]
    aggs += [f"median({c}) AS {c}_median" for c in MEDIAN_ONLY]
    return daily_ctes(ticker) | {
        "monthly": f"""SELECT ticker, last_day(date) AS date, {', '.join(aggs)}
FROM daily GROUP BY ticker, last_day(date)""",
    }


def price_ctes(ticker: str = "type") -> dict:
    m_cols = ", ".join(f"m.{c}" for c in AGG_COLS)
    rets = ",\n  ".join(f"{div('cff', f'lag(cff, {k}) OVER {W}')} - 1 AS return_{k}m" for k in (1, 2, 3))
    out = ["date"] + [r6(c) + f" AS {c}" for c in AGG_COLS + TAIL] + [
        "CAST(year(date) AS INTEGER) AS year", "CAST(month(date) AS INTEGER) AS month", "ticker"
    ]
    return monthly_agg_ctes(ticker) | {
        "grid": """SELECT ticker, last_day(CAST(g AS DATE)) AS date FROM (
  SELECT ticker, unnest(generate_series(CAST(date_trunc('month', min(date)) AS DATE),
                                        CAST(date_trunc('month', max(date)) AS DATE), INTERVAL 1 MONTH)) AS g
  FROM monthly GROUP BY ticker)""",
        "mg": f"""SELECT g.ticker, g.date, {m_cols} FROM grid g LEFT JOIN monthly m
  ON g.ticker = m.ticker AND g.date = m.date""",
        "mf": """SELECT *, last_value(close IGNORE NULLS) OVER
  (PARTITION BY ticker ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cff FROM mg""",
        "mr": f"SELECT *, {rets} FROM mf",
        "mv": f"""SELECT *, {masked('stddev_samp', 'return_1m', 3)} AS vol_3m,
  {div(masked('avg', 'close', 3), 'close')} AS mma_3_scaled,
  {div(masked('avg', 'close', 6), 'close')} AS mma_6_scaled FROM mr""",
        "mm": f"""SELECT *, CASE WHEN vol_3m <> 0 THEN return_3m / vol_3m END AS momentum_3m FROM mv""",
        "price": f"SELECT {', '.join(out)} FROM mm",
    }


def price_sql(ticker: str = "type") -> str:
    from .fixtures import with_tables

    cols = ["date"] + AGG_COLS + TAIL + ["year", "month", "ticker"]
    where = " AND ".join(f"{c} IS NOT NULL" for c in cols)
    return with_tables(f"SELECT * FROM price WHERE {where}", **price_ctes(ticker))
