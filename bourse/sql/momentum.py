"""Oracle SQL for the momentum indicators.

Recurrences are written the sequential way (``WITH RECURSIVE`` walking one
row at a time per ticker), with the update formulas of the indicator
library; the Spark side uses the closed-form chunked scan.  Windows use
DuckDB's own list functions where Spark uses min_by / max_by.
"""

from __future__ import annotations

from .fixtures import bars, r6

W = "(PARTITION BY ticker ORDER BY rn)"


def f(n: int) -> str:
    return f"(PARTITION BY ticker ORDER BY rn ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def nz(x: str) -> str:
    return f"(({x}) <= -1e-8 OR ({x}) >= 1e-8)"


def _rec(name: str, cols: list[tuple[str, str, str]], seed_from: str, seed_row: int, src: str) -> str:
    """Recursive walk.  cols = (out, seed_expr, update_expr with p.<out> and m.<x>)."""
    anchor = ", ".join(f"{seed} AS {out}" for out, seed, _ in cols)
    step = ", ".join(f"{upd} AS {out}" for out, _, upd in cols)
    return f"""SELECT ticker, rn, {anchor} FROM {seed_from} WHERE rn = {seed_row}
  UNION ALL
  SELECT m.ticker, m.rn, {step} FROM {name} p JOIN {src} m ON m.ticker = p.ticker AND m.rn = p.rn + 1"""


def ctes(ticker: str = "type") -> dict[str, str]:
    k12, k26 = "(2.0/13)", "(2.0/27)"
    c = {
        "bars": bars(ticker),
        "mb": f"""SELECT ticker, date, open, high, low, close, volume,
  row_number() OVER (PARTITION BY ticker ORDER BY date) - 1 AS rn,
  lag(close) OVER (PARTITION BY ticker ORDER BY date) AS c1,
  high - lag(high) OVER (PARTITION BY ticker ORDER BY date) AS up,
  lag(low) OVER (PARTITION BY ticker ORDER BY date) - low AS down,
  close - lag(close) OVER (PARTITION BY ticker ORDER BY date) AS chg
FROM bars""",
        "mx": """SELECT *,
  CASE WHEN c1 IS NULL THEN high - low ELSE greatest(high - low, abs(high - c1), abs(low - c1)) END AS tr,
  CASE WHEN up > 0 AND up > down THEN up WHEN up IS NOT NULL THEN 0.0 END AS pdm,
  CASE WHEN down > 0 AND up < down THEN down WHEN down IS NOT NULL THEN 0.0 END AS mdm,
  CASE WHEN chg > 0 THEN chg WHEN chg IS NOT NULL THEN 0.0 END AS gain,
  CASE WHEN chg < 0 THEN -chg WHEN chg IS NOT NULL THEN 0.0 END AS loss,
  (high + low + close) / 3 AS tp,
  close - (CASE WHEN c1 IS NULL OR low < c1 THEN low ELSE c1 END) AS bp
FROM mb""",
        "sw": f"""SELECT *,
  avg(close) OVER {f(12)} AS sma12, avg(close) OVER {f(26)} AS sma26,
  lag(close, 10) OVER {W} AS c10,
  min(low) OVER {f(5)} AS ll5, max(high) OVER {f(5)} AS hh5,
  min(low) OVER {f(14)} AS ll14, max(high) OVER {f(14)} AS hh14,
  list(low) OVER {f(15)} AS lows15, list(high) OVER {f(15)} AS highs15,
  avg(tp) OVER {f(14)} AS tp_avg,
  list(tp) OVER {f(14)} AS tps14,
  sum(bp) OVER {f(7)} AS bp7, sum(bp) OVER {f(14)} AS bp14, sum(bp) OVER {f(28)} AS bp28,
  sum(tr) OVER {f(7)} AS tr7, sum(tr) OVER {f(14)} AS tr14, sum(tr) OVER {f(28)} AS tr28
FROM mx""",
        "sx": f"""SELECT *,
  list_position(list_reverse(lows15), list_min(lows15)) - 1 AS since_low,
  list_position(list_reverse(highs15), list_max(highs15)) - 1 AS since_high,
  list_sum(list_transform(tps14, lambda x: abs(x - tp_avg))) AS mad,
  CASE WHEN hh5 - ll5 <> 0 THEN (close - ll5) / ((hh5 - ll5) / 100.0) ELSE 0.0 END AS fastk_raw,
  sma12 - sma26 AS macd_ext_line
FROM sw""",
        "sy": f"""SELECT *, avg(fastk_raw) OVER {f(3)} AS fastk3, avg(macd_ext_line) OVER {f(9)} AS macd_ext_sig
FROM sx""",
        "sz": f"SELECT *, avg(fastk3) OVER {f(3)} AS slowd_full FROM sy",
        "seed1": f"""SELECT ticker, rn, sum(tr) OVER {f(13)} AS tr13, sum(pdm) OVER {f(13)} AS pdm13,
  sum(mdm) OVER {f(13)} AS mdm13, avg(gain) OVER {f(14)} AS gain14, avg(loss) OVER {f(14)} AS loss14,
  avg(close) OVER {f(12)} AS c12, avg(close) OVER {f(26)} AS c26, avg(close) OVER {f(30)} AS c30
FROM mx""",
        "wil": _rec(
            "wil",
            [
                ("s_tr", "tr13", "p.s_tr - p.s_tr / 14 + m.tr"),
                ("s_pdm", "pdm13", "p.s_pdm - p.s_pdm / 14 + m.pdm"),
                ("s_mdm", "mdm13", "p.s_mdm - p.s_mdm / 14 + m.mdm"),
            ],
            "seed1", 13, "mx",
        ),
        "rs": _rec(
            "rs",
            [
                ("g", "gain14", "(p.g * 13 + m.gain) / 14"),
                ("l", "loss14", "(p.l * 13 + m.loss) / 14"),
            ],
            "seed1", 14, "mx",
        ),
        "em": _rec(
            "em",
            [
                ("e12", "c12", f"(m.close - p.e12) * {k12} + p.e12"),
                ("e26", "c26", f"(m.close - p.e26) * {k26} + p.e26"),
                ("f12", "c12", "(m.close - p.f12) * 0.15 + p.f12"),
                ("f26", "c26", "(m.close - p.f26) * 0.075 + p.f26"),
            ],
            "seed1", 25, "mx",
        ),
        "t1": _rec("t1", [("e", "c30", "(m.close - p.e) * (2.0/31) + p.e")], "seed1", 29, "mx"),
        "t1s": f"SELECT ticker, rn, e AS x, avg(e) OVER {f(30)} AS s FROM t1",
        "t2": _rec("t2", [("e", "s", "(m.x - p.e) * (2.0/31) + p.e")], "t1s", 58, "t1s"),
        "t2s": f"SELECT ticker, rn, e AS x, avg(e) OVER {f(30)} AS s FROM t2",
        "t3": _rec("t3", [("e", "s", "(m.x - p.e) * (2.0/31) + p.e")], "t2s", 87, "t2s"),
        "t3l": f"SELECT ticker, rn, e, lag(e) OVER {W} AS e_prev FROM t3",
        "dxs": f"""SELECT m.ticker, m.rn, w.s_tr, w.s_pdm, w.s_mdm,
  CASE WHEN {nz('w.s_tr')} THEN 100.0 * (w.s_pdm / w.s_tr) ELSE 0.0 END AS pdi,
  CASE WHEN {nz('w.s_tr')} AND {nz('100.0 * (w.s_pdm / w.s_tr) + 100.0 * (w.s_mdm / w.s_tr)')}
       THEN 100.0 * (abs(100.0 * (w.s_mdm / w.s_tr) - 100.0 * (w.s_pdm / w.s_tr))
                     / (100.0 * (w.s_mdm / w.s_tr) + 100.0 * (w.s_pdm / w.s_tr)))
       ELSE 0.0 END AS dx
FROM mx m JOIN wil w ON m.ticker = w.ticker AND m.rn = w.rn""",
        "dxseed": f"SELECT ticker, rn, dx, avg(dx) OVER {f(14)} AS dx14 FROM dxs",
        "adx": _rec("adx", [("a", "dx14", "(p.a * 13 + m.dx) / 14")], "dxseed", 27, "dxseed"),
        "adxl": f"SELECT ticker, rn, a, lag(a, 13) OVER {W} AS a13 FROM adx",
        "ml": f"""SELECT ticker, rn, e12 - e26 AS line, f12 - f26 AS fline,
  avg(e12 - e26) OVER {f(9)} AS line9, avg(f12 - f26) OVER {f(9)} AS fline9 FROM em""",
        "sig": _rec(
            "sig",
            [
                ("s", "line9", "(m.line - p.s) * 0.2 + p.s"),
                ("fs", "fline9", "(m.fline - p.fs) * 0.2 + p.fs"),
            ],
            "ml", 33, "ml",
        ),
        "rsi": f"""SELECT ticker, rn, CASE WHEN {nz('g + l')} THEN 100.0 * (g / (g + l)) ELSE 0.0 END AS rsi,
  CASE WHEN {nz('g + l')} THEN 100.0 * ((g - l) / (g + l)) ELSE 0.0 END AS cmo FROM rs""",
        "srsi": f"""SELECT ticker, rn, rsi, min(rsi) OVER {f(5)} AS lo5, max(rsi) OVER {f(5)} AS hi5 FROM rsi""",
        "srsik": """SELECT ticker, rn,
  CASE WHEN hi5 - lo5 <> 0 THEN (rsi - lo5) / ((hi5 - lo5) / 100.0) ELSE 0.0 END AS k FROM srsi""",
        "srsid": f"SELECT ticker, rn, k, avg(k) OVER {f(3)} AS d FROM srsik",
    }
    return c


def _j(cte: str) -> str:
    return f" LEFT JOIN {cte} ON {cte}.ticker = sz.ticker AND {cte}.rn = sz.rn"


# indicator -> (CTEs to join besides the window chain, value expression, first row)
F100 = "(100.0 / 14)"
INDICATORS: dict[str, tuple[list[str], str, int]] = {
    "apo": ([], "sma12 - sma26", 25),
    "ppo": ([], f"CASE WHEN {nz('sma26')} THEN ((sma12 - sma26) / sma26) * 100.0 ELSE 0.0 END", 25),
    "aroon_1": ([], f"{F100} * (14 - since_low)", 14),
    "aroon_2": ([], f"{F100} * (14 - since_high)", 14),
    "aroonosc": ([], f"{F100} * (since_low - since_high)", 14),
    "bop": ([], "CASE WHEN high - low < 1e-8 THEN 0.0 ELSE (close - open) / (high - low) END", 0),
    "cci": ([], "CASE WHEN tp - tp_avg <> 0 AND mad <> 0 THEN (tp - tp_avg) / (0.015 * (mad / 14.0)) ELSE 0.0 END", 13),
    "mom": ([], "close - c10", 10),
    "roc": ([], "CASE WHEN c10 <> 0 THEN ((close / c10) - 1.0) * 100.0 ELSE 0.0 END", 10),
    "rocp": ([], "CASE WHEN c10 <> 0 THEN (close - c10) / c10 ELSE 0.0 END", 10),
    "rocr": ([], "CASE WHEN c10 <> 0 THEN close / c10 ELSE 0.0 END", 10),
    "rocr100": ([], "CASE WHEN c10 <> 0 THEN (close / c10) * 100.0 ELSE 0.0 END", 10),
    "ultosc": (
        [],
        f"""100.0 * ((CASE WHEN {nz('tr7')} THEN 4.0 * (bp7 / tr7) ELSE 0.0 END
  + CASE WHEN {nz('tr14')} THEN 2.0 * (bp14 / tr14) ELSE 0.0 END
  + CASE WHEN {nz('tr28')} THEN bp28 / tr28 ELSE 0.0 END) / 7.0)""",
        28,
    ),
    "willr": ([], "CASE WHEN hh14 - ll14 <> 0 THEN (hh14 - close) / ((hh14 - ll14) / (-100.0)) ELSE 0.0 END", 13),
    "fastk": ([], "fastk_raw", 6),
    "fastd": ([], "fastk3", 6),
    "slowk": ([], "fastk3", 8),
    "slowd": ([], "slowd_full", 8),
    "macd_ext": ([], "macd_ext_line", 33),
    "macdsignal_ext": ([], "macd_ext_sig", 33),
    "macdhist_ext": ([], "macd_ext_line - macd_ext_sig", 33),
    "dm": (["wil"], "wil.s_pdm", 13),
    "minus_di": (["wil"], "wil.s_mdm", 13),
    "plus_di": (["dxs"], "dxs.pdi", 14),
    "dx": (["dxs"], "dxs.dx", 14),
    "adx": (["adxl"], "adxl.a", 27),
    "adxr": (["adxl"], "(adxl.a + adxl.a13) / 2.0", 40),
    "rsi": (["rsi"], "rsi.rsi", 14),
    "cmo": (["rsi"], "rsi.cmo", 14),
    "macd": (["ml"], "ml.line", 33),
    "macdsignal": (["sig"], "sig.s", 33),
    "macdhist": (["ml", "sig"], "ml.line - sig.s", 33),
    "macd_fix": (["ml"], "ml.fline", 33),
    "macdsignal_fix": (["sig"], "sig.fs", 33),
    "macdhist_fix": (["ml", "sig"], "ml.fline - sig.fs", 33),
    "fastk_rsi": (["srsid"], "srsid.k", 20),
    "fastd_rsi": (["srsid"], "srsid.d", 20),
    "trix": (["t3l"], "CASE WHEN t3l.e_prev <> 0 THEN ((t3l.e / t3l.e_prev) - 1.0) * 100.0 ELSE 0.0 END", 88),
}

# CTE dependencies (transitive closure is taken below)
DEPS = {
    "mb": ["bars"], "mx": ["mb"], "sw": ["mx"], "sx": ["sw"], "sy": ["sx"], "sz": ["sy"],
    "seed1": ["mx"], "wil": ["seed1", "mx"], "rs": ["seed1", "mx"], "em": ["seed1", "mx"],
    "t1": ["seed1", "mx"], "t1s": ["t1"], "t2": ["t1s"], "t2s": ["t2"], "t3": ["t2s"], "t3l": ["t3"],
    "dxs": ["mx", "wil"], "dxseed": ["dxs"], "adx": ["dxseed"], "adxl": ["adx"],
    "ml": ["em"], "sig": ["ml"], "rsi": ["rs"], "srsi": ["rsi"], "srsik": ["srsi"], "srsid": ["srsik"],
    "bars": [],
}


def _closure(names: list[str]) -> list[str]:
    out: list[str] = []

    def visit(n):
        for d in DEPS[n]:
            visit(d)
        if n not in out:
            out.append(n)

    for n in names:
        visit(n)
    return out


def indicator_sql(name: str, ticker: str = "type") -> str:
    joins, expr, first = INDICATORS[name]
    all_ctes = ctes(ticker)
    needed = _closure(["sz", *joins])
    body = ",\n".join(f"{n} AS ({all_ctes[n]}\n)" for n in needed)
    join_sql = "".join(_j(j) for j in joins)
    return (
        f"WITH RECURSIVE {body}\n"
        f"SELECT sz.ticker, sz.date, CASE WHEN sz.rn >= {first} THEN {r6(expr)} END AS {name}\n"
        f"FROM sz{join_sql}"
    )


def all_indicators_sql(ticker: str = "type") -> tuple[str, str]:
    """(WITH-clause, select-list) computing every indicator from ``sz``."""
    joins = []
    for j, _, _ in INDICATORS.values():
        for x in j:
            if x not in joins:
                joins.append(x)
    all_ctes = ctes(ticker)
    needed = _closure(["sz", *joins])
    body = ",\n".join(f"{n} AS ({all_ctes[n]}\n)" for n in needed)
    cols = ", ".join(
        f"CASE WHEN sz.rn >= {first} THEN {expr} END AS {name}" for name, (_, expr, first) in INDICATORS.items()
    )
    frm = "FROM sz" + "".join(_j(j) for j in joins)
    return f"WITH RECURSIVE {body},\nmom AS (SELECT sz.ticker, sz.date, {cols} {frm})\n", "mom"


def momentum_daily_sql(ticker: str = "type") -> str:
    head, t = all_indicators_sql(ticker)
    return head + f"SELECT ticker, date, {', '.join(r6(n) + ' AS ' + n for n in INDICATORS)} FROM {t}"


def momentum_monthly_sql(ticker: str = "type") -> str:
    head, t = all_indicators_sql(ticker)
    meds = ", ".join(f"median({n}) AS {n}" for n in INDICATORS)
    where = " AND ".join(f"{n} IS NOT NULL" for n in INDICATORS)
    return (
        head
        + f", mm AS (SELECT ticker, last_day(date) AS date, {meds} FROM {t} GROUP BY ticker, last_day(date))\n"
        + f"SELECT ticker, date, {', '.join(r6(n) + ' AS ' + n for n in INDICATORS)} FROM mm WHERE {where}"
    )
