"""Candlestick pattern specification.

Each pattern is a boolean over the shape columns of the current bar (offset
0) and up to four bars back, plus per-bar thresholds.  The reference only
calls the patterns; these predicates are our specification, written from
the published candlestick literature and the conventions of the common
indicator library (default candle settings, 10-bar and 5-bar averages taken
over the bars *before* the bar they qualify).

Column vocabulary at offset k (k = 0..4):

* o{k} h{k} l{k} c{k}     prices
* body{k}  |c - o|;   up{k}  h - max(o, c);   lo{k}  min(o, c) - l
* rng{k}   h - l;     top{k} max(o, c);       bot{k} min(o, c)
* col{k}   +1 white (c >= o), -1 black
* bl{k}    mean body of the 10 bars before     (Long: body > bl, Short: body < bl)
* dj{k}    0.1 * mean range of the 10 before   (Doji: body <= dj)
* vs{k}    0.1 * mean range of the 10 before   (very short shadow)
* ss{k}    mean (up + lo) of the 10 before / 2 (short shadow)
* nr{k}    0.2 * mean range of the 5 before    (near)
* fr{k}    0.6 * mean range of the 5 before    (far)
* eq{k}    0.05 * mean range of the 5 before   (equal)

The oracle (``sql.patterns``) is written apart from them.
"""

from __future__ import annotations

import re

# Fixed values of the candle conventions: averaging period and factor per
# threshold (defaults of the common indicator library's candle settings).
THRESHOLDS = {
    "bl": ("body", 10, 1.0),
    "dj": ("rng", 10, 0.1),
    "vs": ("rng", 10, 0.1),
    "ss": ("shd", 10, 0.5),
    "nr": ("rng", 5, 0.2),
    "fr": ("rng", 5, 0.6),
    "eq": ("rng", 5, 0.05),
}
SHAPES = ["o", "h", "l", "c", "body", "up", "lo", "rng", "top", "bot", "col"]
MAX_OFFSET = 4
PENETRATION = 0.0  # the reference passes penetration=0 to the seven patterns that take it


def W(k):
    return f"col{k} = 1"


def B(k):
    return f"col{k} = -1"


def long_(k):
    return f"body{k} > bl{k}"


def short(k):
    return f"body{k} < bl{k}"


def doji(k, at=None):
    return f"body{k} <= dj{k if at is None else at}"


def gap_up(a, b):
    return f"bot{a} > top{b}"


def gap_down(a, b):
    return f"top{a} < bot{b}"


def within(x, y, thr):
    return f"{x} <= {y} + {thr} AND {x} >= {y} - {thr}"


def inside(x, k):
    return f"{x} > bot{k} AND {x} < top{k}"


def all_(*parts):
    return " AND ".join(f"({p})" for p in parts)


def any_(*parts):
    return " OR ".join(f"({p})" for p in parts)


def _patterns(p: float) -> dict[str, tuple[str, str]]:
    pen = f"{p!r}"
    return {
        "cdl2crows": (
            all_(W(2), long_(2), B(1), gap_up(1, 2), B(0), "o0 < o1", "o0 > c1", "c0 > o2", "c0 < c2"),
            "-100",
        ),
        "cdl3blackrows": (
            all_(W(3), B(2), "lo2 < vs2", B(1), "lo1 < vs1", B(0), "lo0 < vs0",
                 "o1 < o2", "o1 > c2", "o0 < o1", "o0 > c1", "h3 > c2", "c2 > c1", "c1 > c0"),
            "-100",
        ),
        "cdl3inside": (
            all_(long_(2), short(1), "top1 < top2", "bot1 > bot2",
                 any_(all_(W(2), B(0), "c0 < o2"), all_(B(2), W(0), "c0 > o2"))),
            "-100 * col2",
        ),
        "cdl3linestrike": (
            all_("col3 = col2", "col2 = col1", "col0 = -col1",
                 "o2 >= bot3 - nr3", "o2 <= top3 + nr3", "o1 >= bot2 - nr2", "o1 <= top2 + nr2",
                 any_(all_(W(1), "c1 > c2", "c2 > c3", "o0 > c1", "c0 < o3"),
                      all_(B(1), "c1 < c2", "c2 < c3", "o0 < c1", "c0 > o3"))),
            "100 * col1",
        ),
        "cdl3outside": (
            any_(all_(W(1), B(2), "c1 > o2", "o1 < c2", "c0 > c1"),
                 all_(B(1), W(2), "o1 > c2", "c1 < o2", "c0 < c1")),
            "100 * col1",
        ),
        "cdl3starsinsouth": (
            all_(B(2), B(1), B(0), long_(2), "lo2 > body2",
                 "body1 < body2", "o1 > c2", "o1 <= h2", "l1 < c2", "l1 >= l2", "lo1 > vs1",
                 short(0), "lo0 < vs0", "up0 < vs0", "l0 > l1", "h0 < h1"),
            "100",
        ),
        "cdl3whitesoldiers": (
            all_(W(2), "up2 < vs2", W(1), "up1 < vs1", W(0), "up0 < vs0",
                 "c0 > c1", "c1 > c2", "o1 > o2", "o1 <= c2 + nr2", "o0 > o1", "o0 <= c1 + nr1",
                 "body1 > body2 - fr2", "body0 > body1 - fr1", "body0 > bl0"),
            "100",
        ),
        "cdlabandonedbaby": (
            all_(long_(2), doji(1), "body0 > bl0",
                 any_(all_(W(2), B(0), f"c0 < c2 - body2 * {pen}", "l1 > h2", "h0 < l1"),
                      all_(B(2), W(0), f"c0 > c2 + body2 * {pen}", "h1 < l2", "l0 > h1"))),
            "100 * col0",
        ),
        "cdladvancedblock": (
            all_(W(2), W(1), W(0), "c0 > c1", "c1 > c2",
                 "o1 > o2", "o1 <= c2 + nr2", "o0 > o1", "o0 <= c1 + nr1",
                 long_(2), "up2 < ss2",
                 any_(all_("body1 < body2 - fr2", "body0 < body1 + nr1"),
                      "body0 < body1 - fr1",
                      all_("body0 < body1", "body1 < body2", any_("up0 > ss0", "up1 > ss1")),
                      all_("body0 < body1", "up0 > body0"))),
            "-100",
        ),
        "cdlbelthold": (
            all_(long_(0), any_(all_(W(0), "lo0 < vs0"), all_(B(0), "up0 < vs0"))),
            "100 * col0",
        ),
        "cdlbreakaway": (
            all_(long_(4), "col4 = col3", "col3 = col1", "col1 = -col0",
                 any_(all_(B(4), gap_down(3, 4), "h2 < h3", "l2 < l3", "h1 < h2", "l1 < l2",
                           "c0 > o3", "c0 < c4"),
                      all_(W(4), gap_up(3, 4), "h2 > h3", "l2 > l3", "h1 > h2", "l1 > l2",
                           "c0 < o3", "c0 > c4"))),
            "100 * col0",
        ),
        "cdlclosingmarubozu": (
            all_(long_(0), any_(all_(W(0), "up0 < vs0"), all_(B(0), "lo0 < vs0"))),
            "100 * col0",
        ),
        "cdlconcealbabyswall": (
            all_(B(3), B(2), B(1), B(0), "lo3 < vs3", "up3 < vs3", "lo2 < vs2", "up2 < vs2",
                 gap_down(1, 2), "up1 > vs1", "h1 > c2", "h0 > h1", "l0 < l1"),
            "100",
        ),
        "cdlcounterattack": (
            all_("col1 = -col0", long_(1), long_(0), within("c0", "c1", "eq1")),
            "100 * col0",
        ),
        "cdldarkcloudcover": (
            all_(W(1), long_(1), B(0), "o0 > h1", "c0 > o1", f"c0 < c1 - body1 * {pen}"),
            "-100",
        ),
        "cdldoji": (doji(0), "100"),
        "cdldojistar": (
            all_(long_(1), doji(0), any_(all_(W(1), gap_up(0, 1)), all_(B(1), gap_down(0, 1)))),
            "-100 * col1",
        ),
        "cdldragonflydoji": (all_(doji(0), "up0 < vs0", "lo0 > vs0"), "100"),
        "cdlengulfing": (
            any_(all_(W(0), B(1), any_(all_("c0 >= o1", "o0 < c1"), all_("c0 > o1", "o0 <= c1"))),
                 all_(B(0), W(1), any_(all_("o0 >= c1", "c0 < o1"), all_("o0 > c1", "c0 <= o1")))),
            "100 * col0",
        ),
        "cdleveningdojistar": (
            all_(W(2), long_(2), doji(1), gap_up(1, 2), "body0 > bl0", B(0), f"c0 < c2 - body2 * {pen}"),
            "-100",
        ),
        "cdleveningstar": (
            all_(W(2), long_(2), short(1), gap_up(1, 2), "body0 > bl0", B(0), f"c0 < c2 - body2 * {pen}"),
            "-100",
        ),
        "cdlgapsidesidewhite": (
            all_(any_(all_(gap_up(1, 2), gap_up(0, 2)), all_(gap_down(1, 2), gap_down(0, 2))),
                 W(1), W(0), within("body0", "body1", "nr1"), within("o0", "o1", "eq1")),
            f"CASE WHEN {gap_up(1, 2)} THEN 100 ELSE -100 END",
        ),
        "cdlgravestonedoji": (all_(doji(0), "lo0 < vs0", "up0 > vs0"), "100"),
        "cdlhammer": (all_(short(0), "lo0 > body0", "up0 < vs0", "bot0 <= l1 + nr1"), "100"),
        "cdlhangingman": (all_(short(0), "lo0 > body0", "up0 < vs0", "bot0 >= h1 - nr1"), "-100"),
        "cdlharami": (all_(long_(1), short(0), "top0 < top1", "bot0 > bot1"), "-100 * col1"),
        "cdlharamicross": (all_(long_(1), doji(0), "top0 < top1", "bot0 > bot1"), "-100 * col1"),
        "cdlhighwave": (all_(short(0), "up0 > 2 * body0", "lo0 > 2 * body0"), "100 * col0"),
        "cdlhomingpigeon": (all_(B(1), long_(1), B(0), short(0), "o0 < o1", "c0 > c1"), "100"),
        "cdlidentical3crows": (
            all_(B(2), "lo2 < vs2", B(1), "lo1 < vs1", B(0), "lo0 < vs0", "c2 > c1", "c1 > c0",
                 within("o1", "c2", "eq2"), within("o0", "c1", "eq1")),
            "-100",
        ),
        "cdlinneck": (all_(B(1), long_(1), W(0), "o0 < l1", "c0 <= c1 + eq1", "c0 >= c1"), "-100"),
        "cdlinvertedhammer": (all_(short(0), "up0 > body0", "lo0 < vs0", gap_down(0, 1)), "100"),
        "cdlkicking": (
            all_("col1 = -col0", long_(1), "up1 < vs1", "lo1 < vs1", long_(0), "up0 < vs0", "lo0 < vs0",
                 any_(all_(B(1), "l0 > h1"), all_(W(1), "h0 < l1"))),
            "100 * col0",
        ),
        "cdlkickingbylength": (
            all_("col1 = -col0", long_(1), "up1 < vs1", "lo1 < vs1", long_(0), "up0 < vs0", "lo0 < vs0",
                 any_(all_(B(1), "l0 > h1"), all_(W(1), "h0 < l1"))),
            "100 * CASE WHEN body0 > body1 THEN col0 ELSE col1 END",
        ),
        "cdlladderbottom": (
            all_(B(4), B(3), B(2), "o4 > o3", "o3 > o2", "c4 > c3", "c3 > c2",
                 B(1), "up1 > vs1", W(0), "o0 > o1", "c0 > h1"),
            "100",
        ),
        "cdllongleggeddoji": (all_(doji(0), any_("lo0 > body0", "up0 > body0")), "100"),
        "cdllongline": (all_(long_(0), "up0 < ss0", "lo0 < ss0"), "100 * col0"),
        "cdlmarubozu": (all_(long_(0), "up0 < vs0", "lo0 < vs0"), "100 * col0"),
        "cdlmatchinglow": (all_(B(1), B(0), within("c0", "c1", "eq1")), "100"),
        "cdlmathold": (
            all_(long_(4), short(3), short(2), short(1), W(4), B(3), W(0), gap_up(3, 4),
                 "bot2 < c4", "bot1 < c4",
                 f"bot2 > c4 - body4 * {pen}", f"bot1 > c4 - body4 * {pen}",
                 "top2 < o3", "top1 < top2", "o0 > c1", "c0 > h3", "c0 > h2", "c0 > h1"),
            "100",
        ),
        "cdlmorningdojistar": (
            all_(B(2), long_(2), doji(1), gap_down(1, 2), "body0 > bl0", W(0), f"c0 > c2 + body2 * {pen}"),
            "100",
        ),
        "cdlmorningstar": (
            all_(B(2), long_(2), short(1), gap_down(1, 2), "body0 > bl0", W(0), f"c0 > c2 + body2 * {pen}"),
            "100",
        ),
        "cdlonneck": (all_(B(1), long_(1), W(0), "o0 < l1", within("c0", "l1", "eq1")), "-100"),
        "cdlpiercing": (
            all_(B(1), long_(1), W(0), long_(0), "o0 < l1", "c0 < o1", "c0 > c1 + body1 * 0.5"),
            "100",
        ),
        "cdlrickshawman": (
            all_(doji(0), "lo0 > body0", "up0 > body0",
                 "bot0 <= l0 + rng0 / 2 + nr0", "top0 >= l0 + rng0 / 2 - nr0"),
            "100",
        ),
        "cdlrisefall3methods": (
            all_(long_(4), short(3), short(2), short(1), long_(0),
                 "col4 = -col3", "col3 = col2", "col2 = col1", "col1 = -col0",
                 "bot3 < h4", "top3 > l4", "bot2 < h4", "top2 > l4", "bot1 < h4", "top1 > l4",
                 "c2 * col4 < c3 * col4", "c1 * col4 < c2 * col4",
                 "o0 * col4 > c1 * col4", "c0 * col4 > c4 * col4"),
            "100 * col4",
        ),
        "cdlseparatinglines": (
            all_("col1 = -col0", within("o0", "o1", "eq1"), long_(0),
                 any_(all_(W(0), "lo0 < vs0"), all_(B(0), "up0 < vs0"))),
            "100 * col0",
        ),
        "cdlshootingstar": (all_(short(0), "up0 > body0", "lo0 < vs0", gap_up(0, 1)), "-100"),
        "cdlshortline": (all_(short(0), "up0 < ss0", "lo0 < ss0"), "100 * col0"),
        "cdlspinningtop": (all_(short(0), "up0 > body0", "lo0 > body0"), "100 * col0"),
        "cdlstalledpattern": (
            all_(W(2), W(1), W(0), "c0 > c1", "c1 > c2", long_(2), long_(1), "up1 < vs1",
                 "o1 > o2", "o1 <= c2 + nr2", short(0), "o0 >= c1 - body0 - nr1"),
            "-100",
        ),
        "cdlsticksandwich": (all_(B(2), W(1), B(0), "l1 > c2", within("c0", "c2", "eq2")), "100"),
        "cdltakuru": (all_(doji(0), "up0 < vs0", "lo0 > 2 * body0"), "100"),
        "cdltasukigap": (
            any_(all_(gap_up(1, 2), W(1), B(0), "o0 < c1", "o0 > o1", "c0 < o1", "c0 > top2",
                      "abs(body1 - body0) < nr1"),
                 all_(gap_down(1, 2), B(1), W(0), "o0 < o1", "o0 > c1", "c0 > o1", "c0 < bot2",
                      "abs(body1 - body0) < nr1")),
            "100 * col1",
        ),
        "cdlthrusting": (
            all_(B(1), long_(1), W(0), "o0 < l1", "c0 > c1 + eq1", "c0 <= c1 + body1 * 0.5"),
            "-100",
        ),
        "cdltristar": (
            all_(doji(2), doji(1, at=2), doji(0, at=2),
                 any_(all_(gap_up(1, 2), "top0 < top1"), all_(gap_down(1, 2), "bot0 > bot1"))),
            f"CASE WHEN {gap_up(1, 2)} AND top0 < top1 THEN -100 ELSE 100 END",
        ),
        "cdlunique3river": (
            all_(long_(2), B(2), B(1), "c1 > c2", "o1 <= o2", "l1 < l2", short(0), W(0), "o0 > l1"),
            "100",
        ),
        "cdlupsidegap2crows": (
            all_(W(2), long_(2), B(1), short(1), gap_up(1, 2), B(0), "o0 > o1", "c0 < c1", "c0 > c2"),
            "-100",
        ),
        "cdlxsidegap3methods": (
            all_("col2 = col1", "col1 = -col0", inside("o0", 1), inside("c0", 2),
                 any_(all_(W(2), gap_up(1, 2)), all_(B(2), gap_down(1, 2)))),
            "100 * col2",
        ),
    }


# Hikkake pair: the trigger bar gets +-100; the first bar at most three bars
# later whose close passes the inside bar's high (bullish) or low (bearish)
# gets +-200; a newer trigger replaces an older one.
HIKKAKE_TRIGGERS = {
    "cdlhikkake": (
        all_("h1 < h2", "l1 > l2", any_(all_("h0 < h1", "l0 < l1"), all_("h0 > h1", "l0 > l1"))),
        "CASE WHEN h0 < h1 THEN 100 ELSE -100 END",
    ),
    "cdlhikkakemod": (
        all_("h2 < h3", "l2 > l3", "h1 < h2", "l1 > l2",
             any_(all_("h0 < h1", "l0 < l1", "c2 <= l2 + nr2"), all_("h0 > h1", "l0 > l1", "c2 >= h2 - nr2"))),
        "CASE WHEN h0 < h1 THEN 100 ELSE -100 END",
    ),
}

# The output column names.
PATTERN_COLUMNS = [
    "cdl2crows", "cdl3blackrows", "cdl3inside", "cdl3linestrike", "cdl3outside",
    "cdl3starsinsouth", "cdl3whitesoldiers", "cdlabandonedbaby", "cdladvancedblock",
    "cdlbelthold", "cdlbreakaway", "cdlclosingmarubozu", "cdlconcealbabyswall",
    "cdlcounterattack", "cdldarkcloudcover", "cdldoji", "cdldojistar", "cdldragonflydoji",
    "cdlengulfing", "cdleveningdojistar", "cdleveningstar", "cdlgapsidesidewhite",
    "cdlgravestonedoji", "cdlhammer", "cdlhangingman", "cdlharami", "cdlharamicross",
    "cdlhighwave", "cdlhikkake", "cdlhikkakemod", "cdlhomingpigeon", "cdlidentical3crows",
    "cdlinneck", "cdlinvertedhammer", "cdlkicking", "cdlkickingbylength", "cdlladderbottom",
    "cdllongleggeddoji", "cdllongline", "cdlmarubozu", "cdlmatchinglow", "cdlmathold",
    "cdlmorningdojistar", "cdlmorningstar", "cdlonneck", "cdlpiercing", "cdlrickshawman",
    "cdlrisefall3methods", "cdlseparatinglines", "cdlshootingstar", "cdlshortline",
    "cdlspinningtop", "cdlstalledpattern", "cdlsticksandwich", "cdltakuru", "cdltasukigap",
    "cdlthrusting", "cdltristar", "cdlunique3river", "cdlupsidegap2crows",
    "cdlxsidegap3methods",
]

_TOKEN = re.compile(r"\b([a-z]+)([0-4])\b")


def lookback(pred: str) -> int:
    """First row a pattern can fire on: deepest offset plus the longest
    average its thresholds need (the library's warm-up)."""
    deepest, period = 0, 0
    for name, k in _TOKEN.findall(pred):
        k = int(k)
        if name in THRESHOLDS:
            period = max(period, THRESHOLDS[name][1] + k)
        if name in SHAPES or name in THRESHOLDS:
            deepest = max(deepest, k)
    return max(deepest, period)


def pattern_case(name: str, penetration: float = PENETRATION) -> str:
    """``CASE`` expression giving the pattern's value (0 when it does not
    fire or during warm-up; needs an ``rn`` column)."""
    pred, value = _patterns(penetration)[name]
    return f"CASE WHEN rn >= {lookback(pred)} AND ({pred}) THEN {value} ELSE 0 END"


def trigger_case(name: str) -> str:
    pred, value = HIKKAKE_TRIGGERS[name]
    return f"CASE WHEN rn >= {lookback(pred)} AND ({pred}) THEN {value} ELSE 0 END"


def confirm_case(trig: str) -> str:
    """Hikkake output from the trigger column ``trig`` and its lags
    (``{trig}_1..3``), inside-bar highs/lows ``h2..h4`` / ``l2..l4`` and
    closes ``c0..c2``."""

    def passes(m, k):
        return f"(({trig}_{k} > 0 AND c{m} > h{k + 1}) OR ({trig}_{k} < 0 AND c{m} < l{k + 1}))"

    return (
        f"CASE WHEN {trig} <> 0 THEN {trig}"
        f" WHEN {trig}_1 <> 0 THEN CASE WHEN {passes(0, 1)} THEN 2 * {trig}_1 ELSE 0 END"
        f" WHEN {trig}_2 <> 0 THEN CASE WHEN {passes(0, 2)} AND NOT {passes(1, 2)} THEN 2 * {trig}_2 ELSE 0 END"
        f" WHEN {trig}_3 <> 0 THEN CASE WHEN {passes(0, 3)} AND NOT {passes(1, 3)} AND NOT {passes(2, 3)}"
        f" THEN 2 * {trig}_3 ELSE 0 END"
        " ELSE 0 END"
    )
