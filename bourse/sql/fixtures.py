"""Oracle side: the input-table derivations as DuckDB SQL.

These mirror ``bourse.sources.tables`` (written independently with the
DataFrame API) and are used as CTEs by every oracle query.
"""

BARS = {
    "type": "p_type",
    "brand_type": "concat(p_brand, '/', p_type)",
}


def bars(ticker: str = "type") -> str:
    return f"""
SELECT {BARS[ticker]} AS ticker, CAST(l_shipdate AS DATE) AS date,
       min_by(l_extendedprice / l_quantity, (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS open,
       max(l_extendedprice / l_quantity) AS high,
       min(l_extendedprice / l_quantity) AS low,
       max_by(l_extendedprice / l_quantity, (l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS close,
       sum(l_quantity) AS volume
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY {BARS[ticker]}, CAST(l_shipdate AS DATE)"""


LISTING = """
SELECT s_name AS symbol, concat('Company ', CAST(s_suppkey AS VARCHAR)) AS company,
       CASE WHEN s_suppkey % 10 = 9 THEN 'n/a'
            ELSE concat('$', CAST(CAST(floor(s_acctbal) AS BIGINT) AS VARCHAR),
                        CASE WHEN s_suppkey % 2 = 0 THEN 'B' ELSE 'M' END) END AS market_cap
FROM supplier"""

MACRO = """
SELECT o_orderpriority AS series, CAST(date_trunc('month', o_orderdate) AS DATE) AS date,
       round(sum(o_totalprice), 2) AS value
FROM orders
WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH') OR month(o_orderdate) IN (1, 4, 7, 10)
GROUP BY o_orderpriority, CAST(date_trunc('month', o_orderdate) AS DATE)"""

MARKET = """
SELECT c_mktsegment AS series, CAST(o_orderdate AS DATE) AS date, max(o_totalprice) AS value
FROM orders JOIN customer ON o_custkey = c_custkey
GROUP BY c_mktsegment, CAST(o_orderdate AS DATE)"""

STATEMENTS = """
SELECT p_type AS ticker, concat(l_returnflag, l_linestatus) AS item,
       make_date(CAST(year(l_shipdate) AS INTEGER), 12, 31) AS asof,
       CASE WHEN l_returnflag = 'A' AND year(l_shipdate) = 2001 THEN NULL
            ELSE max(l_extendedprice) END AS value
FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY p_type, l_returnflag, l_linestatus, year(l_shipdate)"""

PROFILE = """
SELECT CAST(c_custkey AS VARCHAR) AS ticker, r_name AS sector, c_mktsegment AS industry, n_name AS country,
       CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal / 1000 END AS trailing_peg,
       CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_acctbal / 500 END AS esg_env,
       CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE c_acctbal / 10000 END AS dividend_yield,
       CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_custkey % 66 AS DOUBLE) END AS days_to_next_earnings
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""

ESG = """
SELECT CAST(c_custkey AS VARCHAR) AS ticker, i.item,
       CASE WHEN (c_custkey + i.k) % 4 = 0 THEN NULL ELSE c_acctbal / i.d END AS value
FROM customer, (VALUES ('environmentScore', 1, 500.0::DOUBLE), ('socialScore', 2, 700.0::DOUBLE),
                       ('governanceScore', 3, 900.0::DOUBLE)) i(item, k, d)"""

HOLDERS = """
SELECT n_name AS ticker, s_name AS holder, s_acctbal / 100000 AS pct_held
FROM supplier JOIN nation ON s_nationkey = n_nationkey"""

_PERIOD = """CASE WHEN day(ts) > 28 THEN '-4m' WHEN day(ts) > 21 THEN '-3m' WHEN day(ts) > 14 THEN '-2m'
            WHEN day(ts) > 7 THEN '-1m' ELSE '0m' END"""

RECOMMENDATIONS = f"""
SELECT CAST(user_id AS VARCHAR) AS ticker, {_PERIOD} AS period,
       count(CASE WHEN event_type = 'purchase' THEN 1 END) AS strong_buy,
       count(CASE WHEN event_type = 'click' THEN 1 END) AS buy,
       count(CASE WHEN event_type = 'view' THEN 1 END) AS hold,
       count(CASE WHEN event_type = 'error' THEN 1 END) AS sell,
       count(CASE WHEN event_type = 'signup' THEN 1 END) AS strong_sell
FROM events
GROUP BY CAST(user_id AS VARCHAR), {_PERIOD}"""

DIVIDENDS = """
SELECT CAST(o_custkey AS VARCHAR) AS ticker, CAST(o_orderdate AS DATE) AS date, o_totalprice / 1000 AS amount
FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')"""

CALENDAR = """
SELECT CAST(o_custkey AS VARCHAR) AS ticker, CAST(o_orderdate AS DATE) AS earnings_date
FROM orders"""

# One ticker domain: the company sources keyed by the tickers of the bars.


def ticker_index(ticker: str = "type") -> str:
    return (f"SELECT ticker, row_number() OVER (ORDER BY ticker) - 1 AS i, count(*) OVER () AS n "
            f"FROM (SELECT DISTINCT {BARS[ticker]} AS ticker FROM part)")


def company_tables(ticker: str = "type") -> dict[str, str]:
    """CTEs of the company sources; ``tk`` numbers the tickers."""
    return {
        "tk": ticker_index(ticker),
        "statements": STATEMENTS.replace("p_type", BARS[ticker]),
        "profile": """SELECT ticker, concat('Company ', ticker) AS company_name, r_name AS sector, CASE WHEN i % 2 = 0 THEN 'BUILDING' ELSE 'MACHINERY' END AS industry, n_name AS country,
  abs(c.c_acctbal) * 1e6 + 1e9 AS market_cap, ((i + 1) % 5) / 2 + 0.5 AS beta, c.c_acctbal / 100 AS trailing_pe, c.c_acctbal / 120 AS forward_pe,
  CASE WHEN (i + 1) % 7 = 0 THEN NULL ELSE c.c_acctbal / 1000 END AS trailing_peg, c.c_acctbal / 700 AS price_to_book,
  CASE WHEN (i + 1) % 3 = 0 THEN NULL ELSE c.c_acctbal / 10000 END AS dividend_yield,
  abs(c.c_acctbal) * 10 + 1000 AS revenue, (i + 1) * 100 AS full_time_employees
FROM tk JOIN customer c ON c.c_custkey = i + 1
  JOIN nation ON n_nationkey = i % 3 JOIN region ON r_regionkey = i % 2""",
        "esg": f"SELECT tk.ticker, e.item, e.value FROM ({ESG}) e JOIN tk ON e.ticker = CAST(i + 1 AS VARCHAR)",
        "holders": "SELECT ticker, s_name AS holder, s_acctbal / 100000 AS pct_held FROM supplier JOIN tk ON s_suppkey % n = i",
        "recommendations": f"""SELECT tk.ticker, period, sum(strong_buy) AS strong_buy, sum(buy) AS buy, sum(hold) AS hold, sum(sell) AS sell,
  sum(strong_sell) AS strong_sell FROM ({RECOMMENDATIONS}) r JOIN tk ON CAST(r.ticker AS BIGINT) % n = i GROUP BY tk.ticker, period""",
        "dividends": f"SELECT tk.ticker, date, amount FROM ({DIVIDENDS}) d JOIN tk ON CAST(d.ticker AS BIGINT) % n = i",
        "calendar": f"SELECT tk.ticker, earnings_date FROM ({CALENDAR}) c JOIN tk ON CAST(c.ticker AS BIGINT) % n = i",
    }


PREDICTIONS = """
SELECT doc_id AS id, quality AS label, toxic AS prediction,
       CAST((doc_id * 37) % 1000 AS DOUBLE) / 1000 AS probability
FROM labels"""

VECTORS = """
SELECT vec_id AS id, embedding AS features, label % 2 AS label,
       CASE WHEN vec_id % 20 < 14 THEN 'train' WHEN vec_id % 20 < 17 THEN 'validation' ELSE 'test' END AS split
FROM embeddings"""


def with_tables(body: str, **ctes: str) -> str:
    """``WITH name AS (sql), ... body``."""
    if not ctes:
        return body
    parts = ",\n".join(f"{name} AS ({sql}\n)" for name, sql in ctes.items())
    return f"WITH {parts}\n{body}"


def r6(expr: str) -> str:
    """DuckDB twin of ``round6``: half-even rounding of x*1e6."""
    return f"(round_even(round_even(({expr}) * 1e12, 0) / 1e6, 0) / 1e6)"


def div(num: str, den: str) -> str:
    """DuckDB twin of ``try_divide``: null on a zero or null denominator."""
    return f"(CASE WHEN ({den}) = 0 THEN NULL ELSE ({num}) / ({den}) END)"
