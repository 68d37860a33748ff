"""Mixing sources to target weights: iterative proportional fitting.

Documents are counted once into cells (source, language, topic) of tokens.
The cell weights start at the token counts and are raked: each sweep scales
them to the target shares of the source, then of the language, then of the
topic.  The ratio of weight to tokens is the calibration factor g of a cell.
A document of the cell is sampled with probability min(1, k * g); k is solved
from the cells so that the expected tokens are ``budget`` of all tokens.  A
document is drawn if its own uniform number (from an MD5 of doc_id and seed)
is below its probability, so the draw does not depend on partitioning.

DataFrame functions only.  The one pass over the documents is a partial
aggregate to one row per cell and task; everything after that works on the
cells (distinct sources x languages x topics).  The factors go back to the
documents by a broadcast of the counted cells, or a shuffle join with skew
splitting beyond ``BROADCAST_CELLS``.

Defined results: null source, language or topic is a value of its own; null
text has no tokens; a cell without tokens has probability 0; targets for
values that do not occur are ignored and the rest is scaled to 1; a value
without target has target 0; rows that repeat get equal decisions; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .store import written

SWEEPS = 10
PLANNED = 5  # sweeps per written table
TEMPERATURE = {"source": 0.7, "lang": 0.9, "topic": 1.0}
BUDGET = 0.9
SEED = 17
BROADCAST_CELLS = 200_000
ONE_TASK = 50_000  # up to so many cells are raked in one task, more by shuffles
WORD = r"[^\x20\x09-\x0D]+"
MARGINS = ("source", "lang", "topic")


def topic_of(text: Column) -> Column:
    """A coarse topic by form: tables, contact lines, figures, prose."""
    return (F.when(text.contains(" | "), "table")
            .when(text.contains("@") | text.contains("://"), "contact")
            .when(text.rlike(r"[0-9]{3}"), "figures")
            .otherwise("prose"))


def _cells(docs: DataFrame, topic: Column | None) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    named = {"source": F.col("source"), "lang": F.col("lang"), "topic": topic if topic is not None else topic_of(text)}
    return docs.select(*[F.coalesce(c.cast("string"), F.lit("\0")).alias(f"__{m}") for m, c in named.items()],
                       F.regexp_count(text, F.lit(WORD)).cast("long").alias("__tokens"), "*")


def rake(cells: DataFrame, targets: dict[str, DataFrame | float], sweeps: int = SWEEPS) -> DataFrame:
    """``cells`` (__source, __lang, __topic, tokens) with the raked weight.
    A target is a table (value, share) or a temperature t: shares in
    proportion to the observed share to the power t."""
    everything = Window.partitionBy(F.lit(0))  # of the values of one margin, or of the cells
    for m in MARGINS:
        c = f"__{m}"
        seen = cells.groupBy(c).agg(F.sum("tokens").alias("t"))
        if isinstance(targets[m], DataFrame):
            given = targets[m].select(F.col("value").cast("string").alias(c), F.col("share").cast("double").alias("want"))
            seen = seen.join(given, c, "left").withColumn("want", F.coalesce("want", F.lit(0.0)))
        else:
            seen = seen.withColumn("want", F.when(F.col("t") > 0, F.pow(F.col("t").cast("double"), F.lit(float(targets[m])))).otherwise(0.0))
        seen = seen.withColumn("want", F.try_divide("want", F.sum("want").over(everything)))
        cells = cells.join(seen.select(c, F.col("want").alias(f"want_{m}")), c)
    cells = written(cells.withColumn("w", F.col("tokens").cast("double")).withColumn("total", F.sum("w").over(everything)), "cells")
    few = cells.count() <= ONE_TASK
    for sweep in range(sweeps):
        if few and sweep % PLANNED == 0:
            cells = cells.coalesce(1)  # a few cells: no exchange for each scaling
        for m in MARGINS:
            cells = cells.withColumn("w", F.coalesce(F.col("w") * F.try_divide(
                F.col(f"want_{m}") * F.col("total"), F.sum("w").over(Window.partitionBy(f"__{m}"))), F.lit(0.0)))
        if sweep % PLANNED == PLANNED - 1:
            cells = written(cells, "raked")
    return cells


def probabilities(cells: DataFrame, budget: float = BUDGET) -> DataFrame:
    """Adds ``g`` and the sampling probability ``p`` to raked cells."""
    cells = cells.withColumn("g", F.when(F.col("tokens") > 0, F.col("w") / F.col("tokens")).otherwise(0.0))
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("g"), *[f"__{m}" for m in MARGINS])
    full = F.coalesce(F.sum("tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    open_ = F.sum("w").over(order.rowsBetween(0, Window.unboundedFollowing))
    cells = cells.withColumn("k", F.try_divide(budget * F.col("total") - full, open_)).withColumn("n", F.row_number().over(order))
    # the first cell, by falling g, that is not sampled in full
    first = F.min(F.when(F.col("k") * F.col("g") <= 1, F.struct("n", "k"))).over(Window.partitionBy(F.lit(0)))
    return cells.withColumn("p", F.when(F.col("g") <= 0, 0.0).otherwise(F.least(F.lit(1.0), F.coalesce(first["k"] * F.col("g"), F.lit(1.0)))))


def uniform(doc_id: Column, seed: int) -> Column:
    """In [0, 1), from doc_id and seed."""
    digest = F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("null")), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(16 ** 13)


def weigh(docs: DataFrame, targets: dict[str, DataFrame | float] | None = None, budget: float = BUDGET, seed: int = SEED,
          topic: Column | None = None, sweeps: int = SWEEPS) -> DataFrame:
    """``docs`` with __source, __lang, __topic, __tokens, __weight (the
    calibration factor), __p and __kept."""
    rows = _cells(docs, topic)
    keys = [f"__{m}" for m in MARGINS]
    cells = written(rows.groupBy(*keys).agg(F.sum("__tokens").alias("tokens")), "cells")
    factors = written(probabilities(rake(cells, targets or TEMPERATURE, sweeps), budget).select(
        *keys, F.col("g").alias("__weight"), F.col("p").alias("__p")), "factors")
    small = factors.count() <= BROADCAST_CELLS
    out = rows.join(F.broadcast(factors) if small else factors, keys)
    return out.withColumn("__kept", uniform(F.col("doc_id"), seed) < F.col("__p"))


def sample(docs: DataFrame, **params) -> DataFrame:
    """The sampled rows of ``docs``, with its columns."""
    return weigh(docs, **params).where("__kept").select(*[F.col(f"`{c}`") for c in docs.columns])


def oracle_sql(budget: float = BUDGET, seed: int = SEED, sweeps: int = SWEEPS) -> str:
    """DuckDB SQL for the query on ``documents`` with the default targets."""
    ctes = [f"""d AS (SELECT doc_id, coalesce(source, chr(1)) AS source, coalesce(lang, chr(1)) AS lang,
  CASE WHEN contains(t, ' | ') THEN 'table' WHEN contains(t, '@') OR contains(t, '://') THEN 'contact'
       WHEN regexp_matches(t, '[0-9]{{3}}') THEN 'figures' ELSE 'prose' END AS topic,
  len(regexp_extract_all(t, '{WORD}'))::BIGINT AS tokens
  FROM (SELECT *, coalesce(text, '') AS t FROM documents))""",
            "c0 AS (SELECT source, lang, topic, sum(tokens)::DOUBLE AS tokens FROM d GROUP BY ALL)"]
    for m in MARGINS:
        ctes.append(f"m_{m} AS (SELECT {m}, a / sum(a) OVER () AS want FROM (SELECT {m}, CASE WHEN sum(tokens) > 0 "
                    f"THEN pow(sum(tokens), {TEMPERATURE[m]}) ELSE 0.0 END AS a FROM c0 GROUP BY {m}))")
    ctes.append("w0 AS MATERIALIZED (SELECT c0.*, s.want AS want_source, l.want AS want_lang, t.want AS want_topic, tokens AS w, "
                "sum(tokens) OVER () AS total FROM c0 JOIN m_source s USING (source) JOIN m_lang l USING (lang) JOIN m_topic t USING (topic))")
    n = 0
    for _ in range(sweeps):
        for m in MARGINS:
            ctes.append(f"w{n + 1} AS MATERIALIZED (SELECT * REPLACE (coalesce(w * (want_{m} * total / nullif(sum(w) OVER (PARTITION BY {m}), 0)), 0.0) AS w) FROM w{n})")
            n += 1
    ctes += [f"g AS (SELECT *, CASE WHEN tokens > 0 THEN w / tokens ELSE 0.0 END AS g FROM w{n})",
             f"k AS (SELECT *, ({budget} * total - coalesce(sum(tokens) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) "
             "/ nullif(sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS k, row_number() OVER o AS n "
             "FROM g WINDOW o AS (ORDER BY g DESC, source, lang, topic))",
             "f AS (SELECT arg_min(k, n) AS k FROM k WHERE k * g <= 1)",
             "p AS (SELECT source, lang, topic, g, CASE WHEN g <= 0 THEN 0.0 ELSE least(1.0, coalesce((SELECT k FROM f) * g, 1.0)) END AS p FROM g)"]
    return "WITH " + ",\n".join(ctes) + f"""
SELECT doc_id, source, lang, topic, tokens, round(g, 6) AS weight, round(p, 6) AS probability,
  ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':{seed}'), 1, 13))::BIGINT::DOUBLE / {float(16 ** 13)!r} < p AS kept
FROM d JOIN p USING (source, lang, topic)"""
