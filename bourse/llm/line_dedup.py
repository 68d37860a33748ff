"""Line de-duplication by site-relative frequency.

Pages are grouped by host.  For each line with a word, the share of the
host's pages that contain it is its boilerplate ratio; lines above ``RATIO``
on at least ``MIN_PAGES`` pages are dropped from that host's pages.

A page is a row, as in the SQL form.  With ``by_content`` a text is no
boilerplate for being copied: a page that consists for the most part (half of
its characters) of lines above the ratio is a copy or near copy of others, or
nothing but boilerplate, and stands for its content, named by the smallest
hash among these lines.  Variants of one page keep most of its lines, so a
group of copies has few such names, whatever its size.  Lines are counted
again over distinct contents, for the host as well; rows without a word are
one content.

Lines travel as 128-bit hashes: one row per page and distinct line, summed
per (host, line) before the shuffle.  Only pages that lose a line are joined
with the set of their dropped hashes; a line that stands on a third of all
pages is one row per map task in the count, and the skew join splits its
pages.

Defined results: a null host is a host of its own; null text stays null;
lines that are empty or white space are never dropped, the others keep their
order; rows that share a (doc_id, host) lose the lines dropped for either;
rows without a doc_id count as pages but are not changed; an empty table
gives an empty result; all columns of the input are returned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import written

RATIO = 0.02
MIN_PAGES = 5


def _has_word(line: Column) -> Column:
    return line.rlike(r"[^\x20\x09-\x0D]")


def _row_id() -> Column:
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64("text"))


def _distinct_contents(pages: DataFrame, lines: DataFrame, often: DataFrame, min_pages: int, ratio: float) -> tuple[DataFrame, DataFrame]:
    """(hits, dropped): the lines of pages that are in ``often``, and those of
    them that are above the ratio when counted by contents."""
    hits = written(lines.join(often.select("host", "line"), ["host", "line"], "left_semi"), "common-lines")
    own = hits.groupBy("id", "host", "total").agg(F.sum("size").alias("common"), F.min("line").alias("content"))
    own = written(own.where(2 * F.col("common") >= F.col("total")).select("id", "host", "content").distinct(), "contents")
    name = F.coalesce("content", F.encode(F.col("id").cast("string"), "UTF-8"))
    hosts = pages.select("id", "host", (F.size("lines") > 0).alias("inked")).join(own, ["id", "host"], "left").groupBy("host").agg(
        (F.count_distinct(F.when(F.col("inked"), name)) + F.max(F.when(F.col("inked"), 0).otherwise(1))).alias("host_pages"))
    again = hits.join(own, ["id", "host"], "left").groupBy("host", "line").agg(F.count_distinct(name).alias("pages"))
    return hits, again.where(F.col("pages") >= min_pages).join(hosts, "host").where(F.col("pages") > ratio * F.col("host_pages"))


def boilerplate_lines(docs: DataFrame, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES,
                      by_content: bool = False) -> tuple[DataFrame, DataFrame]:
    """(lines, dropped): one row (doc_id, host, line) per page and distinct
    line hash, at least for the dropped lines, and (host, line, pages,
    host_pages) of these."""
    pages = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(host).cast("string"), F.lit("\0")).alias("host"),
                        F.array_distinct(F.filter(F.split("text", "\n", -1), _has_word)).alias("lines"), _row_id().alias("id"))
    hosts = pages.groupBy("host").agg(F.count(F.lit(1)).alias("host_pages"))
    each = pages.withColumn("line", F.explode("lines")).drop("lines")
    if by_content:
        total = F.aggregate("lines", F.lit(0).cast("long"), lambda a, x: a + F.length(x))
        each = pages.withColumn("total", total).withColumn("line", F.explode("lines")).drop("lines").withColumn("size", F.length("line"))
    lines = each.withColumn("line", F.unhex(F.md5("line")))
    often = lines.groupBy("host", "line").agg(F.count(F.lit(1)).alias("pages")).where(F.col("pages") >= min_pages)
    dropped = often.join(hosts, "host").where(F.col("pages") > ratio * F.col("host_pages"))
    if by_content:
        lines, dropped = _distinct_contents(pages, lines, written(dropped, "often"), min_pages, ratio)
    return lines.select("doc_id", "host", "line"), written(dropped, "dropped-lines")


def drop_boilerplate(docs: DataFrame, host: str = "source", ratio: float = RATIO, min_pages: int = MIN_PAGES,
                     count_as: str | None = None, by_content: bool = False) -> DataFrame:
    """``docs`` without its boilerplate lines; ``count_as`` names a column
    for the number of lines dropped from each row."""
    lines, dropped = boilerplate_lines(docs, host, ratio, min_pages, by_content)
    n = dropped.count()
    keys = dropped.select("host", "line")
    hits = lines.join(F.broadcast(keys) if n <= 200_000 else keys, ["host", "line"], "left_semi")
    hits = written(hits.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__id"), F.col("host").alias("__host")).agg(
        F.collect_set("line").alias("__drop")), "line-hits")
    joined = docs.join(hits, (docs["doc_id"].cast("long") == hits["__id"])
                       & (F.coalesce(docs[host].cast("string"), F.lit("\0")) == hits["__host"]), "left")
    every = F.split("text", "\n", -1)
    keep = F.filter(every, lambda x: ~(_has_word(x) & F.array_contains(F.col("__drop"), F.unhex(F.md5(x)))))
    hit = F.col("__drop").isNotNull() & F.col("text").isNotNull()
    cols = [F.when(hit, F.array_join(keep, "\n")).otherwise(F.col("text")).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns]
    if count_as:
        cols.append(F.when(hit, F.size(every) - F.size(keep)).otherwise(0).cast("long").alias(count_as))
    return joined.select(*cols)


def oracle_sql(ratio: float = RATIO, min_pages: int = MIN_PAGES) -> str:
    """DuckDB SQL for the query on ``documents``."""
    return f"""
WITH l AS (SELECT doc_id, coalesce(source, chr(1)) AS host, i AS pos, string_split(text, chr(10))[i] AS line
           FROM (SELECT doc_id, source, text, unnest(generate_series(1, len(string_split(text, chr(10))))) AS i FROM documents)),
w AS (SELECT *, regexp_matches(line, '[^\\x20\\x09-\\x0D]') AS inked FROM l),
f AS (SELECT host, line, count(DISTINCT doc_id) AS pages FROM w WHERE inked GROUP BY host, line),
h AS (SELECT coalesce(source, chr(1)) AS host, count(*) AS host_pages FROM documents GROUP BY 1),
d AS (SELECT f.host, f.line FROM f JOIN h USING (host) WHERE pages >= {min_pages} AND pages > {ratio} * host_pages),
k AS (SELECT w.doc_id, w.pos, w.line, d.line IS NOT NULL AS gone FROM w LEFT JOIN d ON w.inked AND w.host = d.host AND w.line = d.line)
SELECT doc_id, count(*) FILTER (WHERE gone) AS n_removed,
       coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '') AS text
FROM k GROUP BY doc_id
UNION ALL SELECT doc_id, 0 AS n_removed, text FROM documents WHERE text IS NULL"""
