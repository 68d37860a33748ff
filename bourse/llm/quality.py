"""Quality rules with risk-controlled thresholds.

Each document gets a few signals; a rule rejects a document whose signal
reaches a cutoff.  Cutoffs are learnt per stratum (language) and rule from
labelled documents so that rules reject few good documents:

* Labelled documents are split by a hash of doc_id: one part in ``TUNE`` sets
  the cutoff that is worth having (share of bad rejected minus ``WEIGHT``
  times share of good rejected), the holdout decides what is allowed.
* On the holdout, cutoffs are tested from the loosest to the strictest.  A
  cutoff passes if the exact binomial tail P(Bin(n, a) <= rejected good) is at
  most the error level, i.e. its Clopper-Pearson upper bound is at most a.
  Testing stops at the first failure (fixed sequence), so no correction for
  the number of cutoffs is due; the error level is divided by the number of
  strata and rules (Bonferroni), and the allowed risk a is ``ALPHA`` divided
  by the number of rules.  So with probability 1 - ``DELTA`` no stratum loses
  more than ``ALPHA`` of its good documents to all rules together.
* A rule without a passing cutoff in a stratum rejects nothing there.

All labelled documents are counted, in a histogram per stratum, rule and
grid step; only histograms of bounded length meet in one task.

Defined results: null text has no words and fails the base rule; a null
stratum is a stratum of its own; a document with several labels is good if
any label says so; labels without a document or quality are ignored; an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import written

ALPHA = 0.05
DELTA = 0.05
TUNE = 4  # one labelled document in TUNE is for tuning
WEIGHT = 20.0
STEPS = 400  # grid: cutoffs are 1/100 apart, up to 4
MIN_WORDS = 10
REPEAT_PERCENT = 20

SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: None of these signals depends on the length of a clean text.
RULES = ("symbols", "marks", "upper", "dup_lines", "repeats")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def repeat_words(words: list[bytes], k: int = 5) -> int:
    """Words inside windows of ``k`` words that occur at least twice."""
    grams = list(zip(*(words[i:] for i in range(k))))
    if len(set(grams)) == len(grams):
        return 0
    seen = Counter(grams)
    hit = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(np.fromiter((seen[g] > 1 for g in grams), bool, len(grams)))
    hit[at] += 1
    hit[at + k] -= 1
    return int(np.count_nonzero(np.cumsum(hit)[:-1]))


def signals(text: str) -> tuple:
    """The base counts and the rules' signals of one text."""
    words = text.encode("utf-8", "surrogatepass").split()
    n = len(words)
    chars = len(text) - sum(map(text.count, SPACE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    dup = len(lines) - len(set(lines))
    rep = repeat_words(words)
    each = max(n, 1)
    upper = sum(1 for w in words if w.isupper() and len(w) > 1) / each
    return (n, chars, symbols, dup, rep,
            symbols / each, (text.count("!") + text.count("?") + text.count("=") + text.count("_")) / each, upper,
            dup / max(len(lines), 1), rep / each)


def _measure(batches):
    for batch in batches:
        cols = list(zip(*(signals(x.as_py() or "") for x in batch.column("text")))) or [()] * (len(COUNTS) + len(RULES))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("stratum"), *(pa.array(c, pa.int64()) for c in cols[:5]),
             *(pa.array(np.minimum(np.floor(np.array(c, float) * 100), STEPS).astype(np.int32)) for c in cols[5:])],
            names=["doc_id", "stratum", *COUNTS, *RULES])


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(Bin(n, p) <= k), exactly (sum of all its terms)."""
    if k >= n:
        return 1.0
    i = np.arange(k)
    logs = n * math.log1p(-p) + np.concatenate([[0.0], np.cumsum(np.log((n - i) / (i + 1.0)) + math.log(p / (1 - p)))])
    top = logs.max()
    return min(1.0, float(np.exp(logs - top).sum() * math.exp(top)))


def _select(alpha: float, level: float, weight: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        """The cutoff of one stratum and rule from its histogram."""
        out = pdf.iloc[:0][["stratum", "rule"]].assign(cutoff=pd.Series(dtype="int32"))
        hist = np.zeros((STEPS + 2, 4))
        np.add.at(hist, pdf["step"].to_numpy(), pdf[["good_tune", "bad_tune", "good_hold", "bad_hold"]].to_numpy(float))
        over = hist[::-1].cumsum(axis=0)[::-1]  # rows at or above each step
        good, bad, n = over[0, 0], over[0, 1], int(over[0, 2])
        if not bad or not good or not n:
            return out
        worth = over[:, 1] / bad - weight * over[:, 0] / good
        worth[0] = -1  # step 0 would reject everything
        best = int(len(worth) - 1 - np.argmax(worth[::-1]))  # the loosest of equals
        if worth[best] <= 0:
            return out
        passed = None
        for step in range(STEPS + 1, best - 1, -1):
            if binomial_tail(int(over[step, 2]), n, alpha) > level:
                break
            passed = step
        if passed is None or not over[passed, 1]:
            return out
        return pdf.iloc[:1][["stratum", "rule"]].assign(cutoff=np.int32(passed))
    return run


def measure(docs: DataFrame, stratum: str = "lang", id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Counts and signals (in grid steps) of every document."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(stratum).cast("string"), F.lit("\0")).alias("stratum"),
                       F.col(text_col).cast("string").alias("text"))
    kinds = ", ".join(f"{c} long" for c in COUNTS) + ", " + ", ".join(f"{r} int" for r in RULES)
    return written(rows.mapInArrow(_measure, f"doc_id long, stratum string, {kinds}"), "signals")


def cutoffs(measured: DataFrame, labels: DataFrame, alpha: float = ALPHA, delta: float = DELTA, weight: float = WEIGHT) -> DataFrame:
    """(stratum, rule, cutoff) for the rules that may reject."""
    known = labels.where("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(
        F.max("quality").alias("good"))
    hold = F.crc32(F.col("doc_id").cast("string")) % TUNE != 0
    labelled = measured.join(known, "doc_id").withColumn("hold", hold)
    long = labelled.select("stratum", "good", "hold", F.explode(F.array(*[
        F.struct(F.lit(r).alias("rule"), F.col(r).alias("step")) for r in RULES])).alias("x")).select("stratum", "good", "hold", "x.*")

    def n(good: int, held: bool):
        return F.sum(((F.col("good") == good) & (F.col("hold") == held)).cast("long"))

    hist = written(long.groupBy("stratum", "rule", "step").agg(
        n(1, False).alias("good_tune"), n(0, False).alias("bad_tune"), n(1, True).alias("good_hold"), n(0, True).alias("bad_hold")), "histogram")
    strata = max(1, hist.select("stratum").distinct().count())
    return hist.groupBy("stratum", "rule").applyInPandas(
        _select(alpha / len(RULES), delta / (strata * len(RULES)), weight), "stratum string, rule string, cutoff int")


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **params) -> DataFrame:
    """(doc_id, counts, base_failed, kept) of every document."""
    measured = measure(docs, stratum)
    cut = written(cutoffs(measured, labels, **params).groupBy("stratum").pivot("rule", list(RULES)).agg(F.first("cutoff")), "cutoffs")
    cut = cut.select("stratum", *[F.col(r).alias(f"cut_{r}") for r in RULES])
    # one row per stratum; broadcast while there are few of them
    joined = measured.join(F.broadcast(cut) if cut.count() <= 100_000 else cut, "stratum", "left")
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    hit = F.lit(False)
    for r in RULES:
        hit = hit | F.coalesce(F.col(r) >= F.col(f"cut_{r}"), F.lit(False))
    return joined.select("doc_id", *COUNTS, failed.alias("base_failed"), (~failed & ~hit).alias("kept"))


def keep_good(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **params) -> DataFrame:
    """The rows of ``docs`` that are kept.  A repeated doc_id stays only if
    all its rows are kept; rows without a doc_id stay."""
    gone = written(judge(docs, labels, stratum, **params).where("NOT kept").select(F.col("doc_id").alias("__gone")).distinct(), "rejected")
    return docs.join(F.broadcast(gone) if gone.count() <= 1_000_000 else gone,
                     docs["doc_id"].cast("long") == gone["__gone"], "left_anti")
