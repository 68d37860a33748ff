"""Prediction evaluation (G20-G23) and model comparison.

Input: a predictions DataFrame ``(label, prediction[, probability])``.
All metrics come from ONE aggregation of the 2x2 confusion counts; the
report is arithmetic over those four numbers, so the work is one pass over
the predictions whatever their size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CLASSES = (0, 1)


def correctness(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Counts and shares of correct (1) / wrong (0) predictions."""
    c = confusion_counts(pred, label, prediction)
    right = F.col("tn") + F.col("tp")
    wrong = F.col("fp") + F.col("fn")
    n = right + wrong
    cells = F.array(
        F.struct(F.lit(0).alias("is_correct"), wrong.alias("count"), (wrong / n).alias("share")),
        F.struct(F.lit(1).alias("is_correct"), right.alias("count"), (right / n).alias("share")),
    )
    return c.select(F.explode(cells).alias("c")).select("c.*").where(F.col("count") > 0)


def confusion_counts(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """G21 as one row: tn, fp, fn, tp (conditional counts, one pass)."""
    y, p = F.col(label), F.col(prediction)
    return pred.agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def confusion_matrix(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """The full 2x2 grid (label, prediction, count), zeros included."""
    c = confusion_counts(pred, label, prediction)
    cells = F.array(
        *[
            F.struct(F.lit(y).alias("label"), F.lit(p).alias("prediction"), F.col(n).alias("count"))
            for (y, p), n in zip([(0, 0), (0, 1), (1, 0), (1, 1)], ["tn", "fp", "fn", "tp"])
        ]
    )
    return c.select(F.explode(cells).alias("c")).select("c.label", "c.prediction", "c.count")


def _safe(num, den):
    return F.when(den != 0, num / den).otherwise(F.lit(0.0))


def classification_report(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Precision / recall / f1 / support per class, accuracy, macro
    and weighted averages (0/0 -> 0, the usual report convention)."""
    c = confusion_counts(pred, label, prediction)
    tn, fp, fn, tp = (F.col(x).cast("double") for x in ("tn", "fp", "fn", "tp"))
    n = tn + fp + fn + tp
    p1, r1 = _safe(tp, tp + fp), _safe(tp, tp + fn)
    p0, r0 = _safe(tn, tn + fn), _safe(tn, tn + fp)
    f1 = _safe(2 * p1 * r1, p1 + r1)
    f0 = _safe(2 * p0 * r0, p0 + r0)
    s0, s1 = tn + fp, fn + tp
    acc = _safe(tn + tp, n)

    def row(name, p, r, f, s):
        return F.struct(F.lit(name).alias("class"), p.alias("precision"), r.alias("recall"),
                        f.alias("f1_score"), s.alias("support"))

    rows = F.array(
        row("0", p0, r0, f0, s0),
        row("1", p1, r1, f1, s1),
        row("accuracy", acc, acc, acc, n),
        row("macro avg", (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1) / 2, n),
        row("weighted avg", _safe(p0 * s0 + p1 * s1, n), _safe(r0 * s0 + r1 * s1, n), _safe(f0 * s0 + f1 * s1, n), n),
    )
    return c.select(F.explode(rows).alias("r")).select("r.*")


def headline(pred: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Accuracy and class-1 precision rounded to 3 decimals."""
    c = confusion_counts(pred, label, prediction)
    tn, fp, fn, tp = (F.col(x).cast("double") for x in ("tn", "fp", "fn", "tp"))
    return c.select(
        F.round(_safe(tn + tp, tn + fp + fn + tp), 3).alias("accuracy"),
        F.round(_safe(tp, tp + fp), 3).alias("precision_1"),
    )


def best_model(metrics: DataFrame, metric: str = "metric", order: str = "model_order") -> DataFrame:
    """The first model (lowest ``order``) with the maximum metric."""
    return metrics.agg(
        F.max_by(F.struct(*[F.col(c) for c in metrics.columns]),
                 F.struct(F.col(metric), -F.col(order))).alias("best")
    ).select("best.*")
