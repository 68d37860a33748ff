"""C07 full dataset, C08 imputation, C09 preprocessing.

Joins: the monthly price table is the left side (it defines the ticker set,
J09).  Momentum / pattern months are keyed (ticker, month) and unique by
construction (they come out of a ``groupBy`` on that key).  Macro and market
tables have one row per month -- bounded by the calendar -- and are
broadcast.  The per-ticker fundamentals are not bounded (one row per
ticker), so no hint is given: AQE turns the join into a broadcast at run
time only when the measured side is small.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import cyclical, growth_label
from ..operators.persist import materialize

TARGET_MONTHS = 3
GROWTH_THRESHOLD = 1.10
# The reference's preprocessing configuration.
DUMMY_VARIABLES = ["ticker", "sector", "industry"]
DROP_VARIABLES = ["date", "target", "company_name", "country", "year"]
CYCLICAL_VARIABLES = ["month"]
LABEL = "is_positive_growth_3m_future"
ZERO_FILL = ["dividend_yield", "dividend_stability"]
CONSTANT_FILL = {"days_to_next_earnings": 66.0}
GROUP_FILL = {
    "trailing_peg": ["industry"],
    "esg_env": ["sector", "industry", "country"],
    "esg_soc": ["sector", "industry", "country"],
    "esg_gov": ["sector", "industry", "country"],
}


class CardinalityError(ValueError):
    pass


def duplicate_keys(right: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once on the right side of a
    many-to-one join (empty when the join is valid)."""
    return right.groupBy(*keys).count().where(F.col("count") > 1)


# A right side is broadcast only up to this many counted rows.
BROADCAST_ROWS = 100_000


def left_join_many_to_one(left: DataFrame, right: DataFrame, keys: list[str], validate: bool = True,
                          broadcast: bool = False) -> DataFrame:
    """J01-J04 with the J05 check: one aggregation of the right side gives its
    rows and whether a key repeats.  Right sides that are unique by
    construction (a ``groupBy`` on the keys) need no check.  ``broadcast``
    takes effect up to ``BROADCAST_ROWS`` rows."""
    if validate or broadcast:
        seen = right.groupBy(*keys).count().agg(F.coalesce(F.sum("count"), F.lit(0)).alias("rows"), F.max("count").alias("most")).first()
        if validate and (seen["most"] or 0) > 1:
            raise CardinalityError(f"right side is not unique on {keys}")
        broadcast = broadcast and seen["rows"] <= BROADCAST_ROWS
    return left.join(F.broadcast(right) if broadcast else right, keys, "left")


def checked_right_sides(tables: dict[str, tuple[DataFrame, list[str]]]) -> dict[str, int]:
    """J05 for several joins at once: {name: rows} of right sides (table,
    keys).  Their keys are stacked and counted by one aggregate; a key that
    repeats raises ``CardinalityError`` with the names of its tables."""
    if not tables:
        return {}
    names = sorted({k for _, keys in tables.values() for k in keys})
    stacked = None
    for name, (df, keys) in tables.items():
        part = df.select(F.lit(name).alias("_table"), *[(F.col(k).cast("string") if k in keys else F.lit(None).cast("string")).alias(k) for k in names])
        stacked = part if stacked is None else stacked.unionByName(part)
    seen = {r["_table"]: r for r in stacked.groupBy("_table", *names).count().groupBy("_table").agg(
        F.sum("count").alias("rows"), F.max("count").alias("most")).collect()}  # one row per table
    wrong = [f"{name} {tables[name][1]}" for name, r in seen.items() if r["most"] > 1]
    if wrong:
        raise CardinalityError(f"not unique on their join keys: {', '.join(sorted(wrong))}")
    return {name: seen[name]["rows"] if name in seen else 0 for name in tables}


def with_target(df: DataFrame, months: int = TARGET_MONTHS) -> DataFrame:
    """W07 + P07: close ``months`` rows ahead within the ticker, rows
    without a target dropped."""
    w = Window.partitionBy("ticker").orderBy("date")
    return df.withColumn("target", F.lead("close", months).over(w)).dropna(subset=["target"])


def full_dataset(price: DataFrame, fundamentals: DataFrame | None, momentum: DataFrame | None,
                 patterns: DataFrame | None, macro: DataFrame | None, market: DataFrame | None,
                 validate: bool = True) -> DataFrame:
    """Monthly prices + fundamentals + monthly momentum / patterns +
    macro + market, then the 3-month-ahead target.  Sources that are None
    are skipped (the reference skips empty frames).

    Every input is read twice (cardinality check, then join), so each is
    materialised once first; one aggregate checks all right sides.  The result
    is materialised too, since imputation and preprocessing read it several
    times.
    """
    price, fundamentals, momentum, patterns, macro, market = (
        None if x is None else materialize(x) for x in (price, fundamentals, momentum, patterns, macro, market)
    )
    # today's fundamentals on every month of the ticker (the reference's
    # point-in-time leak, kept for parity)
    sides = {"fundamentals": (fundamentals, ["ticker"]), "momentum": (momentum, ["ticker", "date"]), "patterns": (patterns, ["ticker", "date"]),
             "macro": (macro, ["date"]), "market": (market, ["date"])}
    sides = {name: side for name, side in sides.items() if side[0] is not None}
    rows = checked_right_sides(sides) if validate else {}
    df = price
    for name, (right, keys) in sides.items():
        small = keys == ["date"] and rows.get(name, BROADCAST_ROWS + 1) <= BROADCAST_ROWS
        df = df.join(F.broadcast(right) if small else right, keys, "left")
    return materialize(with_target(df))


# ------------------------------------------------------------------ C08


def null_counts(df: DataFrame) -> DataFrame:
    """Null count per column in ONE aggregation pass, unpivoted to
    (column, null_count)."""
    counts = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column", "null_count")


def columns_with_nulls(df: DataFrame) -> list[str]:
    row = df.agg(*[F.count_if(F.col(f"`{c}`").isNull()).alias(c) for c in df.columns]).first()
    return [c for c in df.columns if row[c] > 0]


def group_median_fill(df: DataFrame, col: str, group: str) -> DataFrame:
    """One F11 step: fill nulls of ``col`` with the median of its ``group``
    (G09).  The group medians are one aggregation joined back; rows whose
    group key is null are left as they are."""
    med = df.groupBy(group).agg(F.median(col).alias("_median")).where(F.col(group).isNotNull())
    return df.join(med, group, "left").withColumn(col, F.coalesce(col, "_median")).drop("_median")


class MissingValuesError(ValueError):
    """Columns that still hold nulls after imputation, in ``columns``."""

    def __init__(self, columns: list[str]):
        super().__init__(f"columns still holding nulls after imputation: {columns}")
        self.columns = columns


def fill(df: DataFrame) -> DataFrame:
    """F10 constant fills and F11 chained group-median fills."""
    fills = {c: 0.0 for c in ZERO_FILL if c in df.columns}
    fills |= {c: v for c, v in CONSTANT_FILL.items() if c in df.columns}
    df = df.fillna(fills)
    steps = [(c, g) for c, groups in GROUP_FILL.items() if c in df.columns for g in groups if g in df.columns]
    if not steps:
        return df
    if "ticker" in df.columns:
        return _fill_by_ticker(df, steps)
    for col, group in steps:
        df = group_median_fill(df, col, group)
    return df


def weighted_medians(values: DataFrame, group: str, col: str) -> DataFrame:
    """Median of ``col`` per ``group`` where each row counts ``rows`` times
    (linear between the two middle rows, as over the rows themselves).

    Equal values are added up first; the middle is found on running totals per
    group, so no aggregation buffer holds a group's values."""
    n = values.where(F.col(col).isNotNull() & F.col(group).isNotNull()).groupBy(group, col).agg(F.sum("rows").alias("rows"))
    w = Window.partitionBy(group)
    run = n.withColumn("upto", F.sum("rows").over(w.orderBy(col).rowsBetween(Window.unboundedPreceding, 0))).withColumn(
        "all", F.sum("rows").over(w))
    lo, hi = F.floor((F.col("all") + 1) / 2), F.ceil((F.col("all") + 1) / 2)

    def at(rank):  # the value whose run of rows holds this rank
        return F.max(F.when((F.col("upto") >= rank) & (F.col("upto") - F.col("rows") < rank), F.col(col)))

    return run.groupBy(group).agg(((at(lo) + at(hi)) / 2).alias("_median"))


def _fill_by_ticker(df: DataFrame, steps: list[tuple[str, str]]) -> DataFrame:
    """The fill chain on one row per ticker, joined to ``df`` once.

    The filled columns and their groups are constant per ticker (they come
    from the fundamentals); medians over the monthly rows are medians over
    tickers weighted by their rows.  A ticker with differing values keeps one
    row per combination."""
    cols, groups = list(dict.fromkeys(c for c, _ in steps)), list(dict.fromkeys(g for _, g in steps))
    keys = ["ticker", *groups, *cols]
    each = materialize(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows")))
    for c in cols:
        each = each.withColumn(f"_new_{c}", F.col(c))
    for c, g in steps:
        med = weighted_medians(each.select(g, F.col(f"_new_{c}").alias(c), "rows"), g, c).withColumnRenamed(g, "_g")
        each = materialize(each.join(med, F.col(g) == F.col("_g"), "left").withColumn(
            f"_new_{c}", F.coalesce(f"_new_{c}", "_median")).drop("_median", "_g"))
    each = each.select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[f"_new_{c}" for c in cols])
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
    out = df.join(each, same, "left")
    return out.select(*[F.col(f"_new_{c}").alias(c) if c in cols else F.col(f"`{c}`") for c in df.columns])


def impute(df: DataFrame) -> DataFrame:
    """F10 and F11 fills, then P13: ``MissingValuesError`` names the
    columns that still hold nulls."""
    df = fill(df)
    remaining = columns_with_nulls(df)
    if remaining:
        raise MissingValuesError(remaining)
    return df


def impute_dropping(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """C08 with P09: the filled table without the columns that still hold
    nulls, and the names of those columns."""
    df = fill(df)
    remaining = columns_with_nulls(df)
    return df.drop(*remaining), remaining


def complete_months(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in which all the given series columns have a value: indicator
    warm-up and months outside the macro / market calendar go."""
    return df.dropna(subset=[c for c in columns if c in df.columns])


# ------------------------------------------------------------------ C09


def add_cyclical(df: DataFrame, cols=CYCLICAL_VARIABLES, period: int = 12) -> DataFrame:
    """``{c}_sin`` / ``{c}_cos`` of 2*pi*c/period."""
    for c in cols:
        if c in df.columns:
            s, k = cyclical(c, period)
            df = df.withColumns({f"{c}_sin": s, f"{c}_cos": k})
    return df


# Dense indicator columns are made for at most this many levels per column.
MAX_LEVELS = 1_000


class LevelLimitError(ValueError):
    pass


def level_index(df: DataFrame, col: str) -> DataFrame:
    """(col, ``{col}_index``): the sorted levels of a column, from 0.  The
    window holds the distinct names only."""
    names = df.select(F.col(col).cast("string").alias(col)).where(F.col(col).isNotNull()).distinct()
    w = Window.partitionBy(F.lit(0)).orderBy(col)
    return names.withColumn(f"{col}_index", (F.row_number().over(w) - 1).cast("int"))


def one_hot(df: DataFrame, cols=DUMMY_VARIABLES, sparse=("ticker",), max_levels: int = MAX_LEVELS) -> DataFrame:
    """one 0/1 column ``{col}_{level}`` per level except the first in
    sorted order; the source column is dropped.

    Columns in ``sparse`` have no bounded number of levels: they become
    ``{col}_index``, the level's number, by a join with the level table (index
    0 is the dropped level; ``features`` turns it into a sparse block).  More
    than ``max_levels`` levels of another column raise ``LevelLimitError``."""
    present = [c for c in cols if c in df.columns]
    for c in [c for c in present if c in sparse]:
        df = df.join(level_index(df, c), c, "left").drop(c)
    present = [c for c in present if c not in sparse]
    if not present:
        return df
    new = {}
    for c in present:
        found = df.select(F.col(c).cast("string").alias("v")).where(F.col("v").isNotNull()).distinct().limit(max_levels + 1).collect()
        if len(found) > max_levels:
            raise LevelLimitError(f"{c} has more than {max_levels} levels")
        for v in sorted(r["v"] for r in found)[1:]:
            new[f"{c}_{v}"] = F.when(F.col(c) == F.lit(v), 1).otherwise(0)
    return df.withColumns(new).drop(*present)


def temporal_split(df: DataFrame, train: float = 0.7, validation: float = 0.15, date: str = "date") -> DataFrame:
    """'train' if date <= min + train*D days, 'validation' if <= a
    further validation*D days, else 'test' (D = whole days from min to max;
    cut-offs fractional and inclusive).  The two bounds are one small
    aggregate read back as literals."""
    row = df.agg(F.min(date).alias("lo"), F.max(date).alias("hi")).first()
    lo, hi = row["lo"], row["hi"]
    if lo is None:  # no rows
        return df.withColumn("split", F.lit(None).cast("string"))
    days = (hi - lo).days
    train_end = days * train
    val_end = train_end + days * validation
    diff = F.datediff(F.col(date), F.lit(lo))
    return df.withColumn(
        "split",
        F.when(diff <= F.lit(train_end), "train").when(diff <= F.lit(val_end), "validation").otherwise("test"),
    )


def preprocess(df: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Impute (raising on what is left), cyclical month, one-hot, label,
    temporal split, drop.  The filled table is materialised once; the null
    check, the levels, the date bounds and the result read that.  Columns in
    ``keep`` stay (the date that orders training rows)."""
    df = materialize(fill(df))
    remaining = columns_with_nulls(df)
    if remaining:
        raise MissingValuesError(remaining)
    df = add_cyclical(df)
    df = one_hot(df)
    df = df.withColumn(LABEL, growth_label("target", "close", GROWTH_THRESHOLD))
    df = temporal_split(df)
    return df.drop(*[c for c in DROP_VARIABLES if c in df.columns and c not in keep])


def features(df: DataFrame, label: str = LABEL, split: str = "split", sparse=("ticker_index",)) -> DataFrame:
    """C09 -> C10: (features array<double>, label, split) of the preprocessed
    table: every numeric column but label, split and the sparse indices, in
    column order.  ``sparse_block`` adds the indices as a vector."""
    kinds = ("double", "float", "int", "bigint", "smallint", "tinyint")
    cols = [c for c, t in df.dtypes if (t in kinds or t.startswith("decimal")) and c not in (label, split, *sparse)]
    kept = [c for c in sparse if c in df.columns]
    return df.select(*kept, F.array(*[F.col(f"`{c}`").cast("double") for c in cols]).alias("features"), F.col(label).alias("label"), split)


def sparse_block(df: DataFrame, index: str = "ticker_index") -> DataFrame:
    """Adds ``{index}_vector``: the one-hot of a level index as a sparse ML
    vector without the first level."""
    from pyspark.ml.feature import OneHotEncoder

    # the encoder drops the last category; turning the numbers round drops level 0
    top = df.agg(F.max(index)).first()[0] or 0
    turned = df.withColumn("_turned", F.lit(int(top)) - F.col(index))
    return OneHotEncoder(inputCol="_turned", outputCol=f"{index}_vector").fit(turned).transform(turned).drop("_turned")
