"""Time-aware splits and walk-forward periods.

Spark has no row position and a window without ``partitionBy`` puts every row
in one task. Row-position splits are therefore computed from the date
histogram: one row per distinct date (bounded by the calendar, not by the
data), a running count over it, and a position inside a date only where a
cut falls inside that date. Periods are built from the date range with
``sequence`` and matched to rows by equi-joins on the date.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paddock.operators.sequence import running_sum, with_position


_DAY, _TIME = "_day", "_time"


def date_histogram(df: DataFrame, date_col: str = "race_date", by: Sequence[str] = ()) -> DataFrame:
    """(by..., _day, n, n_before): rows per day and rows on earlier days.

    One row per group and calendar day, also where the column is a timestamp.
    Null dates are a day of their own after all others.
    """
    h = df.groupBy(*by, F.col(date_col).cast("date").alias(_DAY)).agg(F.count(F.lit(1)).alias("n"))
    w = Window.partitionBy(*by).orderBy(F.col(_DAY).asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    return h.withColumn("n_before", F.coalesce(F.sum("n").over(w), F.lit(0)))       # over the calendar only


def _with_days(df: DataFrame, h: DataFrame, date_col: str, by: Sequence[str] = ()) -> DataFrame:
    """Join the histogram's columns to the rows, null days included; it has one
    row per group and calendar day, which bounds the broadcast."""
    keys = [*by, _DAY]
    h = F.broadcast(h.withColumnsRenamed({k: f"_h{k}" for k in keys}))
    x = df.withColumn(_DAY, F.col(date_col).cast("date"))
    return x.join(h, [F.col(k).eqNullSafe(F.col(f"_h{k}")) for k in keys]).drop(*[f"_h{k}" for k in keys])


def _day_position(x: DataFrame, order: Sequence[str], date_col: str, by: Sequence[str] = ()) -> DataFrame:
    """Add ``_pd``: position of the row inside its day (by the time, then ``order``)."""
    rest = [c for c in order if c != date_col]
    if x.schema[date_col].dataType.typeName() == "date":
        return with_position(x, [*by, _DAY], rest, name="_pd")
    seconds = F.col(date_col).cast("timestamp").cast("double") - F.col(_DAY).cast("timestamp").cast("double")
    return with_position(x.withColumn(_TIME, seconds), [*by, _DAY], [_TIME, *rest], name="_pd").drop(_TIME)


def global_position(df: DataFrame, order: Sequence[str], date_col: str = "race_date",
                    name: str = "position", total: str | None = None) -> DataFrame:
    """0-based position of each row in ``order`` (which starts with the date), and
    ``total``: the number of rows.

    position = rows on earlier days + position inside the day; null dates last.
    """
    h = date_histogram(df, date_col)
    if total:
        h = h.withColumn(total, F.sum("n").over(Window.partitionBy()))          # over the date histogram only
    h = h.drop("n")
    x = _with_days(_day_position(df.withColumn(_DAY, F.col(date_col).cast("date")), order, date_col).drop(_DAY), h, date_col)
    return x.withColumn(name, (F.col("n_before") + F.col("_pd")).cast("long")).drop("n_before", "_pd", _DAY)


def _cut_days(df: DataFrame, h: DataFrame, order: Sequence[str], date_col: str, by: Sequence[str],
              name: str, first: str, second: str) -> DataFrame:
    """Label the first ``_k`` rows of each day ``first``, the others ``second``;
    only the days that a cut falls inside need positions."""
    x = _with_days(df, h.select(*by, _DAY, "n", "_k"), date_col, by)
    mixed = (F.col("_k") > 0) & (F.col("_k") < F.col("n"))
    inner = _day_position(x.filter(mixed), order, date_col, by)
    inner = inner.withColumn(name, F.when(F.col("_pd") < F.col("_k"), first).otherwise(second))
    whole = x.filter(~mixed).withColumn(name, F.when(F.col("_k") == F.col("n"), first).otherwise(second))
    return whole.unionByName(inner.drop("_pd")).drop("n", "_k", _DAY)


def temporal_split(df: DataFrame, order: Sequence[str], validation_ratio: float = 0.2,
                   date_col: str = "race_date", mode: str = "row") -> DataFrame:
    """H1: ``split`` = 'train' for the first int(n * (1 - ratio)) rows in order,
    else 'validation'. Rows without a date come last.

    mode='row' follows the reference (the cut may fall inside a day);
    mode='date' keeps whole days: a day is train only if all its rows fit.
    """
    h = date_histogram(df, date_col)
    tot = F.sum("n").over(Window.partitionBy())              # over the date histogram only
    h = h.withColumn("_cut", F.floor(tot * F.lit(1.0 - validation_ratio)).cast("long"))
    if mode == "date":
        h = h.withColumn("_k", F.when(F.col("n_before") + F.col("n") <= F.col("_cut"), F.col("n"))
                         .otherwise(F.lit(0)))
    else:
        h = h.withColumn("_k", F.greatest(F.lit(0), F.least(F.col("n"), F.col("_cut") - F.col("n_before"))))
    return _cut_days(df, h, order, date_col, [], "split", "train", "validation")


def time_folds(df: DataFrame, order: Sequence[str], n_splits: int = 5, date_col: str = "race_date") -> DataFrame:
    """H2: expanding time folds (scikit-learn ``TimeSeriesSplit`` layout).

    test size = n // (n_splits + 1); fold i tests on its block and trains on
    every earlier row. Adds ``position`` and ``test_fold`` (null for rows only
    ever used for training).
    """
    # the total comes with the days: joined as one row, without a key, it would make AQE keep
    # the shuffle's partitions at their least size, and whoever writes the folds write tiny files
    x = global_position(df, order, date_col, total="_n")
    size = F.floor(F.col("_n") / (n_splits + 1))
    first = F.col("_n") - F.lit(n_splits) * size
    fold = F.when((size > 0) & (F.col("position") >= first),
                  F.floor((F.col("position") - first) / F.greatest(size, F.lit(1))))
    return x.withColumn("test_fold", fold.cast("long")).drop("_n")


def fold_table(df: DataFrame, n_splits: int = 5) -> DataFrame:
    """H2 summary: (fold, train_end, test_start, test_end, n_train, n_test) in positions."""
    tot = df.agg(F.count(F.lit(1)).alias("_n"))
    size = F.floor(F.col("_n") / (n_splits + 1))
    out = tot.withColumn("fold", F.explode(F.sequence(F.lit(0), F.lit(n_splits - 1))))
    start = F.col("_n") - (F.lit(n_splits) - F.col("fold")) * size
    return out.select(F.col("fold").cast("long"), start.cast("long").alias("test_start"),
                      (start + size - 1).cast("long").alias("test_end"),
                      start.cast("long").alias("n_train"), size.cast("long").alias("n_test"))


def walk_forward_periods(df: DataFrame, train_window: int | None = 365, test_window: int = 30,
                         step: int = 30, date_col: str = "race_date") -> DataFrame:
    """H3 + H4: candidate periods from the date range, their row counts, and
    the index of each period that has both a train and a test side.

    Returns (period, train_start, train_end, test_start, test_end, n_train, n_test).
    Counts come from the date histogram joined to the days of each period
    (an equi-join on the date; both sides are bounded by the calendar).
    """
    rng = df.agg(F.min(F.col(date_col).cast("date")).alias("_lo"), F.max(F.col(date_col).cast("date")).alias("_hi"))
    lead = train_window if train_window is not None else 90
    first = F.date_add("_lo", lead)
    cand = rng.filter(first <= F.col("_hi")).select(
        "_lo", F.explode(F.sequence(first, F.col("_hi"), F.expr(f"INTERVAL {step} DAYS"))).alias("test_start"))
    cand = cand.select(
        (F.date_sub("test_start", train_window) if train_window is not None else F.col("_lo")).alias("train_start"),
        F.date_sub("test_start", 1).alias("train_end"), "test_start",
        F.date_add("test_start", test_window - 1).alias("test_end"))
    hist = df.groupBy(F.col(date_col).cast("date").alias("_d")).agg(F.count(F.lit(1)).alias("_n"))
    days = cand.select("*", F.explode(F.sequence("train_start", "test_end")).alias("_d"))
    cnt = days.join(F.broadcast(hist), "_d").groupBy("train_start", "train_end", "test_start", "test_end").agg(
        F.sum(F.when(F.col("_d") < F.col("test_start"), F.col("_n")).otherwise(0)).cast("long").alias("n_train"),
        F.sum(F.when(F.col("_d") >= F.col("test_start"), F.col("_n")).otherwise(0)).cast("long").alias("n_test"))
    live = cnt.filter((F.col("n_train") > 0) & (F.col("n_test") > 0))
    idx = F.row_number().over(Window.orderBy("test_start")) - 1          # over periods only
    return live.select(idx.cast("long").alias("period"), "train_start", "train_end", "test_start", "test_end",
                       "n_train", "n_test")


def assign_periods(df: DataFrame, periods: DataFrame, side: str = "test",
                   date_col: str = "race_date") -> DataFrame:
    """Rows of each period's test (or train) side, tagged with ``period``.

    Periods are exploded into their days and equi-joined on the date, so a row
    in overlapping windows appears once per period (as in the reference).
    """
    if side == "test":
        lo, hi = F.col("test_start"), F.col("test_end")
    else:
        lo, hi = F.col("train_start"), F.col("train_end")
    pdays = periods.select("period", F.explode(F.sequence(lo, hi)).alias("_d"))
    return df.join(F.broadcast(pdays), F.col(date_col).cast("date") == F.col("_d")).drop("_d")


def calibration_holdout(train_rows: DataFrame, order: Sequence[str], holdout: float = 0.2,
                        by: str = "period", date_col: str = "race_date") -> DataFrame:
    """H5: per group, the last ``holdout`` share of rows in order calibrates
    (``role`` = 'calibration'), the rest fits ('fit'); int(n*(1-holdout)) fit rows."""
    h = date_histogram(train_rows, date_col, by=[by])
    tot = F.sum("n").over(Window.partitionBy(by))
    h = h.withColumn("_cut", F.floor(tot * F.lit(1.0 - holdout)).cast("long"))
    h = h.withColumn("_k", F.greatest(F.lit(0), F.least(F.col("n"), F.col("_cut") - F.col("n_before"))))
    return _cut_days(train_rows, h, order, date_col, [by], "role", "fit", "calibration")


def holdout_stats(df: DataFrame, periods: DataFrame, order: Sequence[str], holdout: float = 0.2,
                  sums: Sequence[str] = (), date_col: str = "race_date") -> DataFrame:
    """H4 + H5 without a copy of a row per period: (period, role, rows, first_date,
    last_date, and the sum of each of ``sums``) of what ``calibration_holdout`` would tag
    on the rows of each period's training side.

    Days are reduced once; a period adds up its days. Only where a period's cut falls
    inside a day are rows looked at again: those of the cut days, once each, whose
    running sums give what lies before the cut.
    """
    sums = list(sums)
    day = F.col(date_col).cast("date")
    per_day = df.groupBy(day.alias(_DAY)).agg(F.count(F.lit(1)).alias("n"), *[F.sum(c).alias(f"_s_{c}") for c in sums])
    w = Window.partitionBy("period")                                       # over the calendar only
    x = assign_periods(per_day, periods, "train", _DAY).withColumns({
        "n_before": F.coalesce(F.sum("n").over(w.orderBy(_DAY).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        "_cut": F.floor(F.sum("n").over(w) * F.lit(1.0 - holdout)).cast("long")})
    x = x.withColumn("_k", F.greatest(F.lit(0), F.least(F.col("n"), F.col("_cut") - F.col("n_before"))))
    cuts = x.filter("_k > 0 and _k < n").select("period", F.col(_DAY).alias("_d"), "_k")

    rows = df.withColumn(_DAY, day).join(F.broadcast(cuts.select(F.col("_d").alias(_DAY)).distinct()), _DAY)
    rest = [c for c in order if c != date_col]
    if df.schema[date_col].dataType.typeName() != "date":
        rows = rows.withColumn(_TIME, F.col(date_col).cast("timestamp").cast("double"))
        rest = [_TIME, *rest]
    rows = rows.select(*dict.fromkeys([_DAY, *rest]), *[F.coalesce(c, F.lit(0)).alias(f"_b_{c}") for c in sums], F.lit(1).alias("_one"))
    inner = running_sum(rows, [_DAY], rest, ["_one", *[f"_b_{c}" for c in sums]])
    inner = (inner.join(F.broadcast(cuts), (F.col("_d") == F.col(_DAY)) & (F.col("_one_before") == F.col("_k")))
                  .select("period", F.col("_d").alias(_DAY), *[F.col(f"_b_{c}_before").alias(f"_f_{c}") for c in sums]))

    x = x.join(F.broadcast(inner), ["period", _DAY], "left")
    fit = {c: F.when(F.col("_k") == F.col("n"), F.col(f"_s_{c}")).when(F.col("_k") > 0, F.col(f"_f_{c}")) for c in sums}
    own = [F.struct(F.lit("fit").alias("role"), F.col("_k").cast("long").alias("rows"), *[fit[c].alias(c) for c in sums]),
           F.struct(F.lit("calibration").alias("role"), (F.col("n") - F.col("_k")).cast("long").alias("rows"),
                    *[(F.coalesce(f"_s_{c}", F.lit(0)) - F.coalesce(fit[c], F.lit(0))).alias(c) for c in sums])]
    return (x.select("period", _DAY, F.explode(F.array(*own)).alias("_r")).select("period", _DAY, "_r.*").filter("rows > 0")
             .groupBy("period", "role").agg(F.sum("rows").alias("rows"), F.min(_DAY).alias("first_date"), F.max(_DAY).alias("last_date"),
                                            *[F.sum(c).alias(c) for c in sums]))


def period_integrity(df: DataFrame, periods: DataFrame, date_col: str = "race_date") -> DataFrame:
    """H10 for the rows' own periods, from the days that have rows (no row is copied per period)."""
    days = df.select(F.col(date_col).cast("date").alias(date_col)).filter(F.col(date_col).isNotNull()).distinct()
    return temporal_integrity(assign_periods(days, periods, "train", date_col), assign_periods(days, periods, "test", date_col),
                              date_col=date_col)


def temporal_integrity(train_rows: DataFrame, test_rows: DataFrame, by: str = "period",
                       date_col: str = "race_date") -> DataFrame:
    """Per period, the latest train date must be before the earliest test date."""
    tr = train_rows.groupBy(by).agg(F.max(date_col).alias("train_max"))
    te = test_rows.groupBy(by).agg(F.min(date_col).alias("test_min"))
    return tr.join(te, by, "full").withColumn("ok", F.col("train_max") < F.col("test_min"))
