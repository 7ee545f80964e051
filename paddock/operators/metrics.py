"""Ranking, probability, classification and betting metrics.

Every metric takes a prediction frame and optional group keys ``by`` (e.g. a
backtest period) and returns one row per group. Metrics are conditional
aggregates, so many of them share one pass; per-race metrics add one
race-level aggregate. Nothing is collected to the driver.

Prediction frame columns: race_id, horse_id, predicted_rank, actual_position,
predicted_prob, is_win, predicted_win, and for betting bet_amount, payout, odds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paddock.operators.sequence import desc, running_sum

EPS = 1e-15


def _one(c: Column) -> Column:
    return F.when(c, F.lit(1.0)).otherwise(F.lit(0.0))


def _grouped(df: DataFrame, by: Sequence[str], *aggs: Column) -> DataFrame:
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


# -- K1, K2 ------------------------------------------------------------------
def win_accuracy_col() -> Column:
    """Share of top picks (predicted_rank 1) that won; 0 when there are none."""
    pick = F.col("predicted_rank") == 1
    return F.coalesce(F.avg(F.when(pick, _one(F.col("actual_position") == 1))), F.lit(0.0))


def place_accuracy_col(top_n: int = 3) -> Column:
    pick = F.col("predicted_rank") == 1
    return F.coalesce(F.avg(F.when(pick, _one(F.col("actual_position") <= top_n))), F.lit(0.0))


def win_accuracy(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return _grouped(df, by, win_accuracy_col().alias("win_accuracy"))


def place_accuracy(df: DataFrame, by: Sequence[str] = (), top_n: int = 3) -> DataFrame:
    return _grouped(df, by, place_accuracy_col(top_n).alias("place_accuracy"))


# -- K3 ----------------------------------------------------------------------
def top_n_accuracy(df: DataFrame, by: Sequence[str] = (), n: int = 3,
                   name: str = "top3_accuracy") -> DataFrame:
    """Mean over races of |predicted top n ∩ actual top n| / |actual top n|.

    Sets are of horse ids: a horse listed twice in a race counts once, and it
    is in the intersection if any of its rows is predicted top n and any is
    actually top n. Races without an actual top n are skipped.
    """
    per_horse = df.groupBy(*by, "race_id", "horse_id").agg(
        F.max((F.col("predicted_rank") <= n).cast("int")).alias("_p"),
        F.max((F.col("actual_position") <= n).cast("int")).alias("_a"))
    per_race = per_horse.groupBy(*by, "race_id").agg(
        F.sum(F.col("_p") * F.col("_a")).alias("_hit"), F.sum("_a").alias("_act"))
    hit = F.when(F.col("_act") > 0, F.col("_hit") / F.col("_act"))
    out = _grouped(per_race, by, F.coalesce(F.avg(hit), F.lit(0.0)).alias(name))
    return out


# -- K4-K6 -------------------------------------------------------------------
def recovery_rate_col() -> Column:
    bet = F.sum("bet_amount")
    return F.when(F.coalesce(bet, F.lit(0.0)) == 0, F.lit(0.0)).otherwise(F.sum("payout") / bet)


def roi_col() -> Column:
    bet = F.sum("bet_amount")
    return F.when(F.coalesce(bet, F.lit(0.0)) == 0, F.lit(0.0)).otherwise(
        (F.sum("payout") - bet) / bet)


def expected_value_col(prob: str = "predicted_prob", odds: str = "odds") -> Column:
    return F.coalesce(F.avg(F.col(prob) * F.col(odds) - F.lit(1.0)), F.lit(0.0))


# -- K8, K9 ------------------------------------------------------------------
def prf_cols(target: str = "is_win", pred: str = "predicted_win") -> list[Column]:
    y, p = F.col(target), F.col(pred)
    tp = F.sum(_one((y == 1) & (p == 1)))
    fp = F.sum(_one((y == 0) & (p == 1)))
    fn = F.sum(_one((y == 1) & (p == 0)))
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(F.lit(0.0))
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(F.lit(0.0))
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(F.lit(0.0))
    return [F.coalesce(prec, F.lit(0.0)).alias("precision"),
            F.coalesce(rec, F.lit(0.0)).alias("recall"),
            F.coalesce(f1, F.lit(0.0)).alias("f1")]


def log_loss_col(target: str = "is_win", prob: str = "predicted_prob", eps: float = EPS) -> Column:
    p = F.least(F.greatest(F.col(prob).cast("double"), F.lit(eps)), F.lit(1.0 - eps))
    y = F.col(target).cast("double")
    return F.avg(-(y * F.log(p) + (F.lit(1.0) - y) * F.log(F.lit(1.0) - p)))


# -- K7 ----------------------------------------------------------------------
def auc_roc(df: DataFrame, by: Sequence[str] = (), target: str = "is_win",
            prob: str = "predicted_prob") -> DataFrame:
    """Area under the ROC curve, ties counted one half; 0.0 with one class.

    Rows are first reduced to one row per distinct score (partial aggregate),
    then the positives above each score come from a distributed running sum
    over the scores in descending order.
    """
    by = list(by)
    s = df.groupBy(*by, F.col(prob).alias("_s")).agg(
        F.sum(F.col(target).cast("long")).alias("_pos"),
        F.sum((F.col(target) == 0).cast("long")).alias("_neg"))
    s = running_sum(s, by, [desc("_s")], ["_pos"])
    neg = F.col("_neg").cast("double")                 # products of counts exceed a long
    pairs = neg * F.col("_pos_before") + F.lit(0.5) * F.col("_pos") * neg
    t = _grouped(s, by, F.sum(pairs).alias("_num"), F.sum("_pos").alias("_p"),
                 F.sum("_neg").alias("_n"))
    auc = F.when((F.col("_p") > 0) & (F.col("_n") > 0),
                 F.col("_num") / (F.col("_p").cast("double") * F.col("_n"))).otherwise(F.lit(0.0))
    return t.select(*by, auc.alias("auc_roc"))


# -- K10 ---------------------------------------------------------------------
def ndcg_multi(df: DataFrame, by: Sequence[str] = (), ks: Sequence[int | None] = (None,)) -> DataFrame:
    """Mean per-race NDCG for several cutoffs from one pass (None = all entries).

    Relevance = entries in race - actual + 1. A race has a bounded field, so one
    aggregate collects its (rank, horse, actual) and array functions sum the gains
    of the predicted and of the ideal order: one shuffle. Columns ``ndcg`` /
    ``ndcg_at_{k}``.
    """
    by = list(by)
    keys = [*by, "race_id"]
    entry = F.struct(F.col("predicted_rank").alias("rank"), F.col("horse_id").alias("horse"), F.col("actual_position").alias("actual"))
    races = df.groupBy(*keys).agg(F.collect_list(entry).alias("_field"), F.count(F.lit(1)).alias("_n"))
    rel = F.transform(F.array_sort("_field"), lambda e: (F.col("_n") - e["actual"] + 1).cast("double"))
    ideal = F.sort_array(F.col("_rel"), asc=False)             # entries without a position come last
    races = races.withColumn("_rel", rel).withColumn("_ideal", ideal)

    def gain(order: str, k) -> Column:
        head = F.col(order) if k is None else F.slice(order, 1, k)
        gains = F.transform(head, lambda r, i: F.coalesce(r, F.lit(0.0)) / F.log2(i + F.lit(2.0)))
        return F.aggregate(gains, F.lit(0.0), lambda a, g: a + g)

    names = {k: ("ndcg" if k is None else f"ndcg_at_{k}") for k in ks}
    sums = {}
    for k, nm in names.items():
        sums |= {f"_d_{nm}": gain("_rel", k), f"_i_{nm}": gain("_ideal", k)}
    per_race = races.select(*keys, *[c.alias(n) for n, c in sums.items()])
    outs = [F.coalesce(F.avg(F.when(F.col(f"_i_{nm}") > 0, F.col(f"_d_{nm}") / F.col(f"_i_{nm}"))
                             .otherwise(F.lit(0.0))), F.lit(0.0)).alias(nm) for nm in names.values()]
    return _grouped(per_race, by, *outs)


def ndcg(df: DataFrame, by: Sequence[str] = (), k: int | None = None,
         name: str | None = None) -> DataFrame:
    """Mean per-race NDCG (@k). Relevance = entries in race - actual + 1."""
    out = ndcg_multi(df, by, [k])
    nm = "ndcg" if k is None else f"ndcg_at_{k}"
    return out.withColumnRenamed(nm, name) if name and name != nm else out


# -- K11 ---------------------------------------------------------------------
def compute_all(df: DataFrame, by: Sequence[str] = (), has_betting: bool = False) -> DataFrame:
    """All metrics the columns allow, long form (by..., metric, value).

    One row-level aggregate for the per-row metrics, one race-level aggregate
    each for top-3 and NDCG, one score-level aggregate for AUC; joined on
    ``by`` (one row per group each). The caller may persist the prediction
    frame, which feeds these branches.
    """
    by = list(by)
    whole = not by
    if whole:  # one group: a constant key keeps every join an equi-join
        df, by = df.withColumn("_all", F.lit(0)), ["_all"]
    cols = set(df.columns)
    aggs = [win_accuracy_col().alias("win_accuracy"), place_accuracy_col().alias("place_accuracy")]
    has_prob = {"predicted_prob", "is_win"} <= cols
    if has_prob:
        aggs.append(log_loss_col().alias("log_loss"))
    if {"predicted_win", "is_win"} <= cols:
        aggs += prf_cols()
    if has_betting:
        aggs += [recovery_rate_col().alias("recovery_rate"), roi_col().alias("roi")]
        if {"predicted_prob", "odds"} <= cols:
            aggs.append(expected_value_col().alias("expected_value"))
    parts = [_grouped(df, by, *aggs), top_n_accuracy(df, by), ndcg_multi(df, by, [None, 3])]
    if has_prob:
        parts.append(auc_roc(df, by))
    wide = parts[0]
    for p in parts[1:]:
        wide = wide.join(p, by)            # one row per group on each side
    metrics = [c for c in wide.columns if c not in by]
    stack = F.expr("stack({}, {})".format(
        len(metrics), ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in metrics)))
    out = wide.select(*by, stack.alias("metric", "value"))
    return out.drop("_all") if whole else out


# -- I3, I4 ------------------------------------------------------------------
THRESHOLDS = [i / 100 for i in range(1, 50)]   # 0.01 ... 0.49


def threshold_bucket(p: Column) -> Column:
    """Number of thresholds i/100 (i = 1..49) that are <= p, exactly.

    ``floor(p*100)`` alone is off by one where p*100 rounds below an integer
    (0.29*100 = 28.999...), so the neighbours are checked against the same
    doubles the thresholds are.
    """
    b = F.floor(p * 100).cast("int")
    b = (b + F.when((b + 1) / F.lit(100.0) <= p, 1).otherwise(0)
           - F.when(b / F.lit(100.0) > p, 1).otherwise(0))
    return F.least(F.greatest(b, F.lit(0)), F.lit(len(THRESHOLDS)))


def best_threshold(df: DataFrame, target: str = "is_win", prob: str = "predicted_prob",
                   by: Sequence[str] = ()) -> DataFrame:
    """Threshold in 0.01..0.49 that maximises F1 of ``prob >= t``.

    The lowest threshold wins ties; 0.01 if every F1 is 0. Rows are reduced to
    at most 50 buckets per group, so the scan over thresholds is over 49 rows.
    """
    by = list(by)
    whole = not by
    if whole:
        df, by = df.withColumn("_all", F.lit(0)), ["_all"]
    b = df.groupBy(*by, threshold_bucket(F.col(prob)).alias("_b")).agg(
        F.sum(F.col(target).cast("long")).alias("_pos"), F.count(F.lit(1)).alias("_cnt"))
    grid = b.select(*by).distinct().withColumn(
        "_i", F.explode(F.sequence(F.lit(1), F.lit(len(THRESHOLDS)))))   # groups x 49 rows
    w = Window.partitionBy(*by).orderBy(F.col("_i").desc()).rowsBetween(Window.unboundedPreceding, 0)
    ge = grid.join(b.withColumnRenamed("_b", "_i"), [*by, "_i"], "left").select(
        *by, "_i", F.coalesce("_pos", F.lit(0)).alias("_pos"), F.coalesce("_cnt", F.lit(0)).alias("_cnt"))
    allpos = b.groupBy(*by).agg(F.sum("_pos").alias("_P"))
    ge = ge.withColumns({"_tp": F.sum("_pos").over(w), "_pp": F.sum("_cnt").over(w)})
    ge = ge.join(allpos, by)
    tp, fp, fn = F.col("_tp"), F.col("_pp") - F.col("_tp"), F.col("_P") - F.col("_tp")
    prec = F.when(tp + fp > 0, tp / (tp + fp)).otherwise(0.0)
    rec = F.when(tp + fn > 0, tp / (tp + fn)).otherwise(0.0)
    f1 = F.when(prec + rec > 0, 2 * prec * rec / (prec + rec)).otherwise(0.0)
    ge = ge.withColumns({"f1": f1, "threshold": F.col("_i") / F.lit(100.0)})
    best = ge.filter(F.col("f1") > 0)
    pick = F.min_by(F.struct("threshold", "f1"), F.struct(-F.col("f1"), F.col("threshold")))
    res = ge.groupBy(*by).agg(F.max("f1").alias("_mx"))
    chosen = best.groupBy(*by).agg(pick.alias("_b"))
    out = res.join(chosen, by, "left").select(
        *by, F.coalesce(F.col("_b.threshold"), F.lit(0.01)).alias("threshold"),
        F.coalesce(F.col("_b.f1"), F.lit(0.0)).alias("f1"))
    return out.drop("_all") if whole else out


def classify(prob: Column, threshold: float | Column) -> Column:
    """I4: 1 if prob >= threshold else 0."""
    t = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    return (prob >= t).cast("int")


# -- I6, I7 ------------------------------------------------------------------
def group_sizes(df: DataFrame, key: str = "race_id") -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).cast("long").alias("group_size"))


def relevance(pos: Column, max_position: int = 18) -> Column:
    """Ranking label: max_position - min(pos, max_position) + 1."""
    return (F.lit(max_position) - F.least(pos, F.lit(max_position)) + 1).cast("long")
