"""Queries for ranks, prediction frames and metrics."""

from __future__ import annotations

from pyspark.sql import functions as F

from paddock.operators import metrics as M
from paddock.operators.backtest import prediction_frame, predicted_rank
from paddock.operators.history import add_targets
from paddock.operators.models import ensemble
from paddock.plans.bindings import entries, with_entries
from paddock.plans.catalog import query, r6

THRESHOLD = 0.05
TIE = ("horse_id", "ln", "jockey_id", "price", "ship")


def predictions(spark, sf, threshold: float = THRESHOLD):
    """Entries scored by the deterministic probability, ranked inside races."""
    e = add_targets(entries(spark, sf))
    p = prediction_frame(e, threshold=threshold,
                         ids=("race_id", "horse_id", "ln", "jockey_id", "price", "ship",
                              "course", "race_date"))
    return predicted_rank(p, tie_break=TIE)


PREDS_SQL = f"""
, preds AS (
  SELECT race_id, horse_id, ln, jockey_id, price, ship, course, race_date,
         CAST(finish_position = 1 AS BIGINT) AS is_win, predicted_prob,
         CAST(predicted_prob >= {THRESHOLD} AS BIGINT) AS predicted_win,
         CAST(finish_position AS BIGINT) AS actual_position, odds, bet_amount, payout,
         CAST(row_number() OVER (PARTITION BY race_id ORDER BY predicted_prob DESC, horse_id, ln,
              jockey_id, price, ship) AS BIGINT) AS predicted_rank
  FROM entries
)"""


def with_preds(sql: str) -> str:
    return with_entries(PREDS_SQL + "\n" + sql.strip())


@query("predicted_rank", with_preds("""
SELECT race_id, horse_id, CAST(ln AS BIGINT) AS ln, round(predicted_prob, 6) AS predicted_prob,
       predicted_rank FROM preds"""))
def q_predicted_rank(spark, sf):
    p = predictions(spark, sf)
    return p.select("race_id", "horse_id", F.col("ln").cast("long").alias("ln"),
                    r6("predicted_prob").alias("predicted_prob"), "predicted_rank")


@query("prediction_frame", with_preds("""
SELECT race_id, horse_id, CAST(ln AS BIGINT) AS ln, is_win, round(predicted_prob, 6) AS predicted_prob,
       predicted_win, actual_position, round(odds, 6) AS odds, round(bet_amount, 6) AS bet_amount,
       round(payout, 6) AS payout, predicted_rank FROM preds"""))
def q_prediction_frame(spark, sf):
    p = predictions(spark, sf)
    return p.select("race_id", "horse_id", F.col("ln").cast("long").alias("ln"), "is_win",
                    r6("predicted_prob").alias("predicted_prob"), "predicted_win", "actual_position",
                    r6("odds").alias("odds"), r6("bet_amount").alias("bet_amount"),
                    r6("payout").alias("payout"), "predicted_rank")


@query("win_accuracy", with_preds("""
SELECT round(COALESCE(avg(CASE WHEN actual_position = 1 THEN 1.0e0 ELSE 0.0e0 END), 0.0), 6) AS win_accuracy
FROM preds WHERE predicted_rank = 1"""))
def q_win_accuracy(spark, sf):
    return M.win_accuracy(predictions(spark, sf)).select(r6("win_accuracy").alias("win_accuracy"))


@query("place_accuracy", with_preds("""
SELECT round(COALESCE(avg(CASE WHEN actual_position <= 3 THEN 1.0e0 ELSE 0.0e0 END), 0.0), 6) AS place_accuracy
FROM preds WHERE predicted_rank = 1"""))
def q_place_accuracy(spark, sf):
    return M.place_accuracy(predictions(spark, sf)).select(r6("place_accuracy").alias("place_accuracy"))


TOP3_SQL = """
, ph AS (
  SELECT race_id, horse_id, max(CAST(predicted_rank <= 3 AS INTEGER)) AS p,
         max(CAST(actual_position <= 3 AS INTEGER)) AS a
  FROM preds GROUP BY race_id, horse_id
), pr AS (
  SELECT race_id, sum(p * a) AS hit, sum(a) AS act FROM ph GROUP BY race_id
)"""


@query("top_n_accuracy", with_preds(TOP3_SQL + """
SELECT round(COALESCE(avg(CASE WHEN act > 0 THEN hit * 1.0e0 / act END), 0.0), 6) AS top3_accuracy FROM pr"""))
def q_top_n_accuracy(spark, sf):
    return M.top_n_accuracy(predictions(spark, sf)).select(r6("top3_accuracy").alias("top3_accuracy"))


@query("recovery_rate", with_preds("""
SELECT round(CASE WHEN COALESCE(sum(bet_amount), 0) = 0 THEN 0.0 ELSE sum(payout) / sum(bet_amount) END, 6)
       AS recovery_rate FROM preds"""))
def q_recovery_rate(spark, sf):
    return predictions(spark, sf).agg(r6(M.recovery_rate_col()).alias("recovery_rate"))


@query("roi", with_preds("""
SELECT round(CASE WHEN COALESCE(sum(bet_amount), 0) = 0 THEN 0.0
            ELSE (sum(payout) - sum(bet_amount)) / sum(bet_amount) END, 6) AS roi FROM preds"""))
def q_roi(spark, sf):
    return predictions(spark, sf).agg(r6(M.roi_col()).alias("roi"))


@query("expected_value", with_preds("""
SELECT round(COALESCE(avg(predicted_prob * odds - 1.0e0), 0.0), 6) AS expected_value FROM preds"""))
def q_expected_value(spark, sf):
    return predictions(spark, sf).agg(r6(M.expected_value_col()).alias("expected_value"))


AUC_SQL = """
, {name}_sc AS (
  SELECT {by} predicted_prob AS s, sum(is_win) AS pos, sum(CAST(is_win = 0 AS BIGINT)) AS neg
  FROM {src} GROUP BY {by} predicted_prob
), {name}_scw AS (
  SELECT *, COALESCE(sum(pos) OVER (PARTITION BY {part} ORDER BY s DESC
         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_before FROM {name}_sc
), {name} AS (
  SELECT {by} CASE WHEN sum(pos) > 0 AND sum(neg) > 0
         THEN sum(neg * pos_before + 0.5 * pos * neg) / (sum(pos) * 1.0e0 * sum(neg)) ELSE 0.0 END AS auc_roc
  FROM {name}_scw {group}
)"""


def auc_sql(src: str = "preds", by: str = "", name: str = "auc") -> str:
    return AUC_SQL.format(by=f"{by}, " if by else "", src=src, part=by or "1",
                          group=f"GROUP BY {by}" if by else "", name=name)


@query("auc_roc", with_preds(auc_sql() + "\nSELECT round(auc_roc, 6) AS auc_roc FROM auc"))
def q_auc_roc(spark, sf):
    return M.auc_roc(predictions(spark, sf)).select(r6("auc_roc").alias("auc_roc"))


@query("precision_recall_f1", with_preds("""
, c AS (
  SELECT sum(CASE WHEN is_win = 1 AND predicted_win = 1 THEN 1.0e0 ELSE 0.0e0 END) AS tp,
         sum(CASE WHEN is_win = 0 AND predicted_win = 1 THEN 1.0e0 ELSE 0.0e0 END) AS fp,
         sum(CASE WHEN is_win = 1 AND predicted_win = 0 THEN 1.0e0 ELSE 0.0e0 END) AS fn
  FROM preds
), pr AS (
  SELECT CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS p,
         CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS r FROM c
)
SELECT round(p, 6) AS precision, round(r, 6) AS recall,
       round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END, 6) AS f1 FROM pr"""))
def q_prf(spark, sf):
    return predictions(spark, sf).agg(*M.prf_cols()).select(
        *[r6(c).alias(c) for c in ("precision", "recall", "f1")])


@query("log_loss", with_preds("""
SELECT round(avg(-(is_win * ln(least(greatest(predicted_prob, 1e-15), 1 - 1e-15))
   + (1 - is_win) * ln(1 - least(greatest(predicted_prob, 1e-15), 1 - 1e-15)))), 6) AS log_loss FROM preds"""))
def q_log_loss(spark, sf):
    return predictions(spark, sf).agg(r6(M.log_loss_col()).alias("log_loss"))


NDCG_SQL = """
, {name}_rr AS (
  SELECT *, count(*) OVER (PARTITION BY {key}) - actual_position + 1 AS rel FROM {src}
), {name}_rp AS (
  SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY predicted_rank, horse_id) - 1 AS pp,
            row_number() OVER (PARTITION BY {key} ORDER BY rel DESC, horse_id) - 1 AS ip,
            count(*) OVER (PARTITION BY {key}) AS n
  FROM {name}_rr
), {name}_rd AS (
  SELECT {key}, sum(CASE WHEN pp < {cut} THEN rel / log2(pp + 2.0) ELSE 0.0 END) AS dcg,
         sum(CASE WHEN ip < {cut} THEN rel / log2(ip + 2.0) ELSE 0.0 END) AS idcg
  FROM {name}_rp GROUP BY {key}
), {name} AS (
  SELECT {by} COALESCE(avg(CASE WHEN idcg > 0 THEN dcg / idcg ELSE 0.0 END), 0.0) AS {name}
  FROM {name}_rd {group}
)"""


def ndcg_sql(k=None, src="preds", by=""):
    name = "ndcg" if k is None else f"ndcg_at_{k}"
    return NDCG_SQL.format(key=f"{by}, race_id" if by else "race_id", src=src,
                           cut="n" if k is None else str(k), name=name,
                           by=f"{by}, " if by else "", group=f"GROUP BY {by}" if by else "")


@query("ndcg", with_preds(ndcg_sql() + "\nSELECT round(ndcg, 6) AS ndcg FROM ndcg"))
def q_ndcg(spark, sf):
    return M.ndcg(predictions(spark, sf)).select(r6("ndcg").alias("ndcg"))


@query("ndcg_at_3", with_preds(ndcg_sql(3) + "\nSELECT round(ndcg_at_3, 6) AS ndcg_at_3 FROM ndcg_at_3"))
def q_ndcg3(spark, sf):
    return M.ndcg(predictions(spark, sf), k=3).select(r6("ndcg_at_3").alias("ndcg_at_3"))


def metrics_all_sql(src: str, by: str) -> str:
    """Long-form metrics per ``by`` group over the prediction rows in ``src``."""
    top3 = f"""
, ph AS (
  SELECT {by}, race_id, horse_id, max(CAST(predicted_rank <= 3 AS INTEGER)) AS p,
         max(CAST(actual_position <= 3 AS INTEGER)) AS a FROM {src} GROUP BY {by}, race_id, horse_id
), pr AS (SELECT {by}, race_id, sum(p * a) AS hit, sum(a) AS act FROM ph GROUP BY {by}, race_id),
t3 AS (SELECT {by}, COALESCE(avg(CASE WHEN act > 0 THEN hit * 1.0e0 / act END), 0.0) AS top3_accuracy
       FROM pr GROUP BY {by})"""
    row = f"""
, rowm AS (
  SELECT {by},
    COALESCE(avg(CASE WHEN predicted_rank = 1 THEN CASE WHEN actual_position = 1 THEN 1.0e0 ELSE 0.0e0 END END), 0.0) AS win_accuracy,
    COALESCE(avg(CASE WHEN predicted_rank = 1 THEN CASE WHEN actual_position <= 3 THEN 1.0e0 ELSE 0.0e0 END END), 0.0) AS place_accuracy,
    avg(-(is_win * ln(least(greatest(predicted_prob, 1e-15), 1 - 1e-15))
        + (1 - is_win) * ln(1 - least(greatest(predicted_prob, 1e-15), 1 - 1e-15)))) AS log_loss,
    sum(CASE WHEN is_win = 1 AND predicted_win = 1 THEN 1.0e0 ELSE 0.0e0 END) AS tp,
    sum(CASE WHEN is_win = 0 AND predicted_win = 1 THEN 1.0e0 ELSE 0.0e0 END) AS fp,
    sum(CASE WHEN is_win = 1 AND predicted_win = 0 THEN 1.0e0 ELSE 0.0e0 END) AS fn,
    CASE WHEN COALESCE(sum(bet_amount), 0) = 0 THEN 0.0 ELSE sum(payout) / sum(bet_amount) END AS recovery_rate,
    CASE WHEN COALESCE(sum(bet_amount), 0) = 0 THEN 0.0 ELSE (sum(payout) - sum(bet_amount)) / sum(bet_amount) END AS roi,
    COALESCE(avg(predicted_prob * odds - 1.0e0), 0.0) AS expected_value
  FROM {src} GROUP BY {by}
), prf AS (
  SELECT *, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0.0 END AS precision,
            CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0.0 END AS recall FROM rowm
), wide AS (
  SELECT prf.*, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1,
         t3.top3_accuracy, ndcg.ndcg, ndcg_at_3.ndcg_at_3, auc.auc_roc
  FROM prf JOIN t3 USING ({by}) JOIN ndcg USING ({by}) JOIN ndcg_at_3 USING ({by}) JOIN auc USING ({by})
)"""
    names = ["win_accuracy", "place_accuracy", "log_loss", "precision", "recall", "f1",
             "recovery_rate", "roi", "expected_value", "top3_accuracy", "ndcg", "ndcg_at_3", "auc_roc"]
    unions = "\nUNION ALL ".join(
        f"SELECT {by}, '{m}' AS metric, round(CAST({m} AS DOUBLE), 6) AS value FROM wide" for m in names)
    return (top3 + ndcg_sql(src=src, by=by) + ndcg_sql(3, src=src, by=by)
            + auc_sql(src=src, by=by) + row + "\n" + unions)


@query("metrics_all", with_preds(metrics_all_sql("preds", "course")))
def q_metrics_all(spark, sf):
    m = M.compute_all(predictions(spark, sf), by=["course"], has_betting=True)
    return m.select("course", "metric", r6("value").alias("value"))


THRESH_SQL = """
, grid AS (SELECT CAST(i AS INTEGER) AS i, i / 100.0e0 AS threshold FROM range(1, 50) t(i)),
tc AS (
  SELECT g.threshold, sum(CASE WHEN p.predicted_prob >= g.threshold AND p.is_win = 1 THEN 1 ELSE 0 END) AS tp,
         sum(CASE WHEN p.predicted_prob >= g.threshold AND p.is_win = 0 THEN 1 ELSE 0 END) AS fp,
         sum(CASE WHEN p.predicted_prob < g.threshold AND p.is_win = 1 THEN 1 ELSE 0 END) AS fn
  FROM grid g, preds p GROUP BY g.threshold
), tf AS (
  SELECT threshold, CASE WHEN tp + fp > 0 THEN tp * 1.0e0 / (tp + fp) ELSE 0.0 END AS pr,
         CASE WHEN tp + fn > 0 THEN tp * 1.0e0 / (tp + fn) ELSE 0.0 END AS rc FROM tc
), tb AS (
  SELECT threshold, CASE WHEN pr + rc > 0 THEN 2 * pr * rc / (pr + rc) ELSE 0.0 END AS f1 FROM tf
), best AS (
  SELECT COALESCE((SELECT threshold FROM tb WHERE f1 > 0 ORDER BY f1 DESC, threshold LIMIT 1), 0.01) AS threshold,
         COALESCE((SELECT max(f1) FROM tb), 0.0) AS f1
)"""


@query("best_threshold", with_preds(THRESH_SQL + "\nSELECT round(threshold, 6) AS threshold, round(f1, 6) AS f1 FROM best"))
def q_best_threshold(spark, sf):
    b = M.best_threshold(predictions(spark, sf))
    return b.select(r6("threshold").alias("threshold"), r6("f1").alias("f1"))


@query("threshold_class", with_preds(THRESH_SQL + """
SELECT race_id, horse_id, CAST(ln AS BIGINT) AS ln,
       CAST(predicted_prob >= (SELECT threshold FROM best) AS INTEGER) AS predicted_class
FROM preds"""))
def q_threshold_class(spark, sf):
    p = predictions(spark, sf)
    t = M.best_threshold(p).select(F.lit(0).alias("_k"), "threshold")   # one row
    x = p.withColumn("_k", F.lit(0)).join(F.broadcast(t), "_k")
    return x.select("race_id", "horse_id", F.col("ln").cast("long").alias("ln"),
                    M.classify(F.col("predicted_prob"), F.col("threshold")).alias("predicted_class"))


@query("group_sizes", with_entries("""
SELECT race_id, CAST(count(*) AS BIGINT) AS group_size FROM entries GROUP BY race_id"""))
def q_group_sizes(spark, sf):
    return M.group_sizes(entries(spark, sf))


@query("relevance", with_entries("""
SELECT race_id, horse_id, CAST(ln AS BIGINT) AS ln,
       CAST(18 - least(finish_position, 18) + 1 AS BIGINT) AS relevance FROM entries"""))
def q_relevance(spark, sf):
    e = entries(spark, sf)
    return e.select("race_id", "horse_id", F.col("ln").cast("long").alias("ln"),
                    M.relevance(F.col("finish_position")).alias("relevance"))


ENSEMBLE_WEIGHTS = [5.0, 3.0, 2.0]


@query("ensemble", with_entries("""
SELECT race_id, horse_id, CAST(ln AS BIGINT) AS ln,
       round(0.5 * predicted_prob + 0.3 * (1.0e0 / (1 + ln)) + 0.2 * ((horse_weight_change + 4) / 10), 6) AS ensemble_prob,
       round(0.5 * CAST(predicted_prob >= 0.5 AS DOUBLE) + 0.3 * CAST(1.0e0 / (1 + ln) >= 0.5 AS DOUBLE)
             + 0.2 * CAST((horse_weight_change + 4) / 10 >= 0.5 AS DOUBLE), 6) AS ensemble_class
FROM entries"""))
def q_ensemble(spark, sf):
    e = entries(spark, sf)
    probs = [F.col("predicted_prob"), F.lit(1.0) / (F.lit(1) + F.col("ln")),
             (F.col("horse_weight_change") + 4) / 10]
    p, c = ensemble(probs, ENSEMBLE_WEIGHTS)
    return e.select("race_id", "horse_id", F.col("ln").cast("long").alias("ln"),
                    r6(p).alias("ensemble_prob"), r6(c).alias("ensemble_class"))
