"""Queries for ingest, normalisation and quality."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from paddock.functions import parsers as P
from paddock.operators import ingest as I
from paddock.operators.quality import report, validate
from paddock.plans.bindings import entries, raw_results, with_entries, with_raw
from paddock.plans.catalog import query, r6
from paddock.session import scratch_dir
from paddock.sources.results_csv import filter_dates, load_race_results, map_columns, normalise
from paddock.sources.tables import counted_table, table

NON_FINISH_SQL = ", ".join(f"'{w}'" for w in P.NON_FINISH)


def sql_finish(x):
    return (f"CASE WHEN {x} IN ({NON_FINISH_SQL}) THEN NULL "
            f"WHEN regexp_full_match({x}, '[0-9]+') THEN TRY_CAST({x} AS INTEGER) END")


def sql_hash(x):
    return f"CASE WHEN {x} IS NOT NULL AND {x} <> '' THEN substr(sha256({x}), 1, 12) END"


def sql_sex_age(x):
    short = f"({x} IS NULL OR length({x}) < 2)"
    split = f"regexp_full_match({x}, '\\D+\\d+')"
    last = f"regexp_matches({x}, '\\d$')"
    sex = (f"CASE WHEN {short} THEN NULL WHEN {split} THEN regexp_extract({x}, '^(\\D+)(\\d+)$', 1) "
           f"WHEN {last} THEN substr({x}, 1, length({x}) - 1) ELSE {x} END")
    age = (f"CASE WHEN {short} THEN NULL WHEN {split} THEN TRY_CAST(regexp_extract({x}, '^(\\D+)(\\d+)$', 2) AS INTEGER) "
           f"WHEN {last} THEN TRY_CAST(substr({x}, length({x}), 1) AS INTEGER) END")
    return sex, age


def sql_corners(x):
    return [f"TRY_CAST(trim(string_split({x}, '-')[{i + 1}]) AS INTEGER)" for i in range(4)]


def sql_weight(x):
    t = f"trim({x})"
    base = f"TRY_CAST(CASE WHEN instr({t}, '(') > 0 THEN split_part({t}, '(', 1) ELSE {t} END AS DOUBLE)"
    change = (f"CASE WHEN instr({t}, '(') > 0 AND {base} IS NOT NULL THEN "
              f"TRY_CAST(regexp_replace(substr({t}, instr({t}, '(') + 1), '\\)+$', '') AS DOUBLE) END")
    return base, change


def sql_date(x):
    return f"CAST(try_strptime({x}, '%Y-%m-%d') AS DATE)"


SEX, AGE = sql_sex_age('"性齢"')
C1, C2, C3, C4 = sql_corners('"通過"')
WBASE, WCHANGE = sql_weight('"馬体重"')

NORM_TEMPLATE = f"""
, norm AS (
  SELECT CAST("レースID" AS VARCHAR) AS race_id, {sql_finish('"着順"')} AS finish_position,
         TRY_CAST("枠番" AS INTEGER) AS bracket_number, TRY_CAST("馬番" AS INTEGER) AS post_position,
         "馬名" AS horse_name, {sql_hash('"馬名"')} AS horse_id,
         "騎手" AS jockey_name, {sql_hash('"騎手"')} AS jockey_id,
         {SEX} AS sex, {AGE} AS age, TRY_CAST("斤量" AS DOUBLE) AS carried_weight,
         {C1} AS corner_position_1, {C2} AS corner_position_2, {C3} AS corner_position_3, {C4} AS corner_position_4,
         TRY_CAST("上り" AS DOUBLE) AS last_3f_time, TRY_CAST("単勝" AS DOUBLE) AS win_odds,
         TRY_CAST("人気" AS INTEGER) AS win_favorite, {WBASE} AS weight, {WCHANGE} AS horse_weight_change,
         TRY_CAST("賞金" AS DOUBLE) AS prize_money, "競馬場名" AS course, TRY_CAST("距離" AS INTEGER) AS distance,
         "天候" AS weather, "馬場状態" AS track_condition, "芝・ダート" AS track_type, "レース名" AS race_name,
         TRY_CAST("レース番号" AS INTEGER) AS race_number, "リステッド・重賞" AS grade,
         {sql_date('"日付"')} AS race_date
  FROM {{src}}
)"""

NORM_SQL = NORM_TEMPLATE.replace("{src}", "raw")
NORM_CSV_SQL = NORM_TEMPLATE.replace("{src}", "raw_csv")

RAW_COLS = ["レースID", "着順", "枠番", "馬番", "馬名", "性齢", "斤量", "騎手", "通過", "上り", "単勝", "人気",
            "馬体重", "賞金", "競馬場名", "距離", "天候", "馬場状態", "芝・ダート", "レース名", "レース番号",
            "リステッド・重賞", "日付"]
# A CSV field written empty reads back as null (in the reference's reader too).
RAW_CSV_SQL = ", raw_csv AS (SELECT " + ", ".join(f'NULLIF("{c}", \'\') AS "{c}"' for c in RAW_COLS) + " FROM raw)"

NORM_COLS = ["race_id", "finish_position", "bracket_number", "post_position", "horse_id", "jockey_id",
             "sex", "age", "carried_weight", "corner_position_1", "corner_position_2", "corner_position_3",
             "corner_position_4", "last_3f_time", "win_odds", "win_favorite", "weight",
             "horse_weight_change", "prize_money", "course", "distance", "weather", "track_condition",
             "track_type", "race_name", "race_number", "grade", "race_date"]
FLOATS = {"carried_weight", "last_3f_time", "win_odds", "weight", "horse_weight_change", "prize_money"}


def norm_select_sql(src="norm"):
    cols = ", ".join(f"round({c}, 6) AS {c}" if c in FLOATS else c for c in NORM_COLS)
    return f"SELECT {cols} FROM {src}"


def norm_select(df):
    return df.select(*[r6(c).alias(c) if c in FLOATS else F.col(c) for c in NORM_COLS])


def normalised(spark, sf):
    return normalise(map_columns(raw_results(spark, sf)))


@query("parse_finish", with_raw(f"""SELECT "着順" AS raw, {sql_finish('"着順"')} AS finish_position FROM raw"""))
def q_parse_finish(spark, sf):
    r = raw_results(spark, sf)
    return r.select(F.col("着順").alias("raw"), P.parse_finish("着順").alias("finish_position"))


@query("hash_id", with_raw(f"""SELECT "馬名" AS horse_name, {sql_hash('"馬名"')} AS horse_id,
    "騎手" AS jockey_name, {sql_hash('"騎手"')} AS jockey_id FROM raw"""))
def q_hash_id(spark, sf):
    r = raw_results(spark, sf)
    return r.select(F.col("馬名").alias("horse_name"), P.hash_id("馬名").alias("horse_id"),
                    F.col("騎手").alias("jockey_name"), P.hash_id("騎手").alias("jockey_id"))


@query("parse_sex_age", with_raw(f"""SELECT "性齢" AS raw, {SEX} AS sex, {AGE} AS age FROM raw"""))
def q_parse_sex_age(spark, sf):
    r = raw_results(spark, sf)
    sex, age = P.parse_sex_age("性齢")
    return r.select(F.col("性齢").alias("raw"), sex.alias("sex"), age.alias("age"))


@query("parse_corners", with_raw(f"""SELECT "通過" AS raw, {C1} AS corner_position_1, {C2} AS corner_position_2,
    {C3} AS corner_position_3, {C4} AS corner_position_4 FROM raw"""))
def q_parse_corners(spark, sf):
    r = raw_results(spark, sf)
    cs = P.parse_corners("通過")
    return r.select(F.col("通過").alias("raw"), *[c.alias(f"corner_position_{i + 1}") for i, c in enumerate(cs)])


@query("parse_weight", with_raw(f"""SELECT "馬体重" AS raw, round({WBASE}, 6) AS weight,
    round({WCHANGE}, 6) AS horse_weight_change FROM raw"""))
def q_parse_weight(spark, sf):
    r = raw_results(spark, sf)
    b, c = P.parse_weight("馬体重")
    return r.select(F.col("馬体重").alias("raw"), r6(b).alias("weight"), r6(c).alias("horse_weight_change"))


@query("parse_date", with_raw(f"""SELECT "日付" AS raw, {sql_date('"日付"')} AS race_date FROM raw"""))
def q_parse_date(spark, sf):
    r = raw_results(spark, sf)
    return r.select(F.col("日付").alias("raw"), P.parse_date("日付").alias("race_date"))


@query("safe_casts", with_raw("""SELECT TRY_CAST("枠番" AS INTEGER) AS bracket_number,
    TRY_CAST("距離" AS INTEGER) AS distance, TRY_CAST("人気" AS INTEGER) AS win_favorite,
    TRY_CAST("レース番号" AS INTEGER) AS race_number, round(TRY_CAST("斤量" AS DOUBLE), 6) AS carried_weight,
    round(TRY_CAST("単勝" AS DOUBLE), 6) AS win_odds, round(TRY_CAST("上り" AS DOUBLE), 6) AS last_3f_time,
    round(TRY_CAST("賞金" AS DOUBLE), 6) AS prize_money FROM raw"""))
def q_safe_casts(spark, sf):
    r = raw_results(spark, sf)
    return r.select(P.safe_int("枠番").alias("bracket_number"), P.safe_int("距離").alias("distance"),
                    P.safe_int("人気").alias("win_favorite"), P.safe_int("レース番号").alias("race_number"),
                    r6(P.safe_double("斤量")).alias("carried_weight"), r6(P.safe_double("単勝")).alias("win_odds"),
                    r6(P.safe_double("上り")).alias("last_3f_time"), r6(P.safe_double("賞金")).alias("prize_money"))


@query("csv_mapping", with_raw(RAW_CSV_SQL + NORM_CSV_SQL + "\n" + norm_select_sql()))
def q_csv_mapping(spark, sf):
    """A1 + A2 + B: raw rows written as a Japanese-header CSV, read back and normalised."""
    path = scratch_dir(spark, "results-csv")
    raw_results(spark, sf).write.option("header", True).option("encoding", "UTF-8").csv(path)
    return norm_select(load_race_results(spark, path))


D0, D1 = dt.date(1996, 1, 1), dt.date(1997, 12, 31)


@query("scan_date_range", with_raw(NORM_SQL + f"""
SELECT race_id, horse_id, finish_position, race_date FROM norm
WHERE race_date >= DATE '{D0}' AND race_date <= DATE '{D1}'"""))
def q_scan_date_range(spark, sf):
    n = filter_dates(normalised(spark, sf), D0, D1)
    return n.select("race_id", "horse_id", "finish_position", "race_date")


@query("sql_params", with_entries(f"""
SELECT course, CAST(count(*) AS BIGINT) AS n, round(avg(price), 6) AS avg_price
FROM entries WHERE race_date BETWEEN DATE '{D0}' AND DATE '{D1}' GROUP BY course"""))
def q_sql_params(spark, sf):
    """A5: parameterised SQL over a frame (named parameter markers)."""
    return spark.sql(
        "SELECT course, CAST(count(*) AS BIGINT) AS n, round(avg(price), 6) AS avg_price "
        "FROM {e} WHERE race_date BETWEEN :d0 AND :d1 GROUP BY course",
        args={"d0": D0, "d1": D1}, e=entries(spark, sf))


RACE_DIM_SQL = """
, rd AS (
  SELECT *, row_number() OVER (PARTITION BY race_id ORDER BY post_position NULLS FIRST,
         race_date NULLS FIRST, race_name NULLS FIRST, race_number NULLS FIRST, course NULLS FIRST,
         distance NULLS FIRST, track_type NULLS FIRST, track_condition NULLS FIRST,
         weather NULLS FIRST, grade NULLS FIRST) AS k,
         CAST(count(*) OVER (PARTITION BY race_id) AS INTEGER) AS num_entries
  FROM norm
)"""


@query("race_dim", with_raw(NORM_SQL + RACE_DIM_SQL + """
SELECT race_id, race_date, race_name, race_number, course, distance, track_type, track_condition,
       weather, grade, num_entries FROM rd WHERE k = 1"""))
def q_race_dim(spark, sf):
    return I.race_dim(normalised(spark, sf))


@query("horse_results", with_raw(NORM_SQL + "\n" + """
SELECT horse_id, race_id, race_date, course, distance, track_condition, finish_position,
       round(weight, 6) AS weight, jockey_id, bracket_number, post_position, sex, age,
       round(carried_weight, 6) AS carried_weight, round(win_odds, 6) AS win_odds, win_favorite,
       corner_position_1, corner_position_2, corner_position_3, corner_position_4,
       round(last_3f_time, 6) AS last_3f_time, round(horse_weight_change, 6) AS horse_weight_change,
       round(prize_money, 6) AS prize_money FROM norm"""))
def q_horse_results(spark, sf):
    h = I.horse_results(normalised(spark, sf))
    return h.select(*[r6(c).alias(c) if c in FLOATS else F.col(c) for c in h.columns])


@query("jockey_results", with_raw(NORM_SQL + "\n" + """
SELECT jockey_id, race_id, race_date, course, distance, horse_id, finish_position FROM norm"""))
def q_jockey_results(spark, sf):
    return I.jockey_results(normalised(spark, sf))


def _views(spark, sf):
    n = normalised(spark, sf)
    return I.race_dim(n), I.horse_results(n), I.jockey_results(n)


def quality_sql(rel: str, dataset: str, cols: list[str], required: list[str], mx: float) -> str:
    """Oracle for ``validate``: the same violations from plain SQL."""
    parts = [f"SELECT '{dataset}' AS dataset, '{c}' AS \"column\", 'missing_column' AS error_type, "
             f"CAST(NULL AS DOUBLE) AS value, 'Required column ''{c}'' is missing' AS message"
             for c in required if c not in cols]
    thr = f"{round(mx * 100, 1)}%"
    for c in cols:
        parts.append(
            f"SELECT '{dataset}' AS dataset, '{c}' AS \"column\", 'high_null_rate' AS error_type, "
            f"v AS value, 'Column ''{c}'' has ' || "
            f"CAST(round(v * 100, 1) AS VARCHAR) || '% nulls (threshold: {thr})' AS message FROM "
            f"(SELECT (count(*) - count(\"{c}\")) * 1.0e0 / count(*) AS v, count(*) AS n FROM {rel}) "
            f"WHERE n > 0 AND v > {mx}")
    parts.append(f"SELECT '{dataset}' AS dataset, '*' AS \"column\", 'empty_dataframe' AS error_type, "
                 f"CAST(NULL AS DOUBLE) AS value, 'DataFrame has no rows' AS message "
                 f"WHERE (SELECT count(*) FROM {rel}) = 0")
    return "\nUNION ALL ".join(parts)


TABLE_COLUMNS = {
    "lineitem": "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_extendedprice l_discount l_tax "
                "l_returnflag l_linestatus l_shipdate",
    "orders": "o_orderkey o_custkey o_orderstatus o_totalprice o_orderdate o_orderpriority",
    "customer": "c_custkey c_name c_nationkey c_acctbal c_mktsegment",
    "part": "p_partkey p_name p_brand p_type p_size p_retailprice",
    "supplier": "s_suppkey s_name s_nationkey s_acctbal",
    "nation": "n_nationkey n_name n_regionkey",
    "region": "r_regionkey r_name",
    "events": "event_id ts user_id event_type value props",
    "documents": "doc_id text lang source n_chars",
    "labels": "doc_id quality toxic",
    "embeddings": "vec_id embedding label",
    "pages": "page_id url html",
    "benchmark": "item_id text",
    "conversations": "conv_id turn role text",
}
ENTRY_COLUMNS = ("race_id horse_id jockey_id race_date ln price ship course track_type weather "
                 "track_condition grade distance weight carried_weight win_odds odds win_favorite "
                 "bracket_number post_position corner_position_4 last_3f_time horse_weight_change sex age "
                 "predicted_prob num_entries finish_position bet_amount payout").split()
RACE_DIM_COLUMNS = ["race_id"] + I.RACE_COLUMNS[1:] + ["num_entries"]
HR_COLUMNS = [c for c in I.EXTENDED_HORSE_RESULT_COLUMNS if c in NORM_COLS]
JR_COLUMNS = [c for c in I.JOCKEY_RESULT_COLUMNS if c in NORM_COLS]


@query("import_summary", with_raw(NORM_SQL + RACE_DIM_SQL + """
, races AS (SELECT * FROM rd WHERE k = 1),
qr AS (""" + quality_sql("races", "races", RACE_DIM_COLUMNS, ["race_id"] + I.RACE_COLUMNS[1:], 0.5) + """),
qh AS (""" + quality_sql("norm", "horse_results", HR_COLUMNS, I.HORSE_RESULT_COLUMNS, 0.5) + """),
qj AS (""" + quality_sql("norm", "jockey_results", JR_COLUMNS, I.JOCKEY_RESULT_COLUMNS, 0.5) + """)
SELECT 'races' AS view, CAST((SELECT count(*) FROM races) AS BIGINT) AS rows,
       CAST((SELECT count(*) FROM qr) AS BIGINT) AS violations
UNION ALL SELECT 'horse_results', CAST((SELECT count(*) FROM norm) AS BIGINT), CAST((SELECT count(*) FROM qh) AS BIGINT)
UNION ALL SELECT 'jockey_results', CAST((SELECT count(*) FROM norm) AS BIGINT), CAST((SELECT count(*) FROM qj) AS BIGINT)
"""))
def q_import_summary(spark, sf):
    r, h, j = _views(spark, sf)
    return I.import_summary(r, h, j)


MESSAGES_LIMIT = 0.02


@query("import_messages", with_raw(NORM_SQL + RACE_DIM_SQL + """
, races AS (SELECT * FROM rd WHERE k = 1),
q AS (""" + "\nUNION ALL ".join(
    quality_sql(rel, name, cols, req, MESSAGES_LIMIT) for rel, name, cols, req in (
        ("races", "races", RACE_DIM_COLUMNS, I.RACE_COLUMNS), ("norm", "horse_results", HR_COLUMNS, I.HORSE_RESULT_COLUMNS),
        ("norm", "jockey_results", JR_COLUMNS, I.JOCKEY_RESULT_COLUMNS))) + """)
SELECT dataset AS view, "column", error_type, round(value, 6) AS value, message FROM q"""))
def q_import_messages(spark, sf):
    """What the import found in each view, with a strict limit on null shares."""
    r, h, j = _views(spark, sf)
    return I.import_messages(r, h, j, MESSAGES_LIMIT).withColumn("value", r6("value"))


QUALITY_TABLES = {
    # table: required columns (one absent on purpose in orders)
    "lineitem": ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"],
    "orders": ["o_orderkey", "o_custkey", "o_orderdate", "o_comment"],
    "customer": ["c_custkey", "c_name", "c_nationkey"],
    "part": ["p_partkey", "p_name"],
    "supplier": ["s_suppkey", "s_name"],
    "nation": ["n_nationkey", "n_name"],
    "region": ["r_regionkey", "r_name"],
    "events": ["event_id", "ts", "user_id", "event_type", "value"],
    "documents": ["doc_id", "text"],
    "labels": ["doc_id", "quality", "toxic"],
    "embeddings": ["vec_id", "embedding"],
    "pages": ["page_id", "url", "html"],
    "benchmark": ["item_id", "text"],
    "conversations": ["conv_id", "turn", "role", "text"],
}
ENTRY_REQUIRED = ["race_id", "horse_id", "jockey_id", "horse_name"]


def _quality_checks(spark, sf):
    checks = [validate(counted_table(spark, sf, t), t, req, 0.5) for t, req in QUALITY_TABLES.items()]
    checks.append(validate(entries(spark, sf), "entries", ENTRY_REQUIRED, 0.1))
    checks.append(validate(table(spark, sf, "orders").filter(F.col("o_totalprice") < 0),
                           "refunds", ["o_orderkey"], 0.5))
    checks.append(validate(_sparse(spark, sf), "sparse_orders", ["o_orderkey"], 0.5))
    return report(checks)


def _sparse(spark, sf):
    """Orders with three prices of four missing: over the limit."""
    return table(spark, sf, "orders").withColumn("o_totalprice", F.when(F.col("o_orderkey") % 4 == 0, F.col("o_totalprice")))


def _quality_oracle():
    parts = [quality_sql(t, t, TABLE_COLUMNS[t].split(), req, 0.5) for t, req in QUALITY_TABLES.items()]
    parts.append(quality_sql("entries", "entries", ENTRY_COLUMNS, ENTRY_REQUIRED, 0.1))
    parts.append(quality_sql("refunds", "refunds", TABLE_COLUMNS["orders"].split(), ["o_orderkey"], 0.5))
    parts.append(quality_sql("sparse", "sparse_orders", TABLE_COLUMNS["orders"].split(), ["o_orderkey"], 0.5))
    body = "\nUNION ALL ".join(f"SELECT * FROM ({p})" for p in parts)
    return with_entries(f"""
, refunds AS (SELECT * FROM orders WHERE o_totalprice < 0),
sparse AS (SELECT * REPLACE (CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice END AS o_totalprice) FROM orders),
q AS ({body})
SELECT dataset, "column", error_type, round(value, 6) AS value, message,
       '[' || dataset || '] ' || message AS prefixed FROM q""")


@query("quality_report", _quality_oracle())
def q_quality_report(spark, sf):
    return _quality_checks(spark, sf).select("dataset", "column", "error_type", r6("value").alias("value"),
                                            "message", "prefixed")
