"""Binding of the domain tables onto the driver's TPC-H-like tables.

Domain words map to generic roles: a race is the group being ranked (an
order), a horse and a jockey are entities with a history (part and supplier),
the race date is the order date and the finish position is the rank of an
entry inside its race by price. The same binding is written once in SQL
(``ENTRIES_SQL``) for the DuckDB oracle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paddock.sources.tables import table

# Total order of entries for every per-entity window (date, then a unique tie-break).
HISTORY_ORDER = ["race_date", "race_id", "ln", "horse_id", "jockey_id", "price", "ship"]


def finish_order() -> list[Column]:
    """Order of entries inside a race that defines the finish position."""
    return [F.col("price").desc(), F.col("ln"), F.col("horse_id"), F.col("jockey_id"), F.col("ship")]


def _map(col: Column, pairs: dict) -> Column:
    expr = None
    for k, v in pairs.items():
        expr = (F.when(col == F.lit(k), F.lit(v)) if expr is None
                else expr.when(col == F.lit(k), F.lit(v)))
    return expr


#: What the domain columns of an entry are made of, besides its ids, place, price and dates.
_SOURCE = {"_quantity": "l_quantity", "_discount": "l_discount", "_tax": "l_tax", "_flag": "l_returnflag",
           "_priority": "o_orderpriority", "_status": "o_orderstatus"}


def runners(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per entry of a race: ids, order, finish position, field size and the
    columns of the tables that ``described`` makes the domain columns of."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    od = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderdate", "o_orderpriority", "o_orderstatus")
    e = li.join(od, li.l_orderkey == od.o_orderkey).select(
        F.col("l_orderkey").alias("race_id"),
        F.col("l_partkey").alias("horse_id"),
        F.col("l_suppkey").alias("jockey_id"),
        F.to_date("o_orderdate").alias("race_date"),
        F.col("l_linenumber").alias("ln"),
        F.col("l_extendedprice").alias("price"),
        F.to_date("l_shipdate").alias("ship"),
        *[F.col(c).alias(k) for k, c in _SOURCE.items()],
    )
    race = Window.partitionBy("race_id")                     # a race has a bounded field
    return e.withColumns({"finish_position": F.row_number().over(race.orderBy(*finish_order())).cast("int"),
                          "num_entries": F.count(F.lit(1)).over(race).cast("int")})


def _domain() -> dict[str, Column]:
    """The columns of ``entries`` in their order, from those of ``runners``."""
    quantity, tax = F.col("_quantity"), F.col("_tax")
    same = {c: F.col(c) for c in ("race_id", "horse_id", "jockey_id", "race_date", "ln", "price", "ship")}
    return same | {
        "course": F.col("_priority"),
        "track_type": _map(F.col("_flag"), {"A": "芝", "N": "ダート", "R": "障害"}),
        "weather": _map(F.substring("_priority", 1, 1), {"1": "晴", "2": "曇", "3": "小雨", "4": "雨", "5": "雪"}),
        "track_condition": F.coalesce(_map(F.col("ln"), {1: "良", 2: "稍重", 3: "重", 4: "不良"}), F.lit("不明")),
        "grade": F.when(F.col("_status") == "F", F.lit("F")).otherwise(F.lit("")),
        "distance": (F.lit(1000) + F.col("ln") * 200).cast("int"),
        "weight": quantity,
        "carried_weight": quantity,
        "win_odds": F.lit(1.0) + quantity,
        "odds": F.lit(1.0) + quantity,
        "win_favorite": F.col("ln"),
        "bracket_number": F.col("ln"),
        "post_position": F.col("ln"),
        "corner_position_4": F.col("ln"),
        "last_3f_time": F.when(tax != 0, F.lit(30.0) + F.col("_discount") * 100),
        "horse_weight_change": tax * 100 - 4,
        "sex": _map(F.col("horse_id") % 3, {0: "牡", 1: "牝", 2: "セ"}),
        "age": (F.lit(2) + F.col("horse_id") % 6).cast("int"),
        "predicted_prob": F.lit(1.0) / (F.lit(1.0) + quantity),
        "num_entries": F.col("num_entries"),
        "finish_position": F.col("finish_position"),
        "bet_amount": F.lit(100.0),
        "payout": F.when(F.col("finish_position") == 1, (F.lit(1.0) + quantity) * 100.0).otherwise(F.lit(0.0)),
    }


def entry_columns(*names: str) -> dict[str, Column]:
    """Some domain columns as expressions over ``runners``."""
    return {k: _domain()[k] for k in names}


def described(df: DataFrame, rename: dict[str, str] | None = None) -> DataFrame:
    """Make the domain columns of ``runners``' rows (``rename``: other names for
    some), before the columns that were added to them. They are made of the row
    alone, so a job that shuffles the rows first moves only what they are made of."""
    own = _domain()
    kept = [c for c in df.columns if c not in own and c not in _SOURCE]
    return df.select(*[v.alias((rename or {}).get(k, k)) for k, v in own.items()], *kept)


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per entry of a race, with the domain columns."""
    return described(runners(spark, sf_dir))


# ---------------------------------------------------------------------------
# The same binding in SQL, for the DuckDB oracle.
ENTRIES_SQL = """
entries0 AS (
  SELECT l_orderkey AS race_id, l_partkey AS horse_id, l_suppkey AS jockey_id,
         CAST(o_orderdate AS DATE) AS race_date, l_linenumber AS ln,
         l_extendedprice AS price, CAST(l_shipdate AS DATE) AS ship,
         o_orderpriority AS course,
         CASE l_returnflag WHEN 'A' THEN '芝' WHEN 'N' THEN 'ダート' WHEN 'R' THEN '障害' END AS track_type,
         CASE substr(o_orderpriority, 1, 1) WHEN '1' THEN '晴' WHEN '2' THEN '曇' WHEN '3' THEN '小雨'
              WHEN '4' THEN '雨' WHEN '5' THEN '雪' END AS weather,
         COALESCE(CASE l_linenumber WHEN 1 THEN '良' WHEN 2 THEN '稍重' WHEN 3 THEN '重'
              WHEN 4 THEN '不良' END, '不明') AS track_condition,
         CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE '' END AS grade,
         CAST(1000 + l_linenumber * 200 AS INTEGER) AS distance,
         l_quantity AS weight, l_quantity AS carried_weight,
         1.0e0 + l_quantity AS win_odds, 1.0e0 + l_quantity AS odds,
         l_linenumber AS win_favorite, l_linenumber AS bracket_number,
         l_linenumber AS post_position, l_linenumber AS corner_position_4,
         CASE WHEN l_tax <> 0 THEN 30.0e0 + l_discount * 100 END AS last_3f_time,
         l_tax * 100 - 4 AS horse_weight_change,
         CASE l_partkey % 3 WHEN 0 THEN '牡' WHEN 1 THEN '牝' WHEN 2 THEN 'セ' END AS sex,
         CAST(2 + l_partkey % 6 AS INTEGER) AS age,
         1.0e0 / (1.0e0 + l_quantity) AS predicted_prob,
         CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC,
              l_linenumber, l_partkey, l_suppkey, l_shipdate) AS INTEGER) AS finish_position,
         CAST(count(*) OVER (PARTITION BY l_orderkey) AS INTEGER) AS num_entries,
         100.0e0 AS bet_amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
),
entries AS (
  SELECT *, CASE WHEN finish_position = 1 THEN odds * 100.0e0 ELSE 0.0e0 END AS payout FROM entries0
)"""

HISTORY_ORDER_SQL = "race_date, race_id, ln, horse_id, jockey_id, price, ship"


def with_entries(sql: str) -> str:
    """Prefix a query that reads ``entries`` with the entries CTEs.

    A ``sql`` starting with a comma continues the CTE list.
    """
    body = sql.strip()
    sep = "" if body.startswith(",") else "\n"
    return "WITH " + ENTRIES_SQL.strip() + sep + body


# ---------------------------------------------------------------------------
# Raw result rows as a results CSV carries them: Japanese headers, every field
# a string, with the irregular values the normaliser has to handle (status
# words, '1.0', two-digit ages, two-part corner strings, weights without a
# change, bad dates). Derived from the entries so the work grows with the data.
RAW_SQL = """
raw AS (
  SELECT
    CAST(race_id AS VARCHAR) AS "レースID",
    CASE WHEN last_3f_time IS NULL THEN '取消'
         WHEN ln = 7 THEN CAST(finish_position AS VARCHAR) || '.0'
         ELSE CAST(finish_position AS VARCHAR) END AS "着順",
    CAST(bracket_number AS VARCHAR) AS "枠番",
    CAST(post_position AS VARCHAR) AS "馬番",
    CASE WHEN horse_id % 97 = 0 THEN '' ELSE 'ホース' || CAST(horse_id AS VARCHAR) END AS "馬名",
    CASE WHEN jockey_id % 13 = 0 THEN sex
         ELSE sex || CAST(2 + horse_id % 11 AS VARCHAR) END AS "性齢",
    CAST(carried_weight AS VARCHAR) AS "斤量",
    'ジョッキー' || CAST(jockey_id AS VARCHAR) AS "騎手",
    CASE WHEN ln % 2 = 0 THEN CAST(ln AS VARCHAR) || '-' || CAST(finish_position AS VARCHAR)
         WHEN ln = 5 THEN 'x-' || CAST(ln AS VARCHAR) || '-3-2'
         ELSE CAST(ln AS VARCHAR) || '-' || CAST(ln + 1 AS VARCHAR) || '- ' || CAST(finish_position AS VARCHAR) || '-1-9' END AS "通過",
    CAST(last_3f_time AS VARCHAR) AS "上り",
    CAST(win_odds AS VARCHAR) AS "単勝",
    CAST(win_favorite AS VARCHAR) AS "人気",
    CASE WHEN ln = 6 THEN CAST(CAST(400 + weight * 2 AS INTEGER) AS VARCHAR)
         WHEN ln = 5 THEN CAST(CAST(400 + weight * 2 AS INTEGER) AS VARCHAR) || '(x)'
         WHEN ln = 3 THEN 'abc(+2)'
         ELSE CAST(CAST(400 + weight * 2 AS INTEGER) AS VARCHAR) || '('
              || CASE WHEN horse_weight_change >= 0 THEN '+' ELSE '' END
              || CAST(CAST(round(horse_weight_change) AS INTEGER) AS VARCHAR) || ')' END AS "馬体重",
    CAST(price AS VARCHAR) AS "賞金",
    course AS "競馬場名",
    CAST(distance AS VARCHAR) AS "距離",
    weather AS "天候",
    track_condition AS "馬場状態",
    track_type AS "芝・ダート",
    'R' || CAST(race_id AS VARCHAR) AS "レース名",
    CAST(race_id % 12 + 1 AS VARCHAR) AS "レース番号",
    grade AS "リステッド・重賞",
    CASE WHEN race_id % 101 = 0 THEN '2001-13-01' ELSE strftime(race_date, '%Y-%m-%d') END AS "日付"
  FROM entries
)"""


def _s(c) -> Column:
    return c.cast("string")


def raw_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw results frame (all strings, Japanese headers); see ``RAW_SQL``."""
    e = entries(spark, sf_dir)
    c = F.col
    w400 = _s((F.lit(400) + c("weight") * 2).cast("int"))
    return e.select(
        _s(c("race_id")).alias("レースID"),
        F.when(c("last_3f_time").isNull(), F.lit("取消"))
         .when(c("ln") == 7, F.concat(_s(c("finish_position")), F.lit(".0")))
         .otherwise(_s(c("finish_position"))).alias("着順"),
        _s(c("bracket_number")).alias("枠番"),
        _s(c("post_position")).alias("馬番"),
        F.when(c("horse_id") % 97 == 0, F.lit(""))
         .otherwise(F.concat(F.lit("ホース"), _s(c("horse_id")))).alias("馬名"),
        F.when(c("jockey_id") % 13 == 0, c("sex"))
         .otherwise(F.concat(c("sex"), _s(F.lit(2) + c("horse_id") % 11))).alias("性齢"),
        _s(c("carried_weight")).alias("斤量"),
        F.concat(F.lit("ジョッキー"), _s(c("jockey_id"))).alias("騎手"),
        F.when(c("ln") % 2 == 0, F.concat_ws("-", _s(c("ln")), _s(c("finish_position"))))
         .when(c("ln") == 5, F.concat(F.lit("x-"), _s(c("ln")), F.lit("-3-2")))
         .otherwise(F.concat(_s(c("ln")), F.lit("-"), _s(c("ln") + 1), F.lit("- "),
                             _s(c("finish_position")), F.lit("-1-9"))).alias("通過"),
        _s(c("last_3f_time")).alias("上り"),
        _s(c("win_odds")).alias("単勝"),
        _s(c("win_favorite")).alias("人気"),
        F.when(c("ln") == 6, w400)
         .when(c("ln") == 5, F.concat(w400, F.lit("(x)")))
         .when(c("ln") == 3, F.lit("abc(+2)"))
         .otherwise(F.concat(w400, F.lit("("),
                             F.when(c("horse_weight_change") >= 0, F.lit("+")).otherwise(F.lit("")),
                             _s(F.round(c("horse_weight_change")).cast("int")), F.lit(")"))).alias("馬体重"),
        _s(c("price")).alias("賞金"),
        c("course").alias("競馬場名"),
        _s(c("distance")).alias("距離"),
        c("weather").alias("天候"),
        c("track_condition").alias("馬場状態"),
        c("track_type").alias("芝・ダート"),
        F.concat(F.lit("R"), _s(c("race_id"))).alias("レース名"),
        _s(c("race_id") % 12 + 1).alias("レース番号"),
        c("grade").alias("リステッド・重賞"),
        F.when(c("race_id") % 101 == 0, F.lit("2001-13-01"))
         .otherwise(F.date_format("race_date", "yyyy-MM-dd")).alias("日付"),
    )


def with_raw(sql: str) -> str:
    """Prefix a query that reads ``raw`` with the entries and raw CTEs."""
    body = sql.strip()
    sep = "" if body.startswith(",") else "\n"
    return "WITH " + ENTRIES_SQL.strip() + ",\n" + RAW_SQL.strip() + sep + body
