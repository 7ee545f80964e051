"""Results CSV source: header mapping, normalisation and date-range scan (A1-A3).

The CSV is read without schema inference (every column a string) and the
normalisation is one ``select`` of native expressions; nothing runs per row in
Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paddock.functions import parsers as P

# Results-CSV header names and the internal column each maps to.
COLUMN_MAP_JA: dict[str, str] = {
    "レースID": "race_id",
    "着順": "finish_position",
    "枠番": "bracket_number",
    "馬番": "post_position",
    "馬名": "horse_name",
    "性齢": "sex_age",
    "性別": "sex",
    "馬齢": "age",
    "斤量": "carried_weight",
    "騎手": "jockey_name",
    "タイム": "time",
    "着差": "margin",
    "通過": "corner_positions",
    "1コーナー": "corner_position_1",
    "2コーナー": "corner_position_2",
    "3コーナー": "corner_position_3",
    "4コーナー": "corner_position_4",
    "上り": "last_3f_time",
    "単勝": "win_odds",
    "人気": "win_favorite",
    "馬体重": "horse_weight",
    "場体重増減": "horse_weight_change",
    "調教師": "trainer",
    "馬主": "owner",
    "賞金": "prize_money",
    "賞金(万円)": "prize_money",
    "競馬場名": "course",
    "距離": "distance",
    "距離(m)": "distance",
    "天候": "weather",
    "馬場状態": "track_condition",
    "馬場状態1": "track_condition",
    "芝・ダート": "track_type",
    "芝・ダート区分": "track_type",
    "レース名": "race_name",
    "レース番号": "race_number",
    "リステッド・重賞": "grade",
    "リステッド・重賞競走": "grade",
    "日付": "race_date",
    "レース日付": "race_date",
}

COLUMN_MAP_EN: dict[str, str] = {
    "Race ID": "race_id",
    "FP": "finish_position",
    "Bracket": "bracket_number",
    "PP": "post_position",
    "Horse Name": "horse_name",
    "Sex and Age": "sex_age",
    "Weight(Kg)": "carried_weight",
    "Jockey": "jockey_name",
    "Total Time": "time",
    "Margin": "margin",
    "Position": "corner_positions",
    "Last 3F": "last_3f_time",
    "Win Odds": "win_odds",
    "Fav": "win_favorite",
    "Horse Weight": "horse_weight",
    "Trainer": "trainer",
    "Owner": "owner",
    "Prize Money": "prize_money",
    "Racecourse": "course",
    "Distance": "distance",
    "Weather": "weather",
    "Track Condition": "track_condition",
    "Turf/Dirt": "track_type",
    "Race Name": "race_name",
    "Race Number": "race_number",
    "Grade": "grade",
    "Date": "race_date",
}


def choose_map(columns: list[str]) -> dict[str, str]:
    """The header map with more matching names (ties go to Japanese)."""
    cols = set(columns)
    ja = sum(1 for k in COLUMN_MAP_JA if k in cols)
    en = sum(1 for k in COLUMN_MAP_EN if k in cols)
    return COLUMN_MAP_JA if ja >= en else COLUMN_MAP_EN


def map_columns(df: DataFrame) -> DataFrame:
    """A2: rename headers to internal names (plan-time, no job).

    Several headers can map to one name (two prize or distance headers); when
    both exist their values are coalesced in header order. Unknown columns
    keep their names.
    """
    m = choose_map(df.columns)
    targets: dict[str, list[str]] = {}
    for src in df.columns:
        if src in m:
            targets.setdefault(m[src], []).append(src)
    out: list[Column] = []
    seen: set[str] = set()
    for src in df.columns:
        if src in m:
            dst = m[src]
            if dst in seen:
                continue
            seen.add(dst)
            srcs = [F.col(f"`{s}`") for s in targets[dst]]
            out.append((srcs[0] if len(srcs) == 1 else F.coalesce(*srcs)).alias(dst))
        elif src not in seen:
            out.append(F.col(f"`{src}`"))
    return df.select(*out)


def normalise(df: DataFrame) -> DataFrame:
    """B1-B7 by column presence, in one projection."""
    cols = df.columns
    have = set(cols)
    exprs: dict[str, Column] = {}
    drop: set[str] = set()
    if "finish_position" in have:
        exprs["finish_position"] = P.parse_finish("finish_position")
    if "horse_name" in have:
        exprs["horse_id"] = P.hash_id("horse_name")
    if "jockey_name" in have:
        exprs["jockey_id"] = P.hash_id("jockey_name")
    if "sex_age" in have:
        sex, age = P.parse_sex_age("sex_age")
        exprs["sex"], exprs["age"] = sex, age
        drop.add("sex_age")
    elif "age" in have:
        exprs["age"] = P.safe_int("age")
    if "corner_positions" in have:
        for i, c in enumerate(P.parse_corners("corner_positions"), start=1):
            exprs[f"corner_position_{i}"] = c
        drop.add("corner_positions")
    else:
        for i in range(1, 5):
            if f"corner_position_{i}" in have:
                exprs[f"corner_position_{i}"] = P.safe_int(f"corner_position_{i}")
    if "horse_weight" in have:
        base, change = P.parse_weight("horse_weight")
        exprs["weight"] = base
        if "horse_weight_change" not in have:
            exprs["horse_weight_change"] = change
        drop.add("horse_weight")
    if "horse_weight_change" in have:
        exprs["horse_weight_change"] = P.safe_double("horse_weight_change")
    if "race_date" in have:
        exprs["race_date"] = P.parse_date("race_date")
    for c in P.INT_COLS:
        if c in have:
            exprs[c] = P.safe_int(c)
    for c in P.FLOAT_COLS:
        if c in have:
            exprs[c] = P.safe_double(c)
    if "race_id" in have:
        exprs["race_id"] = F.col("race_id").cast("string")
    keep = [F.col(f"`{c}`") for c in cols if c not in drop and c not in exprs]
    return df.select(*keep, *[e.alias(k) for k, e in exprs.items()])


def read_csv(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """A1: header CSV, all columns as strings.

    Without an explicit encoding, UTF-8 is tried first. Spark does not fail on
    bad UTF-8 (it yields replacement characters), so the fallback to Shift_JIS
    is decided by whether the decoded header contains known column names.
    """
    def _read(enc: str) -> DataFrame:
        return spark.read.option("header", True).option("encoding", enc).csv(path)

    if encoding:
        return _read(encoding)
    df = _read("UTF-8")
    known = set(COLUMN_MAP_JA) | set(COLUMN_MAP_EN)
    if any(c in known for c in df.columns):
        return df
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    return _read("Shift_JIS")


def filter_dates(df: DataFrame, date_from=None, date_to=None, col: str = "race_date") -> DataFrame:
    """A3: inclusive date range, either end optional (rows with null dates drop
    out as soon as one bound is set). On partitioned parquet this prunes
    partitions; on plain parquet it is a pushed-down filter."""
    c = F.col(col)
    if date_from is not None:
        df = df.filter(c >= F.lit(date_from).cast("date"))
    if date_to is not None:
        df = df.filter(c <= F.lit(date_to).cast("date"))
    return df


def load_race_results(spark: SparkSession, path: str, date_from=None, date_to=None,
                      encoding: str | None = None) -> DataFrame:
    """A1 + A2 + B + A3: read, map headers, normalise, filter dates."""
    return filter_dates(normalise(map_columns(read_csv(spark, path, encoding))), date_from, date_to)
