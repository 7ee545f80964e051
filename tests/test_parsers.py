"""Hand-computed normalisation cases."""

import hashlib

from pyspark.sql import functions as F

from paddock.functions import parsers as P
from paddock.sources.results_csv import choose_map, map_columns, normalise


def _one(spark, values, fn, schema="s string"):
    df = spark.createDataFrame([(v,) for v in values], schema)
    return [tuple(r) for r in df.select(*fn(F.col("s"))).collect()]


def test_finish_position(spark):
    got = _one(spark, ["1", "12", "取消", "除外", "1.0", "", None, "DQ"], lambda c: [P.parse_finish(c)])
    assert [g[0] for g in got] == [1, 12, None, None, None, None, None, None]


def test_sex_age(spark):
    got = _one(spark, ["牡3", None, "", "牝", "セ5", "牡12", "ab"], lambda c: list(P.parse_sex_age(c)))
    assert got == [("牡", 3), (None, None), (None, None), (None, None), ("セ", 5), ("牡", 12), ("ab", None)]


def test_corners(spark):
    got = _one(spark, ["3-3-2-1", "1-1", "x-2", None, "1- 2-3-4-5"], P.parse_corners)
    assert got == [(3, 3, 2, 1), (1, 1, None, None), (None, 2, None, None), (None,) * 4, (1, 2, 3, 4)]


def test_weight(spark):
    got = _one(spark, ["460(-2)", "480", "480(+4)", "abc(+2)", "470(x)", None], lambda c: list(P.parse_weight(c)))
    assert got == [(460.0, -2.0), (480.0, None), (480.0, 4.0), (None, None), (470.0, None), (None, None)]


def test_date(spark):
    got = _one(spark, ["2020-01-05", "2001-13-01", "x"], lambda c: [P.parse_date(c)])
    assert str(got[0][0]) == "2020-01-05" and got[1][0] is None and got[2][0] is None


def test_hash_matches_hashlib(spark):
    names = ["ディープインパクト", "abc", "", None]
    got = [g[0] for g in _one(spark, names, lambda c: [P.hash_id(c)])]
    assert got[0] == hashlib.sha256(names[0].encode()).hexdigest()[:12]
    assert got[1] == hashlib.sha256(b"abc").hexdigest()[:12]
    assert got[2] is None and got[3] is None


def test_header_mapping_and_collision(spark):
    df = spark.createDataFrame([("1", "100", None, "2020-01-01")],
                               "`レースID` string, `賞金` string, `賞金(万円)` string, `日付` string")
    m = map_columns(df)
    assert set(m.columns) == {"race_id", "prize_money", "race_date"}
    n = normalise(m).collect()[0]
    assert n["prize_money"] == 100.0 and str(n["race_date"]) == "2020-01-01"
    assert choose_map(["Race ID", "FP", "Date"])["FP"] == "finish_position"


def test_csv_shift_jis_fallback(spark, tmp_path):
    """A Shift_JIS file is detected by its header and decoded."""
    from paddock.sources.results_csv import load_race_results
    p = tmp_path / "results.csv"
    p.write_bytes("レースID,着順,性齢,日付\n1,1,牡3,2020-01-05\n1,取消,牝4,2020-01-05\n".encode("shift_jis"))
    df = load_race_results(spark, str(p))
    rows = sorted((tuple(r) for r in df.select("race_id", "finish_position", "sex", "age").collect()), key=str)
    assert rows == sorted([("1", 1, "牡", 3), ("1", None, "牝", 4)], key=str)
