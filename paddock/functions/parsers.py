"""Column expressions that normalise raw result fields.

All are native Spark expressions (no Python UDF). Spark runs with ANSI mode,
so every lenient conversion uses ``try_cast`` / ``try_to_date``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Status words that mean "did not finish" (scratched, excluded,
# stopped, disqualified), Japanese and English.
NON_FINISH = ["取消", "除外", "中止", "失格", "Cancel", "Exclude", "Stop", "DQ"]


def _c(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_finish(c: str | Column) -> Column:
    """B1: digits only -> int, anything else (status words, '1.0', '') -> null."""
    s = _c(c).cast("string")
    return F.when(s.isin(NON_FINISH), F.lit(None).cast("int")).when(
        s.rlike("^[0-9]+$"), s.try_cast("int"))


def hash_id(c: str | Column) -> Column:
    """B2: first 12 hex chars of SHA-256 of the UTF-8 name; null / '' -> null."""
    s = _c(c).cast("string")
    return F.when(s.isNotNull() & (s != ""), F.substring(F.sha2(s, 256), 1, 12))


def parse_sex_age(c: str | Column) -> tuple[Column, Column]:
    """B3: '牡3' -> ('牡', 3).

    Non-digit prefix + digits splits there ('牡12' -> ('牡', 12); the reference
    only reads the last digit and gives ('牡1', 2)). Otherwise a trailing
    digit is the age; no trailing digit -> (whole, null); fewer than 2
    characters -> (null, null).
    """
    s = _c(c).cast("string")
    short = s.isNull() | (F.length(s) < 2)
    split = s.rlike(r"^\D+\d+$")
    last_digit = s.rlike(r"\d$")
    sex = (F.when(short, F.lit(None).cast("string"))
            .when(split, F.regexp_extract(s, r"^(\D+)(\d+)$", 1))
            .when(last_digit, F.substring(s, F.lit(1), F.length(s) - 1))
            .otherwise(s))
    age = (F.when(short, F.lit(None).cast("int"))
            .when(split, F.regexp_extract(s, r"^(\D+)(\d+)$", 2).try_cast("int"))
            .when(last_digit, F.substring(s, F.length(s), F.lit(1)).try_cast("int")))
    return sex, age


def parse_corners(c: str | Column) -> list[Column]:
    """B4: '3-3-2-1' -> four ints; missing or bad parts -> null."""
    s = _c(c).cast("string")
    return [F.trim(F.split_part(s, F.lit("-"), F.lit(i))).try_cast("int") for i in range(1, 5)]


def parse_weight(c: str | Column) -> tuple[Column, Column]:
    """B5: '480(+4)' -> (480.0, 4.0); bad base -> (null, null); bad change ->
    (base, null); no parenthesis -> (value, null)."""
    s = F.trim(_c(c).cast("string"))
    has_paren = F.instr(s, "(") > 0
    base = F.when(has_paren, F.substring_index(s, "(", 1)).otherwise(s).try_cast("double")
    rest = F.substring(s, F.instr(s, "(") + 1, F.lit(1 << 30))
    change = F.when(has_paren & base.isNotNull(),
                    F.regexp_replace(rest, r"\)+$", "").try_cast("double"))
    return base, change


def parse_date(c: str | Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Date string -> date; bad -> null."""
    return F.try_to_date(_c(c).cast("string"), fmt)


# The typed columns of the results file.
INT_COLS = ["race_number", "distance", "win_favorite", "bracket_number", "post_position"]
FLOAT_COLS = ["carried_weight", "win_odds", "last_3f_time", "prize_money"]


def safe_int(c: str | Column) -> Column:
    """Lenient int (strings like '12' -> 12, '1.5' / 'x' -> null)."""
    return _c(c).cast("string").try_cast("int")


def safe_double(c: str | Column) -> Column:
    return _c(c).cast("string").try_cast("double")
