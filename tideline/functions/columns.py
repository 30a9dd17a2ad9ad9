"""Column-expression helpers.  All are built-in Spark expressions (JVM side,
whole-stage codegen); none calls back into Python."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's output labels.
#   age groups: "20 and under", "21-30", "over 30"
#   gender:     male, female
AGE_GROUP_LABELS = ("20岁及以下", "21-30岁", "30岁以上")
MALE_LABEL = "男"
FEMALE_LABEL = "女"
# ---------------------------------------------------------------------------


def c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def epoch_millis(ts) -> Column:
    """Epoch milliseconds (truncated) of a timestamp / timestamp_ntz column.

    timestamp_ntz is read as UTC wall clock (the session zone is pinned to UTC).
    """
    return F.unix_millis(c(ts).cast("timestamp"))


def millis_format(ts_ms, fmt: str) -> Column:
    return F.date_format(F.timestamp_millis(c(ts_ms)), fmt)


def split_part(s, sep: str, i: int) -> Column:
    """i-th piece of ``s`` split on a literal separator; null (never an error)
    when the piece does not exist."""
    return F.get(F.split(c(s), _regex_literal(sep)), i)


def _regex_literal(sep: str) -> str:
    return "".join("\\" + ch if ch in r"\^$.|?*+()[]{}" else ch for ch in sep)


def date_of_datetime(s) -> Column:
    """``yyyy-MM-dd`` part of a ``yyyy-MM-dd HH:mm:ss`` string (split on space)."""
    return split_part(s, " ", 0)


def hour_of_datetime(s) -> Column:
    """``HH`` part of a ``yyyy-MM-dd HH:mm:ss`` string (split on space, then ':')."""
    return split_part(split_part(s, " ", 1), ":", 0)


def age_years(birthday, as_of=None) -> Column:
    """Completed years between ``birthday`` and ``as_of`` (a date, a column, or None
    for the day the query runs); null when the birthday
    is null or not a date.  Year difference, less one before the birthday in
    the as-of year (no months_between: its month-end rule differs elsewhere)."""
    b = F.try_to_date(c(birthday).cast("string"))
    a = F.current_date() if as_of is None else F.to_date(c(as_of) if isinstance(as_of, Column) else F.lit(as_of))
    before = (F.month(a) * 100 + F.dayofmonth(a)) < (F.month(b) * 100 + F.dayofmonth(b))
    return F.year(a) - F.year(b) - F.when(before, 1).otherwise(0)


def age_group(age, labels=AGE_GROUP_LABELS) -> Column:
    """<=20, 21-30, >30; null age stays null."""
    a = c(age)
    return (F.when(a <= 20, labels[0]).when(a <= 30, labels[1])
            .when(a > 30, labels[2]))


def gender_label(gender, rule: str = "standard") -> Column:
    """Gender code to label.

    ``standard``: F -> female, M -> male, anything else (null included) -> null.
    ``swapped``: the reference rule: F -> the male label, everything else ->
    the female label (applied only to users found in the dimension).
    """
    g = c(gender)
    if rule == "swapped":
        return F.when(g == "F", MALE_LABEL).otherwise(FEMALE_LABEL)
    if rule != "standard":
        raise ValueError(f"unknown gender rule {rule!r}")
    return F.when(g == "F", FEMALE_LABEL).when(g == "M", MALE_LABEL)


def topic_for_table(table) -> Column:
    """Routing rule: ``ODS_T_`` + upper-cased table name."""
    return F.concat(F.lit("ODS_T_"), F.upper(c(table)))
