"""Column helpers shared by all layers."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

Day = date | str


def as_col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def day(value: Day) -> Column:
    """A calendar day as a DATE literal."""
    return F.lit(str(value)).cast("date")


def days_back(as_of: Day, days: int) -> Column:
    """First day of the ``days`` days that end on ``as_of``."""
    return F.date_sub(day(as_of), days - 1)


def within_days(column: Column | str, as_of: Day, days: int) -> Column:
    """True on the ``days`` days ending on ``as_of``, both ends included."""
    c = as_col(column)
    return (c >= days_back(as_of, days)) & (c <= day(as_of))


def money(column: Column | str) -> Column:
    return as_col(column).cast("decimal(16,2)")


def ratio(part: Column | str, whole: Column | str, digits: int = 4) -> Column:
    """part / whole rounded, 0.0 where the whole is missing or not positive."""
    p, w = as_col(part).cast("double"), as_col(whole).cast("double")
    return F.when(w > 0, F.round(p / w, digits)).otherwise(F.lit(0.0))


def amount_per(amount: Column | str, count: Column | str) -> Column:
    """Amount per unit to whole cents, halves up, worked in integers so that no half is lost to DOUBLE."""
    cents = (as_col(amount).cast("decimal(28,2)") * 100).cast("decimal(30,0)")
    n = as_col(count).cast("decimal(20,0)")
    halves_up = F.call_function("div", 2 * cents + n, F.when(n > 0, 2 * n))
    return F.when(n > 0, (halves_up * F.lit(0.01).cast("decimal(3,2)")).cast("decimal(20,2)")).otherwise(F.lit(0))


def ratio_or_null(part: Column | str, whole: Column | str, digits: int = 4) -> Column:
    """part / whole rounded, NULL where the whole is missing or 0."""
    return F.round(mean(part, whole), digits)


def ratio_over_one(part: Column | str, whole: Column | str, digits: int = 4) -> Column:
    """part / whole rounded, with a zero whole read as 1."""
    p, w = as_col(part).cast("double"), as_col(whole).cast("double")
    return F.round(p / F.when(w == 0, F.lit(1.0)).otherwise(w), digits)


def mean(total: Column | str, count: Column | str) -> Column:
    """Unrounded total / count as DOUBLE, NULL for an empty count."""
    t, n = as_col(total).cast("double"), as_col(count).cast("double")
    return F.when(n != 0, t / n)


def zero_if_null(column: Column | str) -> Column:
    return F.coalesce(as_col(column), F.lit(0))


def flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also for NULL)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def count_where(condition: Column) -> Column:
    return F.sum(flag(condition))


def sum_where(condition: Column, value: Column | str) -> Column:
    """Conditional sum that yields 0, not NULL, when nothing matches."""
    return F.sum(F.when(condition, as_col(value)).otherwise(F.lit(0)))


def band(column: Column | str, lower_bounds: list[tuple[float, str]], below: str) -> Column:
    """Label of the first bound the value reaches; ``lower_bounds`` runs from high to low."""
    c = as_col(column)
    label = F.lit(below)
    for bound, text in reversed(lower_bounds):
        label = F.when(c >= bound, F.lit(text)).otherwise(label)
    return label


def date_id(column: Column | str) -> Column:
    return F.date_format(as_col(column), "yyyy-MM-dd")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    return F.unix_timestamp(as_col(end)) - F.unix_timestamp(as_col(start))


def event_time(epoch_ms: Column | str) -> Column:
    return F.timestamp_millis(as_col(epoch_ms))


def epoch_ms(column: Column | str) -> Column:
    return F.unix_millis(as_col(column))


def percent_text(share: Column, digits: int = 2) -> Column:
    """0.1234 -> '12.34%'."""
    return F.concat(F.format_string(f"%.{digits}f", F.round(share * 100, digits)), F.lit("%"))


def to_double(column: Column | str) -> Column:
    """Text to DOUBLE, NULL where it is no number."""
    return as_col(column).try_cast("double")


# The texts of the benefit rules, by rule type code.
COUPON_FULL_CUT, COUPON_FULL_DISCOUNT, COUPON_CASH = "3201", "3202", "3203"
ACTIVITY_FULL_CUT, ACTIVITY_FULL_DISCOUNT, ACTIVITY_DISCOUNT = "3101", "3102", "3103"


def _spent_cut(amount: Column, benefit: Column) -> Column:
    return F.concat(F.lit("满"), amount.cast("string"), F.lit("元减"), benefit.cast("string"), F.lit("元"))


def _pieces_discount(pieces: Column, discount: Column) -> Column:
    return F.concat(F.lit("满"), pieces.cast("string"), F.lit("件打"), discount.cast("string"), F.lit(" 折"))


def coupon_benefit(kind: Column, amount: Column, pieces: Column, benefit: Column, discount: Column) -> Column:
    """Readable rule of a coupon; NULL for an unknown type."""
    return (
        F.when(kind == COUPON_FULL_CUT, _spent_cut(amount, benefit))
        .when(kind == COUPON_FULL_DISCOUNT, _pieces_discount(pieces, discount))
        .when(kind == COUPON_CASH, F.concat(F.lit("减"), benefit.cast("string"), F.lit("元")))
    )


def activity_benefit(kind: Column, amount: Column, pieces: Column, benefit: Column, discount: Column) -> Column:
    """Readable rule of a promotion; NULL for an unknown type."""
    return (
        F.when(kind == ACTIVITY_FULL_CUT, _spent_cut(amount, benefit))
        .when(kind == ACTIVITY_FULL_DISCOUNT, _pieces_discount(pieces, discount))
        .when(kind == ACTIVITY_DISCOUNT, F.concat(F.lit("打"), discount.cast("string"), F.lit("折")))
    )


# What counts as a valid mobile number and mail address, on first load and on daily merge.
PHONE_FIRST_LOAD = r"^(13[0-9]|14[01456879]|15[0-35-9]|16[2567]|17[0-8]|18[0-9]|19[0-35-9])\d{8}$"
EMAIL_FIRST_LOAD = r"^[a-zA-Z0-9_-]+@[a-zA-Z0-9_-]+(\.[a-zA-Z0-9_-]+)+$"
PHONE_DAILY = r"^1[3-9][0-9]{9}$"
EMAIL_DAILY = r"^[a-zA-Z0-9_.+-]+@[a-zA-Z0-9-]+\.[a-zA-Z0-9-.]+$"


def masked_name(column: Column | str) -> Column:
    return F.concat(F.substring(as_col(column), 1, 1), F.lit("*"))


def masked_phone(column: Column | str, daily: bool = False) -> Column:
    c = as_col(column)
    head = F.substring(c, 1, 3)
    if daily:
        return F.when(c.rlike(PHONE_DAILY), F.concat(head, F.lit("****"), F.substring(c, 8, 4)))
    return F.when(c.rlike(PHONE_FIRST_LOAD), F.concat(head, F.lit("*")))


def masked_email(column: Column | str, daily: bool = False) -> Column:
    c = as_col(column)
    domain = F.split(c, "@")[1]
    if daily:
        return F.when(c.rlike(EMAIL_DAILY), F.concat(F.lit("***@"), domain))
    return F.when(c.rlike(EMAIL_FIRST_LOAD), F.concat(F.lit("*@"), domain))
