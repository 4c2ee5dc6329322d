"""Calendar features: date parts and holiday flags as column expressions.

Holidays are computed per row from the row's own year (fixed dates, n-th
weekday rules, and Easter by the anonymous Gregorian computus), so flagging
needs no calendar table and no join.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Feast days used as holiday features, with their rule.
#   AllSouls Nov 2; AshWednesday Easter-46; ChristmasEve Dec 24; Easter;
#   ChristmasDay Dec 25; GoodFriday Easter-2; NewYearsDay Jan 1; PalmSunday Easter-7
FEASTS = ["AllSouls", "AshWednesday", "ChristmasEve", "Easter", "ChristmasDay", "GoodFriday",
          "NewYearsDay", "PalmSunday"]
# US federal holidays and their rule.
#   USNewYearsDay Jan 1; USMLKingsBirthday 3rd Monday of Jan; USWashingtonsBirthday 3rd Monday of Feb;
#   USMemorialDay last Monday of May; USIndependenceDay Jul 4; USLaborDay 1st Monday of Sep;
#   USColumbusDay 2nd Monday of Oct; USVeteransDay Nov 11; USThanksgivingDay 4th Thursday of Nov;
#   USChristmasDay Dec 25
US_HOLIDAYS = ["USNewYearsDay", "USMLKingsBirthday", "USWashingtonsBirthday", "USMemorialDay",
               "USIndependenceDay", "USLaborDay", "USColumbusDay", "USVeteransDay", "USThanksgivingDay",
               "USChristmasDay"]


def _fdiv(a, b):
    return F.floor(a / b).cast("int")


def easter(year: Column) -> Column:
    """Gregorian Easter Sunday of ``year`` (anonymous computus)."""
    y = year.cast("int")
    a = F.pmod(y, F.lit(19))
    b = _fdiv(y, 100)
    c = F.pmod(y, F.lit(100))
    d = _fdiv(b, 4)
    e = F.pmod(b, F.lit(4))
    f = _fdiv(b + 8, 25)
    g = _fdiv(b - f + 1, 3)
    h = F.pmod(a * 19 + b - d - g + 15, F.lit(30))
    i = _fdiv(c, 4)
    k = F.pmod(c, F.lit(4))
    l_ = F.pmod(e * 2 + i * 2 - h - k + 32, F.lit(7))
    m = _fdiv(a + h * 11 + l_ * 22, 451)
    s = h + l_ - m * 7 + 114
    return F.make_date(y, _fdiv(s, 31), F.pmod(s, F.lit(31)) + 1)


def easter_sql(y: str) -> str:
    """DuckDB twin of :func:`easter` (all operands are non-negative)."""
    a, b, c = f"({y} % 19)", f"({y} // 100)", f"({y} % 100)"
    d, e, f = f"({b} // 4)", f"({b} % 4)", f"(({b} + 8) // 25)"
    g = f"(({b} - {f} + 1) // 3)"
    h = f"((19 * {a} + {b} - {d} - {g} + 15) % 30)"
    i, k = f"({c} // 4)", f"({c} % 4)"
    l_ = f"((32 + 2 * {e} + 2 * {i} - {h} - {k}) % 7)"
    m = f"(({a} + 11 * {h} + 22 * {l_}) // 451)"
    s = f"({h} + {l_} - 7 * {m} + 114)"
    return f"make_date(CAST({y} AS BIGINT), CAST({s} // 31 AS BIGINT), CAST({s} % 31 + 1 AS BIGINT))"


def nth_weekday(year: Column, month: int, weekday: int, n: int) -> Column:
    """The ``n``-th ``weekday`` (1 = Sunday .. 7 = Saturday) of a month; ``n = -1`` for the last."""
    if n > 0:
        first = F.make_date(year, F.lit(month), F.lit(1))
        shift = F.pmod(F.lit(weekday) - F.dayofweek(first), F.lit(7))
        return F.date_add(first, (shift + (n - 1) * 7).cast("int"))
    last = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    back = F.pmod(F.dayofweek(last) - F.lit(weekday), F.lit(7))
    return F.date_sub(last, back.cast("int"))


def holiday_date(name: str, year: Column, easter_col: Column | None = None) -> Column:
    md = lambda m, d: F.make_date(year, F.lit(m), F.lit(d))
    ea = (lambda _y: easter_col) if easter_col is not None else easter
    rules = {
        "AllSouls": lambda: md(11, 2),
        "AshWednesday": lambda: F.date_sub(ea(year), 46),
        "ChristmasEve": lambda: md(12, 24),
        "Easter": lambda: ea(year),
        "ChristmasDay": lambda: md(12, 25),
        "GoodFriday": lambda: F.date_sub(ea(year), 2),
        "NewYearsDay": lambda: md(1, 1),
        "PalmSunday": lambda: F.date_sub(ea(year), 7),
        "USNewYearsDay": lambda: md(1, 1),
        "USMLKingsBirthday": lambda: nth_weekday(year, 1, 2, 3),
        "USWashingtonsBirthday": lambda: nth_weekday(year, 2, 2, 3),
        "USMemorialDay": lambda: nth_weekday(year, 5, 2, -1),
        "USIndependenceDay": lambda: md(7, 4),
        "USLaborDay": lambda: nth_weekday(year, 9, 2, 1),
        "USColumbusDay": lambda: nth_weekday(year, 10, 2, 2),
        "USVeteransDay": lambda: md(11, 11),
        "USThanksgivingDay": lambda: nth_weekday(year, 11, 5, 4),
        "USChristmasDay": lambda: md(12, 25),
    }
    return rules[name]()


def holiday_flags(date_col: str, names=FEASTS, prefix: str | None = None, easter_col: str | None = None) -> list[Column]:
    """``step_holiday``: one 0/1 column per holiday, named ``<date>_<holiday>``.

    With ``easter_col`` the Easter date of the row's year is read from that
    column instead of being recomputed for every Easter-based holiday.
    """
    d = F.col(date_col)
    y = F.year(d)
    prefix = prefix if prefix is not None else f"{date_col}_"
    e = F.col(easter_col) if easter_col else None
    return [(d == holiday_date(n, y, e)).cast("int").alias(f"{prefix}{n}") for n in names]


def with_holiday_flags(df, date_col: str, names=FEASTS):
    """Add holiday flags, computing Easter once per row."""
    out = df.withColumn("_easter", easter(F.year(F.col(date_col))))
    return out.select("*", *holiday_flags(date_col, names, easter_col="_easter")).drop("_easter")


# English day and month abbreviations (Sunday first, as dayofweek counts).
DOW_ABB = ["Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat"]
MONTH_ABB = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


def date_parts(date_col: str, features=("dow", "month", "year")) -> list[Column]:
    """``step_date``: day of week and month as abbreviated names, year as a number.

    Names are looked up from the integer parts (no per-row date formatting).
    """
    d = F.col(date_col)
    out = []
    for f in features:
        if f == "dow":
            out.append(F.element_at(F.array(*[F.lit(x) for x in DOW_ABB]), F.dayofweek(d)).alias(f"{date_col}_dow"))
        elif f == "month":
            out.append(F.element_at(F.array(*[F.lit(x) for x in MONTH_ABB]), F.month(d)).alias(f"{date_col}_month"))
        elif f == "year":
            out.append(F.year(d).cast("bigint").alias(f"{date_col}_year"))
        elif f == "doy":
            out.append(F.dayofyear(d).cast("bigint").alias(f"{date_col}_doy"))
    return out
