"""Date helpers and the rule-generated US federal holiday dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# US federal holidays (name, month, rule, n, weekday 0=Mon, first year).
# rule "fixed": day n of the month, with an observed day (Saturday -> Friday,
# Sunday -> Monday) added as a second entry; "nth": the n-th given weekday of the
# month; "last": the last given weekday of the month.
US_FEDERAL_HOLIDAYS = [
    ("New Year's Day", 1, "fixed", 1, None, 1871),
    ("Martin Luther King Jr. Day", 1, "nth", 3, 0, 1986),
    ("Washington's Birthday", 2, "nth", 3, 0, 1971),
    ("Memorial Day", 5, "last", None, 0, 1971),
    ("Juneteenth National Independence Day", 6, "fixed", 19, None, 2021),
    ("Independence Day", 7, "fixed", 4, None, 1871),
    ("Labor Day", 9, "nth", 1, 0, 1894),
    ("Columbus Day", 10, "nth", 2, 0, 1971),
    ("Veterans Day", 11, "fixed", 11, None, 1954),
    ("Thanksgiving", 11, "nth", 4, 3, 1871),
    ("Christmas Day", 12, "fixed", 25, None, 1871),
]


def day_of_week(d: Column) -> Column:
    """0 = Monday ... 6 = Sunday (pandas ``dayofweek``)."""
    return F.weekday(d)


def iso_week(d: Column) -> Column:
    return F.weekofyear(d)


def iso_year(d: Column) -> Column:
    return F.extract(F.lit("YEAROFWEEK"), d)


def holiday_dimension(dates: DataFrame, date_col: str = "date") -> DataFrame:
    """Holiday dates covering the years spanned by ``dates``.

    One global min/max aggregate gives the year range; every year row is then
    expanded by a single ``explode`` over all rules. The size is bounded by
    2 x 11 entries per year, so the result is safe to broadcast.
    """
    years = (dates.agg(F.min(F.year(date_col)).alias("y0"), F.max(F.year(date_col)).alias("y1"))
             .where(F.col("y0").isNotNull())
             .select(F.explode(F.sequence(F.col("y0") - 1, F.col("y1") + 1)).alias("year")))
    year = F.col("year")
    entries = []
    for name, month, rule, n, wd, first_year in US_FEDERAL_HOLIDAYS:
        first = F.make_date(year, F.lit(month), F.lit(1))
        active = year >= first_year
        if rule == "fixed":
            actual = F.make_date(year, F.lit(month), F.lit(n))
            dow = F.weekday(actual)
            observed = (F.when(dow == 5, F.date_sub(actual, 1))
                        .when(dow == 6, F.date_add(actual, 1)))
            entries.append((F.when(active, actual), name))
            entries.append((F.when(active, observed), name + " (observed)"))
        elif rule == "nth":
            off = F.pmod(F.lit(wd) - F.weekday(first), F.lit(7)) + (n - 1) * 7
            entries.append((F.when(active, F.date_add(first, off.cast("int"))), name))
        else:
            last = F.last_day(first)
            off = F.pmod(F.weekday(last) - F.lit(wd), F.lit(7))
            entries.append((F.when(active, F.date_sub(last, off.cast("int"))), name))
    arr = F.array(*[F.struct(d.alias("holiday_date"), F.lit(nm).alias("holiday_name"))
                    for d, nm in entries])
    return (years.select(F.explode(arr).alias("h"))
            .select("h.holiday_date", "h.holiday_name")
            .where(F.col("holiday_date").isNotNull()))
