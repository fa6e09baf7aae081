"""Keys, dates, measures and labels. All Column -> Column."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from pricelake.functions.text import STRIPPED_BLANKS

# Fixed value: the text that stands for null inside a surrogate key.
NULL_TOKEN = "_dbt_utils_surrogate_key_null_"


def surrogate_key(*cols: Column | str) -> Column:
    """md5 hex over the values joined with "-"; nulls take part as a token."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def valid_url(c: Column | str) -> Column:
    """The value when it starts with http:// or https://, else null."""
    c = _col(c)
    return F.when(c.rlike("^https?://"), c)


def clean_url(c: Column | str, drop_fragment: bool = False) -> Column:
    """Trim, cut the query (and the fragment), keep http(s) only."""
    ends = "[?#]" if drop_fragment else "[?]"
    return valid_url(F.regexp_replace(F.trim(_col(c), F.lit(STRIPPED_BLANKS)), f"(?s){ends}.*$", ""))


def clip(c: Column | str, lo: float, hi: float) -> Column:
    """Limit to [lo, hi]; null stays null."""
    c = _col(c)
    return F.when(c.isNotNull(), F.greatest(F.least(c, F.lit(hi)), F.lit(lo)))


def variation_pct(latest: Column | str, earliest: Column | str, digits: int = 4) -> Column:
    """(latest - earliest) / earliest, rounded; null when it cannot be divided."""
    latest, earliest = _col(latest), _col(earliest)
    return F.round(F.try_divide(latest - earliest, earliest), digits)


def direction(c: Column | str) -> Column:
    c = _col(c)
    return F.when(c > 0, "increase").when(c < 0, "decrease").otherwise("flat")


def discount_measures(price="price", original="original_price", discount="discount_price") -> dict[str, Column]:
    price, original, discount = _col(price), _col(original), _col(discount)
    saved = original - price
    return {
        "is_discounted": discount.isNotNull() & (discount < original),
        "discount_abs": saved,
        "discount_pct": F.try_divide(saved, original),
    }


def calendar_columns(d: Column | str) -> dict[str, Column]:
    """The attributes of one calendar day (ISO weeks start on Monday)."""
    d = _col(d)
    week, month, quarter, year = (F.trunc(d, unit) for unit in ("week", "month", "quarter", "year"))
    iso_year, iso_week, weekday = F.extract(F.lit("YEAROFWEEK"), d), F.weekofyear(d), F.weekday(d) + 1
    return {
        "date": d,
        "date_key": F.date_format(d, "yyyyMMdd").cast("int"),
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_key": F.date_format(d, "yyyyMM").cast("int"),
        "month_name": F.date_format(d, "MMMM"),
        "iso_year": iso_year,
        "iso_week": iso_week,
        "week_start_date": week,
        "week_end_date": F.date_add(week, 6),
        "iso_week_key": F.concat(iso_year.cast("string"), F.lpad(iso_week.cast("string"), 2, "0")),
        "day_of_week": weekday,
        "day_of_month": F.dayofmonth(d),
        "day_of_year": F.dayofyear(d),
        "is_weekend": weekday.isin(6, 7),
        "month_start_date": month,
        "month_end_date": F.last_day(d),
        "quarter_start_date": quarter,
        "quarter_end_date": F.date_sub(F.add_months(quarter, 3), 1),
        "year_start_date": year,
        "year_end_date": F.date_sub(F.add_months(year, 12), 1),
    }


def period_starts(d: Column | str) -> dict[str, Column]:
    """Anchor days of the to-date comparisons: this month, 3 and 6 months (both count this one), this year."""
    d = _col(d)
    return {
        "mtd": F.trunc(d, "month"),
        "mtd3": F.trunc(F.add_months(d, -2), "month"),
        "mtd6": F.trunc(F.add_months(d, -5), "month"),
        "ytd": F.trunc(d, "year"),
    }


def since(c: Column | str, as_of: dt.date | str, n: int, unit: str = "day", truncate: bool = False) -> Column:
    """Rows dated in the last `n` days or months up to `as_of`; `truncate` starts at the month's first day."""
    today = F.to_date(F.lit(str(as_of)))
    start = {"day": F.date_sub(today, n), "month": F.add_months(today, -n)}[unit]
    return _col(c) >= (F.trunc(start, "month") if truncate else start)


def month_window(c: Column | str, as_of: dt.date | str) -> Column:
    """Rows dated in the month of `as_of`."""
    start = F.trunc(F.to_date(F.lit(str(as_of))), "month")
    return (_col(c) >= start) & (_col(c) < F.add_months(start, 1))


def last_saturday(d: Column | str) -> Column:
    """The last Saturday on or before the day."""
    d = _col(d)
    return F.date_sub(d, F.dayofweek(d) % 7)


def parse_category_label(c: Column | str) -> tuple[Column, Column]:
    """Category path -> (first piece, the rest), with names for what is absent."""
    pieces = F.filter(
        F.transform(F.split(F.coalesce(_col(c), F.lit("")), ">"), lambda p: F.trim(p, F.lit(STRIPPED_BLANKS))), lambda p: p != ""
    )
    first = F.coalesce(F.get(pieces, F.lit(0)), F.lit("(missing)"))
    rest = (
        F.when(F.size(pieces) == 0, "(missing)")
        .when(F.size(pieces) == 1, "(none)")
        .otherwise(F.array_join(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), " > "))
    )
    return first, rest


def stats_product_key(url: Column | str, name: Column | str) -> Column:
    """Who a listed product is: its URL, else its name, else "unknown"."""
    blanks = F.lit(STRIPPED_BLANKS)
    url = F.nullif(F.trim(_col(url), blanks), F.lit(""))
    words = F.regexp_replace(_col(name), f"[{STRIPPED_BLANKS}]+", " ")
    name = F.nullif(F.lower(F.trim(words)), F.lit(""))
    return F.coalesce(F.concat(F.lit("url::"), url), F.concat(F.lit("name::"), name), F.lit("unknown"))


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c
