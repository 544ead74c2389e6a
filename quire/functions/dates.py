"""Story-date and relative-date expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The dateline is looked for in the first 40 characters of
# the content (a dateline sits at the head of a story by definition).
DATELINE_WINDOW = 40
DAY_PATTERN = r"(?U)(\d{1,2})日"

# Relative-date words, replaced in this order.
# (word, day offset / month offset / year offset, rendering)
RELATIVE_WORDS = [
    ("前天", "day", -2), ("昨天", "day", -1), ("今天", "day", 0), ("明天", "day", 1),
    ("明後天", "day2", 1), ("本月", "this_month", 0), ("上個月", "month", -1),
    ("下個月", "month", 1), ("今年", "year", 0), ("去年", "year", -1), ("明年", "year", 1),
]
FULL_DATE = "yyyy年MM月dd日"

_WIDE, _NARROW = "０１２３４５６７８９", "0123456789"


def _number(digits: Column) -> Column:
    """Digits, full-width ones too, as an integer (null for anything else)."""
    return F.translate(digits, _WIDE, _NARROW).try_cast("int")


def dateline_day(content: Column) -> Column:
    """Day number of the dateline (e.g. 15 in 15日) or null."""
    head = F.substring(content, 1, DATELINE_WINDOW)
    return _number(F.nullif(F.regexp_extract(head, DAY_PATTERN, 1), F.lit("")))


def _add_days(ts: Column, days: Column) -> Column:
    return ts + F.make_dt_interval(days=days)


def story_date(dt: Column, content: Column, variant: str = "calendar") -> Column:
    """The event date a story refers to.

    v1: article date shifted by (dateline day - article day) days, time kept.
    v2: v1, then one month back if that is later than the article.
    calendar: the latest date not after the article date with that day number.
    No dateline -> the article date.
    """
    day = dateline_day(content)
    v1 = _add_days(dt, day - F.dayofmonth(dt))
    if variant == "v1":
        out = v1
    elif variant == "v2":
        out = F.when(v1 > dt, F.timestamp_add("MONTH", F.lit(-1), v1)).otherwise(v1)
    elif variant == "calendar":
        first = F.date_trunc("MONTH", dt)
        prev1 = F.timestamp_add("MONTH", F.lit(-1), first)
        prev2 = F.timestamp_add("MONTH", F.lit(-2), first)
        time_of_day = dt - F.date_trunc("DAY", dt)
        fits1 = day <= F.dayofmonth(F.last_day(prev1))
        base = (F.when(day <= F.dayofmonth(dt), first)
                 .when(fits1, prev1).otherwise(prev2))
        out = _add_days(base, day - 1) + time_of_day
    else:
        raise ValueError(f"unknown variant {variant!r}")
    return F.when(day.isNull(), dt).otherwise(out)


def resolve_relative_dates(text: Column, story: Column) -> Column:
    """Append the concrete date to relative-date words, in the fixed order."""
    out = text
    for word, kind, k in RELATIVE_WORDS:
        if kind == "day":
            rep = F.concat(F.lit(word + "（"), F.date_format(_add_days(story, F.lit(k)), FULL_DATE), F.lit("）"))
        elif kind == "day2":
            rep = F.concat(F.lit(word + "（"), F.date_format(_add_days(story, F.lit(1)), FULL_DATE),
                           F.lit("、"), F.date_format(_add_days(story, F.lit(2)), FULL_DATE), F.lit("）"))
        elif kind == "this_month":
            rep = F.concat(F.lit(word), F.date_format(story, "MM月"))
        elif kind == "month":
            rep = F.concat(F.lit(word + "（"), F.date_format(F.timestamp_add("MONTH", F.lit(k), story), "MM月"),
                           F.lit("）"))
        else:
            rep = F.concat(F.lit(word + "（"), F.date_format(F.timestamp_add("YEAR", F.lit(k), story), "yyyy年"),
                           F.lit("）"))
        out = F.replace(out, F.lit(word), rep)
    return out


def _let(value: Column, body) -> Column:
    """Evaluate ``value`` once and hand it to ``body`` as a lambda variable.
    Expressions holding lambdas get no common-subexpression elimination, so
    a value used several times inside them is bound once this way."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _rebuild(text: Column, pattern: str, convert) -> Column:
    """Replace every match of ``pattern`` by ``convert(match, text_before)``.

    Spark has no replace-with-function; the text is split on the pattern and
    the pieces are zipped once into (before, hit, after) elements, so the
    per-match lambda reads only its own element."""
    def body(t):
        parts = F.split(t, pattern, -1)
        hits = F.regexp_extract_all(t, F.lit(pattern), 0)
        n = F.size(hits)
        zipped = F.arrays_zip(F.slice(parts, 1, n).alias("b"), hits.alias("h"), F.slice(parts, 2, n).alias("a"))
        joined = F.array_join(F.transform(zipped, lambda x: F.concat(convert(x["h"], x["b"]), x["a"])), "")
        return F.when(n == 0, t).otherwise(F.concat(F.element_at(parts, 1), joined))
    return _let(text, body)


def resolve_day_mentions(text: Column, story: Column) -> Column:
    """``11月15日`` -> ``11月15日（YYYY年11月15日）`` with the story year; a lone
    ``2日`` (not right after 月) -> ``2日（date）`` shifted from the story day;
    the original words stay, and dates already written in full are left alone (I4)."""
    md = r"(?U)(\d{1,2})月(\d{1,2})日"

    def conv_md(m, before):
        mon = F.lpad(F.translate(F.regexp_extract(m, md, 1), _WIDE, _NARROW), 2, "0")
        day = F.lpad(F.translate(F.regexp_extract(m, md, 2), _WIDE, _NARROW), 2, "0")
        # part of a full date already (…年10月13日) or of a longer number: unchanged
        inside = before.endswith("年") | F.coalesce(before.rlike(r"(?U)\d$"), F.lit(False))
        return F.when(inside, m).otherwise(
            F.concat(m, F.lit("（"), F.date_format(story, "yyyy"), F.lit("年"), mon, F.lit("月"),
                     day, F.lit("日）")))

    def conv_day(m, before):
        d = _number(F.regexp_extract(m, DAY_PATTERN, 1))
        when = _add_days(story, d - F.dayofmonth(story))
        return F.when(before.endswith("月") | F.coalesce(before.rlike(r"(?U)\d$"), F.lit(False)) | when.isNull(), m) \
                .otherwise(F.concat(m, F.lit("（"), F.date_format(when, FULL_DATE), F.lit("）")))

    once = _rebuild(text, md, conv_md)
    return _rebuild(once, DAY_PATTERN, conv_day)


# The forms in which sources write times and days.
TIME_FORMATS = ("yyyy/MM/dd HH:mm", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd", "yyyyMMdd")


def parse_minute_time(text: Column) -> Column:
    """``yyyy/MM/dd HH:mm`` text -> timestamp_ntz (null when malformed)."""
    return parse_time(text, TIME_FORMATS[:1])


def parse_time(text: Column, formats: tuple[str, ...] = TIME_FORMATS) -> Column:
    """Text in any of the forms -> timestamp_ntz (I19); null when none fits."""
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("timestamp_ntz") for f in formats])


def format_time(ts: Column, form: str = TIME_FORMATS[0]) -> Column:
    """A timestamp written in one of the forms."""
    return F.date_format(ts, form)
