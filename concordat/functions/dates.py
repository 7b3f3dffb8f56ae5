"""Date functions of other dialects on Spark columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Abbreviations of date parts and the parts they stand for.
UNITS = {
    "year": "YEAR", "yy": "YEAR", "yyyy": "YEAR",
    "quarter": "QUARTER", "qq": "QUARTER", "q": "QUARTER",
    "month": "MONTH", "mm": "MONTH", "m": "MONTH",
    "dayofyear": "DOY", "dy": "DOY", "y": "DOY",
    "day": "DAY", "dd": "DAY", "d": "DAY",
    "week": "WEEK", "wk": "WEEK", "ww": "WEEK", "iso_week": "WEEK", "isowk": "WEEK", "isoww": "WEEK",
    "weekday": "DOW", "dw": "DOW", "w": "DOW",
    "hour": "HOUR", "hh": "HOUR",
    "minute": "MINUTE", "mi": "MINUTE", "n": "MINUTE",
    "second": "SECOND", "ss": "SECOND", "s": "SECOND",
    "millisecond": "MILLISECOND", "ms": "MILLISECOND",
    "microsecond": "MICROSECOND", "mcs": "MICROSECOND",
}
#: Average seconds in a unit.
AVERAGE = {"YEAR": 365.25 * 86400, "QUARTER": 91.3125 * 86400, "MONTH": 30.4375 * 86400, "WEEK": 7 * 86400, "DAY": 86400, "HOUR": 3600, "MINUTE": 60, "SECOND": 1}


def unit(name: str) -> str:
    return UNITS[name.lower()]


def dateadd(name: str, n: Column | int, x: Column) -> Column:
    """x moved by n units; the day is clamped to the month's end."""
    u = unit(name)
    u = {"DOY": "DAY", "DOW": "DAY"}.get(u, u)
    n = F.lit(n) if isinstance(n, int) else n
    return F.timestamp_add(u, n.cast("int"), x.cast("timestamp"))


def datepart(name: str, x: Column) -> Column:
    """Part of x; weekdays count from Sunday = 1, weeks are ISO weeks."""
    u = unit(name)
    if u == "WEEK":
        return F.weekofyear(x)
    if u in ("MILLISECOND", "MICROSECOND"):
        scale = 1000 if u == "MILLISECOND" else 1_000_000
        return (F.date_part(F.lit("SECOND"), x) * scale).cast("int")
    part = F.date_part(F.lit(u), x)
    return part.cast("int") if u == "SECOND" else part


def _number(u: str, x: Column) -> Column:
    """How many boundaries of unit u lie between a fixed moment and x."""
    if u == "YEAR":
        return F.year(x)
    if u == "QUARTER":
        return F.year(x) * 4 + F.quarter(x)
    if u == "MONTH":
        return F.year(x) * 12 + F.month(x)
    days = F.datediff(x, F.lit("1970-01-01").cast("date"))
    if u == "WEEK":  # weeks begin on Sunday; 1970-01-01 was a Thursday
        return F.floor((days + 4) / 7).cast("int")
    if u in ("DAY", "DOY", "DOW"):
        return days
    seconds = {"HOUR": 3600, "MINUTE": 60, "SECOND": 1}[u]
    return F.floor(F.unix_micros(x.cast("timestamp")) / (seconds * 1_000_000)).cast("bigint")


def datediff_boundary(name: str, a: Column, b: Column) -> Column:
    """Boundaries of the unit crossed from a to b."""
    u = unit(name)
    return (_number(u, b) - _number(u, a)).cast("int")


def datediff_elapsed(name: str, a: Column, b: Column) -> Column:
    """Whole units of average length from a to b, towards zero."""
    seconds = (F.unix_micros(b.cast("timestamp")) - F.unix_micros(a.cast("timestamp"))) / 1e6
    return (seconds / AVERAGE[unit(name)]).cast("int")


def truncated(name: str, x: Column, shift: int = 0) -> Column:
    """Start of x's unit, moved by shift units: what adding a difference from day 0 stands for."""
    start = F.date_trunc(unit(name), x)
    return dateadd(name, shift, start) if shift else start


def eomonth(x: Column, months: int = 0) -> Column:
    return F.last_day(F.add_months(x, months)) if months else F.last_day(x)


def days_between(a: Column, b: Column) -> Column:
    """a - b in days, with their fraction."""
    return (F.unix_micros(a.cast("timestamp")) - F.unix_micros(b.cast("timestamp"))) / 8.64e10


#: Codes of strftime-like formats and the patterns they stand for.
FORMAT_CODES = {"%Y": "yyyy", "%y": "yy", "%m": "MM", "%c": "M", "%d": "dd", "%e": "d", "%H": "HH", "%k": "H", "%h": "hh", "%I": "hh", "%i": "mm", "%s": "ss", "%S": "ss", "%p": "a", "%M": "MMMM", "%b": "MMM", "%W": "EEEE", "%a": "EEE", "%j": "DDD", "%T": "HH:mm:ss", "%f": "SSSSSS", "%%": "%"}


def date_pattern(text: str) -> str:
    """A pattern of Spark for a format with percent codes; other letters are quoted."""
    out, k = "", 0
    while k < len(text):
        if text[k] == "%" and text[k : k + 2] in FORMAT_CODES:
            out, k = out + FORMAT_CODES[text[k : k + 2]], k + 2
        else:
            out, k = out + (f"'{text[k]}'" if text[k].isalpha() else text[k]), k + 1
    return out


#: Styles of CONVERT to text.
STYLES = {101: "MM/dd/yyyy", 103: "dd/MM/yyyy", 104: "dd.MM.yyyy", 110: "MM-dd-yyyy", 111: "yyyy/MM/dd", 112: "yyyyMMdd", 120: "yyyy-MM-dd HH:mm:ss", 121: "yyyy-MM-dd HH:mm:ss.SSS", 126: "yyyy-MM-dd'T'HH:mm:ss", 23: "yyyy-MM-dd", 108: "HH:mm:ss"}


def convert_style(x: Column, style: int) -> Column:
    return F.date_format(x, STYLES[style])
