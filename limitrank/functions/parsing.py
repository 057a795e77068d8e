"""Text to typed values: dates, numbers, markets and security types. Columns in, columns out; bad input gives null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Markers of a missing valuation, in lower case (fixed values).
MISSING = ("-", "--", "n/a", "na", "null", "none")
#: White space of Unicode, and the four separators of ASCII (fixed values).
SPACE = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"


def strip(text: Column) -> Column:
    """The text without white space of any kind at its ends."""
    return F.btrim(text, F.lit(SPACE))


def roc_to_date(text: Column) -> Column:
    """Seven digits, a year of the Republic (1911 less) with month and day; anything else, or no such day: null."""
    t = strip(text)
    year = (F.substring(t, 1, 3).try_cast("int") + 1911).cast("string")
    return F.when(t.rlike(r"\A[0-9]{7}\z"), F.to_date(F.try_to_timestamp(F.concat(year, F.substring(t, 4, 4)), F.lit("yyyyMMdd"))))


def iso_to_date(text: Column) -> Column:
    """``YYYY-MM-DD`` only; other forms or no such day: null."""
    return F.when(text.rlike(r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}\z"), text.try_cast("date"))


def parse_decimal(text: Column, commas: bool = True, zero_is_null: bool = False, missing: tuple[str, ...] = (), kind: str = "decimal(18,4)") -> Column:
    """A stripped number as ``kind``; empty, unreadable or not finite: null."""
    t = strip(text)
    if missing:
        t = F.when(~F.lower(t).isin(*missing), t)
    if commas:
        t = F.replace(t, F.lit(","), F.lit(""))
    d = t.try_cast(kind)
    return F.nullif(d, F.lit(0).cast(kind)) if zero_is_null else d


def parse_int(text: Column, commas: bool = True) -> Column:
    """BIGINT of a whole number; fractions and all that ``parse_decimal`` refuses: null."""
    d = parse_decimal(text, commas, kind="decimal(24,4)")
    return F.when(d == F.floor(d), d.cast("bigint"))


def market_of(text: Column) -> Column:
    t = F.upper(strip(text))
    return F.when(t.isin("TWSE", "TPEX"), t)


def classify_security(stock_id: Column, name: Column, category: Column) -> Column:
    """ETF, ETN, WARRANT, DR, COMMON_STOCK or UNKNOWN; the first that fits, in this order (the words are fixed values)."""
    c, n = F.upper(strip(F.coalesce(category, F.lit("")))), F.upper(strip(F.coalesce(name, F.lit(""))))

    def named(*words: str) -> Column:
        found = F.lit(False)
        for w in words:
            found = found | c.contains(w) | n.contains(w)
        return found

    return (
        F.when(named("ETF"), "ETF").when(named("ETN"), "ETN").when(named("權證"), "WARRANT")
        .when((c == "DR") | named("TDR", "存託憑證"), "DR")
        .when(stock_id.rlike(r"\A[0-9]{4}\z"), "COMMON_STOCK").otherwise("UNKNOWN")
    )


def utf16_length(text: Column) -> Column:
    """UTF-16 code units of a text."""
    return (F.octet_length(F.encode(text, "UTF-16LE")) / 2).cast("long")
