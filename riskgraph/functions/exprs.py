"""Column expressions: number patterns, guarded parsing, text formats, day helpers.

Everything here returns a ``Column`` built from ``pyspark.sql.functions`` so it
stays inside the JVM and whole-stage code generation; nothing is a Python UDF.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values.  These codes, patterns and names must equal the source
# system's for the results to be right; they are stated here once, in order.
# ---------------------------------------------------------------------------
CHANNEL_OUT = "012001001"          # the record owner called the other number
CHANNEL_IN = "012001002"           # the other number called the record owner
SETTLED = "002005002"              # repay_status of a settled instalment
EDGE_LABEL = "CALL_OUT"            # relation type written on every edge line
MOBILE = r"1[0-9]{10}"             # strict mobile number: 1 and ten digits
LOOSE = r"p1[0-9]{5,10}"           # loose number with the p prefix: 6-11 digits
ANY11 = r"[0-9]{11}"               # any eleven digits
DIGITS = r"[0-9]+"                 # a duration that parses as a number
PREFIX = "p"                       # node prefix used by the loader variants
FRAUD_LABEL = "欺诈"               # collection label meaning fraud
FRAUD_CHANNELS = ("weibo", "hao123", "bbpay", "beike", "dshb", "bbqb",
                  "juanpi", "mmqb", "wowo", "xiaocheng", "yueguang")
# Phone clean-up tokens: country code forms and a trailing carrier tag.
CC_LONG = "p0086"
CC_SHORT = "p86"
CARRIER_TAG = ";cpc"
CC_PAREN = r"p\([0-9]*\)"
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def full_match(c, pattern: str) -> Column:
    """True when the whole text matches ``pattern`` (null stays null).

    ``rlike`` searches, and ``$`` also matches before a final newline, so the
    pattern is anchored with ``\\A`` and ``\\z``.
    """
    return _col(c).rlike(rf"\A(?:{pattern})\z")


def digits_or_zero(c) -> Column:
    """Text made only of digits becomes a double; anything else (``12a``,
    empty, null, ``12\\n``) becomes 0.0.  The guard and the cast sit in one
    ``CASE`` so ANSI mode never sees a bad cast."""
    c = _col(c)
    return F.when(full_match(c, DIGITS), c.cast("double")).otherwise(F.lit(0.0))


def two_decimals(c) -> Column:
    """Fixed two-decimal text, half-up on the shortest decimal form
    (``0.125`` -> ``0.13``); no thousands separator."""
    return F.format_string("%.2f", _col(c))


def prefixed(c, prefix: str = PREFIX) -> Column:
    """``p`` + number (null stays null)."""
    return F.concat(F.lit(prefix), _col(c))


def clean_phone_a(c) -> Column:
    """Drop a country code (long form first) and the carrier tag."""
    c = _col(c)
    drop_tag = lambda x: F.replace(x, F.lit(CARRIER_TAG), F.lit(""))
    return (F.when(c.contains(CC_LONG), drop_tag(F.replace(c, F.lit(CC_LONG), F.lit(PREFIX))))
            .when(c.contains(CC_SHORT), drop_tag(F.replace(c, F.lit(CC_SHORT), F.lit(PREFIX))))
            .when(c.contains(CARRIER_TAG), drop_tag(c))
            .otherwise(c))


def clean_phone_b(c) -> Column:
    """The first matching rule only: long code, short code, carrier tag,
    then a bracketed code ``p(86)``."""
    c = _col(c)
    return (F.when(c.contains(CC_LONG), F.replace(c, F.lit(CC_LONG), F.lit(PREFIX)))
            .when(c.contains(CC_SHORT), F.replace(c, F.lit(CC_SHORT), F.lit(PREFIX)))
            .when(c.contains(CARRIER_TAG), F.replace(c, F.lit(CARRIER_TAG), F.lit("")))
            .when(c.contains("p("), F.regexp_replace(c, CC_PAREN, PREFIX))
            .otherwise(c))


def nz(c) -> Column:
    """Null day count read as 0 (a null unboxes to 0 in the source jobs)."""
    return F.coalesce(_col(c), F.lit(0))


def day_text(d) -> str:
    """A date parameter as ``YYYY-MM-DD`` text."""
    if isinstance(d, str):
        return _dt.date.fromisoformat(d[:10]).isoformat()
    if isinstance(d, _dt.datetime):
        return d.date().isoformat()
    return d.isoformat()


def days(as_of) -> tuple[str, str]:
    """(current_day, pass_day) for an as-of date; pass_day is the day
    before.  The as-of date is always a parameter, never the wall clock."""
    today = _dt.date.fromisoformat(day_text(as_of))
    return today.isoformat(), (today - _dt.timedelta(days=1)).isoformat()


def to_day(c) -> Column:
    """The calendar day of a timestamp or date text."""
    return F.to_date(_col(c))


def later_than_day(c, day) -> Column:
    """timestamp compared with a day **as text**, so exact midnight of
    ``day`` counts as later (``'2001-06-01 00:00:00' > '2001-06-01'``)."""
    return _col(c).cast("string") > F.lit(day_text(day))


def oriented(mobile, other, channel) -> tuple[Column, Column]:
    """(src, dst) of a call record.  Outgoing keeps (mobile, other),
    incoming swaps them; any other channel yields null ends (see
    ``edges.checked_channels``)."""
    mobile, other, channel = _col(mobile), _col(other), _col(channel)
    out = channel == F.lit(CHANNEL_OUT)
    inc = channel == F.lit(CHANNEL_IN)
    return F.when(out, mobile).when(inc, other), F.when(out, other).when(inc, mobile)


def known_channel(channel) -> Column:
    return _col(channel).isin(CHANNEL_OUT, CHANNEL_IN)
