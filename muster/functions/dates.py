"""Lenient date and time parsing of trimmed text.

ISO text, the common case, is cast to ``timestamp_ntz`` at once. Only text the cast
refuses is rewritten into ISO order and cast again. Unlike the ``to_timestamp``
family this never depends on the session time zone, and ``try_cast`` turns bad text
into null under ANSI mode. As in ``text``, a column name or SQL expression goes in.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

_MONTHS = (
    "jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sept?(?:ember)?"
    "|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?"
)
_MONTH_STARTS = "janfebmaraprmayjunjulaugsepoctnovdec"
_DAY = r"\d{1,2}(?:st|nd|rd|th)?"
# A named month before or after the day, then the year and perhaps a time.
_NAMED = rf"(?i)^(?:(?:{_MONTHS})\.? {_DAY},? +|{_DAY}[ -](?:{_MONTHS})\.?,?[ -])\d{{4}}(?: .*)?$"

# (pattern, rewrite), applied in turn; a text that does not match stays as it is.
_REWRITES = (
    # Twelve-hour clock: 12 AM and 12 PM count from 0, then the suffix goes. The 12 hours
    # of PM are added after the cast, to texts this list leaves as a time before noon.
    (r"(?i)^(\S+) 12(:[0-5]\d(?::[0-5]\d)? ?[ap]\.?m\.?)$", "$1 00$2"),
    (r"(?i)^(\S+ (?:0?\d|1[01]):[0-5]\d(?::[0-5]\d)?) ?[ap]\.?m\.?$", "$1"),
    # Two-digit years lie between 1976 and 2075.
    (r"^(\d{1,2}[/.-]\d{1,2})[/.-]([0-6]\d|7[0-5])( .*)?$", "$1/20$2$3"),
    (r"^(\d{1,2}[/.-]\d{1,2})[/.-](7[6-9]|[89]\d)( .*)?$", "$1/19$2$3"),
    # Month first; day first only where the first number cannot be a month.
    (r"^(0?[1-9]|1[0-2])[/.-](\d{1,2})[/.-](\d{4})( .*)?$", "$3-$1-$2$4"),
    (r"^(\d{1,2})[/.-](\d{1,2})[/.-](\d{4})( .*)?$", "$3-$2-$1$4"),
    (r"^(\d{4})[/.](\d{1,2})[/.](\d{1,2})([ T].*)?$", "$1-$2-$3$4"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
    (r"^(\d{4})(\d{2})(\d{2})T?(\d{2})(\d{2})(\d{2})$", "$1-$2-$3 $4:$5:$6"),
    # Years have four digits and start at 1.
    (r"^(?!\d{4}(?:-|$)).*|^0000.*", ""),
)

_AFTERNOON = r"(?i) (?:0?\d|1[0-2]):[0-5]\d(?::[0-5]\d)? ?p\.?m\.?$"


def _ntz(sql: str) -> str:
    return f"try_cast({sql} as timestamp_ntz)"


def _numbered(c: str) -> str:
    """A named month by its number, in ISO order; other text as it is."""
    month = f"locate(lower(regexp_extract({c}, r'([A-Za-z]{{3}})', 1)), '{_MONTH_STARTS}')"
    year, rest = (f"regexp_extract({c}, r'(\\d{{4}})( .*)?$', {n})" for n in (1, 2))
    day = f"regexp_extract({c}, r'(?<!\\d)(\\d{{1,2}})(?!\\d)', 1)"
    iso = f"concat({year}, '-', ({month} + 2) div 3, '-', {day}, {rest})"
    return f"if({c} rlike r'{_NAMED}', {iso}, {c})"


def _rewritten(c: str) -> str:
    iso = reduce(
        lambda sql, step: f"regexp_replace({sql}, r'{step[0]}', '{step[1]}')", _REWRITES, _numbered(c)
    )
    return f"{_ntz(iso)} + if({c} rlike r'{_AFTERNOON}', interval '12' hour, interval '0' hour)"


def parse_datetime(c: str) -> Column:
    """Date and time of day without time zone; null when the text fits no declared format."""
    four_digit_year = f"substring({c}, 5, 1) in ('-', '') and not startswith({c}, '0000')"
    direct = _ntz(f"if({four_digit_year}, {c}, null)")
    return F.expr(f"coalesce({direct}, {_rewritten(c)})")


def parse_date(c: str) -> Column:
    """Date part of ``parse_datetime``."""
    return parse_datetime(c).cast("date")
