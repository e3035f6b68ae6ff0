"""Cleaning of text columns.

Functions take the name of a column, or any SQL expression, and give a Column. They
are written as SQL text because a file has dozens of columns, and one parsed
expression is far cheaper to build than a tree of Column calls for each of them.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Field texts that mean "missing" when a CSV file is read, matched
# exactly (the three declared tokens, then the pandas reader's documented list).
CSV_NULL_TOKENS = (
    "[NULL]", "NULL", "",
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NaN", "None", "n/a", "nan", "null",
)

# Texts that mean "missing" after trimming, in lower case.
BLANK_WORDS = ("nan", "nat", "none", "null", "")

# Texts that mean "true" after trimming, in lower case.
TRUE_WORDS = ("1", "true", "yes")

# The characters Python's str.strip() removes (F.trim alone removes spaces only).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Decimal number with optional sign, fraction, exponent and digit-group underscores.
# Keeps out the suffixes and words (1.0d, NaN, Infinity) that a cast to double accepts.
_NUMBER = r"^[+-]?(\d+(_\d+)*\.?(\d+(_\d+)*)?|\.\d+(_\d+)*)([eE][+-]?\d+)?$"
_LONGEST_BLANK = max(map(len, BLANK_WORDS))


def literal(text: str) -> str:
    """SQL string literal; every character is written as its code."""
    return "'" + "".join(f"\\u{ord(c):04x}" for c in text) + "'"


def _among(words: Iterable[str]) -> str:
    return "(" + ", ".join(map(literal, words)) + ")"


def _strip(c: str) -> str:
    visible = "between 33 and 127"  # ASCII codes
    return (
        f"if(ascii({c}) {visible} and ascii(substring({c}, -1, 1)) {visible}, {c}, "
        f"trim(both {literal(WHITESPACE)} from {c}))"
    )


def _blank_to_null(c: str) -> str:
    return (
        f"case when octet_length({c}) > {_LONGEST_BLANK} or lower({c}) not in {_among(BLANK_WORDS)} "
        f"then {c} end"
    )


def strip(c: str) -> Column:
    """Trim every kind of white space from both ends.

    Trimming a character set is costly per value, so text that starts and ends
    with a visible ASCII character passes as it is.
    """
    return F.expr(_strip(c))


def blank_to_null(c: str) -> Column:
    """Null where trimmed text is empty or a word for missing; longer text passes at once."""
    return F.expr(_blank_to_null(c))


def clean_string(c: str) -> Column:
    """Trimmed text, null when blank or a word for missing."""
    return F.expr(_blank_to_null(_strip(c)))


def clean_columns(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """``clean_string`` on many columns, in two projections so that each value is trimmed once."""
    names = list(columns)
    stripped = df.withColumns({c: strip(c) for c in names})
    return stripped.withColumns({c: blank_to_null(c) for c in names})


def null_token(c: str, tokens: Sequence[str] = CSV_NULL_TOKENS) -> Column:
    """Null where the raw field is one of ``tokens``; the text is not trimmed first."""
    return F.expr(f"case when {c} not in {_among(tokens)} then {c} end")


# The parsers below expect trimmed text, as ``clean_columns`` leaves it.


def parse_bool(c: str) -> Column:
    """True for a true word, else false; never null."""
    return F.expr(f"coalesce(lower({c}) in {_among(TRUE_WORDS)}, false)")


def _plain_number(c: str) -> str:
    """Number text without digit-group underscores; null for any other text."""
    return f"case when {c} rlike r'{_NUMBER}' then translate({c}, '_', '') end"


def parse_double(c: str) -> Column:
    """Number as double; text that is no finite number gives null."""
    return finite(f"try_cast({_plain_number(c)} as double)")


def parse_decimal(c: str, precision: int, scale: int) -> Column:
    """Number as fixed point, rounded half away from zero; null when invalid or too large.

    The cast accepts no words or suffixes, so only what it refuses is looked at again.
    """
    kind = f"decimal({precision}, {scale})"
    return F.expr(f"coalesce(try_cast({c} as {kind}), try_cast({_plain_number(c)} as {kind}))")


def overflows(c: str, precision: int, scale: int) -> Column:
    """True where the text is a number that ``parse_decimal`` cannot hold; never null."""
    return parse_decimal(c, precision, scale).isNull() & parse_double(c).isNotNull()


def finite(c: str) -> Column:
    """Null instead of NaN, which sorts above every number, or an infinity."""
    return F.expr(f"case when abs({c}) < double('infinity') then {c} end")


def finite_columns(df: DataFrame) -> DataFrame:
    """Apply ``finite`` to every floating-point column."""
    floating = (T.DoubleType, T.FloatType)
    return df.withColumns(
        {f.name: finite(f.name) for f in df.schema.fields if isinstance(f.dataType, floating)}
    )
