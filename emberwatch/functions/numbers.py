"""Lenient numbers and percentages."""

from pyspark.sql import functions as F

# Letters by which Java would read more texts as numbers than others do: "1d", "2f", "0x1p3".
_JAVA_LETTERS = "dDfFxXpP"
_JAVA_SUFFIX = r"[0-9.][dDfF]\s*$"
_MOST = 1.7976931348623157e308


def to_number(column):
    """Number, or null where the value is not one. NaN is treated as missing."""
    text = column.cast("string")
    return F.nanvl(F.when(~text.rlike(_JAVA_SUFFIX), text.try_cast("double")), F.lit(None))


def clean_double(column):
    """A column that is already numeric, with NaN turned into null."""
    return F.nanvl(column.cast("double"), F.lit(None))


def to_finite(column):
    """As ``to_number``, rejecting infinities as well."""
    number = F.translate(column.cast("string"), _JAVA_LETTERS, "?" * len(_JAVA_LETTERS)).try_cast("double")
    return F.when(F.abs(number) <= _MOST, number)


def web_number(column):
    """The number of a web record's text, as a browser reads it: blanks around it do not count,
    a text of blanks only is 0, and 0x, 0o and 0b begin whole numbers of other bases. Null for
    an empty text and for what is not a finite number."""
    text = column.cast("string")
    body = F.regexp_replace(text, r"^\s+|\s+$", "")
    number = to_finite(body)
    for letter, digits, base in (("x", "0-9a-f", 16), ("o", "0-7", 8), ("b", "01", 2)):
        based = body.rlike(f"^(?i)0{letter}[{digits}]+$")
        number = F.when(based, F.conv(F.substring(body, 3, 64), base, 10).cast("double")).otherwise(number)
    return F.when(text == "", F.lit(None)).when(body == "", 0.0).otherwise(number)


def safe_float(column, default=None):
    """Finite number, else the default."""
    return F.coalesce(to_finite(column), F.lit(default).cast("double"))


def percent_clamped(column):
    """A 0..1 share as a percentage limited to 0..100; missing stays missing."""
    percent = web_number(column) * 100
    return F.when(percent.isNotNull(), F.greatest(F.lit(0.0), F.least(F.lit(100.0), percent)))


def percent_rounded(column):
    """A share as a percentage with one decimal, halves to even."""
    return F.rint(to_number(column) * 100 * 10) / 10


def renormalised(*shares):
    """Shares as percentages of their sum; null unless all are valid and the sum is positive."""
    shares = [clean_double(share) for share in shares]
    total = sum(shares[1:], shares[0])
    valid = total > 0
    for share in shares:
        valid = valid & (share >= 0)
    return [F.when(valid, share / total * 100) for share in shares]
