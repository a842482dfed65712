"""Numbers as text, rounded as correctly rounded decimal output does.

Java formatting rounds halves up on the shortest decimal form of a double; dashboards
and alerts round the exact binary value, halves to even. The two differ on every
value that looks like a tie (0.25, 25.81875), so the rounding is done here.
"""

from pyspark.sql import functions as F

from emberwatch.constants import NO_MEASURE_TEXT, NOT_AVAILABLE
from emberwatch.functions.labels import is_missing
from emberwatch.functions.literals import literal_array
from emberwatch.functions.numbers import clean_double, safe_float

_SPLITTER = 134217729.0  # 2**27 + 1: cuts a double into two halves of at most 27 bits
_GENERAL_DIGITS = 6
_INFINITY = float("inf")
_MOST_DECIMALS = 11  # up to here a power of ten has at most 26 bits, so products with a half are exact


def _rounded(value, factor):
    """``value * factor`` rounded to a whole number, halves to even, ``factor`` a power of ten.

    The product itself may be rounded onto a tie; the sign of that rounding error, computed
    exactly from the two halves of ``value``, tells on which side the true product lies.
    """
    product = value * factor
    high = value * _SPLITTER - (value * _SPLITTER - value)
    error = (high * factor - product) + (value - high) * factor
    tied = F.abs(product - F.rint(product)) == 0.5
    return F.when(
        tied & (error != 0), F.floor(product).cast("double") + F.when(error > 0, 1.0).otherwise(0.0)
    ).otherwise(F.rint(product))


def _with_point(whole, digits):
    """A whole number as text with the decimal point ``digits`` places from the right."""
    scale = literal_array([10**count for count in range(_MOST_DECIMALS + 1)])[digits.cast("int")]
    fraction = F.lpad((whole % scale).cast("string"), digits.cast("int"), F.lit("0"))
    return F.concat(F.call_function("div", whole, scale).cast("string"), F.lit("."), fraction)


def _signed(value, text):
    negative = (value < 0) | ((value == 0) & (value.cast("string") == "-0.0"))
    return F.concat(F.when(negative, F.lit("-")).otherwise(F.lit("")), text)


def format_fixed(value, digits):
    """Fixed number of decimals; null for null."""
    if not 0 <= digits <= _MOST_DECIMALS:
        raise ValueError(f"digits must be 0 to {_MOST_DECIMALS}")
    value = value.cast("double")
    text = _with_point(_rounded(F.abs(value), F.lit(10.0**digits)).try_cast("bigint"), F.lit(digits))
    text = _signed(value, text if digits else F.rtrim(text, F.lit(".")))
    return F.coalesce(text, F.when(value.isNotNull(), F.format_string(f"%.{digits}f", value)))


def format_general(value):
    """Six significant digits without trailing zeros, scientific outside 1e-4 .. 1e6.

    Null for null and NaN. From 1e6 on, where no measure of this kind lies, exact ties are
    rounded up.
    """
    value = value.cast("double")
    size = F.abs(value)
    most = _GENERAL_DIGITS + 3
    digits = F.least(F.greatest(F.lit(_GENERAL_DIGITS - 1) - F.floor(F.log10(size)), F.lit(0)), F.lit(most))
    factor = literal_array([10.0**count for count in range(most + 1)])[digits.cast("int")]
    whole = _rounded(size, factor).try_cast("bigint")
    plain = F.rtrim(F.rtrim(_with_point(whole, digits), F.lit("0")), F.lit("."))
    scientific = F.regexp_replace(F.format_string("%.5e", size), r"\.?0*e", "e")
    special = (
        F.when(size == 0, F.lit("0")).when(size == _INFINITY, F.lit("inf")).when(~F.isnan(size) & size.isNotNull(), scientific)
    )
    # The first condition names ``whole``, so Spark computes it once for the condition and the text.
    text = F.when(whole.isNull() | (size >= 999999.5) | (size < 1e-4), special).otherwise(plain)
    return _signed(value, text)


def display_measure(value, unit=""):
    """A numeric column as a compact number with its unit; missing gives N/A."""
    return F.coalesce(F.concat(format_general(value), F.lit(unit)), F.lit(NOT_AVAILABLE))


def display_measure_text(value, unit=""):
    """As ``display_measure`` for text; what is neither missing nor a number passes through."""
    number = safe_float(value)
    text = F.coalesce(format_general(number), F.when(~is_missing(value), value), F.lit(NOT_AVAILABLE))
    return F.concat(text, F.when(is_missing(value), F.lit("")).otherwise(F.lit(unit)))


def fixed_measure(value, digits=1):
    """Fixed decimals; missing gives a dash."""
    return F.coalesce(format_fixed(clean_double(value), digits), F.lit(NO_MEASURE_TEXT))


def display_probability(value):
    """A numeric column as a percentage with one decimal.

    0..1 is a share, anything else is taken as a percentage; missing gives N/A.
    """
    number = F.when(F.abs(value) < _INFINITY, value)
    percent = number * F.when(value.between(0, 1), 100.0).otherwise(1.0)
    return F.coalesce(F.concat(format_fixed(percent, 1), F.lit("%")), F.lit(NOT_AVAILABLE))


def display_probability_text(value):
    """As ``display_probability`` for text."""
    return display_probability(safe_float(value))
