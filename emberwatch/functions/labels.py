"""Class codes, labels and statuses."""

from pyspark.sql import functions as F

from emberwatch import constants as K
from emberwatch.functions.literals import literal_map
from emberwatch.functions.numbers import safe_float

# Whitespace removed by a full trim; SQL trim alone removes only blanks.
WHITESPACE = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\u00a0\u1680\u2028\u2029\u202f\u205f\u3000\ufeff"


def trimmed(column):
    return F.btrim(column, F.lit(WHITESPACE))


def text_for(column, texts, otherwise=None):
    """Look a value up in a small fixed mapping; others give ``otherwise`` or stay as they are."""
    return F.coalesce(literal_map(texts)[column], column if otherwise is None else otherwise)


def class_code(prediction):
    return prediction.cast("int")


def class_label(code):
    """NORMAL, FIRE_RISK, FIRE by code, else UNKNOWN."""
    return text_for(code, K.CLASS_LABELS, F.lit(K.UNKNOWN))


def _by_threshold(temperature, smoke, fire, risk, normal):
    return (
        F.when((temperature > K.FIRE_TEMPERATURE) | (smoke > K.FIRE_SMOKE), F.lit(fire))
        .when((temperature > K.RISK_TEMPERATURE) | (smoke > K.RISK_SMOKE), F.lit(risk))
        .otherwise(F.lit(normal))
    )


def threshold_label(temperature, smoke):
    """Label by the threshold rule; a missing measure decides nothing."""
    return _by_threshold(temperature, smoke, K.FIRE, K.FIRE_RISK, K.NORMAL)


def threshold_code(temperature, smoke):
    return _by_threshold(temperature, smoke, 2, 1, 0)


def normalise_label(label):
    """Upper case without trimming; anything but the three classes is UNKNOWN."""
    upper = F.upper(label.cast("string"))
    return F.when(upper.isin([*K.CLASS_LABELS.values()]), upper).otherwise(F.lit(K.UNKNOWN))


def normalise_status(value):
    """Web status of a free text: NORMAL, RISK, FIRE or UNKNOWN."""
    text = F.translate(F.upper(trimmed(value.cast("string"))), "- ", "__")
    synonyms = {word: status for status, words in K.WEB_STATUS_SYNONYMS.items() for word in words}
    return text_for(text, synonyms, F.lit(K.UNKNOWN))


def status_alias(status, prediction, predicted_class, result, label):
    """Web status of the first field present; an empty text counts as present."""
    return normalise_status(F.coalesce(status, prediction, predicted_class, result, label))


def is_missing(value):
    """Null, NaN, or a text that stands for nothing."""
    text = F.lower(trimmed(value.cast("string")))
    return text.isNull() | text.isin(K.MISSING_TEXTS)


def resolve_status(label, prediction):
    """Alert status: a valid trimmed label wins, else the class code, else UNKNOWN."""
    upper = F.upper(trimmed(label.cast("string")))
    code = safe_float(prediction).try_cast("int")
    return F.when(upper.isin([*K.CLASS_LABELS.values()]), upper).otherwise(class_label(code))


def status_text(label):
    return text_for(label, K.STATUS_TEXT)


def incident_text(label):
    return text_for(label, K.INCIDENT_TEXT)


def web_status_text(status):
    return text_for(status, K.WEB_STATUS_TEXT)


def freshness_text(is_fresh, fresh=K.FRESH_TEXT, stale=K.STALE_TEXT):
    return F.when(is_fresh, F.lit(fresh)).otherwise(F.lit(stale))


def fire_first(label):
    """0 for FIRE, 1 for FIRE_RISK: the order in which alerts are shown."""
    return text_for(label, {K.FIRE: 0, K.FIRE_RISK: 1}, F.lit(None).cast("int"))


def board_priority(label):
    """FIRE, FIRE_RISK, anything unclear, NORMAL."""
    return text_for(label, {K.FIRE: 0, K.FIRE_RISK: 1, K.NORMAL: 3}, F.lit(2))


def is_fresh(age, stale_seconds=K.STALE_SECONDS):
    """Age within the limits, both inclusive; no age is not fresh."""
    return F.coalesce(age.between(-K.CLOCK_SKEW_SECONDS, stale_seconds), F.lit(False))


def connection_state(age, stale_seconds=K.STALE_SECONDS):
    """ONLINE, OFFLINE, or UNKNOWN where there is no usable time."""
    return (
        F.when(age.isNull(), F.lit("UNKNOWN"))
        .when(is_fresh(age, stale_seconds), F.lit("ONLINE"))
        .otherwise(F.lit("OFFLINE"))
    )
