"""Personal data by patterns, validators and context, in SQL functions only.

A pattern proposes spans, a validator confirms them (ranges of address parts, Luhn, mod-97,
numbers of digits), and words nearby raise the score. Spans hold code points, end exclusive.

Spark gives the matches of a pattern and the pieces between them, but no positions; these
are running sums of the lengths of both. A running sum is taken in blocks, so a text with
very many matches costs n * sqrt(n), not n * n.

The patterns start where the plain ones would start first: at the beginning of a run of
their characters or where the last match ended. Together with possessive repeats they never
read a character more than a few times, however long the run.
"""

from pyspark.sql import functions as F

#: name, characters that must occur, pattern
PATTERNS = [
    ("email", "@", r"(?=[A-Za-z0-9._%+-])(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"),
    ("ip", ".", r"(?=[0-9])(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"),
    ("card", None, r"(?=[0-9])(?:(?<![0-9])|\G)[0-9](?:[\x20-]?[0-9])++"),
    ("phone", "+", r"\+[0-9][\x20().0-9-]+[0-9]"),
    # only the head is taken, so that an account number may begin inside a failed proposal;
    # group 1 is the longest proposal, group 2 the text from the head to behind its context
    ("iban", None, r"(?=[A-Z])(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?)(?![A-Za-z0-9]))(?=(?s:(.{0,90})))[A-Z]{2}[0-9]{2}"),
]
BASE_KINDS = ["email", "ip", "card", "phone"]
#: Score of a confirmed span, and what a context word adds.
SCORES = {"email": 0.9, "ip": 0.6, "card": 0.8, "phone": 0.6, "iban": 0.9}
CONTEXT_SCORE = 0.1
CONTEXT_CHARACTERS = 40
CONTEXT_WORDS = {
    "email": "e-?mail|contact|write",
    "ip": "ip|address|host|server|login",
    "card": "card|visa|credit|payment|karte|tarjeta|carte",
    "phone": "phone|tel|call|mobile|fax",
    "iban": "iban|account|bank|konto|cuenta|compte",
}
#: Countries by the length of their account numbers. Codes that are not here have any length.
IBAN_COUNTRIES = {
    15: "NO",
    16: "BE",
    18: "DK FI FK FO GL NL SD",
    19: "MK SI",
    20: "AT BA EE KZ LT LU MN XK",
    21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA",
    23: "AE GI IL IQ OM SO TL",
    24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST",
    26: "IS TR",
    27: "BI DJ FR GR IT MC MR SM",
    28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA",
    30: "JO KW MU YE",
    31: "MT SC",
    32: "LC",
    33: "RU",
}
_IBAN_LENGTHS = "|".join(f"(?:{'|'.join(codes.split())}).{{{length - 2}}}" for length, codes in IBAN_COUNTRIES.items())
_IBAN_FORM = f"^(?:{_IBAN_LENGTHS}|(?!{'|'.join(' '.join(IBAN_COUNTRIES.values()).split())}).{{12,}})$"
_BLOCK = 64
_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]{1,2})"


def _luhn(digits):
    turned = F.reverse(digits)

    def add(total, place):
        digit = F.substring(turned, place, 1).cast("int")
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(place % 2 == 1, digit).otherwise(doubled)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _mod_97(plain):
    moved = F.split(F.concat(F.substring(plain, 5, 64), F.substring(plain, 1, 4)), "")

    def add(rest, sign):
        code = F.ascii(sign)
        number = F.when(code < 58, rest * 10 + code - 48).otherwise(rest * 100 + code - 55)
        return number % 97

    return F.aggregate(moved, F.lit(0), add) == 1


def _is_valid(kind, text):
    digits = F.regexp_replace(text, "[^0-9]", "")
    if kind == "ip":
        return text.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _account(proposal):
    """The longest beginning of ``proposal`` that is an account number, null if none is: it
    ends where a word ends, has the length of its country, and passes mod-97."""
    words = F.split(proposal, " ")
    ends = F.transform(F.sequence(F.size(words), F.lit(1), F.lit(-1)), lambda count: F.slice(words, F.lit(1), count))

    def valid(part):
        plain = F.array_join(part, "")
        return F.when(plain.rlike(_IBAN_FORM), _mod_97(plain)).otherwise(False)

    return F.array_join(F.get(F.filter(ends, valid), F.lit(0)), " ")


def _running(lengths, index):
    """Sum of the first ``index`` of ``lengths``, from sums of whole blocks and a rest."""
    whole = F.floor(index / _BLOCK).cast("int")
    blocks, single = lengths["blocks"], lengths["single"]
    add = lambda total, value: total + value
    before = F.aggregate(F.slice(blocks, F.lit(1), whole), F.lit(0), add)
    return before + F.aggregate(F.slice(single, whole * _BLOCK + 1, index - whole * _BLOCK), F.lit(0), add)


def _with_sums(lengths):
    """``lengths`` with the sums of its blocks."""
    count = F.ceil(F.size(lengths) / _BLOCK).cast("int")
    numbers = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    add = lambda total, value: total + value
    blocks = F.transform(numbers, lambda k: F.aggregate(F.slice(lengths, k * _BLOCK + 1, F.lit(_BLOCK)), F.lit(0), add))
    return F.struct(lengths.alias("single"), blocks.alias("blocks"))


def _spans(frame, place, text, names):
    """Adds the valid spans of one kind: array of (kind, start, end, score)."""
    kind, needed, pattern = PATTERNS[place]
    found, pieces, sums, spans = (names(f"{kind}_{part}") for part in ("found", "pieces", "sums", "spans"))
    pattern = F.lit(pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    none = F.array().cast("array<string>")
    frame = frame.withColumn(found, F.when(F.contains(text, F.lit(needed)), matches).otherwise(none) if needed else matches)
    frame = frame.withColumn(pieces, F.when(F.size(found) > 0, F.split(text, pattern, F.lit(-1))).otherwise(none))
    both = F.zip_with(F.slice(F.col(pieces), F.lit(1), F.size(found)), F.col(found), lambda piece, match: F.length(piece) + F.length(match))
    frame = frame.withColumn(sums, _with_sums(both))
    indexes = F.when(F.size(found) > 0, F.sequence(F.lit(1), F.size(found))).otherwise(F.array().cast("array<int>"))
    words = rf"(?i)\b(?:{CONTEXT_WORDS[kind]})\b"

    def span(index):
        match = F.element_at(F.col(found), index)
        end = _running(F.col(sums), index)
        near = F.right(F.element_at(F.col(pieces), index), F.lit(CONTEXT_CHARACTERS)).rlike(words)
        near = near | F.left(F.element_at(F.col(pieces), index + 1), F.lit(CONTEXT_CHARACTERS)).rlike(words)
        score = F.lit(SCORES[kind]) + F.when(near, CONTEXT_SCORE).otherwise(0.0)
        return F.struct(
            F.lit(kind).alias("kind"), (end - F.length(match)).alias("start"), end.alias("end"), F.round(score, 2).alias("score")
        )

    confirmed = F.filter(indexes, lambda index: _is_valid(kind, F.element_at(F.col(found), index)))
    return frame.withColumn(spans, F.transform(confirmed, span)).drop(found, pieces, sums), spans


def _account_spans(frame, text, names):
    """Adds the account numbers, as ``_spans``. Every head proposes one; of those that
    overlap the first counts."""
    kind, _, pattern = PATTERNS[-1]
    found, proposed, windows, pieces, before, sums, valid, spans = (names(f"{kind}_{part}") for part in ("found", "proposed", "windows", "pieces", "before", "sums", "valid", "spans"))
    pattern = F.lit(pattern)
    none = F.array().cast("array<string>")
    frame = frame.withColumn(found, F.regexp_extract_all(text, pattern, F.lit(0)))
    some = F.size(found) > 0
    for name, group in ((proposed, 1), (windows, 2)):
        frame = frame.withColumn(name, F.when(some, F.regexp_extract_all(text, pattern, F.lit(group))).otherwise(none))
    frame = frame.withColumn(proposed, F.transform(proposed, _account))
    frame = frame.withColumn(pieces, F.when(some, F.split(text, pattern, F.lit(-1))).otherwise(none))
    own = F.slice(F.col(pieces), F.lit(1), F.size(found))
    frame = frame.withColumn(sums, _with_sums(F.zip_with(own, F.col(found), lambda piece, head: F.length(piece) + F.length(head))))
    frame = frame.withColumn(before, F.zip_with(own, F.col(found), lambda piece, head: F.concat(F.right(piece, F.lit(CONTEXT_CHARACTERS)), head)))
    indexes = F.when(some, F.sequence(F.lit(1), F.size(found))).otherwise(F.array().cast("array<int>"))
    words = rf"(?i)\b(?:{CONTEXT_WORDS[kind]})\b"
    heads = CONTEXT_CHARACTERS // 4  # so many that the context cannot reach further back

    def span(index):
        account = F.element_at(F.col(proposed), index)
        start = _running(F.col(sums), index) - F.length(F.element_at(F.col(found), index))
        earlier = F.array_join(F.slice(F.col(before), F.greatest(index - heads, F.lit(1)), F.least(index - 1, F.lit(heads))), "")
        earlier = F.right(F.concat(earlier, F.element_at(F.col(pieces), index)), F.lit(CONTEXT_CHARACTERS))
        later = F.substring(F.element_at(F.col(windows), index), F.length(account) + 1, F.lit(CONTEXT_CHARACTERS))
        score = F.lit(SCORES[kind]) + F.when(earlier.rlike(words) | later.rlike(words), CONTEXT_SCORE).otherwise(0.0)
        return F.struct(F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(account)).alias("end"), F.round(score, 2).alias("score"))

    confirmed = F.filter(indexes, lambda index: F.element_at(F.col(proposed), index).isNotNull())
    frame = frame.withColumn(valid, F.transform(confirmed, span))
    first = F.slice(F.col(valid), F.lit(1), F.lit(1))

    def take(taken, one):
        return F.when(one["start"] >= F.element_at(taken, -1)["end"], F.concat(taken, F.array(one))).otherwise(taken)

    apart = F.aggregate(F.slice(F.col(valid), F.lit(2), F.greatest(F.size(valid) - 1, F.lit(0))), first, take)
    frame = frame.withColumn(spans, F.when(F.size(valid) > 1, apart).otherwise(F.col(valid)))
    return frame.drop(found, proposed, windows, pieces, before, sums, valid), spans


def find_personal_data(docs, text="text"):
    """Adds ``pii``, an array of (kind, start, end, score), to every row of ``docs``.

    Kinds come in the order of ``PATTERNS``, spans of a kind by start. A null or empty text
    has none. All other columns stay, whatever their names; repeated rows stay repeated, an
    empty table stays empty.
    """
    taken = {name.lower() for name in docs.columns}

    def names(wish):
        while wish.lower() in taken:
            wish += "_"
        taken.add(wish.lower())
        return wish

    body = names("pii_text")
    frame = docs.withColumn(body, F.coalesce(F.col(text), F.lit("")))
    parts = []
    for place, (kind, _, _) in enumerate(PATTERNS):
        frame, spans = _account_spans(frame, F.col(body), names) if kind == "iban" else _spans(frame, place, F.col(body), names)
        parts.append(spans)
    # no name of the table is overwritten: an older pii column keeps its name
    result = "pii" if "pii" not in {name.lower() for name in docs.columns} else names("pii")
    return frame.withColumn(result, F.concat(*parts)).drop(body, *parts)


def redact(docs, text="text"):
    """``docs`` with each span replaced by its kind in angle brackets; overlapping spans
    are replaced by the first of them."""
    found = find_personal_data(docs, text)
    spans = F.array_sort(F.col(found.columns[-1]), lambda a, b: F.when(a["start"] != b["start"], a["start"] - b["start"]).otherwise(b["end"] - a["end"]))
    start = F.struct(F.lit("").alias("done"), F.lit(0).alias("at"))
    body = F.coalesce(F.col(text), F.lit(""))

    def step(state, span):
        done = F.concat(state["done"], F.substring(body, state["at"] + 1, span["start"] - state["at"]), F.lit("<"), span["kind"], F.lit(">"))
        return F.when(span["start"] >= state["at"], F.struct(done.alias("done"), span["end"].alias("at"))).otherwise(state)

    state = F.aggregate(spans, start, step)
    clean = F.concat(state["done"], F.substring(body, state["at"] + 1, F.length(body)))
    return found.withColumn(text, F.when(F.col(text).isNotNull(), clean)).select(*docs.columns)


def digest(found, spans="pii"):
    """doc_id, counts per base kind, hash of the base spans, and all spans as text."""

    def written(items):
        return F.array_join(F.transform(items, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE_KINDS]
    base = F.filter(spans, lambda s: s["kind"].isin(BASE_KINDS))
    scores = F.transform(spans, lambda s: s["score"]).alias("scores")
    return found.select("doc_id", *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col(spans)).alias("spans"), scores)
