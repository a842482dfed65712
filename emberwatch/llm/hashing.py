"""Hashes of words and byte strings over Arrow columns, in numpy.

A hash of any span comes from differences of two prefix sums of ``code(byte) * base**place``:
one modulo 2**64, one modulo the prime 2**31 - 1. The first alone is not enough: modulo a
power of two, some texts of 1,024 bytes and more agree for every base. Texts are worked on
in slices of about ``SLICE`` bytes, so memory does not depend on the length of a text or of
a batch; only the word hashes of one text are held whole.
"""

import numpy as np

SLICE = 1 << 18
BASE = 0x9E3779B97F4A7C15
_BASE_INVERSE = pow(BASE, -1, 1 << 64)
PRIME = (1 << 31) - 1
#: A primitive root: 7 is one, and the exponent shares no factor with PRIME - 1.
ROOT = pow(7, 1_000_003, PRIME)
#: Spans of fewer bytes are safe with the first sum alone: known texts that agree need far longer ones.
SHORT = 64
#: Bytes whose terms (40 bits each) add up without an overflow.
_SUMMED = 1 << 23
_SPACES = np.zeros(256, bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True


def mix(values):
    """A bijection of 64 bits that spreads every bit."""
    values = np.asarray(values, np.uint64)
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


#: Everything but letters, digits and bytes beyond ASCII: what separates terms.
BETWEEN_TERMS = np.array([not (chr(byte).isalnum() or byte > 127) for byte in range(256)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Codes of bytes for both sums, as they are and with A-Z in lower case.
CODES = (mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)), np.arange(1, 257, dtype=np.uint64))
LOWER_CODES = tuple(codes[LOWER] for codes in CODES)

_powers = [np.ones(0, np.uint64)] * 4


def _powers_of(base, size):
    steps = np.full(size, base, np.uint64)
    steps[0] = 1
    return np.cumprod(steps, dtype=np.uint64)


def _residues_of(base, size):
    powers = np.ones(1, np.uint64)
    while len(powers) < size:
        powers = np.concatenate([powers, powers * np.uint64(pow(base, len(powers), PRIME)) % np.uint64(PRIME)])
    return powers[:size]


def _power_tables(length):
    """Powers of the base and its inverse, then of the root and its inverse."""
    if len(_powers[0]) < length:
        size = max(length, SLICE + 4096)
        _powers[:2] = [_powers_of(base, size) for base in (BASE, _BASE_INVERSE)]
        _powers[2:] = [_residues_of(base, size) for base in (ROOT, pow(ROOT, -1, PRIME))]
    return _powers


def prefix_sums(data, codes=CODES):
    """Both sums before each byte and after the last one."""
    powers, _, residues, _ = _power_tables(len(data) + 1)
    sums, rests = np.zeros((2, len(data) + 1), np.uint64)
    np.cumsum(codes[0][data] * powers[: len(data)], dtype=np.uint64, out=sums[1:])
    for low in range(0, len(data), _SUMMED):
        high = min(low + _SUMMED, len(data))
        np.cumsum(codes[1][data[low:high]] * residues[low:high], dtype=np.uint64, out=rests[low + 1 : high + 1])
        rests[low + 1 : high + 1] += rests[low] % np.uint64(PRIME)
    return sums, rests


def short_span_hashes(sums, starts, ends):
    """One hash for each span, from the first sum alone: for spans of far below 1,024 bytes."""
    _, inverse, _, _ = _power_tables(len(sums[0]))
    return mix((sums[0][ends] - sums[0][starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def span_hashes(sums, starts, ends):
    """One hash for each span of bytes, independent of where it stands."""
    prime, rests = np.uint64(PRIME), sums[1]
    inverse = _power_tables(len(rests))[3]
    rest = (rests[ends] % prime + prime - rests[starts] % prime) % prime * inverse[starts] % prime
    return mix(short_span_hashes(sums, starts, ends) ^ mix(rest))


def column_bytes(column):
    """Bytes of a text column (null: empty) and the offsets of its rows."""
    column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    if data is None or offsets[0] == offsets[-1]:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_slices(offsets, size=SLICE):
    """Ranges of rows of about ``size`` bytes; a longer row stands alone."""
    first, rows = 0, len(offsets) - 1
    while first < rows:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), rows)
        yield first, last
        first = last


def _wide(data):
    """Starts and lengths of characters that are terms of their own, and whether they are
    punctuation: all of three bytes and more but Latin and Greek letters. That holds the
    scripts that put no spaces between words."""
    at = np.flatnonzero(data >= 0xE0)
    lead, second = data[at].astype(np.int64), data[np.minimum(at + 1, max(len(data) - 1, 0))].astype(np.int64)
    third = data[np.minimum(at + 2, max(len(data) - 1, 0))].astype(np.int64)
    point = np.where(lead < 0xF0, (lead & 15) << 12 | (second & 63) << 6 | third & 63, 0x10000)
    letter = (point >= 0x1E00) & (point <= 0x1FFF)
    at, lead, point = at[~letter], lead[~letter], point[~letter]
    mark = (point >= 0x2000) & (point <= 0x206F) | (point >= 0x3000) & (point <= 0x3003) | (point >= 0x3008) & (point <= 0x3020) | (point == 0x30FB)
    mark |= (point >= 0xFF01) & (point <= 0xFF0F) | (point >= 0xFF1A) & (point <= 0xFF20) | (point >= 0xFF3B) & (point <= 0xFF40) | (point >= 0xFF5B) & (point <= 0xFF65)
    return at, np.where(lead < 0xF0, 3, 4), mark


def _word_bounds(data, row_starts, between, characters=False):
    inside = ~between[data]
    cut = np.zeros(len(data) + 1, bool)
    if characters:
        at, size, mark = _wide(data)
        cut[at] = cut[at + size] = True
        for place in range(4):
            inside[at[mark & (size > place)] + place] = False
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    before[row_starts[row_starts < len(data)]] = False
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    ends = row_starts[(row_starts > 0) & (row_starts <= len(data))]
    after[ends - 1] = False
    before &= ~cut[:-1]
    after &= ~cut[1:]
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def word_spans(data, offsets, terms=False, characters=False):
    """Starts and ends of all words; with ``terms``, punctuation separates words too, with
    ``characters`` those of scripts without spaces are words of their own."""
    return _word_bounds(data, offsets, BETWEEN_TERMS if terms else _SPACES, characters)


def _cuts(starts, ends, length, size):
    """Ranges of words whose bytes fit into slices."""
    first = 0
    while first < len(starts):
        last = int(np.searchsorted(ends, starts[first] + size, "right"))
        last = max(last, first + 1)
        yield first, last
        first = last


def word_hashes(data, starts, ends, codes=LOWER_CODES):
    """Hashes of words, by default with A-Z in lower case."""
    hashes = np.empty(len(starts), np.uint64)
    for first, last in _cuts(starts, ends, len(data), SLICE):
        low = starts[first]
        sums = prefix_sums(data[low : ends[last - 1]], codes)
        hashes[first:last] = span_hashes(sums, starts[first:last] - low, ends[first:last] - low)
    return hashes


def quick_word_hashes(data, starts, ends, codes=LOWER_CODES):
    """Like ``word_hashes``, with other values: words below ``SHORT`` bytes need one sum only."""
    hashes = np.empty(len(starts), np.uint64)
    for first, last in _cuts(starts, ends, len(data), SLICE):
        low = starts[first]
        part = data[low : ends[last - 1]]
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(codes[0][part] * _power_tables(len(part) + 1)[0][: len(part)], dtype=np.uint64, out=sums[1:])
        hashes[first:last] = short_span_hashes((sums,), starts[first:last] - low, ends[first:last] - low)
    long = np.flatnonzero(ends - starts >= SHORT)
    if len(long):
        hashes[long] = word_hashes(data, starts[long], ends[long], codes)
    return hashes


def texts_of_words(column, terms=False, size=SLICE, characters=False, hashed=word_hashes):
    """For slices of rows: first row, row count, word hashes, offsets of the rows into them."""
    data, offsets = column_bytes(column)
    for first, last in row_slices(offsets, size):
        low, high = offsets[first], offsets[last]
        part = data[low:high]
        starts, ends = word_spans(part, offsets[first : last + 1] - low, terms, characters)
        bounds = np.searchsorted(starts, offsets[first : last + 1] - low)
        yield first, last - first, hashed(part, starts, ends), bounds


def signed(values):
    return np.ascontiguousarray(values, np.uint64).view(np.int64)
