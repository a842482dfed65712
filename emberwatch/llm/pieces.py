"""SentencePiece encoding with byte offsets, and decoding.

A model file holds pieces with scores and a compiled character map: a double array of
normalisation rules, of which the longest that a place of the text starts with applies.
Normalising keeps an ``Alignment``: runs of the normalised bytes with the source byte at which
each begins. Merging then works on words, since no piece goes on behind a space, so a word's
pieces depend on the word alone and are remembered. Lengths of pieces add up to places in the
normalised text, and alignments carry them back to bytes of the original.

The model is a parameter. Its bytes (at most ``MODEL_BYTES``) travel to the tasks with the
function; nothing is read from an executor's disk.
"""

import codecs
import math
import re
import struct
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa

MODEL_BYTES = 64 << 20
#: Words that a task remembers; when it has met as many others since, the older ones go.
REMEMBERED = 200_000
#: Characters of a word up to which it is remembered and merged by scanning.
SHORT = 48
#: Bytes of text after which a task hands on what it has.
SLICE = 1 << 21
SPACE = "▁"

# Fixed values of the file format: kinds of pieces and the model type that is read here.
NORMAL, UNKNOWN, CONTROL, BYTE, BPE = 1, 2, 3, 6, 2


def _fields(data):
    """Number and value of each field of a protocol buffer message."""
    at = 0

    def number():
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(key & 7)
            size = number() if size is None else size
            yield key >> 3, data[at : at + size]
            at += size


def _merged(messages):
    """The last value of each field over parts of one message."""
    return dict(field for message in messages for field in _fields(message))


class Alignment:
    """Where places of a derived text come from: ``starts`` of runs and their ``sources``.

    Inside a run places go along with the source, inside a ``flat`` one all come from its
    beginning. The last run is the end of both texts.
    """

    def __init__(self, starts, sources, flat):
        self.starts, self.sources, self.flat = starts, sources, flat

    def project(self, places):
        run = np.searchsorted(self.starts, places, "right") - 1
        return self.sources[run] + np.where(self.flat[run], 0, places - self.starts[run])


class CharacterMap:
    """Normalisation rules in a double array, as model files hold them."""

    def __init__(self, blob):
        size = struct.unpack_from("<I", blob)[0]
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).astype(np.int64)
        self.values = bytes(blob[4 + size :])
        keys = self._keys()
        singles = {key for key in keys if len(key) == 1}
        longer = {}
        for key in keys:
            if len(key) > 1 and key[0] not in singles:
                longer.setdefault(key[1], set()).add(key[0])
        # a rule can only begin where this matches; whether one does, the double array says
        seconds = {}
        for second, firsts in longer.items():
            seconds.setdefault(frozenset(firsts), []).append(second)
        options = [_class(firsts) + "(?=" + _class(following) + ")" for firsts, following in seconds.items()]
        self.begins = re.compile("|".join(([_class(singles)] if singles else []) + options) or "(?!)")

    def _offset(self, unit):
        return (unit >> 10) << ((unit & 512) >> 6)

    def _keys(self):
        """All texts that have a rule."""
        found, labels = [], np.arange(256)
        below = [(self._offset(int(self.units[0])), b"")]
        known = self.units & 0x800000FF
        while below:
            base, key = below.pop()
            places = base ^ labels
            places = np.where(places < len(self.units), places, 0)
            for label in np.flatnonzero((known[places] == labels) & (labels > 0)).tolist():
                unit = int(self.units[base ^ label])
                own = key + bytes([label])
                if unit >> 8 & 1:
                    found.append(own)
                below.append((base ^ label ^ self._offset(unit), own))
        return [key.decode() for key in found]

    def longest(self, data, at):
        """Length and replacement of the longest rule that ``data`` has at ``at``, or None."""
        node, best = self._offset(int(self.units[0])), None
        for place in range(at, len(data)):
            node ^= data[place]
            if node >= len(self.units) or int(self.units[node]) & 0x800000FF != data[place]:
                break
            unit = int(self.units[node])
            node ^= self._offset(unit)
            if unit >> 8 & 1:
                best = place + 1 - at, int(self.units[node]) & 0x7FFFFFFF
        if best is None:
            return None
        return best[0], self.values[best[1] : self.values.index(b"\0", best[1])]

    def normalise(self, text):
        """The text with all rules applied from left to right, and its alignment."""
        data, parts, runs = text.encode(), [], []
        done, made, behind, behind_bytes = 0, 0, 0, 0

        def put(part, source, flat):
            nonlocal made
            if part:
                parts.append(part)
                runs.append((made, source, flat))
                made += len(part)

        for match in self.begins.finditer(text):
            behind_bytes += len(text[behind : match.start()].encode())
            behind = match.start()
            if behind_bytes < done:
                continue
            rule = self.longest(data, behind_bytes)
            if rule:
                put(data[done:behind_bytes], done, False)
                put(rule[1], behind_bytes, True)
                done = behind_bytes + rule[0]
        put(data[done:], done, False)
        runs.append((made, len(data), True))
        starts, sources, flat = (np.array(column) for column in zip(*runs, strict=True))
        return b"".join(parts).decode(), Alignment(starts, sources, flat.astype(bool))


def _class(characters):
    return "[" + "".join(re.escape(c) for c in sorted(characters)) + "]"


def mark_spaces(text, prefix, collapse):
    """The text with its spaces as ``SPACE`` and its alignment.

    ``prefix`` puts one in front, ``collapse`` leaves none at the ends and one of each run.
    """
    data = np.frombuffer(text.encode(), np.uint8)
    if collapse:
        low = len(text) - len(text.lstrip(" "))
        inner = text[low:].rstrip(" " + SPACE)
        low = low if inner else len(data)
        marked = re.sub(" +", SPACE, inner)
        high = low + len(inner.encode())
    else:
        marked, low, high = text.replace(" ", SPACE), 0, len(data)
    if low == high:
        # nothing but spaces, of which nothing stays
        return "", Alignment(np.zeros(1, np.int64), np.full(1, low), np.ones(1, bool))
    part = data[low:high]
    at = np.flatnonzero(part == 32)
    firsts, afters = at, at + 1
    if collapse and len(at):
        apart = at[1:] > at[:-1] + 1
        firsts, afters = at[np.append(True, apart)], at[np.append(apart, True)] + 1
    # a space, and what stands behind it, begins a run of its own
    gone = np.arange(len(firsts)) * 2 - (np.cumsum(afters - firsts - 1) - (afters - firsts - 1))
    shift = 3 if prefix else 0
    starts = np.empty(2 * len(firsts) + 2, np.int64)
    sources = np.empty_like(starts)
    flat = np.zeros(len(starts), bool)
    starts[0], sources[0] = shift, low
    starts[1:-1:2], sources[1:-1:2] = firsts + gone + shift, firsts + low
    starts[2:-1:2], sources[2:-1:2] = firsts + gone + shift + 3, afters + low
    starts[-1], sources[-1] = shift + len(marked.encode()), high
    flat[1:-1:2] = flat[-1] = True
    if prefix:
        marked = SPACE + marked
        starts, sources, flat = np.append(0, starts), np.append(low, sources), np.append(True, flat)
    return marked, Alignment(starts, sources, flat)


class PieceModel:
    """What a model file of the kind BPE with byte fallback says.

    Models of other kinds, with unused or user-defined pieces or with spaces as suffixes, are
    refused with a ValueError.
    """

    def __init__(self, data):
        if len(data) > MODEL_BYTES:
            raise ValueError(f"a model of {len(data)} bytes; at most {MODEL_BYTES}")
        parts = {}
        for field, value in _fields(data):
            parts.setdefault(field, []).append(value)
        trainer, spec = _merged(parts.get(2, [])), _merged(parts.get(3, []))
        self.prefix, self.collapse = bool(spec.get(3, 1)), bool(spec.get(4, 1))
        charmap = spec.get(2, b"")
        self.charmap = CharacterMap(charmap) if charmap else None
        self.names, self.kinds, self.scores, self.ids = [], [], {}, {}
        for number, entry in enumerate(map(dict, map(_fields, parts.get(1, [])))):
            name, kind = entry.get(1, b"").decode(), entry.get(3, NORMAL)
            self.names.append(name)
            self.kinds.append(kind)
            if kind == NORMAL:
                self.scores[name] = struct.unpack("<f", entry.get(2, bytes(4)))[0]
                self.ids.setdefault(name, number)
        marked = any(SPACE in name.lstrip(SPACE) for name in self.scores)
        if trainer.get(3) != BPE or not trainer.get(35) or trainer.get(24) or not spec.get(5, 1) or parts.get(5) or marked:
            raise ValueError("only BPE with byte fallback and spaces in front of pieces is supported")
        if set(self.kinds) - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("models with unused or user-defined pieces are not supported")
        self.bytes = {int(name[1:-1], 16): number for number, name in enumerate(self.names) if self.kinds[number] == BYTE}
        self.begin = self.names.index(trainer.get(46, b"<s>").decode())
        self.end = self.names.index(trainer.get(47, b"</s>").decode())
        self.unknown = trainer.get(44, " ⁇ ".encode())
        # reserved names come before pieces of the same name
        self.reserved = {name: number for number, name in enumerate(self.names) if self.kinds[number] != NORMAL}
        self.pairs = {name[at : at + 2] for name in self.scores for at in range(len(name) - 1)}
        self.words = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.recent, self.earlier, self.packed, self.symbols = {}, {}, {}, None
        self.surfaces = [self._surface(number) for number in range(len(self.names))]

    # -- encoding

    def normalise(self, text):
        """The text as pieces are looked for in it, and the alignments back to its bytes."""
        alignments = []
        if self.charmap:
            text, alignment = self.charmap.normalise(text)
            alignments.append(alignment)
        if not text:
            return "", alignments
        text, alignment = mark_spaces(text, self.prefix, self.collapse)
        return text, [alignment, *alignments]

    def _tables(self):
        """Arrays for merging many words at once: ids of characters, sorted pairs of ids with
        the piece that they make, ranks of pieces (the best score first) and their lengths."""
        count = len(self.names)
        plain = {name: number for name, number in self.ids.items() if name not in self.reserved}
        self.symbols = np.full(0x110000, -1, np.int32)
        for name, number in plain.items():
            if len(name) == 1:
                self.symbols[ord(name)] = number
        made = [(plain[name[:at]] << 32 | plain[name[at:]], number) for name, number in plain.items() for at in range(1, len(name)) if name[:at] in plain and name[at:] in plain]
        self.keys, self.made = (np.array(column, np.int64) for column in zip(*sorted(made), strict=True)) if made else (np.zeros(1, np.int64) - 1, np.zeros(1, np.int64))
        scores = np.array([self.scores[name] for name in plain])
        levels = np.unique(-scores)
        self.ranks = np.full(count + 1, len(levels), np.int32)  # the last: a pair that makes nothing
        self.ranks[list(plain.values())] = np.searchsorted(levels, -scores)
        self.lengths = np.array([len(name.encode()) for name in self.names], "<u4")

    def encode(self, text):
        """Ids and the bytes of ``text`` each piece stands for, both as uint32."""
        return next(self.encode_all([text]))

    def encode_all(self, texts):
        """The same for each of some texts, whose new words are merged together."""
        marked = [self.normalise(text) for text in texts]
        words = [self.words.findall(text) for text, _ in marked]
        found = self._found({word for own in words for word in own if len(word) <= SHORT})
        for own, (_, alignments) in zip(words, marked, strict=True):
            pieces = [found[word] if len(word) <= SHORT else self._joined(self._merge_long(word)) for word in own]
            ids = np.frombuffer(b"".join([piece[0] for piece in pieces]), "<u4")
            places = np.zeros(len(ids) + 1, np.int64)
            np.cumsum(np.frombuffer(b"".join([piece[1] for piece in pieces]), "<u4"), out=places[1:])
            if len(ids):
                for alignment in alignments:
                    places = alignment.project(places)
            yield ids, np.stack([places[:-1], places[1:]], 1).astype("<u4")

    def _found(self, words):
        """Packed ids and lengths in bytes of the pieces of each word."""
        found, new = {}, []
        for word in words:
            own = self.recent.get(word) or self.earlier.get(word)
            if own is None:
                new.append(word)
            else:
                found[word] = own
        found.update(self._merge_many(new))
        if len(self.recent) >= REMEMBERED:
            self.earlier, self.recent = self.recent, {}
        self.recent.update(found)
        return found

    def _merge_many(self, words):
        """What ``_merge_short`` gives, for words side by side: those of one length form a
        matrix, of which every step joins one pair in each row."""
        if self.symbols is None:
            self._tables()
        sizes = np.array([len(word) for word in words], np.int64)
        symbols = self.symbols[np.frombuffer("".join(words).encode("utf-32-le"), "<u4")]
        starts = np.cumsum(sizes) - sizes
        for size in np.unique(sizes).tolist():
            rows = np.flatnonzero(sizes == size)
            matrix = symbols[starts[rows][:, None] + np.arange(size)]
            known = (matrix >= 0).all(1)
            for row in rows[~known].tolist():
                yield words[row], self._joined(self._merge_short(words[row]))
            for places, ids in self._merge_matrix(matrix[known], rows[known]):
                width = 4 * ids.shape[1]
                packed, lengths = ids.astype("<u4").tobytes(), self.lengths[ids].tobytes()
                for at, row in enumerate(places.tolist()):
                    yield words[row], (packed[at * width : at * width + width], lengths[at * width : at * width + width])

    def _pair(self, left, right):
        """The piece that two neighbours make, or the number of pieces if none."""
        key = left.astype(np.int64) << 32 | right
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.made[at], len(self.names))

    def _merge_matrix(self, symbols, rows):
        """Rows in which nothing is left to join, with their pieces."""
        made = self._pair(symbols[:, :-1], symbols[:, 1:])
        while len(rows):
            if made.shape[1] == 0:
                yield rows, symbols
                return
            ranks = self.ranks[made]
            at = ranks.argmin(1)  # the first of equals
            line = np.arange(len(rows))
            open_ones = ranks[line, at] < self.ranks[-1]
            if not open_ones.all():
                yield rows[~open_ones], symbols[~open_ones]
                rows, symbols, made, at = rows[open_ones], symbols[open_ones], made[open_ones], at[open_ones]
                line = line[: len(rows)]
            behind = np.arange(symbols.shape[1] - 1) > at[:, None]
            joined = made[line, at]
            symbols = np.where(behind, symbols[:, 1:], symbols[:, :-1])
            symbols[line, at] = joined
            made = np.where(behind[:, :-1], made[:, 1:], made[:, :-1])
            inner = np.flatnonzero(at < made.shape[1])
            made[inner, at[inner]] = self._pair(joined[inner], symbols[inner, at[inner] + 1])
            inner = np.flatnonzero(at > 0)
            made[inner, at[inner] - 1] = self._pair(symbols[inner, at[inner] - 1], joined[inner])

    def _joined(self, pieces):
        packed, missing = [], self.packed
        for piece in pieces:
            own = missing.get(piece)
            packed.append(self._packed(piece) if own is None else own)
        return b"".join([own[0] for own in packed]), b"".join([own[1] for own in packed])

    def _packed(self, piece):
        """Packed id and length of a piece, or of the bytes of a character that is none; the
        last byte then stands for the character. Remembered: pieces and characters are few."""
        number = self.reserved.get(piece, self.ids.get(piece))
        size = len(piece.encode())
        if number is None or self.kinds[number] == UNKNOWN:
            ids, sizes = [self.bytes[byte] for byte in piece.encode()], [0] * (size - 1) + [size]
        else:
            ids, sizes = [number], [size]
        self.packed[piece] = np.array(ids, "<u4").tobytes(), np.array(sizes, "<u4").tobytes()
        return self.packed[piece]

    def _merge_short(self, word):
        """Joins the neighbours of the best score, the first of equals, until none is a piece."""
        parts, score, none = list(word), self.scores.get, -math.inf
        gains = [score(word[at : at + 2], none) for at in range(len(word) - 1)]
        while gains:
            best = max(gains)
            if best == none:
                break
            at = gains.index(best)
            joined = parts[at] + parts.pop(at + 1)
            parts[at] = joined
            del gains[at]
            if at < len(gains):
                gains[at] = score(joined + parts[at + 1], none)
            if at:
                gains[at - 1] = score(parts[at - 1] + joined, none)
        return parts

    def _merge_long(self, word):
        """The same with a heap, part by part: no merge reaches over a pair in no piece."""
        low, pairs = 0, self.pairs
        for high in range(1, len(word) + 1):
            if high == len(word) or word[high - 1 : high + 1] not in pairs:
                yield from self._merge_heap(word[low:high])
                low = high

    def _merge_heap(self, word):
        scores, count = self.scores, len(word)
        ends, before = list(range(1, count + 1)), list(range(-1, count - 1))
        heap = []
        for at in range(count - 1):
            gain = scores.get(word[at : at + 2])
            if gain is not None:
                heap.append((-gain, at, at + 2))
        heapify(heap)
        alive = [True] * count
        while heap:
            _, left, end = heappop(heap)
            right = ends[left] if alive[left] else count
            if right >= count or ends[right] != end:
                continue
            alive[right] = False
            ends[left] = end
            if end < count:
                before[end] = left
                gain = scores.get(word[left : ends[end]])
                if gain is not None:
                    heappush(heap, (-gain, left, ends[end]))
            earlier = before[left]
            if earlier >= 0:
                gain = scores.get(word[earlier:end])
                if gain is not None:
                    heappush(heap, (-gain, earlier, end))
        at = 0
        while at < count:
            yield word[at : ends[at]]
            at = ends[at]

    # -- decoding

    def _surface(self, number):
        kind, name = self.kinds[number], self.names[number]
        if kind == CONTROL:
            return b""
        if kind == UNKNOWN:
            return self.unknown
        return bytes([int(name[1:-1], 16)]) if kind == BYTE else name.replace(SPACE, " ").encode()

    def decode(self, ids):
        """The text of ids. Bytes that are no character become U+FFFD each; the space in front
        of the first word goes. An id that the model lacks is an IndexError."""
        ids = ids.tolist()
        surfaces = [self.surfaces[number] for number in ids]
        if self.prefix or self.collapse:
            for place, number in enumerate(ids):
                kind = self.kinds[number]
                if kind == CONTROL:
                    continue
                if kind == NORMAL and surfaces[place].startswith(b" "):
                    surfaces[place] = surfaces[place][1:]
                    if self.collapse and not surfaces[place]:
                        continue
                break
        # bytes on both sides of a control piece make no character together
        text, low = [], 0
        for place in [at for at, number in enumerate(ids) if self.kinds[number] == CONTROL] + [len(ids)]:
            text.append(b"".join(surfaces[low:place]).decode("utf-8", "each-byte"))
            low = place + 1
        return "".join(text)


codecs.register_error("each-byte", lambda error: ("�" * (error.end - error.start), error.end))

_models = {}


def _model(data):
    """The model of a task; parsed once in each Python worker."""
    if data not in _models:
        _models.clear()
        _models[data] = PieceModel(data)
    return _models[data]


def _slices(batch, place):
    """Parts of a batch of about ``SLICE`` bytes in the column ``place``; a longer row alone."""
    sizes, low, filled = batch.column(place).nbytes, 0, 0
    if sizes <= SLICE:
        yield batch
        return
    for row, value in enumerate(batch.column(place)):
        size = len(value.as_buffer()) if value.is_valid else 0
        if filled and filled + size > SLICE:
            yield batch.slice(low, row - low)
            low, filled = row, 0
        filled += size
    yield batch.slice(low)


def _mapped(rows, column, added, drop, function):
    """``rows`` with the columns ``added`` (name, SQL type) that ``function`` makes of one
    column; columns of these names are replaced, and the source goes with ``drop``."""
    names = {name.lower() for name, _ in added} | ({column.lower()} if drop else set())
    kept = [name for name in rows.columns if name.lower() not in names]
    source = [field for field in rows.columns if field.lower() == column.lower()][0]
    narrow = rows.select(*[f"`{name}`" for name in kept], rows[f"`{source}`"].alias("source for pieces"))
    schema = ", ".join([f"`{name}` {rows.schema[name].dataType.simpleString()}" for name in kept] + [f"`{name}` {kind}" for name, kind in added])

    def run(batches):
        for whole in batches:
            for batch in _slices(whole, whole.num_columns - 1):
                made = function(batch.column(batch.num_columns - 1))
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], [*batch.schema.names[:-1], *[name for name, _ in added]])

    return narrow.mapInArrow(run, schema)


def encode(docs, model, text="text", ends=True, keep_text=True, read_back=False):
    """Adds ``ids`` and ``spans`` to every row of ``docs``, for the bytes ``model`` of a file.

    ``ids`` holds the piece ids as little-endian uint32, ``spans`` for each of them the first
    byte and the byte behind the last in the UTF-8 text, as two of these. ``unpacked`` gives
    arrays. With ``ends``, the ids of begin and end stand around, with empty spans. A null text
    is an empty one and has no other ids. With ``read_back``, ``decoded`` is what ``decode`` makes
    of the ids, in the same tasks. Columns of the added names are replaced. An empty
    table gives no rows; repeated rows are encoded one by one; texts of any length are encoded
    whole. A word without spaces and of n characters takes n log n steps.
    """
    PieceModel(model)  # refuses here what no task could encode

    def run(column):
        pieces = _model(model)
        ids, spans, decoded = [], [], []
        texts = [value or "" for value in column.to_pylist()]
        for written, (own, places) in zip(texts, pieces.encode_all(texts), strict=True):
            if ends:
                size = len(written.encode())
                own = np.concatenate([[pieces.begin], own, [pieces.end]]).astype("<u4")
                places = np.concatenate([[[0, 0]], places, [[size, size]]]).astype("<u4")
            ids.append(own.tobytes())
            spans.append(places.tobytes())
            if read_back:
                decoded.append(pieces.decode(own))
        made = [pa.array(ids, pa.binary()), pa.array(spans, pa.binary())]
        return [*made, pa.array(decoded, pa.string())] if read_back else made

    added = [("ids", "binary"), ("spans", "binary"), *([("decoded", "string")] if read_back else [])]
    return _mapped(docs, text, added, not keep_text, run)


def decode(rows, model, ids="ids", keep_ids=True):
    """Adds ``decoded``, the text of the packed ids, to every row; null ids give empty text.

    A column named decoded is replaced. Ids need not come from ``encode``.
    """

    def run(column):
        pieces = _model(model)
        return [pa.array([pieces.decode(np.frombuffer(value.as_buffer(), "<u4")) if value.is_valid else "" for value in column], pa.string())]

    return _mapped(rows, ids, [("decoded", "string")], not keep_ids, run)


def unpacked(packed):
    """The numbers of an ids or spans column of one row, as a list or a list of pairs."""
    return np.frombuffer(packed, "<u4").tolist()
