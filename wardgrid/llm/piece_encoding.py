"""SentencePiece encoding that keeps, for every piece, the bytes of the original text it stands for.

A text is normalised by the model's compiled character map: at each byte the longest prefix that the map's
double-array trie knows is replaced, everything else is kept, and each normalised byte records the original
byte it comes from.  White space is escaped and a leading space added as the model's settings say.  The
normalised text is cut where two bytes meet that are neighbours in no piece of the vocabulary: no merge can
span such a border, so each unit is merged alone, and equal units once per task.  Pieces are then laid over
the normalised bytes and projected back by the alignment.  Decoding spells the pieces and drops the space
that encoding added.

Each text is handled where it lies, in blocks of bounded size (a longer text is a block of its own), without
a shuffle; a lost executor's batches are encoded anew with the same result.

Defined results: NULL and empty texts have no pieces and decode to the empty text; bytes that are not UTF-8
read as U+FFFD each; characters the vocabulary lacks become byte pieces, or the unknown id in a model without
them; an own space of the text stays beside the added one; repeated rows are encoded alike; other columns
are ignored.  Models other than byte-pair ones, and models with user-defined or unused pieces, raise an error.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wardgrid.llm import textbytes

SPACE = 0x20  # stands for the escaped space inside this module
ESCAPED = "▁".encode()
BAD = "�".encode()
CACHE_BYTES = 32_000_000  # of units that a task remembers
SHORT = 24  # characters of a unit merged by plain search

# Fixed values of the model format: kinds of pieces, and the number of byte-pair models.
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6
BYTE_PAIR = 2


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = number()
        if key & 7 == 0:
            yield key >> 3, number()
        else:
            size = {1: 8, 5: 4}.get(key & 7) or number()
            yield key >> 3, message[at : at + size]
            at += size


class CharacterMap:
    """The compiled character map: a double-array trie over prefixes, and the texts that replace them."""

    def __init__(self, compiled: bytes) -> None:
        size = int.from_bytes(compiled[:4], "little") if compiled else 0
        self.trie = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if size else []
        self.texts = compiled[4 + size :]
        self.starts = np.zeros(256, bool)  # bytes that some prefix begins with
        if self.trie:
            root = self._children(self.trie[0])
            for byte in range(256):
                node = root ^ byte
                self.starts[byte] = node < len(self.trie) and self.trie[node] & 0x800000FF == byte

    @staticmethod
    def _children(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def longest(self, data: bytes, at: int) -> tuple[int, bytes] | None:
        """Length and replacement of the longest known prefix of ``data[at:]``."""
        node, found = self._children(self.trie[0]), None
        for k in range(at, len(data)):
            node ^= data[k]
            if node >= len(self.trie) or self.trie[node] & 0x800000FF != data[k]:
                break
            unit = self.trie[node]
            node ^= self._children(unit)
            if unit >> 8 & 1:
                found = (k + 1 - at, self.trie[node] & 0x7FFFFFFF)
        if found is None:
            return None
        return found[0], self.texts[found[1] : self.texts.index(0, found[1])]


class Model:
    """What encoding needs of a SentencePiece model file."""

    def __init__(self, path: str) -> None:
        with open(path, "rb") as file:
            whole = file.read()
        self.pieces: dict[str, tuple[int, float]] = {}
        self.unknown, self.bytes_of = 0, [-1] * 256
        spelled: list[bytes] = []
        spec: dict[int, int | bytes] = {}
        kind_of_model = 1
        for number, value in fields(whole):
            if number == 1:
                self._piece(len(spelled), dict(fields(value)), spelled)
            elif number == 2:
                kind_of_model = dict(fields(value)).get(3, 1)
            elif number == 3:
                spec = dict(fields(value))
        if kind_of_model != BYTE_PAIR:
            raise ValueError("only byte-pair models are supported")
        self.map = CharacterMap(spec.get(2, b""))
        self.dummy_prefix, self.squeeze, self.escape = (bool(spec.get(k, 1)) for k in (3, 4, 5))
        self.sizes = np.array([len(s) for s in spelled], np.int64)
        self.first = np.cumsum(self.sizes) - self.sizes
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        # Byte pairs that are neighbours inside some piece: borders between all others are never merged over.
        self.neighbours = np.zeros((256, 256), bool)
        for piece in self.pieces:
            inner = np.frombuffer(self._inner(piece), np.uint8)
            self.neighbours[inner[:-1], inner[1:]] = True
        self.scores = {piece.replace("▁", " "): score for piece, (_, score) in self.pieces.items()}
        self.ids = {piece.replace("▁", " "): k for piece, (k, _) in self.pieces.items()}

    def _piece(self, k: int, piece: dict, spelled: list[bytes]) -> None:
        text, kind = piece[1].decode(), piece.get(3, NORMAL)
        score = float(np.frombuffer(piece.get(2, b"\0\0\0\0"), "<f4")[0])
        if kind == BYTE:
            self.bytes_of[int(text[3:5], 16)] = k
            spelled.append(bytes([int(text[3:5], 16)]))
        elif kind == NORMAL:
            self.pieces[text] = (k, score)
            spelled.append(self._inner(text))
        elif kind in (UNKNOWN, CONTROL):
            self.unknown = k if kind == UNKNOWN else self.unknown
            spelled.append(" ⁇ ".encode() if kind == UNKNOWN else b"")
        else:
            raise ValueError("user-defined and unused pieces are not supported")

    @staticmethod
    def _inner(text: str) -> bytes:
        return text.replace("▁", " ").encode()

    def merge(self, unit: str) -> list[str]:
        """The symbols left when no two neighbours form a piece: best score first, then leftmost."""
        parts, scores = list(unit), self.scores
        if len(parts) > SHORT:
            return self._merge_long(parts)
        while len(parts) > 1:
            best, where = None, -1
            for k in range(len(parts) - 1):
                score = scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, where = score, k
            if best is None:
                break
            parts[where : where + 2] = [parts[where] + parts[where + 1]]
        return parts

    def _merge_long(self, parts: list[str | None]) -> list[str]:
        scores, n = self.scores, len(parts)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[float, int, str, int]] = []

        def offer(left: int) -> None:
            right = after[left] if left >= 0 else -1
            if right >= 0:
                both = parts[left] + parts[right]
                if both in scores:
                    heapq.heappush(agenda, (-scores[both], left, both, right))

        for k in range(n):
            offer(k)
        while agenda:
            _, left, both, right = heapq.heappop(agenda)
            if parts[left] is None or parts[right] is None or after[left] != right or len(parts[left]) + len(parts[right]) != len(both):
                continue
            parts[left], parts[right] = both, None
            after[left] = after[right]
            if after[left] >= 0:
                before[after[left]] = left
            offer(before[left])
            offer(left)
        return [p for p in parts if p is not None]

    def unit(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a unit and the normalised bytes each covers: byte pieces but the last of a character cover none."""
        ids, sizes, unknown = [], [], False
        for part in self.merge(data.decode()):
            own = self.ids.get(part)
            raw = part.encode()
            if own is not None:
                ids.append(own)
                sizes.append(len(raw))
            elif self.bytes_of[0] >= 0:
                spelled = ESCAPED if part == " " else raw
                ids += [self.bytes_of[b] for b in spelled]
                sizes += [0] * (len(spelled) - 1) + [len(raw)]
            elif unknown:
                sizes[-1] += len(raw)
            else:
                ids.append(self.unknown)
                sizes.append(len(raw))
            unknown = own is None
        return np.array(ids, np.int32), np.array(sizes, np.int32)


def replacements(data: bytes, bounds: np.ndarray, chars: CharacterMap) -> list[tuple[int, int, bytes]]:
    """(start, length, new bytes) of all that changes, in order, each inside one text."""
    bad: list[int] = []

    def note(error: UnicodeDecodeError) -> tuple[str, int]:
        bad.append(error.start)
        return "�", error.start + 1

    codecs.register_error("wardgrid.note", note)
    data.decode(errors="wardgrid.note")
    out = [(at, 1, BAD) for at in bad]
    if chars.trie:
        marked = np.frombuffer(data, np.uint8)
        places = np.flatnonzero(chars.starts[marked])
        ends = bounds[np.searchsorted(bounds, places, side="right")]
        done = 0
        for at, end in zip(places.tolist(), ends.tolist(), strict=True):
            found = chars.longest(data[at : min(end, at + 1024)], 0) if at >= done else None
            if found is not None:
                out.append((at, *found))
                done = at + found[0]
    # The map's longest prefix wins over what else is noted inside it.
    kept, done = [], 0
    for start, size, new in sorted(out, key=lambda r: (r[0], -r[1])):
        if start >= done:
            kept.append((start, size, new))
            done = start + size
    return kept


def normalised(data: np.ndarray, bounds: np.ndarray, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Normalised bytes, the original start and end of each, and the borders of the texts."""
    raw = data.tobytes()
    changes = replacements(raw, bounds, model.map)
    src, stop, out = np.arange(len(data)), np.arange(1, len(data) + 1), data
    if changes:
        whole, first, last, at = [], [], [], 0
        for start, size, new in changes:
            whole += [raw[at:start], new]
            first += [src[at:start], np.full(len(new), start)]
            last += [stop[at:start], np.full(len(new), start + size)]
            at = start + size
        out = np.frombuffer(b"".join([*whole, raw[at:]]), np.uint8)
        src, stop = np.concatenate([*first, src[at:]]), np.concatenate([*last, stop[at:]])
    cuts = np.searchsorted(src, bounds)
    if model.squeeze:
        out, src, stop, cuts = _kept(_squeezed(out, cuts), out, src, stop, cuts)
    # An escaped space, the text's own ones too, is one byte from here on.
    mark = out.tobytes()
    if (at := mark.find(ESCAPED)) >= 0:
        out, stop, keep = out.copy(), stop.copy(), np.ones(len(out), bool)
        while at >= 0:
            out[at], stop[at] = SPACE, stop[at + 2]
            keep[at + 1 : at + 3] = False
            at = mark.find(ESCAPED, at + 3)
        out, src, stop, cuts = _kept(keep, out, src, stop, cuts)
        if model.squeeze:  # at the end of a text its own escaped spaces go too
            solid = np.flatnonzero(out != SPACE)
            text = np.searchsorted(cuts, np.arange(len(out)), side="right") - 1
            keep = np.searchsorted(solid, np.arange(len(out))) < np.searchsorted(solid, cuts)[text + 1]
            out, src, stop, cuts = _kept(keep, out, src, stop, cuts)
    if model.dummy_prefix:
        filled = np.flatnonzero(np.diff(cuts) > 0)
        at = cuts[filled]
        begin = src[at]
        out, src, stop = np.insert(out, at, SPACE), np.insert(src, at, begin), np.insert(stop, at, begin)
        cuts = cuts + np.concatenate(([0], np.cumsum(np.diff(cuts) > 0)))
    return out, src, stop, cuts


def _kept(keep: np.ndarray, out: np.ndarray, src: np.ndarray, stop: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, ...]:
    return out[keep], src[keep], stop[keep], np.concatenate(([0], np.cumsum(keep)))[cuts]


def _squeezed(out: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Which bytes stay when runs of spaces become one and those at the ends of a text go."""
    space = out == SPACE
    keep = ~space
    keep[1:] |= space[1:] & ~space[:-1]
    solid = np.flatnonzero(~space)
    text = np.searchsorted(cuts, np.arange(len(out)), side="right") - 1
    place = np.searchsorted(solid, np.arange(len(out)))
    inside = (place > np.searchsorted(solid, cuts)[text]) & (place < np.searchsorted(solid, cuts)[text + 1])
    return keep & (inside | ~space)


class Encoder:
    """Encodes blocks of texts and remembers the units it has seen."""

    def __init__(self, path: str) -> None:
        self.model, self.known, self.held = Model(path), {}, 0

    def block(self, data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Ids, their first and end byte in ``data``, and the borders of the texts among them."""
        model = self.model
        out, src, stop, cuts = normalised(data, bounds, model)
        none = np.zeros(0, np.int64)
        if not len(out):
            return none.astype(np.int32), none, none, np.zeros(len(bounds), np.int64)
        border = np.zeros(len(out), bool)
        border[1:] = ~model.neighbours[out[:-1], out[1:]] & (out[1:] & 0xC0 != 0x80)
        border[cuts[:-1][np.diff(cuts) > 0]] = True
        starts = np.flatnonzero(border)
        ends = np.append(starts[1:], len(out))
        _, example, which = np.unique(textbytes.hash_spans(out, starts, ends), return_index=True, return_inverse=True)
        raw = out.tobytes()
        found = [self._unit(raw[s:e]) for s, e in zip(starts[example].tolist(), ends[example].tolist(), strict=True)]
        sizes = np.array([len(ids) for ids, _ in found])
        first = np.cumsum(sizes) - sizes
        counts = sizes[which]
        before = np.concatenate(([0], np.cumsum(counts)))
        take = np.arange(before[-1]) + np.repeat(first[which] - before[:-1], counts)
        ids = np.concatenate([ids for ids, _ in found])[take]
        covered = np.concatenate([widths for _, widths in found])[take]
        edge = np.concatenate(([0], np.cumsum(covered)))
        begin = src[np.minimum(edge[:-1], len(src) - 1)]
        return ids, begin, np.where(covered > 0, stop[np.maximum(edge[1:], 1) - 1], begin), before[np.searchsorted(starts, cuts)]

    def _unit(self, data: bytes) -> tuple[np.ndarray, np.ndarray]:
        found = self.known.get(data)
        if found is None:
            if self.held > CACHE_BYTES:
                self.known.clear()
                self.held = 0
            self.held += 100 + 9 * len(data)
            found = self.known[data] = self.model.unit(data)
        return found


def spell(model: Model, ids: np.ndarray, cuts: np.ndarray) -> Iterator[bytes]:
    """The bytes each run of ids stands for."""
    sizes = model.sizes[ids]
    edge = np.concatenate(([0], np.cumsum(sizes)))
    flat = model.spelled[np.arange(edge[-1]) + np.repeat(model.first[ids] - edge[:-1], sizes)].tobytes()
    at = edge[cuts].tolist()
    drop = (model.dummy_prefix or model.squeeze) and len(ids) > 0
    for k in range(len(at) - 1):
        yield flat[at[k] + (drop and flat[at[k] : at[k + 1]].startswith(b" ")) : at[k + 1]]


def decoded(model: Model, ids: np.ndarray, cuts: np.ndarray) -> Iterator[str]:
    """The text of each run of ids; bytes that form no character read as U+FFFD each."""

    def one(error: UnicodeDecodeError) -> tuple[str, int]:
        return "�", error.start + 1

    codecs.register_error("wardgrid.each", one)
    for raw in spell(model, ids, cuts):
        yield raw.decode(errors="wardgrid.each")


def encode(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, ids, starts, ends): the pieces of every text and the original bytes ``[start, end)`` of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        for batch in batches:
            for row, end, data, bounds in textbytes.blocks(batch.column(1)):
                ids, start, stop, cuts = encoder.block(data, bounds)
                base = np.repeat(bounds[:-1], np.diff(cuts))
                columns = [pa.ListArray.from_arrays(pa.array(cuts, pa.int32()), pa.array(v.astype(np.int32))) for v in (ids, start - base, stop - base)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, end - row), *columns], ["doc_id", "ids", "starts", "ends"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id bigint, ids array<int>, starts array<int>, ends array<int>")


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """(doc_id, text): the text of the ``ids`` of every row; NULL ids give the empty text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(path)
        for batch in batches:
            lists = batch.column(1).fill_null([])
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            cuts = np.concatenate(([0], np.cumsum(lists.value_lengths().to_numpy(zero_copy_only=False)))).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(decoded(model, ids, cuts), pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): encoding and decoding in one pass, without writing ids down."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(path)
        model = encoder.model
        names = [str(k).encode() + b"," for k in range(len(model.sizes))]
        sizes = np.array([len(x) for x in names])
        first, flat = np.cumsum(sizes) - sizes, np.frombuffer(b"".join(names), np.uint8)
        for batch in batches:
            for row, end, data, bounds in textbytes.blocks(batch.column(1)):
                ids, _, _, cuts = encoder.block(data, bounds)
                edge = np.concatenate(([0], np.cumsum(sizes[ids])))
                listed = flat[np.arange(edge[-1]) + np.repeat(first[ids] - edge[:-1], sizes[ids])].tobytes()
                at = edge[cuts].tolist()
                one = [hashlib.sha256(listed[a : max(a, b - 1)]).hexdigest() for a, b in zip(at[:-1], at[1:], strict=True)]
                two = [hashlib.sha256(text.encode()).hexdigest() for text in decoded(model, ids, cuts)]
                columns = [batch.column(0).slice(row, end - row), pa.array(np.diff(cuts).astype(np.int64)), pa.array(one, pa.string()), pa.array(two, pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
