"""SentencePiece encoding with the source bytes of every piece, and decoding.

A model file holds a compiled character map (a trie in a double array and the replacements
its leaves point to), the pieces and their scores. Texts are normalised by the longest
entries of the map, and every normalised byte keeps the source byte it came from. Pieces are
then merged, best score first, in stretches no piece can reach across: as a corpus repeats
its words, a stretch is merged once and looked up afterwards.
"""

from __future__ import annotations

import codecs
import heapq
import struct
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from pulsemart.llm.text import filled, free_names, pieces, value_bytes

# Fixed values of the file format: message fields, kinds of pieces, the sign for a space.
PIECE, TRAINER, NORMALISER = 1, 2, 3
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
SPACE = "▁"
REPLACEMENT = "�"
UNKNOWN_SURFACE = " ⁇ "

# Stretches a worker remembers before it starts anew; the result does not depend on it.
REMEMBERED = 400_000
# Stretches up to these numbers of characters are merged together; longer ones on their own.
WIDTHS = (8, 12, 16, 24, 48)
NO_RANK = np.int32(2**31 - 1)
# A vocabulary is broadcast; larger files are no tokeniser models.
MODEL_BYTES = 64 << 20


def _one_sign_a_byte(error: UnicodeDecodeError) -> tuple[str, int]:
    return REPLACEMENT, error.start + 1


codecs.register_error("one-sign-a-byte", _one_sign_a_byte)


def message_fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a serialized message: integers, or the bytes of everything else."""
    at = 0

    def number() -> int:
        nonlocal at
        shift = value = 0
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
            continue
        size = {1: 8, 5: 4}.get(key & 7)
        size = number() if size is None else size
        yield key >> 3, data[at : at + size]
        at += size


class CharacterMap:
    """The compiled map: longest entry at a position of the text, and what it becomes."""

    def __init__(self, compiled: bytes):
        size = struct.unpack_from("<I", compiled)[0] if compiled else 0
        self.units = np.frombuffer(compiled, "<u4", size // 4, 4).tolist() if size else []
        self.replacements = compiled[4 + size :]
        self.starts = np.zeros(256, dtype=bool)
        if self.units:
            root = self._children(0)
            for byte in range(1, 256):
                self.starts[byte] = self._is(root ^ byte, byte)

    def _children(self, node: int) -> int:
        unit = self.units[node]
        return node ^ ((unit >> 10) << ((unit & 512) >> 6))

    def _is(self, node: int, byte: int) -> bool:
        return node < len(self.units) and self.units[node] & 0x800000FF == byte

    def longest(self, data: bytes, at: int) -> tuple[int, bytes]:
        """(length, replacement) of the longest entry that begins at ``at``; length 0 if none does."""
        found, value = 0, 0
        base = self._children(0)
        for i in range(at, len(data)):
            node = base ^ data[i]
            if data[i] == 0 or not self._is(node, data[i]):
                break
            base = self._children(node)
            if self.units[node] & 256:
                found, value = i + 1 - at, self.units[base] & 0x7FFFFFFF
        if not found:
            return 0, b""
        return found, self.replacements[value : self.replacements.index(b"\0", value)]


@dataclass
class Normalised:
    """Texts after normalisation, one after the other, a space for every space sign.

    Text i is ``data[starts[i]:starts[i + 1]]``; byte p of it comes from byte ``source[p]`` of the
    text, and what is before p from the bytes before that one. ``ends[i]`` is where the source of
    text i ends.
    """

    data: np.ndarray
    starts: np.ndarray
    source: np.ndarray
    ends: np.ndarray


class Remembered:
    """Stretches a worker has merged: slot i holds ``ids[starts[i]:starts[i + 1]]`` and the sizes there."""

    def __init__(self):
        self.known: dict[bytes, int] = {}
        self.starts = np.zeros(1, np.int64)
        self.ids = self.sizes = np.zeros(0, np.int32)

    def slots(self, stretches: list[bytes], merge: Callable[[list[bytes]], tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
        """The slot of each of some different stretches; those not known yet are merged."""
        found = np.fromiter(map(self.known.get, stretches, repeat(-1)), np.int64, len(stretches))
        unknown = np.flatnonzero(found < 0)
        if len(unknown):
            new = [stretches[i] for i in unknown.tolist()]
            ids, sizes, counts = merge(new)
            free = len(self.starts) - 1
            found[unknown] = np.arange(free, free + len(new))
            self.known.update(zip(new, range(free, free + len(new))))
            self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(counts, dtype=np.int64)])
            self.ids = np.concatenate([self.ids, ids])
            self.sizes = np.concatenate([self.sizes, sizes])
        return found

    def forget_if_full(self) -> None:
        if len(self.known) > REMEMBERED or len(self.ids) > 8 * REMEMBERED:
            self.__init__()


@dataclass
class PieceModel:
    """A BPE model with byte pieces. ``remembered`` is a worker's memory of merged stretches."""

    texts: list[str]
    kinds: list[int]
    ranks: dict[str, tuple[float, int]]
    byte_ids: list[int]
    characters: bytes
    dummy_prefix: bool
    trims: bool
    cuts: bool
    remembered: Remembered = field(default_factory=Remembered)

    def __post_init__(self):
        self.map = CharacterMap(self.characters)
        # Pieces of one character by code point, and pairs of pieces that make a piece.
        single = {ord(t): i for t, (_, i) in self.ranks.items() if len(t) == 1}
        self.characters_of = np.full(max(single, default=32) + 1, -1, dtype=np.int64)
        self.characters_of[list(single)] = list(single.values())
        if SPACE in self.ranks:
            self.characters_of[32] = self.ranks[SPACE][1]
        # ASCII in no piece; a space is there as its sign.
        used = {c for t in self.ranks for c in t} | {" "}
        self.alone = np.array([b < 128 and chr(b) not in used for b in range(256)])
        ranked = {key: rank for rank, key in enumerate(sorted({key for key, _ in self.ranks.values()}))}
        pairs = sorted(
            (self.ranks[t[:k]][1] << 32 | self.ranks[t[k:]][1], ranked[key], i)
            for t, (key, i) in self.ranks.items()
            for k in range(1, len(t))
            if t[:k] in self.ranks and t[k:] in self.ranks
        )
        self.pair_keys, self.pair_ranks, self.pair_pieces = (
            np.array(column, kind) for column, kind in zip(zip(*pairs or [(-1, 0, 0)]), (np.int64, np.int32, np.int64))
        )

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("map", "_shown")} | {"remembered": Remembered()}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.map = CharacterMap(self.characters)

    # Normalisation

    def normalise_one(self, text: bytes) -> tuple[bytes, list[int]]:
        """A text by the map, and the source byte of each byte and of the end."""
        units: list[tuple[int, bytes]] = []
        at = 0
        mapped = self.map.starts
        while at < len(text):
            size, becomes = self.map.longest(text, at) if mapped[text[at]] else (0, b"")
            if not size:
                size = 1 if text[at] < 0x80 else 2 if text[at] < 0xE0 else 3 if text[at] < 0xF0 else 4
                becomes = text[at : at + size]
                try:
                    becomes.decode()
                except UnicodeDecodeError:
                    size, becomes = 1, REPLACEMENT.encode()
            units.append((at, becomes))
            at += size
        if self.trims:
            units = _trimmed(units)
        if not units:
            return b"", [0]
        end = len(text)
        if self.trims:
            last, becomes = units[-1]
            end = last + (self.map.longest(text, last)[0] or len(becomes))
        data = b"".join(becomes for _, becomes in units)
        source = [at for at, becomes in units for _ in becomes] + [end]
        return (b" " + data, [units[0][0], *source]) if self.dummy_prefix else (data, source)

    def normalise(self, texts: pa.Array) -> Normalised:
        whole = filled(texts)
        data = np.frombuffer(value_bytes(whole), dtype=np.uint8)
        offsets = np.frombuffer(whole.buffers()[1], dtype=np.int64)[: len(whole) + 1] if len(whole) else np.zeros(1, np.int64)
        plain = not self.map.units and not self.trims
        if plain:
            try:
                data.tobytes().decode()
            except UnicodeDecodeError:
                plain = False
        sizes = np.diff(offsets)
        if plain:
            # No entry can match: every character stands for itself, after one space a text.
            if not self.dummy_prefix:
                own = np.arange(len(data)) - np.repeat(offsets[:-1], sizes)
                return Normalised(data, offsets, own, sizes)
            some = sizes > 0
            put = np.insert(data, offsets[:-1][some], 0x20)
            starts = offsets + np.concatenate([[0], np.cumsum(some)])
            own = np.arange(len(put)) - np.repeat(starts[:-1], np.diff(starts))
            return Normalised(put, starts, np.maximum(own - 1, 0), sizes)
        parts, sources, ends = [], [], []
        for text in pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(whole), whole.buffers()[:3]).to_pylist():
            part, source = self.normalise_one(text)
            parts.append(part)
            sources.append(source[:-1])
            ends.append(source[-1])
        starts = np.concatenate([[0], np.cumsum([len(p) for p in parts], dtype=np.int64)])
        joined = np.frombuffer(b"".join(parts), dtype=np.uint8)
        source = np.fromiter(chain.from_iterable(sources), np.int64, int(starts[-1]))
        return Normalised(joined, starts, source, np.array(ends, dtype=np.int64))

    # Encoding

    def merge(self, stretch: bytes) -> tuple[list[int], list[int]]:
        """Ids of a normalised stretch and the bytes of it that each takes.

        Of the bytes of a character without a piece, the last takes the whole character.
        """
        text = stretch.decode()
        ids, sizes = [], []
        at = 0
        for part in self._merge_long(text.replace(" ", SPACE)):
            size = len(text[at : at + len(part)].encode())
            at += len(part)
            rank = self.ranks.get(part)
            if rank is not None:
                ids.append(rank[1])
                sizes.append(size)
                continue
            raw = part.encode()
            ids += [self.byte_ids[b] for b in raw]
            sizes += [0] * (len(raw) - 1) + [size]
        return ids, sizes

    def merge_many(self, stretches: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(ids, sizes, pieces of each) of many stretches, one after the other.

        Those of the same width are merged together, one pair of each at a time. Long ones and
        those with characters without a piece go through `merge`.
        """
        data = np.frombuffer(b"".join(stretches), dtype=np.uint8)
        ends = np.cumsum([len(s) for s in stretches], dtype=np.int64)
        heads = np.flatnonzero((data & 0xC0) != 0x80)
        widths = np.diff(np.append(heads, len(data)))
        points = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), dtype="<u4")
        symbols = np.where(points < len(self.characters_of), self.characters_of[np.minimum(points, len(self.characters_of) - 1)], -1)
        bounds = np.concatenate([[0], np.searchsorted(heads, ends)])
        length = np.diff(bounds)
        odd = np.add.reduceat(symbols < 0, bounds[:-1]) > 0
        outs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        least = 0
        for most in WIDTHS:
            rows = np.flatnonzero((length > least) & (length <= most) & ~odd)
            least = most
            if len(rows):
                at = bounds[rows][:, None] + np.arange(most)
                inside = np.arange(most) < length[rows][:, None]
                at = np.minimum(at, len(symbols) - 1)
                outs += self._merge_rows(rows, np.where(inside, symbols[at], -1), np.where(inside, widths[at], 0))
        for i in np.flatnonzero(odd | (length > WIDTHS[-1])).tolist():
            ids, sizes = self.merge(stretches[i])
            outs.append((np.full(len(ids), i), np.array(ids, np.int32), np.array(sizes, np.int32)))
        row, ids, sizes = (np.concatenate(parts) for parts in zip(*outs))
        order = np.argsort(row, kind="stable")
        counts = np.bincount(row, minlength=len(stretches))
        return ids[order].astype(np.int32), sizes[order].astype(np.int32), counts

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rank, piece) of the pairs that make a piece; NO_RANK for others."""
        keys = left.astype(np.int64) << 32 | right
        place = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
        hit = (self.pair_keys[place] == keys) & (left >= 0) & (right >= 0)
        return np.where(hit, self.pair_ranks[place], NO_RANK), self.pair_pieces[place]

    def _merge_rows(self, rows: np.ndarray, symbols: np.ndarray, sizes: np.ndarray) -> Iterator[tuple]:
        """Merge the best pair of every row, the first of equal ones, until none makes a piece.

        Yields (row, piece, size) arrays of the rows that are done. Symbols fill rows from the
        left, -1 stands behind them.
        """
        ranks, made = self._pairs(symbols[:, :-1], symbols[:, 1:])
        while len(rows):
            best = ranks.argmin(axis=1)
            every = np.arange(len(rows))
            done = ranks[every, best] == NO_RANK
            if done.any():
                there = symbols[done] >= 0
                yield np.repeat(rows[done], there.sum(axis=1)), symbols[done][there], sizes[done][there]
                rows, symbols, sizes, ranks, made, best = (x[~done] for x in (rows, symbols, sizes, ranks, made, best))
                every = np.arange(len(rows))
            symbols[every, best] = made[every, best]
            sizes[every, best] += sizes[every, best + 1]
            behind = np.arange(symbols.shape[1]) > best[:, None]
            symbols = np.where(behind, np.pad(symbols[:, 1:], ((0, 0), (0, 1)), constant_values=-1), symbols)
            sizes = np.where(behind, np.pad(sizes[:, 1:], ((0, 0), (0, 1))), sizes)
            behind = behind[:, :-1]
            ranks = np.where(behind, np.pad(ranks[:, 1:], ((0, 0), (0, 1)), constant_values=NO_RANK), ranks)
            made = np.where(behind, np.pad(made[:, 1:], ((0, 0), (0, 1))), made)
            for place in (best - 1, best):
                near = np.flatnonzero((place >= 0) & (place < ranks.shape[1]))
                at = place[near]
                ranks[near, at], made[near, at] = self._pairs(symbols[near, at], symbols[near, at + 1])

    def _merge_long(self, shown: str) -> list[str]:
        """Parts of a text of any length: a queue of pairs, best score first, then the leftmost."""
        ranks = self.ranks
        parts: list[str | None] = list(shown)
        n = len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue: list[tuple[float, int, str]] = []

        def offer(left: int) -> None:
            if after[left] < n:
                both = parts[left] + parts[after[left]]
                if both in ranks:
                    heapq.heappush(queue, (ranks[both][0], left, both))

        for i in range(n - 1):
            offer(i)
        while queue:
            _, left, both = heapq.heappop(queue)
            # Merged meanwhile, or with another neighbour.
            if parts[left] is None or after[left] >= n or parts[left] + parts[after[left]] != both:
                continue
            right = after[left]
            parts[left], parts[right] = both, None
            after[left] = after[right]
            if after[right] < n:
                before[after[right]] = left
            if before[left] >= 0:
                offer(before[left])
            offer(left)
        return [p for p in parts if p is not None]

    def stretches(self, found: Normalised) -> tuple[np.ndarray, np.ndarray]:
        """Where stretches begin, and how many each text has: a new one begins with each space
        that follows no space, if no piece has a space after something else, and on both sides of
        a byte of ASCII that is in no piece."""
        data, texts = found.data, found.starts[:-1][np.diff(found.starts) > 0]
        begins = np.zeros(len(data) + 1, dtype=bool)
        if self.cuts and len(data):
            space = data == 0x20
            # The space's own sign in a text is a space as well.
            sign = np.zeros(len(data), dtype=bool)
            sign[2:] = (data[:-2] == 0xE2) & (data[1:-1] == 0x96) & (data[2:] == 0x81)
            begins[1:-1] = space[1:] & ~space[:-1] & ~sign[:-1]
        if len(data):
            alone = self.alone[data]
            begins[:-1] |= alone
            begins[1:] |= alone
        begins[texts] = True
        begins[-1] = False
        where = np.flatnonzero(begins)
        return where, np.diff(np.searchsorted(where, found.starts))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, begins, ends, starts): all pieces, their spans in bytes of the source, and the first of each text."""
        found = self.normalise(texts)
        where, per_text = self.stretches(found)
        if not len(where):
            none = np.zeros(0, np.int32)
            return none, none, none, np.zeros(len(per_text) + 1, np.int64)
        bounds = np.append(where, len(found.data)).astype(np.int64)
        buffers = [None, pa.py_buffer(bounds), pa.py_buffer(found.data)]
        coded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(where), buffers).dictionary_encode()
        pool = self.remembered
        slots = pool.slots(coded.dictionary.to_pylist(), self.merge_many)[coded.indices.to_numpy()]
        firsts = pool.starts[slots]
        per = pool.starts[slots + 1] - firsts
        ends = np.cumsum(per)
        places = np.arange(ends[-1]) + np.repeat(firsts - (ends - per), per)
        ids = pool.ids[places]
        sizes = pool.sizes[places]
        pool.forget_if_full()
        stop = np.cumsum(sizes, dtype=np.int64)
        first = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per_text)])]
        # Byte p of all normalised bytes; where a text ends, its source ends.
        source = np.append(found.source, 0)
        begin = source[stop - sizes]
        end = source[stop]
        some = per_text > 0
        end[first[1:][some] - 1] = found.ends[some]
        # Bytes of a character before its last one end where they begin.
        end = np.where(sizes > 0, end, begin)
        return ids, begin.astype(np.int32), end.astype(np.int32), first

    # Decoding

    def decode(self, ids: np.ndarray, starts: np.ndarray) -> list[str]:
        """Texts of lists of ids, list i being ``ids[starts[i]:starts[i + 1]]``.

        The space before a text's first word is left out; bytes that make no character become
        a replacement sign each.
        """
        surfaces, begins_with_space, shows = self._surfaces()
        ids = ids.astype(np.int64)
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.texts)):
            raise ValueError("id outside the vocabulary")
        if self.dummy_prefix or self.trims:
            shown = np.flatnonzero(shows[ids])
            first = np.searchsorted(shown, starts[:-1])
            there = first < len(shown)
            first = shown[first[there]]
            first = first[first < starts[1:][there]]
            first = first[begins_with_space[ids[first]]]
            ids[first] += len(self.texts)
        taken = surfaces.take(pa.array(ids))
        raw = value_bytes(taken)
        ends = np.frombuffer(taken.buffers()[1], dtype=np.int64)[: len(taken) + 1] if len(taken) else np.zeros(1, np.int64)
        hidden = np.flatnonzero(~shows[np.minimum(ids, len(self.texts) - 1)])
        out = []
        for first, stop in zip(starts[:-1], starts[1:]):
            # Bytes on both sides of a sign that does not show make no character together.
            own = hidden[np.searchsorted(hidden, first) : np.searchsorted(hidden, stop)] if len(hidden) else ()
            cuts = [first, *own, stop]
            out.append("".join(raw[ends[a] : ends[b]].decode("utf-8", "one-sign-a-byte") for a, b in zip(cuts, cuts[1:])))
        return out

    def _surfaces(self):
        """Bytes of every id, then of every id without a space in front; which begin with one; which show at all."""
        if not hasattr(self, "_shown"):
            shown = []
            for text, kind in zip(self.texts, self.kinds):
                if kind == BYTE:
                    shown.append(bytes([int(text[1:-1], 16)]))
                elif kind == CONTROL:
                    shown.append(b"")
                elif kind == UNKNOWN:
                    shown.append(UNKNOWN_SURFACE.encode())
                else:
                    shown.append(text.replace(SPACE, " ").encode())
            kinds = np.array(self.kinds)
            spaced = np.array([s[:1] == b" " for s in shown]) & (kinds == NORMAL)
            table = pa.array(shown + [s[1:] if ok else s for s, ok in zip(shown, spaced)], pa.large_binary())
            self._shown = table, spaced, kinds != CONTROL
        return self._shown


def _trimmed(units: list[tuple[int, bytes]]) -> list[tuple[int, bytes]]:
    """Without spaces in front, at the end and after another space."""
    out: list[tuple[int, bytes]] = []
    spaced = True
    for at, becomes in units:
        if spaced:
            becomes = becomes.lstrip(b" ")
        if becomes:
            out.append((at, becomes))
            spaced = becomes.endswith(b" ")
    while out and out[-1][1].endswith(b" "):
        at, becomes = out.pop()
        if becomes := becomes.rstrip(b" "):
            out.append((at, becomes))
    return out


def read_piece_model(path: str) -> PieceModel:
    """The model in a file the driver can read: BPE with byte pieces and escaped spaces.

    Anything else (unigram models, pieces of the user's own, unused pieces, spaces as
    suffixes) is refused with a ValueError, never encoded otherwise than the model says.
    """
    with open(path, "rb") as file:
        data = file.read(MODEL_BYTES + 1)
    if len(data) > MODEL_BYTES:
        raise ValueError(f"{path} is larger than {MODEL_BYTES} bytes")
    return parse_piece_model(data)


def parse_piece_model(data: bytes) -> PieceModel:
    texts, kinds, scores = [], [], []
    trainer: dict = {}
    normaliser: dict = {}
    for number, value in message_fields(data):
        if number == PIECE:
            own = dict(message_fields(value))
            texts.append(own.get(1, b"").decode())
            scores.append(struct.unpack("<f", own[2])[0] if 2 in own else 0.0)
            kinds.append(own.get(3, NORMAL))
        elif number == TRAINER:
            trainer = dict(message_fields(value))
        elif number == NORMALISER:
            normaliser = dict(message_fields(value))
    byte_ids = [-1] * 256
    for i, (text, kind) in enumerate(zip(texts, kinds)):
        if kind == BYTE:
            byte_ids[int(text[1:-1], 16)] = i
    if trainer.get(3, 1) != BPE or trainer.get(24, 0) or not normaliser.get(5, 1):
        raise ValueError("not a BPE model with escaped spaces in front of words")
    if -1 in byte_ids or USER_DEFINED in kinds or UNUSED in kinds:
        raise ValueError("the model has no byte pieces, or pieces that are user-defined or unused")
    ranks = {t: (-s, i) for i, (t, s, k) in enumerate(zip(texts, scores, kinds)) if k == NORMAL}
    return PieceModel(
        texts=texts,
        kinds=kinds,
        ranks=ranks,
        byte_ids=byte_ids,
        characters=normaliser.get(2, b""),
        dummy_prefix=bool(normaliser.get(3, 1)),
        trims=bool(normaliser.get(4, 1)),
        cuts=not any(SPACE in t.lstrip(SPACE) for t in ranks),
    )


def encode_documents(
    docs: DataFrame, model: PieceModel, id_column: str = "doc_id", text_column: str = "text", decoded: bool = False
) -> DataFrame:
    """One row per row of ``docs``: doc_id, ids, begins, ends, and with ``decoded`` the text of the ids.

    Piece i of a text stands for its bytes ``begins[i]`` to ``ends[i]`` (UTF-8, end excluded);
    spans follow one another, and only the space put before the first word and the first bytes
    of a character without a piece have empty ones. A null or empty text has no pieces. Texts
    are encoded whole, whatever their length; repeated rows, null ids and equal texts come back
    as often as they are there, an empty table gives no rows, other columns are ignored.
    Nothing is shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in pieces(batches):
            ids, begins, ends, starts = shared.value.encode(piece.column("text"))
            offsets = pa.array(starts, pa.int32())
            columns = [pa.ListArray.from_arrays(offsets, pa.array(v, pa.int32())) for v in (ids, begins, ends)]
            if decoded:
                columns.append(pa.array(shared.value.decode(ids, starts), pa.string()))
            yield pa.RecordBatch.from_arrays([piece.column("doc_id"), *columns], names)

    kind = docs.schema[id_column].dataType.simpleString()
    schema = f"doc_id {kind}, ids array<int>, begins array<int>, ends array<int>" + ", decoded string" * decoded
    names = ["doc_id", "ids", "begins", "ends", *["decoded"] * decoded]
    narrow = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    return narrow.mapInArrow(encode, schema)


def decode_documents(rows: DataFrame, model: PieceModel, ids_column: str = "ids", as_column: str = "decoded") -> DataFrame:
    """``rows`` with the text of their ids; null ids give null, no ids an empty text.

    Control pieces have no text, the unknown piece its sign, and byte pieces that make no
    character a replacement sign each. An id outside the vocabulary raises. ``as_column`` gets
    underscores in front if ``rows`` already has it. Nothing is shuffled.
    """
    shared = rows.sparkSession.sparkContext.broadcast(model)
    (name,) = free_names(rows.columns, as_column)

    def decode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(ids_column)
            sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            starts = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
            ids = lists.flatten().to_numpy(zero_copy_only=False)
            texts = pa.array(shared.value.decode(ids, starts), pa.string(), mask=lists.is_null().to_numpy(zero_copy_only=False))
            yield pa.RecordBatch.from_arrays([*batch.columns, texts], [*batch.schema.names, name])

    schema = StructType([*rows.schema.fields, StructField(name, StringType())])
    return rows.mapInArrow(decode, schema)
