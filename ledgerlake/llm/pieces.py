"""SentencePiece encoding and decoding that keeps byte offsets of the original text.

A text is normalised by the character map compiled into the model: at every place the longest
prefix that the map's double-array trie knows is replaced, any other character stays, and each
byte written records the byte of the original that it came from.  The normalised text is encoded
by byte-pair merges; each piece's byte span there is projected through the recorded alignment to a
byte span of the original, from the source of its first byte to that of the byte after it (so a
piece inside a replacement of several pieces may have an empty span).  Characters without a piece become byte pieces, of which the last holds
the character's span (the others are empty spans before it).

Merges never cross two characters that no piece holds side by side.  A text is therefore cut at
every word mark that follows another character, if no piece holds such a place, and long words at
all such pairs; the distinct new parts of a batch are merged together as arrays, and remembered by
the worker process until they have ``PART_CHARS`` characters.

Models: byte-pair models without user-defined or unused pieces; others are refused.

Defined cases: a null text is an empty one, whose ids are the end id alone; very long texts are
encoded whole, unbroken ones by a heap in n log n; rows are independent, so repeated rows and null
ids change nothing; an empty table gives no rows; other columns are passed through, and an added
column takes the place of one with the same name.
"""

from __future__ import annotations

import bisect
import functools
import heapq
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType
from sentencepiece import sentencepiece_model_pb2 as schema

MARK = "▁"
#: Characters of distinct parts that a worker process remembers (unless one batch has more).
PART_CHARS = 5_000_000
#: Words of at most so many characters are merged together, round by round; longer ones by a heap each.
SCANNED = 48
#: Characters of text in one batch of rows that a task encodes and returns.
BATCH_CHARS = 1_000_000
#: The cost of a join that no piece allows.
NEVER = (1 << 31) - 1


class CharacterMap:
    """Longest-prefix replacement by a compiled map: a double-array trie and its replacements.

    The map is the trie's size in bytes, the trie, and the replacements, each ended by a zero byte.
    A unit of the trie holds its label in the low byte, whether a value follows in bit 8, and the
    distance to its children from bit 9 on.
    """

    def __init__(self, compiled: bytes):
        size = int.from_bytes(compiled[:4], "little")
        self.units = np.frombuffer(compiled[4:4 + size], "<u4").tolist()
        self.texts = compiled[4 + size:]
        self.starts: dict[str, bool] = {}

    def longest(self, data: bytes, at: int, stop: int | None = None) -> tuple[int, int]:
        """(bytes matched, place of the replacement) of the longest match at a byte; (0, -1) if none."""
        units, best, node = self.units, (0, -1), 0
        if not units:
            return best
        node ^= self._step(units[0])
        for i in range(at, len(data) if stop is None else stop):
            node ^= data[i]
            unit = units[node] if node < len(units) else 0
            if unit & 0x800000FF != data[i]:
                break
            node ^= self._step(unit)
            if unit >> 8 & 1:
                best = (i + 1 - at, units[node] & 0x7FFFFFFF)
        return best

    @staticmethod
    def _step(unit: int) -> int:
        return (unit >> 10) << ((unit & 0x200) >> 6)

    def replacement(self, place: int) -> bytes:
        return self.texts[place:self.texts.index(b"\0", place)]

    def may_start(self, char: str) -> bool:
        """Whether any rule starts with this character."""
        known = self.starts.get(char)
        if known is None:
            units, node, data = self.units, 0, char.encode()
            known = bool(units)
            if known:
                node ^= self._step(units[0])
                for byte in data:
                    node ^= byte
                    unit = units[node] if node < len(units) else 0
                    if unit & 0x800000FF != byte:
                        known = False
                        break
                    node ^= self._step(unit)
            self.starts[char] = known
        return known

    def apply(self, text: str) -> tuple[bytes, np.ndarray]:
        """(normalised bytes, first byte of the original's source for each of them)."""
        data = text.encode()
        if not self.units:
            heads = (np.frombuffer(data, np.uint8) & 0xC0) != 0x80      # every byte belongs to its character
            return data, np.flatnonzero(heads).astype(np.int32)[np.cumsum(heads, dtype=np.int32) - 1]
        out, first, at, done = [], [], 0, 0
        for char in text:
            width = len(char.encode())
            if at < done:       # inside the last match
                at += width
                continue
            length, place = self.longest(data, at) if self.may_start(char) else (0, -1)
            piece = self.replacement(place) if length else data[at:at + width]
            done = at + (length or width)
            out.append(piece)
            first += [at] * len(piece)
            at += width
        return b"".join(out), np.array(first, np.int32)


class PieceCodec:
    """Encoder and decoder of one model, given as its serialised bytes."""

    def __init__(self, model: bytes):
        m = schema.ModelProto()
        m.ParseFromString(model)
        kind = schema.ModelProto.SentencePiece
        if m.trainer_spec.model_type != schema.TrainerSpec.BPE or any(p.type in (kind.USER_DEFINED, kind.UNUSED) for p in m.pieces):
            raise ValueError("only byte-pair models without user-defined or unused pieces")
        if m.trainer_spec.treat_whitespace_as_suffix or m.denormalizer_spec.precompiled_charsmap:
            raise ValueError("word marks must come before words, and decoding must not rewrite text")
        spec = m.normalizer_spec
        self.map = CharacterMap(spec.precompiled_charsmap)
        self.prefix, self.squeeze, self.escape = spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.escape_whitespaces
        self._index({p.piece: (-p.score, i) for i, p in enumerate(m.pieces) if p.type == kind.NORMAL}, len(m.pieces))
        self.unknown = next(i for i, p in enumerate(m.pieces) if p.type == kind.UNKNOWN)
        self.end = next((i for i, p in enumerate(m.pieces) if p.piece == (m.trainer_spec.eos_piece or "</s>")), -1)
        self.bytes = {int(p.piece[1:-1], 16): i for i, p in enumerate(m.pieces) if p.type == kind.BYTE}
        if m.trainer_spec.byte_fallback and len(self.bytes) != 256:
            raise ValueError("byte fallback needs a piece for every byte")
        self.fallback = bool(m.trainer_spec.byte_fallback)
        marks_lead = not any(b == MARK and a != MARK for a, b in self.pairs)
        # parts end before a word mark that follows another character
        self.parts = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+") if marks_lead else None
        self._forget()
        # decoding
        self.control = {i for i, p in enumerate(m.pieces) if p.type == kind.CONTROL}
        self.byte_of = {i: bytes([b]) for b, i in self.bytes.items()}
        surface = m.trainer_spec.unk_surface
        self.texts = [b"" if i in self.control else self.byte_of[i] if i in self.byte_of else surface.encode() if i == self.unknown
                      else p.piece.replace(MARK, " ").encode() for i, p in enumerate(m.pieces)]
        self.marked = {i for i, p in enumerate(m.pieces) if p.type == kind.NORMAL and p.piece.startswith(MARK)}

    # -------------------------------------------------------------- encoding

    def _index(self, pieces: dict[str, tuple[float, int]], size: int) -> None:
        """Number the symbols (a piece by its id, other characters from size on) and all joins of two."""
        self.size, self.symbols = size, [""] * size
        self.symbol_of = np.full(0x110000, -1, np.int64)
        for piece, (_, i) in pieces.items():
            self.symbols[i] = piece
            if len(piece) == 1:
                self.symbol_of[ord(piece)] = i
        self.width_of = np.array([len(x.encode()) for x in self.symbols], np.int32)
        self._symbols("".join(sorted({c for piece in pieces for c in piece})))
        order = {cost: k for k, cost in enumerate(sorted({cost for cost, _ in pieces.values()}))}

        def symbol(part: str) -> int | None:
            return int(self.symbol_of[ord(part)]) if len(part) == 1 else pieces[part][1] if part in pieces else None

        joins = sorted(((a << 21) + b, order[cost], i) for piece, (cost, i) in pieces.items() for k in range(1, len(piece))
                       if (a := symbol(piece[:k])) is not None and (b := symbol(piece[k:])) is not None) or [(-1, NEVER, 0)]
        self.join_keys, self.join_costs, self.join_symbols = (
            np.array(column, t) for column, t in zip(zip(*joins), (np.int64, np.int32, np.int32)))
        self.pairs = {piece[i:i + 2] for piece in pieces for i in range(len(piece) - 1)}

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """(normalised text, byte of the original where each byte's source starts, and where the last one ends)."""
        data, first = self.map.apply(text)
        first = np.append(first, np.int32(len(text.encode())))
        if self.squeeze and data:
            keep = np.frombuffer(data, np.uint8) != 0x20
            keep[1:] |= keep[:-1]                                       # the first of several spaces stays
            stop = len(data.decode().rstrip(" " + MARK * self.escape).encode())
            keep[stop:] = False
            data, first = np.frombuffer(data, np.uint8)[keep].tobytes(), np.append(first[:-1][keep], first[stop])
        if not data:
            return "", first[-1:]
        out = data.decode()
        if self.escape:
            spaces = np.frombuffer(data + b"\0", np.uint8) == 0x20
            out, first = out.replace(" ", MARK), np.repeat(first, np.where(spaces, 3, 1))
        if self.prefix:
            mark = MARK if self.escape else " "
            out, first = mark + out, np.concatenate([np.full(len(mark.encode()), first[0], np.int32), first])
        return out, first

    def _costs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(cost of joining, joined symbol) of pairs of symbols; NEVER where no piece joins them."""
        key = (left.astype(np.int64) << 21) + right
        at = np.minimum(np.searchsorted(self.join_keys, key), len(self.join_keys) - 1)
        found = (self.join_keys[at] == key) & (left >= 0) & (right >= 0)
        return np.where(found, self.join_costs[at], NEVER), self.join_symbols[at]

    def _symbols(self, text: str) -> np.ndarray:
        """The symbol of every character; characters without one get the next free number."""
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
        found = self.symbol_of[codes]
        if found.min(initial=0) < 0:
            for code in np.unique(codes[found < 0]).tolist():
                self.symbol_of[code] = len(self.symbols)
                self.symbols.append(chr(code))
            found = self.symbol_of[codes]
        return found

    def _merge_words(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The symbols of all words after all merges, and how many each word has.

        In each round every word joins its best pair of neighbours, the leftmost of equals.  Joined
        symbols keep the first one's place, and links lead to the places left and right of it.
        """
        n, lengths = len(words), np.array([len(w) for w in words])
        width = int(lengths.max()) + 1
        symbol = self._symbols("".join(w.ljust(width, "\0") for w in words)).astype(np.int32).reshape(n, width)
        symbol[np.arange(width) >= lengths[:, None]] = -1
        cost, joined = np.full((n, width), NEVER, np.int32), np.zeros((n, width), np.int32)
        cost[:, :-1], joined[:, :-1] = self._costs(symbol[:, :-1], symbol[:, 1:])
        after = np.tile(np.arange(1, width + 1, dtype=np.int32), (n, 1))
        before = after - 2
        flat = [x.reshape(-1) for x in (symbol, cost, joined, after, before)]
        rows = np.arange(n)
        while len(rows):
            best = cost[rows].argmin(axis=1) if len(rows) < n else cost.argmin(axis=1)
            left = rows * width + best
            open_ = flat[1][left] != NEVER
            if not open_.all():
                rows, left = rows[open_], left[open_]
            start = rows * width
            right = start + flat[3][left]
            new = flat[2][left]
            flat[0][left], flat[0][right], flat[1][right] = new, -1, NEVER
            far = flat[3][right]
            flat[3][left] = far
            there = far < width
            flat[4][(start + far)[there]] = (left - start)[there]
            follower = np.where(there, flat[0][start + np.minimum(far, width - 1)], -1)
            flat[1][left], flat[2][left] = self._costs(new, follower)
            lead = flat[4][left]
            has = lead >= 0
            lead = (start + lead)[has]
            flat[1][lead], flat[2][lead] = self._costs(flat[0][lead], new[has])
        kept = symbol >= 0
        return symbol[kept].astype(np.int64), kept.sum(axis=1)

    def _merge_long(self, word: str) -> np.ndarray:
        """The same for one long word, by a heap of pairs."""
        n = len(word)
        symbols, before, after = self._symbols(word).tolist(), list(range(-1, n - 1)), [*range(1, n), -1]
        heap, keys = [], self.join_keys

        def offer(a: int, b: int) -> None:
            key = (symbols[a] << 21) + symbols[b]
            at = bisect.bisect_left(keys, key)
            if at < len(keys) and keys[at] == key:
                heapq.heappush(heap, (int(self.join_costs[at]), a, b, symbols[a], symbols[b], int(self.join_symbols[at])))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, a, b, left, right, joined = heapq.heappop(heap)
            if symbols[a] != left or symbols[b] != right or after[a] != b:
                continue
            symbols[a], symbols[b], after[a] = joined, -1, after[b]
            if after[b] >= 0:
                before[after[b]] = a
                offer(a, after[b])
            if before[a] >= 0:
                offer(before[a], a)
        return np.array([x for x in symbols if x >= 0], np.int64)

    def _learn(self, words: list[str]) -> None:
        """Remember the ids and byte widths of these parts' pieces."""
        self.chars += sum(map(len, words))
        words.sort(key=len)
        short = bisect.bisect_right(words, SCANNED, key=len)
        merged = [self._merge_words(words[at:min(short, at + (1 << 13))]) for at in range(0, short, 1 << 13)]
        merged += [(m, np.array([len(m)])) for m in map(self._merge_long, words[short:])]
        flat, counts = (np.concatenate(x) for x in zip(*merged))
        odd = np.flatnonzero(flat >= self.size)
        ids, widths = flat.astype(np.int32), self.width_of[np.minimum(flat, self.size - 1)]
        if len(odd):    # characters without a piece; a byte piece but the last of its character has width 0
            raws = [self.symbols[x].encode() for x in flat[odd].tolist()]
            given = [[self.bytes[b] for b in raw] if self.fallback else [self.unknown] for raw in raws]
            more = np.array([len(g) for g in given])
            times = np.ones(len(flat), np.int64)
            times[odd] = more
            ids, widths = np.repeat(ids, times), np.repeat(widths, times)
            ends = np.cumsum(times)
            places = np.repeat(ends[odd] - np.cumsum(more), more) + np.arange(more.sum())
            ids[places], widths[places] = [i for g in given for i in g], 0
            widths[ends[odd] - 1] = [len(raw) for raw in raws]
            counts = np.add.reduceat(times, np.cumsum(counts) - counts)
        first = len(self.known)
        self.known.update(zip(words, range(first, first + len(words))))
        self.counts = np.concatenate([self.counts, counts])
        self.offsets = np.cumsum(self.counts) - self.counts
        self.ids = np.concatenate([self.ids, ids])
        self.widths = np.concatenate([self.widths, widths])

    def _rows(self, parts: list[str]) -> np.ndarray:
        """Where each part is remembered, -1 if it is not."""
        return np.fromiter(map(self.known.get, parts, repeat(-1)), np.int64, len(parts))

    def _forget(self) -> None:
        self.known: dict[str, int] = {}
        self.chars, self.counts, self.offsets = 0, np.empty(0, np.int64), np.empty(0, np.int64)
        self.ids, self.widths = np.empty(0, np.int32), np.empty(0, np.int32)

    def _cut(self, out: str) -> list[str]:
        """The parts of a normalised text; long ones are cut where no piece holds both neighbours."""
        parts = self.parts.findall(out) if self.parts else [out] if out else []
        if max(map(len, parts), default=0) <= SCANNED:
            return parts
        done = []
        for part in parts:
            if len(part) <= SCANNED:
                done.append(part)
                continue
            cuts = [0, *(i for i in range(1, len(part)) if part[i - 1:i + 1] not in self.pairs), len(part)]
            done += [part[a:b] for a, b in zip(cuts, cuts[1:])]
        return done

    def encode_all(self, texts: list[str], add_end: bool = False) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(ids, first bytes, end bytes) of each text's pieces."""
        normal = [self.normalise(t) for t in texts]
        parts = [self._cut(n[0]) for n in normal]
        everything = [p for some in parts for p in some]
        found = self._rows(everything)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            fresh = list({everything[i] for i in missing.tolist()})
            if self.chars + sum(map(len, fresh)) > PART_CHARS:
                self._forget()
                fresh = list(set(everything))
                missing = np.arange(len(everything))
            self._learn(fresh)
            found[missing] = self._rows([everything[i] for i in missing.tolist()])
        out, at = [], 0
        for text, (_, first), some in zip(texts, normal, parts):
            rows = found[at:at + len(some)]
            at += len(some)
            counts = self.counts[rows]
            places = np.repeat(self.offsets[rows] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
            ids, widths = self.ids[places], self.widths[places].astype(np.int64)
            if not self.fallback and len(ids):      # neighbouring unknown pieces are one
                same = np.zeros(len(ids), bool)
                same[1:] = (ids[1:] == self.unknown) & (ids[:-1] == self.unknown)
                widths, ids = np.add.reduceat(widths, np.flatnonzero(~same)), ids[~same]
            stops = np.cumsum(widths)
            begin, end = first[stops - widths], first[stops]
            if add_end:
                size = np.int32(len(text.encode()))
                ids, begin, end = np.append(ids, np.int32(self.end)), np.append(begin, size), np.append(end, size)
            out.append((ids, begin, end))
        return out

    def encode(self, text: str, add_end: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.encode_all([text], add_end)[0]

    # -------------------------------------------------------------- decoding

    def decode(self, ids: list[int]) -> str:
        """The text of these ids: byte pieces in a row are read as UTF-8, and bad bytes replaced.  Nulls are skipped."""
        if None in ids:
            ids = [i for i in ids if i is not None]
        strip = self.prefix or self.squeeze
        lead = 0
        while lead < len(ids) and ids[lead] in self.control:
            lead += 1
        skip, texts = 0, self.texts
        if strip and lead < len(ids) and ids[lead] in self.marked:
            skip = 1
            while self.squeeze and lead + 1 < len(ids) and texts[ids[lead]] == b" " and ids[lead + 1] in self.marked:
                lead += 1       # all leading marks go
        body = ids[lead:]
        raw = b"".join(map(texts.__getitem__, body))
        plain = not self.control.intersection(body[:-1])
        if plain:
            try:
                return raw.decode()[skip:]
            except UnicodeDecodeError:
                pass
        out, run = [], []
        for i in [*body, None]:
            if i in self.byte_of:
                run.append(self.byte_of[i])
                continue
            if run:
                out.append(lenient(b"".join(run)))
                run = []
            if i is not None:
                out.append(texts[i].decode())
        return "".join(out)[skip:]


def lenient(raw: bytes) -> str:
    """UTF-8 in which every byte that starts no valid character becomes one replacement character."""
    out = []
    while raw:
        try:
            out.append(raw.decode())
            break
        except UnicodeDecodeError as bad:
            out.append(raw[:bad.start].decode() + "�")
            raw = raw[bad.start + 1:]
    return "".join(out)


# ---------------------------------------------------------------- Spark

@functools.lru_cache(maxsize=2)
def _codec(model: bytes) -> PieceCodec:
    """The codec of a worker process: its parts serve all tasks that the process runs."""
    return PieceCodec(model)


def _map_text(df: DataFrame, col: str, empty, model_path: str, added: list[StructField], keep: bool, each) -> DataFrame:
    """df with the columns added, whose rows each(codec, values) gives for some values of col."""
    with open(model_path, "rb") as f:
        model = df.sparkSession.sparkContext.broadcast(f.read())
    gone = {f.name for f in added} | (set() if keep else {col})
    kept = [f for f in df.schema.fields if f.name not in gone]
    types = [pa.list_(pa.int32()) if isinstance(f.dataType, ArrayType) else pa.string() for f in added]
    order = [*(f.name for f in kept), *(f.name for f in added)]
    wanted = ArrayType(IntegerType()) if empty == [] else StringType()
    # the values are a column that stays, if it has their type, or else a last one more
    names = [f.name for f in kept if f.name == col and f.dataType == wanted]
    place = [f.name for f in kept].index(col) if names else len(kept)
    value = [] if names else [F.col(f"`{col}`").cast(wanted).alias("".join(["value", *df.columns]))]

    def run(batches):
        codec = _codec(model.value)
        for b in batches:
            values, at = b.column(place), 0
            while at < b.num_rows:
                some, size, start = [], 0, at
                while at < b.num_rows and size < BATCH_CHARS:
                    some.append(values[at].as_py() or empty)
                    size += len(some[-1])
                    at += 1
                out = [pa.array(column, t) for column, t in zip(zip(*each(codec, some)), types)]
                yield pa.RecordBatch.from_arrays([c.slice(start, at - start) for c in b.columns[:len(kept)]] + out, order)

    return df.select(*(F.col(f"`{f.name}`") for f in kept), *value).mapInArrow(run, StructType([*kept, *added]))


def encode(df: DataFrame, text_col: str, model_path: str, add_end: bool = True, ids_col: str = "ids", starts_col: str = "starts",
           ends_col: str = "ends", decoded_col: str | None = None, keep_text: bool = True) -> DataFrame:
    """df with the ids of every whole text and the byte span of the text that each stands for.

    With decoded_col, also the text that decoding these ids gives; without keep_text, text_col goes.
    """
    integers = ArrayType(IntegerType())

    def each(codec: PieceCodec, texts: list[str]):
        found = codec.encode_all(texts, add_end)
        return found if decoded_col is None else [(*f, codec.decode(f[0].tolist())) for f in found]

    added = [StructField(ids_col, integers), StructField(starts_col, integers), StructField(ends_col, integers)]
    if decoded_col:
        added.append(StructField(decoded_col, StringType()))
    return _map_text(df, text_col, "", model_path, added, keep_text, each)


def decode(df: DataFrame, ids_col: str, model_path: str, out_col: str = "decoded") -> DataFrame:
    """df with the text that its ids stand for."""
    return _map_text(df, ids_col, [], model_path, [StructField(out_col, StringType())], True,
                     lambda codec, rows: [(codec.decode(ids),) for ids in rows])
