"""Byte-level BPE encoding and decoding with the ranks of a public tokenizer.

Pre-tokenisation works on arrays of code-point classes instead of a regular
expression. Every code point becomes one of nine symbols (letter, number,
other, apostrophe that opens a contraction of one or two letters, space or
other white space before a visible character, white space before white space or
the end, end of text). A symbol is a function on eight states; composing these
functions is associative, so blocks of the text are composed side by side, the
blocks' functions are combined by a prefix scan, and a second pass marks in
every block where a piece begins. The result is the split of the pattern

    's|'t|'re|'ve|'m|'ll|'d| ?\\p{L}+| ?\\p{N}+| ?[^\\s\\p{L}\\p{N}]+|\\s+(?!\\S)|\\s+

Pieces are merged by rank, with a cache of at most ``CACHE`` pieces per task.
Token offsets (bytes) are kept beside the ids; decoding places the tokens'
bytes at these offsets.

Inputs: null text counts as empty and gives no ids; texts of any length are
encoded whole (over ``CHUNK`` code points they are cut before a space that
follows a visible character, where a piece begins in any context); ids that are
null decode to empty bytes, ids outside the vocabulary make ``decoded`` null.
The added columns replace columns of the same name; others pass through.
"""

from __future__ import annotations

import base64
import heapq
import unicodedata
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Code points worked on at once, and pieces cached per task.
CHUNK, CACHE = 1 << 18, 400_000
#: Code points of a block of the scan, and bytes of a piece merged without a heap.
BLOCK, SHORT = 512, 64
END = 0x110000
#: The code points that \s stands for (Unicode White_Space).
WHITE_SPACE = [*range(9, 14), 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]
# Letters and numbers of Unicode 16, which the tokenizer library
# knows, that the character database of older Python versions leaves unassigned.
LETTERS_16 = [
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85), (0x10EC2, 0x10EC4),
    (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5), (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3),
    (0x11BC0, 0x11BE0), (0x13460, 0x143FA), (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0),
]
NUMBERS_16 = [(0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79), (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA)]
LETTER, NUMBER, OTHER, APOS1, APOS2, SPACE, BLANK, WHITE, STOP = range(9)
FRESH, LETTERS, NUMBERS, OTHERS, WHITES, PREFIX, TAIL1, TAIL2 = STATES = range(8)


def transitions() -> tuple[np.ndarray, np.ndarray]:
    """(symbol x state -> next state, symbol x state -> a piece begins here)."""
    step, cut = np.zeros((9, 8), dtype=np.uint8), np.ones((9, 8), dtype=bool)
    for symbol, to in ((LETTER, LETTERS), (NUMBER, NUMBERS), (OTHER, OTHERS), (APOS1, TAIL1), (APOS2, TAIL2), (SPACE, PREFIX), (BLANK, FRESH), (WHITE, WHITES), (STOP, FRESH)):
        step[symbol] = to
    for symbol, states, to in (
        (LETTER, (LETTERS, PREFIX), LETTERS), (LETTER, (TAIL1,), FRESH), (LETTER, (TAIL2,), TAIL1), (NUMBER, (NUMBERS, PREFIX), NUMBERS),
        (OTHER, (OTHERS, PREFIX), OTHERS), (APOS1, (OTHERS, PREFIX), OTHERS), (APOS2, (OTHERS, PREFIX), OTHERS), (WHITE, (WHITES,), WHITES),
    ):
        for s in states:
            step[symbol, s], cut[symbol, s] = to, False
    return step, cut


def code_point_classes() -> np.ndarray:
    """LETTER, NUMBER, OTHER or WHITE of each code point; STOP for the end."""
    kinds = {"L": LETTER, "N": NUMBER}
    table = np.fromiter((kinds.get(c[0], OTHER) for c in map(unicodedata.category, map(chr, range(END)))), dtype=np.uint8, count=END)
    for ranges, kind in ((LETTERS_16, LETTER), (NUMBERS_16, NUMBER)):
        for first, last in ranges:
            table[first:last + 1] = kind
    table[WHITE_SPACE] = WHITE
    return np.append(table, np.uint8(STOP))


def symbols(cps: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Symbol of each code point; looks at the two code points that follow."""
    sym = classes[cps]
    pad = np.concatenate([cps, np.array([END, END], dtype=cps.dtype)])
    one, two = pad[1:-1], pad[2:]
    nxt = np.append(sym[1:], np.uint8(STOP))
    last = (sym == WHITE) & (nxt != WHITE) & (nxt != STOP)
    sym = np.where(last, np.where(cps == 32, SPACE, BLANK), sym).astype(np.uint8)
    apostrophe = np.flatnonzero(cps == 39)
    a, b = one[apostrophe], two[apostrophe]
    sym[apostrophe[np.isin(a, [ord(c) for c in "stmd"])]] = APOS1
    pair = ((a == ord("r")) | (a == ord("v"))) & (b == ord("e")) | (a == ord("l")) & (b == ord("l"))
    sym[apostrophe[pair]] = APOS2
    return sym


def piece_starts(sym: np.ndarray, step: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """Positions where a piece begins, by an associative scan over blocks."""
    n = len(sym)
    rows = -(-n // BLOCK)
    grid = np.full(rows * BLOCK, STOP, dtype=np.int64)
    grid[:n] = sym
    grid = np.ascontiguousarray(grid.reshape(rows, BLOCK).T) * 8
    flat, flags = step.ravel(), cut.ravel()
    through = np.tile(np.arange(8, dtype=np.uint8), (rows, 1))  # each block as a function on states
    for column in grid:
        through = flat[column[:, None] + through]
    shift = 1
    while shift < rows:  # prefix composition: doubled spans
        through[shift:] = np.take_along_axis(through[shift:], through[:-shift], axis=1)
        shift *= 2
    state = np.concatenate([[FRESH], through[:-1, FRESH]]).astype(np.uint8)
    begins = np.empty((BLOCK, rows), dtype=bool)
    for i, column in enumerate(grid):
        at = column + state
        begins[i] = flags[at]
        state = flat[at]
    return np.flatnonzero(begins.T.ravel()[:n])


def merge(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """Ids of a piece: the adjacent pair of the lowest rank, the leftmost of
    equal ones, is merged until none is left."""
    if (whole := ranks.get(piece)) is not None:
        return (whole,)
    n = len(piece)
    if n <= SHORT:
        return _merge_short(piece, ranks)
    end = list(range(1, n + 1))  # end[i]: end of the part that starts at i
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, stop = heapq.heappop(heap)
        if end[i] == 0 or (mid := end[i]) >= stop or end[mid] != stop:
            continue  # one of the two parts has been merged meanwhile
        end[i], end[mid] = stop, 0
        if stop < n:
            before[stop] = i
            if (r := ranks.get(piece[i:end[stop]])) is not None:
                heapq.heappush(heap, (r, i, end[stop]))
        if (p := before[i]) >= 0 and (r := ranks.get(piece[p:stop])) is not None:
            heapq.heappush(heap, (r, p, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return tuple(out)


def _merge_short(piece: bytes, ranks: dict[bytes, int]) -> tuple[int, ...]:
    """The same, looking for the lowest pair in a short list."""
    get, none = ranks.get, 1 << 31
    cuts = list(range(len(piece) + 1))
    pairs = [get(piece[i:i + 2], none) for i in cuts[:-2]]
    while pairs and (low := min(pairs)) != none:
        i = pairs.index(low)
        del cuts[i + 1], pairs[i]
        if i < len(pairs):
            pairs[i] = get(piece[cuts[i]:cuts[i + 2]], none)
        if i:
            pairs[i - 1] = get(piece[cuts[i - 1]:cuts[i + 1]], none)
    return tuple(ranks[piece[a:b]] for a, b in zip(cuts, cuts[1:]))


class Pieces(dict):
    """Piece -> its number; ids and id counts of all numbers are in arrays. The
    cache is emptied (between texts) when it has ``CACHE`` pieces."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks, self.ids, self.ends = ranks, array("i"), array("q", [0])

    def __missing__(self, piece: bytes) -> int:
        self.ids.extend(merge(piece, self.ranks))
        self.ends.append(len(self.ids))
        self[piece] = k = len(self)
        return k

    def of(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each piece, all ids)."""
        if len(self) >= CACHE:
            self.clear()
            self.ids, self.ends = array("i"), array("q", [0])
        number = np.fromiter(map(self.__getitem__, pieces), dtype=np.int64, count=len(pieces))
        ends, pool = np.frombuffer(self.ends, np.int64), np.frombuffer(self.ids, np.int32)  # views, gone before the next piece
        counts = ends[number + 1] - ends[number]
        first = np.cumsum(counts) - counts
        return counts, pool[np.repeat(ends[number] - first, counts) + np.arange(int(counts.sum()))].astype(np.int64)


def read_ranks(rank_file: bytes) -> dict[bytes, int]:
    return {base64.b64decode(a): int(b) for a, b in map(bytes.split, rank_file.splitlines())}


class Tokens:
    """The bytes of all tokens in one array, and where each token's lie."""

    def __init__(self, ranks: dict[bytes, int]):
        tokens = [b""] * (max(ranks.values()) + 1)
        for token, r in ranks.items():
            tokens[r] = token
        self.known = np.zeros(len(tokens), dtype=bool)
        self.known[list(ranks.values())] = True
        self.sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        self.places = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def decode(self, ids: np.ndarray, offsets: np.ndarray | None = None) -> bytes | None:
        """Bytes of the ids; null if one is not in the vocabulary."""
        if not len(ids):
            return b""
        if ids.min() < 0 or ids.max() >= len(self.sizes) or not self.known[ids].all():
            return None
        size = self.sizes[ids]
        starts = np.cumsum(size) - size if offsets is None else offsets
        return self.bytes[np.arange(int(size.sum())) + np.repeat(self.places[ids] - starts, size)].tobytes()


class Codec:
    """Ranks, classes and scan tables, held once per task."""

    def __init__(self, rank_file: bytes, classes: np.ndarray):
        self.ranks = read_ranks(rank_file)
        self.classes, (self.step, self.cut) = classes, transitions()
        self.cache, self.tokens = Pieces(self.ranks), Tokens(self.ranks)
        self.decode = self.tokens.decode

    def pieces(self, cps: np.ndarray) -> np.ndarray:
        return piece_starts(symbols(cps, self.classes), self.step, self.cut)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(number of ids of each text, all ids, byte offset of each id in its
        text). Texts are scanned together, an end symbol after each."""
        raw = [t.encode("utf-32-le") for t in texts]
        cps = np.frombuffer(b"".join(x + END.to_bytes(4, "little") for x in raw), dtype="<u4")
        stops = np.cumsum([len(x) // 4 + 1 for x in raw]) - 1
        width = 1 + (cps >= 0x80).astype(np.int64) + (cps >= 0x800) + (cps >= 0x10000)
        width[stops] = 0
        at = np.cumsum(width) - width
        starts = self.pieces(cps)
        text_of = np.searchsorted(stops, starts)
        real = starts != stops[text_of]
        starts, text_of = starts[real], text_of[real]
        buffer = "".join(texts).encode("utf-8")
        a = at[starts]
        b = np.append(a[1:], len(buffer)).tolist()
        per_piece, flat = self.cache.of([buffer[i:j] for i, j in zip(a.tolist(), b)])
        per_text = np.bincount(text_of, weights=per_piece, minlength=len(texts)).astype(np.int64)
        size = self.tokens.sizes[flat]
        offsets = np.cumsum(size) - size - np.repeat(at[np.concatenate([[0], stops[:-1] + 1])] if texts else [], per_text)
        return per_text, flat, offsets


def chunks(text: str, limit: int = CHUNK) -> Iterator[str]:
    """Parts of a text that can be encoded apart: each ends before a space that
    follows a visible character."""
    i = 0
    while len(text) - i > limit:
        j = text.find(" ", i + limit)
        while j > 0 and (ord(text[j - 1]) in WHITE_SPACE):
            j = text.find(" ", j + 1)
        if j < 0:
            break
        yield text[i:j]
        i = j
    yield text[i:]


def _codec_source(df: DataFrame, path: str):
    """Rank file and code-point classes (about 2 MB) for the tasks."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast((f.read(), code_point_classes()))


def _with(df: DataFrame, fields: list[T.StructField], drop: tuple[str, ...] = ()) -> tuple[DataFrame, T.StructType]:
    names = {f.name.lower() for f in fields} | {d.lower() for d in drop}
    base = df.select(*(F.col(f"`{c}`") for c in df.columns if c.lower() not in names))
    return base, T.StructType([*base.schema.fields, *fields])


def _lists(counts: np.ndarray, values: np.ndarray, packed: bool) -> pa.Array:
    ends = np.concatenate([[0], np.cumsum(counts)])
    if packed:
        return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer((ends * 4).astype(np.int32)), pa.py_buffer(values.astype("<u4"))])
    return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(values.astype(np.int32)))


def encode(df: DataFrame, path: str, text_col: str = "text", packed: bool = False, keep_text: bool = True, decoded: bool = False) -> DataFrame:
    """Add n_tokens (long), ids and starts (byte offset of each id): arrays of
    int, or with ``packed`` binaries of little-endian unsigned 32-bit integers.
    With ``decoded`` the ids are decoded again in the same task, into a binary."""
    kind = T.BinaryType() if packed else T.ArrayType(T.IntegerType(), False)
    fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids", kind), T.StructField("starts", kind)]
    fields += [T.StructField("decoded", T.BinaryType())] if decoded else []
    base, schema = _with(df, fields, () if keep_text else (text_col,))
    source = base.withColumn("__bpe_text", df[f"`{text_col}`"]) if keep_text else df.select(*(df[f"`{f.name}`"] for f in base.schema.fields), df[f"`{text_col}`"].alias("__bpe_text"))
    shared = _codec_source(df, path)

    def run(batches):
        codec = Codec(*shared.value)
        for batch in batches:
            texts = batch.column(batch.num_columns - 1)
            for lo, hi in _slices(texts):
                parts, owner = [], []
                for k, t in enumerate(texts.slice(lo, hi - lo).to_pylist()):
                    for p in chunks(t or ""):
                        parts.append(p)
                        owner.append(k)
                per_part, ids, offsets = codec.encode(parts)
                owner = np.array(owner, dtype=np.int64)
                sizes = np.array([len(p.encode()) for p in parts], dtype=np.int64) if len(parts) > hi - lo else None
                if sizes is not None:  # offsets of the later parts of a text start after its earlier ones
                    first = np.concatenate([[True], owner[1:] != owner[:-1]])
                    ahead = np.cumsum(sizes) - sizes
                    offsets = offsets + np.repeat(ahead - np.maximum.accumulate(np.where(first, ahead, 0)), per_part)
                counts = np.bincount(owner, weights=per_part, minlength=hi - lo).astype(np.int64)
                rest = [batch.column(c).slice(lo, hi - lo) for c in range(batch.num_columns - 1)]
                arrays = [*rest, pa.array(counts), _lists(counts, ids, packed), _lists(counts, offsets, packed)]
                if decoded:
                    ends = np.cumsum(counts)
                    arrays.append(pa.array([codec.decode(ids[e - n:e], offsets[e - n:e]) for e, n in zip(ends.tolist(), counts.tolist())], pa.binary()))
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return source.mapInArrow(run, schema)


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``CHUNK`` bytes of text, at least one row each."""
    sizes = [len(x.as_buffer()) if x.is_valid else 0 for x in texts]
    lo, held = 0, 0
    for k, n in enumerate(sizes):
        if held and held + n > CHUNK:
            yield lo, k
            lo, held = k, 0
        held += n
    if lo < len(sizes):
        yield lo, len(sizes)


def decode(df: DataFrame, path: str, ids_col: str = "ids", starts_col: str | None = "starts") -> DataFrame:
    """Add ``decoded`` (binary), and drop ids and starts. Takes arrays or packed
    binaries; without ``starts_col`` offsets follow from the token lengths."""
    used = [ids_col, *([starts_col] if starts_col else [])]
    base, schema = _with(df, [T.StructField("decoded", T.BinaryType())], tuple(used))
    source = df.select(*(df[f"`{f.name}`"] for f in base.schema.fields), *(df[f"`{c}`"].alias(f"__bpe_{i}") for i, c in enumerate(used)))
    with open(path, "rb") as f:
        shared = df.sparkSession.sparkContext.broadcast(f.read())

    def numbers(x) -> np.ndarray:
        if not x.is_valid:
            return np.zeros(0, dtype=np.int64)
        if pa.types.is_binary(x.type) or pa.types.is_large_binary(x.type):
            return np.frombuffer(x.as_buffer(), dtype="<u4").astype(np.int64)
        return x.values.to_numpy(zero_copy_only=False).astype(np.int64)

    def run(batches):
        tokens = Tokens(read_ranks(shared.value))
        n = len(schema.names) - 1
        for batch in batches:
            for lo in range(0, batch.num_rows, 256):
                part = batch.slice(lo, 256)
                out = [tokens.decode(*(numbers(part.column(n + k)[r]) for k in range(len(used)))) for r in range(part.num_rows)]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in range(n)), pa.array(out, type=pa.binary())], names=schema.names)

    return source.mapInArrow(run, schema)
