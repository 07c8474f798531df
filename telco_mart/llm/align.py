"""Cross-tokenizer alignment by products of sparse incidence matrices.

Tokenizer A is a byte-level BPE read from a tokenizer file, tokenizer B a
sentence-piece model. A encodes a space and the text, B the text, to which it
adds that space, so that both cover the same bytes. Over these bytes A and B
are token-byte incidence matrices in compressed rows: a token's row has a one
for each of its bytes. The product of A and B' has an entry for every pair of
tokens that share bytes (an overlap link; its value is how many), and is made
row by row by Gustavson's rule. Offsets where tokens of both end cut the text
into groups; the product of the two token-group matrices has an entry for each
pair of tokens of one group (a shared-group link), and is counted from the row
sizes of its factors unless its entries are asked for.

Many texts are worked on as one block-diagonal matrix: both tokenisations end
with each text. Token ids are written once; a pass counts in how many documents
each id pair is linked (distinct pairs of a document, added up in tasks, then by
an aggregate on the pair); another pass looks the counts up. The table of pairs
is broadcast up to ``TABLE`` pairs of counted size; above it the links are
joined to it by pair, salted, and added up by row.

Inputs: null and empty texts, and texts whose joined token bytes differ from
space and text, have no tokens: zeros and empty groups. Repeated rows and null
ids count row by row; texts of any length are encoded whole; empty tables give
empty results. Only the id and text columns are read.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from telco_mart.operators.lookup import join_lookup

from .common import written
from .csr import membership, products, row_terms, spans, transposed

#: Bytes of text worked on at once; distinct pairs that a task holds before it
#: hands their counts on; pairs of a table that may be broadcast (16 bytes each).
SLICE, HELD, TABLE = 1 << 18, 1_000_000, 4_000_000
#: What splits a text before byte pairs are merged, as the tokenizer file's
#: byte-level step does.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Sentence-piece's mark of a space.
SPACE = "▁"


def byte_alphabet() -> dict[str, int]:
    """The byte that each letter of a byte-level vocabulary stands for: visible
    Latin-1 characters for themselves, the others in order from U+0100."""
    visible = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = [b for b in range(256) if b not in set(visible)]
    return {chr(b): b for b in visible} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Tokenizers:
    """Both tokenizers and the bytes of their tokens, held once per task.

    The byte-level BPE of the file (no normaliser, no added space, pairs merged
    in the order of ids) is run by a byte-pair library on its own entries; the
    tests hold the ids against the file's library."""

    def __init__(self, a_file: bytes, b_model: bytes):
        content, letters = json.loads(a_file), byte_alphabet()
        special = {t["content"] for t in content["added_tokens"]}
        ranks = {bytes(letters[c] for c in entry): i for entry, i in content["model"]["vocab"].items() if entry not in special}
        self.a = tiktoken.Encoding("a", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b = SentencePieceProcessor(model_proto=b_model)
        self.a_bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.a_bytes[i] = token
        self.a_sizes = [len(t) for t in self.a_bytes]
        self.b_bytes = [self.piece_bytes(self.b.id_to_piece(i)) for i in range(self.b.get_piece_size())]

    @staticmethod
    def piece_bytes(piece: str) -> bytes:
        if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
            return bytes([int(piece[3:5], 16)])
        return piece.replace(SPACE, " ").encode()

    def encode(self, texts: list[str | None]) -> Iterator[tuple[list[int], list[int]]]:
        """Ids of A and B; none for texts that the two do not cover equally."""
        full = [i for i, t in enumerate(texts) if t]
        pieces = dict(zip(full, self.b.encode([texts[i] for i in full], num_threads=1)))
        for i, text in enumerate(texts):
            if i not in pieces:
                yield [], []
                continue
            a, b, whole = self.a.encode_ordinary(" " + text), pieces[i], b" " + text.encode()
            # A's tokens are slices of the text in their order: they join to it if none is lost
            same = sum(map(self.a_sizes.__getitem__, a)) == len(whole) and b"".join(map(self.b_bytes.__getitem__, b)) == whole
            yield (a, b) if same else ([], [])


def _slices(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``SLICE`` bytes of text, at least one row each."""
    lo, held = 0, 0
    for k, x in enumerate(texts):
        n = len(x.as_buffer()) if x.is_valid else 0
        if held and held + n > SLICE:
            yield lo, k
            lo, held = k, 0
        held += n
    if lo < len(texts):
        yield lo, len(texts)


def _packed(lists: list[list[int]], kind: str) -> pa.Array:
    return pa.array([np.array(x, dtype=kind).tobytes() for x in lists], pa.binary())


def _source(df: DataFrame, a_path: str, b_path: str):
    """The tokenizers' files (under 3 MB) for the tasks."""
    with open(a_path, "rb") as a, open(b_path, "rb") as b:
        return df.sparkSession.sparkContext.broadcast((a.read(), b.read()))


def encode(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, id, a_ids, b_ids): a key of each row and its ids as little-endian
    unsigned 32-bit integers, empty where the text has no tokens."""
    shared = _source(df, a_path, b_path)
    source = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))

    def run(batches):
        tokenizers, row = Tokenizers(*shared.value), TaskContext.get().partitionId() << 33
        for batch in batches:
            texts = batch.column(1)
            for lo, hi in _slices(texts):
                a, b = zip(*tokenizers.encode(texts.slice(lo, hi - lo).to_pylist()))
                rows = pa.array(np.arange(row, row + hi - lo))
                row += hi - lo
                yield pa.RecordBatch.from_arrays([rows, batch.column(0).slice(lo, hi - lo), _packed(a, "<u4"), _packed(b, "<u4")], names=["row", "id", "a_ids", "b_ids"])

    return source.mapInArrow(run, f"row long, id {source.schema['id'].dataType.simpleString()}, a_ids binary, b_ids binary")


@dataclass(frozen=True)
class Sizes:
    """Bytes of the tokens of both tokenizers, by id."""

    a: np.ndarray
    b: np.ndarray

    @classmethod
    def of(cls, a_path: str, b_path: str) -> "Sizes":
        with open(a_path, "rb") as a, open(b_path, "rb") as b:
            t = Tokenizers(a.read(), b.read())
        return cls(np.array([len(x) for x in t.a_bytes]), np.array([len(x) for x in t.b_bytes]))

    def pair(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return a * len(self.b) + b


class Aligned:
    """The matrices of some documents side by side, on their joined bytes."""

    def __init__(self, a_ids: list[np.ndarray], b_ids: list[np.ndarray], sizes: Sizes):
        self.docs = len(a_ids)
        self.a_doc, self.b_doc = (np.repeat(np.arange(self.docs), [len(x) for x in ids]) for ids in (a_ids, b_ids))
        join = lambda ids: np.concatenate(ids).astype(np.int64) if ids else np.zeros(0, dtype=np.int64)
        self.a, self.b = join(a_ids), join(b_ids)
        a_ends, b_ends = np.cumsum(sizes.a[self.a]), np.cumsum(sizes.b[self.b])
        self.a_bytes, self.b_bytes = spans(a_ends), spans(b_ends)
        cuts = np.intersect1d(a_ends, b_ends, assume_unique=True)
        self.groups = len(cuts)
        self.a_group, self.b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)

    def links(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(A token, B token, shared bytes) of every overlap link."""
        parts = list(products(self.a_bytes, transposed(self.b_bytes)))
        return tuple(np.concatenate(x) for x in zip(*parts)) if parts else (np.zeros(0, dtype=np.int64),) * 3

    def shared_group_links(self) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(A token, B token, 1) of the pairs of one group, in blocks."""
        yield from products(membership(self.a_group, self.groups), transposed(membership(self.b_group, self.groups)))

    def per_doc(self, doc: np.ndarray, weights: np.ndarray | None = None) -> np.ndarray:
        """Exact sums (or counts) by document."""
        if weights is None:
            return np.bincount(doc, minlength=self.docs)
        out = np.zeros(self.docs, dtype=np.int64)
        np.add.at(out, doc, weights)
        return out

    def shared_counts(self) -> np.ndarray:
        """Shared-group links of each document: a row of the product has as many
        entries as its only group has B tokens."""
        each = row_terms(membership(self.a_group, self.groups), transposed(membership(self.b_group, self.groups)))
        return self.per_doc(self.a_doc, each)

    def group_counts(self) -> np.ndarray:
        first = np.flatnonzero(np.diff(self.a_group, prepend=-1))
        return self.per_doc(self.a_doc[first])

    def texts(self, names: np.ndarray, sizes: Sizes) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each document, from the ``id_names``."""
        side = np.concatenate([self.a_group * 2, self.b_group * 2 + 1])
        order = np.argsort(side, kind="stable")
        closes = np.append(side[order][1:] != side[order][:-1], True)
        n, m = len(sizes.a), len(sizes.b)
        code = np.concatenate([self.a, self.b + 2 * n])[order] + np.where(closes, np.where(order < len(self.a), n, m), 0)
        words = names[code].tolist()
        ends = np.cumsum(self.per_doc(self.a_doc) + self.per_doc(self.b_doc)).tolist()
        return ["".join(words[i:j])[:-1] for i, j in zip([0, *ends], ends)]


def id_names(sizes: Sizes) -> np.ndarray:
    """Ids of A with the mark inside their list, then with the one at its end,
    then those of B."""
    return np.array([f"{i}{mark}" for s, marks in ((sizes.a, ",|"), (sizes.b, ",;")) for mark in marks for i in range(len(s))], dtype=object)


def _aligned(batch: pa.RecordBatch, sizes: Sizes) -> Iterator[tuple[pa.RecordBatch, Aligned]]:
    """Parts of a batch of ``encode`` rows with about ``SLICE`` bytes of ids."""
    a, b = batch.schema.get_field_index("a_ids"), batch.schema.get_field_index("b_ids")
    for lo, hi in _slices(batch.column(a)):
        part = batch.slice(lo, hi - lo)
        ids = ([np.frombuffer(x.as_buffer(), "<u4") for x in part.column(k)] for k in (a, b))
        yield part, Aligned(*ids, sizes)


def _added(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(key):
        return key, n
    order = np.argsort(key, kind="stable")
    key, n = key[order], n[order]
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[start], np.add.reduceat(n, start)


def _doc_pairs(aligned: Aligned, sizes: Sizes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair, links) of the distinct id pairs that each document links."""
    i, j, _ = aligned.links()
    span = len(sizes.a) * len(sizes.b)
    key, n = _added(aligned.a_doc[i] * span + sizes.pair(aligned.a[i], aligned.b[j]), np.ones(len(i), dtype=np.int64))
    return key // span, key % span, n


def pair_counts(encoded: DataFrame, sizes: Sizes) -> DataFrame:
    """(pair, n, best): documents that hold each id pair linked, and whether no
    other pair of the same A id is held by more."""

    def run(batches):
        key, n = np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        fresh, size = [], 0
        for batch in batches:
            for _, aligned in _aligned(batch, sizes):
                fresh.append(_doc_pairs(aligned, sizes)[1])
                size += len(fresh[-1])
                if size >= HELD:
                    key, n = _added(np.concatenate([key, *fresh]), np.concatenate([n, np.ones(size, dtype=np.int64)]))
                    fresh, size = [], 0
                    if len(key) >= HELD:
                        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["pair", "n"])
                        key, n = key[:0], n[:0]
        key, n = _added(np.concatenate([key, *fresh]), np.concatenate([n, np.ones(size, dtype=np.int64)]))
        yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["pair", "n"])

    counts = encoded.select("a_ids", "b_ids").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    a_id = Window.partitionBy(F.floor(F.col("pair") / len(sizes.b)))  # no more rows than B has ids
    return counts.withColumn("best", F.col("n") == F.max("n").over(a_id))


def doc_links(encoded: DataFrame, sizes: Sizes) -> DataFrame:
    """(row, pair, links): the distinct id pairs of each document."""

    def run(batches):
        for batch in batches:
            for part, aligned in _aligned(batch, sizes):
                doc, pair, n = _doc_pairs(aligned, sizes)
                rows = part.column(part.schema.get_field_index("row")).take(pa.array(doc))
                yield pa.RecordBatch.from_arrays([rows, pa.array(pair), pa.array(n)], names=["row", "pair", "links"])

    return encoded.select("row", "a_ids", "b_ids").mapInArrow(run, "row long, pair long, links long")


def token_links(encoded: DataFrame, sizes: Sizes, shared_groups: bool = False) -> DataFrame:
    """(row, a, b, value) of every link, a and b being token numbers inside the
    document: overlap links with the bytes that they share, or shared-group
    links (value 1), which are made and handed on block by block."""

    def run(batches):
        for batch in batches:
            for part, aligned in _aligned(batch, sizes):
                rows = part.column(part.schema.get_field_index("row"))
                a_first, b_first = (np.cumsum(n) - n for n in (aligned.per_doc(aligned.a_doc), aligned.per_doc(aligned.b_doc)))
                for i, j, value in aligned.shared_group_links() if shared_groups else [aligned.links()]:
                    doc = aligned.a_doc[i]
                    yield pa.RecordBatch.from_arrays([rows.take(pa.array(doc)), pa.array(i - a_first[doc]), pa.array(j - b_first[doc]), pa.array(value)], names=["row", "a", "b", "value"])

    return encoded.select("row", "a_ids", "b_ids").mapInArrow(run, "row long, a long, b long, value long")


def described(encoded: DataFrame, sizes: Sizes, table: DataFrame | None = None) -> DataFrame:
    """(row, id, n_a, n_b, n_groups, n_links, n_shared, groups) of every row; with
    a pair table, which each task then holds, also n_best and count_sum."""
    counted = table is not None
    if counted:
        arrow = table.orderBy("pair").toArrow()  # no more than TABLE pairs
        shared = encoded.sparkSession.sparkContext.broadcast(tuple(arrow.column(c).to_numpy() for c in ("pair", "n", "best")))
    fields = ["row", "id", "n_a", "n_b", "n_groups", "n_links", "n_shared", "groups", *(["n_best", "count_sum"] if counted else [])]
    kinds = {"id": encoded.schema["id"].dataType.simpleString(), "groups": "string"}

    def run(batches):
        names = id_names(sizes)
        for batch in batches:
            for part, aligned in _aligned(batch, sizes):
                i, j, _ = aligned.links()
                columns = [aligned.per_doc(aligned.a_doc), aligned.per_doc(aligned.b_doc), aligned.group_counts(), aligned.per_doc(aligned.a_doc[i]), aligned.shared_counts()]
                arrays = [part.column(part.schema.get_field_index(c)) for c in ("row", "id")]
                arrays += [*map(pa.array, columns), pa.array(aligned.texts(names, sizes), pa.string())]
                if counted:
                    pairs, counts, best = shared.value
                    at = np.searchsorted(pairs, sizes.pair(aligned.a[i], aligned.b[j]))
                    arrays += [pa.array(aligned.per_doc(aligned.a_doc[i], v[at])) for v in (best.astype(np.int64), counts)]
                yield pa.RecordBatch.from_arrays(arrays, names=fields)

    return encoded.mapInArrow(run, ", ".join(f"{f} {kinds.get(f, 'long')}" for f in fields))


def align(df: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text", limit: int = TABLE) -> DataFrame:
    """(id, n_a, n_b, n_groups, n_links, n_shared, n_best, count_sum, groups):
    tokens, groups and links of every row, links whose pair is the best of its A
    id, and the documents that hold each link's pair, added up over the links."""
    encoded, sizes = written(encode(df, a_path, b_path, id_col, text_col), "tokens"), Sizes.of(a_path, b_path)
    table = written(pair_counts(encoded, sizes), "pairs")
    pairs = table.count()
    if pairs <= limit:
        out = described(encoded, sizes, table)
    else:
        counted = join_lookup(doc_links(encoded, sizes), table, ["pair"], rows=pairs)
        sums = counted.groupBy("row").agg(F.sum(F.when(F.col("best"), F.col("links")).otherwise(0)).alias("n_best"), F.sum(F.col("links") * F.col("n")).alias("count_sum"))
        out = described(encoded, sizes).join(sums, "row", "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return out.select(F.col("id").alias(id_col), "n_a", "n_b", "n_groups", "n_links", "n_shared", zero("n_best"), zero("count_sum"), "groups")
