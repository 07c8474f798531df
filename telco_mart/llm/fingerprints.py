"""Document fingerprints: 64-bit SimHash of weighted terms, and a search for all
fingerprints within a Hamming radius through permuted block tables.

Each term (a lower-cased word) votes with the weight 1 + ln(count) on the bits
of its XXH64 hash: for a one bit, against a zero bit; the fingerprint has the
bits with a positive sum. For a search the 64 bits are cut into ``radius * 2``
blocks. Two fingerprints that differ in at most ``radius`` bits agree in at
least half of the blocks, so there is a table for every choice of that half,
with the chosen blocks permuted to the front as the table's key.

Inputs: null text counts as empty; a text without words has fingerprint zero;
equal texts have equal fingerprints; rows may repeat. Only the id and text
columns are read. Empty tables give empty results.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import as_long, groups, signed, written

#: Terms whose bits are summed at once.
CHUNK = 1 << 15
#: Rows compared at once in a search.
BLOCK = 1 << 20


def fingerprint(text: str) -> int:
    """Weighted SimHash. Sums are exact: weights are integers (1/1024)."""
    counts = Counter(text.lower().encode("utf-8", "replace").split())
    if not counts:
        return 0
    votes, digest = np.zeros(64, dtype=np.int64), xxhash.xxh64_intdigest
    h = np.fromiter(map(digest, counts), dtype=np.uint64, count=len(counts))
    w = np.rint(1024 * (1 + np.log(np.fromiter(counts.values(), dtype=np.float64, count=len(counts))))).astype(np.int64)
    for i in range(0, len(h), CHUNK):
        bits = np.unpackbits(h[i:i + CHUNK].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").astype(np.float64)
        votes += (2 * (w[i:i + CHUNK].astype(np.float64) @ bits)).astype(np.int64) - int(w[i:i + CHUNK].sum())
    return int(np.packbits(votes > 0, bitorder="little").view("<u8")[0])


def likeness(a: int, b: int) -> float:
    return 1 - (a ^ b).bit_count() / 64


def edited(text: str, following: str) -> str:
    """The text with its last floor(n / 2) code points replaced by the first as
    many (or all) of the following text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


COLUMNS = "n_chars long, edited_sha256 string, fp long, edited_fp long, near_edited double, near_next double"


def _columns(id_type: T.DataType, more: str) -> T.StructType:
    return T.StructType([T.StructField("id", id_type), *T.StructType.fromDDL(f"{COLUMNS}{more}").fields])


def _compared(own: tuple, following: tuple) -> tuple:
    (rid, text, fp), (_, after, after_fp) = own, following
    new = edited(text, after)
    new_fp = fingerprint(new)
    return rid, len(text), hashlib.sha256(new.encode("utf-8", "replace")).hexdigest(), fp, new_fp, likeness(fp, new_fp), likeness(fp, after_fp)


def with_next(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fp, edited_fp, near_edited, near_next): each
    document against its edited text and the next document in order of id (after
    the last: the first; equal ids in order of text, null ids first).

    Documents are dealt by ranges of the id and sorted inside them, one shuffle
    of the texts; each task walks its range with one document in hand. The last
    document of a range meets the first of the next range in a second step over
    two rows per range.
    """
    src = df.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ordered = src.repartitionByRange("id").sortWithinPartitions("id", "text")
    schema = _columns(src.schema[0].dataType, ", edge int, text string")

    def walk(batches):
        held = first = None
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                out = []
                for rid, text in zip(*(c.to_pylist() for c in b.slice(lo, 256).columns)):
                    now = (rid, text, fingerprint(text))
                    if held is not None:
                        out.append((*_compared(held, now), 0, None))
                    else:
                        first = now
                    held = now
                yield batch(out)
        if held is not None:  # edges: the range's first and last document
            yield batch([(r[0], None, None, r[2], None, None, None, edge, r[1]) for edge, r in ((1, first), (2, held))])

    def batch(rows):
        kinds = [arrow_id, pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.int32(), pa.string()]
        cols = list(zip(*rows)) if rows else [()] * 9
        cols[3:5] = [[None if x is None else as_long(x) for x in c] for c in cols[3:5]]
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(cols, kinds)], names=schema.names)

    arrow_id = _arrow(src.schema[0].dataType)
    walked = written(ordered.mapInArrow(walk, schema), "walked")
    edges = walked.filter("edge > 0").select("id", "fp", "edge", "text")

    def meet(batches):  # all edges in order: first, last, first, last, ... (a range of one document gives both)
        rows = [r for b in batches for r in zip(*(c.to_pylist() for c in b.columns))]
        starts, ends = rows[0::2], rows[1::2]
        out = [(*_compared((e[0], e[2], e[1] & M), (n[0], n[2], n[1] & M)), 0, None) for e, n in zip(ends, starts[1:] + starts[:1])]
        yield batch(out)

    M = (1 << 64) - 1
    met = edges.select("id", "fp", "text", "edge").repartition(1).sortWithinPartitions("id", "text", "edge").mapInArrow(meet, schema)
    return walked.filter("edge = 0").unionByName(met).drop("edge", "text")


def _arrow(t: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(t)


def block_masks(radius: int) -> list[int]:
    """Keys of the permuted tables: half of 2 * radius blocks, in every choice."""
    n = max(2 * radius, 2)
    cuts = [round(64 * k / n) for k in range(n + 1)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(c) for c in combinations(blocks, n - radius)] if radius else [(1 << 64) - 1]


def search(fps: DataFrame, radius: int = 3) -> DataFrame:
    """(fp, n_near): for each distinct query fingerprint the number of rows
    within ``radius`` bits. ``fps`` has (fp, n, asked): distinct fingerprints,
    their row counts and whether they are queries.

    A pair that agrees in several tables is counted in the first. Each bucket's
    values are dealt to salts when there are many of them (their number is
    counted first), with its queries in every salt, so no task gets an unbounded
    bucket; results are sums, so nothing grows with the number of pairs.
    """
    masks = block_masks(radius)
    tables = F.explode(F.array(*(F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(as_long(m))).alias("key")) for k, m in enumerate(masks))))
    rows = fps.select(tables.alias("b"), "fp", "n", "asked").select("b.t", "b.key", "fp", "n", "asked")
    sizes = rows.groupBy("t", "key").agg(F.count("*").alias("size"), F.max("asked").alias("any")).filter("any").select(
        "t", "key", F.ceil(F.col("size") / SALT_ROWS).cast("int").alias("salts"))
    dealt = rows.join(sizes, ["t", "key"])
    own = F.pmod(F.xxhash64("fp"), F.col("salts")).cast("int")
    salts = F.when(F.col("asked"), F.sequence(F.lit(0), F.col("salts") - 1)).otherwise(F.array(own))
    dealt = dealt.withColumn("salt", F.explode(salts)).select("t", "key", "salt", "fp", (F.when(F.col("salt") == own, F.col("n")).otherwise(0)).alias("n"), "asked")

    def count(batches):
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            cols = [c.to_numpy(zero_copy_only=False) for c in b.columns]
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]) | (cols[2] != cols[2][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            held = [c[cut:] for c in cols]
            yield tally([c[:cut] for c in cols])
        if held is not None:
            yield tally(held)

    def tally(cols):
        t, key, salt, fp, n, asked = cols
        fp, out, total = fp.view(np.uint64), [], []
        for i, j in groups(t, key, salt):
            ask = np.flatnonzero(asked[i:j]) + i
            earlier = [np.uint64(m) for m in masks[: int(t[i])]]
            step = max(1, BLOCK // (j - i))
            for k in range(0, len(ask), step):
                q = fp[ask[k:k + step]]
                diff = q[:, None] ^ fp[None, i:j]
                a, b = np.nonzero(np.bitwise_count(diff) <= radius)
                d, keep = diff[a, b], np.ones(len(a), dtype=bool)
                for m in earlier:
                    keep &= (d & m) != 0
                total.append(np.bincount(a[keep], weights=n[i:j][b[keep]], minlength=len(q)).astype(np.int64))
                out.append(q)
        join = lambda x, kind: np.concatenate(x) if x else np.zeros(0, dtype=kind)
        return pa.RecordBatch.from_arrays([pa.array(signed(join(out, np.uint64))), pa.array(join(total, np.int64))], names=["fp", "n_near"])

    placed = dealt.repartition("t", "key", "salt").sortWithinPartitions("t", "key", "salt")
    return placed.mapInArrow(count, "fp long, n_near long").groupBy("fp").agg(F.sum("n_near").alias("n_near"))


#: Values of a bucket per salt.
SALT_ROWS = 100_000
