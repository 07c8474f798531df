"""SimHash near-duplicate groups by covering locality-sensitive hashing.

A 64-bit SimHash of the XXH64 hashes of a text's word shingles; two
fingerprints are linked when they differ in at most ``radius`` bits. Links are
found through structured bit masks: every bit position gets a vector of
``radius + 1`` bits, and each non-zero vector v gives the mask of the positions
whose vector has an odd product with v. At most ``radius`` differing positions
span too few dimensions, so some v is orthogonal to all of them: its mask covers
none of the differing bits and both fingerprints have the same masked value.
With radius 4 these are 31 tables of 32 to 34 bits, and no link is ever missed.

Inputs: null text counts as empty; a text without words has fingerprint zero
and is linked like any other; repeated rows and equal texts share their
fingerprint; a null id is never a component's name unless all its ids are null.
Only the id and text columns are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_long, groups, hex64, signed, written
from .components import connected_components

SEED = 42
#: Shingles whose bits are counted at once.
CHUNK = 1 << 16
#: Distinct fingerprints of a bucket that one step compares; larger buckets are
#: cut further by masks over their remaining bits.
BUCKET = 1024


def shingle_hashes(text: bytes, shingle: int) -> Iterator[np.ndarray]:
    """XXH64 of each shingle, in blocks."""
    words = text.lower().split()
    if not words:
        return
    joined, digest = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) < shingle:
        yield np.array([digest(joined, SEED)], dtype=np.uint64)
        return
    ends = np.cumsum([len(w) + 1 for w in words])
    starts, ends = [0, *ends[:-shingle].tolist()], (ends[shingle - 1:] - 1).tolist()
    for i in range(0, len(starts), CHUNK):
        yield np.array([digest(joined[a:b], SEED) for a, b in zip(starts[i:i + CHUNK], ends[i:i + CHUNK])], dtype=np.uint64)


def simhash(text: bytes | None, shingle: int) -> int:
    """Majority of each bit over all shingle hashes (a tie gives 0)."""
    ones, n = np.zeros(64, dtype=np.int64), 0
    for h in shingle_hashes(text or b"", shingle):
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
        n += len(h)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]) if n else 0


def fingerprints(df: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, fp): the fingerprint of every row, as a signed 64-bit integer."""
    src = df.select(F.col(id_col), F.col(text_col).cast("binary").alias("__text"))

    def run(batches):
        for b in batches:
            fps = np.fromiter((simhash(t.as_py(), shingle) for t in b.column(1)), dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(signed(fps))], names=[id_col, "fp"])

    return src.mapInArrow(run, f"`{id_col}` {src.schema[0].dataType.simpleString()}, fp long")


def covering_masks(positions: list[int], radius: int) -> list[int]:
    """Masks over ``positions``: any two values that differ in at most
    ``radius`` of these positions agree under at least one mask."""
    full = (1 << (radius + 1)) - 1
    vector = {p: j % full + 1 for j, p in enumerate(positions)}
    return [sum(1 << p for p in positions if bin(vector[p] & v).count("1") % 2) for v in range(1, full + 1)]


def forest(values: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """Links (a, b) that join all values within ``radius`` of each other, one
    per joined value. A value is compared only with values not yet reached, so
    a dense group takes about one pass."""
    a, b, rest = [], [], values
    while len(rest) > 1:
        root, front, rest = rest[0], [rest[0]], rest[1:]
        while front and len(rest):
            near = np.bitwise_count(rest ^ front.pop()) <= radius
            if near.any():
                found = rest[near]
                rest = rest[~near]
                front.extend(found)
                a.extend([int(root)] * len(found))
                b.extend(found.tolist())
    return a, b


def _bucket_links(rows: DataFrame, radius: int) -> DataFrame:
    """Links inside the buckets (path, key) of rows (path, key, fp)."""

    def links(path, key, fp):
        a, b = [], []
        for i, j in groups(path, key):
            if j - i > 1:
                x, y = forest(np.unique(fp[i:j]), radius)
                a += x
                b += y
        return pa.RecordBatch.from_arrays([pa.array(signed(np.array(x, dtype=np.uint64))) for x in (a, b)], names=["a", "b"])

    def run(batches):
        held = None
        for t in batches:
            if not t.num_rows:
                continue
            cols = [t.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
            cols[2] = cols[2].view(np.uint64)
            if held is not None:
                cols = [np.concatenate(x) for x in zip(held, cols)]
            last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            held = [c[cut:] for c in cols]
            if cut:
                yield links(*(c[:cut] for c in cols))
        if held is not None:
            yield links(*held)

    placed = rows.select("path", "key", "fp").repartition("path", "key").sortWithinPartitions("path", "key")
    return placed.mapInArrow(run, "a long, b long")


def links(fps: DataFrame, radius: int = 4, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of ``fps`` (fp:
    long, distinct) at ``radius`` or fewer differing bits.

    Bucket sizes are counted first (a map-side aggregate). Rows alone in their
    bucket are dropped; buckets over ``bucket`` values are not compared at once
    but cut again by covering masks over the bits their mask leaves free, which
    keeps every link. After two cuts a bucket has at most 2^15 values.
    """
    spark = fps.sparkSession
    paths = {0: list(range(64))}  # path of mask choices -> bits still free
    rows, found = fps.select(F.lit(0).cast("long").alias("path"), "fp"), None
    for level in range(3):
        steps = []
        for path, free in paths.items():
            for v, m in enumerate(covering_masks(free, radius)):
                fixed = ((1 << 64) - 1) & ~sum(1 << p for p in free) | m
                steps.append((path, path * 64 + v + 1, as_long(fixed)))
        if level:
            masks = F.broadcast(spark.createDataFrame(steps, "path long, child long, mask long"))  # 31^3 rows at most
            rows = rows.join(masks, "path").select(F.col("child").alias("path"), F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
        else:
            tables = F.explode(F.array(*(F.struct(F.lit(c).cast("long").alias("path"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for _, c, m in steps)))
            rows = rows.select(tables.alias("t"), "fp").select("t.path", "t.key", "fp")
        # merged by key: Spark's estimate of both sides leaves out the copies that an explode or the masks make
        sizes = rows.groupBy("path", "key").agg(F.count("*").alias("n")).filter("n > 1")
        rows = written(rows.join(sizes.hint("merge"), ["path", "key"]), "buckets")
        small = rows if level == 2 else rows.filter(F.col("n") <= bucket)
        found = _bucket_links(small, radius) if found is None else found.union(_bucket_links(small, radius))
        big = rows.filter(F.col("n") > bucket)
        if level == 2 or big.isEmpty():
            return found
        held = {r.path for r in big.select("path").distinct().collect()}  # at most 31 ** (level + 1) numbers
        mask_of = {c: m for _, c, m in steps}
        paths = {p: [i for i in range(64) if not (mask_of[p] >> i) & 1] for p in held}
        rows = big.select("path", "fp")
    return found


def near_duplicates(df: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id", text_col: str = "text",
                    bucket: int = BUCKET) -> DataFrame:
    """(id, fingerprint, component_id) for every row: component_id is the
    smallest id reachable over links of at most ``radius`` differing bits."""
    docs = written(fingerprints(df, shingle, id_col, text_col), "fingerprints")
    fps = docs.groupBy("fp").agg(F.min(id_col).alias("low"))
    comp = connected_components(links(fps.select("fp"), radius, bucket))
    # written tables, so that a large component's rows can be split in the join
    rooted = written(fps.join(comp.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "rooted")
    names = written(rooted.groupBy("root").agg(F.min("low").alias("component_id")), "names")
    named = written(rooted.join(names, "root").select("fp", "component_id"), "components")
    return docs.join(named, "fp").select(id_col, hex64(F.col("fp")).alias("fingerprint"), "component_id")
