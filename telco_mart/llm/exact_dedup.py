"""Exact deduplication against immutable snapshots.

A snapshot is the set of texts seen so far, written once: a digest table (the
exact buckets: SHA-256 of the normalised text, the id that stays, the number of
rows) and static binary-fuse filters over the digests, one per shard of the
digest space. An incoming batch is first grouped by digest on its own; its
distinct digests are screened by the filters, only positives are joined with
the exact buckets, and the texts of joined digests are compared byte by byte.

Texts are equal when identical after lower-casing A-Z; null counts as empty. Of
equal texts the largest id stays (a null id is smaller than any other); rows
that repeat the id that stays are one document and all keep it. Only the id and
text columns are read, so other columns may have any name. Empty tables give
empty results.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, scratch, written
from .fuse_filter import FuseFilter

#: Distinct digests per filter shard (about 1.2 bytes each).
SHARD = 200_000


@dataclass(frozen=True)
class Snapshot:
    """``rows``: (id, digest) of every row; ``buckets``: (digest, top, n) with
    one row per distinct text; ``filters``: (shard, filter); ``docs``: the texts."""

    rows: DataFrame
    buckets: DataFrame
    filters: DataFrame
    shards: int
    docs: DataFrame
    shard_rows: int = SHARD


def _normalised(text_col: str):
    return ascii_lower(F.coalesce(F.col(text_col), F.lit("")))


def _shard(shards: int):
    return F.pmod(F.xxhash64("digest", F.lit("shard")), F.lit(shards)).cast("int")


def digests(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, digest), written once: later steps don't read the texts again."""
    return written(df.select(F.col(id_col).alias("id"), F.unhex(F.sha2(_normalised(text_col).cast("binary"), 256)).alias("digest")), "digests")


def _buckets(rows: DataFrame) -> DataFrame:
    # max() skips nulls, so a null id stays only where there is no other
    return rows.groupBy("digest").agg(F.max("id").alias("top"), F.count("*").alias("n"))


def build_filters(buckets: DataFrame, shards: int) -> DataFrame:
    """(shard, filter): a binary-fuse filter over the 64-bit keys of a shard's
    distinct digests. Shards are cut by a hash of the digest, so they are even
    whatever the texts, and small enough to be built in one task each."""

    def build(key: tuple, t: pa.Table) -> pa.Table:
        keys = np.unique(t.column("key").to_numpy().view(np.uint64))
        return pa.table({"shard": pa.array([key[0].as_py()], pa.int32()), "filter": pa.array([FuseFilter.build(keys).to_bytes()], pa.binary())})

    return buckets.select(_shard(shards).alias("shard"), F.xxhash64("digest").alias("key")).groupBy("shard").applyInArrow(build, "shard int, filter binary")


def make_snapshot(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_rows: int = SHARD) -> Snapshot:
    """Digest, group and write the texts of ``df`` as an immutable snapshot."""
    rows = digests(df, id_col, text_col)
    buckets = written(_buckets(rows), "snapshot_buckets")
    shards = max(1, -(-buckets.count() // shard_rows))
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return Snapshot(rows, buckets, written(build_filters(buckets, shards), "snapshot_filters"), shards, docs, shard_rows)


def dealt(fresh: DataFrame, snapshot: Snapshot) -> tuple[DataFrame, int]:
    """(digest, key, shard, salt) and the number of salts: ``fresh`` is counted,
    and each shard (even, being cut by a hash) is cut by another hash, so that a
    group has about ``shard_rows`` digests however small the snapshot is."""
    salts = max(1, -(-fresh.count() // (snapshot.shards * snapshot.shard_rows)))
    salt = F.pmod(F.xxhash64("digest", F.lit("salt")), F.lit(salts)).cast("int")
    return fresh.select("digest", F.xxhash64("digest").alias("key"), _shard(snapshot.shards).alias("shard"), salt.alias("salt")), salts


def screen(fresh: DataFrame, snapshot: Snapshot) -> DataFrame:
    """Rows of ``fresh`` (digest, ...; one row per digest) that the snapshot's
    filters do not rule out. Filters travel to the digests of their shard, one
    copy to each of its salts, none is broadcast whole."""

    def probe(key: tuple, left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return left.select(["digest"]).slice(0, 0)
        keys = left.column("key").to_numpy().view(np.uint64)
        hit = FuseFilter.from_bytes(right.column("filter")[0].as_py()).contains(keys)
        return left.select(["digest"]).filter(pa.array(hit))

    keyed, salts = dealt(fresh, snapshot)
    filters = snapshot.filters.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return keyed.groupBy("shard", "salt").cogroup(filters.groupBy("shard", "salt")).applyInArrow(probe, "digest binary")


def match(batch: DataFrame, docs: DataFrame, snapshot: Snapshot) -> DataFrame:
    """(digest, top, n) of the snapshot's bucket for each batch digest whose
    text is in the snapshot: screened, joined exactly, compared byte by byte.
    Two texts of one digest that differed would not be matched."""
    positive = screen(batch, snapshot)
    joined = written(
        batch.withColumnRenamed("top", "new_top").drop("n").join(positive, "digest", "left_semi").join(snapshot.buckets, "digest"), "positives"
    )
    text = ascii_lower(F.coalesce(F.col("text"), F.lit("")))
    # an id's texts: more than one only if the input repeats the id
    ours = joined.select("digest", F.col("new_top").alias("id")).hint("shuffle_hash").join(docs, "id").select("digest", text.alias("ours"))
    theirs = joined.select("digest", F.col("top").alias("id")).hint("shuffle_hash").join(snapshot.docs, "id").select("digest", text.alias("theirs"))
    same = ours.join(theirs, (ours.digest == theirs.digest) & (ours.ours == theirs.theirs)).select(ours.digest).distinct()
    no_id = joined.filter("top is null or new_top is null").select("digest")  # nothing to look a text up by
    return joined.join(same.union(no_id).distinct(), "digest", "left_semi").select("digest", "top", "n")


def dedup_batch(df: DataFrame, snapshot: Snapshot, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, digest, keep, size, text_sha256) for every row of the batch and of
    the snapshot: ``keep`` the id that stays of all equal texts of both."""
    rows = digests(df, id_col, text_col)
    docs = df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    groups = written(_buckets(rows), "batch_buckets")
    seen = match(groups, docs, snapshot).select("digest", F.col("top").alias("old_top"), F.col("n").alias("old_n"))
    fresh = groups.join(seen, "digest", "left").select(
        "digest", F.greatest("top", "old_top").alias("keep"), (F.col("n") + F.coalesce("old_n", F.lit(0))).alias("size"), F.col("old_n").isNotNull().alias("known")
    )
    fresh = written(fresh, "batch_groups")
    old = snapshot.buckets.join(fresh.filter("known").drop("known"), "digest", "left").select(
        "digest", F.coalesce("keep", "top").alias("keep"), F.coalesce("size", "n").alias("size")
    )
    old = written(old, "snapshot_groups")  # rows then join a plain table, whose large partitions Spark can split
    final = lambda r, g: r.join(g, "digest").select("id", F.col("keep"), "size", F.lower(F.hex("digest")).alias("text_sha256"))
    return final(rows, fresh.drop("known")).union(final(snapshot.rows, old))


def exact_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_rows: int = SHARD) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256) for every row: about half
    of the ids, by a hash, are the snapshot, the others the incoming batch."""
    older = F.pmod(F.xxhash64(F.col(id_col)), F.lit(2)) == 0
    snapshot = make_snapshot(df.filter(older), id_col, text_col, shard_rows)
    out = dedup_batch(df.filter(~older), snapshot, id_col, text_col)
    return out.select(F.col("id").alias(id_col), F.col("keep").alias("keep_id"), F.col("size").alias("group_size"), F.col("id").eqNullSafe(F.col("keep")).alias("kept"), "text_sha256")
