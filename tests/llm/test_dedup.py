"""SimHash near-duplicates, exact dedup and the binary-fuse filter."""

import random

import numpy as np
import pytest
import xxhash

from telco_mart.llm import exact_dedup, simhash_dedup
from telco_mart.llm.common import written
from telco_mart.llm.components import connected_components
from telco_mart.llm.fuse_filter import FuseFilter

DOC = "doc_id long, text string"


def brute_fingerprint(text, shingle=4):
    words, cur = [], ""
    for ch in (text or ""):
        if ch in " \t\n\x0b\x0c\r":
            words, cur = words + [cur] * bool(cur), ""
        else:
            cur += ch.lower() if "A" <= ch <= "Z" else ch
    words += [cur] * bool(cur)
    if not words:
        return 0
    grams = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(pairs_of):
    """{key: smallest key reachable} where pairs_of maps key -> fingerprint."""
    keys = sorted(pairs_of)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[i + 1:]:
            if (pairs_of[a] ^ pairs_of[b]).bit_count() <= 4:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    return {k: find(k) for k in keys}


def corpus(n=60, seed=1):
    rng = random.Random(seed)
    texts = []
    for i in range(n):
        words = ["".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(rng.choice([0, 1, 3, 4, 50, 400]))]
        texts.append(" ".join(words))
        if len(words) > 300:
            for _ in range(3):
                w = list(words)
                w[rng.randrange(len(w))] = "CHANGED"
                texts.append("  ".join(w).upper() if rng.random() < 0.5 else "\n".join(w))
    return texts + ["", "   ", "É É É É É"]


def test_near_duplicates_match_brute_force(spark):
    texts = corpus()
    rows = [(10 * i + 3, t) for i, t in enumerate(texts)] + [(5000, None), (5001, texts[2])]
    got = {r.doc_id: r for r in simhash_dedup.near_duplicates(spark.createDataFrame(rows, DOC).withColumnRenamed("text", "text")).collect()}
    fps = {i: brute_fingerprint(t) for i, t in rows}
    comp = brute_components(fps)
    assert {i: int(r.fingerprint, 16) for i, r in got.items()} == fps
    assert {i: r.component_id for i, r in got.items()} == comp
    assert len(set(comp.values())) < len(comp) - 10


def test_covering_masks_never_miss():
    masks = simhash_dedup.covering_masks(list(range(64)), 4)
    rng = random.Random(3)
    assert len(masks) == 31
    for _ in range(3000):
        diff = sum(1 << p for p in rng.sample(range(64), 4))
        assert any(diff & m == 0 for m in masks)


@pytest.mark.parametrize("bucket", [1, 8, 1024])
def test_links_keep_every_component_when_buckets_are_cut(spark, bucket):
    rng = random.Random(bucket)
    centre = rng.getrandbits(64)
    values = {centre ^ sum(1 << p for p in rng.sample(range(12), rng.randrange(0, 9))) for _ in range(120)} | {rng.getrandbits(64) for _ in range(40)}
    values |= {centre ^ (0x1F << 40), centre ^ (0x3FF << 30)}
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    df = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    found = {r.node: r.root for r in connected_components(simhash_dedup.links(df, 4, bucket)).collect()}
    fps = {signed(v): v for v in values}
    want = {k: r for k, r in brute_components(fps).items()}
    groups = {}
    for k in fps:
        groups.setdefault(found.get(k, k), set()).add(k)
    expected = {}
    for k, r in want.items():
        expected.setdefault(r, set()).add(k)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, expected.values()))


def test_bucket_sizes_are_never_broadcast(spark, monkeypatch):
    """The tables of a fingerprint are exploded, which Spark's estimate leaves out:
    a small table of fingerprints must not put all its copies into a broadcast."""
    plans = []

    def kept(df, name):
        if name == "buckets":
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return written(df, name)

    monkeypatch.setattr(simhash_dedup, "written", kept)
    fps = spark.range(200).toDF("fp")
    found = simhash_dedup.links(fps, 4, 64).collect()
    assert found and len(plans) > 1 and all("SortMergeJoin" in p for p in plans)
    assert "Broadcast" not in plans[0]  # later levels broadcast their masks


def test_components_of_a_path_a_star_and_nothing(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 100 + k) for k in range(1, 60)] + [(7, 7), (None, 3)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + k: 100 for k in range(60)}}
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_duplicates_of_odd_tables(spark):
    assert simhash_dedup.near_duplicates(spark.createDataFrame([], DOC)).count() == 0
    rows = [(None, "a b c d e"), (None, "a b c d e"), (4, "A  b c d e"), (9, "x"), (9, "x")]
    df = spark.createDataFrame([(*r, "f", 1) for r in rows], DOC + ", fingerprint string, fp int")
    got = sorted((str(r.doc_id), r.component_id) for r in simhash_dedup.near_duplicates(df).collect())
    assert got == [("4", 4), ("9", 9), ("9", 9), ("None", 4), ("None", 4)]
    long = " ".join(f"w{i}" for i in range(200_000))
    df = spark.createDataFrame([(1, long), (2, long + " end")], DOC)
    assert [r.component_id for r in simhash_dedup.near_duplicates(df).collect()] == [1, 1]


def brute_exact(rows):
    low = lambda t: "".join(c.lower() if "A" <= c <= "Z" else c for c in (t or ""))
    groups = {}
    for i, t in rows:
        groups.setdefault(low(t), []).append(i)
    return sorted((i, max(groups[low(t)]), len(groups[low(t)]), i == max(groups[low(t)])) for i, t in rows)


@pytest.mark.parametrize("shard_rows", [3, 200_000])
def test_exact_duplicates_match_brute_force(spark, shard_rows):
    rng = random.Random(5)
    rows = [(i, rng.choice([None, "", "a", "A", "ä", "Ä", f"t{rng.randrange(40)}", f"T{rng.randrange(40)}"])) for i in rng.sample(range(1000), 200)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], DOC + ", digest string, keep_id string")
    got = sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(df, shard_rows=shard_rows).collect())
    assert got == brute_exact(rows)


def test_exact_duplicates_of_odd_tables(spark):
    assert exact_dedup.exact_duplicates(spark.createDataFrame([], DOC)).count() == 0
    rows = [(None, "a"), (1, "A"), (1, "a"), (None, "only"), (None, "Only"), (8, "z" * 3_000_000), (9, "Z" * 3_000_000)]
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(spark.createDataFrame(rows, DOC)).collect()}
    assert got == {(None, 1, 3, False), (1, 1, 3, True), (None, None, 2, True), (8, 9, 2, False), (9, 9, 2, True)}


def test_batches_are_screened_against_a_snapshot(spark):
    old = spark.createDataFrame([(i, f"text {i}") for i in range(50)], DOC)
    new = spark.createDataFrame([(100 + i, f"TEXT {i + 40}") for i in range(30)] + [(207, "own"), (208, "own")], DOC)
    snapshot = exact_dedup.make_snapshot(old, shard_rows=8)
    assert snapshot.shards > 4
    out = {r.id: (r.keep, r.size) for r in exact_dedup.dedup_batch(new, snapshot).collect() if r.id >= 100 or r.id == 42}
    assert out[100] == (100, 2) and out[42] == (102, 2) and out[129] == (129, 1) and out[208] == (208, 2)
    fresh = exact_dedup._buckets(exact_dedup.digests(new, "doc_id", "text"))
    hits = exact_dedup.screen(fresh, snapshot).count()
    assert 10 <= hits <= 14  # every known text, and hardly any other


def test_large_batches_are_cut_against_a_small_snapshot(spark, monkeypatch):
    """One row is the snapshot: the batch's own size decides how it is cut."""
    snapshot = exact_dedup.make_snapshot(spark.createDataFrame([(1, "t 5")], DOC), shard_rows=16)
    fresh = exact_dedup._buckets(exact_dedup.digests(spark.createDataFrame([(10 + i, f"T {i}") for i in range(800)], DOC), "doc_id", "text"))
    keyed, salts = exact_dedup.dealt(fresh, snapshot)
    sizes = [r["count"] for r in keyed.groupBy("shard", "salt").count().collect()]
    assert snapshot.shards == 1 and salts == 50 and sum(sizes) == 800 and max(sizes) < 50
    assert 1 <= exact_dedup.screen(fresh, snapshot).count() < 30
    made = []
    make = exact_dedup.make_snapshot
    monkeypatch.setattr(exact_dedup, "make_snapshot", lambda *a: made.append(make(*a)) or made[-1])
    rows = [(i, f"x {i % 300}") for i in range(400)] + [(-(10**15), "outlier")]  # one id far from the others
    got = sorted((r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_duplicates(spark.createDataFrame(rows, DOC)).collect())
    assert got == brute_exact(rows) and 100 < made[0].rows.count() < 300


def test_fuse_filter_has_no_false_negatives():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 5, 100, 5000):
        keys = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        f = FuseFilter.from_bytes(FuseFilter.build(keys).to_bytes())
        assert f.contains(keys).all()
        assert f.contains(rng.integers(0, 1 << 63, 20_000, dtype=np.uint64)).mean() < 0.01
