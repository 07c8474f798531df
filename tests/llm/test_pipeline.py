"""The corpus pipeline and its queries on the smallest tables."""

import hashlib
from collections import Counter

import public_tokenizers as P
import tiktoken

import corpus_pipeline
from telco_mart.llm import quality, queries
from telco_mart.llm.bpe import Codec, code_point_classes
from test_dedup import brute_components, brute_exact, brute_fingerprint
from test_web import brute_poisson, brute_spans, digest

SF, LARGER = "/root/testdata/sf0.001", "/root/testdata/sf0.01"  # only the larger one holds secrets


def test_stages_match_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    functions = dict(corpus_pipeline.STAGES)
    assert [n.split()[0] for n in functions] == ["quality", "exact", "SimHash", "mixing", "byte-level"]
    quality_stage, exact, near, mix, bpe = functions.values()

    kept = quality_stage(spark, docs, SF)
    rows = {r.doc_id: r for r in kept.collect()}
    assert kept.columns == docs.columns
    judged = {r.doc_id: r.keep for r in quality.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).collect()}
    assert set(rows) == {i for i, k in judged.items() if k}
    assert all(i in rows for i, q in labels.items() if q == 1) and sum(i in rows for i, q in labels.items() if q == 0) <= 1

    unique = exact(spark, kept, SF)
    texts = {r.doc_id: r.text for r in unique.collect()}
    assert unique.columns == docs.columns and set(texts) == {i for i, _, _, k in brute_exact([(i, r.text) for i, r in rows.items()]) if k}

    apart = near(spark, unique, SF)
    left = {r.doc_id: r for r in apart.collect()}
    comp = brute_components({i: brute_fingerprint(t) for i, t in texts.items()})
    assert apart.columns == docs.columns and set(left) == {i for i, c in comp.items() if i == c}

    mixed = mix(spark, apart, SF)
    counts = Counter(r.source for r in left.values())
    weight = {s: n ** 0.5 for s, n in counts.items()}
    rate = {s: weight[s] / sum(weight.values()) * len(left) / counts[s] for s in counts}
    want = {i: brute_poisson(rate[r.source], queries.SEED, digest(i, r.text, r.lang, r.source, r.n_chars), 1) for i, r in left.items()}
    assert mixed.columns == docs.columns and Counter(r.doc_id for r in mixed.collect()) == Counter({i: n for i, n in want.items() if n})

    with open(queries.RANKS, "rb") as f:
        ranks = Codec(f.read(), code_point_classes()).ranks
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    out = bpe(spark, mixed, SF).collect()
    assert all(r.round_trip and r.ids == library.encode_ordinary(left[r.doc_id].text) for r in out)
    assert Counter(r.doc_id for r in out) == Counter({i: n for i, n in want.items() if n})
    whole = corpus_pipeline.run(spark, SF).collect()
    assert sorted((r.doc_id, r.n_tokens) for r in whole) == sorted((r.doc_id, r.n_tokens) for r in out)


def test_stages_drop_rows_not_ids(spark):
    _, exact, near, _, _ = dict(corpus_pipeline.STAGES).values()
    words = lambda k: " ".join(f"w{k}x{j}" for j in range(60))
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    table = lambda rows: spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], schema)
    rows = [(1, "A"), (1, "clean"), (2, "a"), (3, "r"), (3, "r"), (None, "n"), (None, "N"), (None, "a"), (None, "own")]
    out = Counter((r.doc_id, r.text.lower()) for r in exact(spark, table(rows), SF).collect())
    assert out == Counter([(1, "clean"), (2, "a"), (3, "r"), (None, "n"), (None, "own")])
    rows = [(5, words(0)), (7, words(0)), (7, words(1)), (None, words(0)), (None, words(2)), (None, words(2)), (9, words(3)), (9, words(3))]
    out = Counter((r.doc_id, r.text) for r in near(spark, table(rows), SF).collect())
    assert out == Counter([(5, words(0)), (7, words(1)), (None, words(2)), (9, words(3))])


def test_columns_of_any_name_pass_through(spark):
    """Columns named like internal ones keep their values in stages 1-4, and the
    last stage leaves them out."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    names = ["row_key", "copies", "copy", "rate", "shuffle_key", "features", "fp", "ids", "starts", "text_sha256", "decoded"]
    odd = docs.selectExpr("*", *(f"concat('{n}', doc_id) AS {n}" for n in names)).cache()
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, odd, SF)
        assert out.columns == odd.columns and out.count() > 0, name
        assert all(r[n] == f"{n}{r.doc_id}" for r in out.collect() for n in names), name
    last = corpus_pipeline.STAGES[4][1](spark, odd, SF)
    assert last.columns == ["doc_id", "lang", "source", "n_chars", "n_tokens", "ids", "round_trip"] and all(r.round_trip for r in last.collect())


def test_quality_stage_judges_rows_not_ids(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rejected = quality.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).orderBy("quality").first()
    good = quality.classify(docs, spark.read.parquet(f"{SF}/labels.parquet")).orderBy("quality", ascending=False).first()
    assert not rejected.keep and good.keep
    bad_row = docs.filter(docs.doc_id == rejected.doc_id)
    good_row = docs.filter(docs.doc_id == good.doc_id)
    under = lambda rows, i: rows.selectExpr(f"cast({i} as long) doc_id", "text", "lang", "source", "n_chars")
    both = docs.filter(docs.doc_id != rejected.doc_id).select("doc_id", "text", "lang", "source", "n_chars")
    both = both.union(under(bad_row, "null")).union(under(bad_row, 999999)).union(under(good_row, 999999))
    bad, fine = bad_row.first().text, good_row.first().text
    out = dict(corpus_pipeline.STAGES)["quality classifier"](spark, both.select(docs.columns), SF).collect()
    assert not [r for r in out if r.text == bad] and [r.text for r in out if r.doc_id == 999999] == [fine]


def test_secret_query_derives_its_digest(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{LARGER}/documents.parquet").collect()}
    got = queries.op7_secret_scan(spark, LARGER).collect()
    assert len(got) == len(texts)
    from telco_mart.llm.secret_scan import BASE, RULES

    for r in got:
        base = brute_spans(texts[r.doc_id], BASE)
        joined = lambda spans: ",".join(f"{kind}:{a}:{b}" for a, _, kind, b in spans)
        assert r.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest() and r.spans == joined(brute_spans(texts[r.doc_id], RULES))
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == kind for _, _, k, _ in base) for kind in ("assign", "access", "hex")]
    assert sum(r.n_assign + r.n_access + r.n_hex for r in got) > 0


def test_bpe_query_digests(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in queries.op2_byte_bpe(spark, SF).collect():
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
