"""Cross-tokenizer alignment against the two libraries and plain loops."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from telco_mart.llm import align
from telco_mart.llm.common import written
from telco_mart.llm.csr import Csr, membership, products, row_terms, transposed
from telco_mart.llm.queries import BYTE_TOKENIZER, PIECE_TOKENIZER, QUERIES

SMALL = "/root/testdata/sf0.001"
ODD = ["", None, " ", "  two  spaces ", "a\n\nb\tc", "mixed 中文 text 🙂🙂 é é", "under▁score", "<0x41> <s> <|endoftext|> </s>", "\u0000nul", "x" * 5000, "don't we'll I'm", "ﬁ ligature ①", " lead", "Ⅷ ½ ٣", "​ zero", "trail \n "]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(BYTE_TOKENIZER)
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PIECE_TOKENIZER)


def token_bytes(a_entries, b_pieces):
    letters = align.byte_alphabet()
    piece = lambda p: bytes([int(p[3:5], 16)]) if p.startswith("<0x") and len(p) == 6 else p.replace("▁", " ").encode()
    return [bytes(letters[c] for c in t) for t in a_entries], [piece(p) for p in b_pieces]


def brute(texts, libraries):
    a_lib, b_lib = libraries
    docs = []
    for text in texts:
        if not text:
            docs.append(None)
            continue
        enc, b = a_lib.encode(" " + text, add_special_tokens=False), b_lib.encode(text)
        a_bytes, b_bytes = token_bytes([a_lib.id_to_token(i) for i in enc.ids], [b_lib.id_to_piece(i) for i in b])
        whole = (" " + text).encode()
        if b"".join(a_bytes) != whole or b"".join(b_bytes) != whole:
            docs.append(None)
            continue
        spans = [[], []]
        for out, parts in zip(spans, (a_bytes, b_bytes)):
            at = 0
            for p in parts:
                out.append((at, at := at + len(p)))
        links, j0 = [], 0
        for i, (s, e) in enumerate(spans[0]):
            while spans[1][j0][1] <= s:
                j0 += 1
            j = j0
            while j < len(spans[1]) and spans[1][j][0] < e:
                links.append((i, j, min(e, spans[1][j][1]) - max(s, spans[1][j][0])))
                j += 1
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        group = [[next(k for k, c in enumerate(cuts) if e <= c) for _, e in sp] if len(sp) < 3000 else list(np.searchsorted(cuts, [e for _, e in sp])) for sp in spans]
        docs.append((enc.ids, b, links, group, len(cuts)))
    held, best = Counter(), defaultdict(int)
    for d in filter(None, docs):
        held.update({(d[0][i], d[1][j]) for i, j, _ in d[2]})
    for (a, _), n in held.items():
        best[a] = max(best[a], n)
    rows = []
    for d in docs:
        if d is None:
            rows.append((0, 0, 0, 0, 0, 0, 0, ""))
            continue
        a, b, links, group, n = d
        counts = [held[a[i], b[j]] for i, j, _ in links]
        texts_ = []
        members = [[[] for _ in range(n)] for _ in range(2)]
        for side, ids in enumerate((a, b)):
            for k, g in enumerate(group[side]):
                members[side][g].append(str(ids[k]))
        text = ";".join(",".join(x) + "|" + ",".join(y) for x, y in zip(*members))
        shared = sum(len(x) * len(y) for x, y in zip(*members))
        rows.append((len(a), len(b), n, len(links), shared, sum(c == best[a[i]] for c, (i, j, _) in zip(counts, links)), sum(counts), text))
    return rows


def collected(df):
    return {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_shared, r.n_best, r.count_sum, r.groups) for r in df.collect()}


def test_query_matches_the_libraries_on_the_whole_table(spark, libraries):
    table = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    want = {r.doc_id: w for r, w in zip(table, brute([r.text for r in table], libraries))}
    got = QUERIES["op12_cross_tokenizer_alignment"](spark, SMALL).collect()
    assert len(got) == len(table)
    for r in got:
        n_a, n_b, n_groups, n_links, n_shared, n_best, count_sum, text = want[r.doc_id]
        assert (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_shared, r.n_best, r.count_sum) == (n_a, n_b, n_groups, n_links, n_shared, n_best, count_sum)
        assert r.groups_sha256 == (hashlib.sha256(text.encode()).hexdigest() if text else "")


def test_odd_texts_and_both_ways_of_counting(spark, libraries, monkeypatch):
    rng = random.Random(5)
    letters = "ab cé▁中 \n\t'1½🙂 ́"
    texts = ODD + ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(150)] + ["the same text"] * 9
    want = dict(enumerate(brute(texts, libraries)))
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, row string, groups int").repartition(5)
    assert collected(align.align(df, BYTE_TOKENIZER, PIECE_TOKENIZER)) == want
    monkeypatch.setattr("telco_mart.operators.lookup.BROADCAST_ROWS", 10)
    assert collected(align.align(df, BYTE_TOKENIZER, PIECE_TOKENIZER, limit=10)) == want
    monkeypatch.setattr(align, "SLICE", 64)
    monkeypatch.setattr(align, "HELD", 20)
    assert collected(align.align(df, BYTE_TOKENIZER, PIECE_TOKENIZER)) == want


def test_links_are_rows_of_the_products(spark, libraries):
    texts = ["under the  bridge", "naïve 中文", None, "x1y2z3"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    encoded, sizes = written(align.encode(df, BYTE_TOKENIZER, PIECE_TOKENIZER), "test_tokens"), align.Sizes.of(BYTE_TOKENIZER, PIECE_TOKENIZER)
    named = align.token_links(encoded, sizes).join(encoded.select("row", "id"), "row")
    got = sorted((r.id, r.a, r.b, r.value) for r in named.collect())
    a_lib, b_lib = libraries
    want, shared = [], Counter()
    for d, t in enumerate(texts):
        if t:
            ends = []
            for parts in token_bytes([a_lib.id_to_token(i) for i in a_lib.encode(" " + t, add_special_tokens=False).ids], [b_lib.id_to_piece(i) for i in b_lib.encode(t)]):
                ends.append(np.cumsum([len(p) for p in parts]))
            for i, e in enumerate(ends[0]):
                for j, f in enumerate(ends[1]):
                    both = min(e, f) - max(ends[0][i - 1] if i else 0, ends[1][j - 1] if j else 0)
                    want += [(d, i, j, both)] if both > 0 else []
            cuts = np.intersect1d(*ends)
            shared[d] = sum(int(np.searchsorted(cuts, e) == np.searchsorted(cuts, f)) for e in ends[0] for f in ends[1])
    assert got == sorted(want)
    in_groups = align.token_links(encoded, sizes, shared_groups=True).join(encoded.select("row", "id"), "row")
    assert {r.id: r["count"] for r in in_groups.groupBy("id").count().collect()} == dict(shared)


def test_empty_table_null_ids_and_repeated_rows(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert align.align(empty, BYTE_TOKENIZER, PIECE_TOKENIZER).count() == 0
    df = spark.createDataFrame([(None, "same words"), (None, "same words"), (3, None)], "doc_id long, text string")
    rows = align.align(df, BYTE_TOKENIZER, PIECE_TOKENIZER).collect()
    assert len(rows) == 3 and {r.count_sum for r in rows if r.doc_id is None} == {2 * next(r.n_links for r in rows if r.n_links)}


@pytest.mark.parametrize("terms", [1, 7, 1 << 20])
def test_row_products_match_dense_matrices(terms):
    rng = np.random.default_rng(1)
    for _ in range(20):
        dense = [rng.integers(0, 3, size=s) * (rng.random(s) < 0.4) for s in ((6, 9), (9, 5))]
        a, b = (Csr(np.concatenate([[0], np.cumsum((m > 0).sum(1))]), np.nonzero(m)[1], m[np.nonzero(m)], m.shape[1]) for m in dense)
        got = np.zeros((6, 5), dtype=int)
        for i, j, v in products(a, b, terms):
            got[i, j] += v
        assert (got == dense[0] @ dense[1]).all()
        assert (row_terms(a, b) == (dense[0] > 0) @ (dense[1] > 0).sum(1)).all()
        t = transposed(a)
        assert t.rows == 9 and t.width == 6 and t.indptr[-1] == a.indptr[-1]
    assert membership(np.array([0, 0, 1]), 2).indices.tolist() == [0, 0, 1]
