"""License scan against every place of every template, by plain loops."""

import math
import random

import pytest

from telco_mart.llm import license_scan as L
from telco_mart.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def brute(texts, templates, threshold=0.8):
    """{row: [(template, start, label, base, score)]}: each start of each template
    whose equal words reach the threshold, all mandatory words among them."""
    words = [L.split_words(t or "") for t in texts]
    df = {}
    for ws in words:
        for w in set(ws):
            df[w] = df.get(w, 0) + 1
    weight = lambda w: math.log(1 + len(texts) / (1 + df.get(w, 0))) + 0.01
    out = []
    for ws in words:
        found = []
        for t, template in enumerate(templates):
            tw = L.split_words(template.text)
            total = sum(map(weight, tw))
            must = L.mandatory_positions(template, tw)
            for start in range(len(ws) - len(tw) + 1):
                same = [a == b for a, b in zip(tw, ws[start:])]
                score = sum(weight(w) for w, s in zip(tw, same) if s) / total
                if score >= threshold and all(same[i] for i in must):
                    found.append((t, start, template.label, template.base, pytest.approx(score)))
        out.append((len(ws), found))
    return out


def scanned(spark, texts, templates=L.TEMPLATES):
    df = spark.createDataFrame([(i, t, "x", [1]) for i, t in enumerate(texts)], "doc_id long, text string, words string, places array<int>").repartition(3)
    rows = {r.doc_id: r for r in L.scan(df, templates).collect()}
    return [(rows[i].n_words, [(p.template, p.start, p.label, p.base, p.score) for p in rows[i].places]) for i in range(len(texts))]


def test_query_matches_every_place(spark):
    table = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = {r.doc_id: r for r in QUERIES["op11_license_scan"](spark, SMALL).collect()}
    hits = 0
    for r, (n, found) in zip(table, brute([r.text for r in table], L.TEMPLATES)):
        base = [p for p in found if p[3]]
        starts = [p[1] for p in base]
        g = got[r.doc_id]
        assert (g.n_words, g.n_base, g.first_word, g.last_word) == (n, len(base), min(starts, default=None), max(starts, default=None))
        assert g.base_labels == ",".join(sorted({p[2] for p in base})) and g.labels == ",".join(sorted({p[2] for p in found}))
        assert 0 <= g.score <= 1 and (g.score > 0) == bool(found)
        hits += len(found)
    assert hits > 5


def test_random_edits_of_notices(spark):
    rng = random.Random(11)
    filler = [f"w{k}" for k in range(40)] + ["the", "of", "software", "license", "by", "cc", "mit", "public", "general", "gnu"]
    texts = []
    for _ in range(250):
        words = [rng.choice(filler) for _ in range(rng.randrange(30))]
        for t in rng.sample(L.TEMPLATES, rng.randrange(3)):
            notice = t.text.split()
            for _ in range(rng.randrange(4)):
                k = rng.randrange(len(notice))
                notice[k:k + rng.randrange(3)] = [rng.choice(filler)] * rng.randrange(1, 3)
            at = rng.randrange(len(words) + 1)
            words[at:at] = notice
        sep = [" ", " ", "\n", ", ", " -- "]
        texts.append("".join(w + rng.choice(sep) for w in words).swapcase())
    got, want = scanned(spark, texts), brute(texts, L.TEMPLATES)
    assert got == want
    assert sum(not p[3] and p[4] < 0.999 for _, found in got for p in found) > 10  # edited notices are found as well


def test_odd_texts(spark):
    """Null, empty, long and hot texts, words of other alphabets, repeated rows."""
    texts = [None, "", " .,;", "MIT LICENSE", "mit license", "cc" + " by" * 3, "cc-by", "ccby", "ccé by", "İ mit license ﬁ 中文 ", "gnu general public license" * 2,
             "license " * 3000 + "mit license " * 500, "apache " * 2000 + "license", "the mit  license.", "the mit  license."]
    got = scanned(spark, texts)
    assert got == brute(texts, L.TEMPLATES)
    assert [len([p for p in f if p[3]]) for _, f in got[:8]] == [0, 0, 0, 1, 1, 1, 1, 0] and got[0] == got[1] == got[2] == (0, [])


def test_empty_table_null_ids_and_own_templates(spark):
    schema = "doc_id long, text string"
    assert L.scan(spark.createDataFrame([], schema)).count() == 0
    rows = L.summary(L.scan(spark.createDataFrame([(None, "under cc by 4.0"), (None, "under cc by 4.0")], schema))).collect()
    assert [(r.doc_id, r.n_base, r.base_labels, r.first_word) for r in rows] == [(None, 1, "cc-by", 1)] * 2
    own = [L.Template("mine", "alpha beta gamma", ("beta",))]
    assert scanned(spark, ["Alpha BETA gamma beta", "x"], own)[0][1] == [(0, 0, "mine", False, 1.0)]
    with pytest.raises(ValueError):
        L.build_index({}, 1, [L.Template("bad", "alpha beta", ("beta alpha",))])


def test_index_keeps_what_a_place_needs():
    """Whatever a place may miss, one indexed word is left."""
    for entry in L.build_index({"the": 900, "license": 500, "software": 300, "by": 800}, 1000, L.TEMPLATES):
        left = entry.total - sum(entry.weights[i] for i in entry.indexed)
        assert left < L.THRESHOLD * entry.total and entry.needed > 0
        rare = min(entry.weights[i] for i in entry.indexed)
        assert all(entry.weights[i] <= rare for i in range(len(entry.words)) if i not in entry.indexed)
