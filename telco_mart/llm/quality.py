"""Quality classifier with hierarchical empirical Bayes over sites.

A logistic regression on surface statistics of a text, trained on the labelled
rows, gives each document's own evidence. Documents are then grouped by site
(host) and by path inside the site; sums of the evidence per group, from
map-side aggregates over all documents, give beta posteriors of the share of good
documents: a path is shrunk toward its site and a site toward the global share,
the more the fewer documents it has. How strongly is estimated from the groups
themselves (method of moments on the spread between groups). A document's
posterior replaces the global prior odds in its evidence by the odds of its
path, from which its own contribution has been taken out.

Inputs: null or empty texts are judged on zero statistics; null sites or paths
are groups of their own; labels of unknown documents are ignored, null labels
too; a repeated label row counts once per row; repeated documents get equal
posteriors. Without labels of both classes every document keeps the prior 0.5
and is kept. Only the named columns are read. Empty tables give empty results.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telco_mart.operators.lookup import join_lookup

from .common import written

#: Labelled rows that the classifier is fitted on at most: a share of them, cut
#: by a hash of the id.
SAMPLE = 20_000
FEATURES = ["symbols", "upper", "distinct", "top_word", "bars", "word_length", "repeated_lines", "log_words", "digits", "stops", "longest", "neighbours", "marks", "letters"]


def features(text: str | None) -> list[float]:
    words = (text or "").split()
    if not words:
        return [0.0] * len(FEATURES)
    n, chars = len(words), max(1, sum(map(len, words)))
    joined = "".join(words)
    letters = sum(map(str.isalpha, joined))
    upper = sum(map(str.isupper, joined))
    digits = sum(map(str.isdigit, joined))
    lowered = [w.lower() for w in words]
    counts = Counter(lowered)
    lines = [x for x in text.split("\n") if x.strip()]
    plain = sum(w.isalpha() or w[:-1].isalpha() for w in words)
    neighbours = sum(a == b for a, b in zip(lowered, lowered[1:]))
    return [
        1 - plain / n, upper / chars, len(counts) / n ** 0.75, max(counts.values()) / n, counts.get("|", 0) / n, chars / n / 10, 1 - len(set(lines)) / len(lines),
        np.log1p(n) / 10, digits / chars, joined.count(".") / n, np.log1p(max(map(len, words))) / 10, neighbours / n, joined.count("!") / n, letters / chars,
    ]


def with_features(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, ..keep, features: array<double>) of every row."""
    src = df.select(F.col(id_col).alias("id"), *keep, F.col(text_col).alias("__text"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in src.schema.fields[:-1]) + ", features array<double>"
    names = [*src.columns[:-1], "features"]

    def run(batches):
        for b in batches:
            x = pa.array([features(t.as_py()) for t in b.columns[-1]], pa.list_(pa.float64()))  # one text at a time as a string
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], x], names=names)

    return src.mapInArrow(run, schema)


@dataclass(frozen=True)
class Model:
    weights: tuple[float, ...]
    bias: float
    prior: float  # share of good documents among the labelled ones

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip(x @ np.array(self.weights) + self.bias, -30, 30)


def fit(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 30) -> Model:
    """Logistic regression by Newton steps on standardised features."""
    if len(y) == 0 or y.min() == y.max():
        return Model((0.0,) * len(FEATURES), 0.0, 0.5)
    mean, std = x.mean(0), x.std(0) + 1e-9
    z = np.hstack([(x - mean) / std, np.ones((len(x), 1))])
    w, penalty = np.zeros(z.shape[1]), ridge * len(y) / 100 * np.append(np.ones(x.shape[1]), 0)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty + 1e-9), z.T @ (y - p) - penalty * w)
        w = w + step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    scaled = w[:-1] / std
    return Model(tuple(scaled.tolist()), float(w[-1] - scaled @ mean), float(y.mean()))


def train(feats: DataFrame, labels: DataFrame, sample: int = SAMPLE, label_col: str = "quality", label_id: str = "doc_id") -> Model:
    """Fit on at most ``sample`` labelled rows; only their statistics (14
    numbers a row) reach the driver. They are counted first and each task sends
    its share of them, so what the driver gets does not grow with the input."""
    known = labels.select(F.col(label_id).alias("id"), F.col(label_col).cast("double").alias("y")).filter("y is not null")
    rows = written(feats.select("id", "features").join(known, "id"), "labelled")
    share = 0.95 * sample / max(rows.count(), 1)  # the hash's spread stays below the other twentieth
    if share < 0.95:
        rows = rows.filter(F.pmod(F.xxhash64("id"), F.lit(1 << 31)) < int(share * (1 << 31)))
    rows = rows.toPandas().sort_values(["id", "y"]).head(sample)
    x = np.array(rows["features"].tolist(), dtype=np.float64).reshape(len(rows), len(FEATURES))
    return fit(x, rows["y"].to_numpy(dtype=np.float64))


def _shrinkage(groups: DataFrame) -> float:
    """Pseudo-count of the parent's share: from the variance of the groups'
    shares around their parents' (``parent``), beyond what chance gives."""
    far = F.col("good") / F.col("n") - F.col("parent")
    s = groups.filter("n > 1").agg(F.sum(F.col("n") * far * far).alias("spread"), F.sum("n").alias("n"), F.count("*").alias("k"), F.sum(F.col("parent") * (1 - F.col("parent"))).alias("chance"), F.sum(F.col("n") * F.col("parent") * (1 - F.col("parent"))).alias("noise")).first()
    if not s.k or not s.noise:
        return 1.0
    # E[sum n far^2] = sum v + tau * sum n v with v = parent (1 - parent), tau = 1 / (kappa + 1)
    tau = min(1.0, max(1e-4, (s.spread - s.chance) / s.noise))
    return 1 / tau - 1 + 1e-6


def classify(df: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", site_col: str = "source", path_col: str = "lang",
             threshold: float = 0.5, sample: int = SAMPLE, label_col: str = "quality", carry: tuple[str, ...] = ()) -> DataFrame:
    """(id, ..carry, p_document, p_site, p_path, quality, keep) for every row: keep
    where the posterior ``quality`` is at least ``threshold``."""
    feats = written(with_features(df.select(F.col(id_col), F.col(text_col), F.col(site_col).alias("site"), F.col(path_col).alias("path"), *carry), id_col, text_col, ("site", "path", *carry)), "features")
    model = train(feats, labels, sample, label_col)
    logit = F.lit(model.bias)
    for k, w in enumerate(model.weights):
        logit = logit + F.col("features")[k] * F.lit(w)
    logit = F.greatest(F.least(logit, F.lit(30.0)), F.lit(-30.0))
    docs = feats.select("id", "site", "path", *carry, logit.alias("logit")).withColumn("p_document", 1 / (1 + F.exp(-F.col("logit"))))

    paths = written(docs.groupBy("site", "path").agg(F.count("*").alias("n"), F.sum("p_document").alias("good")), "path_sums")
    sites = paths.groupBy("site").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    total = sites.agg(F.sum("n").alias("n"), F.sum("good").alias("good")).first()
    share = (total.good + model.prior) / (total.n + 1) if total.n else model.prior
    k_site = _shrinkage(sites.withColumn("parent", F.lit(share)))
    sites = sites.withColumn("p_site", (F.col("good") + k_site * share) / (F.col("n") + k_site)).select("site", "p_site")
    paths = join_lookup(paths, sites, ["site"])
    k_path = _shrinkage(paths.withColumn("parent", F.col("p_site")))

    seen = join_lookup(docs, paths, ["site", "path"])
    # its own evidence does not count twice: the document is left out of its path
    p_path = (F.greatest(F.col("good") - F.col("p_document"), F.lit(0.0)) + k_path * F.col("p_site")) / (F.col("n") - 1 + k_path)
    p_path = F.greatest(F.least(p_path, F.lit(1 - 1e-6)), F.lit(1e-6))
    odds = lambda p: F.log(p / (1 - p))
    prior = min(max(model.prior, 1e-6), 1 - 1e-6)
    post = F.col("logit") - float(np.log(prior / (1 - prior))) + odds(F.col("p_path"))
    out = seen.withColumn("p_path", p_path).withColumn("quality", 1 / (1 + F.exp(-post)))
    return out.select(F.col("id").alias(id_col), *carry, "p_document", "p_site", "p_path", "quality", (F.col("quality") >= threshold).alias("keep"))
