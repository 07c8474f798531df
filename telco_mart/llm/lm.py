"""Language-model scoring with a log-bilinear neural model.

Tokens are the words of the text with A-Z lower-cased, then one end token. Every
word belongs to a class: the most frequent words are classes of their own, all
others share a class with the words that end alike (a hash of their last
letters), so that also a word never seen has one. There are as many classes of
either kind as the square root of the number of distinct words, ``CLASSES`` at
least. The model gives

    p(word | context) = sum over positions i of weight_i p_i(class | class of the
                        i-th word before) * p(word | class)

where p_i is log-bilinear: representation of the context class times that of
the class, plus a bias, normalised over all classes by batched products. Inside
its class a word has its absolutely discounted training frequency; the discounted
mass is divided over the class's unseen types, whose number is Chao's estimate
from the words seen once and twice, dealt evenly over the classes (the base score
gives every unseen word the chance of a single type).

What is learned comes from all training tokens: counts of all words, and counts
of the pairs (context class, class) at each position, added up in tasks and then
by an aggregate. Representations are trained in numpy by noise-contrastive
estimation, side by side in tasks that hold the pairs of some contexts each;
after a round, changes are averaged row by row with the rows' counts. Steps are
in proportion to the counted pairs.

Texts are scored where they are read, with the model and the exact counts of the
``HEAD`` most frequent words; only the distinct other words of each text are
joined to their counts. HEAD decides how a count is looked up, not its value.

Inputs: null text counts as empty (one end token); a null id is hashed as the
empty text; rows that repeat an id are scored one by one; with no training text
the base score is 0 and the model is uniform over classes. Only the id and text
columns are read. Empty tables give empty results.
"""

from __future__ import annotations

import math
from array import array
from collections import Counter
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import written

#: Least number of classes of either kind, width of a representation, words
#: whose counts every task holds.
CLASSES, WIDTH, HEAD = 1024, 16, 100_000
#: Weight of each position: the word before, and the one before that.
POSITIONS = (0.5, 0.5)
#: Distinct words, and distinct pairs, that a task holds before it hands its counts on.
HELD, PAIRS = 300_000, 2_000_000
#: Training rounds, draws of a round for each distinct pair, draws and noise
#: classes of a step, least steps of a round, pairs of a trainer.
ROUNDS, DRAWS, STEP, NOISE, LEAST, SHARE = 4, 1, 4096, 64, 100, 400_000
#: Models added up at once.
FAN = 64
END = b" "  # no word holds a space


def tokens(text: bytes | None) -> list[bytes]:
    words = (text or b"").lower().split()
    words.append(END)
    return words


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text leaves 2 when divided by 7."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 7 == 2


def word_counts(texts: DataFrame) -> DataFrame:
    """(word: binary, n) over all rows of ``texts`` (text: binary)."""

    def run(batches):
        counts: Counter = Counter()
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                for t in b.column(0).slice(lo, 256).to_pylist():
                    counts.update(tokens(t))
                if len(counts) > HELD:
                    yield batch(counts)
                    counts = Counter()
        yield batch(counts)

    def batch(counts):
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())], names=["word", "n"])

    return texts.mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


@dataclass(frozen=True)
class Corpus:
    """Counts of the training tokens: ``words`` are the HEAD most frequent, the
    first ``own`` of them are classes of their own, before ``spelled`` others."""

    counts: DataFrame
    total: int
    distinct: int
    discount: float
    unseen: float
    own: int
    spelled: int
    words: list[bytes]
    numbers: np.ndarray

    @property
    def classes(self) -> int:
        return self.own + self.spelled


def read_corpus(texts: DataFrame, head: int = HEAD, classes: int = CLASSES) -> Corpus:
    counts = written(word_counts(texts), "word_counts")
    once, twice = F.count_if(F.col("n") == 1), F.count_if(F.col("n") == 2)
    s = counts.agg(F.sum("n").alias("total"), F.count("*").alias("distinct"), once.alias("once"), twice.alias("twice")).first()
    top = counts.orderBy(F.desc("n"), "word").limit(head).toArrow()
    discount = s.once / (s.once + 2 * s.twice) if s.once and s.twice else 0.5
    unseen = max(s.once * s.once / (2 * s.twice) if s.twice else s.once, 1)
    size = max(classes, math.isqrt(s.distinct))
    words = [bytes(w) for w in top.column("word").to_pylist()]
    return Corpus(counts, s.total or 0, s.distinct, min(max(discount, 0.1), 0.9), unseen, min(size, len(words)), size, words, top.column("n").to_numpy())


def ending(word: bytes) -> bytes:
    """The last letters of a word, without the marks around it."""
    return word.strip(b".,!?;:'\"()")[-3:] or word


class Words(dict):
    """Word -> its place in ``cls`` (class) and ``n`` (count; -1 if outside the
    head). Words outside the head are kept until ``HELD`` of them are known."""

    def __init__(self, words: list[bytes], numbers: np.ndarray, own: int, spelled: int):
        super().__init__()
        self.words, self.numbers, self.own, self.spelled = words, numbers, own, spelled
        self.restart()

    def restart(self) -> None:
        self.clear()
        self.update(zip(self.words, range(len(self.words))))
        self.cls = array("q", (k if k < self.own else self.spelled_class(w) for k, w in enumerate(self.words)))

    def spelled_class(self, word: bytes) -> int:
        return self.own + crc32(ending(word)) % self.spelled

    def __missing__(self, word: bytes) -> int:
        self[word] = k = len(self.cls)
        self.cls.append(self.spelled_class(word))
        return k

    def places(self, words: list[bytes]) -> np.ndarray:
        if len(self) > len(self.words) + HELD:
            self.restart()
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))

    def classes(self, places: np.ndarray) -> np.ndarray:
        return np.frombuffer(self.cls, np.int64)[places] if len(places) else places  # a view, gone before the next word


def sequences(texts: list[bytes | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """(words of all texts, each after one end for every position; text and place
    of each token that is predicted)."""
    words, sizes, lead = [], [], len(POSITIONS)
    for t in texts:
        ws = tokens(t)
        words += [END] * lead
        words += ws
        sizes.append(len(ws))
    sizes = np.array(sizes, dtype=np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    return words, text, np.arange(int(sizes.sum())) + (text + 1) * lead


def added(key: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(key):
        return key, n
    order = np.argsort(key)
    key, n = key[order], n[order]
    start = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    return key[start], np.add.reduceat(n, start)


def _shared(df: DataFrame, corpus: Corpus):
    """The head's words and counts (HEAD at most) for the tasks."""
    return df.sparkSession.sparkContext.broadcast((corpus.words, corpus.numbers, corpus.own, corpus.spelled))


def pair_counts(texts: DataFrame, corpus: Corpus) -> DataFrame:
    """(position, context, cls, n) over all tokens of ``texts`` (text: binary)."""
    shared, classes, names = _shared(texts, corpus), corpus.classes, ["position", "context", "cls", "n"]

    def run(batches):
        known = Words(*shared.value)
        empty = np.zeros(0, dtype=np.int64)
        held, fresh = [(empty, empty) for _ in POSITIONS], [[] for _ in POSITIONS]

        def fold(i):
            key = np.concatenate([empty, *fresh[i]])
            fresh[i] = []
            key, n = added(key, np.ones(len(key), dtype=np.int64))
            return added(np.concatenate([held[i][0], key]), np.concatenate([held[i][1], n]))

        def rows(i):
            key, n = held[i]
            held[i] = (empty, empty)
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(key), i, dtype=np.int32)), pa.array((key // classes).astype(np.int32)), pa.array((key % classes).astype(np.int32)), pa.array(n)], names=names)

        for b in batches:
            for lo in range(0, b.num_rows, 256):
                words, _, at = sequences(b.column(0).slice(lo, 256).to_pylist())
                place = known.places(words)
                cls = known.classes(place)
                for i in range(len(POSITIONS)):
                    fresh[i].append(cls[at - 1 - i] * classes + cls[at])
                    if sum(map(len, fresh[i])) >= PAIRS:
                        held[i] = fold(i)
                        if len(held[i][0]) >= PAIRS:
                            yield rows(i)
        for i in range(len(POSITIONS)):
            held[i] = fold(i)
            yield rows(i)

    counted = texts.mapInArrow(run, "position int, context int, cls int, n long")
    return counted.groupBy("position", "context", "cls").agg(F.sum("n").alias("n"))


@dataclass
class Model:
    """Representations of contexts and classes (classes x width) and biases."""

    q: np.ndarray
    r: np.ndarray
    b: np.ndarray

    def parts(self) -> list[np.ndarray]:
        return [self.q, self.r, self.b]

    def scores(self, lo: int, hi: int) -> np.ndarray:
        return self.q[lo:hi] @ self.r.T + self.b

    def log_norms(self) -> np.ndarray:
        """Logarithm of the sum over all classes, for each context."""
        out = np.empty(len(self.q))
        for lo in range(0, len(out), 256):
            s = self.scores(lo, lo + 256).astype(np.float64)
            top = s.max(axis=1)
            out[lo:lo + 256] = top + np.log(np.exp(s - top[:, None]).sum(axis=1))
        return out

    def log_probabilities(self, context: np.ndarray, cls: np.ndarray, norms: np.ndarray) -> np.ndarray:
        return np.einsum("ij,ij->i", self.q[context], self.r[cls]).astype(np.float64) + self.b[cls] - norms[context]

    @classmethod
    def start(cls, noise: np.ndarray, width: int, seed: int) -> "Model":
        rng = np.random.default_rng(seed)
        q, r = (rng.normal(0, 0.05, (len(noise), width)).astype(np.float32) for _ in range(2))
        return cls(q, r, np.log(noise).astype(np.float32))


def sigmoid(x: np.ndarray) -> np.ndarray:
    x = np.clip(x, -30, 30)
    np.exp(np.negative(x, out=x), out=x)
    x += 1
    return np.reciprocal(x, out=x)


def nce_steps(model: Model, context: np.ndarray, cls: np.ndarray, n: np.ndarray, noise: np.ndarray, steps: int, rate: float, seed: int) -> None:
    """Noise-contrastive estimation in place: pairs are drawn by their counts;
    each is told from ``NOISE`` classes drawn from ``noise``, shared by a step.
    Gradients are smoothed by their moments (Adam)."""
    rng, upto, noise_upto = np.random.default_rng(seed), np.cumsum(n), np.cumsum(noise)
    expected = (np.log(noise) + math.log(NOISE)).astype(np.float32)
    params = model.parts()
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for t in range(1, steps + 1):
        pick = np.minimum(np.searchsorted(upto, rng.random(STEP) * upto[-1], side="right"), len(n) - 1)
        v = np.minimum(np.searchsorted(noise_upto, rng.random(NOISE) * noise_upto[-1], side="right"), len(noise) - 1)
        h, w = context[pick], cls[pick]
        q, r, s = model.q[h], model.r[w], model.r[v]
        true = sigmoid(np.einsum("ij,ij->i", q, r) + model.b[w] - expected[w]) - 1
        false = sigmoid(q @ s.T + (model.b[v] - expected[v]))
        grads = [np.zeros_like(p) for p in params]
        np.add.at(grads[0], h, true[:, None] * r + false @ s)
        np.add.at(grads[1], w, true[:, None] * q)
        np.add.at(grads[1], v, false.T @ q)
        np.add.at(grads[2], w, true)
        np.add.at(grads[2], v, false.sum(0))
        for p, g, m, s2 in zip(params, grads, first, second):
            g /= STEP
            m += 0.1 * (g - m)
            s2 += 0.01 * (g * g - s2)
            p -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(s2 / (1 - 0.99 ** t)) + 1e-8)


def _summed(changes: DataFrame) -> DataFrame:
    """Sums of the packed arrays (position, part, data) by position, ``FAN`` at a
    time, so that no task holds more than that many models."""
    schema, parts = "position int, part int, data binary", (changes.agg(F.max("part")).first()[0] or 0) + 1

    def add(key: tuple, t: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_buffer(), np.float64) for x in t.column("data"))
        return pa.table([pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int32()), pa.array([total.tobytes()], pa.binary())], names=["position", "part", "data"])

    while parts > 1:
        changes = changes.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).groupBy("position", "part").applyInArrow(add, schema)
        parts = -(-parts // FAN)
    return changes


def _trainer(shared, rate: float, k: int):
    """A round's work of one trainer: its pairs, as columns position, part,
    context, cls and n, to the weighted changes of the model and the weights."""

    def run(key: tuple, t: pa.Table) -> pa.Table:
        before, noise = shared.value
        i, part = key[0].as_py(), key[1].as_py()
        order = np.lexsort((t.column("cls").to_numpy(), t.column("context").to_numpy()))
        context, cls, n = (t.column(c).to_numpy()[order] for c in ("context", "cls", "n"))
        model = Model(*(p.copy() for p in before[i].parts()))
        nce_steps(model, context, cls, n.astype(np.float64), noise, max(LEAST, DRAWS * len(n) // STEP), rate, seed=1000 * k + part)
        drawn, all_ = np.bincount(context, weights=n, minlength=len(noise)) + 1e-9, np.full(len(noise), float(n.sum()))
        changes = [(a.astype(np.float64) - b) * (w if a.ndim == 1 else w[:, None]) for a, b, w in zip(model.parts(), before[i].parts(), (drawn, all_, all_))]
        data = np.concatenate([*map(np.ravel, changes), drawn, all_]).tobytes()
        return pa.table([pa.array([i], pa.int32()), pa.array([part], pa.int32()), pa.array([data], pa.binary())], names=["position", "part", "data"])

    return run


def train(pairs: DataFrame, noise: np.ndarray, width: int = WIDTH, rounds: int = ROUNDS) -> list[Model]:
    """A model for each position. A trainer has all pairs of its contexts; a
    round's changes are averaged by how often each trainer drew from a row."""
    sc, classes = pairs.sparkSession.sparkContext, len(noise)
    models = [Model.start(noise, width, i) for i in range(len(POSITIONS))]
    trainers = max(1, -(-pairs.count() // (len(POSITIONS) * SHARE)))
    dealt = written(pairs.withColumn("part", F.pmod(F.xxhash64("context"), F.lit(trainers)).cast("int")), "dealt_pairs")
    for k in range(rounds):
        work = _trainer(sc.broadcast((models, noise)), 0.02 * (1 - k / rounds), k)
        changes = written(dealt.groupBy("position", "part").applyInArrow(work, "position int, part int, data binary"), "changes")
        for row in _summed(changes).collect():  # one model a position
            x, at = np.frombuffer(row.data, np.float64), 0
            drawn, all_ = x[-2 * classes:-classes], x[-classes:]
            for p, w in zip(models[row.position].parts(), (drawn, all_, all_)):
                p += (x[at:at + p.size].reshape(p.shape) / (w if p.ndim == 1 else w[:, None])).astype(np.float32)
                at += p.size
    return models


def class_sums(corpus: Corpus) -> tuple[np.ndarray, np.ndarray]:
    """Tokens and distinct words of each class, over all counted words."""
    shared, classes = _shared(corpus.counts, corpus), corpus.classes

    def run(batches):
        known = Words(*shared.value)
        n, types = np.zeros(classes, dtype=np.int64), np.zeros(classes, dtype=np.int64)
        for b in batches:
            cls = known.classes(known.places(b.column(0).to_pylist()))
            np.add.at(n, cls, b.column(1).to_numpy())
            types += np.bincount(cls, minlength=classes)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(classes, dtype=np.int32)), pa.array(n), pa.array(types)], names=["cls", "n", "types"])

    sums = corpus.counts.select("word", "n").mapInArrow(run, "cls int, n long, types long").groupBy("cls").agg(F.sum("n").alias("n"), F.sum("types").alias("types"))
    out = np.zeros((2, classes), dtype=np.int64)
    for r in sums.collect():  # one row a class
        out[:, r.cls] = r.n, r.types
    return out[0], out[1]


@dataclass(frozen=True)
class Inside:
    """p(word | class) by the word's count: class sums, discount, unseen types
    of a spelled class. A class of its own holds one word for certain."""

    n: np.ndarray
    types: np.ndarray
    discount: float
    unseen: float
    own: int

    def log10(self, cls: np.ndarray, count: np.ndarray) -> np.ndarray:
        n, types = self.n[cls], self.types[cls]
        seen = np.maximum(count - self.discount, 1e-300) / np.maximum(n, 1)
        new = np.where(n > 0, self.discount * types / np.maximum(n, 1), 1.0) / self.unseen
        return np.where(cls < self.own, 0.0, np.log10(np.where(count > 0, seen, new)))


def score(df: DataFrame, id_col: str, text_col: str, corpus: Corpus, models: list[Model], inside: Inside) -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) for every row."""
    source = df.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").cast("binary").alias("text"))
    sc, shared = df.sparkSession.sparkContext, _shared(df, corpus)
    fitted = sc.broadcast((models, [m.log_norms() for m in models], inside))
    possible = corpus.total + corpus.distinct + 1
    fields = "row long, id {}, n_tokens long, n_known long, base double, score double, rare array<struct<word:binary,times:int,fresh:double>>".format(source.schema["id"].dataType.simpleString())
    names = ["row", "id", "n_tokens", "n_known", "base", "score", "rare"]
    rare_type = pa.struct([("word", pa.binary()), ("times", pa.int32()), ("fresh", pa.float64())])

    def run(batches):
        models, norms, inside = fitted.value
        known, numbers, row = Words(*shared.value), shared.value[1], TaskContext.get().partitionId() << 33
        head = len(numbers)
        for b in batches:
            for lo in range(0, b.num_rows, 256):
                texts = b.column(1).slice(lo, 256)
                words, text, at = sequences(texts.to_pylist())
                place = known.places(words)
                cls = known.classes(place)
                chance = np.zeros(len(at))
                for i, (m, z, weight) in enumerate(zip(models, norms, POSITIONS)):
                    chance += weight * np.exp(m.log_probabilities(cls[at - 1 - i], cls[at], z))
                place, cls = place[at], cls[at]
                common = place < head
                count = numbers[place[common]] if head else np.zeros(0, dtype=np.int64)
                lp, base = np.log10(np.maximum(chance, 1e-300)), np.zeros(len(at))
                lp[common] += inside.log10(cls[common], count)
                base[common] = np.log10((count + 1) / possible)
                size = len(texts)
                add = lambda x: np.bincount(text, weights=x, minlength=size)
                # distinct other words of each text, with what each is worth if it was never seen
                other = np.flatnonzero(~common)
                key, times = added(text[other] << 40 | place[other], np.ones(len(other), dtype=np.int64))
                spot = key & (1 << 40) - 1
                name = {int(p): words[a] for p, a in zip(place[other], at[other])}
                fresh = inside.log10(known.classes(spot), np.zeros(len(spot)))
                flat = pa.StructArray.from_arrays([pa.array([name[p] for p in spot.tolist()], pa.binary()), pa.array(times.astype(np.int32)), pa.array(fresh)], fields=list(rare_type))
                ends = np.concatenate([[0], np.cumsum(np.bincount(key >> 40, minlength=size))]).astype(np.int32)
                arrays = [pa.array(np.arange(row, row + size)), b.column(0).slice(lo, 256), pa.array(np.bincount(text, minlength=size)), pa.array(add(common).astype(np.int64)), pa.array(add(base)), pa.array(add(lp)), pa.ListArray.from_arrays(pa.array(ends), flat)]
                row += size
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    read = written(source.mapInArrow(run, fields), "scored")
    valued = written(_valued(corpus, inside), "valued_words")
    rare = read.select("row", F.explode("rare").alias("w")).select("row", "w.word", "w.times", "w.fresh")
    met = rare.join(valued, "word", "left")
    n = F.coalesce("n", F.lit(0))
    sums = met.groupBy("row").agg(
        F.sum(F.when(n > 0, F.col("times")).otherwise(0)).alias("known"),
        F.sum(F.col("times") * F.log10((n + 1) / F.lit(float(possible)))).alias("more_base"),
        F.sum(F.col("times") * F.coalesce("value", "fresh")).alias("more"),
    )
    out = read.drop("rare").join(sums, "row", "left")
    plus = lambda a, b: F.col(a) + F.coalesce(F.col(b), F.lit(0))
    known = plus("n_known", "known").cast("long").alias("n_known")
    return out.select(F.col("id").alias(id_col), "n_tokens", known, plus("base", "more_base").alias("base_score"), plus("score", "more").alias("score"))


def _valued(corpus: Corpus, inside: Inside) -> DataFrame:
    """(word, n, value) of the words outside the head: log10 p(word | class)."""
    shared, fitted = _shared(corpus.counts, corpus), corpus.counts.sparkSession.sparkContext.broadcast(inside)

    def run(batches):
        known, head = Words(*shared.value), len(shared.value[0])
        for b in batches:
            place = known.places(b.column(0).to_pylist())
            rare = np.flatnonzero(place >= head)
            part = b.take(pa.array(rare))
            value = fitted.value.log10(known.classes(place[rare]), part.column(1).to_numpy())
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(value)], names=["word", "n", "value"])

    return corpus.counts.select("word", "n").mapInArrow(run, "word binary, n long, value double")


def fit(texts: DataFrame, classes: int = CLASSES, head: int = HEAD, rounds: int = ROUNDS) -> tuple[Corpus, list[Model], Inside]:
    """Counts, models and class sums of training texts (text: binary)."""
    corpus = read_corpus(texts, head, classes)
    n, types = class_sums(corpus)
    noise = (n + 0.5) / (n + 0.5).sum()
    models = train(written(pair_counts(texts, corpus), "pairs"), noise, rounds=rounds)
    return corpus, models, Inside(n, types, corpus.discount, max(corpus.unseen / corpus.spelled, 1.0), corpus.own)


def fit_and_score(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", classes: int = CLASSES, head: int = HEAD, rounds: int = ROUNDS) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score) for
    every row, learning from the rows that are not held out."""
    texts = df.filter(~held_out(F.col(id_col))).select(F.col(text_col).cast("binary").alias("text"))
    corpus, models, inside = fit(texts, classes, head, rounds)
    scored = score(df, id_col, text_col, corpus, models, inside)
    return scored.select(id_col, held_out(F.col(id_col)).alias("held_out"), "n_tokens", "n_known", F.lit(corpus.total).cast("long").alias("train_tokens"), "base_score", "score")
