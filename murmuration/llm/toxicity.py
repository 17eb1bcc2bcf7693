"""Toxicity by multiple-instance learning.

A document is a bag of sentences. A sentence is offending with probability
sigmoid(bias + weights of its words), a document is toxic if at least one is: noisy-or,
1 - product(1 - p). Weights are learned from document labels alone; the sentences' own
probabilities then tell where the offence stands. A document's score counts what its words add to the
bias: a sentence without telling words adds nothing, so length alone makes no document toxic.

A word contributes its own weight and those of its beginnings (4, 5 and 6 letters), hashed into
a fixed number of weights, so that inflected forms share what is learned.

The model is fitted on a bounded sample: at most about ``per_class`` labelled documents of each class, drawn by a
hash of the id, from training rows only (crc32 of the id modulo 3 is not 1). Every document is scored, whole.

Edge cases: a null, empty or wordless text has no sentence and scores 0; of a text of any length all sentences are scored; rows without id are scored and never
learned from; repeated rows are scored alike and learned from once (of labels that differ the toxic one, of texts the
first in code point order); without any usable label nothing is learned and all scores are 0; an
empty table gives no rows. Other columns are not read.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from xxhash import xxh3_64_intdigest

from murmuration.llm.common import bounded_batches, once_per_worker, sliced

BITS = 18
#: Bound of the training sample, per class.
PER_CLASS = 4000
THRESHOLD = 0.7
EPOCHS = 60
#: A feature is told apart from chance by so many toxic documents and so many standard deviations.
LEAST_DOCUMENTS = 3
LEAST_LIFT = 4.0
RIDGE = 1e-5
_SENTENCE = re.compile(r"[^.!?\n]+")
_EDGES = re.compile(r"^[\W_]+|[\W_]+$")
_CACHE = 200_000


def word_features(token: str) -> list[int]:
    """Places of a token's weights: the word and its beginnings."""
    word = _EDGES.sub("", token)
    if not word:
        return []
    parts = [f"={word}", *[f"{k}{word[:k]}" for k in (4, 5, 6) if len(word) >= k]]
    return [xxh3_64_intdigest(p.encode("utf-8", "replace")) & ((1 << BITS) - 1) for p in parts]


def sentences(text: str) -> list[tuple[int, int]]:
    """(start, end) of the sentences that have a word."""
    return [m.span() for m in _SENTENCE.finditer(text) if not m.group().isspace()]


def bag(text: str) -> tuple[list[int], list[int]]:
    """Features of all sentences laid end to end, and how many each sentence has."""
    features, sizes = [], []
    known: dict[str, list[int]] = {}
    for a, b in sentences(text):
        before = len(features)
        for token in text[a:b].lower().split():
            if token not in known:
                known[token] = word_features(token)
            features += known[token]
        if len(features) > before:
            sizes.append(len(features) - before)
    return features, sizes


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


def telling(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Features that stand in toxic documents of the sample clearly more often than in all."""
    in_toxic, rate = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for (features, _), y, each in zip(bags, labels.tolist(), weight.tolist(), strict=True):
        own = np.unique(features)
        in_toxic[own] += y
        rate[own] += each
    toxic = weight[labels == 1].sum()
    expected = rate * (labels == 1).sum() / max(weight.sum(), 1e-9)
    lift = (in_toxic - expected) / np.sqrt(expected + 0.1)
    return np.flatnonzero((in_toxic >= LEAST_DOCUMENTS) & (lift > LEAST_LIFT)) if toxic else np.zeros(0, np.int64)


def fit(bags: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, weight: np.ndarray, epochs: int = EPOCHS, seed: int = 5) -> tuple[float, np.ndarray]:
    """(bias, weights) of the noisy-or model.

    Only telling features have a weight, and none is negative: a sentence offends by what it says, not
    by what it leaves out. Adam over shuffled batches of documents, then clipped at 0.
    """
    rng = np.random.default_rng(seed)
    weights, bias = np.zeros(1 << BITS, np.float32), -8.0
    chosen = telling(bags, labels, weight)
    place = np.full(1 << BITS, len(chosen), np.int64)
    place[chosen] = np.arange(len(chosen))
    reduced = []
    for features, sizes in bags:
        at = place[features]
        owner = np.repeat(np.arange(len(sizes)), sizes)[at < len(chosen)]
        reduced.append((at[at < len(chosen)], owner, len(sizes)))
    w = np.zeros(len(chosen))
    m, v, step = np.zeros(len(w) + 1), np.zeros(len(w) + 1), 0
    usable = [i for i, (_, _, n) in enumerate(reduced) if n] if len(chosen) else []
    batch = int(np.clip(len(usable) // 8, 16, 256))
    for epoch in range(epochs if usable else 0):
        rate = 0.05 * (1 - epoch / epochs) + 0.002
        order = rng.permutation(usable)
        for first in range(0, len(order), batch):
            some = order[first : first + batch]
            counts = np.array([reduced[i][2] for i in some])
            starts = np.r_[0, np.cumsum(counts)[:-1]]
            features = np.concatenate([reduced[i][0] for i in some])
            owner = np.concatenate([reduced[i][1] + a for i, a in zip(some, starts, strict=True)])
            z = bias + np.bincount(owner, w[features], counts.sum())
            p = _sigmoid(z)
            none = np.add.reduceat(-np.logaddexp(0, z), starts)
            y, each = labels[some], weight[some]
            pull = np.where(y == 1, -np.exp(none) / np.maximum(-np.expm1(none), 1e-9), 1.0) * each / each.sum()
            dz = np.repeat(pull, counts) * p
            grad = np.append(np.bincount(features, dz[owner], len(w)) + RIDGE * w, dz.sum())
            step += 1
            m = 0.9 * m + 0.1 * grad
            v = 0.99 * v + 0.01 * grad * grad
            move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
            w = np.maximum(w - move[:-1], 0)
            bias -= move[-1]
    weights[chosen] = w
    return float(bias), weights


class Scorer(dict):
    """Maps a lower-case token to the sum of its weights."""

    def __init__(self, bias: float, weights: np.ndarray):
        super().__init__()
        self.bias, self.weights = bias, weights

    def __missing__(self, token: str) -> float:
        found = float(self.weights[word_features(token)].sum()) if token else 0.0
        if len(self) < _CACHE:
            self[token] = found
        return found

    def lifts(self, text: str) -> tuple[list[tuple[int, int]], np.ndarray]:
        """The sentences, and what the words of each add to the bias (never negative)."""
        spans = sentences(text)
        return spans, np.array([sum(map(self.__getitem__, text[a:b].lower().split())) for a, b in spans], np.float64)

    def sentence_scores(self, text: str) -> tuple[list[tuple[int, int]], np.ndarray]:
        spans, lifts = self.lifts(text)
        return spans, _sigmoid(lifts + self.bias)

    def joined(self, lifts: np.ndarray) -> float:
        """Noisy-or over sentences, each against a sentence without telling words."""
        lifts = lifts[lifts > 0]
        return float(-np.expm1((np.logaddexp(0, self.bias) - np.logaddexp(0, self.bias + lifts)).sum())) if len(lifts) else 0.0

    def score(self, text: str) -> float:
        return self.joined(self.lifts(text)[1])


class Model:
    """A fitted model, as column expressions."""

    def __init__(self, bias: float, weights: np.ndarray):
        used = np.flatnonzero(weights)
        self.bias, self.places, self.values = bias, used.astype(np.int32), weights[used]
        self.key = ("toxicity", xxh3_64_intdigest(self.places.tobytes() + self.values.tobytes()), bias)

    def _scorer(self) -> Scorer:
        def make() -> Scorer:
            weights = np.zeros(1 << BITS, np.float32)
            weights[self.places] = self.values
            return Scorer(self.bias, weights)

        return once_per_worker(self.key, make)

    def score(self, text: Column) -> Column:
        """Probability that the text is toxic."""
        model = self

        @F.arrow_udf("double")
        def scored(texts: pa.Array) -> pa.Array:
            scorer = model._scorer()
            return pa.array([scorer.score(t or "") for some in sliced([texts]) for t in some.to_pylist()], pa.float64())

        return scored(text.cast("string"))

    def located(self, text: Column, least: float = 0.5) -> Column:
        """The score of a text, and its sentences at or above ``least``: start, end (code points, from 0) and score of each."""
        model = self

        @F.arrow_udf("struct<score:double,offending:array<struct<start:int,end:int,score:double>>>")
        def judged(texts: pa.Array) -> pa.Array:
            scorer, scores, found = model._scorer(), [], []
            for some in sliced([texts]):
                for t in some.to_pylist():
                    spans, lifts = scorer.lifts(t or "")
                    scores.append(scorer.joined(lifts))
                    told = np.flatnonzero(lifts > 0)  # most sentences have no telling word
                    p = _sigmoid(lifts[told] + scorer.bias)
                    found.append([{"start": spans[i][0], "end": spans[i][1], "score": s} for i, s in zip(told.tolist(), p.tolist(), strict=True) if s >= least])
            kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))
            return pa.StructArray.from_arrays([pa.array(scores, pa.float64()), pa.array(found, kind)], names=["score", "offending"])

        return judged(text.cast("string"))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> Model:
    """Fit on at most about ``per_class`` documents of each class."""
    bounded_batches(docs.sparkSession)
    usable = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    usable = usable.groupBy(F.col("doc_id").alias("_id")).agg(F.max(F.col("toxic").cast("int")).alias("_y"))
    total = {r._y: r.n for r in usable.groupBy("_y").agg(F.count(F.lit(1)).alias("n")).collect()}
    draw = F.pmod(F.xxhash64("_id", F.lit(3)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    share = F.when(F.col("_y") == 1, F.lit(min(1.0, per_class / max(1, total.get(1, 0))))).otherwise(F.lit(min(1.0, per_class / max(1, total.get(0, 0)))))
    sample = usable.where(draw < share)  # about 2 * per_class ids

    @F.arrow_udf("struct<features:binary,sizes:binary>")
    def bags(texts: pa.Array) -> pa.Array:
        found = [bag(t or "") for t in texts.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([np.array(x, "<u4").tobytes() for x in column], pa.binary()) for column in (zip(*found, strict=True) if found else ([], []))], names=["features", "sizes"])

    joined = docs.select("doc_id", "text").join(F.broadcast(sample), F.col("doc_id") == F.col("_id"))
    joined = joined.groupBy("_id", "_y").agg(F.min("text").alias("text"))  # rows that share an id teach once
    rows = joined.select("_id", "_y", bags(F.col("text").cast("string")).alias("b")).collect()
    rows.sort(key=lambda r: (r._id, r._y))
    # views of the collected bytes, without a second copy on the driver
    found = [(np.frombuffer(r.b.features, "<u4"), np.frombuffer(r.b.sizes, "<u4")) for r in rows]
    y = np.array([r._y for r in rows])
    # the classes weigh as in the labels, however they were drawn
    drawn = {c: max(1, int((y == c).sum())) for c in (0, 1)}
    weight = np.array([total.get(c, 0) / drawn[c] for c in y.tolist()])
    return Model(*fit(found, y, weight))


def score_documents(docs: DataFrame, model: Model) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, offending (the sentences, as start, end and score)."""
    judged = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), model.located(F.col("text")).alias("j"))
    predicted = (F.col("j.score") >= THRESHOLD).cast("int")
    return judged.select("doc_id", "held_out", F.col("j.score").alias("score"), predicted.alias("predicted"), F.col("j.offending").alias("offending"))
