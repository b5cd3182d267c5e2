"""Quality classifier: hashed word n-gram logistic regression, trained by follow-the-regularised-leader.

A text is split into words and runs of punctuation, case kept. Uni- and bigrams are hashed to ``1 << bits`` features
whose value is their share of the text; a word in capitals and a word that repeats the one before also
count as a word of their own, so that shouting and stuttering are known from words never seen. Training takes at most
about ``fit_rows`` labelled rows (chosen by a hash of the id; the bound is this parameter), dealt to tasks of about
``shard_rows``; each runs FTRL-proximal over its rows and the weights are averaged. Scoring is a sparse dot
product per text, on the documents' own partitions; the weights are ``8 << bits`` bytes.

Cases: null and empty texts have no features and get the score of the bias; labels that are null are
not learned from; an id labelled twice takes its lowest label; documents without a label, repeated rows
and extra columns are scored like any other; without labels the score is 0.5 everywhere.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from firnline.llm.common import give_back, per_batch, text_of

BITS = 18
FIT_ROWS = 20_000
SHARD_ROWS = 5_000
EPOCHS = 3
THRESHOLD = 0.3
PARTS = re.compile(r"\w+|[^\w\s]+")
SHOUTED, REPEATED = (np.uint64(zlib.crc32(name)) for name in (b"<capitals>", b"<same again>"))


class Hashes(dict):
    """Hash of each word seen, forgotten when there are too many."""

    def __missing__(self, word: str) -> int:
        if len(self) > 100_000:
            self.clear()
        h = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        return h


def features(text: str | None, bits: int, hashes: Hashes) -> tuple[np.ndarray, np.ndarray]:
    """Indices and values of the text's uni- and bigrams."""
    words = PARTS.findall(text or "")
    h = np.fromiter(map(hashes.__getitem__, words), dtype=np.uint64, count=len(words))
    if not len(h):
        return np.empty(0, dtype=np.int64), np.empty(0)
    pairs = (h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]) * np.uint64(0xC2B2AE3D27D4EB4F)
    shouted = np.full(sum(len(w) > 1 for w in filter(str.isupper, words)), SHOUTED)
    repeated = np.full(np.count_nonzero(h[1:] == h[:-1]), REPEATED)
    single = np.concatenate([h, shouted, repeated]) * np.uint64(0x9E3779B97F4A7C15)
    grams = np.concatenate([single, pairs]) >> np.uint64(64 - bits)
    index, count = np.unique(grams.astype(np.int64), return_counts=True)
    return index, count / len(h)


def follow_leader(examples, bits: int, epochs: int, alpha=200.0, beta=1.0, l1=1e-4, l2=1e-4) -> np.ndarray:
    """Weights, the bias last, after FTRL-proximal over (label, indices, values)."""
    size = (1 << bits) + 1
    z, n, w = np.zeros(size), np.zeros(size), np.zeros(size)
    for _ in range(epochs):
        for label, index, value in examples:
            at = np.append(index, size - 1)
            x = np.append(value, 1.0)
            w[at] = np.where(np.abs(z[at]) <= l1, 0.0,
                             -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))
            g = (1 / (1 + np.exp(-np.clip(w[at] @ x, -30, 30))) - label) * x
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w[at]
            n[at] += g * g
    return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((beta + np.sqrt(n)) / alpha + l2))


def fit(docs: DataFrame, labels: DataFrame, label: str, bits: int = BITS, fit_rows: int = FIT_ROWS,
        shard_rows: int = SHARD_ROWS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights learned from ``labels`` (doc_id, ``label`` 0/1) and the texts of ``docs``."""
    known = (labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull())
             .groupBy("doc_id").agg(F.min(label).cast("int").alias("label")))
    labelled = known.count()
    share = min(1.0, fit_rows / max(1, labelled))
    shards = max(1, -(-min(labelled, fit_rows) // shard_rows))
    drawn = known.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) < int(share * (1 << 32)))
    # The drawn rows are bounded by fit_rows, whatever the corpus: 12 bytes each.
    rows = (docs.select("doc_id", text_of("text").alias("text")).join(F.broadcast(drawn), "doc_id")
            .withColumn("shard", F.pmod(F.xxhash64("text", "doc_id"), F.lit(shards)).cast("int")))

    def train(group: pa.Table) -> pa.Table:
        group = group.sort_by([("doc_id", "ascending"), ("text", "ascending")])
        hashes = Hashes()
        # One text at a time becomes its features, in half the bytes of the usual numbers.
        examples = [(y, index.astype(np.int32), value.astype(np.float32)) for y, (index, value) in (
            (y.as_py(), features(t.as_py(), bits, hashes)) for t, y in zip(group["text"], group["label"]))]
        del group, hashes
        order = np.random.default_rng(0).permutation(len(examples))
        weights, count = follow_leader([examples[i] for i in order], bits, epochs), len(examples)
        del examples
        give_back()
        return pa.table({"rows": pa.array([count], pa.int64()),
                         "weights": pa.array([weights.astype("<f8").tobytes()], pa.binary())})

    made = rows.groupBy("shard").applyInArrow(train, "rows long, weights binary").collect()
    total = sum(r["rows"] for r in made)
    out = np.zeros((1 << bits) + 1)
    for r in sorted(made, key=lambda r: (r["rows"], bytes(r["weights"]))):
        out += np.frombuffer(r["weights"], dtype="<f8") * (r["rows"] / total)
    return out


def score(docs: DataFrame, weights: np.ndarray, text: str = "text") -> Column:
    """Column: the probability of label 1."""
    sent = docs.sparkSession.sparkContext.broadcast(weights)
    bits = int(np.log2(len(weights) - 1))

    def make():
        w, hashes = sent.value, Hashes()

        def act(texts: pa.Array) -> pa.Array:
            sums = np.empty(len(texts))
            for i, t in enumerate(texts.to_pylist()):
                index, value = features(t, bits, hashes)
                sums[i] = w[index] @ value + w[-1]
            return pa.array(1 / (1 + np.exp(-np.clip(sums, -700, 700))), pa.float64())

        return act

    return per_batch(make, "double")(text_of(text))


def held_out() -> Column:
    """True for the fifth of the ids that is never learned from."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 5 == 0


def fit_quality(docs: DataFrame, labels: DataFrame, **options) -> np.ndarray:
    return fit(docs, labels.filter(~held_out()), "quality", **options)
