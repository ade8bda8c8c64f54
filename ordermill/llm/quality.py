"""Quality by supervised subword embeddings.

A document is the average of learned vectors: one for each word and each of its byte n-grams, hashed into
``BUCKETS`` rows; a softmax over the two labels follows. Words are cut at blanks and keep their
case; the n-grams are of the word between marks. A word that repeats the one before it also
counts as a marker word, so that endless repetition is visible in an average. Vectors and output
weights are trained by stochastic gradient descent in numpy on a bounded sample of labelled rows
(``SAMPLE`` ids; see ``labelled.sample``); the trained vectors matter only through their product with
the output weights, one number a bucket, and that table of fixed size is broadcast.

Null and empty texts have no features: their score follows from the bias alone. Repeated rows are scored
each for itself. Without labels of both kinds the score is the share of label 1 (one half without any).
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ordermill.llm import labelled
from ordermill.llm.common import Shared, bounded_batches

BUCKETS = 1 << 18
GRAMS = (3, 4, 5)
DIMENSIONS = 8
SAMPLE = 6000
EPOCHS = 12
RATE = 0.5
SEED = 7
THRESHOLD = 0.3
#: Words whose sums a task remembers; when full, it starts anew.
REMEMBER = 400_000

_REPEATED = b"\x00again"


def words_of(text: bytes) -> Counter:
    words = text.split()
    counts = Counter(words)
    again = sum(map(bytes.__eq__, words, words[1:]))
    if again:
        counts[_REPEATED] = again
    return counts


def word_features(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of all features of the words (distinct or not), and the word each is from, ascending."""
    if not words:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    marked = [b"<" + w + b">" for w in words]
    sizes = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    buffer = np.frombuffer(b"".join(marked), dtype=np.uint8).astype(np.uint64)
    ends, owner = np.repeat(np.cumsum(sizes), sizes), np.repeat(np.arange(len(words)), sizes)
    left = ends - np.arange(len(buffer))  # bytes from here to the word's end
    buckets = [np.fromiter((zlib.crc32(w) for w in words), dtype=np.int64, count=len(words)) % BUCKETS]
    owners = [np.arange(len(words))]
    for n in GRAMS:
        if len(buffer) >= n:
            code = np.full(len(buffer) - n + 1, n, dtype=np.uint64)
            for k in range(n):
                code = code * np.uint64(1099511628211) + buffer[k : len(buffer) - n + 1 + k]
            inner = np.flatnonzero(left[: len(code)] >= n)
            buckets.append(((code[inner] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(46)).astype(np.int64))
            owners.append(owner[inner])
    buckets, owners = np.concatenate(buckets), np.concatenate(owners)
    order = np.argsort(owners, kind="stable")
    return buckets[order], owners[order]


def _bags(sample: DataFrame) -> DataFrame:
    """(label, bucket array, share array): each document's features and their shares of the average."""

    @F.arrow_udf("struct<buckets:array<int>,shares:array<float>>")
    def bag(text: pa.Array) -> pa.Array:
        rows = []
        for t in text.cast(pa.large_binary()).to_pylist():
            counts = words_of(t or b"")
            buckets, owner = word_features(list(counts))
            weight = np.array(list(counts.values()), dtype=float)[owner] if counts else np.zeros(0)
            unique, at = np.unique(buckets, return_inverse=True)
            total = np.bincount(at, weights=weight, minlength=len(unique))
            rows.append({"buckets": unique.astype(np.int32), "shares": (total / max(total.sum(), 1)).astype(np.float32)})
        return pa.array(rows, pa.struct([("buckets", pa.list_(pa.int32())), ("shares", pa.list_(pa.float32()))]))

    return sample.select("label", bag("text").alias("b")).select("label", "b.*")


def train(bags: list[tuple[int, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, float]:
    """Numbers for the buckets and a bias: a document's log-odds of label 1 are their average plus the bias."""
    positive = sum(label for label, _, _ in bags)
    if not bags or positive in (0, len(bags)):
        share = (positive + 0.5) / (len(bags) + 1)
        return np.zeros(BUCKETS, np.float32), float(np.log(share / (1 - share)))
    random = np.random.default_rng(SEED)
    vectors = random.uniform(-1 / DIMENSIONS, 1 / DIMENSIONS, (BUCKETS, DIMENSIONS)).astype(np.float32)
    output, bias = np.zeros((2, DIMENSIONS), np.float32), np.zeros(2, np.float32)
    steps, total = 0, EPOCHS * len(bags)
    for _ in range(EPOCHS):
        for i in random.permutation(len(bags)):
            label, buckets, shares = bags[i]
            rate = RATE * (1 - steps / total)
            steps += 1
            hidden = shares @ vectors[buckets]
            logits = output @ hidden + bias
            softmax = np.exp(logits - logits.max())
            error = softmax / softmax.sum()
            error[label] -= 1
            back = error @ output
            output -= rate * np.outer(error, hidden)
            bias -= rate * 0.1 * error
            # Shares are small, so vectors take a longer step than the output.
            vectors[buckets] -= (rate * 20 * shares)[:, None] * back
    return (vectors @ (output[1] - output[0])).astype(np.float32), float(bias[1] - bias[0])


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    table = _bags(labelled.sample(docs, labels, "quality", SAMPLE)).toArrow()
    # Rows arrive in any order, and descent depends on it.
    bags = sorted(
        (
            (label, b.values.to_numpy(), s.values.to_numpy())
            for label, b, s in zip(table["label"].to_pylist(), table["buckets"], table["shares"])
        ),
        key=lambda x: (x[0], len(x[1]), x[1].tobytes(), x[2].tobytes()),
    )
    numbers, bias = train(bags)
    model = Shared(spark, numbers)

    class Sums(dict):
        """(sum, number) of the features of each word."""

        def learn(self, words: list[bytes]) -> None:
            buckets, owner = word_features(words)
            if len(buckets):
                first = np.flatnonzero(np.diff(owner, prepend=-1))
                sums = np.add.reduceat(model.value[buckets], first, dtype=np.float64)
                self.update(zip(words, zip(sums.tolist(), np.diff(first, append=len(owner)).tolist())))

    known = Sums()

    @F.arrow_udf("double")
    def probability(text: pa.Array) -> pa.Array:
        bags = [words_of(t or b"") for t in text.cast(pa.large_binary()).to_pylist()]
        missing = {w for b in bags for w in b if w not in known}
        if len(known) + len(missing) > REMEMBER:
            known.clear()
            missing = set().union(*bags)
        known.learn(sorted(missing))
        logits = []
        for b in bags:
            total = number = 0
            for word, n in b.items():
                s, k = known[word]
                total += n * s
                number += n * k
            logits.append(bias + (total / number if number else 0.0))
        return pa.array(1 / (1 + np.exp(-np.clip(np.array(logits, dtype=float), -50, 50))), pa.float64())

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), labelled.held_out().alias("held_out"), probability("text").alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
