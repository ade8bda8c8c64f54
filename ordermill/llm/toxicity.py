"""Toxicity by a weighted finite-state pattern grammar.

A text is cut into clauses at stops and line ends. Each word of a clause is read as a symbol: insult,
threat, target, negation, reporting verb, quotation mark or other. Small transducers over these symbols
are composed into one: the negation transducer marks an insult or threat within ``REACH`` words of a
negation; the reporting transducer marks those after a reporting verb or in quotation marks; the target
transducer those within ``REACH`` words of a target, read once in each direction. The clause's output is
a list of matched patterns, such as "insult, aimed, not negated, reported", each with the strength of its
word; a document's features are the damped sums of strengths for each pattern.

Insults and threats have a seed list; the rest of the lexicon is learned from the labels of a bounded
sample of training rows (``SAMPLE`` ids; see ``labelled.sample``), as whole words and as word beginnings,
from how many toxic and clean texts hold them, counted in grouped sums. An entry needs ``SUPPORT`` and a
positive lower bound of its log-odds, which is its strength; of nested beginnings with the same toxic
texts the shortest is enough. A logistic regression on the same sample weighs the patterns.

Null and empty texts match nothing and score like clean texts. Repeated rows are scored each for itself.
Without labels of both kinds only seeds count and fixed weights apply.
"""

from __future__ import annotations

from collections import Counter
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ordermill.llm import labelled
from ordermill.llm.common import Shared, bounded_batches, text_bytes

SAMPLE = 20_000
REACH = 4
#: Lengths in bytes of word beginnings that may enter the lexicon.
BEGINNINGS = (4, 5, 6, 7, 8)
SUPPORT = 8
SURE = 2.0
THRESHOLD = 0.5
#: Words a task remembers the symbol of, and entries it counts before handing them on.
REMEMBER = 500_000

# Seeds of the word classes.
INSULTS = "idiot moron stupid loser scum trash worthless pathetic disgusting clown fool dumb"
THREATS = "kill destroy hurt beat burn smash punish"
TARGETS = "you your he she they him her them this that these those du ihr sie tu vous il elle ellos usted"
NEGATIONS = "not no never neither nor without isn't aren't wasn't don't nicht kein keine nie pas jamais nunca"
REPORTS = "said says say called calls quoted wrote writes claimed claims sagte dit dijo"
SEED_STRENGTH = 3.0

INSULT, THREAT, TARGET, NEGATION, REPORT, QUOTE, OTHER = "ihtnrqo"
_SEEDS = {
    w.encode(): (symbol, SEED_STRENGTH)
    for words, symbol in ((TARGETS, TARGET), (NEGATIONS, NEGATION), (REPORTS, REPORT), (INSULTS, INSULT), (THREATS, THREAT))
    for w in words.split()
}
#: (symbol, negated, reported, aimed)
PATTERNS = list(product((INSULT, THREAT), (False, True), (False, True), (False, True)))
_AT = {p: k for k, p in enumerate(PATTERNS)}
_FEATURES = len(PATTERNS)

_READ = bytes(
    c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 or c == 39 else 10 if c in b".!?;\n" else 32
    for c in range(256)
)
_QUOTES = ("\u201c".encode(), "\u201d".encode(), "\u00ab".encode(), "\u00bb".encode(), b'"')
_MARK = b" \xff "


class Transducer:
    """Finite states; ``table[state, symbol]`` is (next state, output). Symbols are a letter and its marks so far."""

    def __init__(self, start, table):
        self.start, self.table = start, table

    def compose(self, after: "Transducer") -> "Transducer":
        """The transducer that feeds this one's output to ``after``, over the reachable pairs of states."""
        start = (self.start, after.start)
        table, todo, symbols = {}, [start], {a for _, a in self.table}
        seen = {start}
        while todo:
            pair = todo.pop()
            for a in symbols:
                first, middle = self.table[pair[0], a]
                second, out = after.table[pair[1], middle]
                table[pair, a] = ((first, second), out)
                if (first, second) not in seen:
                    seen.add((first, second))
                    todo.append((first, second))
        return Transducer(start, table)

    def run(self, symbols: list) -> list:
        state, out = self.start, []
        for a in symbols:
            state, made = self.table[state, a]
            out.append(made)
        return out


def _within(letter: str, mark: int, symbols: list) -> Transducer:
    """Sets ``mark`` on insults and threats at most REACH words after ``letter``."""
    table = {}
    for state, a in product(range(REACH + 1), symbols):
        marked = a[:mark] + (True,) + a[mark + 1 :] if a[0] in (INSULT, THREAT) and state else a
        table[state, a] = (REACH if a[0] == letter else max(state - 1, 0), marked)
    return Transducer(0, table)


def _reporting(mark: int, symbols: list) -> Transducer:
    """Sets ``mark`` after a reporting verb, up to the clause's end, and between quotation marks."""
    table = {}
    for (said, quoted), a in product(product((False, True), repeat=2), symbols):
        marked = a[:mark] + (True,) + a[mark + 1 :] if a[0] in (INSULT, THREAT) and (said or quoted) else a
        table[(said, quoted), a] = ((said or a[0] == REPORT, quoted != (a[0] == QUOTE)), marked)
    return Transducer((False, False), table)


def grammar() -> tuple[Transducer, Transducer]:
    """What reads a clause from the left, and then from the right."""
    symbols = [(c, *marks) for c in "ihtnrqo" for marks in product((False, True), repeat=3)]
    left = _within(NEGATION, 1, symbols).compose(_reporting(2, symbols)).compose(_within(TARGET, 3, symbols))
    return left, _within(TARGET, 3, symbols)


def clauses_of(text: bytes) -> list[list[bytes]]:
    for q in _QUOTES:
        if q in text:
            text = text.replace(q, b"\0")
    return [c.replace(b"\0", _MARK).split() for c in text.translate(_KEEP_NUL).split(b"\n")]


_KEEP_NUL = bytes(0 if c == 0 else b for c, b in enumerate(_READ))


class Matcher:
    """Pattern features of texts under a lexicon of words and word beginnings."""

    def __init__(self, words: dict[bytes, tuple[str, float]], beginnings: dict[bytes, tuple[str, float]]):
        self.words, self.beginnings = words, beginnings
        self.left, self.right = grammar()
        self.known: dict[bytes, tuple[str, float] | None] = {}

    def symbol(self, word: bytes) -> tuple[str, float] | None:
        found = self.words.get(word)
        for n in BEGINNINGS:
            if found is None and len(word) > n:
                found = self.beginnings.get(word[:n])
        return found

    def features(self, text: bytes) -> np.ndarray:
        sums = np.zeros(_FEATURES)
        words = set(text.translate(_READ).split())
        known = self.known
        new = [w for w in words if w not in known]
        if len(known) + len(new) > REMEMBER:
            known.clear()
            new = words
        for w in new:
            known[w] = self.symbol(w)
        if not any(known[w] and known[w][0] in (INSULT, THREAT) for w in words):
            return sums
        for clause in clauses_of(text):
            read = [(QUOTE, 0.0) if w == b"\xff" else known.get(w) or self.symbol(w) or (OTHER, 0.0) for w in clause]
            if any(c in (INSULT, THREAT) for c, _ in read):
                marked = self.left.run([(c, False, False, False) for c, _ in read])
                marked = self.right.run(marked[::-1])[::-1]
                for pattern, (c, strength) in zip(marked, read):
                    if c in (INSULT, THREAT):
                        sums[_AT[pattern]] += strength
        return np.log1p(sums)


def _entry_counts(sample: DataFrame) -> DataFrame:
    """(entry, whole, toxic, clean): how many texts hold a word, or a word that goes on after this beginning."""

    def count(batches):
        held = Counter()

        def rows():
            keys = list(held)
            columns = [pa.array([k[0] for k in keys], pa.binary()), pa.array([k[1] for k in keys], pa.bool_()),
                       pa.array([k[2] for k in keys], pa.int32()), pa.array(held.values(), pa.int64())]
            return pa.RecordBatch.from_arrays(columns, names=["entry", "whole", "label", "n"])

        for batch in batches:
            for text, label in zip(text_bytes(batch), batch.column(1).to_pylist()):
                words = set(text.translate(_READ).split())
                held.update((w, True, label) for w in words)
                held.update({(w[:n], False, label) for n in BEGINNINGS for w in words if len(w) > n})
                if len(held) > REMEMBER:
                    yield rows()
                    held = Counter()
        yield rows()

    counted = sample.mapInArrow(count, "entry binary, whole boolean, label int, n long").groupBy("entry", "whole")
    return counted.agg(
        F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("toxic"),
        F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("clean"),
    )


def _lexicon(sample: DataFrame) -> Matcher:
    sizes = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    words, beginnings = dict(_SEEDS), {}
    if sizes.get(0) and sizes.get(1):
        a, b = F.col("toxic") + 0.5, F.col("clean") + 0.5
        odds = F.log(a * (sizes[0] + 1)) - F.log(b * (sizes[1] + 1))
        bound = odds - SURE * F.sqrt(1 / a + 1 / b)
        # Entries as frequent as this in a sample of fixed size are a bounded number.
        strong = _entry_counts(sample).where(F.col("toxic") >= SUPPORT).withColumn("strength", bound)
        for r in strong.where("strength > 0.5").orderBy("entry").collect():
            entry = bytes(r["entry"])
            if r["whole"]:
                if entry not in words or words[entry][0] in (INSULT, THREAT):
                    kind = words.get(entry, (INSULT,))[0]
                    words[entry] = (kind, max(r["strength"], words.get(entry, (0, 0.0))[1]))
            elif not any(entry[:n] in beginnings and beginnings[entry[:n]][1] >= r["strength"] - 0.5 for n in BEGINNINGS if n < len(entry)):
                beginnings[entry] = (INSULT, r["strength"])
    return Matcher(words, beginnings)


def _features(matcher: Matcher, spark):
    shared = Shared(spark, matcher)

    @F.arrow_udf("array<double>")
    def features(text: pa.Array) -> pa.Array:
        rows = [shared.value.features(t or b"") for t in text.cast(pa.large_binary()).to_pylist()]
        return pa.array(rows, pa.list_(pa.float64()))

    return features


def _weights(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression with a ridge, by Newton's method; the last weight is the bias."""
    if len(y) == 0 or y.min() == y.max():
        return np.array([1.0] * _FEATURES + [-3.0])
    x = np.hstack([x, np.ones((len(x), 1))])
    ridge = np.full(x.shape[1], 1.0)
    ridge[-1] = 0.01
    w = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        curve = (x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(curve, x.T @ (p - y) + ridge * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def score(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    sample = labelled.sample(docs, labels, "toxic", SAMPLE)
    features = _features(_lexicon(sample), spark)
    table = sample.select("label", features("text").alias("x")).toArrow()
    x = np.array(table["x"].to_pylist(), dtype=float).reshape(-1, _FEATURES)
    weights = _weights(x, table["label"].to_numpy().astype(float))
    total = F.aggregate(
        F.zip_with("x", F.array(*map(F.lit, weights[:-1].tolist())), lambda a, b: a * b), F.lit(float(weights[-1])), lambda s, v: s + v
    )
    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), labelled.held_out().alias("held_out"), features("text").alias("x"))
    out = out.select("doc_id", "held_out", (1 / (1 + F.exp(-total))).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
