"""Language-model scores by prediction by partial matching (PPM).

The model is a trie of byte contexts up to ``ORDER`` bytes, counted over all training rows. A text is its
words, A-Z lower-cased, each followed by a blank, and an end byte; contexts reach across words, and blanks
stand before the text. A byte is predicted from its longest known context. Of the context's mass, every
distinct follower gives up ``DISCOUNT`` to escape; an escape tries the context one byte shorter, where
the followers just ruled out are excluded; after the empty context the 257 symbols left are equally likely.
As shorter contexts have seen all followers of longer ones, exclusion needs one number for each context:
the count that its followers have in the context one shorter.

Scores come with a base: a smoothed unigram model of the words. Its vocabulary is a table. The ``HEAD``
most frequent words are broadcast (a fixed number), the other words of each document are joined.

Strings of ``ORDER + 1`` bytes go the same way, at every size: the prices of the most frequent, at most
``FREQUENT`` of them (16 bytes each), are broadcast; of each document's other strings the distinct ones are
joined with theirs. The trie is a table for each order: contexts with the numbers above, strings with their
counts. A string that training rows hold is priced by its longest context. The others pass down the orders, joined
with one table after the other; the tables of contexts up to one byte have at most 65,536 rows.

Rows are in training unless crc32(doc_id as text) mod 10 is 0; a null doc_id counts as the empty text, and is
held out. Null and empty texts are the end alone. Repeated rows count and are scored each for itself.
Without training rows every known count is 0. Other columns of any name are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ordermill.llm.common import Shared, bounded_batches, gram_codes, id_bucket, in_blocks, text_bytes, written

ORDER = 5
DISCOUNT = 0.5
FOLDS = 10
HEAD = 100_000
#: Strings whose prices are broadcast, at most; only strings of equal frequency class are taken or left together.
FREQUENT = 4_000_000
#: Distinct words or strings a task holds before it hands their counts on.
HELD = 1_000_000
SMOOTH = 0.1
SYMBOLS = 257

_END = b"\n"
_BEFORE = b" " * ORDER


def _strings(words: list[list[bytes]]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """Owners of parts, codes of all strings of ORDER + 1 bytes, and their parts, of texts given as words."""
    texts = [b" ".join([*w, _END]) for w in words]
    for owners, parts in in_blocks(texts, _BEFORE, 1 << 20):
        yield owners, *gram_codes(parts, ORDER)


class Counts:
    """Counts of codes, as sorted arrays."""

    def __init__(self):
        self.pending: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, codes: np.ndarray) -> None:
        self.pending.append(np.unique(codes, return_counts=True))
        self.size += len(self.pending[-1][0])
        if self.size > 4 * HELD:
            self.merge()

    def merge(self) -> tuple[np.ndarray, np.ndarray]:
        codes = np.concatenate([c for c, _ in self.pending] or [np.zeros(0, np.uint64)])
        weights = np.concatenate([n for _, n in self.pending] or [np.zeros(0, np.int64)])
        unique, at = np.unique(codes, return_inverse=True)
        self.pending = [(unique, np.bincount(at, weights=weights, minlength=len(unique)).astype(np.int64))]
        self.size = len(unique)
        return self.pending[0]


def _statistics(training: DataFrame) -> DataFrame:
    """(word, string, n): partial counts of words (the end is the empty word) and of strings; one of both is null."""
    names = ["word", "string", "n"]

    def word_rows(counter):
        n = len(counter)
        return pa.RecordBatch.from_arrays(
            [pa.array(counter.keys(), pa.binary()), pa.nulls(n, pa.int64()), pa.array(counter.values(), pa.int64())], names=names
        )

    def string_rows(counts):
        codes, n = counts.merge()
        for low in range(0, len(codes), 100_000):
            part = codes[low : low + 100_000].view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(part), pa.binary()), pa.array(part), pa.array(n[low : low + 100_000])], names=names
            )

    def count(batches):
        words, strings = Counter(), Counts()
        for batch in batches:
            split = [t.lower().split() for t in text_bytes(batch)]
            for w in split:
                words.update(w)
            words[b""] += len(split)
            for _, codes, _ in _strings(split):
                strings.add(codes)
            if len(words) > HELD // 2:
                yield word_rows(words)
                words = Counter()
            if strings.size > 2 * HELD and len(strings.merge()[0]) > HELD:
                yield from string_rows(strings)
                strings = Counts()
        yield word_rows(words)
        yield from string_rows(strings)

    return training.select("text").mapInArrow(count, "word binary, string long, n long")


def _find(table: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``wanted`` in the sorted ``table``, and whether they are there."""
    if not len(table):
        return np.zeros(len(wanted), dtype=np.int64), np.zeros(len(wanted), dtype=bool)
    at = np.minimum(np.searchsorted(table, wanted), len(table) - 1)
    return at, table[at] == wanted


def _last(octets: int) -> Column:
    return F.col("string").bitwiseAND((1 << 8 * octets) - 1)


def _trie(strings: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For each order its strings (string, n) and contexts (context, mass, kinds, below).

    ``below`` is the count that a context's followers have in the context one byte shorter.
    """
    levels = []
    for order in range(ORDER, -1, -1):
        shorter = F.sum("n").over(Window.partitionBy(_last(order))) if order else F.lit(0)
        counted = strings.select(F.shiftright("string", 8).alias("context"), "n", shorter.cast("double").alias("shorter"))
        contexts = counted.groupBy("context").agg(
            F.sum("n").cast("double").alias("mass"), F.count("*").cast("double").alias("kinds"), F.sum("shorter").alias("below")
        )
        levels.append((strings, written(contexts, f"lm-contexts-{order}")))
        if order:
            strings = written(strings.groupBy(_last(order).alias("string")).agg(F.sum("n").alias("n")), f"lm-strings-{order - 1}")
    return levels[::-1]


def _known_prices(strings: DataFrame, contexts: DataFrame) -> DataFrame:
    """(string, price) of strings that training rows hold."""
    joined = strings.join(contexts, F.shiftright("string", 8) == F.col("context"))
    return joined.select("string", F.log10((F.col("n") - DISCOUNT) / F.col("mass")).alias("price"))


def _new_prices(wanted: DataFrame, trie: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(string, price) of ``wanted``, distinct strings that no training row holds."""
    zero = F.lit(0.0)
    rows = wanted.select("string", zero.alias("price"), zero.alias("gone"), zero.alias("followers"), F.lit(False).alias("done"))
    for order in range(ORDER, -1, -1):
        strings, contexts = trie[order]
        strings = strings.select(F.col("string").alias("known"), "n")
        if order < 2:
            strings, contexts = F.broadcast(strings), F.broadcast(contexts)
        rows = rows.join(contexts, F.shiftright(_last(order + 1), 8) == F.col("context"), "left")
        rows = rows.join(strings, _last(order + 1) == F.col("known"), "left")
        open_, seen, hit = ~F.col("done"), F.col("context").isNotNull(), F.col("known").isNotNull()
        mass, left = F.col("mass") - F.col("gone"), F.col("kinds") - F.col("followers")
        step = F.when(open_ & hit, F.log10((F.col("n") - DISCOUNT) / mass))
        step = step.when(open_ & seen & (left > 0), F.log10(DISCOUNT * left / mass)).otherwise(0.0)
        missed = open_ & seen & ~hit
        rows = rows.select(
            "string",
            (F.col("price") + step).alias("price"),
            F.when(missed, F.col("below")).otherwise(F.col("gone")).alias("gone"),
            F.when(missed, F.col("kinds")).otherwise(F.col("followers")).alias("followers"),
            (F.col("done") | hit).alias("done"),
        )
    rest = F.when(F.col("done"), 0.0).otherwise(F.log10(SYMBOLS - F.col("followers")))
    return rows.select("string", (F.col("price") - rest).alias("price"))


def _frequent(strings: DataFrame, most: int) -> DataFrame:
    """The most frequent strings, at most ``most``: whole classes of frequency, eight to a doubling."""
    kind = F.floor(8 * F.log2("n"))
    sizes = strings.groupBy(kind.alias("kind")).count().collect()
    taken, least = 0, None
    for row in sorted(sizes, key=lambda r: -r["kind"]):
        taken += row["count"]
        if taken > most:
            break
        least = row["kind"]
    return strings.where(F.lit(False) if least is None else kind >= least)


def score(docs: DataFrame, head: int = HEAD, most: int = FREQUENT) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for every row of ``docs``."""
    spark = docs.sparkSession
    bounded_batches(spark)
    held_out = id_bucket("doc_id", FOLDS) == 0
    partial = written(_statistics(docs.where(~held_out)), "lm-partial-counts")
    words = partial.where("word is not null").groupBy("word").agg(F.sum("n").alias("n"))
    words = written(words.where("n > 0"), "lm-words")
    strings = partial.where("string is not null").groupBy("string").agg(F.sum("n").alias("n"))
    strings = written(strings, "lm-strings")
    size = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("tokens"), F.count("*").alias("kinds")).first()
    tokens, kinds = size["tokens"], size["kinds"]
    floor = float(np.log10(tokens + SMOOTH * (kinds + 1)))
    frequent = words.orderBy(F.desc("n"), "word").limit(head).collect()
    known = Shared(spark, {bytes(r["word"]): float(np.log10(r["n"] + SMOOTH)) - floor for r in frequent})
    trie = _trie(strings)
    table = _known_prices(_frequent(strings, most), trie[ORDER][1]).toArrow()
    order = np.argsort(table["string"].to_numpy())
    frequent_strings = Shared(spark, tuple(table[c].to_numpy()[order] for c in ("string", "price")))
    del table, order

    @F.arrow_udf(
        "struct<n_tokens:long,head_known:long,head_base:double,head_score:double,"
        "tail:array<struct<word:binary,n:long>>,strings:array<struct<string:long,n:long>>>"
    )
    def scored(text: pa.Array) -> pa.Array:
        table, (codes_known, prices) = known.value, frequent_strings.value
        split = [(t or b"").lower().split() for t in text.cast(pa.large_binary()).to_pylist()]
        sums = np.zeros(len(split))
        # Each document's other strings: owner, string and how often, in the order of owners.
        apart = [(np.zeros(0, np.int64),) * 3]
        for owners, codes, part in _strings(split):
            codes = codes.view(np.int64)
            unique, of = np.unique(codes, return_inverse=True)
            at, hit = _find(codes_known, unique)
            price = np.zeros(len(unique))
            price[hit] = prices[at[hit]]
            hit, owner = hit[of], np.array(owners)[part]
            sums += np.bincount(owner, weights=price[of], minlength=len(split))
            owner, codes = owner[~hit], codes[~hit]
            if len(codes):
                order = np.lexsort((codes, owner))
                owner, codes = owner[order], codes[order]
                first = np.flatnonzero((np.diff(owner, prepend=-1) != 0) | (np.diff(codes, prepend=-1) != 0))
                apart.append((owner[first], codes[first], np.diff(first, append=len(codes))))
        owner, codes, times = (np.concatenate(x) for x in zip(*apart))
        ends = np.searchsorted(owner, np.arange(len(split) + 1)).astype(np.int32)
        strings = pa.ListArray.from_arrays(pa.array(ends), pa.StructArray.from_arrays([pa.array(codes), pa.array(times)], ["string", "n"]))
        bases, seen, words, numbers, ends = [], [], [], [], [0]
        for w in split:
            counts = Counter(w)
            counts[b""] = 1
            base = found = 0
            for word, n in counts.items():
                value = table.get(word)
                if value is None:
                    words.append(word)
                    numbers.append(n)
                else:
                    base += n * value
                    found += n
            bases.append(float(base))
            seen.append(found)
            ends.append(len(words))
        pairs = pa.StructArray.from_arrays([pa.array(words, pa.binary()), pa.array(numbers, pa.int64())], ["word", "n"])
        columns = {
            "n_tokens": pa.array([len(w) + 1 for w in split], pa.int64()),
            "head_known": pa.array(seen, pa.int64()),
            "head_base": pa.array(bases, pa.float64()),
            "head_score": pa.array(sums),
            "tail": pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pairs),
            "strings": strings,
        }
        return pa.StructArray.from_arrays(list(columns.values()), list(columns))

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out.alias("held_out"), scored("text").alias("s"))
    # Written once, the numbers of rows stay what they are.
    rows = written(rows.select(F.monotonically_increasing_id().alias("row"), "doc_id", "held_out", "s.*"), "lm-rows")

    tail = rows.select("row", F.explode("tail").alias("t")).select("row", "t.word", F.col("t.n").alias("times"))
    tail = tail.join(words, "word", "left").select("row", "times", F.coalesce("n", F.lit(0)).alias("n"))
    rare = tail.groupBy("row").agg(
        F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("tail_known"),
        F.sum(F.col("times") * (F.log10(F.col("n") + SMOOTH) - floor)).alias("tail_base"),
    )
    others = rows.select("row", F.explode("strings").alias("s")).select("row", "s.string", F.col("s.n").alias("times"))
    distinct = others.select("string").distinct()
    wanted = written(distinct.join(strings, "string", "left"), "lm-wanted")
    prices = _known_prices(wanted.where("n is not null"), trie[ORDER][1])
    prices = written(prices.unionByName(_new_prices(wanted.where("n is null"), trie)), "lm-prices")
    rest = others.join(prices, "string").groupBy("row").agg(F.sum(F.col("times") * F.col("price")).alias("tail_score"))
    out = rows.join(rare, "row", "left").join(rest, "row", "left")
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("head_known") + F.coalesce("tail_known", F.lit(0))).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("head_base") + F.coalesce("tail_base", F.lit(0.0))).alias("base_score"),
        (F.col("head_score") + F.coalesce("tail_score", F.lit(0.0))).alias("score"),
    )
