"""Ranked lexical search by dual trees: items and documents in hierarchies of coordinate maxima, searched together.

A document is a sparse vector of whole-number term impacts, an item one of term weights; a score is their inner
product. Documents are dealt into blocks by their two strongest terms, at most about ``DOC_POSTINGS`` postings a block
(blocks by the row's hash where one pair of terms is too frequent), items likewise by ``ITEM_POSTINGS``. A block is
a tree whose nodes hold, for each term, the greatest value below them; the product of two nodes is a bound for every
pair below. The pairs of roots are a join on terms with a grouped sum. For each item block its ``SEEDS`` most promising
document blocks are searched first; they give every item a kth score that its best results cannot fall below. All
other pairs of blocks whose bound reaches the weakest of those scores are then searched from the roots down; a pair of
nodes goes unvisited, with all items and documents below, when its bound is below the weakest kth score of the node's
items. Each item is compared with the leaves that remain, best bound first, until a bound is below its own kth score. Equal
bounds are visited, since equal scores go by id. Nothing else is left out, so the result is exact.

Terms are the maximal runs of ASCII letters and digits and all characters beyond ASCII, A-Z lower-cased. Counts
cover all documents and whole texts. Only document terms that may occur in an item travel on: a bit table of
fixed size (``BITS``) screens them in the tasks, a join on the term decides. No list of items, terms or
documents passes the driver.

A row is a document, and a row is an item: repeated documents are ranked one after the other, repeated items get equal
results of their own. Null texts have no terms; items without terms or without documents that score get no rows. Null
ids of documents come last among equals. Empty tables give an empty result. Only ids and texts are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from ordermill.llm.common import Shared, bounded_batches, text_bytes, written

RESULTS = 10
DOC_POSTINGS = 1 << 17
ITEM_POSTINGS = 1 << 12
SEEDS = 4
BITS = 1 << 23
LEAF_DOCS = 4
FAN = 8
#: Leaves of documents that an item is compared with at once, most promising first.
LEAVES = 32
#: Numbers in the table of a tree's maxima, and words whose bit a task remembers.
TABLE = 1 << 23
REMEMBER = 300_000
EXACT = 1 << 53

_KEEP = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_KEEP).split()


def _bit(term: bytes) -> int:
    return xxhash.xxh64_intdigest(term, seed=42) & (BITS - 1)


# --- one pair of blocks --------------------------------------------------------------------------------------------


class Block:
    """Sparse vectors in the order of their strongest terms, and a tree of coordinate maxima over them.

    Node n covers the vectors from ``low[n]`` up to the next node of its level; its children are the nodes from
    ``first[n]`` to before ``last[n]``. The leaves come first, each its own child, the root last.
    """

    def __init__(self, lists: pa.Array, values: pa.Array, terms: np.ndarray, leaf: int, others: int = 1):
        """``terms``: the sorted terms that count, other coordinates are left out; ``others``: vectors on the other side."""
        sizes = pc.list_value_length(lists).to_numpy()
        flat = lists.flatten().to_numpy()
        self.n, ends = len(sizes), np.cumsum(sizes)
        lead = [np.where(sizes > i, flat[np.minimum(ends - sizes + i, len(flat) - 1)], -1) for i in (1, 0)]
        self.order = np.lexsort(lead)
        place = np.empty(self.n, np.int64)
        place[self.order] = np.arange(self.n)
        column = np.minimum(np.searchsorted(terms, flat), len(terms) - 1)
        known = terms[column] == flat
        row, column, value = place[np.repeat(np.arange(self.n), sizes)][known], column[known], values.flatten().to_numpy()[known]
        by = np.argsort(row, kind="stable")
        row, self.column, self.value = row[by], column[by], value[by]
        self.start = np.searchsorted(row, np.arange(self.n + 1))
        leaf = max(leaf, -(-self.n // max(1, TABLE // (2 * max(len(terms), others)))))
        low = np.arange(0, self.n, leaf)
        level = np.zeros((len(low), len(terms)), np.int64)
        np.maximum.at(level, (row // leaf, self.column), self.value)
        self.leaves = len(low)
        lows, firsts, lasts, tables, before = [low], [np.arange(len(low))], [np.arange(1, len(low) + 1)], [level], 0
        while len(level) > 1:
            heads = np.arange(0, len(level), FAN)
            firsts.append(before + heads)
            lasts.append(before + np.append(heads[1:], len(level)))
            before += len(level)
            low, level = low[heads], np.maximum.reduceat(level, heads)
            lows.append(low)
            tables.append(level)
        self.levels = [len(t) for t in tables]
        self.low, self.first, self.last = np.concatenate(lows), np.concatenate(firsts), np.concatenate(lasts)
        self.maxima = np.concatenate(tables)

    def weakest(self, values: np.ndarray) -> np.ndarray:
        """The least value of the vectors below each node."""
        starts = np.cumsum([0, *self.levels])
        return np.concatenate([np.minimum.reduceat(values, self.low[a:b]) for a, b in zip(starts[:-1], starts[1:])])

    def members(self, leaves: np.ndarray) -> np.ndarray:
        ends = np.append(self.low[1 : self.leaves], self.n)
        return _ranges(self.low[leaves], ends[leaves] - self.low[leaves])[0]


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of numbers one after the other, and the run of each."""
    run = np.repeat(np.arange(len(sizes)), sizes)
    return starts[run] + np.arange(len(run)) - (np.cumsum(sizes) - sizes)[run], run


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of rows; floating point is exact below 2^53 and much faster."""
    if a.size and b.size and int(a.sum(axis=1).max()) * int(b.max()) < EXACT:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


def search_blocks(
    docs: Block, items: Block, precedence: np.ndarray, least: np.ndarray, k: int
) -> tuple[list[tuple[np.ndarray, np.ndarray]], int]:
    """Scores and precedence of every item's best documents, in block order, and the number of products computed.

    ``precedence`` ranks the documents among equal scores; only scores of at least ``least``, an item each, are wanted.
    A leaf of ``items`` is one item.
    """
    least = np.maximum(least, 1)
    bounds = _product(items.maxima, docs.maxima)
    weakest = items.weakest(least)
    i, d = np.array([len(items.low) - 1]), np.array([len(docs.low) - 1])
    while len(i):
        reach = bounds[i, d] >= weakest[i]
        i, d = i[reach], d[reach]
        if not len(i) or max(i.max() - items.leaves, d.max() - docs.leaves) < 0:
            break
        down = docs.last[d] - docs.first[d]
        at, pair = _ranges(np.zeros(len(i), np.int64), (items.last[i] - items.first[i]) * down)
        i, d = items.first[i][pair] + at // down[pair], docs.first[d][pair] + at % down[pair]
    by = np.lexsort((-bounds[i, d], i))
    d, places = d[by], np.searchsorted(i[by], np.arange(items.n + 1))
    best, products = [], 0
    for item in range(items.n):
        weights = np.zeros(items.maxima.shape[1], np.int64)
        own = slice(items.start[item], items.start[item + 1])
        weights[items.column[own]] = items.value[own]
        scores, ranks = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for low in range(places[item], places[item + 1], LEAVES):
            leaves = d[low : min(low + LEAVES, places[item + 1])]
            leaves = leaves[bounds[item, leaves] >= least[item]]
            if not len(leaves):
                break
            rows = docs.members(leaves)
            at, row = _ranges(docs.start[rows], docs.start[rows + 1] - docs.start[rows])
            sums = np.zeros(len(rows), np.int64)
            np.add.at(sums, row, weights[docs.column[at]] * docs.value[at])
            products += len(rows)
            reach = sums >= least[item]
            scores, ranks = np.concatenate([scores, sums[reach]]), np.concatenate([ranks, precedence[rows[reach]]])
            order = np.lexsort((ranks, -scores))[:k]
            scores, ranks = scores[order], ranks[order]
            if len(scores) == k:
                least[item] = max(least[item], scores[-1])
        best.append((scores, ranks))
    return best, products


def _pair(docs: pa.Table, items: pa.Table, k: int) -> pa.Table:
    """(item, doc, doc_id, score) of one document block and one item block."""
    docs, items = docs.combine_chunks(), items.combine_chunks()
    one = lambda table, name: table[name].chunk(0) if table[name].num_chunks else table[name].combine_chunks()
    terms = np.unique(one(items, "terms").flatten().to_numpy())
    right = Block(one(items, "terms"), one(items, "weights"), terms, 1)
    left = Block(one(docs, "terms"), one(docs, "impacts"), terms, LEAF_DOCS, right.n)
    by_id = pc.sort_indices(docs, [("doc_id", "ascending"), ("doc", "ascending")], null_placement="at_end").to_numpy()
    precedence = np.empty(left.n, np.int64)
    precedence[by_id] = np.arange(left.n)
    least = items["least"].to_numpy()[right.order]
    best, _ = search_blocks(left, right, precedence[left.order], least, k)
    keys = items["item"].to_numpy()[right.order]
    rows = by_id[np.concatenate([ranks for _, ranks in best])]
    return pa.table({
        "item": np.repeat(keys, [len(scores) for scores, _ in best]),
        "doc": docs["doc"].take(rows),
        "doc_id": docs["doc_id"].take(rows),
        "score": np.concatenate([scores for scores, _ in best]),
    })


# --- counts and vectors --------------------------------------------------------------------------------------------


def _item_terms(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, item_id, term): the distinct terms of every row, numbered by ``item``."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [list(set(terms_of(t))) for t in text_bytes(batch)]
            terms = pa.array(found, pa.list_(pa.binary())).cast(pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), terms], names=["item_id", "terms"])

    rows = items.select(F.col(f"`{item_id}`").alias("item_id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["item_id"].dataType.simpleString()
    rows = rows.mapInArrow(read, f"item_id {kind}, terms array<string>").withColumn("item", F.monotonically_increasing_id())
    return written(rows.select("item", "item_id", F.explode("terms").alias("term")), "lexical-items")


def _screen(item_terms: DataFrame) -> np.ndarray:
    """A bit for every hash that an item's term has; the table's size does not depend on the items."""
    bit = item_terms.select((F.xxhash64("term").bitwiseAND(F.lit(BITS - 1)) + 1).alias("bit"))
    parts = bit.groupBy(F.bitmap_bucket_number("bit").alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("bits"))
    out = np.zeros(BITS, dtype=bool)
    for r in parts.collect():
        bits = np.unpackbits(np.frombuffer(r["bits"], np.uint8), bitorder="little")
        out[(r["part"] - 1) * len(bits) : r["part"] * len(bits)] = bits[: BITS - (r["part"] - 1) * len(bits)]
    return np.packbits(out, bitorder="little")


def _doc_terms(docs: DataFrame, doc_id: str, text: str, screen: Shared) -> DataFrame:
    """(doc, doc_id, n, terms, counts): all terms counted in ``n``, those that pass the screen with their occurrences."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits, known = screen.value, {}
        for batch in batches:
            sizes, terms, counts = [], [], []
            for t in text_bytes(batch):
                words = terms_of(t)
                sizes.append(len(words))
                counted = Counter(words)
                for word in counted:
                    if word not in known:
                        if len(known) >= REMEMBER:
                            known.clear()
                        at = _bit(word)
                        known[word] = bool(bits[at >> 3] >> (at & 7) & 1)
                passed = [word for word in counted if known.get(word, True)]
                terms.append(passed)
                counts.append([counted[word] for word in passed])
            columns = [
                batch.column(0), pa.array(sizes, pa.int64()), pa.array(terms, pa.list_(pa.binary())).cast(pa.list_(pa.string())),
                pa.array(counts, pa.list_(pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "terms", "counts"])

    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    rows = rows.mapInArrow(read, f"doc_id {kind}, n long, terms array<string>, counts array<long>")
    return written(rows.withColumn("doc", F.monotonically_increasing_id()), "lexical-docs")


def _vectors(entries: DataFrame, key: str, carried: str, value: str, name: str) -> DataFrame:
    """One sparse vector a row, strongest coordinate first: its terms and values."""
    coordinates = F.sort_array(F.collect_list(F.struct("strength", "t", value)), asc=False)
    rows = entries.groupBy(key).agg(F.any_value(carried).alias(carried), coordinates.alias("c"))
    return written(rows.select(key, carried, F.col("c.t").alias("terms"), F.col(f"c.{value}").alias(name)), f"lexical-{key}-vectors")


def _dealt(vectors: DataFrame, key: str, block: str, postings: int) -> DataFrame:
    """``vectors`` with a block of about ``postings`` coordinates at most, or one vector."""
    size = F.size("terms").cast("long")
    bins = -(-(vectors.agg(F.sum(size)).first()[0] or 1) // postings)
    rows = vectors.withColumn("bin", F.pmod(F.xxhash64(F.slice("terms", 1, 2)), F.lit(bins)))
    parts = rows.groupBy("bin").agg(F.ceil(F.sum(size) / postings).cast("long").alias("parts")).where(F.col("parts") > 1)
    part = F.pmod(F.xxhash64(key), F.coalesce("parts", F.lit(1).cast("long")))
    dealt = rows.join(parts, "bin", "left").withColumn(block, F.call_function("shiftleft", F.col("bin"), F.lit(32)) + part)
    return written(dealt.drop("bin", "parts"), f"lexical-{block}")


def _roots(dealt: DataFrame, block: str, name: str) -> DataFrame:
    """(block, t, value): the greatest value of every term in a block."""
    entries = dealt.select(block, F.explode(F.arrays_zip(F.col("terms").alias("t"), F.col(name).alias("x"))).alias("e"))
    return entries.groupBy(block, F.col("e.t").alias("t")).agg(F.max("e.x").alias(name))


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = RESULTS,
    doc_id: str = "doc_id",
    item_id: str = "item_id",
    text: str = "text",
    doc_postings: int = DOC_POSTINGS,
    item_postings: int = ITEM_POSTINGS,
) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of every item."""
    spark = docs.sparkSession
    bounded_batches(spark)
    item_terms = _item_terms(items, item_id, text)
    counted = _doc_terms(docs, doc_id, text, Shared(spark, _screen(item_terms)))
    whole = counted.agg(F.count_if(F.col("n") > 0).alias("n"), F.sum("n").alias("length")).first()
    if not whole["n"]:
        ids = f"item_id {item_terms.schema['item_id'].dataType.simpleString()}, rank int, doc_id {counted.schema['doc_id'].dataType.simpleString()}"
        return spark.createDataFrame([], f"{ids}, score long")

    holders = counted.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df"))
    weight = F.floor(1000 * F.log(F.lit(2.0 * whole["n"] + 2) / (2 * F.col("df") + 1))).cast("long")
    wanted = item_terms.select("term").distinct().join(holders, "term").select("term", weight.alias("weight"))
    weights = written(wanted.where(F.col("weight") > 0).withColumn("t", F.monotonically_increasing_id()), "lexical-weights")

    # The length's share may need more than 64 bits on the way.
    share = F.expr(f"cast(90 * cast(n as decimal(38,0)) * {whole['n']} div {whole['length']} as long)")
    entry = F.explode(F.arrays_zip("terms", "counts")).alias("e")
    entries = counted.select("doc", "doc_id", (F.lit(10) + share).alias("m"), entry)
    entries = entries.join(weights, F.col("e.terms") == F.col("term"))
    entries = entries.select("doc", "doc_id", "t", F.expr("1000000000 * e.counts div (1000 * e.counts + 8 * m)").alias("impact"), "weight")
    entries = entries.where(F.col("impact") > 0).withColumn("strength", F.col("weight") * F.col("impact"))
    documents = _dealt(_vectors(entries, "doc", "doc_id", "impact", "impacts"), "doc", "db", doc_postings)
    asked = item_terms.join(weights, "term").withColumn("strength", F.col("weight"))
    asking = _dealt(_vectors(asked, "item", "item_id", "weight", "weights"), "item", "ib", item_postings)

    both = _roots(asking, "ib", "weights").join(_roots(documents, "db", "impacts"), "t")
    pairs = written(both.groupBy("ib", "db").agg(F.sum(F.col("weights") * F.col("impacts")).alias("bound")), "lexical-pairs")
    order = Window.partitionBy("ib").orderBy(F.desc("bound"), "db")
    seeds = written(pairs.withColumn("n", F.row_number().over(order)).where(F.col("n") <= SEEDS).select("ib", "db"), "lexical-seeds")

    id_kind = documents.schema["doc_id"].dataType.simpleString()
    found = f"item long, doc long, doc_id {id_kind}, score long"

    def compared(chosen: DataFrame, asking: DataFrame) -> DataFrame:
        left = documents.join(chosen.select("ib", "db"), "db").select("ib", "db", "doc", "doc_id", "terms", "impacts")
        right = asking.join(chosen.select("ib", "db"), "ib").select("ib", "db", "item", "terms", "weights", "least")
        groups = left.groupBy("ib", "db").cogroup(right.groupBy("ib", "db"))
        return groups.applyInArrow(lambda a, b: _pair(a, b, k), found)

    best_first = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("doc")]
    ranked = Window.partitionBy("item").orderBy(*best_first)
    first = written(compared(seeds, asking.withColumn("least", F.lit(0).cast("long"))), "lexical-first")
    top = first.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    least = top.where(F.col("rank") == k).select("item", F.col("score").alias("least"))
    bounded = written(asking.join(least, "item", "left").fillna(0, ["least"]), "lexical-bounded")
    weakest = bounded.groupBy("ib").agg(F.min("least").alias("weakest"))
    others = pairs.join(seeds, ["ib", "db"], "left_anti").join(weakest, "ib").where(F.col("bound") >= F.col("weakest"))
    rest = compared(written(others, "lexical-others"), bounded)
    result = first.union(rest).withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k)
    names = asking.select("item", "item_id")
    return result.join(names, "item").select("item_id", F.col("rank").cast("int").alias("rank"), "doc_id", "score")


#: The same ranking in SQL, over all pairs that share a term.
ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS k, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents
), whole AS (
  SELECT count(*) FILTER (WHERE len(terms) > 0) AS n, sum(len(terms))::BIGINT AS l FROM docs
), entries AS (
  SELECT k, doc_id, len(terms) AS n, unnest(terms) AS term FROM docs
), counted AS (
  SELECT k, doc_id, n, term, count(*) AS tf FROM entries GROUP BY ALL
), weights AS (
  SELECT term, floor(1000 * ln((2.0::DOUBLE * any_value(w.n) + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM counted, whole w GROUP BY term
), asked AS (
  SELECT DISTINCT q, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT row_number() OVER () AS q, * FROM benchmark)
), scores AS (
  SELECT q, item_id, k, doc_id, sum(weight * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * c.n * w.n) // w.l))))::BIGINT AS score
  FROM asked JOIN counted c USING (term) JOIN weights USING (term), whole w GROUP BY q, item_id, k, doc_id
), ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST, k)::INT AS rank FROM scores WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""
