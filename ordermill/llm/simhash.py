"""SimHash near-duplicates with pigeonring candidate pruning.

A document's fingerprint has 64 bits; two documents are linked if at most ``BUDGET`` bits differ.
The bits lie on a ring of five segments. If all differences together are at most 4, some segment
starts a chain in which the first k segments differ in at most k * 4 / 5 bits, for every k: none in
the first, one in two, two in three, three in four (the strong form of the pigeonring principle).
Two segments with at most one difference are found by an equality join: one side offers its 26
bits as they are, the other also with each bit of the second segment turned. The longer chains
are checked as join conditions before the full distance.

Rows with null or blank-only text have fingerprint zero and link like any other. Repeated rows and
equal fingerprints meet in one representative first, so thousands of copies cost one node.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ordermill.llm.common import bounded_batches, row_key, written
from ordermill.llm.components import connected_components

BUDGET = 4
WIDTHS = (13, 13, 13, 13, 12)
SHINGLE = 4
SEED = 42
#: Hashes counted at once; bounds memory for a very long document.
HASHES = 1 << 16


def shingle_hashes(text: bytes, words: int = SHINGLE) -> Iterator[np.ndarray]:
    """Unsigned hashes of all shingles of a whole text, in pieces."""
    parts = text.lower().split()
    if not parts:
        return
    joined = b" ".join(parts)
    hash64 = xxhash.xxh64_intdigest
    if len(parts) <= words:
        yield np.array([hash64(joined, SEED)], dtype=np.uint64)
        return
    ends = np.cumsum(np.fromiter(map(len, parts), dtype=np.int64, count=len(parts)) + 1)
    starts = np.concatenate(([0], ends[:-words])).tolist()
    stops = (ends[words - 1 :] - 1).tolist()
    for low in range(0, len(starts), HASHES):
        pairs = zip(starts[low : low + HASHES], stops[low : low + HASHES])
        yield np.array([hash64(joined[a:b], SEED) for a, b in pairs], dtype=np.uint64)


#: Row v: the eight bits of the byte v, lowest first.
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8).reshape(-1, 1), axis=1, bitorder="little").astype(np.int64)


def fingerprint(text: bytes) -> int:
    """The 64-bit fingerprint as a signed integer; bit j is bit j of the hashes' majority."""
    counts, total = np.zeros(64, dtype=np.int64), 0
    for hashes in shingle_hashes(text):
        octets = hashes.view(np.uint8).reshape(-1, 8)
        total += len(hashes)
        if len(hashes) < 512:
            counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
        else:
            for k in range(8):
                counts[8 * k : 8 * k + 8] += np.bincount(octets[:, k], minlength=256) @ _BITS
    return int(np.packbits(2 * counts > total, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame) -> DataFrame:
    """(doc_id, key, fp) for every row of ``docs``, ``key`` of doc_id and text; other columns are not read."""
    bounded_batches(docs.sparkSession)

    @F.arrow_udf("long")
    def printed(text: pa.Array) -> pa.Array:
        return pa.array([fingerprint(t or b"") for t in text.cast(pa.large_binary()).to_pylist()], pa.int64())

    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_key("doc_id", "text").alias("key"), printed("text").alias("fp")
    )


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _segments() -> list[int]:
    low, masks = 0, []
    for width in WIDTHS:
        masks.append(((1 << width) - 1) << low)
        low += width
    return masks


def _starts() -> list[dict]:
    """For each segment as a chain's start: masks of the first 2, 3, 4 segments, and the second's bits."""
    masks, n, out = _segments(), len(WIDTHS), []
    for start in range(n):
        ring = [masks[(start + k) % n] for k in range(n)]
        second = [1 << b for b in range(64) if ring[1] >> b & 1]
        out.append({"chain": [sum(ring[:k]) for k in range(1, n)], "second": ring[1], "bits": second})
    return out


def links(prints: DataFrame) -> DataFrame:
    """(x, y) for all pairs of different fingerprints (column ``fp``, distinct) within the budget."""
    starts = _starts()
    long = lambda value: F.lit(_signed(value))
    offered = F.array(*[
        F.struct(F.lit(i).cast("byte").alias("start"), long(s["chain"][1]).alias("mask"))
        for i, s in enumerate(starts)
    ])
    # Of two ends one bit apart in the second segment, exactly one has an even number of ones there: it asks.
    asked = F.array(*[
        F.struct(
            F.lit(i).cast("byte").alias("start"),
            long(s["chain"][1]).alias("mask"),
            long(s["second"]).alias("second"),
            long(flip).alias("flip"),
        )
        for i, s in enumerate(starts)
        for flip in [0, *s["bits"]]
    ])
    index = prints.select(F.col("fp").alias("y"), F.explode(offered).alias("o")).select(
        "y", "o.start", (F.col("y").bitwiseAND(F.col("o.mask"))).alias("key")
    )
    probes = (
        prints.select(F.col("fp").alias("x"), F.explode(asked).alias("o"))
        .where((F.col("o.flip") == 0) | (F.bit_count(F.col("x").bitwiseAND(F.col("o.second"))) % 2 == 0))
        .select(
            "x",
            F.col("o.start").alias("at"),
            F.col("x").bitwiseAND(F.col("o.mask")).bitwiseXOR(F.col("o.flip")).alias("probe"),
            (F.col("o.flip") == 0).alias("plain"),
        )
    )
    differ = F.col("x").bitwiseXOR(F.col("y"))
    budgets = [k * BUDGET // len(WIDTHS) for k in range(1, len(WIDTHS))]

    def chain(k: int):
        mask = F.lit(0).cast("long")
        for i, s in enumerate(starts):
            mask = F.when(F.col("start") == i, long(s["chain"][k])).otherwise(mask)
        return F.bit_count(differ.bitwiseAND(mask)) <= budgets[k]

    near = (
        (F.col("start") == F.col("at"))
        & (F.col("key") == F.col("probe"))
        & (~F.col("plain") | (F.col("x") < F.col("y")))
        & chain(2)
        & chain(3)
        & (F.bit_count(differ) <= BUDGET)
    )
    # Exploded rows outgrow Spark's size estimate, so a broadcast must not be chosen by it.
    return probes.hint("merge").join(index, near).select("x", "y")


def components(docs: DataFrame) -> DataFrame:
    """(doc_id, key, fp, component_id) for every row of ``docs``."""
    prints = written(fingerprints(docs), "fingerprints")
    nodes = written(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "distinct-fingerprints")
    roots = connected_components(links(nodes.select("fp")))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    least = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    labels = rooted.join(least, "root").select("fp", "component_id", "root")
    return prints.join(labels, "fp").select("doc_id", "key", "fp", "component_id", "root")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint, component_id) for every row of ``docs``.

    ``component_id`` is the smallest doc_id that links reach, a null id never being smallest; a
    component of null ids only has a null one.
    """
    return components(docs).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_representatives(docs: DataFrame) -> DataFrame:
    """One row of ``docs`` for each component: that with the smallest doc_id, null last.

    Of several texts with that id, the one with the least key stays, and of equal rows one.
    """
    found = written(components(docs).select("key", "root", F.col("doc_id").isNull().alias("no_id"), "doc_id"), "components")
    best = found.groupBy("root").agg(F.min(F.struct("no_id", "doc_id", "key"))["key"].alias("best"))
    goes = written(found.join(best, "root").where("key <> best").select("key").distinct(), "near-copies")
    again = written(found.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key"), "repeated-rows")
    names = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(F.struct(*names).alias("row"), row_key("doc_id", "text").alias("key"))
    # The same plan at every size: near copies are a share of all rows and soon too many to broadcast.
    keyed = keyed.join(goes.hint("merge"), "key", "left_anti")
    kept = keyed.join(again, "key", "left_anti").select("row.*")
    if again.isEmpty():
        return kept
    one = keyed.join(again, "key").groupBy("key").agg(F.min_by("row", F.xxhash64("row")).alias("row"))
    return kept.union(one.select("row.*"))
