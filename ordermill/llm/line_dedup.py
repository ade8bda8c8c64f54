"""Line dedup: drop every line whose normalised form occurs in many documents.

A line's key is the line without blanks at both ends, A-Z lower-cased. Keys are hashed to 128 bits;
each row offers a key once, with the positions of its lines. Keys in too few rows cannot be in enough
documents: a grouped sum that combines before the shuffle leaves the others, and of these the distinct
documents are counted. Rows that hold frequent keys learn the positions through a join on the key and a
grouping by row, so no list of frequent lines is ever held whole. The text is then put together from
the lines at the positions that stay.

A document is a doc_id: rows that repeat one, with the same text or another, count once for a key. Rows
without an id count as one document for each different text. Null and empty text are one empty line;
empty keys are never dropped. A row that loses all lines stays, with empty text. Input columns named
like the added ones are replaced.
"""

from __future__ import annotations

from array import array
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from ordermill.llm.common import BLANKS, bounded_batches, row_key, written

MIN_DOCS = 10
MIN_POINTS = 1
_STRIP = BLANKS.encode()


def _key_hash(line: bytes, min_points: int) -> bytes | None:
    """The hash of a line's key, or nothing for a key too short to be dropped."""
    key = line.strip(_STRIP).lower()
    if len(key) < min_points or (min_points > 1 and len(key.decode("utf-8", "replace")) < min_points):
        return None
    return xxhash.xxh3_128_digest(key)


def _texts(values: pa.Array) -> list[bytes]:
    return [v or b"" for v in values.cast(pa.large_binary()).to_pylist()]


def dedup_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_points: int = MIN_POINTS) -> DataFrame:
    """``docs`` with shortened ``text``, and ``n_lines`` (before), ``n_dropped``."""
    bounded_batches(docs.sparkSession)

    @F.arrow_udf("array<struct<line:binary,places:array<int>>>")
    def keyed_lines(text: pa.Array) -> pa.Array:
        rows, lines, ends, places = [0], [], [0], array("i")
        for t in _texts(text):
            found: dict[bytes, array] = {}
            for place, line in enumerate(t.split(b"\n")):
                line = _key_hash(line, min_points)
                if line is not None:
                    found.setdefault(line, array("i")).append(place)
            for line, at in found.items():
                lines.append(line)
                places.extend(at)
                ends.append(len(places))
            rows.append(len(lines))
        at = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(places, dtype=np.int32)))
        keyed = pa.StructArray.from_arrays([pa.array(lines, pa.binary()), at], names=["line", "places"])
        return pa.ListArray.from_arrays(pa.array(rows, pa.int32()), keyed)

    result = "text string, n_lines long, n_dropped long"

    @F.arrow_udf(f"struct<{result.replace(' ', ':').replace(',:', ',')}>")
    def without(text: pa.Array, places: pa.Array) -> pa.Array:
        kept, before, dropped = [], [], []
        for t, drop in zip(_texts(text), places):
            lines = t.split(b"\n")
            before.append(len(lines))
            gone = drop.as_py() or ()
            if gone:
                stays = bytearray(b"\1") * len(lines)
                for place in gone:
                    stays[place] = 0
                lines = list(compress(lines, stays))
            dropped.append(len(gone))
            kept.append(b"\n".join(lines))
        return pa.StructArray.from_arrays(
            [pa.array(kept, pa.binary()).cast(pa.string()), pa.array(before, pa.int64()), pa.array(dropped, pa.int64())],
            names=["text", "n_lines", "n_dropped"],
        )

    key = row_key("doc_id", "text")
    document = F.when(F.col("doc_id").isNull(), key).otherwise(row_key("doc_id"))
    offered = docs.select(key.alias("key"), document.alias("document"), F.explode(keyed_lines("text")).alias("line"))
    lines = written(offered.select("key", "document", "line.*"), "lines")
    # As tables of their own their sizes are known, and a very common line's rows can be split in the joins.
    in_rows = lines.groupBy("line").agg(F.count("*").alias("n")).where(F.col("n") >= min_docs).select("line")
    held = written(lines.join(written(in_rows, "lines-of-many-rows"), "line"), "held-lines")
    in_documents = held.groupBy("line").agg(F.count_distinct("document").alias("n"))
    frequent = written(in_documents.where(F.col("n") >= min_docs).select("line"), "frequent-lines")
    # Equal rows offer the same lines at the same places: a set per key serves them all.
    marks = held.join(frequent, "line").groupBy("key").agg(F.flatten(F.collect_set("places")).alias("places"))
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("n_lines", "n_dropped")]
    rows = docs.select(F.struct(*others).alias("row"), key.alias("key"))
    joined = rows.join(marks, "key", "left").select("row", without("row.text", "places").alias("new"))
    return joined.select(
        *[
            F.col("new.text").alias("text") if c == "text" else F.col(f"row.`{c}`").alias(c)
            for c in docs.columns
            if c not in ("n_lines", "n_dropped")
        ],
        "new.n_lines",
        "new.n_dropped",
    )


#: The digest columns in SQL.
ORACLE = r"""
WITH lines AS (
  SELECT doc_id, pos, parts[pos] AS line,
         translate(trim(parts[pos], chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM (SELECT doc_id, parts, unnest(range(1, len(parts) + 1)) AS pos
        FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents))
), frequent AS (
  SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
), marked AS (
  SELECT l.*, f.key IS NOT NULL AS dropped FROM lines l LEFT JOIN frequent f ON l.key = f.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""
