"""Benchmark decontamination with a generalised suffix automaton of the test items.

Texts become words of letters, digits and non-ASCII points, A-Z lower-cased. The automaton of all
items' words is streamed over each document; the state and the length of the longest match tell at
every word which item windows end there. A window is 13 consecutive words of an item, or a shorter
item as a whole. Words inside any window's occurrence are hit.

The automaton is broadcast. Its size is bounded: items are taken in blocks of at most ``BLOCK_WORDS``
words (a longer item is a block of its own), each block's automaton passes over all documents, and what
the blocks found is joined row by row. Null texts have no words; a null item_id counts as the empty id;
repeated items count once. Input columns named like the added ones are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F

from ordermill.llm.common import Shared, bounded_batches, written

SPAN = 13
#: A document is contaminated if at least one word in this many is hit.
ONE_IN = 20
BLOCK_WORDS = 100_000

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_TO_WORDS = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TO_WORDS).split()


class Automaton:
    """Suffix automaton over the words of several items, with the windows that end in each state."""

    def __init__(self, items: list[tuple[str, list[bytes]]], span: int = SPAN):
        self.span = span
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        numbered = []
        for name, words in items:
            if words:
                ids = [self.vocabulary.setdefault(w, len(self.vocabulary)) for w in words]
                numbered.append((name, ids))
                last = 0
                for w in ids:
                    last = self._extend(last, w)
        self.least = min((min(len(ids), span) for _, ids in numbered), default=0)
        self._mark(numbered)

    def _new(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(edges)
        return len(self.length) - 1

    def _split(self, state: int, word: int, target: int) -> int:
        """A copy of ``target`` that holds just the strings ending here, one word longer than ``state``'s."""
        copy = self._new(self.length[state] + 1, self.link[target], dict(self.next[target]))
        self.link[target] = copy
        while state >= 0 and self.next[state].get(word) == target:
            self.next[state][word] = copy
            state = self.link[state]
        return copy

    def _extend(self, last: int, word: int) -> int:
        target = self.next[last].get(word)
        if target is not None:  # an earlier item has this prefix
            return target if self.length[target] == self.length[last] + 1 else self._split(last, word, target)
        made = self._new(self.length[last] + 1, 0, {})
        state = last
        while state >= 0 and word not in self.next[state]:
            self.next[state][word] = made
            state = self.link[state]
        if state >= 0:
            target = self.next[state][word]
            fits = self.length[target] == self.length[state] + 1
            self.link[made] = target if fits else self._split(state, word, target)
        return made

    def _mark(self, numbered: list[tuple[str, list[int]]]) -> None:
        """Full windows by the state that holds them; short items by (length, name)."""
        self.full: dict[int, set[str]] = {}
        self.short: dict[int, set[tuple[int, str]]] = {}
        for name, ids in numbered:
            n = min(len(ids), self.span)
            for end, state in self._walk(ids):
                if end >= n:
                    holder = self._holder(state, n)
                    if len(ids) >= self.span:
                        self.full.setdefault(holder, set()).add(name)
                    else:
                        self.short.setdefault(holder, set()).add((n, name))

    def _walk(self, ids: list[int]) -> Iterator[tuple[int, int]]:
        state = 0
        for end, w in enumerate(ids, 1):
            state = self.next[state][w]
            yield end, state

    def _holder(self, state: int, n: int) -> int:
        """The state of the last n words of what ``state`` matched."""
        while self.length[self.link[state]] >= n:
            state = self.link[state]
        return state

    def find(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit spans [from, to) in word positions, joined where they touch or overlap, and the items that occur."""
        spans: list[tuple[int, int]] = []
        found: set[str] = set()
        if not self.least:
            return spans, found
        known = bytes(map(self.vocabulary.__contains__, words))
        run, at = b"\x01" * self.least, known.find(b"\x01" * self.least)
        while at >= 0:
            stop = known.find(b"\x00", at)
            stop = len(words) if stop < 0 else stop
            self._stream(words, at, stop, spans, found)
            at = known.find(run, stop)
        return spans, found

    def _stream(self, words, at, stop, spans, found) -> None:
        state = matched = 0
        for i in range(at, stop):
            w = self.vocabulary[words[i]]
            while w not in self.next[state] and state:
                state = self.link[state]
                matched = self.length[state]
            if w in self.next[state]:
                state = self.next[state][w]
                matched += 1
            widest = 0
            if matched >= self.span:
                names = self.full.get(self._holder(state, self.span))
                if names:
                    found |= names
                    widest = self.span
            if self.short:
                up = state
                while up > 0:
                    for n, name in self.short.get(up, ()):
                        if n <= matched:
                            found.add(name)
                            widest = max(widest, n)
                    up = self.link[up]
            if widest:
                low = i + 1 - widest
                while spans and spans[-1][1] >= low:
                    low = min(low, spans.pop()[0])
                spans.append((low, i + 1))


def blocks_of(rows: Iterator[Row], most: int) -> Iterator[list[tuple[str, list[bytes]]]]:
    block, size = [], 0
    for row in rows:
        words = words_of((row["text"] or "").encode())
        if block and size + len(words) > most:
            yield block
            block, size = [], 0
        block.append(("" if row["item_id"] is None else row["item_id"], words))
        size += len(words)
    yield block


def find_items(
    docs: DataFrame, benchmark: DataFrame, span: int = SPAN, block_words: int = BLOCK_WORDS
) -> DataFrame:
    """``docs`` with ``found``: n_words, hit spans in word positions (joined), and the ids of items that occur."""
    spark = docs.sparkSession
    bounded_batches(spark)
    names = [F.col(f"`{c}`") for c in docs.columns if c != "found"]
    kind = "struct<n_words:long,spans:array<struct<a:long,b:long>>,items:array<string>>"
    out = docs.select(*names, F.lit(None).cast(kind).alias("found"))
    found_type = out.schema["found"].dataType
    arrow_type = pa.struct([
        ("n_words", pa.int64()),
        ("spans", pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))),
        ("items", pa.list_(pa.string())),
    ])
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text")

    def scan(automaton):
        @F.arrow_udf(found_type)
        def scanned(text: pa.Array, before: pa.Array) -> pa.Array:
            rows = []
            for t, old in zip(text.cast(pa.large_binary()).to_pylist(), before.to_pylist()):
                words = words_of(t or b"")
                spans, names = automaton.value.find(words)
                if old:
                    names |= set(old["items"])
                    spans = joined([*spans, *((s["a"], s["b"]) for s in old["spans"])])
                rows.append({"n_words": len(words), "spans": [{"a": a, "b": b} for a, b in spans], "items": sorted(names)})
            return pa.array(rows, arrow_type)

        return scanned

    for k, block in enumerate(blocks_of(items.toLocalIterator(), block_words)):
        out = written(out, "scanned") if k else out
        scanned = scan(Shared(spark, Automaton(block, span)))
        out = out.withColumn("found", scanned("text", "found"))
    return out


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` with ``found``, ``n_words``, ``n_hit``, ``n_items`` and ``contaminated``."""
    added = ("found", "n_words", "n_hit", "n_items", "contaminated")
    found = find_items(docs.select([F.col(f"`{c}`") for c in docs.columns if c not in added]), benchmark)
    hit = F.aggregate("found.spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"])
    return (
        found.withColumn("n_words", F.col("found.n_words"))
        .withColumn("n_hit", hit)
        .withColumn("n_items", F.size("found.items").cast("long"))
        .withColumn("contaminated", (F.col("n_hit") > 0) & (ONE_IN * F.col("n_hit") >= F.col("n_words")))
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without contaminated documents; in the others, hit spans are cut out of ``text``."""

    @F.arrow_udf("string")
    def cut(text: pa.Array, spans: pa.Array) -> pa.Array:
        rows = []
        for t, hits in zip(text.cast(pa.large_binary()).to_pylist(), spans.to_pylist()):
            if hits:
                at = [m.span() for m in _WORD.finditer(t.lower())]
                for s in reversed(hits):
                    t = t[: at[s["a"]][0]] + t[at[s["b"] - 1][1] :]
            rows.append(t)
        return pa.array(rows, pa.large_binary()).cast(pa.large_string()).cast(pa.string())

    found = written(contamination(docs, benchmark).where("not contaminated"), "clean")
    return found.select([
        cut("text", "found.spans").alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns
    ])


#: The digest columns in SQL.
ORACLE = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(w), 13) AS n,
         array_to_string(w[p:p + least(len(w), 13) - 1], ' ') AS gram
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS p FROM iw WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT doc_id, n, p, array_to_string(w[p:p + n - 1], ' ') AS gram
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM dw, sizes WHERE len(w) >= n)
), hits AS (SELECT doc_id, p, g.n, item_id FROM grams g JOIN windows i ON g.n = i.n AND g.gram = i.gram),
words AS (SELECT doc_id, count(DISTINCT q) AS n_hit
          FROM (SELECT doc_id, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT doc_id, p, n FROM hits)) GROUP BY doc_id),
found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
          FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT dw.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
"""
