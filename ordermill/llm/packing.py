"""Packing token sequences: bounded-space online best fit.

Every task keeps a fixed number of open windows. A document's ids are cut into full windows and a
rest; the rest goes into the open window that it fills best, and when none fits, the fullest window
is emitted and an empty one takes its place. If that would waste more than ``WASTE`` ids, the rest's
head fills the window up first. What is open at a task's end is merged afterwards: leftover
windows are dealt to tasks by number, each with a bounded share, and packed again, largest first.

Null and empty texts give the end id alone. Repeated rows are packed each for itself; a null doc_id is
carried along. Other columns of any name are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from ordermill.llm.common import bounded_batches, text_bytes, written

WINDOW = 2048
OPEN = 64
WASTE = 32
END_ID = 1
TOKENIZER = "byte_bpe_50k.json"
#: Leftover windows that one task merges: at most this times the window's size in ids.
MERGE = 4096
#: Encoded words a task remembers; when full, it starts anew.
REMEMBER = 200_000

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, ids binary, closed boolean"
)

#: A single blank between two others: the tokenizer's pattern always starts a token there and looks
#: neither back nor further ahead, so chunks can be encoded apart.
_CUT = re.compile(r"(?<=\S)(?=\s\S)")
#: In texts with one of these, words are not just divided by single spaces and line ends.
_ODD = ["\0", *(a + b for a in " \n" for b in " \n"), *(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n")]


class Encoder:
    """Ids of whole texts as little-endian bytes, word by word with a bounded memory of words.

    Where all blanks are single spaces and line ends between words, a text is a sequence of words
    with a space before them, or with a line end, which is a token of its own. Full stops and commas
    at a word's end are tokens of their own after letters. Other texts are cut at single blanks.
    """

    def __init__(self, path: str | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path(TOKENIZER)
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        self.known = Known(self)
        # The letters that stand for bytes in the vocabulary: printable ones for themselves, then from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self.byte_letters = {b: b for b in plain} | {b: 256 + k for k, b in enumerate(rest)}
        self.space = chr(self.byte_letters[32])

    def _word(self, chunk: str) -> bytes:
        """Ids of letters with at most a space before them: one token of the pattern, so straight to the merges."""
        if chunk.isascii():
            letters = self.space + chunk[1:] if chunk[0] == " " else chunk
        else:
            letters = chunk.encode().decode("latin-1").translate(self.byte_letters)
        return array("I", [token.id for token in self.model.tokenize(letters)]).tobytes()

    def ids_of(self, chunk: str) -> bytes:
        stem = chunk.rstrip(".,")
        if not stem.removeprefix(" ").isalpha():
            return array("I", self.tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
        if len(stem) == len(chunk):
            return self._word(chunk)
        return self.known[stem] + self.known[chunk[len(stem) :]]

    def encode(self, texts: list[str]) -> list[bytes]:
        if len(self.known) > REMEMBER:
            self.known = Known(self)
        known, out = self.known.__getitem__, []
        for t in texts:
            if not t or t[0].isspace() or t[-1].isspace() or any(odd in t for odd in _ODD):
                chunks = _CUT.split(t)
            else:
                chunks = t.replace(" ", "\0 ").replace("\n", "\0\n\0").split("\0")
            out.append(b"".join(map(known, chunks)))
        return out


class Known(dict):
    """Ids by chunk; a chunk that is looked up for the first time is encoded."""

    def __init__(self, encoder: Encoder):
        self.encoder = encoder

    def __missing__(self, chunk: str) -> bytes:
        ids = self[chunk] = self.encoder.ids_of(chunk)
        return ids


class Windows:
    """At most ``most`` open windows of ``size`` ids. Items are (length, pieces); emitted windows are lists of items."""

    def __init__(self, size: int, most: int | None):
        self.size, self.most = size, most
        self.free: list[tuple[int, int]] = []  # (free ids, number), ascending
        self.items: dict[int, list] = {}
        self.made = 0

    def share(self, length: int, waste: int) -> int:
        """How many of the next item's ids to place at once: all, or those that fill up the window to be emitted."""
        if self.most is None or len(self.free) < self.most or self.free[-1][0] >= length:
            return length
        room = self.free[0][0]
        return room if room > waste else length

    def place(self, length: int, item) -> Iterator[list]:
        at = bisect_left(self.free, (length, -1))
        if at < len(self.free):
            room, number = self.free.pop(at)
        else:
            if self.most is not None and len(self.free) >= self.most:
                yield self.items.pop(self.free.pop(0)[1])
            room, number = self.size, self.made
            self.made += 1
            self.items[number] = []
        self.items[number].append(item)
        if room == length:
            yield self.items.pop(number)
        else:
            insort(self.free, (room - length, number))

    def rest(self) -> Iterator[list]:
        while self.free:
            yield self.items.pop(self.free.pop(0)[1])


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _schema() -> pa.Schema:
    kinds = {"long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[t]) for n, t in (x.split() for x in PIECES.split(", "))])


def _laid(windows: Iterator[list], base: int, start: int, closed: bool) -> tuple[list[tuple], int]:
    """Rows of windows, numbered on from ``start``, their pieces at gapless offsets."""
    rows = []
    for window in windows:
        offset = 0
        for doc_id, first, length, crc, total, ids in window:
            rows.append((doc_id, first, length, crc, total, base + start, offset, ids, closed))
            offset += length
        start += 1
    return rows, start


def pack(
    docs: DataFrame,
    window: int = WINDOW,
    open_windows: int = OPEN,
    waste: int = WASTE,
    tokenizer_path: str | None = None,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``PIECES`` without ``closed``. ``ids`` (little-endian unsigned 32 bits) is null unless asked for."""
    spark = docs.sparkSession
    bounded_batches(spark)
    end = np.array([end_id], dtype="<u4").tobytes()
    schema = _schema()

    def online(batches):
        encoder, state, number = Encoder(tokenizer_path), Windows(window, open_windows), 0
        base = TaskContext.get().partitionId() << 36
        for batch in batches:
            ids_of = batch.column(0).to_pylist()
            texts = [t.decode("utf-8", "replace") for t in text_bytes(batch)]
            rows = []
            for low in range(0, len(texts), 128):
                for doc_id, ids in zip(ids_of[low : low + 128], encoder.encode(texts[low : low + 128])):
                    ids += end
                    total = len(ids) // 4
                    first = 0
                    while first < total:
                        length = state.share(min(window, total - first), waste)
                        part = ids[4 * first : 4 * (first + length)]
                        piece = (doc_id, first, length, zlib.crc32(part), total, part if with_ids else None)
                        more, number = _laid(state.place(length, piece), base, number, True)
                        rows += more
                        first += length
            yield _table(rows, schema)
        yield _table(_laid(state.rest(), base, number, False)[0], schema)

    def merged(batches):
        held: dict[int, list] = {}
        for batch in batches:
            for row in batch.to_pylist():
                held.setdefault(row["sequence_id"], []).append(row)
        state, number = Windows(window, None), 0
        base = (1 << 62) + (TaskContext.get().partitionId() << 36)
        rows: list[tuple] = []
        sized = [(sum(r["length"] for r in part), part) for _, part in sorted(held.items())]
        done = []
        for length, part in sorted(sized, key=lambda x: -x[0]):
            part.sort(key=lambda r: r["offset"])
            done += state.place(length, part)
        for window_items in [*done, *state.rest()]:
            flat = [
                (r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"], r["ids"])
                for part in window_items
                for r in part
            ]
            more, number = _laid(iter([flat]), base, number, True)
            rows += more
        yield _table(rows, schema)

    placed = written(docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(online, PIECES), "pieces")
    leftover = placed.where("not closed")
    windows = leftover.agg(F.count_distinct("sequence_id")).first()[0]
    tasks = -(-windows // MERGE) or 1
    again = leftover.repartition(tasks, "sequence_id").mapInArrow(merged, PIECES)
    return placed.where("closed").union(again).drop("closed")
