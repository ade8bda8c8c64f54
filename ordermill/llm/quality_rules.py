"""Quality rules whose limits follow the data: quantile sketches per language and source in place of fixed cutoffs.

Each document is measured once, with built-in functions only, and the measures are written. Of the documents that
pass the base rules, every measure is counted in log-linear buckets (64 exact values, then 32 buckets to each
doubling, so an edge is at most 1/32 off). Such a sketch is a bag of counts: tasks count before the shuffle, the
sketch of a language is the sum of those of its sources, the corpus' that of all languages, and the result does
not depend on how rows were dealt. (Spark's KLL aggregates flip coins when they merge; a rerun after a lost executor
could move a limit.) A group of at least ``SUPPORT`` documents has limits of its own, a smaller one those of its
language, a small language those of the corpus.

A limit lies ``REACH`` spreads outside the quartiles; the spread is the distance between the quartiles, at least the
measure's resolution, so documents alike are all kept and no fixed share is lost. Documents join their group's limits.

A row is a document; repeated rows count and get equal results. Null and empty texts have no words and fail the base
rules. Null languages and sources are groups of their own. An empty table gives an empty result. Only the id, the text
and the grouping columns are read, so further columns cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ordermill.llm.common import BLANKS, written

MIN_WORDS = 50
MAX_REPEAT = 50
SUPPORT = 100
REACH = 3
#: Limits are dealt out this many times, so that the rows of one frequent group meet them in many tasks.
SALTS = 16

_WORD = r"[^\x20\x09-\x0D]"
_SYMBOL = "[#*$%&|<>]"


@dataclass(frozen=True)
class Measure:
    """A ratio in whole units, its least spread, and whether low values are suspect too."""

    name: str
    value: str
    resolution: int
    both_sides: bool = False


MEASURES = (
    Measure("word_length", "1000 * word_chars div n_words", 250, both_sides=True),
    Measure("symbols", "10000 * n_symbols div n_words", 100),
    Measure("dup_lines", "1000 * n_dup_lines div n_lines", 150),
    Measure("repeat_words", "1000 * n_repeat_words div n_words", 100),
)


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once a row."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    """The maximal runs without blanks."""
    return F.filter(F.split(F.translate(text, BLANKS, " " * len(BLANKS)), " "), lambda w: w != "")


def _repeat_words(words: Column) -> Column:
    """Words inside three-word windows that occur twice or more: equal hashes stand together once sorted, and
    each repeated window covers three words or those up to the next repeated one."""

    def hashes(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - 3)
        return F.transform(starts, lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))

    def repeated(s: Column) -> Column:
        alike = lambda x, at: F.coalesce(x["h"] == F.get(s, at)["h"], F.lit(False))
        return F.array_sort(F.transform(F.filter(s, lambda x, at: alike(x, at - 1) | alike(x, at + 1)), lambda x: x["i"]))

    def covered(p: Column) -> Column:
        return F.aggregate(
            F.transform(p, lambda i, at: F.least(F.lit(3), F.coalesce(F.get(p, at + 1) - i, F.lit(3))).cast("long")),
            F.lit(0).cast("long"),
            lambda total, n: total + n,
        )

    found = _let(F.array_sort(_let(words, hashes)), repeated)
    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(_let(found, covered))


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", by: tuple[str, ...] = ("lang", "source")) -> DataFrame:
    """The id, the grouping columns as ``g0``, ``g1`` and the counts of every document; no text."""
    body = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    groups = [F.col(f"`{c}`").alias(f"g{n}") for n, c in enumerate(by)]
    rows = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), *groups, body.alias("text"), words_of(body).alias("words"))
    lines = F.filter(F.split("text", "\n"), lambda line: line.rlike(_WORD))
    rows = rows.select("*", lines.alias("lines")).select(
        "doc_id",
        *[f"g{n}" for n in range(len(by))],
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(_SYMBOL)).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        _repeat_words(F.col("words")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def _bucket(value: Column) -> Column:
    shift = F.length(F.bin(value)) - 6
    return F.when(value < 64, value).otherwise(32 * shift + F.call_function("shiftright", value, shift))


def _edges(bucket: Column) -> tuple[Column, Column]:
    """The least and the greatest value of a bucket."""
    shift = F.when(bucket < 64, 0).otherwise(F.floor(bucket / 32) - 1).cast("int")
    low = F.call_function("shiftleft", bucket - 32 * shift, shift)
    return low, low + F.call_function("shiftleft", F.lit(1).cast("long"), shift) - 1


def sketches(measured: DataFrame, groups: int = 2) -> DataFrame:
    """(level, g0, g1, ..., measure, bucket, n): bucket counts of every group and, merged, of every wider one."""
    names = [f"g{n}" for n in range(groups)]
    cells = F.array(*[F.struct(F.lit(n).alias("measure"), _bucket(F.expr(m.value)).alias("bucket")) for n, m in enumerate(MEASURES)])
    passed = measured.where(~F.col("base_failed")).select(*names, F.explode(cells).alias("cell"))
    finest = passed.groupBy(*names, "cell.measure", "cell.bucket").agg(F.count("*").alias("n"))
    finest = written(finest.select(F.lit(groups).alias("level"), *names, "measure", "bucket", "n"), "rule-sketches")
    out = finest
    for level in range(groups - 1, -1, -1):
        merged = finest.groupBy(*names[:level], "measure", "bucket").agg(F.sum("n").alias("n"))
        absent = [F.lit(None).cast(finest.schema[c].dataType).alias(c) for c in names[level:]]
        out = out.unionByName(merged.select(F.lit(level).alias("level"), *names[:level], *absent, "measure", "bucket", "n"))
    return out


def limits(sketch: DataFrame, groups: int = 2) -> DataFrame:
    """(level, g0, g1, ..., n, lows, highs): the limits of every sketch, by measure. A group holds at most some 2000 buckets."""
    names = [f"g{n}" for n in range(groups)]
    one = Window.partitionBy("level", *names, "measure")
    counted = sketch.withColumn("below", F.sum("n").over(one.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)))
    counted = counted.withColumn("total", F.sum("n").over(one))
    quartile = lambda share: F.min(F.when(4 * F.col("below") >= share * F.col("total"), F.col("bucket")))
    rows = counted.groupBy("level", *names, "measure").agg(F.max("total").alias("n"), quartile(1).alias("q1"), quartile(3).alias("q3"))
    q1, q3 = _edges(F.col("q1"))[0], _edges(F.col("q3"))[1]
    resolution = F.array(*[F.lit(m.resolution) for m in MEASURES])[F.col("measure")]
    both = F.array(*[F.lit(m.both_sides) for m in MEASURES])[F.col("measure")]
    rows = rows.select("level", *names, "measure", "n", q1.alias("q1"), q3.alias("q3"), F.greatest(q3 - q1, resolution).alias("spread"), both.alias("both"))
    low = F.when(F.col("both"), F.col("q1") - REACH * F.col("spread"))
    sides = F.array_sort(F.collect_list(F.struct("measure", low.alias("low"), (F.col("q3") + REACH * F.col("spread")).alias("high"))))
    packed = rows.groupBy("level", *names).agg(F.max("n").alias("n"), sides.alias("sides"))
    return packed.select("level", *names, "n", F.col("sides.low").alias("lows"), F.col("sides.high").alias("highs"))


def group_limits(sketch: DataFrame, groups: int = 2, support: int = SUPPORT) -> DataFrame:
    """One row a group: its own limits, or those of the narrowest wider group with ``support`` documents."""
    names = [f"g{n}" for n in range(groups)]
    table = written(limits(sketch, groups), "rule-limits")
    rows = table.where(F.col("level") == groups).select(*names, F.struct("n", "level", "lows", "highs").alias(f"at{groups}"))
    for level in range(groups - 1, -1, -1):
        wider = table.where(F.col("level") == level).select(*names[:level], F.struct("n", "level", "lows", "highs").alias(f"at{level}"))
        if level:
            same = reduce(lambda a, b: a & b, [rows[c].eqNullSafe(wider[c]) for c in names[:level]])
            rows = rows.join(wider, same, "left").select(*[rows[c] for c in rows.columns], f"at{level}")
        else:
            rows = rows.withColumn("at0", wider.select("at0").scalar())
    best = F.coalesce(*[F.when(F.col(f"at{n}.n") >= support, F.col(f"at{n}")) for n in range(groups, 0, -1)], F.col("at0"))
    return rows.select(*names, best.alias("best")).select(*names, "best.level", "best.lows", "best.highs")


def judge(docs: DataFrame, by: tuple[str, ...] = ("lang", "source"), support: int = SUPPORT) -> DataFrame:
    """One row a document: its id, the groups, the counts, ``base_failed``, ``kept`` and the ``level`` of its limits."""
    measured = written(measure(docs, by=by), "rule-measures")
    names = [f"g{n}" for n in range(len(by))]
    salted = measured.withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)).cast("int"))
    table = group_limits(sketches(measured, len(by)), len(by), support)
    table = table.withColumn("salt", F.explode(F.array(*[F.lit(n) for n in range(SALTS)])))
    same = reduce(lambda a, b: a & b, [salted[c].eqNullSafe(table[c]) for c in names])
    joined = salted.join(table, same & (salted["salt"] == table["salt"]), "left")
    inside = [
        (F.expr(m.value) <= F.col("highs")[n]) & F.coalesce(F.expr(m.value) >= F.col("lows")[n], F.lit(True))
        for n, m in enumerate(MEASURES)
    ]
    kept = F.when(F.col("base_failed"), False).otherwise(reduce(lambda a, b: a & b, inside))
    return joined.select(
        "doc_id", *[salted[c].alias(name) for c, name in zip(names, by)], "n_words", "word_chars", "n_symbols", "n_dup_lines",
        "n_repeat_words", "base_failed", kept.alias("kept"), F.when(~F.col("base_failed"), F.col("level")).alias("level"),
    )


#: The same result in SQL; level 2 is language and source, 1 the language, 0 the corpus.
ORACLE = r"""
WITH docs AS (
  SELECT row_number() OVER () AS k, doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
  SELECT k, i, [words[i], words[i + 1], words[i + 2]] AS gram
  FROM (SELECT k, words, unnest(range(1, len(words) - 1)) AS i FROM docs WHERE len(words) >= 3)
), covered AS (
  SELECT k, count(DISTINCT place) AS n FROM (
    SELECT k, unnest([i, i + 1, i + 2]) AS place
    FROM (SELECT k, i, count(*) OVER (PARTITION BY k, gram) AS times FROM windows) WHERE times > 1
  ) GROUP BY k
), lined AS (
  SELECT k, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM docs
), counts AS (
  SELECT k, doc_id, lang, source, len(words)::BIGINT AS n_words, length(array_to_string(words, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM docs JOIN lined USING (k) LEFT JOIN covered USING (k)
), measured AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         CASE WHEN n_words > 0 THEN [1000 * word_chars // n_words, 10000 * n_symbols // n_words,
                                     1000 * n_dup_lines // n_lines, 1000 * n_repeat_words // n_words] END AS v
  FROM counts
), cells AS (
  SELECT lang, source, m, v[m] AS x FROM (SELECT lang, source, v, unnest([1, 2, 3, 4]) AS m FROM measured WHERE NOT base_failed)
), buckets AS (
  SELECT lang, source, m, CASE WHEN x < 64 THEN x ELSE 32 * (length(bin(x)) - 6) + (x >> (length(bin(x)) - 6)) END AS b FROM cells
), sketch AS (
  SELECT 2 - grouping_id(lang, source) // 2 - grouping_id(lang, source) % 2 AS level, lang, source, m, b, count(*) AS n
  FROM buckets GROUP BY GROUPING SETS ((lang, source, m, b), (lang, m, b), (m, b))
), ranked AS (
  SELECT *, sum(n) OVER (PARTITION BY level, lang, source, m ORDER BY b) AS below,
         sum(n) OVER (PARTITION BY level, lang, source, m) AS total FROM sketch
), quartiles AS (
  SELECT level, lang, source, m, max(total) AS n, min(b) FILTER (WHERE 4 * below >= total) AS b1,
         min(b) FILTER (WHERE 4 * below >= 3 * total) AS b3 FROM ranked GROUP BY level, lang, source, m
), edges AS (
  SELECT level, lang, source, m, n,
         CASE WHEN b1 < 64 THEN b1 ELSE (b1 - 32 * (b1 // 32 - 1)) << (b1 // 32 - 1)::INT END AS q1,
         CASE WHEN b3 < 64 THEN b3 ELSE ((b3 - 32 * (b3 // 32 - 1) + 1) << (b3 // 32 - 1)::INT) - 1 END AS q3,
         [250, 100, 150, 100][m] AS least FROM quartiles
), limits AS (
  SELECT level, lang, source, max(n) AS n, list(CASE WHEN m = 1 THEN q1 - 3 * greatest(q3 - q1, least) END ORDER BY m) AS lows,
         list(q3 + 3 * greatest(q3 - q1, least) ORDER BY m) AS highs FROM edges GROUP BY level, lang, source
), placed AS (
  SELECT d.*, CASE WHEN a.n >= 100 THEN a.level WHEN b.n >= 100 THEN b.level ELSE c.level END AS chosen,
         CASE WHEN a.n >= 100 THEN a.lows WHEN b.n >= 100 THEN b.lows ELSE c.lows END AS lows,
         CASE WHEN a.n >= 100 THEN a.highs WHEN b.n >= 100 THEN b.highs ELSE c.highs END AS highs
  FROM measured d
  LEFT JOIN limits a ON a.level = 2 AND a.lang IS NOT DISTINCT FROM d.lang AND a.source IS NOT DISTINCT FROM d.source
  LEFT JOIN limits b ON b.level = 1 AND b.lang IS NOT DISTINCT FROM d.lang
  LEFT JOIN limits c ON c.level = 0
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       CASE WHEN base_failed THEN false
            ELSE v[1] BETWEEN lows[1] AND highs[1] AND v[2] <= highs[2] AND v[3] <= highs[3] AND v[4] <= highs[4] END AS kept,
       CASE WHEN NOT base_failed THEN chosen::INT END AS level
FROM placed
"""
