"""Language identification by Bayesian evidence fusion.

Four kinds of evidence are added as logarithms, for every language and for "und", undetermined:

* the text: byte trigrams under a multinomial of each language, counted over all rows that declare
  it and smoothed by the mean of the corpus's distribution and the uniform one, so that languages with
  few rows stay near it (overlapping trigrams repeat each other, so a third of their log-likelihood
  counts); "und" has the uniform distribution;
* the declared language (markup or metadata), through how often texts of each language declare it;
* the address suffix, through how often texts of each language carry it;
* the host: its own language counts, smoothed by its domain's, which are smoothed by the corpus's.

The last three come from grouped sums over all rows, where a row counts for the language that its text
alone suggests. Hosts, declared values and suffixes are joined back by key; rows travel there
without their texts, and hot keys are left to the adaptive planner's skew handling.

Every declared value of the form of an ISO 639 code (two or three letters, but for those that name no
language) is a language, however few rows declare it. Other values are evidence only.

A row is accepted if its best language is not "und" and has at least half of the probability. Rows with
null text or without letters have no text evidence and are "und". Null evidence of another kind is
neutral. Repeated rows get equal results. Without any declared language all rows are "und".
Input columns named like the added ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ordermill.llm.common import Shared, bounded_batches, gram_codes, in_blocks, row_key, text_bytes, written

BUCKETS = 1 << 16
SMOOTHING = 0.5
REPEATS = 3
#: Languages looked at together in a text's trigrams, and counted together in a task.
ABREAST = 16
#: Codes of ISO 639 for undetermined, several, uncoded and no language.
NO_LANGUAGE = ("und", "mul", "mis", "zxx")
#: Pseudo-counts of the level above, for hosts, domains, declared values and suffixes.
STRENGTH = 10.0
UNDETERMINED = 1e-4
MIN_PROBABILITY = 0.5

_LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def trigram_buckets(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Buckets of all byte trigrams around a letter, and the text each is from, in ascending pieces."""
    clean = [t.translate(_LETTERS) + b" " for t in texts]
    for owners, parts in in_blocks(clean, b"  "):
        code, part = gram_codes(parts, 2)
        inner = (code >> np.uint64(8)) & np.uint64(255) != 32
        code = code[inner].astype(np.uint32)
        yield (code * np.uint32(2654435761)) >> np.uint32(16), np.array(owners)[part[inner]]


def primary(declared: Column) -> Column:
    """The primary subtag of a language tag, lower-cased; null if there is none."""
    return F.nullif(F.lower(F.regexp_extract(declared.cast("string"), r"^\s*([A-Za-z]{2,8})", 1)), F.lit(""))


def _trigram_counts(rows: DataFrame, langs: list[str]) -> DataFrame:
    """(lang, bucket, n) over all rows that declare one of ``langs``; ``lang`` is its number."""
    column = {lang: i for i, lang in enumerate(langs)}

    def table(sums):
        for lang, n in sums.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), column[lang]), pa.int32()), pa.array(at, pa.int32()), pa.array(n[at], pa.int64())],
                names=["lang", "bucket", "n"],
            )

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs, of = np.unique(batch.column(1).to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
            for buckets, owner in trigram_buckets(text_bytes(batch)):
                for k in np.unique(of[owner]):
                    if langs[k] not in sums and len(sums) == ABREAST:
                        yield from table(sums)
                        sums = {}
                    add = np.bincount(buckets[of[owner] == k], minlength=BUCKETS)
                    sums[langs[k]] = sums.get(langs[k], 0) + add
        yield from table(sums)

    counted = rows.where("is_language").select("text", "declared")
    counted = counted.mapInArrow(count, "lang int, bucket int, n long")
    return counted.groupBy("lang", "bucket").agg(F.sum("n").alias("n"))


def _model(rows: DataFrame) -> tuple[list[str], np.ndarray]:
    """Languages and log-probabilities, buckets by languages with "und" last."""
    rows = rows.withColumn("is_language", F.length("declared").between(2, 3) & ~F.col("declared").isin(*NO_LANGUAGE))
    langs = sorted(r["declared"] for r in rows.where("is_language").select("declared").distinct().collect())
    table = np.full((BUCKETS, len(langs) + 1), -np.log(BUCKETS), dtype=np.float32)
    if langs:
        counts = _trigram_counts(rows, langs).toArrow()
        of, buckets, n = (counts[c].to_numpy() for c in ("lang", "bucket", "n"))
        # Half of the pseudo-counts are spread like the corpus's trigrams, half evenly.
        corpus = np.bincount(buckets, n, BUCKETS)
        pseudo = SMOOTHING / 2 * (1 + BUCKETS * (corpus / corpus.sum() if len(n) else 1 / BUCKETS))
        order = np.argsort(of, kind="stable")
        ends = np.searchsorted(of[order], np.arange(len(langs) + 1))
        for i in range(len(langs)):
            at = order[ends[i] : ends[i + 1]]
            own = pseudo.copy()
            own[buckets[at]] += n[at]
            table[:, i] = np.log(own / own.sum())
    return langs, table


def _text_evidence(rows: DataFrame, table: np.ndarray) -> DataFrame:
    """``text`` replaced by ``grams`` (their number) and ``likelihood`` (one log-likelihood for each language, "und" last)."""
    shared = Shared(rows.sparkSession, table)
    width = table.shape[1]

    @F.arrow_udf("struct<grams:long,likelihood:array<double>>")
    def evidence(text: pa.Array) -> pa.Array:
        texts = text_bytes(pa.RecordBatch.from_arrays([text], names=["text"]))
        sums, grams = np.zeros((len(texts), width)), np.zeros(len(texts), dtype=np.int64)
        for buckets, owner in trigram_buckets(texts):
            if len(buckets):
                first = np.flatnonzero(np.diff(owner, prepend=-1))
                for low in range(0, width, ABREAST):
                    part = shared.value[:, low : low + ABREAST][buckets]
                    sums[owner[first], low : low + ABREAST] += np.add.reduceat(part, first, axis=0, dtype=np.float64)
                grams[owner[first]] += np.diff(first, append=len(owner))
        flat = pa.ListArray.from_arrays(
            pa.array(np.arange(0, (len(texts) + 1) * width, width), pa.int32()), pa.array(sums.ravel() / REPEATS)
        )
        return pa.StructArray.from_arrays([pa.array(grams), flat], names=["grams", "likelihood"])

    return rows.withColumn("e", evidence("text")).select(
        *[c for c in rows.columns if c != "text"], "e.grams", "e.likelihood"
    )


def _log_shares(counts: DataFrame, key: str, above: Column, name: str) -> DataFrame:
    """log((count + STRENGTH * share above) / (total + STRENGTH)) for each language of each key, and "und"."""
    total = F.aggregate(F.map_values("counts"), F.lit(0).cast("long"), lambda s, n: s + n)
    rows = counts.select("*", total.alias("total"))
    shares = F.transform(
        above, lambda share, i: F.log((F.coalesce(F.col("counts")[i], F.lit(0)) + STRENGTH * share) / (F.col("total") + STRENGTH))
    )
    return rows.select(key, F.concat(shares, F.array(F.lit(float(np.log(UNDETERMINED))))).alias(name))


def identify(
    docs: DataFrame,
    text: Column,
    declared: Column,
    host: Column,
    domain: Column | None = None,
    suffix: Column | None = None,
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """(key, carried, language, probability, accepted) for every row of ``docs``.

    ``key`` is ``row_key`` of all its columns, ``carried`` a struct of those named in ``carry``.
    """
    bounded_batches(docs.sparkSession)
    nothing = F.lit(None).cast("string")
    rows = docs.select(
        row_key(*[f"`{c}`" for c in docs.columns]).alias("key"),
        F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns[:1]]).alias("carried"),
        text.alias("text"),
        primary(declared).alias("declared"),
        host.cast("string").alias("host"),
        (nothing if domain is None else domain.cast("string")).alias("domain"),
        (nothing if suffix is None else suffix.cast("string")).alias("suffix"),
    )
    langs, table = _model(rows)
    scored = _text_evidence(rows, table)
    if not langs:
        return scored.select("key", "carried", F.lit("und").alias("language"), F.lit(1.0).alias("probability"), F.lit(False).alias("accepted"))
    best = F.array_position("likelihood", F.array_max("likelihood")).cast("int") - 1
    scored = written(scored.withColumn("suggested", F.when(F.col("grams") > 0, best)), "text-evidence")

    known = scored.where(F.col("suggested") < len(langs))
    corpus = {r["suggested"]: r["count"] for r in known.groupBy("suggested").count().collect()}
    base = [(corpus.get(i, 0) + 1) / (sum(corpus.values()) + len(langs)) for i in range(len(langs))]
    flat = F.array(*map(F.lit, base))

    def per(key: str, *others: Column) -> DataFrame:
        counts = known.where(F.col(key).isNotNull()).groupBy(key, "suggested").agg(F.count("*").alias("n"), *others)
        entries = F.collect_list(F.struct("suggested", "n"))
        return counts.groupBy(key).agg(F.map_from_entries(entries).alias("counts"), *others)

    domains = _log_shares(per("domain"), "domain", flat, "domain_prior")
    hosts = per("host", F.min("domain").alias("domain")).join(domains, "domain", "left")
    above = F.coalesce(F.transform(F.slice("domain_prior", 1, len(langs)), F.exp), flat)
    hosts = _log_shares(hosts, "host", above, "prior")
    out = scored.join(hosts, "host", "left")
    logs = F.array(*[F.lit(float(np.log(x))) for x in base])
    corpus_prior = F.concat(logs, F.array(F.lit(float(np.log(UNDETERMINED)))))
    total = F.zip_with("likelihood", F.coalesce("prior", corpus_prior), lambda a, b: a + b)
    for key in ("declared", "suffix"):
        # How often a text of language i shows this value, against how often any text does.
        ratio = _log_shares(per(key), key, flat, "share").select(
            key,
            F.concat(
                F.transform(F.slice("share", 1, len(langs)), lambda s, i: s - F.get(logs, i)),
                F.array(F.lit(0.0)),
            ).alias(f"{key}_evidence"),
        )
        out = out.join(ratio, key, "left")
        neutral = F.array_repeat(F.lit(0.0), len(langs) + 1)
        total = F.zip_with(total, F.coalesce(f"{key}_evidence", neutral), lambda a, b: a + b)
    out = out.select("key", "carried", "grams", total.alias("total"))
    top = F.array_max("total")
    position = F.array_position("total", top).cast("int")
    share = 1 / F.aggregate("total", F.lit(0.0), lambda s, x: s + F.exp(x - top))
    out = out.select(
        "key",
        "carried",
        F.when(F.col("grams") > 0, F.element_at(F.array(*map(F.lit, [*langs, "und"])), position)).otherwise("und").alias("language"),
        F.when(F.col("grams") > 0, share).otherwise(F.lit(1.0)).alias("probability"),
    )
    accepted = (F.col("language") != "und") & (F.col("probability") >= MIN_PROBABILITY)
    return out.withColumn("accepted", accepted)


def identify_documents(docs: DataFrame) -> DataFrame:
    """For a table like ``documents``: ``lang`` is the declared language, ``source`` the host."""
    return identify(docs, F.col("text"), F.col("lang"), F.col("source"), carry=("doc_id",))


def page_columns(pages: DataFrame) -> dict[str, Column]:
    """Evidence of a table like ``pages``: visible text, markup language, host, domain and suffix."""
    plain = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    host = F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1))
    host = F.nullif(host, F.lit(""))
    labels = F.split(host, r"\.")
    return {
        "text": plain,
        "declared": F.regexp_extract("html", r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z-]+)", 1),
        "host": host,
        "domain": F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), "."),
        "suffix": F.element_at(labels, -1),
    }


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` without the rows that are rejected."""
    rejected = written(identify_documents(docs).where("not accepted").select("key").distinct(), "rejected")
    # Read from a table, the rejected keys have a known size: Spark broadcasts them only if they are few.
    names = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(F.struct(*names).alias("row"), row_key(*[f"`{c}`" for c in docs.columns]).alias("key"))
    return keyed.join(rejected, "key", "left_anti").select("row.*")
