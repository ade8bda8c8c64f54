"""Every operator against a brute-force model on a small table of difficult rows, and on an empty one."""

import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from ordermill.llm import (
    ann, decontamination, labelled, language_id, line_dedup, lm_scoring, packing, quality, simhash, toxicity, warc,
)
from ordermill.llm.common import in_blocks

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    # Names that operators use inside.
    "key string, row string, line string, found string, fp long, component_id long, n_lines long, `odd name` int"
)
SENTENCE = "The quick brown fox jumps over the lazy dog while seven wizards quietly mix potions near the old river bank"


def _rows():
    texts = [None, "", "  \n \t\r\n", "One line.", "ONE LINE.", " one line. \nother\n\nother", SENTENCE, SENTENCE + " today"]
    texts += [SENTENCE.upper() + "\n" + f"unique {i} words {i * i}\nshared footer" for i in range(12)]
    texts += ["a " * 70_000, "x" * 300_000, "naïve – „quote“, 日本 語.\nSpäter kommt, was 12,5 kostet.", "word\x0bword\x0cword", "a\0b\n"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, "One line."), (3, "another text with this id"), (None, "no id"), (None, None)]
    return [(i, t, "en", "src1", len(t or ""), "k", "r", "l", "f", 1, 2, 3, 4) for i, t in rows]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(i, int(i % 3 > 0), int(i % 4 == 0)) for i in range(20)] + [(1, None, None), (2, 0, 1), (2, 1, 0), (None, 1, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def _bucket(i, modulus):
    return zlib.crc32(("" if i is None else str(i)).encode()) % modulus


def test_packing_round_trip(docs, nothing):
    from tokenizers import Tokenizer
    import public_tokenizers

    tokenizer = Tokenizer.from_file(public_tokenizers.path(packing.TOKENIZER))
    expected = Counter()
    for i, t, *_ in _rows():
        expected[i, tuple(tokenizer.encode(t or "", add_special_tokens=False).ids + [1])] += 1
    pieces = packing.pack(docs, open_windows=2).collect()
    windows, parts = defaultdict(list), defaultdict(list)
    for p in pieces:
        ids = np.frombuffer(p["ids"], dtype="<u4")
        assert len(ids) == p["length"] and zlib.crc32(p["ids"]) == p["ids_crc32"]
        windows[p["sequence_id"]].append((p["offset"], p["length"]))
        parts[p["doc_id"], p["doc_tokens"]].append((p["start"], tuple(ids.tolist())))
    for places in windows.values():
        end = 0
        for offset, length in sorted(places):
            assert offset == end
            end += length
        assert end <= packing.WINDOW
    for (doc, total), found in parts.items():
        same = sum(n for (i, ids), n in expected.items() if i == doc and len(ids) == total)
        assert same and sum(len(ids) for _, ids in found) == same * total
        if same == 1:
            joined = sum((ids for _, ids in sorted(found)), ())
            assert expected[doc, joined] == 1
    ids = sum(p["length"] for p in pieces)
    assert len(windows) <= ids / packing.WINDOW * 1.05 + 2
    assert packing.pack(nothing).count() == 0


def test_encoder_equals_whole_texts():
    encoder = packing.Encoder(None)
    texts = [
        "a  b", "\n\nx. y", "x  y", "<|endoftext|> a<|endoftext|>", "don't, stop'.. ok", "", "  ", "a.\n b", "x,. y..",
        "\x1fa \x1f b", "12, 3. a1,", "é, É. ²,", "a\0b c", "a​, b", "日本, 語.", SENTENCE * 50,
    ]
    for text, ids in zip(texts, encoder.encode(texts)):
        whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, dtype="<u4").tolist() == whole, text


def test_line_dedup(docs, nothing):
    rows = _rows()
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate({c: c + 32 for c in range(65, 91)})
    documents = {(i, t if i is None else "", key(line)) for i, t, *_ in rows for line in (t or "").split("\n")}
    holders = Counter(k for *_, k in documents if k)
    expected = Counter()
    for i, t, *_ in rows:
        lines = (t or "").split("\n")
        kept = [line for line in lines if not (key(line) and holders[key(line)] >= 10)]
        expected[i, len(lines), len(lines) - len(kept), "\n".join(kept)] += 1
    result = line_dedup.dedup_lines(docs)
    assert result.columns == [c for c in docs.columns if c != "n_lines"] + ["n_lines", "n_dropped"]
    assert Counter((r["doc_id"], r["n_lines"], r["n_dropped"], r["text"]) for r in result.collect()) == expected
    assert any(dropped for _, _, dropped, _ in expected)
    assert line_dedup.dedup_lines(nothing).count() == 0


def test_line_dedup_counts_documents_not_rows(spark):
    rows = [(7, "only here\ncommon\nlast")] * 12 + [(i, f"own {i}\n Common") for i in range(10, 19)]
    rows += [(8, f"mine\nother {i}") for i in range(12)] + [(None, "of nobody")] * 12
    rows += [(i, "Nine\n\nnine") for i in range(20, 29)] + [(20, "nine too")] * 5
    rows += [(None, f"ten\n{i}") for i in range(10)]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    result = Counter((r["doc_id"], r["text"], r["n_dropped"]) for r in line_dedup.dedup_lines(table).collect())
    expected = Counter((i, t, 0) for i, t in rows if i in (8, *range(20, 29)))
    expected += Counter({(7, "only here\nlast", 1): 12, (None, "of nobody", 0): 12})
    expected += Counter((i, f"own {i}", 1) for i in range(10, 19)) + Counter((None, f"{i}", 1) for i in range(10))
    assert result == expected


def _brute_print(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 4]) for i in range(max(len(words) - 3, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, seed=42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_simhash(docs, nothing):
    rows = [(i, t) for i, t, *_ in _rows() if len(t or "") < 1000]
    prints = {(i, t): _brute_print(t) for i, t in rows}
    group = {v: v for v in prints.values()}
    for a in group:
        for b in group:
            if bin(a ^ b).count("1") <= 4:
                old, new = group[a], group[b]
                group = {k: new if v == old else v for k, v in group.items()}
    least = {}
    for (i, _), v in prints.items():
        least[group[v]] = min((x for x in (least.get(group[v]), i) if x is not None), default=None)
    expected = Counter((i, f"{prints[i, t]:016x}", least[group[prints[i, t]]]) for i, t in rows)
    found = simhash.near_duplicates(docs.where("text is null or length(text) < 1000")).collect()
    assert Counter(map(tuple, found)) == expected
    kept = simhash.keep_representatives(docs.where("text is null or length(text) < 1000"))
    assert kept.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(map(str, least.values()))
    assert simhash.near_duplicates(nothing).count() == 0
    assert simhash.keep_representatives(nothing).count() == 0


def test_simhash_links_are_complete(spark):
    random = np.random.default_rng(3)
    base = random.integers(-(2**62), 2**62, 60)
    values = {int(b) for b in base}
    for b in base:
        for _ in range(5):
            v = int(b)
            for bit in random.choice(63, random.integers(1, 6), replace=False):
                v ^= 1 << int(bit)
            values.add(v)
    values = sorted(values)
    expected = {(a, b) for a in values for b in values if a < b and bin((a ^ b) & (2**64 - 1)).count("1") <= 4}
    frame = spark.createDataFrame([(v,) for v in values], "fp long")
    found = {(min(x, y), max(x, y)) for x, y in simhash.links(frame).collect()}
    assert found == expected and expected


def _windows(items):
    out = defaultdict(set)
    for name, text in items:
        words = decontamination.words_of((text or "").encode())
        n = min(13, len(words))
        for i in range(len(words) - n + 1 if n else 0):
            out[tuple(words[i : i + n])].add(str(name))
    return out


@pytest.mark.parametrize("block_words", [100_000, 15])
def test_decontamination(spark, docs, nothing, block_words):
    items = [(7, SENTENCE), (70, "seven WIZARDS quietly"), (8, None), (9, "..."), (10, "one"), (11, SENTENCE + " tonight"), (10, "one")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    windows = _windows(items)
    expected = Counter()
    for i, t, *_ in _rows():
        words, hit, names = decontamination.words_of((t or "").encode()), set(), set()
        for n in {len(w) for w in windows}:
            for p in range(len(words) - n + 1):
                got = windows.get(tuple(words[p : p + n]))
                if got:
                    hit |= set(range(p, p + n))
                    names |= got
        expected[i, len(words), len(hit), ",".join(sorted(names))] += 1
    found = decontamination.find_items(docs, benchmark, block_words=block_words)
    got = Counter(
        (r["doc_id"], r["found"]["n_words"], sum(s["b"] - s["a"] for s in r["found"]["spans"]), ",".join(sorted(r["found"]["items"])))
        for r in found.collect()
    )
    assert got == expected
    clean = decontamination.decontaminate(docs, benchmark)
    assert clean.columns == docs.columns
    assert all(not set(_windows([(0, r["text"])])) & set(windows) or len(r["text"]) < 13 for r in clean.collect())
    assert decontamination.contamination(nothing, benchmark).count() == 0
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontamination.contamination(docs, none).where("n_hit > 0 or n_items > 0").count() == 0


class _Ppm:
    """PPM over dictionaries of contexts, one byte after the other."""

    def __init__(self, texts):
        self.after = defaultdict(Counter)
        for text in map(self.framed, texts):
            for at in range(5, len(text)):
                for size in range(6):
                    self.after[text[at - size : at]][text[at]] += 1

    @staticmethod
    def framed(words):
        return b"     " + b" ".join([*words, b"\n"])

    def probability(self, context, symbol):
        share, ruled_out = 1.0, set()
        for size in range(5, -1, -1):
            followers = self.after.get(context[5 - size :])
            if followers is None:
                continue
            mass = sum(followers.values()) - sum(followers[b] for b in ruled_out)
            left = len(followers) - len(ruled_out)
            if symbol in followers:
                return share * (followers[symbol] - 0.5) / mass
            if left:
                share *= 0.5 * left / mass
            ruled_out = set(followers)
        return share / (257 - len(ruled_out))

    def score(self, words):
        text = self.framed(words)
        return sum(n * math.log10(self.probability(s[:5], s[5])) for s, n in Counter(text[i - 5 : i + 1] for i in range(5, len(text))).items())


@pytest.mark.parametrize("head,most", [(lm_scoring.HEAD, lm_scoring.FREQUENT), (3, 200), (0, 0)])
def test_lm_scoring(docs, nothing, head, most):
    rows = [(i, (t or "").encode().lower().split()) for i, t, *_ in _rows()]
    counts = Counter()
    for i, words in rows:
        if _bucket(i, 10):
            counts.update([*words, b""])
    total, kinds = sum(counts.values()), len(counts)
    base = lambda words: sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in [*words, b""])
    result = lm_scoring.score(docs, head=head, most=most).collect()
    expected = sorted((str(i), len(w) + 1, sum(x in counts for x in [*w, b""]), total, round(base(w), 4)) for i, w in rows)
    assert sorted((str(r[0]), r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 4)) for r in result) == expected
    assert all(r["held_out"] == (_bucket(r["doc_id"], 10) == 0) for r in result)
    model = _Ppm([w for i, w in rows if _bucket(i, 10)])
    wanted = sorted((str(i), model.score(w)) for i, w in rows)
    got = sorted((str(r["doc_id"]), r["score"]) for r in result)
    assert [i for i, _ in got] == [i for i, _ in wanted]
    assert all(math.isclose(a, b, rel_tol=1e-9) for (_, a), (_, b) in zip(got, wanted))
    assert lm_scoring.score(nothing).count() == 0


def test_lm_scoring_without_training_rows(docs):
    result = lm_scoring.score(docs.where("doc_id is null")).collect()
    assert sorted(r["train_tokens"] for r in result) == [0, 0]
    assert all(r["n_known"] == 0 for r in result)
    wanted = sorted(_Ppm([]).score(w) for w in ([b"no", b"id"], []))
    assert all(math.isclose(a, b) for a, b in zip(sorted(r["score"] for r in result), wanted))


def test_ppm_is_a_distribution(spark):
    model = _Ppm([b"the cat sat on the mat".split(), b"the dog".split()])
    texts = [(1, "the cat sat on the mat"), (2, "the dog"), (0, "the dug"), (0, "zebra")]
    ids = [next(i for i in range(k * 1000, k * 1000 + 999) if (_bucket(i, 10) > 0) == (held > 0)) for k, (held, _) in enumerate(texts, 1)]
    rows = spark.createDataFrame([(i, t) for i, (_, t) in zip(ids, texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["score"] for r in lm_scoring.score(rows, most=5).collect()}
    assert all(math.isclose(got[i], model.score(t.encode().split())) for i, (_, t) in zip(ids, texts))
    for context in (b"     ", b"he ca", b"zzzzz", b" on t", b" the "):
        assert 0.9 < sum(model.probability(context, b) for b in range(256)) <= 1 + 1e-9  # the 257th symbol takes the rest


def test_warc_of_other_writers(spark, tmp_path):
    data = zlib.compress(b"WARC/1.1\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n", wbits=31)
    data += warc.record("revisit", [("X-Page-ID", "p1"), ("WARC-Payload-Digest", "sha1:?"), ("X-Payload-Length", "9" * 30)], b"")
    data += warc.record("response", [("X-Page-ID", "7")], b"page")
    (tmp_path / "other.warc.gz").write_bytes(data)
    manifest = spark.createDataFrame([(str(tmp_path / "other.warc.gz"), len(data))], "path string, bytes long")
    rows = sorted(warc.read_archives(manifest).collect(), key=lambda r: r["at"])
    assert [(r["record_type"], r["page_id"], r["payload_bytes"]) for r in rows] == [(None, None, 2), ("revisit", None, 0), ("response", 7, 4)]
    assert [r["payload_digest"] is None for r in rows] == [False, True, False]


def test_blocks_keep_context():
    text = bytes(range(256)) * 40
    seen = b"".join(part[3:] for _, parts in in_blocks([b"", text, b"ab"], b"   ", size=1000) for part in parts)
    assert seen == text + b"ab"


@pytest.mark.parametrize("module", [quality, toxicity])
def test_classifiers(spark, docs, nothing, labels, module):
    result = module.score(docs, labels)
    assert result.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = result.collect()
    assert len(rows) == docs.count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= module.THRESHOLD) for r in rows)
    assert all(r["held_out"] == (_bucket(r["doc_id"], 5) == 0) for r in rows)
    assert module.score(docs, labels.where("false")).count() == docs.count()
    assert module.score(nothing, labels).count() == 0
    # Labels of rows that are held out change nothing.
    held = [i for i in range(20) if _bucket(i, 5) == 0]
    changed = labels.where(~F.col("doc_id").isin(held)).union(spark.createDataFrame([(i, 0, 1) for i in held], labels.schema))
    again = {(r["doc_id"], r["score"]) for r in module.score(docs, changed).collect()}
    assert again == {(r["doc_id"], r["score"]) for r in rows}


def test_labelled_rows_are_bounded(spark):
    ids = [i for i in range(100) if _bucket(i, labelled.FOLDS)]
    rows = [(i, f"text {i}") for i in ids] + [(ids[0], f"other text {n}") for n in range(500)] + [(ids[1], None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, quality int")
    found = labelled.sample(docs, labels, "quality", len(ids)).collect()
    assert len(found) == len(ids) and Counter(r["label"] for r in found) == Counter(i % 2 for i in ids)
    assert {r["text"] for r in found} >= {f"text {i}" for i in ids[2:]}
    again = labelled.sample(docs.repartition(3, "text"), labels, "quality", len(ids)).collect()
    assert Counter(again) == Counter(found)


def test_toxicity_grammar():
    match = toxicity.Matcher(dict(toxicity._SEEDS), {b"gru": (toxicity.INSULT, 2.0), b"grum": (toxicity.INSULT, 2.0)})

    def patterns(text):
        values = match.features(text.encode())
        return {toxicity.PATTERNS[k] for k in np.flatnonzero(values)}

    insult, threat = toxicity.INSULT, toxicity.THREAT
    assert patterns("You are an idiot.") == {(insult, False, False, True)}
    assert patterns("An idiot like you.") == {(insult, False, False, True)}
    assert patterns("You are not an idiot.") == {(insult, True, False, True)}
    assert patterns("Nothing here. All is well.") == set()
    assert patterns('The word "moron" was old.') == {(insult, False, True, False)}
    assert patterns("He said they will destroy cities.") == {(threat, False, True, True)}
    assert patterns("grumblers") == {(insult, False, False, False)}


def test_classifier_accuracy(spark):
    folder = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    for module, column, least in ((quality, "quality", 0.85), (toxicity, "toxic", 0.95)):
        held = module.score(documents, labels).where("held_out").join(labels, "doc_id")
        right = held.agg(F.avg((F.col("predicted") == F.col(column)).cast("double"))).first()[0]
        assert right >= least


def test_warc_round_trip(spark, tmp_path):
    big = "é" * 600
    pages = [(1, "http://a/ b", big), (2, None, big), (3, "u", "x" * 999), (4, "u", "x" * 999), (5, "u", None), (6, "u", "WARC/1.1 \x1f" * 300)]
    pages += [(None, "u", big), (None, "u", "y" * 2000), (7, "u", "z" * 2000), (7, "u", "z" * 2000), (0, "u", "z" * 2000)]
    frame = spark.createDataFrame(pages, "page_id long, url string, html string")
    manifest = warc.write_archives(warc.with_revisits(frame), f"file://{tmp_path}/w")
    whole = Counter(map(tuple, warc.read_archives(manifest).drop("payload", "path", "at").collect()))
    for size in (1, 7, 100, 1000):
        assert Counter(map(tuple, warc.read_archives(manifest, size).drop("payload", "path", "at").collect())) == whole
    got = Counter((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in warc.read_archives(manifest).collect())
    expected = Counter()
    for i, _, html in pages:
        data = (html or "").encode()
        same = [j for j, _, h in pages if h == html and j is not None] if len(data) >= 1000 else []
        other = max(same) if same and i != max(same) else None
        expected[i, len(data), hashlib.sha1(data).hexdigest(), "response" if other is None else "revisit", other] += 1
    assert got == expected
    bodies = {r["page_id"]: bytes(r["payload"]) for r in warc.read_archives(manifest, 50).where("record_type = 'response'").collect()}
    assert bodies[2] == big.encode() and bodies[6] == pages[5][2].encode()
    assert warc.archive(spark, frame.where("false")).count() == 0


def _places(data, size):
    found = []
    for start in range(0, len(data), size):
        source = warc._Source(pa.BufferReader(data), len(data))
        found += [at for at, _, _ in warc.records_in(source, start, min(start + size, len(data)))]
    return found


def _archive_of(blocks):
    members = [warc.record("response", [], block) for block in blocks]
    return b"".join(members), [sum(map(len, members[:i])) for i in range(len(members))]


@pytest.mark.parametrize("left", range(5))
def test_warc_record_at_the_end_of_a_chunk(left):
    noise = np.random.default_rng(1).bytes(warc.CHUNK)
    n = warc.CHUNK - left - len(warc.record("response", [], noise)) + len(noise)
    while (short := warc.CHUNK - left - len(warc.record("response", [], noise[:n]))) != 0:
        n += short
    data, places = _archive_of([noise[:n], b"second", b"third"])
    assert places[1] == warc.CHUNK - left and _places(data, len(data)) == places


def test_warc_chunks_of_any_size(monkeypatch):
    random = np.random.default_rng(2)
    data, places = _archive_of([random.bytes(int(n)) for n in random.integers(0, 200, 60)])
    for chunk in range(1, 65):
        monkeypatch.setattr(warc, "CHUNK", chunk)
        assert _places(data, len(data)) == places and _places(data, 37) == places, chunk


def test_warc_manifest_counts_what_is_read(spark, tmp_path):
    pages = spark.range(3000).selectExpr("id AS page_id", "'u' AS url", "repeat(sha2(cast(id AS string), 512), 9) AS html")
    manifest = warc.write_archives(warc.with_revisits(pages.coalesce(1)), f"file://{tmp_path}/w")
    expected = {r["path"]: r["records"] for r in manifest.collect()}
    assert sum(expected.values()) == 3000
    assert {r["path"]: r["count"] for r in warc.read_archives(manifest).groupBy("path").count().collect()} == expected


def _brute_neighbours(rows, queries, k):
    rows = sorted({(i, tuple(v)) for i, v in rows})
    out = {}
    for q, v in rows:
        if q % queries == 0:
            scored = [(-float((np.array(w) * np.array(v)).sum()), i) for i, w in rows if i != q]
            out[q] = sorted(set(scored))[:k]
    return out


def test_nearest_is_exact_for_all_leaves(spark):
    random = np.random.default_rng(5)
    rows = [(i, random.normal(size=6).astype("float32").astype(float).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[3][1]) for i in range(60)] + [rows[3], (2000, [3.0] * 6)]
    bad = [(5000, None), (5001, [0.0] * 6), (5002, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (5003, [float("nan")] * 6), (5004, [float("inf")] * 6), (5005, [1.0]), (None, [1.0] * 6)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>").withColumn("class", F.lit(1))
    result = defaultdict(list)
    for r in ann.search(frame, F.col("vec_id") % 20 == 0, k=5, target=1.0).orderBy("query_id", "rank").collect():
        result[r["query_id"]].append((-r["score"], r["vec_id"]))
    expected = _brute_neighbours(rows, 20, 5)
    assert set(result) == set(expected)
    found = sum(len({i for _, i in result[q]} & {i for _, i in expected[q]}) for q in expected)
    assert found >= 0.99 * sum(map(len, expected.values()))
    assert ann.search(frame.where("false"), F.lit(True)).count() == 0
    assert ann.search(frame.where("vec_id = 20"), F.col("vec_id") % 20 == 0).count() == 0


def test_nearest_reaches_the_calibrated_recall(spark, monkeypatch):
    monkeypatch.setattr(ann, "LEAF", 16)
    vectors = np.random.default_rng(7).normal(size=(4000, 16))
    frame = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    # All 200 queries are calibration queries.
    result = ann.search(frame, F.col("vec_id") % 20 == 0).toPandas().groupby("query_id")["vec_id"].agg(set)
    hits = 0
    for q, got in result.items():
        scores = vectors @ vectors[q]
        scores[q] = -np.inf
        hits += len(got & set(np.argsort(-scores)[:20].tolist()))
    assert len(result) == 200 and hits >= 0.97 * 20 * 200, hits / 4000


def test_nearest_recall(spark):
    table = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    data = table.select("vec_id", "embedding").toPandas()
    vectors, ids = np.vstack(data["embedding"]).astype(float), data["vec_id"].to_numpy()
    result = ann.search(table, F.col("vec_id") % 20 == 0).toPandas().groupby("query_id")["vec_id"].agg(set)
    hits = 0
    for q, got in result.items():
        scores = vectors @ vectors[ids == q][0]
        scores[ids == q] = -np.inf
        hits += len(got & set(ids[np.argsort(-scores)[:20]]))
    assert hits >= 0.9 * 20 * len(result) and len(result) == (ids % 20 == 0).sum()


def test_language_id(spark, docs, nothing):
    words = {"en": "the of and to in that", "de": "der die und das nicht ein", "fr": "le la les des que une"}
    rows = [(i, " ".join(np.random.default_rng(i).choice(w.split(), 40)), lang, f"src-{lang}", None) for lang, w in words.items() for i in range(k0(lang), k0(lang) + 30)]
    rows += [(900, None, "en", "src-en", None), (901, "12 34 !!", "en", "src-en", None), (902, words["de"] * 5, "en", None, None), (903, words["fr"] * 5, None, "src-de", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    found = {r["doc_id"]: r for r in language_id.identify_documents(frame).select("carried.doc_id", "language", "accepted").collect()}
    assert all(found[i]["language"] == lang and found[i]["accepted"] for i, _, lang, *_ in rows if i < 900)
    assert [found[i]["language"] for i in (900, 901, 902, 903)] == ["und", "und", "de", "fr"]
    kept = language_id.keep_identified(frame)
    assert kept.columns == frame.columns and {r["doc_id"] for r in kept.collect()} == {i for i in found if i not in (900, 901)}
    assert language_id.keep_identified(nothing).count() == 0
    assert language_id.identify_documents(docs).count() == docs.count()


def test_languages_of_few_rows(spark):
    words = {
        "en": "the of and to in that with from this have", "fi": "mutta kanssa olivat joka ovat heidän kuin siitä",
        "ceb": "ang nga sa mga usa kini niya adunay", "de": "der die und das nicht ein mit von",
    }
    many = {"en": 300, "de": 19, "fi": 3, "ceb": 1}
    rows = [
        (f"{lang}{i}", " ".join(np.random.default_rng(i).choice(words[lang].split(), 40)), lang, f"src-{lang}")
        for lang, n in many.items() for i in range(n)
    ]
    # No declared language, an English text under a rare code, values that name no language.
    rows += [("fi-", words["fi"] * 4, None, None), ("en-fi", words["en"] * 4, "fi", "src-en"), ("en-und", words["en"] * 4, "und", "src-en")]
    rows += [("en-word", words["en"] * 4, "english", "src-en")]
    frame = spark.createDataFrame(rows, "doc_id string, text string, lang string, source string")
    found = {r["doc_id"]: (r["language"], r["accepted"]) for r in language_id.identify_documents(frame).select("carried.doc_id", "language", "accepted").collect()}
    wrong = {i: found[i] for i, *_ in rows if found[i] != (i.rstrip("0123456789").split("-")[0], True)}
    assert not wrong
    alone = frame.where("doc_id like 'fi%' or doc_id like 'ceb%'")
    assert language_id.keep_identified(alone).count() == alone.count() == 5


def test_pages_of_the_smallest_table(spark):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    columns = language_id.page_columns(pages)
    found = language_id.identify(pages, **columns, carry=("page_id",)).select("carried.page_id", "language", "accepted")
    declared = pages.select("page_id", language_id.primary(columns["declared"]).alias("declared"))
    both = found.join(declared, "page_id").collect()
    assert {r["language"] for r in both} >= {"en", "de", "fr", "es"}
    assert sum(r["language"] == r["declared"] for r in both) >= 0.9 * len(both)


def k0(lang):
    return {"en": 0, "de": 100, "fr": 200}[lang]


def test_page_evidence(spark):
    pages = spark.createDataFrame(
        [("http://www.Shop.example.de/x", "<html lang='DE-at'><script>no</script><b>ja</b></html>"), (None, None)], "url string, html string"
    )
    columns = language_id.page_columns(pages)
    first = pages.select(*[c.alias(n) for n, c in columns.items()]).first()
    assert (first["declared"], first["host"], first["domain"], first["suffix"]) == ("DE-at", "www.shop.example.de", "example.de", "de")
    assert first["text"].split() == ["ja"]


def test_pipeline_stages(spark, tmp_path):
    base = [(i, f"{SENTENCE} number {i} and {i * 7} more\nshared footer line\nown line {i}", "en", "src1", None) for i in range(40)]
    base += [(100, base[5][1], "en", "src1", None), (5, base[5][1], "en", "src1", None), (101, None, "en", "src1", None)]
    # Extra columns with names that stages use keep their values.
    extras = {"n_lines": "doc_id + 7", "found": "concat('f', doc_id)", "contaminated": "'no'", "key": "doc_id", "extra_0": "'x'", "odd.name": "3"}
    table = spark.createDataFrame(base, "doc_id long, text string, lang string, source string, n_chars long")
    table.select("*", *[F.expr(e).alias(c) for c, e in extras.items()]).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "completely unrelated item text of more than thirteen words which no document holds at all")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs, columns = spark.read.parquet(f"{tmp_path}/documents.parquet"), None
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, str(tmp_path))
        columns = columns or docs.columns
        assert docs.columns == columns, name
    rows = docs.collect()
    assert all("shared footer" not in r["text"] and r["n_chars"] == len(r["text"]) for r in rows)
    assert all(r["n_lines"] == r["doc_id"] + 7 and r["found"] == f"f{r['doc_id']}" and r["odd.name"] == 3 for r in rows)
    assert all((r["contaminated"], r["key"], r["extra_0"]) == ("no", r["doc_id"], "x") for r in rows)
    ids = [r["doc_id"] for r in rows]
    assert len(ids) == len(set(ids)) and 100 not in ids and 101 not in ids
    pieces = corpus_pipeline.run(spark, str(tmp_path))
    assert {r["doc_id"] for r in pieces.collect()} == set(ids)
