"""Adaptive quality rules, centroids and ranked search against brute-force models on difficult rows, and on empty tables."""

import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from ordermill.llm import centroids, lexical, quality_rules
from ordermill.llm.centroids import Neighbours

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
SCHEMA = "doc_id long, text string, lang string, source string, words string, lines string, g0 int, t long, salt int, level int, bin int"


def _table(spark, rows):
    return spark.createDataFrame([(i, t, lang, source, "w", "l", 1, 2, 3, 4, 5) for i, t, lang, source in rows], SCHEMA).repartition(3)


def _prose(seed, n, words=("alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa", "lambda", "mu")):
    pick = random.Random(seed)
    return " ".join(pick.choice(words) + str(pick.randrange(50)) for _ in range(n))


def _documents():
    rows = [(i, _prose(i, 60 + i % 40), "en", "src1") for i in range(130)]
    rows += [(1000 + i, _prose(i, 70).replace("a", "#"), "de" if i % 2 else None, f"src{i % 7}") for i in range(60)]
    rows += [(2000, " ".join(w + "$$$" for w in _prose(1, 80).split()), "en", "src1"), (2001, _prose(2, 30) + "\n" + "same line\n" * 40, "en", "src1")]
    rows += [(2002, "x" * 5000 + " " + _prose(3, 60), "en", "src1"), (2003, "a b c " * 30_000, "en", None), (2004, _prose(4, 60).replace(" ", "\x0b\t"), "en", "src5")]
    rows += [(2005, None, "en", "src1"), (2006, "", None, None), (2007, " \n\t", "en", "src1"), (2008, "one two three", "en", "src1"), (2009, "a b a b", "en", "src1")]
    rows += [(2010, "naïve – „quote“ 日本 語 é|é " * 12 + _prose(5, 50), "en", "src5"), (None, _prose(6, 60), "en", "src1"), (3, rows[3][1], "en", "src1")]
    return rows


def _measured(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    times = Counter(windows)
    places = {i + j for i, w in enumerate(windows) if times[w] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(places), len(lines)


def _limits(values):
    """Lows and highs of one measure each, from sorted values with edges of buckets."""

    def edges(x):
        shift = max(x.bit_length() - 6, 0)
        return x >> shift << shift, ((x >> shift) + 1 << shift) - 1

    out = []
    for m, column in enumerate(zip(*values)):
        ranked = sorted(column)
        q1 = edges(ranked[-(-len(ranked) // 4) - 1])[0]
        q3 = edges(ranked[-(-3 * len(ranked) // 4) - 1])[1]
        spread = max(q3 - q1, (250, 100, 150, 100)[m])
        out.append((q1 - 3 * spread if m == 0 else -1, q3 + 3 * spread))
    return out


def test_quality_rules(spark):
    rows = _documents()
    measured = [_measured(t) for _, t, _, _ in rows]
    failed = [n < 50 or 100 * repeat > 50 * n for n, _, _, _, repeat, _ in measured]
    ratios = [None if bad else (1000 * c // n, 10000 * s // n, 1000 * d // full, 1000 * r // n) for (n, c, s, d, r, full), bad in zip(measured, failed)]
    expected = Counter()
    for (i, _, lang, source), m, bad, ratio in zip(rows, measured, failed, ratios):
        kept, level = False, None
        if not bad:
            for level, alike in ((2, lambda r: r[2:] == (lang, source)), (1, lambda r: r[2] == lang), (0, lambda r: True)):
                group = [x for r, x in zip(rows, ratios) if x and alike(r)]
                if level == 0 or len(group) >= 100:
                    break
            kept = all(low <= x <= high for x, (low, high) in zip(ratio, _limits(group)))
        expected[i, lang, source, *m[:5], bad, kept, level] += 1
    result = quality_rules.judge(_table(spark, rows))
    assert Counter(map(tuple, result.collect())) == expected
    assert {level for *_, level in expected} == {0, 1, 2, None}
    by_id = {i: kept for i, *_, kept, _ in expected}
    assert not by_id[2000] and not by_id[2001] and not by_id[2002] and all(by_id[i] for i in range(130))
    assert quality_rules.judge(_table(spark, [])).count() == 0


def test_sketches_merge(spark):
    """A language's sketch is that of all its documents, however the rows are dealt."""
    rows = _documents()
    found = []
    for n in (1, 7):
        sketch = quality_rules.sketches(quality_rules.measure(_table(spark, rows).repartition(n)))
        found.append(Counter(map(tuple, sketch.collect())))
    assert found[0] == found[1]
    total = Counter()
    for (level, *_, n), times in found[0].items():
        total[level] += n * times
    assert total[0] == total[1] == total[2] > 0


def test_orchard_search():
    random_ = np.random.default_rng(5)
    for width, k in ((1, 30), (2, 50), (64, 8)):
        centres = random_.integers(-1000, 1000, (k, width))
        centres[3] = centres[1]
        points = np.concatenate([random_.integers(-1000, 1000, (500, width)), centres, (centres[:4] + centres[4:8]) // 2])
        square = ((points[:, None, :] - centres[None]) ** 2).sum(axis=2)
        number, least, compared = Neighbours(centres.tolist()).nearest(points)
        assert number.tolist() == square.argmin(axis=1).tolist() and least.tolist() == square.min(axis=1).tolist()
        assert width > 2 or compared < 0.7 * len(points) * k
    at_limit = Neighbours([[centroids.LARGEST - 1] * 64, [1 - centroids.LARGEST] * 64])
    assert at_limit.nearest(np.full((1, 64), 1 - centroids.LARGEST))[0].tolist() == [1]
    assert Neighbours([[0, 0]]).nearest(np.zeros((0, 2), np.int64))[0].tolist() == []


def _clusters(vectors, k, rounds, seed):
    kept = [(i, [math.floor(1024 * x) for x in v]) for i, v in vectors if v is not None and len(v) == 2 and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    centres = [v for i, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    for round_ in range(rounds + 1):
        near = [min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres)) for _, v in kept]
        if round_ < rounds:
            for n in range(len(centres)):
                own = [v for (_, v), (_, m) in zip(kept, near) if m == n]
                if own:
                    centres[n] = [sum(x) // len(own) for x in zip(*own)]
    sums = Counter()
    for square, n in near if kept else []:
        sums[n] += square
    hashed = lambda c: hashlib.sha256(",".join(map(str, c)).encode()).hexdigest()
    return Counter((i, n, square, sums[n], sum(sums.values()), hashed(centres[n])) for (i, _), (square, n) in zip(kept, near)) if kept else Counter()


def test_centroids(spark):
    pick = random.Random(2)
    vectors = [(i, [pick.gauss(i % 5, 0.3), pick.gauss(-i % 3, 0.3)]) for i in range(120)]
    vectors += [(500, None), (501, [1.0]), (502, [1.0, None]), (503, [float("nan"), 1.0]), (504, [float("inf"), 1.0]), (505, [0.0, 0.0])]
    vectors += [(7, vectors[7][1]), (7, vectors[7][1]), (8, [9.0, 9.0]), (None, [2.0, 2.0]), (None, None)]
    frame = spark.createDataFrame([(i, v, 1, "c", 0) for i, v in vectors], "vec_id long, embedding array<double>, v int, cluster string, n int")
    for k, rounds in ((8, 10), (3, 0), (500, 2)):
        result = centroids.cluster(frame.repartition(5), k=k, rounds=rounds, width=2)
        assert Counter(tuple(r)[:6] for r in result.collect()) == _clusters(vectors, k, rounds, 3)
    assert centroids.cluster(frame.where("vec_id < 0"), width=2).count() == 0
    with pytest.raises(Exception, match="64-bit"):
        centroids.cluster(spark.createDataFrame([(1, [1e300, 0.0])], "vec_id long, embedding array<double>"), width=2).count()


def _ranking(docs, items, k):
    counted = [(i, Counter(TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))) for i, t in docs]
    whole, length = sum(bool(c) for _, c in counted), sum(sum(c.values()) for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = Counter()
    for item, text in items:
        terms = set(TERM.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or "")))
        scored = []
        for place, (i, c) in enumerate(counted):
            m = 10 + 90 * sum(c.values()) * whole // max(length, 1)
            score = sum(math.floor(1000 * math.log((2 * whole + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            scored += [(-score, i is None, i or 0, place)] if score > 0 else []
        for rank, (score, none, i, _) in enumerate(sorted(scored)[:k], 1):
            out[item, rank, None if none else i, -score] += 1
    return out


def test_lexical_search(spark):
    words = [f"w{n}" for n in range(60)] + ["Über", "naïve", "日本", "x2", "the"]
    docs = [(i, _prose(i, 5 + i % 60, words) + " the") for i in range(300)]
    docs += [(400 + i, "rare phrase of many copies the w7 1") for i in range(50)] + [(3, docs[3][1]), (None, docs[4][1]), (None, None), (900, ""), (901, "--- !!"), (902, "THE rare É é " * 20_000)]
    items = [(i, _prose(1000 + i, 1 + i % 9, words)) for i in range(40)] + [(50, "rare phrase"), (51, None), (52, "..."), (53, "absent"), (0, "w1 w1"), (0, "w1 w1"), (None, "É copies, the")]
    frame = _table(spark, [(i, t, "en", "s") for i, t in docs])
    asked = spark.createDataFrame([(i, t, 1, 2) for i, t in items], "item_id long, text string, item int, term int").repartition(3)
    expected = _ranking(docs, items, 10)
    for blocks in ({}, {"doc_postings": 300, "item_postings": 20}):
        result = lexical.search(frame, asked, **blocks)
        assert result.columns == ["item_id", "rank", "doc_id", "score"]
        assert Counter(map(tuple, result.collect())) == expected
    assert lexical.search(_table(spark, []), asked).count() == 0
    assert lexical.search(frame, asked.where("item_id < 0")).count() == 0


def test_dual_trees_prune():
    """Batches are left out, and what is left out would not have been among the best."""
    import pyarrow as pa

    random_ = np.random.default_rng(3)
    topics = random_.permutation(400).reshape(20, 20)
    docs = [np.append(random_.choice(topics[n % 20], 8, replace=False), 400) for n in range(2000)]
    asks = [np.append(random_.choice(topics[n], 5, replace=False), 400) for n in range(20)]
    lists = lambda rows: pa.array([r.tolist() for r in rows], pa.list_(pa.int64()))
    left = lexical.Block(lists(docs), lists([1000 + random_.integers(0, 1000, 9) for _ in docs]), np.arange(401), 4, 20)
    right = lexical.Block(lists(asks), lists(np.array([[500] * 5 + [1]] * 20)), np.arange(401), 1)
    dense = lambda block: [np.bincount(block.column[a:b], block.value[a:b], 401).astype(int) for a, b in zip(block.start, block.start[1:])]
    scores = np.array(dense(right)) @ np.array(dense(left)).T
    places = random_.permutation(2000)
    best, products = lexical.search_blocks(left, right, places, np.zeros(20, np.int64), 10)
    for row, (found, ranks) in zip(scores, best):
        order = np.lexsort((places, -row))[:10]
        assert found.tolist() == row[order].tolist() and ranks.tolist() == places[order].tolist()
    assert products < 0.3 * scores.size
