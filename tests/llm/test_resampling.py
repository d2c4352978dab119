"""Importance resampling against plain Python, and its edges."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import pytest

from driftline.llm import resampling

KIND = "doc_id long, text string, weight string, n int"


def plain(rows, target, low, high, percent, buckets, least):
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))
    features = lambda ws: [" ".join(ws[k : k + n]) for n in range(low, high + 1) for k in range(len(ws) - n + 1)]
    at = lambda t: [zlib.crc32(f.encode()) % buckets for f in features(words(t))]
    s, t = Counter(), Counter()
    for _, text in rows:
        s.update(at(text))
    for text in target:
        t.update(at(text))
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in range(buckets)]
    out = []
    for doc, text in rows:
        found = at(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"2024:{'' if doc is None else doc}".encode()).hexdigest()[:8], 16)
        out.append([doc, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words(text)) >= least])
    able = sorted((r for r in out if r[4]), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1], r[2]))
    ranks = {}
    for k, r in enumerate(able[: percent * len(able) // 100]):
        ranks.setdefault((r[0], r[1]), []).append(k + 1)
    return sorted((str(r[0]), r[1], r[2], r[3], ranks[r[0], r[1]].pop(0) if r[4] and ranks.get((r[0], r[1])) else None) for r in out)


def texts(n, seed=3):
    r = random.Random(seed)
    word = lambda: r.choice(["the", "THE", "É", "日本", "a-b", "x9", "w%d" % r.randrange(300), "_", "\x7f", "it's"])
    rows = [(k, r.choice([" ", "\n"]).join(word() for _ in range(r.randrange(60)))) for k in range(n)]
    return rows + [(k, rows[k][1]) for k in range(0, n, 9)] + [(None, "no id " * 30), (None, None), (n + 1, ""), (n + 2, None), (n + 3, "long word " * 50000), (-4, "A")]


def result(found):
    return sorted((str(r.doc_id), r.n_features, r.weight, r.score, r["rank"]) for r in found.collect())


@pytest.mark.parametrize("low, high, percent, buckets", [(1, 1, 10, 10_000), (1, 2, 50, 97), (2, 3, 100, 1000), (1, 1, 0, 10)])
def test_against_plain_python(spark, low, high, percent, buckets):
    rows, target = texts(200), ["the w1 w2 w3 日本", None, "", "w1 w1 x9 " * 40]
    docs = spark.createDataFrame([(*r, "clash", 1) for r in rows], KIND).repartition(5)
    found = resampling.resample(docs, spark.createDataFrame([(t,) for t in target], "text string"), percent, (low, high), buckets, least_words=20)
    assert result(found) == plain(rows, target, low, high, percent, buckets, 20)


def test_ties_and_many_ranges(spark):
    """Copies with ids of their own differ by noise alone; rows equal in all take neighbouring ranks, none twice."""
    rows = [(k // 3, "same words in every one of these rows " * 4) for k in range(3000)]
    docs = spark.createDataFrame([(*r, "", 0) for r in rows], KIND).repartition(7)
    found = resampling.resample(docs, spark.createDataFrame([("other",)], "text string"), 40).collect()
    ranks = sorted(r["rank"] for r in found if r["rank"])
    assert ranks == list(range(1, 1201))
    drawn = sorted((r for r in found if r["rank"]), key=lambda r: r["rank"])
    assert [(-r.score, r.doc_id) for r in drawn] == sorted((-r.score, r.doc_id) for r in drawn)
    assert min(r.score for r in drawn) >= max(r.score for r in found if not r["rank"])


def test_no_rows_and_no_target(spark):
    none = spark.createDataFrame([], KIND)
    assert resampling.resample(none, none).collect() == []
    docs = spark.createDataFrame([(1, "a b c " * 9, "", 0)], KIND)
    assert result(resampling.resample(docs, none, 100)) == plain([(1, "a b c " * 9)], [], 1, 1, 100, 10_000, 20)


def test_only_counts_and_drawn_rows_are_shuffled(spark):
    """Scores are computed where the bucket arrays stand: one map over the rows, no join and no explode."""
    rows = resampling.bucket_arrays(spark.createDataFrame(texts(20), "doc_id long, text string"))
    plan = resampling.weights(rows, [1] * resampling.BUCKETS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan and "Python" not in plan
