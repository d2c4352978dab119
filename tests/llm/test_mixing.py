from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from driftline.llm import mixing
from driftline.llm.mixing import apportion, coprime_step, mix, whole_copies


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 10**6), min_size=1, max_size=12), st.integers(0, 400))
def test_apportion(weights, seats):
    want = [0] * len(weights)
    for _ in range(seats if sum(weights) else 0):
        best = max(range(len(weights)), key=lambda k: (weights[k] / (2 * want[k] + 1), -k))
        want[best] += 1
    found = apportion(np.array(weights), seats).tolist()
    assert sum(found) == sum(want)
    for a, b, w in zip(found, want, weights):
        assert a == b or abs(a - b) == 1 and w  # equal quotients may fall either way


def targets(size):
    names = sorted((s for s in size if s is not None)) + [s for s in size if s is None]
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    total, free, fixed = sum(size.values()), set(size), {}
    while True:
        left = total - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 3 * size[s]}
        if not over:
            return fixed | share
        fixed |= {s: 3 * size[s] for s in over}
        free -= over


@pytest.mark.parametrize("shard_words", [500, 1 << 22])
def test_mix(spark, shard_words):
    rows = [(k, "w " * (1 + k * 7 % 90), "hot" if k % 3 == 0 else f"s{k % 11}") for k in range(900)]
    rows += [(1001, "a b", None), (None, "c d e", None), (1007, None, "s1"), (1007, None, "s1"), (1008, "", "tiny"), (1009, "x " * 9000, "é"), (1010, " \x0b\f  \t", "tiny")]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, source string, size string")
    found = mix(docs, shard_words=shard_words).collect()
    assert sorted(found, key=str) == sorted(mix(docs.repartition(5), shard_words=shard_words).collect(), key=str)
    assert len(found) == len(rows)
    size = defaultdict(int)
    for _, text, source in rows:
        size[source] += len((text or "").encode().split())
    want = sorted((size[s], t) for s, t in targets(size).items())
    got = {(r.source_size, r.target) for r in found}
    assert [a for a, _ in want] == [a for a, _ in sorted(got)]
    assert np.allclose([b for _, b in want], [b for _, b in sorted(got)])
    taken, of, aim = defaultdict(int), {r[0]: r[2] for r in rows}, targets(size)
    for r in found:
        assert 0 <= r.taken <= 3 * r.size
        taken[of[r.doc_id]] += r.taken
    for name, n in taken.items():
        shards = -(-max(size[name], 1) // shard_words)
        assert abs(n - aim[name]) <= 2 * 17 * shards, name
    copies = {r.doc_id: r.copies for r in whole_copies(docs, shard_words=shard_words).collect()}
    mean, words = {r.doc_id: r.taken / r.size for r in found if r.size}, defaultdict(int)
    for k, text, source in {r[0]: r for r in rows if r[0] in mean}.values():
        assert int(mean[k]) <= copies[k] <= int(mean[k]) + 1
        words[source] += copies[k] * len(text.split())
    longest = {s: max(len((t or "").split()) for _, t, x in rows if x == s) for s in size}
    for name, n in words.items():
        shards = -(-max(size[name], 1) // shard_words)
        assert abs(n - aim[name]) <= 2 * (17 + longest[name]) * shards, name


@pytest.mark.parametrize("group_shards", [1, 3])
def test_groups_of_shards(spark, monkeypatch, group_shards):
    monkeypatch.setattr(mixing, "GROUP_SHARDS", group_shards)
    rows = [(k, "w " * (1 + k * 7 % 90), "hot" if k % 3 == 0 else f"s{k % 4}") for k in range(600)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    size, taken = defaultdict(int), defaultdict(int)
    for _, text, source in rows:
        size[source] += len(text.split())
    for r in mix(docs, shard_words=700).collect():
        taken[rows[r.doc_id][2]] += r.taken
    assert all(abs(taken[s] - t) <= 2 * 17 * -(-size[s] // 700) for s, t in targets(size).items())


def test_every_block_once():
    for blocks in range(1, 2001):
        step = coprime_step(blocks * 7919 % 104729, blocks)
        assert len({(k * step + 3) % blocks for k in range(blocks)}) == blocks


def test_rows_of_one_id_are_dealt_by_text(spark):
    docs = spark.createDataFrame([(None, f"w{k} " * 40, "s") for k in range(400)], "doc_id long, text string, source string")
    tape, quotas = mixing._shards(docs.selectExpr("doc_id", "source", "xxhash64(text) AS digest", "40L AS size"), 1, 16, 1000)
    assert tape.groupBy("shard").count().where("count > 100").isEmpty() and quotas.count() == 16


def test_no_rows(spark):
    assert mix(spark.createDataFrame([], "doc_id long, text string, source string")).collect() == []
