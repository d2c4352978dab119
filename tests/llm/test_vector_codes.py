"""Vector codes against plain integer arithmetic; the approximation file against all distances."""

import hashlib
import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from driftline.llm import vector_codes
from driftline.llm.vector_codes import ApproximationFile

KIND = "vec_id long, embedding array<float>, label string, code int"


def nearest(entries, queries):
    distance = np.square(queries[:, None].astype(object) - entries[None].astype(object)).sum(axis=2).astype(np.int64)
    return distance.argmin(axis=1), distance.min(axis=1)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 2**32), st.integers(1, 70), st.integers(1, 6), st.integers(1, 5), st.sampled_from([1, 3, 40, 5000, (1 << 27)]))
def test_bounds_never_lose_the_nearest(seed, n, size, bits, spread):
    r = np.random.default_rng(seed)
    entries, queries = r.integers(-spread, spread + 1, (n, size)), r.integers(-2 * spread, 2 * spread + 1, (50, size))
    entry, distance, refined = ApproximationFile.of(entries, bits).nearest(queries)
    want = nearest(entries, queries)
    assert (entry == want[0]).all() and (distance == want[1]).all() and refined >= len(queries)


def test_most_entries_are_never_compared():
    r = np.random.default_rng(5)
    entries, queries = r.integers(-200, 200, (64, 4)), r.integers(-200, 200, (2000, 4))
    assert ApproximationFile.of(entries).nearest(queries)[2] < 0.35 * 64 * 2000


def plain(rows, parts=16, entries=64, rounds=2):
    kept = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if v is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    width = len(kept[0][1]) // parts
    cut = np.array([[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in kept])
    first = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, kept[k][1]))[:entries]
    books = [cut[first, p].copy() for p in range(parts)]
    for step in range(rounds + 1):
        found = [nearest(books[p], cut[:, p]) for p in range(parts)]
        for p in range(parts if step < rounds else 0):
            for e in set(found[p][0].tolist()):
                own = cut[found[p][0] == e, p]
                books[p][e] = [int(s) // len(own) for s in own.sum(axis=0)]
    digest = hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()
    error = [sum(int(found[p][1][k]) for p in range(parts)) for k in range(len(kept))]
    of_label = {}
    for (_, _, label), e in zip(kept, error):
        of_label[label] = of_label.get(label, 0) + e
    return sorted(((i, "".join(f"{found[p][0][k]:02x}" for p in range(parts)), error[k], of_label[label], digest) for k, (i, _, label) in enumerate(kept)), key=repr)


def result(found):
    return sorted(((r.vec_id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in found.collect()), key=repr)


def vectors(n, size, seed):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(9, size))
    found = [(k, (centres[k % 9] + 0.3 * r.normal(size=size)).astype(np.float32).tolist(), [None, "a", "b"][k % 3]) for k in r.permutation(n).tolist()]
    return found + found[: n // 10]  # repeated rows


@pytest.mark.parametrize("n, size", [(300, 64), (40, 16), (90, 48)])
def test_against_plain_integers(spark, n, size):
    rows = vectors(n, size, n) + [(None, [0.25] * size, "a"), (-7, None, "a"), (-6, [None] * size, "b"), (-5, [float("nan")] * size, None), (-4, [float("inf")] + [0.0] * (size - 1), "c"), (n + 9, [-0.001] * size, "a")]
    table = spark.createDataFrame([(*r, 1) for r in rows], KIND).repartition(4)
    assert result(vector_codes.compress_vectors(table)) == plain(rows)


def test_odd_tables(spark):
    assert vector_codes.compress_vectors(spark.createDataFrame([], KIND)).collect() == []
    other = [(1, [0.5] * 16, "a", 0), (2, [0.5] * 16, "a", 0), (3, [0.5] * 32, "a", 0), (4, [], "a", 0), (5, [0.1] * 5, "a", 0)]
    assert sorted(r.vec_id for r in vector_codes.compress_vectors(spark.createDataFrame(other, KIND)).collect()) == [1, 2]
    with pytest.raises(Exception, match="beyond"):
        vector_codes.compress_vectors(spark.createDataFrame([(1, [3e30] * 16, "a", 0)], KIND)).collect()
