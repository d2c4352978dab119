"""The n-gram join against all pairs in plain Python."""

import random
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest

from driftline.llm import ngram_join

KIND = "doc_id long, text string, key string, n int, at long"
SPACES = " \t\n\x0b\x0c\r"


def split(text):
    return [w for w in "".join(" " if c in SPACES else c.lower() if "A" <= c <= "Z" else c for c in text or "").split(" ") if w]


def shingles(text, n=5):
    words = split(text)
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} or ({tuple(words)} if words else set())


def plain(rows, percent=80, n=5):
    sets = [shingles(t, n) for _, t in rows]
    group = list(range(len(rows)))

    def root(k):
        while group[k] != k:
            k = group[k]
        return k

    for a, b in combinations(range(len(rows)), 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y) and root(a) != root(b):
            group[root(a)] = root(b)
    least = {}
    for k, (doc, _) in enumerate(rows):
        if doc is not None:
            least[root(k)] = min(least.get(root(k), doc), doc)
    return sorted(((doc, len(sets[k]), least.get(root(k)) if sets[k] else doc) for k, (doc, _) in enumerate(rows)), key=repr)


def result(found):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in found.collect()), key=repr)


def table(spark, rows, parts=5):
    return spark.createDataFrame([(*r, "clash", 1, 2) for r in rows], KIND).repartition(parts)


def corpus(seed, n=60):
    """Families of near copies with any number of words changed, passages in common, short texts, repeats."""
    r = random.Random(seed)
    word = lambda: r.choice(["The", "é", "日本", "it's", "w%d" % r.randrange(40), "v%d" % r.randrange(5000)])
    passages, rows = [[word() for _ in range(60)] for _ in range(2)], []
    for k in range(n):
        base = [word() for _ in range(r.choice([1, 3, 5, 6, 12, 40, 150]))]
        if k % 3 == 0:
            at = r.randrange(len(base) + 1)
            base[at:at] = r.choice(passages)
        for _ in range(r.choice([1, 1, 2, 6])):
            new = list(base)
            for _ in range(r.choice([0, 1, 1, 2, 4])):
                at = r.randrange(len(new))
                new[at : at + r.choice([0, 1])] = [word()] * r.choice([0, 1, 1]) or new[at : at + 1]
            text = r.choice([" ", "\n", " \t"]).join(new)
            rows.append((len(rows), text.upper() if r.random() < 0.1 and text.isascii() else text))
    return rows


@pytest.mark.parametrize("seed, frequent", [(1, 16), (2, 3)])
def test_against_all_pairs(spark, monkeypatch, seed, frequent):
    monkeypatch.setattr(ngram_join, "FREQUENT", frequent)
    rows = corpus(seed) + [(None, None), (9001, None), (9002, ""), (9003, " \x0b\f "), (9004, "one"), (9005, "ONE"), (-3, "two words"), (None, "two words"), (None, "all alone without an id")]
    rows += [rows[4], rows[4], (rows[5][0], rows[7][1])]  # repeated rows, and an id of two texts
    found = result(ngram_join.near_documents(table(spark, rows)))
    assert found == plain(rows)
    assert len({c for *_, c in found}) < 0.8 * len(found)


@pytest.mark.parametrize("percent, n", [(50, 3)])
def test_other_bounds(spark, percent, n):
    rows = corpus(7, 40)
    assert result(ngram_join.near_documents(table(spark, rows), shingle_words=n, percent=percent)) == plain(rows, percent, n)


def test_many_near_copies_and_a_chain(spark, monkeypatch):
    """A crowd that all link, texts that only share a passage, and a chain whose ends share little: with nothing remembered by tasks."""
    monkeypatch.setattr(ngram_join, "ROW_BLOCK", 400)
    r = random.Random(4)
    base = [f"b{k}" for k in range(80)]
    rows = []
    for k in range(150):
        new = list(base)
        new[r.randrange(80)] = f"x{k}"
        rows.append((k, " ".join(new)))
    passage = " ".join(f"p{k}" for k in range(100))
    rows += [(1000 + k, passage + "".join(f" own{k}-{j}" for j in range(20))) for k in range(60)]
    chain = [f"c{k}" for k in range(400)]
    rows += [(2000 + k, " ".join(chain[6 * k : 6 * k + 100])) for k in range(40)]
    found = result(ngram_join.near_documents(table(spark, rows), remembered=1))
    assert found == plain(rows)
    groups = {d: c for d, _, c in found}
    assert {groups[k] for k in range(150)} == {0} and len({groups[1000 + k] for k in range(60)}) == 60 and {groups[2000 + k] for k in range(40)} == {2000}


def test_very_long_texts(spark):
    r = random.Random(5)
    words = [f"w{r.randrange(50000)}" for _ in range(300_000)]  # over 1 MB: read in parts
    other = list(words)
    for k in range(0, len(words), 70):
        other[k] = "X"
    rows = [(1, " ".join(words)), (2, "\n".join(other)), (3, " ".join(words[: 200_000])), (4, "y" * 3_000_000), (5, "Y" * 3_000_000), (6, "z " + "y" * 3_000_000)]
    found = result(ngram_join.near_documents(table(spark, rows)))
    assert found == [(k, len(shingles(t)), c) for (k, t), c in zip(rows, [1, 1, 3, 4, 4, 6])]


def test_sets_by_parts_and_at_once():
    texts = ["a b c d", "A B c d e", "a b c d e f a b c d e", "", " x "]
    column = pa.array([t.encode() for t in texts], pa.binary())
    found = [len(g) for _, g in ngram_join.gram_sets(column)]
    assert found == [len(shingles(t)) for t in texts]
    one, other = (next(ngram_join.gram_sets(pa.array([t.encode()], pa.binary())))[1] for t in ("q " * 3, "q " * 4))
    assert one[0] != other[0]


def test_rows_of_the_product():
    r = np.random.default_rng(1)
    sets = [np.unique(r.integers(0, 2**63, n).astype(np.uint64) * np.uint64(2)) for n in (1, 5, 30, 200)]
    sets += [np.unique(np.concatenate([sets[3][k:], r.integers(0, 2**63, k).astype(np.uint64)])) for k in (1, 10, 20, 22, 23, 25, 60)]
    for row in sets:
        want = [100 * len(np.intersect1d(row, x)) >= 80 * len(np.union1d(row, x)) for x in sets]
        assert ngram_join.linked_rows(row, sets).tolist() == want


def test_parities_never_part_what_links():
    r = np.random.default_rng(2)
    for n in (1, 3, 40, 146, 900):
        base = np.unique(r.integers(0, 2**63, n).astype(np.uint64))
        for changed in {0, 1, n // 12, n // 9, n // 7, n // 4}:
            other = np.unique(np.concatenate([base[changed:], r.integers(0, 2**63, changed).astype(np.uint64)]))
            differ = sum(int(x).bit_count() for x in (ngram_join.parities(base) ^ ngram_join.parities(other)).view(np.uint64))
            alone = len(np.setxor1d(base, other))
            assert differ <= alone and (n > 200 or differ > 0.7 * alone - 2)


def test_no_rows(spark):
    assert ngram_join.near_documents(table(spark, [])).collect() == []
    assert result(ngram_join.near_documents(table(spark, [(1, None), (None, "")]))) == [(1, 0, 1), (None, 0, None)]
