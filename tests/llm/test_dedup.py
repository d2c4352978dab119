import hashlib
import random
import tracemalloc
from collections import defaultdict

import xxhash

from driftline.llm import simhash, words
from driftline.llm.components import component_of, connected_components
from driftline.llm.exact_dedup import exact_dedup

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def test_exact(spark):
    r = random.Random(1)
    pool = ["", "a", "A", "é", "É", "x" * 64, "x" * 65, "x" * 64 + "y" * 64, "y" * 64 + "x" * 64, "x" * 192, "long " * 100, "lonG " * 100, "long " * 99 + "longx", None]
    rows = [(k, r.choice(pool)) for k in range(200)] + [(5, "a"), (5, "a"), (None, "a"), (None, "only here"), (500, "b" * 1000)]
    docs = spark.createDataFrame([(*x, "clash", 1) for x in rows], "doc_id long, text string, name string, row int").repartition(3)
    found = exact_dedup(docs, block_bytes=64).collect()
    groups = defaultdict(list)
    for doc, text in rows:
        groups[(text or "").translate(UPPER)].append(doc)
    want = []
    for text, ids in groups.items():
        keep = max((i for i in ids if i is not None), default=None)
        want += [(i, keep, len(ids), hashlib.sha256(text.encode()).hexdigest()) for i in ids]
    assert sorted(((x.doc_id, x.keep_id, x.group_size, x.text_sha256) for x in found), key=str) == sorted(want, key=str)
    assert sum(x.kept for x in found) == len(groups)
    assert all(x.doc_id == x.keep_id for x in found if x.kept)
    assert exact_dedup(docs.limit(0)).collect() == []
    plan = exact_dedup(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def brute_fingerprint(text):
    words = "".join(c if c not in " \t\n\x0b\x0c\r" else " " for c in (text or "").translate(UPPER)).split(" ")
    words = [w for w in words if w]
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def test_fingerprints_of_long_texts_in_parts(monkeypatch):
    r = random.Random(11)
    for size in (8, 40, 300):
        monkeypatch.setattr(words, "LONG_BYTES", size)
        for _ in range(80):
            text = "".join(r.choice(["a", "B ", "É\n", "ccc  ", "d" * 70, " ", "\x0b"]) for _ in range(r.randrange(70)))
            assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)
        for text in (" " * 900, "x" * 900, "X" * 900 + " y" + " " * 900, " " * 900 + "a b c d"):
            assert simhash.fingerprint(text.encode()) == brute_fingerprint(text)


def test_memory_for_a_long_text():
    text = b"Of all the words " * 500_000  # 8.5 MB, 2,000,000 words
    tracemalloc.start()
    simhash.fingerprint(text)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 60e6


def test_fingerprints():
    r = random.Random(2)
    for text in [None, "", " \t", "A b", "one", "a b c", "É é x\x1fy z", *(" ".join(r.choice("abcXYZé") for _ in range(r.randrange(40))) for _ in range(200))]:
        assert simhash.fingerprint((text or "").encode()) == brute_fingerprint(text)


def test_links_are_complete(spark):
    r = random.Random(3)
    prints = {0, 2**64 - 1, 1 << 63, 3 << 62}
    while len(prints) < 400:
        x = r.getrandbits(64)
        prints.add(x)
        for _ in range(r.randrange(4)):
            x ^= sum(1 << b for b in r.sample(range(64), r.randrange(1, 4)))
            prints.add(x)
    prints = sorted(x - (1 << 64) if x >> 63 else x for x in prints)
    found = {(x.a, x.b) for x in simhash.fingerprint_links(spark.createDataFrame([(x,) for x in prints], "fp long")).collect()}
    want = {(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if ((a ^ b) & (2**64 - 1)).bit_count() <= 2}
    assert found == want and len(want) > 100


def test_full_cells_keep_what_is_connected(spark):
    r = random.Random(5)
    prints = {x ^ (1 << a) ^ (1 << b) for x in [r.getrandbits(64) for _ in range(3)] for a in range(9) for b in range(9)}
    prints |= {r.getrandbits(64) for _ in range(50)}
    table = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in sorted(prints)], "fp long")
    every = {(x.a, x.b) for x in simhash.fingerprint_links(table).collect()}
    some = {(x.a, x.b) for x in simhash.fingerprint_links(table, full_cell=3).collect()}
    assert some < every and len(some) < len(every)
    label = lambda links: {x.node: x.component for x in connected_components(spark.createDataFrame(sorted(links), "a long, b long")).collect()}
    assert label(some) == label(every)


def test_near(spark):
    r = random.Random(4)
    base = [" ".join(r.choice(["alpha", "beta", "gamma", "delta", "eps"]) + str(r.randrange(50)) for _ in range(120)) for _ in range(20)]
    rows = [(k, t) for k, t in enumerate(base)] + [(100 + k, t + " end") for k, t in enumerate(base)] + [(200 + k, t.upper()) for k, t in enumerate(base)]
    rows += [(300, ""), (301, None), (302, " \n"), (None, base[0]), (None, "no other"), (1, base[1])]
    docs = spark.createDataFrame([(*x, 1, 2) for x in rows], "doc_id long, text string, fp int, component int").repartition(3)
    found = simhash.near_duplicates(docs).collect()
    prints = [brute_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2 and group[a] != group[b]:
                group = [group[b] if g == group[a] else g for g in group]
    least = {g: min((d for (d, _), h in zip(rows, group) if h == g and d is not None), default=None) for g in group}
    want = sorted(((d, p, least[g]) for (d, _), p, g in zip(rows, prints, group)), key=str)
    assert sorted(((x.doc_id, x.fp % (1 << 64), x.component_id) for x in found), key=str) == want
    assert simhash.near_duplicates(docs.limit(0)).collect() == []


def test_components(spark):
    chain = [(k, k + 1) for k in range(40)] + [(1000, 1001), (1001, 1000), (5000, 5000), (None, 3), (7, None)]
    star = [(2000, 2000 + k) for k in range(1, 60)]
    found = {x.node: x.component for x in connected_components(spark.createDataFrame(chain + star, "a long, b long")).collect()}
    assert found == {k: 0 for k in range(41)} | {1000: 1000, 1001: 1000} | {2000 + k: 2000 for k in range(60)}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_rounds_are_few(spark):
    links = [(k, k + 1) for k in range(999)]
    found, rounds = component_of(spark.createDataFrame(links, "a long, b long"))
    assert rounds < 15 and found.select("component").distinct().count() == 1 and found.count() == 1000
