import random

import numpy as np
import pytest

from driftline.llm import substring as s
from driftline.llm import words as w
from driftline.llm.common import new_path


def brute(rows):
    seen, out = {}, {}
    for doc, text in sorted(rows, key=lambda r: -1 if r[0] is None else r[0]):
        words = (text or "").encode().split()
        gone = [False] * len(words)
        for k in range(len(words) - 19):
            w = tuple(words[k : k + 20])
            if w in seen:
                gone[k : k + 20] = [True] * 20
            seen.setdefault(w, True)
        out[doc] = (len(words), sum(gone), b" ".join(x for x, g in zip(words, gone) if not g).decode())
    return out


def corpus(seed=1):
    r = random.Random(seed)
    word = lambda: r.choice(["a", "the", "é", f"w{r.randrange(40)}", "x."])
    shared = [" ".join(word() for _ in range(n)) for n in (19, 20, 21, 35, 80)]
    rows = []
    for k in range(300):
        parts = [" ".join(word() for _ in range(r.randrange(30))) for _ in range(3)]
        parts.insert(r.randrange(3), r.choice(shared))
        if k % 3 == 0:
            parts.append(shared[3])
        rows.append((k * 7, r.choice([" ", "\n", "\t "]).join(parts)))
    rows += [(5, None), (6, ""), (8, "a " * 100), (9, "a " * 60), (None, shared[4]), (10, rows[3][1]), (11, "z " * 30000 + shared[4])]
    return rows


@pytest.mark.parametrize("batches,most_runs,remembered,long_bytes", [(1, 4, 100_000, 1 << 20), (3, 2, 20, 700), (5, 1, 1, 1 << 20)])
def test_against_brute_force(spark, monkeypatch, batches, most_runs, remembered, long_bytes):
    monkeypatch.setattr(w, "LONG_BYTES", long_bytes)
    rows = corpus()
    docs = spark.createDataFrame([(*x, "clash", 1) for x in rows], "doc_id long, text string, doc string, n long").repartition(4)
    found = s.remove_repeats(docs, batches=batches, most_runs=most_runs, remembered=remembered).collect()
    assert {r.doc_id: tuple(r)[1:] for r in found} == brute(rows)
    assert len(found) == len(rows) and sum(r.n_removed for r in found) > 1000


def test_query_compacts(spark, monkeypatch):
    merged = []
    compact = s.FingerprintIndex.compact
    monkeypatch.setattr(s.FingerprintIndex, "compact", lambda self: (compact(self), merged.append([r.n for r in self.run(self.names[0]).collect()])))
    s.remove_repeats(spark.createDataFrame(corpus(3), "doc_id long, text string"))
    assert len(merged) == 1 and max(merged[0]) > 1


def test_same_rows_and_no_rows(spark):
    text = " ".join(f"w{k}" for k in range(30))
    found = s.remove_repeats(spark.createDataFrame([(1, text), (1, text), (2, text)], "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_removed) for r in found) == [(1, 0), (1, 0), (2, 30)]
    assert s.remove_repeats(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_filter(spark):
    rows = spark.range(0, 3000, 3).withColumnRenamed("id", "doc")
    docs = spark.range(3000).selectExpr("id AS doc", "cast(cast(id AS string) AS binary) AS text")
    found = s.bitmap_of(rows, "doc")
    assert {r.doc for r in s.passing(docs, "doc", found).select("doc").collect()} >= set(range(0, 3000, 3))
    rest = {r.doc for r in s._untouched(docs, found).select("doc").collect()}
    assert not rest & set(range(0, 3000, 3)) and len(rest) > 1900


def test_remove_words():
    assert s.remove_words(b"", np.zeros(0, np.int64)) == (0, 0, b"")
    assert s.remove_words(b" a\tb ", np.zeros(0, np.int64)) == (2, 0, b"a b")


def test_long_texts_in_parts(monkeypatch):
    monkeypatch.setattr(w, "LONG_BYTES", 50)
    r = random.Random(2)
    for _ in range(200):
        words = [r.choice("abc") * r.choice([1, 2, 3, 90]) for _ in range(r.randrange(60))]
        data = (" " * r.randrange(3) + r.choice([" ", "  \n"]).join(words) + " " * r.randrange(80)).encode()
        for overlap in (0, 3):
            found = []
            for word, own, part in w.LongText(np.frombuffer(data, np.uint8)).parts(overlap, 50):
                assert word == len(found)
                joined, at = part.joined()
                texts = [joined[a : b - 1].tobytes().decode() for a, b in zip(at[:-1], at[1:])]
                assert texts[own:] == words[word + own : word + own + overlap] or word + len(texts) == len(words)
                found += texts[:own]
            assert found == words


def test_long_words_are_told_apart():
    words = [b"x" * 200 + bytes([65 + k]) for k in range(26)] + [b"short", b"x" * 64, b"x" * 65]
    data = b" ".join(words + words)
    hashes = w.Texts(np.frombuffer(data, np.uint8), np.array([0, len(data)])).hashes()
    assert len(set(hashes.tolist())) == len(words) and (hashes[: len(words)] == hashes[len(words) :]).all()


def test_index_is_opened_again_and_history_stays_where_it_is(spark):
    rows = sorted((r for r in corpus(2) if r[0] is not None), key=lambda r: r[0])
    table = s._keyed(spark.createDataFrame(rows, "doc_id long, text string"), "text", "doc_id")
    path = new_path(spark, "index")
    bounds, marks = [(0, 500), (500, 900), (900, 1500), (1500, 3000)], {}
    merged = 0
    for a, b in bounds:
        index = s.FingerprintIndex.open(spark, path, most_runs=2) if a else s.FingerprintIndex(spark, path, most_runs=2)
        batch = table.where(f"doc >= {a} AND doc < {b}")
        marks |= {r.doc: np.array(r.marks) for r in index.append(batch, table.where(f"doc < {a}")).collect()}
        assert len(index.names) <= 2
        merged += index.merged
        if len(index.names) == 2:
            joined = index.repeated(index.run(index.names[0]))
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Exchange" not in plan
        with pytest.raises(ValueError, match="above"):
            index.append(batch)
        index.close()
    assert merged == 2
    want = brute(rows)
    for doc, text in rows:
        n, gone, kept = s.remove_words((text or "").encode(), marks.get(doc, np.zeros(0, np.int64)))
        assert (n, gone, kept.decode()) == want[doc]


def test_a_passage_of_all_is_combined_before_the_shuffle(spark):
    text = " ".join(f"w{k}" for k in range(60))
    docs = s._keyed(spark.createDataFrame([(k, text) for k in range(2000)], "doc_id long, text string").repartitionByRange(4, "doc_id"), "text", "doc_id")
    fresh = s.posting_rows(docs).where("NOT later")
    assert fresh.count() <= 4 * s.posting_rows(docs.limit(1)).count()


def test_empty_row_of_a_shared_id(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(1, text), (2, text), (2, ""), (2, None), (2, "a b"), (None, f"{text} {text}"), (None, None)]
    found = s.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    got = [(r.doc_id or 0, r.n_words, r.n_removed) for r in found]
    assert sorted(got) == [(0, 0, 0), (0, 60, 30), (1, 30, 30), (2, 0, 0), (2, 0, 0), (2, 2, 0), (2, 30, 30)]
