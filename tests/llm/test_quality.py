import math
import random
import re

import numpy as np

from driftline.llm import quality as q
from driftline.llm import words


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    at = {}
    for k in range(len(words) - 7):
        at.setdefault(tuple(words[k : k + 8]), []).append(k)
    marked = {j for ks in at.values() if len(ks) > 1 for k in ks for j in range(k, k + 8)}
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(marked)


def lines_with_a_word(text):
    return sum(bool(re.search(r"[^\x20\x09-\x0D]", x)) for x in (text or "").split("\n"))


def test_counts(spark):
    r = random.Random(3)
    made = lambda n: "".join(r.choice(["a ", "b ", "é", "x#", "|", "\n", "\t", "the end ", "\x1f", "日 "]) for _ in range(n))
    rows = [(k, made(r.randrange(120)) * r.choice([1, 1, 2]), "en", "s") for k in range(300)]
    rows += [(400, None, None, None), (401, "", "en", "s"), (402, "w " * 100000, "en", "s"), (None, "x y", "en", "s"), (403, "a\n a\na\n\n\n", "en", "s")]
    found = q.text_statistics(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()
    assert {r.doc_id: tuple(r)[3:] for r in found} == {k: (*brute(t), lines_with_a_word(t)) for k, t, _, _ in rows}


def test_long_texts_in_parts(monkeypatch):
    r = random.Random(9)
    for size in (40, 200, 1 << 20):
        monkeypatch.setattr(words, "LONG_BYTES", size)
        for _ in range(60):
            text = " ".join(r.choice(["a", "b", "ccc", "d" * 70]) for _ in range(r.randrange(60)))
            assert q.repeated_words(text.encode()) == brute(text)[4]


ERRORS = np.array([1, 1 / 4, 1 / 4, 1 / 4, 2])


def features(text):
    """Features and counting errors of a text in plain Python, on the grid."""
    n, chars, symbols, lines, repeats = brute(text)
    filled = max(lines_with_a_word(text), 1)
    x = [math.log1p(n), math.sqrt(min(chars / n, 64)), math.sqrt(min(symbols / n, 64)), math.sqrt(lines / filled), math.sqrt(repeats / n)]
    by_words, by_lines = (math.floor(256**3 / v + 0.5) / 256 for v in (n, filled))
    return [math.floor(v * 256 + 0.5) for v in x], ERRORS * [by_words, by_words, by_words, by_lines, by_words]


def moments(x, e):
    spread = np.cov(x.T, bias=True)
    return x.mean(axis=0), spread, e.mean(axis=0), spread + np.diag(e.mean(axis=0) + 1 / 12)


def plain_search(x, e, rows):
    """Concentration steps from the subset ``rows`` until the determinant falls no more."""
    best, determinants = None, []
    while True:
        centre, spread, error, whole = moments(x[rows], e[rows])
        determinant = np.linalg.slogdet(whole)[1]
        if best is not None and determinant >= best[0] - q.LEAST_FALL and len(determinants) > q.FIRST_STEPS:
            return best, determinants
        best = (determinant, centre, spread, error)
        determinants.append(determinant)
        inverse = np.linalg.inv(whole)
        d = np.einsum("ij,jk,ik->i", x - centre, inverse, x - centre) + e @ np.diag(inverse)
        d = np.round(256 * np.log1p(d))
        rows = d <= np.quantile(d, q.SUBSET)


def distances(best, x, e):
    _, centre, spread, error = best
    inverses = [np.linalg.inv(q.CONSISTENCY * spread + np.diag(np.maximum(error, own) + 1 / 12)) for own in e]
    return np.array([(row - centre) @ inverse @ (row - centre) for row, inverse in zip(x, inverses)])


def mixed_texts():
    r = random.Random(6)
    rows = [(k, "\n".join(" ".join("x" * r.randrange(1, 9) + r.choice(["", "", "#"]) for _ in range(r.randrange(5, 30))) for _ in range(r.randrange(4, 9)))) for k in range(300)]
    return rows + [(1000 + k, " ".join("y" * r.randrange(6, 14) + "#|#" for _ in range(r.randrange(30, 60)))) for k in range(60)]


def test_distances_as_of_a_plain_search(spark):
    rows = mixed_texts()
    docs = spark.createDataFrame([(*x, "en", "s") for x in rows], "doc_id long, text string, lang string, source string")
    statistics = q.text_statistics(docs)
    fit = statistics.selectExpr("lang AS g_lang", "source AS g_source", "*").select("g_lang", "g_source", *q._features())
    starts = {}
    for row in q._first_subsets(fit).collect():
        starts.setdefault(row.start, []).append([row[name] for name in q._X])
    assert len(starts) == q.STARTS and all(3 <= len(subset) <= 6 for subset in starts.values())
    made = [features(t) for _, t in rows]
    x, e = np.array([m[0] for m in made], float), np.array([m[1] for m in made])
    found = []
    for subset in starts.values():
        best, determinants = plain_search(x, e, [int(np.flatnonzero((x == row).all(axis=1))[0]) for row in subset])
        found.append(best)
        after = determinants[1:]  # those of three quarters of the rows
        assert after == sorted(after, reverse=True)
    best = min(found, key=lambda b: b[0])
    parameters = q.least_determinant(fit).collect()
    assert len(parameters) == 1 and abs(parameters[0].logdet - best[0]) < 1e-6
    # other subsets lead no lower
    r = np.random.default_rng(8)
    tried = [plain_search(x, e, r.choice(len(x), 6, False))[0][0] for _ in range(100)]
    assert best[0] <= min(tried) + 0.01
    want = distances(best, x, e)
    judged = {f.doc_id: f for f in q.robust_outliers(statistics).collect()}
    assert np.allclose([judged[k].distance for k, _ in rows], want, rtol=1e-6)
    assert [judged[k].kept for k, _ in rows] == (want <= q.CHI2_LIMIT).tolist()
    assert not any(judged[1000 + k].kept for k in range(60)) and sum(not judged[k].kept for k in range(300)) <= 5


def test_no_step_lessens_what_is_found(spark):
    """Several groups at once, some of equal rows alone, copies and ties."""
    r = random.Random(12)
    rows = [(k, 20 + r.randrange(400), r.choice("ab"), r.choice(["s", None])) for k in range(900)]
    stats = [(k, n, n * 5 + r.randrange(40), r.choice([0, 0, 0, 3]), 0, 0, 5, lang, source) for k, n, lang, source in rows]
    stats += [(2000 + k, 50, 250, 0, 0, 0, 3, "same", "s") for k in range(60)] + [(3000, 50, 250, 90, 0, 0, 3, "same", "s")]
    names = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, lang string, source string"
    statistics = spark.createDataFrame(stats, names)
    fit = q.materialise(statistics.selectExpr("lang AS g_lang", "source AS g_source", "*").select("g_lang", "g_source", *q._features()), "fit")
    best = q.least_determinant(fit)
    found = {(x.g_lang, x.g_source): x.logdet for x in best.collect()}
    assert set(found) == {("a", "s"), ("b", "s"), ("a", None), ("b", None), ("same", "s")}
    again = q._concentrated(fit, best, "again").collect()
    assert len(again) == 5 and all(x.logdet >= found[x.g_lang, x.g_source] - q.LEAST_FALL for x in again)
    judged = {x.doc_id: x for x in q.robust_outliers(statistics).collect()}
    assert all(judged[2000 + k].kept for k in range(60)) and not judged[3000].kept and judged[3000].far_in == "symbols_a_word"
    assert {x: judged[x].distance for x in judged} == {x.doc_id: x.distance for x in q.robust_outliers(statistics.repartition(5)).collect()}
    clashing = statistics.selectExpr("*", "'a' AS x0", "1.5 AS centre", "named_struct('k', doc_id) AS e0", "'b' AS g_lang", "false AS base_failed", "7 AS start")
    found = q.robust_outliers(clashing).collect()
    assert {x.doc_id: x.distance for x in found} == {x: judged[x].distance for x in judged}
    assert all((x.x0, float(x.centre), x.e0.k, x.g_lang, x.start) == ("a", 1.5, x.doc_id, "b", 7) for x in found)


def test_query(spark, tmp_path):
    r = random.Random(7)
    rows = [(k, " ".join(r.choice(["a", "bb", "c#", "é\n", "the same eight words as all the others"]) for _ in range(r.randrange(60))), r.choice(["en", None]), r.choice(["s", "t", None])) for k in range(300)]
    rows += [(None, None, None, None), (3, rows[3][1], "en", "s"), (900, "", "en", "s")]
    spark.createDataFrame([(*x, "clash", True) for x in rows], "doc_id long, text string, lang string, source string, n_words string, kept boolean").write.parquet(f"{tmp_path}/documents.parquet")
    found = q.op7_quality(spark, str(tmp_path)).collect()
    want = []
    for k, text, _, _ in rows:
        n = brute(text)
        want.append((k, *n, n[0] < 20 or 100 * n[4] > 30 * n[0]))
    assert sorted((tuple(x)[:7] for x in found), key=str) == sorted(want, key=str)
    assert not any(x.kept and x.base_failed for x in found) and any(x.kept for x in found)


def test_verdicts(spark):
    r = random.Random(4)
    rows = []
    for k in range(1500):
        words = [r.choice("aeiou") * r.randrange(2, 9) + str(r.randrange(999)) for _ in range(int(r.lognormvariate(5, 0.6)) + 20)]
        rows.append((k, " ".join(words), "en", "big"))
    for k in range(200):  # a cluster that would mask itself in plain means
        rows.append((2000 + k, " ".join(f"|x{r.randrange(9999)}#|" + "#" * 40 for _ in range(200)), "en", "big"))
    rows += [(3000 + k, " ".join(f"w{r.randrange(9999)}" for _ in range(300)), None, f"small{k}") for k in range(5)]
    rows += [(4000, "too short", "en", "big"), (4001, "a b c d e f g h i j " * 40, "en", "big"), (4002, None, "en", None)]
    docs = spark.createDataFrame([(*x, 0.5, 7) for x in rows], "doc_id long, text string, lang string, source string, distance double, n long")
    found = {r.doc_id: r for r in q.robust_outliers(q.text_statistics(docs)).collect()}
    assert len(found) == len(rows)
    assert sum(not found[k].kept for k in range(1500)) <= 3
    assert not any(found[2000 + k].kept for k in range(200))
    assert all(found[3000 + k].kept for k in range(5))
    assert [found[k].base_failed for k in (4000, 4001, 4002)] == [True] * 3 and not any(found[k].kept for k in (4000, 4001, 4002))


def test_every_other_word_a_bar(spark):
    r = random.Random(5)
    word = lambda least=2, most=8: "".join(r.choice("aeioust") for _ in range(r.randint(least, most)))
    rows = [(k, " ".join(word() for _ in range(int(r.lognormvariate(5, 0.6)) + 20)), "en", "big") for k in range(1000)]
    rows += [(2000 + k, " | ".join(word(6, 12) for _ in range(r.randrange(60, 200))), "en", "big") for k in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    found = {x.doc_id: x.kept for x in q.robust_outliers(q.text_statistics(docs)).collect()}
    assert sum(not found[k] for k in range(1000)) <= 5
    assert not any(found[2000 + k] for k in range(40))


def test_no_rows(spark):
    assert q.robust_outliers(q.text_statistics(spark.createDataFrame([], "doc_id long, text string, lang string, source string"))).collect() == []
