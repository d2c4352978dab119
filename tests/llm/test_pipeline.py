import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

import corpus_pipeline as c
from driftline.llm import bpe, mixing, simhash, toxicity
from driftline.llm.words import LongText, Texts, texts


def table(spark, tmp_path):
    """Documents with copies, near copies and toxic words; every toxic row is labelled."""
    r = np.random.default_rng(8)
    word = lambda: "".join(r.choice(list("abcdefghij"), 5))
    rows = []
    for k in range(400):
        words = [word() for _ in range(30 + k % 50)]
        if k % 5 == 0:
            words[3] = words[9] = "horrible"
        rows.append((k, " ".join(words), "en", f"s{k % 4}", 0))
    rows += [(1000 + k, rows[k][1].upper(), "en", "s1", 0) for k in range(1, 40)]
    rows += [(2000 + k, rows[k][1] + " zz", "en", "s2", 0) for k in range(1, 40)]
    rows += [(3000, None, None, None, None), (None, "null id words here", "en", None, 0), rows[7]]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(k, 1, int(k % 5 == 0)) for k in range(400)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return rows


def test_stages(spark, tmp_path):
    rows = table(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    made = [docs]
    for name, stage in c.STAGES:
        stage(spark, made[-1], str(tmp_path)).write.parquet(f"{tmp_path}/{name}")
        made.append(spark.read.parquet(f"{tmp_path}/{name}"))
    assert all(x.columns == docs.columns for x in made[:-1])
    clean, exact, near, mixed, encoded = ([tuple(r) for r in x.collect()] for x in made[1:])

    toxic = {r[0] for r in rows} - {r[0] for r in clean}
    real = {r[0] for r in rows if "horrible" in (r[1] or "").lower()}
    assert len(real - toxic) <= 4 and len(toxic - real) <= 4, (real - toxic, toxic - real)

    groups = defaultdict(list)
    for r in clean:
        groups[(r[1] or "").lower()].append(r)
    assert Counter(exact) == Counter(max(g, key=lambda r: -1 if r[0] is None else r[0]) for g in groups.values())

    prints = [simhash.fingerprint((r[1] or "").encode()) for r in exact]
    group = list(range(len(exact)))
    for a in range(len(exact)):
        for b in range(a):
            if (prints[a] ^ prints[b]).bit_count() <= 2 and group[a] != group[b]:
                group = [group[b] if g == group[a] else g for g in group]
    least = {}
    for r, g in zip(exact, group):
        least[g] = min([least.get(g), r[0]], key=lambda x: (x is None, x or 0))
    assert Counter(near) == Counter(r for r, g in zip(exact, group) if r[0] == least[g])

    size = defaultdict(int)
    for r in near:
        size[r[3]] += len((r[1] or "").split())
    taken = {r.doc_id: r for r in mixing.mix(made[3]).collect()}
    copies, words, aim = Counter(r[0] for r in mixed), defaultdict(int), {}
    for r in mixed:
        words[r[3]] += len((r[1] or "").split())
    for r in near:
        aim[r[3]] = taken[r[0]].target
    longest = max(len((r[1] or "").split()) for r in near)
    assert all(abs(words[s] - t) <= 2 * (17 + longest) for s, t in aim.items())
    for r in near:
        share = taken[r[0]].taken / max(1, taken[r[0]].size)
        assert int(share) <= copies[r[0]] <= int(share) + 1 or not taken[r[0]].size
    assert set(mixed) <= set(near)

    library = Tokenizer.from_file(public_tokenizers.path(bpe.VOCABULARY))
    want = Counter((r[0], tuple(library.encode(r[1] or "", add_special_tokens=False).ids)) for r in mixed)
    assert Counter((r[0], tuple(r[1])) for r in encoded) == want
    assert Counter((r.doc_id, tuple(r.ids)) for r in c.run(spark, str(tmp_path)).collect()) == want


def test_stages_with_clashing_columns(spark, tmp_path):
    table(spark, tmp_path)
    names = "score _score _id _sha _nth _found_id _found_sha _copies row name size digest copies shard fp".split()
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet").where("doc_id < 60 OR doc_id >= 3000 OR doc_id IS NULL").selectExpr("*", *[f"'x' AS {n}" for n in names])
    for name, stage in c.STAGES:
        for rows in (docs, docs.limit(0)):
            found = stage(spark, rows, str(tmp_path))
            assert name == "bpe" or found.columns == docs.columns
            assert (found.count() > 10) == (rows is docs), name


def test_toxicity_of_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, "x"), (2, "", "x"), (None, "a " * 200000, None), (2, "", "x")], "doc_id long, text string, lang string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.train_toxicity(docs, labels, ~toxicity.held_out()) is None
    assert [r.score for r in toxicity.score_toxicity(docs, None).collect()] == [0.0] * 4
    data = [f"{'bad awful' if k % 3 == 0 else 'fine'} w{k} x y".encode() for k in range(90)]
    model = toxicity.fit(data, np.array([int(k % 3 == 0) for k in range(90)]), ["en", None, "de"] * 30)
    found = toxicity.score_toxicity(docs, model).collect()
    assert len(found) == 4 and all(0 <= r.score <= 1 for r in found)
    assert toxicity.score_toxicity(docs.limit(0), model).collect() == []
    whole = toxicity.score_toxicity(spark.createDataFrame([(k, d.decode()) for k, d in enumerate(data)], "doc_id long, text string").repartition(3), model)
    # the same by a plain convolution, word by word and place by place; long texts in parts score as in one piece
    for d in [*data[:20], b"", b"bad", b"x y", b" ".join(data[:30])]:
        found = Texts(toxicity._LETTERS[np.frombuffer(d, np.uint8)], np.array([0, len(d)]), toxicity._SPACE)
        buckets = toxicity._buckets(found)
        vectors = [sum(model.embeddings[b] for b in row) for row in buckets] + [np.zeros(toxicity.DIMENSIONS)] * 3
        pooled = []
        for width, weights in model.filters.items():
            for f in range(weights.shape[2]):
                at = [model.biases[width][f] + sum(vectors[p + k] @ weights[k, :, f] for k in range(width)) for p in range(len(buckets) + 1)]
                pooled.append(max(0, *at))
        language = int(np.argmax([sum(model.languages[b[0], k] for b in buckets) for k in range(model.languages.shape[1])]))
        logit = np.dot(pooled, model.last) + model.bias + model.shifts[language]
        assert abs(float(model.scores(found)[0]) - 1 / (1 + np.exp(-logit))) < 1e-4
        if not d:
            continue
        long = LongText(found.data, toxicity._SPACE)
        long.parts = lambda overlap, own=long.parts: own(overlap, 20)
        assert abs(float(model.scores(long)[0]) - float(model.scores(found)[0])) < 1e-5
    one = {k: float(model.scores(f)[0]) for k, d in enumerate(data) for _, _, f in texts(toxicity.pa.array([d], toxicity.pa.binary()), 1 << 20, toxicity._SPACE, toxicity._LETTERS)}
    assert all(abs(r.score - one[r.doc_id]) < 1e-5 for r in whole.collect())


def test_toxicity_query(spark, tmp_path):
    rows = table(spark, tmp_path)
    docs = spark.read.parquet(f"{tmp_path}/documents.parquet")
    docs.selectExpr("*", "'x' AS score", "1 AS held_out").repartition(3).write.parquet(f"{tmp_path}/b/documents.parquet")
    spark.read.parquet(f"{tmp_path}/labels.parquet").repartition(2).write.parquet(f"{tmp_path}/b/labels.parquet")
    found = [sorted(map(tuple, toxicity.op1_toxicity(spark, str(d)).collect()), key=str) for d in (tmp_path, tmp_path / "b")]
    assert [(a[0], a[1], a[3], round(a[2], 5)) for a in found[0]] == [(a[0], a[1], a[3], round(a[2], 5)) for a in found[1]]
    assert len(found[0]) == len(rows)
    real = {r[0] for r in rows if "horrible" in (r[1] or "").lower()}
    wrong = 0
    for doc, held, score, predicted in found[0]:
        assert held == (doc is not None and zlib.crc32(str(doc).encode()) % 4 == 2)
        assert predicted == int(score >= 0.3) and 0 <= score <= 1
        wrong += held and predicted != (doc in real)
    assert wrong <= 3


def test_thresholds_by_language():
    data = [f"{'bad awful' if k % 3 == 0 else 'fine'} {'le la les' if k // 4 % 2 else 'the of and'} w{k} x y".encode() for k in range(240)]
    labels = np.array([int(k % 3 == 0) for k in range(240)])
    model = toxicity.fit(data, labels, ["fr" if k // 4 % 2 else "en" for k in range(240)])
    found = Texts(np.frombuffer(b"".join(data), np.uint8), np.cumsum([0, *map(len, data)]), toxicity._SPACE)
    assert (model.language(toxicity._buckets(found), found.first) == np.arange(240) // 4 % 2).mean() > 0.95
    logits = model.logits(toxicity._buckets(found), found.first)
    test = np.arange(240) % toxicity.CALIBRATE_EVERY == 0
    for k in range(2):
        own = test & (np.arange(240) // 4 % 2 == k)
        f1 = lambda cut: 2 * (labels[own] & (logits[own] >= cut)).sum() / max(1, labels[own].sum() + (logits[own] >= cut).sum())  # noqa: B023, E731
        cut = np.log(toxicity.PREDICT_FROM / (1 - toxicity.PREDICT_FROM)) - model.shifts[k]
        assert f1(cut) >= max(f1(x) for x in logits[own]) - 1e-9
