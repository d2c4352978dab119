"""Each query on a small table of odd rows against its whole contract, worked out in plain Python."""

import hashlib
import json
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

from driftline.llm import bpe, token_store
from driftline.llm.queries import QUERIES

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACES = " \t\n\x0b\x0c\r"


def words(text):
    return "".join(" " if c in SPACES else c for c in text or "").split(" ") if text else []


def split(text):
    return [w for w in words(text) if w]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    r = random.Random(12)
    word = lambda: r.choice(["the", "A", "é", "It's", "x.", "日本", "w%d" % r.randrange(60), "\x1f"])
    passage = " ".join(f"p{k}" for k in range(40))
    rows = []
    for k in range(260):
        text = r.choice([" ", "\n", "\t "]).join(word() for _ in range(r.randrange(90)))
        rows.append((k, f"{text} {passage} tail{k}" if k % 5 == 0 else text, r.choice(["a", "b", "é", "z", None])))
    rows += [(1000 + k, (rows[k][1] or "").upper(), "a") for k in range(30)] + [(2000 + k, rows[k][1], "b") for k in range(30)]
    rows += [(3000, None, None), (3001, "", "a"), (3002, " \x0b\f ", "b"), (3003, "long " * 60000 + passage, "z"), (3004, "x" * 100000, "z"), (-5, "one", "a")]
    path = tmp_path_factory.mktemp("contracts")
    extra = [(*row, "clash", 1, True) for row in rows]
    spark.createDataFrame(extra, "doc_id long, text string, source string, size string, start int, kept boolean").repartition(5).write.parquet(f"{path}/documents.parquet")
    return str(path), rows


def result(spark, table, name, columns):
    return sorted((tuple(r[c] for c in columns) for r in QUERIES[name](spark, table[0]).collect()), key=lambda r: r[0])


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


def test_op2(spark, table, library):
    start, want = 0, []
    for doc, text, _ in sorted(table[1]):
        ids = library.encode(text or "", add_special_tokens=False).ids + [1]
        want.append((doc, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert result(spark, table, "op2_token_store", ("doc_id", "start", "n_tokens", "ids_crc32")) == want


def test_op3(spark, table):
    seen, want = set(), []
    for doc, text, _ in sorted(table[1]):
        found = split(text)
        gone = [False] * len(found)
        for k in range(len(found) - 19):
            window = tuple(found[k : k + 20])
            if window in seen:
                gone[k : k + 20] = [True] * 20
            seen.add(window)
        kept = " ".join(w for w, g in zip(found, gone) if not g)
        want.append((doc, len(found), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    assert result(spark, table, "op3_substring", ("doc_id", "n_words", "n_removed", "kept_sha256")) == want
    assert sum(w[2] for w in want) > 1000


def test_op4(spark, table):
    groups = defaultdict(list)
    for doc, text, _ in table[1]:
        groups[(text or "").translate(UPPER)].append(doc)
    want = sorted((doc, max(ids), len(ids), doc == max(ids), hashlib.sha256(t.encode()).hexdigest()) for t, ids in groups.items() for doc in ids)
    assert result(spark, table, "op4_exact_dedup", ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) == want


def test_op5(spark, table):
    size, of = defaultdict(int), {}
    for doc, text, source in table[1]:
        size[source] += len(split(text))
        of[doc] = (len(split(text)), source)
    names = sorted(s for s in size if s is not None) + [None]
    weight, fixed = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}, {}
    while True:
        free = [s for s in names if s not in fixed]
        left = sum(size.values()) - sum(fixed.values())
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * size[s]]
        if not over:
            break
        fixed |= {s: 3.0 * size[s] for s in over}
    target = fixed | share
    found = result(spark, table, "op5_mixing", ("doc_id", "size", "source_size", "target", "taken"))
    assert found == result(spark, table, "op5_mixing", ("doc_id", "size", "source_size", "target", "taken"))
    taken = defaultdict(int)
    for doc, n, of_source, aim, got in found:
        assert (n, of_source) == (of[doc][0], size[of[doc][1]]) and abs(aim - target[of[doc][1]]) < 1e-6 * max(1, aim)
        assert 0 <= got <= 3 * n
        taken[of[doc][1]] += got
    for s in names:
        assert abs(taken[s] - target[s]) <= 2 * 17 * -(-size[s] // (1 << 18)), s


def test_op8(spark, table, library):
    want = []
    for doc, text, _ in sorted(table[1]):
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want.append((doc, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert result(spark, table, "op8_bpe", ("doc_id", "n_tokens", "ids_sha256", "decoded_sha256")) == want


def test_op9(spark, table):
    prints = {}
    for doc, text, _ in table[1]:
        found = [w.translate(UPPER) for w in split(text)]
        shingles = [" ".join(found[k : k + 3]) for k in range(len(found) - 2)] or ([" ".join(found)] if found else [])
        hashes = np.array([xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles], np.uint64)
        bits = [int(((hashes >> np.uint64(b)) & np.uint64(1)).sum()) for b in range(64)]
        prints[doc] = sum(1 << b for b in range(64) if 2 * bits[b] > len(hashes))
    docs = sorted(prints)
    group = {d: d for d in docs}
    for a in docs:
        for b in docs:
            if a < b and (prints[a] ^ prints[b]).bit_count() <= 2 and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = {d: low if g == high else g for d, g in group.items()}
    want = [(d, f"{prints[d]:016x}", group[d]) for d in docs]
    assert result(spark, table, "op9_simhash", ("doc_id", "fingerprint", "component_id")) == want


@pytest.mark.parametrize("name", ["op2_token_store", "op3_substring", "op4_exact_dedup", "op5_mixing", "op8_bpe", "op9_simhash"])
def test_no_rows(spark, tmp_path, name):
    spark.createDataFrame([], "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    assert QUERIES[name](spark, str(tmp_path)).collect() == []


def test_other_vocabularies_go_to_the_library_whole_or_are_refused():
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["Hello  World.", "", " a\n\nb é日 <|endoftext|> x"]
    want = Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)
    assert [np.frombuffer(x, "<i4").tolist() for x in token_store.Encoder(path)(texts)] == [w.ids for w in want]
    with pytest.raises(ValueError, match="normalise"):
        bpe.Vocabulary(path)
    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        assert bpe.word_pieces(json.load(f))
