import re
import sys
import time
import unicodedata
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from driftline.llm import common
from driftline.llm import token_store as t
from driftline.llm.bpe import vocabulary

PATH = public_tokenizers.path(t.VOCABULARY)


def test_round_trip(spark, tmp_path):
    rows = [(k, f"text {k} " * (k % 7), "x") for k in range(50)] + [(3, None, "y"), (None, "no id", "z"), (7, "", "x"), (60, "long " * 30000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    t.write_store(t.encode(docs, PATH), f"{tmp_path}/store")
    found = sorted(t.read_store(spark, f"{tmp_path}/store").collect(), key=lambda r: r.start)
    library, start = Tokenizer.from_file(PATH), 0
    for row, (doc_id, text, _) in zip(found, sorted(rows, key=lambda r: (-1 if r[0] is None else r[0], r[1] or ""))):
        assert (row.doc_id, row.start, row.n_tokens) == (doc_id, start, len(row.ids))
        assert list(row.ids) == library.encode(text or "", add_special_tokens=False).ids + [t.END_ID]
        start += row.n_tokens
    sums = {r.start: r.ids_crc32 for r in t.ids_crc32(t.read_store(spark, f"{tmp_path}/store")).collect()}
    assert sums == {r.start: zlib.crc32(np.array(r.ids, "<u4").tobytes()) for r in found}


def test_every_character():
    texts = [f"a{chr(c)}b {chr(c)}'s x{chr(c)}. {chr(c)}" for c in range(sys.maxunicode + 1) if unicodedata.category(chr(c)) not in ("Cn", "Cs", "Co", "Lo")]
    texts += ["", " ", "<|endoftext|> a", "ΑΣ. Σ", "a\x1cb", "İ ß. é.", "'s. a'. 5. x.y ,"]
    want = Tokenizer.from_file(PATH).encode_batch_fast(texts, add_special_tokens=False)
    for text, ids, row in zip(texts, t.encoder(PATH)(texts), want):
        assert np.frombuffer(ids, "<i4").tolist() == row.ids, repr(text)


def test_generations():
    """With a memory of a few chunks, which begins anew again and again, ids stay the same."""
    ask = t.Encoder(PATH)
    ask.known.most = 3
    texts = [f"word{k % 7} some other{k % 3}. Words {k}" for k in range(60)]
    want = Tokenizer.from_file(PATH).encode_batch_fast(texts, add_special_tokens=False)
    assert [np.frombuffer(x, "<i4").tolist() for k in range(0, 60, 2) for x in ask(texts[k : k + 2])] == [w.ids for w in want]
    known = vocabulary(PATH)
    most, known.encoded.most = known.encoded.most, 3
    assert [memoryview(known.encode(x)).cast("i").tolist() for x in texts] == [w.ids for w in want]
    known.encoded.most = most


def test_metadata_alone(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, "c")], "doc_id long, text string")
    t.write_store(t.encode(docs, PATH), f"{tmp_path}/store")
    found = t.read_store(spark, f"{tmp_path}/store", ("n_tokens",))
    assert "ids" not in found._jdf.queryExecution().executedPlan().toString().split("ReadSchema")[1].split(">")[0]
    assert sorted(map(tuple, found.collect())) == [(1, 0, 3), (2, 3, 2)]


def test_no_rows(spark, tmp_path):
    t.write_store(t.encode(spark.createDataFrame([], "doc_id long, text string"), PATH), f"{tmp_path}/store")
    assert t.ids_crc32(t.read_store(spark, f"{tmp_path}/store")).collect() == []


def test_letters_before_signs():
    signs = [chr(c) for c in range(33, 127) if not chr(c).isalnum()]
    texts = [f"{x}{a}{b} {a}{x}{b} {x}{a}{x}" for x in ("a", "thing", "it", "don", "A", "é", "x1") for a in signs for b in (*signs, "###", "%%%", "s", "'t")]
    assert [np.frombuffer(x, "<i4").tolist() for x in t.Encoder(PATH)(texts)] == [x.ids for x in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]


def test_stops_are_found_fast():
    """As by a pattern that looks at every place, in less than half its time."""

    def took(f, text):
        times = []
        for _ in range(3):
            began = time.thread_time()
            f(text)
            times.append(time.thread_time() - began)
        return min(times)

    plain = re.compile(r"(?<=[A-Za-z])(?=[.,](?:\s|\Z))", re.ASCII)
    odd = ["a. b, c", "a., b,. c", "a.", "b,", ".a, é. é, 1. x.\n y,\x1c z.\u00a0 a..", "", ".", "a.b,c"]
    assert [common.set_off_stops(x) for x in odd] == [plain.sub(" ", x) for x in odd]
    text = "some words without end, and more of them. " * 20000
    assert took(common.set_off_stops, text) < took(lambda x: plain.sub(" ", x), text) / 2


def test_what_the_library_is_asked_for():
    """Only what is neither letters alone nor letters before signs goes through the whole library."""
    asked, encoder = [], t.Encoder(PATH)
    whole = encoder._whole
    encoder._whole = lambda texts: asked.extend(texts) or whole(texts)
    encoder(["word thing### it's other%%%. x1 a"])
    assert sorted(asked) == ["it's", "x1"]
