import random

import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from regionflow.llm import sentencepiece_codec as sc

PATH = sc.default_model()
SP = sentencepiece.SentencePieceProcessor(model_file=PATH)
C = sc.codec(PATH)
TEXTS = ["", " ", "  ", "a", " a", "a ", "a  b   c", "\n", "\n\n \n", "x\ty\r\n", "▁x ▁", "<s></s><unk><0x0A>", "\x00\x01", "é́", "日本語のテキスト", "😀👩‍👩‍👧", " ﻿ ", "aaaaaaaaaaaaaaaaaaaaaaaaa", "                                  x"]


def same(text):
    ids = SP.encode(text)
    assert C.encode(text).tolist() == ids, text
    assert C.decode(ids) == SP.decode(ids), text


def test_given_texts():
    for t in TEXTS:
        same(t)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=60) | st.text(alphabet="aeinorst \n.▁hABC!é", max_size=80))
def test_any_text(text):
    same(text)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 31999), max_size=30) | st.lists(st.integers(0, 300), max_size=30))
def test_decoding_any_ids(ids):
    assert C.decode(ids) == SP.decode(ids)


def test_joined_pieces():
    rng = random.Random(5)
    for _ in range(3000):
        same("".join(SP.id_to_piece(rng.randrange(259, 32000)).replace("▁", " ") for _ in range(rng.randint(1, 8))))


def test_small_store_gives_the_same(monkeypatch):
    monkeypatch.setattr(sc, "REMEMBERED", 3)
    c = sc.Codec(PATH)
    text = "the cat and the dog and the cat sat on the other mat " * 3
    assert c.encode(text).tolist() == SP.encode(text)


def test_long_chunks_are_not_remembered():
    c = sc.Codec(PATH)
    text = "short " + "ab" * 50_000 + " end"
    assert c.encode(text).tolist() == SP.encode(text) and c.encode(text).tolist() == SP.encode(text)
    assert max(map(len, c.known)) <= sc.LONGEST


def test_frames(spark):
    rows = [(1, None, "k"), (None, "", "k"), (2, "hello world", None), (2, "hello world", None), (3, "long " * 50_000, "k")]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = sc.encode(df, decoded_col="decoded").collect()
    assert sorted((r.doc_id or 0, r.ids) for r in out) == sorted((r[0] or 0, SP.encode(r[1] or "")) for r in rows)
    assert sorted(r.decoded for r in out) == sorted(r[1] or "" for r in rows)
    assert sorted(r.text for r in sc.decode(sc.encode(df)).collect()) == sorted(r[1] or "" for r in rows)
    assert sc.encode(df.limit(0)).count() == 0
