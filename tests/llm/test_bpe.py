import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from hirelake.llm import bpe
from hirelake.llm.queries import QUERIES
from tests.llm.conftest import FOLDER, LONG

PATH = public_tokenizers.path("byte_bpe_50k.json")
POOLS = ["ab \n", "aeiou thinr'sdlvm", "  \t\n\r\x0b\x1c\x1f\x85\xa0 　aé1٣!,._'", " .,-=#*0123456789",
         "abc<|endoftext|>", "日本語😀é̈İßﬁ٣¼²𐐷"]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def ids_of(raw):
    return np.frombuffer(raw, "<u4").tolist()


def test_random_texts_equal_the_library(tokenizer):
    draw, codec, back = random.Random(7), bpe.Encoder(PATH), bpe.Decoder(PATH)
    for k in range(20_000):
        if k % 5:
            text = "".join(draw.choice(draw.choice(POOLS)) for _ in range(draw.randrange(30)))
        else:  # any characters, also those that no version of Unicode knows
            codes = [draw.choice([draw.randrange(1, 0xD800), draw.randrange(0xE000, 0x110000)]) for _ in range(8)]
            text = "".join(map(chr, codes))
        text = f"{text}<|endoftext|> {text}" if k % 50 == 0 else text
        expected = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids_of(codec.encode(text)) == expected
        assert back.decode(codec.encode(text)) == tokenizer.decode(expected, skip_special_tokens=False)


def test_long_words(tokenizer):
    draw, codec = random.Random(8), bpe.Encoder(PATH)
    for text in ("a" * 50_000, "".join(draw.choice("abcdefgh") for _ in range(50_000)), "=" * 3_001, "é" * 2_000):
        assert ids_of(codec.encode(text)) == tokenizer.encode(text, add_special_tokens=False).ids


def test_forgetting_changes_nothing(tokenizer, monkeypatch):
    monkeypatch.setattr(bpe, "KEPT_WORDS", 3)
    monkeypatch.setattr(bpe, "KEPT_PAIRS", 3)
    codec = bpe.Encoder(PATH)
    text = "the quick brown fox jumps over the lazy dog, again and again " * 3
    assert ids_of(codec.encode(text)) == tokenizer.encode(text, add_special_tokens=False).ids


def test_any_ids_decode_alike(tokenizer):
    draw, codec = random.Random(9), bpe.Decoder(PATH)
    for _ in range(500):
        ids = [draw.randrange(50_300) for _ in range(6)]  # broken characters, and numbers of no token
        raw = np.array(ids, "<u4").tobytes()
        assert codec.decode(raw) == tokenizer.decode(ids, skip_special_tokens=False)


def test_other_tokenizers_are_refused():
    with pytest.raises(ValueError):
        bpe.Encoder(public_tokenizers.path("word_bpe_49k.json"))


def test_odd_rows(odd, clashing, none, tokenizer):
    rows = bpe.decoded(bpe.encoded(odd, PATH), PATH).collect()
    assert len(rows) == odd.count()
    for row in rows:
        text = row["text"] or ""
        assert ids_of(row["ids"]) == tokenizer.encode(text, add_special_tokens=False).ids
        assert row["decoded"] == text
    assert any(row["text"] == LONG for row in rows)
    wide = bpe.encoded(clashing, PATH, keep_text=False)
    assert set(wide.columns) == set(clashing.columns) - {"text"}
    assert all(isinstance(r["ids"], (bytes, bytearray)) for r in wide.collect())
    assert bpe.encoded(none, PATH).count() == 0


def test_query_equals_the_library(spark, given, tokenizer):
    texts = {r["doc_id"]: r["text"] or "" for r in given("documents").collect()}
    rows = QUERIES["op11_bpe_round_trip"](spark, FOLDER).collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = tokenizer.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        back = tokenizer.decode(ids, skip_special_tokens=False)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()
