import itertools
import random
import zlib

import numpy as np
import pyarrow.parquet as pq
import pytest

from hirelake.llm import packing, token_files
from hirelake.llm.queries import QUERIES
from hirelake.llm.tokens import Encoder, _tokenizer, vocabulary

from .conftest import FOLDER, ODD

TEXTS = ["", None, "a  b", " a", "a ", "\n\n a\n b  \n", "It's THE İstanbul", "é" * 50 + " é ́", "don't'll 123 4,5 ...,",
         "x" * 5000, "\t a \t b", "  ", "ΣΑΣ Σ", "日本語 テキスト 😀", "a\x85b c\x00d", "a,b. c_, d.e", "<|endoftext|> hi",
         "end.\n\nnew para, x", "tab\tsep. \n y", "foo,\n bar"]


def plain(name, text):
    return _tokenizer(vocabulary(name)).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_tokenizer(name, given):
    texts = TEXTS + [r["text"] for r in given("documents").select("text").collect()]
    found = Encoder(vocabulary(name)).encode(texts)
    assert [np.frombuffer(i, "<u4").tolist() for i in found] == [plain(name, t) for t in texts]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_random_texts(name):
    draw, encoder = random.Random(11), Encoder(vocabulary(name))
    pools = ["ab \n", ".,a 5", "aeiou thinr'sdlvm", "  \t\n\r\x0b\x1c\x1f\x85\xa0\u2003\u3000aé1٣!,._'",
             " .,-=#*0123456789", "日本語😀é̈İßﬁ٣¼²𐐷", "aAÉéİİKΣσς́ ,."]
    texts = ["a , b", "a .b", " .5", "é\n\n.\x1c", "İ,", "日!\x1c,", "本b\n\n,aA"]
    for k in range(25_000):
        pool = draw.choice(pools)
        if k % 5:
            texts.append("".join(draw.choice(pool if k % 3 else draw.choice(pools)) for _ in range(draw.randrange(40))))
        else:
            codes = [draw.choice([draw.randrange(1, 0xD800), draw.randrange(0xE000, 0x110000)]) for _ in range(9)]
            texts.append("".join(map(chr, codes)))
    for at in range(0, len(texts), 1_000):
        found = encoder.encode(texts[at : at + 1_000])
        assert [np.frombuffer(i, "<u4").tolist() for i in found] == [plain(name, t) for t in texts[at : at + 1_000]]


def test_encoder_forgets_without_harm(monkeypatch):
    from hirelake.llm import tokens

    monkeypatch.setattr(tokens, "KEPT_PIECES", 5)
    one = Encoder(vocabulary("byte_bpe_50k.json"))
    for _ in range(3):
        found = one.encode(["a b c d e f g h", "h i j k l m n o p", "a b"])
        assert [np.frombuffer(i, "<u4").tolist() for i in found] == [
            plain("byte_bpe_50k.json", t) for t in ("a b c d e f g h", "h i j k l m n o p", "a b")
        ]


def test_every_neighbourhood_of_kinds():
    encoder, signs = Encoder(vocabulary("byte_bpe_50k.json")), [" ", "\n", "\u3000", "a", "é", "1", "٣", "!", "—", "'", "s"]
    texts = ["".join(t) for n in range(5) for t in itertools.product(signs, repeat=n)]
    lengths, ids = encoder.flat([t.encode() for t in texts], np.array([7], "<u4").tobytes())
    wanted = [plain("byte_bpe_50k.json", t) + [7] for t in texts]
    assert lengths.tolist() == [len(w) for w in wanted] and ids.tolist() == [i for w in wanted for i in w]
    assert [len(x) for x in encoder.flat([])] == [0, 0]
    assert [x.tolist() for x in encoder.flat([None, b"", None])] == [[0, 0, 0], []]


def test_words_are_learnt_once_whatever_signs_touch_them():
    encoder = Encoder(vocabulary("byte_bpe_50k.json"))
    text = " ".join(f"{a}wordly{b}" for a in ("", "(", "„", "12") for b in ("", "!", "%%%", "***", ".”", "34"))
    for _ in range(2):
        assert np.frombuffer(encoder.encode([text])[0], "<u4").tolist() == plain("byte_bpe_50k.json", text)
    assert len([piece for piece in encoder.kept if "wordly" in str(piece)]) == 2 and len(encoder.kept) < 20


def check_packed(pieces, wanted, window):
    """``wanted``: (doc_id, ids) of every row; pieces of equal documents may be mixed up."""
    left = {}
    for number, ids in wanted:
        left.setdefault((number, len(ids)), []).append(ids)
    by = {}
    for p in pieces:
        by.setdefault((p["doc_id"], p["doc_tokens"]), []).append(p)
    assert {k: sum(len(i) for i in v) for k, v in left.items()} == {
        k: sum(len(p["ids"]) // 4 for p in v) for k, v in by.items()
    }
    for key, own in by.items():
        for ids in left[key]:
            at = 0
            while at < len(ids):
                p = next(p for p in own if p["start"] == at and np.frombuffer(p["ids"], "<u4").tolist() == ids[at : at + len(p["ids"]) // 4])
                own.remove(p)
                at += len(p["ids"]) // 4
        assert not own
    sequences = {}
    for p in pieces:
        sequences.setdefault(p["sequence_id"], []).append((p["offset"], len(p["ids"]) // 4))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window and at & (at - 1) == 0
    return sequences


@pytest.mark.parametrize("window", [16, 4096])
def test_packing(odd, window):
    pieces = packing.pack(odd, window=window, open_windows=3).collect()
    wanted = [(r[0], plain("word_bpe_49k.json", r[1]) + [2]) for r in ODD]
    sequences = check_packed(pieces, wanted, window)
    full = sum(1 for s in sequences.values() if sum(n for _, n in s) == window)
    assert len(sequences) - full <= 64 * 20


def test_packing_of_given_documents(spark, given):
    docs = given("documents").collect()
    pieces = packing.pack(given("documents").repartition(5)).collect()
    sequences = check_packed(pieces, [(d["doc_id"], plain("word_bpe_49k.json", d["text"]) + [2]) for d in docs], 4096)
    lengths = [sum(n for _, n in s) for s in sequences.values()]
    assert lengths.count(4096) >= len(lengths) - 13
    rows = QUERIES["op4_pack_windows"](spark, FOLDER).collect()
    assert sum(r["length"] for r in rows) == sum(lengths)
    whole = {d["doc_id"]: plain("word_bpe_49k.json", d["text"]) + [2] for d in docs}
    for r in rows:
        ids = np.array(whole[r["doc_id"]][r["start"] : r["start"] + r["length"]], "<u4")
        assert (r["ids_crc32"], r["doc_tokens"]) == (zlib.crc32(ids.tobytes()), len(whole[r["doc_id"]]))


def test_packing_empty_and_clashing(none, clashing):
    assert packing.pack(none).collect() == []
    assert {r["doc_id"] for r in packing.pack(clashing).collect()} == {r[0] for r in ODD}
    with pytest.raises(ValueError):
        packing.pack(none, window=100)


def test_token_files(spark, odd, clashing, none, tmp_path):
    for name, docs in (("odd", odd), ("clashing", clashing)):
        path = str(tmp_path / name)
        token_files.write_token_files(docs, path, page_rows=2)
        rows = sorted(token_files.read_tokens(spark, path).collect(), key=lambda r: r["start"])
        wanted = sorted(((r[0] is not None, r[0] or 0), r[1] is not None, r[1] or "") for r in ODD)
        assert [r["doc_id"] for r in rows] == [n if known else None for (known, n), _, _ in wanted]
        at = 0
        for r, (_, _, text) in zip(rows, wanted):
            ids = plain("byte_bpe_50k.json", text) + [0]
            assert (r["start"], r["n_tokens"], list(r["ids"])) == (at, len(ids), ids)
            at += len(ids)
        selected = token_files.read_tokens(spark, path, 4, 5).collect()
        assert sorted(r["doc_id"] for r in selected) == [4, 5, 5]
        plan = token_files.read_metadata(spark, path)._jdf.queryExecution().executedPlan().toString()
        assert "ids" not in plan
    token_files.write_token_files(none, str(tmp_path / "none"))
    assert token_files.read_tokens(spark, str(tmp_path / "none")).collect() == []


def test_encodings_and_indexes(odd, tmp_path):
    path = tmp_path / "files"
    token_files.write_token_files(odd, str(path))
    seen = {}
    for file in path.glob("*.parquet"):
        group = pq.ParquetFile(file).metadata
        for k in range(group.num_row_groups):
            for c in range(group.num_columns):
                column = group.row_group(k).column(c)
                seen.setdefault(column.path_in_schema.split(".")[0], set()).update(column.encodings)
                assert column.has_offset_index and column.has_column_index
    assert "RLE_DICTIONARY" in seen["ids"]
    assert "DELTA_BINARY_PACKED" in seen["doc_id"] and "DELTA_BINARY_PACKED" in seen["part_start"]


def test_token_query(spark, given):
    rows = QUERIES["op5_token_files"](spark, FOLDER).orderBy("doc_id").collect()
    at = 0
    for r, d in zip(rows, given("documents").orderBy("doc_id").collect(), strict=True):
        ids = plain("byte_bpe_50k.json", d["text"]) + [0]
        assert (r["doc_id"], r["start"], r["n_tokens"]) == (d["doc_id"], at, len(ids))
        assert r["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        at += len(ids)
