"""Byte-pair encoding by dynamic programming over prefixes, and decoding.

A text's encoding is the only sequence of tokens in which every two neighbours belong together: merging
them anew from their bytes gives the same two tokens. So every prefix has one last token: of the tokens
that end there, the one that fits behind the last token of the prefix before it. An automaton over all
tokens reports those that end at each place; a test of the pair looks for a merge across the seam that
would come earlier than the merges on both sides. Following the last tokens back gives the ids. The work
is linear in the length of a word, whatever it is made of.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.llm.common import some_rows, spare

# Remembered by a worker; it starts anew when there are more, which changes no result.
KEPT_WORDS, KEPT_PAIRS = 1 << 18, 1 << 18
LONGEST_KEPT = 64
NEVER = 1 << 40  # later than any merge

# Characters with the property White_Space, and how byte-level tokenizers cut texts.
SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+"
PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes shown as themselves, others from 256 on
LETTER, NUMBER, SIGN, SPACE = "A0!\t"

# White space before a word and the word: no piece goes beyond the end of a word.
_WORD = re.compile(f"[{SPACES}]*[^{SPACES}]+|[{SPACES}]+")
_PIECE = re.compile(CUT, re.ASCII)
_SYMBOL_OF = {b: chr(b) for b in PRINTABLE}
_SYMBOL_OF |= {b: chr(256 + k) for k, b in enumerate(b for b in range(256) if b not in _SYMBOL_OF)}
_BYTE_OF = {s: b for b, s in _SYMBOL_OF.items()}
_FROM_LATIN = {b: s for b, s in _SYMBOL_OF.items() if chr(b) != s}


class _Kinds(dict):
    """Characters beyond ASCII to one that stands for their kind, as the tokenizer itself cuts them."""

    def __init__(self, pre_tokenizer):
        super().__init__((c, c) for c in range(128))
        self.cut = pre_tokenizer.pre_tokenize_str

    def __missing__(self, code: int) -> str:
        character = chr(code)
        alike = [kind for kind, other in ((LETTER, "a"), (NUMBER, "1"), (SIGN, "!")) if len(self.cut(other + character)) == 1]
        self[code] = alike[0] if alike else SPACE
        return self[code]


def _symbols(piece: str) -> str:
    """A character for each byte of a piece."""
    if piece.isascii() and piece.isprintable():
        return piece.replace(" ", _SYMBOL_OF[32])
    return piece.encode("utf-8", "replace").decode("latin-1").translate(_FROM_LATIN)


def _packed(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _is(part: dict | None, **expected) -> bool:
    return part is not None and all(part.get(k) == v for k, v in expected.items())


def _rules(path: str) -> dict:
    """What a tokenizer file says, if it is byte-level without anything before it; others raise ValueError."""
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    model, added = rules["model"], rules["added_tokens"]
    plain = all(not (t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"]) for t in added)
    unusual = [k for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix",
                           "fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
    if not (
        plain and not unusual and rules["normalizer"] is None and model["type"] == "BPE"
        and _is(rules["pre_tokenizer"], type="ByteLevel", add_prefix_space=False, use_regex=True)
        and _is(rules["decoder"], type="ByteLevel")
    ):
        raise ValueError(f"{path} is not a plain byte-level tokenizer")
    return rules


class Encoder:
    """Encodes as a byte-level tokenizer file says; other kinds raise ValueError.

    Merges must come in the order in which their parts come into being. Added tokens in a text
    become their own id.
    """

    def __init__(self, path: str):
        import ahocorasick

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        rules = _rules(path)
        model = rules["model"]
        self.kinds = _Kinds(Tokenizer.from_file(path).pre_tokenizer)
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        self.pairs: dict[int, bool] = {}
        self._build(model["vocab"], [m.split(" ") if isinstance(m, str) else m for m in model["merges"]])
        self.added = {t["content"]: t["id"] for t in rules["added_tokens"]}
        contents = sorted(self.added, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, contents)) + ")") if contents else None
        self.matches = ahocorasick.Automaton()
        for symbol, token in model["vocab"].items():
            if self.born[token] > -2:
                self.matches.add_word(symbol, token)
        self.matches.make_automaton()

    def _build(self, vocabulary: dict[str, int], merges: list) -> None:
        """When every token comes into being (-1: a byte, -2: never), and from which two."""
        most = max(vocabulary.values(), default=-1) + 1
        self.base = most
        self.length = [0] * most
        for symbol, token in vocabulary.items():
            self.length[token] = len(symbol)
        self.born = [-2] * most
        for symbol in _BYTE_OF:
            self.born[vocabulary[symbol]] = -1
        self.left, self.right = [-1] * most, [-1] * most
        self.rank: dict[int, int] = {}
        for rank, (a, b) in enumerate(merges):
            left, right, whole = vocabulary[a], vocabulary[b], vocabulary[a + b]
            self.rank[left * most + right] = rank
            if self.born[left] == -2 or self.born[right] == -2:
                raise ValueError("merges are not in the order in which tokens come into being")
            # A token that its own bytes don't lead to is never seen; of two ways the first one counts.
            if self.born[whole] == -2 and self._apart(left, right, rank):
                self.born[whole], self.left[whole], self.right[whole] = rank, left, right

    def _apart(self, x: int, y: int, until: int) -> bool:
        """Whether no merge earlier than ``until`` joins the parts of x and y across their seam.

        The tokens at the seam are taken apart backwards in time, the younger one first. Two parts met
        until either was merged with its other neighbour; at the same rank the left pair goes first.
        """
        born, base = self.born, self.base
        limit = 2 * until
        while True:
            joined = self.rank.get(x * base + y)
            if joined is not None and 2 * joined < limit:
                return False
            if born[x] > born[y]:
                limit, x = 2 * born[x], self.right[x]
            elif born[y] >= 0:
                limit, y = 2 * born[y] + 1, self.left[y]
            else:
                return True

    def fits(self, x: int, y: int) -> bool:
        """Whether y may follow x: both stay what they are when their bytes are merged together."""
        pair = x * self.base + y
        known = self.pairs.get(pair)
        if known is None:
            if len(self.pairs) >= KEPT_PAIRS:
                self.pairs.clear()
            known = self.pairs[pair] = self._apart(x, y, NEVER)
        return known

    def piece_ids(self, symbols: str) -> list[int]:
        """The ids of one piece, given as a character for each byte."""
        last, pairs, base, length = [-1] * (len(symbols) + 1), self.pairs, self.base, self.length
        for before, token in self.matches.iter(symbols):
            if last[before + 1] < 0:
                start = before + 1 - length[token]
                if start:
                    known = pairs.get(last[start] * base + token)
                    if not (known or (known is None and self.fits(last[start], token))):
                        continue
                last[before + 1] = token
        ids, at = [], len(symbols)
        while at:
            ids.append(last[at])
            at -= length[last[at]]
        return ids[::-1]

    def _word(self, word: str) -> bytes:
        """The ids of a word with the white space before it, as bytes; those of usual length are kept."""
        found, at = [], 0
        for kinds in _PIECE.findall(word if word.isascii() else word.translate(self.kinds)):
            piece = word[at : at + len(kinds)]
            at += len(kinds)
            known = self.pieces.get(piece)
            if known is None:
                known = _packed(self.piece_ids(_symbols(piece)))
                if len(piece) <= LONGEST_KEPT:
                    if len(self.pieces) >= KEPT_WORDS:
                        self.pieces.clear()
                    self.pieces[piece] = known
            found.append(known)
        raw = b"".join(found)
        if len(word) <= LONGEST_KEPT:
            if len(self.words) >= KEPT_WORDS:
                self.words.clear()
            self.words[word] = raw
        return raw

    def encode(self, text: str | None) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        parts = self.marks.split(text or "") if self.marks else [text or ""]
        encoded = []
        for k, part in enumerate(parts):
            if k % 2:
                encoded.append(_packed([self.added[part]]))
                continue
            words = _WORD.findall(part)
            found = list(map(self.words.get, words))
            if None in found:
                found = [f or self.words.get(w) or self._word(w) for w, f in zip(words, found)]
            encoded += found
        return b"".join(encoded)


class Decoder:
    """Decodes as a byte-level tokenizer file says; it needs the vocabulary only."""

    def __init__(self, path: str):
        rules = _rules(path)
        tokens = rules["model"]["vocab"] | {t["content"]: t["id"] for t in rules["added_tokens"]}
        self.raw = {i: self._raw(s) for s, i in tokens.items()}

    @staticmethod
    def _raw(token: str) -> bytes:
        known = [_BYTE_OF.get(s) for s in token]
        return token.encode() if None in known else bytes(known)

    def decode(self, ids: bytes | None) -> str:
        """The text of ids; numbers of no token give nothing, broken characters the replacement sign."""
        numbers = np.frombuffer(ids or b"", "<u4").tolist()
        try:
            raw = b"".join(map(self.raw.__getitem__, numbers))
        except KeyError:
            raw = b"".join(self.raw.get(i, b"") for i in numbers)
        return raw.decode("utf-8", "replace")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary file."""
    return Encoder(path)


@lru_cache(maxsize=2)
def decoder(path: str) -> Decoder:
    return Decoder(path)


def _with_column(
    df: DataFrame, source: str, name: str, kind: T.DataType, made: Callable[[], Callable], drop: bool
) -> DataFrame:
    """Adds a column computed by the function that ``made`` gives in a worker, batch by batch."""
    kept = [c for c in df.columns if c.lower() != name.lower() and not (drop and c == source)]
    inner = spare([*kept, name], "_in")
    schema = T.StructType([*(df.schema[c] for c in kept), T.StructField(name, kind)])
    arrow = pa.binary() if isinstance(kind, T.BinaryType) else pa.string()

    def computed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = made()
        for whole in batches:
            for batch in some_rows(whole):
                values: Iterable = (apply(v.as_py()) for v in batch.column(inner))
                columns = [batch.column(c) for c in kept] + [pa.array(values, arrow)]
                yield pa.RecordBatch.from_arrays(columns, [*kept, name])

    return df.select(*kept, F.col(source).alias(inner)).mapInArrow(computed, schema)


def encoded(docs: DataFrame, path: str, text: str = "text", name: str = "ids", keep_text: bool = True) -> DataFrame:
    """Adds the token ids of ``text`` as little-endian unsigned 32-bit integers in a binary column.

    ``path`` is a byte-level tokenizer file that every executor can read. Ids equal those of the tokenizers
    library without special tokens added; strings of added tokens in a text become their ids. NULL counts
    as an empty text, which has no ids. Rows keep their other columns, repeats included; a column named
    ``name`` is replaced. Nothing is shuffled, and an empty table gives an empty one.
    """
    return _with_column(docs, text, name, T.BinaryType(), lambda: encoder(path).encode, not keep_text)


def decoded(tokens: DataFrame, path: str, ids: str = "ids", name: str = "decoded", keep_ids: bool = True) -> DataFrame:
    """Adds the text of the ids that ``encoded`` gives; NULL and no ids are the empty text.

    Added tokens show as their strings. Rows keep their other columns; one named ``name`` is replaced.
    """
    return _with_column(tokens, ids, name, T.StringType(), lambda: decoder(path).decode, not keep_ids)
