"""Token ids of whole texts by a public tokenizer, computed in Arrow batches.

A tokenizer is slow on text but its vocabulary of words is repetitive: pieces between which the
tokenizer always cuts are encoded once per worker, in batches, and looked up afterwards. Plain byte-level
tokenizers are met with arrays: the bytes of many texts are cut, numbered and looked up at once.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterable
from functools import lru_cache
from unicodedata import category, is_normalized

import numpy as np
import pyarrow as pa

# Pieces that a worker keeps between calls; it starts anew when they are more, which changes no result.
KEPT_PIECES = 3 << 18
LONGEST_KEPT = 64
ENCODED_AT_ONCE = 1 << 14

# Characters with the property White_Space.
_SPACES = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_WORD = re.compile(f"[{_SPACES}]*[^{_SPACES}]+|[{_SPACES}]+")
# A blank before other white space: there the blank doesn't begin a piece of its own.
_BLANK_RUN = re.compile(r" \s")
# Every ASCII character becomes its kind, and so does a byte of a letter beyond ASCII.
_KINDS = bytes(
    ord(" ") if chr(c) in " \t\n\r\v\f" else ord(",") if chr(c) in ",." else ord("a") if chr(c).isalnum() else ord("!")
    for c in range(128)
) + b"a" * 128


# Byte-level tokenizers show every byte as a character: printable ones as themselves, others from 256 on.
_PRINTABLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_SYMBOLS = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _PRINTABLE)}
_BLANK_SYMBOL = chr(_SYMBOLS[32])
_UINT32 = "I"


def _runs(text: str) -> tuple[bool, bool, bool]:
    """Whether white space follows white space, whether commas or full stops touch other signs, or follow white space.

    For plain texts only, whose signs and white space are ASCII.
    """
    kinds = text.encode().translate(_KINDS)
    return b"  " in kinds, b",," in kinds or b",!" in kinds or b"!," in kinds, b" ," in kinds


def vocabulary(name: str) -> str:
    """Path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=4)
def _tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
    return tokenizer


def _drops_white_space(tokenizer) -> bool:
    return not tokenizer.encode(" \n ", add_special_tokens=False).ids


def _each(tokenizer, words: list[str]) -> list[bytes]:
    """The ids of every word, each encoded by itself."""
    encoded = tokenizer.encode(words, is_pretokenized=True, add_special_tokens=False)
    raw = np.array(encoded.ids, "<u4").tobytes()
    bounds = (np.searchsorted(np.array(encoded.word_ids, np.int64), np.arange(len(words) + 1)) * 4).tolist()
    return [raw[a:b] for a, b in zip(bounds, bounds[1:])]


class Encoder:
    """Texts to token ids as little-endian unsigned 32-bit integers, equal to encoding each as a whole.

    Two kinds of tokenizers are known: those that drop white space, and byte-level ones that cut before a
    blank followed by something else. Both never look beyond white space and the word that follows it, so
    that is encoded by itself. Plain texts, of ASCII characters and letters, are cut at single commas and
    full stops as well, which makes words alike; whether a character is a letter is what the tokenizer says.
    """

    def __init__(self, path: str):
        self.tokenizer = _tokenizer(path)
        self.at_once = ByteLevel(path) if _is_byte_level(path) else None
        self.kept: dict = self.at_once.kept if self.at_once else {}
        self.plain = {chr(c) for c in range(32, 127)} | set("\t\n\r\v\f")
        self.other: set[str] = set()
        self.drops = _drops_white_space(self.tokenizer)
        self.lowers = self.drops and self._ids("AZ") == self._ids("az")
        if not self.drops and self._ids("a\nb c") != self._ids("a") + self._ids("\n") + self._ids("b") + self._ids(" c"):
            raise ValueError("this tokenizer does not cut at white space")
        # Words of letters go to the model itself, if that is all the tokenizer would do with them.
        self.model = self.tokenizer.model
        self.sees_symbols = all(
            [token.id for token in self.model.tokenize(self._symbols(piece))] == self._ids(piece)
            for piece in (["été", "word"] if self.drops else [" été", "Été", " Word", "word"])
        )

    def _ids(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _plain(self, text: str) -> bool:
        """Whether a text has only ASCII characters, but few controls, and letters that nothing changes."""
        unknown = set(text) - self.plain
        for c in unknown - self.other:
            alone = category(c).startswith("L") and is_normalized("NFC", c) and len(c.lower()) == 1
            letter = alone and len(self.tokenizer.pre_tokenizer.pre_tokenize_str(f"a{c}a")) == 1
            (self.plain if letter else self.other).add(c)
        return not unknown or unknown <= self.plain

    def pieces(self, text: str) -> list:
        """Parts of a text that are encoded each by itself."""
        plain = self._plain(text)
        spaces, signs, begun = _runs(text) if plain else (True, True, True)
        if self.drops:
            if not plain:
                return [w.encode("utf-8", "replace") for w in _WORD.findall(text)]
            raw = text.encode()
            raw = raw.lower() if self.lowers else raw
            # Signs are cut off words, so that a word with and without a comma is one piece.
            if not signs:
                raw = raw.replace(b",", b" ,").replace(b".", b" .")
            return raw.split()
        if not plain or (spaces and _BLANK_RUN.search(text)):
            return _WORD.findall(text)
        marked = text.replace(" ", "\0 ")
        if not spaces:
            marked = marked.replace("\n", "\0\n\0")
        # A blank belongs to the sign behind it, and other white space is cut by what follows it.
        if not signs and not begun:
            marked = marked.replace(",", "\0,").replace(".", "\0.")
        return marked.split("\0")

    def _symbols(self, piece: str) -> str | None:
        """What the model sees of a piece that is one word of letters; None of other pieces."""
        word = piece[1:] if piece[:1] == " " and not self.drops else piece
        if not word.isalpha() or (self.drops and not (word.islower() and is_normalized("NFC", word))):
            return None
        if word.isascii():
            return piece.replace(" ", _BLANK_SYMBOL)
        return piece.encode().decode("latin-1").translate(_SYMBOLS) if self._plain(word) else None

    def _learn(self, pieces: set) -> None:
        """Adds the ids of pieces to those that are kept."""
        others = []
        for piece in pieces:
            word = piece.decode("utf-8") if self.drops else piece
            symbols = self._symbols(word) if self.sees_symbols else None
            if symbols is None:
                others.append((piece, word))
            else:
                self.kept[piece] = array(_UINT32, [token.id for token in self.model.tokenize(symbols)]).tobytes()
        for at in range(0, len(others), ENCODED_AT_ONCE):
            some = others[at : at + ENCODED_AT_ONCE]
            self.kept.update(zip([piece for piece, _ in some], _each(self.tokenizer, [w for _, w in some])))

    def flat(self, texts: list[bytes | None], end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """How many ids each text (in UTF-8) has, and the ids of all; the id ``end`` follows each text."""
        if self.at_once:
            return self.at_once.flat(texts, end)
        raw = [ids + end for ids in self.encode([(t or b"").decode() for t in texts])]
        return np.fromiter(map(len, raw), np.int64, len(raw)) // 4, np.frombuffer(b"".join(raw), "<i4")

    def encode(self, texts: list[str | None]) -> list[bytes]:
        if self.at_once:
            lengths, ids = self.at_once.flat([(t or "").encode() for t in texts])
            raw, ends = ids.tobytes(), (np.cumsum(lengths) * 4).tolist()
            return [raw[a:b] for a, b in zip([0, *ends], ends)]
        cut = [self.pieces(t or "") for t in texts]
        wanted = set().union(*cut)
        missing = wanted - self.kept.keys()
        if len(self.kept) + len(missing) > KEPT_PIECES:
            self.kept.clear()
            missing = wanted
        self._learn(missing)
        encoded = [b"".join(map(self.kept.__getitem__, c)) for c in cut]
        for piece in missing:
            if len(piece) > LONGEST_KEPT:
                del self.kept[piece]
        return encoded

# What a byte belongs to; a blank and other ASCII white space differ, for a blank goes with what follows it.
EDGE, BLANK, SPACE, WIDE_SPACE, LETTER, NUMBER, SIGN, APOSTROPHE = range(8)
_EDGE = b"\xff"  # never a byte of UTF-8


def _cuts() -> np.ndarray:
    """For the kinds of two neighbours, 8 times the first plus the second: 1 if there is always a cut, 2 if there
    is one as long as something else than white space follows the second, 0 if there may be none.
    """
    white, others = (BLANK, SPACE, WIDE_SPACE), (LETTER, NUMBER, SIGN, APOSTROPHE)
    cut = np.zeros((8, 8), np.uint8)
    cut[EDGE], cut[:, EDGE] = 1, 1
    for a in others:
        for b in (*white, *others):
            cut[a, b] = a != b
        cut[SPACE, a] = 1
    cut[SIGN, APOSTROPHE] = cut[APOSTROPHE, SIGN] = 0
    cut[APOSTROPHE, LETTER] = 0  # may be 's, 't and the like
    # Of several white spaces the last goes with what follows, or is cut from it.
    cut[BLANK : SPACE + 1, BLANK : SPACE + 1] = 2
    return cut.ravel()


_CUTS = _cuts()


def _is_byte_level(path: str) -> bool:
    """Whether a tokenizer file is byte-level BPE with the usual cuts and with nothing before them."""
    with open(path, encoding="utf-8") as file:
        rules = json.load(file)
    model, cuts = rules["model"], rules["pre_tokenizer"] or {}
    unusual = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback")
    return (
        rules["normalizer"] is None and all(token["special"] for token in rules["added_tokens"])
        and cuts.get("type") == "ByteLevel" and not cuts.get("add_prefix_space") and cuts.get("use_regex", True)
        and model["type"] == "BPE" and not any(model.get(k) for k in unusual)
    )


class ByteLevel:
    """Token ids of many texts at once, for tokenizers that ``_is_byte_level`` accepts.

    The tokenizer cuts between letters, numbers, signs and white space, so the kinds of neighbouring bytes
    tell the cuts; of what kind a character is, the tokenizer says. Arrow numbers the distinct pieces. A new
    piece is what the model sees as one word and goes to the model itself; pieces with apostrophes or with
    white space beyond ASCII, inside which there may be cuts, go to the whole tokenizer.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import CharDelimiterSplit

        self.tokenizer = _tokenizer(path)
        self.words = Tokenizer.from_file(path)  # takes symbols of bytes, words apart by the edge's
        self.words.encode_special_tokens = True
        self.words.pre_tokenizer = CharDelimiterSplit(_EDGE.decode("latin-1"))
        self.symbols = np.array([_SYMBOLS.get(b, b) for b in range(256)], "<u2")
        known = self.words.get_vocab(with_added_tokens=False)
        self.n_bytes = np.zeros(max(known.values()) + 1, np.int64)
        for token, number in known.items():
            self.n_bytes[number] = len(token)
        self.kept: dict[bytes, bytes] = {}
        self.ascii = np.full(256, LETTER, np.uint8)
        self.ascii[:128] = [self._kind(chr(c)) for c in range(128)]
        self.ascii[[32, 39, 255]] = BLANK, APOSTROPHE, EDGE
        self.beyond = np.full(0x110000, LETTER, np.uint8)  # of characters, once they are met
        self.letters: set[str] = set()
        self.others: set[str] = set()

    def _kind(self, character: str) -> int:
        alone = self.tokenizer.pre_tokenizer.pre_tokenize_str
        found = [kind for kind, like in ((LETTER, "a"), (NUMBER, "1"), (SIGN, "!")) if len(alone(like + character)) == 1]
        return found[0] if found else SPACE if character.isascii() else WIDE_SPACE

    def _kinds(self, raw: bytes) -> np.ndarray:
        """The kind of every byte's character."""
        read = np.frombuffer(raw, np.uint8)
        kinds = self.ascii[read]
        met = set(raw.translate(None, bytes(range(128)) + _EDGE).decode()) - self.letters
        for c in met - self.others:
            self.beyond[ord(c)] = self._kind(c)
            (self.letters if self.beyond[ord(c)] == LETTER else self.others).add(c)
        if met - self.letters:
            for first, n, bits in ((0xC0, 2, 0x1F), (0xE0, 3, 0x0F), (0xF0, 4, 0x07)):
                at = np.flatnonzero((read >= first) & (read <= first + bits))
                code = read[at].astype(np.int32) & bits
                for k in range(1, n):
                    code = code << 6 | (read[at + k] & 0x3F)
                kind = self.beyond[code]
                for k in range(n):
                    kinds[at + k] = kind
        return kinds

    def _bounds(self, raw: bytes) -> np.ndarray:
        """Where pieces begin, and the end. ``raw`` ends with an edge."""
        kinds = self._kinds(raw)
        cut = _CUTS[kinds[:-1] << 3 | kinds[1:]]
        doubtful = np.flatnonzero(cut == 2)  # the edge at the end is never
        cut[doubtful] = kinds[doubtful + 2] >= LETTER
        # White space right behind such beyond ASCII isn't cut from it, so neither from what follows.
        behind = np.flatnonzero((kinds[:-2] == WIDE_SPACE) & (kinds[1:-1] == SPACE)) + 1
        cut[behind] &= kinds[behind + 1] < LETTER
        return np.r_[0, np.flatnonzero(cut) + 1, len(raw)].astype(np.int32)

    def _learn(self, pieces: list[bytes]) -> None:
        """Adds the ids of pieces to those that are kept."""
        raw = _EDGE.join([*pieces, b""])
        kinds = self._kinds(raw)
        sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
        cut_inside = np.flatnonzero((kinds == APOSTROPHE) | (kinds == WIDE_SPACE))
        whole = np.ones(len(pieces), bool)
        whole[np.searchsorted(np.cumsum(sizes + 1), cut_inside, "right")] = False
        symbols = self.symbols[np.frombuffer(raw, np.uint8)].tobytes().decode("utf-16-le")
        ids = np.array(self.words.encode_batch_fast([symbols], add_special_tokens=False)[0].ids, "<u4")
        ends = np.r_[0, np.cumsum(self.n_bytes[ids])]
        bounds = np.searchsorted(ends, np.r_[0, np.cumsum(sizes)])
        if ends[-1] != sizes.sum():  # the vocabulary lacks some bytes
            whole[:] = False
        packed, bounds = ids.tobytes(), (bounds * 4).tolist()
        self.kept.update(zip(pieces, [packed[a:b] for a, b in zip(bounds, bounds[1:])]))
        if not whole.all():
            others = [pieces[k] for k in np.flatnonzero(~whole).tolist()]
            self.kept.update(zip(others, _each(self.tokenizer, [p.decode() for p in others])))

    def flat(self, texts: list[bytes | None], end: bytes = b"") -> tuple[np.ndarray, np.ndarray]:
        """As ``Encoder.flat``."""
        raw = _EDGE.join([*(t or b"" for t in texts), b""])
        if not raw:
            return np.zeros(0, np.int64), np.zeros(0, "<i4")
        bounds = self._bounds(raw)
        pieces = pa.Array.from_buffers(pa.binary(), len(bounds) - 1, [None, pa.py_buffer(bounds), pa.py_buffer(raw)])
        numbered = pieces.dictionary_encode()
        distinct = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        self.kept[_EDGE] = end
        missing = [p for p in distinct if p not in self.kept]
        if len(self.kept) + len(missing) > KEPT_PIECES:
            self.kept.clear()
            self.kept[_EDGE] = end
            missing = [p for p in distinct if p != _EDGE]
        for at in range(0, len(missing), ENCODED_AT_ONCE):
            self._learn(missing[at : at + ENCODED_AT_ONCE])
        known = [self.kept[p] for p in distinct]
        for piece in missing:
            if len(piece) > LONGEST_KEPT:
                del self.kept[piece]
        offsets = np.r_[0, np.cumsum(np.fromiter(map(len, known), np.int64, len(known))) // 4].astype(np.int32)
        lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(known), "<i4")))
        code = numbered.indices
        found = lists.take(code)
        edges = np.flatnonzero(code.to_numpy() == distinct.index(_EDGE))
        ends = found.offsets.to_numpy()[edges + 1].astype(np.int64)
        return np.diff(ends, prepend=0), found.values.to_numpy()


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker and vocabulary; it stays while the worker does."""
    return Encoder(path)


def in_lots(texts: list, most: int = 1 << 21) -> Iterable[tuple[int, int]]:
    """Ranges of texts of about ``most`` characters, or bytes."""
    start, size = 0, 0
    for at, text in enumerate(texts):
        size += len(text or "")
        if size >= most:
            yield start, at + 1
            start, size = at + 1, 0
    if start < len(texts):
        yield start, len(texts)
