"""Text expressions. All of them stay inside Catalyst; none needs a Python worker."""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterable
from functools import lru_cache
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MISSING_TEXT = "None"

# Every character Python's str.split() treats as white space.
WHITESPACE = r"[\s\x0B\x1C-\x1F\x85\p{Z}]+"

# Letters that fold to other letters without being an accented form of them.
SPECIAL_FOLDS = {
    "ß": "ss",
    "Æ": "AE",
    "æ": "ae",
    "Œ": "OE",
    "œ": "oe",
    "Þ": "Th",
    "þ": "th",
    "Ø": "O",
    "ø": "o",
    "Đ": "D",
    "đ": "d",
    "Ð": "D",
    "ð": "d",
    "Ł": "L",
    "ł": "l",
    "Ħ": "H",
    "ħ": "h",
    "ı": "i",
    "‘": "'",
    "’": "'",
    "“": '"',
    "”": '"',
    "–": "-",
}


def squeeze_whitespace(text: Column | str) -> Column:
    """Runs of white space become one blank; none is left at the ends."""
    return F.trim(F.regexp_replace(text, WHITESPACE, " "))


def null_to_none(text: Column | str) -> Column:
    """NULL becomes the text 'None'."""
    return F.coalesce(text, F.lit(MISSING_TEXT))


def take_first_nonempty(values: Column) -> Column:
    """The first element that is neither NULL nor empty; NULL when there is none."""
    return F.get(F.filter(values, lambda v: v.isNotNull() & (v != "")), F.lit(0))


@lru_cache(maxsize=1)
def _accent_table() -> tuple[str, str]:
    """Accented Latin letters and the ASCII letter each decomposes to, derived from Unicode."""
    source, target = [], []
    for code in (*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base != chr(code) and base.isascii():
            source.append(chr(code))
            target.append(base)
    for letter, fold in SPECIAL_FOLDS.items():
        if len(fold) == 1:
            source.append(letter)
            target.append(fold)
    # translate() drops characters without a counterpart: the combining marks.
    source.extend(chr(code) for code in range(0x0300, 0x0370))
    return "".join(source), "".join(target)


def fold_accents(text: Column | str) -> Column:
    """Latin text without accents, in ASCII letters."""
    folded = F.translate(text, *_accent_table())
    for letter, fold in SPECIAL_FOLDS.items():
        if len(fold) > 1:
            folded = F.replace(folded, F.lit(letter), F.lit(fold))
    return folded


# Fixed value: characters that a piece of a text holds at most.
CHUNK_CHARS = 3000


def chunk_text(text: Column | str, size: int = CHUNK_CHARS) -> Column:
    """The text as pieces of at most ``size`` characters, each ending at a word boundary.

    What follows the last word boundary (closing punctuation) belongs to no piece. The flags make
    Java's '.' and word boundary follow Python's: only a line feed ends a line, words are Unicode.
    """
    return F.regexp_extract_all(text, F.lit(rf"(?dU)(.{{1,{size}}})(?=\b)"), F.lit(1))


def explode_chunks(docs: DataFrame, id_col: str, text: Column | str, size: int = CHUNK_CHARS) -> DataFrame:
    """One row per piece: id, position, piece."""
    return docs.select(id_col, F.posexplode(chunk_text(text, size)).alias("pos", "chunk"))


def rejoined(text: Column | str, size: int = CHUNK_CHARS) -> Column:
    """The pieces of a text put together again in its own row; NULL without any piece."""
    pieces = chunk_text(text, size)
    return F.when(F.size(pieces) > 0, F.array_join(pieces, ""))


def rejoin_chunks(chunks: DataFrame, id_col: str) -> DataFrame:
    """Put pieces that come as rows back together, in order and without separator.

    A group holds the pieces of one text, which was one value before it was cut.
    """
    pieces = F.sort_array(F.collect_list(F.struct("pos", "chunk")))
    return chunks.groupBy(id_col).agg(
        F.array_join(F.transform(pieces, lambda p: p["chunk"]), "").alias("text")
    )


@lru_cache(maxsize=1)
def _named_entities() -> str:
    """Every named character reference that ends with a semicolon, as a JSON object."""
    return json.dumps({name: text for name, text in html5.items() if name.endswith(";")})


def unescape_entities(text: Column | str) -> Column:
    """Decode character references by number or name, once each, from left to right.

    What a decoded reference gives is not decoded again; unknown ones stay as they are.
    """
    text = F.col(text) if isinstance(text, str) else text
    names = F.from_json(F.lit(_named_entities()), "map<string,string>")

    def decode(part: Column) -> Column:
        """Decode what a part begins with, for it followed an ampersand; keep the rest."""
        name = F.regexp_extract(part, r"^([A-Za-z][A-Za-z0-9]*;)", 1)
        digits = F.regexp_extract(part, r"^#0*([0-9]+);", 1)
        hexits = F.regexp_extract(part, r"^#[xX]0*([0-9a-fA-F]+);", 1)
        code = F.when(digits != "", digits.try_cast("int")).when(
            (hexits != "") & (F.length(hexits) <= 6), F.conv(hexits, 16, 10).try_cast("int")
        )
        known = code.between(1, 0x10FFFF) & ~code.between(0xD800, 0xDFFF)
        character = F.decode(F.unhex(F.lpad(F.hex(code.cast("long")), 8, "0")), "UTF-32")
        decoded = F.when(known, character).when(name != "", F.try_element_at(names, name))
        rest = F.substring(part, F.locate(";", part) + 1, F.length(part))
        return F.coalesce(F.concat(decoded, rest), F.concat(F.lit("&"), part))

    def joined(parts: Column) -> Column:
        following = F.transform(F.slice(parts, F.lit(2), F.size(parts)), decode)
        return F.array_join(F.concat(F.slice(parts, 1, 1), following), "")

    def whole(value: Column) -> Column:
        decoded = F.get(F.transform(F.array(F.split(value, "&")), joined), F.lit(0))
        return F.when(F.contains(value, F.lit("&")), decoded).otherwise(value)

    # Inside a lambda a value is computed once, however often it is used; ``text`` may be costly.
    return F.get(F.transform(F.array(text), whole), F.lit(0))


def any_of(terms: Iterable[str], exact: Iterable[str] = (), word: str = r"\p{L}\p{N}_", blank: str = " ") -> str:
    """A regular expression for whole words or phrases, as spelled in the text.

    ``terms`` match in any letter case; those in ``exact``, which are also words of the language, only
    as they are written. ``word`` are the characters that words consist of, inside a class; none of them
    touches a match. ``blank`` is the expression that a blank inside a term stands for.

    Where several terms begin at one place the longest one matches. Most places of a text are ruled
    out by the first character alone; the others are compared with the terms of one letter only.
    """
    strict = set(exact)
    groups: dict[str, list[tuple[str, bool]]] = {}
    for term in {*terms} | strict:
        groups.setdefault(term[0].lower(), []).append((term, term in strict))
    alternatives = []
    for first, members in sorted(groups.items()):
        ordered = sorted(members, key=lambda m: (-len(m[0]), m[0]))
        spelled = "|".join(_spelled(term, only, blank) for term, only in ordered)
        alternatives.append(f"(?=[{_quote(first)}{_quote(first.upper())}])(?:{spelled})")
    firsts = "".join(_quote(c) for first in sorted(groups) for c in sorted({first, first.upper()}))
    return f"(?=[{firsts}])(?<![{word}])(?:{'|'.join(alternatives)})(?![{word}])"


def _spelled(term: str, exact: bool, blank: str) -> str:
    """One term; a single letter is none next to an ampersand, as in R&D."""
    spelled = blank.join(_quote(part) for part in term.split(" "))
    if not exact:
        return f"(?i:{spelled})"
    return spelled if len(term) > 1 else f"(?<!&){spelled}(?!&)"


def _quote(literal: str) -> str:
    return "".join("\\" + c if c in r"\.[]{}()*+?^$|/-#&~" else c for c in literal)
