"""Words of a batch of texts as numbers, each distinct word looked at once."""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc

HASH_KEY = "0123456789abcdef"  # sixteen characters; only has to stay the same


class Words(NamedTuple):
    """The words of texts, in order: number of the text, number of the word in ``distinct``."""

    texts: int
    text: np.ndarray
    code: np.ndarray
    distinct: pa.Array


def split_words(texts: pa.Array) -> Words:
    """White space separates words; NULL has none."""
    lists = pc.utf8_split_whitespace(pc.fill_null(texts.cast(pa.large_string()), ""))
    lengths = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    encoded = lists.flatten().dictionary_encode()
    code = encoded.indices.to_numpy(zero_copy_only=False)
    text = np.repeat(np.arange(len(texts)), lengths)
    empty = pc.equal(encoded.dictionary, "").to_numpy(zero_copy_only=False)
    if empty.any():  # before leading and after trailing white space
        real = ~empty[code]
        text, code = text[real], code[real]
    return Words(len(texts), text, code, encoded.dictionary)


def letters(words: pa.Array) -> pa.Array:
    """Letters and digits of each word, in lower case."""
    return pc.replace_substring_regex(pc.utf8_lower(words), r"[^\pL\pN]+", "")


def signs(words: pa.Array) -> pa.Array:
    """What is neither letter nor digit in each word."""
    return pc.replace_substring_regex(words, r"[\pL\pN]+", "")


def hashed(strings: pa.Array, kind: str, buckets: int) -> np.ndarray:
    """A bucket for each string; strings of different kinds are hashed differently."""
    values = np.array([f"{kind}:{s}" for s in strings.to_pylist()], object)
    if not len(values):
        return np.empty(0, np.int64)
    return (pd.util.hash_array(values, hash_key=HASH_KEY, categorize=False) % buckets).astype(np.int64)
