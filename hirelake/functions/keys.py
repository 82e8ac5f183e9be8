"""Surrogate keys."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class KeyLengths:
    """How many leading hex digits of a label's MD5 make its key."""

    # The short lengths of the warehouse's interface. Labels whose short keys collide share
    # a row of their dimension, so loads use WHOLE_KEYS unless they are told to keep the short ones.
    role: int = 3
    employment_type: int = 3
    company: int = 5
    location: int = 5


SHORT_KEYS = KeyLengths()
WHOLE_KEYS = KeyLengths(role=32, employment_type=32, company=32, location=32)


def surrogate_key(label: Column | str, length: int) -> Column:
    """The first ``length`` hex digits of the label's MD5; a NULL label has no key."""
    return F.left(F.md5(label), F.lit(length))
