"""Adverts from stored HTML pages."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from hirelake.functions.text import squeeze_whitespace, unescape_entities

# The elements (tag, beginning of the class) that hold an advert's header and description.
HEADER_ELEMENT = ("div", "jobOverview")
BODY_ELEMENT = ("div", "jobBreakdown")
# Where the fields of an advert stand in its header. The title cannot leave its heading.
ADVERT_HEADER = {
    "title": r"(?is)<h2\b[^>]*>(?:(?!</h2\b).)*?<strong\b[^>]*>([^<]+)",
    "company": r"(?is)<a\b[^>]*>([^<]+)",
    "location": r'(?is)<span\b[^>]*data-ui="overview-location"[^>]*>([^<]+)',
    "employment_type": r'(?is)<span\b[^>]*data-ui="overview-employment-type"[^>]*>([^<]+)',
    "date_posted": r'(?is)<span\b[^>]*data-ui="overview-date-posted"[^>]*>([^<]+)',
}

_CODE = (
    r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>"
    r"|<noscript\b.*?</noscript\s*>|<template\b.*?</template\s*>"
)
_HEAD = r"(?is)<head\b.*?</head\s*>"
_INLINE = (
    r"(?i)</?(?:a|abbr|b|bdi|bdo|cite|code|em|font|i|kbd|mark|q|s|small|span|strong|sub|sup|u|var|wbr)"
    r"(?:[\s/][^>]*)?>"
)
_TAG = r"<[^>]*>"


def extract_fields(html: Column | str, patterns: Mapping[str, str]) -> list[Column]:
    """One column per field: its first text, entities decoded, NULL where the field is missing."""
    return [
        F.nullif(unescape_entities(F.regexp_extract(html, pattern, 1)), F.lit("")).alias(name)
        for name, pattern in patterns.items()
    ]


def element_html(html: Column | str, tag: str, css_class: str | None = None) -> Column:
    """What the first element with this tag holds, and with a class that begins so; NULL without one.

    The element ends where its own end tag is: tags of its kind inside it are balanced. One that is
    never closed goes on to the end of the page.
    """
    html = F.col(html) if isinstance(html, str) else html
    wanted = "" if css_class is None else rf"""(?=[^>]*\sclass\s*=\s*["']?[^"'>]*(?<![\w-]){css_class})"""
    opening = rf"(?is)^(.*?)<{tag}\b{wanted}[^>]*>"
    inside = F.regexp_replace(html, rf"{opening}(.*)$", "$2")
    # Pieces begin at tags of this kind; the depth of each tells where the element's own end tag is.
    pieces = F.split(inside, rf"(?i)(?=</?{tag}[\s/>])")
    steps = F.transform(
        pieces, lambda p: F.when(F.rlike(p, F.lit(rf"(?i)^</{tag}")), -1).when(F.rlike(p, F.lit(rf"(?i)^<{tag}[\s/>]")), 1).otherwise(0)
    )
    state = F.struct(F.lit(1).alias("depth"), F.lit(0).alias("kept"))
    kept = F.aggregate(
        steps,
        state,
        lambda s, step: F.struct(
            F.when(s["depth"] > 0, s["depth"] + step).otherwise(0).alias("depth"),
            F.when((s["depth"] > 0) & (s["depth"] + step > 0), s["kept"] + 1).otherwise(s["kept"]).alias("kept"),
        ),
        lambda s: s["kept"],
    )
    found = F.array_join(F.slice(pieces, F.lit(1), kept), "")
    return F.when(F.rlike(html, F.lit(opening)), F.nullif(found, F.lit("")))


def visible_text(html: Column | str) -> Column:
    """The text a reader sees: tags, scripts, styles and comments removed, blanks squeezed.

    Inline tags vanish, all others separate words.
    """
    shown = F.regexp_replace(F.regexp_replace(html, _CODE, " "), _HEAD, " ")
    joined = F.regexp_replace(shown, _INLINE, "")
    return squeeze_whitespace(unescape_entities(F.regexp_replace(joined, _TAG, " ")))
