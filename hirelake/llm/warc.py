"""Derivatives of web archives: metadata and plain-text conversion records of response records.

A record is a row of its type, its identifiers, its header fields and its block. Responses are read as
rows of those columns; every derived record refers to the response it comes from and keeps what the
server sent as header. Records are written as WARC files by Spark's text writer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake.functions.text import squeeze_whitespace
from hirelake.sources.pages import visible_text

VERSION = "WARC/1.1"
CRLF = "\r\n"
FETCHED_AT = "2024-01-01T00:00:00Z"


def identifier(kind: str, of: Column) -> Column:
    """A record identifier that is the same in every run: a name-based UUID of the kind and ``of``."""
    digest = F.md5(F.concat(F.lit(f"{kind}:"), of))
    parts = [F.substring(digest, start, length) for start, length in ((1, 8), (9, 4), (14, 3), (18, 3), (21, 12))]
    uuid = F.concat(parts[0], F.lit("-"), parts[1], F.lit("-3"), parts[2], F.lit("-8"), parts[3], F.lit("-"), parts[4])
    return F.concat(F.lit("<urn:uuid:"), uuid, F.lit(">"))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(block.cast("binary"), 256))


def responses(
    pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", fetched_at: str = FETCHED_AT
) -> DataFrame:
    """Response records of stored pages: (record_id, target_uri, date, block), as a crawler writes them.

    A NULL page is an empty payload; a NULL address gives a record without target. The identifier
    depends on number and address, so rows that repeat have the same.
    """
    payload = F.coalesce(F.col(html), F.lit(""))
    name = F.concat_ws(" ", F.coalesce(F.col(page_id).cast("string"), F.lit("-")), F.coalesce(F.col(url), F.lit("-")))
    head = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length(payload).cast("string"),
        F.lit(CRLF + CRLF),
    )
    return pages.select(
        identifier("response", name).alias("record_id"),
        F.col(url).alias("target_uri"),
        F.lit(fetched_at).alias("date"),
        F.concat(head, payload).alias("block"),
    )


def _http(block: Column) -> tuple[Column, Column]:
    """Header lines and payload; a block without an empty line is all header."""
    at = F.locate(CRLF + CRLF, block)
    head = F.when(at > 0, F.substring(block, F.lit(1), at - 1)).otherwise(block)
    payload = F.when(at > 0, F.substring(block, at + 4, F.length(block))).otherwise(F.lit(""))
    return head, payload


def _field(lines: Column, name: str) -> Column:
    """The value of the first header line of that name; NULL without one."""
    found = F.filter(lines, lambda line: F.lower(line).startswith(f"{name.lower()}:"))
    return F.trim(F.substring(F.get(found, F.lit(0)), F.lit(len(name) + 2), F.lit(1 << 20)))


def derive(records: DataFrame) -> DataFrame:
    """Metadata and conversion records of response records (record_id, target_uri, date, block).

    Columns: record_id, warc_type, refers_to (the response's record_id), target_uri, date, content_type,
    content_length (bytes), block_digest, payload_digest (of the response's payload), source_status,
    source_headers (the server's header lines, as sent) and block.

    Every response gives a metadata record, whose fields are the page's title, language and links in
    their order (repeats too) next to the kept header lines. Responses of status 2xx and a type of text
    give a conversion record too: the visible text of HTML (lines and blanks squeezed), other text as it
    is. NULL blocks count as empty and give metadata only; a missing address stays missing; records that
    repeat give repeated records; other columns are ignored; no records give none.
    """
    head, payload = _http(F.coalesce(F.col("block"), F.lit("")))
    parts = records.select(
        F.col("record_id").alias("refers_to"), "target_uri", "date", head.alias("head"), payload.alias("payload")
    ).withColumn("lines", F.split("head", CRLF))
    status = F.regexp_extract(F.get("lines", F.lit(0)), r"^HTTP/\S+\s+(\d{3})", 1).try_cast("int")
    kind = F.lower(F.trim(F.substring_index(_field(F.col("lines"), "Content-Type"), ";", 1)))
    html = F.coalesce(kind.isin("text/html", "application/xhtml+xml"), F.lit(False))
    text = html | F.coalesce(kind.startswith("text/"), F.lit(False))
    page = F.col("payload")
    title = squeeze_whitespace(F.regexp_extract(page, r"(?is)<title[^>]*>(.*?)</title>", 1))
    language = F.regexp_extract(page, r"""(?is)<html[^>]*\slang=["']?([A-Za-z-]+)""", 1)
    links = F.regexp_extract_all(page, F.lit(r"""(?is)<a\s[^>]*?href=["']([^"']*)["']"""), F.lit(1))
    # Columns first: what is used several times below is computed once.
    known = parts.select(
        "refers_to", "target_uri", "date", "payload", title.alias("title"), language.alias("language"), links.alias("links"),
        status.alias("source_status"),
        F.slice("lines", F.lit(2), F.size("lines")).alias("source_headers"),
        html.alias("html"),
        (text & F.coalesce(status.between(200, 299), F.lit(False))).alias("text"),
    )
    fields = F.concat(
        F.transform("source_headers", lambda line: F.concat(F.lit("source-header: "), line)),
        F.when(F.col("html") & (F.col("title") != ""), F.array(F.concat(F.lit("title: "), F.col("title")))).otherwise(F.array()),
        F.when(F.col("html") & (F.col("language") != ""), F.array(F.concat(F.lit("language: "), F.col("language")))).otherwise(F.array()),
        F.when(F.col("html"), F.transform("links", lambda link: F.concat(F.lit("outlink: "), link))).otherwise(F.array()),
    )
    lines = F.array_join(F.transform(fields, lambda line: F.concat(line, F.lit(CRLF))), "")
    converted = F.when(F.col("html"), visible_text("payload")).otherwise(page)

    def record(kind: str, content_type: str, block: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("warc_type"), F.lit(content_type).alias("content_type"), block.alias("block")
        )

    both = F.array(
        record("metadata", "application/warc-fields", lines),
        F.when(F.col("text"), record("conversion", "text/plain; charset=utf-8", converted)),
    )
    made = known.select(
        "refers_to", "target_uri", "date", "source_status", "source_headers",
        digest(page).alias("payload_digest"), F.explode(F.filter(both, lambda r: r.isNotNull())).alias("r"),
    ).select("*", "r.*")
    known_id = F.coalesce(F.col("refers_to"), F.lit("-"))
    return made.select(
        F.when(F.col("warc_type") == "metadata", identifier("metadata", known_id))
        .otherwise(identifier("conversion", known_id))
        .alias("record_id"),
        "warc_type", "refers_to", "target_uri", "date", "content_type",
        F.octet_length("block").cast("long").alias("content_length"),
        digest(F.col("block")).alias("block_digest"),
        "payload_digest", "source_status", "source_headers", "block",
    )


def serialized(records: DataFrame) -> DataFrame:
    """(record): each derived record in the format of WARC files, without the two line ends after it."""
    named = {
        "WARC-Type": "warc_type",
        "WARC-Record-ID": "record_id",
        "WARC-Date": "date",
        "WARC-Target-URI": "target_uri",
        "WARC-Refers-To": "refers_to",
        "WARC-Block-Digest": "block_digest",
        "WARC-Source-Payload-Digest": "payload_digest",
        "Content-Type": "content_type",
        "Content-Length": "content_length",
    }
    # concat() is NULL where a value is, and concat_ws() leaves that line out.
    lines = [F.concat(F.lit(f"{name}: "), F.col(column).cast("string")) for name, column in named.items()]
    return records.select(F.concat_ws(CRLF, F.lit(VERSION), *lines, F.concat(F.lit(CRLF), F.col("block"))).alias("record"))


def write_warc(records: DataFrame, path: str) -> None:
    """One file of records per partition; the text writer's line separator is the end of a record."""
    serialized(records).write.option("lineSep", CRLF + CRLF).text(path)
