"""From stored advert pages to the rows of the raw table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hirelake import schemas
from hirelake.functions.dates import parse_posted_date, truncate_minute
from hirelake.functions.text import null_to_none, squeeze_whitespace
from hirelake.operators.keyed import first_wins, rank_by_id
from hirelake.sources.pages import (
    ADVERT_HEADER,
    BODY_ELEMENT,
    HEADER_ELEMENT,
    element_html,
    extract_fields,
    visible_text,
)


def raw_jobs(
    pages: DataFrame,
    fetched_at: Column,
    source: str,
    patterns: Mapping[str, str] = ADVERT_HEADER,
    header: tuple[str, str | None] | None = HEADER_ELEMENT,
    body: tuple[str, str | None] | None = BODY_ELEMENT,
) -> DataFrame:
    """Raw adverts of pages (page_id, url, html) that hold one advert each.

    The fields stand in the header element (tag, beginning of its class), the description is the text of
    the body element; None takes the whole page for either. Texts that are missing or blank become
    'None', posting dates are counted back from ``fetched_at``, and the first page of a title, company
    and location wins.
    """
    within = pages.select(
        "page_id",
        "url",
        (element_html("html", *header) if header else F.col("html")).alias("_header"),
        (element_html("html", *body) if body else F.col("html")).alias("_body"),
    )
    fields = within.select(
        "page_id",
        *extract_fields("_header", patterns),
        visible_text("_body").alias("job_description"),
        F.col("url").alias("metadata_application_link"),
    )
    fields = fields.withColumns({n: F.lit(None).cast("string") for n in ADVERT_HEADER if n not in patterns})
    texts = ("title", "company", "location", "employment_type", "job_description", "metadata_application_link")
    cleaned = fields.withColumns(
        {
            **{name: null_to_none(F.nullif(squeeze_whitespace(name), F.lit(""))) for name in texts},
            "date_posted": parse_posted_date("date_posted", fetched_at),
            "metadata_lastupdated": truncate_minute(fetched_at),
            "metadata_source": F.lit(source),
        }
    )
    accepted = first_wins(cleaned, schemas.RAW_JOBS.key, "page_id")
    return schemas.conform(rank_by_id(accepted, "page_id", name="id"), schemas.RAW_JOBS)
