"""Market questions: demand over time, skills, places, employers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


GRAINS = ("day", "week", "month")


def trend_by_role(
    adverts: DataFrame, date_col: str = "date_posted", grains: Sequence[str] = GRAINS
) -> DataFrame:
    """Adverts per role and day, week and month. Counted per day first; coarser grains add up days."""
    daily = adverts.groupBy("role", F.col(date_col).alias("day")).agg(F.count(F.lit(1)).alias("n"))
    periods = F.array(
        *[
            F.struct(F.lit(g).alias("grain"), F.date_trunc(g, "day").cast("date").alias("period_start"))
            for g in grains
        ]
    )
    return (
        daily.select("role", "n", F.inline(periods))
        .groupBy("grain", "period_start", "role")
        .agg(F.sum("n").alias("n_ads"))
    )


def top_skills(adverts: DataFrame, role: str, toolset: str, k: int) -> DataFrame:
    """The k most named tools per role; equal counts go by name.

    Spellings that differ in letter case are one tool, shown as the smallest of them by code point.
    """
    skill = F.explode(F.split(F.nullif(F.col(toolset), F.lit("")), ", "))
    spelled = (
        adverts.select(F.col(role).alias("role"), skill.alias("skill"))
        .groupBy("role", "skill")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    names = spelled.groupBy(F.lower("skill").alias("folded")).agg(F.min("skill").alias("skill"))
    counted = (
        spelled.groupBy("role", F.lower("skill").alias("folded"))
        .agg(F.sum("n").alias("n_mentions"))
        .join(names, "folded")
        .select("role", "skill", "n_mentions")
    )
    order = W.partitionBy("role").orderBy(F.desc("n_mentions"), "skill")
    return counted.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def postings_by_location(adverts: DataFrame, counted: str | None = None) -> DataFrame:
    """Adverts per country and city, per country, and in all; ``level`` is 2, 1 and 0.

    ``counted`` names the column with the number of adverts, where rows are counts already.
    """
    n = F.count(F.lit(1)) if counted is None else F.sum(counted)
    cities = adverts.groupBy("country", "city").agg(n.alias("n"))
    level = F.lit(2) - F.grouping("city").cast("int") - F.grouping("country").cast("int")
    return cities.rollup("country", "city").agg(
        level.alias("level"), F.sum("n").alias("n_ads")
    )


def top_hiring_companies(adverts: DataFrame, k: int) -> DataFrame:
    """The k companies with most adverts; equal counts go by name."""
    return (
        adverts.groupBy("company")
        .agg(F.count(F.lit(1)).alias("n_ads"), F.max("metadata_lastupdated").alias("last_seen"))
        .orderBy(F.desc("n_ads"), "company")
        .limit(k)
    )


def star_rollup(
    fact: DataFrame,
    calendar: DataFrame,
    roles: DataFrame,
    companies: DataFrame,
    locations: DataFrame,
) -> DataFrame:
    """Adverts and employers per role, country and month, over the star schema.

    Facts of days that the calendar doesn't have don't count. The calendar is broadcast: it has one row
    per day, whatever the number of facts. The other sides are, below the session's threshold.
    """
    days = calendar.select(
        F.col("date_iso_format_pk").alias("date_posted_fk"), "num_year", "num_month_in_year", "name_month_en"
    )
    joined = fact.join(F.broadcast(days), "date_posted_fk")
    for dim, name, labels in ((roles, "role", ["role"]), (locations, "location", ["country"]), (companies, "company", [])):
        joined = joined.join(dim.select(F.col(f"{name}_pk").alias(f"{name}_fk"), *labels), f"{name}_fk")
    return joined.groupBy("role", "country", "num_year", "num_month_in_year", "name_month_en").agg(
        F.count(F.lit(1)).alias("n_ads"), F.count_distinct("company_fk").alias("n_companies")
    )
