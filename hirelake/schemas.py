"""The warehouse tables: columns, keys, length limits, and their creation."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hirelake.session import path_exists

LANDING, PRESENTATION = "landing", "presentation"


@dataclass(frozen=True)
class Table:
    """One warehouse table; ``limits`` are the longest texts a column may hold."""

    zone: str
    name: str
    columns: str
    key: tuple[str, ...]
    unique: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    limits: dict[str, int] = field(default_factory=dict)
    partition_by: tuple[str, ...] = ()

    @property
    def schema(self) -> T.StructType:
        return T.StructType.fromDDL(self.columns)

    @property
    def column_types(self) -> dict[str, str]:
        return dict(part.split(" ") for part in self.columns.split(", "))

    @property
    def column_names(self) -> list[str]:
        return list(self.column_types)


# Names, order, types and limits of the columns are the interface of the warehouse. Keys may
# be as long as whole ones.
RAW_JOBS = Table(
    LANDING,
    "raw_jobs",
    "id BIGINT, title STRING, company STRING, location STRING, employment_type STRING, "
    "date_posted DATE, job_description STRING, metadata_lastupdated TIMESTAMP_NTZ, "
    "metadata_application_link STRING, metadata_source STRING",
    key=("title", "company", "location"),
    limits={
        "title": 100,
        "company": 50,
        "location": 100,
        "employment_type": 30,
        "metadata_application_link": 255,
        "metadata_source": 100,
    },
)
CLEAN_JOBS = Table(
    LANDING,
    "clean_jobs",
    "id BIGINT, title STRING, role_key STRING, role STRING, company_key STRING, company STRING, "
    "location_key STRING, location STRING, country STRING, city STRING, "
    "employment_type_key STRING, employment_type STRING, date_posted DATE, "
    "job_description STRING, toolset_list STRING, metadata_lastupdated TIMESTAMP_NTZ, "
    "metadata_application_link STRING, metadata_source STRING",
    key=("id",),
    limits={
        "title": 100,
        "role_key": 32,
        "role": 50,
        "company_key": 32,
        "company": 100,
        "location_key": 32,
        "location": 100,
        "country": 50,
        "city": 50,
        "employment_type_key": 32,
        "employment_type": 100,
        "toolset_list": 500,
        "metadata_application_link": 255,
        "metadata_source": 100,
    },
)
ROLE_DIM = Table(
    PRESENTATION,
    "role_dim",
    "role_pk STRING, role STRING",
    key=("role_pk",),
    unique=("role",),
    limits={"role_pk": 32, "role": 30},
)
EMPLOYMENT_TYPE_DIM = Table(
    PRESENTATION,
    "employment_type_dim",
    "employment_type_pk STRING, employment_type STRING",
    key=("employment_type_pk",),
    unique=("employment_type",),
    limits={"employment_type_pk": 32, "employment_type": 30},
)
LOCATION_DIM = Table(
    PRESENTATION,
    "location_dim",
    "location_pk STRING, country STRING, city STRING",
    key=("location_pk",),
    limits={"location_pk": 32, "country": 30, "city": 30},
)
COMPANY_DIM = Table(
    PRESENTATION,
    "company_dim",
    "company_pk STRING, company STRING",
    key=("company_pk",),
    unique=("company",),
    limits={"company_pk": 32, "company": 50},
)
SENIORITY_DIM = Table(
    PRESENTATION,
    "seniority_dim",
    "seniority_pk STRING, seniority STRING",
    key=("seniority_pk",),
    unique=("seniority",),
    limits={"seniority_pk": 32},
)
DATE_DIM = Table(
    PRESENTATION,
    "date_dim",
    "date_iso_format_pk DATE, date TIMESTAMP_NTZ, num_year INT, num_month_in_year INT, "
    "num_day_in_month INT, num_day_in_week INT, is_holiday_us BOOLEAN, name_month_en STRING, "
    "name_day_en STRING",
    key=("date_iso_format_pk",),
    not_null=(
        "num_day_in_month",
        "num_day_in_week",
        "is_holiday_us",
        "name_month_en",
        "name_day_en",
    ),
)
FACT = Table(
    PRESENTATION,
    "fact_less_table",
    "date_posted_fk DATE, role_fk STRING, company_fk STRING, employment_type_fk STRING, "
    "location_fk STRING, toolset_list STRING, days_opened INT, last_updated TIMESTAMP_NTZ",
    key=("date_posted_fk", "role_fk", "company_fk", "employment_type_fk", "location_fk"),
    limits={
        "role_fk": 32,
        "company_fk": 32,
        "employment_type_fk": 32,
        "location_fk": 32,
        "toolset_list": 500,
    },
    partition_by=("posted_month",),
)
DAILY_SNAPSHOT = Table(
    PRESENTATION,
    "daily_snap_ads_number",
    "snap_date DATE, open_ads BIGINT",
    key=("snap_date",),
    not_null=("open_ads",),
)

TABLES = (
    RAW_JOBS,
    CLEAN_JOBS,
    ROLE_DIM,
    EMPLOYMENT_TYPE_DIM,
    LOCATION_DIM,
    SENIORITY_DIM,
    COMPANY_DIM,
    DATE_DIM,
    FACT,
    DAILY_SNAPSHOT,
)

# First and last day of the default calendar.
CALENDAR_START, CALENDAR_END = "2023-06-01", "2024-02-28"


def conform(df: DataFrame, table: Table) -> DataFrame:
    """The columns of ``table`` by name, in its order and types."""
    return df.select(*[F.col(name).cast(kind).alias(name) for name, kind in table.column_types.items()])


def table_path(root: str, table: Table) -> str:
    return f"{root.rstrip('/')}/{table.zone}/{table.name}"


def create_tables(spark: SparkSession, root: str) -> None:
    """Create both zones and all tables where they do not exist yet."""
    for zone in (LANDING, PRESENTATION):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {zone}")
    for table in TABLES:
        extra = "".join(f", {name} STRING" for name in table.partition_by)
        layout = f"PARTITIONED BY ({', '.join(table.partition_by)}) " if table.partition_by else ""
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {table.zone}.{table.name} ({table.columns}{extra}) "
            f"USING parquet {layout}LOCATION '{table_path(root, table)}'"
        )


def refresh_tables(spark: SparkSession, root: str) -> None:
    """Let the tables of this session's catalog show what has been written to their folders."""
    for table in TABLES:
        name = f"{table.zone}.{table.name}"
        if spark.catalog.tableExists(name) and path_exists(spark, table_path(root, table)):
            if table.partition_by:
                spark.catalog.recoverPartitions(name)
            spark.catalog.refreshTable(name)
