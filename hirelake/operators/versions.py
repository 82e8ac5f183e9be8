"""Tables whose content is replaced at once: version folders and a pointer to the current one.

A table is a folder of versions, written beside each other, and a folder of pointers. A version is
written completely before its pointer is; the pointer comes into being by one rename, and the one with
the highest number counts. So a reader sees the old rows or the new ones, never a mixture and never
nothing, and a load that is lost leaves nothing but an unnamed folder. Old versions stay for readers
that have begun with them, until ``vacuum`` is told how many to keep.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from hirelake.session import delete_path, files_in, folders_in, read_text, rename_path, write_text

POINTERS, DATA = "_pointers", "data"


class Conflict(RuntimeError):
    """Another writer has published a version in the meantime; nothing was changed."""


def _name(version: int) -> str:
    return f"v{version:012d}"


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the published versions, oldest first."""
    return [int(name[1:]) for name in files_in(spark, f"{path.rstrip('/')}/{POINTERS}") if name[:1] == "v"]


def current_version(spark: SparkSession, path: str) -> int:
    """The version readers see; 0 before the first one."""
    return max(versions(spark, path), default=0)


def _pointer(spark: SparkSession, path: str, version: int) -> tuple[str, T.StructType]:
    """Folder and schema of a version; without rows a folder doesn't tell its columns."""
    folder, schema = read_text(spark, f"{path}/{POINTERS}/{_name(version)}").split("\n", 1)
    return folder, T.StructType.fromJson(json.loads(schema))


def publish(spark: SparkSession, df: DataFrame, path: str, expected: int | None = None, partition: str | None = None) -> int:
    """Writes the rows as the table's next version and makes it the current one; returns its number.

    ``df`` may read the table itself. ``expected`` is the version it was made from (by default the
    current one at the start of the call): if another writer has published since, Conflict is raised and
    the table stays as that writer left it. Schemas of versions may differ.
    """
    return publish_all(spark, {path: df}, {path: expected} if expected is not None else {}, partition)[path]


def publish_all(
    spark: SparkSession, tables: Mapping[str, DataFrame], expected: Mapping[str, int] | None = None, partition: str | None = None
) -> dict[str, int]:
    """Writes several tables, and only when all are complete makes them current, one rename each.

    A load that fails while it writes, however late, changes no table at all.
    """
    written = {}
    base = {path: (expected or {}).get(path, current_version(spark, path.rstrip("/"))) for path in tables}
    for path, df in tables.items():
        folder = uuid.uuid4().hex
        writer = df.write.partitionBy(partition) if partition else df.write
        writer.parquet(f"{path.rstrip('/')}/{DATA}/{folder}")
        written[path] = folder
    published = {}
    for path, folder in written.items():
        root, version = path.rstrip("/"), base[path] + 1
        # A rename onto a name that exists fails, so of two writers one is told.
        draft = f"{root}/{POINTERS}/.{folder}"
        write_text(spark, draft, f"{folder}\n{tables[path].schema.json()}")
        try:
            if current_version(spark, root) >= version:
                raise OSError("taken")
            rename_path(spark, draft, f"{root}/{POINTERS}/{_name(version)}")
        except OSError as taken:
            delete_path(spark, draft)
            raise Conflict(f"{path} has a version {version} already") from taken
        published[path] = version
    return published


def read_version(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version, by default the current one.

    What is returned goes on reading that version's files, whatever is published afterwards.
    """
    root = path.rstrip("/")
    version = version or current_version(spark, root)
    if version not in versions(spark, root):
        raise AnalysisException(f"{path} has no version {version}")
    folder, schema = _pointer(spark, root, version)
    return spark.read.schema(schema).parquet(f"{root}/{DATA}/{folder}")


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Removes all but the newest ``keep`` versions and what lost loads have left; returns how many folders.

    To be run while no load of this table runs; readers of the versions that stay aren't disturbed.
    """
    root = path.rstrip("/")
    kept = sorted(versions(spark, root))[-max(keep, 1) :]
    used = {_pointer(spark, root, v)[0] for v in kept}
    for version in set(versions(spark, root)) - set(kept):
        delete_path(spark, f"{root}/{POINTERS}/{_name(version)}")
    unused = [name for name in folders_in(spark, f"{root}/{DATA}") if name not in used]
    for name in unused:
        delete_path(spark, f"{root}/{DATA}/{name}")
    return len(unused)
