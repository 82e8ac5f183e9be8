"""Session settings and the shared folder for written intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # A join on company or location may meet one key with a third of all rows.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Checked at run time by AQE against the measured size of the side.
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.compression.codec": "zstd",
}


def build_session(app: str = "hirelake", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators are written for."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written intermediate table or a streaming checkpoint.

    It lies in the shared folder the cluster names in ``spark.checkpoint.dir``. Only a local
    session, where driver and executors are one process, may go without that setting.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = tempfile.mkdtemp(prefix="hirelake-")
    return f"{base.rstrip('/')}/hirelake/{name}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whichever file system its scheme names."""
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path) and fs.getFileStatus(hadoop_path).isDirectory()


def rename_path(spark: SparkSession, path: str, to: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    if not fs.rename(hadoop_path, spark.sparkContext._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"{path} could not be renamed to {to}")


def delete_path(spark: SparkSession, path: str) -> None:
    """Removes a folder this library wrote, if it is there."""
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def folders_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders inside a folder; none if it isn't there."""
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(hadoop_path) if f.isDirectory())


def files_in(spark: SparkSession, path: str) -> list[str]:
    """Names of the files inside a folder; none if it isn't there."""
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(f.getPath().getName() for f in fs.listStatus(hadoop_path) if f.isFile())


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file that must not exist."""
    fs, hadoop_path = _file_system(spark, path)
    out = fs.create(hadoop_path, False)
    out.write(bytearray(text.encode()))
    out.close()


def read_text(spark: SparkSession, path: str) -> str:
    """The content of a small file."""
    fs, hadoop_path = _file_system(spark, path)
    size = fs.getFileStatus(hadoop_path).getLen()
    stream = fs.open(hadoop_path)
    try:
        return bytes(stream.readNBytes(size)).decode()
    finally:
        stream.close()
