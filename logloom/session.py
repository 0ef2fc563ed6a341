"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}
_SHIPPED: dict[str, str] = {}


def build_session(app: str = "logloom", master: str | None = None, **conf) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Timestamps without a zone are read and shown as UTC everywhere in this package."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ship_package(spark: SparkSession) -> SparkSession:
    """Python workers can import this package wherever the job was started from.

    The sources are sent once per application, as one zip that Spark serves.
    """
    context = spark.sparkContext
    if _SHIPPED.get("application") != context.applicationId:
        folder = tempfile.mkdtemp(prefix="logloom-code-")
        top = os.path.dirname(os.path.abspath(__file__))
        archive = os.path.join(folder, "logloom_code.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for path, _, names in os.walk(top):
                for name in sorted(n for n in names if n.endswith(".py")):
                    full = os.path.join(path, name)
                    out.write(full, os.path.relpath(full, os.path.dirname(top)))
        context.addPyFile(archive)
        _SHIPPED["application"] = context.applicationId
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can read and write: ``spark.checkpoint.dir``.

    A local temporary folder is used only when the setting is missing and the
    session runs in local mode (tests); a cluster must name a shared folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = spark.sparkContext.getCheckpointDir()
    if not folder:
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="logloom-"))
        folder = spark.sparkContext.getCheckpointDir()
    return folder


def new_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder; all paths of one application lie in one folder."""
    return f"{shared_folder(spark)}/logloom/{spark.sparkContext.applicationId}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, packed: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used where a plan reads the same rows twice and both reads have to agree on
    positions (file splits), and to cut lineage so a lost executor costs little.
    ``packed`` tables hold whole texts; they are written with zstd.
    """
    path = new_path(df.sparkSession, label)
    (df.write.option("compression", "zstd") if packed else df.write).parquet(path)
    return df.sparkSession.read.parquet(path)


def discard(staged: DataFrame) -> None:
    """Deletes a staged table that nothing reads any more."""
    spark = staged.sparkSession
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for folder in {f.rsplit("/", 1)[0] for f in staged.inputFiles()}:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        # only what this application has staged lies in such a folder
        if path.getParent().getName() == spark.sparkContext.applicationId:
            path.getFileSystem(conf).delete(path, True)
