"""Pictures of documents as files, one per different content.

A file is named by the SHA-256 of its bytes, so equal pictures share a file and a
task that runs again writes the same names. It is written under a name of the
attempt and moved to its place whole. The index table is written last: a name in
it always has its file.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from logloom.functions.paths import suffix
from logloom.session import ship_package
from logloom.sinks.writers import image_table


def _place(path: str):
    """The store and the path in it; a path without a scheme is a local one."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[len("file:") :].lstrip("/")
    return fs.FileSystem.from_uri(path)


def _writer(path: str):
    def write(batches):
        from pyarrow import fs

        store, root = _place(path)
        for rows in batches:
            for name, data in zip(rows.column("file"), rows.column("data")):
                if not data.is_valid:
                    continue
                target = f"{root}/{name}"
                if store.get_file_info(target).type == fs.FileType.NotFound:
                    store.create_dir(target.rsplit("/", 1)[0], recursive=True)
                    part = f"{target}.{uuid.uuid4().hex}.part"
                    with store.open_output_stream(part) as out:
                        out.write(data.as_buffer())
                    store.move(part, target)
            yield rows.select([c for c in rows.schema.names if c != "data"])

    return write


def write_images(documents: DataFrame, path: str, key: str = "path", mode: str = "errorifexists") -> None:
    """Files under ``path/files`` and, written last, ``path/index``: ``key, filename, content_type, n_bytes, file``.

    Pictures without bytes get a row without a file name. Names keep the suffix of
    the picture, in lower case. ``path`` lies on a store that pyarrow can write
    (a shared folder, S3, GCS, Azure, HDFS).
    """
    pictures = image_table(documents, key)
    hashed = F.sha2("data", 256)
    named = pictures.withColumn("file", F.concat(F.lit("files/"), F.left(hashed, F.lit(2)), F.lit("/"), hashed, F.lower(suffix(F.col("filename")))))
    rows = named.select(key, "filename", "content_type", F.octet_length("data").cast("bigint").alias("n_bytes"), "file", "data")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.drop("data").schema)
    ship_package(documents.sparkSession)
    # documents without pictures leave an empty folder
    store, root = _place(path)
    store.create_dir(f"{root}/files", recursive=True)
    rows.mapInArrow(_writer(path), fields).write.mode(mode).parquet(f"{path}/index")


def read_images(spark, path: str) -> DataFrame:
    """The index with the bytes of each file; a file that several rows name is read once."""
    index = spark.read.parquet(f"{path}/index")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(f"{path}/files")
    named = files.select(F.regexp_extract("path", "(files/[0-9a-f]{2}/[^/]+)$", 1).alias("file"), F.col("content").alias("data"))
    # scans leave empty files out
    empty = F.when(F.col("n_bytes") == 0, F.lit(bytearray()))
    return index.join(named, "file", "left").withColumn("data", F.coalesce("data", empty))
