"""Media folders and arriving files."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The extensions picked up from a folder.
MEDIA_EXTENSIONS = ("mp3", "wav", "flac")

BINARY_FILE = T.StructType(
    [
        T.StructField("path", T.StringType()),
        T.StructField("modificationTime", T.TimestampType()),
        T.StructField("length", T.LongType()),
        T.StructField("content", T.BinaryType()),
    ]
)


def _glob(extensions: tuple[str, ...]) -> str:
    return "*.{" + ",".join(extensions) + "}"


def scan_media(
    spark: SparkSession, folder: str, extensions: tuple[str, ...] = MEDIA_EXTENSIONS, recursive: bool = True
) -> DataFrame:
    """Files of a folder as ``path, modificationTime, length, content``.

    Selecting without ``content`` lists files and reads none of them.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", recursive)
        .option("pathGlobFilter", _glob(extensions))
        .load(folder)
    )


def _folder_uri(spark: SparkSession, folder: str, extensions: tuple[str, ...]) -> str:
    """The folder with the scheme and host under which Spark finds its files."""
    if "://" in folder:
        return folder
    plain = folder.removeprefix("file:")
    found = scan_media(spark, folder, extensions).select("path").first()
    host = re.match("[a-z0-9+.-]+://[^/]*", found.path) if found else None
    return (host.group() if host else "file://") + quote(os.path.abspath(plain))


def _list_folder(recursive: bool):
    """Map function from folder URIs to ``uri, is_folder, size`` of what lies in them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                system, path = pafs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", uri))
                prefix = unquote(uri).removesuffix(path)
                found = system.get_file_info(pafs.FileSelector(path, recursive=recursive))
                for at in range(0, len(found), 10_000):
                    part = found[at : at + 10_000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([prefix + f.path for f in part], pa.string()),
                            pa.array([f.type == pafs.FileType.Directory for f in part], pa.bool_()),
                            pa.array([f.size for f in part], pa.int64()),
                        ],
                        names=["uri", "is_folder", "size"],
                    )

    return run


def empty_media(
    spark: SparkSession, folder: str, extensions: tuple[str, ...] = MEDIA_EXTENSIONS, recursive: bool = True
) -> DataFrame:
    """Zero-length files below a folder, which Spark's file sources pass over.

    Tasks list the folders, one per subfolder of ``folder``, through Arrow's
    file systems (local, HDFS, S3 and others it knows). Same columns as
    :func:`scan_media`.
    """
    root = _folder_uri(spark, folder, extensions)
    listing = "uri string, is_folder boolean, size long"
    top = spark.createDataFrame([(root,)], "uri string").mapInArrow(_list_folder(False), listing)
    found = top.filter("NOT is_folder")
    if recursive:
        below = top.filter("is_folder").select(F.replace(F.url_encode("uri"), F.lit("+"), F.lit("%20")).alias("uri"))
        # only the path is encoded, and its separators stay
        below = below.select(F.replace(F.replace("uri", F.lit("%2F"), F.lit("/")), F.lit("%3A"), F.lit(":")).alias("uri"))
        width = spark.sparkContext.defaultParallelism
        deep = below.repartition(width).mapInArrow(_list_folder(True), listing).filter("NOT is_folder")
        found = found.unionByName(deep)
    return found.filter((F.col("size") == 0) & F.substring_index("uri", ".", -1).isin(*extensions)).select(
        F.regexp_replace("uri", "^file:/+", "file:/").alias("path"),
        F.lit(None).cast("timestamp").alias("modificationTime"),
        F.lit(0).cast("bigint").alias("length"),
        F.lit(b"").alias("content"),
    )


def list_media(
    spark: SparkSession, folder: str, extensions: tuple[str, ...] = MEDIA_EXTENSIONS, recursive: bool = True
) -> DataFrame:
    """``path, length`` in path order, without reading any content."""
    return scan_media(spark, folder, extensions, recursive).select("path", "length").orderBy("path")


def stream_media(
    spark: SparkSession,
    folder: str,
    extensions: tuple[str, ...] = MEDIA_EXTENSIONS,
    max_files: int | None = None,
    max_bytes: str | None = None,
) -> DataFrame:
    """Files as they arrive; ``max_files`` or ``max_bytes`` bounds a micro-batch."""
    reader = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", _glob(extensions))
    )
    return _limited(reader, max_files, max_bytes).load(folder)


def stream_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    max_files: int | None = None,
    max_bytes: str | None = None,
) -> DataFrame:
    """A parquet table, file or folder, as a stream of its files."""
    reader = _limited(spark.readStream.format("parquet").schema(schema), max_files, max_bytes)
    # a one-letter class makes the path a pattern, which may be a file or a folder
    path = path.rstrip("/")
    return reader.load(f"{path[:-1]}[{path[-1]}]")


def _limited(reader, max_files: int | None, max_bytes: str | None):
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if max_bytes:
        reader = reader.option("maxBytesPerTrigger", max_bytes)
    return reader


def wrap_items(df: DataFrame, item: str) -> DataFrame:
    """Bare items under the column ``data``."""
    return df.select(F.col(item).alias("data"))


def split_items(lines: DataFrame, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows, quarantined lines) of JSON items in a text frame, batch or stream.

    A line that cannot be read is kept as it is; nothing is dropped silently.
    """
    with_raw = T.StructType([*schema.fields, T.StructField("_raw", T.StringType())])
    options = {"columnNameOfCorruptRecord": "_raw"}
    read = lines.select("value", F.from_json("value", with_raw, options).alias("_item"))
    broken = F.col("_item._raw").isNotNull()
    return read.filter(~broken).select("_item.*").drop("_raw"), read.filter(broken).select("value")


def read_items(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    return split_items(spark.read.text(path).filter("trim(value) <> ''"), schema)
