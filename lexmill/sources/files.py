"""Artifacts on a file system: {root}/{folder}/{type}/{id}.{extension}."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import jsondoc
from lexmill.functions.ids import ARTIFACTS, valid_document

_PATH = r"([^/]+)/([^/]+)\.[^./]+$"
_LISTED_AT_ONCE = 10_000


def _located(df: DataFrame, path: str) -> DataFrame:
    return df.withColumns(
        {"type": F.regexp_extract(path, _PATH, 1), "document_id": F.regexp_extract(path, _PATH, 2)}
    )


def _glob(root: str, kind: str) -> str:
    folder, extension = ARTIFACTS[kind]
    return f"{root.rstrip('/')}/{folder}/*/*.{extension}"


def read_texts(spark: SparkSession, root: str) -> DataFrame:
    """(document_id, type, text), one row per file."""
    raw = spark.read.text(_glob(root, "ocr"), wholetext=True).select(
        F.col("value").alias("text"), F.col("_metadata.file_path").alias("path")
    )
    return _located(raw, "path").select("document_id", "type", "text")


def _json_files(spark: SparkSession, root: str) -> DataFrame:
    """All JSON files with their parsed form and whether they can be used."""
    files = spark.read.format("binaryFile").load(_glob(root, "json"))
    raw = files.select(F.col("content").cast("string").alias("json"), "path")
    docs = jsondoc.with_document(_located(raw, "path").select("document_id", "type", "json"))
    usable = F.col("doc._metadata.confidence").isNotNull() | F.col("doc._metadata.source").isNotNull()
    return docs.withColumn("__usable", F.coalesce(usable, F.lit(False)))


def read_json(spark: SparkSession, root: str) -> DataFrame:
    """(document_id, type, json, doc) of documents whose `_metadata` has a confidence or a source."""
    return _json_files(spark, root).where("__usable").drop("__usable")


def unreadable_json(spark: SparkSession, root: str) -> DataFrame:
    """Quarantine: every file that `read_json` leaves out. (Spark's file sources do not list files of zero bytes.)"""
    return _json_files(spark, root).where("not __usable").select("document_id", "type", "json")


def _uri(spark: SparkSession, root: str) -> str:
    """`root` with the scheme that Spark would read it by, for use inside tasks."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root.rstrip("/"))
    uri = path.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(path).toUri().toString()
    return re.sub("^file:/(?=[^/])", "file:///", uri)


def read_inventory(spark: SparkSession, root: str, empty_files: bool = True) -> DataFrame:
    """(document_id, kind, length) of every artifact; contents are not read.

    Folders are listed inside tasks, one for each kind and type, and so include files of zero bytes,
    which Spark's file sources leave out. A task holds the entries of one folder. With
    `empty_files=False` Spark lists the files, on any file system it knows; a root without any
    artifact is then an error and not an empty inventory.
    """
    if not empty_files:
        parts = []
        for kind in ARTIFACTS:
            files = spark.read.format("binaryFile").load(_glob(root, kind)).select("path", "length")
            parts.append(_located(files, "path").select("document_id", F.lit(kind).alias("kind"), "length"))
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out
    uri = _uri(spark, root)

    def types(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind in batch.column(0).to_pylist():
                system, base = fs.FileSystem.from_uri(uri)
                found = system.get_file_info(fs.FileSelector(f"{base}/{ARTIFACTS[kind][0]}", allow_not_found=True))
                paths = [f.path for f in found if f.type == fs.FileType.Directory]
                yield pa.RecordBatch.from_arrays([pa.array([kind] * len(paths), pa.string()), pa.array(paths, pa.string())], ["kind", "folder"])

    def artifacts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for kind, folder in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                system, _ = fs.FileSystem.from_uri(uri)
                ending = f".{ARTIFACTS[kind][1]}"
                # Hidden files are none: writers keep unfinished ones under such names.
                names = (f for f in system.get_file_info(fs.FileSelector(folder)) if f.type == fs.FileType.File)
                found = [f for f in names if f.base_name.endswith(ending) and f.base_name[0] not in "._"]
                for at in range(0, len(found), _LISTED_AT_ONCE):
                    some = found[at : at + _LISTED_AT_ONCE]
                    columns = [pa.array([f.base_name.removesuffix(ending) for f in some]), pa.array([kind] * len(some)), pa.array([f.size for f in some], pa.int64())]
                    yield pa.RecordBatch.from_arrays(columns, ["document_id", "kind", "length"])

    kinds = spark.createDataFrame([(k,) for k in ARTIFACTS], "kind string")
    folders = kinds.mapInArrow(types, "kind string, folder string").repartition("kind", "folder")
    return folders.mapInArrow(artifacts, "document_id string, kind string, length long")


def write_files(artifacts: DataFrame, root: str, kind: str) -> int:
    """One file for each row (document_id, type, content as text or bytes) in the layout; the number written.

    Null content makes an empty file. Rows without a known type or with an id that could leave its
    folder are not written. A file gets its name when it is whole, so a task that runs again, or
    twice at once, leaves the same file; an older one is replaced. Of rows with one id any stays.
    """
    uri = _uri(artifacts.sparkSession, root)
    folder, extension = ARTIFACTS[kind]

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(uri)
        made = set()
        for batch in batches:
            for name, type_, content in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                place = f"{base}/{folder}/{type_}"
                if place not in made:
                    system.create_dir(place, recursive=True)
                    made.add(place)
                unfinished = f"{place}/.{uuid.uuid4().hex}"
                with system.open_output_stream(unfinished) as out:
                    out.write(content or b"")
                system.move(unfinished, f"{place}/{name}.{extension}")
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["n"])

    rows = artifacts.where(valid_document(F.col("type"), F.col("document_id")))
    rows = rows.select("document_id", "type", F.col("content").cast("binary").alias("content"))
    return rows.mapInArrow(write, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def read_payloads(spark: SparkSession, root: str, kind: str = "pdf") -> DataFrame:
    """(document_id, type, content) with the raw bytes."""
    files = spark.read.format("binaryFile").load(_glob(root, kind)).select("path", "content")
    return _located(files, "path").select("document_id", "type", "content")


def write_documents(extractions: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Export extraction JSON, one object per line, partitioned by document type.

    Only extracted, non-empty documents are written.
    """
    chosen = extractions.where((F.col("status") == "EXTRACTED") & (F.length(F.trim("json")) > 0))
    chosen.select("type", F.col("json").alias("value")).write.mode(mode).partitionBy("type").text(path)


def write_artifacts(artifacts: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Texts or payloads as a Parquet table keyed by document_id."""
    artifacts.write.mode(mode).parquet(path)


def append_words(found: DataFrame, known: DataFrame, path: str) -> None:
    """Append the words that are not known yet, sorted."""
    from lexmill.operators.words import new_words

    new_words(found, known).orderBy("word").write.mode("append").parquet(path)


def write_word_counts(counts: DataFrame, path: str) -> None:
    """CSV `word,count` with a header. The files are sorted among themselves as well as within."""
    counts.select("word", F.col("n").alias("count")).orderBy(F.col("count").desc(), "word").write.mode(
        "overwrite"
    ).csv(path, header=True)
