"""File sources: fixed-width reference text and per-file checksums."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a block, the unit of a file's digest.
BLOCK_BYTES = 4 << 20
MANIFEST_SCHEMA = "file string, bytes long, digest string"


def fixed_width_reference(spark: SparkSession, path: str, code_start: int = 7, code_len: int = 7,
                          text_start: int = 78) -> DataFrame:
    """``src_fixed_width``: code in columns 7-13, text from column 78
    (1-based), both trimmed and non-empty. Of a code's lines the last wins;
    ``conflicting`` says that they differ.

    A line's place is its file, the start of the block that it was read in
    and its number in the task: lines of a block are read in order, so no
    line is counted and the files stay splittable. Files go by name, as they
    are written by Spark."""
    lines = spark.read.text(path).select(
        "value", F.struct(F.col("_metadata.file_path"), F.col("_metadata.file_block_start"),
                          F.monotonically_increasing_id().alias("row")).alias("at"))
    parsed = lines.select(
        F.trim(F.substring("value", code_start, code_len)).alias("code"),
        F.trim(F.expr(f"substring(value, {text_start})")).alias("text"), "at")
    parsed = parsed.where((F.col("code") != "") & (F.col("text") != ""))
    return parsed.groupBy("code").agg(F.max_by("text", "at").alias("description"), F.count(F.lit(1)).alias("n_lines"),
                                      (F.min("text") != F.max("text")).alias("conflicting"))


def _opened(uri: str):
    """The file of a path as Spark names it, for reading at offsets."""
    from pyarrow import fs
    scheme, colon, rest = uri.partition(":")
    if not colon or scheme == "file":
        return fs.LocalFileSystem().open_input_file("/" + rest.lstrip("/") if colon else uri)
    system, path = fs.FileSystem.from_uri(uri)
    return system.open_input_file(path)


def _block_digests(task_blocks: int, block_bytes: int):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                blocks, digests = [], []
                with _opened(row["path"]) as f:
                    f.seek(row["first"] * block_bytes)
                    for k in range(row["first"], row["first"] + task_blocks):
                        if k * block_bytes >= row["length"]:
                            break
                        blocks.append(k)
                        digests.append(hashlib.sha256(f.read(block_bytes)).hexdigest())
                n = len(blocks)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["path"]] * n), pa.array([row["length"]] * n, pa.int64()), pa.array(blocks, pa.int64()),
                     pa.array(digests)], ["path", "length", "block", "digest"])
    return run


def file_checksums(spark: SparkSession, base_dir: str, glob: str = "*", task_blocks: int = 32,
                   block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``src_file_checksum``: size and digest of every file under ``base_dir``,
    those in the folders of multi-file tables too, by its path below
    ``base_dir``.

    The digest is the SHA-256 of the hexadecimal SHA-256 digests of the
    file's blocks in order, so a file of any size is read by many tasks,
    ``task_blocks`` blocks at a time, whose number doesn't change it; a task
    holds one block. Spark lists the files without their contents, and leaves
    empty files out, so one that was emptied counts as missing. Tasks read by
    ``pyarrow.fs``, so paths must be local, shared or of a store it knows.
    """
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(base_dir).select("path", "length"))
    last = (F.ceil(F.col("length") / block_bytes) - 1).cast("long")
    parts = files.where("length > 0").select("path", "length", F.explode(F.sequence(F.lit(0).cast("long"), last, F.lit(task_blocks).cast("long"))).alias("first"))
    # A stated number of partitions: AQE would merge such few rows into one task.
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    blocks = parts.repartition(tasks, "path", "first").mapInArrow(_block_digests(task_blocks, block_bytes),
                                                                  "path string, length long, block long, digest string")
    joined = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("block", "digest"))), lambda b: b["digest"]), "")
    name = base_dir.rstrip("/").rsplit("/", 1)[-1]
    return blocks.groupBy("path", "length").agg(F.sha2(joined, 256).alias("digest")).select(
        F.regexp_replace(F.expr(f"substring_index(path, '/{name}/', -1)"), "^/+", "").alias("file"),
        F.col("length").alias("bytes"), "digest")


def files_signature(spark: SparkSession, paths: list[str]) -> str:
    """A mark that changes with the names, lengths or times of the files at
    ``paths`` (as ``inputFiles`` gives them): a key for what was derived from
    them. Contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load([unquote(p) for p in paths])
    mark = F.xxhash64("path", "length", "modificationTime").cast("decimal(38,0)")
    return ":".join(str(v) for v in files.agg(F.count(F.lit(1)), F.sum(mark), F.sum(F.col("length"))).first())


def landed_manifest(spark: SparkSession, base_dir: str, path: str, glob: str = "*") -> DataFrame:
    """The manifest of the files under ``base_dir``, stored at ``path`` when
    they were first seen: a later call reads it and reads no file."""
    try:
        return spark.read.schema(MANIFEST_SCHEMA).parquet(path)
    except AnalysisException as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
    file_checksums(spark, base_dir, glob).coalesce(1).write.parquet(path)
    return spark.read.schema(MANIFEST_SCHEMA).parquet(path)


def verify_checksums(checksums: DataFrame, manifest: DataFrame) -> DataFrame:
    """Observed checksums against a manifest ``(file, digest)``; ``valid`` is
    False for a file that differs, is missing or isn't in the manifest."""
    m = manifest.select("file", F.col("digest").alias("expected"))
    j = m.join(checksums, "file", "full_outer")
    return j.select("file", "bytes", "digest", "expected",
                    F.coalesce(F.col("digest") == F.col("expected"), F.lit(False)).alias("valid"))
