"""CSV input.

Spark matches CSV columns to a schema by position, so files are grouped by
their header line and each group is read once; the groups are then put
together by name.
"""

from __future__ import annotations

import csv
import io
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaykit import constants as K

MAX_HEADER, READERS = 1 << 16, 16


class Headers(NamedTuple):
    files: dict[tuple[str, ...], list[str]]  # header -> files
    skipped: dict[str, str]  # file -> why it was left out


def headers(spark: SparkSession, path: str, pattern: str, recursive: bool = False) -> Headers:
    """The header of each file; only its first bytes are read, by a few threads for all files.

    A file that cannot be opened, is empty, or has no header within ``MAX_HEADER`` characters
    is left out, with the reason.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found, skipped = defaultdict(list), {}

    def read(file: str) -> tuple[str, tuple[str, ...] | None, str]:
        try:
            columns = _header(_first_record(jvm, fs, file))
            return file, columns, "" if columns else "no header"
        except Exception as e:  # noqa: BLE001 - whatever keeps a file from being read is its reason
            return file, None, str(e).splitlines()[0][:200] if str(e) else type(e).__name__

    with ThreadPoolExecutor(READERS) as pool:
        for file, columns, reason in pool.map(read, sorted(_list(fs, root, pattern, recursive))):
            if columns:
                found[columns].append(file)
            else:
                skipped[file] = reason
    return Headers(dict(found), skipped)


def unreadable_files(spark: SparkSession, path: str, pattern: str = "*.csv", recursive: bool = False) -> DataFrame:
    """The files that a scan leaves out: ``file`` and ``reason``."""
    skipped = headers(spark, path, pattern, recursive).skipped
    return spark.createDataFrame(sorted(skipped.items()), "file string, reason string")


def _list(fs, root, pattern: str, recursive: bool):
    import fnmatch

    if not fs.exists(root):
        return
    files = fs.listFiles(root, recursive)
    while files.hasNext():
        path = files.next().getPath()
        if fnmatch.fnmatchcase(path.getName().lower(), pattern.lower()):
            yield path.toString()


def _first_record(jvm, fs, file: str) -> str:
    """The first lines up to the end of a record, quoted line feeds included."""
    stream = fs.open(jvm.org.apache.hadoop.fs.Path(file))
    try:
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        text = ""
        while len(text) <= MAX_HEADER:
            line = reader.readLine()
            if line is None:
                return text
            text += line
            if text.count('"') % 2 == 0:
                return text
            text += "\n"
    finally:
        stream.close()
    raise ValueError(f"no header within {MAX_HEADER} characters")


def _header(record: str) -> tuple[str, ...] | None:
    if not record.strip():
        return None
    return tuple(c.strip() for c in next(csv.reader(io.StringIO(record.lstrip("\ufeff")), skipinitialspace=True)))


def read_group(spark: SparkSession, columns: tuple[str, ...], files: list[str]) -> DataFrame:
    """Files with one header, every column as text."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return (
        spark.read.option("header", True)
        .option("mode", "PERMISSIVE")
        .option("enforceSchema", True)
        .option("escape", '"')
        .schema(schema)
        .csv(files)
    )


def union_sources(frames: list[DataFrame]) -> DataFrame:
    """Rows of all frames, columns united by name, duplicates kept."""
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.unionByName(frame, allowMissingColumns=True)
    return whole


def scan_csv_dir(spark: SparkSession, path: str) -> DataFrame:
    """Every ``*.csv`` directly in ``path``; unreadable or empty files are left out."""
    groups = headers(spark, path, "*.csv").files
    if not groups:
        raise FileNotFoundError(f"no readable CSV in {path}")
    return union_sources([read_group(spark, cols, files) for cols, files in groups.items()])


def scan_delay_cause(
    spark: SparkSession, path: str, filename: str = "airline_delay_cause.csv"
) -> DataFrame | None:
    """Files of that name anywhere below ``path`` that look like a delay-cause report."""
    groups = headers(spark, path, filename, recursive=True).files
    marks = {"carrier", "airport", "carrier_delay"}
    frames = [
        read_group(spark, cols, files) for cols, files in groups.items() if marks & set(cols)
    ]
    return union_sources(frames) if frames else None


def scan_single_csv(spark: SparkSession, file: str) -> DataFrame:
    return (
        spark.read.option("header", True).option("mode", "PERMISSIVE").csv(file)
    )


def typed_delay_cause(df: DataFrame) -> DataFrame:
    """Measures of a text-only report as doubles, bad text as null."""
    from delaykit.functions.numbers import to_number

    return df.withColumns(
        {c: to_number(F.col(c)) for c in K.REPORT_NUMERIC if c in df.columns}
    )
