"""JSON lines, JSON arrays, tar bundles, CSV and checksum lists."""

from __future__ import annotations

import gzip
import io
import json
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.sources.files import filesystem, replacing


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One object a line, gzip by suffix; a line that does not fit the schema fails."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_json_array(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").json(path)


def write_jsonl(df: DataFrame, path: str, split: str | None = None) -> None:
    """Gzip lines, a folder for each split; an existing output is an error."""
    w = df.write.mode("errorifexists").option("compression", "gzip").option("ignoreNullFields", False)
    (w.partitionBy(split) if split else w).json(path)


def write_csv(df: DataFrame, path: str, blank: tuple[str, ...] = ()) -> None:
    """One CSV file with a header; nested columns as JSON, and blank columns for reviewers.
    For tables that people read."""
    nested = (T.ArrayType, T.MapType, T.StructType)
    columns = [F.to_json(f.name).alias(f.name) if isinstance(f.dataType, nested) else F.col(f.name) for f in df.schema]
    df.select(*columns, *(F.lit("").alias(b) for b in blank)).coalesce(1).write.mode("errorifexists").csv(path, header=True, escape='"')


def write_pretty(path: str, value: object) -> None:
    """A small value as JSON with sorted keys; the file appears whole or not at all."""
    with replacing(path) as out:
        out.write(json.dumps(value, ensure_ascii=False, indent=2, sort_keys=True).encode())


def files_under(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """(path) of the files below a folder; their content is not read."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").where(F.col("path").endswith(suffix))


def numbered_lines(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """(path, line_no, text) of the files' lines, counted from 1, blank ones too.

    Each file is streamed by one task, so a gzip file of any size takes a line's memory."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                store, at = filesystem(name)
                with store.open_input_stream(at, compression=None) as raw:
                    stream = gzip.GzipFile(fileobj=raw) if name.endswith(".gz") else raw
                    rows: list[tuple[int, str]] = []
                    for i, line in enumerate(io.TextIOWrapper(stream, encoding="utf-8", newline="\n"), 1):
                        rows.append((i, line.rstrip("\r\n")))
                        if len(rows) == 1000:
                            yield _lines(name, rows)
                            rows = []
                    if rows:
                        yield _lines(name, rows)

    return files_under(spark, path, suffix).mapInArrow(read, "path string, line_no long, text string")


def _lines(name: str, rows: list[tuple[int, str]]) -> pa.RecordBatch:
    numbers, texts = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array([name] * len(rows)), pa.array(numbers, pa.int64()), pa.array(texts, pa.string())], names=["path", "line_no", "text"])


def read_bundles(spark: SparkSession, path: str, suffix: str = ".json") -> DataFrame:
    """(bundle, member, text) of the members of tar archives, without a BOM. An archive is
    streamed by one task, a member at a time."""

    def members(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                store, at = filesystem(name)
                with store.open_input_stream(at, compression=None) as raw, tarfile.open(fileobj=raw, mode="r|*") as tar:
                    for m in tar:
                        if m.isfile() and m.name.endswith(suffix):
                            text = tar.extractfile(m).read().decode("utf-8-sig")
                            yield pa.RecordBatch.from_pylist([{"bundle": name, "member": m.name, "text": text}])

    return files_under(spark, path).mapInArrow(members, "bundle string, member string, text string")


def read_checksums(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, sha256, path) of lines 'hex  path'; malformed lines have nulls, blank ones
    are left out."""
    part = lambda i: F.regexp_extract("text", r"^([0-9a-f]{64}) +(.+)$", i)
    fits = F.col("text").rlike(r"^[0-9a-f]{64} +.+$")
    lines = numbered_lines(spark, path).where(F.trim("text") != "")
    return lines.select("line_no", F.when(fits, part(1)).alias("sha256"), F.when(fits, part(2)).alias("path"))


def file_hashes(spark: SparkSession, path: str) -> DataFrame:
    """(path, sha256) of files of up to 2 GiB."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path", F.sha2("content", 256).alias("sha256"))


def markdown(rows: list[tuple], header: tuple[str, ...]) -> str:
    """A small table in Markdown."""
    line = lambda cells: "| " + " | ".join(map(str, cells)) + " |"
    return "\n".join([line(header), line(["---"] * len(header)), *map(line, rows)])


def latex(rows: list[tuple], header: tuple[str, ...]) -> str:
    """A small table in LaTeX; what it reads as a command is escaped."""
    cell = lambda c: "".join("\\" + x if x in "&%$#_{}" else x for x in str(c))
    line = lambda cells: " & ".join(map(cell, cells)) + r" \\"
    return "\n".join([r"\begin{tabular}{" + "l" * len(header) + "}", line(header), r"\hline", *map(line, rows), r"\end{tabular}"])
