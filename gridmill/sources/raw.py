"""Readers of landed files (rows S01, S03, S05, S06, S16 to S18)."""

from __future__ import annotations

import io
import itertools
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from gridmill.schema import BRONZE, GKG

CORRUPT = "_corrupt_record"


def scan_parquet(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """A Parquet table; only the named columns are read."""
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def scan_csv(spark: SparkSession, path: str, schema: str | StructType) -> DataFrame:
    """CSV with a header row under a declared schema."""
    return spark.read.csv(path, header=True, schema=schema, mode="FAILFAST")


def scan_jsonl(spark: SparkSession, path: str, schema: StructType = BRONZE, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """JSON lines; blank lines are skipped. Bad lines are an error if ``strict``, else the second table holds them."""
    if strict:
        return spark.read.schema(schema).option("mode", "FAILFAST").json(path), spark.createDataFrame([], f"{CORRUPT} string")
    wide = StructType([*schema.fields]).add(CORRUPT, StringType())
    lines = spark.read.text(path).filter(F.trim("value") != "")
    rows = lines.select(F.from_json("value", wide, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r"), "value")
    # A line that is JSON but no object has no field at all; it counts as bad, too.
    bad = F.col(f"r.{CORRUPT}").isNotNull() | F.col("r").isNull() | ~F.ltrim("value").startswith("{")
    return rows.filter(~bad).select(*[F.col(f"r.{f.name}") for f in schema.fields]), rows.filter(bad).select(F.col("value").alias(CORRUPT))


def scan_gkg(spark: SparkSession, path: str) -> DataFrame:
    """Unpacked knowledge-graph files: 27 tab-separated string columns, Latin-1, no header. Short rows have nulls at the end; a file wider than that is an error."""
    lines = spark.read.option("encoding", "ISO-8859-1").option("sep", "\t").option("quote", "").option("mode", "PERMISSIVE")
    wide = StructType([*GKG.fields]).add("_extra", StringType())
    df = lines.schema(wide).csv(path)
    return df.withColumn("_ok", F.when(F.col("_extra").isNotNull(), F.raise_error(F.lit("a row has more than 27 columns"))).otherwise(True)).filter("_ok is null or _ok").select(*GKG.names)


def gkg_archives(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Zipped knowledge-graph files, given as ``path`` and ``content``: the rows of each archive's first member with the path, and the archives that cannot be read with the reason.

    An archive is looked through before its rows leave the task, so a broken one, an
    empty one, or one with a row of more than 27 columns gives no row at all. Archives
    are read side by side, each by one task that holds its packed bytes and a batch of
    its lines. Blank lines are skipped; empty cells and those missing at a row's end are
    null.
    """

    def lines_of(archive: zipfile.ZipFile) -> Iterator[str]:
        with archive.open(archive.namelist()[0]) as packed, io.TextIOWrapper(packed, "latin-1", newline="\n") as text:
            yield from (line for line in (raw.rstrip("\r\n") for raw in text) if line.strip())

    def fault_of(content: bytes) -> str | None:
        try:
            with zipfile.ZipFile(io.BytesIO(content)) as archive:
                if not archive.namelist():
                    return "the archive is empty"
                widest = max((line.count("\t") + 1 for line in lines_of(archive)), default=0)
        except (zipfile.BadZipFile, zlib.error, EOFError, NotImplementedError, RuntimeError) as error:
            return f"no readable archive: {error}"
        return f"a row has {widest} columns" if widest > len(GKG.names) else None

    def unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(path: str, lines: list[str | None], reason: str | None) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([path] * len(lines), pa.string()), pa.array(lines, pa.string()), pa.array([reason] * len(lines), pa.string())], ["path", "line", "reason"])

        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                raw = content.as_py() or b""
                if reason := fault_of(raw):
                    yield batch_of(path.as_py(), [None], reason)
                    continue
                with zipfile.ZipFile(io.BytesIO(raw)) as archive:
                    lines = lines_of(archive)
                    while some := list(itertools.islice(lines, 10_000)):
                        yield batch_of(path.as_py(), some, None)

    read = files.select("path", "content").mapInArrow(unpacked, "path string, line string, reason string")
    cells = F.split("line", "\t", -1)
    rows = read.filter("reason is null").select("path", *[F.nullif(F.get(cells, F.lit(i)), F.lit("")).alias(name) for i, name in enumerate(GKG.names)])
    return rows, read.filter("reason is not null").select("path", "reason")


def scan_gkg_archives(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """``gkg_archives`` of the files under a path; files of no bytes are not listed."""
    return gkg_archives(spark.read.format("binaryFile").load(path))


def scan_bulletins(spark: SparkSession, path: str) -> DataFrame:
    """Whole files of bulletin text, blank ones and error replies left out; the key is the file's name without extension."""
    df = spark.read.text(path, wholetext=True).select(F.regexp_extract(F.input_file_name(), r"([^/]+?)(?:\.[^./]*)?$", 1).alias("pil"), F.col("value").alias("response"))
    return df.filter(F.trim("response", F.lit(" \t\r\n")) != "").filter(~F.ltrim("response").startswith("ERROR:"))


def scan_nested(spark: SparkSession, path: str, schema: str, array: str) -> DataFrame:
    """API replies, one JSON document a file, with a row for each item of the array; a reply without items keeps one row."""
    df = spark.read.schema(schema).json(path, multiLine=True)
    return df.select(*[c for c in df.columns if c != array], F.explode_outer(array).alias("item"))
