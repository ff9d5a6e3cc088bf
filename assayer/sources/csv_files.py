"""CSV files as they come: columns are found by the names in each file's header, and a record that does not fit is kept apart.

Spark's own reader takes columns by position. Files with the same header are therefore read together, each group with a
schema in the order of its header; records with too few or too many fields come back as text and go to the quarantine. Only
headers pass through the driver.
"""

from __future__ import annotations

import csv
import io
from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.scratch import written
from assayer.sources.files import CSV_OPTIONS

MOST_HEADERS = 200  # different headers in a folder, each of which is a branch of the plan
HEADERS_AT_ONCE = 32  # files whose headers are read at a time
HEADER_LINES = 100  # a header with more line breaks than this inside quotes is none

_BAD = "_malformed"
_TOLERANT = CSV_OPTIONS | {
    "multiLine": True,
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _BAD,
    "columnPruning": False,
}


@dataclass(frozen=True)
class Arrived:
    """`rows` (the declared columns as text, and `_source_file`) and `quarantine` (_source_file, _record, _reason)."""

    rows: DataFrame
    quarantine: DataFrame

    def counts(self) -> DataFrame:
        """(source_file, reason, n): the reason of accepted rows is NULL."""
        each = self.rows.select("_source_file", F.lit(None).cast("string").alias("reason"))
        each = each.union(self.quarantine.select("_source_file", "_reason"))
        return each.groupBy(F.col("_source_file").alias("source_file"), "reason").agg(F.count(F.lit(1)).alias("n"))


def _header(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The names in the first record of a file, through the file system that Spark reads it with."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    place = jvm.org.apache.hadoop.fs.Path(path)
    stream = place.getFileSystem(conf).open(place)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(place)
        content = stream if codec is None else codec.createInputStream(stream)
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(content, "UTF-8"))
        lines: list[str] = []
        while len(lines) < HEADER_LINES and (line := reader.readLine()) is not None:
            if line or lines:  # Spark, too, passes over empty lines
                lines.append(line)
                if "\n".join(lines).count('"') % 2 == 0:
                    break
    finally:
        stream.close()
    text = "\n".join(lines).removeprefix("﻿")
    return tuple(next(csv.reader(io.StringIO(text)), []))


def headers(spark: SparkSession, path: str, pattern: str = "*") -> dict[str, tuple[str, ...]]:
    """The header of each file under `path`; an empty file has none."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path)
    names = [row.path for row in listed.select("path").collect()]  # a name for each file, as in Spark's own listing
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        return dict(zip(names, pool.map(lambda name: _header(spark, name), names)))


def _reason(record: Column, fields: int) -> Column:
    """Why a record of a file with so many fields is malformed."""
    bare = F.regexp_replace(record, '"([^"]|"")*"', "")
    found = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    return (
        F.when(record.isNull(), None)
        .when(F.contains(bare, F.lit('"')), "open quote")
        .when(found < fields, F.concat(F.lit("too few fields: "), found.cast("string"), F.lit(f" of {fields}")))
        .when(found > fields, F.concat(F.lit("too many fields: "), found.cast("string"), F.lit(f" of {fields}")))
        .otherwise("malformed")
    )


def read_arrived(
    spark: SparkSession, path: str, columns: list[str], position: str | None = None, pattern: str = "*", optional: tuple[str, ...] = ()
) -> Arrived:
    """The records of all CSV files under `path`.

    Columns are taken by name, whatever their order; names are compared without the spaces around them, other columns
    are not read. A file may lack the `optional` columns, which are NULL then. A file whose header lacks another declared column, or names
    one twice, goes to the quarantine line by line, its first line included. An empty field is NULL. Free text may span lines. A quote that is never
    closed takes the lines up to the next quote into its record: no text is lost, but the record is in the quarantine
    only if its number of fields is wrong. `position` as in `read_csv`.
    """
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    for name, header in headers(spark, path, pattern).items():
        groups[tuple(n.strip() for n in header)].append(name)
    if len(groups) > MOST_HEADERS:
        raise ValueError(f"{len(groups)} different headers; read the files in parts")
    source = F.col("_metadata.file_name").alias("_source_file")
    none = F.lit(None).cast("string")
    fields = [T.StructField(c, T.StringType()) for c in [*columns, "_source_file", "_record", "_reason"]]
    parts = [spark.createDataFrame([], T.StructType(fields))]
    for header, names in sorted(groups.items()):
        lacking = [c for c in columns if c not in header and c not in optional]
        twice = [c for c in columns if header.count(c) > 1]
        if not header:
            continue
        if lacking or twice:
            why = "no column " + ", ".join(lacking) if lacking else "more than one column " + ", ".join(twice)
            lines = spark.read.text(names).where("value <> ''")
            parts.append(lines.select(*[none.alias(c) for c in columns], source, F.col("value").alias("_record"), F.lit(why).alias("_reason")))
            continue
        # Names of their own, so that equal names of columns nobody asked for do not clash.
        schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(header))] + [T.StructField(_BAD, T.StringType())])
        # Spark counts only the fields it is asked for, so all are.
        found = spark.read.schema(schema).options(**_TOLERANT).csv(names)
        taken = [F.col(f"_c{header.index(c)}").alias(c) if c in header else none.alias(c) for c in columns]
        parts.append(found.select(*taken, source, F.col(_BAD).alias("_record"), _reason(F.col(_BAD), len(header)).alias("_reason")))
    # Written, as accepted rows and quarantine would each parse the files.
    every = written(reduce(DataFrame.union, parts), "arrived")
    rows = every.where("_reason is null").select(*columns, "_source_file")
    if position is not None:
        rows = rows.withColumn(position, F.monotonically_increasing_id())
    return Arrived(rows, every.where("_reason is not null").select("_source_file", "_record", "_reason"))
