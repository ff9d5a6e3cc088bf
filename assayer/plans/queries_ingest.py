"""Sources, sinks, landing and bookkeeping."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.functions.hashing import row_hash as row_hash_of
from assayer.functions.numbers import rounded
from assayer.operators import reports
from assayer.operators.curate import make_batches
from assayer.plans import inputs, workspace
from assayer.plans.registry import query, r, with_
from assayer.plans.shared_sql import LABELLED_DOCUMENTS, TO_RAW, TO_STAGING
from assayer.spec import DOUBLE
from assayer.scratch import new_path, written
from assayer.sources import content_ledger, csv_files, files, fingerprint, ledger, tables
from assayer.sources.audit import Run, with_audit
from assayer.sources.landing import Landing, ingest_batches
from assayer.sources.landing import ingest_full as land_full
from assayer.streaming.increments import ingest_arrivals


def _text_time(column: str) -> F.Column:
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def _new_landing(spark: SparkSession) -> Landing:
    return Landing(new_path(spark, "raw"), new_path(spark, "ledger"))


# ---------------------------------------------------------------------------
# files and tables
# ---------------------------------------------------------------------------


@query("csv_roundtrip", "SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars FROM documents")
def csv_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    documents = inputs.table(spark, folder, "documents")
    path = files.export_csv(documents, new_path(spark, "csv"))
    back = files.read_csv(spark, path, documents.columns)
    return back.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.md5("text").alias("text_md5"),
        "lang",
        "source",
        F.col("n_chars").cast("bigint").alias("n_chars"),
    )


_LONG_LINE = "too many fields: 6 of 5"
_SHORT_LINE = "too few fields: 2 of 5"


@query(
    "csv_arrivals",
    f"""
SELECT doc_id, md5(text) AS text_md5, lang, source, n_chars, 'accepted' AS verdict FROM documents
UNION ALL
SELECT doc_id, NULL, NULL, NULL, NULL, CASE doc_id % 3 WHEN 0 THEN '{_SHORT_LINE}' ELSE '{_LONG_LINE}' END
FROM documents WHERE doc_id % 3 < 2""",
)
def csv_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Files with their columns in another order and one more, and files with lines that are too short or too long."""
    documents, path = inputs.table(spark, folder, "documents"), new_path(spark, "arrivals")
    odd, third = F.col("doc_id") % 2 == 1, F.col("doc_id") % 3
    files.export_csv(documents.where(~odd), path)
    other = documents.where(odd).select("n_chars", "source", F.lit("x, y").alias("extra"), "text", "lang", "doc_id")
    files.export_csv(other, path, "append")
    short, long = F.concat_ws(",", "doc_id", "lang"), F.concat_ws(",", "doc_id", "lang", "source", "n_chars", F.lit(","))
    lines = documents.where(third < 2).select(F.when(third == 0, short).otherwise(long).alias("value"))

    header = ",".join(documents.columns)

    def with_header(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"value": [header]})
        for batch in stream:
            yield pa.RecordBatch.from_arrays([batch.column("value")], ["value"])

    lines.mapInArrow(with_header, "value string").write.mode("append").text(path)
    arrived = csv_files.read_arrived(spark, path, documents.columns)
    none = F.lit(None).cast("string")
    rows = arrived.rows.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.md5("text").alias("text_md5"), "lang", "source",
        F.col("n_chars").cast("bigint").alias("n_chars"), F.lit("accepted").alias("verdict"),
    )
    key = F.substring_index("_record", ",", 1).cast("bigint")
    return rows.union(arrived.quarantine.select(key, none, none, none, none.cast("bigint"), "_reason"))


@query(
    "jsonl_roundtrip",
    with_(LABELLED_DOCUMENTS, select="SELECT _row_key, md5(text_content) AS text_md5, content_type, label, source, n_chars FROM labelled"),
)
def jsonl_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    rows = inputs.labelled_documents(spark, folder)
    path = files.export_jsonl(rows, new_path(spark, "jsonl"))
    back = files.read_jsonl(spark, path, rows.schema)
    return back.select("_row_key", F.md5("text_content").alias("text_md5"), "content_type", "label", "source", "n_chars")


def _sum_of(digest: str) -> str:
    """SQL for the sum of `functions.hashing.content_number`."""
    halves = [f"CAST(CAST('0x' || substr({digest}, {at}, 16) AS UBIGINT) AS HUGEINT)" for at in (1, 17)]
    return f"CAST(sum({' + '.join(halves)}) AS VARCHAR)"


_PUBLISHED = ("text_content", "content_type", "label", *inputs.SPEC.numeric)
_PUBLIC = " || '|' || ".join(
    f"coalesce(CAST({f'CAST({c} AS DECIMAL(18,6))' if inputs.SPEC.types.get(c) == DOUBLE else c} AS VARCHAR), '<NA>')" for c in _PUBLISHED
)


@query(
    "publish_projection",
    with_(
        *TO_STAGING,
        select=f"""
SELECT format, count(*) AS row_count, CAST({len(_PUBLISHED)} AS BIGINT) AS column_count,
       {_sum_of(f"md5({_PUBLIC})")} AS fingerprint
FROM staging, (VALUES ('parquet'), ('csv'), ('jsonl')) f(format) GROUP BY format""",
    ),
)
def publish_projection(spark: SparkSession, folder: str) -> DataFrame:
    """Every public column of staging in three formats, read back and fingerprinted."""
    columns, staging = list(_PUBLISHED), workspace.staging(spark, folder)
    paths = files.publish(staging, new_path(spark, "published"))
    public = T.StructType([staging.schema[c] for c in columns])
    back = {
        "parquet": spark.read.parquet(paths["parquet"]),
        "csv": csv_files.read_arrived(spark, paths["csv"], columns).rows,
        "jsonl": files.read_jsonl(spark, paths["jsonl"], public),
    }
    # Fractions in a form that every engine writes alike.
    form = [F.col(c).cast("double").cast("decimal(18,6)").alias(c) if inputs.SPEC.types.get(c) == DOUBLE else F.col(c) for c in columns]
    prints = [fingerprint.table_fingerprint(df.select(*form)).withColumn("format", F.lit(name)) for name, df in back.items()]
    return reduce(DataFrame.unionByName, prints)


@query(
    "partitioned_roundtrip",
    with_(
        *TO_STAGING,
        select="""
SELECT content_type, label, count(*) AS n, CAST(sum(word_count) AS BIGINT) AS words, count(DISTINCT text_content) AS texts
FROM staging GROUP BY content_type, label""",
    ),
)
def partitioned_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    staging, path = workspace.staging(spark, folder), new_path(spark, "partitioned")
    # Written twice: a rerun must not add rows.
    files.export_partitioned(staging, "content_type", path)
    files.export_partitioned(staging, "content_type", path)
    back = spark.read.parquet(path)
    return back.groupBy("content_type", "label").agg(
        F.count(F.lit(1)).alias("n"), F.sum("word_count").alias("words"), F.countDistinct("text_content").alias("texts")
    )


@query(
    "sink_modes",
    f"""
SELECT o_orderpriority, 2 * count(*) AS n, {r("2 * sum(CAST(o_totalprice AS DECIMAL(18,2)))", 2)} AS total
FROM orders GROUP BY o_orderpriority""",
)
def sink_modes(spark: SparkSession, folder: str) -> DataFrame:
    orders, path = inputs.table(spark, folder, "orders"), new_path(spark, "sink")
    for mode in ("fail", "replace", "append"):
        tables.load_table(orders, path, mode)
    return spark.read.parquet(path).groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("n"),
        rounded(F.sum(F.col("o_totalprice").cast("decimal(18,2)")), 2).alias("total"),
    )


_TABLES = (
    "benchmark conversations customer documents embeddings events labels lineitem nation orders pages part region supplier"
).split()


@query(
    "source_manifest_check",
    "\nUNION ALL\n".join(
        f"SELECT '{t}.parquet' AS file, '{dict(documents='MISMATCH', events='UNEXPECTED').get(t, 'MATCH')}' AS status" for t in _TABLES
    )
    + "\nUNION ALL\nSELECT 'absent.parquet', 'MISSING'",
)
def source_manifest_check(spark: SparkSession, folder: str) -> DataFrame:
    """The files of the given tables against a manifest with a wrong checksum, a file too few and a file too many."""
    actual = written(fingerprint.file_checksums(spark, folder, "*.parquet"), "checksums")
    wrong = F.when(F.col("file") == "documents.parquet", F.sha2("sha256", 256)).otherwise(F.upper("sha256"))
    manifest = actual.where("file <> 'events.parquet'").select("file", wrong.alias("expected"))
    absent = spark.createDataFrame([("absent.parquet", "0" * 64)], manifest.schema)
    return fingerprint.verify_sources(actual, manifest.union(absent)).select("file", "status")


_AMOUNTS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
_LINE = " || '|' || ".join(
    [f"CAST({c} AS VARCHAR)" for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber")]
    + [f"CAST(CAST({c} AS DECIMAL(18,4)) AS VARCHAR)" for c in _AMOUNTS]
    + ["l_returnflag", "l_linestatus", "CAST(epoch_us(l_shipdate) AS VARCHAR)"]
)
_DOCUMENT = "CAST(doc_id AS VARCHAR) || '|' || text || '|' || lang || '|' || source || '|' || CAST(n_chars AS VARCHAR)"


@query(
    "table_fingerprint",
    f"""
SELECT 'lineitem' AS table_name, count(*) AS row_count, CAST(11 AS BIGINT) AS column_count,
       {_sum_of(f"md5({_LINE})")} AS fingerprint
FROM lineitem
UNION ALL
SELECT 'documents', count(*), CAST(5 AS BIGINT), {_sum_of(f"md5({_DOCUMENT})")}
FROM documents""",
)
def table_fingerprint(spark: SparkSession, folder: str) -> DataFrame:
    # Amounts and times in a form that every engine writes alike.
    lines = inputs.table(spark, folder, "lineitem").withColumns(
        {c: F.col(c).cast("decimal(18,4)") for c in _AMOUNTS} | {"l_shipdate": F.unix_micros(F.col("l_shipdate").cast("timestamp"))}
    )
    documents = inputs.table(spark, folder, "documents")
    prints = [
        fingerprint.table_fingerprint(df).withColumn("table_name", F.lit(name))
        for name, df in (("lineitem", lines), ("documents", documents))
    ]
    return reduce(DataFrame.unionByName, prints)


@query(
    "partition_verification",
    """
SELECT 'o_orderpriority=' || o_orderpriority AS "partition", count(*) AS row_count,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'CHANGED' WHEN '2-HIGH' THEN 'REWRITTEN' ELSE 'SAME' END AS status
FROM orders GROUP BY o_orderpriority""",
)
def partition_verification(spark: SparkSession, folder: str) -> DataFrame:
    """Orders by priority, of which one partition gets other prices and one is only written anew."""
    orders, path, kept = inputs.table(spark, folder, "orders"), new_path(spark, "orders"), new_path(spark, "kept")
    files.replace_partitions(orders.hint("rebalance", "o_orderpriority"), path, "o_orderpriority")
    content_ledger.keep(written(content_ledger.verify(spark, path, kept), "verified"), kept)
    dearer = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    again = orders.where("o_orderpriority in ('1-URGENT', '2-HIGH')").withColumn("o_totalprice", dearer)
    files.replace_partitions(again.hint("rebalance", "o_orderpriority"), path, "o_orderpriority")
    return content_ledger.verify(spark, path, kept).select("partition", "row_count", "status")


# ---------------------------------------------------------------------------
# audit columns and hashes
# ---------------------------------------------------------------------------

_EVENT_HASH = "md5(CAST(event_id AS VARCHAR) || '|' || CAST(user_id AS VARCHAR) || '|' || event_type || '|' || props)"
_EVENT_COLUMNS = ("event_id", "_ts_micros", "user_id", "event_type", "value", "props")  # a changed time or value is a new row


def _events(spark: SparkSession, folder: str) -> DataFrame:
    """All columns, and the time in a form that no session setting changes, for the hash."""
    return inputs.table(spark, folder, "events").withColumn("_ts_micros", F.unix_micros(F.col("ts").cast("timestamp")))


@query(
    "audit_columns",
    f"""
SELECT event_id, 'run-0001' AS _pipeline_run_id, '2024-01-31 00:00:00' AS ingested_at, 'events.parquet' AS _source_file,
       'full' AS _batch_id,
       md5(CAST(event_id AS VARCHAR) || '|' || CAST(epoch_us(ts) AS VARCHAR) || '|' || CAST(user_id AS VARCHAR) || '|' || event_type
           || '|' || CAST(CAST(value AS DECIMAL(18,4)) AS VARCHAR) || '|' || props) AS _row_hash
FROM events""",
)
def audit_columns(spark: SparkSession, folder: str) -> DataFrame:
    events = inputs.table(spark, folder, "events").withColumn("_file", F.col("_metadata.file_name"))
    events = events.withColumns({"ts": F.unix_micros(F.col("ts").cast("timestamp")), "value": F.col("value").cast("decimal(18,4)")})
    whole = ("event_id", "ts", "user_id", "event_type", "value", "props")
    audited = with_audit(events, inputs.RUN, source_file=F.col("_file"), hashed=whole)
    return audited.select(
        "event_id", "_pipeline_run_id", _text_time("_ingested_at_utc").alias("ingested_at"),
        "_source_file", "_batch_id", "_row_hash",
    )


@query(
    "row_hash",
    "SELECT doc_id, md5(text || '|' || lang || '|' || source || '|' || CAST(n_chars AS VARCHAR)) AS row_hash FROM documents",
)
def row_hash(spark: SparkSession, folder: str) -> DataFrame:
    documents = inputs.table(spark, folder, "documents")
    return documents.select("doc_id", row_hash_of(["text", "lang", "source", "n_chars"]).alias("row_hash"))


@query(
    "ingest_full",
    with_(
        *TO_RAW,
        select="SELECT _row_key, label, word_count, _row_hash, 'full' AS _batch_id, 'run-0001' AS _pipeline_run_id FROM raw",
    ),
)
def ingest_full(spark: SparkSession, folder: str) -> DataFrame:
    landing, source = _new_landing(spark), workspace.raw(spark, folder).select("_row_key", *_SOURCE_COLUMNS)
    land_full(source, landing, inputs.RUN, hashed=inputs.SPEC.hashed)
    # A second call with the same run finds it committed.
    landed = land_full(source, landing, inputs.RUN, hashed=inputs.SPEC.hashed)
    return landed.select("_row_key", "label", "word_count", "_row_hash", "_batch_id", "_pipeline_run_id")


_SOURCE_COLUMNS = ["text_content", "content_type", "label", *inputs.SPEC.numeric]


# ---------------------------------------------------------------------------
# batches and the ledger
# ---------------------------------------------------------------------------


def _batch_sql(n: int) -> str:
    return f"""
batched AS (
  SELECT *, format('batch_{{:02d}}_of_{n:02d}',
                   CASE WHEN total < {n} THEN {n} ELSE least((i - 1) // (total // {n}), {n - 1}) + 1 END) AS _batch_id
  FROM (SELECT *, row_number() OVER (ORDER BY event_id) AS i, count(*) OVER () AS total FROM events))
"""


@query("make_batches", with_(_batch_sql(7), select="SELECT event_id, _batch_id FROM batched"))
def batches(spark: SparkSession, folder: str) -> DataFrame:
    return make_batches(inputs.table(spark, folder, "events").select("event_id"), "event_id", 7)


@query(
    "uncommitted_batches",
    with_(_batch_sql(3), select="SELECT event_id, _batch_id FROM batched WHERE _batch_id <> 'batch_01_of_03'"),
)
def uncommitted_batches(spark: SparkSession, folder: str) -> DataFrame:
    batched = make_batches(inputs.table(spark, folder, "events").select("event_id"), "event_id", 3)
    committed = spark.createDataFrame([("batch_01_of_03",)], "batch_id string")
    return ledger.uncommitted(batched, committed).select("event_id", "_batch_id")


@query(
    "raw_audit",
    with_(
        _batch_sql(3),
        select="""
SELECT 'run-0001' AS pipeline_run_id, _batch_id AS batch_id, 'events.parquet' AS source_file, 'none' AS source_checksum,
       count(*) AS row_count, '2024-01-31 00:00:00' AS ingested_at
FROM batched GROUP BY _batch_id""",
    ),
)
def raw_audit(spark: SparkSession, folder: str) -> DataFrame:
    landing, events = _new_landing(spark), _events(spark, folder)
    # The second run finds every batch committed and lands nothing.
    for run in (inputs.RUN, Run("run-0002", "2024-02-01 00:00:00")):
        ingest_batches(events, "event_id", 3, landing, run, source_file="events.parquet", checksum="none", hashed=_EVENT_COLUMNS)
    audit = reports.raw_audit(landing.visible(spark))
    return audit.withColumn("ingested_at", _text_time("ingested_at_utc")).drop("ingested_at_utc")


@query(
    "latest_snapshot",
    f"""
SELECT 'run-0002' AS run_id, event_type, count(*) AS n, {r("sum(CAST(value AS DECIMAL(18,2)))", 2)} AS total
FROM events GROUP BY event_type""",
)
def latest_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    events = _events(spark, folder)
    landing = _new_landing(spark)
    early = events.where(F.col("ts") < F.lit("2024-01-16").cast("timestamp"))
    land_full(early, landing, Run("run-0001", "2024-01-16 00:00:00"), hashed=_EVENT_COLUMNS)
    land_full(events, landing, Run("run-0002", "2024-01-31 00:00:00"), hashed=_EVENT_COLUMNS)
    newest = ledger.latest_snapshot(landing.rows(spark), landing.entries(spark))
    return newest.groupBy(F.col("_pipeline_run_id").alias("run_id"), "event_type").agg(
        F.count(F.lit(1)).alias("n"), rounded(F.sum(F.col("value").cast("decimal(18,2)")), 2).alias("total")
    )


@query(
    "run_log_status",
    """
SELECT user_id AS run_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS started,
       CASE WHEN arg_max(event_type, (ts, event_id)) IN ('purchase', 'error')
            THEN strftime(arg_max(ts, (ts, event_id)), '%Y-%m-%d %H:%M:%S') END AS completed,
       CASE arg_max(event_type, (ts, event_id)) WHEN 'purchase' THEN 'SUCCESS' WHEN 'error' THEN 'FAILED' ELSE 'RUNNING' END AS status,
       arg_max(event_type, (ts, event_id)) AS stage
FROM events GROUP BY user_id""",
)
def run_log_status(spark: SparkSession, folder: str) -> DataFrame:
    """Events read as a log of stages: a purchase ends a run well, an error ends it badly."""
    kind = F.col("event_type")
    log = inputs.table(spark, folder, "events").select(
        F.col("user_id").alias("run_id"),
        F.col("ts").alias("at"),
        F.col("event_id").alias("seq"),
        kind.alias("stage"),
        F.when(kind == "purchase", "SUCCESS").when(kind == "error", "FAILED").otherwise("RUNNING").alias("status"),
        F.lit("").alias("notes"),
    )
    return reports.run_log_status(log).select(
        "run_id", _text_time("started_at").alias("started"), _text_time("completed_at").alias("completed"), "status", "stage"
    )


@query(
    "stream_ingest",
    f"""
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, count(DISTINCT event_id) AS events,
       {r("sum(CAST(value AS DECIMAL(18,2)))", 2)} AS total
FROM events GROUP BY 1""",
)
def stream_ingest(spark: SparkSession, folder: str) -> DataFrame:
    """Events arrive in two halves; the second half is followed by a rerun with a lost checkpoint."""
    events = _events(spark, folder).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    landing, arrivals = _new_landing(spark), new_path(spark, "arrivals")
    checkpoint = new_path(spark, "stream")
    early = F.col("day") < "2024-01-16"
    for part, place in ((early, checkpoint), (~early, checkpoint), (None, new_path(spark, "stream"))):
        if part is not None:
            events.where(part).write.mode("append").parquet(arrivals)
        ingest_arrivals(spark, arrivals, events.schema, landing, inputs.RUN, place, hashed=_EVENT_COLUMNS)
    return landing.visible(spark).groupBy("day").agg(
        F.count(F.lit(1)).alias("n"),
        F.countDistinct("event_id").alias("events"),
        rounded(F.sum(F.col("value").cast("decimal(18,2)")), 2).alias("total"),
    )


@query(
    "stream_new_rows",
    """
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n, min(event_id) AS first_event, max(event_id) AS last_event
FROM events GROUP BY 1""",
)
def stream_new_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The second arrival repeats the rows of the first; only the new ones are landed."""
    events = _events(spark, folder).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    landing, arrivals, checkpoint = _new_landing(spark), new_path(spark, "arrivals"), new_path(spark, "stream")
    for part in (events.where(F.col("day") < "2024-01-16"), events):
        part.write.mode("append").parquet(arrivals)
        ingest_arrivals(
            spark, arrivals, events.schema, landing, inputs.RUN, checkpoint, hashed=_EVENT_COLUMNS, new_rows_by="event_id"
        )
    return landing.visible(spark).groupBy("day").agg(
        F.count(F.lit(1)).alias("n"), F.min("event_id").alias("first_event"), F.max("event_id").alias("last_event")
    )
