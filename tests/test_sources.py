import gzip
import hashlib
import random

import pytest
from pyspark.sql import functions as F

from assayer import scratch
from assayer.plans.refinery import Warehouse
from assayer.sources import files, fingerprint, ledger, tables
from assayer.sources.audit import Run, with_audit
from assayer.sources.landing import Landing, ingest_batches, ingest_full

RUN = Run("r1", "2024-01-31 00:00:00")
LATER = Run("r2", "2024-02-01 00:00:00")

TEXTS = [
    (1, "plain"),
    (2, 'comma, "quote" and \\ backslash'),
    (3, "line\nbreak\r\nand\ttab"),
    (4, "a|pipe"),
    (5, "  spaces  "),
    (6, None),
    (7, "é ü 漢字 😀"),
    (8, '"'),
    (9, "NULL"),
]


@pytest.fixture
def landing(tmp_path):
    return Landing(str(tmp_path / "raw"), str(tmp_path / "ledger"))


def test_csv_keeps_texts(spark, rows, tmp_path):
    df = spark.createDataFrame(TEXTS, "id int, t string")
    path = files.export_csv(df, str(tmp_path / "csv"))
    back = files.read_csv(spark, path, ["id", "t"]).select(F.col("id").cast("int").alias("id"), "t")
    assert rows(back) == rows(df)


def test_jsonl_writes_nulls(spark, rows, tmp_path):
    df = spark.createDataFrame(TEXTS, "id int, t string")
    path = files.export_jsonl(df.coalesce(1), str(tmp_path / "jsonl"))
    assert '{"id":6,"t":null}' in [r.value for r in spark.read.text(path).collect()]
    assert rows(files.read_jsonl(spark, path, df.schema)) == rows(df)


def test_published_columns(spark, tmp_path):
    df = spark.createDataFrame([(1, "x", "secret")], "a int, b string, _c string")
    paths = files.publish(df, str(tmp_path))
    assert set(paths) == {"parquet", "csv", "jsonl"}
    assert spark.read.parquet(paths["parquet"]).columns == ["a", "b"]


def test_partitioned_rerun_adds_no_rows_and_spreads_a_hot_value(spark, tmp_path):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("kind"))
    path = str(tmp_path / "parts")
    for _ in range(2):
        assert files.export_partitioned(df, "kind", path) == path
    # Another run touches only the partition it has rows for.
    files.export_partitioned(df.where("kind = 'cold'").limit(10), "kind", path)
    assert {r.kind: r["count"] for r in spark.read.parquet(path).groupBy("kind").count().collect()} == {"hot": 2000, "cold": 10}
    assert files.export_partitioned(df, "absent", path) is None


def test_sink_modes(spark, tmp_path):
    df, path = spark.range(5), str(tmp_path / "t")
    tables.load_table(df, path, "fail")
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        tables.load_table(df, path, "fail")
    tables.load_table(df, path, "append")
    assert spark.read.parquet(path).count() == 10
    tables.load_table(df, path, "replace")
    assert spark.read.parquet(path).count() == 5
    with pytest.raises(ValueError):
        tables.load_table(df, path, "merge")


def test_checksums_against_a_manifest(spark, tmp_path):
    for name, text in (("a.bin", b"one"), ("b.bin", b"two"), ("c.bin", b"three")):
        (tmp_path / name).write_bytes(text)
    manifest = spark.createDataFrame(
        [("a.bin", hashlib.sha256(b"one").hexdigest().upper()), ("b.bin", "0" * 64), ("d.bin", "0" * 64)], "file string, expected string"
    )
    found = fingerprint.verify_sources(fingerprint.file_checksums(spark, str(tmp_path), "*.bin"), manifest)
    assert {r.file: r.status for r in found.collect()} == {"a.bin": "MATCH", "b.bin": "MISMATCH", "c.bin": "UNEXPECTED", "d.bin": "MISSING"}
    with pytest.raises(fingerprint.SourceMismatchError, match="b.bin: MISMATCH"):
        fingerprint.require_match(found)


def test_files_longer_than_a_value_are_hashed_as_well(spark, tmp_path):
    rng = random.Random(3)
    noise = rng.randbytes(300_000)
    mark = b"\xef\xbb\xbf"
    files_ = {
        "noise.parquet": noise, "noise end.parquet": noise + b"\n", "{two}[1]*.parquet": noise[:70_000] + b"\n\n", "none.parquet": b"x" * 50_000,
        "ends.parquet": b"\n" * 5_000, "crlf.csv": b"a,\xff\r\n" * 9_000, "marked.csv": mark + noise, "marked end.csv": mark * 2 + noise + b"\n",
        "line first.csv": b"\n" + mark + noise, "mark.csv": mark, "mark line.csv": mark + b"\n" * 2_000, "packed.csv.gz": gzip.compress(noise),
        "packed.zst": noise, "short.bin": b"one\n", "plain": b"no ending",
    }
    for name, content in files_.items():
        (tmp_path / name).write_bytes(content)
    (tmp_path / "inner").mkdir()
    (tmp_path / "inner" / "below.parquet").write_bytes(noise)
    limits = {fingerprint.LIMIT: "1000", "spark.sql.files.maxPartitionBytes": "100000"}  # 2 GB and 128 MB else
    before = {name: spark.conf.get(name) for name in limits}
    for name, value in limits.items():
        spark.conf.set(name, value)
    try:
        found = {(r.file, r.bytes, r.sha256) for r in fingerprint.file_checksums(spark, str(tmp_path)).collect()}
        some = [r.file for r in fingerprint.file_checksums(spark, str(tmp_path), "noise*").collect()]
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert found == {(name, len(content), hashlib.sha256(content).hexdigest()) for name, content in files_.items()}
    assert sorted(some) == ["noise end.parquet", "noise.parquet"]


def test_fingerprint_ignores_order_and_sees_duplicates(spark):
    df = spark.createDataFrame(TEXTS, "id int, t string")
    first = fingerprint.table_fingerprint(df).first()
    assert first == fingerprint.table_fingerprint(df.repartition(5).orderBy(F.desc("id"))).first()
    assert first.fingerprint != fingerprint.table_fingerprint(df.union(df).union(df)).first().fingerprint
    assert fingerprint.table_fingerprint(df.limit(0)).first().fingerprint == "0"
    fingerprint.require_identity(df, 9, 2)
    with pytest.raises(fingerprint.SourceMismatchError):
        fingerprint.require_identity(df, 9, 3)


def test_audit_columns(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    row = with_audit(df, RUN, "b1", "f.csv", "00").first()
    assert row._row_hash == hashlib.md5(b"a|<NA>").hexdigest()
    assert (row._pipeline_run_id, row._batch_id, row._source_file, row._source_checksum) == ("r1", "b1", "f.csv", "00")
    # A hash over the source columns does not change when the audit columns are there already.
    assert with_audit(with_audit(df, RUN), LATER).first()._row_hash == row._row_hash


def test_a_committed_run_is_left_alone_unless_forced(spark, landing):
    assert ingest_full(spark.range(5), landing, RUN).count() == 5
    assert ingest_full(spark.range(9), landing, RUN).count() == 5
    assert ingest_full(spark.range(9), landing, RUN, force=True).count() == 9
    assert landing.visible(spark).count() == 9


def test_the_newest_full_run_is_the_snapshot(spark, landing):
    ingest_full(spark.range(5), landing, LATER)
    ingest_full(spark.range(9), landing, RUN)
    assert ledger.latest_snapshot(landing.rows(spark), landing.entries(spark)).count() == 5
    assert landing.visible(spark).count() == 5
    with pytest.raises(LookupError):
        ledger.latest_snapshot(landing.rows(spark), landing.entries(spark), "stream")


def test_batches_are_landed_once(spark, landing):
    df = spark.range(10).toDF("ord")
    assert ingest_batches(df, "ord", 3, landing, RUN) == ["batch_01_of_03", "batch_02_of_03", "batch_03_of_03"]
    assert ingest_batches(df, "ord", 3, landing, LATER) == []
    assert sorted(r.ord for r in landing.visible(spark).collect()) == list(range(10))
    assert len(ingest_batches(df, "ord", 3, landing, LATER, force=True)) == 3
    assert sorted(r.ord for r in landing.visible(spark).collect()) == list(range(10))


def test_a_source_that_has_grown_is_landed_anew(spark, landing):
    assert len(ingest_batches(spark.range(9).toDF("ord"), "ord", 3, landing, RUN)) == 3
    grown = spark.range(30).toDF("ord")
    assert len(ingest_batches(grown, "ord", 3, landing, LATER)) == 3
    assert sorted(r.ord for r in landing.visible(spark).collect()) == list(range(30))
    assert ingest_batches(grown, "ord", 3, landing, LATER) == []


def test_only_missing_batches_are_landed(spark, landing):
    df = spark.range(10).toDF("ord")
    ingest_batches(df, "ord", 3, landing, RUN)
    partial = landing.entries(spark).where("batch_id <> 'batch_02_of_03'").collect()
    other = Landing(landing.raw, landing.ledger + "_2")
    spark.createDataFrame(partial, ledger.SCHEMA).write.parquet(other.ledger)
    # The rows of the second batch were written but never committed.
    assert other.visible(spark).count() == 7
    assert ingest_batches(df, "ord", 3, other, LATER) == ["batch_02_of_03"]
    assert sorted(r.ord for r in other.visible(spark).collect()) == list(range(10))


def test_full_and_incremental_rows_are_both_visible(spark, landing):
    df = spark.range(10).toDF("ord")
    ingest_full(df, landing, RUN)
    ingest_batches(df, "ord", 3, landing, RUN)
    assert landing.visible(spark).groupBy("_batch_id").count().count() == 4
    assert landing.visible(spark).select("_row_hash").distinct().count() == 10


def test_run_ids_of_digits_stay_text(spark, landing):
    run = Run("000123456789", "2024-01-31 00:00:00")
    ingest_full(spark.range(3), landing, run)
    assert landing.visible(spark).first()._pipeline_run_id == "000123456789"


class _Session:
    """As much of a session as the choice of a folder looks at."""

    def __init__(self, master, folder=None):
        self.conf = {"spark.checkpoint.dir": folder} if folder else {}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"app-{master}"})


def test_scratch_folder():
    assert scratch.shared_folder(_Session("yarn", "hdfs:///shared/")) == "hdfs:///shared"
    assert scratch.shared_folder(_Session("local[2]", "/mine")) == "/mine"
    local = scratch.shared_folder(_Session("local[2]"))
    assert local == scratch.shared_folder(_Session("local[2]"))
    # A cluster never writes to a folder of the machine it happens to run on.
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch.shared_folder(_Session("yarn"))


def test_warehouse_paths():
    assert Warehouse("/w/").path("a", "b") == "/w/a/b" and Warehouse("/w").landing.raw == "/w/raw"
