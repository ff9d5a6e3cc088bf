"""An index of landed row hashes: new arrivals are compared with it instead of with all history.

The index is a set of runs. A run holds the distinct hashes of some committed batches, partitioned by as many leading bits as keep
a partition near `per_part` hashes, and sorted inside. Arrivals read, of each run, the partitions of their own leading bits only.
`fan` runs of a level are merged into one of the next level, so that there are few runs however many batches have landed, and a
hash is rewritten once a level.

The index follows the ledger and is never ahead of it: `refresh` adds the batches that have become visible and replaces runs with a batch
that is no longer visible, by reading these batches alone. A run counts once the catalog names it, and the same
line of the catalog retires the runs it replaces; whatever a crash leaves behind is never read. One writer at a time.
"""

from __future__ import annotations

import math
import uuid
from collections import defaultdict
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from assayer.scratch import written
from assayer.sources.landing import Landing
from assayer.sources.tables import table_exists

CATALOG = "run string, level int, bits int, rows bigint, covers array<string>, retires array<string>"
KINDS = ("full", "incremental", "stream")  # of ledger entries that stand for raw rows
PER_PART = 1_000_000  # hashes of a partition, about 16 MB
FAN = 8
MOST_BITS = 16


@dataclass(frozen=True)
class _Run:
    name: str
    level: int
    bits: int
    rows: int
    covers: frozenset[str]


def _leading(bits: int) -> Column:
    """The leading bits of a hash in hex digits, as a number."""
    return F.shiftright(F.conv(F.substring("_row_hash", 1, 4), 16, 10).cast("int"), MOST_BITS - bits)


@dataclass(frozen=True)
class HashIndex:
    path: str
    per_part: int = PER_PART
    fan: int = FAN

    # -- the catalog ---------------------------------------------------------

    def runs(self, spark: SparkSession) -> list[_Run]:
        """The runs that count; a line for each batch and merge is read."""
        if not table_exists(spark, f"{self.path}/catalog"):
            return []
        lines = spark.read.schema(CATALOG).parquet(f"{self.path}/catalog").collect()
        gone = {name for line in lines for name in line.retires}
        return [_Run(x.run, x.level, x.bits, x.rows, frozenset(x.covers)) for x in lines if x.run and x.run not in gone]

    def _commit(self, spark: SparkSession, run: _Run | None, retired: list[_Run]) -> None:
        new = (run.name, run.level, run.bits, run.rows, sorted(run.covers)) if run else (None, None, None, None, [])
        line = spark.createDataFrame([(*new, [r.name for r in retired])], CATALOG)
        line.coalesce(1).write.mode("append").parquet(f"{self.path}/catalog")
        for old in retired:
            self._remove(spark, old)

    def _folder(self, run: _Run) -> str:
        return f"{self.path}/runs/{run.name}"

    def _remove(self, spark: SparkSession, run: _Run) -> None:
        folder = spark._jvm.org.apache.hadoop.fs.Path(self._folder(run))
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)

    # -- writing -------------------------------------------------------------

    def _write(self, hashes: DataFrame, level: int, rows: int, covers: frozenset[str]) -> _Run:
        bits = min(MOST_BITS, max(0, math.ceil(math.log2(max(1, rows) / self.per_part))))
        run = _Run(uuid.uuid4().hex[:12], level, bits, rows, covers)
        parts = hashes.select("_row_hash").distinct().withColumn("p", _leading(bits))
        cut = parts.repartition(2**bits, "p").sortWithinPartitions("p", "_row_hash")
        cut.select(F.unhex("_row_hash").alias("hash"), "p").write.partitionBy("p").parquet(self._folder(run))
        return run

    def refresh(self, spark: SparkSession, landing: Landing) -> None:
        """Brings the index up to what the ledger makes visible."""
        entries = landing.entries(spark).where(F.col("kind").isin(*KINDS))
        per_run = entries.groupBy("batch_id", "run_id").agg(F.max("committed_at").alias("at"), F.count("*").alias("n"), F.sum("rows").alias("rows"))
        newest = per_run.groupBy("batch_id").agg(F.max_by(F.struct("run_id", "at", "n", "rows"), F.struct("at", "run_id")).alias("c"))
        visible = {f"{x.batch_id}|{x.run_id}|{x['at']}|{x.n}": x for x in newest.select("batch_id", "c.*").collect()}
        runs = self.runs(spark)
        stale = [run for run in runs if not run.covers <= visible.keys()]
        covered = {c for run in runs if run not in stale for c in run.covers}
        missing = {name: x for name, x in visible.items() if name not in covered}
        if missing:
            pairs = spark.createDataFrame([(x.batch_id, x.run_id) for x in missing.values()], "_batch_id string, _pipeline_run_id string")
            # The first condition reads no other partitions, the second one is exact.
            raw = landing.rows(spark).where(F.col("_batch_id").isin(*{x.batch_id for x in missing.values()}))
            hashes = raw.join(F.broadcast(pairs), pairs.columns, "left_semi")  # a row for each batch to be added
            run = self._write(hashes, 0, sum(x.rows for x in missing.values()), frozenset(missing))
            self._commit(spark, run, stale)
        elif stale:
            self._commit(spark, None, stale)
        self._merge(spark)

    def _merge(self, spark: SparkSession) -> None:
        while True:
            levels: dict[int, list[_Run]] = defaultdict(list)
            for run in self.runs(spark):
                levels[run.level].append(run)
            full = [(level, runs) for level, runs in sorted(levels.items()) if len(runs) >= self.fan]
            if not full:
                return
            level, runs = full[0]
            hashes = self._hashes(spark, [self._folder(run) for run in runs])
            merged = self._write(hashes, level + 1, sum(run.rows for run in runs), frozenset().union(*(run.covers for run in runs)))
            self._commit(spark, merged, runs)

    # -- reading -------------------------------------------------------------

    def _hashes(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        """(_row_hash) of what stands in these folders; those that are not there hold nothing."""
        found = spark.createDataFrame([], "_row_hash string")
        for folder in folders:
            try:
                part = spark.read.schema("hash binary").parquet(folder)
            except AnalysisException as problem:
                if "PATH_NOT_FOUND" not in str(problem):
                    raise
                continue
            found = found.union(part.select(F.lower(F.hex("hash")).alias("_row_hash")))
        return found

    def scan(self, spark: SparkSession, hashes: DataFrame) -> DataFrame:
        """(_row_hash) of all partitions in which one of `hashes` can be."""
        runs = self.runs(spark)
        bits = max((run.bits for run in runs), default=0)
        wanted = {0}
        if bits:
            wanted = {x.p for x in hashes.select(_leading(bits).alias("p")).distinct().collect()}  # 65,536 numbers at most
        folders = []
        for run in runs:
            parts = sorted({p >> (bits - run.bits) for p in wanted})
            folders.append(f"{self._folder(run)}/p={{{','.join(map(str, parts))}}}" if parts else "")
        return self._hashes(spark, [f for f in folders if f])

    def new_rows(self, batch: DataFrame) -> DataFrame:
        """The rows of `batch` whose hash the index does not hold."""
        spark = batch.sparkSession
        hashes = written(batch.select("_row_hash").distinct(), "batch-hashes")
        known = self.scan(spark, hashes).join(hashes, "_row_hash", "left_semi")
        return batch.join(known, "_row_hash", "left_anti")
