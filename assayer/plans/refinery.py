"""One run, stage by stage: land, stage, curate, check, publish, train, evaluate.

Every stage writes under the run id and then commits to the ledger, so a rerun of a finished stage
does nothing (unless forced) and a rerun of a broken one replaces what was left behind.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from assayer.operators import checks, contract, curate, models, reports, scoring, staging
from assayer.scratch import written
from assayer.sources import csv_files, files, fingerprint, landing as lands, ledger, tables
from assayer.sources.audit import Run
from assayer.spec import CLASSIFIERS, RANGE_RULES, STYLOMETRY, ModelSpec, Rule, Settings, TableSpec
from assayer.streaming.increments import ingest_arrivals


_CHECKS = "check string, status string, details string, value double"


@dataclass(frozen=True)
class Warehouse:
    """Folders of a refinery; `root` must be reachable by every executor."""

    root: str

    def path(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def landing(self) -> lands.Landing:
        return lands.Landing(self.path("raw"), self.path("ledger"))


@dataclass(frozen=True)
class Refinery:
    """One run over a warehouse."""

    spark: SparkSession
    warehouse: Warehouse
    run: Run
    spec: TableSpec = STYLOMETRY
    settings: Settings = field(default_factory=Settings)
    rules: Sequence[Rule] = RANGE_RULES
    contract: Sequence[Rule] = ()
    classifiers: Sequence[ModelSpec] = CLASSIFIERS

    # -- bookkeeping --------------------------------------------------------

    def log(self, stage: str, status: str, seq: int, notes: str = "") -> None:
        row = [(self.run.run_id, stage, status, notes, seq)]
        event = self.spark.createDataFrame(row, "run_id string, stage string, status string, notes string, seq int")
        event.withColumn("at", F.current_timestamp()).write.mode("append").parquet(self.warehouse.path("run_log"))

    def _done(self, kind: str) -> bool:
        return ledger.is_committed(self.warehouse.landing.entries(self.spark), kind, run_id=self.run.run_id)

    def _commit(self, kind: str, path: str) -> None:
        entry = self.spark.read.parquet(path).agg(
            F.lit(self.run.run_id).alias("batch_id"), F.lit(path).alias("source_file"), F.count(F.lit(1)).alias("rows")
        )
        ledger.commit(entry, self.warehouse.landing.ledger, kind, self.run)

    def _stage(self, kind: str, force: bool, build: Callable[[str], None]) -> DataFrame:
        path = self.warehouse.path(kind, self.run.run_id)
        if force or not self._done(kind):
            build(path)
            self._commit(kind, path)
        return self.spark.read.parquet(path)

    def table(self, kind: str) -> DataFrame:
        """The newest committed table of a stage."""
        newest = ledger.latest_run(self.warehouse.landing.entries(self.spark), kind).first()
        if newest is None:
            raise LookupError(f"no committed {kind} table")
        return self.spark.read.parquet(self.warehouse.path(kind, newest.run_id))

    # -- stages -------------------------------------------------------------

    def ingest_full(self, source: DataFrame, force: bool = False, **identity) -> DataFrame:
        return lands.ingest_full(source, self.warehouse.landing, self.run, force, hashed=self.spec.hashed, **identity)

    def verify_sources(self, path: str, manifest: DataFrame, pattern: str = "*") -> DataFrame:
        """Every file against its declared checksum; anything but a match stops the run."""
        checksums = written(fingerprint.file_checksums(self.spark, path, pattern), "checksums")
        verified = fingerprint.verify_sources(checksums, manifest)
        fingerprint.require_match(verified)
        return verified

    def ingest_csv(
        self, path: str, columns: Sequence[str], manifest: DataFrame | None = None, force: bool = False, pattern: str = "*.csv"
    ) -> DataFrame:
        """A folder of CSV files as one full run; with a manifest, only if every file matches it.

        Records that do not fit their file's header are kept in `csv_quarantine`, and counted by file in `csv_counts`.
        """
        arrived = csv_files.read_arrived(self.spark, path, list(columns), self.spec.key, pattern)
        rows = arrived.rows.withColumnRenamed("_source_file", "_file")
        checksum: Column | None = None
        if manifest is not None:
            sums = self.verify_sources(path, manifest, pattern).select(F.col("file").alias("_file"), F.col("sha256").alias("_sum"))
            rows, checksum = rows.join(sums, "_file", "left"), F.col("_sum")
        run_id = F.lit(self.run.run_id).alias("_run_id")
        for table, name in ((arrived.quarantine, "csv_quarantine"), (arrived.counts(), "csv_counts")):
            files.replace_partitions(table.select("*", run_id), self.warehouse.path(name), "_run_id")
        return self.ingest_full(rows, force, source_file=F.col("_file"), checksum=checksum)

    def ingest_arrivals(self, source: str, schema: T.StructType, **how) -> None:
        """Files that arrived since the last call, each landed once."""
        checkpoint = self.warehouse.path("checkpoints", "arrivals")
        ingest_arrivals(
            self.spark, source, schema, self.warehouse.landing, self.run, checkpoint, hashed=self.spec.hashed, **how
        )

    def ingest_increment(self, source: DataFrame, force: bool = False, **identity) -> list[str]:
        return lands.ingest_batches(
            source, self.spec.key, self.settings.n_batches, self.warehouse.landing, self.run, force,
            hashed=self.spec.hashed, **identity,
        )

    def to_staging(self, force: bool = False, raw: DataFrame | None = None) -> DataFrame:
        """All visible raw rows, full and incremental, typed, deduplicated, imputed."""

        def build(path: str) -> None:
            rows = self.warehouse.landing.visible(self.spark) if raw is None else raw
            clean, quarantined = to_staging(rows, self.spec, self.settings, self.run, self.contract)
            clean.write.mode("overwrite").parquet(path)
            log = staging.quarantine_log(quarantined, F.lit(self.run.at)).withColumn("_run_id", F.lit(self.run.run_id))
            files.replace_partitions(log, self.warehouse.path("quarantine"), "_run_id")

        return self._stage("staging", force, build)

    def to_curated(self, force: bool = False) -> DataFrame:
        def build(path: str) -> None:
            rows, codes, params = curate.curated(self.table("staging"), self.spec, self.settings, self.run.at)
            rows.write.mode("overwrite").partitionBy("_split").parquet(path)
            written_rows = self.spark.read.parquet(path)
            manifest = self.warehouse.path("manifest", self.run.run_id)
            curate.split_manifest(written_rows, self.spec, self.settings).write.mode("overwrite").json(f"{manifest}/split")
            scaler = self.spark.createDataFrame(params, "feature string, mean double, std double")
            scaler.write.mode("overwrite").json(f"{manifest}/scaler")
            for column, table in codes.items():
                table.write.mode("overwrite").json(f"{manifest}/codes_{column}")

        return self._stage("curated", force, build)

    def run_checks(
        self, table: DataFrame | None = None, as_of: str | None = None, gate: bool = True, reproducibility: DataFrame | None = None
    ) -> DataFrame:
        """The quality report of staging, kept under the run id; a failed check stops the run.

        Once a run is evaluated against a baseline, its report holds those rows as well (`reproducibility`, or the ones kept).
        """
        rows = self.table("staging") if table is None else table
        if reproducibility is None:
            reproducibility = self._reproducibility()
        report = checks.quality_report(rows, self.spec, self.settings, self.rules, as_of or self.run.at, reproducibility)
        path = self.warehouse.path("quality", self.run.run_id)
        report.coalesce(1).write.mode("overwrite").json(path)
        kept = self.spark.read.schema(_CHECKS).json(path)
        if gate:
            checks.gate(kept)
        return kept

    def _reproducibility(self) -> DataFrame | None:
        """The comparison with the baseline that this run has kept, if it has one."""
        path = self.warehouse.path("evaluation", self.run.run_id, "reproducibility")
        try:
            return self.spark.read.schema(_CHECKS).json(path)
        except AnalysisException as problem:
            if "PATH_NOT_FOUND" in str(problem):
                return None
            raise

    def check_contract(self, table: DataFrame | None = None) -> DataFrame:
        return contract.contract_report(self.table("staging") if table is None else table, self.contract)

    def publish(self, partition_by: str | None = "content_type") -> dict[str, str]:
        curated = self.table("curated")
        folder = self.warehouse.path("published", self.run.run_id)
        paths = files.publish(curated, folder)
        if partition_by is not None:
            partitioned = files.export_partitioned(curated, partition_by, self.warehouse.path("partitioned"))
            if partitioned is not None:
                paths["partitioned"] = partitioned
        return paths

    def load(self, if_exists: str = "replace") -> list[str]:
        return tables.load_curated(self.table("curated"), self.warehouse.path("tables"), if_exists)

    def _model_rows(self, split: str) -> DataFrame:
        rows = self.table("curated").where(F.col("_split") == split)
        return models.model_input(rows, self.spec)

    def train(self, force: bool = False, cross_validation: bool = True) -> list[str]:
        """Fits and saves every classifier of this run; those already saved are kept unless forced."""
        names = {m.name for m in self.classifiers}
        done = set() if force else self._saved_models()
        missing = [m for m in self.classifiers if m.name not in done]
        if missing:
            train = models.training_table(self._model_rows("train"))
            if cross_validation:
                scores = models.cv_scores(train, self.spec, missing, self.settings)
                summary = written(scoring.cv_summary(scores).withColumn("run_id", F.lit(self.run.run_id)), "cv-summary")
                for model in missing:  # a folder for each run and model, so that a rerun replaces its results
                    mine = summary.where(F.col("classifier") == model.name)
                    mine.coalesce(1).write.mode("overwrite").json(self.warehouse.path("cv_results", self.run.run_id, model.name))
            for name, fitted in models.fit_all(train, self.spec, missing, self.settings).items():
                path = models.save_model(fitted, self.warehouse.path("models"), self.run.run_id, name)
                entry = self.spark.createDataFrame([(name, path, 1)], "batch_id string, source_file string, rows bigint")
                ledger.commit(entry, self.warehouse.landing.ledger, "model", self.run)
        return sorted(names)

    def _saved_models(self) -> set[str]:
        entries = self.warehouse.landing.entries(self.spark)
        mine = entries.where((F.col("kind") == "model") & (F.col("run_id") == self.run.run_id))
        return {row[0] for row in mine.select("batch_id").distinct().collect()}

    def evaluate(
        self, baseline: DataFrame | None = None, baseline_tolerance: float | None = None, baseline_metric: str | None = None
    ) -> DataFrame:
        """Metrics of exactly the models of this run, the best one's predictions, and the gate rows."""
        folder, run_id = self.warehouse.path("models"), self.run.run_id
        fitted = {m.name: models.load_model(folder, run_id, m.name) for m in self.classifiers}
        test = written(self._model_rows("test"), "test")
        scored = written(models.score_all(fitted, test, self.spec.key), "scored")
        metrics = written(
            scoring.metrics(scored).withColumns(
                {
                    "run_id": F.lit(run_id),
                    "evaluated_at": F.lit(self.run.at).cast("timestamp"),
                    "random_seed": F.lit(self.settings.seed),
                    "test_size": F.lit(self.settings.test_size).cast("double"),
                }
            ),
            "metrics",
        )
        files.replace_partitions(metrics.coalesce(1), self.warehouse.path("model_metrics"), "run_id")

        report = self.warehouse.path("evaluation", run_id)
        reports.classifier_comparison(metrics).coalesce(1).write.mode("overwrite").option("header", True).csv(f"{report}/comparison")
        scoring.classification_report(scoring.confusion_matrix(scored)).coalesce(1).write.mode("overwrite").json(f"{report}/classes")
        models.importance_table(self.spark, fitted).coalesce(1).write.mode("overwrite").json(f"{report}/importances")
        curated_test = self.table("curated").where(F.col("_split") == "test")
        best = scoring.best_model(metrics, self.settings.metric)
        self._summary(best).coalesce(1).write.mode("overwrite").json(f"{report}/best_model")
        extract = scoring.predictions_extract(curated_test, scored, best, self.spec.key)
        files.export_csv(extract, f"{report}/predictions")
        if baseline is not None:
            actual = scoring.long_metrics(metrics.select("classifier", *scoring.METRICS))
            repro = checks.check_reproducibility(
                actual, baseline, baseline_metric or self.settings.metric, self.settings.tolerance, baseline_tolerance
            )
            repro.coalesce(1).write.mode("overwrite").json(f"{report}/reproducibility")
        return metrics

    def _summary(self, best: DataFrame) -> DataFrame:
        """The best model's metrics, and the threshold that balances its recalls on an inner part of the training rows."""
        row = best.first()
        chosen = [m for m in self.classifiers if row is not None and m.name == row.classifier]
        threshold = None
        if chosen:
            train = models.training_table(self._model_rows("train"))
            threshold = models.calibrate_threshold(train, self.spec, chosen[0], self.settings)[1]
        return best.withColumn("balanced_threshold", F.lit(threshold).cast("double"))

    def run_all(
        self,
        source: DataFrame,
        force: bool = False,
        gate: bool = True,
        baseline: DataFrame | None = None,
        baseline_metric: str | None = None,
        baseline_tolerance: float | None = None,
    ) -> DataFrame:
        """Every stage in order; the run log tells how far a run came. A baseline's own metric and
        tolerance, as `read_baseline` gives them, win over the configured ones."""
        steps: list[tuple[str, Callable[[], object]]] = [
            ("ingest_full", lambda: self.ingest_full(source, force)),
            ("ingest_increment", lambda: self.ingest_increment(source, force)),
            ("staging", lambda: self.to_staging(force)),
            ("curated", lambda: self.to_curated(force)),
            ("checks", lambda: self.run_checks(gate=gate)),
            ("publish", lambda: (self.publish(), self.load())),
            ("train", lambda: self.train(force)),
            ("evaluate", lambda: self.evaluate(baseline, baseline_tolerance, baseline_metric)),
        ]
        result: object = None
        for i, (name, step) in enumerate(steps):
            self.log(name, "RUNNING", 2 * i)
            try:
                result = step()
            except Exception as problem:
                self.log(name, "FAILED", 2 * i + 1, str(problem))
                raise
            last = i == len(steps) - 1
            self.log(name, "SUCCESS" if last else "RUNNING", 2 * i + 1)
        return result  # the metrics of the last step


def to_staging(
    raw: DataFrame, spec: TableSpec, settings: Settings, run: Run, rules: Sequence[Rule] = ()
) -> tuple[DataFrame, DataFrame]:
    """(staging rows, quarantined rows).

    Cast, deduplicate, then quarantine and impute, in this order. The deduplicated rows are written
    once, as the medians, the staging table and the quarantine all read them. Clauses whose action is
    `quarantine`, of whichever rule, reject rows besides those without a target.
    """
    typed = staging.cast_declared(raw, spec.types)
    order = [c for c in (spec.key, "_batch_id", "_pipeline_run_id") if c in typed.columns]
    unique = written(staging.deduplicate(typed, order, spec.row_hash), "unique")
    labelled, quarantined = staging.split_on_target(unique, spec.target)
    others = [r for r in rules if r.column != spec.target]
    if others:
        labelled, broken = contract.split_by_contract(labelled, others)
        quarantined = quarantined.unionByName(broken)
    fit_on = None
    if settings.medians_from == "train":
        split = curate.stratified_split(labelled, spec.target, spec.key, settings.seed, settings.test_size)
        fit_on = split.where(F.col("_split") == "train")
    stamped = staging.impute_median(labelled, spec.numeric, fit_on).withColumns(
        {
            "_staged_at_utc": F.lit(run.at).cast("timestamp"),
            "_staging_version": F.lit(settings.staging_version),
        }
    )
    return stamped, quarantined


def read_baseline(spark: SparkSession, path: str) -> tuple[DataFrame, str | None, float | None]:
    """(classifier, metric, expected) rows of a baseline JSON file, with its own metric and tolerance.

    A baseline describes a handful of classifiers, so the document is read whole.
    """
    text = spark.read.text(path, wholetext=True).first()[0]
    document = json.loads(text)
    lines = [
        (name, metric, None if value is None else str(value))
        for name, entry in document.get("classifiers", {}).items()
        for metric, value in (entry.get("reported_metrics", entry) or {}).items()
        if not isinstance(value, (dict, list))
    ]
    own = document.get("tolerance", {})
    rows = spark.createDataFrame(lines, "classifier string, metric string, expected string")
    return rows, own.get("metric"), own.get("threshold")
