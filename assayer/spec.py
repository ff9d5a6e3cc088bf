"""What a pipeline needs to know about a table: roles of its columns, rules, thresholds, classifiers."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

LONG, DOUBLE = "bigint", "double"


@dataclass(frozen=True)
class TableSpec:
    """Column roles of a labelled table.

    `key` is unique and ordered; it stands for the position of a row in its source, which a
    distributed table does not have.
    """

    types: dict[str, str]
    numeric: tuple[str, ...]
    categorical: tuple[str, ...] = ()
    target: str = "label"
    text: str | None = "text_content"
    key: str = "_row_key"
    row_hash: str = "_row_hash"
    hashed: tuple[str, ...] | None = None  # None: every source column

    @property
    def required(self) -> list[str]:
        return [*self.numeric, *self.categorical, self.target]

    @property
    def features(self) -> list[str]:
        return [*self.numeric, *self.categorical]

    def without(self, *columns: str) -> "TableSpec":
        return replace(
            self,
            types={c: t for c, t in self.types.items() if c not in columns},
            numeric=tuple(c for c in self.numeric if c not in columns),
            categorical=tuple(c for c in self.categorical if c not in columns),
        )


@dataclass(frozen=True)
class Rule:
    """One line of a data contract. `on_violation` is fail, warn or quarantine."""

    column: str
    nullable: bool = True
    minimum: float | None = None
    maximum: float | None = None
    allowed: tuple | None = None
    max_null_rate: float | None = None
    on_violation: str = "warn"
    on_null: str | None = None


@dataclass(frozen=True)
class ModelSpec:
    name: str
    params: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Settings:
    """Run settings; the defaults are the pipeline's published ones."""

    seed: int = 42
    test_size: str = "0.2"  # a decimal in text: the ceiling of 0.2 * N must not see binary noise
    folds: int = 5
    n_batches: int = 3
    max_null_rate: float = 0.10
    min_rows: int = 1200
    target_classes: tuple[int, ...] = (0, 1)
    min_class_ratio: float = 0.25
    max_age_hours: float = 24.0
    metric: str = "f1_weighted"
    tolerance: float = 0.02
    staging_version: str = "1.0"
    medians_from: str = "all"  # or "train": only the rows that will be in the training split


# The stylometric table, its declared types and its feature order.
STYLOMETRY = TableSpec(
    types={
        "word_count": LONG,
        "character_count": LONG,
        "sentence_count": LONG,
        "lexical_diversity": DOUBLE,
        "avg_sentence_length": DOUBLE,
        "avg_word_length": DOUBLE,
        "punctuation_ratio": DOUBLE,
        "flesch_reading_ease": DOUBLE,
        "gunning_fog_index": DOUBLE,
        "grammar_errors": LONG,
        "passive_voice_ratio": DOUBLE,
        "predictability_score": DOUBLE,
        "burstiness": DOUBLE,
        "sentiment_score": DOUBLE,
        "label": LONG,
    },
    numeric=(
        "word_count",
        "character_count",
        "sentence_count",
        "lexical_diversity",
        "avg_sentence_length",
        "avg_word_length",
        "punctuation_ratio",
        "flesch_reading_ease",
        "gunning_fog_index",
        "grammar_errors",
        "passive_voice_ratio",
        "predictability_score",
        "burstiness",
        "sentiment_score",
    ),
    categorical=("content_type",),
)

# Valid ranges of the quality checks (inclusive bounds).
RANGE_RULES = (
    Rule("lexical_diversity", minimum=0.0, maximum=1.0),
    Rule("punctuation_ratio", minimum=0.0, maximum=1.0),
    Rule("passive_voice_ratio", minimum=0.0, maximum=1.0),
    Rule("sentiment_score", minimum=-1.0, maximum=1.0),
    Rule("word_count", minimum=1, maximum=100000),
    Rule("character_count", minimum=1, maximum=1000000),
    Rule("sentence_count", minimum=0, maximum=10000),
)

# The data contract.
CONTRACT_RULES = (
    Rule("text_content", nullable=False, on_violation="quarantine"),
    Rule(
        "content_type",
        nullable=False,
        allowed=("Marketing", "Technical Blog", "Social Media", "News", "Email", "Education"),
    ),
    Rule("word_count", nullable=False, minimum=1, maximum=100000),
    Rule("character_count", nullable=False, minimum=1, maximum=1000000),
    Rule("sentence_count", nullable=False, minimum=1, maximum=10000),
    Rule("lexical_diversity", nullable=False, minimum=0.0, maximum=1.0),
    Rule("avg_sentence_length", nullable=False, minimum=1.0, maximum=500.0),
    Rule("avg_word_length", nullable=False, minimum=1.0, maximum=50.0),
    Rule("punctuation_ratio", nullable=False, minimum=0.0, maximum=1.0),
    Rule("flesch_reading_ease", max_null_rate=0.10, on_null="impute_median"),
    Rule("gunning_fog_index", max_null_rate=0.10, on_null="impute_median"),
    Rule("grammar_errors", nullable=False, minimum=0, maximum=1000),
    Rule("passive_voice_ratio", max_null_rate=0.10, on_null="impute_median"),
    Rule("predictability_score", nullable=False, minimum=0.0, maximum=1.0),
    Rule("burstiness", nullable=False, minimum=0.0, maximum=1.0),
    Rule("sentiment_score", max_null_rate=0.10, minimum=-1.0, maximum=1.0, on_null="impute_median"),
    Rule("label", nullable=False, allowed=(0, 1), on_violation="fail", on_null="quarantine"),
)

# Audit columns every landed row must carry.
AUDIT_COLUMNS = ("_pipeline_run_id", "_ingested_at_utc", "_source_file", "_source_checksum", "_row_hash")

# Classifiers trained by default.
CLASSIFIERS = (
    ModelSpec("LogisticRegression", {"C": 1.0, "max_iter": 1000}),
    ModelSpec("DecisionTree", {"max_depth": 10, "min_samples_split": 10, "criterion": "gini"}),
    ModelSpec(
        "XGBoost",
        {"n_estimators": 100, "learning_rate": 0.01, "max_depth": 3, "subsample": 0.7, "colsample_bytree": 0.7},
    ),
    ModelSpec("GradientBoosting", {"n_estimators": 100, "learning_rate": 0.01, "max_depth": 3, "subsample": 0.7}),
)
