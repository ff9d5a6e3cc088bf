"""Quality rules as a short-circuit cascade.

Each rule rejects on features of a text. What a rule costs and how many rows it rejects are estimated
on a sample; rules then run in the order of rejections per cost, and a text that one rule rejects
is not looked at by the next. Features are computed when a rule first asks for them. The verdict is
the same in any order; only the work differs.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_SPACE = b" \t\n\x0b\x0c\r"
_SYMBOLS = b"#*$%&|<>"
SAMPLE_ROWS = 2_000  # expected size of the sample on which costs and rejections are estimated


class Features:
    """Counts of one text, each computed once and only when asked for; NULL counts as empty."""

    def __init__(self, text: str | None):
        self.text = text or ""

    @cached_property
    def data(self) -> bytes:
        return self.text.encode()

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()  # bytes are split at the six ASCII spaces only

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        return len(self.text) - (len(self.data) - len(self.data.translate(None, _SPACE)))

    @cached_property
    def n_symbols(self) -> int:
        return len(self.data) - len(self.data.translate(None, _SYMBOLS))

    @cached_property
    def lines(self) -> list[bytes]:
        """The lines that hold a word."""
        return [line for line in self.data.split(b"\n") if line and not line.isspace()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words that lie in a window of three words which occurs twice or more."""
        words = self.words
        windows = list(zip(words, words[1:], words[2:]))
        if len(set(windows)) == len(windows):
            return 0
        seen: set = set()
        repeated: set = set()
        for window in windows:
            (repeated if window in seen else seen).add(window)
        total = upto = 0
        for at, window in enumerate(windows):
            if window in repeated:
                total += at + 3 - max(at, upto)
                upto = at + 3
        return total

    @cached_property
    def n_wordless(self) -> int:
        """Words without a letter: digits, punctuation and symbols of ASCII only."""
        kept = self.data.translate(None, _NO_LETTERS)
        return self.n_words - len(kept.split())


_NO_LETTERS = bytes(b for b in range(33, 127) if not chr(b).isalpha())


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Callable[[Features], bool]


FEW_WORDS = Rule("few_words", lambda f: f.n_words < 50)
REPETITION = Rule("repetition", lambda f: 100 * f.n_repeat_words > 50 * f.n_words)
BASE = (FEW_WORDS, REPETITION)
RULES = (
    *BASE,
    Rule("symbols", lambda f: 10 * f.n_symbols > f.n_words),
    Rule("duplicate_lines", lambda f: 10 * f.n_dup_lines > 3 * len(f.lines)),
    Rule("word_length", lambda f: not 2 * f.n_words <= f.word_chars <= 20 * f.n_words),
    Rule("wordless", lambda f: 5 * f.n_wordless > 2 * f.n_words),
)
REPORTED = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def cascade(docs: DataFrame, rules: Sequence[Rule] = RULES, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by falling rejections per second, as a sample of the texts shows them.

    The sample is a random share of the rows, `sample_rows` of them to be expected; it decides the
    order of work only, never a verdict. An empty table leaves the rules as they are.
    """
    rows = docs.count()
    if not rows:
        return list(rules)

    def measure(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seconds, rejected = [0.0] * len(rules), [0] * len(rules)
        for batch in stream:
            for value in batch.column(0).to_pylist():
                for i, rule in enumerate(rules):
                    features = Features(value)
                    start = time.perf_counter()
                    rejected[i] += rule.rejects(features)
                    seconds[i] += time.perf_counter() - start
        yield pa.RecordBatch.from_arrays(
            [pa.array(range(len(rules)), pa.int32()), pa.array(seconds), pa.array(rejected, pa.int64())],
            ["rule", "seconds", "rejected"],
        )

    sample = docs.select(text).sample(min(1.0, sample_rows / rows), seed=7)
    totals = (
        sample.mapInArrow(measure, "rule int, seconds double, rejected bigint")
        .groupBy("rule")
        .agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected"))
        .collect()  # one row for each rule
    )
    worth = {row.rule: row.rejected / max(row.seconds, 1e-9) for row in totals}
    return [rules[i] for i in sorted(range(len(rules)), key=lambda i: (-worth.get(i, 0.0), i))]


def judge(
    docs: DataFrame,
    rules: Sequence[Rule],
    text: str = "text",
    keep: Sequence[str] = ("doc_id",),
    report: Sequence[str] = (),
    base: Sequence[Rule] = BASE,
    verdict: str = "kept",
) -> DataFrame:
    """(keep.., report.., [base_failed], kept): the verdict of a cascade over each whole text.

    `rules` run in the given order until one rejects. `report` names features of every row to
    return, in which case `base_failed` says whether one of `base` rejects. NULL is an empty text,
    which has no words. Repeated rows are judged alike; an empty table gives an empty table; columns
    that are not in `keep` are not read. `verdict` names the last column.
    """
    rest = [rule for rule in rules if not (report and rule in base)]
    schema = [f"`{c}` {t}" for c, t in docs.select(*keep).dtypes] + [f"{c} bigint" for c in report]
    schema += (["base_failed boolean"] if report else []) + [f"{verdict} boolean"]
    names = [*keep, *report, *(["base_failed"] if report else []), verdict]

    def row(value: str | None) -> tuple:
        features = Features(value)
        told = [getattr(features, name) for name in report]
        failed = [any(rule.rejects(features) for rule in base)] if report else []
        return *told, *failed, not any(failed) and not any(rule.rejects(features) for rule in rest)

    def batches(stream: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.int64()] * len(report) + [pa.bool_()] * (len(names) - len(keep) - len(report))
        for batch in stream:
            found = zip(*map(row, batch.column(text).to_pylist()))
            columns = [pa.array(values, kind) for values, kind in zip(found, kinds)] or [pa.array([], k) for k in kinds]
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + columns, names)

    return docs.select(*dict.fromkeys([*keep, text])).mapInArrow(batches, ", ".join(schema))
