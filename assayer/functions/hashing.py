"""Row hashes, seeded orders and table fingerprints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_MISSING = "<NA>"


def _texts(columns: Sequence[str]) -> list[Column]:
    # concat_ws skips NULLs, which would make (a, NULL) and (NULL, a) the same row.
    return [F.coalesce(F.col(c).cast("string"), F.lit(_MISSING)) for c in columns]


def row_hash(columns: Sequence[str]) -> Column:
    """md5 of the values joined by a pipe."""
    return F.md5(F.concat_ws("|", *_texts(columns)))


def row_hash_strict(columns: Sequence[str]) -> Column:
    """sha256 of the row as JSON: a pipe inside a value cannot imitate a column boundary."""
    return F.sha2(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}), 256)


def seeded_code(seed: int, key: Column) -> Column:
    """Hex text that orders rows at random, the same way wherever they are."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), key.cast("string")))
    # Never NULL, so a join on a part of it needs no NULL filter that would hash every row again.
    return F.coalesce(digest, F.lit(""))


def content_number(columns: Sequence[str]) -> Column:
    """The two halves of the row hash, each as a decimal, added; to be summed into a table fingerprint."""
    digest = row_hash(columns)
    halves = [F.conv(F.substring(digest, at, 16), 16, 10).cast("decimal(20,0)") for at in (1, 17)]
    return (halves[0] + halves[1]).cast("decimal(21,0)")
