"""Column functions on composite keys: text keys, reproducible hash orders and hash buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

SEPARATOR = "|"


def join_key(cols: Sequence[str], sep: str = " ") -> Column:
    """One text key out of several columns."""
    return F.concat_ws(sep, *[F.col(c).cast("string") for c in cols])


def split_key(key: str | Column, names: Sequence[str], sep: str = " ") -> list[Column]:
    """The columns a text key was made of, as text."""
    parts = F.split(F.col(key) if isinstance(key, str) else key, _literal_regex(sep))
    return [parts.getItem(i).alias(name) for i, name in enumerate(names)]


def _literal_regex(text: str) -> str:
    return "\\Q" + text + "\\E"


def md5_order(seed: int, cols: Sequence[str]) -> Column:
    """A seeded pseudo-random order key that any SQL engine can recompute: md5 of ``seed|key|key…``."""
    return F.md5(F.concat_ws(SEPARATOR, F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def fold_hash(seed: int, cols: Sequence[str], digits: int = 8) -> Column:
    """The leading hex digits of :func:`md5_order` as a BIGINT."""
    return F.conv(F.substring(md5_order(seed, cols), 1, digits), 16, 10).cast("bigint")
