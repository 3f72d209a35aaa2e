"""Train/test split and folds from a hash of the record key.

Unlike a random split these do not depend on partitioning, row order or retries.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def key_digest(key: Sequence[str]) -> Column:
    """The key's digest as hexadecimal text."""
    return F.md5(F.concat_ws("|", *(F.col(name).cast("string") for name in key)))


def _hex_number(digest: Column, start: int) -> Column:
    """Seven hex digits as a number below 2**28."""
    return F.conv(F.substring(digest, start, 7), 16, 10).cast("bigint")


def _digest_number(key: Sequence[str], start: int) -> Column:
    return _hex_number(key_digest(key), start)


def digest_share(digest: Column) -> Column:
    """A number from 0 to 1 per digest, of other digits than split and folds use."""
    return _hex_number(digest, 15) / F.lit(float(1 << 28))


def is_train(key: Sequence[str], percent: int = 80) -> Column:
    return _digest_number(key, 1) % 100 < percent


def fold_of(key: Sequence[str], folds: int = 3) -> Column:
    """Fold number from other digits than the split uses, so the two are independent."""
    return (_digest_number(key, 8) % folds).cast("int")


def hash_split(df: DataFrame, key: Sequence[str], percent: int = 80) -> tuple[DataFrame, DataFrame]:
    return df.filter(is_train(key, percent)), df.filter(~is_train(key, percent))
