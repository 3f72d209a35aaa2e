"""Text tables read with a schema, what cannot be read set aside instead of turned into nulls."""

from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskflow.functions.scalar import quoted
from riskflow.session import counting, materialize
from riskflow.sources.tables import typed

_log = logging.getLogger(__name__)

# Columns of the stored rows beside those of the table.
_LINE, _CELLS, _READABLE = "__line", "__unreadable", "__readable"


@dataclass(frozen=True)
class Ingested:
    """``table``: all well-formed rows, unreadable cells null. ``rejects``: the key columns,
    ``column`` and ``raw`` text of every unreadable cell, and of a line with too few or too many
    fields its whole text, without a column. ``counts``: per column (rows read, empty, rejected)."""

    table: DataFrame
    rejects: DataFrame
    n_rows: int
    n_malformed: int
    counts: dict[str, tuple[int, int, int]]

    def check(self, max_share: float) -> None:
        """An error that names the columns of which more than ``max_share`` of the rows is rejected."""
        rows = max(1, self.n_rows)
        wrong = [
            f"{name} ({rejected} of {self.n_rows} rows)"
            for name, (_, _, rejected) in self.counts.items()
            if rejected > max_share * rows
        ]
        if self.n_malformed > max_share * rows:
            wrong.append(f"lines ({self.n_malformed} of {self.n_rows})")
        if wrong:
            raise ValueError(f"unreadable: {', '.join(wrong)}")


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header row, all columns text; a line whose fields do not fit the header
    is kept whole in one more column."""
    header = spark.read.option("header", True).csv(path).columns
    schema = T.StructType([T.StructField(name, T.StringType()) for name in (*header, _LINE)])
    reader = spark.read.option("header", True).option("columnNameOfCorruptRecord", _LINE)
    return reader.schema(schema).csv(path)


def ingest(text: DataFrame, schema: T.StructType | str, key: Sequence[str] = ()) -> Ingested:
    """Cells of ``schema`` as their types, by name; other columns stay text.

    A blank cell is empty, not unreadable. The text is read once: rows and rejects
    are written in one job, parted by readability, and counted along the way. ``rejects`` carry the
    key as text, so that an unreadable key shows too.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    if _LINE not in text.columns:
        text = text.withColumn(_LINE, F.lit(None).cast("string"))
    names = [field.name for field in schema.fields]
    columns = [name for name in text.columns if name != _LINE]
    raw = {name: F.col(f"t.{quoted(name)}") for name in names}
    cast = {name: F.col(f"c.{quoted(name)}") for name in names}
    # Both forms of a row side by side, so that each cell is cast once.
    both = typed(text.select("*", F.struct("*").alias("t")), schema).select(
        "t", F.struct(*(F.col(quoted(n)) for n in columns)).alias("c")
    )
    well_formed = F.col(f"t.{_LINE}").isNull()
    blank = {n: F.coalesce(F.trim(raw[n]) == "", F.lit(True)) for n in names}
    unreadable = {n: well_formed & ~blank[n] & cast[n].isNull() for n in names}
    cells = F.array_compact(
        F.array(*(F.when(unreadable[n], F.struct(F.lit(n).alias("column"), raw[n].alias("raw"))) for n in names))
    )
    measures = [F.count(F.lit(1)).alias("n_rows"), F.count_if(~well_formed).alias("n_malformed")]
    for i, n in enumerate(names):
        measures += [
            F.count_if(well_formed & ~blank[n] & cast[n].isNotNull()).alias(f"read_{i}"),
            F.count_if(well_formed & blank[n]).alias(f"empty_{i}"),
            F.count_if(unreadable[n]).alias(f"rejected_{i}"),
        ]
    keys = F.struct(*(F.col(f"t.{quoted(n)}").alias(n) for n in key)) if key else F.struct(F.lit(1).alias("__none"))
    counted, tally = counting(both, *measures)
    rows = counted.select(
        "c.*", F.col(f"t.{_LINE}").alias(_LINE), cells.alias(_CELLS), keys.alias("__key")
    )
    readable = F.col(_LINE).isNull() & (F.size(_CELLS) == 0)
    stored = materialize(
        rows.withColumn(_READABLE, readable), "ingested", [_READABLE], text.sparkSession
    )
    found = tally.get()
    counts = {
        n: (found[f"read_{i}"], found[f"empty_{i}"], found[f"rejected_{i}"]) for i, n in enumerate(names)
    }
    for n, (_, _, rejected) in counts.items():
        if rejected:
            _log.warning("%s: %d cells cannot be read", n, rejected)
    if found["n_malformed"]:
        _log.warning("%d lines do not have the fields of the header", found["n_malformed"])
    whole = F.struct(F.lit(None).cast("string").alias("column"), F.col(_LINE).alias("raw"))
    items = F.when(F.col(_LINE).isNotNull(), F.array(whole)).otherwise(F.col(_CELLS))
    rejects = stored.filter(~F.col(_READABLE)).select(
        *(F.col(f"__key.{quoted(n)}").alias(n) for n in key), F.inline(items)
    )
    table = stored.filter(F.col(_LINE).isNull()).select(*(F.col(quoted(n)) for n in columns))
    return Ingested(table, rejects, found["n_rows"], found["n_malformed"], counts)
