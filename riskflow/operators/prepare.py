"""Zero imputation, assembly and standardisation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml import Transformer
from pyspark.ml.feature import SQLTransformer, StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.functions.scalar import as_number, quoted


def _non_zero(name: str) -> Column:
    """The value as double, null where it is zero, NaN or null."""
    value = as_number(F.col(quoted(name)))
    return F.when(value != 0, value)


def nonzero_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Zero count and mean of the non-zero values per column, in one aggregate."""
    measures, entries = [], []
    for name in columns:
        measures += [
            F.count_if(F.col(quoted(name)) == 0).alias(f"{name}_zeros"),
            F.avg(_non_zero(name)).alias(f"{name}_mean"),
        ]
        entries.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.col(quoted(f"{name}_zeros")).alias("n_zero"),
                F.col(quoted(f"{name}_mean")).alias("mean_nonzero"),
            )
        )
    return df.agg(*measures).select(F.inline(F.array(*entries)))


def nonzero_means(df: DataFrame, columns: Sequence[str], on_all_zero: str = "raise") -> dict[str, float]:
    """Imputation means as numbers: one job, one row back.

    A column without any non-zero value has no mean: ``raise`` or ``keep`` its zeros.
    """
    row = df.agg(*(F.avg(_non_zero(name)).alias(name) for name in columns)).first()
    return _usable_means(row.asDict(), on_all_zero)


def _usable_means(means: Mapping[str, float | None], on_all_zero: str) -> dict[str, float]:
    empty = [name for name, mean in means.items() if mean is None]
    if empty and on_all_zero == "raise":
        raise ValueError(f"no non-zero value to impute from: {', '.join(empty)}")
    return {name: 0.0 if mean is None else mean for name, mean in means.items()}


def zero_impute(
    df: DataFrame,
    columns: Sequence[str],
    means: Mapping[str, float] | None = None,
    on_all_zero: str = "raise",
) -> DataFrame:
    """Replace zeros by the column's non-zero mean; nulls stay null, NaN becomes null."""
    means = means or nonzero_means(df, columns, on_all_zero)
    values = {name: as_number(F.col(quoted(name))) for name in columns}
    return df.withColumns(
        {
            name: F.when(value == 0, F.lit(means[name])).otherwise(value)
            for name, value in values.items()
        }
    )


def assemble(
    df: DataFrame, columns: Sequence[str], output: str = "features", handle_invalid: str = "error"
) -> DataFrame:
    return _assembler(columns, output, handle_invalid).transform(df)


def _assembler(columns: Sequence[str], output: str, handle_invalid: str) -> VectorAssembler:
    return VectorAssembler(inputCols=list(columns), outputCol=output, handleInvalid=handle_invalid)


def standardize(df: DataFrame, columns: Sequence[str], output: str = "features") -> DataFrame:
    """Vector of (value - mean) / sample deviation over the whole table."""
    raw = f"{output}_unscaled"
    assembled = assemble(df, columns, raw)
    scaler = StandardScaler(inputCol=raw, outputCol=output, withMean=True, withStd=True)
    return scaler.fit(assembled.select(raw)).transform(assembled).drop(raw)


def scaler_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean and sample deviation per feature, in one aggregate."""
    measures = []
    for name in columns:
        measures += [
            F.avg(quoted(name)).alias(f"{name}_mean"),
            F.stddev_samp(quoted(name)).alias(f"{name}_std"),
        ]
    entries = (
        F.struct(
            F.lit(name).alias("feature"),
            F.col(quoted(f"{name}_mean")).alias("mean"),
            F.col(quoted(f"{name}_std")).alias("std"),
        )
        for name in columns
    )
    return df.agg(*measures).select(F.inline(F.array(*entries)))


# Marks the scaled copy of a feature column.
SCALED_PREFIX = "z_"


@dataclass(frozen=True)
class Preparation:
    """Fitted numbers of the preparation step, and the stages that apply them."""

    features: tuple[str, ...]
    fill: dict[str, float]
    mean: dict[str, float]
    std: dict[str, float]
    n_rows: int

    def stages(self, output: str = "features", handle_invalid: str = "keep") -> list[Transformer]:
        """Impute and scale as SQL expressions, then assemble; all stages can be saved.

        By default rows with a missing feature keep NaN in the vector: the scorer
        decides what becomes of them, so that no row is lost or fails the job.
        """
        scaled = [SCALED_PREFIX + name for name in self.features]
        items = ", ".join(
            f"{self._expression(n)} AS {quoted(z)}" for n, z in zip(self.features, scaled)
        )
        return [
            SQLTransformer(statement=f"SELECT *, {items} FROM __THIS__"),
            _assembler(scaled, output, handle_invalid),
        ]

    def _expression(self, name: str) -> str:
        value = f"nanvl(CAST({quoted(name)} AS DOUBLE), CAST(NULL AS DOUBLE))"
        if not self.std[name]:
            # a constant column carries no information
            return f"CASE WHEN {value} IS NOT NULL THEN 0D END"
        if name in self.fill:
            value = f"CASE WHEN {value} = 0 THEN {self.fill[name]!r}D ELSE {value} END"
        return f"({value} - {_double(self.mean[name])}) / {_double(self.std[name])}"


def _double(value: float) -> str:
    return f"({value!r}D)"


def fit_preparation(
    df: DataFrame, features: Sequence[str], zero_columns: Sequence[str] = (), on_all_zero: str = "raise"
) -> Preparation:
    """Imputation means and scaler statistics in a single pass over the table.

    Filling zeros with the mean m of the non-zero values keeps the mean at m and
    adds nothing to the squared deviations, so the statistics after imputation
    follow from those of the non-zero values and the two counts.
    """
    measures = [F.count(F.lit(1)).alias("n_rows")]
    for name in features:
        number = as_number(F.col(quoted(name)))
        value = _non_zero(name) if name in zero_columns else number
        measures += [
            F.count(number).alias(f"{name}_rows"),
            F.count(value).alias(f"{name}_n"),
            F.avg(value).alias(f"{name}_mean"),
            F.var_samp(value).alias(f"{name}_var"),
        ]
    row = df.agg(*measures).first()
    means = {name: row[f"{name}_mean"] for name in features}
    fill = _usable_means({name: means[name] for name in zero_columns}, on_all_zero)
    std = {}
    for name in features:
        rows, n, var = row[f"{name}_rows"], row[f"{name}_n"], row[f"{name}_var"]
        std[name] = ((var or 0.0) * (n - 1) / (rows - 1)) ** 0.5 if rows > 1 and n > 1 else 0.0
    return Preparation(
        features=tuple(features),
        fill=fill,
        mean={name: means[name] if means[name] is not None else 0.0 for name in features},
        std=std,
        n_rows=row["n_rows"],
    )
