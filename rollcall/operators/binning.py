"""Score bins: global quantile bins and fixed edges per agenda."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollcall.functions.scalars import right_closed_bin
from rollcall.operators.ordering import exact_quantiles


def qcut_edges(df: DataFrame, value: str, n_bins: int) -> list[float]:
    """The ``n_bins + 1`` quantile edges of a column; these few numbers are collected."""
    probs = [i * (1.0 / n_bins) for i in range(n_bins)] + [1.0]
    row = exact_quantiles(df, value, probs).first()
    if row is None or row["edges"][0] is None:
        raise ValueError(f"no values in {value}")
    edges = list(row["edges"])
    if any(a >= b for a, b in zip(edges, edges[1:])):
        raise ValueError(f"bin edges must be unique: {edges}")
    return edges


def qcut(df: DataFrame, value: str, n_bins: int, out: str = "bin") -> DataFrame:
    """Quantile bin of each row: right-closed, the lowest value included."""
    return df.withColumn(out, right_closed_bin(value, qcut_edges(df, value, n_bins)[1:-1]))


def top_row(
    df: DataFrame, key: str, score: str, tie: Sequence[str] = ()
) -> DataFrame:
    """The highest-score row per key; ties go to the smallest ``tie`` columns.

    An aggregate, so a hot key is reduced before it is shuffled.
    """
    payload = [c for c in df.columns if c != key]
    # Ties: first the best score, then the smallest tie values among its rows.
    packed = F.struct(*[F.col(c) for c in tie], *[F.col(c) for c in payload if c not in tie])
    best = df.groupBy(key, score).agg(F.min(packed).alias("_row"))
    top = best.groupBy(key).agg(F.max_by("_row", score).alias("_row"))
    return top.select(
        *[F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns]
    )


def bin_edges(
    predictions: DataFrame,
    by: str,
    n_bins: int = 4,
    patient: str = "pseudo_id",
    score: str = "prediction",
    tie: Sequence[str] = ("APP_ID",),
) -> DataFrame:
    """Quantile edges per agenda over each patient's highest score."""
    probs = [i * (1.0 / n_bins) for i in range(n_bins)] + [1.0]
    return exact_quantiles(top_row(predictions, patient, score, tie), score, probs, [by])


def apply_bins(
    df: DataFrame, edges: DataFrame, by: str, score: str = "prediction"
) -> DataFrame:
    """Bin number by the agenda's edges ``(0, q1], (q1, q2], ... (max, 1]``.

    0 or less and more than 1 get no bin.  An agenda without edges is an error.
    """
    known = edges.select(F.col(by), F.col("edges").alias("_edges"))
    joined = df.join(known, by, "left")
    checked = F.when(
        F.col("_edges").isNull(),
        F.raise_error(F.concat(F.lit("no bin edges for "), F.col(by).cast("string"))),
    ).otherwise(F.col("_edges"))
    x = F.col(score)
    above = F.size(F.filter(F.slice(checked, 2, F.greatest(F.lit(0), F.size(checked) - 1)), lambda e: e < x))
    return joined.withColumn(
        "score_bin", F.when((x > 0) & (x <= 1), above).otherwise(F.lit(None).cast("int"))
    ).select(*df.columns, "score_bin")
