"""What the operators share: reading, words, row packing."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word is a run of anything but ASCII white space (space and \t \n \v \f \r).
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once per application."""
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="rollcall-")) / "rollcall-package.zip"
    with zipfile.ZipFile(archive, "w") as packed_files:
        for file in sorted(root.rglob("*.py")):
            packed_files.write(file, file.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def words(text: Column) -> Column:
    """Array of the words of ``text``; null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def packed(docs: DataFrame, keep: list[str] | None, *computed: Column) -> DataFrame:
    """Input columns (all, or those named) as one struct ``row`` beside computed ones: no name can clash."""
    names = docs.columns if keep is None else keep
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in names]).alias("row"), *computed)


def unpacked(df: DataFrame, *more: Column) -> DataFrame:
    return df.select("row.*", *more)
