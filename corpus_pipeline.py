"""The corpus pipeline: quality rules, near duplicates, decontamination, mixing, token ids.

Each stage works on all that its predecessor kept. Stages write Parquet that the next one reads back, so
a lost executor repeats one stage at most.

Defined cases: rows with null or empty text fail the base rule and go in the first stage, and so do texts of under 50 words; a null
``source`` is a source of its own; repeated rows and equal texts are one group, of which the row with the smallest doc_id
stays; very long texts are worked on whole in every stage; documents of equal position in the mix keep the order that the mix
wrote, which the last stage reads from the files; an empty table gives an empty result. Stages hand on all columns of
``documents``, also ones of other names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rollcall.llm.common import default_tokenizer, table
from rollcall.llm.decontaminate import clean_documents
from rollcall.llm.mixing import mixed_documents
from rollcall.llm.near_dups import deduplicated
from rollcall.llm.quality_rules import kept_documents
from rollcall.llm.token_store import token_digest
from rollcall.session import drop_paths, materialize, scratch_made, scratch_path, use_utc


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rule and lie near their language's histograms."""
    return kept_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a similarity of 0.8 or more."""
    return deduplicated(docs, width=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per copy that the mix takes, in training order over the written files."""
    return mixed_documents(docs)


def stored_order(docs: DataFrame) -> list | None:
    """The order in which a table's files and their rows were written; None if ``docs`` is not read from files."""
    name, row = F.col("_metadata.file_name"), F.col("_metadata.row_index")
    try:
        docs.select(name, row)
    except AnalysisException:
        return None
    return [F.regexp_extract(name, r"part-(\d+)", 1).try_cast("long"), name, row]


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens and crc of every row's ids, read back from a store in training order."""
    path = scratch_path(spark, "pipeline-tokens")
    return token_digest(docs, path, default_tokenizer(), order=stored_order(docs))


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

_scratch: dict[int, list[str]] = {}


def _in_turn(number: int, stage: Stage) -> Stage:
    """The stage, which first deletes its predecessor's intermediates: what it gets is written and read back."""

    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        drop_paths(spark, _scratch.pop(number - 1, []))
        before = len(scratch_made)
        result = stage(spark, docs, sf_dir)
        _scratch[number] = scratch_made[before:]
        return result

    return run_stage


STAGES: list[tuple[str, Stage]] = [
    (name, _in_turn(number, stage))
    for number, (name, stage) in enumerate(
        [
            ("quality rules", quality_rules),
            ("near duplicates", near_duplicates),
            ("decontamination", decontamination),
            ("mixing", mixing),
            ("token ids", token_ids),
        ]
    )
]

#: Sketches, walks and tokenizers have no SQL counterpart; tests compare with plain Python instead.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    use_utc(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = materialize(docs, "pipeline-stage")
    return docs
