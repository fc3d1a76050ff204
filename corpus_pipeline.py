"""A training corpus from ``documents``, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next stage's ``docs``.  All but the last return the columns of ``documents``; ``n_chars``
follows the text.  A stage works on all rows that its predecessor kept:

1. quality rules: documents that a rule rejects go (null and empty texts among them);
2. line dedup: lines that are equal to an earlier line, or one word away, go;
3. n-gram Jaccard join: one document of each group of near copies stays (five words, 80 %);
4. substring dedup: passages of 20 words and more that start earlier elsewhere go;
5. packing: sequences of 2048 tokens.

A document that loses its last word in stage 2 or 4 goes.  Null doc_ids sort first; rows with equal doc_ids
are documents of their own to stages 1, 3 and 5, and the same place in the order to 2 and 4, where equal rows
both stay.  Ties go to the earlier line or place.  Other columns may have any name; an empty table
passes all stages.  From the second on, a stage begins by
removing the tables that the stage before kept in the shared folder: its result has been written by
then.

``ORACLE_SQL`` is None: Jaccard components and tokenisation are beyond SQL; tests/llm compares the
pipeline with a brute-force version.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from raresight.llm import jaccard, lines, packing, quality, substring, token_ids
from raresight.llm.common import documents, recorded, remove, ship
from raresight.session import scratch_path

ORACLE_SQL = None
HAS_WORD = r"[^\x20\x09-\x0D]"


def as_rows(docs: DataFrame) -> DataFrame:
    """(row, doc_id, text): all columns but the text as one struct, so that their names meet no others."""
    return docs.select(F.struct(*[c for c in docs.columns if c != "text"]).alias("row"), "doc_id", "text")


def with_text(kept: DataFrame, columns: list[str]) -> DataFrame:
    """``row``'s columns with kept_text as the text; documents without a word go."""
    row, text = F.col("row"), F.col("kept_text")
    fields = {f.name: f.dataType for f in kept.schema["row"].dataType.fields}
    new = {"text": text, "n_chars": F.char_length(text).cast(fields["n_chars"]) if "n_chars" in fields else None}
    return kept.filter(text.rlike(HAS_WORD)).select(*[(row.getField(c) if new.get(c) is None else new[c]).alias(c) for c in columns])


_TABLES: list[str] = []  # of the stage before


def after_the_last(first: bool = False):
    """The first stage leaves what another run has, whose last result may still be read."""
    def wrap(stage):
        @wraps(stage)
        def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
            ship(spark)
            if not first:
                remove(spark, _TABLES)
            with recorded() as paths:
                out = stage(spark, docs, sf_dir)
            _TABLES[:] = paths
            return out
        return run_stage
    return wrap


@after_the_last(first=True)
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs)


@after_the_last()
def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_text(lines.dedup_lines(as_rows(docs), min_words=2, keep=("row",)), docs.columns)


@after_the_last()
def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.keep_one(docs, size=5, percent=80)


@after_the_last()
def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return with_text(substring.dedup_substrings(as_rows(docs), window=20, keep=("row",), layout=True), docs.columns)


@after_the_last()
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, token_ids.vocabulary_path(), end_id=1, capacity=2048, added=True)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", jaccard_join),
    ("substring dedup", substring_dedup),
    ("packing", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, stored = documents(spark, sf_dir), []
    for _, stage in STAGES[:-1]:
        path = scratch_path(spark, "pipeline")
        stage(spark, docs, sf_dir).write.parquet(path)
        remove(spark, stored)  # the stage before's result, read for the last time
        docs, stored = spark.read.parquet(path), [path]
    return STAGES[-1][1](spark, docs, sf_dir)
