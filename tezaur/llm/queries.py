"""Registered queries of the text-corpus operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import table
from .broken_pairs import broken_pairs
from .layout_copies import layout_copies
from .lost_ends import lost_ends, question_of, rates
from .normal_form import consistent_form
from .personal_items import found as items_found
from .personal_items import sanitised
from .source_mix import mixture, report
from .split_overlap import counts_found, pairs_found
from .tokenizer import encode_corpus
from .wrong_decoding import garbled_fields, wrongly_decoded

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields that differ from their consistent form."""
    names = table(spark, sf_dir, "stations").select(F.lit("station_name").alias("field_name"), F.col("station_id").cast("string").alias("record_id"), F.col("station_name").alias("text"))
    questions = table(spark, sf_dir, "generated_example").select(F.lit("question_ro").alias("field_name"), F.col("id").alias("record_id"), F.col("question_ro").alias("text"))
    return consistent_form(names.unionByName(questions), "text").where("text <> form").select("field_name", "record_id")


@query
def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by byte_bpe_50k."""
    return encode_corpus(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "ids")


@query
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of question_en and sql in another layout: the group's smallest id and every other id."""
    return layout_copies(table(spark, sf_dir, "generated_example"), "id", "question_en", "sql")[0]


@query
def p4_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One record for each group of layout copies, with the number of its copies."""
    return layout_copies(table(spark, sf_dir, "generated_example"), "id", "question_en", "sql")[1]


_GARBLED = (["instruction", "input"], ["instruction", "input", "output"])


@query
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields a part or all of which was decoded wrongly."""
    return garbled_fields(table(spark, sf_dir, "queries_alpaca_ro"), "id", *_GARBLED).select("field_name", "id")


@query
def p6_restored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same fields with the original text where it can be recovered."""
    return wrongly_decoded(table(spark, sf_dir, "queries_alpaca_ro"), "id", *_GARBLED).select("field_name", "id", "restored")


def _ends(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, q = table(spark, sf_dir, "generated_example"), table(spark, sf_dir, "queries_alpaca_ro")
    english = F.coalesce("question_en", F.lit(""))
    first = e.select(F.lit("question_ro").alias("field_name"), F.col("id").alias("record_id"), "source", F.col("question_ro").alias("text"), F.concat_ws(" ", "sql", english).alias("sibling"), english.alias("named"))
    asked = question_of("input")
    second = q.select(F.lit("instruction").alias("field_name"), F.col("id").alias("record_id"), F.col("source_dataset").alias("source"), F.col("instruction").alias("text"), F.concat_ws(" ", asked, "output").alias("sibling"), F.regexp_replace(asked, r"(?s)\n\s*(?:SELECT|INSERT|UPDATE|DELETE|CREATE|DROP|WITH)\b.*", "").alias("named"))
    return lost_ends(first.unionByName(second))


@query
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts whose end was lost."""
    return _ends(spark, sf_dir).where("lost").select("field_name", "record_id")


@query
def p2_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of cut texts for each field and source."""
    return rates(_ends(spark, sf_dir))


@query
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records whose output does not answer their instruction, with the defect's type."""
    return broken_pairs(table(spark, sf_dir, "queries_alpaca_ro"), "instruction", "input", "output")


@query
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of equal or nearly equal records across train and the other splits."""
    return pairs_found(table(spark, sf_dir, "generated_example"))


@query
def p5_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pairs' counts for each split and source."""
    return counts_found(table(spark, sf_dir, "generated_example"))


@query
def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every item of personal information in the posts."""
    return items_found(table(spark, sf_dir, "documents"))


@query
def p9_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts with a typed placeholder in place of each item."""
    return sanitised(table(spark, sf_dir, "documents"))


@query
def p8_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as one mixture with the shares of mix_targets: blocks of tokens with the pieces of documents they hold."""
    return mixture(table(spark, sf_dir, "documents"), table(spark, sf_dir, "mix_targets"))


@query
def p8_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Target and reached share of each source of the mixture."""
    return report(p8_mixture(spark, sf_dir), table(spark, sf_dir, "mix_targets"))
