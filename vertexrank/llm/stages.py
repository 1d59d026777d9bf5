"""Stages of the corpus pipeline: ``(spark, docs, sf_dir) -> DataFrame``.

All but the last return the columns of ``docs``. Rows are judged by ``doc_id``
and text: rows that share an id but not the text have decisions of their own,
and rows without id take part like any other; null and empty texts pass unless
the classifier rejects them; further columns are kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate as leaks
from .common import cut, join_checked, join_text, pack, read_table, unpack
from .line_dedup import dedup_lines
from .mixing import apply_mix, mix_parameters, n_words
from .ngram_join import ngram_components
from .quality import fit, score_documents


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    scored = score_documents(pack(docs, ["doc_id", "text"]), model).where("predicted = 1")
    return scored.select(*unpack(scored, docs.columns))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every family of like lines one stays; documents left without text go."""
    cleaned = dedup_lines(pack(docs, ["doc_id", "text"]), null_ids=True).where("n_removed = 0 or trim(text) <> ''")
    return cleaned.drop("n_lines", "n_removed").select(*unpack(cleaned.drop("n_lines", "n_removed"), docs.columns))


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: of the smallest id, then text
    hash, a null id last; where that row is repeated, the first by its other columns."""
    found = ngram_components(docs, n=5, share=80, by_text=True).where("component is not null")
    texts = cut(found.groupBy("component", "doc_id", "th").agg(F.count("*").alias("m")))
    key = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "th")
    top = cut(texts.groupBy("component").agg(F.min(key).alias("top"), F.sum("m").alias("rows")).where("rows > 1").select("component", "top"))
    judged = join_checked(texts, top, "component", "inner", 48).where((key > F.col("top")) | (F.col("m") > 1))
    judged = cut(judged.select("doc_id", "th", (key == F.col("top")).alias("stays")))
    left = join_text(docs, judged.drop("stays"), "left_anti", 24)
    again = cut(judged.where("stays").drop("stays"))
    if not again.count():
        return left
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    one = join_text(docs, again, "left_semi", 24).select("doc_id", F.xxhash64("text").alias("th"), F.to_json(row).alias("by"), row.alias("row"))
    one = one.groupBy("doc_id", "th").agg(F.min_by("row", "by").alias("row"))
    return left.unionByName(one.select(*[F.col("row").getField(c).alias(c) for c in docs.columns]))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return leaks.drop_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in the mix, with their number of ``copies`` (1 or 2) and the
    sizes and targets behind it; empty documents stay as they are."""
    sized = cut(docs.select("doc_id", "source", n_words().alias("size")))
    packed = pack(docs, ["doc_id", "source", "text"]).withColumn("size", n_words())
    mixed = apply_mix(packed, mix_parameters(sized)).where("copies > 0 or size = 0")
    added = ["size", "source_size", "target", "rate", "copies", "taken"]
    return mixed.select(*unpack(mixed.drop(*added), [c for c in docs.columns if c not in added]), *added)
