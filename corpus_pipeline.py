"""The corpus pipeline: documents in, packed token ids out.

Five stages, each one an operator of ``refinery.llm`` over all that the stage
before kept.  Every stage but the last returns the columns of its input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from refinery.llm.common import small_batches, table
from refinery.llm.decontaminate import contamination
from refinery.llm.jaccard_join import similar_groups
from refinery.llm.language import UNDETERMINED, identify, train_on_open_part, with_letter
from refinery.llm.mixing import mix
from refinery.llm.tokens import read_token_files, write_token_files
from refinery.session import materialize, scratch_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told: a null text, or one without a
    letter, goes.  Nothing else is rejected, also where no row is labelled
    outside the held-out third and so there is no model."""
    model = train_on_open_part(docs)
    if model is None:
        return with_letter(docs)
    told = identify(docs, model, carry={"id": F.col("doc_id"), "text_hash": F.xxhash64("text")}, names=("__lang", "__score"))
    rejected = told.filter(F.col("__lang") == UNDETERMINED).select("id", "text_hash").distinct()
    with small_batches(spark):
        rejected = materialize(rejected, "pipeline-rejected")        # texts do not come back from Python
    return without(docs, rejected)


def text_key(docs: DataFrame, prefix: str = "__") -> DataFrame:
    """``docs`` with the pair that names a row's id and text."""
    return docs.withColumns({f"{prefix}id": F.col("doc_id"), f"{prefix}text": F.xxhash64("text")})


def without(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """``docs`` without the rows named in ``keys`` (id, text_hash)."""
    same = F.col("__id").eqNullSafe(F.col("__gone_id")) & (F.col("__text") == F.col("__gone_text"))
    gone = keys.select(F.col("id").alias("__gone_id"), F.col("text_hash").alias("__gone_text"))
    return text_key(docs).join(gone, same, "left_anti").drop("__id", "__text")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: the one with the
    smallest id.  A document without words is alone and stays."""
    groups = materialize(similar_groups(docs).filter("n_shingles > 0"), "pipeline-groups")
    leads = F.col("id").eqNullSafe(F.col("component")) & (F.col("text_hash") == F.col("component_text"))
    kept = without(docs, groups.filter(~leads).select("id", "text_hash").distinct())
    # a leading row that repeats as a whole, id and text, stays once
    again = groups.filter(leads).groupBy("id", "text_hash").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    again = materialize(again.select(F.col("id").alias("__again_id"), F.col("text_hash").alias("__again_text")), "pipeline-again")
    if not again.take(1):
        return kept
    same = F.col("__id").eqNullSafe(F.col("__again_id")) & (F.col("__text") == F.col("__again_text"))
    keyed = text_key(kept)
    once = keyed.join(again, same, "left_semi").dropDuplicates(["__id", "__text"])
    return keyed.join(again, same, "left_anti").unionByName(once).drop("__id", "__text")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark window."""
    with small_batches(spark):
        found = contamination(docs, table(spark, sf_dir, "benchmark"))
        found = materialize(found.filter("n_hit > 0").select("id", "text_hash").distinct(), "pipeline-contaminated")
    return without(docs, found)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it: not at all up to three times."""
    rows = materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "pipeline-rows")
    times = mix(rows, row_column="__row").filter("times > 0").select(F.col("row").alias("__taken"), F.col("times").alias("__times"))
    taken = rows.join(times, F.col("__row") == F.col("__taken"))
    copies = taken.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__times"))))
    return copies.select(*[F.col(f"`{c}`") for c in docs.columns])


def token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, written and read back: doc_id, start, n_tokens, ids_crc32."""
    import public_tokenizers

    folder = scratch_path(spark, "pipeline-tokens")
    with small_batches(spark):
        manifest = write_token_files(docs, folder, public_tokenizers.path("byte_bpe_50k.json"))
    return read_token_files(manifest, folder).select("doc_id", "start", "n_tokens", "ids_crc32")


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("mix_sources", mix_sources),
    ("token_files", token_files),
]

# A trained classifier and a tokenizer decide, which SQL cannot express: tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents of ``sf_dir``, each one's result written
    as Parquet and reread as the next one's input."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
