"""The training-data pipeline: stages over `documents`, each stored as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir) and returns the columns of `docs`, the last one its tokens. A
stage works on all that its predecessor kept, and what it decides is done to the documents:

1. quality: documents that the classifier, trained on `labels`, scores below 0.5 go;
2. lines: lines found in many documents go, the others stay in their order;
3. near_duplicates: of each group of near copies the document with the least id stays;
4. mix: documents are left out or repeated until the sources have their target shares;
5. tokens: texts become token ids, which are decoded again as a check.

Defined cases: a null text passes through 1 to 3 by the operators' rules for empty texts and is not drawn by
4; rows are told apart by id and text, so that of equal rows one stays in 3, and a copy that goes takes no
other row of its id along; rows without an id are never near copies; ties go to the least id, then to the
least hash of the text; an empty table gives an empty table; further columns of the documents pass through 1
to 4 unchanged, and names that begin with two underscores are used inside.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import bpe, line_dedup, minhash, mixing, quality
from riskloom.llm.common import table
from riskloom.operators.joins import broadcast_if_small
from riskloom.session import materialize


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more."""
    labels = table(spark, sf_dir, "labels").where(~quality.held_out()).select("doc_id", "quality")
    model = quality.fit(docs.select("doc_id", "text"), labels)
    return docs.where(quality.score(spark, model) >= 0.5)


def _with_text(docs: DataFrame, text: Column) -> DataFrame:
    """`docs` with another text, and the number of its characters where the table has that."""
    changed = docs.withColumn("text", text)
    if "n_chars" not in docs.columns:
        return changed
    return changed.withColumn("n_chars", F.coalesce(F.length("text").cast("long"), "n_chars"))


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that many share; a null text stays null."""
    done = line_dedup.drop_repeated_lines(docs, result="__lines")
    kept = F.when(F.col("text").isNotNull(), F.col("__lines.kept"))
    return _with_text(done, kept).select(*docs.columns)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies; of equal rows one.

    Only ids and marks of texts are looked at to find what goes and what is repeated; documents are
    joined with these, which moves them only where there are too many to broadcast.
    """
    found = materialize(minhash.near_duplicates(docs.select("doc_id", "text")), "near-copies")
    rows = docs.withColumn("__mark", F.xxhash64("text"))

    def of(thin: DataFrame) -> tuple[DataFrame, Column]:
        thin = broadcast_if_small(materialize(thin.select(F.col("doc_id").alias("__id"), F.col("mark").alias("__of")).distinct(), "near-rows"))
        return thin, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__mark") == F.col("__of"))

    rest = rows.join(*of(found.where(~F.col("first"))), "left_anti")
    again = materialize(found.where("first").groupBy("doc_id", "mark").count().where("count > 1"), "equal-rows")
    if again.limit(1).count():
        equal, same = of(again)
        one = rest.join(equal, same, "left_semi").dropDuplicates(["doc_id", "__mark"])
        rest = rest.join(equal, same, "left_anti").unionByName(one)
    return rest.select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole documents, each as often as the mix takes its words."""
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, n_tokens, ids and whether decoding gives the text back."""
    path = public_tokenizers.path(bpe.VOCABULARY)
    texts = docs.select("doc_id", "lang", "source", "text")
    coded = bpe.round_trip(texts, path, public_tokenizers.PATTERN, result="__coded")
    ids = F.col("__coded.ids")
    whole = F.col("__coded.decoded") == F.encode(F.coalesce("text", F.lit("")), "UTF-8")
    return coded.select("doc_id", "lang", "source", bpe.token_count("__coded.ids").alias("n_tokens"), ids.alias("ids"), whole.alias("whole"))


STAGES = [
    ("quality", quality_stage),
    ("lines", line_stage),
    ("near_duplicates", near_duplicate_stage),
    ("mix", mixing_stage),
    ("tokens", token_stage),
]

#: A trained classifier decides in the first stage, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
