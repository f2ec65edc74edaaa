"""A corpus pipeline: ``documents`` to token ids in five stages.

``run(spark, sf_dir)`` applies STAGES in order.  Each stage gets all that its
predecessor kept and writes Parquet to the shared folder, which the next one
reads; a lost executor re-runs only its tasks of the stage at hand.  All but
the last return the columns of ``documents``, whatever these are called: a stage's
own columns take names that its input does not have.  An empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickwise.llm import byte_bpe, decontaminate, line_dedup, queries, simhash, toxicity
from tickwise.llm.common import bound_batches, read, spare
from tickwise.session import materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that a classifier trained on ``labels`` calls toxic.

    Null and empty texts are scored like any other, from no features.
    """
    bound_batches(spark)
    members = toxicity.train(docs, read(spark, sf_dir, "labels"))
    own = spare(docs.columns) + "score"
    scored = toxicity.with_score(docs, members, out=own)
    return scored.where(F.col(own) < queries.TOXIC).select(*docs.columns)


def drop_boilerplate_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cut each document's lines that are boilerplate of its source.

    The ratio judges sources of every size; a null text stays null.  A page
    that the cut would leave blank keeps its whole text: it is a copy of others
    rather than boilerplate around a page, and the next stage keeps one of them.
    """
    bound_batches(spark)
    own = spare(docs.columns) + "cut"
    cut = line_dedup.drop_boilerplate(docs, out=own)
    left = F.col(f"{own}.text")
    left = F.when(F.trim(left, F.lit(line_dedup.BLANK + "\n")) == "", F.col("text")).otherwise(left)
    values = {"text": left, "n_chars": F.length(left).cast("long")}
    return cut.select(*[values.get(c, F.col(c)).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of each group of near-duplicates.

    Null, empty and blank texts are one group.
    """
    bound_batches(spark)
    return simhash.one_of_each(docs, simhash.near_duplicates(docs)).select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold too much of the benchmark; a null or empty text
    holds nothing of it."""
    bound_batches(spark)
    own = spare(docs.columns) + "hits"
    hits = decontaminate.benchmark_hits(docs, read(spark, sf_dir, "benchmark"), out=own)
    return hits.where(~decontaminate.contaminated(own)).select(*docs.columns)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document, and digests of them and of the decoded bytes; a
    null or empty text has no ids."""
    bound_batches(spark)
    coded = byte_bpe.encode_decode(docs.select("doc_id", "text"), queries.rank_file(),
                                   queries.public_tokenizers.PATTERN)
    return queries.digests(coded.select("doc_id", "bpe", F.col("bpe.ids").alias("ids")))


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_boilerplate_lines),
    ("simhash", drop_near_duplicates),
    ("decontaminate", drop_contaminated),
    ("byte_bpe", tokenize),
]
#: The first stage scores by a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over the whole ``documents`` table."""
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
