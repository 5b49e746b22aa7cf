"""A corpus pipeline over ``documents``: each stage's rows are written as Parquet and read back for the next.

Every stage takes (spark, docs, sf_dir), works on all rows that it gets, and all but the last give the columns of
``documents``; n_chars follows the text where a stage changes it. The columns may have any names besides ``doc_id`` and
``text``. An empty table gives an empty table; rows with a NULL id or text, and repeated rows, are kept unless a stage says
otherwise.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ludolytics.llm import decontaminate, line_dedup, near_dedup, piece_bpe, toxicity
from ludolytics.llm.common import stored, table
from ludolytics.session import configure


def _rows(docs: DataFrame) -> DataFrame:
    """(doc_id, text, row): a row's other columns are out of the operators' way."""
    return docs.select("doc_id", "text", F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression distance calls toxic go; it is learnt from those of them that are labelled.

    Without labels nothing goes. A text without words has no sign of toxicity and stays; repeated rows go together.
    """
    configure(spark)
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    judged = toxicity.score(_rows(docs), model, keep=("row",))
    return judged.where("predicted = 0").select("row.*")


def cut_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated passages are cut out of the texts; every document stays, its text may become empty.

    The copy in the least id stays (NULL first, then by the text); rows that repeat id and text are cut alike.
    """
    configure(spark)
    cut = line_dedup.without_repeats(_rows(docs))
    own = {"text": F.col("text"), "n_chars": F.length("text").cast("bigint")}
    return cut.select(*(own.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one of the least doc_id.

    Documents without words are no copies of each other; rows without an id stay, rows of one id stay or go together.
    """
    configure(spark)
    judged = near_dedup.near_duplicates(docs.select("doc_id", "text"))
    return docs.join(judged.where("NOT kept").select("doc_id"), "doc_id", "left_anti").select(*(f"`{c}`" for c in docs.columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go; with an empty benchmark none."""
    configure(spark)
    found = decontaminate.find_benchmark(_rows(docs), table(spark, sf_dir, "benchmark"), keep=("row",))
    return found.where("size(hits) = 0").select("row.*")


def encode_and_decode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, token_ids, decoded) of what is left; a NULL text is an empty one and has no tokens."""
    configure(spark)
    both = piece_bpe.round_trip(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return both.select("doc_id", F.size("token_ids").cast("bigint").alias("n_tokens"), "token_ids", "decoded")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", cut_repeated_lines),
    ("near copies", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("piece encoding and decoding", encode_and_decode),
]

#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage; the rows between stages are written to the shared folder."""
    configure(spark)
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, "stage")
    return docs
