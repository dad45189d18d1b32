"""The corpus pipeline: documents in, token ids out.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as Parquet
and read again as the next stage's documents. All but the last return the columns of documents,
whatever further columns they have. Repeated rows and NULL ids are documents like others,
and an empty table gives no rows in every stage.
"""

from pyspark.sql import functions as F

from roadwatch.llm.line_chunks import without_repeated_chunks
from roadwatch.llm.mixing import mixed_documents
from roadwatch.llm.near import representatives
from roadwatch.llm.quality import good_documents
from roadwatch.llm.tables import stored
from roadwatch.llm.tokens import encode


def quality_rules(spark, docs, sf_dir):
    """Documents that the rules keep; a NULL or empty text has no words and goes."""
    return good_documents(docs)


def line_dedup(spark, docs, sf_dir):
    """All documents, repeated chunks of lines taken out; n_chars follows the text.

    Of repeated chunks the place with the smallest id (NULL first) and line stays. NULL texts stay NULL, with a NULL
    n_chars; a text that loses all lines is empty.
    """
    left = without_repeated_chunks(docs).select(*docs.columns)
    return left.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else left


def near_dedup(spark, docs, sf_dir):
    """One document of each group of near duplicates, and all that are in none.

    NULL and empty texts are in no group, so they stay.
    """
    return representatives(docs)


def mixing_sources(spark, docs, sf_dir):
    """Rows of documents, each as often as the mix takes it; texts without words are not taken."""
    return mixed_documents(docs)


def piece_tokens(spark, docs, sf_dir):
    """Token ids of each row, with the check that they decode to its text; NULL counts as empty."""
    return encode(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("MinHash near-dedup", near_dedup),
    ("mixing sources to target weights", mixing_sources),
    ("SentencePiece encoding and decoding", piece_tokens),
]

# Rolling hashes, minwise trees and tokens have no SQL; the tests run the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents table, each one's result stored before the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"stage-{number}")
    return docs
