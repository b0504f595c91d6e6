"""The corpus pipeline: documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents.
"""

import public_tokenizers

from tripflow.llm import classifier, jaccard, line_quality, packing, secrets
from tripflow.llm.queries import WORD_TOKENIZER
from tripflow.session import fresh_dir


def quality_classifier(spark, docs, sf_dir):
    """Documents that the classifier rejects go."""
    return classifier.keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def quality_rules(spark, docs, sf_dir):
    """Documents that the rules reject go, and so do boilerplate lines of the others."""
    return _with_chars(line_quality.clean(docs))


def near_duplicates(spark, docs, sf_dir):
    """One document of each group of copies stays."""
    return jaccard.keep_one(docs)


def secret_scan(spark, docs, sf_dir):
    """Secrets are masked."""
    return _with_chars(secrets.redact(docs))


def pack(spark, docs, sf_dir):
    """Pieces of all documents with their place in the sequences."""
    return packing.packed_pieces(docs, public_tokenizers.path(WORD_TOKENIZER))


def _with_chars(docs):
    """The stored length follows the text."""
    from pyspark.sql import functions as F

    return docs.withColumn("n_chars", F.char_length("text").cast("long")) if "n_chars" in docs.columns else docs


STAGES = [
    ("quality classifier", quality_classifier),
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("secret scan", secret_scan),
    ("packing", pack),
]

# The classifier is trained and the pieces are tokenised; SQL expresses neither.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages, one after the other, from documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = fresh_dir(spark, name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
