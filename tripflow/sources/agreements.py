"""Service agreements."""

from tripflow.schemas import AGREEMENT


def read_agreements(spark, directory):
    """All agreement documents of a directory, one JSON object per file."""
    return (
        spark.read.schema(AGREEMENT)
        .option("multiLine", True)
        .option("pathGlobFilter", "*.json")
        .json(directory)
    )
