"""op13: a manifest of all documents, proved for rows of which a half may have been tampered with."""

from pyspark.sql import functions as F

from . import merkle
from .common import read


def tampered():
    """The text after a tampering that deletes line ends where the crc32 of the doc_id is even."""
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.translate(F.col("text"), "\n", "")).otherwise(F.col("text"))


def op13_merkle_manifest(spark, sf_dir):
    return merkle.prove(read(spark, sf_dir, "documents"), tampered())


QUERIES = {"op13_merkle_manifest": op13_merkle_manifest}
ORACLES: dict[str, str] = {}
