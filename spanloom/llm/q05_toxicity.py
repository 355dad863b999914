"""op5: toxicity of every document, learned from labels outside the held-out fold."""

from pyspark.sql import functions as F

from . import toxicity
from .common import read
from .sampling import fold

FOLDS, HELD, THRESHOLD = 4, 2, 0.3


def fit_outside_fold(docs, labels):
    return toxicity.fit(docs, labels.where(fold(F.col("doc_id"), FOLDS) != HELD))


def op5_toxicity(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit_outside_fold(docs, read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id"), FOLDS) == HELD, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


QUERIES = {"op5_toxicity": op5_toxicity}
ORACLES: dict[str, str] = {}  # learned; tests hold it to accuracy on the held-out fold
