"""op8: links and classes of all embeddings at cosine 0.93 within a label."""

from .common import read
from .vectors import near_duplicates


def op8_embedding_near_dedup(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "embeddings"), 0.93)


QUERIES = {"op8_embedding_near_dedup": op8_embedding_near_dedup}
ORACLES: dict[str, str] = {}  # hashing may miss a pair; tests measure recall against brute force
