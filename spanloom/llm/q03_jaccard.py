"""op3: classes of documents whose 3-word shingle sets have a Jaccard similarity of 0.9 or more."""

from .common import read
from .jaccard import link_classes


def op3_ngram_jaccard(spark, sf_dir):
    return link_classes(read(spark, sf_dir, "documents"), size=3, percent=90)


QUERIES = {"op3_ngram_jaccard": op3_ngram_jaccard}
ORACLES: dict[str, str] = {}  # reachability over a quadratic join is too slow in SQL; tests compare with brute force
