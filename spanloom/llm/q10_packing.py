"""op10: all documents packed in sequences of at most 2048 tokens."""

import public_tokenizers

from .common import read
from .packing import pack_documents

CAPACITY, END_ID = 2048, 0


def op10_best_fit_packing(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), END_ID, CAPACITY)


QUERIES = {"op10_best_fit_packing": op10_best_fit_packing}
ORACLES: dict[str, str] = {}  # tokenising isn't SQL; tests check the packing against a brute-force optimum
