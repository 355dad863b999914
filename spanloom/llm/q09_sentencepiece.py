"""op9: all documents encoded and decoded by the SentencePiece model on the tokenizers library, parity verified."""

import public_tokenizers

from .common import read
from .spm import verify_documents


def op9_sentencepiece(spark, sf_dir):
    return verify_documents(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


QUERIES = {"op9_sentencepiece": op9_sentencepiece}
ORACLES: dict[str, str] = {}  # tokenising isn't SQL; every row holds its own comparison with the sentencepiece library
