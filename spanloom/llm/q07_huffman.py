"""op7: all documents' token ids, written in the Huffman file format and digested from the files."""

import public_tokenizers

from . import huffman
from .common import read

DIGEST = "doc_id long, start long, n_tokens long, ids_crc32 long"


def op7_huffman_ids(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    book, segments = huffman.store_documents(
        docs, public_tokenizers.path("word_bpe_49k.json"), keeps_space=False, end_id=2
    )
    return huffman.read_documents(book, segments, huffman.crc_digest, DIGEST)


QUERIES = {"op7_huffman_ids": op7_huffman_ids}
ORACLES: dict[str, str] = {}  # tokenising isn't SQL; tests compare with the tokenizers library and check the round trip
