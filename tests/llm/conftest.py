import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from texts; ids count from 0 unless rows are (id, text)."""

    def make(texts, extra=None):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        rows = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(rows, DOCS)
        for name in extra or ():
            from pyspark.sql import functions as F

            df = df.withColumn(name, F.lit("x"))
        return df

    return make


#: Column names that operators use inside.
CLASHES = ("score", "statistics", "n", "rank", "print", "node", "root", "length", "norm", "rid", "class", "a.b")


def sentencepiece_model(pieces, kind, byte_fallback, charsmap=b"", prefix=True, squeeze=True, suffix=False):
    """The bytes of a SentencePiece model file put together by hand; pieces are (piece, score, type)."""
    import struct

    def number(n):
        out = b""
        while True:
            n, low = n >> 7, n & 127
            out += bytes([low | (128 if n else 0)])
            if not n:
                return out

    def entry(key, value):
        if isinstance(value, int):
            return number(key << 3) + number(value)
        if isinstance(value, float):
            return number(key << 3 | 5) + struct.pack("<f", value)
        value = value.encode() if isinstance(value, str) else value
        return number(key << 3 | 2) + number(len(value)) + value

    out = b"".join(entry(1, entry(1, p) + entry(2, float(s)) + entry(3, k)) for p, s, k in pieces)
    out += entry(2, entry(3, kind) + entry(24, int(suffix)) + entry(35, int(byte_fallback)))
    rules = entry(1, "identity") + (entry(2, charsmap) if charsmap else b"")
    return out + entry(3, rules + entry(3, int(prefix)) + entry(4, int(squeeze)) + entry(5, 1))
