"""op6: exact copies among all documents."""

from .common import read
from .exact import find_copies


def op6_exact_dedup(spark, sf_dir):
    return find_copies(read(spark, sf_dir, "documents"))


QUERIES = {"op6_exact_dedup": op6_exact_dedup}
ORACLES = {
    "op6_exact_dedup": r"""
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), k AS (
  SELECT doc_id, norm, count(*) OVER (PARTITION BY norm) AS group_size,
    first_value(doc_id) OVER (PARTITION BY norm ORDER BY length(t) DESC, doc_id) AS keep_id
  FROM n
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM k
"""
}
