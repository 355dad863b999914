"""op12: a mix of all documents to weights of their sources."""

from . import mixing
from .common import read


def op12_mixing(spark, sf_dir):
    made = mixing.mix(read(spark, sf_dir, "documents"))
    return made.select("doc_id", "size", "source_size", "target", mixing.words_taken(made["spans"]).alias("taken"))


def _apportion(name: str, units: str, within: str, seats: str, weight: str, most: str, order: str) -> str:
    """CTEs that add quota to the rows of units, as mixing.apportion does."""
    over, rank = (f"PARTITION BY {within}", f"PARTITION BY {within} ") if within else ("", "")
    return f"""{name}_f AS (SELECT *, row_number() OVER () AS unit, sum({weight}) OVER ({over}) AS all_weight, count(*) OVER ({over}) AS n FROM {units}),
{name}_s AS (SELECT *, CASE WHEN all_weight > 0 THEN {weight}::DOUBLE / all_weight ELSE 0 END AS share FROM {name}_f),
{name}_l AS (SELECT *, least(floor(share * greatest({seats} - n, 0) + 0.5), {most})::BIGINT AS low,
  least(floor(share * ({seats} + 2 * n) + 0.5), {most})::BIGINT AS high FROM {name}_s),
{name}_o AS (SELECT *, {seats} - sum(low) OVER ({over}) AS open_seats FROM {name}_l),
{name}_k AS (SELECT *, unnest(generate_series(low + 1, high)) AS k FROM {name}_o),
{name}_r AS (SELECT *, row_number() OVER ({rank}ORDER BY {weight}::DOUBLE / (2 * k - 1) DESC, {order}, k) AS claim FROM {name}_k),
{name}_w AS (SELECT unit, count(*) AS won FROM {name}_r WHERE claim <= open_seats GROUP BY 1),
{name} AS (SELECT * EXCLUDE (unit, n, all_weight, share, low, high, open_seats, won), low + coalesce(won, 0) AS quota FROM {name}_o LEFT JOIN {name}_w USING (unit))"""


QUERIES = {"op12_mixing": op12_mixing}
ORACLES = {
    "op12_mixing": rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    md5('{mixing.SEED}:' || coalesce(doc_id::VARCHAR, '-' || coalesce(text, ''))) AS seeded FROM documents
), s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY 1), w AS (
  SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight, source_size * 2 AS lim,
    (sum(source_size) OVER () * 150)::DOUBLE / 100 AS total FROM s
), p AS (
  SELECT *, row_number() OVER level_order AS place,
    coalesce(sum(lim) OVER (level_order ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE AS filled,
    sum(weight) OVER (level_order ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS weight_left
  FROM w WINDOW level_order AS (ORDER BY lim::DOUBLE / weight, source NULLS LAST)
), o AS (SELECT min(place) AS open_place FROM p WHERE lim * weight_left > (total - filled) * weight), t AS (
  SELECT p.source, p.source_size, (CASE WHEN p.place >= open_place THEN (p.total - l.filled) * p.weight / l.weight_left ELSE p.lim END)::DOUBLE AS target,
    greatest(ceil(p.source_size / greatest({mixing.SHARD_WORDS}, ceil(sum(p.source_size) OVER () / {mixing.MOST_SHARDS}.0))), 1)::BIGINT AS shards,
    round(p.total / {mixing.BLOCK_WORDS})::BIGINT AS all_seats
  FROM p CROSS JOIN o LEFT JOIN p l ON l.place = open_place
), e AS (
  SELECT d.*, t.source_size, ('0x' || substr(seeded, 1, 8))::BIGINT % t.shards AS shard FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), h AS (SELECT source, shard, sum(size)::BIGINT AS words, ceil(sum(size) / {mixing.BLOCK_WORDS}.0)::BIGINT AS blocks FROM e GROUP BY 1, 2),
named AS (SELECT t.*, (SELECT sum(blocks) * 2 FROM h WHERE h.source IS NOT DISTINCT FROM t.source)::BIGINT AS most FROM t),
{_apportion("a", "named", "", "all_seats", "target", "most", "source NULLS LAST")},
units AS (SELECT h.*, a.source_size, a.target, a.quota AS source_quota FROM h JOIN a ON h.source IS NOT DISTINCT FROM a.source),
{_apportion("b", "units", "source", "source_quota", "words", "(blocks * 2)", "shard")},
q AS (
  SELECT *, CASE WHEN blocks > 0 THEN quota // blocks ELSE 0 END AS again, CASE WHEN blocks > 0 THEN quota % blocks ELSE 0 END AS more,
    CASE WHEN blocks > 0 THEN ('0x' || substr(md5('{mixing.SEED}:' || coalesce(source, '') || ':' || shard), 1, 8))::BIGINT % blocks ELSE 0 END AS start FROM b
), x AS (
  SELECT e.*, sum(size) OVER (PARTITION BY source, shard ORDER BY seeded, doc_id NULLS FIRST, size ROWS UNBOUNDED PRECEDING)::BIGINT AS stop FROM e
), y AS (
  SELECT x.doc_id, x.size, q.source_size, q.target, again, more, blocks, start, unnest([x.stop - x.size, x.stop]) AS spot, unnest([-1, 1]) AS sign,
    row_number() OVER () AS id
  FROM x JOIN q ON x.source IS NOT DISTINCT FROM q.source AND x.shard = q.shard
), z AS (
  SELECT *, ((spot // {mixing.BLOCK_WORDS}) * more + start) // greatest(blocks, 1) AS full_blocks,
    ((spot // {mixing.BLOCK_WORDS} + 1) * more + start) // greatest(blocks, 1) - ((spot // {mixing.BLOCK_WORDS}) * more + start) // greatest(blocks, 1) AS here FROM y
)
SELECT doc_id, size, any_value(source_size) AS source_size, any_value(target) AS target,
  (CASE WHEN size = 0 THEN 0 ELSE any_value(again) * size + sum(sign * (full_blocks * {mixing.BLOCK_WORDS} + spot % {mixing.BLOCK_WORDS} * here)) END)::BIGINT AS taken
FROM z GROUP BY id, doc_id, size
"""
}
