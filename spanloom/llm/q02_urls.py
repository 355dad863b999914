"""op2: a verdict for every page's url."""

from .common import read
from .urls import judge

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def op2_url_filters(spark, sf_dir):
    return judge(read(spark, sf_dir, "pages"), RULES)


QUERIES = {"op2_url_filters": op2_url_filters}
#: The rules in SQL; pages that no rule fits are allowed, as the html of the test tables holds no alias links.
#: The query is tested on a table of pages with such links against a union-find and urllib.
ORACLES = {
    "op2_url_filters": r"""
WITH r(verdict, h, p) AS (
  VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')
), u AS (
  SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), s AS (
  SELECT page_id, lower(regexp_extract(rest, '^[^/?#]*')) AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), m AS (
  SELECT page_id, host, path, max_by(struct_pack(rule := h || p, verdict := r.verdict), length(h || p)) AS best
  FROM s LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  GROUP BY ALL
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM m
"""
}
