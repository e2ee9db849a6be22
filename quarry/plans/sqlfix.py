"""DuckDB SQL definitions of the derived fixtures (see quarry.sources.fixtures).

Used only to build the oracle SQL strings; each is a CTE body.  They must
stay semantically identical to the Spark definitions.
"""

PV_GRID = """
pv_grid AS (
  WITH ev AS (SELECT event_type AS series, CAST(floor(epoch(ts)) AS BIGINT) AS e, value FROM events),
  b AS (SELECT series, (min(e) // 86400) * 86400 AS lo, (max(e) // 86400) * 86400 + 86400 - 900 AS hi
        FROM ev GROUP BY series),
  g AS (SELECT series, lo, hi, unnest(range(lo, hi + 900, 900)) AS t FROM b),
  a AS (SELECT series, (e // 900) * 900 AS t, avg(value) AS p, sum(value) AS s FROM ev GROUP BY ALL)
  SELECT g.series, g.t, (g.t - g.lo) // 900 AS slot, (g.hi - g.lo) // 900 + 1 AS n, g.t // 86400 AS day, g.t % 86400 AS tod,
         CASE WHEN ((g.t - g.lo) // 900) % 11 < 2 OR (g.series = 'error' AND (g.t % 86400) // 3600 = 3)
              THEN NULL ELSE a.p END AS power,
         coalesce(a.s, 0.0) AS generation
  FROM g LEFT JOIN a USING (series, t))"""

LAB = """
lab AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rid,
         l_returnflag AS grp,
         CASE WHEN (l_orderkey * 7 + l_linenumber) % 100 < 12 THEN NULL ELSE CAST(l_quantity AS DOUBLE) END AS quantity,
         CASE WHEN (l_orderkey * 7 + l_linenumber) % 100 < 45 THEN NULL ELSE CAST(l_extendedprice AS DOUBLE) END AS price,
         CASE WHEN (l_orderkey * 7 + l_linenumber) % 100 < 70 THEN NULL ELSE CAST(l_discount AS DOUBLE) END AS discount,
         CASE WHEN (l_orderkey * 7 + l_linenumber) % 100 < 90 THEN NULL ELSE CAST(l_tax AS DOUBLE) END AS tax,
         CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS DATE)) AS DOUBLE) AS ship_days
  FROM lineitem)"""

DEMO = """
demo AS (
  SELECT c_custkey AS code, c_mktsegment AS age_band,
         CASE WHEN c_acctbal >= 0 THEN 'Male' ELSE 'Female' END AS gender, c_acctbal AS balance
  FROM customer)"""

OUTCOME = """
outcome AS (
  SELECT o_orderkey AS oid, o_custkey AS code, CAST(o_orderstatus = 'P' AS INTEGER) AS deceased,
         o_totalprice AS total, o_orderpriority AS priority
  FROM orders)"""


def order_items(attr: str = "p_type") -> str:
    prefix = {"p_type": "type", "p_brand": "brand"}[attr]
    return f"""
order_items AS (
  WITH lines AS (SELECT l_orderkey AS oid, '{prefix}=' || {attr} AS item
                 FROM lineitem JOIN part ON l_partkey = p_partkey)
  SELECT DISTINCT oid, item FROM (
    SELECT oid, item FROM lines
    UNION ALL
    SELECT o_orderkey AS oid, 'status=' || o_orderstatus AS item FROM orders
    WHERE o_orderkey IN (SELECT oid FROM lines)))"""


SCORES = """
scores AS (
  SELECT l.doc_id, l.quality AS y, CAST(d.n_chars AS DOUBLE) AS score
  FROM labels l JOIN documents d ON l.doc_id = d.doc_id)"""

MIXED_TEXT = """
mixed_text AS (
  SELECT event_id,
         CASE WHEN event_id % 5 = 0 THEN NULL WHEN event_id % 5 = 1 THEN 'Negative'
              WHEN event_id % 5 = 2 THEN ' negative ' WHEN event_id % 5 = 3 THEN 'x'
              ELSE CAST(value AS VARCHAR) END AS troponin
  FROM events)"""

SCALE_ERRORS = """
scale_errors AS (
  SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS rid,
         CASE WHEN (l_orderkey * 31 + l_linenumber * 17 + l_partkey) % 1000 < 3
              THEN l_extendedprice * 1000 ELSE l_extendedprice END AS price,
         l_quantity AS quantity
  FROM lineitem)"""

ZVECTORS = """
u AS (SELECT vec_id, unnest(embedding)::DOUBLE AS x, unnest(range(1, len(embedding) + 1)) AS dim FROM embeddings),
st AS (SELECT dim, avg(x) AS m, stddev_pop(x) AS s FROM u GROUP BY dim),
z AS (SELECT vec_id, list(CASE WHEN s = 0 THEN 0.0 ELSE (x - m) / s END ORDER BY dim) AS v
      FROM u JOIN st USING (dim) GROUP BY vec_id)"""

# Text features of the labelled documents, and their stratified split.
DOC_FEATURES = r"""
doc_features AS (
  SELECT d.doc_id, l.quality AS y, d.n_chars::DOUBLE AS n_chars,
         len(string_split_regex(trim(text), '[ \t\n\x0B\f\r]+'))::DOUBLE AS n_words,
         len(string_split(text, chr(10)))::DOUBLE AS n_lines,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) / greatest(length(text), 1)::DOUBLE AS upper_share,
         length(regexp_replace(text, '[^0-9]', '', 'g')) / greatest(length(text), 1)::DOUBLE AS digit_share,
         length(regexp_replace(text, '[^[:punct:]]', '', 'g')) / greatest(length(text), 1)::DOUBLE AS punct_share,
         CASE lang WHEN 'en' THEN 0 WHEN 'de' THEN 1 WHEN 'fr' THEN 2 WHEN 'es' THEN 3 ELSE 4 END::DOUBLE AS lang_code
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"""
DOC_SPLIT = DOC_FEATURES + """,
doc_rank AS (SELECT *, count(*) OVER (PARTITION BY y) AS class_n,
                    row_number() OVER (PARTITION BY y ORDER BY ('0x' || md5(doc_id || ':42')[1:12])::BIGINT, doc_id) - 1
                        AS class_rank
             FROM doc_features),
doc_split AS (SELECT *, CASE WHEN class_rank < ceil(class_n * 0.2::DOUBLE) THEN 'test' ELSE 'train' END AS split
              FROM doc_rank)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n"
