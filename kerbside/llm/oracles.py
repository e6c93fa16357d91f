"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

# Each document's lines, cut where the rolling hash of two line hashes is a multiple of 3; chunks of
# two lines or more that occur more than once stay only at their first place.
OP1 = """
WITH lines AS (
    SELECT doc_id, text, generate_subscripts(string_split(text, chr(10)), 1) AS i,
           unnest(string_split(text, chr(10))) AS line
    FROM documents
), hashed AS (
    SELECT doc_id, i, line, CAST('0x' || substr(md5(line), 1, 8) AS BIGINT) AS h FROM lines
), flagged AS (
    SELECT *, (h * 1000003 + coalesce(lag(h) OVER (PARTITION BY doc_id ORDER BY i), 0) * 8191)
              % 2147483647 % 3 = 0 AS cut
    FROM hashed
), placed AS (
    SELECT *, coalesce(sum(cut::INT) OVER (
        PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS place
    FROM flagged
), chunks AS (
    SELECT doc_id, place, string_agg(line, chr(10) ORDER BY i) AS chunk, count(*) AS n
    FROM placed GROUP BY doc_id, place
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY chunk, n > 1 ORDER BY doc_id, place) AS r FROM chunks
)
SELECT doc_id,
       coalesce(string_agg(chunk, chr(10) ORDER BY place) FILTER (n = 1 OR r = 1), '') AS text,
       CAST(sum(n) AS BIGINT) AS n_lines,
       CAST(coalesce(sum(n) FILTER (n > 1 AND r > 1), 0) AS BIGINT) AS n_removed
FROM ranked GROUP BY doc_id
"""

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_WORDS = (
    f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), "
    r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

# All runs of 10 document words (and of the lengths of shorter items) against those of the items.
OP10 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
item_windows AS (
    SELECT DISTINCT item, w[s:s + least(10, len(w)) - 1] AS run
    FROM (SELECT item, w, unnest(generate_series(1, greatest(len(w) - 9, 1))) AS s FROM b WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT len(run) AS n FROM item_windows),
runs AS (
    SELECT doc_id, s, n, w[s:s + n - 1] AS run
    FROM (SELECT doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) AS s
          FROM d, sizes WHERE len(w) >= n)
), hits AS (SELECT doc_id, s, n, item FROM runs JOIN item_windows USING (run)),
hit_words AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM hits) GROUP BY doc_id
), hit_items AS (
    SELECT doc_id, count(DISTINCT item) AS n_items,
           sha256(array_to_string(list_sort(list(DISTINCT item)), ',')) AS items_sha256
    FROM hits GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

ORACLES = {"op1_line_dedup": OP1, "op10_decontamination": OP10}
