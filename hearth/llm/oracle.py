"""DuckDB SQL of the operators that SQL can express, over whole tables."""

from __future__ import annotations

from string import ascii_lowercase, ascii_uppercase

WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
LOWER = f"translate(coalesce(text, ''), '{ascii_uppercase}', '{ascii_lowercase}')"
#: ASCII bytes that are neither letters nor digits.
MARKS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]"


def shingles(name: str, table: str, key: str, text: str, k: int = 5) -> str:
    """CTE ``name(key, s)``: distinct runs of ``k`` words; a shorter text's whole sequence."""
    return f"""{name} AS (
  SELECT DISTINCT {key}, md5(array_to_string(w[i:i + {k - 1}], ' ')) AS s
  FROM (SELECT {key}, {WORDS.format(text)} AS w FROM {table}) t,
       unnest(range(1, CASE WHEN len(w) = 0 THEN 1 ELSE greatest(len(w) - {k - 2}, 2) END)) u(i))"""


ORACLE = {
    "op3_decontamination": f"""WITH
{shingles('d', 'documents', 'doc_id', f"regexp_replace({LOWER}, '{MARKS}', ' ', 'g')")},
{shingles('b', 'benchmark', 'item_id', f"regexp_replace({LOWER}, '{MARKS}', ' ', 'g')")},
n AS (SELECT item_id, count(*) AS n_item FROM b GROUP BY item_id)
SELECT doc_id, item_id, count(*) AS n_shared, any_value(n_item) AS n_item, count(*) / any_value(n_item) AS containment
FROM d JOIN b USING (s) JOIN n USING (item_id) GROUP BY doc_id, item_id HAVING count(*) >= 0.75 * any_value(n_item)""",
    "op5_substring_dedup": f"""WITH
t AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS h FROM t, unnest(range(1, greatest(len(w) - 48, 1))) u(i)),
early AS (SELECT h, min(doc_id) AS f FROM win GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p FROM win JOIN early USING (h) WHERE doc_id > f),
word AS (SELECT doc_id, p, w[p] AS x FROM t, unnest(range(1, len(w) + 1)) u(p)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS k, count(*) AS n
         FROM word LEFT JOIN gone g USING (doc_id, p) WHERE g.p IS NULL GROUP BY doc_id)
SELECT t.doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM t LEFT JOIN kept USING (doc_id)""",
    "op10_ngram_jaccard": f"""WITH RECURSIVE
{shingles('s', 'documents', 'doc_id', LOWER)},
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pair AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (SELECT a, b FROM pair JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
walk AS (SELECT doc_id AS a, doc_id AS c FROM documents UNION SELECT b, c FROM walk JOIN link USING (a))
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(c) AS component_id
FROM walk JOIN documents d ON d.doc_id = walk.a LEFT JOIN n USING (doc_id) GROUP BY doc_id""",
    "op11_filter_audit": f"""WITH
t AS (SELECT doc_id, coalesce(text, '') AS text, coalesce(source, '') AS part, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
f AS (SELECT part, concat(
        CASE WHEN len(w) < 50 THEN 'A' ELSE '' END, CASE WHEN 100 * len(list_distinct(w)) < 65 * len(w) THEN 'B' ELSE '' END,
        CASE WHEN 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) THEN 'C' ELSE '' END,
        CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 'D' ELSE '' END,
        CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY text) THEN 'E' ELSE '' END) AS fails,
      EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = t.doc_id AND quality = 1) AS good,
      EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = t.doc_id AND toxic = 1) AS toxic FROM t),
c AS (SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM f GROUP BY ALL),
l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e
      WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5),
s AS (SELECT filter_order, i::INTEGER AS step, filter_order[i] AS x FROM o, range(1, 6) r(i)),
g AS (SELECT c.*, filter_order, (SELECT min(instr(filter_order, x)) FROM l WHERE contains(fails, x)) AS gone FROM c, o),
r AS (SELECT part, filter_order, step, x, sum(CASE WHEN gone IS NULL OR gone > step THEN n ELSE 0 END) AS kept,
        sum(CASE WHEN gone = step THEN n ELSE 0 END) AS removed, sum(CASE WHEN gone < step AND contains(fails, x) THEN n ELSE 0 END) AS redundant,
        sum(CASE WHEN fails = x THEN n ELSE 0 END) AS unique_fails, sum(CASE WHEN gone = step THEN good ELSE 0 END) AS good_lost,
        sum(CASE WHEN gone = step THEN toxic ELSE 0 END) AS toxic_lost
      FROM g JOIN s USING (filter_order) GROUP BY ALL)
SELECT part, filter_order, step, kept::BIGINT AS kept, removed::BIGINT AS removed, redundant::BIGINT AS redundant, unique_fails::BIGINT AS unique_fails,
  good_lost::BIGINT AS good_lost, toxic_lost::BIGINT AS toxic_lost, (sum(removed) OVER (PARTITION BY part, x))::BIGINT AS shapley FROM r""",
    "op13_topk_search": """WITH
v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS w FROM embeddings
      WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
e AS (SELECT vec_id, generate_subscripts(w, 1) AS t, unnest(w) AS x FROM v),
s AS (SELECT q.vec_id AS query_id, d.vec_id, sum(q.x * d.x)::BIGINT AS score
      FROM e q JOIN e d ON q.t = d.t AND q.vec_id <> d.vec_id WHERE q.vec_id % 50 = 0 GROUP BY 1, 2)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5""",
}
