"""DuckDB SQL for those queries on training data that SQL can express over whole tables.

The others (endings judged by a model, compression, word edits, personal information, mixing) are tested against brute force instead; the queries pN_holds
are what has to hold for results that the data don't fix, so SQL tells them without the operator.
"""

from __future__ import annotations

NAME = "nullif(regexp_replace(lower({c}), '[^\\p{{L}}\\p{{N}}]+', '', 'g'), '')"
LETTERS = "regexp_replace(lower(coalesce({c}, '')), '[^\\p{{L}}\\p{{M}}\\p{{N}}]+', '', 'g')"
WORDS = "list_filter(string_split_regex(regexp_replace(regexp_replace(lower(coalesce({c}, '')), '[\\x{{2012}}-\\x{{2015}}\\x{{2026}}/|]+', ' ', 'g'), '[^\\p{{L}}\\p{{M}}\\p{{N}}\\p{{Z}}\\s]+', '', 'g'), '[\\p{{Z}}\\s]+'), lambda w: w <> '')"


def _name(c: str) -> str:
    return NAME.format(c=c)


def _split(c: str) -> str:
    return f"CASE {_name(c)} WHEN 'training' THEN 'train' WHEN 'valid' THEN 'val' WHEN 'validation' THEN 'val' ELSE {_name(c)} END"


def _entity(c: str) -> str:
    n = _name(c)
    return f"CASE WHEN regexp_matches({n}, '^\\d+$') THEN coalesce(nullif(ltrim({n}, '0'), ''), '0') ELSE {n} END"


def _node(kind: str, c: str) -> str:
    file = f"regexp_extract(regexp_replace({c}, '[\\s/\\\\]+$', ''), '([^/\\\\]*)$', 1)"
    return f"({kind} || '/' || CASE WHEN {kind} = 'sorec' THEN {_entity(file)} ELSE {_entity(c)} END)"


GROUPS = f"""
r AS (SELECT sample_key, {_split('split')} AS part, {_name('dataset')} AS kind, CASE WHEN json_valid(metadata) THEN metadata END AS m FROM built_samples),
e AS (SELECT sample_key, part, kind, m, m ->> '$.derived_from' AS came,
       CASE kind WHEN 'd3' THEN m ->> '$.image_id' WHEN 'sorec' THEN m ->> '$.source_image' WHEN 'mevis' THEN m ->> '$.video_id' ELSE m ->> '$.sequence' END AS entity FROM r),
n AS (SELECT sample_key, part, {_node('kind', 'entity')} AS node, came, {_name("regexp_extract(came, '^([^/:]*)[/:]', 1)")} AS from_kind, regexp_extract(came, '^[^/:]*[/:](.*)$', 1) AS from_name FROM e),
l AS (SELECT DISTINCT node AS a, {_node('from_kind', 'from_name')} AS b FROM n WHERE node IS NOT NULL AND came IS NOT NULL),
b AS (SELECT a, b FROM l WHERE b IS NOT NULL UNION SELECT b, a FROM l WHERE b IS NOT NULL),
reach AS (SELECT a AS node, a AS other FROM b UNION SELECT reach.node, b.b FROM reach JOIN b ON reach.other = b.a),
roots AS (SELECT node, min(other) AS root FROM reach GROUP BY node),
g AS (SELECT n.sample_key, n.part, n.node, coalesce(roots.root, n.node) AS root FROM n LEFT JOIN roots USING (node) WHERE n.node IS NOT NULL)"""
COPIES = f"""
s AS (SELECT sample_key, from_json(row_json, '{{"messages":[{{"role":"VARCHAR","content":"VARCHAR"}}],"images":["VARCHAR"],"videos":[["VARCHAR"]]}}') AS r FROM built_samples WHERE row_json IS NOT NULL AND json_valid(row_json)),
k AS (
  SELECT 'built_samples' AS table_name, sample_key AS key,
    array_to_string(list_sort(list_transform(range(1, len(r.messages) + 1), lambda i: coalesce(r.messages[i].role, '') || ':' || printf('%06d', i) || ':' || {LETTERS.format(c='r.messages[i].content')})), '|') AS said, coalesce(r.images, [])::VARCHAR || coalesce(r.videos, [])::VARCHAR AS media
  FROM s
  UNION ALL
  SELECT 'template_records', record_id, {LETTERS.format(c='source_text')}, coalesce('=' || source_image, '') FROM template_records WHERE {LETTERS.format(c='source_text')} <> '')"""


def oracle_sql() -> dict[str, str]:
    return {
        "p3_found": f"WITH RECURSIVE {GROUPS} SELECT sample_key FROM g WHERE part IS NOT NULL AND root IN (SELECT root FROM g WHERE part IS NOT NULL GROUP BY root HAVING count(DISTINCT part) > 1)",
        "p5_found": f"""WITH b AS (SELECT {_name('dataset')} AS c FROM built_samples WHERE {_name('dataset')} IS NOT NULL), n AS (SELECT c, count(*) AS n FROM b GROUP BY c)
            SELECT t.dataset FROM sample_targets t LEFT JOIN n ON n.c = {_name('t.dataset')} WHERE coalesce(n.n, 0) < t.target_share * 0.2 * (SELECT count(*) FROM b) - 1e-9""",
        "p3_holds": "SELECT count(*) AS samples, count(*) AS assigned, 0 AS parted_groups, true AS near_targets FROM built_samples",
        "p5_holds": f"""WITH b AS (SELECT {_name('dataset')} AS c FROM built_samples WHERE {_name('dataset')} IS NOT NULL), n AS (SELECT c, count(*) AS n FROM b GROUP BY c)
            SELECT t.dataset, coalesce(n.n, 0) AS available, least(t.min_rows, coalesce(n.n, 0)) AS floor, coalesce(n.n, 0) >= t.target_share * 0.2 * (SELECT count(*) FROM b) - 1e-9 AS reachable,
              true AS drawn_once, true AS floor_kept, true AS goal_kept FROM sample_targets t LEFT JOIN n ON n.c = {_name('t.dataset')}""",
        "p9_holds": "SELECT source, max_repeats, true AS within_cap, true AS whole_blocks, true AS share_kept FROM mix_targets",
        "p10_holds": "SELECT doc_id, true AS kept FROM documents",
        "p6_found": f"WITH {COPIES}, w AS (SELECT table_name, key, min(key) OVER (PARTITION BY table_name, said, media) AS keep_key FROM k) SELECT table_name, keep_key, key AS copy_key FROM w WHERE key <> keep_key",
        "p6_collapsed": f"WITH {COPIES} SELECT table_name, min(key) AS keep_key, count(*) AS copies FROM k GROUP BY table_name, said, media",
        "p7_stable": f"""WITH b AS (SELECT sample_key, sample_id, coalesce(batch_no, -1) AS batch_no, {_name('sample_id')} AS id FROM built_samples),
            u AS (SELECT *, ('0x' || substr(sha1('stable-1:' || id), 1, 13))::BIGINT::DOUBLE / 4503599627370496.0 AS u FROM b WHERE id IS NOT NULL) SELECT sample_key, sample_id, batch_no, u FROM u WHERE u < 0.1""",
        "p8_found": f"""WITH d AS (SELECT doc_id, {WORDS.format(c='text')} AS w FROM documents), i AS (SELECT item_id, {WORDS.format(c='item_text')} AS w FROM benchmark_items),
            dg AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 8), lambda p: array_to_string(w[p:p + 9], ' '))) AS g FROM d WHERE len(w) >= 10),
            ig AS (SELECT item_id, unnest(list_transform(range(1, len(w) - 8), lambda p: array_to_string(w[p:p + 9], ' '))) AS g FROM i WHERE len(w) >= 10)
            SELECT DISTINCT doc_id, item_id FROM dg JOIN ig USING (g)""",
        "p8_report": f"""WITH d AS (SELECT doc_id, {WORDS.format(c='text')} AS w FROM documents), i AS (SELECT item_id, dataset, {WORDS.format(c='item_text')} AS w FROM benchmark_items),
            dg AS (SELECT doc_id, unnest(list_transform(range(1, len(w) - 8), lambda p: array_to_string(w[p:p + 9], ' '))) AS g FROM d WHERE len(w) >= 10),
            ig AS (SELECT item_id, dataset, unnest(list_transform(range(1, len(w) - 8), lambda p: array_to_string(w[p:p + 9], ' '))) AS g FROM i WHERE len(w) >= 10)
            SELECT item_id, dataset, count(DISTINCT doc_id) AS documents FROM dg JOIN ig USING (g) GROUP BY item_id, dataset""",
    }
