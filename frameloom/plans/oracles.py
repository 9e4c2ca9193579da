"""DuckDB SQL for the queries of the catalogue. Queries without SQL are checked by tests instead."""

from __future__ import annotations


def _fraction(value: str, seed: int = 42) -> str:
    return f"(('0x' || substr(sha1('{seed}:' || {value}::VARCHAR), 1, 16))::UBIGINT::DOUBLE / 18446744073709551616.0)"


def _part(value: str, ratio: float = 0.1) -> str:
    return f"CASE WHEN {_fraction(value)} < {ratio} THEN 'val' ELSE 'train' END"


def _key(seed: int, *values: str) -> str:
    return f"sha1(concat_ws(':', '{seed}', {', '.join(f'{v}::VARCHAR' for v in values)}))"


def _even(n: str, count: int, items: str) -> str:
    """count items spread evenly over the first n of a list."""
    spread = f"list_transform(range({count}), lambda i: {items}[round_even(i * ({n} - 1) / {max(1, count - 1)}.0, 0)::INTEGER + 1])"
    return f"CASE WHEN {n} <= {count} THEN {items}[1:{n}] ELSE {spread} END"


def _bundle(path: str) -> str:
    base = f"regexp_replace(regexp_extract({path}, '([^/]*)$', 1), '[^\\p{{L}}\\p{{N}}._-]', '_', 'g')"
    return f"('media/files/' || substr(sha256({path}), 1, 2) || '/' || substr(sha256({path}), 1, 20) || '_' || right({base}, 120))"


SAMPLES = """s AS (
  SELECT sample_key, dataset, sample_id, split, batch_no,
         from_json(row_json, '{"messages":[{"role":"VARCHAR","content":"VARCHAR"}],"images":["VARCHAR"],"videos":[["VARCHAR"]]}') AS r
  FROM built_samples WHERE row_json IS NOT NULL AND json_valid(row_json)),
t AS (SELECT sample_key, dataset, sample_id, split, batch_no, r.messages AS messages, r.images AS images, r.videos AS videos FROM s)"""
REFS = """refs AS (
  SELECT sample_key, 'images' AS field, unnest(images) AS path FROM t
  UNION ALL SELECT sample_key, 'videos' AS field, unnest(flatten(videos)) AS path FROM t)"""
FRAMES = "f AS (SELECT user_id, list(event_id ORDER BY event_id) AS frames FROM events GROUP BY user_id)"
MANIFEST = f"""m AS (
  SELECT path AS source_path, {_bundle('path')} AS bundle_path, count(*) AS reference_count FROM refs WHERE path IS NOT NULL GROUP BY path),
z AS (SELECT source_path, max(size_bytes) AS size_bytes FROM media_manifest GROUP BY source_path),
e AS (SELECT m.source_path, m.bundle_path, z.size_bytes, m.reference_count FROM m LEFT JOIN z USING (source_path))"""
WORDS = "len(regexp_extract_all({t}, '[A-Za-z]+(?:[''-][A-Za-z]+)?'))"
SENTENCES = "CASE WHEN {t} = '' THEN 0 ELSE greatest(1, len(list_filter(string_split_regex({t}, '[.!?]+(?:[\\s\\p{{Z}}\\x{{1c}}-\\x{{1f}}\\x{{85}}]+|$)'), lambda p: regexp_matches(p, '[^\\s\\p{{Z}}]')))) END"
STRIPPED = "regexp_replace(coalesce({t}, ''), '^[\\s\\p{{Z}}\\x{{1c}}-\\x{{1f}}\\x{{85}}]+|[\\s\\p{{Z}}\\x{{1c}}-\\x{{1f}}\\x{{85}}]+$', '', 'g')"
FORBIDDEN = " OR ".join(
    f"regexp_matches({{t}}, '(?i){p}')"
    for p in (
        r"\bbbox\b",
        r"\bbounding boxes?\b",
        r"\bcoordinates?\b",
        r"\bmasks?\b",
        r"\btrack[_ ]?ids?\b",
        r"\(\s*-?\d+(?:\.\d+)?\s*,\s*-?\d+(?:\.\d+)?(?:\s*,\s*-?\d+(?:\.\d+)?\s*,\s*-?\d+(?:\.\d+)?)?\s*\)",
    )
)


def _reasons(t: str) -> str:
    tests = (
        (f"{t} = ''", "empty"),
        (f"{WORDS.format(t=t)} > 80", "too_long"),
        (f"{SENTENCES.format(t=t)} > 2", "too_many_sentences"),
        (f"regexp_matches({t}, '[\\x{{3400}}-\\x{{9fff}}]')", "non_english"),
        (f"starts_with({t}, '{{') OR starts_with({t}, '[')", "json_like"),
        (FORBIDDEN.format(t=t), "forbidden_annotation_output"),
    )
    return "concat_ws(',', " + ", ".join(f"CASE WHEN {test} THEN '{name}' END" for test, name in tests) + ")"


def _by_group(select: str, group: str, order: str, k: str) -> str:
    return f"SELECT * FROM (SELECT {select}, row_number() OVER (PARTITION BY {group} ORDER BY {order}) AS rank FROM rows) WHERE rank <= {k}"


URGENT = "SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'"
TURNS = f"row_number() OVER (PARTITION BY source ORDER BY {_key(79, 'source', 'doc_id')}, doc_id)"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["hash_split"] = f"SELECT lang, {_part('doc_id')} AS part, count(*) AS n FROM documents GROUP BY ALL"
    q["hash_fractions"] = f"SELECT o_orderkey, round({_fraction('o_orderkey')}, 12) AS fraction, ('0x' || substr(sha1(o_orderkey::VARCHAR), 1, 8))::BIGINT AS seed FROM orders"
    q["group_split_leakage"] = f"SELECT user_id, count(DISTINCT part) AS parts, min(part) AS part, count(*) AS n FROM (SELECT user_id, {_part('user_id')} AS part FROM events) GROUP BY user_id"
    q["distinct_pairs"] = "SELECT DISTINCT user_id, event_type FROM events"
    q["annotation_join"] = "SELECT p_brand, s_nationkey, count(*) AS pairs FROM (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem) JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey GROUP BY ALL"
    q["seeded_topk"] = "WITH rows AS (SELECT source, doc_id FROM documents) " + _by_group("source, doc_id", "source", f"{_key(42, 'doc_id')}, doc_id", "5")
    q["quota_by_source"] = "WITH rows AS (SELECT event_type, event_id FROM events WHERE event_type IN ('click', 'view', 'purchase', 'error')) " + _by_group(
        "event_type, event_id", "event_type", f"{_key(53, 'event_id')}, event_id", "CASE event_type WHEN 'click' THEN 40 WHEN 'view' THEN 30 WHEN 'purchase' THEN 20 ELSE 10 END"
    )
    q["limit_then_filter"] = f"SELECT * FROM (SELECT c_custkey, row_number() OVER (ORDER BY {_key(7, 'c_custkey')}, c_custkey) AS rank FROM customer) WHERE rank <= 200 AND c_custkey IN ({URGENT})"
    q["filter_after_rank"] = f"SELECT * FROM (SELECT c_custkey, row_number() OVER (ORDER BY {_key(7, 'c_custkey')}, c_custkey) AS rank FROM customer WHERE c_custkey IN ({URGENT})) WHERE rank <= 200"
    q["unique_first_topk"] = f"""WITH a AS (SELECT event_id, user_id, {_key(42, 'event_id')} AS h FROM events),
      b AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY h, event_id) > 1 AS again FROM a)
      SELECT event_id, user_id, rank FROM (SELECT *, row_number() OVER (ORDER BY again, h, event_id) AS rank FROM b) WHERE rank <= 400"""
    for name, keep in (("round_robin", ""), ("round_robin_kept", "WHERE n_chars > 800")):
        q[name] = f"""WITH a AS (SELECT coalesce(source, '') AS source, doc_id, n_chars FROM documents), b AS (SELECT *, {TURNS} AS depth FROM a)
          SELECT source, doc_id, depth, rank FROM (SELECT *, row_number() OVER (ORDER BY depth, {_key(79, 'source')}, source) AS rank FROM b {keep}) WHERE rank <= 100"""
    q["even_sample"] = f"WITH {FRAMES} SELECT user_id, array_to_string({_even('len(frames)', 6, 'frames')}, ',') AS chosen FROM f"
    q["prefix_groups"] = f"""WITH {FRAMES},
      c AS (SELECT * FROM (VALUES (0, 'wide', 0.15), (1, 'long', 0.5), (2, 'full', 1.0)) v(position, scale, ratio)),
      g AS (SELECT user_id, scale, position, frames, least(len(frames) - 1, greatest(4, round_even((len(frames) - 1) * ratio, 0)::INTEGER)) AS endpoint FROM f, c),
      h AS (SELECT *, array_to_string({_even('(endpoint + 1)', 5, 'frames')}, ',') AS chosen FROM g)
      SELECT user_id, scale, 0 AS variant, endpoint, chosen FROM h QUALIFY row_number() OVER (PARTITION BY user_id, chosen ORDER BY position) = 1"""
    tries = "range(-1, CASE WHEN len(frames) <= 6 THEN 0 ELSE 30 END)"
    span = "CASE WHEN i < 0 THEN len(frames) ELSE least([24, 48, 96, 192][i % 4 + 1], len(frames)) END"
    start = "CASE WHEN i < 0 THEN 0 ELSE ('0x' || substr(sha1('83:' || user_id || ':' || i), 1, 8))::BIGINT % (len(frames) - span + 1) END"
    q["window_variants"] = f"""WITH {FRAMES}, a AS (SELECT user_id, frames, unnest({tries}) AS i FROM f), b AS (SELECT *, {span} AS span FROM a), c AS (SELECT *, {start} AS start FROM b),
      d AS (SELECT user_id, i, array_to_string({_even('span', 6, 'frames[start + 1:start + span]')}, ',') AS chosen FROM c),
      e AS (SELECT user_id, chosen, min(i) AS i FROM d GROUP BY user_id, chosen)
      SELECT user_id, variant, chosen FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY i) - 1 AS variant FROM e) WHERE variant < 3"""
    q["active_keys"] = "SELECT event_id, concat_ws(',', '900', CASE WHEN value > 20 THEN (user_id + 1000)::VARCHAR END) AS keys FROM events WHERE event_type <> 'click' UNION ALL SELECT event_id, concat_ws(',', '7', '900', CASE WHEN value > 20 THEN (user_id + 1000)::VARCHAR END) FROM events WHERE event_type = 'click'"
    q["unnest_map"] = "SELECT name, count(*) AS n, sum(json_extract(props, '$.' || name)::BIGINT)::BIGINT AS total FROM (SELECT props, unnest(json_keys(props)) AS name FROM events) GROUP BY name"
    q["bbox_parse"] = """WITH b AS (SELECT l_linenumber,
        CASE WHEN l_linenumber % 2 = 0 THEN [l_quantity, l_tax, l_quantity, l_discount]
             ELSE [least(l_tax, l_quantity), least(l_discount, l_quantity), greatest(l_tax, l_quantity) - least(l_tax, l_quantity), greatest(l_discount, l_quantity) - least(l_discount, l_quantity)] END AS v FROM lineitem),
      g AS (SELECT l_linenumber, CASE WHEN v[3] > 0 AND v[4] > 0 THEN v END AS v FROM b)
      SELECT l_linenumber, count(v) AS boxes, count(*) - count(v) AS faulty, round(sum(v[1]), 3) AS x, round(sum(v[2]), 3) AS y, round(sum(v[3]), 3) AS w, round(sum(v[4]), 3) AS h FROM g GROUP BY l_linenumber"""
    q["square_crop"] = """WITH b AS (SELECT record_id, bbox_xywh AS b, context_scale, original_size[1]::DOUBLE AS iw, original_size[2]::DOUBLE AS ih FROM template_records
        WHERE bbox_xywh IS NOT NULL AND original_size IS NOT NULL AND len(bbox_xywh) = 4 AND context_scale IS NOT NULL),
      c AS (SELECT *, greatest(2.0, least(greatest(b[3], b[4]) * context_scale, iw, ih)) AS side FROM b),
      d AS (SELECT *, greatest(0.0, least(b[1] + b[3] / 2 - side / 2, iw - side)) AS l, greatest(0.0, least(b[2] + b[4] / 2 - side / 2, ih - side)) AS t FROM c)
      SELECT record_id, greatest(0, floor(l))::INTEGER AS crop_left, greatest(0, floor(t))::INTEGER AS crop_top, least(iw, ceil(l + side))::INTEGER AS crop_right, least(ih, ceil(t + side))::INTEGER AS crop_bottom FROM d"""
    q["template_ids"] = """SELECT record_id, 'sorec_' || printf('%06d', source_index) || '_' || substr(sha1(source_index::VARCHAR || ':' || source_image || ':(' || array_to_string(bbox_xywh, ', ') || ')'), 1, 10) AS template_id
      FROM template_records WHERE bbox_xywh IS NOT NULL AND len(bbox_xywh) = 4 AND source_index IS NOT NULL AND source_image IS NOT NULL"""
    q["natural_sort"] = """WITH n AS (SELECT p_partkey, p_type, p_brand || ' x' || p_size::VARCHAR || ' ' || p_name AS name, regexp_extract(p_brand, '(\\d+)', 1)::INTEGER AS b, p_size, lower(p_name) AS low FROM part)
      SELECT p_partkey, row_number() OVER (PARTITION BY p_type ORDER BY b, p_size, low, name, p_partkey) AS place FROM n"""
    q["path_parts"] = """WITH p AS (SELECT record_id, source_image AS p, regexp_extract(source_image, '([^/]*)$', 1) AS name, string_split(source_image, '/') AS parts FROM template_records WHERE source_image IS NOT NULL),
      r AS (SELECT *, regexp_replace(name, '(.)\\.[^.]*$', '\\1') AS stem FROM p)
      SELECT record_id, stem, CASE WHEN len(parts) > 1 THEN parts[len(parts) - 1] ELSE p END AS parent, lower(regexp_extract(name, '.(\\.[^.]+)$', 1)) AS suffix, regexp_replace(stem, '_[^_]*$', '') AS base,
        CASE WHEN starts_with(p, 'sorec/') THEN substr(p, 7) ELSE p END AS relative, list_contains(parts, 'Images') AS held FROM r"""
    q["frame_names"] = "SELECT o_orderkey, printf('%06d', o_orderkey * 97) || '.png' AS frame FROM orders"
    from ..operators.assemble import PROMPTS

    q["build_messages"] = f"""SELECT record_id, 'system,user,assistant' AS roles, CASE source WHEN 'sorec' THEN '{PROMPTS['sorec'][1]}' ELSE '{PROMPTS['tnl2k'][1]}' END AS request,
      {STRIPPED.format(t='source_text')} AS answer, 2 AS image_count, TRUE AS no_video FROM template_records WHERE source IN ('sorec', 'tnl2k') AND source_text IS NOT NULL"""
    q["sample_metadata"] = "SELECT record_id, sample_id, source_index, sequence_name AS sequence FROM template_records WHERE source = 'sorec'"
    q["union_counts"] = "WITH u AS (SELECT coalesce(dataset, 'none') AS dataset FROM built_samples UNION ALL SELECT coalesce(source, 'none') FROM template_records) SELECT dataset, count(*) AS samples FROM u GROUP BY dataset UNION ALL SELECT 'all', count(*) FROM u"
    q["global_order"] = f"SELECT doc_id, row_number() OVER (ORDER BY {_key(143, 'doc_id')}, doc_id) - 1 AS ordinal FROM documents"
    q["role_validation"] = f"WITH {SAMPLES}, g AS (SELECT array_to_string(list_transform(messages, lambda m: m.role), ',') AS roles, count(*) AS n FROM t GROUP BY 1) SELECT roles, n, roles IN ('system,user,assistant', 'user,assistant') AS valid FROM g"
    user = "array_to_string(list_transform(list_filter(messages, lambda m: m.role = 'user'), lambda m: m.content), '')"
    q["placeholder_check"] = f"WITH {SAMPLES} SELECT sample_key, len(regexp_extract_all({user}, '<image>')) AS image_marks, coalesce(len(images), 0) AS images, len(regexp_extract_all({user}, '<video>')) AS video_marks, coalesce(len(videos), 0) AS videos FROM t"
    q["check_report_of_broken_rows"] = f"""WITH {SAMPLES}, u AS (SELECT *, {user} AS said, coalesce(trim(dataset), 'none') AS file FROM t),
      e AS (SELECT file, CASE WHEN sample_key % 17 = 0 THEN NULL ELSE images END AS images, videos, sample_key,
        CASE WHEN sample_key % 11 = 0 THEN 1 WHEN sample_key % 13 = 0 THEN 1 ELSE 0 END +
        CASE WHEN sample_key % 11 <> 0 AND sample_key % 13 = 0 THEN 0 WHEN sample_key % 17 = 0 AND len(regexp_extract_all(said, '<image>')) > 0 THEN 1 WHEN len(regexp_extract_all(said, '<image>')) <> coalesce(len(images), 0) AND sample_key % 17 <> 0 THEN 1
             WHEN len(regexp_extract_all(said, '<video>')) <> coalesce(len(videos), 0) THEN 1 ELSE 0 END AS bad FROM u)
      SELECT file, count(*) AS rows, count(images) AS image_rows, count(videos) AS video_rows, count(*) FILTER (bad > 0) AS error_rows, least(5, count(*) FILTER (bad > 0)) AS listed FROM e GROUP BY file"""
    q["check_errors"] = f"""WITH {SAMPLES}, u AS (SELECT *, {user} AS said, array_to_string(list_transform(list_filter(messages, lambda m: m.role = 'assistant'), lambda m: coalesce(m.content, '')), '') AS answer,
        array_to_string(list_transform(messages, lambda m: m.role), ',') AS roles FROM t),
      miss AS (SELECT sample_key, count(*) AS n FROM (SELECT sample_key, unnest(list_concat(coalesce(images, []), coalesce(flatten(videos), []))) AS path FROM t) WHERE path NOT IN (SELECT source_path FROM media_manifest WHERE source_path IS NOT NULL) GROUP BY sample_key),
      e AS (SELECT u.sample_key, coalesce(miss.n, 0) + (len(regexp_extract_all(said, '<image>')) <> coalesce(len(images), 0))::INTEGER + (len(regexp_extract_all(said, '<video>')) <> coalesce(len(videos), 0))::INTEGER
        + ({STRIPPED.format(t='answer')} = '')::INTEGER + (roles NOT IN ('system,user,assistant', 'user,assistant'))::INTEGER AS errors FROM u LEFT JOIN miss USING (sample_key))
      SELECT sample_key, errors FROM e WHERE errors > 0"""
    q["format_check"] = f"WITH p AS (SELECT eval_id, {STRIPPED.format(t='prediction')} AS t FROM eval_records), r AS (SELECT eval_id, {_reasons('t')} AS reasons FROM p) SELECT eval_id, reasons = '' AS format_success, reasons FROM r"
    q["format_measures"] = f"WITH p AS (SELECT doc_id, coalesce(text, '') AS raw, {STRIPPED.format(t='text')} AS t FROM documents) SELECT doc_id, {WORDS.format(t='raw')} AS words, {SENTENCES.format(t='t')} AS sentences, regexp_matches(raw, '[\\x{{3400}}-\\x{{9fff}}]') AS cjk FROM p"
    q["format_summary"] = f"""WITH p AS (SELECT model_name, bertscore_p, bertscore_r, bertscore_f1, {STRIPPED.format(t='prediction')} AS t FROM eval_records), r AS (SELECT *, {_reasons('t')} = '' AS ok FROM p)
      SELECT model_name, count(*) AS num_samples, round(avg(bertscore_p), 6) AS p, round(avg(bertscore_r), 6) AS r, round(avg(bertscore_f1), 6) AS f1, round(avg(ok::INTEGER), 6) AS rate,
        count(*) FILTER (ok) AS format_success_count, count(*) FILTER (NOT ok) AS format_failure_count FROM r GROUP BY model_name"""
    last = "list_filter(messages, lambda m: m.role = 'assistant')[-1].content"
    q["extract_text"] = f"WITH {SAMPLES} SELECT sample_key, nullif({STRIPPED.format(t=last)}, '') AS reference, list_filter(messages, lambda m: m.role = 'user')[1].content AS request FROM t"
    q["extract_prediction"] = f"SELECT eval_id, coalesce(nullif({STRIPPED.format(t='prediction')}, ''), nullif({STRIPPED.format(t='reference')}, '')) AS text FROM eval_records"
    q["positional_pair"] = "SELECT eval_id AS ordinal, coalesce(trim(prediction) = trim(reference), FALSE) AS same FROM eval_records"
    q["prompt_parts"] = """WITH p AS (SELECT eval_id, list_filter(string_split(replace(replace(prompt, '<image>', chr(1) || '<image>' || chr(1)), '<video>', chr(1) || '<video>' || chr(1)), chr(1)), lambda x: x <> '') AS parts FROM eval_records WHERE prompt IS NOT NULL)
      SELECT eval_id, array_to_string(list_transform(parts, lambda x: CASE WHEN x IN ('<image>', '<video>') THEN x ELSE length(x)::VARCHAR END), '|') AS parts FROM p"""
    q["content_parts"] = f"""WITH {SAMPLES}, u AS (SELECT *, list_filter(messages, lambda m: m.role = 'user')[1].content AS prompt FROM t),
      p AS (SELECT *, list_filter(string_split(replace(replace(prompt, '<image>', chr(1) || '<image>' || chr(1)), '<video>', chr(1) || '<video>' || chr(1)), chr(1)), lambda x: trim(x) <> '') AS parts FROM u)
      SELECT sample_key, length(list_filter(messages, lambda m: m.role = 'system')[1].content) AS system_length,
        array_to_string(list_transform(parts, lambda x: CASE x WHEN '<image>' THEN 'image_url' WHEN '<video>' THEN 'video' ELSE 'text' END), ',') AS kinds, coalesce(len(flatten(videos)), 0) AS frames FROM p
      WHERE len(list_filter(parts, lambda x: x = '<image>')) = coalesce(len(images), 0) AND len(list_filter(parts, lambda x: x = '<video>')) = coalesce(len(videos), 0)"""
    q["media_manifest"] = f"WITH {SAMPLES}, {REFS}, {MANIFEST} SELECT * FROM e"
    q["media_totals"] = f"WITH {SAMPLES}, {REFS}, {MANIFEST} SELECT count(*) AS unique_media_files, coalesce(sum(size_bytes), 0)::BIGINT AS media_bytes, round(coalesce(sum(size_bytes), 0) / 1073741824.0, 2) AS gib FROM e"
    q["missing_bytes"] = f"WITH {SAMPLES}, {REFS}, {MANIFEST} SELECT count(*) AS files, coalesce(sum(size_bytes), 0)::BIGINT AS missing FROM e WHERE substr(bundle_path, 13, 1) >= '8'"
    q["bundle_metadata"] = f"""WITH {SAMPLES}, {REFS}, {MANIFEST}, f AS (SELECT count(DISTINCT coalesce(trim(dataset), 'none')) AS jsonl_files, count(*) AS rows_across_files FROM t)
      SELECT 'relocatable-bundle-1' AS format, jsonl_files, rows_across_files, (SELECT count(*) FROM e) AS unique_media_files, (SELECT coalesce(sum(size_bytes), 0)::BIGINT FROM e) AS media_bytes FROM f"""
    packed = _bundle("p")
    q["rewrite_refs"] = f"WITH {SAMPLES} SELECT sample_key, array_to_string(list_transform(images, lambda p: {packed}), '|') AS images, array_to_string(list_transform(flatten(videos), lambda p: {packed}), '|') AS frames FROM t"
    q["round_trip"] = f"WITH {SAMPLES} SELECT sample_key, array_to_string(images, '|') AS images, array_to_string(flatten(videos), '|') AS frames FROM t"
    q["resolved_refs"] = f"WITH {SAMPLES}, {REFS} SELECT field, count(*) AS refs, count(*) AS below FROM refs WHERE path IS NOT NULL GROUP BY field"
    q["missing_refs"] = f"WITH {SAMPLES}, {REFS} SELECT field, count(*) AS missing, count(DISTINCT path) AS paths FROM refs WHERE path IS NOT NULL AND path NOT IN (SELECT source_path FROM media_manifest WHERE source_path IS NOT NULL) GROUP BY field"
    q["greedy_match"] = """WITH e AS (SELECT vec_id // 16 AS pair, (vec_id // 8) % 2 AS side, vec_id, embedding::DOUBLE[] AS v FROM embeddings),
      x AS (SELECT a.pair, a.vec_id AS i, b.vec_id AS j, list_cosine_similarity(a.v, b.v) AS s FROM e a JOIN e b ON a.pair = b.pair AND a.side = 0 AND b.side = 1),
      p AS (SELECT pair, avg(m) AS p FROM (SELECT pair, i, max(s) AS m FROM x GROUP BY ALL) GROUP BY pair), r AS (SELECT pair, avg(m) AS r FROM (SELECT pair, j, max(s) AS m FROM x GROUP BY ALL) GROUP BY pair)
      SELECT pair, round(p, 6) AS p, round(r, 6) AS r, round(2 * p * r / (p + r), 6) AS f1 FROM p JOIN r USING (pair)"""
    q["resume_missing"] = "SELECT doc_id AS ordinal, lang FROM documents WHERE doc_id % 4 = 0"
    q["demo_sample"] = "WITH rows AS (SELECT dataset, sample_key FROM built_samples WHERE dataset IS NOT NULL) " + _by_group("dataset, sample_key", "dataset", f"{_key(42, 'sample_key')}, sample_key", "3")
    escape = lambda c: f"replace(replace(replace(replace(replace({c}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')"
    tag = lambda alt: f"'<img src=\"' || {escape(chr(39) + 'file://' + chr(39) + ' || replace(p, ' + chr(39) + ' ' + chr(39) + ', ' + chr(39) + '%20' + chr(39) + ')')} || '\" alt=\"{alt}\">'"
    said = lambda role: escape(f"coalesce(list_filter(messages, lambda m: m.role = '{role}')[-1].content, '')")
    q["preview_html"] = f"""WITH {SAMPLES}, c AS (SELECT sample_key, '<article><h2>' || {escape("coalesce(dataset, '')")} || ' / ' || {escape("coalesce(sample_id, '')")} || '</h2>'
        || coalesce(array_to_string(list_transform(images, lambda p: {tag('image')}), ''), '')
        || coalesce(array_to_string(list_transform(videos, lambda v: '<div class="clip">' || array_to_string(list_transform(v, lambda p: {tag('frame')}), '') || '</div>'), ''), '')
        || '<h3>Request</h3><p>' || {said('user')} || '</p><h3>Target</h3><p>' || {said('assistant')} || '</p></article>' AS card FROM t)
      SELECT sample_key, length(card) AS length, md5(card) AS card FROM c"""
    q["data_urls"] = "SELECT doc_id, md5('data:' || CASE WHEN doc_id % 2 = 0 THEN 'image/jpeg' ELSE 'application/octet-stream' END || ';base64,' || to_base64(encode(text))) AS url FROM documents WHERE text IS NOT NULL"
    q["extract_list"] = "SELECT DISTINCT 'Images\\' || regexp_extract(source_image, '([^/]*)$', 1) AS line FROM template_records WHERE source = 'sorec' AND source_image IS NOT NULL"
    q["source_counts"] = "SELECT source, count(*) AS records, count(DISTINCT source_image) AS images FROM template_records GROUP BY source"
    index = "SELECT regexp_extract(source_path, '([^/]*)$', 1) AS name, min(source_path) AS path FROM media_manifest WHERE source_path IS NOT NULL GROUP BY 1"
    q["image_index"] = index
    q["indexed_images"] = f"WITH i AS ({index}) SELECT record_id, i.path IS NOT NULL AS found FROM template_records t LEFT JOIN i ON i.name = regexp_extract(t.source_image, '([^/]*)$', 1) WHERE source = 'sorec'"
    q["resume_state"] = "SELECT count(*) AS done FROM eval_records WHERE eval_id <= 1000"
    val = lambda group, ratio=0.1: _part(group, ratio)
    q["built_d3"] = f"""WITH p AS (SELECT DISTINCT o_custkey AS i, length(o_orderpriority) AS c FROM orders), k AS (SELECT p.*, n_name, row_number() OVER (ORDER BY {_key(53, "(i || ':' || c)")}, i || ':' || c) AS rank
        FROM p JOIN customer ON c_custkey = i JOIN nation ON n_nationkey = c)
      SELECT 'd3_' || i || '_' || c AS sample_id, {val('i', 0.05)} AS split, n_name AS answer, 'c' || i || '.jpg' AS image FROM k JOIN customer ON c_custkey = i WHERE rank <= 9000 AND c_mktsegment <> 'MACHINERY'"""
    q["built_sorec"] = f"""WITH a AS (SELECT * FROM template_records WHERE source = 'sorec' AND sample_id IS NOT NULL AND source_image IS NOT NULL AND template_image IS NOT NULL AND source_text IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY sample_id ORDER BY record_id) = 1),
      k AS (SELECT *, row_number() OVER (ORDER BY {_key(65, 'sample_id')}, sample_id) AS rank FROM a)
      SELECT sample_id, {val("coalesce(nullif(sequence_name, ''), source_image)")} AS split, {STRIPPED.format(t='source_text')} AS answer, source_image || ',' || template_image AS images FROM k WHERE rank <= 6000"""
    q["built_mevis"] = f"""WITH f AS (SELECT user_id, list(printf('%05d', event_id) ORDER BY event_id) AS frames FROM events GROUP BY user_id), e AS (SELECT DISTINCT user_id, event_type FROM events),
      k AS (SELECT 'mevis_u' || user_id || '_' || event_type AS sample_id, e.user_id, event_type, frames FROM e JOIN f USING (user_id)),
      r AS (SELECT *, row_number() OVER (ORDER BY {_key(85, 'sample_id')}, sample_id) AS rank FROM k)
      SELECT sample_id, {val("('u' || user_id)")} AS split, 'who did ' || event_type AS answer, array_to_string(list_transform({_even('len(frames)', 6, 'frames')}, lambda x: 'out/frames/mevis/u' || user_id || '/' || x || '.jpg'), ',') AS frames FROM r WHERE rank <= 1900"""
    q["built_refer_kitti"] = f"""WITH s AS (SELECT s_suppkey AS i, 'n' || s_nationkey AS sequence, 'The Car ' || s_suppkey % 40 AS sentence, s_suppkey % 6 AS k FROM supplier),
      a AS (SELECT *, lower(sentence) AS g, 'expression/' || sequence || '/e' || i || '.json' AS place, CASE WHEN k > 0 THEN list_filter(range(1, 10), lambda x: x % k = 0) ELSE [] END AS ids FROM s),
      d AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY {_key(79, 'g', 'place')}, place) AS depth FROM a),
      r AS (SELECT *, row_number() OVER (ORDER BY depth, {_key(79, 'g')}, g) AS rank FROM d WHERE len(ids) > 0)
      SELECT 'refer_kitti_' || sequence || '_e' || i AS sample_id, {val('sequence')} AS split, sentence AS answer,
        array_to_string(list_transform({_even('len(ids)', 6, 'ids')}, lambda x: 'out/frames/refer_kitti/' || sequence || '/' || printf('%06d', x) || '.png'), ',') AS frames FROM r WHERE rank <= 60"""
    q["built_lasot"] = f"""WITH f AS (SELECT 's' || printf('%05d', s_suppkey) AS sequence, s_name, list_transform(range(1, s_suppkey % 7 + 6), lambda i: printf('%03d', i) || '.jpg') AS frames FROM supplier),
      c AS (SELECT * FROM (VALUES (0, 'wide', 0.15), (1, 'long', 0.5), (2, 'full', 1.0)) v(position, scale, ratio)),
      g AS (SELECT f.*, scale, position, least(len(frames) - 1, greatest(4, round_even((len(frames) - 1) * ratio, 0)::INTEGER)) AS endpoint FROM f, c),
      h AS (SELECT *, array_to_string({_even('(endpoint + 1)', 5, 'frames')}, ',') AS chosen FROM g QUALIFY row_number() OVER (PARTITION BY sequence, chosen ORDER BY position) = 1),
      k AS (SELECT *, 'lasot_' || sequence || '_' || scale || '_v0' AS sample_id FROM h)
      SELECT sample_id, {val('sequence')} AS split, 'the ' || s_name AS answer, chosen AS frames, 'cut/' || sequence || '.jpg' AS images FROM k QUALIFY row_number() OVER (ORDER BY {_key(73, 'sample_id')}, sample_id) <= 7"""
    q["built_lamot"] = f"""WITH a AS (SELECT s_suppkey AS i, 'n' || s_nationkey AS sequence, CASE WHEN s_suppkey % 3 = 0 THEN 'val' ELSE 'train' END AS split, s_name, range(1, s_suppkey % 9 + 4) AS ids FROM supplier),
      b AS (SELECT *, split || '/MOT17/' || sequence || '_' || i || '.json#0' AS key, {_even('len(ids)', 6, 'ids')} AS chosen FROM a),
      k AS (SELECT *, row_number() OVER (ORDER BY {_key(83, 'key')}, key) AS rank FROM b)
      SELECT 'lamot_' || sequence || '_' || i || '_' || printf('%04d', rank - 1) AS sample_id, split, 'follow ' || s_name AS answer,
        array_to_string(list_transform(chosen, lambda x: sequence || '/img1/' || printf('%06d', x) || '.jpg'), ',') AS frames FROM k WHERE rank <= 8 AND list_max(chosen) <= 10"""
    crop = """c AS (SELECT *, greatest(2.0, least(greatest(w, h) * scale, iw, ih)) AS side FROM b),
      d AS (SELECT *, greatest(0.0, least(x + w / 2 - side / 2, iw - side)) AS l, greatest(0.0, least(y + h / 2 - side / 2, ih - side)) AS t FROM c)"""
    corners = "concat_ws(',', greatest(0, floor(l))::INTEGER, greatest(0, floor(t))::INTEGER, least(iw, ceil(l + side))::INTEGER, least(ih, ceil(t + side))::INTEGER) AS crop"
    q["templates_tracking"] = f"""WITH b AS (SELECT 's' || printf('%05d', s_suppkey) AS sequence, s_name, s_suppkey % 50 AS x, s_suppkey % 30 + 1 AS y, s_suppkey % 20 + 4 AS w, s_suppkey % 9 + 5 AS h, 64.0 AS iw, (s_suppkey % 20 + 40)::DOUBLE AS ih, 2.0 AS scale FROM supplier), {crop}
      SELECT 'tnl2k_' || sequence AS sample_id, sequence, NULL::INTEGER AS source_index, 'tnl2k/' || sequence || '/img/001.jpg' AS source_image, 'templates/tnl2k/tnl2k_' || sequence || '.jpg' AS template_image, {corners}, 'The ' || s_name AS source_text FROM d"""
    q["templates_small"] = f"""WITH p AS (SELECT p_name, p_size, p_partkey, row_number() OVER (ORDER BY p_partkey) - 1 AS i, 'p' || p_partkey % 200 || '.png' AS image FROM part),
      r AS (SELECT *, {_key(42, 'i')} AS hash FROM p), u AS (SELECT *, row_number() OVER (PARTITION BY image ORDER BY hash, i) > 1 AS again FROM r),
      k AS (SELECT * FROM u QUALIFY row_number() OVER (ORDER BY again, hash, i) <= 300),
      b AS (SELECT *, (p_partkey % 80)::DOUBLE AS x, p_size::DOUBLE AS y, p_size / 2.0 + 1 AS w, 6.0::DOUBLE AS h, 120.0 AS iw, 90.0 AS ih, 3.0 AS scale FROM k), {crop},
      e AS (SELECT *, 'sorec_' || printf('%06d', i) || '_' || substr(sha1(i || ':' || image || ':(' || array_to_string([x, y, w::DOUBLE, h], ', ') || ')'), 1, 10) AS sample_id FROM d)
      SELECT sample_id, NULL::VARCHAR AS sequence, i::INTEGER AS source_index, 'sorec/Images/deep/' || image AS source_image, 'templates/sorec/' || sample_id || '.jpg' AS template_image, {corners}, trim(p_name) AS source_text FROM e"""
    moved = lambda x: f"array_to_string(list_transform({x}, lambda p: {_bundle('p')}), ',')"
    q["packed_fields"] = f"WITH {SAMPLES} SELECT sample_key, {moved('images')} AS images, {moved('flatten(videos)')} AS videos, array_to_string(list_transform(messages, lambda m: concat_ws(':', m.role, length(m.content))), ',') AS said FROM t"
    q["checked_lines"] = r"""WITH l AS (SELECT regexp_replace(coalesce(row_json, ''), '[\r\n]+', ' ', 'g') AS v, row_number() OVER (ORDER BY sample_key) AS line FROM built_samples)
      SELECT line, row_number() OVER (ORDER BY line) - 1 AS ordinal, json_valid(v) AND coalesce(json_type(CASE WHEN json_valid(v) THEN v END) = 'OBJECT', false) AS good FROM l WHERE regexp_matches(v, '\S')"""
    return q
