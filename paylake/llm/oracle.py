"""SQL twins of the queries that SQL can express."""

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS = (
    "regexp_extract_all(" + LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

# CRC-32 from its generator polynomial: a table of 256 remainders, and one step per byte.
CRC_TABLE = """
crc AS (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce(list_prepend(i, range(8)),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
        FROM range(256) AS r(i)))"""


def _crc32(bytes_: str) -> str:
    return (
        f"xor(list_reduce(list_prepend(4294967295, {bytes_}), "
        "lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"
    )


def _utf8(text: str) -> str:
    return (
        f"list_transform(range(strlen({text})), "
        f"lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))"
    )


def _climb(name: str, source: str) -> str:
    """Levels of a tree: every 16 consecutive nodes become one while there is more than one."""
    return f"""
{name} AS (
    SELECT tree, 0 AS level, pos, digest, count(*) OVER (PARTITION BY tree) AS n FROM {source}
    UNION ALL
    SELECT tree, level + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos)), (any_value(n) + 15) // 16
    FROM {name} WHERE n > 1 GROUP BY tree, level, pos // 16),
{name}_runs AS (
    SELECT tree, level, pos // 16 AS run, list(digest ORDER BY pos) AS digests FROM {name} WHERE n > 1 GROUP BY ALL)"""


def _walk(name: str, start: str, levels: str) -> str:
    """From a node along its siblings to the top: what is folded on the way, and all siblings."""
    return f"""
{name} AS (
    SELECT rid, tree, 0 AS level, pos, node, proof FROM {start}
    UNION ALL
    SELECT rid, w.tree, w.level + 1, pos // 16,
        sha256(array_to_string(digests[:pos % 16], '') || node || array_to_string(digests[pos % 16 + 2:], '')),
        proof || array_to_string(digests[:pos % 16], '') || array_to_string(digests[pos % 16 + 2:], '')
    FROM {name} w JOIN {levels}_runs r ON w.tree = r.tree AND w.level = r.level AND r.run = pos // 16),
{name}_end AS (SELECT rid, arg_max(node, level) AS node, arg_max(proof, level) AS proof FROM {name} GROUP BY rid)"""


def _part(column: str) -> str:
    return f"coalesce(strlen(CAST({column} AS VARCHAR)) || ':' || {column}, '-')"


_FRONT = " || ".join(_part(c) for c in ("doc_id", "source", "lang", "n_chars"))


SQL = {
    "op1_decontamination": f"""
WITH i AS (SELECT DISTINCT item_id, {WORDS} AS w FROM benchmark),
iw AS (
    SELECT DISTINCT item_id, least(len(w), 13) AS n,
        unnest(list_transform(range(1, len(w) - least(len(w), 13) + 2),
                              lambda s: array_to_string(w[s:s + least(len(w), 13) - 1], ' '))) AS win
    FROM i WHERE len(w) > 0),
lens AS (SELECT DISTINCT n FROM iw),
d AS (SELECT doc_id, {WORDS} AS w FROM documents),
dw AS (
    SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS s, w FROM d JOIN lens ON len(w) >= n),
dws AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS win FROM dw),
hits AS (SELECT doc_id, s, dws.n, item_id FROM dws JOIN iw ON dws.n = iw.n AND dws.win = iw.win),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit
        FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) WHERE id IS NOT NULL GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos ON d.doc_id = pos.doc_id LEFT JOIN its ON d.doc_id = its.doc_id
""",
    "op2_tool_calls": r"""
WITH RECURSIVE c AS (
    SELECT conv_id, turn, role, text, 'c' || conv_id || '-' AS p, coalesce((conv_id * 31 + turn) % 7, 6) AS rule
    FROM conversations),
calls0 AS (
    SELECT conv_id, turn, p || turn AS call_id,
        CASE WHEN role = 'system' THEN NULL WHEN rule IN (0, 1, 2) THEN p || (turn + 2)
            WHEN rule <> 4 AND turn >= 2 THEN p || (turn - 2) END AS ref,
        CASE role WHEN 'user' THEN 'answer' ELSE 'configure' END AS name,
        CASE role WHEN 'user' THEN
            '{' || coalesce('"after":' || to_json(CASE WHEN rule IN (0, 1, 2) THEN p || (turn + 2)
                WHEN rule <> 4 AND turn >= 2 THEN p || (turn - 2) END) || ',', '')
            || coalesce('"question":' || to_json(text) || ',', '')
            || '"words":' || CASE WHEN rule = 5 THEN '"' ELSE '' END
            || len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))
            || CASE WHEN rule = 5 THEN '"' ELSE '' END || '}'
        ELSE '{' || coalesce('"prompt":' || to_json(text), '') || '}' END AS arguments,
        CASE WHEN role = 'system' THEN CASE WHEN text IS NULL THEN ['missing:prompt'] ELSE CAST([] AS VARCHAR[]) END
            ELSE CASE WHEN text IS NULL THEN ['missing:question'] ELSE CAST([] AS VARCHAR[]) END
                || CASE WHEN rule = 5 THEN ['type:words'] ELSE CAST([] AS VARCHAR[]) END END AS errors
    FROM c WHERE role IN ('user', 'system')),
calls AS (
    SELECT conv_id, call_id, min(turn) AS turn, min(name) AS name, min(arguments) AS arguments,
        min(ref) AS ref, min(errors) AS errors, count(*) AS copies
    FROM calls0 WHERE conv_id IS NOT NULL GROUP BY conv_id, call_id
    UNION ALL SELECT conv_id, call_id, turn, name, arguments, ref, errors, 1 FROM calls0 WHERE conv_id IS NULL),
reach AS (
    SELECT conv_id, call_id, call_id AS last, turn, 0 AS level, [call_id] AS way, false AS round
    FROM calls WHERE conv_id IS NOT NULL
    UNION ALL
    SELECT r.conv_id, r.call_id, k.call_id, k.turn, r.level + 1, r.way || [k.call_id], list_contains(r.way, k.call_id)
    FROM reach r JOIN calls a ON a.conv_id = r.conv_id AND a.call_id = r.last
        JOIN calls k ON k.conv_id = a.conv_id AND k.call_id = a.ref
    WHERE NOT r.round),
spots AS (
    SELECT conv_id, call_id, bool_or(round) AS looped, max(row(turn, level)) AS top FROM reach GROUP BY ALL),
results AS (
    SELECT conv_id, p || (turn - 1) AS call_id, min(turn) AS turn, min(text) AS content, count(*) AS copies
    FROM c WHERE role = 'assistant' GROUP BY ALL),
moving AS (
    SELECT DISTINCT a.conv_id FROM calls a JOIN calls k ON a.conv_id = k.conv_id AND a.ref = k.call_id
    WHERE k.turn >= a.turn),
rows AS (
    SELECT coalesce(a.conv_id, r.conv_id) AS conv_id, coalesce(a.call_id, r.call_id) AS call_id,
        coalesce(a.turn, r.turn) AS turn,
        CASE WHEN looped OR top IS NULL THEN row(coalesce(a.turn, r.turn), 0) ELSE top END AS at_,
        a.errors || CASE WHEN a.ref IS NOT NULL AND a.conv_id IS NOT NULL AND k.call_id IS NULL
            THEN ['reference:' || a.ref] ELSE CAST([] AS VARCHAR[]) END
            || CASE WHEN looped AND m.conv_id IS NOT NULL THEN ['cycle'] ELSE CAST([] AS VARCHAR[]) END AS errors,
        a.name, a.arguments, r.content, coalesce(a.copies, 0) + coalesce(r.copies, 0) AS copies,
        a.call_id IS NOT NULL AND r.call_id IS NOT NULL AS linked
    FROM calls a LEFT JOIN calls k ON a.conv_id = k.conv_id AND a.ref = k.call_id
    LEFT JOIN spots s ON s.conv_id = a.conv_id AND s.call_id = a.call_id
    LEFT JOIN moving m ON m.conv_id = a.conv_id
    FULL JOIN results r ON a.conv_id = r.conv_id AND a.call_id = r.call_id)
SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY at_, turn, call_id) - 1 AS position, call_id,
    linked AND len(errors) = 0 AS valid, CAST(copies AS BIGINT) AS copies,
    '{"arguments":' || coalesce(arguments, 'null') || ',"call_id":' || coalesce(to_json(call_id), 'null')
    || ',"errors":' || coalesce(CAST(to_json(errors) AS VARCHAR), '[]') || ',"name":' || coalesce(to_json(name), 'null')
    || ',"result":' || coalesce(to_json(content), 'null') || '}' AS record
FROM rows
""",
    "op6_topk": """
WITH v AS (
    SELECT row_number() OVER () AS uid, vec_id,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS e
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT q.vec_id AS query_id, q.uid AS quid, c.vec_id, c.uid,
        CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
    FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.uid <> c.uid AND len(q.e) = len(c.e))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
    SELECT *, row_number() OVER (PARTITION BY quid ORDER BY score DESC, vec_id, uid) AS rank FROM s)
WHERE rank <= 5
""",
    "op8_urls": r"""
WITH RECURSIVE a AS (
    SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
    FROM pages),
j AS (
    SELECT *, CASE
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
    FROM a),
v AS (SELECT *, CASE WHEN rule IN ('org/', 'com/fr/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block' END AS judged,
    list_transform(list_filter(string_split(path, '/'), lambda x: x <> ''), lambda x: CASE
        WHEN regexp_matches(x, '^[~*]$') THEN '=' || x
        WHEN regexp_matches(x, '^[0-9]+$') THEN '{n}'
        WHEN regexp_matches(x, '^[0-9]+\.[A-Za-z]+$') THEN regexp_replace(x, '^[0-9]+', '{n}')
        WHEN regexp_matches(x, '^[0-9a-f-]{8,}$') THEN '{h}' ELSE x END) AS segs FROM j),
c AS (SELECT host, segs, count(judged) AS labels, count(*) FILTER (judged = 'block') AS blocked FROM v GROUP BY ALL),
o AS (SELECT coalesce(sum(blocked) / nullif(sum(labels), 0), 0)::DOUBLE AS overall FROM c),
r AS (
    SELECT host, segs, labels::DOUBLE AS labels, blocked::DOUBLE AS blocked, 0 AS i, '' AS template,
        (sum(blocked) OVER (PARTITION BY host) + 4.0::DOUBLE * overall)
            / (sum(labels) OVER (PARTITION BY host) + 4.0::DOUBLE) AS p
    FROM c, o
    UNION ALL
    SELECT host, segs, labels, blocked, i + 1, CASE WHEN template = '' THEN seg ELSE template || '/' || seg END,
        CASE WHEN lone THEN p ELSE (sum(blocked) OVER g + 4.0::DOUBLE * p) / (sum(labels) OVER g + 4.0::DOUBLE) END
    FROM (
        SELECT *, CASE WHEN lone OR NOT (nb = 0 OR abs(bb - nb * share) < 2.0::DOUBLE * sqrt(nb * share * (1 - share)))
            THEN next ELSE '~' END AS seg
        FROM (
            SELECT *, (b + 4.0::DOUBLE * p) / (n + 4.0::DOUBLE) AS share FROM (
                SELECT *, sum(labels) OVER t AS n, sum(blocked) OVER t AS b, min(next) OVER t = max(next) OVER t AS lone,
                    min(rest) OVER t <> max(rest) OVER t AS apart,
                    sum(labels) OVER k AS nb, sum(blocked) OVER k AS bb
                FROM (SELECT *, coalesce(segs[i + 1], '') AS next, array_to_string(segs[i + 1:], '/') AS rest FROM r)
                WINDOW t AS (PARTITION BY host, template), k AS (PARTITION BY host, template, next)))
        WHERE b > 0 AND b < n AND apart)
    WINDOW g AS (PARTITION BY host, template, seg)),
z AS (
    SELECT host, segs, arg_max(p, i) AS p, max(i) AS i, arg_max(template, i) AS template FROM r GROUP BY host, segs)
SELECT page_id, v.host, path, rule,
    coalesce(judged, CASE WHEN p >= 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
    CASE WHEN i >= len(segs) THEN template WHEN template = '' THEN '*' ELSE template || '/*' END AS template
FROM v JOIN z USING (host, segs)
""",
    "op9_mixing": r"""
WITH s AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
        md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS h
    FROM documents),
t0 AS (
    SELECT source, sum(size) AS ss, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS number
    FROM s GROUP BY source),
t1 AS (SELECT *, number % 3 + 1 AS weight, 3 * ss AS cap, sum(ss) OVER () AS total FROM t0),
t2 AS (
    SELECT *, max(level) OVER () AS lambda_ FROM (
        SELECT *, CAST(total - coalesce(sum(cap) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, number
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE)
            / CAST(sum(weight) OVER (ORDER BY CAST(cap AS DOUBLE) / weight, number
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS DOUBLE) AS level
        FROM t1)),
t AS (SELECT source, number, ss, total, least(lambda_ * weight, CAST(cap AS DOUBLE)) AS target FROM t2),
placed AS (
    SELECT s.*, CAST(ss AS BIGINT) AS ss, target, CAST(floor(target) AS BIGINT) AS due,
        CAST(coalesce(sum(size) OVER (PARTITION BY number ORDER BY h[1:12], doc_id, size
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
    FROM s JOIN t ON s.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, ss AS source_size, target, CASE WHEN size = 0 THEN 0 ELSE CAST(
    due // ss * size + greatest(0, least(start + size, due % ss) - start) AS BIGINT) END AS taken
FROM placed
""",
    "op12_merkle_manifest": f"""
WITH RECURSIVE {CRC_TABLE.strip()},
rows AS (
    SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || source, '') AS tree,
        sha256({_FRONT} || {_part("text")}) AS leaf, sha256({_FRONT} || {_part(LOWER.format("text"))}) AS low,
        doc_id IS NOT NULL AND {_crc32(_utf8("CAST(doc_id AS VARCHAR)"))} % 5 = 0 AS bent
    FROM documents, crc),
placed AS (
    SELECT *, leaf AS digest, CASE WHEN bent THEN low ELSE leaf END AS node, '' AS proof,
        row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
    FROM rows),{_climb("lv", "placed")},
tops AS (
    SELECT tree AS name, 'all' AS tree, row_number() OVER (ORDER BY tree) - 1 AS pos, digest FROM lv WHERE n = 1),
{_climb("up", "tops").strip()},{_walk("w", "placed", "lv")},
v0 AS (
    SELECT rid, 'all' AS tree, tops.pos, w_end.node, w_end.proof
    FROM w_end JOIN placed USING (rid) JOIN tops ON tops.name = placed.tree),{_walk("v", "v0", "up")}
SELECT doc_id, leaf, tops.digest AS subroot, root, sha256(v_end.proof) AS proof_sha256,
    v_end.node AS folded_root, v_end.node = root AS verified
FROM placed JOIN v_end USING (rid) JOIN tops ON tops.name = placed.tree, (SELECT digest AS root FROM up WHERE n = 1)
""",
    "op11_spelling_variants": rf"""
WITH RECURSIVE {CRC_TABLE.strip()},
runs AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS front,
        unnest(regexp_extract_all({LOWER.format("text")}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
    FROM documents),
long_runs AS (SELECT front, run, count(*) AS k FROM runs WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT run, k, {_crc32(_utf8("(front || run)"))} AS h FROM long_runs, crc),
read AS (
    SELECT k, CASE WHEN h % 31 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2)
        ELSE run END AS word
    FROM hashed),
w AS (SELECT word, CAST(sum(k) AS BIGINT) AS n FROM read WHERE length(word) >= 7 GROUP BY word HAVING sum(k) >= 2),
cut AS (
    SELECT word, i, substr(word, 1, i - 1) AS head, substr(word, i + 1) AS tail
    FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM w)),
near AS (
    SELECT a.word, b.word AS other FROM cut a JOIN cut b ON a.head = b.head AND a.tail = b.tail AND a.word <> b.word
    UNION SELECT c.word, w.word FROM cut c JOIN w ON c.head || c.tail = w.word
    UNION SELECT w.word, c.word FROM cut c JOIN w ON c.head || c.tail = w.word),
best AS (
    SELECT near.word, count(*) AS n_near, max(w.n) AS best_n,
        arg_min(other, row(-w.n, other)) AS best
    FROM near JOIN w ON w.word = near.other GROUP BY near.word),
formed AS (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 10 * w.n THEN best END AS form,
        CASE WHEN best_n >= 10 * w.n THEN best_n END AS form_n
    FROM w LEFT JOIN best USING (word)),
walk AS (
    SELECT word, word AS last, 0 AS steps FROM formed
    UNION ALL SELECT walk.word, form, steps + 1 FROM walk JOIN formed ON formed.word = walk.last WHERE form IS NOT NULL)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n
FROM formed JOIN (SELECT word, arg_max(last, steps) AS root FROM walk GROUP BY word) USING (word)
""",
}
