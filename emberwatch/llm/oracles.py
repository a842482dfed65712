"""SQL with which the queries are checked, where SQL can express them."""

_WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

ORACLES = {
    "op9_mixing": f"""
WITH sized AS (
    SELECT doc_id, source, CAST({_WORDS} AS BIGINT) AS size,
           CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS key
    FROM documents
), sources AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighed AS (
    SELECT *, 2.0::DOUBLE * source_size AS most,
           [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
    FROM sources
), levels AS (
    SELECT *, row_number() OVER o AS place,
           (1.5::DOUBLE * sum(source_size) OVER ()
            - coalesce(sum(most) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
           / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM weighed
    WINDOW o AS (ORDER BY most / weight, source NULLS LAST)
), final AS (
    SELECT arg_min(level, place) FILTER (WHERE most > level * weight) AS level FROM levels
), targets AS (
    SELECT l.source, l.source_size, least(l.most, coalesce(f.level * l.weight, l.most)) AS target FROM levels l, final f
), placed AS (
    SELECT s.doc_id, s.size, t.source_size, t.target, CAST(floor(t.target + 0.5) AS BIGINT) AS budget,
           coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.key, s.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
), parted AS (
    SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS whole FROM placed
), rests AS (
    SELECT *, greatest(0, least(budget - whole * source_size - start, size)) AS rest FROM parted
)
SELECT doc_id, size, source_size, target, CAST(whole * size + rest AS BIGINT) AS taken,
       CAST(whole + CASE WHEN size > 0 THEN CAST(rest * 2 >= size AS INTEGER)
                         ELSE CAST(budget - whole * source_size - start > 0 AS INTEGER) END AS BIGINT) AS copies
FROM rests
""",
    "op10_sharding": """
WITH keyed AS (
    SELECT doc_id, CAST(coalesce(octet_length(encode(text)), 0) + 1 AS BIGINT) AS size, coalesce(text, '') AS text,
           substr(md5(coalesce(text, '')), 1, 12) || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 12) AS key
    FROM documents
), placed AS (
    SELECT *, coalesce(sum(size) OVER (ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start,
           sum(size) OVER () AS total
    FROM keyed
), sharded AS (
    SELECT *, CAST(list_sum(list_transform(range(1, 16), lambda n: CAST(start >= total * n / 16 AS INTEGER))) AS INTEGER) AS shard FROM placed
), bits AS (
    SELECT list_transform(range(256), lambda byte: list_reduce(
        list_prepend(CAST(byte AS BIGINT), range(8)),
        lambda crc, ignored: CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END)) AS crc_of
)
SELECT doc_id, size,
       xor(list_reduce(
           list_prepend(CAST(4294967295 AS BIGINT),
                        list_transform(regexp_extract_all(hex(encode(text)), '..'), lambda byte: CAST('0x' || byte AS BIGINT))),
           lambda crc, byte: xor(crc >> 8, crc_of[xor(crc & 255, byte) + 1])), CAST(4294967295 AS BIGINT)) AS text_crc32,
       'bytes' AS law, shard, CAST(row_number() OVER (PARTITION BY shard ORDER BY key) - 1 AS BIGINT) AS slot,
       CAST(NULL AS INTEGER) AS grown_shard
FROM sharded, bits
""",
    "op13_divergence": r"""
WITH rows AS (
    SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
           regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS found
    FROM documents
), groups AS (
    SELECT DISTINCT lang, source FROM rows
), met AS (
    SELECT row, lang, source, unnest(found) AS term FROM rows
), terms AS MATERIALIZED (
    SELECT lang, term, count(*)::HUGEINT AS n FROM met GROUP BY lang, term HAVING count(DISTINCT row) >= 30
), counts AS MATERIALIZED (
    SELECT lang, source, term, count(*)::HUGEINT AS n FROM met JOIN terms USING (lang, term) GROUP BY ALL
), langs AS (
    SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS total FROM terms GROUP BY lang
), totals AS (
    SELECT lang, source, sum(n)::HUGEINT AS total FROM counts GROUP BY ALL
), shares AS MATERIALIZED (
    SELECT g.lang, g.source, t.term, coalesce(c.n, 0) AS n,
           1 + (1000000000 * (coalesce(c.n, 0) + 5)) // (coalesce(s.total, 0) + 5 * l.v) AS p,
           1 + (1000000000 * (t.n + 5)) // (l.total + 5 * l.v) AS q
    FROM groups g JOIN terms t ON t.lang = g.lang JOIN langs l ON l.lang = g.lang
    LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = t.term
    LEFT JOIN totals s ON s.lang = g.lang AND s.source = g.source
), differences AS (
    SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
    FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), ranked AS (
    SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(d.value, 0) AS value
    FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN differences d ON d.lang = a.lang AND d.source = a.source AND d.item = b.source
    UNION ALL
    SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM ranked
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(place AS INTEGER) AS rank
FROM placed WHERE part = 'pair' OR place <= 50
""",
    "op12_variants": r"""
WITH RECURSIVE bits AS (
    SELECT list_transform(range(256), lambda byte: list_reduce(
        list_prepend(CAST(byte AS BIGINT), range(8)),
        lambda crc, ignored: CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END)) AS crc_of
), runs AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                             '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run
    FROM documents
), counted AS (
    SELECT doc_id, run, count(*) AS times FROM runs WHERE length(run) >= 5 GROUP BY doc_id, run
), coded AS (
    SELECT run, times,
           xor(list_reduce(
               list_prepend(CAST(4294967295 AS BIGINT),
                            list_transform(regexp_extract_all(hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)), '..'),
                                           lambda byte: CAST('0x' || byte AS BIGINT))),
               lambda crc, byte: xor(crc >> 8, crc_of[xor(crc & 255, byte) + 1])), CAST(4294967295 AS BIGINT)) AS h
    FROM counted, bits
), noisy AS (
    SELECT times, CASE WHEN h % 97 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT)) || substr(run, CAST(h % length(run) AS BIGINT) + 2) ELSE run END AS word
    FROM coded
), words AS MATERIALIZED (
    SELECT word, CAST(sum(times) AS BIGINT) AS n FROM noisy WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
), cut AS MATERIALIZED (
    SELECT word, n, spot, substr(word, 1, spot - 1) || substr(word, spot + 1) AS rest
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS spot FROM words)
), pairs AS (
    SELECT a.word, b.word AS near, b.n AS near_n FROM cut a JOIN cut b ON a.rest = b.rest AND a.spot = b.spot AND a.word <> b.word
    UNION SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
    UNION SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word
), ranked AS (
    SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place FROM pairs
), formed AS MATERIALIZED (
    SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near,
           CASE WHEN r.near_n >= 2 * w.n THEN r.near END AS form, CASE WHEN r.near_n >= 2 * w.n THEN r.near_n END AS form_n
    FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1
), chain AS (
    SELECT word, word AS reached, 0 AS links FROM formed
    UNION ALL
    SELECT c.word, f.form, c.links + 1 FROM chain c JOIN formed f ON f.word = c.reached WHERE f.form IS NOT NULL
), ends AS (
    SELECT word, arg_max(reached, links) AS root FROM chain GROUP BY word
)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM formed f JOIN ends e USING (word)
""",
    "op4_chat": """
WITH turns AS (
    SELECT conv_id, turn, CASE WHEN coalesce(role, '') = '' THEN 'unknown' ELSE regexp_replace(role, '[^A-Za-z0-9_.-]', '_', 'g') END AS speaker,
           replace(coalesce(text, ''), '<|', '< |') AS body
    FROM conversations
), casts AS (
    SELECT DISTINCT conv_id, speaker AS perspective FROM turns WHERE speaker <> 'system'
), seen AS (
    SELECT t.*, c.perspective,
           CASE WHEN speaker = 'system' THEN '<|im_start|>system' || chr(10)
                WHEN speaker = perspective THEN '<|im_start|>assistant' || chr(10)
                ELSE '<|im_start|>user name=' || speaker || chr(10) END AS head
    FROM turns t JOIN casts c ON t.conv_id IS NOT DISTINCT FROM c.conv_id
), placed AS (
    SELECT *, row_number() OVER w - 1 AS position,
           coalesce(sum(length(head) + length(body) + 11) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
    FROM seen
    WINDOW w AS (PARTITION BY conv_id, perspective ORDER BY turn NULLS FIRST, speaker, body)
)
SELECT conv_id, perspective, position, turn, speaker, head || body || '<|im_end|>' || chr(10) AS piece,
       CAST(start AS BIGINT) AS start, CAST(start + length(head) + length(body) + 11 AS BIGINT) AS "end",
       CASE WHEN speaker = perspective THEN CAST(start + length(head) AS BIGINT) END AS learn_start,
       CASE WHEN speaker = perspective THEN CAST(start + length(head) + length(body) + 10 AS BIGINT) END AS learn_end
FROM placed
""",
}
