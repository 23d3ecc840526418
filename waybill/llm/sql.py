"""DuckDB statements for the queries that SQL can express, written apart from the Spark code."""

from __future__ import annotations

_WORDS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
)

_TERMS = (
    "regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),"
    r" '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"
)

STATEMENTS: dict[str, str] = {
    "op1_decontamination": f"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id, COALESCE({_WORDS}, []) AS w FROM documents
), item AS (
    SELECT item_id, {_WORDS} AS w, LEAST(13, len({_WORDS})) AS k FROM benchmark
), item_window AS (
    SELECT DISTINCT item_id, k, w[i:i + k - 1] AS win
    FROM (SELECT item_id, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM item WHERE k > 0)
), doc_window AS (
    SELECT r, k, i, w[i:i + k - 1] AS win
    FROM (
        SELECT r, k, w, unnest(range(1, len(w) - k + 2)) AS i
        FROM doc, (SELECT DISTINCT k FROM item_window) WHERE len(w) >= k
    )
), hit AS (
    SELECT r, i, d.k, item_id FROM doc_window d JOIN item_window b ON d.k = b.k AND d.win = b.win
), covered AS (
    SELECT r, COUNT(DISTINCT p) AS n_hit
    FROM (SELECT r, unnest(range(i, i + k)) AS p FROM (SELECT DISTINCT r, i, k FROM hit)) GROUP BY r
), item_of AS (
    SELECT r, COUNT(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(n_hit, 0) AS BIGINT) AS n_hit,
    CAST(COALESCE(n_items, 0) AS BIGINT) AS n_items, sha256(COALESCE(ids, '')) AS items_sha256,
    COALESCE(n_hit, 0) > 0 AND 20 * COALESCE(n_hit, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN covered USING (r) LEFT JOIN item_of USING (r)
""",
    "op2_warc": """
WITH page AS (
    SELECT page_id, COALESCE(strlen(html), 0) AS n, sha256(COALESCE(html, '')) AS digest FROM pages
), first AS (
    SELECT digest, MIN(page_id) AS first_id FROM page WHERE n >= 100 GROUP BY digest
)
SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, page.digest AS payload_digest,
    CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM page LEFT JOIN first ON page.digest = first.digest AND n >= 100
""",
    "op8_preference": """
WITH turn AS (
    SELECT conv_id, COALESCE(role, '') AS role, COALESCE(text, '') AS text,
        row_number() OVER (
            PARTITION BY conv_id ORDER BY turn NULLS FIRST, COALESCE(role, ''), COALESCE(text, '')
        ) AS p
    FROM conversations
), conv AS (
    SELECT conv_id, COUNT(*) AS n, MAX(CASE WHEN role = 'assistant' THEN p END) AS last_reply
    FROM turn GROUP BY conv_id
), reply AS (
    SELECT turn.conv_id, turn.text FROM turn JOIN conv ON turn.conv_id = conv.conv_id AND p = last_reply
), pair AS (
    SELECT conv.conv_id, n, last_reply, other.text AS other,
        CASE WHEN last_reply IS NULL THEN n WHEN other.text = own.text THEN last_reply ELSE last_reply - 1 END AS shared
    FROM conv LEFT JOIN reply AS own ON own.conv_id = conv.conv_id
    LEFT JOIN reply AS other ON last_reply IS NOT NULL AND other.conv_id = xor(conv.conv_id, 1)
), piece AS (
    SELECT conv_id, p, '<|im_start|>' || role || chr(10) AS head, text || '<|im_end|>' || chr(10) AS body,
        role = 'assistant' AS trained
    FROM turn
), side AS (
    SELECT conv_id, p <= shared AS is_prompt, string_agg(head || body, '' ORDER BY p) AS written,
        string_agg(
            CASE WHEN trained THEN length(head) || ':0,' || length(body) || ':1'
                ELSE (length(head) + length(body)) || ':0' END, ',' ORDER BY p
        ) AS mask
    FROM piece JOIN pair USING (conv_id) GROUP BY 1, 2
), answer AS (
    SELECT conv_id, '<|im_start|>assistant' || chr(10) AS head, other || '<|im_end|>' || chr(10) AS body
    FROM pair WHERE other IS NOT NULL AND shared < last_reply
)
SELECT pair.conv_id, CAST(shared AS BIGINT) AS n_prompt_turns, COALESCE(prompt.written, '') AS prompt,
    COALESCE(rest.written, '') AS chosen, COALESCE(answer.head || answer.body, '') AS rejected,
    COALESCE(rest.mask, '') AS chosen_mask,
    COALESCE(length(answer.head) || ':0,' || length(answer.body) || ':1', '') AS rejected_mask,
    rest.conv_id IS NOT NULL OR answer.conv_id IS NOT NULL AS differs
FROM pair
LEFT JOIN side AS prompt ON prompt.conv_id = pair.conv_id AND prompt.is_prompt
LEFT JOIN side AS rest ON rest.conv_id = pair.conv_id AND NOT rest.is_prompt
LEFT JOIN answer ON answer.conv_id = pair.conv_id
""",
    "op11_spelling": """
WITH RECURSIVE crc_row AS (
    SELECT k, list_reduce([k] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS k)
), crc AS (
    SELECT list(c ORDER BY k) AS t FROM crc_row
), run AS (
    SELECT COALESCE(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\\x{C0}-\\x{FF}]+')) AS run
    FROM documents
), per_doc AS (
    SELECT id, run, COUNT(*) AS n FROM run WHERE length(run) >= 6 GROUP BY ALL
), hashed AS (
    SELECT run, n, xor(4294967295, list_reduce(
        [4294967295] || flatten(list_transform(string_split(id || ':' || run, ''),
            lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)] ELSE [195, unicode(x) - 64] END)),
        lambda c, b: xor(c >> 8, t[CAST((xor(c, b) & 255) + 1 AS BIGINT)]))) AS h
    FROM per_doc, crc
), lost AS (
    SELECT CASE WHEN h % 199 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed
), vocab AS (
    SELECT word, CAST(SUM(n) AS BIGINT) AS n FROM lost WHERE length(word) >= 6 GROUP BY word HAVING SUM(n) >= 5
), gap AS (
    SELECT DISTINCT word, n, i, word[:i - 1] || word[i + 1:] AS rest, word[i] AS letter
    FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM vocab)
), near AS (
    SELECT a.word, a.n, b.word AS near, b.n AS near_n FROM gap a JOIN gap b ON a.i = b.i AND a.rest = b.rest AND a.letter <> b.letter
    UNION SELECT gap.word, gap.n, vocab.word, vocab.n FROM gap JOIN vocab ON rest = vocab.word
    UNION SELECT vocab.word, vocab.n, gap.word, gap.n FROM gap JOIN vocab ON rest = vocab.word
), best AS (
    SELECT word, COUNT(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, MAX(near_n) AS near_n FROM near GROUP BY word
), formed AS (
    SELECT vocab.word, vocab.n, COALESCE(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * vocab.n THEN near END AS form,
        CASE WHEN near_n >= 5 * vocab.n THEN near_n END AS form_n
    FROM vocab LEFT JOIN best ON best.word = vocab.word
), chain AS (
    SELECT word, word AS root FROM formed
    UNION ALL SELECT chain.word, formed.form FROM chain JOIN formed ON formed.word = chain.root WHERE formed.form IS NOT NULL
), ended AS (
    SELECT chain.word, root FROM chain JOIN formed ON formed.word = root WHERE form IS NULL
)
SELECT formed.word, form, root, n, CAST(n_near AS BIGINT) AS n_near, form_n FROM formed JOIN ended ON ended.word = formed.word
""",
    "op13_lexical_search": rf"""
WITH doc_term AS (
    SELECT r, doc_id, unnest({_TERMS}) AS term FROM (SELECT row_number() OVER () AS r, doc_id, text FROM documents)
), tf AS (
    SELECT r, doc_id, term, COUNT(*) AS tf FROM doc_term GROUP BY ALL
), doc AS (
    SELECT r, SUM(tf) AS n FROM tf GROUP BY r
), corpus AS (
    SELECT COUNT(*) AS n_docs, SUM(n) AS n_terms FROM doc
), item_term AS (
    SELECT k, item_id, term, COUNT(*) AS q
    FROM (SELECT row_number() OVER () AS k, item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL
), weight AS (
    SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * COUNT(*) + 1))) AS BIGINT) AS w
    FROM tf, corpus WHERE term IN (SELECT term FROM item_term) GROUP BY term, n_docs
), score AS (
    SELECT k, item_id, tf.r, tf.doc_id, CAST(SUM(q * w * (1000000000 * tf // (1000 * tf + 8 * (25 + 75 * n * n_docs // n_terms)))) AS BIGINT) AS score
    FROM item_term JOIN weight USING (term) JOIN tf USING (term) JOIN doc ON doc.r = tf.r, corpus
    GROUP BY ALL
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM score WHERE score > 0)
WHERE rank <= 10
""",
    "mixing_targets": r"""
WITH doc AS (
    SELECT doc_id, source, CAST(COALESCE(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size
    FROM documents
), per_source AS (
    SELECT source, CAST(SUM(size) AS BIGINT) AS source_size,
        [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
    FROM doc GROUP BY source
), judged AS (
    SELECT *, (
        SELECT SUM(LEAST(3.0 * b.source_size, b.weight * (3.0 * a.source_size / a.weight))) FROM per_source b
    ) >= (SELECT SUM(source_size) FROM per_source) AS below
    FROM per_source a
), level AS (
    SELECT (SUM(source_size) - SUM(CASE WHEN below THEN 0 ELSE 3 * source_size END))
        / SUM(CASE WHEN below THEN weight ELSE 0 END) AS level
    FROM judged
)
SELECT doc_id, size, source_size, CASE WHEN below THEN level * weight ELSE CAST(3 * source_size AS DOUBLE) END AS target
FROM doc JOIN judged ON doc.source IS NOT DISTINCT FROM judged.source, level
""",
    "url_rules": """
WITH rule(rule, by_rule, of_host, of_path) AS (VALUES
    ('org/', 'allow', 'org', '/'), ('example.org/es/', 'block', 'example.org', '/es/'),
    ('example.org/en/1', 'block', 'example.org', '/en/1'), ('com/fr/', 'allow', 'com', '/fr/'),
    ('com/de/', 'block', 'com', '/de/')
), rest AS (
    SELECT row_number() OVER () AS r, page_id,
        CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages
), page AS (
    SELECT r, page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
    FROM rest
), best AS (
    SELECT r, arg_max(rule, length(rule)) AS rule, arg_max(by_rule, length(rule)) AS by_rule
    FROM page JOIN rule ON (host = of_host OR ends_with(host, '.' || of_host)) AND starts_with(path, of_path)
    GROUP BY r
)
SELECT page_id, host, path, rule, by_rule FROM page LEFT JOIN best USING (r)
""",
    "rule_counts": r"""
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id, COALESCE(text, '') AS text,
        regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w
    FROM documents
), win AS (
    SELECT r, i, w[i:i + 4] AS win FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM doc WHERE len(w) >= 5)
), again AS (
    SELECT r, i FROM win QUALIFY COUNT(*) OVER (PARTITION BY r, win) > 1
), covered AS (
    SELECT r, COUNT(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM again) GROUP BY r
), line AS (
    SELECT r, unnest(string_split(text, chr(10))) AS line FROM doc
), dup AS (
    SELECT r, COUNT(*) - COUNT(DISTINCT line) AS n FROM line WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(COALESCE(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(COALESCE(covered.n, 0) AS BIGINT) AS n_repeat_words,
    len(w) < 10 OR 100 * COALESCE(covered.n, 0) > 20 * len(w) AS base_failed
FROM doc LEFT JOIN covered USING (r) LEFT JOIN dup USING (r)
""",
    "license_base": f"""
WITH phrase(phrase, label) AS (VALUES
    (['gnu', 'general', 'public', 'license'], 'gpl'), (['apache', 'license'], 'apache'),
    (['cc', 'by'], 'cc-by'), (['mit', 'license'], 'mit')
), doc AS (
    SELECT row_number() OVER () AS r, doc_id, COALESCE({_WORDS}, []) AS w FROM documents
), place AS (
    SELECT r, label, i - 1 AS start
    FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM doc) JOIN phrase ON w[i] = phrase[1]
        AND w[i:i + len(phrase) - 1] = phrase
), found AS (
    SELECT r, COUNT(*) AS n, MIN(start) AS low, MAX(start) AS high, string_agg(DISTINCT label, ',' ORDER BY label) AS labels
    FROM place GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(n, 0) AS BIGINT) AS n_base, low AS first_word,
    high AS last_word, COALESCE(labels, '') AS base_labels
FROM doc LEFT JOIN found USING (r)
""",
}
