"""SQL that another engine runs on the same tables, for the queries that SQL can express."""

ORACLE = {
    "op1_embedding_near_dedup": """
        WITH RECURSIVE vectors AS (
            SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
        ), links AS (
            SELECT a.vec_id AS x, b.vec_id AS y
            FROM vectors a JOIN vectors b ON a.label = b.label AND a.vec_id <> b.vec_id
            WHERE list_cosine_similarity(a.e, b.e) >= 0.93
        ), reach AS (
            SELECT vec_id AS id, vec_id AS other FROM embeddings
            UNION
            SELECT id, y FROM reach JOIN links ON x = other
        ), components AS (
            SELECT id, min(other) AS component_id FROM reach GROUP BY id
        ), counts AS (
            SELECT x, count(*) AS n FROM links GROUP BY x
        )
        SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept
        FROM components LEFT JOIN counts ON x = id
    """,
    "op2_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER same AS keep_id,
               count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
        WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op4_chat_format": """
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations
            UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'),
                             (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
        ), coded AS (
            SELECT *, lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before,
                   -- each ~ takes one more character, each start of a control string too
                   length(text) + length(text) - length(replace(text, '~', ''))
                   + length(regexp_replace(text, '</?s>|\\[/?INST\\]', '\\0#', 'g'))
                   - length(text) AS coded_chars
            FROM rows
        )
        SELECT conv_id, count(*) AS n_turns,
               sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
                   AS turns_sha256,
               coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
               sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
                   FILTER (role = 'assistant'), '')) AS loss_sha256,
               sum(coded_chars + length(role) + length('[INST]') + length('[/INST]')
                   + length('</s>'))::BIGINT AS formatted_chars,
               bool_and(CASE before WHEN '' THEN role IN ('system', 'user')
                                    WHEN 'user' THEN role = 'assistant'
                                    ELSE role = 'user' END)
                   AND arg_max(role, turn) IN ('user', 'assistant') AS valid
        FROM coded GROUP BY conv_id
    """,
    "op10_warc": """
        WITH rows AS (
            SELECT page_id, coalesce(html, '') AS html,
                   octet_length(encode(coalesce(html, ''))) AS payload_bytes
            FROM pages
        ), best AS (
            SELECT *, max(page_id) OVER (PARTITION BY html) AS best FROM rows
        )
        SELECT page_id, payload_bytes, sha1(html) AS payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id <> best
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id <> best THEN best END AS refers_to
        FROM best
    """,
    "op11_hard_negatives": """
        WITH vectors AS (
            SELECT vec_id AS id,
                   CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
        ), scores AS (
            SELECT a.id AS anchor_id, b.id AS id, a.label = b.label AS same,
                   list_dot_product(a.v, b.v)::BIGINT AS score
            FROM vectors a JOIN vectors b ON a.id <> b.id WHERE a.id % 100 = 0
        ), close AS (
            SELECT anchor_id, id AS positive_id, score AS positive_score FROM scores WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
        )
        SELECT anchor_id, positive_id,
               row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id)::INT AS rank,
               id AS negative_id, positive_score, score AS negative_score
        FROM close JOIN scores USING (anchor_id)
        WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
        QUALIFY rank <= 10
    """,
    "op13_phrase_collocations": """
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang,
                   unnest(string_split_regex(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[.,;:!?\\x0A-\\x0D]')) AS piece
            FROM documents
        ), lists AS (
            SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
        ), words AS (
            SELECT lang, unnest(w) AS x, unnest(list_append(w[2:], NULL)) AS y,
                   unnest(list_concat(w[3:], [NULL, NULL])[:len(w)]) AS z
            FROM lists WHERE len(w) > 0
        ), f AS MATERIALIZED (
            SELECT lang, x AS phrase, x, NULL AS y, NULL AS z, count(*) AS f FROM words GROUP BY lang, x
            UNION ALL
            SELECT lang, x || ' ' || y, x, y, NULL, count(*) FROM words
            WHERE y IS NOT NULL GROUP BY lang, x, y HAVING count(*) >= 10
            UNION ALL
            SELECT lang, x || ' ' || y || ' ' || z, x, y, z, count(*) FROM words
            WHERE z IS NOT NULL GROUP BY lang, x, y, z HAVING count(*) >= 10
        ), totals AS (
            SELECT lang, sum(f)::BIGINT AS n FROM f WHERE y IS NULL GROUP BY lang
        ), known AS (
            -- one key, so that no join is on the language alone
            SELECT lang || chr(10) || phrase AS key, f FROM f
        ), parts AS (
            SELECT lang, phrase, f AS a, 1 AS k, lang || chr(10) || x AS head,
                   lang || chr(10) || concat_ws(' ', y, z) AS rest
            FROM f WHERE y IS NOT NULL
            UNION ALL
            SELECT lang, phrase, f, 2, lang || chr(10) || x || ' ' || y, lang || chr(10) || z
            FROM f WHERE z IS NOT NULL
        ), cuts AS (
            SELECT lang, phrase, a, k, l.f AS l, r.f AS r,
                   (1000000::HUGEINT * a * a // (l.f::HUGEINT * r.f))::BIGINT AS score
            FROM parts JOIN known l ON l.key = head JOIN known r ON r.key = rest
        ), scored AS (
            SELECT lang, phrase, a, arg_min(l, (score, k)) AS l, arg_min(r, (score, k)) AS r,
                   min(score) AS score
            FROM cuts GROUP BY lang, phrase, a
        ), inside AS (
            SELECT lang, phrase, max(f) AS longer FROM (
                SELECT lang, f, x || ' ' || y AS phrase FROM f WHERE z IS NOT NULL
                UNION ALL
                SELECT lang, f, y || ' ' || z FROM f WHERE z IS NOT NULL
            ) GROUP BY lang, phrase
        ), ranked AS (
            SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
                   phrase, a, l, r, score
            FROM scored LEFT JOIN inside USING (lang, phrase)
            WHERE longer IS NULL OR 100 * longer < 50 * a
        )
        SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang)
        WHERE rank <= 2000
    """,
}
