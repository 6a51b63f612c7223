"""ANSI SQL with the results of ``queries``, for an independent engine on the same tables."""

from __future__ import annotations

from batchkit.functions.text import STOP_WORDS

_LINES = r"""
    lines AS (SELECT unnest(string_split(text, chr(10))) AS line FROM documents)"""

_CLEAN = (
    _LINES
    + r""",
    tokens AS (
        SELECT list_transform(
                   regexp_split_to_array(regexp_replace(line, '\s+$', ''), '\s+'),
                   lambda w: regexp_replace(lower(w), '[^a-z]', '', 'g')) AS t
        FROM lines)"""
)

_PREFIX = (
    _LINES
    + r""",
    split AS (
        SELECT starts_with(trim(lower(line)), 'the') AS chosen,
               regexp_split_to_array(trim(lower(line)), '\s+') AS t
        FROM lines)"""
)

_PURCHASES = """
    purchases AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_SLOTS = """
    readings AS (
        SELECT user_id AS station, ts,
               CASE WHEN event_type = 'error' AND value < 20 THEN 0 ELSE 1 END AS used,
               CASE WHEN event_type = 'error' THEN 0 ELSE ceil(value) END AS free
        FROM events),
    slots AS (
        SELECT station, strftime(ts, '%a') AS weekday, CAST(extract(hour FROM ts) AS INT) AS hour,
               sum(CASE WHEN free = 0 THEN 1 ELSE 0 END)::DOUBLE / count(*) AS criticality
        FROM readings WHERE NOT (used = 0 AND free = 0)
        GROUP BY 1, 2, 3)"""

_WORST = (
    _SLOTS
    + """,
    ranked AS (
        SELECT *, row_number() OVER (
            PARTITION BY station ORDER BY criticality DESC, hour DESC, weekday DESC) AS r
        FROM slots WHERE criticality > 0.2),
    worst AS (
        SELECT station, weekday, hour, criticality, c_acctbal AS longitude, c_nationkey AS latitude
        FROM ranked JOIN customer ON station = c_custkey WHERE r = 1)"""
)

_VIEWS = """
    views AS (
        SELECT o_custkey, year(l_shipdate) AS y
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
    counts AS (
        SELECT c_custkey AS CID,
               sum(CASE WHEN y = 1998 THEN 1 ELSE 0 END)::BIGINT AS views_1998,
               sum(CASE WHEN y = 1999 THEN 1 ELSE 0 END)::BIGINT AS views_1999
        FROM customer LEFT JOIN views ON o_custkey = c_custkey GROUP BY 1)"""

_POTENTIAL = """
    potential AS (
        SELECT l_orderkey, count(*) AS potential FROM lineitem
        WHERE l_returnflag IN ('A', 'N') GROUP BY 1)"""

_EVENT_GRAPH = """
    edges AS (
        SELECT CAST(user_id AS VARCHAR) AS src, props ->> 'k' AS dst FROM events),
    ids AS (SELECT CAST(c_custkey AS VARCHAR) AS id FROM customer),
    routes AS (
        SELECT src, dst, count(*) AS m FROM edges
        WHERE src IN (SELECT id FROM ids) AND dst IN (SELECT id FROM ids) GROUP BY 1, 2)"""

_DISTANCES = (
    _EVENT_GRAPH
    + """,
    reach AS (
        SELECT '28' AS id, 0 AS hop
        UNION
        SELECT src, hop + 1 FROM reach JOIN routes ON dst = id
        WHERE hop < (SELECT count(DISTINCT src) FROM routes)),
    distances AS (SELECT id, min(hop) AS hop FROM reach GROUP BY id)"""
)

_COMPONENTS = r"""
    pages_cut AS (SELECT regexp_replace(url, '^https?://|[?#].*$', '', 'g') AS u FROM pages),
    edges AS (
        SELECT split_part(u, '/', 1) AS src,
               '/' || substr(u, strpos(u, '/') + 1) AS dst
        FROM pages_cut WHERE strpos(u, '/') > 0),
    both_ways AS (SELECT src AS a, dst AS b FROM edges UNION SELECT dst, src FROM edges),
    ids AS (
        SELECT split_part(u, '/', 1) AS id FROM pages_cut UNION SELECT dst FROM edges),
    reach AS (
        SELECT id AS a, id AS b FROM ids
        UNION
        SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON both_ways.a = reach.b),
    components AS (SELECT a AS id, min(b) AS component FROM reach GROUP BY a)"""

_PAIRS = """
    copies AS (
        SELECT l_orderkey AS k, l_partkey AS p, count(*) AS c FROM lineitem GROUP BY 1, 2)"""

_CELLS = """
    cells AS (
        SELECT count(*) AS n,
               sum(CASE WHEN quality = 1 AND toxic = 1 THEN 1 ELSE 0 END)::DOUBLE AS a,
               sum(CASE WHEN quality = 1 AND toxic = 0 THEN 1 ELSE 0 END)::DOUBLE AS b,
               sum(CASE WHEN quality = 0 AND toxic = 1 THEN 1 ELSE 0 END)::DOUBLE AS c,
               sum(CASE WHEN quality = 0 AND toxic = 0 THEN 1 ELSE 0 END)::DOUBLE AS d
        FROM labels),
    scores AS (
        SELECT *, a / nullif(a + c, 0) AS p1, a / nullif(a + b, 0) AS r1,
               d / nullif(b + d, 0) AS p0, d / nullif(c + d, 0) AS r0
        FROM cells)"""

_STOP = ", ".join("'" + word.replace("'", "''") + "'" for word in STOP_WORDS)

_LABELLED = f"""
    labelled AS (
        SELECT doc_id, quality AS label, n_chars AS score, text, source
        FROM labels JOIN documents USING (doc_id) WHERE text IS NOT NULL AND source IS NOT NULL),
    words AS (
        SELECT *, list_filter(regexp_split_to_array(regexp_replace(lower(text), '\\s+$', ''), '\\s'),
                              lambda w: w NOT IN ({_STOP})) AS t,
                  list_filter(regexp_split_to_array(regexp_replace(lower(source), '\\s+$', ''), '\\s'),
                              lambda w: w NOT IN ({_STOP})) AS s
        FROM labelled)"""

_REACH = (
    _EVENT_GRAPH
    + """,
    reach AS (
        SELECT mark AS id, mark, 0 AS hop FROM (VALUES ('28'), ('7')) AS marks(mark)
        WHERE mark IN (SELECT id FROM ids)
        UNION
        SELECT src, mark, hop + 1 FROM reach JOIN routes ON dst = id
        WHERE hop < (SELECT count(DISTINCT src) FROM routes)),
    distances AS (SELECT id, mark, min(hop) AS hop FROM reach GROUP BY id, mark)"""
)

ORACLE: dict[str, str] = {
    "word_count": f"""
        WITH {_LINES}, words AS (
            SELECT unnest(regexp_split_to_array(regexp_replace(lower(line), '\\s+$', ''), '\\s+'))
                   AS word
            FROM lines)
        SELECT word, count(*) AS n FROM words GROUP BY word""",
    "ngram_count_1": f"""
        WITH {_CLEAN}, grams AS (SELECT unnest(t) AS ngram FROM tokens)
        SELECT ngram, count(*) AS n FROM grams WHERE ngram <> '' GROUP BY ngram""",
    "ngram_count_2": f"""
        WITH {_CLEAN}, places AS (SELECT t, unnest(range(1, len(t))) AS i FROM tokens)
        SELECT t[i] || ' ' || t[i + 1] AS ngram, count(*) AS n
        FROM places WHERE t[i] <> '' AND t[i + 1] <> '' GROUP BY 1""",
    "prefix_word_count": f"""
        WITH {_PREFIX}, words AS (
            SELECT regexp_replace(unnest(t), '[^a-z]', '', 'g') AS word FROM split WHERE chosen)
        SELECT word, count(*) AS n FROM words GROUP BY word""",
    "prefix_word_counters": f"""
        WITH {_PREFIX}
        SELECT sum(CASE WHEN chosen THEN len(t) ELSE 0 END)::BIGINT AS selected_words,
               sum(CASE WHEN chosen THEN 0 ELSE len(t) END)::BIGINT AS unselected_words
        FROM split""",
    "prefix_near_max": f"""
        WITH {_CLEAN}, words AS (SELECT unnest(t) AS word FROM tokens),
        counts AS (
            SELECT word, count(*) AS n FROM words WHERE starts_with(word, 'th') GROUP BY word)
        SELECT word, n FROM counts WHERE n > 0.02 * (SELECT max(n) FROM counts)""",
    "prefix_words_observed": f"""
        WITH {_PREFIX}, words AS (
            SELECT regexp_replace(unnest(t), '[^a-z]', '', 'g') AS word FROM split WHERE chosen)
        SELECT word, count(*) AS n,
               (SELECT sum(len(t)) FROM split WHERE chosen)::BIGINT AS selected_words,
               (SELECT sum(len(t)) FROM split WHERE NOT chosen)::BIGINT AS unselected_words
        FROM words GROUP BY word""",
    "key_value_round_trip": f"""
        WITH {_PREFIX}, words AS (
            SELECT regexp_replace(unnest(t), '[^a-z]', '', 'g') AS word FROM split WHERE chosen)
        SELECT word, count(*) AS n FROM words GROUP BY word""",
    "csv_round_trip": """
        SELECT *, CASE WHEN event_id % 5 = 0 THEN '' WHEN event_id % 7 = 0 THEN NULL
                       ELSE ' ,"' || event_type || ' ' END AS odd
        FROM events""",
    "parse_register": f"""
        WITH {_SLOTS}
        SELECT station, date_trunc('second', ts) AS timestamp, used AS used_slots,
               free::BIGINT AS free_slots
        FROM readings""",
    "inferred_stations": """
        SELECT c_nationkey::INT AS latitude, count(*) AS stations, min(c_acctbal) AS west,
               max(c_acctbal) AS east, max(c_custkey)::INT AS last_id
        FROM customer WHERE c_acctbal > 0 GROUP BY 1""",
    "single_file_lines": """
        SELECT p_partkey || ';' || p_brand || ';' || p_size AS line, 1::BIGINT AS files FROM part""",
    "order_index_pairs": """
        WITH items AS (SELECT DISTINCT l_orderkey AS basket, l_partkey AS p FROM lineitem)
        SELECT x.basket, x.p AS product_a, y.p AS product_b
        FROM items x JOIN items y ON x.basket = y.basket AND x.p < y.p""",
    "user_product_chunks": f"""
        WITH {_PURCHASES}, items AS (
            SELECT o_custkey AS basket, l_partkey AS p,
                   (row_number() OVER (PARTITION BY o_custkey ORDER BY l_partkey) - 1) // 20 AS part
            FROM (SELECT DISTINCT o_custkey, l_partkey FROM purchases))
        SELECT basket, part::INT AS part, string_agg(p::VARCHAR, ',' ORDER BY p) AS products
        FROM items GROUP BY basket, part""",
    "user_product_lists": """
        SELECT l_orderkey AS basket, string_agg(p::VARCHAR, ',' ORDER BY p) AS products
        FROM (SELECT DISTINCT l_orderkey, l_partkey AS p FROM lineitem) GROUP BY 1""",
    "basket_pair_count": f"""
        WITH {_PAIRS}
        SELECT x.p AS product_a, y.p AS product_b, count(*) AS n
        FROM copies x JOIN copies y ON x.k = y.k AND x.p < y.p GROUP BY 1, 2""",
    "basket_pair_count_repeats": f"""
        WITH {_PAIRS}
        SELECT x.p AS product_a, y.p AS product_b,
               sum(CASE WHEN x.p = y.p THEN x.c * (x.c - 1) // 2 ELSE x.c * y.c END)::BIGINT AS n
        FROM copies x JOIN copies y ON x.k = y.k AND x.p <= y.p
        WHERE x.p < y.p OR x.c > 1 GROUP BY 1, 2""",
    "basket_pair_topk": f"""
        WITH {_PURCHASES}, items AS (
            SELECT DISTINCT o_custkey AS k, l_partkey AS p FROM purchases)
        SELECT x.p AS product_a, y.p AS product_b, count(*) AS n
        FROM items x JOIN items y ON x.k = y.k AND x.p < y.p GROUP BY 1, 2
        ORDER BY n DESC, product_a DESC, product_b DESC LIMIT 5""",
    "user_zscore": """
        SELECT l_orderkey, l_partkey, l_quantity,
               round(CASE WHEN stddev_samp(l_quantity) OVER w > 1e-8
                          THEN (l_quantity - avg(l_quantity) OVER w) / stddev_samp(l_quantity) OVER w
                          ELSE 0 END, 4) + 0.0::DOUBLE AS zscore
        FROM lineitem WINDOW w AS (PARTITION BY l_orderkey)""",
    "product_mean_zscore": """
        WITH scored AS (
            SELECT l_partkey,
                   CASE WHEN stddev_samp(l_quantity) OVER w > 1e-8
                        THEN (l_quantity - avg(l_quantity) OVER w) / stddev_samp(l_quantity) OVER w
                        ELSE 0 END AS z
            FROM lineitem WINDOW w AS (PARTITION BY l_suppkey))
        SELECT l_partkey, round(avg(z), 4) + 0.0::DOUBLE AS mean_zscore
        FROM scored GROUP BY l_partkey""",
    "two_level_count": """
        SELECT continent, count(*) AS n FROM (
            SELECT r_name AS continent, n_name AS country
            FROM customer JOIN nation ON c_nationkey = n_nationkey
                          JOIN region ON n_regionkey = r_regionkey
            GROUP BY 1, 2 HAVING count(*) >= 60) GROUP BY continent""",
    "all_match_groups": """
        SELECT l_orderkey, count(*) AS n FROM lineitem
        GROUP BY l_orderkey HAVING bool_and(l_returnflag = 'N')""",
    "distinct_per_user_year": f"""
        WITH {_PURCHASES}
        SELECT o_custkey AS SID, CAST(year(l_shipdate) AS INT) AS year,
               count(DISTINCT l_partkey) AS n
        FROM purchases JOIN part ON l_partkey = p_partkey
        WHERE p_brand = 'Brand#2' AND year(l_shipdate) BETWEEN 1997 AND 1999 GROUP BY 1, 2""",
    "zero_filled_year_counts": f"WITH {_VIEWS} SELECT * FROM counts",
    "min_max_year_select": f"""
        WITH views AS (
            SELECT o_orderkey AS CID, year(l_shipdate) AS y
            FROM orders LEFT JOIN lineitem ON l_orderkey = o_orderkey),
        counts AS (
            SELECT CID, count(*) FILTER (y = 1996) AS views_1996, count(*) FILTER (y = 1999) AS views_1999
            FROM views GROUP BY CID)
        SELECT * FROM counts WHERE views_1996 = (SELECT min(views_1996) FROM counts)
                               AND views_1999 = (SELECT max(views_1999) FROM counts)""",
    "exceeding_organizers": f"""
        WITH {_POTENTIAL}
        SELECT o_custkey AS OrganizerUID FROM orders JOIN potential ON o_orderkey = l_orderkey
        WHERE potential > CAST(substr(o_orderpriority, 1, 1) AS INT)
        GROUP BY o_custkey HAVING count(*) > 5""",
    "low_participation_meetings": f"""
        WITH {_POTENTIAL}, actual AS (
            SELECT l_orderkey AS k, count(DISTINCT l_suppkey) AS actual FROM lineitem
            WHERE l_linestatus = 'F' GROUP BY 1)
        SELECT o_custkey AS OrganizerUID, count(*) AS n
        FROM orders JOIN potential ON o_orderkey = l_orderkey LEFT JOIN actual ON k = o_orderkey
        WHERE potential > 3 AND coalesce(actual, 0) < 2 GROUP BY 1""",
    "slot_criticality": f"WITH {_SLOTS} SELECT * FROM slots WHERE criticality > 0.3",
    "slot_criticality_sql": f"""
        WITH {_SLOTS}
        SELECT station AS station_id, weekday, hour, criticality,
               c_acctbal AS longitude, c_nationkey AS latitude
        FROM slots JOIN customer ON station = c_custkey WHERE criticality > 0.3""",
    "critical_slots_located": f"""
        WITH {_SLOTS}
        SELECT station AS station_id, weekday, hour, criticality,
               c_acctbal AS longitude, c_nationkey AS latitude
        FROM slots JOIN customer ON station = c_custkey WHERE criticality > 0.3""",
    "critical_top1": f"""
        WITH {_SLOTS} SELECT * FROM slots WHERE criticality > 0.2
        ORDER BY criticality DESC, hour DESC, weekday DESC, station LIMIT 1""",
    "critical_top5": f"""
        WITH {_SLOTS} SELECT * FROM slots WHERE criticality > 0.2
        ORDER BY criticality DESC, station, weekday, hour LIMIT 5""",
    "most_critical_per_station": f"WITH {_WORST} SELECT * FROM worst",
    "critical_kml": f"""
        WITH {_WORST}
        SELECT '<Placemark><name>' || station || '</name><ExtendedData>'
            || '<Data name="DayWeek"><value>' || weekday || '</value></Data>'
            || '<Data name="Hour"><value>' || hour || '</value></Data>'
            || '<Data name="Criticality"><value>' || criticality || '</value></Data>'
            || '</ExtendedData><Point><coordinates>' || longitude || ',' || latitude
            || '</coordinates></Point></Placemark>' AS line
        FROM worst""",
    "critical_tsv": f"""
        WITH {_WORST}
        SELECT concat_ws(chr(9), station, weekday, hour, longitude, latitude) AS line FROM worst""",
    "top_slots_per_station": f"""
        WITH {_SLOTS} SELECT * FROM slots WHERE criticality > 0.2
        QUALIFY row_number() OVER (
            PARTITION BY station ORDER BY criticality DESC, hour DESC, weekday DESC) <= 3""",
    "label_rows": """
        SELECT o_orderkey, kept, lines,
               CASE WHEN kept::DOUBLE / lines > 0.9 THEN 1 ELSE 0 END AS label
        FROM orders JOIN (
            SELECT l_orderkey, count(*) AS lines,
                   sum(CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END)::BIGINT AS kept
            FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
        WHERE o_orderpriority IS NOT NULL""",
    "classifier_split": f"""
        WITH {_LABELLED}
        SELECT doc_id, label,
               CASE WHEN ('0x' || substr(md5(doc_id || ':10'), 1, 8))::BIGINT < 0.75 * 4294967296
                    THEN 'train' ELSE 'test' END AS side
        FROM labelled""",
    "classifier_features": f"""
        WITH {_LABELLED}
        SELECT doc_id, score, length(text) AS text_length, len(t) AS text_words,
               length(source) AS summary_length, len(s) AS summary_words
        FROM words""",
    "classifier_weights": f"""
        WITH {_LABELLED}, training AS (
            SELECT doc_id, t, s FROM words
            WHERE ('0x' || substr(md5(doc_id::VARCHAR || ':10'), 1, 8))::UBIGINT < 0.75 * 4294967296),
        used AS (
            SELECT doc_id, 'text' AS text, 1000 AS size, unnest(t) AS word FROM training
            UNION ALL
            SELECT doc_id, 'summary', 500, unnest(s) FROM training),
        -- MurmurHash3, 32 bits, seed 42, of the UTF-8 bytes of each word
        bytes AS (
            SELECT word, octet_length(encode(word)) AS n,
                   list_transform(range(0, octet_length(encode(word))), lambda i:
                       ('0x' || substr(hex(encode(word)), 2 * i::INT + 1, 2))::UBIGINT) AS b
            FROM (SELECT DISTINCT word FROM used)),
        blocks AS (
            SELECT word, n, list_transform(range(0, n // 4), lambda i:
                       b[4 * i + 1] + 256 * b[4 * i + 2] + 65536 * b[4 * i + 3] + 16777216 * b[4 * i + 4]) AS k,
                   (CASE WHEN n % 4 > 0 THEN b[4 * (n // 4) + 1] ELSE 0 END
                    + 256 * CASE WHEN n % 4 > 1 THEN b[4 * (n // 4) + 2] ELSE 0 END
                    + 65536 * CASE WHEN n % 4 > 2 THEN b[4 * (n // 4) + 3] ELSE 0 END)::UBIGINT AS rest
            FROM bytes),
        multiplied AS (
            SELECT word, n, list_transform(list_append(k, rest), lambda x:
                       (x::UBIGINT * 3432918353) % 4294967296) AS k FROM blocks),
        turned AS (
            SELECT word, n, list_transform(k, lambda x:
                       (((x * 32768) % 4294967296 + x // 131072) * 461845907) % 4294967296) AS k
            FROM multiplied),
        mixed AS (
            SELECT word, n, k[len(k)] AS rest, list_reduce(list_prepend(42::UBIGINT, k[:len(k) - 1]), lambda h, x:
                       ((((xor(h, x) * 8192) % 4294967296 + xor(h, x) // 524288) * 5) + 3864292196)
                       % 4294967296) AS h
            FROM turned),
        first AS (SELECT word, xor(xor(h, rest), n::UBIGINT) AS h FROM mixed),
        second AS (SELECT word, (xor(h, h // 65536) * 2246822507) % 4294967296 AS h FROM first),
        third AS (SELECT word, (xor(h, h // 8192) * 3266489909) % 4294967296 AS h FROM second),
        hashed AS (
            SELECT word, xor(h, h // 65536)::BIGINT - CASE WHEN xor(h, h // 65536) >= 2147483648
                                                        THEN 4294967296 ELSE 0 END AS h
            FROM third),
        places AS (
            SELECT text, ((h % size) + size) % size AS place, count(DISTINCT doc_id) AS documents
            FROM used JOIN hashed USING (word) GROUP BY 1, 2),
        every AS (
            SELECT 'text' AS text, unnest(range(0, 1000)) AS place
            UNION ALL
            SELECT 'summary', unnest(range(0, 500)))
        SELECT text, place::INT AS place, coalesce(documents, 0) AS documents,
               round(ln(((SELECT count(*) FROM training) + 1.0) / (coalesce(documents, 0) + 1)), 6) AS weight
        FROM every LEFT JOIN places USING (text, place)""",
    "classification_metrics": f"""
        WITH {_CELLS}, parts AS (
            SELECT n, a, d, (a + b) / n AS w1, (c + d) / n AS w0,
                   coalesce(p1, 0) AS p1, coalesce(r1, 0) AS r1,
                   coalesce(p0, 0) AS p0, coalesce(r0, 0) AS r0
            FROM scores)
        SELECT round((a + d) / n, 6) AS accuracy,
               round(w1 * coalesce(2 * p1 * r1 / nullif(p1 + r1, 0), 0)
                   + w0 * coalesce(2 * p0 * r0 / nullif(p0 + r0, 0), 0), 6) AS f1,
               round(w1 * r1 + w0 * r0, 6) AS weighted_recall,
               round(w1 * p1 + w0 * p0, 6) AS weighted_precision
        FROM parts""",
    "confusion_matrix": f"""
        WITH {_CELLS}
        SELECT 1 AS label, 1 AS prediction, a::BIGINT AS n FROM cells
        UNION ALL SELECT 1, 0, b::BIGINT FROM cells
        UNION ALL SELECT 0, 1, c::BIGINT FROM cells
        UNION ALL SELECT 0, 0, d::BIGINT FROM cells""",
    "per_class_scores": f"""
        WITH {_CELLS}
        SELECT 1 AS class, round(p1, 6) AS precision, round(r1, 6) AS recall FROM scores
        UNION ALL SELECT 0, round(p0, 6), round(r0, 6) FROM scores""",
    "in_degree_top10": f"""
        WITH {_EVENT_GRAPH}, best AS (
            SELECT dst AS id, count(*) AS in_degree FROM edges WHERE dst IS NOT NULL
            GROUP BY 1 ORDER BY in_degree DESC, id LIMIT 10)
        SELECT id, in_degree, c_name AS name
        FROM best JOIN customer ON CAST(c_custkey AS VARCHAR) = id""",
    "motif_1hop": f"""
        WITH {_EVENT_GRAPH}
        SELECT coalesce(sum(m), 0)::BIGINT AS matches FROM routes WHERE dst = '28'""",
    "motif_2hop": f"""
        WITH {_EVENT_GRAPH}
        SELECT coalesce(sum(x.m * y.m), 0)::BIGINT AS matches
        FROM routes x JOIN routes y ON y.dst = x.src
        WHERE x.dst = '28' AND x.src <> '28' AND y.src NOT IN ('28', x.src)""",
    "motif_3hop": f"""
        WITH {_EVENT_GRAPH}
        SELECT coalesce(sum(x.m * y.m * z.m), 0)::BIGINT AS matches
        FROM routes x JOIN routes y ON y.dst = x.src JOIN routes z ON z.dst = y.src
        WHERE x.dst = '28' AND x.src <> '28' AND y.src NOT IN ('28', x.src)
          AND z.src NOT IN ('28', x.src, y.src)""",
    "distances_to_landmark": f"""
        WITH RECURSIVE {_DISTANCES} SELECT id, '28' AS landmark, hop FROM distances""",
    "distances_two_landmarks": f"""
        WITH RECURSIVE {_REACH}
        SELECT id, min(hop) FILTER (mark = '28') AS "first", min(hop) FILTER (mark = '7') AS "second"
        FROM distances GROUP BY id""",
    "farthest_vertices": f"""
        WITH RECURSIVE {_DISTANCES}
        SELECT id, hop AS distance, c_name AS name, c_mktsegment AS city, c_nationkey AS country
        FROM distances JOIN customer ON CAST(c_custkey AS VARCHAR) = id
        WHERE hop = (SELECT max(hop) FROM distances)""",
    "connected_components": f"WITH RECURSIVE {_COMPONENTS} SELECT * FROM components",
    "component_sizes": f"""
        WITH RECURSIVE {_COMPONENTS}
        SELECT component, count(*) AS n FROM components GROUP BY 1 HAVING count(*) >= 2""",
}
