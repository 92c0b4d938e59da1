"""DuckDB SQL for the queries that SQL can express."""

from . import lexical, quality, resampling, sharding

WS = r"[ \t\n\x0B\f\r]+"

OP7_SQL = rf"""
WITH d AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '{WS}', ' ', 'g')) AS text_sha256 FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = min(doc_id) OVER w AS kept, text_sha256
FROM d WINDOW w AS (PARTITION BY text_sha256)
"""

#: Depths beyond 24 would need over 16 million shards.
OP2_SQL = f"""
WITH d AS (
    SELECT doc_id, strlen(coalesce(text, '')) AS n_bytes,
        CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents
), p AS (
    SELECT d.*, x.d AS depth, h >> ({sharding.HASH_BITS} - x.d) AS prefix FROM d, (SELECT unnest(range(0, 25)) AS d) x
), b AS (
    SELECT depth, prefix, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes, count(*) AS shard_docs FROM p GROUP BY ALL
), leaf AS (
    SELECT p.*, b.shard_bytes, b.shard_docs FROM p JOIN b USING (depth, prefix)
    WHERE b.shard_bytes <= {sharding.LIMIT_BYTES} OR b.shard_docs = 1
    QUALIFY row_number() OVER (PARTITION BY p.doc_id ORDER BY p.depth) = 1
)
SELECT doc_id, n_bytes, CAST(depth AS INTEGER) AS depth,
    CASE WHEN depth = 0 THEN '' ELSE lpad(bin(prefix), CAST(depth AS INTEGER), '0') END AS shard, shard_bytes, shard_docs
FROM leaf
"""


def _rounded(x: str) -> str:
    shift = f"CAST(greatest(length(bin({x})) - 6, 0) AS INTEGER)"
    return f"(({x} >> {shift}) << {shift})"


_FINE = " AND ".join(f"coalesce({s} <= (SELECT fence FROM f WHERE f.lang IS NOT DISTINCT FROM r.lang AND f.source IS NOT DISTINCT FROM r.source AND f.signal = '{s}'), true)" for s in quality.SIGNALS)
_EACH = " UNION ALL ".join(f"SELECT lang, source, '{s}' AS signal, {_rounded(s)} AS value, count(*) AS n FROM r WHERE NOT base_failed GROUP BY ALL" for s in quality.SIGNALS)
_SPREAD = " ".join(f"WHEN '{s}' THEN {v}" for s, v in quality.SIGNALS.items())


def _fence(source: str) -> str:
    return f"""
    SELECT lang, source, signal, total, q3 + {quality.FENCE} * greatest(q3 - q1, CASE signal {_SPREAD} END) AS fence FROM (
        SELECT lang, source, signal, any_value(total) AS total,
            min(value) FILTER (4 * up >= total) AS q1, min(value) FILTER (4 * up >= 3 * total) AS q3
        FROM (SELECT *, sum(n) OVER (PARTITION BY lang, source, signal ORDER BY value) AS up, sum(n) OVER (PARTITION BY lang, source, signal) AS total FROM {source})
        GROUP BY lang, source, signal)"""


OP9_SQL = rf"""
WITH w AS (
    SELECT doc_id, lang, source, coalesce(text, '') AS text,
        list_filter(regexp_split_to_array(coalesce(text, ''), '{WS}'), lambda x: x <> '') AS words FROM documents
), g AS (
    SELECT doc_id, i AS p, array_to_string(words[i:i + {quality.WINDOW - 1}], ' ') AS gram
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - {quality.WINDOW} + 2)) AS i FROM w)
), again AS (
    SELECT doc_id, p FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1
), rep AS (
    SELECT doc_id, CAST(sum(least({quality.WINDOW}, p - coalesce(before, -{quality.WINDOW}))) AS BIGINT) AS n_repeat_words
    FROM (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM again) GROUP BY doc_id
), c AS (
    SELECT w.doc_id, lang, source, CAST(len(words) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(text, '{WS}', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]'))) - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ \t\n\x0B\f\r]')))) AS BIGINT) AS n_dup_lines,
        coalesce(n_repeat_words, 0) AS n_repeat_words
    FROM w LEFT JOIN rep USING (doc_id)
), r AS (
    SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.REPEAT_PERCENT} * n_words AS base_failed,
        n_symbols * 1000 // greatest(n_words, 1) AS symbols_pm, n_dup_lines * 1000 // greatest(n_words, 1) AS dup_lines_pm,
        word_chars * 1000 // greatest(n_words, 1) AS word_len_pm, n_repeat_words * 1000 // greatest(n_words, 1) AS repeat_pm
    FROM c
), s AS ({_EACH}
), a AS (SELECT NULL AS lang, NULL AS source, signal, value, CAST(sum(n) AS BIGINT) AS n FROM s GROUP BY signal, value
), fa AS ({_fence("a")}
), fo AS ({_fence("s")}
), f AS (SELECT fo.lang, fo.source, fo.signal, CASE WHEN fo.total >= {quality.MIN_GROUP} THEN fo.fence ELSE fa.fence END AS fence FROM fo JOIN fa USING (signal))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {_FINE} AS kept FROM r
"""

#: Terms of a text as the resampling and search operators take them, and CRC32 by its polynomial, byte by byte.
_TERMS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_CRC = """
crc_table AS (
    SELECT list(v ORDER BY i) AS t FROM (SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384) ELSE a // 2 END) AS v FROM (SELECT unnest(range(256)) AS i))
), crcs AS (
    SELECT word, xor(4294967295, list_reduce(list_prepend(4294967295, bytes), lambda a, x: xor(a // 256, t[CAST(xor(a, x) % 256 AS INTEGER) + 1]))) AS crc
    FROM (SELECT word, list_transform(range(strlen(word)), lambda k: CAST('0x' || substr(hex(encode(word)), CAST(2 * k + 1 AS BIGINT), 2) AS BIGINT)) AS bytes FROM (SELECT DISTINCT word FROM words)), crc_table
)"""

OP11_SQL = rf"""
WITH lists AS (
    SELECT doc_id, false AS wanted, {_TERMS} AS terms FROM documents UNION ALL SELECT item_id, true, {_TERMS} FROM benchmark
), words AS (SELECT doc_id, wanted, unnest(terms) AS word FROM lists), {_CRC.strip()}, hashed AS (
    SELECT doc_id, wanted, crc % {resampling.BUCKETS} AS bucket FROM words JOIN crcs USING (word)
), gain AS (
    SELECT bucket, CAST(floor(1000 * ln((t + 1) * (s_all + {resampling.BUCKETS}) / ((s + 1) * (t_all + {resampling.BUCKETS})))) AS BIGINT) AS gain FROM (
        SELECT bucket, CAST(count(*) FILTER (NOT wanted) AS DOUBLE) AS s, CAST(count(*) FILTER (wanted) AS DOUBLE) AS t FROM hashed GROUP BY bucket),
        (SELECT CAST(count(*) FILTER (NOT wanted) AS DOUBLE) AS s_all, CAST(count(*) FILTER (wanted) AS DOUBLE) AS t_all FROM hashed)
), scored AS (
    SELECT doc_id, CAST(len(terms) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
        CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('{resampling.SEED}:' || CAST(doc_id AS VARCHAR)), 1, 8) AS BIGINT) + CAST(0.5 AS DOUBLE)) / CAST(4294967296 AS DOUBLE)))) AS BIGINT) AS noise
    FROM lists LEFT JOIN (SELECT doc_id, sum(gain) AS weight FROM hashed JOIN gain USING (bucket) WHERE NOT wanted GROUP BY doc_id) USING (doc_id) WHERE NOT wanted
), placed AS (
    SELECT *, n_features >= {resampling.LEAST_WORDS} AS able, weight + noise AS score, row_number() OVER (PARTITION BY n_features >= {resampling.LEAST_WORDS} ORDER BY weight + noise DESC, doc_id) AS place,
        count(*) FILTER (n_features >= {resampling.LEAST_WORDS}) OVER () AS n FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN able AND place <= {resampling.PERCENT} * n // 100 THEN place END AS rank FROM placed
"""

#: Weights and normalisers of the contract: the percentages are the operator's own.
OP12_SQL = rf"""
WITH d AS (SELECT doc_id, unnest({_TERMS}) AS term FROM documents),
tf AS (SELECT doc_id, term, count(*) AS tf FROM d GROUP BY ALL),
n AS (SELECT doc_id, count(*) AS n FROM d GROUP BY doc_id),
total AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS terms FROM n),
w AS (SELECT term, CAST(floor(1000 * ln((2 * CAST(docs AS DOUBLE) + 2) / (2 * CAST(df AS DOUBLE) + 1))) AS BIGINT) AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), total),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) GROUP BY ALL),
m AS (SELECT doc_id, {100 - lexical.LENGTH_PERCENT} + ({lexical.LENGTH_PERCENT} * n * docs) // terms AS m FROM n, total),
s AS (SELECT item_id, doc_id, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + {lexical.K} * m))) AS BIGINT) AS score FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM s WHERE score > 0
QUALIFY row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) <= {lexical.BEST}
"""
