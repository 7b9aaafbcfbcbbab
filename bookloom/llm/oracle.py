"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

CHAT = r"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce("text", '') AS said FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), placed AS (
    SELECT *, row_number() OVER w AS place, lag(role) OVER w AS before,
           length(regexp_replace(said, '<(\\*(?:/?s|r/|t/)>)', '<\\\1', 'g')) AS said_chars,
           length(regexp_replace(role, '<(\\*(?:/?s|r/|t/)>)', '<\\\1', 'g')) AS role_chars
    FROM turns WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, said)
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || said || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(coalesce(sum(length(said)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(said, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
       -- <s>role<r/> and </s> with a line end around a block, <t/> between its texts
       CAST(sum(said_chars + CASE WHEN before = role THEN 4 ELSE 3 + role_chars + 4 + 5 END) AS BIGINT) AS formatted_chars
FROM placed GROUP BY conv_id
"""

WARC = """
WITH digests AS (
    SELECT page_id, strlen(coalesce(html, '')) AS n, sha1(coalesce(html, '')) AS hex,
           CAST(unhex(sha1(coalesce(html, ''))) AS BIT)::VARCHAR AS bits
    FROM pages
), firsts AS (SELECT hex, min(page_id) AS first FROM digests GROUP BY hex)
SELECT page_id, n AS payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1
           + 16 * CAST(substr(bits, 5 * i + 1, 1) AS INT) + 8 * CAST(substr(bits, 5 * i + 2, 1) AS INT)
           + 4 * CAST(substr(bits, 5 * i + 3, 1) AS INT) + 2 * CAST(substr(bits, 5 * i + 4, 1) AS INT)
           + CAST(substr(bits, 5 * i + 5, 1) AS INT) AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM digests JOIN firsts USING (hex)
"""

REPEATS = r"""
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce("text", ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), windows AS (
    SELECT r, doc_id, unnest(range(1, len(words) - 48)) AS w, words FROM texts WHERE len(words) >= 50
), hashed AS (
    SELECT r, doc_id, w, md5_number(array_to_string(words[w:w + 49], ' ')) AS h FROM windows
), earliest AS (SELECT h, min(doc_id) AS first FROM hashed GROUP BY h),
gone AS (
    SELECT DISTINCT r, unnest(range(w, w + 50)) AS place FROM hashed JOIN earliest USING (h) WHERE doc_id > first
), placed AS (
    SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS place FROM texts
), kept AS (
    SELECT r, count(*) AS n_kept, string_agg(word, ' ' ORDER BY place) AS words
    FROM placed ANTI JOIN gone USING (r, place) GROUP BY r
)
SELECT doc_id, CAST(len(t.words) AS BIGINT) AS n_words, CAST(len(t.words) - coalesce(n_kept, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.words, '')) AS kept_sha256
FROM texts t LEFT JOIN kept USING (r)
"""



def centroids_sql(rounds: int = 5, k: int = 40) -> str:
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
near{i} AS MATERIALIZED (
    SELECT r, min({{'d': list_sum(list_transform(list_zip(kept.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), 'c': c.c}}) AS best
    FROM kept CROSS JOIN c{i} AS c GROUP BY r
), sums{i} AS (
    SELECT best.c AS c, p, sum(v[p]) AS s, count(*) AS n FROM near{i} JOIN kept USING (r) CROSS JOIN range(1, 65) AS places(p) GROUP BY ALL
), c{i + 1} AS MATERIALIZED (
    SELECT c.c, coalesce(new.v, c.v) AS v FROM c{i} AS c LEFT JOIN (
        SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY p) AS v FROM sums{i} GROUP BY c) AS new USING (c)
)""")
    return f"""
WITH kept AS MATERIALIZED (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: isfinite(x))) = 64
), c0 AS MATERIALIZED (
    SELECT CAST(row_number() OVER (ORDER BY sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')), v) - 1 AS INTEGER) AS c, v FROM kept QUALIFY c < {k}
),{",".join(steps)}
SELECT vec_id, best.c AS cluster, CAST(best.d AS BIGINT) AS distance, CAST(sum(best.d) OVER (PARTITION BY best.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM near{rounds} JOIN kept USING (r) JOIN c{rounds} AS c ON c.c = best.c
"""


REPAIR = r"""
WITH RECURSIVE bits AS (
    SELECT b AS byte, b AS crc, 0 AS n FROM range(256) AS t(b)
    UNION ALL SELECT byte, CASE WHEN crc & 1 = 1 THEN xor(crc >> 1, 3988292384) ELSE crc >> 1 END, n + 1 FROM bits WHERE n < 8
), lookup AS (SELECT list(crc ORDER BY byte) AS crcs FROM bits WHERE n = 8
), hashed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce("text", ' ') AS said,
           xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), list_transform(string_split(
               coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ascii(x) AS BIGINT))),
               lambda crc, b: xor(crc >> 8, crcs[(xor(crc, b) & 255) + 1]))) % 20 AS fault
    FROM conversations CROSS JOIN lookup
), damaged AS (
    SELECT conv_id, turn, CASE fault WHEN 4 THEN 'user' ELSE role END AS role,
           CASE fault WHEN 1 THEN '' WHEN 2 THEN regexp_replace(said, '[.!?]', '', 'g') ELSE said END AS said
    FROM hashed CROSS JOIN range(2) AS copies(i) WHERE fault <> 0 AND (i = 0 OR fault = 3)
), ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, substr(said, 1, 64)) AS place,
           rtrim(said, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS shown FROM damaged
), marked AS MATERIALIZED (
    SELECT *, substr(role, 1, 1) AS initial,
           CASE WHEN shown = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, said ORDER BY place) > 1 THEN 'duplicate'
                WHEN right(shown, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'whole' END AS fault,
           lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY place) AS before
    FROM ordered
), convs AS (SELECT DISTINCT conv_id FROM conversations
), inserts(state, n, via) AS (  -- o: nothing yet, then the role last seen
    VALUES ('o', 0, 'o'), ('o', 1, 'u'), ('o', 2, 'a'), ('s', 0, 's'), ('s', 1, 'u'), ('s', 2, 'a'),
           ('u', 0, 'u'), ('u', 1, 'a'), ('u', 2, 'u'), ('a', 0, 'a'), ('a', 1, 'u'), ('a', 2, 'a')
), best AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS place, 'o' AS state, CAST(0 AS BIGINT) AS cost, '' AS audit FROM convs
    UNION ALL
    SELECT conv_id, place, state, cost, audit FROM (
        SELECT b.conv_id, m.place, CASE WHEN letter = 'D' THEN via WHEN letter = 'K' THEN initial WHEN via = 'u' THEN 'a' ELSE 'u' END AS state,
               b.cost + 3 * n + CASE letter WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END + CASE WHEN fault = 'truncated' AND letter <> 'D' THEN 3 ELSE 0 END AS cost,
               b.audit || repeat('I', CAST(n AS BIGINT)) || letter AS audit
        FROM best AS b JOIN marked AS m ON m.conv_id IS NOT DISTINCT FROM b.conv_id AND m.place = b.place + 1
        JOIN inserts AS i ON i.state = b.state CROSS JOIN (VALUES ('D'), ('K'), ('R')) AS letters(letter)
        WHERE letter = 'D' OR fault NOT IN ('blank', 'duplicate') AND (
            letter = 'R' OR via = 'o' AND initial = 's' OR via IN ('o', 's', 'a') AND initial = 'u' OR via = 'u' AND initial = 'a')
    ) QUALIFY row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) = 1
), sizes AS (
    SELECT conv_id, max(place) AS n, CASE WHEN count(turn) > 0 THEN max(turn) - min(turn) + 1 - count(DISTINCT turn) ELSE 0 END AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (before || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM marked GROUP BY conv_id
), chosen AS (
    SELECT b.conv_id, cost + CASE state WHEN 'u' THEN 3 WHEN 's' THEN 6 ELSE 0 END AS cost,
           audit || CASE state WHEN 'u' THEN 'I' WHEN 's' THEN 'II' ELSE '' END AS audit
    FROM best AS b LEFT JOIN sizes AS z ON z.conv_id IS NOT DISTINCT FROM b.conv_id WHERE b.place = coalesce(z.n, 0)
    QUALIFY row_number() OVER (PARTITION BY b.conv_id ORDER BY cost + CASE state WHEN 'u' THEN 3 WHEN 's' THEN 6 ELSE 0 END, audit) = 1
), edits AS (
    SELECT conv_id, nth, audit[nth] AS letter, length(replace(substr(audit, 1, nth), 'I', '')) AS place,
           length(replace(substr(audit, 1, nth), 'D', '')) AS kept, length(replace(audit, 'D', '')) % 2 AS opens
    FROM chosen CROSS JOIN LATERAL (SELECT unnest(range(1, length(audit) + 1)) AS nth)
), repaired AS (
    SELECT e.conv_id, string_agg(
        CASE WHEN letter = 'K' THEN role WHEN (kept - opens) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE said END,
        chr(10) ORDER BY nth) AS lines
    FROM edits AS e LEFT JOIN marked AS m ON m.conv_id IS NOT DISTINCT FROM e.conv_id AND m.place = e.place
    WHERE letter <> 'D' GROUP BY e.conv_id
)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, CAST(cost AS BIGINT) AS cost, audit, sha256(coalesce(lines, '')) AS repaired_sha256
FROM chosen AS c LEFT JOIN sizes AS z ON z.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN repaired AS r ON r.conv_id IS NOT DISTINCT FROM c.conv_id
"""

ORACLE = {"op1_chat_formatting": CHAT, "op5_warc": WARC, "op6_substring_dedup": REPEATS,
          "op12_centroids": centroids_sql(), "op13_repair": REPAIR}
