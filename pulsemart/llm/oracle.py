"""Expected results of the package's queries as DuckDB SQL, where SQL can state them."""

from pulsemart.llm.licenses import FULL_TEXTS, JOINED, KNOWN_LICENSES, MARKS, SPELLINGS, STATEMENTS

MIX_SOURCES = """
WITH sizes AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size
    FROM documents
),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM sizes GROUP BY source),
weighted AS (
    SELECT *, (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS weight FROM totals
),
-- In the order of size by weight, the sources that reach their cap come first.
shares AS (
    SELECT *, sum(source_size) OVER () AS everything,
        coalesce(sum(3 * source_size) OVER (
            ORDER BY source_size::DOUBLE / weight, encode(source) NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING
        ), 0) AS capped_before,
        sum(weight) OVER (
            ORDER BY source_size::DOUBLE / weight, encode(source) NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING
        ) AS open_weight
    FROM weighted
),
capped AS (
    SELECT *, 3 * source_size * open_weight < weight * (everything - capped_before) AS stops FROM shares
),
open AS (
    SELECT (max(everything) - coalesce(sum(CASE WHEN stops THEN 3 * source_size END), 0))::DOUBLE AS share,
        sum(CASE WHEN NOT stops THEN weight END)::DOUBLE AS weights
    FROM capped
),
targets AS (
    SELECT source, source_size,
        CASE WHEN stops THEN (3 * source_size)::DOUBLE ELSE weight::DOUBLE * share / weights END AS target
    FROM capped, open
),
rates AS (
    SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate FROM targets
),
drawn AS (
    SELECT s.doc_id, s.size, r.source_size, r.target, r.rate,
        ('0x' || substr(md5('mix:' || coalesce(s.doc_id::VARCHAR, 'null')), 1, 13))::BIGINT::DOUBLE
            / 4503599627370496 AS u
    FROM sizes s JOIN rates r ON s.source IS NOT DISTINCT FROM r.source
)
SELECT doc_id, size, source_size, target,
    (size * (floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM drawn
"""

WARC = """
WITH payloads AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
    FROM pages
),
firsts AS (
    SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first_id
    FROM payloads
)
SELECT page_id, payload_bytes, payload_digest,
    CASE WHEN first_id IS DISTINCT FROM page_id AND first_id IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN first_id IS DISTINCT FROM page_id THEN first_id END AS refers_to
FROM firsts
"""



def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _marked(text: str) -> str:
    def replaced(sql: str, pattern: str, by: str) -> str:
        return f"regexp_replace({sql}, {_quoted(pattern)}, {_quoted(by)}, 'g')"

    sql = f"replace(lower({replaced(text, STATEMENTS, chr(92) + '1 ')}), '&', ' and ')"
    sql = f"('  ' || replace({replaced(sql, MARKS, '  ')}, chr(10), '  ' || chr(10) || '  ') || '  ')"
    for pattern in (JOINED, *SPELLINGS):
        sql = replaced(sql, pattern, r"\1\2")
    return replaced(sql, " +", " ")


LICENSES = f"""
WITH known(license, text) AS (VALUES {", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in KNOWN_LICENSES)}),
stated AS (SELECT license, trim(replace({_marked("text")}, chr(10) || ' ', '')) AS form FROM known),
full_texts(license, digest) AS (VALUES {", ".join(f"({_quoted(n)}, {_quoted(d)})" for n, d in FULL_TEXTS)}),
digests AS (
    SELECT digest, min(license) AS license
    FROM (SELECT sha256(form) AS digest, license FROM stated UNION ALL SELECT digest, license FROM full_texts) GROUP BY 1
),
marked AS (SELECT row_number() OVER () AS r, doc_id, {_marked("text")} AS marked FROM documents),
forms AS (SELECT *, trim(replace(marked, chr(10) || ' ', '')) AS form FROM marked),
lines AS (SELECT r, trim(unnest(string_split(marked, chr(10)))) AS line FROM marked),
notices AS (
    SELECT l.r, string_agg(DISTINCT s.license, ',' ORDER BY s.license) AS notices
    FROM lines l JOIN (SELECT form, min(license) AS license FROM stated GROUP BY 1) s ON l.line = s.form GROUP BY 1
)
SELECT f.doc_id, CASE WHEN f.form <> '' THEN sha256(f.form) END AS digest, d.license, n.notices
FROM forms f LEFT JOIN digests d ON f.form <> '' AND sha256(f.form) = d.digest LEFT JOIN notices n ON n.r = f.r
"""

# Stupid backoff with three words, on n-grams as text.
STUPID_BACKOFF = """
WITH texts AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(lower(coalesce(text, '')), '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
words AS (
    SELECT r, unnest(w) AS w3, unnest(range(1, len(w) + 1)) AS i,
        unnest(list_concat([NULL], w)[1:len(w)]) AS w2, unnest(list_concat([NULL, NULL], w)[1:len(w)]) AS w1
    FROM texts
),
grams AS (
    SELECT r, i, w3 AS g1, CASE WHEN i > 1 THEN w2 || ' ' || w3 END AS g2,
        CASE WHEN i > 2 THEN w1 || ' ' || w2 || ' ' || w3 END AS g3,
        CASE WHEN i > 1 THEN w2 END AS c1, CASE WHEN i > 2 THEN w1 || ' ' || w2 END AS c2
    FROM words
),
n1 AS (SELECT g1 AS g, count(*) AS n FROM grams GROUP BY 1),
n2 AS (SELECT g2 AS g, count(*) AS n FROM grams WHERE g2 IS NOT NULL GROUP BY 1),
n3 AS (SELECT g3 AS g, count(*) AS n FROM grams WHERE g3 IS NOT NULL GROUP BY 1),
size AS (SELECT count(*) AS n FROM grams),
scored AS (
    SELECT r, CASE
        WHEN a3.n >= 1 THEN ln(a3.n / b2.n)
        WHEN a2.n >= 1 THEN CASE WHEN g3 IS NULL THEN 0 ELSE ln(0.4::DOUBLE) END + ln(a2.n / b1.n)
        ELSE CASE WHEN g3 IS NULL THEN 0 ELSE ln(0.4::DOUBLE) END + CASE WHEN g2 IS NULL THEN 0 ELSE ln(0.4::DOUBLE) END
            + ln(a1.n / size.n)
        END AS s
    FROM grams CROSS JOIN size
    JOIN n1 a1 ON a1.g = g1
    LEFT JOIN n2 a2 ON a2.g = g2 LEFT JOIN n3 a3 ON a3.g = g3
    LEFT JOIN n1 b1 ON b1.g = c1 LEFT JOIN n2 b2 ON b2.g = c2
),
sums AS (SELECT r, sum(s) AS s FROM scored GROUP BY r)
SELECT doc_id, len(w) AS words, round(coalesce(s, 0), 6) AS score,
    CASE WHEN len(w) > 0 THEN round(s / len(w), 6) END AS per_word
FROM texts LEFT JOIN sums USING (r)
"""

FILTER_AUDIT = """
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
words AS (SELECT *, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w FROM d),
firsts AS (SELECT t, min(doc_id) AS first_id FROM d GROUP BY t),
marks AS (
    SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id
),
failed AS (
    SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
        CASE WHEN len(w) < 100 THEN 'A' ELSE '' END
        || CASE WHEN 100 * len(list_distinct(w)) < 80 * len(w) THEN 'B' ELSE '' END
        || CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END
        || CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END
        || CASE WHEN doc_id > first_id THEN 'E' ELSE '' END AS fails
    FROM words JOIN firsts USING (t) LEFT JOIN marks USING (doc_id)
),
kinds AS (SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM failed GROUP BY ALL),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
    SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
    FROM letters a, letters b, letters c, letters d, letters e
    WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
steps AS (
    SELECT filter_order, s AS step, substr(filter_order, s, 1) AS own, substr(filter_order, 1, s - 1) AS earlier
    FROM orders, (SELECT unnest([1, 2, 3, 4, 5])::INT AS s)
),
met AS (
    SELECT part, filter_order, step, own, n, good, toxic, fails,
        contains(fails, own) AS fail, translate(fails, earlier, '') <> fails AS gone
    FROM kinds, steps
),
results AS (
    SELECT part, filter_order, step, any_value(own) AS own,
        sum(CASE WHEN NOT fail AND NOT gone THEN n ELSE 0 END)::BIGINT AS kept,
        sum(CASE WHEN fail AND NOT gone THEN n ELSE 0 END)::BIGINT AS removed,
        sum(CASE WHEN fail AND gone THEN n ELSE 0 END)::BIGINT AS redundant,
        sum(CASE WHEN fails = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
        sum(CASE WHEN fail AND NOT gone THEN good ELSE 0 END)::BIGINT AS good_lost,
        sum(CASE WHEN fail AND NOT gone THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
    FROM met GROUP BY part, filter_order, step
)
SELECT * EXCLUDE own, (sum(removed) OVER (PARTITION BY part, own))::BIGINT AS shapley FROM results
"""

ORACLES: dict[str, str] = {
    "op2_stupid_backoff": STUPID_BACKOFF,
    "op3_licenses": LICENSES,
    "op6_warc": WARC,
    "op10_mix_sources": MIX_SOURCES,
    "op12_filter_audit": FILTER_AUDIT,
}
