"""SQL forms of the corpus queries that SQL can express (DuckDB)."""

from __future__ import annotations

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = f"""
WITH t AS (SELECT doc_id, {LOWER} AS norm FROM documents)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM t
"""

#: Sizes, keys, targets by running sums and the nearest cut, for a relation given by name.
_MIX = """
facts AS (
    SELECT *, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
           -ln((('0x' || substr(md5(concat('42:', coalesce(doc_id::VARCHAR, ''))), 1, 13))::BIGINT + 0.5::DOUBLE)
               / 4503599627370496.0::DOUBLE)
           / (1.0::DOUBLE / (1.0::DOUBLE + 20.0::DOUBLE
              * (length(coalesce(text, '')) - length(translate(coalesce(text, ''), '#$%&*+/<=>@^_`{|}~!', '')))
              / greatest(length(coalesce(text, '')), 1))) AS mix_key
    FROM {docs}
),
src AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight,
           1.5::DOUBLE * sum(sum(size)) OVER () AS budget
    FROM facts GROUP BY source
),
fill AS (
    SELECT *, 2.0::DOUBLE * source_size AS bound,
           coalesce(sum(2.0::DOUBLE * source_size) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
           sum(weight) OVER (ORDER BY 2.0::DOUBLE * source_size / weight, source NULLS LAST
                    ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest
    FROM src
),
capped AS (SELECT *, bound * rest <= weight * (budget - before) AS full_up FROM fill),
targets AS (
    SELECT source, source_size,
           CASE WHEN full_up THEN bound
                ELSE weight * (budget - coalesce(sum(CASE WHEN full_up THEN bound END) OVER (), 0))
                     / sum(CASE WHEN NOT full_up THEN weight END) OVER () END AS target
    FROM capped
),
parts AS (
    SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS passes FROM targets
),
taken AS (
    SELECT f.*, p.source_size, p.target, p.passes,
           p.target - p.passes * p.source_size AS part,
           sum(f.size) OVER (PARTITION BY f.source ORDER BY f.mix_key, coalesce(f.doc_id::VARCHAR, ''), f.size) AS upto,
           sum(f.size) OVER (PARTITION BY f.source, f.mix_key, f.doc_id, f.size) AS alike
    FROM facts f JOIN parts p ON f.source IS NOT DISTINCT FROM p.source
),
mixed AS (
    SELECT *, passes + CASE WHEN upto - alike / 2.0 <= part AND part > 0 THEN 1 ELSE 0 END AS times FROM taken
)
"""


def mix_sql(docs: str) -> str:
    return _MIX.replace("{docs}", docs)


OP10 = f"""
WITH {mix_sql("documents")}
SELECT doc_id, size::BIGINT AS size, source_size, target, (size * times)::BIGINT AS taken FROM mixed
"""


OP11 = f"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece
    FROM documents
),
split AS (
    SELECT row_number() OVER () AS id, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces
),
words AS (SELECT id, lang, unnest(w) AS w1, unnest(generate_series(1, len(w))) AS i FROM split WHERE len(w) > 0),
runs AS (
    SELECT lang, w1, lead(w1) OVER (PARTITION BY id ORDER BY i) AS w2, lead(w1, 2) OVER (PARTITION BY id ORDER BY i) AS w3
    FROM words
),
counts AS (
    SELECT lang, 1 AS k, w1 AS phrase, count(*)::HUGEINT AS f FROM runs GROUP BY ALL
    UNION ALL
    SELECT lang, 2, concat(w1, ' ', w2) AS phrase, count(*)::HUGEINT FROM runs WHERE w2 IS NOT NULL GROUP BY ALL
    UNION ALL
    SELECT lang, 3, concat(w1, ' ', w2, ' ', w3) AS phrase, count(*)::HUGEINT FROM runs WHERE w3 IS NOT NULL GROUP BY ALL
),
totals AS (SELECT lang, sum(f) AS n FROM counts WHERE k = 1 GROUP BY lang),
candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND f >= 10),
cuts AS (
    SELECT c.lang, c.phrase, c.f AS a, j, l.f AS l, r.f AS r, 1000000::HUGEINT * c.f * c.f // (l.f * r.f) AS score
    FROM candidates c CROSS JOIN (VALUES (1), (2)) ends(j)
    JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:j], ' ')
    JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[j + 1:], ' ')
    WHERE j < c.k
),
lowest AS (
    SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
),
inside AS (
    SELECT lang, f, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase
    FROM candidates WHERE k = 3
),
kept AS (
    SELECT x.* FROM lowest x LEFT JOIN (SELECT lang, phrase, max(f) AS longer FROM inside GROUP BY ALL) i
        ON i.lang = x.lang AND i.phrase = x.phrase
    WHERE longer IS NULL OR 100 * longer < 50 * a
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
    FROM kept JOIN totals USING (lang)
) WHERE rank <= 2000
"""

OP12 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
t AS (
    SELECT page_id, strlen(html)::BIGINT AS payload_bytes, sha1(html) AS payload_digest,
           max(page_id) OVER (PARTITION BY html) AS largest
    FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id < largest THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id < largest THEN largest END AS refers_to,
       true AS intact
FROM t
"""


def _codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    """The vector codes as a chain of views: pieces, then a codebook from each round's nearest entries."""
    views = [f"""
good AS (
    SELECT row_number() OVER () AS place, vec_id, label,
           list_transform(embedding, lambda x: floor({scale}.0::DOUBLE * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
),
sizes AS (SELECT max(len(v)) // {parts} AS width FROM good),
pieces AS (
    SELECT place, (i - 1) // width AS part, (i - 1) % width AS axis, v[i] AS x
    FROM good CROSS JOIN sizes CROSS JOIN (SELECT unnest(generate_series(1, (SELECT max(len(v)) FROM good))) AS i)
),
book0 AS (
    SELECT part, nth AS entry, axis, x FROM pieces
    JOIN (SELECT place, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS nth FROM good) USING (place)
    WHERE nth < {entries}
)"""]
    for r in range(rounds + 1):
        views.append(f"""
far{r} AS (
    SELECT p.place, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x))::BIGINT AS d
    FROM pieces p JOIN book{r} b ON p.part = b.part AND p.axis = b.axis GROUP BY ALL
),
near{r} AS (
    SELECT * FROM far{r} QUALIFY row_number() OVER (PARTITION BY place, part ORDER BY d, entry) = 1
)""")
        if r < rounds:
            views.append(f"""
book{r + 1} AS (
    SELECT b.part, b.entry, b.axis, coalesce((s - ((s % n) + n) % n) // n, b.x) AS x
    FROM book{r} b LEFT JOIN (
        SELECT part, entry, axis, sum(x)::BIGINT AS s, count(*)::BIGINT AS n
        FROM near{r} JOIN pieces USING (place, part) GROUP BY ALL) USING (part, entry, axis)
)""")
    return f"""
WITH {",".join(views)},
coded AS (
    SELECT place, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
    FROM near{rounds} GROUP BY place
)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
       (SELECT sha256(string_agg(x::BIGINT::VARCHAR, ',' ORDER BY part, entry, axis)) FROM book{rounds}) AS codebooks_sha256
FROM coded JOIN good USING (place)
"""


OP13 = _codes()


def oracle_sql() -> dict[str, str]:
    return {
        "op1_exact_dedup": OP1,
        "op10_source_mix": OP10,
        "op11_collocations": OP11,
        "op12_warc_zstd": OP12,
        "op13_vector_codes": OP13,
    }
