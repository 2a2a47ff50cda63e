"""The vector and digest queries as DuckDB SQL; rounds are written out one after another."""

from claimwright.llm import centroids, text_digest, vector_codes

_FINITE = "len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
_FLOORED = "(total - ((total % n) + n) % n) // n"


def vector_codes_sql(parts: int = vector_codes.PARTS, entries: int = vector_codes.ENTRIES,
                     rounds: int = vector_codes.ROUNDS, scale: int = vector_codes.SCALE) -> str:
    """Codes and codebooks of vectors of one length that can be cut into the parts."""
    def assigned(name: str, books: str) -> str:
        return f"""{name} AS MATERIALIZED (
  SELECT r, p, min({{'d': d, 'e': e}}) AS best FROM (
    SELECT r, p, e, sum((x - y) * (x - y))::BIGINT AS d FROM cells JOIN {books} USING (p, j)
    GROUP BY r, p, e) GROUP BY r, p)"""

    steps = [f"""rows_ AS MATERIALIZED (
  SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS r,
    list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE embedding IS NOT NULL AND {_FINITE})""", f"""cells AS MATERIALIZED (
  SELECT r, i // (n // {parts}) AS p, i % (n // {parts}) AS j, v[i + 1] AS x
  FROM (SELECT r, v, len(v) AS n, unnest(generate_series(0, len(v) - 1)) AS i FROM rows_))""",
        f"b0 AS MATERIALIZED (SELECT p, r AS e, j, x AS y FROM cells WHERE r < {entries})"]
    for k in range(rounds):
        steps += [assigned(f"a{k}", f"b{k}"), f"""b{k + 1} AS MATERIALIZED (
  SELECT p, e, j, coalesce({_FLOORED}, y) AS y FROM b{k} LEFT JOIN (
    SELECT p, best.e AS e, j, sum(x)::BIGINT AS total, count(*) AS n
    FROM cells JOIN a{k} USING (r, p) GROUP BY ALL) USING (p, e, j))"""]
    steps += [assigned("last_", f"b{rounds}"), f"""coded AS (
  SELECT r, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error
  FROM last_ GROUP BY r)"""]
    return "WITH " + ",\n".join(steps) + f"""
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
  (SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY p, e, j)) FROM b{rounds}) AS codebooks_sha256
FROM coded JOIN rows_ USING (r)"""


def centroids_sql(clusters: int = centroids.CLUSTERS, rounds: int = centroids.ROUNDS,
                  length: int = centroids.LENGTH, scale: int = centroids.SCALE, seed: str = "1") -> str:
    """Clusters of the vectors of the given length."""
    def assigned(name: str, centres: str) -> str:
        return f"""{name} AS MATERIALIZED (
  SELECT r, min({{'d': d, 'c': c}}) AS best FROM (
    SELECT r, c, sum((x - y) * (x - y))::BIGINT AS d FROM cells JOIN {centres} USING (j)
    GROUP BY r, c) GROUP BY r)"""

    steps = [f"""rows_ AS MATERIALIZED (
  SELECT vec_id, row_number() OVER (
      ORDER BY sha256('{seed}:' || vec_id::VARCHAR) NULLS LAST, embedding) - 1 AS r,
    list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::BIGINT) AS v
  FROM embeddings WHERE len(embedding) = {length} AND {_FINITE})""", """cells AS MATERIALIZED (
  SELECT r, j, v[j + 1] AS x FROM (
    SELECT r, v, unnest(generate_series(0, len(v) - 1)) AS j FROM rows_))""",
        f"c0 AS MATERIALIZED (SELECT r AS c, j, x AS y FROM cells WHERE r < {clusters})"]
    for k in range(rounds):
        steps += [assigned(f"a{k}", f"c{k}"), f"""c{k + 1} AS MATERIALIZED (
  SELECT c, j, coalesce({_FLOORED}, y) AS y FROM c{k} LEFT JOIN (
    SELECT best.c AS c, j, sum(x)::BIGINT AS total, count(*) AS n
    FROM cells JOIN a{k} USING (r) GROUP BY ALL) USING (c, j))"""]
    steps += [assigned("last_", f"c{rounds}"), f"""names AS (
  SELECT c, sha256(string_agg(y::VARCHAR, ',' ORDER BY j)) AS centroid_sha256
  FROM c{rounds} GROUP BY c)"""]
    return "WITH " + ",\n".join(steps) + """
SELECT vec_id, best.c::INTEGER AS cluster, best.d AS distance,
  (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia,
  (sum(best.d) OVER ())::BIGINT AS inertia, centroid_sha256
FROM last_ JOIN rows_ USING (r) JOIN names ON names.c = best.c"""


def text_digest_sql() -> str:
    """Digests of all texts and of their edited texts."""
    buckets, quarter = text_digest.BUCKETS, text_digest.BUCKETS // 4
    one, two, three = text_digest.FACTORS
    word = 1 << 32
    shift = 32 - buckets.bit_length() + 1
    return f"""
WITH ordered AS (
  SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id DESC NULLS LAST) AS i
  FROM documents),
paired AS (
  SELECT doc_id, i, t, length(t) AS n, coalesce(lead(t) OVER (ORDER BY i), first_value(t) OVER (ORDER BY i)) AS u,
    coalesce(lead(i) OVER (ORDER BY i), 1) AS after FROM ordered),
texts AS MATERIALIZED (
  SELECT i, 0 AS kind, t AS s FROM paired UNION ALL
  SELECT i, 1, substring(t, 1, n - n // 3) || substring(u, 1, n // 3) FROM paired),
bytes AS (
  SELECT i, kind, list_transform(string_split(regexp_replace(hex(encode(s)), '(..)', '\\1 ', 'g'), ' ')[:-2],
    lambda h: ('0x' || h)::UINTEGER::UBIGINT) AS b FROM texts WHERE strlen(s) > 2),
triples AS (
  SELECT i, kind, (b[k] * {one} + b[k + 1] * {two} + b[k + 2] * {three}) % {word} AS h
  FROM (SELECT i, kind, b, unnest(generate_series(1, len(b) - 2)) AS k FROM bytes)),
counted AS (
  SELECT i, kind, (((xor(h, h >> 15) * {text_digest.MIX}::UBIGINT) % {word}) >> {shift})::INTEGER AS bucket,
    count(*) AS hits FROM triples GROUP BY ALL),
filled AS (
  SELECT i, kind, bucket, coalesce(hits, 0) AS hits
  FROM texts CROSS JOIN generate_series(0, {buckets - 1}) AS g(bucket) LEFT JOIN counted USING (i, kind, bucket)),
limits AS (
  SELECT i, kind, list_sort(list(hits)) AS l FROM filled GROUP BY i, kind),
quarters AS (
  SELECT i, kind, list((hits > l[{quarter}])::INT + (hits > l[{2 * quarter}])::INT + (hits > l[{3 * quarter}])::INT
    ORDER BY bucket) AS q FROM filled JOIN limits USING (i, kind) GROUP BY i, kind),
digests AS MATERIALIZED (
  SELECT i, kind, s, q, CASE WHEN strlen(s) = 0 THEN 0 ELSE 4 * length(bin(strlen(s)))
    + (((strlen(s) << 3) >> length(bin(strlen(s)))) & 3) END AS code,
    list_aggregate(list_transform(generate_series(0, {buckets // 4 - 1}), lambda k: printf('%02x',
      64 * q[4 * k + 1] + 16 * q[4 * k + 2] + 4 * q[4 * k + 3] + q[4 * k + 4])), 'string_agg', '') AS hexed
  FROM quarters JOIN texts USING (i, kind)),
near AS (
  SELECT p.i, e.kind, 1 - (len(list_filter(list_zip(a.q, e.q), lambda z: z[1] <> z[2]))
    + {text_digest.LENGTH_WEIGHT} * least(abs(a.code - e.code), {text_digest.LENGTH_STEPS}))
    / {text_digest.GREATEST}::DOUBLE AS likeness
  FROM paired p JOIN digests a ON a.i = p.i AND a.kind = 0
  JOIN digests e ON (e.kind = 1 AND e.i = p.i) OR (e.kind = 0 AND e.i = p.after))
SELECT p.doc_id, p.n AS n_chars, sha256(e.s) AS edited_sha256,
  printf('%02x', a.code) || a.hexed AS fingerprint, printf('%02x', e.code) || e.hexed AS edited_fingerprint,
  x.likeness AS near_edited, y.likeness AS near_next
FROM paired p JOIN digests a ON a.i = p.i AND a.kind = 0 JOIN digests e ON e.i = p.i AND e.kind = 1
JOIN near x ON x.i = p.i AND x.kind = 1 JOIN near y ON y.i = p.i AND y.kind = 0
"""
