"""SQL of those training-data queries that SQL can express."""

from __future__ import annotations


def _integers(scale: int) -> str:
    return f"list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT))"


USABLE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"
DISTANCE = "list_sum(list_transform(list_zip(kept.v, {c}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))"


def clusters(k: int = 40, rounds: int = 5, size: int = 64, scale: int = 256, salt: str = "2") -> str:
    """Rounds of nearest centroids and floored means, one after the other."""
    steps = [
        f"kept AS MATERIALIZED (SELECT vec_id, {_integers(scale)} AS v FROM embeddings WHERE len(embedding) = {size} AND {USABLE})",
        f"""c0 AS MATERIALIZED (SELECT n - 1 AS c, v FROM (SELECT v, row_number() OVER (ORDER BY sha256('{salt}:' || vec_id), v) AS n FROM kept)
          WHERE n <= {k})""",
    ]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (SELECT vec_id, v, b[1] AS distance, b[2] AS c FROM (
          SELECT kept.vec_id, any_value(kept.v) AS v, min([CAST({DISTANCE.format(c=f'c{i}')} AS BIGINT), c]) AS b FROM kept, c{i} GROUP BY kept.vec_id))""")
        if i < rounds:
            steps.append(f"""m{i} AS (SELECT c, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n
              FROM (SELECT c, unnest(v) AS x, generate_subscripts(v, 1) AS pos FROM a{i}) GROUP BY ALL),
            c{i + 1} AS MATERIALIZED (SELECT c{i}.c, coalesce(any_value(w.v), any_value(c{i}.v)) AS v FROM c{i} LEFT JOIN (
              SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS v FROM m{i} GROUP BY c) w ON w.c = c{i}.c GROUP BY c{i}.c)""")
    return f"""WITH {', '.join(steps)}
      SELECT vec_id, CAST(a{rounds}.c AS INTEGER) AS cluster, distance, CAST(sum(distance) OVER (PARTITION BY a{rounds}.c) AS BIGINT) AS cluster_inertia,
        CAST(sum(distance) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
      FROM a{rounds} JOIN c{rounds} ON c{rounds}.c = a{rounds}.c"""


def largest_products(k: int = 20, every: int = 20, scale: int = 64) -> str:
    """Every query against all other rows."""
    return f"""WITH kept AS MATERIALIZED (SELECT vec_id, {_integers(scale)} AS v FROM embeddings WHERE vec_id IS NOT NULL AND {USABLE}),
      scored AS (SELECT q.vec_id AS query_id, o.vec_id, CAST(list_sum(list_transform(list_zip(q.v, o.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
        FROM kept q, kept o WHERE q.vec_id % {every} = 0 AND o.vec_id <> q.vec_id)
      SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
        SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= {k}"""


#: crc32 of a decimal number, bit by bit.
CRC32 = """xor(list_reduce([ord(c) for c in string_split(CAST({x} AS VARCHAR), '')], lambda crc, b: list_reduce(range(8),
  lambda v, i: xor(v >> 1, (v & 1) * 3988292384), xor(crc, CAST(b AS BIGINT))), 4294967295), 4294967295)"""


def word_runs(least: int = 12) -> str:
    """Runs as stretches of equal words one period apart, from pairs of equal words."""
    return f"""WITH base AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {CRC32.format(x='doc_id')} AS h,
        regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
      shape AS (SELECT r, doc_id, w, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) ELSE len(w) END AS a, h // 10 AS g FROM base),
      words AS MATERIALIZED (SELECT r, i, w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END] AS word, n FROM (
        SELECT r, w, n, a, 1 + (n - a) // (3 + g % 8) AS p, unnest(range(n)) AS i FROM shape)),
      pairs AS (SELECT x.r, x.i, y.i - x.i AS q FROM words x JOIN words y ON x.r = y.r AND x.word = y.word AND y.i > x.i AND (y.i - x.i) * 2 <= x.n),
      stretches AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM (
        SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS k FROM pairs) GROUP BY r, q, k
        HAVING count(*) + q >= greatest({least}, 2 * q)),
      runs AS MATERIALIZED (SELECT r, start, length, min(q) AS period FROM stretches GROUP BY r, start, length),
      gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
      kept AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS body FROM words ANTI JOIN gone USING (r, i) GROUP BY r),
      found AS (SELECT r, count(*) AS n_runs, min([-length, start, period]) AS b,
        string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS shown FROM runs GROUP BY r)
      SELECT doc_id, coalesce(n_runs, 0) AS n_runs, b[2] AS start, -b[1] AS length, b[3] AS period, -b[1] * 1000 // b[3] AS exponent_milli,
        sha256(coalesce(shown, '')) AS runs_sha256, sha256(coalesce(body, '')) AS collapsed_sha256
      FROM shape LEFT JOIN found USING (r) LEFT JOIN kept USING (r)"""
