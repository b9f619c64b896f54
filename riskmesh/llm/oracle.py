"""DuckDB SQL for the queries whose results SQL can express, written from what
each query returns, not from how the operators find it."""

from __future__ import annotations


def vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Lloyd rounds written out: every part against every entry, one relation a round."""
    nearest = """
        SELECT p.vec_id, p.part, min({{d: d.d, e: d.entry}}) AS m FROM points p JOIN (
          SELECT x.vec_id, x.part, c.entry, sum((x.v - c.v) * (x.v - c.v))::BIGINT AS d
          FROM cells x JOIN book{k} c ON c.part = x.part AND c.pos = x.pos GROUP BY ALL
        ) d ON d.vec_id = p.vec_id AND d.part = p.part GROUP BY ALL"""
    steps = []
    for k in range(rounds):
        steps.append(f"near{k} AS MATERIALIZED ({nearest.format(k=k)})")
        steps.append(f"""sums{k} AS (SELECT x.part, n.m.e AS entry, x.pos, sum(x.v)::BIGINT AS s, count(*) AS c
            FROM cells x JOIN near{k} n ON n.vec_id = x.vec_id AND n.part = x.part GROUP BY ALL)""")
        steps.append(f"""book{k + 1} AS MATERIALIZED (SELECT b.part, b.entry, b.pos,
            CASE WHEN s.c IS NULL THEN b.v ELSE (s.s - ((s.s % s.c) + s.c) % s.c) // s.c END AS v
            FROM book{k} b LEFT JOIN sums{k} s ON s.part = b.part AND s.entry = b.entry AND s.pos = b.pos)""")
    return f"""
    WITH kept AS (SELECT vec_id, label, embedding FROM embeddings
                  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    cells AS MATERIALIZED (SELECT vec_id, (i - 1) // (len(embedding) // {parts}) AS part, (i - 1) % (len(embedding) // {parts}) AS pos,
                           floor(4096 * embedding[i]::DOUBLE)::BIGINT AS v
                           FROM (SELECT vec_id, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM kept)),
    points AS (SELECT DISTINCT vec_id, part FROM cells),
    first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept ORDER BY vec_id LIMIT {entries}),
    book0 AS MATERIALIZED (SELECT part, entry, pos, v FROM cells JOIN first USING (vec_id)),
    {", ".join(steps)},
    last AS ({nearest.format(k=rounds)}),
    coded AS (SELECT vec_id, string_agg(printf('%02x', m.e), '' ORDER BY part) AS code, sum(m.d)::BIGINT AS error FROM last GROUP BY vec_id),
    digest AS (SELECT sha256(string_agg(v::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM book{rounds})
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
    FROM coded JOIN kept USING (vec_id), digest"""


FILL_IN_MIDDLE = """
    WITH t AS (SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS tokens,
               sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents),
    h AS (SELECT *, len(tokens) AS n, ('0x' || digest[1:8])::BIGINT AS h1, ('0x' || digest[9:16])::BIGINT AS h2,
          ('0x' || digest[17:24])::BIGINT AS h3, ('0x' || digest[25:32])::BIGINT AS h4 FROM t),
    c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS one, greatest(h1 % (n + 1), h2 % (n + 1)) AS two,
          CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 90 THEN 'plain'
               WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
    p AS (SELECT *, array_to_string(tokens[1:one], '') AS pre, array_to_string(tokens[one + 1:two], '') AS mid,
          array_to_string(tokens[two + 1:n], '') AS suf FROM c)
    SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
           CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
           sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                  ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
           sha256(text) AS restored_sha256
    FROM p"""

SUFFIX_DEDUP = """
    WITH t AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
    w AS MATERIALIZED (SELECT r, p, md5(b[p:p + 199]) AS h
                       FROM (SELECT r, b, unnest(range(1, octet_length(b) - 198)) AS p FROM t WHERE octet_length(b) >= 200)),
    again AS (SELECT h FROM w GROUP BY h HAVING count(*) > 1),
    hit AS (SELECT r, p, coalesce(p > lag(p) OVER (PARTITION BY r ORDER BY p) + 200, true) AS fresh FROM w SEMI JOIN again USING (h)),
    runs AS (SELECT r, run, min(p) AS a, max(p) + 199 AS e
             FROM (SELECT r, p, sum(fresh::INT) OVER (PARTITION BY r ORDER BY p) AS run FROM hit) GROUP BY r, run),
    rest AS (SELECT r, coalesce(lag(e) OVER (PARTITION BY r ORDER BY a), 0) + 1 AS x, a - 1 AS y FROM runs
             UNION ALL SELECT r, max(e) + 1, max(octet_length(b)) FROM runs JOIN t USING (r) GROUP BY r),
    kept AS (SELECT r, sha256(unhex(string_agg(CASE WHEN x > y THEN '' ELSE hex(b[x:y]) END, '' ORDER BY x))) AS digest
             FROM rest JOIN t USING (r) GROUP BY r),
    removed AS (SELECT r, sum(e - a + 1) AS n, count(*) AS spans FROM runs GROUP BY r)
    SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed, coalesce(spans, 0)::BIGINT AS n_spans,
           coalesce(digest, sha256(b)) AS kept_sha256
    FROM t LEFT JOIN removed USING (r) LEFT JOIN kept USING (r)"""

WORDS = r"'[^\x20\x09-\x0D]+'"

NGRAM_JOIN = f"""
    WITH RECURSIVE t AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {WORDS}) AS w
                         FROM documents),
    s AS MATERIALIZED (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
                         ELSE list_transform(range(1, len(w) - 1), lambda p: array_to_string(w[p:p + 2], ' ')) END) AS g FROM t)),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    shared AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
    link AS MATERIALIZED (SELECT a, b FROM shared JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * common >= 90 * (p.n + q.n - common)),
    edge AS MATERIALIZED (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
    reach AS (SELECT a, b FROM edge UNION SELECT reach.a, edge.b FROM reach JOIN edge ON reach.b = edge.a)
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id
    FROM documents LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS m FROM reach GROUP BY a) USING (doc_id)"""

SUBSTRING_DEDUP = f"""
    WITH t AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), {WORDS}) AS w FROM documents),
    v AS MATERIALIZED (SELECT r, p, md5(array_to_string(w[p:p + 34], ' ')) AS h
                       FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS p FROM t WHERE len(w) >= 35)),
    hit AS (SELECT r, p FROM v SEMI JOIN (SELECT h FROM v GROUP BY h HAVING count(*) > 1) USING (h)),
    gone AS (SELECT DISTINCT r, p + i AS k FROM hit, (SELECT unnest(range(35)) AS i)),
    word AS (SELECT r, unnest(w) AS x, generate_subscripts(w, 1) AS k FROM t),
    kept AS (SELECT r, string_agg(x, ' ' ORDER BY k) AS x FROM word ANTI JOIN gone USING (r, k) GROUP BY r),
    removed AS (SELECT r, count(*) AS n FROM gone GROUP BY r)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(x, '')) AS kept_sha256
    FROM t LEFT JOIN removed USING (r) LEFT JOIN kept USING (r)"""

ORACLE_SQL = {"op8_ngram_join": NGRAM_JOIN, "op10_substring_dedup": SUBSTRING_DEDUP, "op11_fill_in_middle": FILL_IN_MIDDLE, "op12_suffix_dedup": SUFFIX_DEDUP, "op13_vector_codes": vector_codes()}
