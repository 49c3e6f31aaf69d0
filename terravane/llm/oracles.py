"""SQL of the text operators that SQL can say, for DuckDB.

The others have none: fingerprints (XXH64 with a seed), learned models, compressed sizes and token ids are beyond SQL,
and spans need lookarounds. Their tests hold them against plain versions.
"""

_WORDS = r"list_filter(regexp_split_to_array(coalesce(text,''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

QUALITY = rf"""WITH w AS (SELECT doc_id, coalesce(text,'') AS text, {_WORDS} AS w FROM documents),
 g AS (SELECT *, CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w)-3), lambda i: array_to_string(w[i:i+4], ' ')) ELSE []::VARCHAR[] END AS grams,
 list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM w),
 k AS (SELECT row_number() OVER () AS r, * FROM g),
 u AS (SELECT r, unnest(grams) AS gram, unnest(range(1, len(grams)+1)) AS i FROM k),
 t AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, gram) AS n FROM u) WHERE n > 1),
 s AS (SELECT r, least(5, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i) - i, 5)) AS c FROM t),
 rep AS (SELECT r, sum(c) AS n FROM s GROUP BY r),
 m AS (SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))),0)::BIGINT AS word_chars, (length(text) - length(translate(text, '#*$%&|<>', '')))::BIGINT AS n_symbols,
 len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(rep.n,0)::BIGINT AS n_repeat_words FROM k LEFT JOIN rep USING (r)),
 f AS (SELECT *, ((n_words < 10)::INT + 2*(100*n_repeat_words > 20*n_words)::INT + 4*(10*n_symbols > 4*n_words)::INT + 8*(n_lines > 3 AND 2*n_dup_lines > n_lines)::INT
 + 16*(word_chars < 2*n_words OR word_chars > 40*n_words)::INT)::BIGINT AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (fail_bits & 3) <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM f"""

_LOW = r"list_filter(regexp_split_to_array(translate(coalesce(text,''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda w: w <> '')"

DECONTAMINATE = rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_LOW} AS w FROM documents), b AS (SELECT item_id, {_LOW} AS w FROM benchmark),
 p AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, least(10, len(w)) AS m, array_to_string(w[i:i+least(10, len(w))-1], ' ') AS gram FROM (SELECT item_id, w, unnest(range(1, len(w)-least(10, len(w))+2)) AS i FROM b WHERE len(w) > 0)),
 lens AS (SELECT DISTINCT m FROM p),
 x AS (SELECT r, m, i, array_to_string(w[i:i+m-1], ' ') AS gram FROM (SELECT r, w, m, unnest(range(1, len(w)-m+2)) AS i FROM d, lens WHERE len(w) >= m)),
 hit AS (SELECT r, x.m, i, item FROM x JOIN p ON x.m = p.m AND x.gram = p.gram),
 cov AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i+m)) AS j FROM hit) GROUP BY r),
 it AS (SELECT r, count(DISTINCT item) AS n_items, sha256(string_agg(DISTINCT item, ',' ORDER BY item)) AS sha FROM hit GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit,0)::BIGINT AS n_hit, coalesce(n_items,0)::BIGINT AS n_items, coalesce(sha, sha256('')) AS items_sha256, coalesce(n_hit,0) > 0 AS contaminated FROM d LEFT JOIN cov USING (r) LEFT JOIN it USING (r)"""

#: Every row comes out of the store once, as it went in.
SHARDING = """SELECT doc_id, sha256(text) AS text_sha256, sha256(concat_ws('|', coalesce(CAST(doc_id AS VARCHAR),'NULL'), coalesce(text,'NULL'), coalesce(lang,'NULL'), coalesce(source,'NULL'), coalesce(CAST(n_chars AS VARCHAR),'NULL'))) AS row_sha256 FROM documents"""

SUBSTRINGS = rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
 g AS (SELECT r, doc_id, i, array_to_string(w[i:i+19], ' ') AS gram FROM (SELECT r, doc_id, w, unnest(range(1, len(w)-18)) AS i FROM d WHERE len(w) >= 20)),
 l AS (SELECT r, i FROM (SELECT r, i, row(doc_id, i) AS here, min(row(doc_id, i)) OVER (PARTITION BY gram) AS first FROM g) WHERE here > first),
 c AS (SELECT DISTINCT r, unnest(range(i, i+20)) AS j FROM l),
 x AS (SELECT r, unnest(w) AS word, unnest(range(1, len(w)+1)) AS j FROM d),
 k AS (SELECT r, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS kept FROM x ANTI JOIN c USING (r, j) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n,0))::BIGINT AS n_removed, sha256(coalesce(kept,'')) AS kept_sha256 FROM d LEFT JOIN k USING (r)"""

_KEPT = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _vector_codes(rounds: int = 4) -> str:
    """Every round as tables: a (the nearest entry of each part) and b (the entries), by exact integer distances."""
    near = """SELECT r, part, min(row(d, e)) AS hit FROM (SELECT p.r, p.part, b.e, list_sum(list_transform(list_zip(p.s, b.s), lambda z: (z[1]-z[2])*(z[1]-z[2])))::BIGINT AS d FROM p JOIN {b} b USING (part)) GROUP BY r, part"""
    steps = [
        f"k AS MATERIALIZED (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024*CAST(x AS DOUBLE)) AS BIGINT)) AS x, row_number() OVER (ORDER BY vec_id) - 1 AS r FROM embeddings WHERE {_KEPT})",
        "p AS MATERIALIZED (SELECT r, part, x[part*(len(x)//4)+1:(part+1)*(len(x)//4)] AS s FROM k, (SELECT unnest(range(4)) AS part))",
        "b0 AS MATERIALIZED (SELECT part, r AS e, s FROM p WHERE r < 256)",
    ]
    for i in range(rounds):
        steps.append(f"a{i} AS MATERIALIZED ({near.format(b=f'b{i}')})")
        steps.append(f"m{i} AS (SELECT part, e, list(v ORDER BY j) AS s FROM (SELECT part, e, j, CAST(floor(sum(v)::DOUBLE / count(*)) AS BIGINT) AS v FROM (SELECT a{i}.part, hit[2] AS e, unnest(s) AS v, unnest(range(1, len(s)+1)) AS j FROM a{i} JOIN p USING (r, part)) GROUP BY part, e, j) GROUP BY part, e)")
        steps.append(f"b{i + 1} AS MATERIALIZED (SELECT part, e, coalesce(m{i}.s, b{i}.s) AS s FROM b{i} LEFT JOIN m{i} USING (part, e))")
    steps.append(f"f AS ({near.format(b=f'b{rounds}')})")
    steps.append("c AS (SELECT r, string_agg(lower(printf('%02x', hit[2])), '' ORDER BY part) AS code, sum(hit[1])::BIGINT AS error FROM f GROUP BY r)")
    steps.append(f"h AS (SELECT sha256(string_agg(array_to_string(s, ','), ',' ORDER BY part, e)) AS sha FROM b{rounds})")
    return "WITH " + ",\n ".join(steps) + "\nSELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, sha AS codebooks_sha256 FROM k JOIN c USING (r), h"


VECTOR_DUPS = f"""WITH RECURSIVE v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label, embedding::DOUBLE[] AS x, {_KEPT} AND label IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0 AS ok FROM embeddings),
 u AS MATERIALIZED (SELECT r, vec_id, label, x, sqrt(list_dot_product(x, x)) AS size FROM v WHERE ok),
 l AS MATERIALIZED (SELECT a.r AS p, b.r AS q FROM u a JOIN u b ON a.label = b.label AND len(a.x) = len(b.x) AND a.r <> b.r WHERE list_dot_product(a.x, b.x) / (a.size * b.size) >= 0.98),
 w AS (SELECT r, r AS s FROM v UNION SELECT w.r, l.q FROM w JOIN l ON l.p = w.s)
SELECT v.vec_id, (SELECT count(*) FROM l WHERE l.p = v.r)::BIGINT AS n_links, c.least AS component_id, v.vec_id = c.least AS kept FROM v JOIN (SELECT w.r, min(t.vec_id) AS least FROM w JOIN v t ON t.r = w.s GROUP BY w.r) c USING (r)"""

SQL: dict[str, str] = {"op3_sharding": SHARDING, "op4_substrings": SUBSTRINGS, "op5_quality_rules": QUALITY, "op6_decontaminate": DECONTAMINATE, "op11_vector_codes": _vector_codes(), "op12_vector_dups": VECTOR_DUPS}
