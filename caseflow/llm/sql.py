"""DuckDB SQL that checks the operators on context trees, vector codes and spelling variants."""

from __future__ import annotations

LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def crc32(text: str) -> str:
    """The unsigned CRC-32 of a text's UTF-8 bytes, byte by byte and bit by bit."""
    byte = "list_reduce(list_concat([CAST(xor(c, b) AS BIGINT)], [0, 0, 0, 0, 0, 0, 0, 0]), lambda x, z: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(range(0, strlen({text})), lambda i: CAST('0x' || substr(hex({text}), 2 * i + 1, 2) AS BIGINT))"
    step = byte.replace("xor(c, b)", "xor(c & 255, b)")
    return f"xor(list_reduce(list_concat([4294967295], {codes}), lambda c, b: xor(c >> 8, {step})), 4294967295)"


def _context_tree(depth: int = 4) -> str:
    estimate = (
        "CASE WHEN zeros + ones = 0 THEN 0 ELSE lgamma(zeros + 0.5) + lgamma(ones + 0.5) - lgamma(zeros + ones + 1.0) - ln(pi()) END"
    )
    stop, total = "exp(own - mixed - ln(2))", "(zeros + ones + 1)"
    levels = [f"l{depth} AS (SELECT *, own AS mixed FROM (SELECT *, {estimate} AS own FROM (SELECT context, node, "
              "sum(CASE WHEN bit = 0 THEN n ELSE 0 END) AS zeros, sum(CASE WHEN bit = 1 THEN n ELSE 0 END) AS ones FROM dec GROUP BY ALL)))"]
    for d in range(depth - 1, -1, -1):
        levels.append(
            f"l{d} AS (SELECT * EXCLUDE (below), greatest(own, below) + ln(1 + exp(-abs(own - below))) - ln(2) AS mixed FROM "
            f"(SELECT *, {estimate} AS own FROM (SELECT {f'right(context, {2 * d})' if d else chr(39) * 2} AS context, node, "
            f"sum(zeros) AS zeros, sum(ones) AS ones, sum(mixed) AS below FROM l{d + 1} GROUP BY ALL)))"
        )
    levels.append(f"d0 AS (SELECT context, node, {stop} * (zeros + 0.5) / {total} AS p0, {stop} * (ones + 0.5) / {total} AS p1, 1 - {stop} AS rest FROM l0)")
    for d in range(1, depth + 1):
        own = stop if d < depth else "1.0"
        parent = f"right(l.context, {2 * d - 2})" if d > 1 else "''"
        levels.append(
            f"d{d} AS (SELECT l.context, l.node, p0 + rest * {own} * (zeros + 0.5) / {total} AS p0, p1 + rest * {own} * (ones + 0.5) / {total} AS p1, "
            f"rest * (1 - {own}) AS rest FROM l{d} l JOIN d{d - 1} u ON u.context = {parent} AND u.node = l.node)"
        )
    low, size = LOWER.format("coalesce(text, '')"), 2 * depth
    return rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {low} AS t, coalesce(CAST(doc_id AS VARCHAR), '') AS name FROM documents),
docs AS (SELECT r, doc_id, {crc32("name")} % 7 = 2 AS held_out, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
                repeat('FF', {depth}) || hex(t) || 'FF' AS h FROM d),
pos AS (SELECT r, run, count(*) AS n FROM (SELECT r, substr(h, 2 * unnest(range(1, len(h) // 2 - {depth} + 1)) - 1, {size + 2}) AS run FROM docs) GROUP BY ALL),
runs AS (SELECT run, CAST(sum(CASE WHEN held_out THEN 0 ELSE n END) AS BIGINT) AS n FROM pos JOIN docs USING (r) GROUP BY run),
dec AS (SELECT run, n, left(run, {size}) AS context, CAST('0x' || right(run, 2) AS BIGINT) AS byte, unnest(range(0, 8)) AS k FROM runs),
dec_ AS (SELECT run, n, context, (1 << k) | (byte >> (8 - k)) AS node, (byte >> (7 - k)) & 1 AS bit FROM dec),
{", ".join(levels).replace("FROM dec GROUP", "FROM dec_ GROUP")},
vals AS (SELECT run, sum(ln(CASE WHEN bit = 0 THEN p0 ELSE p1 END)) / ln(10) AS v FROM dec_ JOIN d{depth} USING (context, node) GROUP BY run),
scores AS (SELECT r, sum(n * v) AS score FROM pos JOIN vals USING (run) GROUP BY r),
tok AS (SELECT r, held_out, unnest(list_append(ws, chr(0))) AS w FROM docs),
cnt AS (SELECT w, count(*) AS c FROM tok WHERE NOT held_out GROUP BY w),
tot AS (SELECT CAST(coalesce(sum(c), 0) AS BIGINT) AS total, count(*) AS kinds FROM cnt),
base AS (SELECT r, CAST(count(*) AS BIGINT) AS n_tokens, CAST(count(c) AS BIGINT) AS n_known,
                sum(log10((coalesce(c, 0) + 1) / (total + kinds + 1))) AS b FROM tok LEFT JOIN cnt USING (w), tot GROUP BY r)
SELECT doc_id, held_out, n_tokens, n_known, total AS train_tokens, round(b, 6) AS base_score, round(score, 4) AS score
FROM docs JOIN base USING (r) JOIN scores USING (r), tot"""


def _vector_codes(rounds: int = 6) -> str:
    distance = "CAST(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT)"
    steps = []
    for k in range(rounds + 1):
        steps.append(f"a{k} AS (SELECT r, part, min({distance} * 16 + e) AS best FROM p JOIN b{k} USING (part) GROUP BY r, part)")
        if k < rounds:
            steps.append(
                f"s{k} AS (SELECT part, e, i, sum(x[i]) AS s, count(*) AS n FROM (SELECT part, best % 16 AS e, x, unnest(range(1, len(x) + 1)) AS i "
                f"FROM a{k} JOIN p USING (r, part)) GROUP BY ALL), "
                f"m{k} AS (SELECT part, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM s{k} GROUP BY part, e), "
                f"b{k + 1} AS (SELECT part, e, coalesce(m{k}.c, b{k}.c) AS c FROM b{k} LEFT JOIN m{k} USING (part, e))"
            )
    return f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r, vec_id, label,
                     list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
              WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
p AS (SELECT r, part, v[part * (len(v) // 8) + 1:(part + 1) * (len(v) // 8)] AS x FROM (SELECT r, v, unnest(range(0, 8)) AS part FROM kept)),
b0 AS (SELECT part, r - 1 AS e, x AS c FROM p WHERE r <= 16),
{", ".join(steps)},
coded AS (SELECT r, string_agg(lpad(lower(to_hex(best % 16)), 2, '0'), '' ORDER BY part) AS code, CAST(sum(best // 16) AS BIGINT) AS error
          FROM a{rounds} GROUP BY r),
book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, e)) AS digest FROM b{rounds})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, digest AS codebooks_sha256
FROM kept JOIN coded USING (r), book"""


def _spelling_variants() -> str:
    return rf"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS name, {LOWER.format("unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{7,}'))")} AS run FROM documents),
hashed AS (SELECT name, run, count(*) AS n, name || ':' || run AS named FROM runs GROUP BY name, run),
crc AS (SELECT run, n, {crc32("named")} AS h FROM hashed),
damaged AS (SELECT n, CASE WHEN h % 31 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM crc),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM damaged WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
gone AS (SELECT word, n, length(word) AS size, i, left(word, i) || substr(word, i + 2) AS rest
         FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
near AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM gone a JOIN gone b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
         UNION SELECT a.word, a.n, b.word, b.n FROM gone a JOIN words b ON a.rest = b.word
         UNION SELECT b.word, b.n, a.word, a.n FROM gone a JOIN words b ON a.rest = b.word),
best AS (SELECT word, n, CAST(count(*) AS BIGINT) AS n_near, max(other_n) AS m,
                min(CASE WHEN other_n = top THEN other END) AS other
         FROM (SELECT *, max(other_n) OVER (PARTITION BY word) AS top FROM near) GROUP BY word, n),
told AS (SELECT words.word, words.n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 10 * words.n THEN other END AS form,
                CASE WHEN m >= 10 * words.n THEN m END AS form_n FROM words LEFT JOIN best ON words.word = best.word),
walk AS (SELECT word, word AS reached, 0 AS steps FROM told UNION ALL
         SELECT walk.word, form, steps + 1 FROM walk JOIN told ON walk.reached = told.word WHERE form IS NOT NULL),
roots AS (SELECT word, arg_max(reached, steps) AS root FROM walk GROUP BY word)
SELECT word, n, n_near, form, form_n, root FROM told JOIN roots USING (word)"""


CONTEXT_TREE = _context_tree()
VECTOR_CODES = _vector_codes()
SPELLING_VARIANTS = _spelling_variants()
