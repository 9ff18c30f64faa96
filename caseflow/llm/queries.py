"""Registered queries of this subpackage, next to the SQL that checks them where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from caseflow.llm import context_tree, decontaminate, language, licenses, mixing, neardup, neighbours, orchard, packing, pii, secrets, spelling, sql, toxicity
from caseflow.llm.tables import table

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
END_OF_TEXT = 50256


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(table(spark, sf_dir, "documents"))


def op4_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.report(table(spark, sf_dir, "documents"))


def op6_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), VOCABULARY, pad_id=END_OF_TEXT)


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.report(table(spark, sf_dir, "embeddings"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), size=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(table(spark, sf_dir, "documents"))


def op10_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(table(spark, sf_dir, "documents"))


def op11_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return context_tree.report(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orchard.report(table(spark, sf_dir, "embeddings"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mixing": op1_mixing,
    "op2_near_duplicates": op2_near_duplicates,
    "op3_language": op3_language,
    "op4_licenses": op4_licenses,
    "op5_secrets": op5_secrets,
    "op6_token_packing": op6_token_packing,
    "op7_neighbours": op7_neighbours,
    "op8_toxicity": op8_toxicity,
    "op9_decontamination": op9_decontamination,
    "op10_personal_data": op10_personal_data,
    "op11_context_tree": op11_context_tree,
    "op12_vector_codes": op12_vector_codes,
    "op13_spelling_variants": op13_spelling_variants,
}

#: Words of a text, A-Z in lower case; DuckDB's lower() would also change other letters.
SQL_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SQL_WORDS = "regexp_extract_all(" + SQL_LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"



def _sql_seeded(*parts: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws(':', 'mix', {', '.join(parts)})), 1, 15) AS BIGINT)"


def _sql_apportion(name: str, source: str, group: str, tie: str, weight: str, seats: str) -> str:
    """Sainte-Lague seats as ``got`` in a CTE ``name``; all seats by their quotients, from rounded shares on."""
    return f"""
{name}_a AS (SELECT *, sum({weight}) OVER g AS w_, count(*) OVER g AS n_, floor({seats} * {weight} / sum({weight}) OVER g + 0.5) AS base
             FROM {source} WINDOW g AS (PARTITION BY {group})),
{name}_b AS (SELECT *, max({seats}) OVER g - sum(base) OVER g AS open_ FROM {name}_a WINDOW g AS (PARTITION BY {group})),
{name}_c AS (SELECT *, unnest(range(1, CAST(CASE WHEN open_ > 0 THEN n_ + open_ ELSE least(n_ - open_, base) END AS BIGINT) + 1)) AS k
             FROM {name}_b WHERE open_ <> 0),
{name}_d AS (SELECT {group}, {tie}, sign(open_) AS step, row_number() OVER (PARTITION BY {group} ORDER BY
               CASE WHEN open_ > 0 THEN -{weight} / (2 * base + 2 * k - 1) ELSE {weight} / (2 * base - 2 * k + 1) END, sign(open_) * {tie}, k) AS place, abs(open_) AS most
             FROM {name}_c),
{name} AS (SELECT b.*, base + coalesce((SELECT sum(step) FROM {name}_d x WHERE x.{group} = b.{group} AND x.{tie} = b.{tie} AND place <= most), 0) AS got
           FROM {name}_b b)"""


ORACLES: dict[str, str] = {
    "op1_mixing": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source,
                  CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
src AS (SELECT source, CAST(sum(size) AS BIGINT) AS s, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS sid FROM d GROUP BY source),
o AS (SELECT *, CASE sid % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS w FROM src),
p AS (SELECT *, sum(s) OVER () AS t, sum(w) OVER () AS ww, coalesce(sum(3 * s) OVER b, 0) AS full_, coalesce(sum(w) OVER b, 0) AS gone
      FROM o WINDOW b AS (ORDER BY 3.0 * s / w, sid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, w * CAST(t - full_ AS DOUBLE) / CAST(ww - gone AS DOUBLE) > 3 * s AS capped FROM p),
l AS (SELECT t - full_ AS left_, ww - gone AS open_ FROM c WHERE NOT capped ORDER BY full_, gone LIMIT 1),
tg AS (SELECT sid, source, s, CASE WHEN capped THEN CAST(3 * s AS DOUBLE) ELSE w * CAST(left_ AS DOUBLE) / CAST(open_ AS DOUBLE) END AS target,
              0 AS one, CAST((t + 8) // 16 AS BIGINT) AS seats FROM c, l),
{_sql_apportion("bs", "tg", "one", "sid", "target", "seats")},
pl AS (SELECT r, doc_id, size, sid, got, {_sql_seeded("coalesce(CAST(doc_id AS VARCHAR), '')")} AS h,
              greatest(1, CAST(ceil(s / 65536) AS BIGINT)) AS shards FROM d JOIN bs ON d.source IS NOT DISTINCT FROM bs.source),
ps AS (SELECT *, h % shards AS shard FROM pl),
sh AS (SELECT sid, shard, CAST(sum(size) AS BIGINT) AS words, max(got) AS blocks FROM ps GROUP BY sid, shard),
{_sql_apportion("q", "sh", "sid", "shard", "words", "blocks")},
qq AS (SELECT sid, shard, words, CAST(least(got * 16, 3 * words) AS BIGINT) AS ask,
              ({_sql_seeded("sid", "shard")} // 16) % greatest(1, (words + 15) // 16) * 16 AS start FROM q),
st AS (SELECT ps.*, words, ask, start, ask - ask // words * words AS rest,
              CAST(sum(size) OVER (PARTITION BY sid, shard ORDER BY h, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS e
       FROM ps JOIN qq USING (sid, shard))
SELECT doc_id, size, tg.s AS source_size, target,
       CAST(CASE WHEN words > 0 THEN ask // words * size ELSE 0 END
            + greatest(0, least(start + rest, words, e) - greatest(start, e - size))
            + greatest(0, least(start + rest - words, e) - greatest(0, e - size)) AS BIGINT) AS taken
FROM st JOIN tg USING (sid)""",
    "op2_near_duplicates": rf"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({SQL_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT r, array_to_string(ws[i:i + 2], ' ') AS sh
      FROM (SELECT r, ws, unnest(range(1, greatest(1, len(ws) - 2) + 1)) AS i FROM d WHERE len(ws) > 0)),
named AS (SELECT r, doc_id, count(sh) AS n, md5(coalesce(string_agg(sh, '|' ORDER BY sh), '')) AS name
          FROM d LEFT JOIN s USING (r) GROUP BY r, doc_id),
node AS (SELECT name, n, min(doc_id) AS id, min(r) AS r FROM named WHERE n > 0 GROUP BY name, n),
ns AS (SELECT id, n, sh FROM node JOIN s USING (r)),
near AS (SELECT a.id AS a, b.id AS b FROM ns a JOIN ns b ON a.sh = b.sh AND a.id <> b.id
         GROUP BY a.id, b.id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach(id, c) AS (SELECT id, id FROM node UNION SELECT near.b, reach.c FROM reach JOIN near ON near.a = reach.id),
comp AS (SELECT id, min(c) AS c FROM reach GROUP BY id)
SELECT doc_id, CAST(named.n AS BIGINT) AS n_shingles, coalesce(c, doc_id) AS component_id,
       doc_id = coalesce(c, doc_id) AS kept
FROM named LEFT JOIN node ON named.name = node.name AND named.n = node.n LEFT JOIN comp USING (id)""",
    "op4_licenses": rf"""
WITH t(n, label, words) AS (VALUES {", ".join(f"({n}, '{label}', list_distinct(string_split('{words}', ' ')))" for n, (label, words) in enumerate(licenses.TEMPLATES))}),
tw AS (SELECT n, label, len(words) AS size, unnest(words) AS w FROM t),
d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {SQL_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
bw AS (SELECT r, b, unnest(list_distinct(regexp_extract_all(lower(lines[b]), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'))) AS w
       FROM (SELECT r, lines, unnest(range(1, len(lines) + 1)) AS b FROM (SELECT r, string_split(text, chr(10)) AS lines FROM d))),
m AS (SELECT r, label, count(*) / size AS c FROM bw JOIN tw USING (w) GROUP BY r, b, n, label, size HAVING count(*) >= ceil(80 * size / 100)),
p AS (SELECT r, 'mit' AS label, unnest(range(1, len(ws))) AS i, 2 AS n FROM d WHERE len(ws) > 1 UNION ALL
      SELECT r, 'apache', unnest(range(1, len(ws))), 2 FROM d WHERE len(ws) > 1 UNION ALL
      SELECT r, 'gpl', unnest(range(1, len(ws) - 1)), 3 FROM d WHERE len(ws) > 2),
places AS (SELECT r, p.label, i - 1 AS i FROM p JOIN d USING (r) WHERE array_to_string(ws[i:i + n - 1], ' ') =
           CASE p.label WHEN 'mit' THEN 'mit license' WHEN 'apache' THEN 'apache license' ELSE 'general public license' END),
base AS (SELECT r, count(*) AS n, min(i) AS a, max(i) AS z, string_agg(DISTINCT label, ',' ORDER BY label) AS labels FROM places GROUP BY r),
al AS (SELECT r, string_agg(label, ',' ORDER BY label) AS labels
       FROM (SELECT r, label FROM places UNION SELECT r, label FROM m) GROUP BY r),
best AS (SELECT r, max(c) AS c FROM m GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_base, CAST(a AS BIGINT) AS first_word,
       CAST(z AS BIGINT) AS last_word, coalesce(base.labels, '') AS base_labels, coalesce(al.labels, '') AS labels,
       CASE WHEN n > 0 THEN 1.0::DOUBLE ELSE coalesce(c, 0)::DOUBLE END AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN al USING (r) LEFT JOIN best USING (r)""",
    "op9_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {SQL_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
i AS (SELECT item_id, {SQL_WORDS.format("text")} AS ws FROM benchmark WHERE item_id IS NOT NULL AND text IS NOT NULL),
iw AS (SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[s:s + least(10, len(ws)) - 1], ' ') AS win
       FROM (SELECT *, unnest(range(1, greatest(1, len(ws) - 9) + 1)) AS s FROM i WHERE len(ws) > 0)),
lengths AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT r, s, n, array_to_string(ws[s:s + n - 1], ' ') AS win
       FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS s FROM d, lengths WHERE len(ws) >= n)),
found AS (SELECT r, s, dw.n, item_id FROM dw JOIN iw USING (n, win)),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + n)) AS p FROM found) GROUP BY r),
items AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
          FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN items USING (r)""",
    "op11_context_tree": sql.CONTEXT_TREE,
    "op12_vector_codes": sql.VECTOR_CODES,
    "op13_spelling_variants": sql.SPELLING_VARIANTS,
}
