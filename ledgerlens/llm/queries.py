"""The registered corpus queries: each applies one operator, with production
parameters, to its whole table. ``ORACLES`` holds DuckDB SQL where SQL can say
the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chaining, decontam, hard_negatives, line_dedup, merkle, mixing, packing, quality, simhash, suffix_dedup,
               token_output, topk, toxicity)
from .common import read

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle.strip()
        return fn
    return add


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").select("doc_id", "text")


@query("op2_exact_topk", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id,
         list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
WHERE rank <= 5
""")
def op2(spark, sf_dir):
    return topk.top_k(read(spark, sf_dir, "embeddings"), k=5, every=50)


def _decontam_sql() -> str:
    numbers, units = (", ".join(f"'{w}'" for w in x) for x in (decontam.NUMBER_WORDS, decontam.UNIT_WORDS))
    num = f"(({{0}} >= '0' AND {{0}} < ':') OR lower({{0}}) IN ({numbers}))"
    slots = "('<num>', '<unit>', '<name>')"
    code = f"""list_transform(tok, lambda t, i: CASE WHEN {num.format("t")} THEN '<num>'
        WHEN i > 1 AND {num.format("tok[i - 1]")} AND lower(t) IN ({units}) THEN '<unit>' {{0}} ELSE lower(t) END)"""
    name = "WHEN t <> lower(t) THEN '<name>'"
    tok = f"regexp_extract_all(coalesce(text, ''), '{decontam.TOKEN}') AS tok"
    return f"""
WITH d AS (SELECT doc_id, {tok} FROM documents),
b AS (SELECT item_id, {tok} FROM benchmark WHERE item_id IS NOT NULL),
bi AS (SELECT item_id, tok, least(len(tok), 12) AS need, greatest(5, least(len(tok), 12) - 2) AS w FROM b WHERE len(tok) >= 5),
bf AS (SELECT *, {code.format("")} AS c FROM bi UNION ALL SELECT *, {code.format(name)} FROM bi),
bk AS (SELECT DISTINCT item_id, need, w, ofs, win FROM (
    SELECT *, c[ofs + 1:ofs + w] AS win FROM (SELECT *, unnest(range(0, len(c) - w + 1)) AS ofs FROM bf))
  WHERE len(list_filter(win, lambda x: x NOT IN {slots})) >= 5),
ws AS (SELECT DISTINCT w FROM bk),
dc AS (SELECT doc_id, tok, {code.format("")} AS p, {code.format(name)} AS n FROM d),
bc AS (SELECT item_id, tok, need, {code.format("")} AS p, {code.format(name)} AS n FROM bi),
dw AS (SELECT doc_id, w, pos, c[pos + 1:pos + w] AS win
  FROM (SELECT dx.*, ws.w, unnest(range(0, greatest(0, len(c) - ws.w + 1))) AS pos
        FROM (SELECT doc_id, p AS c FROM dc UNION ALL SELECT doc_id, n FROM dc) dx, ws)),
l AS (SELECT DISTINCT doc_id, item_id, pos - ofs AS shift FROM dw JOIN bk USING (w, win)),
t AS (SELECT doc_id, item_id, shift, bc.need, i, coalesce(bc.p[i + 1] = dc.p[j + 1] OR (bc.n[i + 1] = '<name>' AND dc.n[j + 1] = '<name>'), false) AS ok,
    bc.n[i + 1] IN {slots} AS slot, lower(bc.tok[i + 1]) AS a, lower(dc.tok[j + 1]) AS z
  FROM (SELECT *, CASE WHEN i + shift >= 0 THEN i + shift ELSE 1000000000 END AS j
        FROM (SELECT l.*, unnest(range(0, len(bc.tok))) AS i FROM l JOIN bc USING (item_id))) x
  JOIN dc USING (doc_id) JOIN bc USING (item_id)),
g AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, item_id, shift ORDER BY i) AS island FROM t WHERE ok),
u AS (SELECT doc_id, item_id, shift, island, count(*) AS k, min(i) AS lo, any_value(need) AS need,
    coalesce(bool_or(a <> z) FILTER (slot), false) AS changed,
    count(DISTINCT (a, z)) FILTER (slot) AS nb, count(DISTINCT a) FILTER (slot) AS na, count(DISTINCT z) FILTER (slot) AS nz
  FROM g GROUP BY doc_id, item_id, shift, island),
r AS (SELECT *, nb = na AND nb = nz AS fits FROM u
  QUALIFY row_number() OVER (PARTITION BY doc_id, item_id, shift ORDER BY k DESC, lo) = 1 AND k >= need),
q AS (SELECT g.*, min(i) OVER p AS lo, max(i) OVER p AS hi FROM g SEMI JOIN (SELECT * FROM r WHERE NOT fits) c USING (doc_id, item_id, shift)
  WINDOW p AS (PARTITION BY doc_id, item_id, shift, island)),
x AS (SELECT y.doc_id, y.item_id, y.shift, y.i, max(v.i) + 1 AS after FROM q y JOIN q v USING (doc_id, item_id, shift, island)
  WHERE y.slot AND v.slot AND v.i < y.i AND (v.a = y.a) <> (v.z = y.z) GROUP BY ALL),
e AS (SELECT q.*, i + 1 - greatest(lo, coalesce(max(after) OVER p, 0)) AS part, greatest(lo, coalesce(max(after) OVER p, 0)) = lo AS whole,
    i + 1 - greatest(lo, max(CASE WHEN slot AND a <> z THEN i + 1 ELSE 0 END) OVER p) AS same
  FROM q LEFT JOIN x USING (doc_id, item_id, shift, i) WINDOW p AS (PARTITION BY doc_id, item_id, shift, island ORDER BY i)),
w AS (SELECT *, CASE WHEN part >= 24 OR (i = hi AND whole AND part >= need) THEN part WHEN same >= 13 THEN same ELSE 0 END AS size FROM e),
b1 AS (SELECT doc_id, item_id, shift, i + 1 AS upto, size FROM w WHERE size > 0
  QUALIFY row_number() OVER (PARTITION BY doc_id, item_id, shift ORDER BY size DESC, i) = 1),
parts AS (SELECT doc_id, item_id, shift, k, changed FROM r WHERE fits
  UNION ALL SELECT b1.doc_id, b1.item_id, b1.shift, size, coalesce(bool_or(a <> z) FILTER (slot), false)
  FROM b1 JOIN q USING (doc_id, item_id, shift) WHERE q.i < upto AND q.i >= upto - size GROUP BY b1.doc_id, b1.item_id, b1.shift, size)
SELECT doc_id, item_id, max(k)::BIGINT AS n_tokens, bool_and(changed) AS changed FROM parts GROUP BY doc_id, item_id
"""


@query("op3_decontamination", _decontam_sql())
def op3(spark, sf_dir):
    return decontam.contaminated(documents(spark, sf_dir), read(spark, sf_dir, "benchmark"))


@query("op5_token_output")
def op5(spark, sf_dir):
    return token_output.token_output(documents(spark, sf_dir), TOKENIZER, end_id=1)


@query("op6_packing")
def op6(spark, sf_dir):
    return packing.pack_documents(documents(spark, sf_dir), TOKENIZER, size=4096, end_id=1)


@query("op7_simhash")
def op7(spark, sf_dir):
    g = simhash.simhash_groups(documents(spark, sf_dir), words=3, radius=3)
    return g.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def id_crc(id_col: str = "doc_id"):
    """crc32 of the id written as text, the fold key of the two classifiers."""
    return F.crc32(F.col(id_col).cast("string").cast("binary"))


def _scored(df: DataFrame, held_out) -> DataFrame:
    return df.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                     F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"))


@query("op8_quality")
def op8(spark, sf_dir):
    held_out = id_crc() % 3 == 1
    return _scored(quality.quality_scores(documents(spark, sf_dir), read(spark, sf_dir, "labels"), held_out), held_out)


@query("op9_toxicity")
def op9(spark, sf_dir):
    held_out = id_crc() % 5 == 0
    return _scored(toxicity.toxicity_scores(documents(spark, sf_dir), read(spark, sf_dir, "labels"), held_out), held_out)


@query("op10_line_dedup", r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
k AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key FROM k WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*)::BIGINT AS n_lines, count(c.key)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (c.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN c USING (key) GROUP BY doc_id
""")
def op10(spark, sf_dir):
    d = line_dedup.line_dedup(documents(spark, sf_dir), min_docs=10, min_chars=1)
    return d.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


@query("op1_suffix_dedup")
def op1(spark, sf_dir):
    return suffix_dedup.suffix_dedup(documents(spark, sf_dir), length=100)


@query("op4_chaining")
def op4(spark, sf_dir):
    return chaining.repeated_passages(documents(spark, sf_dir), min_words=50, similarity=0.8)


def _sha_row(n_chars: str) -> str:
    one = "coalesce(strlen(({0})::VARCHAR)::VARCHAR || ':' || ({0})::VARCHAR, '-')"
    return f"sha256({' || '.join(one.format(c) for c in ('doc_id', 'source', 'lang', n_chars, 'text'))})"


_CRC = """xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ord(c)::BIGINT)),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda c, d: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295)"""


@query("op11_merkle_manifest", f"""
WITH RECURSIVE leaf AS (
  SELECT doc_id, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS g, {_sha_row('n_chars')} AS leaf,
         CASE WHEN {_CRC} % 7 = 0 AND n_chars IS NOT NULL THEN {_sha_row('n_chars + 1')} END AS changed FROM documents),
ranked AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                  count(*) OVER (PARTITION BY g) AS n FROM leaf),
t AS (SELECT g, 0 AS lev, pos, n, leaf AS h FROM ranked
  UNION ALL SELECT g, lev + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM t
            WHERE n > 1 GROUP BY g, lev, pos // 2, n),
sub AS (SELECT g, lev AS top, h AS subroot, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS lev, pos, n, subroot AS h FROM sub
  UNION ALL SELECT lev + 1, pos // 2, (n + 1) // 2, sha256(string_agg(h, '' ORDER BY pos)) FROM u
            WHERE n > 1 GROUP BY lev, pos // 2, n),
root AS (SELECT h AS root, lev AS top FROM u WHERE n = 1),
steps AS (
  SELECT r.g, r.pos, l.lev, CASE WHEN s.h IS NULL THEN 'N' WHEN (r.pos >> l.lev) % 2 = 0 THEN 'R' || s.h ELSE 'L' || s.h END AS step
  FROM ranked r JOIN sub USING (g) JOIN (SELECT unnest(range(0, 64)) AS lev) l ON l.lev < sub.top
  LEFT JOIN t s ON s.g = r.g AND s.lev = l.lev AND s.pos = xor(r.pos >> l.lev, 1)
  UNION ALL
  SELECT r.g, r.pos, sub.top + l.lev, CASE WHEN s.h IS NULL THEN 'N' WHEN (sub.pos >> l.lev) % 2 = 0 THEN 'R' || s.h ELSE 'L' || s.h END
  FROM ranked r JOIN sub USING (g) JOIN root ON true JOIN (SELECT unnest(range(0, 64)) AS lev) l ON l.lev < root.top
  LEFT JOIN u s ON s.lev = l.lev AND s.pos = xor(sub.pos >> l.lev, 1)),
path AS (SELECT g, pos, list(step ORDER BY lev) AS steps FROM steps GROUP BY g, pos)
SELECT doc_id, leaf, subroot, root, sha256(list_aggregate(list_transform(list_concat([''], coalesce(steps, [])), lambda x: substr(x, 2)), 'string_agg', ''))
         AS proof_sha256,
       list_reduce(list_concat([coalesce(changed, leaf)], coalesce(steps, [])), lambda acc, x: CASE x[1]
         WHEN 'N' THEN sha256(acc) WHEN 'R' THEN sha256(acc || substr(x, 2)) ELSE sha256(substr(x, 2) || acc) END) AS folded_root,
       folded_root = root AS verified
FROM ranked JOIN sub USING (g) JOIN root ON true LEFT JOIN path ON path.g = ranked.g AND path.pos = ranked.pos
""")
def op11(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    more = merkle.leaf_digest(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars").cast("decimal(20,0)") + 1, F.col("text"))
    changed = F.when((id_crc() % 7 == 0) & F.col("n_chars").isNotNull(), more)
    return merkle.audit(docs, changed=changed)


@query("op12_hard_negatives", """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL AND label IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
         list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
      QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)::INTEGER AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
""")
def op12(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", moved), every=50)


@query("op13_mixing", r"""
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         CASE WHEN text IS NULL THEN '-' ELSE '=' || md5(text) END AS m FROM documents),
src AS (SELECT *, (s % 3 + 1)::BIGINT AS w FROM (
  SELECT source, sum(size)::BIGINT AS z, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS s FROM sized GROUP BY source)),
cap AS (
  SELECT *, sum(z) OVER () AS whole, coalesce(sum(z) OVER a, 0) AS zb, sum(w) OVER () - coalesce(sum(w) OVER a, 0) AS wr
  FROM src WINDOW a AS (ORDER BY z / w, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
capped AS (SELECT *, 3 * z * wr < (whole - 3 * zb) * w AS stop FROM cap),
goal AS (
  SELECT s, source, z, CASE WHEN stop THEN (3 * z)::DOUBLE
      ELSE (max(whole) OVER () - 3 * coalesce(sum(z) FILTER (stop) OVER (), 0))::DOUBLE * w
           / (sum(w) FILTER (NOT stop) OVER ())::DOUBLE END AS target,
    greatest(ceil(z / 4096.0)::BIGINT, 1) AS nb FROM capped),
plan AS (SELECT *, CASE WHEN z > 0 THEN least(floor(target + 0.5)::BIGINT, 3 * z) // z ELSE 0 END AS e,
                CASE WHEN z > 0 THEN least(floor(target + 0.5)::BIGINT, 3 * z) % z ELSE 0 END AS rest FROM goal),
unit AS (
  SELECT *, md5('=17|=' || s || '|' || coalesce('=' || doc_id, '-') || '|=' || size || '|' || m || '|=' || cp) AS h FROM (
    SELECT sized.*, s, z, target, e, rest, nb, row_number() OVER (PARTITION BY doc_id, s, size, m) AS cp
    FROM sized JOIN plan ON sized.source IS NOT DISTINCT FROM plan.source)),
cut AS (SELECT *, (('0x' || substr(h, 1, 8))::BIGINT * nb) >> 32 AS block FROM unit),
blocks AS (
  SELECT s, block, rest, sum(size)::BIGINT AS words, md5('=17|=' || s || '|=' || e || '|=' || block) AS bh
  FROM cut WHERE size > 0 GROUP BY s, block, rest, e),
given AS (
  SELECT s, block, least(words, greatest(0, rest - coalesce(sum(words) OVER (
    PARTITION BY s ORDER BY bh ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))) AS given FROM blocks)
SELECT doc_id, size, z AS source_size, target, (e * size + greatest(0, least(size, coalesce(given, 0) - coalesce(sum(size) OVER (
    PARTITION BY s, block ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))))::BIGINT AS taken
FROM cut LEFT JOIN given USING (s, block)
""")
def op13(spark, sf_dir):
    return mixing.mix_documents(read(spark, sf_dir, "documents"))
