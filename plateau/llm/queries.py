"""The thin queries: each reads its whole table, runs its operator with production parameters
and derives the columns of its contract."""

from __future__ import annotations

import string
import zlib

from pyspark.sql import functions as F

from plateau.llm.common import table
from plateau.llm.registry import query

_WS = r"[\x20\x09-\x0D]"
_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_UPPER, _LOWER = string.ascii_uppercase, string.ascii_lowercase


@query("op3_exact_dedup", sql=rf"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '{_WS}', '', 'g')) AS text_sha256 FROM documents),
r AS (
  SELECT *, row_number() OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS rn,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, rn = 1 AS kept, text_sha256 FROM r
""")
def op3(spark, sf_dir):
    from plateau.llm.exact_dedup import exact_groups
    return exact_groups(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


@query("op9_mixing")
def op9(spark, sf_dir):
    from plateau.llm.mixing import mix_plan
    return mix_plan(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", "taken", "source")


@query("op10_toxicity")
def op10(spark, sf_dir):
    from plateau.llm import toxicity
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"))).withColumnRenamed("id", "doc_id")


@query("op6_collision_ann")
def op6(spark, sf_dir):
    from plateau.llm.collision_ann import nearest
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query("op7_page_difference")
def op7(spark, sf_dir):
    from plateau.llm.page_diff import extract
    return extract(table(spark, sf_dir, "pages"))


@query("op2_license_scan")
def op2(spark, sf_dir):
    from plateau.llm.licenses import scan_licenses
    return scan_licenses(table(spark, sf_dir, "documents"))


@query("op8_class_lm")
def op8(spark, sf_dir):
    from plateau.llm.class_lm import score_documents
    return score_documents(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), F.col("held").alias("held_out"), "n_tokens", "n_known", "train_tokens",
        F.col("base").alias("base_score"), "score")


@query("op5_order_minhash")
def op5(spark, sf_dir):
    from plateau.llm.order_minhash import near_classes
    return near_classes(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "class_id", "class_size", "n_links", "kept")


@query("op1_pii")
def op1(spark, sf_dir):
    from plateau.llm.pii import digest, find_pii
    return digest(find_pii(table(spark, sf_dir, "documents")))


@query("op4_sampled_pieces")
def op4(spark, sf_dir):
    from plateau.llm.piece_sampling import sample_segmentations
    return sample_segmentations(table(spark, sf_dir, "documents"))


@query("op11_decontaminate", sql=rf"""
WITH d AS (
  SELECT row_number() OVER () AS uid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS ws
  FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '{_WORD}') AS ws FROM benchmark),
placed AS (SELECT item_id, ws, least(10, len(ws)) AS n, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS p FROM i WHERE len(ws) > 0),
win AS MATERIALIZED (SELECT DISTINCT item_id, n, array_to_string(ws[p:p + n - 1], ' ') AS window_text FROM placed),
seen AS (SELECT uid, n, ws, unnest(range(1, len(ws) - n + 2)) AS p FROM d, (SELECT DISTINCT n FROM win) WHERE len(ws) >= n),
hit AS MATERIALIZED (
  SELECT s.uid, s.n, s.p, w.item_id FROM (SELECT uid, n, p, array_to_string(ws[p:p + n - 1], ' ') AS window_text FROM seen) s
  JOIN win w ON s.n = w.n AND s.window_text = w.window_text),
inside AS (SELECT DISTINCT uid, unnest(range(p, p + n)) AS word FROM hit),
n_hits AS (SELECT uid, count(*) AS n_hit FROM inside GROUP BY uid),
found AS (
  SELECT uid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT uid, item_id::VARCHAR AS item FROM hit WHERE item_id IS NOT NULL) GROUP BY uid)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n_hits USING (uid) LEFT JOIN found USING (uid)
""")
def op11(spark, sf_dir):
    from plateau.llm.decontaminate import digest, scan
    return digest(scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")))


def periodic_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The contract's change to the words of one document in ten: from a place on, its words repeat. A document without id
    is left as it is."""
    n, h = len(words), zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    if doc_id is None or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    root = words[a:a + p]
    return words[:a] + (root * (-(-(n - a) // p)))[:n - a]


@query("op12_runs", sql=rf"""
WITH d AS (
  SELECT row_number() OVER () AS uid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(str_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                         lambda x, b: list_reduce(list_prepend(xor(x, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                                                  lambda y, z: xor(y >> 1, (y & 1) * 3988292384))), 4294967295::BIGINT) AS h
  FROM documents),
g AS (SELECT uid, doc_id, ws, len(ws) AS n, h % 10 AS h10, h // 10 AS g FROM d),
a AS (SELECT *, CASE WHEN h10 = 0 AND n > 0 THEN g % n END AS a FROM g),
p AS (SELECT *, 1 + (n - a) // (3 + g % 8) AS p FROM a),
word AS MATERIALIZED (
  SELECT uid, i, CASE WHEN a IS NULL OR i < a THEN ws[i + 1] ELSE ws[a + (i - a) % p + 1] END AS w, n
  FROM (SELECT *, unnest(range(n)) AS i FROM p)),
same AS (SELECT x.uid, y.i - x.i AS q, x.i FROM word x JOIN word y ON x.uid = y.uid AND x.w = y.w AND x.i < y.i AND 3 * (y.i - x.i) <= x.n),
block AS (SELECT uid, q, i, i - row_number() OVER (PARTITION BY uid, q ORDER BY i) AS b FROM same),
stretch AS (SELECT uid, q, min(i) AS s, count(*) + q AS m FROM block GROUP BY uid, q, b HAVING count(*) + q >= greatest(24, 3 * q)),
run AS MATERIALIZED (SELECT uid, s, m, min(q) AS q FROM stretch GROUP BY uid, s, m),
top AS (
  SELECT uid, s, m, q FROM run QUALIFY row_number() OVER (PARTITION BY uid ORDER BY m::DOUBLE / q DESC, s, q) = 1),
listed AS (SELECT uid, count(*) AS n_runs, string_agg(s || ',' || m || ',' || q || chr(10), '' ORDER BY s, q) AS lines FROM run GROUP BY uid),
gone AS (SELECT DISTINCT uid, unnest(range(s + q, s + m)) AS i FROM run),
kept AS (SELECT uid, string_agg(w, ' ' ORDER BY i) AS t FROM word ANTI JOIN gone USING (uid, i) GROUP BY uid)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, m::BIGINT AS length, q::BIGINT AS period,
       (1000 * m // q)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(t, '')) AS collapsed_sha256
FROM d LEFT JOIN top USING (uid) LEFT JOIN listed USING (uid) LEFT JOIN kept USING (uid)
""")
def op12(spark, sf_dir):
    from plateau.llm.runs import digest, find_runs
    return digest(find_runs(table(spark, sf_dir, "documents"), rewrite=periodic_tail))


def _lloyd_sql(rounds: int) -> str:
    """Rounds of full searches, one after another: near<r> has every vector's centroid in c<r>, the next c the means."""
    near = """near{r} AS MATERIALIZED (
  SELECT k.rid, c.j, list_sum(list_transform(list_zip(k.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d
  FROM kept k, c{r} c QUALIFY row_number() OVER (PARTITION BY k.rid ORDER BY d, c.j) = 1)"""
    mean = """sum{n} AS (SELECT j, i, sum(x)::BIGINT AS s, count(*) AS m FROM (
    SELECT j, unnest(v) AS x, unnest(range(64)) AS i FROM near{r} JOIN kept USING (rid)) GROUP BY j, i),
mean{n} AS (SELECT j, list((s - ((s % m + m) % m)) // m ORDER BY i) AS v FROM sum{n} GROUP BY j),
c{n} AS MATERIALIZED (SELECT c.j, coalesce(m.v, c.v) AS v FROM c{r} c LEFT JOIN mean{n} m USING (j))"""
    steps = [near.format(r=r) + ("," + mean.format(r=r, n=r + 1) if r < rounds else "") for r in range(rounds + 1)]
    return ",\n".join(steps)


@query("op13_centroid_clusters", sql=rf"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id::VARCHAR), v) - 1 AS j, v FROM kept QUALIFY j < 16),
{_lloyd_sql(3)},
part AS (SELECT j, sum(d)::BIGINT AS cluster_inertia FROM near3 GROUP BY j)
SELECT vec_id, j::INTEGER AS cluster, d AS distance, cluster_inertia, (SELECT sum(d)::BIGINT FROM near3) AS inertia,
       sha256(array_to_string(c3.v, ',')) AS centroid_sha256
FROM near3 JOIN kept USING (rid) JOIN part USING (j) JOIN c3 USING (j)
""")
def op13(spark, sf_dir):
    from plateau.llm.centroid_clusters import cluster, digest
    found, history = cluster(table(spark, sf_dir, "embeddings"))
    return digest(found, history[-1])
