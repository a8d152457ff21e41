"""The queries of this subpackage, with production parameters over whole tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revisio.llm import balltree, chat, images, langid, merkle, mixing, ngram, packing, secret_scan, simhash, store, toxicity, vafile
from revisio.plans.lineage import Scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    return chat.digests(turns.union(extra))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(_table(spark, sf_dir, "documents"), secret_scan.fit())


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op4_image_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables have no image column: each row of `embeddings` is rendered as one. A crop, a turn and an edit of one in fifty are added (ids under 0), so that there is something to find.

    Vectors are dealt anew before they are rendered: a few MB of them are minutes of work.
    """
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding").repartition(int(spark.conf.get("spark.sql.shuffle.partitions")))
    rendered = images.render_vectors(vectors, copied=F.col("vec_id") % 50 == 0)
    return images.copies(rendered, id_col="vec_id", image_col="image")


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digests(_table(spark, sf_dir, "documents"))


def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = store.write(_table(spark, sf_dir, "documents"), Scratch(spark, "token-store").path("store"))
    store.verify_recipes(spark, folder)
    return store.read(spark, folder)  # re-hashes every chunk


def op9_vafile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.fit(docs)
    threshold, model.threshold = model.threshold, 0.0  # each text with a letter gets a language here; `accepted` says what the calibrated rejection keeps
    return langid.predict(docs, model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", ((F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= threshold)).alias("accepted"))


def op11_ngram_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram.digests(_table(spark, sf_dir, "documents"))


def op12_ball_tree_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.digests(_table(spark, sf_dir, "embeddings"))


def _clusters_sql(k: int = 40, rounds: int = 5, dim: int = 64) -> str:
    """Two expressions for each round: whole numbers below 2**53 in doubles, sums and floors in integers."""
    far = "list_dot_product(v, v) - 2 * list_dot_product(v, c) + list_dot_product(c, c)"
    nearest = "a{r} AS MATERIALIZED (SELECT no, any_value(vec_id) AS vec_id, any_value(v) AS v, arg_min(cluster, (d, cluster)) AS cluster, min(d)::BIGINT AS distance FROM (SELECT *, {far} AS d FROM v, c{r}) GROUP BY no)"
    mean = """c{to} AS MATERIALIZED (SELECT c{r}.cluster, coalesce(m.c, c{r}.c) AS c FROM c{r} LEFT JOIN (SELECT cluster, list(((s - (s % n + n) % n) // n)::DOUBLE ORDER BY place) AS c
      FROM (SELECT cluster, place, sum(x::BIGINT)::BIGINT AS s, count(*) AS n FROM (SELECT cluster, unnest(v) AS x, unnest(range({dim})) AS place FROM a{r}) GROUP BY 1, 2) GROUP BY 1) m USING (cluster))"""
    parts = [
        f"v AS MATERIALIZED (SELECT row_number() OVER () AS no, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings WHERE len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0)",
        f"c0 AS MATERIALIZED (SELECT (row_number() OVER (ORDER BY sha256('2:' || vec_id), v) - 1)::INTEGER AS cluster, v AS c FROM v WHERE vec_id IS NOT NULL QUALIFY cluster < {k})",
    ]
    for r in range(rounds):
        parts += [nearest.format(r=r, far=far), mean.format(r=r, to=r + 1, dim=dim)]
    parts.append(nearest.format(r=rounds, far=far))
    return f"""WITH {', '.join(parts)} SELECT vec_id, cluster, distance, (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
  sha256(array_to_string(list_transform(c, lambda x: x::BIGINT::VARCHAR), ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} USING (cluster)"""


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digests(_table(spark, sf_dir, "documents"))


def _merkle_sql(levels: int = 14, over: int = 9) -> str:
    """One expression for each level of the sources' trees and of the tree over them; a tree that has one node stays as it is."""
    byte = "[ascii(x), -1, -1, -1, -1, -1, -1, -1, -1]"  # a byte of the decimal id goes in, then eight shifts
    shift = "CASE WHEN x >= 0 THEN xor(a, x::BIGINT) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END"
    crc = f"xor(list_reduce(flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda x: {byte})), lambda a, x: {shift}, 4294967295::BIGINT), 4294967295::BIGINT)"
    field = lambda value: f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"
    leaf = lambda text: f"sha256({' || '.join(map(field, ('doc_id', 'source', 'lang', 'n_chars', text)))})"
    parts = [
        f"d AS (SELECT doc_id, CASE WHEN source IS NULL THEN '' ELSE 's' || source END AS tree, {leaf('text')} AS leaf, CASE WHEN {crc} % 2 = 0 THEN {leaf("replace(text, chr(10), '')")} END AS other FROM documents)",
        "a0 AS (SELECT tree, leaf AS hash, doc_id, other, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM d)",
    ]
    grow = "{to} AS MATERIALIZED (SELECT tree, idx // 3 AS idx, (max(n) + 2) // 3 AS n, max(n) = 1 AS done, string_agg(hash, '' ORDER BY idx) AS pre, CASE WHEN max(n) = 1 THEN max(hash) ELSE sha256(string_agg(hash, '' ORDER BY idx)) END AS hash FROM {of} GROUP BY tree, idx // 3)"
    parts += [grow.format(to=f"a{k + 1}", of=f"a{k}") for k in range(levels)]
    parts.append(f"b0 AS (SELECT '' AS tree, tree AS name, hash, row_number() OVER (ORDER BY tree) - 1 AS idx, count(*) OVER () AS n FROM a{levels})")
    parts += [grow.format(to=f"b{k + 1}", of=f"b{k}") for k in range(over)]

    def climb(now: str, nodes: str, k: int, tree: str, idx: str) -> str:
        before, after = f"substr(pre, 1, 64 * ({idx} // {3**k} % 3)::INTEGER)", f"substr(pre, 64 * ({idx} // {3**k} % 3)::INTEGER + 65)"
        return f"SELECT p.* EXCLUDE (told, folded), CASE WHEN done THEN told ELSE told || {before} || {after} END AS told, CASE WHEN done THEN folded ELSE sha256({before} || folded || {after}) END AS folded FROM {now} p JOIN {nodes}{k + 1} x ON x.tree = {tree} AND x.idx = {idx} // {3 ** (k + 1)}"

    parts.append("p0 AS (SELECT a0.doc_id, a0.tree AS name, a0.hash AS leaf, a0.idx AS at, b0.idx AS place, b0.hash AS subroot, '' AS told, coalesce(a0.other, a0.hash) AS folded FROM a0 JOIN b0 ON b0.name = a0.tree)")
    parts += [f"p{k + 1} AS ({climb(f'p{k}', 'a', k, 'p.name', 'p.at')})" for k in range(levels)]
    parts += [f"p{levels + k + 1} AS ({climb(f'p{levels + k}', 'b', k, repr(''), 'p.place')})" for k in range(over)]
    return f"WITH {', '.join(parts)} SELECT doc_id, leaf, subroot, b{over}.hash AS root, sha256(told) AS proof_sha256, folded AS folded_root, folded = b{over}.hash AS verified FROM p{levels + over}, b{over}"


QUERIES = {f.__name__: f for f in (op1_chat_formatting, op2_secret_scan, op3_best_fit_packing, op4_image_copies, op5_simhash, op6_toxicity, op7_mixing, op8_token_store, op9_vafile, op10_language_id, op11_ngram_trie, op12_ball_tree_clusters, op13_merkle_manifest)}

SQL = {
    "op1_chat_formatting": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), e AS (
  SELECT *, length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')) + length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1\\\2\3', 'g')) + 17 AS chars FROM t
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars)::BIGINT AS formatted_chars, count(*) FILTER (role = 'assistant') AS n_examples
FROM e GROUP BY conv_id""",
    "op7_mixing": r"""
WITH d AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS src, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size, md5(coalesce(doc_id::VARCHAR, '')) AS key FROM documents
), s AS (
  SELECT src, sum(size)::BIGINT AS source_size FROM d GROUP BY src
), n AS (
  SELECT *, (row_number() OVER (ORDER BY src) - 1) % 3 + 1 AS weight FROM s
), r AS (
  SELECT *, (3 * source_size)::DOUBLE / weight AS full_at FROM n
), v AS (
  SELECT *, (sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER w, 0))::DOUBLE / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0))::DOUBLE AS level
  FROM r WINDOW w AS (ORDER BY full_at, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), l AS (
  SELECT arg_min(level, (full_at, level)) AS level FROM v WHERE level <= full_at
), g AS (
  SELECT src, source_size, least((3 * source_size)::DOUBLE, l.level * weight) AS target FROM r, l
), p AS (
  SELECT d.*, source_size, target, floor(target)::BIGINT AS budget,
    coalesce(sum(size) OVER (PARTITION BY src ORDER BY key, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS place
  FROM d JOIN g USING (src)
), q AS (
  SELECT *, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS passes FROM p
)
SELECT doc_id, size, source_size, target, (passes * size + least(size, greatest(0, budget - passes * source_size - place)))::BIGINT AS taken FROM q""",
    "op9_vafile": """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.v, c.v)::BIGINT AS score FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op12_ball_tree_clusters": _clusters_sql(),
    "op13_merkle_manifest": _merkle_sql(),
}
