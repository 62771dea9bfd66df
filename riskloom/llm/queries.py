"""The operators over the driver tables, one query each, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import byte_bpe, chat, divergence, hamming, hnsw, jaccard, licenses, merkle, mixing, quality, repeats, secrets, toxicity


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_hnsw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every 20th embedding by inner product."""
    rows = table(spark, sf_dir, "embeddings")
    return hnsw.nearest(rows, rows.where("vec_id % 20 = 0"), "vec_id", "embedding", 20)


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases of every document, and the labels that ordered rules add."""
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    base_labels = F.transform("base", lambda b: b.label)
    labels = F.array_union(base_labels, F.transform("detections", lambda d: d.label))
    starts = F.transform("base", lambda b: b.start)
    return found.select(
        "doc_id",
        "n_words",
        F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base_labels)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("labels"),
        F.coalesce(
            F.array_max(F.transform("detections", lambda d: d.confidence)),
            F.when(F.size("base") > 0, 0.5).otherwise(0.0),
        ).alias("score"),
    )


def _span_list(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s.kind, s.start, s.end)), ",")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document: those of fixed patterns, and what the character network adds."""
    docs = table(spark, sf_dir, "documents")
    found = secrets.find_secrets(docs, secrets.train(docs))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[count(kind) for kind in ("assign", "access", "hex")],
        F.sha2(_span_list("base").cast("binary"), 256).alias("base_sha256"),
        _span_list("spans").alias("spans"),
    )


def op4_hamming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest sign codes of every 50th embedding."""
    codes = hamming.sign_codes(table(spark, sf_dir, "embeddings"), "vec_id", "embedding")
    return hamming.nearest_codes(codes, codes.where("id % 50 = 0"), 10)


OP4_SQL = """
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, CAST(distance AS INTEGER) AS distance
FROM (
  SELECT q.vec_id AS query_id, v.vec_id, d.distance,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY d.distance, v.vec_id) AS rank
  FROM embeddings q JOIN embeddings v
    ON q.vec_id % 50 = 0 AND q.vec_id <> v.vec_id AND len(q.embedding) = len(v.embedding),
  LATERAL (SELECT list_sum([CASE WHEN (q.embedding[i] > 0) <> (v.embedding[i] > 0) THEN 1 ELSE 0 END
                            FOR i IN range(1, len(q.embedding) + 1)]) AS distance) d
) WHERE rank <= 10
"""


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A mix of the sources by weights 5, 2, 1, of half as many words again as there are."""
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("times") * F.col("size")).alias("taken"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels that aren't held out."""
    docs = table(spark, sf_dir, "documents")
    network = toxicity.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, network)
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every text under the public 50k multilingual ranks, and what they decode to."""
    import public_tokenizers

    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    docs = table(spark, sf_dir, "documents")
    return byte_bpe.round_trip(docs, ranks, public_tokenizers.PATTERN).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op8_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose five-word shingles overlap by three quarters."""
    return jaccard.similar_components(table(spark, sf_dir, "documents"))


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations rebuilt from their logs, rendered with a loss mask and read back."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    read = chat.read_back(chat.render(chat.fold(chat.log_of(rows.unionByName(probe)))))
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return read.withColumn("_loss", F.array_join("loss_texts", "")).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(turns, "UTF-8"), 256).alias("turns_sha256"),
        F.length("_loss").cast("long").alias("loss_chars"),
        F.sha2(F.encode("_loss", "UTF-8"), 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the passages of 35 words or more that repeat."""
    out = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    kept = F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256")
    return out.select("doc_id", "n_words", "n_removed", kept)


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document by a vote of its nearest labelled neighbours."""
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    scored = quality.score(docs, model)
    return scored.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each source's words are from its language's and from those of its other sources."""
    return divergence.audit_sources(table(spark, sf_dir, "documents"))


OP12_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms
  FROM documents
), words AS (SELECT row, lang, source, unnest(terms) AS term FROM docs),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT row) >= 10),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
groups AS (SELECT DISTINCT lang, source FROM docs),
v AS (SELECT lang, count(term) AS v FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN kept USING (lang) GROUP BY lang),
totals AS (
  SELECT lang, source, coalesce(sum(n), 0) AS total FROM groups LEFT JOIN counts USING (lang, source) GROUP BY ALL
),
p AS (
  SELECT lang, source, term, coalesce(n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(n, 0) + 2)) // (total + 2 * v)::HUGEINT AS p
  FROM totals JOIN v USING (lang) JOIN kept USING (lang) LEFT JOIN counts USING (lang, source, term)
),
q AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 2)) // (total + 2 * v)::HUGEINT AS q
  FROM (SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL)
  JOIN (SELECT lang, sum(total) AS total FROM totals GROUP BY lang) USING (lang) JOIN v USING (lang)
),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
),
every AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs ON pairs.lang = a.lang AND pairs.source = a.source AND pairs.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM every)
WHERE part = 'pair' OR rank <= 10
"""


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A manifest of all documents, and proofs that find every fifth one's text lower-cased."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = merkle.leaves(docs, {"text": merkle.lower_cased(F.col("text"))}, tampered)
    found = merkle.manifest(rows).withColumnRenamed("id", "doc_id").drop("tree")
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))


def _sql_field(name: str) -> str:
    return f"coalesce(strlen(CAST({name} AS VARCHAR)) || ':' || CAST({name} AS VARCHAR), '-')"


def _sql_leaf(text: str) -> str:
    return f"sha256({' || '.join(_sql_field(c) for c in ('doc_id', 'source', 'lang', 'n_chars'))} || {_sql_field(text)})"


# Ways go through the levels of a row's source and then, from level 100 on, through those of the sources.
OP13_SQL = f"""
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS row, doc_id, coalesce('+' || source, '') AS tree,
         {_sql_leaf("text")} AS leaf,
         list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
                     lambda crc, b: list_reduce(range(8), lambda x, _: xor(x >> 1, (x & 1) * 3988292384), xor(crc, b)),
                     4294967295::BIGINT) AS crc,
         {_sql_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS lower_leaf
  FROM documents
),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
         CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN lower_leaf ELSE leaf END AS put
  FROM rows
),
below AS (
  SELECT tree, 0 AS level, pos, leaf AS digest FROM leaves
  UNION ALL
  SELECT tree, any_value(level) + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM below) WHERE n > 1 GROUP BY tree, pos // 16
),
subroots AS (
  SELECT tree, max(level) AS top, arg_max(digest, level) AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place
  FROM below GROUP BY tree
),
above AS (
  SELECT 100 AS level, place AS pos, subroot AS digest FROM subroots
  UNION ALL
  SELECT any_value(level) + 1, pos // 16, sha256(string_agg(digest, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS n FROM above) WHERE n > 1 GROUP BY pos // 16
),
nodes AS (SELECT tree, level, pos, digest FROM below UNION ALL SELECT NULL, level, pos, digest FROM above),
runs AS (
  SELECT a.tree, a.level, a.pos,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM nodes a JOIN nodes b ON a.tree IS NOT DISTINCT FROM b.tree AND a.level = b.level AND a.pos // 16 = b.pos // 16
  GROUP BY ALL
),
ways AS (
  SELECT row, CASE WHEN top = 0 THEN NULL ELSE tree END AS tree, CASE WHEN top = 0 THEN 100 ELSE 0 END AS level,
         CASE WHEN top = 0 THEN place ELSE pos END AS pos, put AS digest, '' AS beside, top, place
  FROM leaves JOIN subroots USING (tree)
  UNION ALL
  SELECT row, CASE WHEN w.level + 1 = top THEN NULL ELSE w.tree END,
         CASE WHEN w.level + 1 = top THEN 100 ELSE w.level + 1 END,
         CASE WHEN w.level + 1 = top THEN place ELSE w.pos // 16 END,
         sha256(l || w.digest || r), beside || l || r, top, place
  FROM ways w JOIN runs ON runs.tree IS NOT DISTINCT FROM w.tree AND runs.level = w.level AND runs.pos = w.pos
  WHERE w.level < (SELECT max(level) FROM above)
),
ends AS (
  SELECT row, digest AS folded_root, sha256(beside) AS proof_sha256
  FROM ways WHERE level = (SELECT max(level) FROM above)
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified
FROM leaves JOIN subroots USING (tree) JOIN ends USING (row),
     (SELECT arg_max(digest, level) AS root FROM above)
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of the corpus pipeline."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_hnsw": op1_hnsw,
    "op2_licenses": op2_licenses,
    "op3_secrets": op3_secrets,
    "op4_hamming": op4_hamming,
    "op5_mixing": op5_mixing,
    "op7_byte_bpe": op7_byte_bpe,
    "op6_toxicity": op6_toxicity,
    "op8_jaccard": op8_jaccard,
    "op9_chat": op9_chat,
    "op10_repeats": op10_repeats,
    "op11_quality": op11_quality,
    "op12_divergence": op12_divergence,
    "op13_merkle": op13_merkle,
    "pipeline": pipeline,
}

SQL: dict[str, str] = {"op4_hamming": OP4_SQL, "op12_divergence": OP12_SQL, "op13_merkle": OP13_SQL}
