"""A corpus, cleaned, deduplicated, masked, mixed and tokenised: five stages over ``documents``.

Each stage reads what the one before kept, works on all of it and decides; all but the last return the
columns of documents. A document whose secrets are masked, or that the mix takes twice, stays one row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from riskloom.llm import byte_bpe, jaccard, mixing, secrets, toxicity
from riskloom.llm.common import broadcast_if_small, modest_batches
from riskloom.sources.staging import stage, staging_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]

#: Rows that tasks and their Python workers exchange at a time; a row carries its text twice.
BATCH_ROWS = 250


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is below the threshold; those without an id are judged too."""
    modest_batches(spark, BATCH_ROWS)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    network = toxicity.train(docs, labels)
    # The row travels beside the text, so that nothing has to be joined by id afterwards.
    rows = docs.select(F.struct(*COLUMNS).alias("row"), "text")
    scored = toxicity.score(rows, network, id_col="row")
    return scored.where("predicted = 0").select("row.*")


def _row_key() -> Column:
    """A narrow name of a row: its id, rows without one last, and two hashes of all that is in it."""
    parts = [part for c in COLUMNS for part in (F.col(c).isNull(), F.col(c))]  # hashes alone pass over nulls
    return F.struct(
        F.col("doc_id").isNull().alias("no_id"),
        "doc_id",
        F.xxhash64(*parts).alias("k1"),
        F.xxhash64(F.lit("again"), *parts).alias("k2"),
    )


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of similar ones: that of the smallest id, and of several the smallest row.

    Groups are of rows, so rows that share an id or have none are judged by their texts like any others; a
    row with an id goes before those without. Documents without any word are similar to nothing and stay.
    """
    modest_batches(spark, BATCH_ROWS)
    keyed = docs.select(_row_key().alias("key"), "text")
    classes = stage(jaccard.similar_components(keyed, id_col="key"), "classes")
    first = (F.col("key.no_id") == F.col("component_id.no_id")) & F.col("key.doc_id").eqNullSafe(F.col("component_id.doc_id"))
    group = [F.col(f"component_id.k{i}").alias(f"c{i}") for i in (1, 2)]
    firsts = classes.where((F.col("n_shingles") > 0) & first).select("key.k1", "key.k2", *group)
    sizes = firsts.groupBy("c1", "c2").count()
    # A group's name is the key of one of its first rows; where there is one such row, that is the row.
    keep = broadcast_if_small(sizes.where("count = 1").select("c1", "c2"))
    several = broadcast_if_small(sizes.where("count > 1").select("c1", "c2"))
    again = broadcast_if_small(stage(firsts.join(several, ["c1", "c2"], "left_semi").distinct(), "repeated"))
    words = F.col("text").rlike(r"[^\x20\x09-\x0D]")  # null: no words
    rows = docs.select(*COLUMNS).withColumn("_words", F.coalesce(words, F.lit(False)))
    full = rows.where("_words").drop("_words").withColumn("_key", _row_key())
    full = full.withColumns({"_k1": F.col("_key.k1"), "_k2": F.col("_key.k2")}).drop("_key")
    once = full.join(keep, (full._k1 == keep.c1) & (full._k2 == keep.c2), "left_semi")
    repeated = full.join(again, (full._k1 == again.k1) & (full._k2 == again.k2))
    repeated = repeated.groupBy("c1", "c2").agg(F.min(F.struct(*COLUMNS)).alias("r"))
    return (
        once.select(*COLUMNS)
        .unionByName(repeated.select("r.*"))
        .unionByName(rows.where("NOT _words").drop("_words"))
        .select(*COLUMNS)
    )


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with every found secret replaced by ``<secret>``; ``n_chars`` follows the new text."""
    modest_batches(spark, BATCH_ROWS)
    network = secrets.train(docs)
    rows = docs.select(F.struct(*COLUMNS).alias("row"), "text")
    found = secrets.find_secrets(rows, network, id_col="row")
    masked = secrets.mask(found.select("row", F.col("row.text").alias("text"), "spans"), id_col="row")
    changed = ~F.col("masked").eqNullSafe(F.col("row.text"))
    n_chars = F.when(changed, F.length("masked").cast("long")).otherwise(F.col("row.n_chars"))
    return masked.select(
        "row.doc_id", F.col("masked").alias("text"), "row.lang", "row.source", n_chars.alias("n_chars")
    )


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them: never, once or twice."""
    modest_batches(spark, BATCH_ROWS)
    rows = docs.select(F.struct(*COLUMNS).alias("row"), "text", "source")
    taken = mixing.mix(rows, id_col="row")
    # Documents without words have no share in the mix; nothing speaks against them, so they stay.
    times = F.when(F.col("size") == 0, 1).otherwise(F.col("times")).cast("int")
    return taken.withColumn("_copy", F.explode(F.array_repeat(F.lit(0), times))).select("row.*")


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, checked by decoding them again."""
    import public_tokenizers

    modest_batches(spark, BATCH_ROWS)
    ranks = byte_bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    rows = docs.select(F.struct("doc_id", "source", F.sha2("text", 256).alias("sha")).alias("row"), "text")
    back = byte_bpe.round_trip(rows, ranks, public_tokenizers.PATTERN, id_col="row", states=5_000, remember=10_000)
    return back.select(
        "row.doc_id",
        "row.source",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        (F.sha2("decoded", 256) == F.coalesce("row.sha", F.sha2(F.lit(""), 256))).alias("round_trip"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("toxicity", drop_toxic),
    ("near copies", drop_near_copies),
    ("secrets", mask_secrets),
    ("mixing", mix_sources),
    ("tokens", tokenize),
]

#: Trained networks, a knapsack and a tokenizer have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        path = staging_path(spark, name.replace(" ", "-"))
        function(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
