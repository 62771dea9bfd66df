"""Exact nearest binary codes by incremental multi-index hashing (operator 4).

Codes are cut into segments of 16 bits, and every segment value is indexed. Two codes that differ in at
most ``m (r + 1) - 1`` of their bits differ in at most r bits in one of the m segments. So a query looks
up, segment by segment, the values at radius 0, then 1, and so on; what it finds is verified on the whole
code. It stops as soon as its k-th distance is no larger than what the radius covers, and only queries
that haven't stopped go on. At radius 16 everything is covered.

Equal codes are one entry of the index, with as many of their ids as a query may return, the smallest
first; so a code that a third of all rows share is one candidate. Ties go to the smaller id. Vectors that
are null, empty or hold null or non-finite components have no code, and codes only meet those of their
length. Rows with a null id take no part. Repeated rows count once. An empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from riskloom.sources.staging import stage

BITS = 16


def sign_codes(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(id, bits, code): of each vector, which components are positive, as segments of 16 bits."""
    v = F.col(vector_col)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = df.where(F.col(id_col).isNotNull() & v.isNotNull() & (F.size(v) > 0)).where(good)

    def segment(s):
        part = F.slice(v, s * BITS + 1, F.lit(BITS))
        return F.aggregate(part, F.lit(0), lambda value, x: value * 2 + F.when(x > 0, 1).otherwise(0))

    segments = F.sequence(F.lit(0), F.floor((F.size(v) - 1) / BITS).cast("int"))
    return rows.select(F.col(id_col).alias("id"), F.size(v).alias("bits"), F.transform(segments, segment).alias("code"))


def nearest_codes(codes: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """(query_id, rank, vec_id, distance) of the ``k`` nearest of each query, itself left out.

    Both inputs are (id, bits, code).
    """
    place = F.row_number().over(Window.partitionBy("bits", "code").orderBy("id"))
    kept = codes.distinct().withColumn("_at", place).where(F.col("_at") <= k + 1)
    entries = kept.groupBy("bits", "code").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    index = stage(entries.select("bits", "code", "ids", F.posexplode("code").alias("segment", "value")), "index")
    reach = codes.distinct().groupBy("bits").agg((F.count(F.lit(1)) - 1).alias("others"))
    waiting = queries.distinct().join(reach, "bits").select(
        F.col("id").alias("query_id"), "bits", F.col("code").alias("_query"), "others"
    )
    waiting = stage(waiting.where("others > 0"), "queries")
    best, results = None, None
    for radius in range(BITS + 1):
        masks = F.lit([m for m in range(1 << BITS) if m.bit_count() == radius])  # 12,870 at most
        looked = waiting.select("query_id", "bits", "_query", F.posexplode("_query").alias("segment", "_value"))
        probes = looked.withColumn("_mask", F.explode(masks)).select(
            "query_id", "bits", "_query", "segment", F.col("_value").bitwiseXOR(F.col("_mask")).alias("value")
        )
        differ = F.aggregate(
            F.zip_with("_query", "code", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda s, x: s + x
        )
        # Catalyst can't foresee how many probes there are; without the hint it may broadcast them.
        found = probes.join(index.hint("merge"), ["bits", "segment", "value"]).select(
            "query_id", differ.alias("distance"), F.explode("ids").alias("vec_id")
        )
        found = found.where("vec_id <> query_id").distinct()
        found = found if best is None else found.unionByName(best).distinct()
        order = Window.partitionBy("query_id").orderBy("distance", "vec_id")
        top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
        top = stage(top, f"radius-{radius}")
        state = top.groupBy("query_id").agg(F.count(F.lit(1)).alias("_n"), F.max("distance").alias("_far"))
        segments = F.size("_query")
        covered = (F.col("_n") >= F.least(F.lit(k), F.col("others"))) & (
            (F.col("_far") <= segments * (radius + 1) - 1) | (F.col("_n") >= F.col("others"))
        )
        judged = waiting.join(state, "query_id", "left").withColumn("_done", F.coalesce(covered, F.lit(False)))
        judged = stage(judged, "judged")
        finished = top.join(judged.where("_done").select("query_id"), "query_id", "left_semi")
        results = [finished] if results is None else [*results, finished]
        waiting = judged.where("NOT _done").select("query_id", "bits", "_query", "others")
        if waiting.isEmpty():
            break
        best = top.join(waiting.select("query_id"), "query_id", "left_semi").select("query_id", "distance", "vec_id")
    return reduce(DataFrame.unionByName, results).select("query_id", "rank", "vec_id", "distance")
