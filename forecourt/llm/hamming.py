"""Exact top-k search over binary codes by multi-index hashing with growing segment radii.

A vector's code has a bit per dimension: 1 where the value is above zero. Codes are cut into segments of ``BITS``
bits, and every distinct code is indexed once per segment by the segment's value. A round of radius r looks up, for
each open query and segment, all values that differ in exactly r bits, and verifies the full distance of what it
finds. After the round every code within ``segments * (r + 1) - 1`` bits has been verified (a code farther than r in
every segment is at least ``segments * (r + 1)`` away), so a query is closed once its k-th verified distance is no
larger; radius ``BITS`` covers everything. A candidate farther than the k-th distance so far is not passed on: it
could not enter the result. Nothing is sampled or capped.

Equal codes are one entry with its k smallest ids, for no result can hold more of them; equal queries are one query.
Results are ordered by (distance, id). A candidate that several segments or rounds reach is kept by the first only.

Defined cases: a null vector has no code: it is not found and finds nothing; a null element is bit 0, and so are
dimensions that a shorter vector lacks; rows that repeat id and code count once; with fewer than k entries all are
returned; an empty table gives no rows; further columns are left alone.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from forecourt.llm.common import query, table
from forecourt.session import materialize

K = 10
BITS = 16


def codes(vectors: DataFrame, dimensions: int) -> DataFrame:
    """(id, s0, s1, ...): the segments of each vector's code."""
    segments = max(1, -(-dimensions // BITS))

    def segment(k: int) -> Column:
        bits = F.slice("embedding", k * BITS + 1, BITS)
        return F.aggregate(F.transform(bits, lambda x, i: F.when(x > 0, F.expr("1")).otherwise(0) * F.pow(F.lit(2), i).cast("int")), F.lit(0), lambda a, x: a + x)

    return vectors.where("embedding is not null").select(F.col("vec_id").alias("id"), *[segment(k).alias(f"s{k}") for k in range(segments)])


def _differ(k: int) -> Column:
    return F.bit_count(F.col(f"q.s{k}").bitwiseXOR(F.col(f"c.s{k}")))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """(query_id, rank, vec_id, distance): the ``k`` nearest codes of ``vectors`` for each row of ``queries``."""
    widest = vectors.unionByName(queries).agg(F.max(F.size("embedding"))).first()[0] or 1
    segments = max(1, -(-widest // BITS))
    names = [f"s{i}" for i in range(segments)]
    ranked = codes(vectors.select("vec_id", "embedding"), widest).distinct().withColumn("n", F.row_number().over(Window.partitionBy(*names).orderBy("id"))).where(F.col("n") <= k)
    index = materialize(ranked.groupBy(*names).agg(F.array_sort(F.collect_list("id")).alias("ids")), "code-index")
    asked = materialize(codes(queries.select("vec_id", "embedding"), widest).distinct(), "code-queries")
    open_ = asked.select(*names).distinct().withColumn("bound", F.lit(None).cast("int"))
    posted = index.select(*names, F.col("ids")[0].alias("least"), F.posexplode(F.array(*names)).alias("segment", "value"))
    by_query = Window.partitionBy(*names)
    best = None
    for radius in range(BITS + 1):
        masks = F.filter(F.sequence(F.lit(0), F.lit((1 << BITS) - 1)), lambda x: F.bit_count(x) == radius)
        spread = open_.repartition(vectors.sparkSession.sparkContext.defaultParallelism)
        probe = spread.select(*names, "bound", F.posexplode(F.array(*names)).alias("segment", "own"))
        probe = probe.select(*names, "bound", "segment", F.explode(F.transform(masks, lambda x: x.bitwiseXOR(F.col("own")))).alias("value"))
        # Spark takes the probes for as few as the queries and would broadcast them; they are shuffled instead.
        met = probe.hint("merge").alias("q").join(posted.alias("c"), (F.col("q.segment") == F.col("c.segment")) & (F.col("q.value") == F.col("c.value")))
        nearest = F.least(*[_differ(i) for i in range(segments)]) if segments > 1 else _differ(0)
        first = reduce(lambda rest, i: F.when(_differ(i) == radius, i).otherwise(rest), reversed(range(segments)), F.lit(-1))
        far = reduce(lambda a, b: a + b, [_differ(i) for i in range(segments)])
        new = met.where((nearest == radius) & (first == F.col("q.segment")) & (F.col("q.bound").isNull() | (far <= F.col("q.bound"))))
        new = new.select(*[F.col(f"q.{n}").alias(n) for n in names], *[F.col(f"c.{n}").alias(f"c_{n}") for n in names], far.alias("distance"), F.col("c.least").alias("least"))
        if best is not None:
            new = new.unionByName(best)
        place = F.row_number().over(by_query.orderBy("distance", "least"))
        best = materialize(new.withColumn("place", place).where(F.col("place") <= k).drop("place"), "code-best")
        found = _entries(best, index, names)
        ranks = found.withColumn("place", F.row_number().over(by_query.orderBy("distance", "id")))
        bounds = ranks.where(F.col("place") == k).select(*names, F.col("distance").alias("bound"))
        left = asked.select(*names).distinct().join(bounds, names, "left")
        open_ = materialize(left.where(F.col("bound").isNull() | (F.col("bound") >= segments * (radius + 1))), "code-open")
        if open_.isEmpty():
            break
    result = asked.withColumnRenamed("id", "query_id").join(_entries(best, index, names), names)
    rank = F.row_number().over(Window.partitionBy("query_id", *names).orderBy("distance", "id"))
    return result.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", F.col("id").alias("vec_id"), "distance")


def _entries(best: DataFrame, index: DataFrame, names: list[str]) -> DataFrame:
    """The ids behind the codes in ``best``."""
    of = index.select(*[F.col(n).alias(f"c_{n}") for n in names], "ids")
    return best.join(of, [f"c_{n}" for n in names]).select(*names, "distance", F.explode("ids").alias("id"))


SQL = f"""
with c as (select vec_id, array_to_string(list_transform(embedding, lambda x: case when x > 0 then '1' else '0' end), '')::bit as b
  from embeddings where embedding is not null),
d as (select q.vec_id as query_id, c.vec_id, bit_count(xor(q.b, c.b)) as distance from c as q, c where q.vec_id % 100 = 0),
r as (select *, row_number() over (partition by query_id order by distance, vec_id) as rank from d)
select query_id, rank::int as rank, vec_id, distance::int as distance from r where rank <= {K}
"""


@query("op8_top_k", SQL)
def op8(spark, folder):
    """Every vector whose id is divisible by 100 asks for its nearest among all, itself included."""
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    return top_k(vectors, vectors.where(F.col("vec_id") % 100 == 0))
