"""Exact top-k search by inner product: columnar branch and bound over blocks of dimensions."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import Window

from barworks.llm.common import numbered, table

K = 10
QUERY_EVERY = 100
CANDIDATES = 16384  # rows of a candidate block
QUERIES = 1024  # rows of a query block
DIMENSIONS = 16  # dimensions added at a time
_EXACT = 2.0**53


def _matrix(column):
    """Vectors of an Arrow list column as integers floor(1024 x), short ones filled up with zeros: (dimensions, rows)."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(lists.offsets.to_numpy())
    values = np.floor(1024.0 * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    out = np.zeros((int(lengths.max(initial=0)), len(lengths)))
    rows = np.repeat(np.arange(len(lengths)), lengths)
    out[np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths), rows] = values
    return out


def _rest_norms(vectors, cuts):
    """Length of what each vector still holds from each cut on."""
    squares = (vectors * vectors).reshape(len(vectors), -1)
    return [np.sqrt(squares[c:].sum(0)) for c in cuts]


def best(query, query_id, vectors, ids, norms, query_norms, cuts, k):
    """Places of all columns that can be among the k best of one query, ties by id included, and their exact scores.

    Scores grow block by block of dimensions. What the remaining dimensions can add is at most the product of the
    lengths of the two remainders; a column whose upper bound is below the k-th best lower bound is dropped.
    """
    at = np.flatnonzero(ids != query_id)
    score = np.zeros(len(at))
    for i in range(len(cuts) - 1):
        block = vectors[cuts[i]:cuts[i + 1]]
        block = block if len(at) == block.shape[1] else block[:, at]
        score = score + query[cuts[i]:cuts[i + 1]] @ block
        if len(at) > k:
            rest = query_norms[i + 1] * norms[i + 1][at] * (1 + 1e-9) + (i + 2 < len(cuts)) * 1e-6
            low = np.partition(score - rest, len(at) - k)[len(at) - k]
            stay = score + rest >= low
            if not stay.all():
                at, score = at[stay], score[stay]
    order = np.lexsort((ids[at], -score))[:k]
    return at[order], score[order]


def _search(k):
    def search(candidates, queries):
        if not (candidates.num_rows and queries.num_rows):
            return _result([], [], [], [])
        vectors, wanted = _matrix(candidates["v"]), _matrix(queries["v"])
        d = max(len(vectors), len(wanted))
        vectors, wanted = (np.pad(x, ((0, d - len(x)), (0, 0))) for x in (vectors, wanted))
        if d * np.abs(vectors).max(initial=0) * np.abs(wanted).max(initial=0) >= _EXACT:
            vectors, wanted = (np.vectorize(int, otypes=[object])(x) for x in (vectors, wanted))
            cuts = [0, d]  # whole numbers too large for doubles: exact sums, one block
        else:
            cuts = [*range(0, d, DIMENSIONS), d]
        plain = [x.astype(np.float64) for x in (vectors, wanted)]
        norms, query_norms = (_rest_norms(x, cuts) for x in plain)
        ids, query_ids = candidates["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
        out = [[], [], [], []]
        for j, row in enumerate(queries["_row"].to_pylist()):
            at, score = best(np.ascontiguousarray(wanted[:, j]), query_ids[j], vectors, ids, norms,
                             [n[j] for n in query_norms], cuts, k)
            for column, values in zip(out, ([row] * len(at), [query_ids[j]] * len(at), ids[at],
                                            [max(-2**63, min(2**63 - 1, int(s))) for s in score])):
                column.extend(values)
        return _result(*out)
    return search


def _result(*columns):
    return pa.table([pa.array(c, pa.int64()) for c in columns], ["_row", "query_id", "vec_id", "score"])


def top_k(vectors, is_query, k=K, candidates=CANDIDATES, queries=QUERIES):
    """The k best of all rows for every row that `is_query` (a Column) selects: query_id, rank, vec_id, score.

    Component x counts as floor(1024 x); the score is the whole-number inner product, ties go to the smaller vec_id.
    Rows that carry the query's own id are no candidates for it. Rows take no part whose vec_id is null or whose vector
    is null or holds a null, a NaN or an infinity. Vectors of different lengths count as filled up with zeros; an empty
    one scores 0. Repeated rows are candidates, and queries, of their own. Scores beyond 64 bits become the largest or
    smallest long. An empty table gives no rows; other columns are not read.

    Rows are dealt evenly into candidate and query blocks and every pair of blocks meets in a task of its own, so memory
    depends on the block sizes alone. Each task sends at most k rows per query.
    """
    ok = F.col("embedding").isNotNull() & ~F.exists(
        "embedding", lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    rows = numbered(vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding"),
                                   F.coalesce(is_query, F.lit(False)).alias("_q")))
    rows = (rows.where(F.col("vec_id").isNotNull()).where(F.coalesce(ok, F.lit(False)))
            .select("_row", "vec_id", F.col("embedding").alias("v"), "_q"))
    total = vectors.count()
    deal = F.xxhash64("_row")
    n_c = max(1, -(-total // candidates))
    n_q = max(1, -(-rows.where("_q").count() // queries))
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = rows.select("vec_id", "v", F.pmod(deal, F.lit(n_c)).cast("int").alias("c"), every(n_q).alias("q"))
    right = (rows.where("_q").select("_row", "vec_id", "v", F.pmod(deal, F.lit(n_q)).cast("int").alias("q"))
             .select("*", every(n_c).alias("c")))
    found = (left.groupBy("c", "q").cogroup(right.groupBy("c", "q"))
             .applyInArrow(_search(k), "_row long, query_id long, vec_id long, score long"))
    order = Window.partitionBy("_row").orderBy(F.col("score").desc(), "vec_id")
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def op2_topk(spark, sf_dir):
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % QUERY_EVERY == 0)


OP2_SQL = f"""
WITH ok AS (
  SELECT vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         cast(list_sum(list_transform(list_zip(q.v, c.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM ok q JOIN ok c ON q.vec_id % {QUERY_EVERY} = 0 AND q.vec_id <> c.vec_id),
r AS (SELECT *, cast(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM p)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= {K}
"""
