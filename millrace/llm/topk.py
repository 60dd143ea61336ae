"""Exact top-k search by integer inner product, with MaxScore.

A vector is a document whose terms are its dimensions; a query's terms are its non-zero ones. Vectors are cut into
posting shards inside their partition. In a shard each term has its smallest and largest value, and so a bound on
what it can add to a query's score. A query's k-th score so far splits its terms: as long as the bounds of the rest
leave a vector competitive, terms are essential and their postings are traversed (as one matrix product for a block
of queries); the non-essential ones are probed only for vectors that can still reach the k-th score. The best k of
each partition are merged per query.

Queries go through in blocks of `BLOCK`, each broadcast alone; a block's scores start from what it reached before.
Products are exact in 64-bit floats below 2**53; larger ones are computed with Python integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from millrace.llm.common import table
from millrace.session import scratch_path

K = 10
SCALE = 1024
BLOCK = 4096  # queries that a task holds at a time
SHARD = 8192  # vectors that a task holds at a time
_TILE = 256  # queries of one matrix product
_STEP = 8  # terms by which the essential part grows
_EXACT = 1 << 53
_LONG = (1 << 63) - 1


def integer_vectors(df: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, v): components floor(1024 x) as longs. Rows whose id or vector is null, or holds null, NaN or infinity, go."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    rows = df.where(F.col(key).isNotNull() & F.col(vector).isNotNull() & ~bad)
    scaled = F.transform(vector, lambda x: F.floor(F.lit(float(SCALE)) * x.cast("double")))
    return rows.select(F.col(key).cast("long").alias("id"), scaled.alias("v"))


def _matrix(rows: list[np.ndarray], width: int) -> np.ndarray:
    """Rows of any length as one integer matrix; missing terms are zero."""
    made = np.zeros((len(rows), width), np.int64)
    for i, row in enumerate(rows):
        made[i, : len(row)] = row
    return made


class Block:
    """A block of queries and the best k vectors that each has met."""

    def __init__(self, ids: np.ndarray, vectors: list[np.ndarray], k: int):
        self.k, self.ids, self.large = k, ids, False
        self.vectors = _matrix(vectors, max((len(v) for v in vectors), default=0))
        # Best first; a place not yet taken has the least score and no id.
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), _LONG, np.int64)

    def _merge(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Keep the k best of each query, ties to the smaller id."""
        touched = np.unique(query)
        every = np.concatenate((query, np.repeat(touched, self.k)))
        ids = np.concatenate((ids, self.found[touched].ravel()))
        scores = np.concatenate((scores, self.scores[touched].ravel()))
        order = np.lexsort((ids, -scores, every))
        every, ids, scores = every[order], ids[order], scores[order]
        begin = np.flatnonzero(np.concatenate(([True], every[1:] != every[:-1])))
        rank = np.arange(len(every)) - np.repeat(begin, np.diff(np.append(begin, len(every))))
        best = rank < self.k
        self.scores[every[best], rank[best]] = scores[best]
        self.found[every[best], rank[best]] = ids[best]

    def add(self, ids: np.ndarray, vectors: list[np.ndarray]) -> None:
        """Search one shard."""
        width = max(self.vectors.shape[1], max((len(v) for v in vectors), default=0))
        docs = _matrix(vectors, width)
        queries = np.zeros((len(self.ids), width), np.int64)
        queries[:, : self.vectors.shape[1]] = self.vectors
        # Of equal vectors only k + 1 can matter, those with the smallest ids (one may be the query's own).
        order = np.lexsort((ids, *docs.T)) if width else np.argsort(ids, kind="stable")
        ids, docs = ids[order], docs[order]
        fresh = np.ones(len(ids), bool)
        fresh[1:] = (docs[1:] != docs[:-1]).any(axis=1)
        begin = np.flatnonzero(fresh)
        kept = np.arange(len(ids)) - np.repeat(begin, np.diff(np.append(begin, len(ids)))) <= self.k
        ids, docs = ids[kept], docs[kept]
        if self.large or width and float(np.abs(docs.astype(float)).max(initial=0)) * float(np.abs(queries.astype(float)).max(initial=0)) * width >= _EXACT:
            self._add_large(queries, ids, docs)
            return
        low, high = docs.min(axis=0, initial=0).astype(float), docs.max(axis=0, initial=0).astype(float)
        # Terms that vary most come first: the bounds of the rest are then small.
        terms = np.argsort(low - high, kind="stable")
        docs, queries = docs[:, terms].astype(float), queries[:, terms].astype(float)
        bound = np.maximum(queries * low[terms], queries * high[terms])
        rest = np.concatenate((np.cumsum(bound[:, ::-1], axis=1)[:, ::-1], np.zeros((len(queries), 1))), axis=1)
        self._add_tiles(ids, docs, queries, rest)

    def _add_tiles(self, ids, docs, queries, rest) -> None:
        width = docs.shape[1]
        for start in range(0, len(queries), _TILE):
            tile = np.arange(start, min(start + _TILE, len(queries)))
            own = self.ids[tile]
            reached = self.scores[tile, -1]
            # Terms are essential up to where the bounds of the others stay below what is reached.
            most = np.where(np.isinf(reached), width, (rest[tile] > np.maximum(reached, 0)[:, None]).sum(axis=1))
            used = min(width, -(-int(most.max(initial=0)) // _STEP) * _STEP)
            partial = queries[tile, :used] @ docs[:, :used].T
            if np.isinf(reached).any() and len(ids) > self.k:
                # Nothing reached yet: the k-th score of this shard is a floor (one more for the query's own vector).
                short = np.isinf(reached)
                full = partial[short] + queries[tile[short], used:] @ docs[:, used:].T
                reached = reached.copy()
                reached[short] = np.partition(full, -(self.k + 1), axis=1)[:, -(self.k + 1)]
            at, doc = np.nonzero(partial >= (reached - rest[tile, used])[:, None])
            other = ids[doc] != own[at]
            at, doc = at[other], doc[other]
            for a in range(0, len(at), 1 << 16):
                q, d = at[a : a + (1 << 16)], doc[a : a + (1 << 16)]
                score = partial[q, d] + np.einsum("ij,ij->i", queries[tile[q], used:], docs[d, used:])
                in_reach = score >= reached[q]
                if in_reach.any():
                    self._merge(tile[q[in_reach]], ids[d[in_reach]], score[in_reach])

    def _add_large(self, queries, ids, docs) -> None:
        """Without bounds, in Python integers; scores beyond a long end at its limits."""
        self.large = True
        self.scores, wide = self.scores.astype(object), docs.astype(object)
        for i, query in enumerate(queries.astype(object)):
            score = np.array([max(-_LONG - 1, min(_LONG, s)) for s in wide @ query], object)
            rows = sorted(
                [(-s, int(v)) for s, v in zip(score, ids, strict=True) if v != self.ids[i]]
                + [(-s, int(v)) for s, v in zip(self.scores[i], self.found[i], strict=True)]
            )[: self.k]
            self.scores[i], self.found[i] = [-s for s, _ in rows], [v for _, v in rows]

    def rows(self) -> pa.RecordBatch:
        taken = self.found != _LONG
        score = pa.array([int(s) for s in self.scores[taken]], pa.int64())
        query = np.repeat(self.ids, self.k).reshape(taken.shape)[taken]
        return pa.RecordBatch.from_arrays([pa.array(query), pa.array(self.found[taken]), score], ["query_id", "vec_id", "score"])


def _lists(column: pa.Array) -> list[np.ndarray]:
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)
    return [values[a:b] for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def _search_block(vectors: DataFrame, ids: np.ndarray, queries: list[np.ndarray], k: int) -> DataFrame:
    held = vectors.sparkSession.sparkContext.broadcast((ids, queries))

    def run(batches):
        block = Block(*held.value, k)
        own_ids, own, n = [], [], 0
        for batch in batches:
            own_ids.append(batch.column(0).to_numpy())
            own += _lists(batch.column(1))
            n += batch.num_rows
            if n >= SHARD:
                block.add(np.concatenate(own_ids), own)
                own_ids, own, n = [], [], 0
        if n:
            block.add(np.concatenate(own_ids), own)
        yield block.rows()

    return vectors.mapInArrow(run, "query_id long, vec_id long, score long")


def top_k(
    queries: DataFrame, df: DataFrame, key: str = "vec_id", vector: str = "embedding", k: int = K, block: int = BLOCK
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest inner products of each query with rows of other ids.

    Ranks start at 1; ties go to the smaller id; fewer rows where there are fewer candidates. Vectors that are null
    or hold null, NaN or infinity take no part. Of query rows with the same id one counts, the smallest vector; of
    candidates with the same id each counts. Shorter vectors have zeros for missing components. Queries are
    processed in blocks, one pass over the vectors each; the driver holds one block.
    """
    spark = df.sparkSession
    vectors = integer_vectors(df, key, vector)
    own = integer_vectors(queries, key, vector).groupBy("id").agg(F.min("v").alias("v"))
    path, last = scratch_path(spark, "top"), None
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    while True:
        part = (own if last is None else own.where(F.col("id") > last)).orderBy("id").limit(block).toArrow()
        if not part.num_rows and last is not None:
            break
        ids = part.column("id").to_numpy() if part.num_rows else np.zeros(0, np.int64)
        rows = [np.asarray(v, np.int64) for v in part.column("v").to_pylist()]
        found = _search_block(vectors, ids, rows, k).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
        found.select("query_id", "rank", "vec_id", "score").write.mode("append").parquet(path)
        if part.num_rows < block:
            break
        last = int(ids[-1])
    return spark.read.schema("query_id long, rank int, vec_id long, score long").parquet(path)


def op5_maxscore(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return top_k(vectors.where(F.col("vec_id") % 100 == 0), vectors)


_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)::bigint) as e from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2]))::bigint as score
  from v q join v c on q.vec_id % 100 = 0 and q.vec_id <> c.vec_id),
ranked as (
  select query_id, (row_number() over (partition by query_id order by score desc, vec_id))::int as rank, vec_id, score from scored)
select * from ranked where rank <= 10
"""

QUERIES = {"op5_maxscore": op5_maxscore}
CHECKS = {"op5_maxscore": _SQL}
