"""Exact top-k search by inner product: a Voronoi join of queries and data.

1. A sample of the data gives the pivots, about the square root of the rows. Queries and data are both grouped by their nearest pivot.
2. A group of data is summed up by its size and radius; a group of queries by its radius and the least bound of its queries. A query's bound
   is its k-th best score with the sample, whose members are rows themselves, so no row below it can be among its k best.
3. From the summaries alone the driver derives which data groups a query group can need: no member x of a group of radius r around p scores more with
   a query q of a group of radius s around c than c.p + |c| r + s (|p| + r). The other data groups are skipped as a whole. A row of a needed group is
   copied to the query group only if c.x + s |x| reaches its bound.
4. Query groups that need much the same data are put together, up to CELL_QUERIES queries: a row then travels once for all of them. Where bounds prune little
   that leaves a grid of query and data blocks, in which a row travels n / CELL_QUERIES times for n queries, not once for each group.
5. The rows that such a union may need, a number known from the summaries, are split into blocks of about BLOCK_ROWS, and its queries
   go to just these blocks, so no key or group of copies is held in one task. Blocks are solved by exact integer products and merged.

Pivots (PIVOTS at most, which bounds what is broadcast and not the results), summaries and the sample (SAMPLE at most) are all that reaches the driver.
Each row is a candidate of its own, also where rows repeat; a query meets all rows but those of its own id. Of rows with equal vectors a
batch sends only as many as can rank. Ties go to the smaller id. Rows that repeat a query's id are one query (the least vector counts). Vectors that
are null, hold a null or a component that isn't finite (once scaled), or are not of the commonest length (there is no inner product with others), take no part, and neither do rows
without an id. Scores are exact at any size of the components (past 2**53 they are computed with whole numbers); one beyond a long is given as the
nearest long. Other columns aren't read. An empty table or one without queries gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from evgraph.llm.common import binary, pack, unpack, with_checkpoint_dir

BLOCK_ROWS = 40_000
#: Queries that one task holds at most on average; a group of more is dealt to several.
CELL_QUERIES = 32_768
#: Queries that one product takes.
STEP_QUERIES = 2048
#: Inner products that cost about as much as sending a row once.
SENDING = 1000.0
PIVOTS = 4096
SAMPLE = 16_384
EXACT = 2.0**53


def vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """id and vector of whole, finite components of rows that take part."""
    v = F.col("v")
    rows = table.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v")).where(F.col("id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return rows.where(good)


def scaled(rows: DataFrame, scale: float) -> DataFrame:
    """floor(scale * x); a double beyond 2**53 is whole already."""
    big = F.lit(2.0**53)
    out = rows.withColumn("v", F.transform("v", lambda x: F.when(F.abs(x * scale) < big, F.floor(x * scale).cast("double")).otherwise(x * scale)))
    return out.where(F.forall("v", lambda x: F.abs(x) != float("inf")))


def matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 1)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products of whole components: floats while these are exact, Python's numbers beyond."""
    most = float(np.abs(q).max(initial=0)) * float(np.abs(x).max(initial=0)) * q.shape[1]
    if most < EXACT:
        return q @ x.T
    whole = np.frompyfunc(int, 1, 1)
    return whole(q) @ whole(x).T


def top(scores: np.ndarray, ids: np.ndarray, own: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, id, score) of the k best columns of each row without the row's own id, best first, ties to the smaller id."""
    rows, columns = np.nonzero(ids[None, :] != own[:, None])
    if scores.dtype != object and scores.shape[1] > 4 * k:  # only what reaches the k-th best can rank
        masked = np.where(ids[None, :] != own[:, None], scores, -np.inf)
        least = np.partition(masked, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k]
        rows, columns = np.nonzero((masked >= least[:, None]) & (masked > -np.inf))
    return best(rows, ids[columns], scores[rows, columns], k)


def best(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The k best entries of each row."""
    if scores.dtype == object:
        order = np.array(sorted(range(len(rows)), key=lambda i: (rows[i], -scores[i], ids[i])), dtype=np.int64)
    else:
        order = np.lexsort((ids, -scores, rows))
    rows, ids, scores = rows[order], ids[order], scores[order]
    nth = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[nth < k], ids[nth < k], scores[nth < k]


def as_longs(scores: np.ndarray) -> np.ndarray:
    if scores.dtype == object:
        return np.array([min(max(s, -(2**63)), 2**63 - 1) for s in scores], dtype=np.int64)
    return scores.astype(np.int64)


def may_rank(ids: np.ndarray, x: np.ndarray, k: int) -> np.ndarray:
    """Rows of a batch that can be among k best: of equal vectors the k + 1 smallest ids (one may be the query's), each k times at most."""
    order = np.lexsort((ids, *x.T[::-1]))
    i, v = ids[order], x[order]
    new = np.concatenate(([True], (v[1:] != v[:-1]).any(1)))
    other = new | np.concatenate(([True], i[1:] != i[:-1]))
    group = np.maximum.accumulate(np.where(new, np.arange(len(i)), 0))
    nth_id = np.cumsum(other) - np.cumsum(other)[group]
    copy = np.arange(len(i)) - np.maximum.accumulate(np.where(other, np.arange(len(i)), 0))
    return order[(nth_id <= k) & (copy < k)]


def nearest(x: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each vector, and how far it is."""
    cell = ((centres**2).sum(1) - 2 * x @ centres.T).argmin(1)
    return cell, np.sqrt(((x - centres[cell]) ** 2).sum(1))


def together(needed: np.ndarray, weight: np.ndarray, queries: np.ndarray, most: int) -> list[list[int]]:
    """Unions of query groups (rows of `needed`, which tells the data groups they need, of so many rows): groups are put together while the rows that then
    travel only once outweigh the products with rows that a group alone wouldn't have met."""
    out: list[list[int]] = []
    union, held, n = np.zeros_like(needed), np.zeros(len(needed)), np.zeros(len(needed))
    alone = needed @ weight
    for g in np.argsort(-alone, kind="stable").tolist():
        k = len(out)
        shared = union[:k] @ (needed[g] * weight)
        more = queries[g] * (held[:k] - shared) + n[:k] * (alone[g] - shared)
        gain = np.where(n[:k] + queries[g] <= most, SENDING * shared - more, -1.0)
        at = int(gain.argmax()) if k and gain.max() >= 0 else k
        if at == k:
            out.append([])
        out[at].append(g)
        union[at] |= needed[g]
        held[at], n[at] = union[at] @ weight, n[at] + queries[g]
    return out


def search(table: DataFrame, is_query: Column, k: int = 5, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding", pivots: int | None = None, queries_a_cell: int = 256) -> DataFrame:
    """`query_id, rank, vec_id, score`; a component x counts as floor(scale * x)."""
    spark = table.sparkSession
    rows = vectors(table, id_col, vector_col)
    size = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    if size is None:
        return empty
    rows = scaled(rows.where(F.size("v") == size["n"]), scale)
    total = size["count"]
    pivots = int(np.clip(pivots or np.ceil(np.sqrt(total)), 1, PIVOTS))
    sample = rows.orderBy(F.xxhash64("id", "v"), "id").limit(int(np.clip(8 * pivots, 4 * k, SAMPLE))).collect()
    known_ids, known = np.array([r["id"] for r in sample], dtype=np.int64), np.array([r["v"] for r in sample], dtype=np.float64)
    places = known[np.sort(np.unique(known, axis=0, return_index=True)[1])]
    data_centres = places[:pivots]
    queries = rows.where(is_query).groupBy("id").agg(F.min("v").alias("v"))
    n = queries.count()
    if not n:
        return empty
    # fewer, larger groups of queries: a row is copied once for each group that needs it
    query_centres = data_centres[: int(np.clip(n // queries_a_cell, 1, len(data_centres)))]

    def to_groups(batches):
        for batch in batches:
            ids, x = batch.column(0).to_numpy(zero_copy_only=False), matrix(batch.column(1))
            if not len(ids):
                continue
            cell, away = nearest(x, query_centres)
            bound = np.full(len(ids), -np.inf)
            row, _, score = top(products(x, known), known_ids, ids, k)
            at = np.flatnonzero(np.arange(len(row)) - np.searchsorted(row, row) == k - 1)  # of fewer rows than k: no bound
            least = score[at].astype(np.float64)
            bound[row[at]] = least - np.abs(least) * 1e-12
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(cell.astype(np.int32)), pa.array(away), pa.array(bound)], names=["id", "v", "cell", "away", "bound"])

    def radii(batches):
        for batch in batches:
            x = matrix(batch.column(0))
            if len(x):
                cell, away = nearest(x, data_centres)
                yield pa.record_batch([pa.array(cell.astype(np.int32)), pa.array(away)], names=["cell", "away"])

    with_checkpoint_dir(spark)
    grouped = queries.mapInArrow(to_groups, "id long, v array<double>, cell int, away double, bound double").checkpoint()
    asks = grouped.groupBy("cell").agg(F.max("away").alias("radius"), F.min("bound").alias("bound"), F.count("*").alias("n")).orderBy("cell").collect()  # a row for each query group
    holds = rows.select("v").mapInArrow(radii, "cell int, away double").groupBy("cell").agg(F.max("away").alias("radius"), F.count("*").alias("n")).collect()  # a row for each data group
    middle = query_centres[[r["cell"] for r in asks]]
    reach, bound = np.array([r["radius"] for r in asks]) * (1 + 1e-9), np.array([r["bound"] for r in asks])
    p = data_centres[[r["cell"] for r in holds]]
    r, weight = np.array([r["radius"] for r in holds]) * (1 + 1e-9), np.array([r["n"] for r in holds])
    long = lambda x: np.sqrt((x**2).sum(1))
    slack = 1e-9 * (long(middle) + reach)[:, None] * (long(p) + r)[None, :] + 1e-6
    most = middle @ p.T + long(middle)[:, None] * r + reach[:, None] * (long(p) + r) + slack
    most = np.where(np.isnan(most), np.inf, most)  # of components too large to square
    needed = np.zeros((len(asks), len(data_centres)), dtype=bool)
    needed[:, [h["cell"] for h in holds]] = most >= bound[:, None]
    counts, inside = np.array([a["n"] for a in asks]), needed[:, [h["cell"] for h in holds]]
    unions = together(inside, weight, counts, CELL_QUERIES)
    union_of = np.zeros(len(asks), dtype=np.int64)
    for i, members in enumerate(unions):
        union_of[members] = i
    # from here on a union is known by its first part: one of many queries is dealt to several parts
    parts = np.array([-(-counts[m].sum() // CELL_QUERIES) for m in unions])
    base = np.cumsum(parts) - parts
    blocks = np.array([max(1, -(-(inside[m].any(0) @ weight) // BLOCK_ROWS)) for m in unions]).astype(np.int64)

    def copies(batches):
        for batch in batches:
            ids, x = batch.column(0).to_numpy(zero_copy_only=False), matrix(batch.column(1))
            if not len(ids):
                continue
            at = may_rank(ids, x, k)
            ids, x = ids[at], x[at]
            cell, _ = nearest(x, data_centres)
            size = long(x)
            # by the row's place too: copies of one id and vector needn't share a block
            spread = ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.arange(len(ids), dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(33)
            out = []
            for i, members in enumerate(unions):
                wanted = np.zeros(len(ids), dtype=bool)
                for g in members:
                    need = np.flatnonzero(needed[g, cell] & ~wanted)
                    limit = x[need] @ middle[g] + reach[g] * size[need] + 1e-9 * (long(middle[g : g + 1]) + reach[g]) * size[need] + 1e-6
                    wanted[need[~(limit < bound[g])]] = True
                need = np.flatnonzero(wanted)
                block = (spread[need] % np.uint64(blocks[i])).astype(np.int64)
                for b in np.unique(block).tolist():
                    own = need[block == b]
                    value = pack(id=ids[own], v=(x[own].astype(np.int32) if np.abs(x[own]).max() < 2**31 else x[own]).ravel())
                    out += [(int(base[i]) + j, b, value) for j in range(int(parts[i]))]
            if out:
                yield pa.record_batch([pa.array([o[0] for o in out], pa.int32()), pa.array([o[1] for o in out], pa.int32()), binary([o[2] for o in out])], names=["part", "block", "data"])

    def deal(batches):
        cells = {a["cell"]: i for i, a in enumerate(asks)}
        for batch in batches:
            g = union_of[np.array([cells[c] for c in batch.column("cell").to_pylist()], dtype=np.int64)]
            ids = batch.column("id").to_numpy(zero_copy_only=False).astype(np.int64)
            part = base[g] + (ids.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)).astype(np.int64) % parts[g]
            index = np.repeat(np.arange(len(g)), blocks[g])
            block = np.arange(len(index)) - np.repeat(np.cumsum(blocks[g]) - blocks[g], blocks[g])
            for lo in range(0, len(index), 4096):
                at = index[lo : lo + 4096]
                yield pa.record_batch([pa.array(part[at].astype(np.int32)), pa.array(block[lo : lo + 4096].astype(np.int32)), batch.column("id").take(pa.array(at)), batch.column("v").take(pa.array(at))], names=["part", "block", "id", "v"])

    def solve(left, right):
        own, q = left.column("id").combine_chunks().to_numpy(), matrix(left.column("v").combine_chunks())
        row, ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        for value in right.column("data") if left.num_rows else ():
            part = unpack(value.as_py())
            x = part["v"].astype(np.float64).reshape(len(part["id"]), -1)
            found = [top(products(q[lo : lo + STEP_QUERIES], x), part["id"], own[lo : lo + STEP_QUERIES], k) for lo in range(0, len(own), STEP_QUERIES)]
            row = np.concatenate((row, *[r + i * STEP_QUERIES for i, (r, _, _) in enumerate(found)]))
            row, ids, scores = best(row, np.concatenate((ids, *[f[1] for f in found])), np.concatenate((scores, *[f[2] for f in found])), k)
        # the score as text sorts no better; its exact rank goes along as a number of any size
        return pa.table([pa.array(own[row], pa.int64()), pa.array(ids, pa.int64()), pa.array(as_longs(scores), pa.int64()), pa.array([str(int(s)) for s in scores], pa.string())], names=["query_id", "vec_id", "score", "exact"])

    near = (
        grouped.select("id", "v", "cell").mapInArrow(deal, "part int, block int, id long, v array<double>").groupBy("part", "block")
        .cogroup(rows.mapInArrow(copies, "part int, block int, data binary").groupBy("part", "block")).applyInArrow(solve, "query_id long, vec_id long, score long, exact string")
    )
    # scores at a long's limits may differ beyond it: then more digits are more, or less if negative
    digits, negative = F.length("exact"), F.col("exact").startswith("-")
    beyond = F.when(F.col("score").isin(2**63 - 1, -(2**63)), F.when(negative, -digits).otherwise(digits)).otherwise(0)
    text = F.when(F.col("score").isin(2**63 - 1), F.col("exact"))
    low = F.when(F.col("score") == -(2**63), F.col("exact"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), beyond.desc(), text.desc(), low.asc(), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
