"""Nearest neighbours with a hash-prefix forest (an LSH forest).

Every tree gives a vector a long string of hash bits, the sides of random hyperplanes through the
mean of all vectors. The strings of a tree form a sorted array, in which the vectors that share a
prefix with a query are a run. A query descends every tree to its longest match and then ascends
all trees together, a bit at a time, until the runs at that prefix length hold enough candidates;
those are ranked by their exact distance.

How long the prefix of a query is follows from counts per prefix, which are gathered for all
vectors and added up level by level. The arrays are cut into blocks by their leading bits; a block
with many more vectors than others, as when one vector is very frequent, is dealt to several
tasks. A query visits the blocks that its prefix spans, each gives its nearest of the block, and
the best of these are the result. Distances never leave a block but for the nearest.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from eventpulse.llm._common import broadcast_if_small, col, saved

TREES = 32
HASH_BITS = 48
# Candidates per query and tree, at least, and as a share of all vectors: without clusters in many
# dimensions the neighbours of a vector are hardly nearer than others, and recall needs a share.
MIN_CANDIDATES = 64
SHARE = 1 / 40
BLOCK_ROWS = 8192
# Side tables are broadcast up to this number of rows, and shuffled beyond it.
BROADCAST_ROWS = 500_000
BROADCAST_MEANS = 100  # one for each vector length
SEED = 20


def usable(vector: Column) -> Column:
    """Not null nor zero, all components finite."""
    finite = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return vector.isNotNull() & finite & F.exists(vector, lambda x: x != 0)


def _planes(dim: int, trees: int, bits: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, dim]).standard_normal((dim, trees * bits))


def _hashed(rows: DataFrame, trees: int, bits: int, seed: int) -> DataFrame:
    """Add ``codes``, the hash string per tree as a number, to ``id, dim, vec, mean``."""

    def hashes(batches):
        planes = {}
        for batch in batches:
            dims = batch.column(1).to_numpy()
            codes = np.zeros((len(dims), trees), np.int64)
            weights = 1 << np.arange(bits - 1, -1, -1, dtype=np.int64)
            vecs, means = batch.column(2), batch.column(3)
            for dim in np.unique(dims).tolist():
                if dim not in planes:
                    planes = {dim: _planes(dim, trees, bits, seed)}
                at = np.flatnonzero(dims == dim)
                x, m = (
                    c.take(pa.array(at)).flatten().to_numpy().astype(float).reshape(len(at), dim)
                    for c in (vecs, means)
                )
                # Components may be as large as a double: scaled, the sums stay finite.
                scale = np.maximum(np.abs(x).max(1), np.abs(m).max(1))[:, None]
                sides = (x / scale - m / scale) @ planes[dim] > 0
                codes[at] = sides.reshape(len(at), trees, bits) @ weights
            offsets = pa.array(np.arange(len(dims) + 1, dtype=np.int32) * trees)
            lists = pa.ListArray.from_arrays(offsets, pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), lists], ["id", "dim", "vec", "codes"]
            )

    vec = rows.schema["vec"].dataType.simpleString()
    kind = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(hashes, f"id {kind}, dim int, vec {vec}, codes array<bigint>")


def _prefix(code: Column, bits: int, level: Column) -> Column:
    return F.call_function("shiftright", code, F.lit(bits) - level)


def _nearest_in_block(k: int, bits: int, kind: pa.DataType):
    """For a block of vectors and the queries that visit it: the k nearest of each query's run."""

    def nearest(points: pa.Table, queries: pa.Table) -> pa.Table:
        out = {"query_id": [], "vec_id": [], "score": []}
        if points.num_rows and queries.num_rows:
            dim = queries["dim"][0].as_py()
            order = np.argsort(points["code"].to_numpy(), kind="stable")
            codes, ids = points["code"].to_numpy()[order], points["id"].to_numpy()[order]
            flat = points["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            vecs = flat.reshape(-1, dim)[order]
            asked = queries["vec"].combine_chunks().flatten().to_numpy(zero_copy_only=False)
            asked = asked.reshape(-1, dim).astype(float)
            for q, own, code, level in zip(
                asked, queries["id"].to_pylist(), queries["code"].to_pylist(),
                queries["level"].to_pylist(),
            ):
                low = code >> bits - level << bits - level
                lo, hi = np.searchsorted(codes, [low, low + (1 << bits - level)])
                best_d, best_id = np.empty(0), np.empty(0, ids.dtype)
                for at in range(lo, hi, 4096):
                    part = slice(at, min(hi, at + 4096))
                    d = np.sqrt(np.square(vecs[part].astype(float) - q).sum(1))
                    other = ids[part] != own
                    d, i = np.append(best_d, d[other]), np.append(best_id, ids[part][other])
                    if len(d) > k:
                        near = d <= np.partition(d, k - 1)[k - 1]
                        if len(np.unique(i[near])) >= k:  # else repeated ids hide farther ones
                            d, i = d[near], i[near]
                    top = np.lexsort((i, d))
                    # Rows of one id count once, as their nearest.
                    _, first = np.unique(i[top], return_index=True)
                    top = top[np.sort(first)][:k]
                    best_d, best_id = d[top], i[top]
                out["query_id"] += [own] * len(best_d)
                out["vec_id"] += best_id.tolist()
                out["score"] += best_d.tolist()
        return pa.table({
            "query_id": pa.array(out["query_id"], kind), "vec_id": pa.array(out["vec_id"], kind),
            "score": pa.array(out["score"], pa.float64()),
        })

    return nearest


def nearest_neighbours(
    table: DataFrame,
    is_query: Column,
    *,
    k: int = 10,
    id_column: str = "vec_id",
    vector: str = "embedding",
    trees: int = TREES,
    bits: int = HASH_BITS,
    share: float = SHARE,
    min_candidates: int = MIN_CANDIDATES,
    block_rows: int = BLOCK_ROWS,
    seed: int = SEED,
) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` nearest found of every row that ``is_query``,
    a condition on the columns of the table, by Euclidean distance; ties go to the smaller id.

    A query is compared with all rows but those of its own id, and with vectors of its own
    length only. Rows without an id and vectors that are null, zero or not finite take no part;
    rows that share an id count once. A table without usable rows gives no rows. There are fewer
    than ``k`` neighbours only where there are fewer candidates. Ids are whole numbers.
    """
    vec = col(vector)
    rows = table.select(
        col(id_column).alias("id"), F.size(vec).alias("dim"), vec.alias("vec"),
        F.coalesce(is_query, F.lit(False)).alias("asks"),
    ).where(F.col("id").isNotNull() & usable(F.col("vec")))
    parts = rows.select("dim", F.posexplode("vec").alias("i", "x"))
    means = saved(
        parts.groupBy("dim", "i").agg(F.avg(F.col("x").cast("double")).alias("m"))
        .groupBy("dim").agg(F.sort_array(F.collect_list(F.struct("i", "m")))["m"].alias("mean")),
        "means",
    )
    with_mean = rows.join(broadcast_if_small(means, BROADCAST_MEANS), "dim")
    plain = _hashed(with_mean.select("id", "dim", "vec", "mean"), trees, bits, seed)
    points = saved(plain, "points")
    total = points.count()
    enough = max(min_candidates, math.ceil(share * total))
    depth = min(bits, max(1, math.ceil(math.log2(max(2.0, total / enough))) + 4))

    asking = rows.where("asks").select("id").distinct()
    queries = points.join(asking, "id", "left_semi")
    each = F.posexplode("codes").alias("tree", "code")
    level_counts = points.select("dim", each).groupBy(
        "dim", "tree", _prefix(F.col("code"), bits, F.lit(depth)).alias("leaf")
    ).agg(F.count("*").alias("n"))
    level_counts = saved(level_counts, "leaves")
    nodes = level_counts.select(
        "dim", "tree", "leaf", "n", F.explode(F.sequence(F.lit(1), F.lit(depth))).alias("level")
    ).groupBy(
        "dim", "tree", "level", F.expr(f"shiftright(leaf, {depth} - level)").alias("prefix")
    ).agg(F.sum("n").alias("n"))
    nodes = broadcast_if_small(saved(nodes, "nodes"), BROADCAST_ROWS)
    # Synchronous ascent: the longest prefix at which all trees together hold enough candidates.
    steps = queries.select("id", "dim", each).select(
        "id", "dim", "tree", "code", F.explode(F.sequence(F.lit(1), F.lit(depth))).alias("level")
    ).withColumn("prefix", _prefix(F.col("code"), bits, F.col("level")))
    held = (
        steps.join(nodes, ["dim", "tree", "level", "prefix"]).groupBy("id", "dim", "level")
        .agg(F.sum("n").alias("n")).where(F.col("n") >= enough * trees)
        .groupBy("id", "dim").agg(F.max("level").alias("level"))
    )
    asked = saved(
        queries.join(held, ["id", "dim"], "left")
        .select("id", "dim", "vec", F.coalesce("level", F.lit(0)).alias("level"), each), "asked"
    )

    # Blocks of the arrays: a prefix of `cut` bits, in as many parts as its vectors ask for.
    cut = min(depth, max(0, math.floor(math.log2(max(1.0, total / block_rows)))))
    in_block = saved(
        level_counts.groupBy("dim", "tree", F.expr(f"shiftright(leaf, {depth - cut})").alias("block"))
        .agg(F.ceil(F.sum("n") / block_rows).cast("int").alias("parts")), "blocks"
    )
    in_block = broadcast_if_small(in_block, BROADCAST_ROWS)
    placed = points.select("id", "dim", "vec", each).withColumn(
        "block", _prefix(F.col("code"), bits, F.lit(cut))
    )
    placed = placed.join(in_block, ["dim", "tree", "block"]).withColumn(
        "part", F.pmod(F.xxhash64("id"), F.col("parts").cast("bigint")).cast("int")
    )
    spanned = F.greatest(F.lit(cut) - F.col("level"), F.lit(0))
    first = F.expr(f"shiftleft(shiftright(code, {bits - cut} + _span), _span)")
    visits = (
        asked.withColumn("_span", spanned)
        .withColumn("block", F.explode(F.sequence(
            first, first + F.expr("shiftleft(1L, _span)") - 1
        )))
        .join(in_block, ["dim", "tree", "block"])
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    )
    where = ["dim", "tree", "block", "part"]
    kind = points.schema["id"].dataType
    arrow = pa.from_numpy_dtype({"bigint": "int64", "int": "int32"}[kind.simpleString()])
    found = (
        placed.select(*where, "id", "vec", "code").groupBy(*where)
        .cogroup(visits.select(*where, "id", "vec", "code", "level").groupBy(*where))
        .applyInArrow(
            _nearest_in_block(k, bits, arrow),
            f"query_id {kind.simpleString()}, vec_id {kind.simpleString()}, score double",
        )
    )
    one_each = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    ranked = one_each.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
