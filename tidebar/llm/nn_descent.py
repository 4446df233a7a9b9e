"""Approximate nearest neighbours: a graph by NN-descent, searched greedily. Nearness is the inner product.

Equal vectors are one node, so that copies, however many, neither fill each other's lists nor meet in
one task; a node keeps the smallest ids of its members, of which there are enough for any answer.

The graph. Each node starts with the best of several blocks of nodes, dealt by a hash each, so that
blocks overlap. In an iteration, a Spark
join brings to every node its neighbours and reverse neighbours with their vectors; the neighbours of
that node are compared with each other (pairs of which neither is new are not), and each of them is
offered the best it didn't have. Another shuffle brings the offers to their nodes, which keep the best.
It ends when few entries change. Reverse neighbours are limited before the shuffle, so hubs are bounded.

Search. A query starts from its own list and expands, some at a time, the best nodes of its beam whose
neighbours it hasn't seen; joins bring their lists and vectors. It ends when the whole beam is expanded.
What is found is scored again in double precision on the original vectors.

In between vectors are half precision with a factor each. All lists are bounded; tables are cut after
each step.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import column, cut, drop, whole_groups

_GRAPH = "u long, vec binary, scale float, ids array<long>, scores array<float>, fresh array<boolean>"


def _matrix(column: pa.Array) -> np.ndarray:
    """Rows of vectors from a column of equally long binary values (half precision)."""
    if not len(column):
        return np.zeros((0, 0), np.float32)
    return np.frombuffer(b"".join(column.to_pylist()), np.float16).reshape(len(column), -1).astype(np.float32)


def _lists(last: np.ndarray, values: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(last, pa.int32()), pa.array(values, kind))


def _packed(batch_vectors: list) -> tuple[pa.Array, np.ndarray]:
    """Half-precision vectors, and the factor of each."""
    x = np.array(batch_vectors, np.float64)
    scale = np.abs(x).max(1)
    half = (x / scale[:, None]).astype(np.float16)
    return pa.array([r.tobytes() for r in half], pa.binary()), scale.astype(np.float32)


def _best(u: np.ndarray, x: np.ndarray, s: np.ndarray, k: int, *more: np.ndarray) -> tuple[np.ndarray, ...]:
    """Of each u the k entries of largest s, once each; sorted by u, then s. Of repeated (u, x) the first counts."""
    order = np.lexsort((np.arange(len(u)), x, u))
    u, x, s, *more = (a[order] for a in (u, x, s, *more))
    once = np.concatenate([[True], (u[1:] != u[:-1]) | (x[1:] != x[:-1])]) if len(u) else np.zeros(0, bool)
    once &= u != x
    u, x, s, *more = (a[once] for a in (u, x, s, *more))
    order = np.lexsort((x, -s, u))
    u, x, s, *more = (a[order] for a in (u, x, s, *more))
    rank = np.arange(len(u)) - np.searchsorted(u, u)
    keep = rank < k
    return tuple(a[keep] for a in (u, x, s, *more))


def _start(k: int, block: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, block):
                part = batch.slice(lo, block)
                if lo and part.num_rows < block // 2:  # a short rest joins the block before, in part
                    part = batch.slice(max(0, batch.num_rows - block), block)
                fresh_from = part.num_rows - min(part.num_rows, batch.num_rows - lo)
                u = part["u"].to_numpy()
                vec, scale = _packed(part["embedding"].to_pylist())
                v = _matrix(vec) * scale[:, None]
                p = v[fresh_from:] @ v.T
                p[np.arange(len(p)), np.arange(fresh_from, len(u))] = -np.inf
                n = min(k, len(u) - 1)
                top = np.argsort(-p, axis=1)[:, :n]
                ids, scores = u[top], np.take_along_axis(p, top, 1)
                last = np.arange(len(p) + 1) * n
                yield pa.RecordBatch.from_arrays([pa.array(u[fresh_from:]), vec[fresh_from:], pa.array(scale[fresh_from:]), _lists(last, ids.ravel(), pa.int64()), _lists(last, scores.ravel().astype(np.float32), pa.float32()), _lists(last, np.ones(ids.size, bool), pa.bool_())], names=["u", "vec", "scale", "ids", "scores", "fresh"])

    return run


def _local_join(offers: int, k: int, hold: int = 1_000_000) -> Callable:
    """Rows (v, u, fresh, vec, scale, worst) sorted by v to offers (u, ids, scores)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, xs, ss = [], [], []

        def flush() -> pa.RecordBatch:
            u, x, s = _best(np.concatenate(us), np.concatenate(xs), np.concatenate(ss), k)
            us.clear(), xs.clear(), ss.clear()
            at = np.flatnonzero(np.concatenate([[True], u[1:] != u[:-1]])) if len(u) else np.zeros(0, int)
            last = np.append(at, len(u))
            return pa.RecordBatch.from_arrays([pa.array(u[at]), _lists(last, x, pa.int64()), _lists(last, s, pa.float32())], names=["u", "ids", "scores"])

        for batch in whole_groups(batches, "v"):
            v, u, fresh, worst = (batch[c].to_numpy(zero_copy_only=False) for c in ("v", "u", "fresh", "worst"))
            first = np.flatnonzero(np.concatenate([[True], v[1:] != v[:-1]]))
            size = np.diff(first, append=len(v))
            for lo in range(0, len(first), 128):
                f, n = first[lo : lo + 128], size[lo : lo + 128]
                a, b, m = f[0], f[-1] + n[-1], n.max()
                x = _matrix(batch["vec"].slice(a, b - a)) * batch["scale"].to_numpy()[a:b, None]
                row = np.repeat(np.arange(len(f)), n)
                col = np.arange(b - a) - np.repeat(f - a, n)
                block = np.zeros((len(f), m, x.shape[1]), np.float32)
                block[row, col] = x
                new, low, who = np.zeros((len(f), m), bool), np.full((len(f), m), np.inf, np.float32), np.full((len(f), m), -1)
                new[row, col], low[row, col], who[row, col] = fresh[a:b], worst[a:b], u[a:b]
                p = block @ block.transpose(0, 2, 1)
                ok = (p > low[:, :, None]) & (new[:, :, None] | new[:, None, :]) & (who[:, None, :] >= 0) & (who[:, :, None] != who[:, None, :])
                p[~ok] = -np.inf
                top = np.argpartition(-p, min(offers, m - 1), axis=2)[:, :, :offers] if m > offers else np.broadcast_to(np.arange(m), p.shape)
                s = np.take_along_axis(p, top, 2)
                hit = np.nonzero(np.isfinite(s))
                us.append(who[hit[0], hit[1]]), xs.append(who[hit[0], top[hit]]), ss.append(s[hit])
                if sum(map(len, us)) > hold:
                    yield flush()
        if us:
            yield flush()

    return run


def _merge(k: int) -> Callable:
    """Rows sorted by u, a node's own (with vec) and offers to it, to the node's new row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, "u"):
            own = batch["vec"].is_valid().to_numpy(zero_copy_only=False)
            order = np.argsort(~own, kind="stable")  # what a node has comes first, and so stays as it was
            rows = batch.take(pa.array(order))
            n = rows["ids"].value_lengths().to_numpy()
            u = np.repeat(rows["u"].to_numpy(), n)
            had = np.repeat(own[order], n)
            u, x, s, had = _best(u, rows["ids"].flatten().to_numpy(), rows["scores"].flatten().to_numpy(), k, had)
            node = rows.slice(0, int(own.sum()))
            node = node.take(pa.array(np.argsort(node["u"].to_numpy())))
            last = np.searchsorted(u, node["u"].to_numpy())
            last = np.append(last, len(u))
            yield pa.RecordBatch.from_arrays([node["u"], node["vec"], node["scale"], _lists(last, x, pa.int64()), _lists(last, s, pa.float32()), _lists(last, ~had, pa.bool_())], names=["u", "vec", "scale", "ids", "scores", "fresh"])

    return run


def _both_ways(graph: DataFrame, reverse: int, salt: int) -> DataFrame:
    """(v, u, fresh): the neighbours u of each node v, and at most reverse nodes that have v as theirs."""
    out = graph.select(F.col("u").alias("v"), F.explode(F.arrays_zip("ids", "fresh")).alias("x")).select("v", F.col("x.ids").alias("u"), F.col("x.fresh").alias("fresh"))
    back = out.select(F.col("u").alias("v"), F.col("v").alias("u"), "fresh")
    order = Window.partitionBy("v").orderBy(F.desc("fresh"), F.xxhash64("u", F.lit(salt)), "u")
    back = back.withColumn("r", F.row_number().over(order)).where(F.col("r") <= reverse).drop("r")
    return out.unionByName(back)


def build_graph(nodes: DataFrame, k: int = 48, reverse: int = 24, offers: int = 8, block: int = 512, rounds: int = 3, settled: float = 0.03) -> DataFrame:
    """nodes (u, embedding) to a graph: each node's k nearest found, with their scores. Lists only ever improve, so it settles."""
    dealt = lambda salt: F.xxhash64("u", F.lit(salt))
    # sorted, so that a task that runs again deals the same blocks
    starts = [nodes.repartition(dealt(salt)).sortWithinPartitions(dealt(salt), "u").mapInArrow(_start(k, block), _GRAPH).drop("fresh") for salt in range(rounds)]
    every = starts[0]
    for other in starts[1:]:
        every = every.unionByName(other.select("u", "ids", "scores"), allowMissingColumns=True)
    graph = every.repartition("u").sortWithinPartitions("u").mapInArrow(_merge(k), _GRAPH)
    graph = cut(graph.withColumn("fresh", F.transform("ids", lambda _: F.lit(True))), "graph")
    n = graph.count()
    step = 0
    while n > block:
        members = _both_ways(graph, reverse, step).groupBy("v", "u").agg(F.max("fresh").alias("fresh"))
        worst = F.when(F.size("scores") < k, F.lit(float("-inf"))).otherwise(F.element_at("scores", -1)).cast("float").alias("worst")
        members = members.join(graph.select("u", "vec", "scale", worst), "u")
        grouped = members.repartition("v").sortWithinPartitions("v")
        offered = grouped.mapInArrow(_local_join(offers, k), "u long, ids array<long>, scores array<float>")
        every = graph.drop("fresh").unionByName(offered, allowMissingColumns=True)
        new = cut(every.repartition("u").sortWithinPartitions("u").mapInArrow(_merge(k), _GRAPH), "graph")
        drop(graph)
        graph = new
        changed = graph.agg(F.sum(F.size(F.filter("fresh", lambda x: x)))).first()[0]
        if changed < settled * n * k:
            break
        step += 1
    return graph


def _advance(beam: int, expand: int) -> Callable:
    """Rows sorted by q, a query's own and the vectors found for it, to the query's next row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_groups(batches, "q"):
            q = batch["q"].to_numpy()
            x, vec = batch["x"].to_numpy(zero_copy_only=False), batch["vec"]
            scale = batch["scale"].to_numpy()
            first = np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))
            size = np.diff(first, append=len(q))
            rows, ids_, scores_, open_, last = [], [], [], [], [0]
            for f, n in zip(first, size, strict=True):
                part = slice(f, f + n)
                mine = np.flatnonzero(batch["ids"].slice(f, n).is_valid().to_numpy(zero_copy_only=False))
                other = np.setdiff1d(np.arange(n), mine)
                i = int(f + mine[0])
                vectors = _matrix(vec.slice(f, n)) * scale[part, None]
                ids, scores = batch["ids"][i].values.to_numpy(), batch["scores"][i].values.to_numpy()
                todo = batch["todo"][i].values.to_numpy(zero_copy_only=False).copy()
                todo[np.flatnonzero(todo)[:expand]] = False
                found = x[part][other].astype(np.int64)
                s = vectors[other] @ vectors[mine[0]]
                fresh = ~np.isin(found, ids)
                ids, scores = np.concatenate([ids, found[fresh]]), np.concatenate([scores, s[fresh]])
                todo = np.concatenate([todo, np.ones(int(fresh.sum()), bool)])
                top = np.lexsort((ids, -scores))[:beam]
                rows.append(i), ids_.append(ids[top]), scores_.append(scores[top]), open_.append(todo[top]), last.append(last[-1] + len(top))
            own = batch.take(pa.array(rows))
            yield pa.RecordBatch.from_arrays([own["q"], own["vec"], own["scale"], _lists(np.array(last), np.concatenate(ids_), pa.int64()), _lists(np.array(last), np.concatenate(scores_).astype(np.float32), pa.float32()), _lists(np.array(last), np.concatenate(open_), pa.bool_())], names=["q", "vec", "scale", "ids", "scores", "todo"])

    return run


def search(graph: DataFrame, queries: DataFrame, beam: int = 96, expand: int = 24) -> DataFrame:
    """Greedy search from the nodes in queries (u), until each has expanded all of its beam: (q, ids, scores), the best first."""
    near = cut(_both_ways(graph, 48, -1).groupBy("v").agg(F.collect_set("u").alias("near")), "near")
    vectors = graph.select(F.col("u").alias("x"), "vec", "scale")
    state = graph.join(queries, "u", "left_semi").select(F.col("u").alias("q"), "vec", "scale", "ids", "scores", F.transform("ids", lambda _: F.lit(True)).alias("todo"))
    state = cut(state, "beam")
    while True:
        tried = F.slice(F.filter(F.arrays_zip("ids", "todo"), lambda y: y["todo"]), 1, expand)
        front = state.select("q", F.explode(F.transform(tried, lambda y: y["ids"])).alias("v"))
        found = front.join(near, "v").select("q", F.explode("near").alias("x")).where("x <> q").distinct().join(vectors, "x")
        every = state.unionByName(found, allowMissingColumns=True)
        new = cut(every.repartition("q").sortWithinPartitions("q").mapInArrow(_advance(beam, expand), "q long, vec binary, scale float, ids array<long>, scores array<float>, todo array<boolean>"), "beam")
        drop(state)
        state = new
        if state.where(F.exists("todo", lambda y: y)).isEmpty():
            break
    drop(near)
    return state.select("q", "ids", "scores")


def nearest(vectors: DataFrame, is_query, k: int = 20, id_col: str = "vec_id", vector_col: str = "embedding", beam: int = 96, rescored: int = 64, **graph_options) -> DataFrame:
    """(query_id, rank, vec_id, score): for every row for which is_query holds the k nearest found among the other rows.

    Nearest first, ties to the smaller id; score is the inner product in double precision.

    * Vectors that are null, empty or zero, hold a null or non-finite component, or have another length than most take no part, nor do rows without an id.
    * Equal vectors are ties; rows that repeat an id and a vector count once. With k other rows or less, all are found.
    * An empty table gives an empty result. Only the id and the vector are read; other columns don't matter.
    """
    value = column(vector_col).cast("array<double>")
    fine = column(id_col).isNotNull() & F.forall(value, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf"))) & F.exists(value, lambda c: c != 0)
    rows = vectors.where(fine).select(column(id_col).cast("long").alias("id"), value.alias("embedding"))
    common = rows.groupBy(F.size("embedding").alias("d")).count().orderBy(F.desc("count"), "d").first()
    rows = rows.where(F.size("embedding") == (common["d"] if common else 0)).distinct()
    # nodes: equal vectors, with the smallest ids of each; queries belong to a node whatever their id
    ranked = rows.withColumn("r", F.row_number().over(Window.partitionBy("embedding").orderBy("id"))).where(F.col("r") <= k + 1)
    nodes = cut(ranked.groupBy("embedding").agg(F.min("id").alias("u"), F.sort_array(F.collect_list("id")).alias("members")), "nodes")
    asked = cut(rows.withColumnRenamed("id", "query_id").where(is_query(F.col("query_id"))).join(nodes.select("embedding", "u"), "embedding").select("query_id", "u"), "asked")
    wanted = asked.select("u").distinct()
    graph = build_graph(nodes.select("u", "embedding"), **graph_options)
    found = search(graph, wanted, beam=beam)
    exact = nodes.select(F.col("u").alias("x"), F.col("embedding").alias("ex"), "members")
    pairs = found.select("q", F.explode(F.slice("ids", 1, rescored)).alias("x")).unionByName(wanted.select(F.col("u").alias("q"), F.col("u").alias("x")))
    scored = pairs.join(exact, "x").join(nodes.select(F.col("u").alias("q"), F.col("embedding").alias("eq")), "q")
    score = F.aggregate(F.zip_with("eq", "ex", lambda a, b: a * b), F.lit(0.0), lambda a, b: a + b)
    scored = scored.select("q", "members", score.alias("score"))
    # k + 1 members of a node are enough, as all of them tie: lists are cut per node before they meet the queries
    best = scored.select("q", F.explode("members").alias("vec_id"), "score").withColumn("r", F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score"), "vec_id"))).where(F.col("r") <= k + 1)
    lists = best.groupBy("q").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))).alias("best"))
    hits = asked.join(lists, asked["u"] == lists["q"]).select("query_id", F.slice(F.filter("best", lambda b: b["vec_id"] != F.col("query_id")), 1, k).alias("best"))
    out = hits.select("query_id", F.posexplode("best").alias("p", "b"))
    out = cut(out.select("query_id", (F.col("p") + 1).alias("rank"), F.col("b.vec_id").alias("vec_id"), (-F.col("b.s")).alias("score")), "nearest")
    drop(nodes, asked, graph)
    return out


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), lambda i: i % 20 == 0)
