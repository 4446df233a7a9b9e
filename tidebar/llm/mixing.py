"""Mixing sources to target weights by entropy balancing. DataFrame functions only.

Among all rates w (copies of a document, on average) between 0 and ``most`` that meet the token constraints

    sum over the documents of a source of size * w = target of the source

those nearest to one copy of each document are taken, by the entropy of a bounded rate:

    minimise sum(w * ln w + (most - w) * ln(most - w)), with the prior odds of one copy

The convex dual has one multiplier l for each source, and the optimal rates are exponential tilts of the
odds, w / (most - w) = exp(l * x) / (most - 1) with x = size / mean size of the source, so that no rate leaves its bounds.
Newton's method solves the dual for all sources at once. Its sums (tokens at the current rates, and their
derivative) run over all documents in every iteration, distributed, by way of the table (source, size, documents), which
has all that they depend on; a step that leaves the bracket found so far is replaced by bisection.

Rates become copies in blocks of about 256 documents of one source, dealt by a hash, in order of size:
each document gets its rate rounded down or up, whichever keeps the block's words nearer to the words
due so far. The error left in a block is about the size of its smallest documents. Blocks bound what a
task gathers, so a source with a third of all rows is as good as many small ones; documents without words
take no part in blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, column, cut, drop, unfold, whole_row

#: Weights of the sources in their order, again and again.
WEIGHTS = (5.0, 2.0, 1.0)


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(column(text), F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, total: float = 1.5, most: float = 2.0) -> DataFrame:
    """sizes (source, source_size, n) with each source's target.

    The sources share total times all tokens by weight. None gets over most times its own; what is over
    is shared among the others by weight, until none is above. That is one water level t with
    target = min(most * size, t * weight): with the sources in the order of most * size / weight, it is
    found by two running sums. The tables have a row for each source.
    """
    n = len(weights)
    order = Window.orderBy(F.col("source").asc_nulls_last())
    fill = Window.orderBy("fill_at", F.col("source").asc_nulls_last())
    before, after = fill.rowsBetween(Window.unboundedPreceding, -1), fill.rowsBetween(0, Window.unboundedFollowing)
    level = F.try_divide(F.col("due") - F.coalesce(F.sum("most").over(before), F.lit(0.0)), F.sum("weight").over(after))
    rows = (
        sizes.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(order) - 1, F.lit(n)) + 1).cast("int")))
        .withColumn("most", F.col("source_size") * F.lit(float(most)))
        .withColumn("fill_at", F.col("most") / F.col("weight"))
        .withColumn("due", F.sum("source_size").over(Window.partitionBy()) * F.lit(float(total)))
        .withColumn("level", level)
    )
    first = F.struct("fill_at", F.col("source").isNull(), "source", "level")
    rows = rows.withColumn("t", F.min(F.when(F.col("level") <= F.col("fill_at"), first)).over(Window.partitionBy())["level"])
    return rows.select("source", "source_size", "n", "weight", F.when(F.col("t").isNull(), F.col("most")).otherwise(F.least("most", F.col("t") * F.col("weight"))).alias("target"))


def _rate(most: float) -> Column:
    """The rate of a document of ``size`` words: its odds tilted by the multiplier of its source; most where the source takes all it can."""
    tilted = F.lit(most) / (1.0 + F.lit(most - 1.0) * F.exp(-F.col("lam") * F.col("size") / F.col("mean")))
    return F.when(F.col("full"), F.lit(most)).otherwise(tilted)


def multipliers(sizes: DataFrame, targets: DataFrame, most: float = 2.0, tol: float = 1e-7, steps: int = 200) -> DataFrame:
    """targets (source, source_size, n, target) with the multiplier lam of each source and what its rates need beside it.

    sizes: (source, size, n), documents by size. An iteration is a join and a group-by over it. Sources that
    get all they can (full) or have no words aren't solved.
    """
    mean = F.col("source_size") / F.greatest("n", F.lit(1))
    state = targets.withColumn("full", F.col("target") >= F.lit(most) * F.col("source_size")).withColumn("mean", mean)
    state = cut(state.select("*", F.lit(0.0).alias("lam"), F.lit(None).cast("double").alias("low"), F.lit(None).cast("double").alias("high"), F.lit(False).alias("done")), "multipliers")
    few = state.count() <= 100_000  # a row for each source, of about 100 bytes
    for _ in range(steps):
        at = state.where("NOT full AND NOT done AND target > 0").withColumnRenamed("source", "s").select("s", "lam", "mean", "full")
        rows = sizes.withColumnRenamed("n", "docs").join(F.broadcast(at) if few else at, sizes["source"].eqNullSafe(at["s"]))
        w, words = _rate(most), F.col("docs") * F.col("size")
        sums = rows.groupBy("s").agg(F.sum(words * w).alias("got"), F.sum(words * w * (1.0 - w / most) * F.col("size") / F.col("mean")).alias("slope"))
        over = F.col("got") - F.col("target")
        low = F.when(over < 0, F.col("lam")).otherwise(F.col("low"))
        high = F.when(over > 0, F.col("lam")).otherwise(F.col("high"))
        new = state.join(F.broadcast(sums) if few else sums, state["source"].eqNullSafe(sums["s"]), "left")
        new = new.withColumn("low", low).withColumn("high", high).withColumn("done", F.col("s").isNull() | (F.abs(over) <= F.lit(tol) * F.col("target")))
        reach = F.greatest(F.lit(4.0), 2.0 * F.abs("lam"))
        newton = F.col("lam") - F.least(reach, F.greatest(-reach, F.coalesce(F.try_divide(over, F.col("slope")), F.signum(over) * reach)))
        inside = (F.col("low").isNull() | (newton > F.col("low"))) & (F.col("high").isNull() | (newton < F.col("high")))
        step = F.when(F.col("done"), F.col("lam")).when(inside, newton).otherwise((F.col("low") + F.col("high")) / 2)
        new = cut(new.withColumn("lam", step).select(*state.columns), "multipliers")
        drop(state)
        state = new
        if state.where("NOT done").isEmpty():
            break
    return state.drop("low", "high", "done")


def _mixed(docs: DataFrame, row: Column, id_col: str, source_col: str, text_col: str, weights, total: float, most: float, block: int) -> DataFrame:
    """(row, size, source_size, target, rate, copies) of every row."""
    key = F.xxhash64(column(id_col), column(text_col))
    sized = docs.select(row.alias("row"), column(source_col).alias("source"), n_words(text_col).alias("size"), key.alias("key"))
    sizes = cut(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "sizes")
    totals = sizes.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"), F.sum("n").alias("n"))
    table = multipliers(sizes, source_targets(totals, weights, total, most), float(most))
    drop(sizes)
    table = table.withColumn("blocks", F.ceil(F.col("n") / block)).drop("n").withColumnRenamed("source", "source_")
    if table.count() <= 100_000:
        table = F.broadcast(table)
    rows = sized.join(table, sized["source"].eqNullSafe(table["source_"])).drop("source_")
    rate = F.when(F.col("target") > 0, _rate(float(most))).otherwise(F.lit(0.0))
    empty = rows.where("size = 0").select("row", "size", "source_size", "target", rate.alias("rate"), F.lit(1).alias("copies"))
    one = F.struct((-F.col("size")).alias("minus"), F.col("key").alias("tie"), rate.alias("rate"), F.col("row"))
    about = ["source", "source_size", "target", "block"]
    held = rows.where("size > 0").withColumn("block", F.pmod(F.xxhash64("key", F.lit("block")), F.col("blocks")))
    held = held.groupBy(*about).agg(F.collect_list(one).alias("all"))
    before = lambda a, b: F.when(a["minus"] < b["minus"], -1).when(a["minus"] > b["minus"], 1).when(a["tie"] < b["tie"], -1).when(a["tie"] > b["tie"], 1).otherwise(0)
    held = held.withColumn("all", F.array_sort("all", before))

    def fold(acc, x):
        size = -x["minus"]
        near = F.round(x["rate"] + acc["carry"] / size)
        k = F.greatest(F.floor(x["rate"]).cast("double"), F.least(F.ceil(x["rate"]).cast("double"), near)).cast("int")
        return F.struct((acc["carry"] + x["rate"] * size - k * size).alias("carry"), F.concat(acc["copies"], F.array(k)).alias("copies"))

    start = F.struct(F.lit(0.0).alias("carry"), F.array().cast("array<int>").alias("copies"))
    held = held.withColumn("copies", F.aggregate("all", start, fold)["copies"])
    out = held.select("source_size", "target", F.explode(F.arrays_zip("all", "copies")).alias("x"))
    out = out.select(F.col("x.all.row").alias("row"), (-F.col("x.all.minus")).alias("size"), "source_size", "target", F.col("x.all.rate").alias("rate"), F.col("x.copies").alias("copies"))
    return out.unionByName(empty)


def entropy_mix(docs: DataFrame, payload: list[str], id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights=WEIGHTS, total: float = 1.5, most: float = 2.0, block: int = 256) -> DataFrame:
    """The columns payload of every row, with size, source_size, target, rate, copies and taken.

    * Null texts have size 0, as empty ones do; a document of size 0 has one copy and takes no words.
    * Rows with a null source are a source of their own, the last one.
    * A source without words has target 0. A table without rows gives none.
    * Repeated rows are rows like any other; ids may be null. Texts of any length are counted whole.
    * A payload column that has a result column's name is replaced by it; other names don't matter.

    Blocks and their order depend on ids, texts and sizes only, so reruns agree.
    """
    row = F.struct(*[column(c).alias(c) for c in payload])
    mixed = _mixed(docs, row, id_col, source_col, text_col, weights, total, most, block)
    return unfold(mixed.withColumn("taken", F.col("copies") * F.col("size")), "row", ["size", "source_size", "target", "rate", "copies", "taken"])


def mixed_copies(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", weights=WEIGHTS, total: float = 1.5, most: float = 2.0, block: int = 256) -> DataFrame:
    """Each row of docs as often as the mix takes it, with the columns of docs."""
    mixed = _mixed(docs, whole_row(docs), id_col, source_col, text_col, weights, total, most, block)
    return mixed.where("copies > 0").select(F.explode(F.array_repeat("row", F.col("copies"))).alias("row")).select("row.*")


def op4_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return entropy_mix(spark.read.parquet(f"{sf_dir}/documents.parquet"), ["doc_id"])
