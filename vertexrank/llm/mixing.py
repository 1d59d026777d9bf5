"""Mixing sources to target weights by entropy balancing.

Every source gets a target number of words; every document a rate between 0
and ``cap`` copies. Among all rates that meet the targets, entropy balancing
takes those closest (in relative entropy, each of a document's ``cap`` copy
slots being kept or not) to one common base rate. The convex dual has one
multiplier per source, its token constraint, and the primal solution tilts the
odds of the base rate exponentially by document size:

    rate(d) = cap * sigmoid(log(base / (cap - base)) + lambda(source) * size / mean size)

The dual's gradient and (diagonal) Hessian are sums over the documents of a
source; they are taken over the histogram (source, size), which is aggregated
once, in safeguarded Newton steps for all sources together.

Rates become whole copies: the floor, plus one more for documents in the order
of hash / fraction until the target is reached, found by cumulative sums over
a refined histogram of that order (no sort of a source's documents), then two
more passes that fill what is left with documents small enough.

Everything is DataFrame expressions and aggregates. A third of all rows may
belong to one source: sources are only ever aggregated partially first.

Defined cases: a null source is a source, last in order; null or empty text has
size 0 and takes 0 words; equal sizes and repeated rows are decided by the hash
of (doc_id, size), so repeated rows of one id are treated alike; other columns
are passed through; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BROADCAST_MAX_BYTES, cut, final, scratch, shuffle_partitions

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
NEWTON_STEPS = 60
LEVELS, LEVEL_BITS = 3, 10
ORDER_BITS = LEVELS * LEVEL_BITS


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def _join(rows: DataFrame, params: DataFrame) -> DataFrame:
    """Attach the one-row-per-source table (materialised) on a null-safe source."""
    small = params.count() * 200 <= BROADCAST_MAX_BYTES
    params = params.withColumnRenamed("source", "__s")
    side = F.broadcast(params) if small else params.hint("merge")
    return rows.join(side, F.col("source").eqNullSafe(F.col("__s"))).drop("__s")


def source_targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """``source, source_size, docs, weight, target`` from rows ``source, size``.

    Weights repeat over the sources by code point, null last. Words are shared
    by weight; a target stops at ``cap`` times its source's size and the excess
    is shared again by weight until none is above."""
    spark = sized.sparkSession
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum((F.col("size") > 0).cast("long")).alias("docs"))
    # positions in order from counts per range, so that no task sees all sources
    order = [F.col("source").isNull(), F.col("source")]
    dealt = cut(sums.repartitionByRange(shuffle_partitions(spark), *order).withColumn("part", F.spark_partition_id()))
    before = dealt.groupBy("part").agg(F.count("*").alias("n"))
    before = before.withColumn("before", F.sum("n").over(Window.orderBy("part")) - F.col("n")).drop("n")
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1 + F.col("before")
    choice = F.array(*[F.lit(int(w)) for w in weights])
    ranked = cut(
        dealt.join(F.broadcast(before), "part")
        .withColumn("weight", F.get(choice, (place % len(weights)).cast("int")))
        .select("source", "source_size", "docs", "weight")
    )
    total, per = ranked.agg(F.sum("source_size"), F.sum("weight")).head()
    if not per:
        return ranked.withColumn("target", F.lit(0.0))
    level = share * total / per
    while True:
        capped = F.lit(level) * F.col("weight") > cap * F.col("source_size")
        full, free = ranked.agg(
            F.sum(F.when(capped, cap * F.col("source_size")).otherwise(0)), F.sum(F.when(~capped, F.col("weight")).otherwise(0))
        ).head()
        if not free:
            break
        now = (share * total - full) / free
        if now <= level:
            break
        level = now
    return cut(ranked.withColumn("target", F.least((cap * F.col("source_size")).cast("double"), F.lit(level) * F.col("weight"))))


def _rate(share: float, cap: int) -> Column:
    """Copies of a document of ``size`` in its source, from the multiplier ``lam``."""
    base = F.log(F.lit(share / (cap - share)))
    tilt = base + F.col("lam") * F.col("size") / F.col("unit")
    return F.when(F.col("full"), F.lit(float(cap))).otherwise(cap / (1 + F.exp(-F.greatest(F.lit(-700.0), F.least(F.lit(700.0), tilt)))))


def balance(sized: DataFrame, targets: DataFrame, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """``targets`` plus the solved multiplier: ``unit, full, lam``."""
    hist = cut(sized.where("size > 0").groupBy("source", "size").agg(F.count("*").alias("n")))
    state = cut(
        targets.withColumn("unit", F.greatest(F.col("source_size") / F.greatest("docs", F.lit(1)), F.lit(1.0)))
        .withColumn("full", F.col("target") >= cap * F.col("source_size") * (1 - 1e-9))
        .withColumn("lam", F.lit(0.0))
        .withColumn("lo", F.lit(-float(1 << 24)))
        .withColumn("hi", F.lit(float(1 << 24)))
    )
    for _ in range(NEWTON_STEPS):
        r = _rate(share, cap)
        words = F.col("n") * F.col("size")
        sums = _join(hist, state.select("source", "unit", "full", "lam")).groupBy("source").agg(
            F.sum(words * r).alias("got"), F.sum(words * F.col("size") / F.col("unit") * r * (1 - r / cap)).alias("slope")
        )
        sums = sums.withColumnRenamed("source", "__t")
        off = F.coalesce("got", F.lit(0.0)) - F.col("target")
        lo = F.when(off < 0, F.col("lam")).otherwise(F.col("lo"))
        hi = F.when(off > 0, F.col("lam")).otherwise(F.col("hi"))
        newton = F.col("lam") - F.when(F.col("slope") > 0, off / F.col("slope"))
        done = F.col("full") | (F.abs(off) <= 0.5) | (F.col("source_size") == 0)
        inside = (newton > lo) & (newton < hi)
        # rounded, so that the order of summation cannot show in a rerun
        step = F.when(done, F.col("lam")).otherwise(F.round(F.when(inside, newton).otherwise((lo + hi) / 2), 9))
        state = cut(
            state.join(sums, F.col("source").eqNullSafe(F.col("__t")), "left").select(
                "source", "source_size", "docs", "weight", "target", "unit", "full", step.alias("lam"), lo.alias("lo"), hi.alias("hi"), (~done).alias("open")
            )
        )
        if not state.where("open").head(1):
            break
    return state.drop("lo", "hi", "open")


def _fill(rows: DataFrame, budgets: DataFrame) -> DataFrame:
    """``source, limit, used``: the largest ``limit`` such that the rows (``source,
    o, size``) with ``o < limit`` sum to at most the source's ``budget``."""
    at = cut(budgets.select("source", "budget", F.lit(0).cast("long").alias("limit"), F.lit(0).cast("long").alias("used")))
    for level in range(1, LEVELS + 1):
        width = 1 << (ORDER_BITS - level * LEVEL_BITS)
        span = width << LEVEL_BITS
        near = _join(rows, at.drop("budget", "used")).where(F.col("o").between(F.col("limit"), F.col("limit") + span - 1))
        bins = near.groupBy("source", F.floor((F.col("o") - F.col("limit")) / width).cast("int").alias("b")).agg(F.sum("size").alias("sum"))
        # at most 2 ** LEVEL_BITS rows per source
        run = bins.withColumn("run", F.sum("sum").over(Window.partitionBy("source").orderBy("b")))
        run = _join(run, at.select("source", "budget", "used"))
        fits = F.col("used") + F.col("run") <= F.col("budget")
        best = run.groupBy("source").agg(
            F.coalesce(F.max(F.when(fits, F.col("run"))), F.lit(0)).alias("more"),
            F.coalesce(F.min(F.when(~fits, F.col("b"))), F.lit(1 << LEVEL_BITS)).alias("stop"),
        ).withColumnRenamed("source", "__t")
        at = cut(
            at.join(best, F.col("source").eqNullSafe(F.col("__t")), "left").select(
                "source",
                "budget",
                (F.col("limit") + F.coalesce("stop", F.lit((1 << LEVEL_BITS) - 1)) * width).alias("limit"),
                (F.col("used") + F.coalesce("more", F.lit(0))).alias("used"),
            )
        )
    return at.select("source", "limit", "used")


def _with_copies(rows: DataFrame, share: float, cap: int, passes: int) -> DataFrame:
    """``rows`` (joined with the parameters) plus ``rate``, ``copies`` after
    ``passes`` filling passes, and ``o``, the order of the next pass."""
    top = float(1 << ORDER_BITS)
    rate = F.col("rate")
    rows = rows.withColumn("rate", _rate(share, cap))
    rows = rows.withColumn("h", F.pmod(F.xxhash64("doc_id", "size"), F.lit(1 << 52)) / float(1 << 52))
    rows = rows.withColumn("copies", F.floor(rate + 1e-12).cast("int"))
    rows = rows.withColumn("turn", F.col("h") / F.greatest(rate - F.col("copies"), F.lit(1e-12)))
    rows = rows.withColumn("o", F.floor(F.col("turn") / (1 + F.col("turn")) * top).cast("long"))
    for k in range(passes):
        may = (F.col("size") > 0) & (F.col("copies") < cap) & (F.col("o") < F.col(f"limit{k}"))
        if k:
            may = may & (F.col("size") <= F.col(f"left{k}"))
        rows = rows.withColumn("copies", F.col("copies") + may.cast("int"))
        if k == 0:
            rows = rows.withColumn("o", F.floor(F.col("h") * top).cast("long"))
    return rows.drop("h", "turn")


def mix_parameters(sized: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP, passes: int = 3) -> DataFrame:
    """One row per source with all that decides its documents' copies; ``sized``
    is ``doc_id, source, size`` (materialised)."""
    params = balance(sized, source_targets(sized, weights, share, cap), share, cap)
    for k in range(passes):
        rows = cut(_with_copies(_join(sized, params), share, cap, k).select("source", "size", "copies", "o"))
        got = rows.groupBy("source").agg(F.sum(F.col("copies") * F.col("size")).alias("got")).withColumnRenamed("source", "__t")
        params = cut(
            params.join(got, F.col("source").eqNullSafe(F.col("__t")), "left")
            .withColumn(f"left{k}", F.greatest(F.lit(0.0), F.col("target") - F.coalesce("got", F.lit(0))))
            .drop("__t", "got")
        )
        budgets = params.select("source", F.col(f"left{k}").alias("budget"))
        fit = rows.where(f"copies < {cap} and size > 0").select("source", "o", "size")
        if k:
            fit = _join(fit, budgets).where("size <= budget").drop("budget")
        limits = _fill(fit, budgets).select(F.col("source").alias("__t"), F.col("limit").alias(f"limit{k}"))
        params = cut(params.join(limits, F.col("source").eqNullSafe(F.col("__t")), "left").drop("__t"))
    return params


def apply_mix(rows: DataFrame, params: DataFrame, share: float = SHARE, cap: int = CAP, passes: int = 3) -> DataFrame:
    """``rows`` (with ``doc_id, source, size``) plus ``source_size, target, rate,
    copies, taken``."""
    out = _with_copies(_join(rows, params), share, cap, passes)
    out = out.withColumn("taken", (F.col("copies") * F.col("size")).cast("long"))
    return out.select(*[f"`{c}`" for c in rows.columns], "source_size", "target", "rate", "copies", "taken")


def mix_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """The mix as a recipe: ``doc_id, source, size, source_size, target, rate,
    copies, taken`` of every row of ``docs``."""
    with scratch(docs.sparkSession):
        sized = cut(docs.select("doc_id", "source", n_words().alias("size")))
        return final(apply_mix(sized, mix_parameters(sized, weights, share, cap), share, cap))
