"""Exact per-key quantiles without gathering a group into one task.

Spark's exact ``percentile`` keeps every value of a group in one aggregation
buffer, so a key holding a third of the rows would land in one task. Here the
q-quantile of a key is the value at rank r = max(1, ceil(q * n)) (the
smallest value whose cumulative count reaches q * n), found by bracketing:

  round 0   per key: n (one partial/final aggregate)
  round i   per (key, q): a bounded quantile sketch of the candidates in
            (lo, hi] gives a grid of approximate percentiles; the grid points
            around the wanted rank become the new bracket, and an exact count
            pass checks it (a side that would lose the target is kept as it
            was), so correctness never depends on the sketch's error bound
  finish    once every (key, q) has at most ``limit`` candidates, a window
            ``row_number`` over those candidates picks rank r - below

When refinement is needed the (key, value) columns are checkpointed once, so
the rounds do not re-run the pipeline that produced the values.

Each round shrinks the candidates by a factor of about G/2 (G = grid points),
so 100 TB needs two or three rounds. The driver only loops over rounds and
reads per-round maxima; the bracket table has one row per (key, q).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, functions as F

from candlewick.session import bounded_broadcast

GRID_POINTS = 1000


def _join_on_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Null-safe equi-join on ``keys`` (a NULL key is a group like any other)."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond).drop(*[f"_r_{k}" for k in keys])


def _left_on_keys(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(r[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(r, cond, "left").drop(*[f"_r_{k}" for k in keys])


def exact_quantiles(df: DataFrame, value: str, qs=(0.5, 0.95, 0.99), keys=("symbol",),
                    limit: int = 100_000, accuracy: int = 10_000, max_rounds: int = 10) -> DataFrame:
    """Per-key exact quantiles (the same definition as ``quantiles``) with
    memory per task bounded by ``limit`` and the sketch size.

    Grid points are data values, so a heavily repeated value is settled as
    soon as it is a grid point: if count(x < v) < r <= count(x <= v) the
    answer is v, and its duplicates are never sorted."""
    from candlewick.session import checkpoint_root
    checkpoint_root(df.sparkSession)
    keys = list(keys)
    # keys and value are written once (reliable checkpoint in the shared folder): the
    # count, the rounds and the final pick read them, never what produced them
    base = df.select(*keys, F.col(value).cast("double").alias("_x")).where(F.col("_x").isNotNull()).checkpoint()
    counts = base.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    qarr = F.array(*[F.lit(float(q)) for q in qs])
    state = counts.select(*keys, F.posexplode(qarr).alias("_qi", "_q"), "_n")
    state = state.select(*keys, "_qi",
                         F.greatest(F.lit(1), F.ceil(F.col("_q") * F.col("_n"))).cast("long").alias("_r"),
                         F.lit(float("-inf")).alias("_lo"), F.lit(float("inf")).alias("_hi"),
                         F.lit(0).cast("long").alias("_below"), F.col("_n").alias("_m"),
                         F.lit(None).cast("double").alias("_ans"))
    cols = [*keys, "_qi", "_r", "_lo", "_hi", "_below", "_m", "_ans"]
    grid = [i / GRID_POINTS for i in range(GRID_POINTS + 1)]
    margin = 2.0 / accuracy
    in_bracket = (F.col("_x") > F.col("_lo")) & (F.col("_x") <= F.col("_hi")) & F.col("_ans").isNull()
    n_groups = None
    for _ in range(max_rounds):
        top = state.agg(F.max(F.when(F.col("_ans").isNull(), F.col("_m"))).alias("m"),
                        F.count(F.lit(1)).alias("g")).first()
        n_groups = top["g"]
        if top["m"] is None or top["m"] <= limit:
            break
        cand = _join_on_keys(base, bounded_broadcast(state, n_groups), keys).where(in_bracket)
        sketch = cand.groupBy(*keys, "_qi").agg(F.percentile_approx("_x", grid, accuracy).alias("_g"))
        want = F.try_divide((F.col("_r") - F.col("_below")).cast("double"), F.col("_m").cast("double"))
        lo_i = F.floor((want - F.lit(margin)) * F.lit(GRID_POINTS)) - F.lit(1)
        hi_i = F.ceil((want + F.lit(margin)) * F.lit(GRID_POINTS)) + F.lit(1)
        prop = _left_on_keys(state, sketch, keys + ["_qi"]).select(
            *cols,
            F.when(lo_i >= 0, F.element_at("_g", (lo_i + 1).cast("int"))).alias("_lo2"),
            F.when(hi_i <= GRID_POINTS, F.element_at("_g", (hi_i + 1).cast("int"))).alias("_hi2"))
        prop = (prop.withColumn("_lo2", F.greatest("_lo", F.coalesce("_lo2", "_lo")))
                .withColumn("_hi2", F.least("_hi", F.coalesce("_hi2", "_hi"))))
        chk = _join_on_keys(base, bounded_broadcast(prop, n_groups), keys).where(in_bracket)
        x = F.col("_x")
        c = chk.groupBy(*keys, "_qi").agg(
            F.count_if(x < F.col("_lo2")).alias("_lt_lo"), F.count_if(x <= F.col("_lo2")).alias("_le_lo"),
            F.count_if(x < F.col("_hi2")).alias("_lt_hi"), F.count_if(x <= F.col("_hi2")).alias("_le_hi"))
        nxt = _left_on_keys(prop, c, keys + ["_qi"]).fillna(0, ["_lt_lo", "_le_lo", "_lt_hi", "_le_hi"])
        want_r = F.col("_r") - F.col("_below")
        lo_ok = F.col("_le_lo") < want_r
        hi_ok = F.col("_le_hi") >= want_r
        hit_lo = (F.col("_lt_lo") < want_r) & (F.col("_le_lo") >= want_r)
        hit_hi = (F.col("_lt_hi") < want_r) & (F.col("_le_hi") >= want_r)
        ans = (F.when(F.col("_ans").isNotNull(), F.col("_ans"))
               .when(hit_lo, F.col("_lo2")).when(hit_hi, F.col("_hi2")))
        in_lo = F.when(lo_ok, F.col("_le_lo")).otherwise(F.lit(0))
        in_hi = F.when(hi_ok, F.col("_le_hi")).otherwise(F.col("_m"))
        state = nxt.select(
            *keys, "_qi", "_r",
            F.when(lo_ok, F.col("_lo2")).otherwise(F.col("_lo")).alias("_lo"),
            F.when(hi_ok, F.col("_hi2")).otherwise(F.col("_hi")).alias("_hi"),
            (F.col("_below") + in_lo).alias("_below"), (in_hi - in_lo).alias("_m"), ans.alias("_ans"))
        # The bracket table is tiny (one row per key and q); a reliable
        # checkpoint cuts its lineage so later rounds do not replay earlier ones.
        state = state.checkpoint(eager=True)
    else:
        raise RuntimeError("quantile brackets did not converge")
    st = bounded_broadcast(state, n_groups if n_groups is not None else math.inf)
    cand = _join_on_keys(base, st, keys).where(in_bracket)
    w = Window.partitionBy(*keys, "_qi").orderBy("_x")
    picked = cand.withColumn("_rn", F.row_number().over(w)).where(
        F.col("_rn") == F.col("_r") - F.col("_below")).select(*keys, "_qi", "_x")
    settled = state.where(F.col("_ans").isNotNull()).select(*keys, "_qi", F.col("_ans").alias("_x"))
    both = picked.unionByName(settled)
    return both.groupBy(*keys).agg(*[
        F.max(F.when(F.col("_qi") == i, F.col("_x"))).alias(f"p{int(round(q * 100))}")
        for i, q in enumerate(qs)])
