"""Mixing sources to target weights by the cube method.

Each source's rate is its target over its size.  A document gets the whole
part of the rate as copies; the fraction is an inclusion probability.  The
flight phase moves the probabilities of three documents at a time along the
null space of the balancing constraints (sum of sizes, number of documents)
until one of them is 0 or 1, so both totals stay as they are at every step.
It runs on fixed chunks of each source in parallel; what stays fractional
(at most two documents a chunk) meets in the next round, until each source has
one chunk and at most two fractional documents, which the landing phase rounds
to the side nearer to the target.

Rows that repeat id and text are summed to one row with a number, which is cut
into blocks that go to different chunks and become rows again there: they
may be a third of all rows and still fill no chunk.

Cases: null text has size 0; a null source is a source of its own, last in
order; repeated rows are sampled one by one; a source of size 0 has target 0;
an empty table gives no rows.  Reruns agree: order and draws come from hashes.
"""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from snapvault.llm.common import arrow_limits, stored, text_hash, utf8

CHUNK_ROWS = 4096
BLOCK_ROWS = 256  # repeats of one row that go to a chunk together
EPS = 1e-9
STATE = "doc_id long, source string, size long, rate double, prob double, tie long, number long"


def sizes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """doc_id, source, size: words, that is runs of other than ASCII white space."""
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{source_col}`").cast("string").alias("source"),
                       utf8(f"`{text_col}`").alias("body"), text_hash(f"`{text_col}`").alias("tie"))
    arrow_limits(docs.sparkSession)
    return rows.mapInArrow(_count_words, "doc_id long, source string, size long, tie long")


def _count_words(batches):
    for b in batches:
        # bytes.split() parts at space and 09-0D, no other white space
        n = pa.array([len(x.split()) for x in b.column("body").to_pylist()], pa.int64())
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("source"), n, b.column("tie")],
                                         names=["doc_id", "source", "size", "tie"])


def targets(sized: DataFrame, weights=(3, 1, 2), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """source, source_size, target: ``share`` of all sizes by weight, each target at most ``most`` times its source.

    Sources in code-point order, null last, take the weights in turn.  The
    excess of full sources is shared again by weight until none is above its
    limit: with sources sorted by limit over weight, a source is full when
    the level that those not yet full would share reaches its limit.  One row
    a source: sizes are summed before the shuffle.
    """
    by = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_rows"))
    order = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (order % len(weights) + 1).cast("int"))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    first = Window.orderBy("full_at", "rank").rowsBetween(Window.unboundedPreceding, -1)
    s = (by.withColumn("rank", order).withColumn("weight", weight)
         .withColumn("cap", F.col("source_size") * F.lit(float(most)))
         .withColumn("full_at", F.col("cap") / F.col("weight"))
         .withColumn("all_words", F.sum("source_size").over(every) * F.lit(float(share)))
         .withColumn("all_weight", F.sum("weight").over(every))
         .withColumn("cap_before", F.coalesce(F.sum("cap").over(first), F.lit(0.0)))
         .withColumn("weight_before", F.coalesce(F.sum("weight").over(first), F.lit(0.0)))
         .withColumn("level", (F.col("all_words") - F.col("cap_before")) / (F.col("all_weight") - F.col("weight_before")))
         .withColumn("full", F.col("level") >= F.col("full_at")))
    level = F.min(F.when(~F.col("full"), F.struct("full_at", "rank", "level"))).over(every)["level"]
    return (s.withColumn("water", level)
            .withColumn("target", F.when(F.col("full") | F.col("water").isNull(), F.col("cap"))
                        .otherwise(F.col("water") * F.col("weight")))
            .select("source", "source_size", "n_rows", "target"))


def fly(probs: list[float], size: list[int], rng: random.Random) -> None:
    """Flight phase in place: afterwards at most two probabilities are fractional.

    Three documents have one direction that changes neither the sum of sizes
    nor the number of documents: the cross product of both constraint rows.
    Of the two ways along it, each is drawn so that expectations stay.
    """
    active: list[int] = []
    for k in range(len(probs)):
        if EPS < probs[k] < 1 - EPS:
            active.append(k)
        while len(active) == 3:
            a, b, c = active
            u = (size[b] - size[c], size[c] - size[a], size[a] - size[b])
            if not any(u):
                u = (1, -1, 0)
            up = min((1 - probs[i]) / x if x > 0 else probs[i] / -x for i, x in zip(active, u) if x)
            down = min(probs[i] / x if x > 0 else (1 - probs[i]) / -x for i, x in zip(active, u) if x)
            step = up if rng.random() * (up + down) < down else -down
            for i, x in zip(active, u):
                p = probs[i] + step * x
                probs[i] = 0.0 if p <= EPS else 1.0 if p >= 1 - EPS else p
            active = [i for i in active if 0.0 < probs[i] < 1.0]


def land(probs: list[float], size: list[int]) -> None:
    """Landing phase in place: of the roundings of the few fractional documents, the one nearest to their sum."""
    left = [k for k, p in enumerate(probs) if 0.0 < p < 1.0]
    want = sum(probs[k] * size[k] for k in left)
    best = min(range(1 << len(left)),
               key=lambda m: (abs(sum(size[k] for j, k in enumerate(left) if m >> j & 1) - want), m))
    for j, k in enumerate(left):
        probs[k] = float(best >> j & 1)


def numbered_repeats(rows: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Rows that are alike, summed: ``number`` of the first of a block and ``times`` rows in it."""
    times = rows.groupBy(*rows.columns).agg(F.count("*").alias("times"))
    block = F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1, F.lit(block_rows).cast("long")))
    return (times.select(*times.columns, block.alias("number"))
            .withColumn("times", F.least(F.col("times") - F.col("number"), F.lit(block_rows)).cast("long")))


def _fly_chunks(last: bool):
    def run(key, table):
        table = table.sort_by([(k, "ascending") for k in ("tie", "doc_id", "size", "number")])
        times = table["times"].to_numpy()
        first = np.repeat(np.cumsum(times) - times, times)
        at = np.repeat(np.arange(len(times)), times)
        number = table["number"].to_numpy()[at] + np.arange(len(at)) - first
        table = table.take(pa.array(at)).set_column(table.schema.get_field_index("number"), "number", pa.array(number, pa.int64()))
        probs, size = table["prob"].to_pylist(), table["size"].to_pylist()
        source, chunk = key[0].as_py(), key[1].as_py()
        fly(probs, size, random.Random(f"{source}/{chunk}/{len(probs)}"))
        if last:
            land(probs, size)
        table = table.set_column(table.schema.get_field_index("prob"), "prob", pa.array(probs, pa.float64()))
        return table.select([x.split()[0] for x in STATE.split(", ")])

    return run


def cube_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights=(3, 1, 2), share: float = 1.5, most: float = 2.0, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, copies, taken, text_hash."""
    sized = stored(sizes(docs, id_col, text_col, source_col), "mix-sizes")
    goal = stored(targets(sized, weights, share, most), "mix-targets")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    g = goal.select(F.col("source").alias("g_source"), rate.alias("rate"))
    state = (sized.join(g, F.col("source").eqNullSafe(F.col("g_source")))
             .withColumn("prob", F.col("rate") - F.floor("rate"))
             .select("doc_id", "source", "size", "rate", "prob", "tie"))
    state = state.withColumn("prob", F.when(F.col("prob") <= EPS, 0.0).when(F.col("prob") >= 1 - EPS, 1.0)
                             .otherwise(F.col("prob")))
    fractional = (F.col("prob") > 0) & (F.col("prob") < 1)
    decided = [state.where(~fractional)]
    todo, level = numbered_repeats(state.where(fractional)), 0
    while True:
        # chunks per source from its own row count, so that a hot source is cut into as many as it needs
        n = stored(todo.groupBy("source").agg(F.ceil(F.sum("times") / chunk_rows).cast("long").alias("n_chunks"))
                   .withColumnRenamed("source", "n_source"), "mix-chunks")
        most_chunks = n.agg(F.max("n_chunks")).first()[0] or 0
        if not most_chunks:
            break
        chunk = F.pmod(F.xxhash64("doc_id", "tie", "number", F.lit(level)), F.col("n_chunks"))
        flown = stored(
            todo.join(n, F.col("source").eqNullSafe(F.col("n_source"))).withColumn("chunk", chunk)
            .drop("n_source", "n_chunks").groupBy("source", "chunk")
            .applyInArrow(_fly_chunks(most_chunks == 1), STATE), "mix-flight")
        decided.append(flown.where(~fractional))
        if most_chunks == 1:
            break
        todo, level = flown.where(fractional).withColumn("times", F.lit(1).cast("long")), level + 1
    rows = decided[0].withColumn("number", F.lit(0).cast("long"))
    for more in decided[1:]:
        rows = rows.unionByName(more)
    t = goal.select(F.col("source").alias("t_source"), "source_size", "target")
    copies = F.floor("rate") + (F.col("prob") == 1).cast("long")
    return (rows.join(t, F.col("source").eqNullSafe(F.col("t_source")))
            .select("doc_id", "source", "size", "source_size", "target", copies.cast("long").alias("copies"),
                    (copies * F.col("size")).cast("long").alias("taken"), F.col("tie").alias("text_hash")))


def mixed_rows(docs: DataFrame, mix: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with every row as often as the mix takes it; columns unchanged."""
    names = docs.columns
    # of rows that repeat an id and a text, the copies are summed and given to one
    m = mix.groupBy(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__kh")).agg(F.sum("copies").alias("__c"))
    w = Window.partitionBy(F.col(f"`{id_col}`"), F.col("__h")).orderBy(F.lit(0))
    joined = docs.withColumn("__h", text_hash(f"`{text_col}`")).join(
        m.where("__c > 0"), F.col(f"`{id_col}`").eqNullSafe(F.col("__id")) & (F.col("__h") == F.col("__kh")))
    one = joined.withColumn("__n", F.row_number().over(w)).where("__n = 1")
    return (one.withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__c"))))
            .select(*[F.col(f"`{c}`") for c in names]))
