"""Mixing sources to target weights by Pfair scheduling (native columns only).

Each source gets an integer weight.  The schedule has *phases*; in each, the sources that
still hold blocks share the slots by their full weights, in rounds of as many slots as
their weights' sum Q.  Within a round, block j (from 1) of a source of weight W is released
at floor((j-1) * Q / W) and due at ceil(j * Q / W); every slot goes to the released block
that is due first.  After t slots of a phase a source of weight W has had less than one
block more or less than t * W / Q.  A phase ends at the first slot that falls to a source
without blocks, so never before some source's last block is placed; the next phase starts
afresh with the other sources, and no row is dropped or repeated.

Each phase uses up a source, so there are at most n phases for n sources; a phase's
pattern is one round, at most the sum of the weights in slots.  These bounds are parameters
(weights) and the number of sources, not rows.  Where a phase ends depends on the one before:
a fold over the phases and their slots (``aggregate``) makes them all in one row.

Defined cases: a null source is a source of its own; repeated rows are all placed; an
empty table gives an empty result.  ``weights`` may name sources that have no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from fiscalflow.llm._common import number_within, saved, small


RESULT = ("weight", "block", "in_block", "slot", "release", "due")


def source_key(name):
    """Source as a non-null text: nulls stay apart from the empty name."""
    return F.when(name.isNull(), F.lit("-")).otherwise(F.concat(F.lit("+"), name.cast("string")))


def integer_weights(sources: DataFrame, weights: dict[str | None, int] | None, resolution: int, exponent: float) -> DataFrame:
    """(key, blocks) -> adds weight: the given one (1 for unnamed sources), else the source's
    share of blocks to the power ``exponent``, in ``resolution`` parts, at least 1."""
    if weights is not None:
        named = F.create_map(*[F.lit(x) for k, w in weights.items() for x in ("-" if k is None else "+" + str(k), int(w))])
        return sources.withColumn("weight", F.coalesce(named[F.col("key")], F.lit(1)).cast("long"))
    all_rows = Window.partitionBy(F.lit(1))  # one row per source
    part = F.pow(F.col("blocks").cast("double"), F.lit(exponent))
    return sources.withColumn("weight", F.greatest(F.lit(1), F.round(F.lit(resolution) * part / F.sum(part).over(all_rows))).cast("long"))


# least (deadline, source) among sources with a released block left in this round
PICK = """
array_min(filter(transform(w, (x, i) -> if(run.done[i] < x and run.done[i] * q div x <= t,
  named_struct('due', ((run.done[i] + 1) * q + x - 1) div x, 'i', i), null)),
  s -> s is not null)).i
"""

# a round of a phase: the order of its sources, and the slot ``stop`` of the phase's last round
# (the one after ``full`` whole rounds) at which a source has no block left, having ``had`` blocks
# placed in that round.  Without a whole round, slots from ``stop`` on are not needed.
ROUND = """
aggregate(sequence(0, cast(q as int) - 1),
  named_struct('done', transform(w, x -> 0L), 'order', cast(array() as array<int>), 'stop', -1, 'had', transform(w, x -> 0L)),
  (run, t) -> if(full = 0 and run.stop >= 0, run, transform(array(PICK), p -> named_struct(
      'done', transform(run.done, (d, i) -> if(i = p, d + 1L, d)),
      'order', array_append(run.order, p),
      'stop', if(run.stop < 0 and run.done[p] = left[p] - full * w[p], t, run.stop),
      'had', if(run.stop < 0 and run.done[p] = left[p] - full * w[p], run.done, run.had)))[0]))
"""

# each step of the outer fold is a phase; one-element arrays compute a value once
PHASES = """
aggregate(s,
  named_struct('left', transform(s, x -> x.blocks), 'base', 0L, 'phases', cast(array() as
    array<struct<base: bigint, q: bigint, w: array<bigint>, left: array<bigint>, order: array<int>>>)),
  (acc, one) -> if(not exists(acc.left, x -> x > 0), acc,
    transform(array(acc.left), left ->
    transform(array(transform(s, (x, i) -> if(left[i] > 0, x.weight, 0L))), w ->
    transform(array(aggregate(w, 0L, (a, x) -> a + x)), q ->
    transform(array(array_min(filter(transform(w, (x, i) -> if(x > 0, left[i] div x, null)), x -> x is not null))), full ->
    transform(array(ROUND), r -> named_struct(
      'left', transform(left, (x, i) -> x - full * w[i] - r.had[i]),
      'base', acc.base + full * q + r.stop,
      'phases', array_append(acc.phases, named_struct('base', acc.base, 'q', q, 'w', w, 'left', left, 'order', r.order))
    ))[0])[0])[0])[0])[0]),
  acc -> acc.phases)
"""


def phase_schedules(sources: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The phases' patterns and where they begin in each source.

    ``sources``: key, blocks, weight.  Patterns have (phase, base, q, key, j, slot_in_round,
    release, due), with ``base`` the slot at which the phase begins.  The second frame has
    (key, starts): an array of (start, phase), the source's first block not placed before the phase.
    """
    listed = sources.agg(F.sort_array(F.collect_list(F.struct("key", "weight", "blocks"))).alias("s"))
    fold = PHASES.replace("ROUND", ROUND.strip()).replace("PICK", PICK.strip())
    phases = saved(listed.withColumn("phases", F.expr(fold)).select("s", F.posexplode("phases").alias("phase", "p")))  # at most n rows
    starts = (phases.select("phase", F.expr("explode(transform(s, (x, i) -> named_struct('key', x.key, 'start', x.blocks - p.left[i])))").alias("x"))
              .groupBy("x.key").agg(F.collect_list(F.struct("x.start", "phase")).alias("__starts")))
    slots = phases.repartition(64, "phase").select("phase", "s", "p", F.posexplode("p.order").alias("slot_in_round", "i"))
    slots = slots.select("phase", "p.base", "p.q", F.expr("s[i].key").alias("key"), F.expr("p.w[i]").alias("w"), "slot_in_round")
    j = F.row_number().over(Window.partitionBy("phase", "key").orderBy("slot_in_round")) - 1
    slots = slots.withColumn("j", j.cast("long"))
    return slots.select("phase", "base", "q", "key", "j", F.col("slot_in_round").cast("long").alias("slot_in_round"),
                        F.expr("j * q div w").alias("release"),
                        F.expr("((j + 1) * q + w - 1) div w").alias("due")), starts


def mix(df: DataFrame, source: str = "source", weights: dict[str | None, int] | None = None, block_rows: int = 16,
        resolution: int = 1000, exponent: float = 0.7) -> DataFrame:
    """The rows of ``df`` (narrow) with their place in the mix.

    Adds weight, block (from 0 in the source), slot (global block number), in_block, and
    release and due, the slots between which the block has to be placed; columns of ``df``
    with these names are replaced.
    Without ``weights`` each source's target share is its share of blocks to the power
    ``exponent``, normalized.
    """
    d = df.withColumn("__src", source_key(F.col(source))).drop(*RESULT)
    numbered = saved(number_within(d, "__src", "__row"))
    sources = numbered.groupBy(F.col("__src").alias("key")).agg(
        F.ceil(F.count(F.lit(1)) / F.lit(block_rows)).cast("long").alias("blocks"))
    weighted = saved(integer_weights(sources, weights, resolution, exponent))
    plan, starts = phase_schedules(weighted)
    plan = saved(plan)  # at most n * sum of weights rows
    w = saved(weighted.join(starts, "key").select(F.col("key").alias("__src"), "weight", "__starts"))
    n = numbered.join(small(w, 100_000), "__src").withColumn("block", F.expr(f"__row div {int(block_rows)}"))
    n = n.withColumn("__at", F.expr("array_max(filter(__starts, x -> x.start <= block))")).drop("__starts")
    n = n.withColumn("__round", F.expr("(block - __at.start) div weight")).withColumn("__j", F.expr("(block - __at.start) % weight"))
    n = n.withColumn("__phase", F.col("__at.phase")).drop("__at")
    p = plan.select(F.col("key").alias("__src"), F.col("phase").alias("__phase"), F.col("j").alias("__j"), "base", "q",
                    "slot_in_round", "release", "due")
    n = n.join(small(p, 200_000), ["__src", "__phase", "__j"])
    begin = F.col("base") + F.col("__round") * F.col("q")
    return (n.withColumn("slot", begin + F.col("slot_in_round"))
            .withColumn("release", begin + F.col("release")).withColumn("due", begin + F.col("due"))
            .withColumn("in_block", (F.col("__row") % F.lit(block_rows)).cast("long"))
            .drop("__src", "__row", "__round", "__j", "__phase", "base", "q", "slot_in_round"))


def mixed_order(df: DataFrame, source: str = "source", stable: bool = False, **options) -> DataFrame:
    """All rows and columns of ``df``, written out in the order of the mix.

    The rows' places are worked out on the source column alone and joined back by row
    number; the result is range-partitioned and sorted by place, so that its files, read in
    name order, hold the mix.  The numbered rows are saved, unless ``df`` is ``stable``: a scan of files.
    """
    # the columns of df stay together in a struct, so none can clash
    d = df.select(F.monotonically_increasing_id().alias("row"), F.struct(*[df[f"`{c}`"] for c in df.columns]).alias("all"))
    if not stable:
        d = saved(d)
    places = mix(d.select("row", F.col("all")[source].alias("s")), "s", **options).select("row", F.struct("slot", "in_block").alias("place"))
    return d.join(places, "row").repartitionByRange("place").sortWithinPartitions("place").select("all.*")
