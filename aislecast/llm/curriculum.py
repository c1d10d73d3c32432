"""Mixing sources to target weights by a time-varying curriculum.

Every source gets a word target from its weight. A schedule says how the
source's share of the stream changes over training time; its integral, scaled
to the target, is the source's cumulative demand D(t). A document that covers
words c .. c + n of its source's stream is due when demand reaches c, so its
training position is the inverse of D at c, and the mix is a range sort by
position. Everything is built-in functions, joins and windows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aislecast.llm.common import WORD, text_of
from aislecast.session import stage

# Relative demand at the start and the end of training, repeating over the
# sources in the order of their names; it changes linearly in between.
SCHEDULES = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0


def _cycle(values: Sequence[float], index: Column) -> Column:
    """The value of a short parameter list at a 0-based index, repeating."""
    return F.element_at(F.array(*(F.lit(float(v)) for v in values)), (index % len(values) + 1).cast("int"))


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP
) -> DataFrame:
    """One row per source: its size, target and place in the order of names.

    The level to which weights are filled is found in closed form. Sources that
    reach their cap come first in the order of size over weight; with the first
    k of them at their cap the rest would get level(k) per weight, and the true
    level is the largest of these. The windows run over one row per source.
    """
    names = Window.orderBy(F.col("source").asc_nulls_last())
    totals = (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("sid", F.row_number().over(names) - 1)
        .withColumn("weight", _cycle(weights, F.col("sid")))
    )
    everything = Window.partitionBy()
    fill = Window.orderBy(F.col("source_size") / F.col("weight"), "sid")
    capped = F.coalesce(
        F.sum("source_size").over(fill.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
    )
    rest = F.sum("weight").over(fill.rowsBetween(0, Window.unboundedFollowing))
    level = (F.lit(share) * F.sum("source_size").over(everything) - F.lit(cap) * capped) / rest
    return (
        totals.withColumn("_level", level)
        .withColumn("_level", F.max("_level").over(everything))
        .withColumn(
            "target", F.least(F.lit(cap) * F.col("source_size"), F.col("_level") * F.col("weight"))
        )
        .select("source", "sid", "source_size", "target")
    )


def _due(offset: Column, target: Column, schedules: Sequence[tuple[float, float]], sid: Column) -> Column:
    """The time in [0, 1] at which demand reaches an offset.

    Relative demand a + (b - a) t has the integral a t + (b - a) t^2 / 2; the
    root is written so that it also holds for a = b.
    """
    a = _cycle([s[0] for s in schedules], sid)
    b = _cycle([s[1] for s in schedules], sid)
    reached = (a + b) / 2.0 * offset / target
    return F.when(target > 0, 2.0 * reached / (a + F.sqrt(a * a + 2.0 * (b - a) * reached)))


def plan_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    whole: bool = False,
    keep: Sequence[str] = (),
    schedules: Sequence[tuple[float, float]] = SCHEDULES,
) -> DataFrame:
    """What the mix takes of every row: one output row per input row.

    Returns doc_id, source, size, source_size, target, epochs (whole takes),
    part (words of one more take), taken (all its words), start (its offset in
    the source's stream), sid and position (when its first take is due).

    A source gives as many whole epochs as fit into its target; the rest is
    taken from the front of its order, which is by md5 of the id. The row on
    the border gives only the words missing to the target; with whole=True it
    is taken in full or not at all, whichever is nearer. Columns named in keep
    go along.

    Null or wordless text has size 0 and is never taken. A null source is one
    source of its own, last in order. Rows of equal id, also null ones, stay
    apart; their order is by size. No rows give no rows. Other columns, also
    ones named like the result's, are ignored. One source may hold most rows:
    offsets are sums over buckets of the md5, so no window holds a source.
    """
    sized = stage(
        docs.select(
            F.col(id_col).alias("doc_id"),
            F.col(source_col).alias("source"),
            F.regexp_count(text_of(text_col), F.lit(WORD)).cast("long").alias("size"),
            *keep,
        ),
        "mix-sizes",
    )
    targets = source_targets(sized, weights, share, cap)
    key = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    keyed = (
        sized.withColumnRenamed("source", "_source")
        .join(targets, F.col("_source").eqNullSafe(F.col("source")))
        .drop("_source")
        .withColumn("_key", key)
        .withColumn("_bucket", F.substring("_key", 1, 4))
    )
    before = (Window.unboundedPreceding, -1)

    def earlier(rows: DataFrame, within: list[str], by: str, out: str) -> DataFrame:
        """Words of a source in earlier buckets of the same group."""
        inside = Window.partitionBy(*within).orderBy(by).rowsBetween(*before)
        return rows.withColumn(out, F.coalesce(F.sum("_words").over(inside), F.lit(0)))

    # 256 groups of 256 buckets each, so that no window has more rows than that
    fine = keyed.groupBy("sid", "_bucket").agg(F.sum("size").alias("_words"))
    fine = fine.withColumn("_group", F.substring("_bucket", 1, 2))
    coarse = fine.groupBy("sid", "_group").agg(F.sum("_words").alias("_words"))
    coarse = earlier(coarse, ["sid"], "_group", "_groups").drop("_words")
    buckets = (
        earlier(fine, ["sid", "_group"], "_bucket", "_own")
        .join(coarse, ["sid", "_group"])
        .select("sid", "_bucket", (F.col("_groups") + F.col("_own")).alias("_before"))
    )
    inside = Window.partitionBy("sid", "_bucket").orderBy("_key", "doc_id", "size").rowsBetween(*before)
    start = F.col("_before") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    full = F.when(
        F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))
    ).otherwise(F.lit(0)).cast("long")
    rest = F.floor(F.col("target") - full * F.col("source_size") + 0.5).cast("long")
    left = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), rest - F.col("start")))
    part = F.when(2 * left >= F.col("size"), F.col("size")).otherwise(0) if whole else left
    planned = (
        keyed.join(buckets, ["sid", "_bucket"])
        .withColumn("start", start)
        .withColumn("epochs", F.when(F.col("size") > 0, full).otherwise(0).cast("long"))
        .withColumn("part", part.cast("long"))
        .withColumn("taken", F.col("epochs") * F.col("size") + F.col("part"))
    )
    position = F.when(
        F.col("taken") > 0, _due(F.col("start").cast("double"), F.col("target"), schedules, F.col("sid"))
    )
    return planned.select(
        "doc_id", "source", "size", "source_size", "target", "epochs", "part", "taken", "start", "sid",
        position.alias("position"), *keep,
    )


def training_order(
    plan: DataFrame, schedules: Sequence[tuple[float, float]] = SCHEDULES, keep: Sequence[str] = ()
) -> DataFrame:
    """The mix as it is read: one row per take, range-sorted by position.

    Columns: position, doc_id, epoch (0-based), words and those in keep. Takes due at the same
    time stand in the order of source and offset, so reruns agree.
    """
    takes = F.col("epochs") + F.when(F.col("part") > 0, 1).otherwise(0)
    offset = (F.col("epoch") * F.col("source_size") + F.col("start")).cast("double")
    return (
        plan.filter(F.col("taken") > 0)
        .withColumn("epoch", F.explode(F.sequence(F.lit(0).cast("long"), takes - 1)))
        .withColumn("position", _due(offset, F.col("target"), schedules, F.col("sid")))
        .withColumn("words", F.when(F.col("epoch") < F.col("epochs"), F.col("size")).otherwise(F.col("part")))
        .orderBy("position", "sid", "epoch", "start", "doc_id")
        .select("position", "doc_id", "epoch", "words", *keep)
    )


def mix_documents(docs: DataFrame) -> DataFrame:
    """The rows of the mix in training order, one per take, with the columns they came with.

    Rows are taken whole. Rows of equal id and text are one row taken as often
    as all of them are.
    """
    # One key that is never null serves the repeated rows and the join, so whole
    # rows move once before they are sorted.
    key = F.concat_ws("/", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.xxhash64(F.coalesce("text", F.lit(""))).cast("string"))
    rows = docs.select("doc_id", "text", "source", key.alias("_same"), F.struct(*docs.columns).alias("_row"))
    takes = training_order(plan_mix(rows, whole=True, keep=["_same"]), keep=["_same"])
    takes = takes.select("_same", F.col("doc_id").alias("_id"), "position", "epoch")
    rows = rows.select("_same", "_row").dropDuplicates(["_same"])
    return rows.join(takes, "_same").orderBy("position", "_id", "epoch").select("_row.*")
