"""Mixing sources to target token weights by entropy balancing (DataFrame functions only)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyhouse.operators.ranges import row_numbers

from .common import stored

WORD = r"[^\x20\x09-\x0D]+"
#: Weights of the sources in code-point order, repeating.
WEIGHTS = (3.0, 1.0, 2.0)
#: Size of the mix as a share of all words.
SHARE = 1.5
#: Most times a document may be taken.
MOST = 2
#: Rates are held as multiples of 1/UNIT, so that sums are exact and reruns agree.
UNIT_BITS = 24
UNIT = 1 << UNIT_BITS
#: Rows of one source and size are numbered in so many salted groups.
SALTS = 64
TOLERANCE = 1e-9
#: Rounds of mending what rounding left of a target.
MENDS = 4


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Words wanted of each source: ``source``, ``source_size``, ``target``.

    ``sizes`` has ``source``, ``size`` and ``docs`` (words and rows, pre-aggregated
    or not). Targets are proportional to the
    weights but never above ``most`` times the source; what is cut off goes
    to the others by weight until none is above. Sources are numbered by ranges, and each
    round of sharing is one sum over them, so no task sees them all; a round
    caps at least one source more, and the sums are of whole numbers, so reruns agree.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.sum("docs").alias("docs"))
    # strings compare by code point in Spark's binary collation; null comes last
    per = row_numbers(per, [F.col("source").asc_nulls_last()], "nr")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.col("nr") - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("w", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    total = float(per.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = 0.0, -1
    while True:
        full = F.col("cap") <= F.lit(level) * F.col("w")
        got = per.agg(F.count_if(full).alias("n"), F.sum(F.when(full, F.col("cap"))).alias("cap"),
                      F.sum(F.when(~full, F.col("w"))).alias("w")).first()
        if got["n"] == capped:
            break
        capped = got["n"]
        if not got["w"]:
            level = float("inf")
            break
        level = (total - (got["cap"] or 0.0)) / got["w"]
    return per.select("source", "source_size", "docs", "cap", F.least(F.col("cap"), F.lit(level) * F.col("w")).alias("target"))


def tilts(groups: DataFrame, targets: DataFrame, most: int = MOST, max_rounds: int = 60) -> DataFrame:
    """Newton's method on the convex dual of the balancing problem, all sources at once.

    Wanted are the rates nearest to one copy a document (relative entropy, with
    the bound ``most``) such that ``sum(rate * size)`` is each source's target:
    ``rate = most / (1 + (most - 1) * e^(-tilt * x))`` with ``x`` the size over the
    source's mean. Each round is one aggregation of ``groups`` (key, size, n); a
    step that leaves the bracket known so far is replaced by its middle.
    """
    rate = F.lit(float(most)) / (1 + F.lit(float(most - 1)) * F.exp(-F.col("tilt") * F.col("x")))
    share = F.col("target") / F.col("cap")
    start = F.log(share / (1 - share) * F.lit(float(most - 1)))
    now = stored(targets.where("source_size > 0 AND target < cap * (1 - 1e-12)")
                 .select("key", "target", (F.col("source_size") / F.col("docs")).alias("mean"), start.alias("tilt"),
                         F.lit(-1e4).alias("lo"), F.lit(1e4).alias("hi"), F.lit(1.0).alias("off")), "tilts")
    for _ in range(max_rounds):
        at = groups.where("size > 0").join(now.select("key", "tilt", "mean"), "key")
        at = at.withColumn("x", F.col("size") / F.col("mean")).withColumn("rate", rate)
        sums = at.groupBy("key").agg(
            F.sum(F.col("n") * F.col("x") * F.col("rate")).alias("got"),
            F.sum(F.col("n") * F.col("x") * F.col("x") * F.col("rate") * (1 - F.col("rate") / most)).alias("slope"))
        step = now.join(sums, "key").withColumn("gap", F.col("got") - F.col("target") / F.col("mean"))
        step = (step.withColumn("lo", F.when(F.col("gap") < 0, F.col("tilt")).otherwise(F.col("lo")))
                .withColumn("hi", F.when(F.col("gap") > 0, F.col("tilt")).otherwise(F.col("hi")))
                .withColumn("off", F.abs("gap") * F.col("mean") / F.col("target"))
                .withColumn("next", F.when(F.col("slope") > 0, F.col("tilt") - F.col("gap") / F.col("slope"))))
        inside = (F.col("next") > F.col("lo")) & (F.col("next") < F.col("hi"))
        tilt = (F.when(F.col("off") <= TOLERANCE, F.col("tilt"))
                .when(F.coalesce(inside, F.lit(False)), F.col("next")).otherwise((F.col("lo") + F.col("hi")) / 2))
        now = stored(step.select("key", "target", "mean", tilt.alias("tilt"), "lo", "hi", "off"), "tilts")
        worst = now.agg(F.max("off")).first()[0]
        if worst is None or worst <= TOLERANCE:
            break
    # the last bits of a distributed sum may differ between runs
    return now.select("key", F.round("tilt", 6).alias("tilt"), "mean")


def mix(docs: DataFrame, text: str = "text", source: str = "source", doc_id: str = "doc_id", payload: list[str] | None = None,
        weights=WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """Take documents 0 to ``most`` times so that every source meets its token target.

    Returns the ``payload`` columns (all by default) inside struct ``doc``, and
    ``size`` (words of the text, 0 for null), ``source_size``, ``target``, ``rate``
    (exponentially tilted), ``copies`` and ``taken`` (= copies * size).

    Rates are rounded by systematic sampling along each source in order of
    size: the copies of all documents up to a size are their summed rates,
    rounded. What a source then misses (less than its largest document) is
    mended by moving copies of the size that fits best, a few times. Sums
    are exact integers over (source, size) groups; the copies of a group are
    spread evenly over its rows, numbered in salted parts, so no window holds
    more than the distinct sizes of a source or a salted part of one size.

    Null sources form one source, last in order. Texts without words have size
    0 and are not taken. Repeated rows count as rows of their own. An empty
    table gives no rows. Columns of ``docs`` never clash with the result's.
    """
    key = F.when(F.col(source).isNull(), "-").otherwise(F.concat(F.lit("="), F.col(source).cast("string")))
    rows = stored(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in payload or docs.columns]).alias("doc"),
        F.col(source).cast("string").alias("source"), key.alias("key"), F.col(doc_id).cast("string").alias("tie"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.pmod(F.xxhash64(F.col(doc_id)), F.lit(SALTS)).alias("salt")), "mix-rows")
    salted = stored(rows.groupBy("source", "key", "size", "salt").agg(F.count("*").alias("n")), "mix-salted")
    groups = stored(salted.groupBy("source", "key", "size").agg(F.sum("n").alias("n")), "mix-groups")
    wanted = source_targets(groups.select("source", (F.col("size") * F.col("n")).alias("size"), F.col("n").alias("docs")),
                            weights, share, most)
    key = F.when(F.col("source").isNull(), "-").otherwise(F.concat(F.lit("="), F.col("source")))
    wanted = stored(wanted.withColumn("key", key), "mix-targets")
    solved = tilts(groups, wanted, most)

    x = F.col("size") / F.col("mean")
    rate = (F.when(F.col("tilt").isNotNull(), F.lit(float(most)) / (1 + F.lit(float(most - 1)) * F.exp(-F.col("tilt") * x)))
            .when((F.col("source_size") > 0), F.lit(float(most))).otherwise(0.0))
    by_size = (groups.join(wanted.select("key", "source_size", "target"), "key").join(solved, "key", "left")
               .withColumn("rate", F.when(F.col("size") > 0, rate).otherwise(0.0))
               .withColumn("unit", F.round(F.col("rate") * UNIT).cast("long")))
    before = Window.partitionBy("key").orderBy("size").rowsBetween(Window.unboundedPreceding, -1)
    by_size = by_size.withColumn("base", F.coalesce(F.sum(F.col("n") * F.col("unit")).over(before), F.lit(0)) + UNIT // 2)
    # 64-bit integers throughout: division by a power of two as a shift
    copies = F.shiftright(F.col("base") + F.col("n") * F.col("unit"), UNIT_BITS) - F.shiftright("base", UNIT_BITS)
    by_size = mended(by_size.select("key", "size", "n", "rate", "source_size", "target", copies.alias("m")), most)
    earlier = Window.partitionBy("key", "size").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = (salted.withColumn("skip", F.coalesce(F.sum("n").over(earlier), F.lit(0))).select("key", "size", "salt", "skip")
              .join(by_size, ["key", "size"]))

    nth = F.row_number().over(Window.partitionBy("key", "size", "salt").orderBy(F.col("tie").asc_nulls_last()))
    out = rows.withColumn("nth", nth - 1).join(starts, ["key", "size", "salt"]).withColumn("nth", F.col("nth") + F.col("skip"))
    # whole copies of a group of n rows spread evenly: floor((i+1)m/n) - floor(im/n)
    copies = F.expr("(nth + 1) * m div n - nth * m div n")
    return out.select("doc", "source", "size", "source_size", "target", "rate", copies.alias("copies"),
                      (copies * F.col("size")).alias("taken"))


def mended(by_size: DataFrame, most: int, rounds: int = MENDS) -> DataFrame:
    """Move copies of the size that leaves least of what a source still misses (or
    has too much). One row per source and size; ``m`` is its copies."""
    for _ in range(rounds):
        by_size = stored(by_size, "mix-copies")
        gap = by_size.groupBy("key").agg((F.round(F.first("target")).cast("long") - F.sum(F.col("m") * F.col("size"))).alias("gap"))
        room = F.when(F.col("gap") > 0, most * F.col("n") - F.col("m")).otherwise(F.col("m"))
        fits = (by_size.join(gap, "key").where((F.col("size") > 0) & (F.col("size") < 2 * F.abs("gap"))).withColumn("room", room)
                .where("room > 0").withColumn("k", F.least("room", F.greatest(F.lit(1), F.expr("abs(gap) div size"))))
                .withColumn("left", F.abs(F.abs("gap") - F.col("k") * F.col("size")))
                .withColumn("move", F.signum("gap").cast("long") * F.col("k")))
        best = (fits.groupBy("key").agg(F.min_by(F.struct("size", "move"), F.struct("left", "size")).alias("b"))
                .select("key", "b.size", "b.move"))
        by_size = (by_size.join(best, ["key", "size"], "left").withColumn("m", F.col("m") + F.coalesce("move", F.lit(0))).drop("move"))
    return by_size
