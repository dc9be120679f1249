"""Mixing sources to target weights by the cube method of balanced sampling.

A source's target over its size is the share ``r`` of each of its documents that the
mix takes, 0 to 2. Every document is taken ``floor(r)`` times whole; the fraction of
``r`` is its inclusion probability for one more copy. The flight phase moves these
probabilities through the null space of two constraints, the source's token total
and its document total, until at most two documents of a block are undecided. The
undecided of many blocks meet in the next round's blocks, and so on until a source has
one block left. The landing problem is then two documents at most: they take their
fraction of their words, so a source's words meet its target but for rounding.

A null or empty text has size 0 and is taken 0 times. A null source is a source of
its own, last in order. Repeated rows are documents of their own. Other columns pass
through. Random moves are drawn from hashes of ids and sizes, so reruns agree.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stratamart.llm.common import SALTS, WORD, hot_keys, spread_join, stage
from stratamart.operators.keys import number_rows

WEIGHTS = (5, 2, 1)
BUDGET = 1.5
MOST_COPIES = 2
# Documents of one block of a flight; a block is what one Python call holds.
BLOCK = 20_000
EDGE = 1e-9


def source_targets(sizes: DataFrame, weights=WEIGHTS, budget: float = BUDGET, most: int = MOST_COPIES) -> DataFrame:
    """Per source: its size, documents and target, from rows (source, size).

    Sources by code point, null last, weigh ``weights`` in turn and share ``budget``
    times all sizes; a target stops at ``most`` times the source's size and the excess
    is shared by weight among the others until none is above.
    """
    totals = sizes.groupBy("source").agg(
        F.sum("size").cast("long").alias("source_size"), F.count("*").alias("n")
    )
    keyed = totals.withColumn("_null", F.col("source").isNull())
    ranked = number_rows(keyed, ["_null", "source"], "_rank").drop("_null")
    turn = (F.col("_rank") - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    ranked = stage(ranked.withColumn("_w", weight).drop("_rank"), "sources")
    # The level of water-filling: every round fixes the sources above their bound.
    cap = F.col("source_size") * float(most)
    total = float(ranked.agg(F.sum("source_size")).first()[0] or 0) * budget
    level, fixed = 0.0, -1
    while True:
        above = cap < F.col("_w") * level
        row = ranked.agg(
            F.sum(F.when(above, 1).otherwise(0)).alias("fixed"),
            F.sum(F.when(above, cap).otherwise(0.0)).alias("full"),
            F.sum(F.when(above, 0.0).otherwise(F.col("_w"))).alias("free"),
        ).first()
        if row["fixed"] is None or row["fixed"] == fixed or not row["free"]:
            break
        fixed, level = row["fixed"], (total - row["full"]) / row["free"]
    target = F.least(cap, F.col("_w") * level)
    return stage(ranked.withColumn("target", target).drop("_w"), "targets")


def _fly(sizes: np.ndarray, chance: np.ndarray, draws: np.ndarray) -> None:
    """Flight phase in place: three undecided documents at a time move together.

    With sizes a, b, c the direction (b - c, c - a, a - b) keeps both the number of
    documents and the words; it moves until one of the three is decided.
    """
    active: list[int] = []
    for i in range(len(sizes)):
        if not EDGE < chance[i] < 1 - EDGE:
            chance[i] = round(chance[i])
            continue
        active.append(i)
        if len(active) < 3:
            continue
        a, b, c = (sizes[k] for k in active)
        move = [b - c, c - a, a - b]
        if a == b == c:  # the two constraints are one: any move that keeps the sum
            move = [1.0, -1.0, 0.0]
        up = down = math.inf
        for k, m in zip(active, move):
            if m:
                room, back = (1 - chance[k]) / m, chance[k] / m
                if m < 0:
                    room, back = -chance[k] / m, -(1 - chance[k]) / m
                up, down = min(up, room), min(down, back)
        step = up if draws[i] < down / (up + down) else -down
        for k, m in zip(active, move):
            chance[k] = min(1.0, max(0.0, chance[k] + step * m))
        active = [k for k in active if EDGE < chance[k] < 1 - EDGE]
    for k in range(len(sizes)):
        if not EDGE < chance[k] < 1 - EDGE:
            chance[k] = round(chance[k])


def _flight(block: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values(["draw", "row"])
    chance = block["chance"].to_numpy(float).copy()
    draws = (block["draw"].to_numpy(np.int64).view(np.uint64) >> np.uint64(11)) / float(1 << 53)
    # The draw that orders the rows decides no move: a second one is made from it.
    draws = (draws * 7919.0) % 1.0
    _fly(block["size"].to_numpy(float), chance, draws)
    return block.assign(chance=chance)


ROUND = "row long, source_no long, block long, size long, draw long, chance double"


def balanced_sample(units: DataFrame, block: int = BLOCK) -> DataFrame:
    """``units`` (row, source_no, n, size, draw, chance), with ``chance`` after the flight.

    0 or 1, but for at most two rows of each source.
    """
    blocks = F.greatest(F.lit(1), F.ceil(F.col("n") / block)).cast("long")
    state = stage(
        units.withColumn("block", F.pmod("draw", blocks)).select(
            "row", "source_no", "block", "size", "draw", F.col("chance")), "flight")
    most = state.agg(F.max("block")).first()[0]
    decided: list[DataFrame] = []
    while most is not None:
        flown = stage(
            state.groupBy("source_no", "block").applyInPandas(_flight, ROUND), "flight")
        open_ = (F.col("chance") > 0) & (F.col("chance") < 1)
        decided.append(flown if most == 0 else flown.where(~open_))
        if most == 0:
            break
        state = flown.where(open_).withColumn("block", F.floor(F.col("block") / (block // 2)))
        most = most // (block // 2)
    out = decided[0] if decided else state
    for more in decided[1:]:
        out = out.unionByName(more)
    return out.select("row", "chance")


def mix(
    docs: DataFrame, *, weights=WEIGHTS, budget: float = BUDGET, most: int = MOST_COPIES, row: str | None = None
) -> DataFrame:
    """Per row of ``docs``: row, doc_id, source, size, source_size, target, taken, copies.

    ``taken``: words the mix takes, repeats counted; ``copies``: whole copies among
    them. ``row`` names a column that numbers the rows; without it they are numbered here.
    """
    number = F.col(row).cast("long") if row else F.monotonically_increasing_id()
    sized = stage(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
            F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark"),
            number.alias("row"),
        ),
        "sizes",
    )
    targets = source_targets(sized, weights, budget, most)
    targets = targets.withColumn("source_no", F.xxhash64("source", F.col("source").isNull()))
    hot = hot_keys(targets, "source_no")
    keyed = sized.withColumn("source_no", F.xxhash64("source", F.col("source").isNull()))
    share = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rows = spread_join(
        keyed, targets.drop("source"), "source_no", hot, F.col("row"), salts=SALTS
    ).withColumn("share", share).withColumn("whole", F.floor(F.col("share") + EDGE))
    rows = rows.withColumn("chance", F.greatest(F.col("share") - F.col("whole"), F.lit(0.0)))
    rows = stage(rows, "shares")
    units = rows.where((F.col("size") > 0) & (F.col("chance") > EDGE)).withColumn(
        "draw", F.xxhash64("doc_id", "size", "mark", F.when(F.col("doc_id").isNull(), F.col("row"))))
    chosen = balanced_sample(units).withColumnRenamed("chance", "extra")
    done = rows.join(chosen, "row", "left").withColumn("extra", F.coalesce("extra", F.lit(0.0)))
    copies = F.when(F.col("size") > 0, F.col("whole") + F.floor("extra")).otherwise(0).cast("int")
    part = F.col("extra") - F.floor("extra")
    return done.withColumn("copies", copies).select(
        "row", "doc_id", "source", "size", "source_size", "target",
        (F.col("copies") * F.col("size") + F.round(part * F.col("size"))).cast("long").alias("taken"),
        "copies",
    )


def land_whole(mixed: DataFrame) -> DataFrame:
    """Rows (row, copies) of ``mix`` with its at most two undecided documents of a source
    taken once more whole, or not, whichever of the four ways comes nearest to the target.

    Ties go to the fewer, then to the smaller row. Rows with no copy are left out.
    """
    part = F.col("taken") - F.col("copies") * F.col("size")
    open_ = mixed.select("row", "source", "size", part.alias("part")).where("part > 0")
    pairs = open_.groupBy("source").agg(
        F.array_sort(F.collect_list(F.struct("row", "size"))).alias("held"), F.sum("part").alias("want"))
    one, two = F.col("held")[0]["size"], F.coalesce(F.try_element_at("held", F.lit(2))["size"], F.lit(1 << 62))
    ways = [(0, F.lit(0)), (1, one), (1, two), (2, one + two)]
    gaps = F.array(*(
        F.struct(F.abs(F.col("want") - taken).alias("gap"), F.lit(n).alias("n"), F.lit(k).alias("way"))
        for k, (n, taken) in enumerate(ways)))
    way = F.array_min(gaps)["way"]
    more = pairs.withColumn("way", way).select("way", F.posexplode("held").alias("at", "unit")).where(
        "way = 3 OR way = at + 1").select(F.col("unit.row").alias("row"), F.lit(1).alias("more"))
    return mixed.join(more, "row", "left").select(
        "row", (F.col("copies") + F.coalesce("more", F.lit(0))).alias("copies")).where("copies > 0")


def mixture(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` as often as the mix takes them, each whole. Columns may have any names."""
    numbered = stage(
        docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("doc"))
        .withColumn("row", F.monotonically_increasing_id()), "numbered")
    times = land_whole(stage(mix(numbered.select("row", "doc.doc_id", "doc.source", "doc.text"), row="row"), "mixed"))
    return numbered.join(times, "row").withColumn(
        "turn", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("doc.*")
