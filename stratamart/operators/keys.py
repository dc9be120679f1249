"""Row numbers over a whole table, ranks in equal parts, and latest row per key.

A global ``row_number`` moves a whole table into one task. Here the rows, whatever
their number, are range-partitioned on the full sort tuple, sorted inside the
partitions and written once; a row's number is then its place in its partition plus
the sizes of the partitions before it. The numbers are those of the global window.
Ranks in equal parts need no numbers, only the rows at the parts' ends: they are found
by selection.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stratamart.staging import stage

# Rows aimed at per range partition.
ROWS_PER_PARTITION = 1_000_000
# The number of partitions, and with it the broadcast of their sizes, ends here.
MAX_PARTITIONS = 100_000
# Selection reads a range in order once it has so few rows, and cuts longer ones by pivots.
FEW = 20_000
PIVOTS = 48

_ROW = "_staged_row"
_PLACE = "_place"
_PLACE_BITS = 33  # monotonically_increasing_id(): partition above, row below


def _sort_columns(df: DataFrame, order_by: Sequence[str | Column]) -> list[str | Column]:
    """The given order, then every other orderable column, so ties are settled."""
    given = {c for c in order_by if isinstance(c, str)}
    rest = [
        f.name for f in df.schema.fields
        if f.name not in given and f.name != _ROW and not isinstance(f.dataType, T.MapType)
    ]
    return [*order_by, *rest]  # names sort ascending, NULL first


def _staged_with_row(df: DataFrame, label: str) -> DataFrame:
    # The row id is written with the row. It tells equal rows apart, so that even
    # a third of the table being copies of one row spreads over many partitions,
    # and a task that runs again cannot renumber what others have already read.
    return stage(df.withColumn(_ROW, F.monotonically_increasing_id()), label)


def _number_staged(
    staged: DataFrame, total: int, sort: list[str | Column], name: str, label: str,
    rows_per_partition: int,
) -> DataFrame:
    slots = int(staged.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = min(MAX_PARTITIONS, max(slots, -(-total // rows_per_partition)))
    placed = stage(
        staged.repartitionByRange(parts, *sort, _ROW)
        .sortWithinPartitions(*sort, _ROW)
        .withColumn(_PLACE, F.monotonically_increasing_id()),
        label,
    )
    part = F.shiftright(F.col(_PLACE), _PLACE_BITS)
    # One count per partition comes back, at most MAX_PARTITIONS of them.
    counts = sorted(placed.groupBy(part.alias("_part")).count().collect())
    starts = list(accumulate((n for _, n in counts), initial=0))
    offsets = placed.sparkSession.createDataFrame(
        [(own, before) for (own, _), before in zip(counts, starts)], "_part long, _before long")
    in_part = F.col(_PLACE).bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return (
        placed.join(F.broadcast(offsets), part == F.col("_part"))
        .withColumn(name, F.col("_before") + in_part + 1)
        .drop("_part", "_before", _PLACE)
    )


def number_rows(
    df: DataFrame,
    order_by: Sequence[str | Column],
    name: str,
    *,
    rows_per_partition: int = ROWS_PER_PARTITION,
) -> DataFrame:
    """Add ``name``: 1..n in the given order, the other columns settling ties."""
    sort = _sort_columns(df, order_by)
    staged = _staged_with_row(df, "numbered")
    total = staged.count()  # answered from the Parquet footers
    numbered = _number_staged(staged, total, sort, name, "numbered", rows_per_partition)
    return numbered.select(name, *df.columns)


def _comparable(df: DataFrame, order_by: Sequence[str]) -> Column:
    """A row's place in an order as one value: the columns given, the others, the row id.

    Structs compare field by field, NULL first, as ascending columns do. Columns of other
    than simple types do not take part; the row id settles what is left.
    """
    wrong = [c for c in order_by if not isinstance(c, str)]
    if wrong:
        raise TypeError(f"orders are names of columns: {wrong}")
    kinds = {f.name: f.dataType for f in df.schema.fields}
    fields = []
    for name in [*order_by, *(c for c in kinds if c not in order_by and c != _ROW), _ROW]:
        if isinstance(kinds[name], (T.TimestampType, T.TimestampNTZType)):
            micros = F.col(name).cast("timestamp")
            fields.append(F.unix_micros(micros).alias(name))
        elif isinstance(kinds[name], T.AtomicType):
            fields.append(F.col(name))
    return F.struct(*fields)


def _literal(value: Row, kind: T.StructType) -> Column:
    return F.struct(*[
        F.lit(v).cast(f.dataType).alias(f.name) for v, f in zip(value, kind.fields)])


def _cut(place: Column, pivots: list[Row], kind: T.StructType) -> Column:
    """How many of the pivots, in order, a place is above."""
    above = [F.when(place > _literal(p, kind), 1).otherwise(0) for p in pivots]
    return reduce(Column.__add__, above, F.lit(0))


def places_at(places: DataFrame, ranks: Sequence[int], few: int = FEW, pivots: int = PIVOTS) -> dict[int, Row]:
    """The values of column ``place`` at some ranks (from 0) of their order; values are unique.

    Selection without a sort: pivots from a sample cut the places into ranges, one count per
    range comes back, and only the range that holds the rank is looked at again, until it has
    few enough rows to be read in order. A pass reads the places once and shuffles counts.
    """
    kind = places.schema["place"].dataType
    found: dict[int, Row] = {}
    # Open ranges: what is below, what is above, the places before it, and its ranks.
    total = places.count()
    open_ranges = [(None, None, 0, total, sorted({r for r in ranks if 0 <= r < total}))]
    seed = 0  # another sample in every pass, should one fail to divide a range
    while open_ranges:
        low, high, before, n, wanted = open_ranges.pop()
        seed += 2
        if not wanted:
            continue
        own = places
        if low is not None:
            own = own.where(F.col("place") > _literal(low, kind))
        if high is not None:
            own = own.where(F.col("place") <= _literal(high, kind))
        if n <= few:
            ordered = [r[0] for r in own.orderBy("place").limit(wanted[-1] - before + 1).collect()]
            found.update((rank, ordered[rank - before]) for rank in wanted)
            continue
        sample = [r[0] for r in own.where(
            F.rand(seed) < F.lit(min(1.0, 40 * pivots / n))
        ).orderBy(F.rand(seed + 1)).limit(20 * pivots).collect()]
        sample = [r[0] for r in places.sparkSession.createDataFrame(
            [(s,) for s in sample], T.StructType([T.StructField("place", kind)])).orderBy("place").collect()]
        if not sample:
            open_ranges.append((low, high, before, n, wanted))
            continue
        step = max(1, len(sample) // (pivots + 1))
        bounds = sample[step - 1::step][:pivots]
        counts = dict(own.groupBy(_cut(F.col("place"), bounds, kind)).count().collect())
        edges = [low, *bounds, high]
        for at in range(len(bounds) + 1):
            inside = counts.get(at, 0)
            mine = [r for r in wanted if before <= r < before + inside]
            if mine:
                open_ranges.append((edges[at], edges[at + 1], before, inside, mine))
            before += inside
    return found


def equal_parts(
    df: DataFrame,
    parts: int,
    orders: dict[str, Sequence[str]],
    *,
    few: int = FEW,
) -> DataFrame:
    """Add one tile number (1..parts) per entry of ``orders``, as ``ntile`` would.

    The first ``n % parts`` tiles hold one row more than the others. The rows are written
    once, for any number of orders; each order finds the last rows of its tiles by selection
    (``places_at``), and a row's tile is the number of those it is above, plus one.
    """
    staged = _staged_with_row(df, "tiles")
    total = staged.count()  # answered from the Parquet footers
    small, larger = divmod(total, parts)
    sizes = [small + (i < larger) for i in range(parts)]
    last = [end - 1 for end in accumulate(sizes[:-1])]
    tiles = {}
    for name, order_by in orders.items():
        place = _comparable(staged, order_by)
        places = staged.select(place.alias("place"))
        found = places_at(places, last, few)
        cuts = [found[rank] for rank in last if rank in found]
        kind = places.schema["place"].dataType
        tiles[name] = (_cut(place, cuts, kind) + 1).cast("int")
    return staged.withColumns(tiles).select(*df.columns, *orders)


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str | Column]
) -> DataFrame:
    """One row per key: the one with the greatest ``order_by``, ties by all columns.

    ``row_number() = 1`` lets Spark drop all but one row per key and task before
    the shuffle, so a hot key sends one row per task and not its whole group.
    """
    named = [c for c in order_by if isinstance(c, str)]
    rest = [
        f.name for f in df.schema.fields
        if f.name not in {*keys, *named} and not isinstance(f.dataType, T.MapType)
    ]
    order = [F.desc(c) if isinstance(c, str) else c for c in [*order_by, *rest]]  # NULL last
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def newest_key(df: DataFrame, natural_key: str, surrogate_key: str) -> DataFrame:
    """Greatest surrogate key per natural key; rows without a natural key are left out.

    With one number to keep, ``max`` combines before the shuffle and needs no sort.
    """
    return (
        df.where(f"{natural_key} IS NOT NULL")
        .groupBy(natural_key)
        .agg(F.max(surrogate_key).alias(surrogate_key))
    )
