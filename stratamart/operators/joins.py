"""Left lookup join that stays balanced when a few keys hold much of either side."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot from this share of the left rows, and this many of them, on.
HOT_SHARE = 0.01
HOT_ROWS = 1_000_000
# Rows of one hot key that one task is meant to take.
ROWS_PER_SALT = 500_000
# A side estimated below this is shuffled as it is: even one task could take it.
SMALL_BYTES = 64 << 20
# The sketch keeps this many candidates; no more than 1 / HOT_SHARE keys can be hot.
CANDIDATES = 200
TRACKED_ITEMS = 10_000


@dataclass
class HotKeys:
    """Keys to spread, and over how many salts. Steers balance, never the result."""

    values: list[object] = field(default_factory=list)
    nulls: bool = False
    salts: int = 1

    def __bool__(self) -> bool:
        return bool(self.values) or self.nulls


def planned_bytes(df: DataFrame) -> int | None:
    """Catalyst's size estimate of a plan, the one Spark compares for a broadcast."""
    try:
        return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except Exception:  # no JVM handle (Spark Connect)
        return None


def spark_will_broadcast(df: DataFrame) -> bool:
    """True where Spark itself, within its size limit, plans to broadcast ``df``."""
    limit = df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")
    size = planned_bytes(df)
    bound = _as_bytes(limit)
    return size is not None and 0 < size <= bound


def _as_bytes(text: str) -> int:
    units = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40, "b": 1}
    text = text.strip().lower()
    if text.lstrip("-").isdigit():
        return int(text)
    number = text.rstrip("bkmgt")
    unit = text[len(number):][:1]
    return int(number) * units[unit]


def find_hot_keys(
    df: DataFrame,
    *keys: str,
    hot_share: float = HOT_SHARE,
    hot_rows: int = HOT_ROWS,
    rows_per_salt: int = ROWS_PER_SALT,
) -> dict[str, HotKeys]:
    """Hot values of some columns, from bounded sketches: one pass, one row back."""
    sketches = [
        F.struct(
            F.count_if(F.col(k).isNull()).alias("nulls"),
            F.expr(f"approx_top_k(`{k}`, {CANDIDATES}, {TRACKED_ITEMS})").alias("top"),
        ).alias(k)
        for k in keys
    ]
    row = df.select(*keys).agg(F.count("*").alias("_rows"), *sketches).first()
    floor = max(hot_rows, hot_share * row["_rows"], 1)
    found = {}
    for k in keys:
        counts = {t["item"]: t["count"] for t in row[k]["top"] or [] if t["item"] is not None}
        hot = {v: n for v, n in counts.items() if n >= floor}
        nulls = row[k]["nulls"] >= floor
        largest = max([*hot.values(), row[k]["nulls"] if nulls else 0])
        found[k] = HotKeys(list(hot), nulls, max(2, -(-largest // rows_per_salt)))
    return found


def hot_keys_for(
    left: DataFrame, *lookups: tuple[str, DataFrame], small_left: int = SMALL_BYTES
) -> dict[str, HotKeys]:
    """Hot keys of ``left`` for the lookups whose right side Spark will not broadcast."""
    size = planned_bytes(left)
    if size is not None and size <= small_left:
        return {}
    shuffled = dict.fromkeys(k for k, right in lookups if not spark_will_broadcast(right))
    return find_hot_keys(left, *shuffled) if shuffled else {}


def hot_right_keys(
    right: DataFrame, key: str, *, small_right: int = SMALL_BYTES
) -> HotKeys | None:
    """Keys that hold much of a lookup side which may repeat its keys."""
    size = planned_bytes(right)
    if spark_will_broadcast(right) or (size is not None and size <= small_right):
        return None
    return find_hot_keys(right, key)[key]


def _row_salt(df: DataFrame, salts: int) -> Column:
    # From the row's content and its task: equal copies in different tasks part
    # ways, and a task that runs again gives its rows the same salts.
    content = F.xxhash64(*[F.col(c) for c in df.columns])
    return F.pmod(content + F.spark_partition_id(), F.lit(salts)).cast("int")


def left_lookup(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    *,
    hot: HotKeys | None = None,
    hot_right: HotKeys | None = None,
) -> DataFrame:
    """``left LEFT JOIN right ON left_key = right_key``, without the right key.

    Left rows of the ``hot`` keys are spread over salts and the matching right rows
    repeated once per salt; all other keys join as they are. NULL keys match nothing
    and are spread too. For ``hot_right`` keys it is the other way round: they are
    known to be on the right, so every left row with one matches and an inner join
    on the salted right side gives its rows.
    """
    if hot_right and hot_right.values:
        heavy = hot_right.values

        def with_heavy(df: DataFrame, key: str, wanted: bool) -> DataFrame:
            return df.where(F.coalesce(F.col(key).isin(heavy), F.lit(False)) == wanted)

        light = left_lookup(
            with_heavy(left, left_key, False), with_heavy(right, right_key, False),
            left_key, right_key, hot=hot,
        )
        copies = with_heavy(left, left_key, True).withColumn(
            "_salt", F.explode(_every_salt(hot_right))
        )
        own = with_heavy(right, right_key, True)
        own = own.withColumn("_right_salt", _row_salt(own, hot_right.salts))
        own = own.withColumnRenamed(right_key, "_lookup_key")
        matched = copies.join(own, _salted_match(left_key), "inner")
        return light.unionByName(matched.drop("_lookup_key", "_salt", "_right_salt"))

    right = right.withColumnRenamed(right_key, "_lookup_key")
    if not hot:
        match = F.col(left_key) == F.col("_lookup_key")
        return left.join(right, match, "left").drop("_lookup_key")
    listed = F.col(left_key).isin(hot.values) if hot.values else F.lit(False)
    is_hot = F.when(F.col(left_key).isNull(), F.lit(hot.nulls)).otherwise(listed)
    salted = left.withColumn(
        "_salt", F.when(is_hot, _row_salt(left, hot.salts)).otherwise(F.lit(0))
    )
    one_salt = F.array(F.lit(0))
    repeated = (
        F.when(F.col("_lookup_key").isin(hot.values), _every_salt(hot)).otherwise(one_salt)
        if hot.values else one_salt
    )
    spread = right.withColumn("_right_salt", F.explode(repeated))
    return salted.join(spread, _salted_match(left_key), "left").drop(
        "_lookup_key", "_salt", "_right_salt"
    )


def _every_salt(hot: HotKeys) -> Column:
    return F.sequence(F.lit(0), F.lit(hot.salts - 1))


def _salted_match(left_key: str) -> Column:
    return (F.col(left_key) == F.col("_lookup_key")) & (F.col("_salt") == F.col("_right_salt"))
