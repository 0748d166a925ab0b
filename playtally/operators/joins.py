"""Left joins of events to reference tables that hold at any size of either side.

A reference side is broadcast only after its size was measured. Beyond the limit the join shuffles. One counting pass
then finds the keys that have more events than a task's share; the events of these keys (and those without a key) are
spread over `salts` tasks, each event drawing its salt from its own other columns (so a recomputed task draws the same
one), and only the reference rows of these keys are repeated once per salt.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

BROADCAST_LIMIT_BYTES = 64 << 20
SALTS = 64
# A key is hot above this share of the events, so there are at most as many hot keys.
MOST_HOT_KEYS = 1000


# A row's entry in the hash table of a broadcast: a pointer and a key in a table at most half full, and its length.
TABLE_ENTRY_BYTES = 40


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row in memory as a broadcast holds it: one bit per column for nulls, eight bytes per column
    and the bytes of each text rounded up to eight, whether values are null or not; and its table entry."""
    width = TABLE_ENTRY_BYTES + 8 * -(-len(df.columns) // 64) + 8 * len(df.columns)
    texts = [F.coalesce(F.octet_length(F.col(f"`{name}`")) + F.lit(7), F.lit(0)) for name, kind in df.dtypes if kind == "string"]
    return reduce(Column.__add__, texts, F.lit(width)).cast("bigint")


def measured_bytes(*refs: DataFrame) -> list[int]:
    """Upper estimate of the size of each frame in memory, from one pass over the lengths of the values of all."""
    sizes = []
    for place, ref in enumerate(refs):
        sizes.append(ref.agg(F.lit(place).alias("place"), F.coalesce(F.sum(row_bytes(ref)), F.lit(0)).alias("size")))
    measured = {row["place"]: row["size"] for row in reduce(DataFrame.unionByName, sizes).collect()}
    return [measured[place] for place in range(len(refs))]


def fits_broadcast(size: int) -> bool:
    return size <= BROADCAST_LIMIT_BYTES


def hot_keys(events: DataFrame, key: str, most: int = MOST_HOT_KEYS) -> list:
    """The keys with more events than a task gets on average (or than one in `most`): no more than `most` of them, whatever
    the events. One pass over the key column, counted in each task before the shuffle."""
    partitions = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = Observation()
    counts = events.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    largest = counts.observe(total, F.sum("_n").alias("n")).orderBy(F.desc("_n")).limit(most).collect()
    share = (total.get["n"] or 0) / max(2, min(partitions, most))
    return [row[key] for row in largest if row["_n"] > share]


def hot_keys_of(events: DataFrame, keys: list[str], most: int = MOST_HOT_KEYS) -> dict[str, list]:
    """`hot_keys` of several columns from one pass over `events`, so that a frame with a long lineage is computed once
    for all of its joins and not once per key. Each task keeps only its `most` largest counts of each column."""
    partitions = int(events.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    types = dict(events.dtypes)
    entries = [F.struct(F.lit(place).alias("_k"), *[(F.col(key) if other == key else F.lit(None).cast(types[other])).alias(other)
                                                    for other in keys])
               for place, key in enumerate(keys)]
    present = reduce(Column.__or__, [(F.col("_k") == place) & F.col(key).isNotNull() for place, key in enumerate(keys)])
    counts = (events.select(F.explode(F.array(*entries)).alias("_e")).select("_e.*").where(present)
              .groupBy("_k", *keys).agg(F.count(F.lit(1)).alias("_n")))
    total = Observation()
    sums = [F.sum(F.when(F.col("_k") == place, F.col("_n"))).alias(f"n{place}") for place in range(len(keys))]
    ranked = counts.observe(total, *sums).withColumn("_r", F.row_number().over(Window.partitionBy("_k").orderBy(F.desc("_n"))))
    largest = ranked.where(F.col("_r") <= most).collect()
    hot = {key: [] for key in keys}
    for place, key in enumerate(keys):
        share = (total.get[f"n{place}"] or 0) / max(2, min(partitions, most))
        hot[key] = [row[key] for row in largest if row["_k"] == place and row["_n"] > share]
    return hot


def spread_reference(ref: DataFrame, key: str, hot: list, salts: int) -> DataFrame:
    """The reference with a column _salt: rows of hot keys once per salt, all others once."""
    copies = F.when(F.col(key).isin(hot), F.lit(salts - 1)).otherwise(F.lit(0)) if hot else F.lit(0)
    return ref.withColumn("_salt", F.explode(F.sequence(F.lit(0), copies)))


def left_join_reference(events: DataFrame, ref: DataFrame, key: str, broadcast: bool | None = None,
                        salts: int = SALTS, hot: list | None = None) -> DataFrame:
    """`events` left join `ref` on `key`. `broadcast=None` measures `ref` to decide, `hot=None` counts the keys of `events`;
    a caller that has a cheaper frame with the same keys passes its hot keys."""
    ref = ref.where(F.col(key).isNotNull())
    if broadcast is None:
        broadcast = fits_broadcast(*measured_bytes(ref))
    if broadcast:
        return events.join(F.broadcast(ref), key, "left")
    # The merge hint keeps the planner, which knows only file sizes, from broadcasting what was measured
    # to be large.
    others = [name for name in events.columns if name != key]
    if salts == 1 or not others:
        return events.join(ref.hint("merge"), key, "left")
    hot = hot_keys(events, key) if hot is None else hot
    drawn = F.pmod(F.xxhash64(*others), F.lit(salts)).cast("int")
    spread = F.col(key).isNull() | F.col(key).isin(hot) if hot else F.col(key).isNull()
    salted = events.withColumn("_salt", F.when(spread, drawn).otherwise(F.lit(0)))
    return salted.join(spread_reference(ref, key, hot, salts).hint("merge"), [key, "_salt"], "left").drop("_salt")
