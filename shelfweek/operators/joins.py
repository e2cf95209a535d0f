"""Join operators: membership tests, salted lookups, grids, nearest match, self joins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfweek.functions.dates import hour_boundaries

# How many slices one hot key is cut into by the salted operators.
SPREAD = 16
# How many rows the small side of a grid may have.
GRID_ROWS = 100_000
# Up to how many times of one key the nearest match sorts candidates into the gaps between them.
FEW_TIMES = 64


def _matches(names: list[str], null_safe: bool) -> Column:
    tests = [
        F.col(name).eqNullSafe(F.col(f"_r_{name}")) if null_safe else F.col(name) == F.col(f"_r_{name}")
        for name in names
    ]
    return reduce(lambda left, right: left & right, tests)


def _right_keys(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[F.col(name).alias(f"_r_{name}") for name in names])


def present(df: DataFrame, keys: DataFrame, on: list[str], null_safe: bool = False) -> DataFrame:
    """Rows whose key occurs in ``keys``; repeats there do not multiply rows."""
    return df.join(_right_keys(keys, on), _matches(on, null_safe), "left_semi")


def absent(df: DataFrame, keys: DataFrame, on: list[str], null_safe: bool = False) -> DataFrame:
    """Rows whose key does not occur in ``keys``; rows with a null key stay unless ``null_safe``."""
    return df.join(_right_keys(keys, on), _matches(on, null_safe), "left_anti")


def not_in(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """``NOT IN`` with its null rules: one null in the list empties the result, a null value never passes.

    ``values`` has one column, the list. It plans as a hash or sort-merge anti join with one lookup of the list's
    size and nulls, where the SQL form would need the list broadcast or a nested loop.
    """
    listed = values.toDF(column)
    facts = listed.agg(F.struct(F.count("*").alias("size"), F.count_if(F.col(column).isNull()).alias("nulls"))).scalar()
    kept = absent(df, listed, [column])
    return kept.where(F.when(F.col(column).isNull(), facts["size"] == 0).otherwise(facts["nulls"] == 0))


def _salt(df: DataFrame, spread: int) -> Column:
    return F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in df.columns]), F.lit(spread))


def _slices(spread: int) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.lit(spread - 1).cast("bigint"))


def look_up(df: DataFrame, stats: DataFrame, on: list[str], null_safe: bool = False) -> DataFrame:
    """Left join to a table with one row per key.

    Only the join columns decide where a row goes, so unused columns stay prunable, and the lookup side travels once.
    A key that holds a large share of ``df`` is split over tasks by adaptive execution, which copies just its lookup row.
    """
    carried = [name for name in stats.columns if name not in on]
    right = stats.select(*[F.col(name).alias(f"_r_{name}") for name in on], *carried)
    return df.join(right, _matches(on, null_safe), "left").select(*df.columns, *carried)


def with_group_stats(df: DataFrame, by: list[str], null_safe: bool = True, **stats: Column) -> DataFrame:
    """Add per-group aggregates to every row, as an aggregate over a partition without order would.

    Built from a grouped aggregate (combined before the shuffle) and a salted lookup, because a window would
    bring each whole group into one task. Rows with a null key form a group.
    """
    grouped = df.groupBy(*by).agg(*[value.alias(name) for name, value in stats.items()])
    return look_up(df, grouped, by, null_safe=null_safe)


def all_pairs(left: DataFrame, right: DataFrame, spread: int | None = None) -> DataFrame:
    """Every row of ``left`` with every row of ``right``, for dimension frames whose grid is the result itself.

    ``right`` is the small dimension. Its rows are brought beside each row of ``left`` as one array and exploded there, so
    only the rows of ``left`` are shuffled, once, however wide the cluster is; the grid is built by all of its tasks. The
    array is refused beyond ``GRID_ROWS`` rows. For two large dimensions give ``spread``: ``right`` is then dealt into that
    many slices, ``left`` is copied once per slice, and the grid is a partitioned equi join.
    """
    if spread is not None:
        dealt = right.withColumn("_slice", _salt(right, spread))
        copied = left.withColumn("_slice", F.explode(_slices(spread)))
        return copied.join(dealt, "_slice").drop("_slice")
    names = [F.col(f"`{name}`") for name in left.columns]
    refused = F.raise_error(F.lit(f"the small side of a grid has more than {GRID_ROWS} rows: give a spread")).cast("int")
    wanted = F.when(F.count(F.lit(1)) > GRID_ROWS, refused).otherwise(GRID_ROWS)
    rows = right.limit(GRID_ROWS + 1).agg(F.slice(F.collect_list(F.struct(*[F.col(f"`{name}`") for name in right.columns])), 1, wanted))
    width = int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    beside = left.repartition(width, *names).select(*names, F.explode(rows.scalar()).alias("_row"))
    return beside.select(*names, "_row.*")


def dense_spine(*dimensions: DataFrame) -> DataFrame:
    return reduce(all_pairs, dimensions)


def key_union(keys: list[str], *frames: DataFrame) -> DataFrame:
    """The distinct keys that occur in any frame: the sparse counterpart of a dense spine."""
    return reduce(lambda a, b: a.unionByName(b), [f.select(*keys) for f in frames]).distinct()


def attach(spine: DataFrame, facts: DataFrame, keys: list[str], measures: list[str]) -> DataFrame:
    """Left join measures to a spine and fill the gaps with zero."""
    return spine.join(facts.select(*keys, *measures), keys, "left").fillna(0, subset=measures)


def reconcile(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Keep the keys of both sides, with the measures of each side (null where a side lacks the key).

    Both sides have one row per key. The merge is a union and one grouping, so it needs a single shuffle, and
    null keys of the two sides meet.
    """
    stacked = left.unionByName(right, allowMissingColumns=True)
    measures = [name for name in stacked.columns if name not in keys]
    return stacked.groupBy(*keys).agg(*[F.max(name).alias(name) for name in measures])


def resolve_alias(items: DataFrame) -> DataFrame:
    """Follow one hop: an item takes the report item of the item it points to; dangling pointers drop out.

    ``items`` has ``item_code`` (unique) and ``points_to``.
    """
    targets = items.select(F.col("item_code").alias("points_to"), F.col("points_to").alias("report_item"))
    return items.join(targets, "points_to").select("item_code", "report_item")


def prior_year(df: DataFrame, keys: list[str], values: dict[str, str]) -> DataFrame:
    """Left join the same week of the year before; ``values`` maps column names to their prior-year names.

    Two weeks can carry the same year and week label; the earlier one stands for the label, so rows never
    multiply.
    """
    before = (
        df.groupBy(*keys, (F.col("yr") + 1).alias("yr"), "wk")
        .agg(F.min_by(F.struct(*values), "min_dt").alias("_before"))
        .select(*keys, "yr", "wk", *[F.col(f"_before.{name}").alias(new) for name, new in values.items()])
    )
    return df.join(before, [*keys, "yr", "wk"], "left")


def nearest_in_time(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    columns: list[str],
    tie: list[str],
) -> DataFrame:
    """For each left row the right row of the same key nearest in hour marks, before or after.

    Equal distances go to the smallest ``tie`` values. Right rows without a timestamp are no candidates. Left
    rows without a match get nulls. Of the candidates between two neighbouring left times of a key only the first and
    the last can be nearest to any, so only these are kept; a key with more than ``FEW_TIMES`` left times keeps one
    candidate per hour. A hot key brings at most as many rows to one task as its history has hours, and no pairs are formed.
    """
    hour = F.date_trunc
    choice = F.struct(*[F.col(name).alias(f"_tie_{i}") for i, name in enumerate(tie)], F.struct(*columns).alias("row"))
    asked = left.where(F.col(left_time).isNotNull()).select(key, hour("hour", F.col(left_time)).alias("_hour")).distinct()
    times = asked.groupBy(F.col(key).alias(f"_r_{key}")).agg(F.collect_set("_hour").alias("_times")).withColumn(
        "_times", F.when(F.size("_times") <= FEW_TIMES, F.col("_times"))
    )
    gap = F.when(F.col("_times").isNotNull(), F.size(F.filter("_times", lambda time: time < F.col("_hour"))).cast("bigint"))
    seconds = F.unix_seconds("_hour")
    named = right.where(F.col(right_time).isNotNull()).select(key, hour("hour", F.col(right_time)).alias("_hour"), choice.alias("_choice"))
    ends = (
        named.join(times, _matches([key], True))
        .groupBy(key, F.coalesce(gap, seconds).alias("_gap"))
        .agg(F.min(F.struct(seconds, "_hour", "_choice")).alias("_first"), F.min(F.struct(-seconds, "_hour", "_choice")).alias("_last"))
    )
    candidates = ends.select(key, F.explode(F.array(*[F.struct(f"{end}._hour", f"{end}._choice") for end in ("_first", "_last")])).alias("_end")).select(
        key, "_end._hour", "_end._choice"
    )
    timeline = candidates.select(key, "_hour", F.struct("_hour", "_choice").alias("_seen")).unionByName(
        asked.select(key, "_hour", F.lit(None).cast(_struct_type(candidates)).alias("_seen"))
    )
    # Two running frames, one per direction: a frame open towards the end would be recomputed for every row.
    running = (Window.unboundedPreceding, 0)
    seen = timeline.withColumns(
        {
            side: F.last("_seen", ignorenulls=True).over(
                Window.partitionBy(key).orderBy(order).rangeBetween(*running)
            )
            for side, order in (("_before", F.asc("_hour")), ("_after", F.desc("_hour")))
        }
    ).where(F.col("_seen").isNull())
    sides = F.array_compact(
        F.array(
            *[
                F.when(
                    F.col(side).isNotNull(),
                    F.struct(
                        F.abs(hour_boundaries(F.col("_hour"), F.col(f"{side}._hour"))).alias("gap"),
                        F.col(f"{side}._choice").alias("choice"),
                    ),
                )
                for side in ("_before", "_after")
            ]
        )
    )
    answers = seen.select(key, "_hour", F.array_min(sides).alias("_best")).select(
        key,
        "_hour",
        F.col("_best.gap").alias("hours_apart"),
        *[F.col(f"_best.choice.row.{name}").alias(name) for name in columns],
    )
    rows = left.withColumn("_hour", hour("hour", F.col(left_time)))
    return look_up(rows, answers, [key, "_hour"], null_safe=True).drop("_hour")


def _struct_type(candidates: DataFrame):
    return candidates.select(F.struct("_hour", "_choice").alias("s")).schema["s"].dataType
