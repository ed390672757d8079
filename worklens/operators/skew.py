"""Joins and ordered histories that hold when one key owns a large share of all rows.

Hot keys are counted, not guessed: a key is hot above ``hot_rows`` rows, so a table of N rows has
at most N / hot_rows of them. That bound is what makes broadcasting the list of hot keys safe.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: A key is hot above so many rows. A table of N rows then has at most N / HOT_ROWS hot keys, some
#: tens of bytes each; raise it with the table so that their list stays a few megabytes.
HOT_ROWS = 1_000_000

#: Hot keys that a join is told of at most, the largest ones.
MOST_HOT = 10_000

#: Slots a hot history is cut into at most, sampled events a slot, and cuts looked at in one leap.
SLOTS, SAMPLED, LEAP = 1024, 128, 32
_DRAWS = 1 << 40


def hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """``_hot_key, _parts``: each hot key, NULL too, and how many parts of ``hot_rows`` rows it makes."""
    return (
        df
        .groupBy(F.col(key).alias("_hot_key"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > hot_rows)
        .select("_hot_key", F.ceil(F.col("_rows") / hot_rows).cast("int").alias("_parts"))
    )


def heavy_keys(
    df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS, most: int = MOST_HOT
) -> dict[str, DataFrame | None]:
    """Of each of several key columns its hot keys as ``_hot_key, _parts``; None where none is hot.

    One aggregation counts all columns exactly: each row sends its keys with the column's number, and
    they are combined before the shuffle. Only keys above ``hot_rows`` reach the driver, and of those
    the ``most`` largest, so the lists are small whatever the table; a key beyond them is left to the
    engine's own skew handling.
    """
    keys = list(dict.fromkeys(keys))
    cells = F.explode(F.array(*[
        F.struct(F.lit(i).alias("_of"), F.col(c).cast("string").alias("_key"))
        for i, c in enumerate(keys)]))
    counted = (
        df.select(cells.alias("_cell")).groupBy("_cell._of", "_cell._key")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .where(F.col("_rows") > hot_rows)
        .orderBy(F.desc("_rows")).limit(most)
    ).collect()
    found: dict[str, DataFrame | None] = dict.fromkeys(keys)
    for i, name in enumerate(keys):
        rows = [(r["_key"], -(-r["_rows"] // hot_rows)) for r in counted if r["_of"] == i]
        if rows:
            found[name] = df.sparkSession.createDataFrame(
                rows, "_hot_key string, _parts int").withColumn(
                "_hot_key", F.col("_hot_key").cast(df.schema[name].dataType))
    return found


def skew_join(
    many: DataFrame, one: DataFrame, key: str, how: str = "inner",
    spread: Sequence[str] = (), hot_rows: int = HOT_ROWS, counted: DataFrame | None = None,
    heavy: Mapping[str, DataFrame | None] | None = None,
) -> DataFrame:
    """Equi-join ``many`` rows to the one row per key in ``one``, salting only the hot keys.

    ``spread`` names the columns whose hash picks the salt (the row id). Rows of a hot key spread
    over its parts and its single partner is copied once per part; NULL keys never match, so they
    spread too. The copies add at most N / hot_rows rows. Hot keys are counted first, in ``counted``
    if given (a cheaper table with the same rows or more, such as the source of ``many``), or come
    from ``heavy``, counted for several joins at once. Where none is hot this is a plain join.
    """
    if heavy is None:
        heavy = heavy_keys(many if counted is None else counted, [key], hot_rows)
    if heavy[key] is None:
        return many.join(one, key, how)
    parts = F.broadcast(heavy[key])
    pick = F.xxhash64(*(spread or many.columns))
    salt = F.coalesce(F.pmod(pick, F.col("_parts")), F.lit(0)).cast("int")
    hot = F.col(key).eqNullSafe(F.col("_hot_key"))
    copy = F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_parts"), F.lit(1)) - 1))
    salted = many.join(parts, hot, "left").select(*many.columns, salt.alias("_salt"))
    copies = one.join(parts, hot, "left").select(*one.columns, copy.alias("_salt"))
    return salted.join(copies, [key, "_salt"], how).drop("_salt")


def slot_bounds(
    events: DataFrame, key: str, order: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``_hot_key, _bounds``: where each hot key's history is cut into slots of about equal size.

    The cuts are quantiles of the whole order (all its columns) in a sample drawn by the rows' hash,
    ``SAMPLED`` rows or so a slot, so they follow the data: times that coincide or ids of any shape do
    not fill one slot. A key has at most ``SLOTS`` slots, which bounds sample and cuts; above
    ``SLOTS * hot_rows`` events its slots grow.
    """
    hot = F.broadcast(hot_keys(events, key, hot_rows).where("_hot_key IS NOT NULL"))
    slots = F.least("_parts", F.lit(SLOTS))
    share = slots * SAMPLED / (F.col("_parts") * hot_rows)
    drawn = F.pmod(F.xxhash64(*order), F.lit(_DRAWS)) < share * _DRAWS
    sampled = (
        events.join(hot, F.col(key) == F.col("_hot_key")).where(drawn)
        .groupBy("_hot_key")
        .agg(F.sort_array(F.collect_list(F.struct(*order))).alias("_sample"),
             F.max(slots).alias("_slots"))
    )
    at = lambda i: F.ceil(F.size("_sample") * i / F.col("_slots")).cast("int")
    cuts = F.transform(
        F.sequence(F.lit(1), F.col("_slots") - 1), lambda i: F.element_at("_sample", at(i)))
    return sampled.where("_slots > 1").select("_hot_key", cuts.alias("_bounds"))


def slotted(
    events: DataFrame, key: str, order: Sequence[str], hot_rows: int = HOT_ROWS
) -> DataFrame:
    """``events`` with ``_slot``: NULL for keys that are not hot, else a number that grows with the
    order. The cuts are at most ``SLOTS`` a hot key, which is what makes them small to broadcast."""
    position = F.struct(*order)
    reached = lambda cuts: F.size(F.filter(cuts, lambda cut: cut < position))
    # every LEAP-th cut first, then the cuts between two of those
    coarse = F.filter("_bounds", lambda _, i: i % LEAP == LEAP - 1)
    leaps = reached(coarse) * LEAP
    slot = leaps + reached(F.slice("_bounds", leaps + 1, F.lit(LEAP)))
    bounds = F.broadcast(slot_bounds(events, key, order, hot_rows))
    return events.join(bounds, F.col(key) == F.col("_hot_key"), "left").withColumn(
        "_slot", F.when(F.col("_hot_key").isNotNull(), slot)).drop("_bounds", "_hot_key")


def ordered_history(
    events: DataFrame, key: str, order: Sequence[str], *,
    number: str | None = None,
    following: Mapping[str, str] | None = None,
    preceding: Mapping[str, str] | None = None,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """Position, next and previous values of each event in its key's history.

    ``following`` and ``preceding`` map a new column to the column it reads one event later or
    earlier. A key with more than ``hot_rows`` events is ordered in slots (:func:`slotted`): windows
    run inside a slot, one summary row per slot carries the count and the edge values across, and an
    equi-join brings them back. Results equal a plain window over the whole key.
    ``hot_rows=None`` skips the split where histories are known to be short.
    """
    following, preceding = dict(following or {}), dict(preceding or {})
    if hot_rows is None:
        window = Window.partitionBy(key).orderBy(*order)
        return events.withColumns(_window_columns(window, number, following, preceding))

    cut = slotted(events, key, order, hot_rows)
    inside = Window.partitionBy(key, "_slot").orderBy(*order)
    local = cut.withColumns({
        **_window_columns(inside, number, following, preceding),
        "_is_last": F.lead(F.lit(1)).over(inside).isNull(),
        "_is_first": F.lag(F.lit(1)).over(inside).isNull(),
    })

    across = Window.partitionBy(key).orderBy("_slot")
    position = F.struct(*order)
    edges = {"_rows": F.count(F.lit(1))}
    for i, source in enumerate(following.values()):
        edges[f"_head{i}"] = F.min_by(F.col(source), position)
    for i, source in enumerate(preceding.values()):
        edges[f"_tail{i}"] = F.max_by(F.col(source), position)
    slots = (
        cut.where(F.col("_slot").isNotNull())
        .groupBy(key, "_slot")
        .agg(*[column.alias(name) for name, column in edges.items()])
        .select(
            key, "_slot",
            F.sum("_rows").over(across.rowsBetween(Window.unboundedPreceding, -1)).alias("_before"),
            *[F.lead(f"_head{i}").over(across).alias(f"_next{i}") for i in range(len(following))],
            *[F.lag(f"_tail{i}").over(across).alias(f"_prior{i}") for i in range(len(preceding))],
        )
    )
    joined = local.join(slots, [key, "_slot"], "left")
    fixed: dict[str, Column] = {}
    if number:
        fixed[number] = (F.col(number) + F.coalesce(F.col("_before"), F.lit(0))).cast("bigint")
    for i, target in enumerate(following):
        fixed[target] = F.when(F.col("_is_last"), F.col(f"_next{i}")).otherwise(F.col(target))
    for i, target in enumerate(preceding):
        fixed[target] = F.when(F.col("_is_first"), F.col(f"_prior{i}")).otherwise(F.col(target))
    return joined.select(
        *[F.col(c) for c in events.columns if c not in fixed],
        *[column.alias(name) for name, column in fixed.items()],
    )


def _window_columns(
    window, number: str | None, following: Mapping[str, str], preceding: Mapping[str, str]
) -> dict[str, Column]:
    columns: dict[str, Column] = {}
    if number:
        columns[number] = F.row_number().over(window).cast("bigint")
    for target, source in following.items():
        columns[target] = F.lead(source).over(window)
    for target, source in preceding.items():
        columns[target] = F.lag(source).over(window)
    return columns
