"""Stateful tables: change-only merges, tombstones, carry-forward, replace by period, guards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import dedup_latest


class GuardError(RuntimeError):
    """A load that would lose too much was refused."""


def _once(source: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """``columns`` of each key as ``_new``; a key that repeats fails the job when its row is made, as a merge of it has no one result.

    Grouped by the join's own keys, so its shuffle serves the join too.
    """
    packed = F.struct(*[F.col(c) for c in columns])
    grouped = source.groupBy(*keys).agg(F.first(packed).alias("_first"), F.count("*").alias("_n"))
    refused = F.raise_error(F.concat(F.lit(f"{', '.join(keys)} repeats in the source: "), F.to_json(F.struct(*keys))))
    return grouped.select(*keys, F.when(F.col("_n") > 1, refused).otherwise(F.col("_first")).alias("_new"))


def snapshot_actions(target: DataFrame, source: DataFrame, keys: list[str], ignore: tuple[str, ...] = (), delete: bool = True) -> DataFrame:
    """Keys with action insert, update, delete or keep; columns in ``ignore`` do not make a change.  One full outer join.

    A key that the source repeats is refused, as in ``merge_snapshot``.
    """
    compared = [c for c in source.columns if c not in keys and c not in ignore]
    t = target.select(*keys, F.struct(*compared).alias("_old"), F.lit(True).alias("_t"))
    s = _once(source, keys, compared)
    action = (
        F.when(F.col("_t").isNull(), "insert").when(F.col("_new").isNull(), "delete" if delete else "keep")
        .when(~F.col("_old").eqNullSafe(F.col("_new")), "update").otherwise("keep")
    )
    return t.join(s, keys, "full").select(*keys, action.alias("action"))


def merge_snapshot(target: DataFrame, source: DataFrame, keys: list[str], ignore: tuple[str, ...] = (), delete: bool = True) -> DataFrame:
    """The merged table: new and changed rows of the source, unchanged ones as the target has them.

    A key that the source repeats is refused: the job fails and names it (``merge_batch`` takes the last row of such).
    """
    columns = target.columns
    rest = [c for c in columns if c not in keys]
    compared = [c for c in rest if c not in ignore]
    t = target.select(*keys, F.struct(*rest).alias("_old"))
    both = t.join(_once(source, keys, rest), keys, "full")
    if delete:
        both = both.where("_new IS NOT NULL")
    same = reduce(lambda a, b: a & b, [F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in compared], F.lit(True))
    row = F.when(F.col("_new").isNull() | (F.col("_old").isNotNull() & same), F.col("_old")).otherwise(F.col("_new"))
    return both.withColumn("_row", row).select(*[F.col(c) if c in keys else F.col(f"_row.{c}").alias(c) for c in columns])


def last_in_batch(batch: DataFrame, keys: list[str], sequence: str) -> DataFrame:
    """Of rows that repeat a key in one batch, the last wins."""
    return dedup_latest(batch, keys, [F.col(sequence).desc_nulls_last()]).drop(sequence)


def tombstones(target: DataFrame, present: DataFrame, keys: list[str], run_at: Column, column: str = "missing_since") -> DataFrame:
    """``column`` set for keys absent from this run, kept if set before, cleared when they are back."""
    seen = present.select(*keys).distinct().withColumn("_seen", F.lit(True))
    state = F.when(F.col("_seen"), F.lit(None)).otherwise(F.coalesce(F.col(column), run_at))
    return target.join(seen, keys, "left").withColumn(column, state).drop("_seen")


def carry_forward(earlier: DataFrame, current: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Latest earlier row of every key that the current run lost, for groups that are not wholly absent from it."""
    lost = earlier.join(current.select(*keys).distinct(), keys, "left_anti")
    return dedup_latest(lost, keys, order)


def replace_by_period(table: DataFrame, batch: DataFrame, period: Column) -> DataFrame:
    """Rows of ``table`` outside the periods that ``batch`` brings, and all of ``batch``."""
    periods = batch.select(period.alias("_period")).distinct()
    kept = table.withColumn("_period", period).join(periods, "_period", "left_anti").drop("_period")
    return kept.unionByName(batch)


def unique_backfill(df: DataFrame, column: str, lookup: DataFrame, passes: list[list[str]], value: str) -> DataFrame:
    """``column`` filled, where null, from passes of ever looser keys; only keys with one value count."""
    for i, keys in enumerate(passes):
        only = lookup.groupBy(*keys).agg(F.countDistinct(value).alias("_n"), F.min(value).alias(f"_v{i}")).where("_n = 1").drop("_n")
        df = df.join(only, keys, "left")
    found = F.coalesce(F.col(column), *[F.col(f"_v{i}") for i in range(len(passes))])
    return df.withColumn(column, found).drop(*[f"_v{i}" for i in range(len(passes))])


def guard_shrink(before: int, after: int, rows: int = 10, percent: float = 5.0) -> None:
    """Refuse a refresh that loses more than ``rows`` rows and more than ``percent`` of them."""
    lost = before - after
    if lost > rows and lost * 100 > before * percent:
        raise GuardError(f"refused: {lost} of {before} rows would go")


def guard_wipe(before: int, after: int, least: int = 50, fraction: float = 0.5) -> None:
    """Refuse a load that brings less than ``fraction`` of a table that had at least ``least`` rows."""
    if before >= least and after < before * fraction:
        raise GuardError(f"refused: {after} rows instead of {before}")


def changes(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """History rows: key, column, old and new value as text, for every changed column of keys in both."""
    pairs = [F.struct(F.lit(c).alias("column"), F.col(f"o.{c}").cast("string").alias("old"),
        F.col(f"n.{c}").cast("string").alias("new")) for c in columns]
    both = old.alias("o").join(new.alias("n"), keys)
    changed = F.filter(F.array(*pairs), lambda x: ~x["old"].eqNullSafe(x["new"]))
    return both.select(*keys, F.explode(changed).alias("_c")).select(*keys, "_c.*")


def action_counts(target: DataFrame, source: DataFrame, keys: list[str], ignore: tuple[str, ...] = (), delete: bool = True) -> DataFrame:
    """What a merge would report: rows afterwards, and rows inserted, updated, deleted and kept."""
    n = lambda action: F.count_if(F.col("action") == action).alias(action)
    came = F.count_if(F.col("action").isin("insert", "update") | (F.col("action") == "keep")).alias("total")
    return snapshot_actions(target, source, keys, ignore, delete).agg(came, n("insert"), n("update"), n("delete"), n("keep"))


def merge_batch(
    target: DataFrame, batch: DataFrame, keys: list[str], sequence: str, ignore: tuple[str, ...] = (), insert_only: tuple[str, ...] = (),
) -> DataFrame:
    """Change-only merge of a batch that brings some keys: nothing is deleted.

    Of rows that repeat a key the last by ``sequence`` wins.  ``ignore`` columns (bookkeeping) follow the batch only when
    something else changed; ``insert_only`` columns are set when a key is new and never again.
    """
    last = last_in_batch(batch, keys, sequence)
    kept = target.select(*keys, *[F.col(c).alias(f"_first_{c}") for c in insert_only])
    source = last.join(kept, keys, "left").withColumns({c: F.coalesce(f"_first_{c}", c) for c in insert_only}) if insert_only else last
    return merge_snapshot(target, source.select(*target.columns), keys, ignore, delete=False)


def merge_capped(
    target: DataFrame, batch: DataFrame, keys: list[str], window: Column, rows: int = 10, percent: float = 20.0
) -> tuple[DataFrame, bool]:
    """Upsert a batch that should list all of a window; rows of the window that it leaves out go, if they are few.

    They go only if there are at most ``rows`` of them or ``percent`` of the window's rows, whichever is more; else none goes.
    Returns the merged table and whether deletions took place.
    """
    inside = target.where(window)
    gone = inside.join(batch.select(*keys).distinct(), keys, "left_anti")
    counted = inside.agg(F.count("*")).first()[0], gone.agg(F.count("*")).first()[0]
    allowed = counted[1] <= max(rows, counted[0] * percent / 100)
    left = target.join(gone.select(*keys), keys, "left_anti") if allowed else target
    return merge_snapshot(left, batch, keys, delete=False), allowed


def refresh_window(table: DataFrame, rebuilt: DataFrame, keys: list[str], window: Column, owner: str, rows: int = 10,
    percent: float = 5.0) -> DataFrame:
    """Replace a window of a table by its rebuilt rows, change by change; refused where too much would be lost.

    Lost are rows (``guard_shrink``) and owners: rows whose ``owner`` was known and no longer is, by the same bounds.
    """
    size = lambda df: df.agg(F.count("*").alias("n"), F.count(owner).alias("owned")).first()
    before, after = size(table.where(window)), size(rebuilt)
    guard_shrink(before.n, after.n, rows, percent)
    guard_shrink(before.owned, after.owned, rows, percent)
    return table.where(~F.coalesce(window, F.lit(False))).unionByName(merge_snapshot(table.where(window), rebuilt, keys))


def replace_if_enough(table: DataFrame, batch: DataFrame, part: str, percent: float = 90.0) -> DataFrame:
    """Per value of ``part``: the batch's rows if there are at least ``percent`` of the table's, else the table's."""
    count = lambda df, to: df.groupBy(part).agg(F.count("*").alias(to))
    sizes = count(table, "_old").join(count(batch, "_new"), part, "full")
    enough = sizes.select(part, (F.coalesce("_new", F.lit(0)) * 100 >= F.coalesce("_old", F.lit(0)) * percent).alias("_enough"))
    new = batch.join(enough.where("_enough").select(part), part, "left_semi")
    return table.join(enough.where("NOT _enough").select(part), part, "left_semi").unionByName(new.select(*table.columns))


def enrich_changed(df: DataFrame, lookup: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """Columns taken from a lookup where it knows the key and differs; ``changed`` tells which rows that made different."""
    known = lookup.select(*keys, *[F.col(c).alias(f"_new_{c}") for c in columns], F.lit(True).alias("_known"))
    both = df.join(known, keys, "left")
    differs = reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"_new_{c}")) for c in columns])
    changed = F.coalesce(F.col("_known"), F.lit(False)) & differs
    return both.withColumn("changed", changed).withColumns({c: F.when(F.col("changed"),
        F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns}).select(*df.columns, "changed")


def seed_unknown(found: DataFrame, known: DataFrame, key: str, classify: Column) -> DataFrame:
    """Keys that no table row has yet, each once, with a first class."""
    return found.where(F.col(key).isNotNull()).select(key).distinct().join(known.select(key), key, "left_anti").withColumn("class", classify)


def not_blank(old: DataFrame, new: DataFrame) -> DataFrame:
    """A refreshed table, or the old one where the refresh came out empty: stale is better than blank."""
    return old if new.isEmpty() else new


def changed_groups(hashes: DataFrame, state: DataFrame, keys: list[str], column: str = "content_hash") -> DataFrame:
    """Groups whose content hash is not the one of the last load, with what happened: new or changed."""
    then = state.select(*keys, F.col(column).alias("_then"))
    both = hashes.join(then, keys, "left").where(~F.col(column).eqNullSafe(F.col("_then")))
    return both.select(*keys, F.when(F.col("_then").isNull(), "new").otherwise("changed").alias("state"))


def roster_diff(old: DataFrame, new: DataFrame, keys: list[str], tracked: list[str], simple: list[str]) -> DataFrame:
    """Keys that are new, removed, changed in a ``tracked`` field (worth a history row) or only in a ``simple`` one.

    ``fields`` names the changed fields, tracked ones first.
    """
    both = old.withColumn("_o", F.lit(True)).alias("o").join(new.withColumn("_n", F.lit(True)).alias("n"), keys, "full")
    names = F.array_compact(F.array(*[F.when(~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")), F.lit(c)) for c in [*tracked, *simple]]))
    is_tracked = F.arrays_overlap(names, F.array(*[F.lit(c) for c in tracked]))
    change = (
        F.when(F.col("_o").isNull(), "new").when(F.col("_n").isNull(), "removed")
        .when(is_tracked, "tracked").when(F.size(names) > 0, "simple").otherwise("same")
    )
    both_sides = change.isin("tracked", "simple")
    return both.select(*keys, change.alias("change"), F.when(both_sides, F.array_join(names, ",")).alias("fields"))


def rebuilt_entries(
    raw: DataFrame, corrections: DataFrame, rejected: DataFrame, removed: DataFrame, additions: DataFrame,
    keys: list[str], order: list[Column], value: str, most: float,
) -> DataFrame:
    """A clean table from raw entries and what people decided about them.

    Raw rows are deduplicated by ``keys`` (the first of ``order``); rejected ones go, removed ones too unless a correction
    came for them (null-safe keys).  Corrections replace ``value`` of the rows they name; those that name none are rows
    of their own (orphans), as are additions.  Rows whose value exceeds ``most`` go at last unless a person gave it.
    ``provenance`` tells where a row came from.
    """
    from .joins import anti_unless, null_safe_anti

    first = dedup_latest(raw, keys, order)
    left = anti_unless(null_safe_anti(first, rejected, keys), removed, corrections, keys)
    fixes = corrections.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(value).alias("_value"))
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    applied = left.join(fixes, same, "left")
    fixed = applied.select(
        *keys, F.coalesce("_value", value).alias(value), F.when(F.col("_value").isNotNull(), "corrected").otherwise("raw").alias("provenance")
    )
    orphans = null_safe_anti(corrections, left, keys).select(*keys, value, F.lit("orphan").alias("provenance"))
    added = additions.select(*keys, value, F.lit("added").alias("provenance"))
    return fixed.unionByName(orphans).unionByName(added).where((F.col("provenance") != "raw") | F.col(value).isNull() | (F.col(value) <= most))


def alias_table(snapshots: list[DataFrame], key: str, email: str) -> DataFrame:
    """Every address a key has had in any snapshot, lower-cased; ``is_current`` where the last snapshot has it."""
    last = len(snapshots) - 1
    tagged = [df.select(F.lower(F.trim(F.col(email))).alias(email), key, F.lit(i == last).alias("_now")) for i, df in enumerate(snapshots)]
    both = reduce(DataFrame.unionByName, tagged).where(F.col(email).isNotNull() & (F.col(email) != ""))
    return both.groupBy(email, key).agg(F.bool_or("_now").alias("is_current"))
