"""Change application as plain functions: merged = f(target, changes).

Results are written by the sinks. The anti joins put the (small) batch on the
right side, so Spark broadcasts it when it is under the broadcast threshold
and the target is not shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions.payload import add_key, has_key
from forecourt.operators.latest import earliest_per_key, latest_per_key


def upsert_replace(target: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every row of ``changes`` replaces the target row of its key. ``changes`` has one row per key."""
    kept = target.join(changes.select(*keys), list(keys), "left_anti")
    return kept.unionByName(changes)


def insert_if_absent(target: DataFrame, changes: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    """Add rows whose key the target lacks; the first of a batch by ``order_by`` wins."""
    return target.unionByName(new_rows(target, changes, keys, order_by))


def new_rows(target: DataFrame, changes: DataFrame, keys: Sequence[str], order_by: str) -> DataFrame:
    first = earliest_per_key(changes, keys, order_by)
    return first.join(target.select(*keys), list(keys), "left_anti").select(*target.columns)


def upsert_when(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    take_new: Callable[[str, str], Column],
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Upsert in which each of ``columns`` takes the incoming value only where ``take_new`` holds.

    ``take_new`` gets the names of the two structs (old row, new row) and
    returns a condition; NULL means keep. ``changes`` has one row per key.
    Both sides are read once; rows of a NULL key match nothing and stay.
    """
    rest = [c for c in target.columns if c not in keys]
    columns = rest if columns is None else list(columns)
    old = target.select(*[F.col(k).alias(f"_old_{k}") for k in keys], F.struct(*rest).alias("_old"))
    new = changes.select(*[F.col(k).alias(f"_new_{k}") for k in keys], F.struct(*rest).alias("_new"))
    met = old.join(new, reduce(lambda a, b: a & b, [F.col(f"_old_{k}") == F.col(f"_new_{k}") for k in keys]), "full_outer")
    fresh = F.col("_old").isNull()
    wins = F.coalesce(take_new("_old", "_new"), F.lit(False)) & F.col("_new").isNotNull()
    merged = [F.when(fresh | wins if c in columns else fresh, F.col(f"_new.{c}")).otherwise(F.col(f"_old.{c}")).alias(c) for c in rest]
    return met.select(*[F.when(fresh, F.col(f"_new_{k}")).otherwise(F.col(f"_old_{k}")).alias(k) for k in keys], *merged)


def upsert_newest(target: DataFrame, changes: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """Incoming row wins only if it is strictly newer; a tie keeps the stored row."""
    return upsert_when(target, changes, keys, lambda old, new: F.col(f"{old}.{ts}") < F.col(f"{new}.{ts}"))


def upsert_newest_partial(target: DataFrame, changes: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str]) -> DataFrame:
    """Only ``columns`` move on conflict, and the incoming row wins a tie."""
    take = lambda old, new: F.coalesce(F.col(f"{old}.{ts}") <= F.col(f"{new}.{ts}"), F.lit(True))
    return upsert_when(target, changes, keys, take, columns)


def upsert_by_file_date(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    ledger: DataFrame,
    file_id: str = "file_id",
    prefer: str = "newest",
) -> DataFrame:
    """Upsert deciding by the ledger's ``last_modified`` of the two files.

    ``prefer="newest"`` lets the newer file win. ``prefer="as_shipped"`` keeps
    the inverted test of the original job, where the older file wins.
    """
    dates = ledger.select(F.col("id").alias(file_id), F.col("last_modified").alias("_modified"))
    dated = [df.join(dates, file_id, "left") for df in (target, changes)]
    tests = {
        "newest": lambda old, new: F.col(f"{old}._modified") < F.col(f"{new}._modified"),
        "as_shipped": lambda old, new: F.col(f"{old}._modified") > F.col(f"{new}._modified"),
    }
    merged = upsert_when(dated[0], dated[1], keys, tests[prefer])
    return merged.select(*target.columns)


def apply_change_batch(target: DataFrame, batch: DataFrame, key: str, deleted: str) -> DataFrame:
    """Drop every id of the batch, then add its rows that are not tombstones."""
    kept = target.join(batch.select(key), [key], "left_anti")
    live = batch.where(F.coalesce(F.col(deleted) != "true", F.lit(True)))
    return kept.unionByName(live.select(*target.columns))


def delete_by_json_key(df: DataFrame, value: Column, ids: DataFrame, id_column: str = "id") -> DataFrame:
    """Drop rows whose extracted JSON value is in ``ids``; rows without the key stay."""
    gone = ids.select(F.col(id_column).alias("_gone"))
    return df.withColumn("_value", value).join(gone, F.col("_value") == F.col("_gone"), "left_anti").drop("_value")


def patch_json_if_missing(df: DataFrame, row_id: Column, mapping: DataFrame, key: str, payload: str = "payload") -> DataFrame:
    """Add ``key`` from ``mapping(id, value)`` to payloads that match by id and lack the key."""
    values = mapping.select(F.col("id").alias("_id"), F.col("value").alias("_value"))
    joined = df.withColumn("_row", row_id).join(values, F.col("_row") == F.col("_id"), "left")
    missing = F.col("_id").isNotNull() & ~has_key(F.col(payload), key)
    patched = F.when(missing, add_key(F.col(payload), key, F.col("_value"))).otherwise(F.col(payload))
    return joined.withColumn(payload, patched).select(*df.columns)


def purge_for_reprocess(rollup: DataFrame, date: str, from_date: Column) -> DataFrame:
    """Keep derived rows before ``from_date`` so the rest is rebuilt."""
    return rollup.where(F.col(date) < from_date)


def purge_ledger(ledger: DataFrame, jobs: Sequence[str]) -> DataFrame:
    """Forget the files of the given jobs; their rows go with ``cascade_delete``."""
    return ledger.where(~F.col("script").isin(*jobs))


def cascade_delete(rows: DataFrame, ledger: DataFrame, file_id: str = "file_id") -> DataFrame:
    """Keep rows whose file is still in the ledger."""
    return rows.join(ledger.select(F.col("id").alias(file_id)), [file_id], "left_semi")


def register_session(sessions: DataFrame, schema: Column, script: Column, payload: Column) -> DataFrame:
    """Append a run record (not validated) with the next free id."""
    new = sessions.agg((F.coalesce(F.max("id"), F.lit(0)) + 1).alias("id")).select(
        F.col("id").cast("bigint"), schema.alias("schema"), script.alias("script"), payload.alias("payload"), F.lit(False).alias("validated")
    )
    return sessions.unionByName(new)


def upsert_job_status(jobs: DataFrame, updates: DataFrame) -> DataFrame:
    """Set last_run, last_update, status and run_time of known jobs; start and frequency stay."""
    keys = ["schema", "script"]
    moving = ["last_run", "last_update", "status", "run_time"]
    new = updates.select(*keys, F.struct(*moving).alias("_new"))
    joined = jobs.join(new, keys, "left")
    kept = [F.when(F.col("_new").isNull(), F.col(c)).otherwise(F.col(f"_new.{c}")).alias(c) for c in moving]
    fixed = [c for c in jobs.columns if c not in keys + moving]
    return joined.select(*keys, *fixed, *kept).select(*jobs.columns)


def upsert_job_plan(jobs: DataFrame, plans: DataFrame) -> DataFrame:
    """Insert jobs or move their ``start_date`` and ``frequency``; run history stays."""
    empty = [F.lit(None).cast(jobs.schema[c].dataType).alias(c) for c in jobs.columns if c not in plans.columns]
    return upsert_when(jobs, plans.select("*", *empty), ["schema", "script"], lambda old, new: F.lit(True), ["start_date", "frequency"])


def dedupe_newest(changes: DataFrame, keys: Sequence[str], ts: str, ties: Sequence[Column] = ()) -> DataFrame:
    """One row per key, newest first: what an upsert batch must be."""
    return latest_per_key(changes, keys, ts, ties)
