"""Set-based changes: a table snapshot and a DataFrame of changes give the next snapshot.

Nothing is written here; store a result with ``sources.tables.overwrite`` under
a new path, or ``append`` the changed rows of a log.

Upserts and inserts read each side once and join once; table rows with a NULL
key pass by the join.  ``bulk=False`` is for change sets that are tiny against
their table: there the table is the streamed side of every join, so Spark can
broadcast the change set, read several times for it, and never shuffles the table.

Snapshots do not have the day column that a stored log is laid out by, since it
would be NULL or stale in changed rows; writing a snapshot adds it again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce
from operator import or_
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import at
from ..functions.frames import look_up, only_keys, top_per_key, undated, union_all, without_keys
from ..sources import schemas
from ..sources.constraints import CASCADE, PRIMARY_KEYS, RESTRICT, SET_NULL, foreign_keys
from ..sources.tables import Tables, with_defaults


class Change(NamedTuple):
    """The next snapshot and the rows that were inserted, updated or deleted.

    Where a change both adds and removes rows, ``changed`` has the added ones
    and ``removed`` the others.
    """

    snapshot: DataFrame
    changed: DataFrame
    removed: DataFrame | None = None

    def signed(self) -> DataFrame:
        """Added rows with ``sign`` 1 and removed ones with -1."""
        added = self.changed.withColumn("sign", F.lit(1))
        return added if self.removed is None else added.unionByName(self.removed.withColumn("sign", F.lit(-1)))


def _all_present(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for key in keys:
        out = out & F.col(key).isNotNull()
    return out


def _same(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool) -> Column:
    out = F.lit(True)
    for key in keys:
        equal = left[key].eqNullSafe(right[f"_k_{key}"]) if null_safe else left[key] == right[f"_k_{key}"]
        out = out & equal
    return out


def _keys_only(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(key).alias(f"_k_{key}") for key in keys])


def _present(target: DataFrame, rows: DataFrame, keys: Sequence[str], null_safe: bool) -> DataFrame:
    """Keys of ``rows`` that ``target`` already holds."""
    wanted = _keys_only(rows, keys)
    held = target.select(*keys)
    return held.join(wanted, _same(held, wanted, keys, null_safe), "left_semi").distinct()


def _absent_rows(
    target: DataFrame, rows: DataFrame, keys: Sequence[str], null_safe: bool, bulk: bool = False
) -> DataFrame:
    """Rows of the change set whose key the table does not hold."""
    if bulk and not null_safe:
        target = target.filter(_all_present(keys))
    held = _keys_only(target if bulk else _present(target, rows, keys, null_safe), keys)
    return rows.join(held, _same(rows, held, keys, null_safe), "left_anti")


def _one_per_key(rows: DataFrame, keys: Sequence[str], order: Sequence[Column] | None) -> DataFrame:
    """The first row per key in ``order``; without an order a repeated key is an error."""
    if order is not None:
        return top_per_key(rows, keys, order, 1)
    numbered = top_per_key(rows, keys, [F.lit(1)], 2, rank="_nth")
    repeated = F.raise_error(F.lit("change set touches a row twice")).cast("boolean")
    return numbered.filter(F.when(F.col("_nth") > 1, repeated).otherwise(True)).drop("_nth")


def _append_rows(target: DataFrame, rows: DataFrame) -> DataFrame:
    known = rows.select(*[c for c in rows.columns if c in target.columns])
    return target.unionByName(known, allowMissingColumns=True)


def merge_upsert(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    as_of: dt.date | dt.datetime | None = None,
    order: Sequence[Column] | None = None,
    null_safe: bool = False,
    bulk: bool = True,
) -> Change:
    """Insert new keys; for known keys take ``update_cols`` from the change.

    ``updated_at`` of updated rows becomes ``as_of``.  Rows with a NULL key are
    always new, unless ``null_safe`` makes NULL equal to NULL (ratings of a
    whole title, say).  ``order`` picks the row to use when ``changes`` names a
    key twice; without it that is an error.
    """
    target = undated(target)
    keyed = changes if null_safe else changes.filter(_all_present(keys))
    loose = changes.limit(0) if null_safe else changes.filter(~_all_present(keys))
    keyed = _one_per_key(keyed, keys, order)
    if bulk:
        return _merge_all(target, keyed, loose, keys, update_cols, as_of, null_safe)
    incoming = keyed.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[F.col(c).alias(f"_n_{c}") for c in update_cols],
        F.lit(True).alias("_hit"),
    )
    merged = target.join(incoming, _same(target, incoming, keys, null_safe), "left")
    new_values = {c: F.when(F.col("_hit"), F.col(f"_n_{c}")).otherwise(F.col(c)) for c in update_cols}
    if as_of is not None and "updated_at" in target.columns:
        new_values["updated_at"] = F.when(F.col("_hit"), at(as_of)).otherwise(F.col("updated_at"))
    merged = merged.withColumns(new_values)
    inserted = _absent_rows(target, keyed, keys, null_safe)
    if not null_safe:
        inserted = inserted.unionByName(loose)
    kept = merged.select(*target.columns)
    updated = merged.filter("_hit").select(*target.columns)
    return Change(_append_rows(kept, inserted), _append_rows(updated, inserted))


def _merge_all(
    target: DataFrame,
    keyed: DataFrame,
    loose: DataFrame,
    keys: Sequence[str],
    update_cols: Sequence[str],
    as_of: dt.date | dt.datetime | None,
    null_safe: bool,
) -> Change:
    """The upsert as one full outer join.

    Table rows with a NULL key match nothing and would all hash alike, so they
    bypass the join.
    """
    joinable = target if null_safe else target.filter(_all_present(keys))
    given = [c for c in keyed.columns if c in target.columns]
    incoming = keyed.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[F.col(c).alias(f"_n_{c}") for c in given],
        F.lit(True).alias("_hit"),
    )
    left = joinable.withColumn("_old", F.lit(True))
    merged = left.join(incoming, _same(left, incoming, keys, null_safe), "full")
    both = F.col("_hit") & F.col("_old")
    values = {}
    for c in target.columns:
        new, old = (F.col(f"_n_{c}") if c in given else F.lit(None)), F.col(c)
        if c == "updated_at" and as_of is not None:
            values[c] = F.when(both, at(as_of)).otherwise(F.coalesce(old, new))
        elif c in update_cols:
            values[c] = F.when(F.col("_hit"), new).otherwise(old)
        else:
            values[c] = F.when(F.col("_old"), old).otherwise(new)
    merged = merged.select(*[v.alias(c) for c, v in values.items()], "_hit")
    kept = merged.drop("_hit") if null_safe else merged.drop("_hit").unionByName(target.filter(~_all_present(keys)))
    return Change(_append_rows(kept, loose), _append_rows(merged.filter("_hit").drop("_hit"), loose))


def insert_ignore(
    target: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    where: str | None = None,
    null_safe: bool = False,
    order: Sequence[Column] | None = None,
    bulk: bool = True,
) -> Change:
    """Insert rows whose key is not there yet.

    ``where`` limits the key's uniqueness to rows that satisfy it, on both
    sides; other rows are always inserted.  Of new rows with the same key the
    first in ``order`` is used (by default in the order of their other columns).
    """
    target = undated(target)
    competes = F.coalesce(F.expr(where), F.lit(False)) if where else F.lit(True)
    if not null_safe:
        competes = competes & _all_present(keys)
    if order is None:
        order = [F.asc(c) for c in new.columns if c not in keys] or [F.lit(1)]
    candidates = _one_per_key(new.filter(competes), keys, order)
    rivals = target.filter(where) if where else target
    fresh = _absent_rows(rivals, candidates, keys, null_safe, bulk).unionByName(new.filter(~competes))
    return Change(_append_rows(target, fresh), _append_rows(target.limit(0), fresh))


class Split(NamedTuple):
    ok: DataFrame
    rejected: DataFrame


def append_valid(df: DataFrame, predicate: str | Column) -> Split:
    """Rows that may be appended and those that may not; an unknown outcome is a no."""
    valid = F.expr(predicate) if isinstance(predicate, str) else predicate
    valid = F.coalesce(valid, F.lit(False))
    return Split(df.filter(valid), df.filter(~valid))


# What a row must satisfy before it is logged or listed.
LOG_GUARDS = {
    "search_history": "length(trim(search_query)) > 0",
    "watch_history": "progress_seconds >= 0 and watch_duration_seconds >= 0",
    "content": "content_type = 'Movie' or (content_type = 'Series' and duration_minutes is null)",
}


def number_rows(
    target: DataFrame | None, new: DataFrame, id_column: str, by: Sequence[str], buckets: int = 1024
) -> DataFrame:
    """Give new rows consecutive ids after the highest one of ``target``.

    ``by`` must identify a new row; it is an error if two rows share it, since
    their ids could differ from one evaluation to the next.  Rows are numbered inside hash buckets and
    every bucket starts where the one before it ends, so no task sorts all of
    them and a recomputed task gives the same ids.
    """
    bucketed = new.withColumn("_bucket", F.pmod(F.xxhash64(*by), F.lit(buckets)).cast("int"))
    sizes = bucketed.groupBy("_bucket").agg(F.count("*").alias("_size"))
    earlier = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_start"))
    ordered = Window.partitionBy("_bucket").orderBy(*by)
    tied = F.raise_error(F.lit(f"two new rows share {', '.join(by)}")).cast("int")
    nth = F.when(F.row_number().over(ordered) == F.rank().over(ordered), F.row_number().over(ordered)).otherwise(tied)
    base = F.lit(0) if target is None else F.coalesce(target.agg(F.max(id_column)).scalar(), F.lit(0))
    return (
        bucketed.withColumn("_nth", nth)
        .join(starts, "_bucket")
        .withColumn(id_column, (base + F.col("_start") + F.col("_nth")).cast("bigint"))
        .drop("_bucket", "_nth", "_start")
    )


def insert_rows(
    target: DataFrame,
    rows: DataFrame,
    table: str,
    by: Sequence[str],
    as_of: dt.datetime,
    gen: int = 2,
    buckets: int = 1024,
) -> Change:
    """Append entity rows with fresh ids and the table's defaults.

    ``by`` must identify a new row; ids that ``rows`` brings are kept.
    ``buckets`` is the number of tasks over which new rows are numbered.
    """
    target = undated(target)
    (key,) = PRIMARY_KEYS[table]
    numbered = rows if key in rows.columns else number_rows(target, rows, key, by, buckets)
    complete = with_defaults(numbered, table, as_of, gen)
    return Change(target.unionByName(complete, allowMissingColumns=True), complete)


def expand_insert(rows: DataFrame, arrays: Mapping[str, str]) -> DataFrame:
    """One child row per element of parallel arrays, e.g. ``{"country_codes": "country_code"}``.

    Shorter arrays are filled with NULL.
    """
    zipped = F.arrays_zip(*[F.col(a).alias(name) for a, name in arrays.items()])
    parents = [c for c in rows.columns if c not in arrays]
    return rows.select(*parents, F.explode(zipped).alias("_e")).select(
        *parents, *[F.col("_e")[name].alias(name) for name in arrays.values()]
    )


def create_titles(
    T: Tables, new: DataFrame, by: Sequence[str], as_of: dt.datetime, gen: int = 2, folder: str | None = None, buckets: int = 1024
) -> Tables:
    """Add titles with their genres and language tracks at once.

    ``new`` has title columns and the arrays genre_ids, language_ids,
    language_types and is_default.  Ids do not change when a task is run again,
    so the children get the ids of their titles.  With a ``folder`` the titles
    are numbered once, into a table there from which all three are taken;
    without one each evaluates the numbering for itself.
    """
    numbered = number_rows(T["content"], new, "content_id", by, buckets)
    if folder is not None:
        numbered.write.mode("overwrite").parquet(folder)
        numbered = new.sparkSession.read.schema(numbered.schema).parquet(folder)
    titles = insert_rows(T["content"], numbered, "content", by, as_of, gen)
    genres = expand_insert(numbered.select("content_id", "genre_ids"), {"genre_ids": "genre_id"})
    lists = {"language_ids": "language_id", "language_types": "language_type", "is_default": "is_default"}
    tracks = expand_insert(numbered.select("content_id", *lists), lists)
    track = ["content_id", "language_id", "language_type"]
    return T.replace(
        content=titles.snapshot,
        content_genres=insert_ignore(T["content_genres"], genres, ["content_id", "genre_id"]).snapshot,
        content_languages=insert_rows(
            T["content_languages"], tracks, "content_languages", track, as_of, gen, buckets
        ).snapshot,
    )


def create_profiles(T: Tables, new: DataFrame, by: Sequence[str], as_of: dt.datetime, gen: int = 2) -> Tables:
    """Add profiles, each with a row of default preferences."""
    profiles = insert_rows(T["profiles"], new, "profiles", by, as_of, gen)
    blank = profiles.changed.select("profile_id")
    return T.replace(
        profiles=profiles.snapshot,
        profile_preferences=insert_rows(
            T["profile_preferences"], blank, "profile_preferences", ["profile_id"], as_of, gen
        ).snapshot,
    )


def replace_children(
    target: DataFrame,
    owners: DataFrame,
    new: DataFrame,
    parent: DataFrame | None = None,
    parent_key: str | None = None,
) -> Change:
    """Drop all child rows of ``owners`` and insert ``new`` for them.

    New rows of other owners, and those whose ``parent_key`` is not in
    ``parent``, are left out.
    """
    target = undated(target)
    flagged = target.join(owners.distinct().withColumn("_gone", F.lit(True)), owners.columns, "left")
    keep = flagged.filter(F.col("_gone").isNull()).select(*target.columns)
    rows = only_keys(new, owners)
    if parent is not None and parent_key is not None:
        rows = only_keys(rows, parent.select(parent_key))
    rows = rows.distinct()
    return Change(_append_rows(keep, rows), _append_rows(target.limit(0), rows), flagged.filter("_gone").select(*target.columns))


def toggle(target: DataFrame, pairs: DataFrame, keys: Sequence[str], bulk: bool = True) -> Change:
    """Remove the pairs that are there, add those that are not.

    One full outer join tells them apart; rows and pairs with a NULL key, which
    equal nothing, pass by it.  ``bulk=False`` keeps the table the streamed
    side of two joins, so that a tiny set of pairs can be broadcast.
    """
    target = undated(target)
    pairs = _one_per_key(pairs, keys, [F.asc(c) for c in pairs.columns if c not in keys] or [F.lit(1)])
    if not bulk:
        kept, removed = without_keys(target, pairs.select(*keys)), only_keys(target, pairs.select(*keys))
        added = _absent_rows(target, pairs, keys, False, False)
        return Change(_append_rows(kept, added), _append_rows(target.limit(0), added), removed)
    given = [c for c in pairs.columns if c in target.columns]
    held = target.filter(_all_present(keys)).withColumn("_old", F.lit(True))
    asked = pairs.filter(_all_present(keys)).select(*[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_n_{c}") for c in given], F.lit(True).alias("_new"))
    both = held.join(asked, _same(held, asked, keys, False), "full")
    values = [F.when(F.col("_old"), F.col(c)).otherwise(F.col(f"_n_{c}") if c in given else F.lit(None)).alias(c) for c in target.columns]
    told = both.select(*values, F.coalesce("_old", F.lit(False)).alias("_old"), F.coalesce("_new", F.lit(False)).alias("_new"))
    loose = pairs.filter(~_all_present(keys))
    kept = told.filter("_old <> _new").select(*target.columns).unionByName(target.filter(~_all_present(keys)))
    added = told.filter("not _old").select(*target.columns)
    removed = told.filter("_old and _new").select(*target.columns)
    return Change(_append_rows(kept, loose), _append_rows(added, loose), removed)


def update_where(df: DataFrame, predicate: str | Column, values: Mapping[str, object]) -> Change:
    """Set columns on the rows that satisfy ``predicate``.

    ``values`` are literals or Columns; Columns see the old values.
    """
    df = undated(df)
    hit = F.coalesce(F.expr(predicate) if isinstance(predicate, str) else predicate, F.lit(False))
    new = {c: _literal(v) for c, v in values.items()}
    types = {f.name: f.dataType for f in df.schema}
    changed = {c: F.when(hit, v.cast(types[c])).otherwise(F.col(c)) for c, v in new.items()}
    only = {c: v.cast(types[c]) for c, v in new.items()}
    return Change(df.withColumns(changed), df.filter(hit).withColumns(only))


def _literal(value: object) -> Column:
    if isinstance(value, dt.datetime):
        return at(value)
    return value if isinstance(value, Column) else F.lit(value)


def patch(
    target: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    as_of: dt.date | dt.datetime | None = None,
    order: Sequence[Column] | None = None,
) -> Change:
    """Overwrite with the non-NULL columns of each change, leave the others."""
    target = undated(target)
    columns = [c for c in changes.columns if c not in keys]
    incoming = _one_per_key(changes.filter(_all_present(keys)), keys, order).select(
        *[F.col(k).alias(f"_k_{k}") for k in keys],
        *[F.col(c).alias(f"_n_{c}") for c in columns],
        F.lit(True).alias("_hit"),
    )
    merged = target.join(incoming, _same(target, incoming, keys, False), "left")
    values = {c: F.coalesce(F.col(f"_n_{c}"), F.col(c)) for c in columns}
    if as_of is not None and "updated_at" in target.columns:
        values["updated_at"] = F.when(F.col("_hit"), at(as_of)).otherwise(F.col("updated_at"))
    merged = merged.withColumns(values)
    return Change(merged.select(*target.columns), merged.filter("_hit").select(*target.columns))


def stamped(df: DataFrame, values: Mapping[str, object], as_of: dt.date | dt.datetime) -> dict[str, object]:
    """``values`` plus the change time, if the table records one."""
    return {**values, "updated_at": at(as_of)} if "updated_at" in df.columns else dict(values)


# State transitions -----------------------------------------------------------------------------


def _chosen(who: str | Column) -> Column:
    return F.expr(who) if isinstance(who, str) else who


def verify_email(users: DataFrame, who: str | Column, as_of: dt.date) -> Change:
    """Mark pending accounts that satisfy ``who`` verified and active."""
    values = {"email_verified": True, "account_status": "active"}
    return update_where(users, (F.col("account_status") == "pending") & _chosen(who), stamped(users, values, as_of))


def set_status(df: DataFrame, who: str | Column, old: str | None, new: str, as_of: dt.date) -> Change:
    """Publish, retire, reinstate or pause the rows that satisfy ``who``; ``old=None`` takes any state."""
    hit = _chosen(who) if old is None else _chosen(who) & (F.col("status") == old)
    return update_where(df, hit, stamped(df, {"status": new}, as_of))


def expire_downloads(downloads: DataFrame, as_of: dt.date) -> Change:
    """Nightly job: active downloads past their expiry date."""
    due = (F.col("download_status") == "Active") & (F.col("expiry_date") < F.lit(as_of))
    return update_where(downloads, due, {"download_status": "Expired"})


def cancel(subscriptions: DataFrame, who: str | Column, reason: str | None, as_of: dt.date) -> Change:
    """Cancel active subscriptions that satisfy ``who``."""
    values = {
        "status": "cancelled",
        "auto_renew": False,
        "cancelled_at": at(as_of),
        "cancellation_reason": reason,
        "next_billing_date": None,
    }
    return update_where(
        subscriptions, (F.col("status") == "active") & _chosen(who), stamped(subscriptions, values, as_of)
    )


def resume(subscriptions: DataFrame, who: str | Column, as_of: dt.date) -> Change:
    """Paused subscriptions run again and are billed a month from ``as_of``."""
    values = {"status": "active", "next_billing_date": F.add_months(F.lit(as_of), 1)}
    return update_where(
        subscriptions, (F.col("status") == "paused") & _chosen(who), stamped(subscriptions, values, as_of)
    )


def remove_downloads(downloads: DataFrame, who: str | Column) -> Change:
    """Downloads that a device no longer has; those removed before stay as they are."""
    return update_where(downloads, (F.col("download_status") != "Deleted") & _chosen(who), {"download_status": "Deleted"})


def record_progress(log: DataFrame, sessions: DataFrame, order: Sequence[Column] | None = None) -> Change:
    """Sessions that went on: ``sessions`` has watch_id and the new progress_seconds, watch_duration_seconds and completed.

    Of several reports on a session, which ``order`` sorts, the first counts.
    """
    return patch(log, sessions, ["watch_id"], order=order)


def close_windows(windows: DataFrame, who: str | Column, day: dt.date) -> Change:
    """Let open windows, and those that end later, end on ``day``; windows that have not begun by then stay."""
    last = F.col("available_to")
    begun = (F.col("available_from") < F.lit(day)) & (last.isNull() | (last > F.lit(day)))
    return update_where(windows, begun & _chosen(who), {"available_to": F.lit(day)})


def ping_devices(devices: DataFrame, seen: DataFrame) -> Change:
    """``seen`` has device_id and seen_at; a device keeps the latest moment, a late report does not set it back."""
    devices = undated(devices)
    last = seen.groupBy("device_id").agg(F.max("seen_at").alias("_seen"))
    merged = devices.join(last, "device_id", "left").withColumn(
        "_hit", F.col("_seen").isNotNull() & (F.col("last_active_at").isNull() | (F.col("_seen") > F.col("last_active_at")))
    )
    merged = merged.withColumn("last_active_at", F.when(F.col("_hit"), F.col("_seen")).otherwise(F.col("last_active_at")))
    return Change(merged.select(*devices.columns), merged.filter("_hit").select(*devices.columns))


def set_ceiling(profiles: DataFrame, who: str | Column, limit: str | None, as_of: dt.date) -> Change:
    """Give kids profiles the highest rating that they may watch; ``None`` takes the limit away."""
    return update_where(profiles, F.col("is_kids") & _chosen(who), stamped(profiles, {"age_rating_limit": limit}, as_of))


# Billing ---------------------------------------------------------------------------------------


def renew(subscriptions: DataFrame, as_of: dt.date, by_cycle: bool = False) -> Change:
    """Move the billing date of renewing subscriptions due on ``as_of`` on by a month.

    ``by_cycle`` moves yearly ones by a year.
    """
    months = F.when(F.col("billing_cycle") == "yearly", 12).otherwise(1) if by_cycle else F.lit(1)
    due = (F.col("status") == "active") & F.col("auto_renew") & (F.col("next_billing_date") == F.lit(as_of))
    values = {"next_billing_date": F.add_months("next_billing_date", months)}
    return update_where(subscriptions, due, stamped(subscriptions, values, as_of))


class Billing(NamedTuple):
    payments: Change
    subscriptions: Change


def apply_payments(payments: DataFrame, subscriptions: DataFrame, incoming: DataFrame) -> Billing:
    """Record payments once per transaction and bill the next month.

    Every newly recorded completed payment moves a monthly subscription's
    billing date on by one month, month by month: a date clamped to the end of
    a short month stays there.
    """
    subscriptions = undated(subscriptions)
    recorded = insert_ignore(payments, incoming, ["transaction_id"])
    paid = (
        recorded.changed.filter("payment_status = 'completed'")
        .groupBy("subscription_id")
        .agg(F.count("*").cast("int").alias("_times"))
    )
    each = F.sequence(F.lit(1), F.col("_times"))
    later = F.aggregate(each, F.col("next_billing_date"), lambda day, _: F.add_months(day, F.lit(1)))
    hit = F.col("_times").isNotNull() & (F.col("billing_cycle") == "monthly")
    moved = subscriptions.join(paid, "subscription_id", "left").withColumn("_hit", F.coalesce(hit, F.lit(False)))
    moved = moved.withColumn("next_billing_date", F.when(F.col("_hit"), later).otherwise(F.col("next_billing_date")))
    columns = subscriptions.columns
    return Billing(recorded, Change(moved.select(*columns), moved.filter("_hit").select(*columns)))


def refund(payments: DataFrame, refunds: DataFrame, as_of: dt.date | dt.datetime) -> Change:
    """Refund completed payments, at most what was paid.

    ``refunds`` has payment_id and refund_amount; the first per payment counts,
    smallest amount first, since the payment is no longer completed after it.
    """
    payments = undated(payments)
    asked = _one_per_key(refunds, ["payment_id"], [F.asc("refund_amount")]).select(
        "payment_id", F.col("refund_amount").alias("_asked")
    )
    merged = payments.join(asked, "payment_id", "left").withColumn(
        "_hit", F.col("_asked").isNotNull() & (F.col("payment_status") == "completed")
    )
    amount = F.least("_asked", "amount").cast(payments.schema["refund_amount"].dataType)
    merged = merged.withColumns(
        {
            "refund_amount": F.when(F.col("_hit"), amount).otherwise(F.col("refund_amount")),
            "payment_status": F.when(F.col("_hit"), "refunded").otherwise(F.col("payment_status")),
            "refunded_at": F.when(F.col("_hit"), at(as_of)).otherwise(F.col("refunded_at")),
        }
    )
    columns = payments.columns
    return Change(merged.select(*columns), merged.filter("_hit").select(*columns))


def set_exclusive(
    df: DataFrame, group: Sequence[str], id_column: str, flag: str, chosen: DataFrame
) -> Change:
    """Make the chosen row the only flagged one of its group.

    ``chosen`` has the group columns and the id, one row per group; other
    groups stay as they are.
    """
    df = undated(df)
    picked = _one_per_key(chosen, group, None).select(*group, F.col(id_column).alias("_pick"))
    merged = df.join(picked, list(group), "left")
    value = F.when(F.col("_pick").isNull(), F.col(flag)).otherwise(F.col(id_column) == F.col("_pick"))
    merged = merged.withColumn("_old", F.col(flag)).withColumn(flag, value)
    return Change(merged.select(*df.columns), merged.filter(F.col("_old") != F.col(flag)).select(*df.columns))


def change_plan(subscriptions: DataFrame, changes: DataFrame, as_of: dt.date) -> Change:
    """End the active subscription of each user and start one on the new plan.

    ``changes`` has user_id, plan_id and billing_cycle, one row per user.
    """
    subscriptions = undated(subscriptions)
    changes = _one_per_key(changes, ["user_id"], None)
    merged = subscriptions.join(changes.select("user_id", F.lit(True).alias("_hit")), "user_id", "left")
    ended = update_where(
        merged,
        F.col("_hit") & (F.col("status") == "active"),
        stamped(merged, {"status": "expired", "end_date": F.lit(as_of), "next_billing_date": None}, as_of),
    )
    columns = subscriptions.columns
    started = number_rows(subscriptions, changes, "subscription_id", ["user_id"]).withColumns(
        {
            "status": F.lit("active"),
            "start_date": F.lit(as_of),
            "next_billing_date": F.add_months(F.lit(as_of), 1),
            "auto_renew": F.lit(True),
        }
    )
    for stamp in ("created_at", "updated_at"):
        if stamp in columns:
            started = started.withColumn(stamp, at(as_of))
    return Change(
        _append_rows(ended.snapshot.select(*columns), started),
        _append_rows(ended.changed.select(*columns), started),
    )


# Deletes ---------------------------------------------------------------------------------------


def delete_where(df: DataFrame, predicate: str | Column) -> Change:
    df = undated(df)
    hit = F.coalesce(F.expr(predicate) if isinstance(predicate, str) else predicate, F.lit(False))
    return Change(df.filter(~hit), df.filter(hit))


def delete_keys(df: DataFrame, keys: DataFrame) -> Change:
    df = undated(df)
    return Change(without_keys(df, keys), only_keys(df, keys))


class Deletion(NamedTuple):
    """``tables`` after the delete; it must not be used unless ``blocked`` is empty."""

    tables: Tables
    blocked: DataFrame


def delete_cascade(T: Tables, table: str, keys: DataFrame, gen: int = 2) -> Deletion:
    """Delete rows of one table and do what its references ask of the others.

    Children cascade, lose their reference, or block the delete; each child is
    read once, and rows without a reference are spread over the tasks of the
    join that looks it up.  ``keys`` holds the primary key of the rows to go.  ``blocked`` counts the references
    that forbid the delete, per child table.
    """
    references = [fk for fk in foreign_keys(gen) if fk.child in T and fk.parent in T]
    doomed = {table: keys}
    after: dict[str, DataFrame] = {table: without_keys(undated(T[table]), keys)}
    blocked: list[DataFrame] = []
    for child in _parents_first(references, table):
        rows = undated(T[child])
        found = [fk for fk in references if fk.child == child and fk.parent in doomed and fk.column in rows.columns]
        # One read of the child: each reference leaves a flag on the row, and the flags together decide what it becomes.
        flagged = rows
        for i, fk in enumerate(found):
            gone = doomed[fk.parent].select(F.col(fk.parent_column).alias(fk.column)).distinct()
            gone = gone.withColumn(f"_gone_{i}", F.lit(True))
            if schemas.schema(child, gen)[fk.column].nullable:
                flagged = look_up(flagged, gone, fk.column)
            else:  # by the key alone, so that a table bucketed by it is not shuffled
                flagged = flagged.join(gone, fk.column, "left")
        said = {action: [i for i, fk in enumerate(found) if fk.on_delete == action] for action in (CASCADE, SET_NULL, RESTRICT)}
        goes = reduce(or_, [F.col(f"_gone_{i}").isNotNull() for i in said[CASCADE]], F.lit(False))
        cleared = {found[i].column: F.when(F.col(f"_gone_{i}").isNull(), F.col(found[i].column)) for i in said[SET_NULL]}
        if said[CASCADE] or cleared:
            after[child] = flagged.filter(~goes).withColumns(cleared).select(*rows.columns)
        if said[CASCADE] and any(fk.parent == child for fk in references):
            doomed[child] = flagged.filter(goes).select(*PRIMARY_KEYS[child])
        if said[RESTRICT]:
            hits = flagged.agg(*[F.count(f"_gone_{i}").alias(f"_{i}") for i in said[RESTRICT]])
            named = [F.struct(F.lit(child).alias("child"), F.lit(found[i].column).alias("column"), F.col(f"_{i}").alias("references")) for i in said[RESTRICT]]
            blocked.append(hits.select(F.inline(F.array(*named))))
    report = T[table].limit(0).select(
        F.lit("").alias("child"), F.lit("").alias("column"), F.lit(0).cast("bigint").alias("references")
    )
    return Deletion(T.replace(**after), union_all([report, *blocked]).filter("references > 0"))


def delete_profiles(T: Tables, keys: DataFrame, gen: int = 2) -> Deletion:
    """Delete profiles with all that hangs on them; an account's primary profile stays."""
    others = T["profiles"].filter("not is_primary").select("profile_id")
    return delete_cascade(T, "profiles", only_keys(keys, others), gen)


def _parents_first(references: Sequence, table: str) -> list[str]:
    """Tables below ``table``, each after all of its parents."""
    below: list[str] = []

    def visit(parent: str) -> None:
        for fk in references:
            if fk.parent == parent and fk.child not in below:
                visit(fk.child)
        if parent != table:
            below.append(parent)

    visit(table)
    return below[::-1]
