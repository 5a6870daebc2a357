"""States at many points from one pass: as of many requests (PUB2), stock by day (ACT5).

``as_of_requests`` gives what ``as_of_request`` gives for each request of a stated list,
without an activation for each.  The base rows and the changes meet in one aggregate per
key; each request has an aggregate of its own in it (the latest change that falls between
it and the request before, or the sums up to it).  So the rows are shuffled once, partly
aggregated before, and a key's versions follow from its one aggregated row.

The stock of a day is the marker's balance less what moved after that day, so a day needs
only the movements that follow it.  A stock key has at most one aggregated row for each
calendar day, which bounds the windows here whatever the number of movements.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.functions import is_delete, null_safe_add, request_key
from lodestar.operators.activate import MOVEMENT_STAMP, stock_balance
from lodestar.spec import EntitySpec


def _q(c: str) -> str:
    return f"`{c}`"


def _until(requests: list[str]) -> Column:
    """The number of the first request that has absorbed a change."""
    slot = F  # the first ``when`` is that of the module
    for i, r in enumerate(requests):
        slot = slot.when(F.col("reqtsn") <= F.lit(r), F.lit(i))
    return slot


def as_of_requests(base: DataFrame, inbound: DataFrame, spec: EntitySpec, requests: list[str],
                   n: str = "2", order: str = "numeric") -> DataFrame:
    """(reqtsn, columns of table ``n``): the table's state after each of ``requests``.

    ``base`` is the state before all changes of ``inbound``, one row per key.  The list
    is stated by the caller; the width of an aggregated row grows with it.  Requests
    may be repeated or unsorted (each counts once) and need not occur in ``inbound``.
    A NULL in a key is a value like any other here; activation refuses it."""
    spec.require_keys()
    requests = sorted(set(requests))
    if not requests:
        raise ValueError("as_of_requests needs a request")
    if spec.kind not in ("standard", "cube", "ncum"):
        raise ValueError(f"entities of kind {spec.kind!r} are not activated")
    changes = inbound.where(F.col("reqtsn") <= F.lit(requests[-1]))
    if spec.kind == "standard":
        return _standard(base, changes, spec, requests, order)
    return _sums(base, changes, spec, requests, marker=spec.kind == "ncum" and n == "5")


def _spread(states: DataFrame, requests: list[str], columns: list[str], keys: list[str]) -> DataFrame:
    """One row for each request and key that has a state ``_s<i>`` then."""
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("reqtsn"), F.col(f"_s{i}").alias("row")) for i, r in enumerate(requests)]))
    out = states.select(*[_q(k) for k in keys], each.alias("_at")).where(F.col("_at.row").isNotNull())
    return out.select(F.col("_at.reqtsn").alias("reqtsn"), *[F.col(_q(c)) if c in keys else F.col(f"_at.row.{_q(c)}").alias(c) for c in columns])


def _standard(base: DataFrame, changes: DataFrame, spec: EntitySpec, requests: list[str], order: str) -> DataFrame:
    keys, columns = list(spec.keys), base.columns
    rest = [c for c in columns if c not in keys]
    kinds = {f.name: f.dataType for f in base.schema.fields}

    def held(df: DataFrame, slot: Column, identity: Column, gone: Column, mode) -> DataFrame:
        values = [(mode(c) if c == "recordmode" else F.col(_q(c))).cast(kinds[c]).alias(c) for c in rest]
        return df.select(*[F.col(_q(k)).cast(kinds[k]).alias(k) for k in keys], slot.cast("int").alias("_slot"),
                         identity.alias("_identity"), F.struct(*values, gone.alias("_gone")).alias("_row"))

    identity = request_key(order)
    new = held(changes, _until(requests), identity, is_delete("recordmode"), lambda c: F.lit(None))
    kind = new.schema["_identity"].dataType
    old = held(base, F.lit(-1), F.lit(None).cast(kind), F.lit(False), lambda c: F.col(c))
    both = new.unionByName(old)
    latest = [F.max_by("_row", F.when(F.col("_slot") == i, F.col("_identity"))).alias(f"_n{i}") for i in range(len(requests))]
    before = F.max_by("_row", F.when(F.col("_slot") == -1, F.lit(1))).alias("_base")
    states = both.groupBy(*[F.col(_q(k)) for k in keys]).agg(before, *latest)
    for i in range(len(requests)):
        states = states.withColumn(f"_v{i}", F.coalesce(f"_n{i}", f"_v{i - 1}" if i else "_base"))
    shown = [F.when(~F.col(f"_v{i}._gone"), F.col(f"_v{i}")).alias(f"_s{i}") for i in range(len(requests))]
    return _spread(states.select(*[_q(k) for k in keys], *shown), requests, columns, keys)


def _sums(base: DataFrame, changes: DataFrame, spec: EntitySpec, requests: list[str], marker: bool) -> DataFrame:
    day = spec.day_col
    keys = spec.key_spec(drop=day) if marker else list(spec.keys)
    columns, kinds = base.columns, {f.name: f.dataType for f in base.schema.fields}
    rest = [c for c in columns if c not in keys]
    figures = list(spec.figures)
    issue = dict(spec.stock_pairs)
    stamp = {"recordtp": "1"} if marker else MOVEMENT_STAMP if spec.kind == "ncum" else {}
    taken = [*figures, *([day] if marker else [])]
    new = changes.select(*[F.col(_q(k)).cast(kinds[k]).alias(k) for k in keys], _until(requests).cast("int").alias("_slot"),
                         *[F.col(_q(c)).alias(f"_d_{c}") for c in taken])
    old = base.select(*[F.col(_q(k)) for k in keys], F.lit(-1).alias("_slot"), F.struct(*[F.col(_q(c)) for c in rest]).alias("_row"))
    both = new.unionByName(old, allowMissingColumns=True)
    aggs = [F.max_by("_row", F.when(F.col("_slot") == -1, F.lit(1))).alias("_base")]
    for i in range(len(requests)):
        seen = F.col("_slot").between(0, i)
        aggs.append(F.count_if(seen).alias(f"_c{i}"))
        aggs += [F.sum(F.when(seen, F.col(f"_d_{f}"))).cast(kinds[f]).alias(f"_{i}_{f}") for f in figures]
        if marker:
            aggs.append(F.min(F.when(seen, F.col(f"_d_{day}"))).alias(f"_{i}_{day}"))
    states = both.groupBy(*[F.col(_q(k)) for k in keys]).agg(*aggs)

    def value(i: int, c: str) -> Column:
        was, moved = F.col(f"_base.{_q(c)}"), F.col(f"_{i}_{c}") if c in taken else F.lit(stamp.get(c))
        if c not in figures or marker and c not in issue:
            matched = was
        elif marker:
            matched = null_safe_add(was, moved, -F.col(f"_{i}_{issue[c]}"))
        else:
            matched = null_safe_add(was, moved)
        return F.when(F.col("_base").isNotNull(), matched).otherwise(moved).cast(kinds[c]).alias(c)

    shown = [F.when(F.col("_base").isNotNull() | (F.col(f"_c{i}") > 0), F.struct(*[value(i, c) for c in rest])).alias(f"_s{i}")
             for i in range(len(requests))]
    return _spread(states.select(*[_q(k) for k in keys], *shown), requests, columns, keys)


def _moved(movements: DataFrame, spec: EntitySpec) -> list[Column]:
    """Receipts less issues of a movement, for each pair; a NULL counts as 0."""
    return [(F.coalesce(F.col(_q(rec)), F.lit(0)) - F.coalesce(F.col(_q(iss)), F.lit(0))).alias(f"_{rec}")
            for rec, iss in spec.stock_pairs]


def stock_by_day(movements: DataFrame, marker: DataFrame, spec: EntitySpec) -> DataFrame:
    """ACT5: the stock of every stock key at the end of each day it moved on.

    The marker's balance is the stock after all ``movements``; a key without a marker
    starts from what its movements add up to 0 from (balance = their sum)."""
    keys, day = spec.key_spec(drop=spec.day_col), spec.day_col
    receipts = [rec for rec, _ in spec.stock_pairs]
    daily = movements.select(*[F.col(_q(k)) for k in keys], F.col(_q(day)), *_moved(movements, spec)).groupBy(
        *[F.col(_q(k)) for k in keys], F.col(_q(day))).agg(*[F.sum(f"_{r}").alias(f"_{r}") for r in receipts])
    own = Window.partitionBy(*[F.col(_q(k)) for k in keys])
    later = own.orderBy(F.col(_q(day)).asc_nulls_first()).rowsBetween(1, Window.unboundedFollowing)
    sums = daily.select(*[F.col(_q(k)) for k in keys], F.col(_q(day)),
                        *[F.coalesce(F.sum(f"_{r}").over(later), F.lit(0)).alias(f"_after_{r}") for r in receipts],
                        *[F.sum(f"_{r}").over(own).alias(f"_all_{r}") for r in receipts])
    return _less_later(sums, marker, spec, [day])


def stock_on_days(movements: DataFrame, marker: DataFrame, spec: EntitySpec, days: list[datetime.date]) -> DataFrame:
    """ACT5: the stock of every stock key at the end of each of the stated ``days``, whether
    it moved then or not.  One aggregate of the movements after the earliest day."""
    keys, day = spec.key_spec(drop=spec.day_col), spec.day_col
    receipts = [rec for rec, _ in spec.stock_pairs]
    days = sorted(set(days))
    if not days:
        raise ValueError("stock_on_days needs a day")
    rows = movements.select(*[F.col(_q(k)) for k in keys], F.col(_q(day)), *_moved(movements, spec))
    later = [F.struct(F.lit(d).alias(day), *[F.coalesce(F.sum(F.when(F.col(_q(day)) > F.lit(d), F.col(f"_{r}"))), F.lit(0)).alias(f"_after_{r}")
                                             for r in receipts]) for d in days]
    sums = rows.groupBy(*[F.col(_q(k)) for k in keys]).agg(
        F.array(*later).alias("_days"), *[F.sum(f"_{r}").alias(f"_all_{r}") for r in receipts])
    # a key that never moved has its marker's balance on every day
    still = F.array(*[F.struct(F.lit(d).alias(day), *[F.lit(0).alias(f"_after_{r}") for r in receipts]) for d in days])
    return _less_later(sums, marker, spec, [day], still)


def _less_later(sums: DataFrame, marker: DataFrame, spec: EntitySpec, days: list[str], still: Column | None = None) -> DataFrame:
    keys = spec.key_spec(drop=spec.day_col)
    receipts = [rec for rec, _ in spec.stock_pairs]
    held = stock_balance(marker, spec).withColumnsRenamed({k: f"_m_{k}" for k in keys})
    same = [F.col(_q(k)).eqNullSafe(F.col(f"_m_{k}")) for k in keys]
    joined = sums.join(held, same, "left" if still is None else "full")
    named = [F.coalesce(F.col(_q(k)), F.col(f"_m_{k}")).alias(k) for k in keys]
    if still is not None:
        kind = sums.schema["_days"].dataType
        joined = joined.select(*named, *[f"{r}_bal" for r in receipts], *[f"_all_{r}" for r in receipts],
                               F.inline(F.coalesce("_days", still.cast(kind))))
        named = [F.col(_q(k)) for k in keys]
    out = [(F.coalesce(F.col(f"{r}_bal"), F.col(f"_all_{r}")) - F.col(f"_after_{r}")).cast(marker.schema[r].dataType).alias(f"{r}_stock")
           for r in receipts]
    return joined.select(*named, *[F.col(_q(d)) for d in days], *out)
