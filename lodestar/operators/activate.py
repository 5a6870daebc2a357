"""Activation: collapse an inbound change table into the active table (ACT1-5).

Plan shape.  The inbound side is first reduced to one row per key
(``reduce_*``: a partial + final aggregate, sort-based for the struct-valued
``max_by`` of standard activation, hash-based for sums), checkpointed, and its
size measured; ``apply_*`` then merges it into the active rows it is given
(the jobs pass only the touched months).  When it fits the
broadcast limit the active table is never shuffled: it is streamed once
against the broadcast delta (anti / left-outer join) and once, key columns
only, for the matched keys (semi join).  Otherwise both sides are
hash-partitioned on the key and joined in one full outer join.  Both paths give
the same rows.

Modes.  Standard activation (``upsert``, default): the latest change of a key
replaces the key's row, a latest ``'D'`` removes it, an unmatched ``'D'`` is
dropped.  ``strict`` reproduces the configured MERGE text as it executes:
matched after-images keep the target (Q2) and an unmatched ``'D'`` row is
inserted (Q3).  Additive merges treat NULL as 0 when another operand has a
value (``null_policy='zero'``); ``'strict'`` propagates NULL (Q5).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lodestar.functions import is_delete, null_safe_add
from lodestar.operators.latest import latest_per_key, sum_per_key, sum_per_stock_key
from lodestar.operators.sizing import fits_broadcast, materialize
from lodestar.spec import EntitySpec

Getter = Callable[[str], Column]
TELLING_ROWS = 10_000


def _q(c: str) -> str:
    return f"`{c}`"


def _typed(df_schema, cols: dict[str, Column], order: list[str]) -> list[Column]:
    return [cols[c].cast(df_schema[c].dataType).alias(c) for c in order]


def _hint(small: bool):
    return F.broadcast if small else (lambda d: d)


def telling_first(delta: DataFrame, keys: list[str]) -> list[str]:
    """The keys, those that tell most rows apart first, as the first ``TELLING_ROWS`` rows of the
    materialized delta show.  Both sides of a merge join are sorted by the keys in this order: a
    sort that starts with a column of few values compares column after column for every row.
    The order of the keys changes no result."""
    if len(keys) < 2:
        return keys
    seen = delta.select(*[F.col(_q(k)) for k in keys]).limit(TELLING_ROWS)
    counts = seen.agg(*[F.approx_count_distinct(_q(k)).alias(f"n{i}") for i, k in enumerate(keys)]).collect()[0]
    return [keys[i] for i in sorted(range(len(keys)), key=lambda i: -counts[i])]


# --------------------------------------------------------------------------- #
# generic keyed merge
# --------------------------------------------------------------------------- #
def merge_keyed(
    active: DataFrame,
    delta: DataFrame,
    keys: list[str],
    on_match: dict[str, Callable[[Getter, Getter], Column]],
    on_insert: dict[str, Callable[[Getter], Column]],
    strategy: str = "auto",
    materialized: bool = False,
) -> DataFrame:
    """MERGE of a delta with one row per key into ``active``.

    Matched rows: columns in ``on_match`` get ``fn(target, source)``, all others
    keep the target.  Unmatched delta rows are inserted with ``on_insert``
    expressions, else the same-named delta column, else NULL.  Unmatched
    target rows stay.  The result has the columns and types of ``active``.  Strategy
    ``in_order`` shuffles as ``shuffle`` does but takes the keys as they stand, for a delta
    that is not materialized."""
    schema = active.schema
    cols = active.columns
    if not materialized:
        delta = materialize(delta)
    if strategy == "auto":
        strategy = "broadcast" if fits_broadcast(delta) else "shuffle"
    src_cols = [c for c in delta.columns if c not in keys]
    s_pref = delta.select(*[F.col(_q(k)) for k in keys], *[F.col(_q(c)).alias(f"_s_{c}") for c in src_cols],
                          F.lit(True).alias("_m"))

    def ins_value(c: str, s: Getter) -> Column:
        if c in on_insert:
            return on_insert[c](s)
        if c in keys or c in src_cols:
            return s(c)
        return F.lit(None)

    if strategy == "broadcast":
        t: Getter = lambda c: F.col(_q(c))
        s: Getter = lambda c: F.col(_q(f"_s_{c}"))
        joined = active.join(F.broadcast(s_pref), keys, "left_outer")
        matched = F.col("_m").isNotNull()
        upd = {}
        for c in cols:
            if c in on_match and c not in keys:
                upd[c] = F.when(matched, on_match[c](t, s)).otherwise(t(c))
            else:
                upd[c] = t(c)
        updated = joined.select(*_typed(schema, upd, cols))
        matched_keys = active.select(*[F.col(_q(k)) for k in keys]).join(
            F.broadcast(delta.select(*keys)), keys, "left_semi")
        # matched keys are a subset of the measured delta keys: bounded
        fresh = delta.join(F.broadcast(matched_keys), keys, "left_anti")
        sd: Getter = lambda c: F.col(_q(c))
        inserted = fresh.select(*_typed(schema, {c: ins_value(c, sd) for c in cols}, cols))
        return updated.unionByName(inserted)

    if strategy not in ("shuffle", "in_order"):
        raise ValueError(f"unknown strategy {strategy!r}")
    t2: Getter = lambda c: F.col(_q(f"_t_{c}"))
    s2: Getter = lambda c: F.col(_q(f"_s_{c}"))
    t_pref = active.select(*[F.col(_q(k)) for k in keys],
                           *[F.col(_q(c)).alias(f"_t_{c}") for c in cols if c not in keys],
                           F.lit(True).alias("_t"))
    j = t_pref.join(s_pref, telling_first(delta, keys) if strategy == "shuffle" else keys, "full_outer")
    has_t, has_s = F.col("_t").isNotNull(), F.col("_m").isNotNull()
    out = {}
    for c in cols:
        if c in keys:
            out[c] = F.col(_q(c))
            continue
        tv = t2(c)
        mv = on_match[c](t2, s2) if c in on_match else tv
        s_get: Getter = lambda x: F.col(_q(x)) if x in keys else s2(x)
        iv = ins_value(c, s_get)
        out[c] = F.when(has_t & has_s, mv).when(has_t, tv).otherwise(iv)
    return j.select(*_typed(schema, out, cols))


# --------------------------------------------------------------------------- #
# ACT1 standard
# --------------------------------------------------------------------------- #
def reduce_standard(inbound: DataFrame, spec: EntitySpec, order: str = "numeric") -> DataFrame:
    """The latest change of every key (AGG1), checkpointed: one row per key."""
    spec.require_keys()
    return materialize(latest_per_key(inbound, list(spec.keys), order))


def apply_standard(
    active: DataFrame,
    latest: DataFrame,
    spec: EntitySpec,
    mode: str = "upsert",
    strategy: str = "auto",
) -> DataFrame:
    """ACT1 given the reduced delta (one row per key, from ``reduce_standard``)."""
    keys = list(spec.keys)
    cols = active.columns
    schema = active.schema
    if strategy == "auto":
        strategy = "broadcast" if fits_broadcast(latest.select(*keys)) else "shuffle"
    hint = _hint(strategy == "broadcast")

    def as_target(df: DataFrame) -> DataFrame:
        vals = {c: (F.lit(None) if c == "recordmode" else F.col(_q(c))) for c in cols}
        return df.select(*_typed(schema, vals, cols))

    if mode == "upsert":
        kept = active.join(hint(latest.select(*keys)), keys, "left_anti").select(*[_q(c) for c in cols])
        return kept.unionByName(as_target(latest.where(~is_delete("recordmode"))))
    if mode == "strict" and strategy != "broadcast":
        # every side moves once: what a key's row becomes follows from which sides hold it
        others = [c for c in latest.columns if c not in keys]
        t = active.select(*[F.col(_q(k)) for k in keys], *[F.col(_q(c)).alias(f"_t_{c}") for c in cols if c not in keys], F.lit(True).alias("_t"))
        s = latest.select(*[F.col(_q(k)) for k in keys], *[F.col(_q(c)).alias(f"_s_{c}") for c in others], F.lit(True).alias("_m"))
        has_t, has_s = F.col("_t").isNotNull(), F.col("_m").isNotNull()
        out = t.join(s, keys, "full_outer").where(~(has_t & has_s & is_delete("_s_recordmode")))
        vals = {c: F.col(_q(c)) if c in keys else F.when(has_t, F.col(_q(f"_t_{c}"))).otherwise(
            (F.lit(None) if c == "recordmode" else F.col(_q(f"_s_{c}"))).cast(schema[c].dataType)) for c in cols}
        return out.select(*_typed(schema, vals, cols))
    if mode == "strict":
        del_keys = latest.where(is_delete("recordmode")).select(*keys)
        kept = active.join(hint(del_keys), keys, "left_anti").select(*[_q(c) for c in cols])
        matched = active.select(*keys).join(hint(latest.select(*keys)), keys, "left_semi")
        fresh = latest.join(hint(matched), keys, "left_anti")
        return kept.unionByName(as_target(fresh))
    raise ValueError(f"unknown mode {mode!r}")


def activate_standard(
    active: DataFrame,
    inbound: DataFrame,
    spec: EntitySpec,
    mode: str = "upsert",
    order: str = "numeric",
    strategy: str = "auto",
) -> DataFrame:
    """ACT1: latest record per key, deletes, replace or insert (see module doc)."""
    return apply_standard(active, reduce_standard(inbound, spec, order), spec, mode, strategy)


# --------------------------------------------------------------------------- #
# ACT2/ACT3 additive (cube, stock movements)
# --------------------------------------------------------------------------- #
def _add(null_policy: str):
    if null_policy == "zero":
        return lambda *xs: null_safe_add(*xs)
    if null_policy == "strict":
        def plain(*xs):
            out = xs[0]
            for x in xs[1:]:
                out = out + x
            return out
        return plain
    raise ValueError(f"unknown null policy {null_policy!r}")


def reduce_cube(inbound: DataFrame, spec: EntitySpec) -> DataFrame:
    """Sums per key (AGG2), checkpointed: one row per key."""
    spec.require_keys()
    return materialize(sum_per_key(inbound, list(spec.keys), list(spec.figures)))


def apply_cube(
    active: DataFrame,
    delta: DataFrame,
    spec: EntitySpec,
    null_policy: str = "zero",
    stamp: dict[str, str] | None = None,
    strategy: str = "auto",
) -> DataFrame:
    """ACT2 given the reduced delta (from ``reduce_cube``)."""
    add = _add(null_policy)
    on_match = {f: (lambda t, s, f=f: add(t(f), s(f))) for f in spec.figures}
    on_insert = {c: (lambda s, v=v: F.lit(v)) for c, v in (stamp or {}).items()}
    return merge_keyed(active, delta, list(spec.keys), on_match, on_insert, strategy, materialized=True)


def activate_cube(
    active: DataFrame,
    inbound: DataFrame,
    spec: EntitySpec,
    null_policy: str = "zero",
    stamp: dict[str, str] | None = None,
    strategy: str = "auto",
) -> DataFrame:
    """ACT2: sum per key; matched -> target + source per figure; else insert.
    ``stamp`` sets constant columns on inserted rows (ACT3: recordtp '2')."""
    return apply_cube(active, reduce_cube(inbound, spec), spec, null_policy, stamp, strategy)


MOVEMENT_STAMP = {"recordtp": "2"}


def activate_movements(active: DataFrame, inbound: DataFrame, spec: EntitySpec, null_policy: str = "zero",
                       strategy: str = "auto") -> DataFrame:
    """ACT3: stock movements into table 2: a cube merge stamping recordtp '2'."""
    return activate_cube(active, inbound, spec, null_policy, MOVEMENT_STAMP, strategy)


def reduce_marker(inbound: DataFrame, spec: EntitySpec) -> DataFrame:
    """Sums per stock key without the day, earliest day kept (AGG3), checkpointed."""
    spec.require_keys()
    return materialize(sum_per_stock_key(inbound, list(spec.keys), list(spec.figures), spec.day_col))


def reduce_stock(inbound: DataFrame, spec: EntitySpec) -> dict[str, DataFrame]:
    """The deltas of both stock tables from one shuffle of the inbound rows, checkpointed:
    ``2`` (AGG2, per key with the day) and ``5`` (AGG3, per stock key, earliest day kept)
    are two grouping sets of one aggregate."""
    spec.require_keys()
    keys, day = list(spec.keys), spec.day_col
    if day not in keys:
        return {"2": reduce_cube(inbound, spec), "5": reduce_marker(inbound, spec)}
    stock = spec.key_spec(drop=day)
    sums = [F.sum(F.col(_q(f))).cast(inbound.schema[f].dataType).alias(f) for f in spec.figures]
    both = materialize(inbound.withColumn("_day", F.col(_q(day)))
                       .groupingSets([[F.col(_q(k)) for k in keys], [F.col(_q(k)) for k in stock]], *[F.col(_q(k)) for k in keys])
                       .agg(F.grouping(day).alias("_no_day"), F.min("_day").alias("_first"), *sums))
    figures = [F.col(_q(f)) for f in spec.figures]
    return {"2": both.where("_no_day = 0").select(*[F.col(_q(k)) for k in keys], *figures),
            "5": both.where("_no_day = 1").select(*[F.col(_q(k)) for k in stock], F.col("_first").alias(day), *figures)}


def apply_marker(
    marker: DataFrame,
    delta: DataFrame,
    spec: EntitySpec,
    null_policy: str = "zero",
    strategy: str = "auto",
) -> DataFrame:
    """ACT4 given the reduced delta (from ``reduce_marker``)."""
    keys = spec.key_spec(drop=spec.day_col)
    add = _add(null_policy)
    on_match = {rec: (lambda t, s, rec=rec, iss=iss: add(t(rec), s(rec), -s(iss))) for rec, iss in spec.stock_pairs}
    on_insert = {"recordtp": lambda s: F.lit("1")}
    return merge_keyed(marker, delta, keys, on_match, on_insert, strategy, materialized=True)


def activate_marker(
    marker: DataFrame,
    inbound: DataFrame,
    spec: EntitySpec,
    null_policy: str = "zero",
    strategy: str = "auto",
) -> DataFrame:
    """ACT4: stock marker (table 5), keyed without the day.

    Matched: receipt += (source receipt - source issue) for each pair; issues,
    day and record type unchanged.  Unmatched: raw sums, earliest day,
    recordtp '1'."""
    return apply_marker(marker, reduce_marker(inbound, spec), spec, null_policy, strategy)


def stock_balance(marker: DataFrame, spec: EntitySpec) -> DataFrame:
    """ACT5: receipts - issues per stock key (invariant under both branches)."""
    keys = spec.key_spec(drop=spec.day_col)
    out = [F.col(_q(k)) for k in keys]
    for rec, iss in spec.stock_pairs:
        typ = marker.schema[rec].dataType
        out.append((F.coalesce(F.col(rec), F.lit(0)) - F.coalesce(F.col(iss), F.lit(0))).cast(typ).alias(f"{rec}_bal"))
    return marker.select(*out)


def activate(kind_spec: EntitySpec, active: DataFrame, inbound: DataFrame, **kw) -> dict[str, DataFrame]:
    """Kind dispatch: standard -> {'2'}, cube -> {'2'}, ncum -> {'2', '5'}.
    Any other kind is a no-op (nothing to activate)."""
    k = kind_spec.kind
    if k == "standard":
        return {"2": activate_standard(active, inbound, kind_spec, **kw)}
    if k == "cube":
        return {"2": activate_cube(active, inbound, kind_spec, **kw)}
    if k == "ncum":
        marker = kw.pop("marker")
        return {
            "2": activate_movements(active, inbound, kind_spec, **kw),
            "5": activate_marker(marker, inbound, kind_spec, **kw),
        }
    return {}
