"""Write-audit-publish (PUB1) and state as of a request (PUB2)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lodestar.operators import activate as act
from lodestar.operators.checks import check_report, verdict
from lodestar.sources.store import Store
from lodestar.spec import EntitySpec


def publish_checked(
    store: Store,
    name: str,
    df: DataFrame,
    checks: Callable[[DataFrame], list[DataFrame]],
    mode: str = "append",
    metrics: dict[str, Column] | None = None,
    order: list[Column] | tuple = (),
) -> tuple[bool, DataFrame]:
    """PUB1: write the load into uncommitted folders of the table, run the
    checks on exactly those rows, and commit the same files if every check
    counts zero (nothing is written twice).  A rejected load is deleted and
    leaves the table (and the caller's ledger) as it was.

    ``metrics`` ({check: count}) are observed while the rows are written, so
    they cost no pass of their own.  (A task that runs again after a lost executor may
    add to a count, never take away: the verdict stands.)  ``checks`` are for what counts
    cannot tell; only they read the staged files.  Returns (passed, check report)."""
    spark = df.sparkSession
    counts: list[tuple[str, int]] = []
    if metrics:
        seen = Observation()
        names = {f"m{i}": check for i, check in enumerate(metrics)}
        entries, staged = store.stage(name, df, lambda rows: rows.observe(
            seen, *[metrics[check].alias(m) for m, check in names.items()]), order)
        counts = [(check, int(seen.get.get(m) or 0)) for m, check in names.items()]
    else:
        entries, staged = store.stage(name, df, order=order)
    found = [*([spark.createDataFrame(counts, "check STRING, cnt LONG")] if counts else []), *checks(staged)]
    if not found:  # no checks: an empty report, which passes
        found = [spark.createDataFrame([], "check STRING, cnt LONG")]
    report = check_report(found).checkpoint(eager=True)
    ok = verdict(report)
    if ok:
        store.publish(name, entries, mode)
    else:
        store.discard(name, entries)
    return ok, report


def as_of_request(base: DataFrame, inbound: DataFrame, spec: EntitySpec, reqtsn: str,
                  mode: str = "upsert", n: str = "2") -> DataFrame:
    """PUB2: the state of table ``n`` as it was after activating every request up to
    and including ``reqtsn`` (needs the inbound history), for every kind of entity."""
    rows = inbound.where(F.col("reqtsn") <= F.lit(reqtsn))
    if spec.kind == "standard":
        return act.activate_standard(base, rows, spec, mode=mode)
    if n == "5":
        return act.activate_marker(base, rows, spec)
    return act.activate_cube(base, rows, spec) if spec.kind == "cube" else act.activate_movements(base, rows, spec)
