"""An audit that goes on: violations kept per rule and brought up to date from the keys that
commits have touched, instead of a scan of all tables.

Two small tables of the ledger hold it, written in one commit. ``audit_totals`` has a row per rule:
its violations, the commit they hold for and the commit they were last counted whole for.
``audit_values`` has, for unique keys that the table is not divided by (a transaction number of transfers
stored by id), how many rows hold each value.

An update looks at the units (keys, for children parents) in the folders committed since. Rows of
these units before and after tell by how much a rule within a unit has changed; a foreign key is
looked up for the children and the parents touched; of the other unique keys the values that came or went
are looked up in ``audit_values``. Lookups open only the buckets and folders that may hold such keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from finledger.operators.audit import audit_constraints, orphans
from finledger.schemas import AUDIT_TOTALS, AUDIT_VALUES, TableSpec
from finledger.session import folder_exists
from finledger.sources.commits import Change, Commit, read_log, transact
from finledger.sources.tables import (
    BUCKET,
    GONE,
    _read,
    bucket_keys,
    bucket_of,
    commits,
    current_rows,
    prepare,
    read_table,
    staged_copies,
    touched,
)

RULE = ["table_name", "rule", "columns"]


@dataclass(frozen=True)
class _Since:
    """What has happened to a table: its state before the changes is that of commit ``before``."""

    before: int
    folders: tuple[str, ...]


def _scattered(spec: TableSpec) -> list[tuple[str, ...]]:
    """Unique keys whose equal values may lie in several units."""
    unit = set(bucket_keys(spec))
    return [k for k in ((spec.keys,) if spec.keys else ()) + spec.unique if not unit <= set(k)]


def _rule_name(spec: TableSpec, keys: Sequence[str]) -> Column:
    return F.lit(f"{spec.name}:{','.join(keys)}")


def _values(rows: DataFrame, spec: TableSpec, keys: Sequence[str]) -> DataFrame:
    """Rows per fully present value of a unique key."""
    present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    value = F.to_json(F.struct(*keys)).alias("value")
    return rows.where(present).groupBy(_rule_name(spec, keys).alias("rule"), value).agg(
        F.count(F.lit(1)).alias("n")
    )



def _changes(
    spark: SparkSession, root: str, specs: Mapping[str, TableSpec], since: int, at: int
) -> dict[str, _Since] | None:
    """The folders committed since, per table; None where they do not tell all: a table was
    emptied, or what is needed has been vacuumed."""
    log = [c for c in read_log(spark, root, at) if c.seq > since]
    if {c.seq for c in log} != set(range(since + 1, at + 1)):
        return None
    found = {}
    for name in specs:
        own: list[Commit] = [
            c for c in log if c.table_name == name and not (c.whole and c.batch_id == "compacted")
        ]
        if any(c.whole for c in own):
            return None
        before = own[0].seq - 1 if own else at
        needed = [*own, *commits(spark, f"{root}/{name}", before)]
        if not all(folder_exists(spark, f"{root}/{name}/rows/{c.folder}") for c in needed):
            return None
        found[name] = _Since(before, tuple(c.folder for c in own))
    return found


def _rows_of(
    spark: SparkSession, root: str, spec: TableSpec, units: DataFrame, at: int
) -> DataFrame:
    """The table's rows of these units as of a commit."""
    unit = list(bucket_keys(spec))
    buckets, bits = touched(units.withColumn(BUCKET, bucket_of(spec)), spec)
    rows = current_rows(spark, f"{root}/{spec.name}", spec, buckets, bits=bits, at=at)
    return rows.join(units.select(*unit), unit, "left_semi")


def _signed(after: DataFrame, before: DataFrame, column: str) -> DataFrame:
    return after.unionByName(before.withColumn(column, -F.col(column)))


def _differences(
    spark: SparkSession, root: str, specs: Mapping[str, TableSpec], changes: Mapping[str, _Since],
    at: int, keep,
) -> tuple[list[DataFrame], list[DataFrame]]:
    """Changes of the totals and of the stored values."""
    totals, values, units = [], [], {}
    for name, change in changes.items():
        if not change.folders:
            continue
        spec = specs[name]
        path, unit = f"{root}/{name}", bucket_keys(spec)
        units[name] = keep(_read(spark, path, spec, change.folders).select(*unit).distinct(), "audit")
        after = keep(_rows_of(spark, root, spec, units[name], at), "audit")
        before = keep(_rows_of(spark, root, spec, units[name], change.before), "audit")
        scattered = _scattered(spec)
        inside = replace(
            spec, parent=None, keys=() if spec.keys in scattered else spec.keys,
            unique=tuple(k for k in spec.unique if k not in scattered),
        )
        if inside.keys or inside.unique or inside.not_null:
            one, other = (audit_constraints({name: rows}, {name: inside}) for rows in (after, before))
            totals.append(_signed(one, other, "violations"))
        for keys in scattered:
            moved = _signed(_values(after, spec, keys), _values(before, spec, keys), "n")
            moved = moved.groupBy("rule", "value").agg(F.sum("n").alias("step")).where("step <> 0")
            moved = keep(moved, "audit")
            held = _rows_of(spark, root, AUDIT_VALUES, moved, at).select("rule", "value", "n")
            moved = moved.join(held, ["rule", "value"], "left").fillna({"n": 0})
            values.append(moved.select("rule", "value", (F.col("n") + F.col("step")).alias("n")))
            beyond = "greatest(n + step - 1, 0) - greatest(n - 1, 0)"
            totals.append(moved.agg(F.coalesce(F.expr(f"sum({beyond})"), F.lit(0)).alias("violations")).select(
                F.lit(name).alias("table_name"), F.lit("unique").alias("rule"),
                F.lit(",".join(keys)).alias("columns"), "violations",
            ))
    for name, spec in specs.items():
        if not spec.parent or spec.parent[1] not in specs:
            continue
        fk, parent, pk = spec.parent
        met = [units[n].select(F.col(k).alias(fk)) for n, k in ((name, fk), (parent, pk)) if n in units]
        if not met:
            continue
        met = reduce(DataFrame.union, met).where(F.col(fk).isNotNull()).distinct()
        own = met.select(F.col(fk).cast(spec.schema[fk].dataType))
        above = met.select(F.col(fk).cast(specs[parent].schema[pk].dataType).alias(pk))
        counts = [
            orphans(
                _rows_of(spark, root, spec, own, when[name]), fk,
                _rows_of(spark, root, specs[parent], above, when[parent]), pk,
            )
            for when in ({name: at, parent: at}, {n: changes[n].before for n in (name, parent)})
        ]
        totals.append(_signed(*counts, "violations").select(
            F.lit(name).alias("table_name"), F.lit("foreign_key").alias("rule"),
            F.lit(fk).alias("columns"), "violations",
        ))
    return totals, values


def update_audit(
    spark: SparkSession, root: str, specs: Mapping[str, TableSpec], batch_id: str = "audit"
) -> DataFrame:
    """Brings the ledger's audit up to its last commit and returns it: a row per rule as in
    ``audit_constraints``, with ``audited`` (the commit it holds for) and ``counted`` (the commit it was
    last counted whole for).

    The first run counts whole, and so does one after a table was reset, one that finds vacuumed what it
    would have to compare, and one for other tables or rules than before. Parents must be stored by the column
    their children name. Nothing committed since: nothing is written.
    """
    for spec in specs.values():
        if spec.parent and spec.parent[1] in specs:
            parent = specs[spec.parent[1]]
            if bucket_keys(parent) != (spec.parent[2],):
                raise ValueError(f"{parent.name} is not stored by {spec.parent[2]}")
    places = {s.name: f"{root}/{s.name}" for s in (AUDIT_TOTALS, AUDIT_VALUES)}

    def build(at: int) -> tuple[list[Change], None]:
        old = read_table(spark, places["audit_totals"], AUDIT_TOTALS, at=at)
        states = {(r["audited"], r["counted"]) for r in old.select("audited", "counted").distinct().collect()}
        since, counted = states.pop() if len(states) == 1 else (None, None)
        none = {n: spark.createDataFrame([], s.schema) for n, s in specs.items()}
        rules = audit_constraints(none, specs).select(*RULE)
        same = since is not None and rules.exceptAll(old.select(*RULE)).unionByName(
            old.select(*RULE).exceptAll(rules)).isEmpty()
        changes = _changes(spark, root, specs, since, at) if same else None
        if changes is not None and not any(c.folders for c in changes.values()):
            return [], None
        if changes is None:
            tables = {n: read_table(spark, f"{root}/{n}", s, at=at) for n, s in specs.items()}
            totals, counted = [audit_constraints(tables, specs)], at
            values = [_values(tables[n], s, k) for n, s in specs.items() for k in _scattered(s)]
        else:
            totals, values = _differences(spark, root, specs, changes, at, keep)
            totals.append(old.select(*RULE, "violations"))
        totals = reduce(DataFrame.unionByName, totals).groupBy(*RULE).agg(F.sum("violations").alias("violations"))
        totals = totals.withColumns({
            "audited": F.lit(at).cast("bigint"), "counted": F.lit(counted).cast("bigint"),
            GONE: F.lit(False),
        })
        made = [prepare(spark, places["audit_totals"], AUDIT_TOTALS, totals, batch_id, at,
                        whole=True, ids_given=False)]
        if values:
            values = reduce(DataFrame.unionByName, values).withColumn(GONE, F.col("n") == 0)
            made.append(prepare(spark, places["audit_values"], AUDIT_VALUES, values, batch_id, at,
                                whole=changes is None, ids_given=False))
        return made, None

    with staged_copies() as keep:
        transact(spark, root, batch_id, build)
    return read_table(spark, places["audit_totals"], AUDIT_TOTALS)
