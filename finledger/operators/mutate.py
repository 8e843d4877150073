"""Table mutation as DataFrame algebra: old rows and a batch in, new rows out.

Every function is idempotent: applying the same batch twice gives the same table.
``finledger.sources.tables`` writes the results.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finledger.operators.ranking import running_total
from finledger.sources.conform import conform, require_columns

PROVISIONAL = "dia"


def merge_upsert(
    target: DataFrame, source: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
    as_of: Column, touch: str | None = None, stamps: Sequence[str] = (),
    context: str = "merge_upsert", flag: str | None = None, insert_only: Sequence[str] = (),
) -> DataFrame:
    """Matched rows take the batch's ``update_cols`` (NULLs too), new keys are inserted.

    ``stamps`` (and ``touch``) are set to ``as_of`` on insert, ``touch`` on update as well;
    all other target columns keep their value. The batch must hold one row per key
    (``keep_last`` first). One full outer join on the keys: each side is read and
    shuffled once. ``flag`` names an extra column telling rows that are in the batch;
    ``insert_only`` columns come from the batch for new keys and never change afterwards.
    """
    keys, update_cols = list(keys), list(update_cols)
    require_columns(source, [*keys, *update_cols], context)
    new = source.selectExpr(
        *keys, *[f"`{c}` AS `__new_{c}`" for c in [*update_cols, *insert_only]], "true AS __hit"
    )
    both = target.withColumn("__old", F.lit(True)).join(new, keys, "full_outer")
    both = both.withColumn("__as_of", as_of)
    out = []
    for field in target.schema:
        c, kind = f"`{field.name}`", field.dataType.simpleString()
        if field.name in update_cols:
            c = f"if(__hit IS NOT NULL, CAST(`__new_{field.name}` AS {kind}), {c})"
        elif field.name in insert_only:
            c = f"if(__old IS NULL, CAST(`__new_{field.name}` AS {kind}), {c})"
        elif field.name == touch:
            c = f"if(__hit IS NOT NULL, __as_of, {c})"
        elif field.name in stamps:
            c = f"if(__old IS NULL, __as_of, {c})"
        out.append(f"{c} AS `{field.name}`")
    if flag:
        out.append(f"__hit IS NOT NULL AS {flag}")
    return both.selectExpr(*out)


def skip_unchanged(source: DataFrame, target: DataFrame, key: str, version: str) -> DataFrame:
    """Batch rows whose stored version is not exactly the same.

    Newer *and* older versions pass (deliveries may arrive out of order); a NULL
    version never matches, so it always passes. Reads two columns of the target.
    """
    return source.join(target.select(key, version).hint("merge"), [key, version], "left_anti")


def replace_children(
    old: DataFrame, touched_parents: DataFrame, new: DataFrame, parent_key: str
) -> DataFrame:
    """Children of touched parents replaced as a whole; all others stay.

    A touched parent without new children ends up with none.
    """
    touched = touched_parents.select(parent_key).distinct()
    kept = old.join(touched, parent_key, "left_anti")
    return kept.unionByName(conform(new, old.schema))


def reconcile_snapshot(
    target: DataFrame, current: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
    as_of: Column, stamps: Sequence[str] = (), scope: DataFrame | None = None,
    scope_key: str = "source_account", source_col: str = "movement_source",
) -> DataFrame:
    """Same-day rows made equal to the current feed; settled rows untouched.

    Rows still in the feed are updated in place, new ones inserted, and those gone from
    it deleted. ``scope`` lists the accounts whose feed was fetched: rows of other
    accounts are kept, so a failed request deletes nothing. Without a scope the feed
    counts as complete. Keys of same-day and settled rows never coincide.
    """
    return target.where(~provisional_rows(source_col)).unionByName(
        reconcile_provisional(
            target.where(provisional_rows(source_col)), current, keys, update_cols, as_of,
            stamps, scope, scope_key,
        )
    )


def provisional_rows(source_col: str = "movement_source") -> Column:
    return F.col(source_col).eqNullSafe(F.lit(PROVISIONAL))


def reconcile_provisional(
    provisional: DataFrame, current: DataFrame, keys: Sequence[str], update_cols: Sequence[str],
    as_of: Column, stamps: Sequence[str] = (), scope: DataFrame | None = None,
    scope_key: str = "source_account", insert_only: Sequence[str] = (),
) -> DataFrame:
    """The same-day part alone, for tables that keep it in a partition of its own."""
    merged = merge_upsert(provisional, current, keys, update_cols, as_of, None, stamps,
                          "reconcile_snapshot", flag="__current", insert_only=insert_only)
    if scope is None:
        return merged.where("__current").drop("__current")
    fetched = scope.select(scope_key).distinct().withColumn("__fetched", F.lit(True))
    return (
        merged.join(fetched, scope_key, "left")
        .where(F.col("__current") | F.col("__fetched").isNull())
        .select(*provisional.columns)
    )


def backfill_null(df: DataFrame, col: str, value) -> DataFrame:
    return df.fillna({col: value})


def evolve(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows of an older layout under a wider schema: new columns NULL, values unchanged."""
    lost = [c for c in df.columns if c not in schema.names]
    if lost:
        raise ValueError(f"evolve only adds columns, would drop {lost}")
    return conform(df, schema)


def assign_surrogate(
    target: DataFrame | None, inserts: DataFrame, id_col: str, order: str, block: Column,
    high: int | None = None,
) -> DataFrame:
    """New ids for inserted rows, counting on from ``high``, the highest id ever given.

    Without it the highest id in ``target`` is taken, which gives the id of a deleted top row
    again: a stored table must pass its mark. Stored ids never change. ``block`` cuts the rows into
    ranges that are numbered side by side, in the given order inside.
    """
    ranked = running_total(inserts, F.lit(1).cast("bigint"), [order], block, "__before")
    top = F.lit(high) if high is not None else target.agg(F.coalesce(F.max(id_col), F.lit(0))).scalar()
    return ranked.withColumn(id_col, top + F.col("__before") + 1).select(
        id_col, *[c for c in inserts.columns if c != id_col]
    )


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key is not stored yet are added; stored rows are left alone."""
    fresh = source.join(target.select(*keys), list(keys), "left_anti")
    return target.unionByName(conform(fresh, target.schema))


def reset_tables(tables: Mapping[str, DataFrame], control: DataFrame, as_of: Column) -> tuple[
    dict[str, DataFrame], DataFrame
]:
    """Empty data tables with their schemas, and the control rows set back to "never ran"."""
    empty = {name: df.limit(0) for name, df in tables.items()}
    keep = ("process_name", "source_system")
    cleared = control.select(
        *[
            F.col(f.name) if f.name in keep
            else (as_of if f.name == "updated_at" else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in control.schema
        ]
    )
    return empty, cleared
