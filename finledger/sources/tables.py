"""Ledger tables on plain Parquet: batches are appended, nothing stored is ever changed.

Layout of a ledger::

    commits/                                                  the log, see ``commits.py``
    <table>/rows/batch_folder=x/[partition column=v/]key_bucket=b/    the rows of one batch
    <table>/errors/batch=id/                                  rows that cannot be stored

A batch writes the new state of the rows it touches (deleted ones as markers) into a folder of
its own per table, and then one commit that names all of them. Readers take committed folders
only, so a writer that dies leaves no trace, and what is being read is never replaced. The current
row of a key is the one with the highest commit; the children of a parent are those of the last
batch that replaced them. A batch costs what it holds plus the stored buckets of its keys, of which
only folders that may hold one of these keys are opened; ``compact_table`` now and then writes
the current state as one folder, from which readers start.

The bucket hashes the natural key (children: the parent's key). Commits carry the highest
surrogate id ever given, so ids are counted on without a look at the table and never come back.
Writers that touch the same keys, or give ids in the same table, at once are told apart by the log;
the later one starts over.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from finledger.operators.dedup import keep_last
from finledger.operators.mutate import PROVISIONAL, assign_surrogate, merge_upsert
from finledger.schemas import TableSpec
from finledger.session import folder_exists, remove_folder, scratch_path
from finledger.sources.commits import (
    Change,
    Commit,
    bits_meet,
    key_bits,
    read_log,
    transact,
)
from finledger.sources.conform import conform

BUCKET = "key_bucket"
BATCH = "batch_id"
SEQ = "batch_seq"
GONE = "row_gone"
FOLDER = "batch_folder"
BLOCKS = 1024  # ranges of the key's hash whose new ids are counted side by side


def bucket_keys(spec: TableSpec) -> tuple[str, ...]:
    return (spec.parent[0],) if spec.parent else spec.keys


def bucket_of(spec: TableSpec) -> Column:
    return F.pmod(F.xxhash64(*bucket_keys(spec)), F.lit(spec.buckets)).cast("int")


def written_schema(spec: TableSpec) -> T.StructType:
    extra = ((BATCH, T.StringType()), (GONE, T.BooleanType()), (BUCKET, T.IntegerType()))
    return T.StructType([*spec.schema.fields, *[T.StructField(n, t) for n, t in extra]])


def stage(df: DataFrame, purpose: str = "stage") -> tuple[DataFrame, str]:
    """The same rows from a written copy in the shared scratch folder, and that folder, which
    the caller removes when the batch is done."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


@contextmanager
def staged_copies():
    """A ``stage`` whose copies are gone when the block ends, however it does."""
    made: list[tuple[SparkSession, str]] = []

    def keep(df: DataFrame, purpose: str = "stage") -> DataFrame:
        rows, path = stage(df, purpose)
        made.append((df.sparkSession, path))
        return rows

    try:
        yield keep
    finally:
        for spark, path in made:
            remove_folder(spark, path)


# -- commits --------------------------------------------------------------------------------
def ledger_of(path: str) -> tuple[str, str]:
    """The ledger's root and the table's name in it."""
    root, _, name = path.rstrip("/").rpartition("/")
    return root, name


def commits(spark: SparkSession, path: str, at: int | None = None) -> list[Commit]:
    """The table's commits in order, from the last one that holds the whole state."""
    root, name = ledger_of(path)
    log = [c for c in read_log(spark, root, at) if c.table_name == name]
    first = max((i for i, c in enumerate(log) if c.whole), default=0)
    return log[first:]


def _high_id(log: Sequence[Commit]) -> int:
    return max((c.high_id or 0 for c in log), default=0)


def prepare(
    spark: SparkSession, path: str, spec: TableSpec, rows: DataFrame, batch_id: str | None, at: int,
    whole: bool = False, ids_given: bool | None = None,
) -> Change:
    """Writes a batch into a folder of its own; it counts once a commit names it.

    ``rows`` has the table's columns and ``GONE``; ``at`` is the state it was made from.
    """
    folder = uuid.uuid4().hex
    stamps = {BUCKET: bucket_of(spec)}
    if BATCH not in rows.columns:
        stamps[BATCH] = F.lit(batch_id).cast("string")
    folders = [*([spec.partition_by] if spec.partition_by else []), BUCKET]
    # rebalance: about one file per bucket, large buckets split, small ones merged
    (
        conform(rows.withColumns(stamps), written_schema(spec)).hint("rebalance", *folders)
        .write.partitionBy(*folders).parquet(f"{path}/rows/{FOLDER}={folder}")
    )
    written = _read(spark, path, spec, [folder])
    top = F.max(spec.surrogate) if spec.surrogate else F.lit(None).cast("bigint")
    found = written.agg(
        top.alias("top"), F.coalesce(F.count_if(~F.col(GONE)), F.lit(0)).alias("rows"),
        key_bits(bucket_keys(spec)).alias("bits"),
    ).first()
    if ids_given is None:
        ids_given = spec.surrogate is not None
    return Change(
        ledger_of(path)[1], f"{FOLDER}={folder}", whole, ids_given,
        max(_high_id(commits(spark, path, at)), found["top"] or 0), found["rows"],
        None if whole else found["bits"],
    )


def _read(spark: SparkSession, path: str, spec: TableSpec, folders: Sequence[str]) -> DataFrame:
    schema = T.StructType([*written_schema(spec).fields, T.StructField(FOLDER, T.StringType())])
    if not folders:
        # seen to be empty when a plan is made: what is joined with it is neither shuffled nor sorted
        none = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
        return spark.range(1).where(F.lit(False)).select(*none)
    return (
        spark.read.schema(schema).option("basePath", f"{path}/rows")
        .parquet(*[f"{path}/rows/{FOLDER}={f.removeprefix(FOLDER + '=')}" for f in folders])
        .select(*schema.names)
    )


# -- state ----------------------------------------------------------------------------------
def current_rows(
    spark: SparkSession, path: str, spec: TableSpec, buckets: Sequence[int] | None = None,
    partition: str | None = None, bits: str | None = None, at: int | None = None,
) -> DataFrame:
    """The table's rows with batch, commit and bucket, as of commit ``at``.

    Buckets and partition prune the scan; with the bitmap of some keys only folders that may hold one
    of them are opened, so other keys' rows may be missing or stale. Keys are reduced to their
    highest commit first; whole rows meet that short list.
    """
    log = commits(spark, path, at)
    if bits is not None:
        log = [c for c in log if bits_meet(c.key_bits, bits)]
    rows = _read(spark, path, spec, [c.folder for c in log])
    if buckets is not None:
        rows = rows.where(F.col(BUCKET).isin(list(buckets)))
    if partition is not None:
        rows = rows.where(F.col(spec.partition_by) == partition)
    # a literal relation, whose size Spark knows: as many entries as commits since the last compaction
    order = ", ".join(f"('{c.folder.removeprefix(f'{FOLDER}=')}', {c.seq}L)" for c in log)
    order = spark.sql(f"SELECT * FROM VALUES {order or "('', 0L)"} AS t({FOLDER}, {SEQ})")
    rows = rows.join(order, FOLDER)
    if len(log) > 1:  # within one batch a key has one state
        unit = list(bucket_keys(spec))
        newest = rows.groupBy(*unit).agg(F.max(SEQ).alias(SEQ))
        rows = rows.join(newest.hint("merge"), [*unit, SEQ], "left_semi")  # a row per key: not broadcast
    return rows.where(~F.col(GONE)).select(*spec.schema.names, BATCH, SEQ, GONE, BUCKET)


def read_table(
    spark: SparkSession, path: str, spec: TableSpec, stored: bool = False,
    buckets: Sequence[int] | None = None, bits: str | None = None, at: int | None = None,
) -> DataFrame:
    """The table's rows, as of commit ``at`` if given; a table that was never written is empty.
    ``stored`` adds batch and bucket."""
    rows = current_rows(spark, path, spec, buckets, None, bits, at).drop(SEQ, GONE)
    return rows if stored else rows.drop(BATCH, BUCKET)


def never_written(spark: SparkSession, path: str, bits: str, at: int) -> bool:
    """Whether no commit can hold one of the keys of a bitmap."""
    return not any(bits_meet(c.key_bits, bits) for c in commits(spark, path, at))


def read_errors(spark: SparkSession, path: str) -> DataFrame:
    """Rows of all batches that could not be stored, with the reason and their batch."""
    return spark.read.option("basePath", f"{path}/errors").parquet(f"{path}/errors")


def _no_key(spec: TableSpec) -> Column:
    return F.array_contains(F.array(*[F.col(k).isNull() for k in bucket_keys(spec)]), True)


def _set_aside(bad: DataFrame, path: str, batch_id: str) -> int:
    """Rows without a key cannot be found again, so each run would add them anew: they go to the
    errors of their batch, which a repeated batch replaces. Returns how many."""
    folder = f"{path}/errors/batch={batch_id}"
    spark, count = bad.sparkSession, bad.count()
    if count or folder_exists(spark, folder):
        bad.withColumn("error", F.lit("missing_key")).write.mode("overwrite").parquet(folder)
    return count


def touched(df: DataFrame, spec: TableSpec) -> tuple[list[int], str]:
    """Bucket numbers of a batch, at most ``spec.buckets`` integers, and the bitmap of its keys."""
    found = df.agg(
        F.collect_set(BUCKET).alias("buckets"), key_bits(bucket_keys(spec)).alias("bits")
    ).first()
    return sorted(found["buckets"]), found["bits"]


def id_block(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BLOCKS))


def _numbered(fresh: DataFrame, spec: TableSpec, key: str, high: int) -> DataFrame:
    return assign_surrogate(None, fresh, spec.surrogate, key, id_block(key), high)


# -- writing --------------------------------------------------------------------------------
def write_table(df: DataFrame, path: str, spec: TableSpec, batch_id: str | None = None) -> int:
    """Whole rows into the table; they take the place of those with their key (children: of all
    those of their parent). Returns how many."""
    spark, rows = df.sparkSession, conform(df, spec.schema).where(~_no_key(spec))

    def build(at: int) -> tuple[list[Change], int]:
        change = prepare(
            spark, path, spec, rows.withColumn(GONE, F.lit(False)), batch_id, at, ids_given=False
        )
        return [change], change.rows

    return transact(spark, ledger_of(path)[0], batch_id, build)


def prepare_upsert(
    spark: SparkSession, path: str, spec: TableSpec, good: DataFrame, as_of: Column, batch_id: str,
    at: int, place: tuple[list[int], str],
) -> Change:
    """Merges rows, one per key and none without, into the state at ``at``. ``place`` is what
    ``touched`` says of them."""
    buckets, bits = place
    keys = good.select(*spec.keys)
    # keys, stored rows and children grow with the batch: joined by a shuffle, not broadcast
    target = current_rows(spark, path, spec, buckets, bits=bits, at=at).join(
        keys.hint("merge"), list(spec.keys), "left_semi"
    )
    insert_only = []
    if spec.surrogate:
        fresh = keys.join(target.select(*spec.keys).hint("merge"), list(spec.keys), "left_anti")
        ids = _numbered(fresh, spec, spec.keys[0], _high_id(commits(spark, path, at)))
        good = good.join(ids, list(spec.keys), "left")
        insert_only.append(spec.surrogate)
    merged = merge_upsert(
        target.drop(BATCH, SEQ, GONE, BUCKET), good, spec.keys, spec.update_cols, as_of, spec.touch,
        [spec.created, *([spec.touch] if spec.touch else [])], spec.name, insert_only=insert_only,
    )
    return prepare(spark, path, spec, merged.withColumn(GONE, F.lit(False)), batch_id, at)


def upsert_table(
    spark: SparkSession, path: str, spec: TableSpec, batch: DataFrame, as_of: Column,
    batch_id: str, ordinal: Sequence[str] = (),
) -> dict[str, int]:
    """Merge a batch into the table. Returns the rows read, upserted, repeated and in error.

    With an ordinal the last row of a key counts. Rows without a key are set aside.
    """
    with staged_copies() as keep:
        staged = keep(
            batch.select(*spec.keys, *spec.update_cols, *ordinal).withColumn(BUCKET, bucket_of(spec)),
            spec.name,
        )
        good, read = staged.where(~_no_key(spec)), staged.count()
        errors = _set_aside(staged.where(_no_key(spec)).drop(BUCKET, *ordinal), path, batch_id)
        if ordinal:
            good = keep_last(good, spec.keys, ordinal).drop(*ordinal)
        place = touched(good, spec)

        def build(at: int) -> tuple[list[Change], int]:
            if not place[0]:
                return [], 0
            change = prepare_upsert(spark, path, spec, good, as_of, batch_id, at, place)
            return [change], change.rows

        upserted = transact(spark, ledger_of(path)[0], batch_id, build)
    return {"read": read, "upserted": upserted, "repeated": read - errors - upserted, "errors": errors}


def prepare_children(
    spark: SparkSession, path: str, spec: TableSpec, parents: DataFrame, new: DataFrame,
    as_of: Column, batch_id: str, at: int, keep: Callable[..., DataFrame],
) -> Change:
    """Children of the given parents replaced by the new ones.

    A parent without new children is written as a marker, so its old ones no longer count. The
    stored table is not read.
    """
    parent = spec.parent[0]
    parents = parents.select(parent).where(F.col(parent).isNotNull()).distinct()
    staged = keep(
        new.where(F.col(parent).isNotNull())
        .withColumns({spec.created: as_of, "__row": F.monotonically_increasing_id()}), spec.name,
    )
    children = staged.join(parents.hint("merge"), parent, "left_semi")
    if spec.surrogate:
        # numbered by written position in stretches of a million rows: even when one parent
        # owns much of the batch, or when rows are copies of each other
        children = assign_surrogate(
            None, children, spec.surrogate, "__row", F.shiftright("__row", 20),
            _high_id(commits(spark, path, at)),
        )
    rows = conform(children.drop("__row"), spec.schema).withColumn(GONE, F.lit(False))
    childless = parents.join(staged.select(parent).hint("merge"), parent, "left_anti")
    markers = conform(childless, spec.schema).withColumn(GONE, F.lit(True))
    return prepare(spark, path, spec, rows.unionByName(markers), batch_id, at)


def replace_children_table(
    spark: SparkSession, path: str, spec: TableSpec, parents: DataFrame, new: DataFrame,
    as_of: Column, batch_id: str,
) -> int:
    """Children of the given parents replaced by the new ones; returns how many were written."""
    with staged_copies() as keep:
        def build(at: int) -> tuple[list[Change], int]:
            change = prepare_children(spark, path, spec, parents, new, as_of, batch_id, at, keep)
            return [change], change.rows

        return transact(spark, ledger_of(path)[0], batch_id, build)


def reconcile_table(
    spark: SparkSession, path: str, spec: TableSpec, current: DataFrame, as_of: Column,
    batch_id: str, scope: DataFrame | None = None, scope_key: str = "source_account",
) -> dict[str, int]:
    """Same-day rows made equal to the current feed; settled partitions are not read.

    Rows in the feed are updated or inserted; same-day rows of the accounts in ``scope`` (all,
    without one) that are not in the feed any more get a marker.
    """
    with staged_copies() as keep:
        staged = keep(current.select(*spec.keys, *spec.update_cols), spec.name)
        good, read = staged.where(~_no_key(spec)), staged.count()
        errors = _set_aside(staged.where(_no_key(spec)), path, batch_id)
        keys = good.select(*spec.keys)

        def build(at: int) -> tuple[list[Change], tuple[int, int]]:
            target = current_rows(spark, path, spec, partition=PROVISIONAL, at=at).drop(
                BATCH, SEQ, GONE, BUCKET
            )
            fresh = keys.join(target.select(*spec.keys).hint("merge"), list(spec.keys), "left_anti")
            ids = _numbered(fresh, spec, spec.keys[0], _high_id(commits(spark, path, at)))
            merged = merge_upsert(
                target.join(keys, list(spec.keys), "left_semi"), good.join(ids, list(spec.keys), "left"),
                spec.keys, spec.update_cols, as_of, None, [spec.created], spec.name,
                insert_only=[spec.surrogate],
            ).withColumn(GONE, F.lit(False))
            lost = target.join(keys, list(spec.keys), "left_anti")
            if scope is not None:
                lost = lost.join(scope.select(scope_key).distinct(), scope_key, "left_semi")
            lost = conform(lost.drop(spec.surrogate), spec.schema).withColumn(GONE, F.lit(True))
            rows = keep(merged.unionByName(lost), spec.name)
            change = prepare(spark, path, spec, rows, batch_id, at)
            return [change], (change.rows, rows.where(GONE).count())

        upserted, deleted = transact(spark, ledger_of(path)[0], batch_id, build)
    return {"read": read, "upserted": upserted, "deleted": deleted, "errors": errors}


def reset_table(spark: SparkSession, path: str, spec: TableSpec, batch_id: str) -> None:
    """Empties the table. Ids given so far are not given again."""
    none = spark.createDataFrame([], spec.schema).withColumn(GONE, F.lit(False))
    transact(spark, ledger_of(path)[0], batch_id,
             lambda at: ([prepare(spark, path, spec, none, batch_id, at, True)], None))


def compact_table(spark: SparkSession, path: str, spec: TableSpec) -> None:
    """The current state as one new folder, from which reading starts. Rows keep their batch."""
    def build(at: int) -> tuple[list[Change], None]:
        rows = current_rows(spark, path, spec, at=at).drop(SEQ, BUCKET)
        return [prepare(spark, path, spec, rows, "compacted", at, whole=True)], None

    transact(spark, ledger_of(path)[0], "compacted", build)


def vacuum_table(spark: SparkSession, path: str) -> int:
    """Removes the table's folders that no reader starts from any more, those before its last
    whole one, and commits of which nothing is left. Returns how many folders went. Readers that
    began earlier must have ended."""
    root, _ = ledger_of(path)
    log = read_log(spark, root)
    live = {
        (c.table_name, c.folder)
        for name in {c.table_name for c in log} for c in commits(spark, f"{root}/{name}")
    }
    own = [c for c in log if c.table_name == ledger_of(path)[1] and (c.table_name, c.folder) not in live]
    gone = 0
    for old in own:
        if folder_exists(spark, f"{path}/rows/{old.folder}"):
            remove_folder(spark, f"{path}/rows/{old.folder}")
            gone += 1
    for seq in {c.seq for c in log}:
        if not any((c.table_name, c.folder) in live for c in log if c.seq == seq):
            remove_folder(spark, f"{root}/commits/{seq:020d}.json")
    return gone


def merge_into(batch: DataFrame, table: str, spec: TableSpec, as_of: Column) -> None:
    """The same upsert where the catalog supports row-level MERGE."""
    source = batch.alias("s")
    on = [F.expr(f"s.{k} = {table}.{k}") for k in spec.keys]
    condition = on[0]
    for c in on[1:]:
        condition = condition & c
    values = {c: F.col(f"s.{c}") for c in spec.update_cols}
    stamp = {spec.touch: as_of} if spec.touch else {}
    inserted = {**{k: F.col(f"s.{k}") for k in spec.keys}, **values, spec.created: as_of, **stamp}
    (
        source.mergeInto(table, condition)
        .whenMatched().update({**values, **stamp})
        .whenNotMatched().insert(inserted)
        .merge()
    )


def export_tables(
    tables: Mapping[str, DataFrame], out: str, keys: Mapping[str, Sequence[str]] = {},
    limits: Mapping[str, int] = {}, fmt: str = "csv",
) -> tuple[dict[str, str], dict[str, int], dict[str, str]]:
    """One folder per table: (folders, rows left out, failures).

    Tables are exported whole; one with a limit keeps its first rows in key order, and how many
    were left out is returned. A table that fails does not stop the others.
    """
    written, left, failed = {}, {}, {}
    for name, df in tables.items():
        path = f"{out}/{name}"
        try:
            if name in limits:
                left[name] = max(0, df.count() - limits[name])
                df = df.orderBy(*keys[name]).limit(limits[name])
            writer = df.write.mode("overwrite")
            (writer.option("header", "true").csv if fmt == "csv" else writer.parquet)(path)
            written[name] = path
        except Exception as e:  # any failure of one table: the others are exported
            failed[name] = str(e).splitlines()[0]
    return written, left, failed
