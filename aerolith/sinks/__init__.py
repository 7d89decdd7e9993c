"""Writers: partitioned / full overwrite, versioned swap, epoch-appended store, publish.

Files are sized by an AQE ``REBALANCE`` (split skewed partitions, coalesce
small ones) rather than ``repartition(col)`` / ``coalesce(n)``: a date holding
a third of the rows is spread over many tasks and files, and upstream stages
keep their parallelism. Rows that still lie as their input files do
(``in_place``) are written by the tasks that hold them.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from aerolith.functions.constants import TTL_HOURS
from aerolith.operators.dedup import latest_per_key


def _aqe_on(df: DataFrame) -> bool:
    return str(df.sparkSession.conf.get("spark.sql.adaptive.enabled", "true")).lower() == "true"


def rebalanced(df: DataFrame, cols: Sequence[str] = ()) -> DataFrame:
    """AQE ``REBALANCE`` when adaptive execution is on. Streaming micro-batches
    (e.g. inside ``foreachBatch``) run with AQE off, where the hint would be
    ignored: there, hash-partition by the partition columns so each batch
    writes one file per partition value instead of one per shuffle task."""
    if _aqe_on(df):
        return df.hint("rebalance", *cols) if cols else df.hint("rebalance")
    return df.repartition(*cols) if cols else df


def write_partitioned(
    df: DataFrame,
    path: str,
    partition_cols: Sequence[str] = ("reading_date",),
    mode: str = "overwrite",
    replace: str = "all",
    in_place: bool = False,
) -> None:
    """Partitioned Parquet write. ``replace="all"`` overwrites the whole table,
    so a full reload leaves no partition of an earlier run behind;
    ``"touched"`` replaces only the partitions present in ``df`` (incremental
    loads). The choice is made per write, whatever the session's setting.
    ``in_place``: ``df`` comes, without a shuffle since, from files of the same
    partitions, so that a task holds few of them."""
    overwrite = {"all": "static", "touched": "dynamic"}[replace]
    writer = (df if in_place else rebalanced(df, partition_cols)).write.mode(mode).option("partitionOverwriteMode", overwrite)
    writer.partitionBy(*partition_cols).parquet(path)


def write_table(df: DataFrame, path: str, mode: str = "overwrite", in_place: bool = False) -> None:
    """Unpartitioned Parquet write (dimensions, small facts; ``in_place``: facts as large as the files they come from)."""
    (df if in_place else rebalanced(df)).write.mode(mode).parquet(path)


def write_observed(df: DataFrame, path: str, partition_cols: Sequence[str] = (), name: str = "rows") -> int:
    """Write and return the row count from the same pass (no second action)."""
    obs = Observation(name)
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    if partition_cols:
        write_partitioned(observed, path, partition_cols)
    else:
        write_table(observed, path)
    return int(obs.get["rows"])


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet under the shared scratch folder and return a
    scan of it: later consumers (dimensions, facts) read the written table with
    column pruning instead of re-running its lineage, and a lost executor
    re-reads files rather than recomputing the stage chain. ``saved_path`` of
    the scan says where it lies."""
    from aerolith.session import scratch_path

    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.parquet(path)
    out.saved_path = path
    return out


def write_bucketed(df: DataFrame, table: str, path: str, buckets: int, columns: Sequence[str], sort: Sequence[str] = ()) -> DataFrame:
    """Catalog table (files at ``path``) cut into ``buckets`` by a hash of ``columns``, sorted within.

    Windows, aggregates and joins on those columns, or on more columns that
    include them, then need no exchange. Rows are dealt to their buckets once,
    before the write, so there is one file a bucket. A key's rows share one
    bucket: for keys of many moderate groups, not for one that holds a third.
    """
    dealt = df.repartition(buckets, *columns)
    writer = dealt.write.format("parquet").mode("overwrite").option("path", path)
    writer.bucketBy(buckets, *columns).sortBy(*(sort or columns)).saveAsTable(table)
    return df.sparkSession.table(table)


# --- versioned tables (read-modify-write without deleting the input) --------------------


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def delete_path(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate files that no one reads any more."""
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def versions(spark: SparkSession, base: str) -> list[int]:
    """Committed versions (``v=N`` dirs holding a ``_SUCCESS`` marker), ascending."""
    fs, p = _fs(spark, base)
    if not fs.exists(p):
        return []
    out = []
    for st in fs.listStatus(p):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith("v="):
            if fs.exists(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
                out.append(int(name[2:]))
    return sorted(out)


def table_exists(spark: SparkSession, base: str) -> bool:
    """True when the versioned table has a committed version. Errors other
    than 'not found' propagate (never mistaken for a first load)."""
    return bool(versions(spark, base))


def read_latest(spark: SparkSession, base: str) -> DataFrame:
    vs = versions(spark, base)
    if not vs:
        raise FileNotFoundError(f"no committed version under {base}")
    return spark.read.parquet(f"{base.rstrip('/')}/v={vs[-1]}")


def write_version(df: DataFrame, base: str) -> str:
    """Write ``df`` as the next version; earlier versions stay readable, so a
    ``df`` computed from the current version never loses its input."""
    spark = df.sparkSession
    vs = versions(spark, base)
    path = f"{base.rstrip('/')}/v={(vs[-1] + 1) if vs else 1}"
    write_table(df, path)
    return path


def checkpoint_id(spark: SparkSession, checkpoint: str) -> str:
    """Id of the streaming query that a checkpoint folder belongs to (the same after every restart)."""
    text = spark.read.text(f"{checkpoint.rstrip('/')}/metadata").agg(F.max("value")).first()[0]
    return json.loads(text)["id"]


def claim(spark: SparkSession, path: str, owner: str) -> None:
    """Record ``owner`` as the only writer of a store; fails if it belongs to another.

    Epoch numbers start at zero with every new checkpoint, so a second
    checkpoint on one store would replace the epochs of the first.
    """
    fs, root = _fs(spark, path)
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    held = [f.getPath().getName().removeprefix("_owner-") for f in (fs.listStatus(root) if fs.exists(root) else []) if f.getPath().getName().startswith("_owner-")]
    if not held:
        fs.create(hadoop_path(root, f"_owner-{owner}"), True).close()  # readers skip names with an underscore
    elif held != [owner]:
        raise RuntimeError(f"{path} is written by the streaming query {held[0]}; give {owner} a store of its own")


# --- epoch-appended store (hot path) ----------------------------------------------

EPOCH = "epoch"


def with_ttl(df: DataFrame, hours: int = TTL_HOURS) -> DataFrame:
    """``updated_at`` = now, ``ttl`` = epoch seconds of now + ``hours``."""
    now = F.current_timestamp()
    return df.withColumns(
        {"updated_at": now, "ttl": F.unix_seconds(now) + F.lit(hours * 3600)}
    )


def append_epoch(batch: DataFrame, path: str, epoch: int, keys: Sequence[str], partition_col: str, spread: int = 16) -> None:
    """Write a micro-batch's changed rows under ``partition_col`` and, below it, ``epoch=<id>``.

    Nothing written before is read, changed or deleted, so a crash loses no
    row; the retry of an epoch replaces its own folders only. Rows of one
    partition value (the hour all sensors report in) are spread over
    ``spread`` tasks by a hash of the key.
    """
    lot = F.pmod(F.xxhash64(*keys), F.lit(spread))
    tasks = int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = batch.withColumn(EPOCH, F.lit(f"{epoch:012d}")).repartition(tasks, F.col(partition_col), lot)
    writer = dealt.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(partition_col, EPOCH).parquet(path)


def read_store(spark: SparkSession, path: str, keys: Sequence[str], where: Column | None = None, live_at=None) -> DataFrame:
    """The latest row of each key. ``where`` (on the partition columns) prunes the
    scan before the rows are compared; ``live_at`` (a time, or ``"now"``) leaves
    out rows past their time-to-live."""
    rows = spark.read.parquet(path)
    if where is not None:
        rows = rows.where(where)
    latest = latest_per_key(rows, list(keys), [EPOCH, "updated_at"])
    return latest if live_at is None else live_rows(latest, None if live_at == "now" else live_at)


def compact_store(spark: SparkSession, path: str, target: str, keys: Sequence[str], partition_col: str, as_of=None) -> None:
    """A copy of the store in a new place: one epoch (the newest) with the latest, unexpired row of each key.

    The old store stays as it is until its readers and its writer moved on.
    """
    rows = spark.read.parquet(path)
    newest = rows.agg(F.max(EPOCH)).first()[0]
    live = read_store(spark, path, keys, live_at=as_of or "now").drop(EPOCH)
    append_epoch(live, target, int(newest or 0), keys, partition_col)


def partition_values(spark: SparkSession, path: str, partition_col: str) -> list[str]:
    """Values of a table's outer partition column, from its folder names: no file is opened."""
    fs, root = _fs(spark, path)
    names = [st.getPath().getName() for st in (fs.listStatus(root) if fs.exists(root) else []) if st.isDirectory()]
    return sorted(n.split("=", 1)[1] for n in names if n.startswith(f"{partition_col}="))


def expire_partitions(spark: SparkSession, path: str, partition_col: str, before: str) -> list[str]:
    """Delete whole partition values before ``before``, with all their epochs; returns them."""
    fs, root = _fs(spark, path)
    gone = [v for v in partition_values(spark, path, partition_col) if v < before]
    for value in gone:
        fs.delete(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root, f"{partition_col}={value}"), True)
    return gone


def live_rows(store: DataFrame, as_of=None) -> DataFrame:
    """Rows whose time-to-live has not passed at ``as_of`` (default: now)."""
    now = F.current_timestamp() if as_of is None else F.lit(as_of)
    return store.filter(F.col("ttl") > F.unix_seconds(now.cast("timestamp")))


# --- publish ---------------------------------------------------------------------


def publish(df: DataFrame, key_col: str, fmt: str = "kafka", path: str | None = None, **options) -> None:
    """Write rows as keyed JSON messages (``key``, ``value``), e.g. to a topic
    with ``fmt="kafka", topic=..., **{"kafka.bootstrap.servers": ...}``."""
    from aerolith.functions.json import to_json_value

    msgs = to_json_value(df, key_col)
    w = msgs.write.format(fmt).options(**options)
    w.save(path) if path else w.save()
