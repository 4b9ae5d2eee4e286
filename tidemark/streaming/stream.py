"""Structured Streaming forms of the incremental operators.

All three run with ``Trigger.AvailableNow`` (process what has landed, then stop) and keep their progress
in a checkpoint under the shared checkpoint directory, so a restarted or failed query resumes from the
last committed micro-batch. Sinks are ``foreachBatch`` calls into the batch operators, made idempotent
with the micro-batch id recorded in the TableStore commit log: a replayed batch is a no-op.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..operators.changes import change_detect, latest_by_key
from ..operators.merge import dedupe_by_pk
from ..sources.store import TableStore


def file_stream(spark: SparkSession, directory: str, schema: StructType, glob: str | None = None,
                fmt: str = "parquet", max_files: int | None = None) -> DataFrame:
    """Landed files as a stream (explicit schema, optional file-name filter)."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return r.load(directory)


def _batch_tag(checkpoint: str, batch_id: int) -> str:
    """Replay key of a micro-batch: unique per streaming query (its checkpoint) and batch id."""
    return f"stream:{hashlib.sha1(checkpoint.encode('utf-8')).hexdigest()[:16]}:{batch_id}"


def _run(stream: DataFrame, fn, checkpoint: str, name: str) -> None:
    q = (stream.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).queryName(name).start())
    q.awaitTermination()
    if q.exception() is not None:  # pragma: no cover - surfaced by awaitTermination as well
        raise RuntimeError(str(q.exception()))


def stream_merge(stream: DataFrame, store: TableStore, table: str, pk: Sequence[str], checkpoint: str,
                 prefer: Sequence[str] = ()) -> None:
    """Every micro-batch is PK-merged into ``table`` (idempotent on the batch id)."""
    def sink(batch: DataFrame, batch_id: int) -> None:
        store.merge(table, batch, pk, prefer=[F.col(p) for p in prefer], batch_id=_batch_tag(checkpoint, batch_id))

    _run(stream, sink, checkpoint, f"merge_{table}")


def stream_dedup(stream: DataFrame, store: TableStore, table: str, keys: Sequence[str], checkpoint: str,
                 prefer: Sequence[str] = ()) -> None:
    """The first delivery of a key is stored, later ones are dropped, however late rows arrive.

    The table itself is the memory: a micro-batch is reduced to one row a key, rows whose key is stored already go, the
    rest is merged. Only the key ranges that the micro-batch touches are read for that, not all stored keys. No
    watermark, so no late row is lost.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        new = dedupe_by_pk(batch, list(keys), [F.col(p) for p in prefer])
        if store.exists(table):
            known = store.read_for_keys(table, batch.select(*keys).where(F.col(f"`{keys[0]}`").isNotNull()))
            new = new.join(known.select(*keys), list(keys), "left_anti").select(*batch.columns)
        store.merge(table, new.select(*batch.columns), list(keys), batch_id=_batch_tag(checkpoint, batch_id), unique=True)

    _run(stream, sink, checkpoint, f"dedup_{table}")


def stream_change_detect(stream: DataFrame, store: TableStore, manifest_table: str, changes_table: str,
                         key: str, ts: str, order: Sequence[Column], checkpoint: str, keep_days: int | None = None) -> None:
    """Per micro-batch, latest snapshot per key -> changes vs the stored manifest -> append changes,
    then advance the manifest. Manifest first read, then rewritten only after the changes are committed.

    Only the manifest's key ranges that the micro-batch touches are read and rewritten. With ``keep_days`` entries more
    than that many days older than the newest one leave the manifest when the stream has caught up.
    """
    def sink(batch: DataFrame, batch_id: int) -> None:
        tag = _batch_tag(checkpoint, batch_id)
        latest = latest_by_key(batch, key, list(order)).select(key, ts)
        manifest = store.read_for_keys(manifest_table, latest.select(key))
        changes = change_detect(latest, manifest, key, ts)
        store.append(changes_table, changes, batch_id=tag)
        # Manifest versions are immutable files, so `changes` still reads the pre-batch manifest here.
        store.merge(manifest_table, changes.select(key, ts), [key], batch_id=tag)

    _run(stream, sink, checkpoint, f"changes_{changes_table}")
    if keep_days is not None:
        expire(store, manifest_table, ts, keep_days)


def expire(store: TableStore, table: str, ts: str, keep_days: int) -> None:
    """Rewrite a manifest without what is more than ``keep_days`` days older than its newest entry."""
    rows = store.read(table)
    newest = rows.agg(F.max(ts)).first()[0]
    if newest is not None:
        oldest = F.lit(newest).cast(rows.schema[ts].dataType) - F.make_dt_interval(F.lit(keep_days))
        store.replace(table, rows.where(F.col(ts) >= oldest))
