"""TableStore: Parquet tables with primary-key merge, full replace and append, on any Hadoop filesystem.

Layout of one table::

    <root>/<table>/v=<N>-<attempt>-<batch>/bucket=<b>/part-*.parquet   data written by one attempt at commit N
    <root>/<table>/_log/<N>.json                                        commit N: live data paths, layout, counts

* A table is the set of paths named by its newest commit file. Data is written first, into a folder that no other
  attempt uses, the commit file last (create-if-absent). A job that fails before its commit leaves the previous
  version as it was and one folder that nothing names (``vacuum`` removes it); the retry writes a folder of its own.
* Two writers can't commit the same version: the second one's commit fails, and it merges again on top of the first.
* ``merge`` buckets rows by ranges of the first whole-number key column that varies, within the values of the constant
  ones before it (a tenant's id); ids grow with time, so recent changes share few buckets, and new ids open new ones.
  Without such a column rows are hashed. The layout is decided by the first merge and kept in the commit. A merge rewrites the buckets that hold a key of the delta, no others; live rows are only
  filtered against the delta's keys, never sorted.
* ``batch_id`` makes a write idempotent: its digest is part of the folder's name, so an applied batch is found by one
  listing even if its marker is lost.
* Rows with a NULL in the primary key or another required column go to the table ``_rejects``, counted, instead of the
  merge; texts that a load could not cast are counted by column in ``_cast_failures``. All counts of a delta are observed
  while it is written.
* Data files are Parquet or ORC, one format a table.
"""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import dedupe_by_pk

BUCKET_COL = "__bucket"
REJECTS = "_rejects"
CAST_FAILURES = "_cast_failures"
#: Column of a delta that lists the columns whose text could not be cast; not stored.
FAILED_COL = "__failed"
FORMATS = ("parquet", "orc")
_WHOLE = ("tinyint", "smallint", "int", "bigint")


class CommitConflict(RuntimeError):
    """Another writer has committed this version first."""


@dataclass
class MergeResult:
    table: str
    version: int
    rows_in: int
    inserted: int
    updated: int
    skipped: bool = False
    deleted: int = 0
    rejected: int = 0


class _FS:
    """Tiny wrapper over the Hadoop FileSystem of the session (local, HDFS, object stores)."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()

    def _path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def _fs(self, p: str):
        return self._path(p).getFileSystem(self.conf)

    def exists(self, p: str) -> bool:
        return self._fs(p).exists(self._path(p))

    def list_names(self, p: str) -> list[str]:
        if not self.exists(p):
            return []
        return [s.getPath().getName() for s in self._fs(p).listStatus(self._path(p))]

    def write_new(self, p: str, text: str, overwrite: bool = False) -> None:
        """Create ``p``; unless ``overwrite``, only if absent."""
        out = self._fs(p).create(self._path(p), overwrite)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()

    def delete(self, p: str) -> None:
        self._fs(p).delete(self._path(p), True)

    def read_text(self, p: str) -> str:
        stream = self._fs(p).open(self._path(p))
        try:
            reader = self.jvm.java.io.BufferedReader(self.jvm.java.io.InputStreamReader(stream, "UTF-8"))
            lines = []
            line = reader.readLine()
            while line is not None:
                lines.append(line)
                line = reader.readLine()
            return "\n".join(lines)
        finally:
            stream.close()


class TableStore:
    def __init__(self, spark: SparkSession, root: str, buckets: int = 16, fmt: str = "parquet"):
        if fmt not in FORMATS:
            raise ValueError(f"format must be one of {FORMATS}")
        self.spark = spark
        self.fmt = fmt
        self.root = root.rstrip("/")
        self.buckets = int(buckets)
        self.fs = _FS(spark)

    @classmethod
    def for_dataset(cls, spark: SparkSession, root: str, dataset: str, dev_mode: bool = False,
                    buckets: int = 16, fmt: str = "parquet") -> "TableStore":
        """A10: one namespace per dataset; ``dev_mode`` isolates a run in its own suffixed dataset."""
        name = f"{dataset}_dev_{uuid.uuid4().hex[:8]}" if dev_mode else dataset
        return cls(spark, f"{root.rstrip('/')}/{name}", buckets, fmt)

    # -- commit log -------------------------------------------------------------------------------

    def _tdir(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _log(self, table: str) -> list[int]:
        names = self.fs.list_names(f"{self._tdir(table)}/_log")
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def commit_info(self, table: str, version: int | None = None) -> dict | None:
        versions = self._log(table)
        if not versions:
            return None
        v = versions[-1] if version is None else version
        return json.loads(self.fs.read_text(f"{self._tdir(table)}/_log/{v}.json"))

    def version(self, table: str) -> int:
        versions = self._log(table)
        return versions[-1] if versions else 0

    def history(self, table: str) -> list[dict]:
        return [self.commit_info(table, v) for v in self._log(table)]

    @staticmethod
    def _digest(batch_id: str | None) -> str:
        return hashlib.sha1(batch_id.encode("utf-8")).hexdigest()[:20] if batch_id else "x"

    def _marker(self, table: str, batch_id: str) -> str:
        return f"{self._tdir(table)}/_batches/{self._digest(batch_id)}"

    def _commit(self, table: str, info: dict) -> None:
        info = {**info, "format": self._format(table), "committed_at": time.time()}
        path = f"{self._tdir(table)}/_log/{info['version']}.json"
        if info.get("batch_id"):  # names the commit to look at; says nothing until that commit holds this batch
            self.fs.write_new(self._marker(table, info["batch_id"]), str(info["version"]), overwrite=True)
        try:
            self.fs.write_new(path, json.dumps(info, sort_keys=True))
        except Exception as e:  # the only way to see a lost race; anything else is raised as it is
            if self.fs.exists(path):
                raise CommitConflict(f"{table}: version {info['version']} was committed by another writer") from e
            raise

    def _format(self, table: str) -> str:
        """The format of a table's files: that of its first commit, else the store's."""
        info = self.commit_info(table)
        return info.get("format", "parquet") if info else self.fmt

    def _folder(self, version: int, batch_id: str | None) -> str:
        return f"v={version}-{uuid.uuid4().hex[:8]}-{self._digest(batch_id)}"

    def exists(self, table: str) -> bool:
        return bool(self._log(table))

    # -- reads --------------------------------------------------------------------------------------

    def read(self, table: str, version: int | None = None) -> DataFrame:
        info = self.commit_info(table, version)
        if info is None:
            raise FileNotFoundError(f"table {table} has no commits under {self.root}")
        paths = [f"{self._tdir(table)}/{p}" for p in info["paths"]]
        schema = info.get("schema")
        if not paths:
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.format(info.get("format", "parquet"))
        if schema:
            reader = reader.schema(schema)
        return reader.load(paths)

    def read_for_keys(self, table: str, keys: DataFrame) -> DataFrame:
        """The rows of the buckets that may hold one of ``keys`` (rows with the key columns); all rows of a table without buckets."""
        info = self.commit_info(table)
        if info is None:
            raise FileNotFoundError(f"table {table} has no commits under {self.root}")
        if "buckets" not in info:
            return self.read(table)
        touched = {str(r[0]) for r in keys.select(self._bucket(info["layout"])).distinct().collect()}
        paths = [f"{self._tdir(table)}/{path}" for b, path in sorted(info["buckets"].items()) if b in touched]
        if not paths:
            return self.spark.createDataFrame([], info["schema"])
        return self.spark.read.format(info.get("format", "parquet")).schema(info["schema"]).load(paths)

    def export(self, table: str, name: str, partition_by: Sequence[str] = ()) -> None:
        """The table's current rows as a table of the session's catalog (replaced as a whole)."""
        writer = self.read(table).write.format(self._format(table)).mode("overwrite")
        (writer.partitionBy(*partition_by) if partition_by else writer).saveAsTable(name)

    # -- writes -------------------------------------------------------------------------------------

    def _bucket(self, layout: dict) -> Column:
        if layout["kind"] == "range":
            on = F.col(f"`{layout.get('on', layout['pk'][0])}`").cast("long")
            lead = [F.col(f"`{c}`").cast("string") for c in layout.get("lead", [])]
            return F.concat_ws("_", *lead, F.floor(on / F.lit(layout["width"])).cast("string"))
        return F.pmod(F.xxhash64(*[F.col(f"`{k}`") for k in layout["pk"]]), F.lit(layout["buckets"])).cast("string")

    def _layout(self, df: DataFrame, pk: list[str]) -> dict:
        """Ranges of the first whole-number key column that varies, as wide as gives ``buckets`` ranges now; else hashes."""
        whole, ends = self._ends(df, pk)
        return self._layout_of(pk, whole, df.agg(*ends).first() if ends else None)

    def _ends(self, df: DataFrame, pk: list[str]) -> tuple[list[str], list[Column]]:
        """The leading whole-number key columns, and the least and greatest of each."""
        whole = []
        for k in pk:  # the columns before the ranged one have one value each: whole numbers too
            if df.schema[k].dataType.simpleString() not in _WHOLE:
                break
            whole.append(k)
        value = lambda k: F.col(f"`{k}`").cast("long")
        return whole, [f(value(k)).alias(f"{n}{i}") for i, k in enumerate(whole) for n, f in (("lo", F.min), ("hi", F.max))]

    def _layout_of(self, pk: list[str], whole: list[str], r) -> dict:
        if whole and r["lo0"] is not None:
            at = next((i for i in range(len(whole)) if r[f"lo{i}"] < r[f"hi{i}"]), len(whole) - 1)
            return {"kind": "range", "pk": pk, "lead": whole[:at], "on": whole[at], "width": max(1, -(-(r[f"hi{at}"] - r[f"lo{at}"] + 1) // self.buckets))}
        return {"kind": "hash", "pk": pk, "buckets": self.buckets}

    def _write(self, df: DataFrame, path: str, by_bucket: bool, shuffle: bool = True, dictionary: bool = True) -> None:
        fmt = self._format(path[len(self.root) + 1 :].split("/")[0])
        if by_bucket and shuffle:
            df = df.hint("rebalance", BUCKET_COL)
        writer = df.write.format(fmt).option("compression", "zstd").mode("errorifexists")
        if not dictionary:
            writer = writer.option("parquet.enable.dictionary", "false")
        (writer.partitionBy(BUCKET_COL) if by_bucket else writer).save(path)

    def _written(self, table: str, folder: str) -> dict[str, str]:
        names = self.fs.list_names(f"{self._tdir(table)}/{folder}")
        return {n.split("=", 1)[1]: f"{folder}/{n}" for n in names if n.startswith(f"{BUCKET_COL}=")}

    def replace(self, table: str, df: DataFrame, batch_id: str | None = None, dictionary: bool = True) -> int:
        """The new content fully replaces the table (new folder + commit; old data untouched).

        Without ``dictionary`` texts are written as they are: a third less time for nested rows of mostly distinct texts,
        about a tenth more bytes."""
        return self._whole(table, df, batch_id, "replace", dictionary)

    def append(self, table: str, df: DataFrame, batch_id: str | None = None) -> int:
        """Bag append (audit log, staging): previous paths plus one new folder."""
        return self._whole(table, df, batch_id, "append")

    def _whole(self, table: str, df: DataFrame, batch_id: str | None, op: str, dictionary: bool = True) -> int:
        done = self._replayed(table, batch_id)
        if done is not None:
            return done["version"]
        folder = self._folder(self.version(table) + 1, batch_id)
        self._write(df, f"{self._tdir(table)}/{folder}", by_bucket=False, dictionary=dictionary)
        while True:  # the data doesn't depend on what others committed meanwhile
            prev = self.commit_info(table)
            paths = (prev["paths"] if prev and op == "append" else []) + [folder]
            info = {"version": (prev["version"] if prev else 0) + 1, "op": op, "paths": paths, "schema": _ddl(df), "batch_id": batch_id}
            try:
                self._commit(table, info)
                return info["version"]
            except CommitConflict:
                continue

    def _replayed(self, table: str, batch_id: str | None) -> dict | None:
        """The commit that already applied ``batch_id``, if any: by its marker, else by the names of data folders."""
        if batch_id is None:
            return None
        marker, versions = self._marker(table, batch_id), set(self._log(table))
        tried = [int(self.fs.read_text(marker).strip())] if self.fs.exists(marker) else []
        names = [n for n in self.fs.list_names(self._tdir(table)) if n.endswith(f"-{self._digest(batch_id)}")]
        tried += [int(n[2:].split("-")[0]) + i for n in names for i in (0, 1, 2, 3)]  # a lost race commits a little later
        for v in tried:
            info = self.commit_info(table, v) if v in versions else None
            if info is not None and info.get("batch_id") == batch_id:
                return info
        return None

    def merge(self, table: str, df: DataFrame, pk: Sequence[str], prefer: Sequence[Column] = (),
              batch_id: str | None = None, unique: bool = False, reloaded_parents: DataFrame | None = None,
              keep_newer: bool = False, not_null: Sequence[str] = (), stored: bool = False, ends: dict | None = None) -> MergeResult:
        """A7/D3 + E2: upsert ``df`` by ``pk``, rewriting only the buckets that hold its keys.

        Among delta rows of one key the greatest ``prefer`` tuple wins, then the greatest full row; ``unique`` says that
        there are none to choose from. The winner replaces the live row, unless ``keep_newer`` and the live row has the
        greater ``prefer`` tuple. Columns that only one side has are NULL on the other (the schema grows).

        ``reloaded_parents`` (FK columns only) switches on orphan deletion: live rows whose FK is among the reloaded
        parents and whose key is not in the delta are removed; their buckets are found by a scan of key columns.

        ``stored``: ``df`` is a plain projection of stored rows, which may be read twice. The first merge of such rows, if
        ``unique``, writes them straight into their buckets and counts them meanwhile: no delta, no shuffle. Before that only
        the ends of the key columns are read, unless ``ends`` has them (``key_ends``; a wider range is as right).
        """
        done = self._replayed(table, batch_id)
        if done is not None:
            c = done.get("counts", {})
            return MergeResult(table, done["version"], c.get("rows_in", 0), c.get("inserted", 0), c.get("updated", 0), True)
        pk = list(pk)
        if stored and unique and not self.exists(table):
            try:
                return self._first(table, df, pk, not_null, batch_id, ends)
            except CommitConflict:
                pass  # there is a table now: merged with it
        # The delta is written once, and counted meanwhile: it is deduplicated and joined from there, never recomputed.
        stage = f"{self._tdir(table)}/_delta/{uuid.uuid4().hex}"
        missing, counts = self._row_counts(df, pk, not_null)
        seen = Observation()
        df.observe(seen, *counts).write.option("compression", "zstd").parquet(stage)
        sizes = seen.get
        try:
            staged = self.spark.read.schema(df.schema).parquet(stage)
            delta = self._accepted(table, staged, pk, not_null, missing, sizes, batch_id)
            for _ in range(5):
                try:
                    return self._merge(table, delta, pk, prefer, batch_id, unique, reloaded_parents, keep_newer, sizes)
                except CommitConflict:
                    continue
            raise CommitConflict(f"{table}: other writers were faster five times")
        finally:
            self.fs.delete(stage)

    @staticmethod
    def _row_counts(df: DataFrame, pk: Sequence[str], not_null: Sequence[str]) -> tuple[Column, list[Column]]:
        """Whether a row lacks a required column; and the counts of a delta: rows, rows that do, failed casts."""
        missing = F.lit(False)
        for k in dict.fromkeys([*pk, *not_null]):
            missing = missing | F.col(f"`{k}`").isNull()
        failed = F.coalesce(F.size(FAILED_COL), F.lit(0)) if FAILED_COL in df.columns else F.lit(0)
        return missing, [F.count(F.lit(1)).alias("n"), F.count_if(missing).alias("bad"), F.sum(failed).alias("failed")]

    def _accepted(self, table: str, rows: DataFrame, pk: list[str], not_null: Sequence[str], missing: Column, sizes, batch_id: str | None) -> DataFrame:
        """The rows to merge; failed casts are counted by column, rows that lack a required column set apart."""
        if sizes["failed"]:
            columns = rows.select(F.explode(FAILED_COL).alias("column_name")).groupBy("column_name").agg(F.count(F.lit(1)).alias("n_rows"))
            self.append(CAST_FAILURES, columns.select(F.lit(table).alias("table_name"), "column_name", "n_rows"), batch_id=f"{batch_id}:casts:{table}" if batch_id else None)
        rows = rows.drop(FAILED_COL)
        if not sizes["bad"]:
            return rows
        null_key = F.lit(False)
        for k in pk:
            null_key = null_key | F.col(f"`{k}`").isNull()
        other = F.concat(F.lit("NULL in "), F.concat_ws(", ", *[F.when(F.col(f"`{k}`").isNull(), F.lit(k)) for k in not_null]))
        self._reject(table, rows.where(missing), F.when(null_key, F.lit("NULL primary key")).otherwise(other), batch_id)
        return rows.where(~missing)

    def key_ends(self, keyed: dict[str, tuple[DataFrame, Sequence[str]]]) -> dict[str, dict]:
        """The least and greatest of each leading whole-number key column of several tables, name -> (rows, key): one job, of key columns alone."""
        parts = []
        for name, (df, pk) in keyed.items():
            if ends := self._ends(df, list(pk))[1]:
                parts.append(df.agg(*ends).select(F.lit(name).alias("name"), F.array(*[F.struct(*[F.col(f"{n}{i}").alias(n) for n in ("lo", "hi")]) for i in range(len(ends) // 2)]).alias("ends")))
        if not parts:
            return {}
        every = parts[0]
        for p in parts[1:]:
            every = every.unionByName(p)
        return {r["name"]: {f"{n}{i}": e[n] for i, e in enumerate(r["ends"]) for n in ("lo", "hi")} for r in every.collect()}

    def _first(self, table: str, df: DataFrame, pk: list[str], not_null: Sequence[str], batch_id: str | None, ends: dict | None) -> MergeResult:
        missing, counts = self._row_counts(df, pk, not_null)
        ends = self.key_ends({table: (df.where(~missing), pk)}).get(table, {}) if ends is None else ends
        layout, folder, seen = self._layout_of(pk, pk[: len(ends) // 2], ends), self._folder(1, batch_id), Observation()
        rows = df.observe(seen, *counts).where(~missing).drop(FAILED_COL)
        # Without a shuffle a task writes a file for each bucket it holds rows of: rows landed together have near keys.
        self._write(rows.withColumn(BUCKET_COL, self._bucket(layout)), f"{self._tdir(table)}/{folder}", by_bucket=True, shuffle=False)
        sizes = seen.get
        if sizes["bad"] or sizes["failed"]:  # read once more for these, before the commit
            self._accepted(table, df, pk, not_null, missing, sizes, batch_id)
        n = sizes["n"] - sizes["bad"]
        live, done = self._written(table, folder), {"rows_in": sizes["n"], "rejected": sizes["bad"], "updated": 0, "deleted": 0, "inserted": n}
        self._commit(table, {"version": 1, "op": "merge", "pk": pk, "layout": layout, "buckets": live, "paths": sorted(live.values()), "schema": _ddl(rows), "batch_id": batch_id, "counts": done})
        return MergeResult(table, 1, sizes["n"], n, 0, rejected=sizes["bad"])

    def _reject(self, table: str, rows: DataFrame, reason: Column, batch_id: str | None) -> None:
        text = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns]))
        out = rows.select(F.lit(table).alias("table_name"), reason.alias("reason"), text.alias("row"))
        self.append(REJECTS, out, batch_id=f"{batch_id}:rejects:{table}" if batch_id else None)

    def _merge(self, table, delta, pk, prefer, batch_id, unique, reloaded_parents, keep_newer, sizes) -> MergeResult:
        prev = self.commit_info(table)
        v = (prev["version"] if prev else 0) + 1
        folder = self._folder(v, batch_id)
        keys = [F.col(f"`{k}`") for k in pk]
        layout = (prev or {}).get("layout") or self._layout(delta, pk)
        if layout["pk"] != pk:
            raise ValueError(f"{table} is laid out by {layout['pk']}, not {pk}")
        winners = delta if unique else dedupe_by_pk(delta, pk, prefer)
        schema = prev["schema"] if prev else _ddl(delta)
        counts = {"rows_in": sizes["n"], "rejected": sizes["bad"], "updated": 0, "deleted": 0}
        live: dict[str, str] = {}
        data, n_winners = winners, delta.count() if unique else delta.select(*keys).distinct().count()
        if prev is not None:
            reader = self.spark.read.format(prev.get("format", "parquet")).schema(schema)
            live, everything = dict(prev.get("buckets") or {}), [f"{self._tdir(table)}/{p}" for p in prev["paths"]]
            touched = delta.select(self._bucket(layout).alias(BUCKET_COL))
            gone = None
            if reloaded_parents is not None:
                gone = reloaded_parents.dropDuplicates()
                fk = gone.columns
                if everything:
                    hit = reader.load(everything).select(*dict.fromkeys([*fk, *pk])).join(gone, fk, "left_semi")
                    touched = touched.union(hit.select(self._bucket(layout)))
            touched = {str(r[0]) for r in touched.distinct().collect()}
            # After a replace or append there are no buckets yet: all of the table is laid out now.
            old = [f"{self._tdir(table)}/{live[b]}" for b in sorted(touched) if b in live] if "buckets" in prev else everything
            if old:
                rows = reader.load(old)
                if keep_newer and prefer:
                    mine = winners.select(*keys, F.struct(*prefer).alias("__mine"))
                    theirs = rows.select(*keys, F.struct(*prefer).alias("__theirs"))
                    stale = theirs.join(mine, pk).where(F.col("__theirs") > F.col("__mine")).select(*pk)
                    winners = winners.join(stale, pk, "left_anti")
                    n_winners -= stale.count()
                mine = winners.select(*keys)
                counts["updated"] = rows.select(*keys).join(mine, pk, "left_semi").count()
                rest = rows.join(mine, pk, "left_anti")
                if gone is not None:
                    lost = rest.join(gone, fk, "left_semi")
                    if keep_newer and prefer:  # a live row that outlived its stale delta row is no orphan
                        lost = lost.join(delta.select(*keys), pk, "left_anti")
                    counts["deleted"] = lost.count()
                    rest = rest.join(lost.select(*keys), pk, "left_anti")
                data = rest.unionByName(winners, allowMissingColumns=True)
            else:
                data = winners
            for b in touched:
                live.pop(b, None)
            if "buckets" not in prev:
                live = {}
            known = {f.name for f in reader.load(everything).schema} if everything else set()
            extra = [f for f in delta.schema if f.name not in known]
            schema = ", ".join([schema, *[f"`{f.name}` {f.dataType.simpleString()}" for f in extra]]) if known else _ddl(delta)
        counts["inserted"] = n_winners - counts["updated"]
        self._write(data.withColumn(BUCKET_COL, self._bucket(layout)), f"{self._tdir(table)}/{folder}", by_bucket=True)
        live.update(self._written(table, folder))
        self._commit(table, {"version": v, "op": "merge", "pk": pk, "layout": layout, "buckets": live, "paths": sorted(live.values()), "schema": schema, "batch_id": batch_id, "counts": counts})
        return MergeResult(table, v, counts["rows_in"], counts["inserted"], counts["updated"], deleted=counts["deleted"], rejected=counts["rejected"])

    def vacuum(self, table: str, retain: int = 10) -> list[str]:
        """Remove the commits before the newest ``retain`` and every data folder that no remaining commit names.

        Not to be run while a writer is at work: its folder isn't named yet.
        """
        versions = self._log(table)
        for v in versions[:-retain] if retain else []:
            self.fs.delete(f"{self._tdir(table)}/_log/{v}.json")
        named = {p.split("/")[0] for v in self._log(table) for p in self.commit_info(table, v)["paths"]}
        loose = [n for n in self.fs.list_names(self._tdir(table)) if n.startswith("v=") and n not in named]
        for n in loose:
            self.fs.delete(f"{self._tdir(table)}/{n}")
        return loose


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema.fields if f.name != BUCKET_COL)
