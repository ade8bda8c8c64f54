"""A Parquet table with one row per key and an atomic keyed upsert.

Plain Parquet has no ``MERGE``. Rows live in hash buckets of the key, each bucket in a few pieces
(files). A change set is written once, as the change feed, with one bucket to a file; these files are also
the pieces of the new rows, unless most of their rows are none. The untouched rows of exactly those buckets
in which something was updated or deleted go to new pieces. Buckets that only gain rows keep their pieces. A manifest lists the live pieces, and one small commit
file that appears at once makes a version visible: readers see the old state or the new one, earlier
versions stay readable, and a run that dies before its commit is simply run again.

Small deliveries leave small pieces. A commit that finds more than ``PIECES`` in a bucket merges the
smallest, and of the larger ones those no larger than the merged ones together, so a row is moved a
logarithmic number of times. When buckets hold more than ``bucket_bytes`` on average, their number
doubles: a piece keeps the number it was written under, serves both halves, and is split when it is
next rewritten.

Writers may work side by side. Each prepares its pieces under names of its own and commits the next
version; of several that try the same version one succeeds. The others look at what was committed
meanwhile: if no key of their change set was changed and all pieces that they replace are still live,
they commit on top; else ``Conflict`` is raised, and ``retried`` computes the change set anew.
"""

from __future__ import annotations

import json
import uuid
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce
from typing import NamedTuple, TypeVar

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ordermill.sinks.files import COMPRESSION, create_file, delete_path, read_parquet

# Change sets up to this many keys are broadcast (at most some tens of MB); larger ones shuffle.
BROADCAST_KEYS = 500_000
# Pieces of one bucket; more are merged.
PIECES = 8
BUCKET_BYTES = 1 << 30
# Rows of a change set for one task, and bytes of rewritten pieces; a bucket with more goes to several tasks.
TASK_ROWS = 250_000
TASK_BYTES = 1 << 26
# Keys that one task holds to leave out the rows of a bucket, and buckets that one job rewrites.
TASK_KEYS = 2_000_000
PARTS = 64
ATTEMPTS = 20

INSERTED, UPDATED, DELETED, UNCHANGED = "inserted", "updated", "deleted", "unchanged"

COMMIT = T.StructType(
    [
        T.StructField("version", T.LongType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("source_version", T.LongType()),
        T.StructField("affected", T.LongType()),
        T.StructField("committed_at", T.TimestampType()),
        T.StructField("change_set", T.StringType()),
        T.StructField("manifest", T.StringType()),
        T.StructField("tag", T.StringType()),
    ]
)

Made = TypeVar("Made")


class Conflict(RuntimeError):
    """Another writer changed what this one built on."""


def retried(action: Callable[[], Made], attempts: int = ATTEMPTS) -> Made:
    """Run an action that reads a table and commits to it, again after each conflict."""
    for left in range(attempts - 1, -1, -1):
        try:
            return action()
        except Conflict:
            if not left:
                raise


class Piece(NamedTuple):
    """A file with the rows whose key falls into ``bucket`` of ``buckets``."""

    bucket: int
    buckets: int
    path: str
    size: int

    def serves(self, bucket: int) -> bool:
        """Does it hold rows of a bucket of the table, of which there are at least as many?"""
        return bucket % self.buckets == self.bucket


_MANIFEST = "bucket int, buckets int, path string, size long"


@dataclass(frozen=True)
class Snapshot:
    """One committed state."""

    version: int
    buckets: int
    source_version: int | None = None
    affected: int = 0
    committed_at: datetime | None = None
    change_set: str | None = None
    manifest: str | None = None
    tag: str | None = None


class KeyedTable:
    def __init__(
        self,
        spark: SparkSession,
        root: str,
        key: str,
        schema: T.StructType,
        feed_schema: T.StructType | None = None,
        buckets: int | None = None,
        bucket_bytes: int = BUCKET_BYTES,
    ):
        """``buckets`` counts only at creation; the default is the session's shuffle width.

        ``feed_schema`` names extra columns a change set carries besides the row itself.
        """
        self.spark = spark
        self.root = root
        self.key = key
        self.schema = schema
        self.feed_schema = feed_schema or T.StructType([])
        self.bucket_bytes = bucket_bytes
        self._buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
        # Manifests never change once written.
        self._manifests: dict[str, list[Piece]] = {}

    # --- reading ---------------------------------------------------------------------------

    def commits(self) -> DataFrame:
        """One row per committed version."""
        return read_parquet(self.spark, [f"{self.root}/commits"], COMMIT, kind="json")

    def snapshot(self, version: int | None = None) -> Snapshot:
        """The latest committed state, or an earlier one."""
        rows = self.commits()
        row = (
            rows.agg(F.max_by(F.struct(*COMMIT.names), "version").alias("last")).first()["last"]
            if version is None
            else rows.where(F.col("version") == version).first()
        )
        return Snapshot(**row.asDict()) if row else Snapshot(0, self._buckets)

    def tagged(self, tag: str) -> Snapshot | None:
        """The latest commit that carries a tag."""
        rows = self.commits().where(F.col("tag") == tag)
        row = rows.agg(F.max_by(F.struct(*COMMIT.names), "version").alias("last")).first()["last"]
        return Snapshot(**row.asDict()) if row else None

    def versions(self, tag: str) -> list[Snapshot]:
        """All commits that carry a tag, the oldest first."""
        rows = self.commits().where(F.col("tag") == tag).orderBy("version").collect()
        return [Snapshot(**row.asDict()) for row in rows]

    def before(self, snapshot: Snapshot) -> Snapshot:
        """The state that a commit was made on."""
        found = self.snapshot(snapshot.version - 1)
        if found.version != snapshot.version - 1:
            raise ValueError(f"version {snapshot.version - 1} of {self.root} is no longer there")
        return found

    def pieces(self, snapshot: Snapshot) -> list[Piece]:
        """The live files of a state; as many as Spark lists itself when it reads them."""
        name = snapshot.manifest
        if name is None:
            return []
        if name not in self._manifests:
            rows = read_parquet(self.spark, [f"{self.root}/manifests/{name}"], T.StructType.fromDDL(_MANIFEST))
            self._manifests[name] = sorted(Piece(*row) for row in rows.collect())
        return self._manifests[name]

    def read(self, snapshot: Snapshot | None = None, buckets: set[int] | None = None) -> DataFrame:
        """All rows of a committed state, or those of some buckets; other buckets' files are not opened."""
        snapshot = snapshot or self.snapshot()
        live = self.pieces(snapshot)
        if buckets is not None:
            wanted = {n: {b % n for b in buckets} for n in {piece.buckets for piece in live}}
            live = [piece for piece in live if piece.bucket in wanted[piece.buckets]]
        rows = self._rows(live)
        if buckets is None or all(piece.buckets == snapshot.buckets for piece in live):
            return rows
        # A piece from before the number of buckets grew holds rows of other buckets too.
        return rows.where(self.bucket(F.col(self.key), snapshot.buckets).isin(*buckets))

    def _rows(self, pieces: list[Piece]) -> DataFrame:
        """The rows of some pieces. Those in a change set are next to rows that are not in the table."""
        in_changes = [piece.path.startswith("changes/") for piece in pieces]
        paths = [f"{self.root}/{'' if c else 'data/'}{piece.path}" for c, piece in zip(in_changes, pieces)]
        if not any(in_changes):
            return read_parquet(self.spark, paths, self.schema).select(*self.schema.names)
        rows = read_parquet(self.spark, paths, T.StructType([*self.schema, T.StructField("action", T.StringType())]))
        is_row = F.col("action").isNull() | F.col("action").isin(INSERTED, UPDATED)
        return rows.where(is_row).select(*self.schema.names)

    def changes(self, after: int, upto: int) -> DataFrame:
        """Effective changes of the versions in ``(after, upto]`` with their ``version``."""
        wanted = self.commits().where((F.col("version") > after) & (F.col("version") <= upto))
        versions = [(r["change_set"], r["version"]) for r in wanted.select("change_set", "version").collect()]
        feed = self._sets([name for name, _ in versions]).where(F.col("action") != UNCHANGED)
        numbers = self.spark.createDataFrame(versions, "change_set string, version long")
        return feed.join(F.broadcast(numbers), "change_set")

    def actions(self, change_set: str) -> DataFrame:
        """Every key of one change set with what happened to it, unchanged ones included."""
        return self._sets([change_set]).select(self.key, "action")

    def _sets(self, names: list[str]) -> DataFrame:
        fields = self.schema.fields + self.feed_schema.fields + [
            T.StructField("action", T.StringType()),
            T.StructField("bucket", T.IntegerType()),
            T.StructField("change_set", T.StringType()),
        ]
        base = f"{self.root}/changes"
        return read_parquet(self.spark, [f"{base}/change_set={n}" for n in names], T.StructType(fields), base)

    # --- writing ---------------------------------------------------------------------------

    def bucket(self, key: Column, buckets: int) -> Column:
        return F.pmod(F.hash(key), F.lit(buckets))

    def tasks(self, base: Snapshot, n_rows: int) -> int:
        """How many tasks rows are dealt to by key: each has rows of one bucket, many rows of a bucket go to several."""
        return base.buckets * max(min(-(-n_rows // (base.buckets * TASK_ROWS)), PIECES // 2), 1)

    def stage(self, changes: DataFrame, base: Snapshot, tasks: int | None = None) -> str:
        """Write a change set: rows of the table schema plus ``action`` (and feed columns); returns its name.

        The bare key is enough for a deleted or unchanged row. The rows are dealt by key, to ``tasks`` if that
        is given; Spark leaves rows where they are that a repartition or join has dealt so.
        """
        change_set = uuid.uuid4().hex
        names = self.schema.names + self.feed_schema.names
        effective = F.col("action").isin(INSERTED, UPDATED)
        columns = [
            F.when(effective, F.col(n)).alias(n) if n in self.schema.names and n != self.key
            else F.col(n)
            for n in names
        ]
        changes = changes.select(*columns, "action", self.bucket(F.col(self.key), base.buckets).alias("bucket"))
        changes = changes.repartition(tasks or base.buckets, self.key)
        changes.write.option("compression", COMPRESSION).parquet(f"{self.root}/changes/change_set={change_set}")
        return change_set

    def commit(
        self,
        base: Snapshot,
        change_set: str,
        source_version: int | None = None,
        rebuild: bool = False,
        always: bool = False,
        tag: str | None = None,
    ) -> Snapshot:
        """Turn a staged change set into the next version, or raise ``Conflict``.

        A change set without effect leaves the table as it is, unless ``always`` asks for a
        commit to move ``source_version``; such a commit tolerates no other one since ``base``, nor
        does ``rebuild``, which replaces every bucket.
        """
        staged = self._sets([change_set])
        files = (
            staged.groupBy("bucket", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_size").alias("size"))
            .agg(
                F.count(F.lit(1)).alias("n_rows"),
                F.count_if(F.col("action") != UNCHANGED).alias("n"),
                F.count_if(F.col("action").isin(UPDATED, DELETED)).alias("n_rewrite"),
                F.count_if(F.col("action").isin(INSERTED, UPDATED)).alias("n_new"),
            )
            .collect()
        )
        touched = [file for file in files if file["n"]]
        if not touched and not rebuild and not always:
            return base
        attempt = uuid.uuid4().hex
        replaced = {r["bucket"] for r in touched if r["n_rewrite"]}
        live = self.pieces(base)
        old = [p for p in live if rebuild or any(p.serves(b) for b in replaced)] if replaced or rebuild else []
        added: list[Piece] = []
        new = [file for file in files if file["n_new"]]
        if len({file["path"] for file in files}) == len(files) and (
            2 * sum(file["n_new"] for file in files) >= sum(file["n_rows"] for file in files)
        ):
            added = [
                Piece(f["bucket"], base.buckets, f"changes/{f['path'].rsplit('/changes/', 1)[1]}", f["size"]) for f in new
            ]
        elif new:
            self._write_new_rows(staged, f"{attempt}/new", base.buckets)
            added = self._written(f"{attempt}/new", base.buckets)
        merged = [] if rebuild else self._to_merge([p for p in live if p not in set(old)], added, base.buckets)
        if (old or merged) and not rebuild:
            n_keys = sum(r["n_rewrite"] for r in touched)
            if n_keys <= BROADCAST_KEYS or merged:
                self._write_survivors(staged, f"{attempt}/kept", old + merged, n_keys, base.buckets, bool(merged))
            else:
                self._write_survivors_apart(touched, f"{attempt}/kept", old, base.buckets)
            added += self._written(f"{attempt}/kept", base.buckets)
        gone, latest = set(old + merged), base
        while True:
            pieces = [p for p in self.pieces(latest) if p not in gone] + added
            result = Snapshot(
                latest.version + 1, self._grown(pieces, latest.buckets), source_version,
                sum(r["n"] for r in touched), datetime.now(timezone.utc).replace(tzinfo=None),
                change_set, self._write_manifest(pieces), tag,
            )
            if self._publish(result):
                return result
            delete_path(self.spark, f"{self.root}/manifests/{result.manifest}")
            latest = self.snapshot()
            if rebuild or always or not gone <= set(self.pieces(latest)) or self._overlaps(change_set, base, latest):
                delete_path(self.spark, f"{self.root}/data/{attempt}")
                delete_path(self.spark, f"{self.root}/changes/change_set={change_set}")
                raise Conflict(f"version {latest.version} of {self.root} changed what version {base.version} held")

    def _overlaps(self, change_set: str, base: Snapshot, latest: Snapshot) -> bool:
        """Did a version since ``base`` change a key of the change set, unchanged ones included?"""
        others = self.changes(base.version, latest.version).select(self.key)
        return not self._sets([change_set]).join(others, self.key, "left_semi").isEmpty()

    def _to_merge(self, kept: list[Piece], added: list[Piece], buckets: int) -> list[Piece]:
        """Pieces to write together, so that no bucket that gains rows keeps more than ``PIECES``."""
        serving: dict[int, list[Piece]] = defaultdict(list)
        gaining = {piece.bucket for piece in added}
        by_number: dict[int, dict[int, list[Piece]]] = defaultdict(lambda: defaultdict(list))
        for piece in kept:
            by_number[piece.buckets][piece.bucket].append(piece)
        for bucket in gaining:
            for number, pieces in by_number.items():
                serving[bucket] += pieces[bucket % number]
        chosen: set[Piece] = set()
        for bucket, pieces in serving.items():
            surplus = len(pieces) + sum(piece.bucket == bucket for piece in added) - PIECES if len(pieces) >= PIECES else 0
            if surplus > 0:
                total = 0
                for n, piece in enumerate(sorted(pieces, key=lambda p: (p.size, p.path))):
                    # Merging one piece more than the surplus makes room for the merged one.
                    if n > surplus and piece.size > total:
                        break
                    total += piece.size
                    chosen.add(piece)
        return sorted(chosen)

    def _grown(self, pieces: list[Piece], buckets: int) -> int:
        while sum(piece.size for piece in pieces) > buckets * self.bucket_bytes:
            buckets *= 2
        return buckets

    def _write_new_rows(self, staged: DataFrame, folder: str, buckets: int) -> None:
        """One file for a bucket."""
        (
            staged.where(F.col("action").isin(INSERTED, UPDATED))
            .select(*self.schema.names, "bucket")
            .repartition(buckets, self.key)
            .write.option("compression", COMPRESSION)
            .partitionBy("bucket")
            .parquet(f"{self.root}/data/{folder}")
        )

    def _write_survivors(
        self, staged: DataFrame, folder: str, pieces: list[Piece], n_keys: int, buckets: int, merge: bool
    ) -> None:
        """Copy the untouched rows of the rewritten pieces."""
        survivors = self._survivors(staged, pieces, n_keys, buckets, merge).select(*self.schema.names, "bucket")
        survivors.write.option("compression", COMPRESSION).partitionBy("bucket").parquet(f"{self.root}/data/{folder}")

    def _write_survivors_apart(self, touched: list[Row], folder: str, pieces: list[Piece], buckets: int) -> None:
        """Copy the untouched rows of the rewritten pieces, each bucket in a task, for a large change set.

        A bucket's pieces and the files with its keys are known, so no row is shuffled: a task reads both.
        """
        number = min(piece.buckets for piece in pieces)
        rewritten = {n: [p for p in pieces if p.bucket % number == n] for n in sorted({p.bucket % number for p in pieces})}
        schema = T.StructType([self.schema[self.key], T.StructField("action", T.StringType())])
        parts = []
        for n, own in rewritten.items():
            files = [file for file in touched if file["n_rewrite"] and file["bucket"] % number == n]
            rows = self._rows(own).withColumn("bucket", self.bucket(F.col(self.key), buckets)).coalesce(1)
            if files:
                keys = read_parquet(self.spark, sorted({file["path"] for file in files}), schema)
                keys = keys.where(F.col("action").isin(UPDATED, DELETED)).select(F.col(self.key).alias("_gone")).coalesce(1)
                # Few enough are held in the task, more are sorted.
                few = sum(file["n_rewrite"] for file in files) <= TASK_KEYS
                # No anti join: Spark would push it below coalesce and shuffle both sides.
                keys = keys.hint("shuffle_hash" if few else "merge")
                rows = rows.join(keys, F.col(self.key) == F.col("_gone"), "left").where(F.col("_gone").isNull())
            parts.append(rows.select(*self.schema.names, "bucket"))
        for at in range(0, len(parts), PARTS):
            rows = reduce(DataFrame.unionByName, parts[at : at + PARTS])
            rows.write.mode("append").option("compression", COMPRESSION).partitionBy("bucket").parquet(
                f"{self.root}/data/{folder}"
            )

    def _survivors(
        self, staged: DataFrame, pieces: list[Piece], n_keys: int, buckets: int, merge: bool
    ) -> DataFrame:
        """The untouched rows of some pieces, dealt to tasks such that buckets get few files.

        With a bounded change set and nothing to merge, the rows never leave the task that reads them. With a
        larger one they are shuffled once, by key, which puts a bucket's rows into few tasks; a join keeps that
        unless the session's shuffles are wider. The join holds a task's keys and sorts no rows.
        """
        keys = staged.where(F.col("action").isin(UPDATED, DELETED)).select(self.key)
        rows = self._rows(pieces).withColumn("bucket", self.bucket(F.col(self.key), buckets))
        if n_keys <= BROADCAST_KEYS:
            survivors = rows.join(F.broadcast(keys), self.key, "left_anti")
            return survivors.repartition("bucket") if merge else survivors
        if buckets < int(self.spark.conf.get("spark.sql.shuffle.partitions")):
            return rows.join(keys, self.key, "left_anti").repartition("bucket")
        split = min(sum(piece.size for piece in pieces) // (buckets * TASK_BYTES) + 1, PIECES // 2)
        return rows.repartition(buckets * split, self.key).join(keys.hint("shuffle_hash"), self.key, "left_anti")

    def _written(self, folder: str, buckets: int) -> list[Piece]:
        """The files of a folder that hold rows."""
        schema = T.StructType([T.StructField("bucket", T.IntegerType())])
        rows = self.spark.read.schema(schema).parquet(f"{self.root}/data/{folder}")
        files = rows.select("bucket", "_metadata.file_path", "_metadata.file_size").distinct().collect()
        return [
            Piece(r["bucket"], buckets, r["file_path"].rsplit("/data/", 1)[1], r["file_size"]) for r in files
        ]

    def _write_manifest(self, pieces: list[Piece]) -> str:
        name = uuid.uuid4().hex
        rows = self.spark.createDataFrame(sorted(pieces), _MANIFEST).coalesce(1)
        rows.write.parquet(f"{self.root}/manifests/{name}")
        return name

    def _publish(self, snapshot: Snapshot) -> bool:
        """Let the commit file appear; False if another writer has taken the version."""
        row = {name: getattr(snapshot, name) for name in COMMIT.names}
        row["committed_at"] = row["committed_at"].isoformat() + "Z"
        return create_file(
            self.spark, f"{self.root}/commits/{snapshot.version:012d}.json", json.dumps(row) + "\n"
        )
