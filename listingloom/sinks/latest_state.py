"""The newest row per key as a stored state that feeds are added to one by one.

Rows lie in buckets by source and hash of the key, a folder for each. Adding a feed
reads and rewrites the buckets that its rows fall into, nothing else; rows without
a key are versions of nothing, so they only ever add a folder. A manifest names the
folders that count. It is written last and under a new number, so a state is seen
before or after a feed and never half way, and a run that fails leaves folders that
no manifest names.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from listingloom.operators.dedup import latest_one
from listingloom.storage import CODEC, shuffles_freed

BUCKETS = 64
#: The bucket of rows without a key.
KEYLESS = -1
BUCKET, VALUE = "_bucket", "_by"


@dataclass(frozen=True)
class Manifest:
    """``parts`` are (value, bucket, folder); there is one folder per bucket, any number for keyless rows."""

    version: int
    buckets: int
    parts: tuple[tuple[str | None, int, str], ...]
    #: Rows that all feeds so far have brought, by value.
    rows_read: tuple[tuple[str | None, int], ...] = ()


class LatestState:
    """A state below ``root``: the newest row per ``by`` and ``key``.

    ``by`` is the column that parts the state first (the source: a feed of one
    source touches its buckets alone), ``time`` orders versions and ``tie_breaks``
    settle the rest, as in :func:`latest_one`. The number of buckets is fixed by the
    first feed.
    """

    def __init__(
        self, spark: SparkSession, root: str, by: str, key: str, time: str, tie_breaks: list[Column], buckets: int = BUCKETS
    ) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.by, self.key, self.time, self.tie_breaks, self.buckets = by, key, time, tie_breaks, buckets
        self._hadoop = spark._jvm.org.apache.hadoop.fs

    # --- manifests ------------------------------------------------------------

    def _path(self, name: str):
        path = self._hadoop.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        folder, system = self._path("manifests")
        if not system.exists(folder):
            return []
        names = [status.getPath().getName() for status in system.listStatus(folder)]
        return sorted(int(n.split(".")[0]) for n in names if n.endswith(".json") and n.split(".")[0].isdigit())

    def manifest(self, version: int | None = None) -> Manifest:
        """The manifest of a version, by default the newest; an empty one before the first feed."""
        known = self.versions()
        if not known:
            return Manifest(0, self.buckets, ())
        version = known[-1] if version is None else version
        text = self.spark.read.option("wholetext", True).text(f"{self.root}/manifests/{version:010d}.json").first()[0]
        found = json.loads(text)
        return Manifest(
            version, found["buckets"], tuple(map(tuple, found["parts"])), tuple(map(tuple, found["rows_read"]))
        )

    def _publish(self, manifest: Manifest) -> None:
        """Writes the manifest under its number, in one step. Fails if another run took that number."""
        body = {"buckets": manifest.buckets, "parts": manifest.parts, "rows_read": manifest.rows_read}
        draft, system = self._path(f"manifests/.{uuid.uuid4().hex}")
        out = system.create(draft, False)
        out.write(bytearray(json.dumps(body, ensure_ascii=False).encode()))
        out.close()
        final, _ = self._path(f"manifests/{manifest.version:010d}.json")
        if system.exists(final) or not system.rename(draft, final):
            system.delete(draft, False)
            raise RuntimeError(f"version {manifest.version} of {self.root} was written by another run; add the feed again")

    # --- rows -----------------------------------------------------------------

    def read(self, version: int | None = None) -> DataFrame | None:
        """All rows of a version, by default the newest; None before the first feed."""
        manifest = self.manifest(version)
        return self._rows([folder for _, _, folder in manifest.parts])

    def _rows(self, folders: list[str]) -> DataFrame | None:
        if not folders:
            return None
        return self.spark.read.option("mergeSchema", True).parquet(*[f"{self.root}/{f}" for f in folders])

    def add(self, rows: DataFrame, rows_read: dict[str | None, int] | None = None) -> Manifest:
        """Adds a feed's rows (each in any number of versions) and returns the new manifest.

        The feed is reduced to its own newest rows first. Only those, and the
        buckets that they fall into, are shuffled and written. ``rows_read`` is
        added to what the manifest says of earlier feeds.
        """
        before = self.manifest()
        total = dict(before.rows_read)
        for value, count in (rows_read or {}).items():
            total[value] = total.get(value, 0) + count
        keyed = F.col(self.key).isNotNull()
        bucket = F.when(keyed, F.pmod(F.xxhash64(F.col(self.key)), F.lit(before.buckets))).otherwise(KEYLESS)
        own = latest_one(rows.where(keyed), [self.by, self.key], self.time, self.tie_breaks)
        new = own.unionByName(rows.where(~keyed)).withColumn(BUCKET, bucket.cast("int")).withColumn(VALUE, F.col(self.by))

        folder = f"data/{before.version + 1:010d}-{uuid.uuid4().hex}"
        fresh = f"{folder}/feed"
        # The feed's rows by bucket: what is touched is then known from the folders' names.
        self._write(new, fresh)
        touched = self._folders(fresh)
        old = {(value, number): path for value, number, path in before.parts if number != KEYLESS}
        merge = {at: path for at, path in touched.items() if at in old}
        parts = [part for part in before.parts if part[1] == KEYLESS or (part[0], part[1]) not in touched]
        parts += [(*at, path) for at, path in touched.items() if at not in merge]
        if merge:
            both = self._rows([path for at in merge for path in (merge[at], old[at])])
            newest = latest_one(both, [self.by, self.key], self.time, self.tie_breaks)
            merged = newest.withColumn(BUCKET, bucket.cast("int")).withColumn(VALUE, F.col(self.by))
            self._write(merged, f"{folder}/merged")
            parts += [(*at, path) for at, path in self._folders(f"{folder}/merged").items()]
        after = Manifest(before.version + 1, before.buckets, tuple(sorted(parts, key=repr)), tuple(total.items()))
        self._publish(after)
        # What has been merged no manifest has ever named.
        for part in merge.values():
            path, system = self._path(part)
            system.delete(path, True)
        return after

    def _write(self, rows: DataFrame, folder: str) -> None:
        dealt = rows.hint("rebalance", F.col(VALUE), F.col(BUCKET))
        with shuffles_freed(self.spark):
            dealt.write.option("compression", CODEC).partitionBy(VALUE, BUCKET).parquet(f"{self.root}/{folder}")

    def _folders(self, folder: str) -> dict[tuple[str | None, int], str]:
        """Folders of a write by value and bucket, from the names that it gave them."""
        base, system = self._path(folder)
        unescape = self.spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
        found = {}
        for outer in system.listStatus(base):
            name = outer.getPath().getName()
            if not name.startswith(f"{VALUE}="):
                continue
            value = unescape(name.split("=", 1)[1])
            value = None if value == "__HIVE_DEFAULT_PARTITION__" else value
            for inner in system.listStatus(outer.getPath()):
                number = inner.getPath().getName()
                if number.startswith(f"{BUCKET}="):
                    found[value, int(number.split("=", 1)[1])] = f"{folder}/{name}/{number}"
        return found

    def expire(self, keep: int = 2) -> list[str]:
        """Deletes manifests but the newest ``keep`` and the data folders that none of these names.

        Only between runs: a run under way has folders that no manifest names yet.
        """
        known = self.versions()
        stay = [self.manifest(v) for v in known[-keep:]]
        named = {folder.split("/")[1] for m in stay for _, _, folder in m.parts}
        for version in known[:-keep]:
            path, system = self._path(f"manifests/{version:010d}.json")
            system.delete(path, False)
        gone = []
        folder, system = self._path("data")
        for status in system.listStatus(folder) if system.exists(folder) else []:
            if status.getPath().getName() not in named:
                gone.append(status.getPath().getName())
                system.delete(status.getPath(), True)
        return gone
