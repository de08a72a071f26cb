"""Products as a table of versions: a build is written beside the others and published at once.

path/data/build=<id>/station_id=../variable=../year=..   what builds have written, never changed
path/manifests/<number>-<id>                             all products of one version, each with the build that it is from
path/commits/<number>                                    the id of the build that made a version; the highest one is current

Only the commit file publishes.  It is created only if nobody has, and counts once it has its content, so a reader
sees one version as a whole, a build that dies half-way leaves the last one as it was, and of two builds at once
one has to start again.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .build import KEYS

#: An empty commit file of this age is of a build that died as it published.
ABANDONED_MS = 600_000


class ConcurrentBuild(Exception):
    """Another build has published since this one began."""


@dataclass(frozen=True)
class VersionedProducts:
    spark: SparkSession
    path: str

    def _at(self, *parts: str):
        where = self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.path, *parts]))
        return where.getFileSystem(self.spark._jsc.hadoopConfiguration()), where

    def _commits(self) -> dict[int, tuple[int, int]]:
        """Number -> (length, time of change in ms) of the commit files."""
        fs, where = self._at("commits")
        found = fs.listStatus(where) if fs.exists(where) else []
        return {int(s.getPath().getName()): (s.getLen(), s.getModificationTime()) for s in found if s.getPath().getName().isdigit()}

    def versions(self) -> list[int]:
        """Numbers of the published versions, the oldest first."""
        return sorted(n for n, (length, _) in self._commits().items() if length)

    def _manifest_path(self, version: int) -> str:
        fs, commit = self._at("commits", f"{version:010d}")
        content = fs.open(commit)
        try:
            return f"{self.path}/manifests/{version:010d}-{content.readLine()}"
        finally:
            content.close()

    def manifest(self, version: int | None = None) -> DataFrame | None:
        """The manifest of a version, the current one by default; None before the first."""
        known = self.versions()
        if not known or version is not None and version not in known:
            return None
        return self.spark.read.parquet(self._manifest_path(known[-1] if version is None else version))

    def read(self, version: int | None = None) -> DataFrame | None:
        """The series of a version.  Folders of other builds are pruned through the manifest."""
        m = self.manifest(version)
        if m is None:
            return None
        data = self.spark.read.parquet(f"{self.path}/data")
        return data.join(m.select("build", *KEYS).filter("build is not null"), ["build", *KEYS], "left_semi").drop("build")

    def commit(self, series: DataFrame, manifest: DataFrame, scope: DataFrame) -> int:
        """Publish series (station_id, variable, year, ...) and their manifest; the new version's number.

        scope: the station-years (station_id, year) that were rebuilt.  Products that they no longer make leave the
        version with this; all others stay as they are.
        """
        build, known = uuid.uuid4().hex, self.versions()
        base = known[-1] if known else 0
        number = max(self._commits(), default=0) + 1
        series.withColumn("build", F.lit(build)).repartition("build", *KEYS).write.mode("append").partitionBy("build", *KEYS).parquet(f"{self.path}/data")
        new = manifest.withColumn("build", F.lit(build))
        old = self.manifest(base) if base else None
        if old is not None:
            new = old.join(scope.select("station_id", "year").distinct(), ["station_id", "year"], "left_anti").unionByName(new, allowMissingColumns=True)
        new.write.parquet(f"{self.path}/manifests/{number:010d}-{build}")
        self._publish(number, build, base)
        return number

    def _publish(self, number: int, build: str, base: int) -> None:
        fs, commit = self._at("commits", f"{number:010d}")
        try:
            out = fs.create(commit, False)  # fails where the file is there already
        except Exception as e:
            if fs.exists(commit):
                raise ConcurrentBuild(f"version {number} is there already") from e
            raise
        now = fs.getFileStatus(commit).getModificationTime()
        between = [n for n, (length, at) in self._commits().items() if base < n < number and (length or now - at < ABANDONED_MS)]
        if not between:
            out.writeBytes(build)
        out.close()
        if between:
            fs.delete(commit, False)
            raise ConcurrentBuild(f"version {min(between)} was published meanwhile")

    def remove_unused(self, keep: int = 1) -> int:
        """Delete folders of data that none of the last `keep` versions refers to, and older versions; how many folders went.

        Not for while a build is under way: what it has written is not referred to yet.  Spark finds the folders; the driver
        asks the file system to drop one after the other and holds one name at a time.
        """
        known = self.versions()
        stay, go = known[-keep:], known[:-keep]
        if not stay:
            return 0
        used = self.manifest(stay[0]).select("build", *KEYS)
        for v in stay[1:]:
            used = used.unionByName(self.manifest(v).select("build", *KEYS))
        files = self.spark.read.parquet(f"{self.path}/data").select("build", *KEYS, F.col("_metadata.file_path").alias("f")).distinct()
        unused = files.join(used.distinct(), ["build", *KEYS], "left_anti").select(F.regexp_replace("f", "/[^/]*$", "").alias("folder")).distinct()
        n = 0
        for r in unused.toLocalIterator():
            where = self.spark._jvm.org.apache.hadoop.fs.Path(self.spark._jvm.java.net.URI(r.folder))  # as Spark writes it: escaped once more as a URI
            n += bool(where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True))
        for v in go:
            made = self._manifest_path(v)
            fs, commit = self._at("commits", f"{v:010d}")
            fs.delete(commit, False)
            fs.delete(self.spark._jvm.org.apache.hadoop.fs.Path(made), True)
        return n
