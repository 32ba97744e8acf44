"""Version logs and snapshot reads; published versions of whole tables."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A version is milliseconds since 1970 times 2^18, plus a counter.
COUNTER_BITS = 18


def version_of(timestamp: Column) -> Column:
    """The first version of a timestamp (with time zone)."""
    return F.shiftleft(F.unix_millis(timestamp), COUNTER_BITS)


def timestamp_of(version: Column) -> Column:
    return F.timestamp_millis(F.shiftright(version, COUNTER_BITS))


def as_of(
    log: DataFrame,
    key: Sequence[str],
    version: int | None = None,
    timestamp: str | None = None,
    version_col: str = "commit_version",
    sequence: Sequence[str] = (),
    change_col: str = "_change_type",
) -> DataFrame:
    """The table's rows at a version, else at a timestamp (ISO, with zone), else now: the latest change of each key, without deletes.

    One partial aggregation by key; nothing is sorted.
    """
    if version is not None:
        log = log.filter(F.col(version_col) <= F.lit(version))
    elif timestamp is not None:
        log = log.filter(F.col(version_col) <= version_of(F.to_timestamp(F.lit(timestamp))))
    whole = F.struct(*[F.col(c) for c in log.columns if c not in key])
    latest = log.groupBy(*key).agg(F.max_by(whole, F.struct(version_col, *sequence)).alias("_row")).filter(F.col(f"_row.{change_col}") != "delete")
    return latest.select(*[F.col(c) if c in key else F.col(f"_row.{c}").alias(c) for c in log.columns])


def with_metadata(rows: DataFrame, source: str = "SNAPSHOT", version_col: str = "commit_version", names: dict[str, str] | None = None) -> DataFrame:
    """Appends commit_version, commit_timestamp and source_event, by other names if wanted. Such a frame is read-only."""
    names = names or {}
    made = {"commit_version": F.col(version_col), "commit_timestamp": timestamp_of(F.col(version_col)), "source_event": F.lit(source)}
    base = rows.select(*[c for c in rows.columns if c != version_col], *[v.alias(names.get(k, k)) for k, v in made.items()])
    return base


#: The column of a row's layer while layers are read.
_LAYER = "_layer"
#: Seconds after which a claim without a version is that of a writer that has died.
CLAIM_SECONDS = 3600


class Conflict(ValueError):
    """Another writer published a version meanwhile."""


class VersionedTable:
    """A table as layers of Parquet folders, and for each version a manifest of the layers it consists of.

    A write adds a layer: the rows it puts, and for keys the values whose rows
    in earlier layers go. So an append writes the appended rows only, and an
    upsert its rows and keys. A read leaves out rows that a later layer has
    taken away, by one join for each kind of key and none for tables that were
    only appended to. ``compact`` rewrites the rows as one layer.

    A reader sees a version whole or not at all. Publishing claims the version
    before it by a file that only one writer can create; a failed write leaves
    folders that no manifest names, which ``expire`` deletes.
    """

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")
        jvm = spark._jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self.fs = self._path(self.path).getFileSystem(spark._jsc.hadoopConfiguration())

    def versions(self) -> list[int]:
        place = self._path(f"{self.path}/_manifests")
        if not self.fs.exists(place):
            return []
        return sorted(int(f.getPath().getName().split(".")[0]) for f in self.fs.listStatus(place) if f.getPath().getName().endswith(".json"))

    def manifest(self, version: int | None = None) -> dict:
        """What was published with the newest version not after the given one."""
        fit = [v for v in self.versions() if version is None or v <= version]
        if not fit:
            raise ValueError(f"{self.path} has no version" + ("" if version is None else f" up to {version}"))
        return json.loads(self.spark.read.text(f"{self.path}/_manifests/{fit[-1]:020d}.json").first()[0])

    def read(self, version: int | None = None) -> DataFrame:
        """The newest version not after the given one. Filters on the rows reach the scans of all layers."""
        found = self.manifest(version)
        reader, layers = self.spark.read.schema(found["schema"]), found["layers"]
        gone = [(i, kind) for i, layer in enumerate(layers) for kind in layer["gone"]]
        last = max((i for i, _ in gone), default=-1)  # layers from there on lose nothing
        paths = lambda some: [f"{self.path}/{x['data']}" for x in some]
        if last < 0:
            return self._of(reader, paths(layers), found)
        parts = [self._of(reader, [path], found).withColumn(_LAYER, F.lit(i)) for i, path in enumerate(paths(layers[:last]))]
        old = reduce(DataFrame.unionByName, parts) if parts else None
        for kind in sorted({tuple(k["key"]) for _, k in gone}):
            if old is None:
                break
            keys = reduce(DataFrame.unionByName, [self.spark.read.schema(k["schema"]).parquet(f"{self.path}/{k['data']}").withColumn("_by", F.lit(i)) for i, k in gone if tuple(k["key"]) == kind])
            newest = keys.groupBy(*[F.col(c).alias(f"_k_{c}") for c in kind]).agg(F.max("_by").alias("_by"))
            on = reduce(lambda a, b: a & b, [F.col(c) == F.col(f"_k_{c}") for c in kind]) & (F.col("_by") > F.col(_LAYER))
            old = old.join(newest, on, "left_anti")
        new = self._of(reader, paths(layers[last:]), found)
        return new if old is None else old.drop(_LAYER).unionByName(new)

    def scans(self) -> int:
        """How many scans a read takes: layers that were only appended to, without partitions, are one."""
        held = self.manifest()
        if held["partition_by"]:
            return len(held["layers"])
        return 1 + max((i for i, layer in enumerate(held["layers"]) if layer["gone"]), default=0)

    def _of(self, reader, paths: list[str], manifest: dict) -> DataFrame:
        if not manifest.get("partition_by"):
            return reader.parquet(*paths)
        # folders of partitions stand below each layer, and Spark wants one base for all of a scan
        return reduce(DataFrame.unionByName, [reader.parquet(p) for p in paths])

    def commit(self, rows: DataFrame, version: int, partition_by: Sequence[str] = (), expected: int | None = None, notes: dict | None = None) -> None:
        """Publishes the rows as all of the table, as a version greater than all others, with notes for whoever reads its manifest."""
        self._publish(rows, {}, version, partition_by, expected, notes, fresh=True)

    def add(
        self, rows: DataFrame, version: int, gone: dict[tuple[str, ...], DataFrame] | None = None, partition_by: Sequence[str] = (), expected: int | None = None, notes: dict | None = None
    ) -> None:
        """Publishes the version before with these rows added; gone: by key, the values whose rows go from what was there before."""
        self._publish(rows, gone or {}, version, partition_by, expected, notes, fresh=False)

    def compact(self, version: int, partition_by: Sequence[str] = ()) -> None:
        """The newest rows as one layer."""
        held = self.manifest()
        notes = {k: v for k, v in held.items() if k not in ("version", "layers", "schema", "partition_by")}
        self.commit(self.read(), version, partition_by or held["partition_by"], held["version"], notes)

    def _publish(self, rows, gone, version, partition_by, expected, notes, fresh) -> None:
        before = self.versions()
        base = before[-1] if before else 0
        if before and version <= base or expected is not None and base != expected:
            raise Conflict(f"version {version} can't follow {before[-1:] or 'none'}")
        layers = [] if fresh or not before else self.manifest(base)["layers"]
        name = f"{version:020d}-{uuid.uuid4().hex}"
        made = [f"data-{name}"]
        rows.write.partitionBy(*partition_by).parquet(f"{self.path}/{made[0]}")
        taken = []
        for i, (key, values) in enumerate(gone.items()):
            made.append(f"gone-{i}-{name}")
            values = values.select(*key).filter(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in key])).distinct()
            values.write.parquet(f"{self.path}/{made[-1]}")
            taken.append({"key": list(key), "data": made[-1], "schema": _ddl(values)})
        entry = {"version": version, "layers": [*layers, {"data": made[0], "gone": taken}], "schema": _ddl(rows), "partition_by": list(partition_by), **(notes or {})}
        self.fs.mkdirs(self._path(f"{self.path}/_manifests"))
        staged = self._path(f"{self.path}/_staged-{uuid.uuid4().hex}")
        out = self.fs.create(staged)
        out.write(bytearray(json.dumps(entry).encode()))
        out.close()
        final, claim = self._path(f"{self.path}/_manifests/{version:020d}.json"), self._path(f"{self.path}/_claims/{base:020d}")
        owned = self._claim(claim, base)
        if not owned or self.fs.exists(final) or not self.fs.rename(staged, final):
            if owned:
                self.fs.delete(claim, False)
            self.fs.delete(staged, False)
            for one in made:
                self.fs.delete(self._path(f"{self.path}/{one}"), True)
            raise Conflict(f"another writer published a version after {base}")

    def _claim(self, place, base: int) -> bool:
        """Whether this writer may publish what follows the base version: true for one only."""
        if self.fs.exists(place) and self.versions()[-1:] in ([], [base]) and time.time() - self.fs.getFileStatus(place).getModificationTime() / 1000 > CLAIM_SECONDS:
            self.fs.delete(place, False)  # its writer died before it published
        if self.fs.getUri().getScheme() == "file":  # create() looks first and makes the file then; this is one step
            self.fs.mkdirs(place.getParent())
            won = self.spark._jvm.java.io.File(place.toUri().getPath()).createNewFile()
        else:
            try:
                self.fs.create(place, False).close()
                won = True
            except Py4JJavaError:
                won = False
        if won and self.versions()[-1:] not in ([], [base]):  # published and expired in between
            self.fs.delete(place, False)
            won = False
        return bool(won)

    def expire(self, keep: int) -> None:
        """Keeps the newest ``keep`` versions; deletes manifests, claims and folders that none of them needs."""
        if keep < 1:
            raise ValueError("one version has to stay")
        held = self.versions()
        stay = held[-keep:]
        needed = {name for v in stay for layer in self.manifest(v)["layers"] for name in (layer["data"], *(g["data"] for g in layer["gone"]))}
        for v in held[:-keep]:
            self.fs.delete(self._path(f"{self.path}/_claims/{v:020d}"), False)
            self.fs.delete(self._path(f"{self.path}/_manifests/{v:020d}.json"), False)
        for found in self.fs.listStatus(self._path(self.path)):
            name = found.getPath().getName()
            old = time.time() - found.getModificationTime() / 1000 > CLAIM_SECONDS or any(f"{v:020d}" in name for v in held)
            if name.startswith(("data-", "gone-", "_staged-")) and name not in needed and old:
                self.fs.delete(found.getPath(), True)


def _ddl(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
