"""Tables in layers: loads append files, and a manifest put in place by one rename says which of them are a snapshot."""

from __future__ import annotations

import json
import uuid
from functools import reduce
from typing import Any

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: Layers of one level that a compaction makes one layer of the next.
FANOUT = 4
#: Level of a first load, which the small layers after it reach only when they hold about as many rows.
BASE_LEVEL = 6
#: Most changed keys that are broadcast when a snapshot is read; more are joined by a shuffle.
BROADCAST_KEYS = 500_000


class Conflict(RuntimeError):
    """Another writer has put the next snapshot in place."""


def files(spark: SparkSession, path: str) -> tuple[Any, Any]:
    """The file system of a path, and the path for it."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def renamed(spark: SparkSession, source: str, target: str) -> bool:
    """Move a file or folder to where nothing is, at once; False if something is there."""
    jvm = spark.sparkContext._jvm
    fs, src = files(spark, source)
    dst = files(spark, target)[1]
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.makeQualified(src).toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(src), fs.makeQualified(dst), spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
    except Exception as e:
        if "FileAlreadyExists" in str(e) or fs.exists(dst):
            return False
        raise
    return True


def put_text(spark: SparkSession, path: str, text: str) -> bool:
    """A small file, whole or not at all; False if one is there."""
    fs, at = files(spark, f"{path}.{uuid.uuid4().hex}.part")
    out = fs.create(at, True)
    out.write(bytearray(text.encode()))
    out.close()
    if renamed(spark, at.toString(), path):
        return True
    fs.delete(at, False)
    return False


def get_text(spark: SparkSession, path: str) -> str:
    fs, at = files(spark, path)
    stream = fs.open(at)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


class Layer:
    """Files that a load is writing; they count from `commit` on."""

    def __init__(self, table: Layers, seen: dict, level: int):
        self.table, self.seen, self.level, self.id = table, seen, level, uuid.uuid4().hex
        self.kinds: dict[str, dict] = {}

    def write(self, df: DataFrame, kind: str = "rows") -> DataFrame:
        """Write the rows, the `keys` whose rows they replace, or another frame beside them, and read it back."""
        path = f"{self.table.path}/layers/{self.id}/{kind}"
        by = [self.table.by] if self.table.by and kind == "rows" else []
        df.write.option("compression", "zstd").partitionBy(*by).parquet(path)
        self.kinds[kind] = json.loads(df.schema.json())
        return self.table.spark.read.schema(df.schema).parquet(path)

    def commit(self, **told: Any) -> int:
        """Make the files part of the next snapshot, with what else is told of it; one rename. Conflict if that exists by now."""
        return self.table._put(self.seen, [*self.seen["layers"], self.entry(self.seen["version"] + 1)], told)

    def entry(self, version: int) -> dict:
        """The layer in a manifest: its files, their schemas, and the version that brought its newest rows."""
        return {"id": self.id, "level": self.level, "version": version, "kinds": self.kinds}


class Layers:
    """A table whose rows are found by key columns. A later layer's rows replace all earlier rows of its keys.

    Each layer is a folder: rows (partitioned by `by`), and, if a load names them, the keys that it replaces, which may have no rows any more.
    A snapshot is the newest manifest: the layers that count, oldest first, and what loads told (marks, numbers of batches). Files that no manifest names
    are left from loads that died, and are never read. Readers keep the snapshot that they began with. When FANOUT layers
    of a level are there, `compact` makes one of the next level of them, so a row is rewritten as often as there are levels.
    """

    def __init__(self, spark: SparkSession, path: str, keys: list[str], by: str | None = None):
        self.spark, self.path, self.keys, self.by = spark, path.rstrip("/"), keys, by

    def snapshot(self, version: int | None = None) -> dict:
        """The newest manifest, or that of a version; of a table that isn't there yet, version 0 without layers."""
        if version is not None:
            return json.loads(get_text(self.spark, f"{self.path}/manifests/{version:010d}.json"))
        fs, at = files(self.spark, f"{self.path}/manifests")
        names = [f.getPath().getName() for f in fs.listStatus(at)] if fs.exists(at) else []
        whole = sorted(n for n in names if n.endswith(".json"))
        return json.loads(get_text(self.spark, f"{self.path}/manifests/{whole[-1]}")) if whole else {"version": 0, "layers": [], "told": {}}

    def told(self, name: str, default: Any = None) -> Any:
        return self.snapshot()["told"].get(name, default)

    def begin(self, level: int | None = None) -> Layer:
        """A new layer over the snapshot of now."""
        seen = self.snapshot()
        return Layer(self, seen, level if level is not None else 0 if seen["layers"] else BASE_LEVEL)

    def append(self, rows: DataFrame, **told: Any) -> int:
        """A layer of these rows, which replace those of their keys."""
        layer = self.begin()
        layer.write(rows)
        return layer.commit(**told)

    def read(self, snapshot: dict | None = None) -> DataFrame:
        """The rows of a snapshot: of each key those of its newest layer."""
        return self._newest((snapshot or self.snapshot())["layers"])

    def beside(self, kind: str, snapshot: dict | None = None) -> DataFrame | None:
        """What all layers have beside their rows; None if nothing."""
        frames = [self._frame(x, kind) for x in (snapshot or self.snapshot())["layers"]]
        return reduce(DataFrame.unionByName, [f for f in frames if f is not None]) if any(f is not None for f in frames) else None

    def changed(self, since: int, snapshot: dict | None = None) -> DataFrame | None:
        """The keys that layers after version `since` replace, once each; None if there is no such layer. A compacted layer counts as its newest."""
        later = [x for x in (snapshot or self.snapshot())["layers"] if x["version"] > since]
        return reduce(DataFrame.unionByName, [self._keys(x) for x in later]).distinct() if later else None

    def compact(self) -> int:
        """Merge layers until no level has FANOUT; returns how many merges that took. A merge that another writer overtakes is left out."""
        merges = 0
        while True:
            seen = self.snapshot()
            levels = [x["level"] for x in seen["layers"]]
            full = [n for n in sorted(set(levels)) if levels.count(n) >= FANOUT]
            if not full:
                return merges
            group = [x for x in seen["layers"] if x["level"] == full[0]]
            layer = Layer(self, seen, full[0] + 1)
            layer.write(self._newest(group))
            first = group[0] is seen["layers"][0]
            for kind in {k for x in group for k in x["kinds"]} - {"rows"} | (set() if first else {"keys"}):
                frames = [self._keys(x) if kind == "keys" else self._frame(x, kind) for x in group]
                layer.write(reduce(DataFrame.unionByName, [f for f in frames if f is not None]).distinct(), kind)
            own, at = layer.entry(group[-1]["version"]), seen["layers"].index(group[0])
            rest = [x for x in seen["layers"] if x not in group]
            try:
                self._put(seen, [*rest[:at], own, *rest[at:]], {})
            except Conflict:
                return merges
            merges += 1

    def vacuum(self) -> None:
        """Delete manifests but the newest, and layers that it doesn't name; only while nobody reads older snapshots or writes."""
        seen = self.snapshot()
        for folder, kept in (("manifests", {f"{seen['version']:010d}.json"}), ("layers", {x["id"] for x in seen["layers"]})):
            fs, at = files(self.spark, f"{self.path}/{folder}")
            for f in fs.listStatus(at) if fs.exists(at) else []:
                if f.getPath().getName() not in kept:
                    fs.delete(f.getPath(), True)

    def _put(self, seen: dict, layers: list[dict], told: dict) -> int:
        version = seen["version"] + 1
        manifest = {"version": version, "layers": layers, "told": seen["told"] | told}
        if not put_text(self.spark, f"{self.path}/manifests/{version:010d}.json", json.dumps(manifest)):
            raise Conflict(f"version {version} of {self.path} is there already")
        return version

    def _frame(self, layer: dict, kind: str) -> DataFrame | None:
        schema = layer["kinds"].get(kind)
        return self.spark.read.schema(StructType.fromJson(schema)).parquet(f"{self.path}/layers/{layer['id']}/{kind}") if schema else None

    def _keys(self, layer: dict) -> DataFrame:
        named = self._frame(layer, "keys")
        return (named if named is not None else self._frame(layer, "rows")).select(*self.keys).distinct()

    def _newest(self, layers: list[dict]) -> DataFrame:
        if not layers:
            raise ValueError(f"{self.path} has no rows yet")
        rows = [self._frame(x, "rows") for x in layers]
        if len(layers) == 1:
            return rows[0]
        *older, last = [r.withColumn("_layer", F.lit(k)) for k, r in enumerate(rows)]  # the last layer's rows are all newest
        union = lambda frames: reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
        named = [self._keys(x).withColumn("_layer", F.lit(k)) for k, x in enumerate(layers)]
        keys = union(named[1:])
        newest = keys.groupBy(*self.keys).agg(F.max("_layer").alias("_newest"))
        stays = F.coalesce("_newest", "_layer") == F.col("_layer")
        few = lambda df: df.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
        if few(keys):
            met = union(older).join(F.broadcast(newest), self.keys, "left").where(stays).drop("_newest")
        else:  # most keys came again: those that didn't may be few, and rows go where they lie
            left = union(named[:-1]).join(newest, self.keys, "left").where(stays).drop("_newest")
            met = union(older).join(F.broadcast(left) if few(left) else left, [*self.keys, "_layer"], "left_semi")
        return union([met, last]).drop("_layer")
