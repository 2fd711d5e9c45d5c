"""Environments without copies: a manifest names the files of each bucket of entities, and the digest of what is in them.

Entities are dealt to buckets by their model (fields and fieldsets lie with it), by their kind (menus, the site and roles, which a
plan needs as a whole), or by themselves. A bucket whose digest any environment has already isn't written again. A fork is
another manifest; an environment takes another one's place by one rename; two environments differ at most in the buckets
whose digests do. Folders: data/save=<name>/bucket=<n>/kind=<kind>/ and manifests/<environment>.json.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.canonical import canonical_values
from .folders import shared_folder

BUCKETS = 64
WHOLE = ("menu_item", "schema_menu_item", "site", "role")
_VALUES = ("attributes", "relationships", "meta")
_COLUMNS = ("id", "ord", "owner", *_VALUES)
SCHEMA = "id string, ord long, owner string, attributes map<string,string>, relationships map<string,string>, meta map<string,string>, save string, bucket int, kind string"


def _bucket(n: int) -> Column:
    kind = F.col("kind")
    key = F.when(kind == "item_type", F.concat(F.lit("model:"), "id")).when(kind.isin("field", "fieldset"), F.concat(F.lit("model:"), F.coalesce("owner", F.lit("")))).when(kind.isin(*WHOLE), kind).otherwise(F.concat_ws(":", "kind", "id"))
    return F.pmod(F.xxhash64(key), F.lit(n)).cast("int")


def _digest() -> Column:
    """120 bits of the bucket's rows, in whatever order, and their number."""
    values = [F.array_sort(F.map_entries(F.col(c))).alias(c) for c in _VALUES]
    row = F.md5(F.to_json(F.struct("kind", "id", "ord", "owner", *values)).cast("binary"))
    half = lambda at: F.bit_xor(F.conv(F.substring(row, at, 15), 16, 10).cast("long"))
    return F.concat_ws("-", half(1), half(17), F.count("*"))


class _Store:
    """Manifests in the file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.top, self.jvm = spark, f"{path.rstrip('/')}/manifests", spark.sparkContext._jvm
        self.files = self.path().getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, env: str | None = None):
        return self.jvm.org.apache.hadoop.fs.Path(self.top if env is None else f"{self.top}/{env}.json")

    def names(self) -> list[str]:
        if not self.files.exists(self.path()):
            return []
        found = [f.getPath().getName() for f in self.files.listStatus(self.path())]
        return sorted(n.removesuffix(".json") for n in found if n.endswith(".json") and not n.startswith((".", "_")))

    def read(self, env: str) -> dict:
        if not self.files.exists(self.path(env)):
            raise ValueError(f"there is no environment {env}")
        return json.loads(self.spark.read.option("wholetext", True).text(self.path(env).toString()).first()[0])

    def write(self, env: str, manifest: dict) -> None:
        """In one step: readers see the manifest that was there or this one."""
        waiting = self.jvm.org.apache.hadoop.fs.Path(f"{self.top}/.{uuid.uuid4().hex}")
        out = self.files.create(waiting, True)
        out.write(bytearray(json.dumps(manifest).encode()))
        out.close()
        over = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename").OVERWRITE
        options = self.spark.sparkContext._gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
        options[0] = over
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.files.getUri(), self.spark.sparkContext._jsc.hadoopConfiguration())
        context.rename(self.files.makeQualified(waiting), self.files.makeQualified(self.path(env)), options)


def save(entities: DataFrame, path: str, env: str, buckets: int = BUCKETS) -> list[int]:
    """Make ``entities`` what an environment has, in canonical JSON; gives the buckets that had to be written."""
    spark, store = entities.sparkSession, _Store(entities.sparkSession, path)
    shared_folder(spark)
    rows = entities.select("kind", *[canonical_values(F.col(c)).alias(c) if c in _VALUES else F.col(c) for c in _COLUMNS], _bucket(buckets).alias("bucket")).checkpoint()
    digests = {r["bucket"]: r["digest"] for r in rows.groupBy("bucket").agg(_digest().alias("digest")).collect()}
    there = {(digest, m["n"], b): save_ for m in map(store.read, store.names()) for b, (digest, save_) in m["buckets"].items()}
    own = {str(b): [d, there.get((d, buckets, str(b)))] for b, d in digests.items()}
    fresh = sorted(int(b) for b, (_, save_) in own.items() if save_ is None)
    if fresh:
        name = uuid.uuid4().hex
        rows.where(F.col("bucket").isin(fresh)).withColumn("save", F.lit(name)).hint("rebalance", "bucket").write.mode("append").partitionBy("save", "bucket", "kind").parquet(f"{path.rstrip('/')}/data")
        own = {b: [d, save_ or name] for b, (d, save_) in own.items()}
    store.write(env, {"n": buckets, "buckets": own})
    return fresh


def load(spark: SparkSession, path: str, env: str, *kinds: str, buckets: Iterable[int] | None = None) -> DataFrame:
    """An environment's entities, of some kinds or all, and of some buckets or all; nothing else is read."""
    manifest = _Store(spark, path).read(env)
    wanted = None if buckets is None else {str(b) for b in buckets}
    top = f"{path.rstrip('/')}/data"
    folders = [f"{top}/save={save_}/bucket={b}" for b, (_, save_) in manifest["buckets"].items() if wanted is None or b in wanted]
    rows = spark.read.schema(SCHEMA).option("basePath", top).parquet(*folders) if folders else spark.createDataFrame([], SCHEMA)
    return (rows.where(F.col("kind").isin(*kinds)) if kinds else rows).select("kind", *_COLUMNS)


def listed(spark: SparkSession, path: str) -> list[str]:
    return _Store(spark, path).names()


def fork(spark: SparkSession, path: str, env: str, new_env: str) -> None:
    """An environment with what another one has; no entity is read or written."""
    store = _Store(spark, path)
    if new_env in store.names():
        raise ValueError(f"{new_env} is there already")
    store.write(new_env, store.read(env))


def promote(spark: SparkSession, path: str, env: str, primary: str) -> None:
    """What ``env`` has is from now on what ``primary`` has, in one step."""
    store = _Store(spark, path)
    store.write(primary, store.read(env))


def destroy(spark: SparkSession, path: str, env: str) -> None:
    """Forget an environment; files that others have stay, and so do those that none has, until unused ones are deleted."""
    store = _Store(spark, path)
    store.files.delete(store.path(env), False)


def delete_unused(spark: SparkSession, path: str) -> int:
    """Delete the saved buckets that no environment has, and give their number. No save may be under way."""
    store = _Store(spark, path)
    used = {(save_, b) for m in map(store.read, store.names()) for b, (_, save_) in m["buckets"].items()}
    top = store.jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/data")
    gone = 0
    for s in store.files.listStatus(top) if store.files.exists(top) else ():
        for b in store.files.listStatus(s.getPath()) if s.isDirectory() else ():
            key = (s.getPath().getName().removeprefix("save="), b.getPath().getName().removeprefix("bucket="))
            if b.isDirectory() and key not in used:
                store.files.delete(b.getPath(), True)
                gone += 1
    return gone


def differing(spark: SparkSession, path: str, old: str, new: str) -> list[int] | None:
    """The buckets in which two environments may differ; None (all) if they aren't dealt out alike."""
    store = _Store(spark, path)
    a, b = store.read(old), store.read(new)
    if a["n"] != b["n"]:
        return None
    digest = lambda m, k: m["buckets"].get(k, [None])[0]
    return sorted(int(k) for k in {*a["buckets"], *b["buckets"]} if digest(a, k) != digest(b, k))


def needed(buckets: list[int] | None, spark: SparkSession, path: str, *envs: str) -> list[int] | None:
    """``buckets`` and those of the kinds that a plan needs as a whole, changed or not."""
    if buckets is None:
        return None
    n = _Store(spark, path).read(envs[0])["n"]
    whole = spark.createDataFrame([(k, "", None) for k in WHOLE], "kind string, id string, owner string").select(_bucket(n).alias("b")).collect()
    return sorted({*buckets, *(r["b"] for r in whole)})
