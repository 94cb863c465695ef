"""Tables that are replaced as a whole: new files first, then one small manifest that makes them the table.

A table is a folder with data folders and numbered manifests. A manifest names the data folders of its version; the
highest number is the table. Writers never touch files that a manifest names, so a table can be rewritten from itself,
readers keep what they began with, and a job that fails leaves the old version. Two writers that start from one version
cannot both succeed: the second finds its number taken.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from qaspark.fixed_values import CACHE_TTL_DAYS
from qaspark.operators.ranking import first_per_key
from qaspark.session import delete_table, write_through

_MANIFEST = "manifest-"


class Refused(Exception):
    """A version that was written but did not pass its check; the table is as it was."""


class Conflict(Exception):
    """Another writer has made the next version first."""


def _file_system(spark: SparkSession, root: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    return hadoop, hadoop.Path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, root: str) -> list[int]:
    """The numbers of all versions that can be read, oldest first."""
    hadoop, files = _file_system(spark, root)
    if not files.exists(hadoop.Path(root)):
        return []
    names = [s.getPath().getName() for s in files.listStatus(hadoop.Path(root))]
    return sorted(int(n[len(_MANIFEST) :]) for n in names if n.startswith(_MANIFEST) and n[len(_MANIFEST) :].isdigit())


def _manifest(spark: SparkSession, root: str, version: int | None = None) -> dict:
    known = versions(spark, root)
    if not known or (version is not None and version not in known):
        raise FileNotFoundError(f"{root} has no version {'at all' if version is None else version}")
    path = f"{root}/{_MANIFEST}{known[-1] if version is None else version}"
    return json.loads("".join(r[0] for r in spark.read.text(path, wholetext=True).collect()))


def _commit(spark: SparkSession, root: str, manifest: dict) -> int:
    """Make ``manifest`` the table: write it under a name of its own, then rename it, which fails if the number is taken."""
    hadoop, files = _file_system(spark, root)
    draft = hadoop.Path(f"{root}/_draft-{uuid.uuid4().hex}")
    out = files.create(draft, False)
    out.write(bytearray(json.dumps(manifest).encode()))
    out.close()
    context = hadoop.FileContext.getFileContext(draft.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    keep_existing = spark.sparkContext._gateway.new_array(hadoop.Options.Rename, 0)
    try:
        context.rename(draft, hadoop.Path(f"{root}/{_MANIFEST}{manifest['version']}"), keep_existing)
    except Exception as problem:
        files.delete(draft, False)
        if manifest["version"] in versions(spark, root):
            raise Conflict(f"version {manifest['version']} of {root} was made by another writer") from problem
        raise
    return manifest["version"]


def _read(spark: SparkSession, root: str, manifest: dict, parts: list[str] | None = None) -> DataFrame:
    schema = StructType.fromJson(manifest["schema"])
    folders = [f for p, f in manifest["parts"].items() if parts is None or p in parts]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{root}/{f}" for f in folders])


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The newest version of the table, or a named one. The files it reads are fixed now, not when it runs."""
    return _read(spark, root, _manifest(spark, root, version))


def replace_table(df: DataFrame, root: str, count_by: str | None = None, at_least: dict[str, int] | None = None) -> dict[str, int]:
    """Make ``df`` the next version of the table; ``df`` may read the table itself.

    With ``at_least`` the rows of each named value of ``count_by`` are counted by the job that writes them, and returned. A value with
    fewer rows refuses the version: its files are deleted, ``Refused`` names the counts, and the table stays as it was.
    A version without any rows is allowed unless ``at_least`` asks for some.
    """
    spark = df.sparkSession
    known = versions(spark, root)
    folder = f"data-{uuid.uuid4().hex}"
    limits = at_least or {}
    seen = Observation()
    names = {f"n{i}": value for i, value in enumerate(limits)}
    counted = [F.count_if(F.col(count_by) == F.lit(v)).alias(n) for n, v in names.items()] if limits else []
    try:
        (df.observe(seen, *counted) if limits else df).write.parquet(f"{root}/{folder}")
        counts = {v: seen.get[n] for n, v in names.items()} if limits else {}
        short = {v: n for v, n in counts.items() if n < limits[v]}
        if short:
            raise Refused(f"too few rows for {root}: {short}, at least {limits}")
        last = known[-1] if known else 0
        _commit(spark, root, {"version": last + 1, "schema": df.schema.jsonValue(), "parts": {"all": folder}})
    except Exception:
        delete_table(spark, f"{root}/{folder}")
        raise
    return counts


def _bucket(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def upsert(
    batch: DataFrame, root: str, now: Column, keys: list[str] = ["key"], created_at: str = "created_at", ttl_days: int | None = CACHE_TTL_DAYS,
    tie_break: list[str] | None = None, buckets: int = 64,
) -> list[int]:
    """Set the rows of ``batch`` in the keyed table at ``root``: per key the newest row stays. Returns the buckets rewritten.

    Rows lie in ``buckets`` by the hash of their key (fixed by the first batch). Only buckets that the batch touches are read and
    written again; all others keep their files. A rewritten bucket drops what is older than ``ttl_days`` at ``now`` (None: nothing); what is too
    old in the others is left to the reader, see ``read_current``. Equal ages go to the greater ``tie_break``. Null keys are a key.
    A batch may arrive late or twice: the result does not depend on the order of batches. An empty first batch makes an empty table.
    """
    spark = batch.sparkSession
    known = versions(spark, root)
    old = _manifest(spark, root) if known else {"version": 0, "schema": batch.schema.jsonValue(), "parts": {}, "buckets": buckets}
    schema = StructType.fromJson(old["schema"])
    if [(f.name, f.dataType) for f in batch.schema] != [(f.name, f.dataType) for f in schema]:
        raise ValueError(f"the batch has {batch.schema.simpleString()}, the table {schema.simpleString()}")
    newest = [F.desc(created_at), *[F.desc(c) for c in (tie_break or [])]]
    placed = first_per_key(batch, keys, newest).withColumn("_bucket", _bucket(keys, old["buckets"]))
    staged = write_through(placed, "upsert")
    # At most one row per bucket.
    touched = sorted(r[0] for r in staged.select("_bucket").distinct().collect())
    if not touched:
        if not known:
            _commit(spark, root, {**old, "version": 1})
        return []
    before = _read(spark, root, old, [str(b) for b in touched]).withColumn("_bucket", _bucket(keys, old["buckets"]))
    merged = first_per_key(before.unionByName(staged), keys, newest)
    if ttl_days is not None:
        merged = merged.where(F.col(created_at) >= _oldest(now, ttl_days, schema, created_at))
    folder = f"data-{uuid.uuid4().hex}"
    merged.repartition(len(touched), "_bucket").write.partitionBy("_bucket").parquet(f"{root}/{folder}")
    hadoop, files = _file_system(spark, root)
    written = {s.getPath().getName() for s in files.listStatus(hadoop.Path(f"{root}/{folder}"))}
    parts = {p: f for p, f in old["parts"].items() if int(p) not in touched}
    parts |= {str(b): f"{folder}/_bucket={b}" for b in touched if f"_bucket={b}" in written}
    _commit(spark, root, {**old, "version": old["version"] + 1, "parts": parts})
    return touched


def _oldest(now: Column, ttl_days: int, schema: StructType, created_at: str) -> Column:
    return (now - F.make_dt_interval(F.lit(ttl_days))).cast(schema[created_at].dataType)


def read_current(spark: SparkSession, root: str, now: Column, created_at: str = "created_at", ttl_days: int = CACHE_TTL_DAYS) -> DataFrame:
    """The rows of a keyed table that are not older than ``ttl_days`` at ``now``; the filter reaches the scan."""
    table = read_version(spark, root)
    return table.where(F.col(created_at) >= _oldest(now, ttl_days, table.schema, created_at))


def forget_versions(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Delete all but the ``keep`` newest versions and the data that none of these names. Returns how many versions went.

    Not to be run beside a writer: files that are not committed yet are named by nobody.
    """
    if keep < 1:
        raise ValueError("at least the newest version has to stay")
    known = versions(spark, root)
    gone, kept = known[:-keep], known[-keep:]
    used = {f for v in kept for f in _manifest(spark, root, v)["parts"].values()}
    hadoop, files = _file_system(spark, root)
    for version in gone:
        files.delete(hadoop.Path(f"{root}/{_MANIFEST}{version}"), False)
    for status in files.listStatus(hadoop.Path(root)) if known else []:
        name = status.getPath().getName()
        if not name.startswith("data-") or name in used:
            continue
        inside = {f.split("/", 1)[1] for f in used if f.startswith(f"{name}/")}
        if not inside:
            delete_table(spark, f"{root}/{name}")
            continue
        for bucket in files.listStatus(status.getPath()):
            if bucket.isDirectory() and bucket.getPath().getName() not in inside:
                delete_table(spark, bucket.getPath().toString())
    return len(gone)
