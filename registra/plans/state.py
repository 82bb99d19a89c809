"""The state of the performance mart: week blocks of all batches of logs, as a log-structured store.

A state is a folder. A batch of logs adds a run, a table of week blocks by bucket, a hash of the pair;
when a level holds `FAN` runs they are merged to one of the next level, so a row is rewritten once per level. A manifest, one line
of JSON in a folder of its own per version, names the runs that count; the newest wins, and a run no manifest
names is as if it were not there. So an add that fails leaves the state as it was.

The mart made from a state is kept in parts, tables by the same buckets. A batch replaces the buckets that
it touched; the manifest tells which part holds which bucket.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registra.plans import marts
from registra.sources.sinks import dealt

# Runs of a level that are merged to one of the next.
FAN = 4


@dataclass(frozen=True)
class Run:
    path: str
    level: int


@dataclass(frozen=True)
class Part:
    """A table of mart rows, its table of counts, and the buckets of it that count."""

    table: str
    buckets: tuple[int, ...]


@dataclass(frozen=True)
class Mart:
    """A published mart: its parts, the departments' digest it was made with, and the parts of the version before."""

    parts: tuple[Part, ...]
    departments: str
    before: tuple[str, ...] = ()


@dataclass(frozen=True)
class Manifest:
    variant: str
    buckets: int
    version: int = 0
    schema: str = ""
    batches: tuple[tuple[int, int], ...] = ()  # applied, as ranges
    runs: tuple[Run, ...] = ()
    marts: dict[str, Mart] = field(default_factory=dict)
    touched: dict[str, tuple[int, ...]] = field(default_factory=dict)  # by mart: buckets changed since it was published

    def has(self, batch: int) -> bool:
        return any(low <= batch <= high for low, high in self.batches)


def _ranges(batches: tuple[tuple[int, int], ...], batch: int) -> tuple[tuple[int, int], ...]:
    out: list[tuple[int, int]] = []
    for low, high in sorted([*batches, (batch, batch)]):
        if out and low <= out[-1][1] + 1:
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return tuple(out)


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def _drop(spark: SparkSession, path: str) -> None:
    files, place = _folder(spark, path)
    files.delete(place, True)


def _versions(spark: SparkSession, state: str) -> list[int]:
    """Versions with a complete manifest, oldest first."""
    files, place = _folder(spark, f"{state}/manifest")
    if not files.exists(place):
        return []
    named = [status.getPath() for status in files.listStatus(place)]
    whole = [path for path in named if files.exists(spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS"))]
    return sorted(int(path.getName()) for path in whole if path.getName().isdigit())


def read_manifest(spark: SparkSession, state: str) -> Manifest | None:
    """The newest manifest; None before the first batch."""
    known = _versions(spark, state)
    return _read_version(spark, state, known[-1]) if known else None


def _read_version(spark: SparkSession, state: str, version: int) -> Manifest:
    value = json.loads(spark.read.text(f"{state}/manifest/{version:012d}").first()["value"])
    value["batches"] = tuple(map(tuple, value["batches"]))
    value["runs"] = tuple(Run(**r) for r in value["runs"])
    value["touched"] = {name: tuple(buckets) for name, buckets in value["touched"].items()}
    value["marts"] = {
        name: Mart(tuple(Part(p["table"], tuple(p["buckets"])) for p in mart["parts"]), mart["departments"], tuple(mart["before"]))
        for name, mart in value["marts"].items()
    }
    return Manifest(**value)


def write_manifest(spark: SparkSession, state: str, manifest: Manifest) -> Manifest:
    """Write the next version. The last two stay with their runs; runs that neither names, also those of failed adds, go.

    So a state has one writer at a time, and a reader has until the next version but one.
    """
    fresh = replace(manifest, version=manifest.version + 1)
    line = spark.createDataFrame([(json.dumps(asdict(fresh)),)], "value string")
    line.coalesce(1).write.text(f"{state}/manifest/{fresh.version:012d}")
    known = _versions(spark, state)
    for old in known[:-2]:
        _drop(spark, f"{state}/manifest/{old:012d}")
    named = {run.path for run in fresh.runs} | {run.path for v in known[-2:-1] for run in _read_version(spark, state, v).runs}
    files, place = _folder(spark, f"{state}/runs")
    for status in files.listStatus(place) if files.exists(place) else []:
        if f"runs/{status.getPath().getName()}" not in named:
            files.delete(status.getPath(), True)
    return fresh


def bucket_of(pair: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*pair), F.lit(buckets)).cast("int").alias("bucket")


def _write_run(blocks: DataFrame, manifest: Manifest, state: str, level: int) -> Run:
    path = f"runs/{uuid.uuid4().hex}"
    rows = blocks.withColumn("bucket", bucket_of(marts.PAIR, manifest.buckets))
    dealt(rows, manifest.buckets, [*marts.PAIR, "block"]).write.partitionBy("bucket").parquet(f"{state}/{path}")
    return Run(path, level)


def _read_runs(spark: SparkSession, state: str, manifest: Manifest, runs: tuple[Run, ...]) -> DataFrame:
    frames = [spark.read.schema(manifest.schema).parquet(f"{state}/{run.path}") for run in runs]
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


def add(logs: DataFrame, state: str, batch: int, variant: str = "v2", buckets: int = 64) -> Manifest:
    """Add a batch of logs. A batch that is there already changes nothing.

    The first batch fixes the variant and the number of buckets; another variant is refused. Reads the logs and,
    when a level is full, its runs: never the whole state for a small batch.
    """
    spark = logs.sparkSession
    manifest = read_manifest(spark, state) or Manifest(variant, buckets)
    if manifest.variant != variant:
        raise ValueError(f"the state holds batches of variant {manifest.variant!r}, not {variant!r}")
    if manifest.has(batch):
        return manifest
    blocks = marts.week_blocks(logs, variant)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in blocks.schema.fields) + ", bucket int"
    manifest = replace(manifest, schema=schema, batches=_ranges(manifest.batches, batch))
    run = _write_run(blocks, manifest, state, 0)
    # At most as many rows as there are buckets.
    touched = tuple(sorted(r["bucket"] for r in _read_runs(spark, state, manifest, (run,)).select("bucket").distinct().collect()))
    marks = {name: tuple(sorted({*known, *touched})) for name, known in manifest.touched.items()}
    runs, level = (*manifest.runs, run), 0
    while len(full := tuple(r for r in runs if r.level == level)) >= FAN:
        merged = _write_run(marts.merged_blocks(_read_runs(spark, state, manifest, full)), manifest, state, level + 1)
        runs, level = (*[r for r in runs if r.level != level], merged), level + 1
    return write_manifest(spark, state, replace(manifest, runs=runs, touched=marks))


def read(spark: SparkSession, state: str, buckets: tuple[int, ...] | None = None) -> DataFrame:
    """The blocks of all batches, or of some buckets, whose files alone are read; `marts.merged_blocks` puts them together."""
    manifest = read_manifest(spark, state)
    if manifest is None:
        raise ValueError(f"no state at {state}")
    rows = _read_runs(spark, state, manifest, manifest.runs)
    return (rows if buckets is None else rows.filter(F.col("bucket").isin(list(buckets)))).drop("bucket")
