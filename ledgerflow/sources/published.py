"""Tables in versions: written aside, checked, then published by a manifest that readers resolve.

A version is a folder of its own that nothing writes to again. Its manifest, one small file, is written last and appears by a
rename; the newest manifest names the rows that readers see. So a rewrite that fails leaves the old rows, readers of the
old version are not disturbed by a new one, and a version is replaced as a whole. Two writers at a time publish two
versions, of which the one with the greater name counts.

While a version is written, the number of its rows and two sums of row checksums are observed; before it is published it is
read back, checksums are taken for each partition, and they have to add up to what was observed. ``verify`` takes them
again at any time. ``expire`` removes versions that are both old and not among the newest ones, and what failed writes left.

Layout below the table's path: ``data/<version>-<id>/`` rows, ``checks/<version>-<id>/`` checksums, ``manifests/<version>-<id>``,
``expired/<version>`` the last one removed.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.functions.checksums import checksums, sums

KEEP = 2
SECONDS = 3600.0


@dataclass(frozen=True)
class Manifest:
    """What is known of a published version."""

    version: int
    name: str
    schema: str
    partition_by: tuple[str, ...]
    rows: int
    published: float


class Folder:
    """The few file operations a table needs, on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, self.root = spark._jvm, path.rstrip("/")
        self.fs = self.path("").getFileSystem(spark._jsc.hadoopConfiguration())

    def path(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def names(self, name: str) -> dict[str, float]:
        """The entries of a folder and when they changed; none if there is no folder."""
        if not self.fs.exists(self.path(name)):
            return {}
        return {s.getPath().getName(): s.getModificationTime() / 1000 for s in self.fs.listStatus(self.path(name))}

    def read(self, name: str) -> str:
        stream = self.fs.open(self.path(name))
        try:
            return bytes(self.jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
        finally:
            stream.close()

    def write(self, name: str, text: str) -> None:
        """Writes a file that appears complete."""
        folder, _, last = name.rpartition("/")
        aside = f"{folder}/.{last}.{uuid.uuid4().hex}"
        stream = self.fs.create(self.path(aside), True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        if not self.fs.rename(self.path(aside), self.path(name)):
            self.fs.delete(self.path(aside), False)
            if not self.fs.exists(self.path(name)):
                raise OSError(f"{self.root}/{name} could not be published")

    def remove(self, name: str) -> None:
        self.fs.delete(self.path(name), True)


def manifests(spark: SparkSession, path: str) -> list[Manifest]:
    """All versions that are published and not expired, oldest first."""
    folder, found = Folder(spark, path), []
    for name in sorted(folder.names("manifests")):
        if not name.startswith("."):
            read = json.loads(folder.read(f"manifests/{name}"))
            found.append(Manifest(**{**read, "partition_by": tuple(read["partition_by"])}))
    return found


def newest(spark: SparkSession, path: str) -> Manifest | None:
    """The manifest that readers go by."""
    names = [n for n in Folder(spark, path).names("manifests") if not n.startswith(".")]
    if not names:
        return None
    read = json.loads(Folder(spark, path).read(f"manifests/{max(names)}"))
    return Manifest(**{**read, "partition_by": tuple(read["partition_by"])})


def publish(
    df: DataFrame, path: str, partition_by: Sequence[str] = (), version: int | None = None, check: bool = True
) -> Manifest:
    """Writes ``df`` as the next version of the table and publishes it; returns the manifest.

    With ``version`` the caller numbers the versions: one that is there already, or that came before, is left as it is, so a
    step that is repeated has no effect. Without ``check`` the version is not read back before it is published.
    """
    spark, folder = df.sparkSession, Folder(df.sparkSession, path)
    before = newest(spark, path)
    if version is not None and before is not None and before.version >= version:
        return before
    number = version if version is not None else before.version + 1 if before else 0
    name = f"{number:012d}-{uuid.uuid4().hex}"
    placed = df.hint("rebalance", *partition_by) if partition_by else df
    seen = Observation()
    writer = placed.observe(seen, *sums(placed)).write if check else placed.write
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(f"{path}/data/{name}")
    rows = -1
    if check:
        written = seen.get
        rows = written["rows"]
        stored = read_folder(spark, f"{path}/data/{name}", df.schema, partition_by)
        # One row per partition value, so few that one file holds them.
        checksums(stored, partition_by).coalesce(1).write.parquet(f"{path}/checks/{name}")
        total = checks(spark, path, name).agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("rows", "sum_a", "sum_b")]).first()
        if any(int(total[c]) != int(written[c]) for c in ("rows", "sum_a", "sum_b")):
            raise OSError(f"{path}/data/{name} does not hold the rows that were written")
    done = Manifest(number, name, df.schema.json(), tuple(partition_by), rows, time.time())
    folder.write(f"manifests/{name}", json.dumps(asdict(done)))
    return done


def read_folder(spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(path).select(*[f"`{f.name}`" for f in schema.fields])


def checks(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/checks/{name}")


def find(spark: SparkSession, path: str, version: int | None = None) -> Manifest:
    """The manifest of a version, by default of the newest; an error that says why there is none."""
    now = newest(spark, path)
    if now is None:
        raise ValueError(f"nothing is published at {path}")
    if version is None or version == now.version:
        return now
    known = [m for m in manifests(spark, path) if m.version == version]
    if known:
        return known[-1]
    gone = [int(n) for n in Folder(spark, path).names("expired")]
    why = "has expired" if version <= max(gone, default=-1) else "was not published"
    raise ValueError(f"version {version} of {path} {why}; the newest is {now.version}")


def read(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """The rows of a version, by default of the newest. What is read does not change when another version is published."""
    found = find(spark, path, version)
    schema = T.StructType.fromJson(json.loads(found.schema))
    return read_folder(spark, f"{path}/data/{found.name}", schema, found.partition_by)


def verify(spark: SparkSession, path: str, version: int | None = None) -> DataFrame:
    """(partition columns, rows, rows_found, intact): each partition as it was published and as it is read now.

    A partition that is lost has no rows found, one that should not be there no rows published.
    """
    found = find(spark, path, version)
    keys = list(found.partition_by)
    was = checks(spark, path, found.name)
    now = checksums(read(spark, path, found.version), keys).withColumnsRenamed({c: f"_now_{c}" for c in ("rows", "sum_a", "sum_b")})
    now = now.withColumnsRenamed({k: f"_now_key_{i}" for i, k in enumerate(keys)})
    same = reduce(lambda a, b: a & b, [was[k].eqNullSafe(now[f"_now_key_{i}"]) for i, k in enumerate(keys)], F.lit(True))
    both = was.join(now, same, "full")
    equal = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_now_{c}")) for c in ("rows", "sum_a", "sum_b")])
    return both.select(
        *[F.coalesce(F.col(k), F.col(f"_now_key_{i}")).alias(k) for i, k in enumerate(keys)],
        F.coalesce("rows", F.lit(0)).alias("rows"),
        F.coalesce("_now_rows", F.lit(0)).alias("rows_found"),
        equal.alias("intact"),
    )


def expire(spark: SparkSession, path: str, keep: int = KEEP, seconds: float = SECONDS) -> int:
    """Removes versions that are not among the newest ``keep`` and were published more than ``seconds`` ago.

    Also removes what failed writes left behind that long ago. One mark says up to which version all are gone, so that a late
    reader is told. Returns the number of versions removed.
    """
    folder, known, until = Folder(spark, path), manifests(spark, path), time.time() - seconds
    old = [m for m in known[: max(0, len(known) - max(1, keep))] if m.published < until]
    if old:
        mark = f"{max(m.version for m in old):012d}"
        earlier = [n for n in folder.names("expired") if n < mark]
        folder.write(f"expired/{mark}", "")
        for name in earlier:
            folder.remove(f"expired/{name}")
        for gone in old:  # its manifest goes first, so that nobody finds a version without rows
            folder.remove(f"manifests/{gone.name}")
            folder.remove(f"data/{gone.name}")
            folder.remove(f"checks/{gone.name}")
    named = {m.name for m in known}
    for part in ("data", "checks"):
        for name, changed in folder.names(part).items():
            if name not in named and changed < until:
                folder.remove(f"{part}/{name}")
    for name, changed in folder.names("manifests").items():
        if name.startswith(".") and changed < until:
            folder.remove(f"manifests/{name}")
    return len(old)
