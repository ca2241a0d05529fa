"""Published tables (SNK-1, SNK-3): staged folders and a versioned manifest that readers follow.

A writer stages its rows under a folder of its own, ``data/<run>``, partitioned by the
table's key columns, and then publishes a new version of the manifest: one row per key
value with the run that holds its rows (none: the key is empty). Keys that the writer
did not handle keep their run. A version counts once Spark has committed it, that is,
once its success marker is there; readers take the last such version, so they see the
whole table before a replace or the whole table after it, and never a mix. A writer that
dies leaves staged files that nobody reads.

An empty key value is a null one, as in any Spark partition. One writer at a time publishes a table: version numbers are taken in turn and an existing
one is refused, so the later of two writers fails and can run again. A manifest has one row
per key value (a country, a run, a bucket), so it is small whatever the data.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from shelfmatch.sources.sinks import decimals_as_text


#: Partition column of the staged folders, beside ``_key_<name>`` for each key.
RUN = "_published_run"


def listed(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder (none where it does not exist), through its own file system."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


class Published:
    """A table under ``path`` keyed by ``keys`` (STRING values); ``latest`` is its current version or None."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str] = ("COUNTRY",)):
        self.spark, self.path, self.keys = spark, path.rstrip("/"), list(keys)

    def versions(self) -> list[int]:
        found = [int(n.removeprefix("version=")) for n in listed(self.spark, f"{self.path}/manifest") if n.startswith("version=")]
        return sorted(v for v in found if "_SUCCESS" in listed(self.spark, f"{self.path}/manifest/version={v}"))

    @property
    def latest(self) -> int | None:
        return max(self.versions(), default=None)

    def manifest(self, version: int | None = None) -> list[dict]:
        """Rows of a version: the keys, ``run`` (null: no rows), ``note`` and ``ddl`` (the last writer's schema)."""
        version = self.latest if version is None else version
        if version is None:
            return []
        return [r.asDict() for r in self.spark.read.parquet(f"{self.path}/manifest/version={version}").collect()]

    def replace(self, df: DataFrame, handled: Iterable[Sequence[str] | str] | None = None, note: str = "") -> int:
        """Publish ``df`` as the rows of the keys that it holds and of those ``handled`` (these may be empty).

        Returns the version. Decimals are written as text (SNK-2)."""
        before = self.latest
        rows, run = decimals_as_text(df), uuid.uuid4().hex
        columns = [f"_key_{k}" for k in self.keys]
        staged = rows.withColumns({c: F.col(k).cast("string") for c, k in zip(columns, self.keys)}).drop(*self.keys)
        # Rows of a key come together in files of about the advisory size: few for a small key, several for a hot one.
        staged = staged.hint("rebalance", *columns)
        staged.write.partitionBy(*columns).parquet(f"{self.path}/data/{RUN}={run}")
        ddl = rows.schema.json()
        # The key values come from the staged folders' names: a scan of partition columns alone.
        present = {tuple(r) for r in self._scan([run], ddl).select(*columns).distinct().collect()}
        done = present | {(h,) if isinstance(h, str) else tuple(h) for h in handled or ()}
        kept = [(*[m[k] for k in self.keys], m["run"], m["note"], ddl) for m in self.manifest(before) if tuple(m[k] for k in self.keys) not in done]
        new = [(*key, run if key in present else None, note, ddl) for key in sorted(done, key=lambda k: [(v is not None, v or "") for v in k])]
        if not kept + new:
            new = [(*[None for _ in self.keys], None, note, ddl)]      # no rows yet: the null key is empty
        schema = ", ".join([*[f"`{k}` string" for k in self.keys], "run string", "note string", "ddl string"])
        version = (before or 0) + 1
        rows = self.spark.createDataFrame(kept + new, schema).coalesce(1)
        rows.write.mode("error").parquet(f"{self.path}/manifest/version={version}")
        return version

    def _scan(self, runs: Iterable[str], ddl: str) -> DataFrame:
        """The staged rows of some runs, with the keys as ``_key_`` strings, in one scan."""
        fields = [f for f in StructType.fromJson(json.loads(ddl)).fields if f.name not in self.keys]
        names = [RUN, *[f"_key_{k}" for k in self.keys]]
        reader = self.spark.read.schema(StructType([*fields, *[StructField(n, StringType()) for n in names]]))
        return reader.option("basePath", f"{self.path}/data").parquet(*[f"{self.path}/data/{RUN}={r}" for r in runs])

    def read(self, version: int | None = None) -> DataFrame:
        """The rows of a version (the current one by default).

        One scan over the folders in use; which keys count in which folder is a filter on partition columns, as is
        any filter of the caller on a key, so other folders are not opened."""
        entries = self.manifest(version)
        if not entries:
            raise FileNotFoundError(f"nothing is published under {self.path}")
        ddl = entries[0]["ddl"]
        fields = StructType.fromJson(json.loads(ddl)).fields
        live = [m for m in entries if m["run"]]
        if not live:
            return self.spark.createDataFrame([], StructType(fields))
        holds = F.lit(False)
        for m in live:
            same = F.col(RUN) == m["run"]
            for k in self.keys:
                same = same & F.col(f"_key_{k}").eqNullSafe(F.lit(m[k]))
            holds = holds | same
        rows = self._scan(sorted({m["run"] for m in live}), ddl).where(holds)
        return rows.select(*[F.col(f"_key_{f.name}").cast(f.dataType).alias(f.name) if f.name in self.keys else f.name for f in fields])
