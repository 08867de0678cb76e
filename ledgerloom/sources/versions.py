"""Tables in versions: what a load writes is seen all at once, when its manifest is there.

A table is a list of folders below ``<directory>/<table>``. A change writes new folders and
touches no old one. Its last act is one small file, the manifest of the next version, which
lists the folders of every table and the batches that are in them. Readers take the newest
manifest when they open, so they see one version whole, however far a later load has come.
A load that stops half-way leaves folders that no manifest names; the same load started
again takes up the steps that were finished.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

_FOLDER = "StoredIn"
_MANIFESTS = "manifests"
#: Takes a third less space than the default on text, at about the same speed.
COMPRESSION = "zstd"
#: Columns with about as many values as rows. A dictionary of them is given up in each file, once it is full.
MANY_VALUED = ("TransactionID", "TransactionKey", "TransactionAmount", "CustAccountBalance", "AccountBalance")
WRITE_OPTIONS = {
    "compression": COMPRESSION,
    "parquet.compression.codec.zstd.level": "1",
    **{f"parquet.enable.dictionary#{name}": "false" for name in MANY_VALUED},
}


class ConcurrentLoad(RuntimeError):
    """Another load has committed the version that this one was to become."""


@dataclass(frozen=True)
class Stored:
    schema: str
    folders: tuple[str, ...]


@dataclass(frozen=True)
class Manifest:
    version: int = 0
    tables: dict[str, Stored] = field(default_factory=dict)
    batches: dict[str, str] = field(default_factory=dict)

    def text(self) -> str:
        tables = {name: {"schema": t.schema, "folders": list(t.folders)} for name, t in self.tables.items()}
        return json.dumps({"version": self.version, "tables": tables, "batches": self.batches}, indent=1)

    @staticmethod
    def of(text: str) -> Manifest:
        read = json.loads(text)
        tables = {name: Stored(t["schema"], tuple(t["folders"])) for name, t in read["tables"].items()}
        return Manifest(read["version"], tables, read["batches"])


class TableStore:
    """The versions below one directory, in any store that Spark writes to."""

    def __init__(self, spark: SparkSession, directory: str) -> None:
        self.spark = spark
        self.directory = directory.rstrip("/")

    def latest(self) -> Manifest:
        versions = self._versions()
        return self.manifest(versions[-1]) if versions else Manifest()

    def manifest(self, version: int) -> Manifest:
        return Manifest.of(self.spark.read.text(self._manifest_path(version), wholetext=True).first()[0])

    def read(self, name: str, stored: Stored) -> DataFrame:
        """One scan over all folders of a table; partition columns prune as in a single folder."""
        schema = StructType.fromJson(json.loads(stored.schema))
        base = f"{self.directory}/{name}"
        reader = self.spark.read.schema(schema).option("basePath", base)
        return reader.parquet(*[f"{base}/{f}" for f in stored.folders]).select(*schema.names)

    def begin(self, label: str, after_step: Callable[[str], None] | None = None) -> Change:
        """A change on top of the latest version. The same label on the same version resumes."""
        return Change(self, self.latest(), label, after_step)

    def remove_unnamed(self, keep: int = 1) -> int:
        """Delete folders that the last ``keep`` manifests do not name, and older manifests.

        Run it while no load is under way and no reader holds an older version.
        """
        versions = self._versions()
        kept = [self.manifest(v) for v in versions[-keep:]]
        named = {f"{n}/{f}" for m in kept for n, t in m.tables.items() for f in t.folders}
        gone = [self._manifest_path(v) for v in versions[:-keep]]
        for table in self._names(self.directory):
            if table != _MANIFESTS:
                folders = self._names(f"{self.directory}/{table}")
                gone += [f"{self.directory}/{table}/{f}" for f in folders if f.startswith(f"{_FOLDER}=") and f"{table}/{f}" not in named]
        for path in gone:
            self._delete(path)
        return len(gone)

    def _versions(self) -> list[int]:
        found = (re.fullmatch(r"(\d{8})\.json", n) for n in self._names(f"{self.directory}/{_MANIFESTS}"))
        return sorted(int(m[1]) for m in found if m)

    def _manifest_path(self, version: int) -> str:
        return f"{self.directory}/{_MANIFESTS}/{version:08d}.json"

    def _file(self, path: str):
        found = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return found.getFileSystem(self.spark._jsc.hadoopConfiguration()), found

    def _names(self, path: str) -> list[str]:
        files, folder = self._file(path)
        return sorted(s.getPath().getName() for s in files.listStatus(folder)) if files.exists(folder) else []

    def _delete(self, path: str) -> None:
        files, target = self._file(path)
        files.delete(target, True)

    def finished(self, path: str) -> bool:
        files, marker = self._file(f"{path}/_SUCCESS")
        return files.exists(marker)

    def put(self, manifest: Manifest) -> None:
        """Write a manifest under another name and rename it: it is there whole or not at all."""
        files, target = self._file(self._manifest_path(manifest.version))
        _, draft = self._file(f"{self.directory}/{_MANIFESTS}/draft-{manifest.version:08d}")
        out = files.create(draft, True)
        out.write(bytearray(manifest.text().encode()))
        out.close()
        if files.exists(target) or not files.rename(draft, target):
            raise ConcurrentLoad(f"version {manifest.version} of {self.directory} is there already")


class Change:
    """The next version while it is written. Nobody else sees it before :meth:`commit`."""

    def __init__(self, store: TableStore, base: Manifest, label: str, after_step: Callable[[str], None] | None) -> None:
        self.store, self.base = store, base
        self.folder = f"{_FOLDER}={base.version + 1:08d}-{label}"
        self.tables = dict(base.tables)
        self._after_step = after_step or (lambda name: None)

    def write(
        self, name: str, make: Callable[[], DataFrame], partition_by: str | None = None, append: bool = False
    ) -> DataFrame:
        """Write what ``make`` plans as the table, or as further rows of it; a finished step is not made again."""
        path, before = f"{self.store.directory}/{name}/{self.folder}", self.base.tables.get(name)
        schema = self._finished_schema(name, path)
        if schema is None:
            df = make()
            df.write.mode("overwrite").options(**WRITE_OPTIONS).partitionBy(*([partition_by] if partition_by else [])).parquet(path)
            schema = df.schema
        if append and before is not None:
            self.tables[name] = Stored(before.schema, (*before.folders, self.folder))
        else:
            self.tables[name] = Stored(json.dumps(schema.jsonValue()), (self.folder,))
        self._after_step(name)
        return self.table(name)

    def scratch(self, name: str, make: Callable[[], DataFrame]) -> DataFrame:
        """Write a table that later steps read and the version does not keep."""
        df = self.write(name, make)
        del self.tables[name]
        return df

    def table(self, name: str) -> DataFrame:
        return self.store.read(name, self.tables[name])

    def added(self, name: str) -> DataFrame:
        """Only the rows that this change wrote."""
        return self.store.read(name, Stored(self.tables[name].schema, (self.folder,)))

    def before(self, name: str) -> DataFrame:
        return self.store.read(name, self.base.tables[name])

    def commit(self, batch: tuple[str, str] | None = None, restart: bool = False) -> Manifest:
        """Make this the latest version, with ``batch`` (id, fingerprint) in its ledger.

        ``restart`` begins a new ledger: a full load holds no batches.
        """
        batches = {**({} if restart else self.base.batches), **(dict([batch]) if batch else {})}
        manifest = Manifest(self.base.version + 1, self.tables, batches)
        self.store.put(manifest)
        return manifest

    def _finished_schema(self, name: str, path: str) -> StructType | None:
        if not self.store.finished(path):
            return None
        try:
            found = self.store.spark.read.option("basePath", f"{self.store.directory}/{name}").parquet(path)
            return found.drop(_FOLDER).schema
        except AnalysisException:  # finished without a row and so without a file
            return None


def fingerprint(df: DataFrame) -> str:
    """A short digest of the rows of ``df``, whatever their order: equal batches have equal ones."""
    rows = df.select(F.xxhash64(*[F.col(c) for c in df.columns]).alias("h"))
    seen = rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("h").cast("decimal(38,0)")).alias("s"), F.bit_xor("h").alias("x"))
    return seen.select(F.substring(F.sha2(F.concat_ws(",", "n", "s", "x"), 256), 1, 16)).first()[0]
