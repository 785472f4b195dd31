"""A publication store on plain files: staged, checked, published by one new manifest, and put in force by a pointer of its own.

A dataset is a folder of immutable versions ``v=<run id>`` and numbered manifests that name them. A manifest is never
rewritten: each change writes the next number, and readers take the highest that is whole, so a crash between any two steps
leaves the state before it. Files go through the Hadoop file system of the session, so local and shared folders work alike.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

Check = Callable[[DataFrame], int]


class Refused(RuntimeError):
    """A publication that must not happen; what was there before is untouched."""


class Store:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    # ---- small files
    def _exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def _numbers(self, path: str) -> list[int]:
        if not self._exists(path):
            return []
        names = (str(x.getPath().getName()) for x in self._fs.listStatus(self._path(path)))
        return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())

    def _write(self, path: str, value: dict) -> None:
        """The next number of the record ``path``; two writers at once cannot both have it."""
        n = max(self._numbers(path), default=0) + 1
        try:
            out = self._fs.create(self._path(f"{path}/{n:010d}.json"), False)
        except Py4JJavaError as e:
            raise Refused(f"{path} is being written by another run") from e
        out.write(bytearray(json.dumps(value, sort_keys=True), "utf-8"))
        out.close()

    def _read(self, path: str) -> dict | None:
        """The newest whole value of the record ``path``; one that a crash cut short is passed over."""
        for n in reversed(self._numbers(path)):
            stream = self._fs.open(self._path(f"{path}/{n:010d}.json"))
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            stream.close()
            try:
                return json.loads(text)
            except ValueError:
                continue
        return None

    def manifest(self, name: str) -> dict:
        return self._read(f"{self.root}/{name}/_manifest") or {"current": None, "runs": {}}

    # ---- publications
    def published(self, name: str, run: str, versions: dict | None = None) -> bool:
        """Whether ``run`` is published under just these input versions and its files still hold the rows recorded; refuses everything in between.

        An unknown run id is False. A known one with other versions or another number of rows, or files that no manifest
        knows, is a state to stop at, not one to build over.
        """
        path, entry = self._version(name, run), self.manifest(name)["runs"].get(run)
        if entry is None:
            if self._exists(path):
                raise Refused(f"{name} {run}: half published, files without an entry")
            return False
        if not self._exists(path):
            raise Refused(f"{name} {run}: half published, an entry without files")
        if versions is not None and entry["versions"] != versions:
            raise Refused(f"{name} {run}: published from {entry['versions']}, not from {versions}")
        rows = self.spark.read.parquet(path).count()  # from file footers
        if rows != entry["rows"]:
            raise Refused(f"{name} {run}: {rows} rows, {entry['rows']} recorded")
        return True

    def publish(self, name: str, run: str, df: DataFrame, checks: dict[str, Check] | None = None, promote: bool = False, versions: dict | None = None, fail_at: str | None = None) -> bool:
        """Write ``df`` as version ``run``. False, without any work on ``df``, when that run is already published.

        The version is staged, read back and given to every check (a count of violations); one violation publishes nothing.
        A published version is never overwritten. The pointer moves only with ``promote``. ``fail_at`` stops on purpose
        after ``staged`` or ``moved``, as a crash would.
        """
        if self.published(name, run, versions):
            if promote and self.manifest(name)["current"] != run:
                self.promote(name, run)
            return False
        stage, final = f"{self.root}/{name}/_staging/{self._safe(run)}", self._version(name, run)
        df.write.mode("overwrite").parquet(stage)
        staged = self.spark.read.parquet(stage)
        rows = staged.count()
        bad = {c: n for c, f in (checks or {}).items() if (n := f(staged))}
        if bad or fail_at == "staged":
            self._fs.delete(self._path(stage), True)
            raise Refused(f"{name} {run}: violations {bad}" if bad else f"{name} {run}: stopped before publication")
        if not self._fs.rename(self._path(stage), self._path(final)):
            raise Refused(f"{name} {run}: cannot move the staged files")
        if fail_at == "moved":
            raise Refused(f"{name} {run}: stopped before its entry")
        m = self.manifest(name)
        m["runs"][run] = {"rows": rows, "columns": df.columns, "versions": versions or {}}
        if promote:
            m["current"] = run
        self._write(f"{self.root}/{name}/_manifest", m)
        return True

    def discard(self, name: str, run: str) -> None:
        """Remove what an aborted publication left; a published version is refused."""
        if run in self.manifest(name)["runs"]:
            raise Refused(f"{name}: {run} is published")
        self._fs.delete(self._path(self._version(name, run)), True)

    def _version(self, name: str, run: str) -> str:
        return f"{self.root}/{name}/v={self._safe(run)}"

    @staticmethod
    def _safe(run: str) -> str:
        """A file name for each id, and no two alike."""
        return "".join(ch if ch.isascii() and (ch.isalnum() or ch in "-.") else "".join(f"_{x:02x}" for x in ch.encode()) for ch in run)

    def promote(self, name: str, run: str) -> None:
        m = self.manifest(name)
        if run not in m["runs"]:
            raise Refused(f"{name}: {run} is not published")
        m["current"] = run
        self._write(f"{self.root}/{name}/_manifest", m)

    def read(self, name: str, run: str | None = None) -> DataFrame:
        """A published version, by default the one the pointer names."""
        m = self.manifest(name)
        run = run or m["current"]
        if run is None or run not in m["runs"]:
            raise Refused(f"{name}: no version {run}")
        return self.spark.read.parquet(self._version(name, run))

    def swap(self, group: str, versions: dict[str, str]) -> None:
        """Several datasets change together: one file names the versions that belong to each other."""
        for name, run in versions.items():
            if run not in self.manifest(name)["runs"]:
                raise Refused(f"{name}: {run} is not published")
        self._write(f"{self.root}/_{group}", versions)

    def swapped(self, group: str) -> dict[str, DataFrame]:
        v = self._read(f"{self.root}/_{group}") or {}
        return {name: self.read(name, run) for name, run in v.items()}

    # ---- registry: insert-only
    def register(self, registry: str, key: str, entry: dict) -> bool:
        """Insert when not there; an entry that differs from the one kept is refused."""
        path = f"{self.root}/{registry}/{self._safe(key)}"
        old = self._read(path)
        if old is None:
            self._write(path, entry)
            return True
        if old != json.loads(json.dumps(entry)):
            raise Refused(f"{registry}: {key} is registered with other content")
        return False


def replace_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replace exactly the partitions that ``df`` holds, leaving the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def append_new(df: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key is not there yet: insert-only merge."""
    return df.join(existing.select(*keys).distinct(), keys, "left_anti")


def upsert(existing: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Matched keys take the update's row, others keep theirs, new ones are added; ``updates`` has one row per key."""
    return existing.join(updates.select(*keys), keys, "left_anti").unionByName(updates.select(*existing.columns))


def freeze(st: Store, name: str, run: str, columns: list[str], registry: str = "baselines") -> dict:
    """Record a published version as a baseline, once: its content digest and rows, insert-only. Other content under the same id is refused."""
    from rillmark.operators.digest import content_digest

    if not st.published(name, run):
        raise Refused(f"{name}: {run} is not published")
    d = content_digest(st.read(name, run), columns).first()
    entry = {"dataset": name, "run": run, "rows": d["rows"], "digest": d["digest"]}
    st.register(registry, f"{name}|{run}", entry)
    return entry
