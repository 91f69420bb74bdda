"""Tables in buckets that change together: one commit makes a new version of all of them current."""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


class TableSet:
    """Tables under one folder, each in ``buckets`` buckets by a key, shared where rows of several tables belong together.

    A write makes new versions of the buckets that it touches, in a folder of its own. Only the commit record, one small
    file that is renamed into place after all tables are written, makes them current, for all tables at once. The record
    names, for each table, the folder of every bucket's current version, so a reader lists nothing and stays with the
    version that it opened. What a failed write left behind is never read, and ``clean`` deletes it with the versions
    that no kept record names. There is one writer at a time.
    """

    def __init__(self, spark: SparkSession, root: str, schemas: Mapping[str, str], key: str | Mapping[str, str], buckets: int = 64):
        """``key``: the column that deals out rows, one for all tables or one for each."""
        self.spark, self.root, self.schemas, self.buckets = spark, root.rstrip("/"), dict(schemas), buckets
        self.keys = {t: key if isinstance(key, str) else key[t] for t in schemas}

    def bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(self.buckets)).cast("int")

    # small files by the interface that Spark itself writes with, so any store will do

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _store(self):
        return self._path(self.root).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, path: str) -> list[str]:
        p = self._path(path)
        return [s.getPath().getName() for s in self._store().listStatus(p)] if self._store().exists(p) else []

    def commits(self) -> list[int]:
        """Numbers of all commits, ascending."""
        return sorted(int(n.removesuffix(".json")) for n in self._names(f"{self.root}/commits") if n.endswith(".json"))

    def record(self, number: int) -> dict:
        """What a commit says: ``tables``, for each the folder of every bucket, and ``note``."""
        return json.loads(self.spark.read.text(f"{self.root}/commits/{number}.json", wholetext=True).first()[0])

    def head(self, before: int | None = None) -> int | None:
        found = [n for n in self.commits() if before is None or n < before]
        return found[-1] if found else None

    def read(self, table: str, *, at: int | None = None, only: Iterable[int] | None = None) -> DataFrame:
        """A table as of a commit (the last by default), or only some of its buckets; without any commit, no rows."""
        at = self.head() if at is None else at
        folders = self.record(at)["tables"].get(table, {}) if at is not None else {}
        wanted = None if only is None else {str(b) for b in only}
        paths = [f"{self.root}/{table}/{f}/bucket={b}" for b, f in folders.items() if wanted is None or b in wanted]
        if not paths:
            return self.spark.createDataFrame([], self.schemas[table])
        return self.spark.read.schema(self.schemas[table]).parquet(*paths)

    def touched(self, rows: DataFrame, key: str) -> list[int]:
        """The buckets that rows fall in by a key: at most ``buckets`` numbers."""
        return [r[0] for r in rows.select(self.bucket(key).alias("b")).distinct().collect()]

    def commit(self, number: int, tables: Mapping[str, DataFrame], note: Mapping[str, object] | None = None, *, then: Callable[[dict[str, DataFrame]], Mapping[str, DataFrame]] | None = None) -> bool:
        """Make new versions of the buckets that the tables' rows fall in, all at once; False if the commit is there already.

        ``then`` gets the rows just written, read from where they lie, and returns tables that follow from them, which
        become current by the same commit.
        """
        if number in self.commits():
            return False
        last = self.head()
        folders = self.record(last)["tables"] if last is not None else {}

        def put(name: str, df: DataFrame) -> DataFrame:
            folder = f"{number}-{uuid.uuid4().hex}"
            empty = self.spark.createDataFrame([], self.schemas[name])
            df.select(*empty.columns, self.bucket(self.keys[name]).alias("bucket")).repartition("bucket").write.partitionBy("bucket").parquet(f"{self.root}/{name}/{folder}")
            mine = {n.removeprefix("bucket="): folder for n in self._names(f"{self.root}/{name}/{folder}") if n.startswith("bucket=")}
            folders[name] = {**folders.get(name, {}), **mine}
            paths = [f"{self.root}/{name}/{folder}/bucket={b}" for b in mine]
            return self.spark.read.schema(self.schemas[name]).parquet(*paths) if paths else empty

        written = {name: put(name, df) for name, df in tables.items()}
        for name, df in then(written).items() if then else ():
            put(name, df)
        store, target = self._store(), self._path(f"{self.root}/commits/{number}.json")
        waiting = self._path(f"{self.root}/commits/.{number}-{uuid.uuid4().hex}")
        out = store.create(waiting)
        out.write(bytearray(json.dumps({"tables": folders, "note": dict(note or {})}), "utf-8"))
        out.close()
        return bool(store.rename(waiting, target))

    def clean(self, keep: int = 2) -> int:
        """Delete the versions, and what failed writes left, that the last ``keep`` commits don't name; the number of folders that went."""
        commits = self.commits()
        kept = commits[-keep:] if keep else []
        named = {(t, f) for n in kept for t, of in self.record(n)["tables"].items() for f in of.values()}
        gone = 0
        for table in self.schemas:
            for folder in self._names(f"{self.root}/{table}"):
                if (table, folder) not in named and kept and int(folder.split("-")[0]) <= kept[-1]:
                    gone += bool(self._store().delete(self._path(f"{self.root}/{table}/{folder}"), True))
        for n in commits[:-keep] if keep else []:
            self._store().delete(self._path(f"{self.root}/commits/{n}.json"), False)
        return gone
