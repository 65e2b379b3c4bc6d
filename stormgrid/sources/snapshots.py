"""Tables that change together: immutable parts, and one manifest for each version.

    <root>/parts/<table>/<unique>      rows, written once and never changed
    <root>/manifests/<version>         which parts make up each table, and the tokens of the runs behind it

A transaction writes its parts first and names them in a new manifest last, which
a rename puts in place whole or not at all. Readers follow the newest manifest, so
they see all changes of a run or none; what a failed run wrote is in no manifest.
A run that repeats (same token) after its commit changes nothing, and one that
lost the race for a version fails.

A table is a list of parts. They may be named (by day, say), so that a run reads
and replaces only the parts it touches. A table that has grown by `MERGE_AFTER`
unnamed parts is rewritten as one when the next is appended.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "kind string, name string, part string, path string"
MERGE_AFTER = 256
#: Tokens of finished runs that a manifest remembers.
TOKENS_KEPT = 1000


@dataclass(frozen=True)
class Part:
    table: str
    name: str
    path: str


def _files(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def version(spark: SparkSession, root: str) -> int:
    """Number of the newest version, 0 before the first."""
    store, folder = _files(spark, f"{root}/manifests")
    if not store.exists(folder):
        return 0
    names = [s.getPath().getName() for s in store.listStatus(folder)]
    return max((int(n) for n in names if n.isdigit()), default=0)


def manifest(spark: SparkSession, root: str, number: int | None = None) -> tuple[list[Part], list[str]]:
    """Parts of all tables and remembered tokens of a version (the newest by default)."""
    number = version(spark, root) if number is None else number
    if number == 0:
        return [], []
    rows = spark.read.schema(MANIFEST).parquet(f"{root}/manifests/{number}").collect()
    return [Part(r.name, r.part, f"{root}/{r.path}") for r in rows if r.kind == "part"], [r.name for r in rows if r.kind == "token"]


def _open(spark: SparkSession, parts: list[Part], table: str, schema: T.StructType | str | None, names: list[str] | None) -> DataFrame:
    wanted = None if names is None else set(names)
    paths = [p.path for p in parts if p.table == table and (wanted is None or p.name in wanted)]
    if schema is None:
        return spark.read.parquet(*paths)
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def read(spark: SparkSession, root: str, table: str, schema: T.StructType | str | None = None, parts: list[str] | None = None, number: int | None = None) -> DataFrame:
    """A table, or some of its named parts, as of a version; nothing else is listed or opened. Without a schema there must be a part."""
    return _open(spark, manifest(spark, root, number)[0], table, schema, parts)


class Transaction:
    """Changes of one run to tables below `root`; they take effect when the block ends without an error.

    `done` tells that a run of the same token has been committed already: writes do nothing then.
    """

    def __init__(self, spark: SparkSession, root: str, token: str) -> None:
        self.spark, self.root, self.token = spark, root.rstrip("/"), token
        self.base = version(spark, self.root)
        self.parts, self.tokens = manifest(spark, self.root, self.base)
        self.done = token in self.tokens

    def __enter__(self) -> Transaction:
        return self

    def __exit__(self, kind, error, trace) -> None:
        if kind is None and not self.done:
            self._commit()

    def read(self, table: str, schema: T.StructType | str, parts: list[str] | None = None) -> DataFrame:
        """The table as this run leaves it."""
        return _open(self.spark, self.parts, table, schema, parts)

    def _store(self, table: str, frame: DataFrame, by: str | None = None) -> str:
        path = f"{self.root}/parts/{table}/{uuid.uuid4().hex}"
        writer = frame.write if by is None else frame.write.partitionBy(by)
        writer.parquet(path)
        return path

    def append(self, table: str, frame: DataFrame) -> None:
        if self.done:
            return
        earlier = [p for p in self.parts if p.table == table and p.name == ""]
        if len(earlier) >= MERGE_AFTER:
            frame = self.read(table, frame.schema, [""]).unionByName(frame)
            self.parts = [p for p in self.parts if p not in earlier]
        self.parts.append(Part(table, "", self._store(table, frame)))

    def replace(self, table: str, frame: DataFrame) -> None:
        """The frame may read the table itself: parts are never written over."""
        if self.done:
            return
        path = self._store(table, frame)
        self.parts = [p for p in self.parts if p.table != table] + [Part(table, "", path)]

    def replace_parts(self, table: str, frame: DataFrame, name: str, names: list[str]) -> None:
        """Puts the rows, named by the text column `name`, in place of the parts `names`; one without rows is gone."""
        if self.done or not names:
            return
        path = self._store(table, frame.withColumn("_part", F.col(name)).drop(name).hint("rebalance", "_part"), "_part")
        store, folder = _files(self.spark, path)
        found = {s.getPath().getName().removeprefix("_part=") for s in store.listStatus(folder) if s.isDirectory()}
        if not found <= set(names):
            raise ValueError(f"rows of other parts: {sorted(found - set(names))[:5]}")
        kept = [p for p in self.parts if p.table != table or p.name not in set(names)]
        self.parts = kept + [Part(table, n, f"{path}/_part={n}") for n in sorted(found)]

    def _commit(self) -> None:
        number = self.base + 1
        rows = [("part", p.table, p.name, p.path.removeprefix(f"{self.root}/")) for p in self.parts]
        rows += [("token", t, "", "") for t in [*self.tokens, self.token][-TOKENS_KEPT:]]
        draft = f"{self.root}/manifests/draft-{uuid.uuid4().hex}"
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.parquet(draft)
        jvm, gateway = self.spark._jvm, self.spark.sparkContext._gateway
        hadoop = jvm.org.apache.hadoop.fs
        source, target = hadoop.Path(draft), hadoop.Path(f"{self.root}/manifests/{number}")
        context = hadoop.FileContext.getFileContext(_files(self.spark, draft)[0].getUri(), self.spark._jsc.hadoopConfiguration())
        # Without the option to overwrite, a version that is there makes the rename fail.
        context.rename(source, target, gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0))
        self.done = True


def vacuum(spark: SparkSession, root: str, keep: int = 2) -> int:
    """Removes parts that none of the newest `keep` versions names, and older manifests; gives the number of parts.

    Only for times when no transaction runs: its parts are in no manifest yet.
    """
    newest = version(spark, root)
    numbers = range(max(1, newest - keep + 1), newest + 1)
    used = {p.path.split("/_part=")[0] for n in numbers for p in manifest(spark, root, n)[0]}
    store, folder = _files(spark, f"{root}/parts")
    gone = 0
    for table in store.listStatus(folder) if store.exists(folder) else []:
        for part in store.listStatus(table.getPath()):
            if f"{root}/parts/{table.getPath().getName()}/{part.getPath().getName()}" not in used:
                store.delete(part.getPath(), True)
                gone += 1
    for n in range(1, newest - keep + 1):
        path = _files(spark, f"{root}/manifests/{n}")[1]
        if store.exists(path):
            store.delete(path, True)
    return gone
