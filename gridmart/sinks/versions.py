"""Tables whose files are replaced one by one while others read them.

Every load writes a folder of its own, ``load=<id>/source_file=<key>``. Which folder holds a key's rows now stands in
a pointer: a numbered JSON file under ``_current`` that is written last. A reader takes the highest complete pointer and reads
only folders named there, so it sees the table before a load or after it, never both or none, for as long as
those folders are kept. Two writers can't both write a number: the later one reads the pointer again and puts its keys on top.

Rows are replaced by key: loading a key twice changes nothing, and a key whose load has no rows is no longer there.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

POINTERS = "_current"
KEY = "source_file"


@dataclass
class Version:
    number: int = 0
    #: key -> {"load": folder of the load, or "" for files from before, and what else is known of it}
    files: dict[str, dict] = field(default_factory=dict)
    #: Fields of the last load, as JSON
    schema: str | None = None


class _Folder:
    """A table's folder, seen through the file system that Spark uses for it."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm, context = spark.sparkContext._jvm, spark.sparkContext
        self.path = path.rstrip("/")
        self.store = self._at("").getFileSystem(context._jsc.hadoopConfiguration())
        self.names = self.jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils

    def _at(self, name: str):
        return self.jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)

    def children(self, name: str = "") -> list[str]:
        at = self._at(name)
        if not self.store.exists(at):
            return []
        return [s.getPath().getName() for s in self.store.listStatus(at)]

    def keys(self, load: str) -> list[str]:
        prefix = f"{KEY}="
        return [
            self.names.unescapePathName(c[len(prefix) :]) for c in self.children(load) if c.startswith(prefix)
        ]

    def place(self, key: str, load: str) -> str:
        own = f"{KEY}={self.names.escapePathName(key)}"
        return f"{self.path}/{load}/{own}" if load else f"{self.path}/{own}"

    def read(self, name: str) -> str:
        stream = self.store.open(self._at(name))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def create(self, name: str, text: str) -> bool:
        """Whether the file is new and written; never replaces one."""
        try:
            stream = self.store.create(self._at(name), False)
        except Py4JJavaError as error:
            if "AlreadyExists" in str(error.java_exception.getClass()) or self.store.exists(self._at(name)):
                return False
            raise
        try:
            stream.write(bytearray(text, "utf-8"))
        finally:
            stream.close()
        return True

    def delete(self, name: str) -> None:
        self.store.delete(self._at(name), True)


def _numbers(folder: _Folder) -> list[int]:
    found = (c.removesuffix(".json") for c in folder.children(POINTERS) if c.endswith(".json"))
    return sorted((int(n) for n in found if n.isdigit()), reverse=True)


def _pointer(number: int) -> str:
    return f"{POINTERS}/{number:012d}.json"


def current(spark: SparkSession, path: str) -> Version | None:
    """The version that readers see; None for a folder that has none (yet)."""
    folder = _Folder(spark, path)
    for number in _numbers(folder):
        try:
            found = json.loads(folder.read(_pointer(number)))
            return Version(number, found["files"], found.get("schema"))
        except (ValueError, KeyError):
            continue  # being written at this moment
    return None


def _before(folder: _Folder) -> Version:
    """Files that lie in the folder without a pointer are its first version."""
    return Version(0, {key: {"load": ""} for key in folder.keys("")})


def commit(
    spark: SparkSession,
    path: str,
    change: Callable[[dict[str, dict]], dict[str, dict]],
    schema: str | None = None,
) -> Version:
    """Write the pointer after the current one with ``change`` of its files, again if someone was faster."""
    folder = _Folder(spark, path)
    while True:
        now = current(spark, path) or _before(folder)
        number = max([now.number, *_numbers(folder)]) + 1
        new = Version(number, change(dict(now.files)), schema or now.schema)
        text = json.dumps({"files": new.files, "schema": new.schema}, sort_keys=True)
        if folder.create(_pointer(number), text):
            return new


def replace(df: DataFrame, path: str, keys: list[str], known: dict[str, dict] | None = None) -> Version:
    """Replace the rows of ``keys`` by those of ``df``, which may have rows of other keys too; keep all others.

    ``known`` is kept beside a key (its fingerprint, say). A load that fails before its commit changes nothing; its
    folder is removed by `vacuum`.
    """
    load = f"load={uuid.uuid4().hex}"
    df.write.option("compression", "zstd").partitionBy(KEY).parquet(f"{path.rstrip('/')}/{load}")
    written = _Folder(df.sparkSession, path).keys(load)
    known = known or {}

    def change(files: dict[str, dict]) -> dict[str, dict]:
        kept = {k: v for k, v in files.items() if k not in keys}
        return kept | {k: {**known.get(k, {}), "load": load} for k in written}

    return commit(df.sparkSession, path, change, df.schema.json())


def remove(spark: SparkSession, path: str, keys: list[str]) -> Version:
    """A version without ``keys``."""
    return commit(spark, path, lambda files: {k: v for k, v in files.items() if k not in keys})


def read(
    spark: SparkSession, path: str, schema: str | StructType | None = None, keys: list[str] | None = None
) -> DataFrame:
    """The table as the pointer shows it at this moment, or only ``keys`` of it; other folders are not listed.

    Without ``schema`` its fields are those of the last load.
    """
    path = path.rstrip("/")
    now = current(spark, path)
    if schema is None:
        if now is None or now.schema is None:
            raise ValueError(f"nothing has been loaded into {path}")
        schema = StructType.fromJson(json.loads(now.schema))
    if now is None:
        found = spark.read.schema(schema).parquet(path)
        return found if keys is None else found.filter(found[KEY].isin(keys))
    folder = _Folder(spark, path)
    chosen = [(k, v["load"]) for k, v in sorted(now.files.items()) if keys is None or k in keys]
    empty, found = spark.createDataFrame([], schema), None
    # Folders from before the first pointer lie one level higher.
    for old in (True, False):
        places = [folder.place(k, load) for k, load in chosen if (load == "") == old]
        if places:
            part = spark.read.schema(schema).option("basePath", path).parquet(*places).select(*empty.columns)
            found = part if found is None else found.unionByName(part)
    return empty if found is None else found


def vacuum(spark: SparkSession, path: str, keep: int = 2) -> int:
    """Delete the loads that none of the last ``keep`` versions names, and older pointers. Returns their number.

    For times without writers; readers of one of those versions are not disturbed.
    """
    folder = _Folder(spark, path)
    numbers = _numbers(folder)
    used = set()
    for number in numbers[:keep]:
        used |= {v["load"] for v in json.loads(folder.read(_pointer(number)))["files"].values()}
    gone = [c for c in folder.children() if c.startswith("load=") and c not in used]
    if numbers and "" not in used:
        gone += [c for c in folder.children() if c.startswith(f"{KEY}=")]
    for name in [*gone, *map(_pointer, numbers[keep:])]:
        folder.delete(name)
    return len(gone)
