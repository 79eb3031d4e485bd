"""Stored tables: Parquet folders in versions, and one small file that says which versions are current.

Every write goes to a new folder. Which folder holds each table is said by the newest state file, a new file of
the next number, which appears complete by a rename. So a reader that looks the state up once sees tables of one
refresh, whatever is being written, and a write that fails or is killed changes nothing that is read.
"""

from __future__ import annotations

import json
import time
import uuid
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEPT_STATES = 2  # the current state, and the one that running readers may have looked up before it
ABANDONED_HOURS = 7 * 24  # folders of no state that are older were left by a killed refresh
VERSION = "version-"  # what folders of tables begin with; no other folder is ever cleaned
ATTEMPTS = 20  # to find a free number, where refreshes end at the same moment


def file_system(spark: SparkSession, path: str):
    """Hadoop's view of a path, and its file system."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder of any file system that Spark reaches."""
    target, files = file_system(spark, path)
    files.delete(target, True)


class TableStore:
    """Versioned Parquet tables under ``root``, a path every executor can reach."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, folder: str) -> str:
        return f"{self.root}/{folder}"

    def write(self, name: str, rows: DataFrame, version: str) -> str:
        """Write ``rows`` as a version of ``name``; returns its folder, which no state names yet."""
        folder = f"{VERSION}{version}/{name}"
        rows.write.parquet(self.path(folder))
        return folder

    def replace(self, name: str, rows: DataFrame) -> DataFrame:
        """Write ``rows`` as the whole content of ``name`` and return the stored table."""
        folder = self.write(name, rows, uuid.uuid4().hex)
        self.commit({name: folder}, whole=False)
        return self.read_folder(folder, rows.schema)

    def read(self, name: str, schema=None) -> DataFrame:
        return self.read_folder(self.state()[name], schema)

    def read_folder(self, folder: str, schema=None) -> DataFrame:
        reader = self.spark.read if schema is None else self.spark.read.schema(schema)
        return reader.parquet(self.path(folder))

    def state(self) -> dict[str, str]:
        """The folder of each current table."""
        known = self.states()
        return self.tables_of(known[-1]) if known else {}

    def commit(self, folders: dict[str, str], whole: bool = True) -> None:
        """Make ``folders`` current, all at once; other tables stay, or go if the folders are the ``whole`` state."""
        for _ in range(ATTEMPTS):
            known = self.states()
            tables = dict(folders) if whole or not known else self.tables_of(known[-1]) | folders
            if self.publish((known[-1] if known else 0) + 1, tables):
                break
        else:
            raise RuntimeError(f"{self.root}: another writer took every number")
        self.clean()

    def publish(self, number: int, tables: dict[str, str]) -> bool:
        """Write a state file; false if the number is taken."""
        draft, files = file_system(self.spark, self.path(f"_states/.draft-{uuid.uuid4().hex}"))
        stream = files.create(draft, False)
        stream.write(bytearray(json.dumps(tables, sort_keys=True).encode()))
        stream.close()
        target, _ = file_system(self.spark, self.state_path(number))
        if not files.exists(target) and files.rename(draft, target):
            return True
        files.delete(draft, False)
        return False

    def state_path(self, number: int) -> str:
        return self.path(f"_states/{number:012d}.json")

    def states(self) -> list[int]:
        """Numbers of the state files, ascending."""
        target, files = file_system(self.spark, self.path("_states/*.json"))
        return sorted(int(found.getPath().getName().removesuffix(".json")) for found in files.globStatus(target) or ())

    def tables_of(self, number: int) -> dict[str, str]:
        target, files = file_system(self.spark, self.state_path(number))
        stream = files.open(target)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def clean(self, kept: int = KEPT_STATES, abandoned_hours: float = ABANDONED_HOURS) -> None:
        """Remove states but the last ``kept``, folders that only removed states name, and abandoned ones.

        A folder that no state names may be one of a refresh that is still running, so it goes only when it is old.
        """
        known = self.states()
        used = {folder for number in known[-kept:] for folder in self.tables_of(number).values()}
        for number in known[:-kept]:
            try:
                folders = set(self.tables_of(number).values())
            except Py4JJavaError:  # another writer is cleaning as well
                continue
            for folder in folders - used:
                target, files = file_system(self.spark, self.path(folder))
                files.delete(target, True)
                if not files.listStatus(target.getParent()):
                    files.delete(target.getParent(), False)
            remove(self.spark, self.state_path(number))
        versions = {folder.split("/")[0] for folder in used}
        target, files = file_system(self.spark, self.path(f"{VERSION}*"))
        for found in files.globStatus(target) or ():
            age = time.time() - found.getModificationTime() / 1000
            if found.getPath().getName() not in versions and age > abandoned_hours * 3600:
                files.delete(found.getPath(), True)

    def discard(self, version: str) -> None:
        """Remove every table of a version that was never made current."""
        remove(self.spark, self.path(f"{VERSION}{version}"))

    def scratch(self, label: str) -> str:
        """A new folder for an intermediate result; no two calls share one."""
        return f"{self.root}/_scratch/{label}-{uuid.uuid4().hex}"

    def clear_scratch(self, label: str) -> None:
        """Remove the intermediate results of ``label``, once nothing reads them any more."""
        folders, files = file_system(self.spark, f"{self.root}/_scratch/{label}-*")
        for found in files.globStatus(folders) or ():
            files.delete(found.getPath(), True)


COUNTS = ("source_rows", "target_rows", "malformed_rows", "null_ids")


def reconcile(pairs: dict[str, tuple[DataFrame, DataFrame]], identity: str = "id",
              malformed: str = "_malformed") -> DataFrame:
    """Row counts of source and target per table, and whether they agree.

    Also counts the source's records marked in column ``malformed``, if it has one, and those without an
    ``identity``.
    """
    counts = []
    for name, (source, target) in pairs.items():
        broken = F.sum(malformed) if malformed in source.columns else F.lit(0)
        of_source = {
            "source_rows": F.count("*"), "malformed_rows": F.coalesce(broken, F.lit(0)),
            "null_ids": F.count("*") - F.count(identity),
        }
        for rows, known in ((source, of_source), (target, {"target_rows": F.count("*")})):
            counted = rows.agg(*[v.cast("bigint").alias(k) for k, v in known.items()])
            counts.append(counted.select(
                F.lit(name).alias("table_name"),
                *[F.col(c) if c in known else F.lit(0).cast("bigint").alias(c) for c in COUNTS],
            ))
    return (
        reduce(DataFrame.unionAll, counts)
        .groupBy("table_name")
        .agg(*[F.sum(c).alias(c) for c in COUNTS])
        .withColumn("complete", (F.col("source_rows") == F.col("target_rows")).cast("int"))
    )
