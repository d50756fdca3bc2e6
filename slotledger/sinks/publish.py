"""Storing what a run found once and as a whole, whatever is killed or runs at the same time.

A run writes its judged rows to a folder of its own, in one pass: partitioned by the
report they belong to, their outcome, and how many rows one stands for. The outcomes
are counted in what was stored, so a task that runs twice counts once. Then the folder
is renamed to the next number of its journal, which only one run can do: the others see
that the reports have changed and work out their rows again. From the journal the files
of the inserted rows move into the reports. A run that was killed before the rename has
stored nothing; one killed after it is finished by whichever call comes next.

The reports must lie where renaming a folder is atomic and fails if the new name is
taken: a local or network disk, or a distributed file system, but no object store.
"""

from __future__ import annotations

import errno
import hashlib
import json
import os
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from slotledger.schemas import INSERTED, REPORTS, Report

# Table property that holds the folder of a registered report.
PATH_PROPERTY = "slotledger.path"
# The reports that a call publishes together share a journal.
JOURNALS = {name: "components" if name in ("CPU", "Memory") else name for name in REPORTS}
STAGED, JOURNAL = "_staged", "_journal"
# Columns that a staged row has besides those of its report.
REPORT, OUTCOME, TIMES = "report", "outcome", "times"
LABELS = "report string, outcome string, times long"
# Calls that find the reports changed this often give up.
TRIES = 20
# Holds the name of a run in its folder, hidden from readers of tables; the folder is never empty, so no other can take its name.
NAME_FILE = "_run.json"
# Fixed value: the folder name that Spark gives a partition without a value.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def run_name(call: str, *arguments: object) -> str:
    """The name of a call with these arguments; the same whenever it is repeated."""
    told = hashlib.md5(json.dumps([call, *map(str, arguments)]).encode()).hexdigest()
    return f"{call}-{told[:12]}"


# --- files -------------------------------------------------------------------


class Folder:
    """Files and folders under one root, as Spark's file system sees them."""

    def __init__(self, spark: SparkSession, root: str):
        self.given = root
        self.jvm, self.gateway = spark._jvm, spark.sparkContext._gateway
        self.conf = spark._jsc.hadoopConfiguration()
        self.path = self.jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(root).getFileSystem(self.conf)
        self.root = self.fs.makeQualified(self.path(root)).toString().rstrip("/")

    def at(self, name: str):
        return self.path(f"{self.root}/{name}")

    def names(self, name: str) -> list[str]:
        place = self.at(name)
        return [s.getPath().getName() for s in self.fs.listStatus(place)] if self.fs.exists(place) else []

    def folders(self, pattern: str) -> list[str]:
        """Folders by their path from the root."""
        found = self.fs.globStatus(self.at(pattern)) or []
        return [s.getPath().toString().split(f"{self.root}/", 1)[1] for s in found if s.isDirectory()]

    def files(self, name: str) -> Iterator[str]:
        """All files below, by their path from the root."""
        found = self.fs.listFiles(self.at(name), True) if self.fs.exists(self.at(name)) else None
        while found is not None and found.hasNext():
            yield found.next().getPath().toString().split(f"{self.root}/", 1)[1]

    def write(self, name: str, text: str) -> None:
        out = self.fs.create(self.at(name), True)
        out.write(text.encode())
        out.close()

    def move(self, name: str, to: str) -> None:
        self.fs.mkdirs(self.at(to).getParent())
        if not self.fs.rename(self.at(name), self.at(to)) and not self.fs.exists(self.at(to)):
            raise OSError(f"{name} could not be moved to {to}")

    def delete(self, name: str) -> None:
        self.fs.delete(self.at(name), True)

    def claim(self, name: str, to: str) -> bool:
        """Renames a folder, unless there is one of that name already."""
        self.fs.mkdirs(self.at(to).getParent())
        if self.fs.getUri().getScheme() == "file":
            # the one rename that the system itself makes exclusive: onto a folder with something in it
            try:
                os.rename(*[self.at(x).toUri().getPath() for x in (name, to)])
            except OSError as error:
                if error.errno in (errno.ENOTEMPTY, errno.EEXIST):
                    return False
                raise
            return True
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.fs.getUri(), self.conf)
        option = self.jvm.java.lang.Class.forName("org.apache.hadoop.fs.Options$Rename").getEnumConstants()[0]
        options = self.gateway.new_array(getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
        options[0] = option
        try:
            context.rename(self.at(name), self.at(to), options)
        except Py4JJavaError as error:
            if error.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        return True


# --- staging -----------------------------------------------------------------


def _stage(folder: Folder, name: str, rows: DataFrame, report: Report, run: str) -> dict[tuple[str, str], int]:
    """Writes judged rows, and counts their outcomes in what was written."""
    by = [REPORT, OUTCOME, TIMES, *report.partition]
    path = f"{folder.root}/{name}"
    balanced = rows.hint("rebalance", *[F.col(c) for c in by]).sortWithinPartitions(*by, "AgentGUID")
    balanced.write.partitionBy(*by).parquet(path)
    folder.write(f"{name}/{NAME_FILE}", json.dumps({"run": run}))
    stored = rows.sparkSession.read.schema(LABELS).parquet(path)
    counted = stored.groupBy(REPORT, OUTCOME).agg(F.sum(TIMES).alias("n")).collect()
    return {(r[REPORT], r[OUTCOME]): r["n"] for r in counted}


# --- publishing --------------------------------------------------------------


def report_path(directory: str, name: str) -> str:
    return f"{directory.rstrip('/')}/{name}"


def registered(spark: SparkSession, name: str, path: str) -> bool:
    """Did ``create_report_tables`` register the report over this folder?"""
    if not spark.catalog.tableExists(name):
        return False
    properties = spark.sql(f"SHOW TBLPROPERTIES {name}").collect()
    return {r["key"]: r["value"] for r in properties}.get(PATH_PROPERTY) == path


def _partitions(folder: Folder, entry: str) -> dict[str, list[str]]:
    """The partitions of each report that a run has rows for, as ``a=1/b=2``."""
    out = {}
    for part in folder.names(entry):
        if part.startswith(f"{REPORT}="):
            report = part.split("=", 1)[1]
            inside = f"{entry}/{part}/{OUTCOME}={INSERTED}/{TIMES}=1"
            found = folder.folders(f"{inside}/" + "/".join("*" for _ in REPORTS[report].partition))
            out[report] = sorted(f[len(inside) + 1 :] for f in found)
    return out


def _show(spark: SparkSession, directory: str, partitions: dict[str, list[str]]) -> None:
    """Makes partitions known where a report is a registered table over this directory."""
    for report, found in partitions.items():
        if found and registered(spark, report, report_path(directory, report)):
            for partition in found:
                if NO_VALUE in partition:
                    spark.catalog.recoverPartitions(report)
                    continue
                values = [part.split("=", 1) for part in partition.split("/")]
                values = ", ".join(f"{k} = '{unquote(v)}'" for k, v in values)
                spark.sql(f"ALTER TABLE {report} ADD IF NOT EXISTS PARTITION ({values})")
            spark.catalog.refreshTable(report)


def _move_in(folder: Folder, entry: str) -> None:
    """Moves the inserted files of a journal entry into their reports."""
    while True:
        left = [f for f in folder.files(entry) if f"/{OUTCOME}={INSERTED}/" in f and f.endswith(".parquet")]
        for file in left:
            below = file[len(entry) + 1 :].split("/")
            folder.move(file, "/".join([below[0].split("=", 1)[1], *below[3:]]))
        if not left:
            return


def _finish(spark: SparkSession, folder: Folder, entry: str) -> None:
    """Does what is left to do of a journal entry; calls may do it side by side."""
    failed = None
    for _ in range(TRIES):
        try:
            partitions = _partitions(folder, entry)
            _move_in(folder, entry)
            break
        except (Py4JJavaError, OSError) as error:
            failed = error  # as a rule, another call has moved the file
    else:
        raise RuntimeError(f"{entry} could not be moved into the reports") from failed
    _show(spark, folder.given, partitions)
    for report in partitions:
        folder.delete(f"{entry}/{REPORT}={report}")


def catch_up(spark: SparkSession, directory: str, journal: str) -> int:
    """Finishes the last run of a journal if it was killed; the number of runs so far."""
    folder = Folder(spark, directory)
    runs = sorted(int(n) for n in folder.names(f"{JOURNAL}/{journal}") if n.isdigit())
    if runs:
        _finish(spark, folder, f"{JOURNAL}/{journal}/{runs[-1]:010d}")
    return runs[-1] if runs else 0


def publish(
    spark: SparkSession,
    directory: str,
    report: Report,
    run: str,
    work: Callable[[], DataFrame],
    depends: bool = True,
) -> dict[tuple[str, str], int]:
    """Stores the inserted ones of the judged rows that ``work`` gives; rows by report and outcome.

    ``work`` reads the reports as they are when it is called. If another run has
    published meanwhile it is called again, unless its rows do not depend on the
    reports. Rows carry ``report``, ``outcome`` and ``times`` (how many rows one
    stands for, a power of two, 1 if inserted), and the stored columns of ``report``.
    """
    folder, journal = Folder(spark, directory), JOURNALS[report.name]
    staged, counts = "", {}
    for _ in range(TRIES):
        version = catch_up(spark, directory, journal)
        if depends or not staged:
            staged = f"{STAGED}/{journal}/{run}-{uuid.uuid4().hex}"
            counts = _stage(folder, staged, work(), report, run)
        if not any(outcome == INSERTED for _, outcome in counts):
            folder.delete(staged)
            return counts
        partitions = _partitions(folder, staged)
        entry = f"{JOURNAL}/{journal}/{version + 1:010d}"
        if folder.claim(staged, entry):
            _finish(spark, folder, entry)
            _show(spark, directory, partitions)  # all of them, whoever has moved the files
            return counts
        if depends:
            folder.delete(staged)
    raise RuntimeError(f"{run}: the reports have changed {TRIES} times meanwhile")


def discard_staged(spark: SparkSession, directory: str) -> list[str]:
    """Deletes what killed calls have staged; to be called while no other call runs."""
    folder = Folder(spark, directory)
    left = [f"{STAGED}/{j}/{a}" for j in folder.names(STAGED) for a in folder.names(f"{STAGED}/{j}")]
    for name in left:
        folder.delete(name)
    return left
