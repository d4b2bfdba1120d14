"""Spark sessions and the shared scratch folder."""

from __future__ import annotations

import atexit
import logging
import tempfile
import uuid
from contextlib import suppress
from contextvars import ContextVar
from functools import cache
from threading import Lock

from pyspark import SparkContext
from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


def build_session(app: str, master: str | None = None, **conf: object) -> SparkSession:
    """A named session. Resources, shuffle width and master stay with spark-submit
    unless given here; ``conf`` keys use ``__`` for the dots of a Spark setting."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


# What a task reads where it sorts or groups whole rows: stored, it is a tenth or less of what it takes in memory.
SMALL_READS = {
    "spark.sql.files.maxPartitionBytes": "16m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def small_tasks(spark: SparkSession) -> SparkSession:
    """A session with the settings of this one whose tasks read little enough to sort or group it in memory, at any size
    of the tables. Sizes that the session itself sets stay."""
    small = spark.newSession()
    for key, value in (SMALL_READS | spark.conf.getAll).items():
        if small.conf.get(key, None) != value:
            # Settings of the context are the same for all its sessions.
            with suppress(AnalysisException):
                small.conf.set(key, value)
    return small


class Lease:
    """Owns the scratch folders and databases that are made while it is open, and removes them when its ``with``
    block ends, also after an error. Frames that read from them must be consumed within the block.

    A block within a block owns its own. What is made outside of any block, and what is asked for as ``lasting``, belongs
    to the application and goes when the driver's Python ends.
    """

    def __init__(self):
        self.folders: list[str] = []
        self.databases: list[tuple[SparkSession, str]] = []
        self._lock = Lock()

    def __enter__(self) -> Lease:
        self._token = _lease.set(self)
        return self

    def __exit__(self, *_: object) -> None:
        _lease.reset(self._token)
        self.release()

    def own_folder(self, folder: str) -> None:
        with self._lock:
            self.folders.append(folder)

    def own_database(self, spark: SparkSession, name: str) -> None:
        with self._lock:
            self.databases.append((spark, name))

    def release(self) -> None:
        """Remove everything. Databases go first, whose tables may lie in the folders. All are tried, then the
        first error is raised."""
        with self._lock:
            databases, folders = self.databases, self.folders
            self.databases, self.folders = [], []
        errors: list[Exception] = []
        for spark, name in databases:
            try:
                spark.sql(f"DROP DATABASE IF EXISTS `{name}` CASCADE")
            except Exception as error:  # noqa: BLE001 - raised below
                errors.append(error)
        for folder in folders:
            try:
                _remove(folder)
            except Exception as error:  # noqa: BLE001 - raised below
                errors.append(error)
        if errors:
            raise errors[0]


_lease: ContextVar[Lease | None] = ContextVar("open lease", default=None)
_application = Lease()


def _remove(folder: str) -> None:
    """Remove a folder on whichever file system holds it. The JVM outlives a stopped session."""
    jvm = SparkContext._jvm
    if jvm is None:
        return
    context = SparkContext._active_spark_context
    settings = context._jsc.hadoopConfiguration() if context else jvm.org.apache.hadoop.conf.Configuration()
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(settings).delete(path, True)


def _release_application() -> None:
    """At the end a session may be stopped already and a database gone with it."""
    if SparkContext._active_spark_context is None:
        _application.databases.clear()
    try:
        _application.release()
    except Exception as error:  # noqa: BLE001 - the work is done; what could not be removed is named
        logging.getLogger(__name__).warning("scratch was not removed: %s", error)


@cache
def _application_lease() -> Lease:
    """What the application owns. Its end is registered when the first session is there: what was registered last
    runs first, so the JVM is still up."""
    atexit.register(_release_application)
    return _application


def lease_database(spark: SparkSession, name: str) -> None:
    """Let the open lease, or else the application, own a database."""
    (_lease.get() or _application_lease()).own_database(spark, name)


def scratch_folder(spark: SparkSession, label: str, lasting: bool = False) -> str:
    """A new folder below ``spark.checkpoint.dir`` for tables that a job writes and reads back. The open :class:`Lease`
    owns it; one that is ``lasting`` stays until the application ends.

    Every executor must reach it, so a machine-local folder is used only where the setting
    is missing and the session itself is local.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared:
        folder = f"{shared.rstrip('/')}/marquee-{label}-{uuid.uuid4().hex}"
    elif spark.conf.get("spark.master", "").startswith("local"):
        folder = tempfile.mkdtemp(prefix=f"marquee-{label}-")
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    owner = None if lasting else _lease.get()
    (owner or _application_lease()).own_folder(folder)
    return folder
