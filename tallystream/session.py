"""Session settings and the shared working folder."""

from __future__ import annotations

import math
import tempfile
import uuid
import weakref
from contextlib import contextmanager
from pathlib import Path
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

_local_folders: dict[str, str] = {}


def build_session(app: str = "tallystream", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; keyword names use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for name, value in conf.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


#: The zone and cast mode that results are defined in.
_DEFINED = {"spark.sql.session.timeZone": "UTC", "spark.sql.ansi.enabled": "true"}
_prepared: weakref.WeakKeyDictionary[SparkSession, SparkSession] = weakref.WeakKeyDictionary()


def prepare(spark: SparkSession) -> SparkSession:
    """A session in the zone and cast mode that results are defined in.

    It is the given one if that has them, else one beside it with the same other settings and the same catalogue; the
    given one stays as it is.
    """
    if all(spark.conf.get(name).lower() == value.lower() for name, value in _DEFINED.items()):
        return spark
    own = _prepared.get(spark)
    if own is None:
        own = _prepared[spark] = spark.newSession()
    has = own.conf.getAll
    for name, value in (spark.conf.getAll | _DEFINED).items():
        if has.get(name) != value and own.conf.isModifiable(name):
            own.conf.set(name, value)
    return own


@contextmanager
def settings(spark: SparkSession, **conf: str):
    """Set runtime options for the enclosed actions and put the old values back afterwards."""
    wanted = {name.replace("__", "."): value for name, value in conf.items()}
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


ROWS_PER_TASK = 2_000_000


def shuffle_tasks(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame, rows: int, *keys: str, rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """Shuffle rows by key into as many tasks as their number asks for.

    Where the session's number of shuffle tasks is enough, the next step shuffles by itself, with that
    number, and adaptive execution packs small tasks together; a fixed number would prevent that.
    """
    tasks = math.ceil(rows / rows_per_task)
    return df.repartition(tasks, *keys) if tasks > shuffle_tasks(df.sparkSession) else df


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach.

    It is the one named in ``spark.checkpoint.dir``, or set on the context. Without either a temporary
    folder serves a session of one process only; on a cluster a machine-local folder would be lost with
    its machine. For the same reason a cluster of several machines may not name a machine's temporary folder.
    """
    context = spark.sparkContext
    configured = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if configured:
        path = urlparse(configured)
        temporary = path.scheme == "file" and path.path.startswith(tempfile.gettempdir().rstrip("/") + "/")
        if temporary and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names a folder of one machine; all executors must reach it")
        return configured.rstrip("/")
    if not context.master.startswith(("local[", "local:")) and context.master != "local":
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors can reach")
    app = context.applicationId
    if app not in _local_folders:
        _local_folders[app] = Path(tempfile.mkdtemp(prefix="run-")).as_uri()
    return _local_folders[app]


def scratch(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no other call gets."""
    return f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
