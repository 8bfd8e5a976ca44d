"""Writing tables.

A table refresh in the source is "delete + insert, then commit". Here a table
is a directory ``<base>`` of immutable versions ``d=<id>/<period>=.../`` and
snapshots ``<base>/_state/<commit>.json`` of what it holds: the version of every
period. ``publish`` writes the new rows into a fresh version and puts the next
snapshot in place by one rename, last. Readers take the newest snapshot and open
only the directories that it names, so a write that fails leaves the table as it
was, and running it again is safe. One writer per table at a time (the jobs are
run by one scheduler; a second one is refused at its commit). ``vacuum`` removes
versions that no period uses any more.

Scratch output (checkpoints, exports in tests) goes under the shared folder
the cluster names in ``spark.checkpoint.dir``, never a machine-local one.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def shared_dir(spark: SparkSession) -> str:
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d and spark.sparkContext.master.startswith("local"):
        # Local runs and tests only: a cluster must name its shared folder.
        import tempfile
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="palmyra-ckpt-"))
        d = spark.sparkContext.getCheckpointDir()
    if not d:
        raise RuntimeError("spark.checkpoint.dir is not set; point it at a shared folder")
    return d.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/palmyra/{name}-{uuid.uuid4().hex}"


#: Spark's setting that a query's shuffle files go when it ends.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Spark's setting of how many files a task of a write by period may keep open.
OPEN_FILES = "spark.sql.maxConcurrentOutputFileWriters"
#: That number here. A task whose rows are of more periods sorts those of the others.
OPEN_PERIODS = 8


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


@contextmanager
def releasing_shuffles(spark: SparkSession) -> Iterator[None]:
    """Writes in this block remove their shuffle files as they end. What is written is read
    from its own files from then on; else the shuffles of all of a job's writes would stay
    on the executors' disks until the driver happens to collect garbage."""
    with _setting(spark, SHUFFLE_CLEANUP, "true"):
        yield


@contextmanager
def writing_periods(spark: SparkSession) -> Iterator[None]:
    """A write by period in this block keeps a file open for each of a task's periods, where
    Spark would else sort all rows of the task by period, whole rows and on disk if there are
    many. A number that the submitter has set stays."""
    chosen = int(spark.conf.get(OPEN_FILES, "0"))
    with _setting(spark, OPEN_FILES, str(chosen or OPEN_PERIODS)):
        yield


def cut_lineage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Materialize ``df`` as a parquet table in the shared checkpoint folder
    and continue from that table: one pass, columnar, and a lost executor
    only recomputes from the written table, never the lineage before it.
    (``DataFrame.checkpoint`` would compute the plan twice.) Such tables stay until
    the application calls ``clear_stages``."""
    spark = df.sparkSession
    path = f"{_stages(spark)}/{name}-{uuid.uuid4().hex}"
    with releasing_shuffles(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _stages(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/palmyra/stages/{spark.sparkContext.applicationId}"


def clear_stages(spark: SparkSession) -> None:
    """Remove the intermediate tables of this application; to be called when no
    frame is used any more that came from ``cut_lineage``."""
    fs, path = _fs(spark, _stages(spark))
    if fs.exists(path):
        fs.delete(path, True)


#: Snapshots that stay beside the newest one.
KEPT_SNAPSHOTS = 4


def _fs(spark: SparkSession, path: str):
    """Hadoop file system and path: a table may lie in any store."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _snapshots(spark: SparkSession, base: str) -> list:
    """Paths of the table's snapshots, oldest first (names are numbers of fixed width)."""
    fs, folder = _fs(spark, f"{base.rstrip('/')}/_state")
    if not fs.exists(folder):
        return []
    found = [s.getPath() for s in fs.listStatus(folder) if s.getPath().getName().endswith(".json")]
    return sorted(found, key=lambda p: p.getName())


def is_versioned(spark: SparkSession, base: str) -> bool:
    return bool(_snapshots(spark, base))


def table_state(spark: SparkSession, base: str) -> dict:
    """The newest snapshot: seq (the commit), slots ({slot: version}, what readers open)
    and notes ({name: value} that jobs keep with the table). One small file is read and no
    Spark job is run, however many commits there were."""
    found = _snapshots(spark, base)
    if not found:
        return {"seq": 0, "slots": {}, "notes": {}}
    fs, _ = _fs(spark, base)
    stream = fs.open(found[-1])
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def live_slots(spark: SparkSession, base: str) -> tuple[int, dict[str, str]]:
    """(last commit, {slot: version}). A slot is a period directory, e.g.
    "Tahun=1998/Bulan=6", or "" in a table without periods."""
    state = table_state(spark, base)
    return state["seq"], state["slots"]


def slot_values(slot: str) -> dict[str, str]:
    """Partition values of a slot, as Spark wrote them into its path."""
    return {k: unquote(v) for k, _, v in (part.partition("=") for part in slot.split("/")) if k}


def _put_snapshot(spark: SparkSession, base: str, state: dict) -> None:
    """Put a complete snapshot in place by one rename. A snapshot of this number that is
    there already is another writer's, whose commit must not be lost."""
    folder = f"{base.rstrip('/')}/_state"
    fs, target = _fs(spark, f"{folder}/{state['seq']:012d}.json")
    _, draft = _fs(spark, f"{folder}/.{uuid.uuid4().hex}.tmp")
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(state).encode()))
    out.close()
    if fs.exists(target) or not fs.rename(draft, target):
        fs.delete(draft, False)
        raise RuntimeError(f"{base}: commit {state['seq']} was made by another writer")
    for old in _snapshots(spark, base)[:-1 - KEPT_SNAPSHOTS]:
        fs.delete(old, False)


def publish(df: DataFrame, base: str, partitions: Sequence[str] = (), *,
            replaces: Sequence[str] | None = None, replaces_value: dict[str, str] | None = None,
            notes: dict | None = None, check: Callable[[], None] | None = None,
            as_dealt: bool = False) -> int:
    """Write ``df`` as a new version and let readers see it; return the commit.

    ``replaces`` names the slots whose content this is, so one of them that gets no
    row becomes empty; None replaces the whole table; [] adds or replaces just
    the slots that ``df`` has rows of. ``replaces_value`` names partition values, e.g. a
    batch: all slots with one of them are emptied too, whether ``df`` has rows of them or
    not. ``check`` is called when the rows are written and before anyone sees them; what
    it raises leaves the table as it was. Rows are rebalanced by period before they
    are written: a small period becomes one file, a large one is split by size. With
    ``as_dealt`` each task writes its rows of every period itself: for rows that a join
    has just multiplied, whose shuffle would be far larger than those before it.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    path = f"{base.rstrip('/')}/d={version}"
    with releasing_shuffles(spark):
        if partitions:
            out = df if as_dealt else df.hint("rebalance", *partitions)
            with writing_periods(spark):
                out.write.partitionBy(*partitions).parquet(path)
        else:
            df.write.parquet(path)
    slots = _written_slots(spark, path, len(partitions)) if partitions else [""]
    if check:
        check()
    state = table_state(spark, base)
    gone = set(replaces or [])
    kept = {} if replaces is None and not replaces_value else {
        slot: v for slot, v in state["slots"].items() if slot not in gone
        and not any(slot_values(slot).get(k) == x for k, x in (replaces_value or {}).items())}
    _put_snapshot(spark, base, {"seq": state["seq"] + 1, "slots": {**kept, **dict.fromkeys(slots, version)},
                                "notes": {**state["notes"], **(notes or {})}})
    return state["seq"] + 1


def _written_slots(spark: SparkSession, path: str, depth: int) -> list[str]:
    """Period directories of a version, from the listing (no data is read)."""
    fs, root = _fs(spark, path)
    found = [("", root)]
    for _ in range(depth):
        found = [(f"{slot}/{s.getPath().getName()}".lstrip("/"), s.getPath())
                 for slot, at in found for s in fs.listStatus(at) if s.isDirectory()]
    return [slot for slot, _ in found]


def read_current(spark: SparkSession, base: str, schema: T.StructType,
                 slots: Sequence[str] | None = None) -> DataFrame:
    """The table's live rows (or those of some of its slots); ``schema`` has the partition
    columns too. Period filters on the result prune directories."""
    _, live = live_slots(spark, base)
    if slots is not None:
        live = {s: live[s] for s in slots}
    if not live:
        return spark.createDataFrame([], schema)
    base = base.rstrip("/")
    whole = T.StructType([*schema.fields, T.StructField("d", T.StringType())])
    paths = [f"{base}/d={v}/{slot}".rstrip("/") for slot, v in live.items()]
    return spark.read.option("basePath", base).schema(whole).parquet(*paths).drop("d")


def vacuum(spark: SparkSession, base: str) -> list[str]:
    """Remove the versions that no live slot names; return them. To be run when no
    reader still works on an older state and no writer is about."""
    if not is_versioned(spark, base):
        return []
    used = {f"d={v}" for v in live_slots(spark, base)[1].values()}
    fs, root = _fs(spark, base)
    old = [s.getPath() for s in fs.listStatus(root)
           if s.getPath().getName().startswith("d=") and s.getPath().getName() not in used]
    for p in old:
        fs.delete(p, True)
    return [p.getName() for p in old]


def export_csv(df: DataFrame, path: str) -> None:
    """Spreadsheet export, written by the executors in parallel."""
    df.write.mode("errorifexists").option("header", True).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)
