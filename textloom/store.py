"""Intermediate tables in the folder that driver and executors share."""

import atexit
import shutil
import tempfile
import uuid

_own: dict[str, str] = {}
_leaving: set[str] = set()


def shared_root(spark) -> str:
    """The session's spark.checkpoint.dir. Where it is unset, as in tests, a temporary folder of this process; on a cluster, whose executors couldn't reach one, an error."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in _own:
        _own[app] = tempfile.mkdtemp(prefix="textloom-")
        atexit.register(shutil.rmtree, _own[app], True)
    return _own[app]


def _file_system(spark, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


def new_path(spark, label: str) -> str:
    """A path that isn't in use, in the application's folder, which goes when the driver ends."""
    folder = f"{shared_root(spark)}/textloom/{spark.sparkContext.applicationId}"
    if folder not in _leaving:
        _leaving.add(folder)
        system, at = _file_system(spark, folder)
        system.mkdirs(at)
        system.deleteOnExit(at)
    return f"{folder}/{uuid.uuid4().hex}-{label}"


def stage(df, label: str, spark=None):
    """df written once as Parquet and read again: later jobs, and retries after a lost executor, start from the files."""
    spark = spark or df.sparkSession
    path = new_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._path = path
    return out


def drop_path(spark, path: str) -> None:
    """Deletes a table of stage() through the file system that holds it."""
    system, at = _file_system(spark, path)
    system.delete(at, True)


def drop(staged) -> None:
    """Deletes a table of stage() that nothing reads any more."""
    drop_path(staged.sparkSession, staged._path)
