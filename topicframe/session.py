"""Session helpers: a tuned local session for tests/bench and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def get_session(cpus: int | str = "*", app: str = "topicframe") -> SparkSession:
    """Local session sized for tests and the benchmark.

    On a cluster the caller's session is used as it is; this builder only
    exists for local runs.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus if cpus != "*" else 8))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without one gets a temporary folder: on a cluster
    each machine would write to its own disk, so there the setting is required.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir()
    if root:
        return root
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not (sc.master or "").startswith("local") or (sc.master or "").startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="topicframe-ckpt-")
    sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def work_dir(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/topicframe/{name}-{uuid.uuid4().hex[:12]}"


def _fs(spark: SparkSession, path: str):
    """Hadoop's file system of ``path`` and its Path class: works for any shared store."""
    hpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hpath = _fs(spark, path)
    return bool(fs.exists(hpath))


def path_stamp(spark: SparkSession, path: str) -> tuple:
    """Modification time and length of a file or folder; empty when it does not exist."""
    fs, hpath = _fs(spark, path)
    if not fs.exists(hpath):
        return ()
    status = fs.getFileStatus(hpath)
    return (status.getModificationTime(), status.getLen())


def rename(spark: SparkSession, old: str, new: str) -> None:
    fs, hpath = _fs(spark, old)
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(new)
    fs.mkdirs(target.getParent())
    if fs.exists(target) or not fs.rename(hpath, target):
        raise OSError(f"cannot rename {old} to {new}")


def write_file(spark: SparkSession, path: str, text: str) -> None:
    """Write ``text`` to a new file."""
    fs, hpath = _fs(spark, path)
    out = fs.create(hpath, False)
    out.write(text.encode("utf-8"))
    out.close()


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create ``path`` with ``text`` at once, or leave what is there and return False.

    The text is written beside it first. A local file is then linked, which
    fails where the name is taken; elsewhere Hadoop's rename without the
    overwrite option does that.
    """
    fs, hpath = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    fs.mkdirs(hpath.getParent())
    beside = jvm.org.apache.hadoop.fs.Path(hpath.getParent(), f".{uuid.uuid4().hex}.tmp")
    out = fs.create(beside, False)
    out.write(text.encode("utf-8"))
    out.close()
    try:
        if fs.getScheme() == "file":
            local = [jvm.java.nio.file.Paths.get(p.toUri().getPath(), spark.sparkContext._gateway.new_array(jvm.java.lang.String, 0)) for p in (hpath, beside)]
            jvm.java.nio.file.Files.createLink(*local)
        else:
            none = spark.sparkContext._gateway.new_array(getattr(jvm, "org.apache.hadoop.fs.Options$Rename"), 0)
            jvm.org.apache.hadoop.fs.FileContext.getFileContext(hpath.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(beside, hpath, none)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    finally:
        fs.delete(beside, False)


def list_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in ``path`` (empty when it does not exist)."""
    fs, hpath = _fs(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath) if s.isFile())


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this package wrote."""
    fs, hpath = _fs(spark, path)
    fs.delete(hpath, True)


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path`` (empty when it does not exist)."""
    fs, hpath = _fs(spark, path)
    if not fs.exists(hpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hpath) if s.isDirectory())
