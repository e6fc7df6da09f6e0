"""Shared-folder helpers. Only directory names pass through the driver."""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
_scratch: dict[str, list[str]] = {}  # folders of each application


def scratch_root(spark: SparkSession) -> str:
    """A new folder for intermediate tables, in the session's shared checkpoint folder.

    Without that setting only a local session gets one, in the machine's temporary
    folder; a cluster must name a folder that all executors can reach.
    """
    shared = spark.conf.get(CHECKPOINT_CONF, None) or spark.sparkContext.getConf().get(CHECKPOINT_CONF)
    if shared:
        folder = f"{shared.rstrip('/')}/tripfold-{uuid.uuid4().hex}"
    elif spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="tripfold-")
    else:
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder shared by all executors")
    _scratch.setdefault(spark.sparkContext.applicationId, []).append(folder)
    return folder


def remove_scratch(spark: SparkSession) -> int:
    """Removes every scratch folder that this application has made; returns their number.

    DataFrames that read them are of no use afterwards: call it when their results have been written.
    """
    folders = _scratch.pop(spark.sparkContext.applicationId, [])
    for folder in folders:
        remove(spark, folder)
    return len(folders)


def _fs_path(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs_path(spark, path)
    return fs.exists(p)


def make_dir(spark: SparkSession, path: str) -> None:
    fs, p = _fs_path(spark, path)
    fs.mkdirs(p)


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a folder of a table that this library wrote."""
    fs, p = _fs_path(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, source: str, target: str) -> None:
    """Moves a folder to where nothing is yet; one step on file systems that rename at once."""
    fs, p = _fs_path(spark, target)
    fs.mkdirs(p.getParent())
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(source), p):
        raise OSError(f"cannot move {source} to {target}")


def create_file(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> bool:
    """Writes a small file; False, and nothing changed, if there is one already that is not to be overwritten."""
    fs, p = _fs_path(spark, path)
    fs.mkdirs(p.getParent())
    try:
        stream = fs.create(p, overwrite)
    except Py4JJavaError as error:
        if fs.exists(p):
            return False
        raise error
    stream.write(bytearray(text.encode()))
    stream.close()
    return True


def read_file(spark: SparkSession, path: str) -> str:
    """Text of a small file."""
    fs, p = _fs_path(spark, path)
    stream = fs.open(p)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def first_lines(spark: SparkSession, path: str) -> dict[str, str]:
    """First line of every file under `path` that is not empty or hidden; compressed files are unpacked as far as that.

    The names and first lines pass through the driver, many files at a time, and nothing else of the files.
    """
    fs, p = _fs_path(spark, path)
    jvm = spark._jvm
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(fs.getConf())
    found = []
    files = fs.listFiles(p, True)
    while files.hasNext():
        status = files.next()
        name = status.getPath().toString()[len(fs.makeQualified(p).toString()) :]
        if status.getLen() and not any(part[:1] in ("_", ".") for part in name.split("/") if part):
            found.append(status.getPath())

    def line(file) -> str:
        stream, codec = fs.open(file), codecs.getCodec(file)
        stream = codec.createInputStream(stream) if codec else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(stream, "UTF-8"))
        try:
            return reader.readLine() or ""
        finally:
            reader.close()

    with ThreadPoolExecutor(16) as pool:
        return dict(zip([f.toString() for f in found], pool.map(line, found), strict=True))


def file_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isFile() and s.getPath().getName()[0] not in "._")


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs_path(spark, path)
    if not fs.exists(p):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(p) if status.isDirectory())


def is_complete(spark: SparkSession, path: str) -> bool:
    """Whether a write of this folder finished."""
    return exists(spark, f"{path}/_SUCCESS")


def numbered(spark: SparkSession, path: str, prefix: str, above: int = -1) -> list[int]:
    """Numbers N > `above` of the finished folders `prefix=N`, ascending."""
    tags = (n.split("=", 1) for n in child_names(spark, path) if n.startswith(f"{prefix}="))
    later = sorted(int(number) for _, number in tags if int(number) > above)
    return [n for n in later if is_complete(spark, f"{path}/{prefix}={n}")]
