"""Small file-system calls through the Hadoop FileSystem the session uses.

Works for any file system Spark is configured for (local, HDFS, object
stores); only tiny metadata files are read or written here, data always
moves through Spark readers and writers.
"""

from __future__ import annotations

import contextlib
import os
import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


_PATH = re.compile(r"(?:([A-Za-z][A-Za-z0-9+.-]*):)?(?://([^/]*))?(/.*)")


def local_path(spark: SparkSession, path: str) -> str | None:
    """The path on the driver's own disk, if it is one.  There small files go without Hadoop, which starts a process for each it makes."""
    m = _PATH.fullmatch(path)
    if not m or m[2]:
        return None
    scheme = m[1] or str(spark.sparkContext._jsc.hadoopConfiguration().get("fs.defaultFS", "file:///")).partition(":")[0]
    return m[3] if scheme == "file" else None


def exists(spark: SparkSession, path: str) -> bool:
    if (local := local_path(spark, path)) is not None:
        return os.path.exists(local)
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return sorted(str(s.getPath().getName()) for s in fs.listStatus(p))


def list_files(spark: SparkSession, path: str, suffix: str = "") -> list[str]:
    """Data files directly under ``path`` (hidden ``_``/``.`` files skipped)."""
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    out = []
    for s in fs.listStatus(p):
        name = str(s.getPath().getName())
        if s.isFile() and not name.startswith(("_", ".")) and name.endswith(suffix):
            out.append(str(s.getPath().toString()))
    return sorted(out)


#: Stores where a rename copies, but where a create shows the object only once it is whole.
OBJECT_STORES = ("s3a", "s3", "s3n", "gs", "oss", "cosn", "obs")


def write_text_exclusive(spark: SparkSession, path: str, text: str) -> bool:
    """Publish ``path`` with the whole ``text``; False when it exists, whoever published it.

    The text is written in full under a name of its own and then takes the final
    name in one step that fails if the name is taken: a hard link on a local
    disk, elsewhere a rename without overwrite (atomic on HDFS).  In an object
    store the object is put under its final name directly, on the condition that
    there is none; it appears when it is complete.  A reader never meets half a
    file, and a writer that pauses or dies leaves at most its own temporary one.
    """
    if not text and (local := local_path(spark, path)) is not None:  # nothing to be half written
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            os.close(os.open(local, os.O_CREAT | os.O_EXCL | os.O_WRONLY, 0o644))
        except FileExistsError:
            return False
        return True
    fs, p = _fs(spark, path)
    data = bytearray(text.encode("utf-8"))
    scheme = str(fs.getUri().getScheme())
    if scheme in OBJECT_STORES:
        if fs.exists(p):
            return False
        try:
            _write_whole(fs.createFile(p).overwrite(False).opt("fs.option.create.conditional.overwrite", True).build(), data)
        except Py4JJavaError:
            if fs.exists(p):  # another writer's object was there when ours was complete
                return False
            raise
        return True
    folder, _, name = path.rstrip("/").rpartition("/")
    at = f"{folder}/.{name}.{uuid.uuid4().hex}.tmp"
    tmp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(at)
    if (local := local_path(spark, at)) is not None:
        os.makedirs(os.path.dirname(local), exist_ok=True)
        with open(local, "xb") as out:
            out.write(data)
    else:
        fs.mkdirs(p.getParent())
        _write_whole(fs.create(tmp, False), data)
    try:
        return _publish(spark, scheme, tmp, p)
    finally:
        os.remove(local) if local is not None else fs.delete(tmp, False)


def _write_whole(out, data: bytearray) -> None:
    try:
        out.write(data)
    finally:
        out.close()


def _publish(spark: SparkSession, scheme: str, tmp, p) -> bool:
    """Give the complete file ``tmp`` the name ``p``; False when that name is taken."""
    if scheme == "file":
        try:
            os.link(str(tmp.toUri().getPath()), str(p.toUri().getPath()))
            return True
        except FileExistsError:
            return False
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs
    context = hadoop.FileContext.getFileContext(p.toUri(), sc._jsc.hadoopConfiguration())
    options = sc._gateway.new_array(hadoop.Options.Rename, 1)
    options[0] = hadoop.Options.Rename.NONE
    try:
        context.rename(tmp, p, options)
        return True
    except Py4JJavaError as e:
        if "FileAlreadyExists" in str(e.java_exception.getClass().getName()):
            return False
        raise


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file (a temp file of its own name, then rename over the old one)."""
    if (local := local_path(spark, path)) is not None:
        folder, name = os.path.split(local)
        tmp = f"{folder}/.{name}.{uuid.uuid4().hex}.tmp"
        with open(tmp, "wb") as out:
            out.write(text.encode("utf-8"))
        with contextlib.suppress(FileNotFoundError):  # the old text's checksum, if Hadoop wrote it
            os.remove(f"{folder}/.{name}.crc")
        os.replace(tmp, local)
        return
    fs, p = _fs(spark, path)
    jvm = spark.sparkContext._jvm
    tmp = jvm.org.apache.hadoop.fs.Path(p.getParent(), f".{p.getName()}.{uuid.uuid4().hex}.tmp")
    out = fs.create(tmp, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    fs.delete(p, False)
    if not fs.rename(tmp, p):  # another writer was faster: its text is as good
        fs.delete(tmp, False)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path`` (without Hadoop's own checksums), 0 if it is missing."""
    if (local := local_path(spark, path)) is not None and os.path.isdir(local):
        names = (f"{at}/{n}" for at, _, found in os.walk(local) for n in found if not (n.startswith(".") and n.endswith(".crc")))
        return sum(os.path.getsize(n) for n in names)
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def modified_ms(spark: SparkSession, path: str) -> int:
    fs, p = _fs(spark, path)
    return int(fs.getFileStatus(p).getModificationTime())


def read_text(spark: SparkSession, path: str) -> str:
    text = _read_whole(spark, path).decode("utf-8", "replace")
    return text.replace("\r\n", "\n").replace("\r", "\n").removesuffix("\n")


def _read_whole(spark: SparkSession, path: str) -> bytes:
    local = local_path(spark, path)
    if local is not None and not os.path.exists("{}/.{}.crc".format(*os.path.split(local))):  # no checksum that Hadoop would compare
        with contextlib.suppress(OSError), open(local, "rb") as f:  # else Hadoop says why not
            return f.read()
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes())  # one call, as bytes: a manifest of a long log is large
    finally:
        stream.close()


def files_below(spark: SparkSession, path: str) -> list[str]:
    """Data files of all folders below ``path``, listed by Spark in one step (names only, nothing is opened)."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path).select("path").collect()
    return sorted(r["path"] for r in rows)


def set_mtimes(spark: SparkSession, folder: str, millis: dict[str, int]) -> None:
    """Modification times of files below ``folder``."""
    fs, _ = _fs(spark, folder)
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for path, at in millis.items():
        fs.setTimes(make(path), int(at), -1)


def move_into(spark: SparkSession, paths: dict[str, str], folder: str) -> None:
    """Rename files to the given names in ``folder``, which is made if need be."""
    fs, target = _fs(spark, folder)
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs.mkdirs(target)
    for path, name in paths.items():
        if not fs.rename(make(path), make(target, name)):
            raise OSError(f"could not move {path} to {folder}/{name}")


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def delete_on_exit(spark: SparkSession, path: str) -> None:
    """Delete ``path`` when the application ends, if it is still there."""
    fs, p = _fs(spark, path)
    fs.deleteOnExit(p)
