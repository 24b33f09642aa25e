"""Files that executors write and read themselves, in a folder all of them share.

Spark's own writers cover Parquet and text; the binary token and archive
formats are written by tasks through ``pyarrow.fs``, which takes local paths and
``file:``, ``hdfs:``, ``s3:`` / ``s3a:`` and ``gs:`` addresses. A file is written under a
temporary name of its task attempt and renamed when whole, so a repeated or
speculative attempt replaces equal bytes and a lost one leaves nothing under a
final name.
"""

from __future__ import annotations

import posixpath
import zipfile
from contextlib import contextmanager
from pathlib import Path

from pyarrow import fs
from pyspark.sql import SparkSession


def qualified(spark: SparkSession, path: str) -> str:
    """The address that Spark's own readers and writers take ``path`` for: one without a scheme
    lies on the session's default filesystem, which tasks must be told."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()


def resolve(path: str) -> tuple[fs.FileSystem, str]:
    """The filesystem and path of an address; one without a scheme is local (see ``qualified``)."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[len("file:"):].lstrip("/")
    if "://" not in path:
        return fs.LocalFileSystem(), path
    if path.startswith("s3a://"):
        path = "s3://" + path[len("s3a://"):]
    return fs.FileSystem.from_uri(path)


@contextmanager
def committed_output(path: str, attempt: str):
    """An output stream whose file gets its final name only if the block ends well."""
    system, final = resolve(path)
    system.create_dir(posixpath.dirname(final), recursive=True)
    temporary = f"{posixpath.dirname(final)}/_temporary-{attempt}-{posixpath.basename(final)}"
    try:
        with system.open_output_stream(temporary, compression=None) as out:
            yield out
    except BaseException:
        if system.get_file_info(temporary).type != fs.FileType.NotFound:
            system.delete_file(temporary)
        raise
    system.move(temporary, final)


def open_input(path: str):
    system, p = resolve(path)
    return system.open_input_file(p)


def ship_package(spark: SparkSession) -> None:
    """Send this package's code to the executors, once per application."""
    sc = spark.sparkContext
    if getattr(sc, "_hourglass_shipped", False):
        return
    import tempfile

    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp(prefix="hourglass-code-")) / "hourglass_code.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    sc.addPyFile(str(archive))   # served by the driver's own file server
    sc._hourglass_shipped = True
