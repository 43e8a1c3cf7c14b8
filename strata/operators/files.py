"""Small files that jobs keep beside their data, through the file system of the path."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession
from pyspark.sql.types import StructType


def _hadoop(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path is there, asked of its file system."""
    fs, place = _hadoop(spark, path)
    return fs.exists(place)


def delete_path(spark: SparkSession, path: str) -> None:
    """Remove a folder that nobody reads."""
    fs, place = _hadoop(spark, path)
    fs.delete(place, True)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder but for hidden ones, sorted; none if it is not there."""
    fs, place = _hadoop(spark, path)
    if not fs.exists(place):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(place)]
    return sorted(n for n in names if not n.startswith((".", "_")))


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the data files of a folder, or of a file, or of a pattern, in order of path."""
    fs, place = _hadoop(spark, path)
    out, waiting = [], list(fs.globStatus(place) or [])
    while waiting:
        status = waiting.pop()
        if status.isDirectory():
            waiting += [s for s in fs.listStatus(status.getPath()) if not s.getPath().getName().startswith((".", "_"))]
        else:
            out.append((status.getPath().toString(), status.getLen()))
    return sorted(out)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file so that readers see the old one or the new one, never a part: it is written
    under another name and renamed over the old one."""
    fs, place = _hadoop(spark, path)
    fs.mkdirs(place.getParent())
    Path = spark._jvm.org.apache.hadoop.fs.Path
    fresh = Path(place.getParent(), f".{place.getName()}.{uuid.uuid4().hex}")
    out = fs.create(fresh, True)
    out.write(bytearray(text.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    kind = getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.valueOf("OVERWRITE")
    context.rename(fs.makeQualified(fresh), fs.makeQualified(place), how)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or None if it is not there."""
    fs, place = _hadoop(spark, path)
    if not fs.exists(place):
        return None
    stream = fs.open(place)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def store_schema(spark: SparkSession, schema: StructType, path: str) -> None:
    write_text(spark, path, schema.json())


def load_schema(spark: SparkSession, path: str) -> StructType | None:
    """A schema stored by ``store_schema``, or None."""
    text = read_text(spark, path)
    return StructType.fromJson(json.loads(text)) if text is not None else None
