"""File sources: CSV, JSON lines, Parquet tables."""

from __future__ import annotations

import csv
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.casts import cast_by_name
from strata.operators.files import list_files
from strata.operators.marts import head_rows


def check_header(spark: SparkSession, path: str, sep: str = ",") -> list[str]:
    """Header names as written, trimmed; blank or duplicate names raise.

    Spark silently names a blank header ``_c<i>`` and renames duplicates by
    position, which changes what downstream code selects. Only the first
    line of the input is read.
    """
    first = spark.read.text(path).first()
    raw = next(csv.reader([first.value if first else ""], delimiter=sep))
    names = [n.strip() for n in raw]
    blank = [i for i, n in enumerate(names) if not n]
    lowered = [n.lower() for n in names]
    dups = sorted({n for n in lowered if lowered.count(n) > 1})
    if blank or dups:
        raise ValueError(f"bad CSV header: blank positions={blank} duplicates={dups}")
    return names


def read_csv(spark: SparkSession, path: str | list[str], infer: bool = True,
             types: dict[str, str] | None = None, null_value: str | None = None,
             options: dict[str, str] | None = None, validate_header: bool = False) -> DataFrame:
    """Header CSV, every column kept.

    ``infer=True`` reproduces the source job (a schema-inference pass, then
    the read). At scale, pass ``infer=False`` with ``types``: the file is read
    once as text and the named columns are cast by name, never by position.
    A file whose header differs in names or order stops the read.
    ``null_value`` marks an extra missing-value token (e.g. ``NA``);
    ``validate_header`` trims names and rejects blank or duplicate ones.
    """
    # enforceSchema off: the header of every file is checked against the schema as it is read
    reader = spark.read.option("header", True).option("inferSchema", infer).option("enforceSchema", False)
    if null_value is not None:
        reader = reader.option("nullValue", null_value)
    for k, v in (options or {}).items():
        reader = reader.option(k, v)
    names = check_header(spark, path, (options or {}).get("sep", ",")) if validate_header else None
    df = reader.csv(path)
    if names is not None and names != df.columns:
        df = df.toDF(*names)
    if types:
        df = cast_by_name(df, types)
    return df


def read_reference(spark: SparkSession, path: str, key: str = "state_code",
                   value: str = "state_name") -> DataFrame:
    """Small ``key,value`` reference CSV (e.g. state code -> name)."""
    return read_csv(spark, path, infer=True).select(key, value)


def read_json_lines(spark: SparkSession, path: str, schema=None, mode: str = "FAILFAST") -> DataFrame:
    """JSON lines. Without a schema, Spark infers one in a distributed pass:
    an int in one file and a float in another become double, text and number
    become string, and columns come back sorted by name."""
    reader = spark.read.option("mode", mode)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.json(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table: ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def head_in_file_order(df: DataFrame, n: int | None) -> DataFrame:
    """The first ``n`` rows of a file scan in file order (``None`` = all), by reading all of it.

    File order is (file path, byte offset of the split, row position inside
    the task), taken from the scan's hidden ``_metadata`` columns, so ``df``
    must be a direct file read. The ordered head is ``head_rows``'s bounded
    top-n. ``head_of_files`` reads only what it needs.
    """
    if n is None:
        return df
    if n < 0:
        raise ValueError("n must be >= 0 or None")
    cols = df.columns
    keyed = df.select(
        *cols,
        F.col("_metadata.file_path").alias("__file"),
        F.col("_metadata.file_block_start").alias("__block"),
        F.monotonically_increasing_id().alias("__pos"),
    )
    return head_rows(keyed, n, ["__file", "__block", "__pos"]).select(*cols)


# Files looked at together: at most this many bytes (a larger file is looked at alone).
WINDOW_BYTES = 256 * 1024 * 1024
# A rest of at most this many rows of a file with several splits passes through the driver.
TAKE_ROWS = 100_000


def head_of_files(spark: SparkSession, path: str, n: int, read: Callable[[list[str]], DataFrame]) -> DataFrame:
    """The first ``n`` rows of a file, folder or pattern in file order (path, then place in the file),
    reading little more than those: a cursor over the files, in windows that double, stops once ``n``
    rows are there. ``read`` gives the frame of some of the files, one row after the other.

    Files before the last one are read whole. Of the last one, a file of one split is read by a limit,
    which stops there; of a larger one splits are tried from the front (``take``), and at most
    ``TAKE_ROWS`` rows come to the driver; only a rest beyond that reads that file to its end.
    """
    if n < 0:
        raise ValueError("n must be >= 0")
    files = list_files(spark, path)
    if not files:
        raise FileNotFoundError(f"no files: {path}")
    whole: list[str] = []
    rest: DataFrame | None = None
    have, at, width = 0, 0, 1
    while at < len(files) and have < n and rest is None:
        window = [files[at][0]]
        size = files[at][1]
        while len(window) < width and at + len(window) < len(files) and size + files[at + len(window)][1] <= WINDOW_BYTES:
            size += files[at + len(window)][1]
            window.append(files[at + len(window)][0])
        counts = dict.fromkeys(window, n) if len(window) == 1 else {
            r["file"]: r["count"] for r in read(window).groupBy(F.col("_metadata.file_path").alias("file")).count().collect()}
        counts = {_place(spark, name): c for name, c in counts.items()}
        for name in window:
            # a file by itself is not counted beforehand: its first rows tell
            if len(window) > 1 and have + counts.get(_place(spark, name), 0) <= n:
                have += counts.get(_place(spark, name), 0)
                whole.append(name)
                continue
            got, first = _head_of_file(spark, read([name]), n - have)
            if got < n - have:
                whole.append(name)
                have += got
                continue
            have, rest = n, first
            break
        at += len(window)
        width *= 2
    frames = ([read(whole)] if whole else []) + ([rest] if rest is not None else [])
    return reduce(DataFrame.unionByName, frames) if frames else read([files[0][0]]).limit(0)


def _place(spark: SparkSession, name: str) -> str:
    """A file's name in one spelling: ``file:/x`` and ``file:///x`` are the same, ``%20`` is a blank."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(name) if "%" in name else name).toUri().getPath()


def _head_of_file(spark: SparkSession, df: DataFrame, n: int) -> tuple[int, DataFrame]:
    """(rows found, at most ``n``; the first ``n`` rows of the file)."""
    if df.rdd.getNumPartitions() <= 1:
        return df.select(F.lit(1)).limit(n).count(), df.limit(n)
    if n <= TAKE_ROWS:
        rows = df.take(n)  # runs the first split, then four times as many, until the rows are there
        return len(rows), spark.createDataFrame(rows, df.schema)
    return min(n, df.count()), head_in_file_order(df, n)
