"""Readers and writers of the files a survey leaves: arrays, text tables, partitioned results."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T


def read_arrays(spark: SparkSession, path: str) -> DataFrame:
    """``.npy`` cubes as ``(path, frame, ny, nx, img)``: one row for each frame, images flat in rows."""
    from chronoloom.sources.cubes import read_cubes

    return read_cubes(spark, path)


def read_results(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A Parquet table of a fixed schema; an empty one if there is nothing at the path."""
    from pyspark.errors import AnalysisException

    try:
        df = spark.read.parquet(path)
    except AnalysisException:
        return spark.createDataFrame([], schema)
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])


def read_csv_union(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, name: str = "*.csv", comment: str = "#") -> DataFrame:
    """All CSV files below a folder with one schema; malformed rows drop out. Raises if there are no rows."""
    reader = spark.read.schema(schema).option("header", True).option("comment", comment).option("recursiveFileLookup", True).option("pathGlobFilter", name).option("mode", "DROPMALFORMED")
    df = reader.csv(path)
    if df.isEmpty():
        raise ValueError(f"no rows below {path}")
    return df


def files_without_rows(spark: SparkSession, path: str | Sequence[str], schema: T.StructType, name: str = "*.csv", comment: str = "#") -> DataFrame:
    """Files that ``read_csv_union`` takes nothing from, as ``path``: empty ones and those whose rows are all malformed.

    The names are those that the driver lists for any scan.
    """
    reader = spark.read.schema(schema).option("header", True).option("comment", comment).option("recursiveFileLookup", True).option("pathGlobFilter", name).option("mode", "DROPMALFORMED")
    rows = reader.csv(path)
    plain = lambda c: F.regexp_replace(c, "^file:/+", "file:///")
    listed = spark.createDataFrame([(f,) for f in rows.inputFiles()], "path string").select(plain("path").alias("path"))
    # The greatest hash makes the scan parse every column: a malformed row shows only there.
    used = rows.select(F.hash(*schema.names).alias("_h"), plain("_metadata.file_path").alias("path")).groupBy("path").agg(F.max("_h").alias("_h")).filter("_h is not null")
    return listed.join(used, "path", "left_anti")


def read_spaced(spark: SparkSession, path: str, schema: T.StructType, missing: Sequence[str] = ("None", "-", "--")) -> DataFrame:
    """A text table with columns parted by blanks, ``#`` before its header, and marks for missing values."""
    lines = spark.read.text(path).select(F.split(F.trim("value"), r"\s+").alias("c")).filter("size(c) > 0 and not startswith(c[0], '#') and c[0] <> ''")
    cols = []
    for i, f in enumerate(schema.fields):
        c = F.get("c", F.lit(i))
        cols.append(F.when(~c.isin(*missing), c).try_cast(f.dataType).alias(f.name))
    return lines.select(*cols)


def id_list(column):
    """A list of ids written as text, ``[1, 2]``."""
    return F.from_json(column, "array<bigint>")


def path_parts(column):
    """Sector, camera, detector, cut and the grid's size from a result's path."""
    part = lambda p: F.regexp_extract(column, p, 1).try_cast("int")
    return part(r"Sector(\d+)").alias("sector"), part(r"Cam(\d+)").alias("cam"), part(r"Ccd(\d+)").alias("ccd"), part(r"Cut(\d+)of").alias("cut"), F.sqrt(part(r"of(\d+)")).cast("int").alias("n")


def write_results(df: DataFrame, path: str, partitions: Sequence[str] = ("sector", "cam", "ccd", "cut"), if_absent: bool = False) -> bool:
    """Write a table partitioned by where it comes from; with ``if_absent`` leave one that is complete. True if written."""
    spark = df.sparkSession
    if if_absent:
        done = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
            return False
    have = [p for p in partitions if p in df.columns]
    # Partitions are replaced one by one, or the whole table, which then gets its mark of completion.
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "static" if if_absent else "dynamic")
    (writer.partitionBy(*have) if have else writer).parquet(path)
    return True


def write_table(df: DataFrame, path: str, formats: dict[str, str] | None = None) -> None:
    """A text table: formatted columns parted by blanks; the first part file holds a ``#`` header, the others the rows in order, each part written by its own task."""
    cols = [F.format_string((formats or {}).get(c, "%s"), F.col(c)) for c in df.columns]
    header = df.sparkSession.createDataFrame([("# " + " ".join(df.columns),)], "value string").coalesce(1)
    header.unionByName(df.select(F.concat_ws(" ", *cols).alias("value"))).write.mode("overwrite").text(path)


BLOCK, CARD = 2880, 80


def _cards(data: bytes, extension: int) -> dict[str, str]:
    """Cards of one header of an image file, values as text; empty if the file has no such extension. Headers and data fill whole blocks."""
    at = 0
    for part in range(extension + 1):
        found: dict[str, str] = {}
        while at + CARD <= len(data):
            card = data[at : at + CARD].decode("latin-1")
            at += CARD
            name = card[:8].strip()
            if name == "END":
                break
            if card[8:10] == "= ":
                value = card[10:].strip()
                found.setdefault(name, value[1 : value.index("'", 1)].strip() if value.startswith("'") else value.split("/")[0].strip())
        else:
            return found if part == extension else {}
        if part < extension:
            number = lambda k, missing, found=found: int(float(found.get(k, missing)))
            axes = [number(f"NAXIS{i + 1}", 0) for i in range(number("NAXIS", 0))]
            size = abs(number("BITPIX", 8)) // 8 * number("GCOUNT", 1) * (number("PCOUNT", 0) + int(np.prod(axes))) if axes else 0
            at = -(-at // BLOCK) * BLOCK + -(-size // BLOCK) * BLOCK
    return found


def read_headers(spark: SparkSession, path: str, keys: Sequence[str], extension: int = 0) -> DataFrame:
    """Header cards of image files: ``(path, header map)`` with the wanted keys of one extension (0: the file's first header). Spark lists no files of length zero."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        wanted = set(keys)
        for b in batches:
            rows = [(p, {k: v for k, v in _cards(data, extension).items() if k in wanted}) for p, data in zip(b["path"], b["content"])]
            yield pd.DataFrame(rows, columns=["path", "header"])

    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", "content").mapInPandas(run, "path string, header map<string,string>")


def header_columns(df: DataFrame, required: Sequence[str] = (), optional: Sequence[str] = (), prefix: str = "", suffix: str = "", header: str = "header", path: str = "path", skip: str | None = None, strict: bool = True) -> DataFrame:
    """Keys of a header map as columns ``prefix + key + suffix`` (text; null where absent).

    A row without a required key ends the job if ``strict``, naming key and file;
    else it stays, with ``skip`` (if named) true. Existing columns of those names are
    replaced. A projection: nothing is gathered.
    """
    card = lambda k: F.try_element_at(F.col(header), F.lit(k))
    absent = F.lit(False)
    for k in required:
        absent = absent | card(k).isNull()
    columns = {}
    for k in dict.fromkeys([*required, *optional]):
        value = card(k)
        if strict and k in required:
            value = F.coalesce(value, F.raise_error(F.concat(F.lit(f"key {k} does not exist in file "), F.coalesce(F.col(path).cast("string"), F.lit("?")))).cast("string"))
        columns[f"{prefix}{k}{suffix}"] = value
    if skip:
        columns[skip] = absent
    return df.withColumns(columns)


def manifest(spark: SparkSession, path: str, camera: int, ccd: int, start_mjd: float, end_mjd: float) -> DataFrame:
    """Lines of a download list for one detector and time range: ``(line, mjd)``; the time is in the file's name."""
    from chronoloom.functions.values import mjd_of_stamp

    lines = spark.read.text(path).select(F.col("value").alias("line")).filter(F.col("line").contains(f"-{camera}-{ccd}-"))
    stamped = lines.withColumn("stamp", F.regexp_extract("line", r"(\d{13})", 1)).filter("stamp <> ''")
    return stamped.select("line", mjd_of_stamp(F.col("stamp")).alias("mjd")).filter(F.col("mjd").between(start_mjd, end_mjd))


def drop_results(spark: SparkSession, path: str) -> bool:
    """Remove a table or one of its partitions through the file system that holds it."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True))


def load_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A Parquet table or a CSV one with a header, told by the path's suffix; CSV needs a schema, so that nothing is read twice."""
    if path.rstrip("/").endswith((".parquet", ".pq")):
        return spark.read.parquet(path)
    if path.rstrip("/").endswith(".csv"):
        if schema is None:
            raise ValueError("a CSV table needs a schema")
        return spark.read.schema(schema).option("header", True).csv(path)
    raise ValueError(f"neither Parquet nor CSV: {path}")


def save_table(df: DataFrame, path: str) -> str:
    """Write a table as Parquet or CSV with headers, told by the path's suffix; an existing one is replaced."""
    if path.rstrip("/").endswith((".parquet", ".pq")):
        df.write.mode("overwrite").parquet(path)
    elif path.rstrip("/").endswith(".csv"):
        df.write.mode("overwrite").option("header", True).csv(path)
    else:
        raise ValueError(f"neither Parquet nor CSV: {path}")
    return path


def save_curves(curves: DataFrame, path: str, name: Column, columns: Sequence[str] = ("mjd", "flux", "flux_err")) -> None:
    """Light curves as CSV, one folder ``name=...`` for each, rows in order of time.

    Rows are dealt by name, and a curve is one file; names without rows get none.
    """
    rows = curves.select(name.alias("name"), *columns)
    rows.repartition("name").sortWithinPartitions("name", columns[0]).write.mode("overwrite").option("header", True).partitionBy("name").csv(path)


def lines_table(spark: SparkSession, lines: Sequence[str], schema: T.StructType) -> DataFrame:
    """A small table from lines in memory: columns parted by blanks; blank lines and those with ``#`` first are left out."""
    cells = F.split(F.trim("value"), r"\s+")
    rows = spark.createDataFrame([(x,) for x in lines], "value string").filter("trim(value) <> '' and not startswith(trim(value), '#')")
    return rows.select(*[F.get(cells, F.lit(i)).try_cast(f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])
