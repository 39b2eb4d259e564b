"""Image cubes in ``.npy`` files as a data source that plans ranges of frames, whatever a file's size.

The driver reads each file's header alone; a task opens its file, goes to its
first frame and reads a few frames at a time. A cube of any size is so split over
tasks, and no value holds more than a frame.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

#: Bytes of frames that a task reads at once.
STEP = 8 << 20
SCHEMA = "path string, frame long, ny int, nx int, img array<float>"


def _system(path: str):
    """File system and path in it, of a local path or a URI."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _header(f) -> tuple[tuple[int, ...], np.dtype, int]:
    """Shape, type and first byte of the values of an open ``.npy`` file."""
    version = np.lib.format.read_magic(f)
    if version not in ((1, 0), (2, 0)):
        raise ValueError("an unknown version of the array format")
    shape, by_columns, kind = (np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0)(f)
    if kind.hasobject or len(shape) not in (1, 2, 3) or by_columns and len(shape) > 1:
        raise ValueError("cubes are arrays of numbers in one to three dimensions, row by row")
    return shape, kind, f.tell()


class Frames(InputPartition):
    """Frames [begin, end) of a file, whose values begin at a byte."""

    def __init__(self, path: str, at: int, begin: int, end: int, ny: int, nx: int, kind: str):
        self.path, self.at, self.begin, self.end, self.ny, self.nx, self.kind = path, at, begin, end, ny, nx, kind


class CubeReader(DataSourceReader):
    def __init__(self, options):
        self.paths = options["path"].split("\n")
        self.bytes = int(options.get("partitionBytes", 128 << 20))

    def _files(self) -> Iterator[str]:
        from pyarrow import fs

        for root in self.paths:
            system, path = _system(root)
            info = system.get_file_info(path)
            if info.type == fs.FileType.File:
                yield root
            elif info.type == fs.FileType.Directory:
                prefix = root[: len(root) - len(path)] if "://" in root else ""
                yield from sorted(prefix + i.path for i in system.get_file_info(fs.FileSelector(path, recursive=True)) if i.type == fs.FileType.File and i.path.endswith(".npy"))
            else:
                raise FileNotFoundError(root)

    def partitions(self) -> Sequence[InputPartition]:
        out = []
        for path in self._files():
            system, inner = _system(path)
            with system.open_input_file(inner) as f:
                shape, kind, at = _header(f)
            n, ny, nx = (shape[0], 1, 1) if len(shape) == 1 else (1, *shape) if len(shape) == 2 else shape
            frame = max(1, ny * nx * kind.itemsize)
            each = max(1, self.bytes // frame)
            out += [Frames(path, at + begin * ny * nx * kind.itemsize, begin, min(begin + each, n), ny, nx, kind.str) for begin in range(0, n, each)]
        return out

    def read(self, part: Frames) -> Iterator[pa.RecordBatch]:
        if not isinstance(part, Frames):  # no files: one empty partition
            return
        kind, size = np.dtype(part.kind), part.ny * part.nx
        system, inner = _system(part.path)
        with system.open_input_file(inner) as f:
            f.seek(part.at)
            step = max(1, STEP // max(1, size * kind.itemsize))
            for begin in range(part.begin, part.end, step):
                n = min(step, part.end - begin)
                data = f.read(n * size * kind.itemsize)
                if len(data) < n * size * kind.itemsize:
                    raise ValueError(f"{part.path} ends before frame {begin + n}")
                values = np.frombuffer(data, dtype=kind).astype(np.float32)
                img = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * size), pa.array(values))
                columns = [pa.array([part.path] * n), pa.array(np.arange(begin, begin + n)), pa.array(np.full(n, part.ny, np.int32)), pa.array(np.full(n, part.nx, np.int32)), img]
                yield pa.RecordBatch.from_arrays(columns, names=["path", "frame", "ny", "nx", "img"])


class CubeSource(DataSource):
    """``spark.read.format("npy_cube").option("partitionBytes", ...).load(path)``: rows ``(path, frame, ny, nx, img)``."""

    @classmethod
    def name(cls) -> str:
        return "npy_cube"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> CubeReader:
        return CubeReader(self.options)


def read_cubes(spark: SparkSession, path: str | Sequence[str], partition_bytes: int = 128 << 20) -> DataFrame:
    """Frames of ``.npy`` files, or of all below a folder: arrays of three dimensions are cubes, of two one frame, of one a value a frame."""
    spark.dataSource.register(CubeSource)
    paths = [path] if isinstance(path, str) else list(path)
    return spark.read.format("npy_cube").option("partitionBytes", partition_bytes).load("\n".join(paths))


#: What a cut's arrays are called at the end of their files' names.
CUT_FILES = {"flux": "_ReducedFlux.npy", "time": "_Times.npy", "ref": "_Ref.npy", "bkg": "_Background.npy", "mask": "_Mask.npy"}


def gather_cut(spark: SparkSession, base: str, flux: bool = True, time: bool = True, bkg: bool = False, mask: bool = False, ref: bool = False, partition_bytes: int = 128 << 20) -> dict[str, DataFrame]:
    """The chosen arrays of a cut, whose files begin with ``base``, by name: ``time`` as ``(frame, time)``, the others as frames."""
    chosen = {"flux": flux, "time": time, "ref": ref, "bkg": bkg, "mask": mask}
    out = {name: read_cubes(spark, base + CUT_FILES[name], partition_bytes) for name, wanted in chosen.items() if wanted}
    if time:
        # Times need their full precision: a day number with a fraction of a second has more digits than a float.
        out["time"] = _values(spark, base + CUT_FILES["time"])
    return out


def _values(spark: SparkSession, path: str) -> DataFrame:
    """A one-dimensional array of the cut's frames as ``(frame, time)`` in double precision."""
    system, inner = _system(path)
    with system.open_input_file(inner) as f:
        shape, kind, at = _header(f)
    step = 1 << 16

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, place = _system(path)
        with files.open_input_file(place) as f:
            for b in batches:
                for begin in b.column(0).to_pylist():
                    n = min(step, shape[0] - begin * step)
                    f.seek(at + begin * step * kind.itemsize)
                    v = np.frombuffer(f.read(n * kind.itemsize), dtype=kind).astype(np.float64)
                    yield pa.RecordBatch.from_arrays([pa.array(np.arange(n) + begin * step), pa.array(v)], names=["frame", "time"])

    return spark.range(0, -(-shape[0] // step), 1).select(F.col("id")).mapInArrow(run, "frame long, time double")
