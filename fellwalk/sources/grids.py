"""Raster files: plain banded grids, written in strips by all tasks and read by windows with filters pushed down.

A grid is a folder with a text header, ``layer.hdr``, and strips of rows, ``strip-000000.bil`` and so on.  A strip is rows of
little-endian doubles, band after band within a row (band interleaved by line); a cell without data is NaN.  There is no
codec, so every cell has a computable place, and a reader fetches the bytes of its window alone.

The reader is a data source: ``spark.read.format("banded_grid").load(folder)`` gives ``col row band z``, one partition for each
window of ``WINDOW`` x ``WINDOW`` cells and band.  Comparisons of ``col``, ``row`` and ``band`` with constants are pushed down:
windows beyond them are no partitions, and of the others only the rows and columns asked for are read.
"""

from __future__ import annotations

import dataclasses
import uuid
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, InputPartition, LessThan, LessThanOrEqual

from fellwalk.operators.layers import Georeference, Shape, shape_of
from fellwalk.session import parallelism

FORMAT = "banded_grid"
WINDOW = 256
STRIP_ROWS = 256
SCHEMA = "col int, row int, band int, z double"


def as_uri(folder: str) -> str:
    return folder if "://" in folder or folder.startswith("file:") else f"file://{folder}"


def _store(folder: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(as_uri(folder).replace("file:/", "file:///", 1) if folder.startswith("file:/") and not folder.startswith("file://") else as_uri(folder))


@dataclasses.dataclass(frozen=True)
class Header:
    """What the header of a grid says: the shape, the bands, the rows of a strip, and where the layer lies."""

    shape: Shape
    bands: int
    strip_rows: int
    geo: Georeference | None

    def text(self) -> str:
        fields = {
            "NROWS": self.shape.rows, "NCOLS": self.shape.cols, "NBANDS": self.bands, "NBITS": 64, "PIXELTYPE": "FLOAT", "BYTEORDER": "I", "LAYOUT": "BIL",
            "NODATA": "nan", "FIRSTCOL": self.shape.col0, "FIRSTROW": self.shape.row0, "STRIPROWS": self.strip_rows,
        }
        if self.geo:
            fields |= {"ULXMAP": self.geo.xmin, "ULYMAP": self.geo.ymax, "XDIM": self.geo.cell_width, "YDIM": self.geo.cell_height, "CRS": self.geo.crs}
        return "".join(f"{name} {value!r}\n" if isinstance(value, float) else f"{name} {value}\n" for name, value in fields.items())

    @staticmethod
    def of(text: str) -> "Header":
        found = dict(line.split(maxsplit=1) for line in text.splitlines() if line.strip())
        if (found["NBITS"], found["PIXELTYPE"], found["BYTEORDER"], found["LAYOUT"]) != ("64", "FLOAT", "I", "BIL"):
            raise ValueError("a grid of little-endian doubles, band interleaved by line, is expected")
        number = lambda name: int(found[name])
        geo = Georeference(*[float(found[n]) for n in ("ULXMAP", "ULYMAP", "XDIM", "YDIM")], found["CRS"]) if "ULXMAP" in found else None
        return Header(Shape(number("FIRSTCOL"), number("FIRSTROW"), number("NCOLS"), number("NROWS")), number("NBANDS"), number("STRIPROWS"), geo)


def read_header(folder: str) -> Header:
    store, root = _store(folder)
    with store.open_input_stream(f"{root}/layer.hdr") as source:
        return Header.of(source.read().decode())


def write_grid(cells: DataFrame, folder: str, values: Sequence[str] = ("z",), shape: Shape | None = None, geo: Georeference | None = None) -> Header:
    """Write a cell table ``col row`` and ``values``, a band each, as a grid in ``folder``, a URI that all tasks can write to.

    A task writes whole strips, row by row, under a name of its attempt and renames them, so a task that runs again leaves
    the same files.  Absent cells are without data.  The header comes last and so marks a complete grid.
    """
    shape = shape or shape_of(cells)
    header = Header(shape, len(values), STRIP_ROWS, geo)
    strips = -(-shape.rows // STRIP_ROWS)
    strip = F.floor((F.col("row") - shape.row0) / STRIP_ROWS).cast("int")
    own = cells.select(strip.alias("strip"), F.col("row").cast("int").alias("row"), F.col("col").cast("int").alias("col"), *[F.col(v).cast("double").alias(f"v{i}") for i, v in enumerate(values)])
    nothing = [F.lit(None).cast("int").alias("col"), *[F.lit(None).cast("double").alias(f"v{i}") for i in range(len(values))]]
    every = cells.sparkSession.range(strips).select(F.col("id").cast("int").alias("strip"), (F.col("id") * STRIP_ROWS + shape.row0).cast("int").alias("row"), *nothing)
    strip_rows, bands = STRIP_ROWS, len(values)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = _store(folder)
        open_strip = sink = attempt = None
        line, next_row, done = None, 0, []

        def close() -> None:
            end = shape.row0 + min(shape.rows, (open_strip + 1) * strip_rows)
            flush(end)
            sink.close()
            store.move(attempt, f"{root}/strip-{open_strip:06d}.bil")
            done.append(open_strip)

        def flush(row: int) -> None:
            """Write the lines before ``row``."""
            nonlocal line, next_row
            while next_row < row:
                sink.write(line.tobytes())
                line, next_row = np.full((bands, shape.cols), np.nan), next_row + 1

        store.create_dir(root, recursive=True)
        for batch in batches:
            here, rows, cols = (batch.column(n).to_numpy(zero_copy_only=False) for n in ("strip", "row", "col"))
            data = np.stack([batch.column(f"v{i}").to_numpy(zero_copy_only=False) for i in range(bands)])
            bounds = [0, *(np.flatnonzero((rows[1:] != rows[:-1]) | (here[1:] != here[:-1])) + 1).tolist(), len(rows)] if len(rows) else [0]
            for a, b in zip(bounds[:-1], bounds[1:]):
                if here[a] != open_strip:
                    if open_strip is not None:
                        close()
                    open_strip, next_row = int(here[a]), shape.row0 + int(here[a]) * strip_rows
                    attempt = f"{root}/_{open_strip}-{uuid.uuid4().hex}"
                    sink, line = store.open_output_stream(attempt), np.full((bands, shape.cols), np.nan)
                flush(int(rows[a]))
                there = ~np.isnan(cols[a:b].astype(float))
                line[:, cols[a:b][there].astype(np.int64) - shape.col0] = data[:, a:b][:, there]
        if open_strip is not None:
            close()
        yield pa.RecordBatch.from_arrays([pa.array(done, pa.int32())], names=["strip"])

    dealt = own.unionByName(every).repartition(max(1, min(strips, parallelism(cells.sparkSession))), "strip").sortWithinPartitions("strip", "row")
    written = dealt.mapInArrow(write, "strip int").count()
    if written != strips:
        raise RuntimeError(f"{written} of {strips} strips were written")
    store, root = _store(folder)
    with store.open_output_stream(f"{root}/layer.hdr") as sink:
        sink.write(header.text().encode())
    return header


@dataclasses.dataclass
class Window(InputPartition):
    """Cells of one band from a column and row, in numbers from the corner of the layer, to another, exclusive."""

    band: int
    west: int
    north: int
    east: int
    south: int

    def __init__(self, band: int, west: int, north: int, east: int, south: int):
        super().__init__((band, west, north, east, south))
        self.band, self.west, self.north, self.east, self.south = band, west, north, east, south


class GridReader(DataSourceReader):
    def __init__(self, folder: str, window: int):
        self.folder, self.window, self.header = folder, window, read_header(folder)
        shape = self.header.shape
        self.low = {"col": shape.col0, "row": shape.row0, "band": 0}
        self.high = {"col": shape.col0 + shape.cols - 1, "row": shape.row0 + shape.rows - 1, "band": self.header.bands - 1}

    def pushFilters(self, filters):
        """Comparisons of places with constants narrow the window; all other filters are left to the engine."""
        for f in filters:
            name = f.attribute[0] if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            value = getattr(f, "value", None)
            if name not in self.low or not isinstance(value, int):
                yield f
            elif isinstance(f, EqualTo):
                self.low[name], self.high[name] = max(self.low[name], value), min(self.high[name], value)
            elif isinstance(f, (GreaterThan, GreaterThanOrEqual)):
                self.low[name] = max(self.low[name], value + isinstance(f, GreaterThan))
            elif isinstance(f, (LessThan, LessThanOrEqual)):
                self.high[name] = min(self.high[name], value - isinstance(f, LessThan))
            else:
                yield f

    def partitions(self):
        shape, size = self.header.shape, self.window
        first = {"col": self.low["col"] - shape.col0, "row": self.low["row"] - shape.row0}
        last = {"col": self.high["col"] - shape.col0, "row": self.high["row"] - shape.row0}
        steps = lambda axis: range(first[axis] // size * size, last[axis] + 1, size)
        cut = lambda axis, at: (max(at, first[axis]), min(at + size, last[axis] + 1))
        found = []
        for band in range(self.low["band"], self.high["band"] + 1):
            for row in steps("row"):
                for col in steps("col"):
                    (west, east), (north, south) = cut("col", col), cut("row", row)
                    found.append(Window(band, west, north, east, south))
        return found or [Window(0, 0, 0, 0, 0)]

    def read(self, partition):
        wide, rows = partition.east - partition.west, self.header.strip_rows
        if not wide:
            return
        store, root = _store(self.folder)
        shape, bands = self.header.shape, self.header.bands
        strip = source = None
        lines = []
        try:
            for row in range(partition.north, partition.south):
                if row // rows != strip:
                    if source:
                        source.close()
                    strip = row // rows
                    source = store.open_input_file(f"{root}/strip-{strip:06d}.bil")
                source.seek(((row % rows * bands + partition.band) * shape.cols + partition.west) * 8)
                lines.append(np.frombuffer(source.read(wide * 8), dtype="<f8"))
        finally:
            if source:
                source.close()
        z = np.concatenate(lines)
        col = np.tile(np.arange(partition.west, partition.east, dtype=np.int32) + shape.col0, len(lines))
        row = np.repeat(np.arange(partition.north, partition.south, dtype=np.int32) + shape.row0, wide)
        yield pa.RecordBatch.from_arrays(
            [pa.array(col.astype(np.int32)), pa.array(row.astype(np.int32)), pa.array(np.full(len(z), partition.band, dtype=np.int32)), pa.array(z, mask=np.isnan(z))],
            names=["col", "row", "band", "z"])


class GridSource(DataSource):
    @classmethod
    def name(cls):
        return FORMAT

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return GridReader(self.options["path"], int(self.options.get("window", WINDOW)))


def read_grid(spark: SparkSession, folder: str, window: int = WINDOW) -> DataFrame:
    """The cells of a grid: ``col row band z``; registers the source and lets filters reach it."""
    spark.dataSource.register(GridSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format(FORMAT).option("window", window).load(as_uri(folder))
