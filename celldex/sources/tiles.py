"""A reader of planes in .npy files whose partitions are strips of tiles: each task reads its strip and no more.

    spark.dataSource.register(TileSource)
    spark.read.format("celldex_tiles").option("tile", 256).load("/shared/planes")

gives plane, ty, tx, body, as `operators.planes` has them.  Files hold (height, width) or (layers, height, width).
The option `window` ("x0,y0,x1,y1") leaves out the tiles beyond it, and the strips without one aren't read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as files
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.planes import TILE, Planes

SCHEMA = "plane bigint, ty int, tx int, body binary"


class Strip(InputPartition):
    def __init__(self, path: str, plane: int, ty: int):
        super().__init__((path, plane, ty))
        self.path, self.plane, self.ty = path, plane, ty


def _listed(path: str) -> tuple[files.FileSystem, list[str]]:
    system, at = files.FileSystem.from_uri(path)
    info = system.get_file_info(at)
    if info.type == files.FileType.File:
        return system, [at]
    found = [x.path for x in system.get_file_info(files.FileSelector(at)) if x.path.endswith(".npy")]
    if not found:
        raise ValueError(f"no .npy file in {path}")
    return system, sorted(found)


def header(system: files.FileSystem, path: str) -> tuple[tuple[int, int, int], np.dtype, int]:
    """layers, height and width, the kind of number, and where numbers begin."""
    with system.open_input_file(path) as f:
        version = np.lib.format.read_magic(f)
        shape, fortran, kind = (np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0)(f)
        at = f.tell()
    if fortran or len(shape) not in (2, 3):
        raise ValueError(f"{path} isn't rows of (height, width) or (layers, height, width)")
    return (*(1,) * (3 - len(shape)), *shape), kind, at


class TileReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path, self.tile = options["path"], int(options.get("tile", TILE))
        self.window = [int(v) for v in options["window"].split(",")] if options.get("window") else None

    def _wanted(self, n: int, low: int, high: int) -> range:
        first, last = (max(0, self.window[low] // self.tile), min(n, math.ceil(self.window[high] / self.tile))) if self.window else (0, n)
        return range(first, max(first, last))

    def partitions(self) -> list[Strip]:
        system, paths = _listed(self.path)
        return [Strip(p, i, ty) for i, p in enumerate(paths) for ty in self._wanted(math.ceil(header(system, p)[0][1] / self.tile), 1, 3)] or [Strip("", 0, 0)]

    def read(self, strip: Strip) -> Iterator[pa.RecordBatch]:
        if not strip.path:
            return
        system, _ = _listed(self.path)
        (layers, height, width), kind, at = header(system, strip.path)
        y0, y1 = strip.ty * self.tile, min(height, strip.ty * self.tile + self.tile)
        with system.open_input_file(strip.path) as f:
            rows = []
            for i in range(layers):
                f.seek(at + (i * height + y0) * width * kind.itemsize)
                rows.append(np.frombuffer(f.read((y1 - y0) * width * kind.itemsize), kind).reshape(y1 - y0, width))
        for tx in self._wanted(math.ceil(width / self.tile), 0, 2):
            body = np.stack([r[:, tx * self.tile : (tx + 1) * self.tile] for r in rows]).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([strip.plane], pa.int64()), pa.array([strip.ty], pa.int32()), pa.array([tx], pa.int32()), pa.array([body], pa.binary())], ["plane", "ty", "tx", "body"])


class TileSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "celldex_tiles"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> TileReader:
        return TileReader(self.options)


def read_planes(spark: SparkSession, path: str, tile: int = TILE) -> Planes:
    """All planes of a folder of .npy files of one shape; plane numbers are places in the order of names."""
    system, paths = _listed(path)
    heads = {(*header(system, p)[0], header(system, p)[1].str) for p in paths}
    if len(heads) > 1:
        raise ValueError(f"planes of several shapes: {sorted(heads)}")
    layers, height, width, kind = heads.pop()
    spark.dataSource.register(TileSource)
    return Planes(spark.read.format("celldex_tiles").option("tile", tile).load(path), height, width, tile, layers, kind)
