"""LAS files as a Spark data source: ``spark.read.format("las").load(path)``.

The planner lists the folder and cuts files into record ranges by their size;
no file is opened for that. When the query compares x, y or z, the planner reads
the headers (many at a time), and a file whose bounds can't match gives no
partition, so no task opens it. Comparisons of x, y, z, intensity,
return_num and classification are applied to the decoded records with NumPy
before rows leave Python.

Options: ``path``, ``glob`` (default ``*.las``), ``split_bytes`` (64 MB),
``mode``: ``failfast`` (a file that can't be read fails the query) or
``skip``; ``window`` (``x0,y0,x1,y1``, closed) and ``classes`` (``2,3``), which
prune in the same way; ``pushdown`` (default false): take the comparisons out
of the query itself. Spark 4.1 keeps the filters that were pushed into a
DataFrame's source until that DataFrame pushes others, so a DataFrame read
with ``pushdown`` must serve one query only; without it, a DataFrame can be
used as often as one likes, and its window is an option. Coordinates are ``record * scale + offset``; filters see the same
doubles as the rows, and bounds are widened by one scale step, since headers
are often rounded. A header without bounds is never skipped."""

from __future__ import annotations

import fnmatch
import math
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (DataSource, DataSourceReader, EqualTo, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan,
                                    LessThanOrEqual)

from punktwerk.sources.las import BATCH_ROWS, OUT_SCHEMA, _filesystem, _open, decode_records, header_bounds, parse_header

SPLIT_BYTES = 64 << 20
HEADER_THREADS = 32
_NUMBERS = ("x", "y", "z", "intensity", "return_num", "classification")
_COMPARE = {EqualTo: np.equal, GreaterThan: np.greater, GreaterThanOrEqual: np.greater_equal, LessThan: np.less, LessThanOrEqual: np.less_equal,
            In: np.isin}


@dataclass
class Part(InputPartition):
    """The ``k``-th of ``of`` record ranges of a file."""
    path: str
    length: int
    k: int
    of: int


def _may_match(bounds: dict, step: dict, filters) -> bool:
    """Can a record within ``bounds`` pass all filters?"""
    for column, kind, value in filters:
        if column not in bounds or kind is In:
            continue
        lo, hi = bounds[column][0] - step[column], bounds[column][1] + step[column]
        if (kind in (GreaterThan, GreaterThanOrEqual, EqualTo) and hi < value) or (kind in (LessThan, LessThanOrEqual, EqualTo) and lo > value):
            return False
    return True


class LasReader(DataSourceReader):
    def __init__(self, options: dict):
        self.path, self.glob = options["path"], options.get("glob", "*.las")
        self.split = int(options.get("split_bytes", SPLIT_BYTES))
        self.mode = options.get("mode", "failfast")
        if self.mode not in ("failfast", "skip") or self.split < 1:
            raise ValueError(f"mode {self.mode!r}, split_bytes {self.split}")
        self.filters: list[tuple] = []
        if "window" in options:
            x0, y0, x1, y1 = map(float, options["window"].split(","))
            self.filters += [("x", GreaterThanOrEqual, x0), ("y", GreaterThanOrEqual, y0), ("x", LessThanOrEqual, x1), ("y", LessThanOrEqual, y1)]
        if "classes" in options:
            self.filters.append(("classification", In, [int(c) for c in options["classes"].split(",")]))
        self.pushdown = str(options.get("pushdown", "false")).lower() == "true"

    def pushFilters(self, filters):
        if not self.pushdown:
            yield from filters
            return
        for f in filters:
            column = f.attribute[0] if getattr(f, "attribute", None) and len(f.attribute) == 1 else None
            if type(f) in _COMPARE and column in _NUMBERS and f.value is not None:
                self.filters.append((column, type(f), f.value))
            else:
                yield f

    def _files(self) -> list[tuple[str, int]]:
        from pyarrow.fs import FileSelector, FileType
        fs, root = _filesystem(self.path)
        found = fs.get_file_info(root)
        infos = [found] if found.type == FileType.File else fs.get_file_info(FileSelector(root, recursive=True))
        prefix = self.path.split("://")[0] + "://" if "://" in self.path else ""
        return sorted((prefix + i.path, i.size) for i in infos
                      if i.type == FileType.File and fnmatch.fnmatch(i.base_name, self.glob) and i.base_name[0] not in "._")

    def _wanted(self, file: tuple[str, int]) -> bool:
        try:
            with _open(file[0]) as f:
                head = f.read(375)
            h = parse_header(head)
        except Exception:
            return True             # the task that reads it decides by mode
        return _may_match(header_bounds(head), {c: h[f"s{c}"] for c in "xyz"}, self.filters)

    def partitions(self):
        files = self._files()
        if any(c in "xyz" and kind is not In for c, kind, _ in self.filters):
            with ThreadPoolExecutor(HEADER_THREADS) as pool:
                files = [f for f, wanted in zip(files, pool.map(self._wanted, files)) if wanted]
        parts = [Part(path, length, k, of) for path, length in files for of in [max(1, math.ceil(length / self.split))] for k in range(of)]
        return parts or [Part("", 0, 0, 1)]

    def read(self, part: Part):
        if not part.path:
            return
        try:
            yield from self._records(part)
        except Exception:
            if self.mode == "failfast":
                raise

    def _records(self, part: Part):
        with _open(part.path) as f:
            h = parse_header(f.read(375))
            n, size = h["n_points"], h["record_length"]
            if part.length < h["data_offset"] + n * size:
                raise ValueError(f"{part.path}: truncated: {n} points announced, {part.length} bytes")
            at, end = n * part.k // part.of, n * (part.k + 1) // part.of
            name = part.path.rsplit("/", 1)[-1]
            while at < end:
                k = min(BATCH_ROWS, end - at)
                f.seek(h["data_offset"] + at * size)
                raw = f.read(k * size)
                if len(raw) != k * size:
                    raise OSError(f"{part.path}: file changed while it was read")
                cols = decode_records(raw, h["point_format"], size, (h["sx"], h["sy"], h["sz"]), (h["ox"], h["oy"], h["oz"]))
                keep = np.ones(k, bool)
                for column, kind, value in self.filters:
                    keep &= _COMPARE[kind](cols[column], list(value) if kind is In else value)
                if keep.any():
                    cols = {c: v if keep.all() else v[keep] for c, v in cols.items()}
                    cols["source_file"] = np.full(int(keep.sum()), name, dtype=object)
                    yield pa.RecordBatch.from_pydict(cols)
                at += k


class LasDataSource(DataSource):
    @classmethod
    def name(cls):
        return "las"

    def schema(self):
        return OUT_SCHEMA

    def reader(self, schema):
        return LasReader(self.options)


def register(spark: SparkSession) -> SparkSession:
    """Makes ``format("las")`` known to a session, with filter pushdown."""
    from punktwerk.session import ship_package
    ship_package(spark)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(LasDataSource)
    return spark
