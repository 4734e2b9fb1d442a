"""The CTD cast feed as a data source over landed response pages.

A feed answers with pages of JSON records; they are landed as they come, one folder a station and year:
``<path>/station=<s>/year=<y>/*.json``, a record a line. A query on the feed names fields and conditions on station, year,
depth and day of the year. The source takes them over: station and year leave pages unopened, the field list is what
the JSON parser reads, and depth and day are applied to a page's columns before rows reach Spark. Conditions it cannot
take stay with Spark. Each page is a partition.
"""

from __future__ import annotations

import sys
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.json as pj
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    LessThan,
    LessThanOrEqual,
)

FORMAT = "cast_feed"
PAGE_KEYS = ("station", "year")
# The fields a record of the feed has.
FIELDS = {
    "station": "string", "year": "int", "date": "date", "yday": "int", "cast_number": "bigint", "depth": "double",
    "temperature": "double", "salinity": "double", "dissolved_oxygen_ml_l": "double",
}
_ARROW = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "date": pa.date32()}
_COMPARE = {
    EqualTo: pc.equal, GreaterThan: pc.greater, GreaterThanOrEqual: pc.greater_equal, LessThan: pc.less, LessThanOrEqual: pc.less_equal,
}
TAKEN = ("station", "year", "depth", "yday")  # what the feed can be asked for


def land_feed(casts: DataFrame, path: str) -> None:
    """Land records as pages by station and year."""
    records = casts.withColumns({"year": F.year("date"), "yday": F.dayofyear("date")}).select(*FIELDS)
    records.hint("rebalance", *PAGE_KEYS).write.partitionBy(*PAGE_KEYS).option("ignoreNullFields", False).json(path)


@dataclass
class Page(InputPartition):
    file: str
    station: str
    year: int


class CastFeed(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        wanted = self.options.get("fields") or ",".join(FIELDS)
        unknown = [c for c in wanted.split(",") if c not in FIELDS]
        if unknown:
            raise ValueError(f"the feed has no field {', '.join(unknown)}")
        return ", ".join(f"{c} {FIELDS[c]}" for c in wanted.split(","))

    def reader(self, schema) -> FeedReader:
        return FeedReader(self.options["path"], schema.names)


class FeedReader(DataSourceReader):
    def __init__(self, path: str, names: Sequence[str]) -> None:
        self.path, self.names = path, list(names)
        self.taken: list[tuple[str, type, object]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            name = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            if name in TAKEN and isinstance(f, (*_COMPARE, In, IsNotNull)):
                self.taken.append((name, type(f), getattr(f, "value", None)))
            else:
                yield f

    def _one(self, kind: type, values: pa.Array, value):
        if kind is IsNotNull:
            return pc.is_valid(values)
        return pc.is_in(values, pa.array(value, values.type)) if kind is In else _COMPARE[kind](values, pa.scalar(value, values.type))

    def _holds(self, name: str, values: pa.Array):
        """Whether each value meets all conditions on the field that were taken over; null where that is unknown."""
        out = None
        for field, kind, value in self.taken:
            if field == name:
                one = self._one(kind, values, value)
                out = one if out is None else pc.and_kleene(out, one)
        return out

    def partitions(self) -> Sequence[Page]:
        system, root = fs.FileSystem.from_uri(self.path) if "://" in self.path or self.path.startswith("file:") else (fs.LocalFileSystem(), self.path)
        pages = []
        for info in system.get_file_info(fs.FileSelector(root, recursive=True)):
            parts = dict(p.split("=", 1) for p in info.path.split("/") if "=" in p)
            if info.type == fs.FileType.File and info.base_name.endswith(".json") and set(PAGE_KEYS) <= set(parts):
                page = Page(info.path, parts["station"], int(parts["year"]))
                keys = {"station": pa.array([page.station], pa.string()), "year": pa.array([page.year], pa.int32())}
                if all((held := self._holds(k, v)) is None or held[0].as_py() for k, v in keys.items()):
                    pages.append(page)
        return pages or [Page("", "", 0)]

    def read(self, partition: Page) -> Iterator[pa.RecordBatch]:
        if not partition.file:
            return
        # the parser reads the asked fields and those that conditions need, nothing else
        needed = {*self.names, *(name for name, _, _ in self.taken)} - set(PAGE_KEYS)
        known = pa.schema([(c, pa.string() if FIELDS[c] == "date" else _ARROW[FIELDS[c]]) for c in FIELDS if c in needed])
        system = fs.FileSystem.from_uri(self.path)[0] if "://" in self.path or self.path.startswith("file:") else fs.LocalFileSystem()
        options = pj.ParseOptions(explicit_schema=known, unexpected_field_behavior="ignore")
        with system.open_input_stream(partition.file, compression=None) as stream:
            records = pj.open_json(stream, parse_options=options)
            for batch in records:
                columns = {c: batch.column(c) for c in known.names}
                columns |= {"station": pa.array([partition.station] * len(batch)), "year": pa.array([partition.year] * len(batch), pa.int32())}
                kept = None
                for name in {n for n, _, _ in self.taken} - set(PAGE_KEYS):
                    held = self._holds(name, columns[name])
                    kept = held if kept is None else pc.and_kleene(kept, held)
                out = pa.table({c: columns[c].cast(_ARROW[FIELDS[c]]) for c in self.names})
                yield from (out if kept is None else out.filter(kept)).combine_chunks().to_batches()


def read_feed(
    spark: SparkSession,
    path: str,
    stations: Sequence[str],
    after_year: int | None = None,
    days: tuple[int, int] | None = None,
    deepest: float | None = None,
    columns: Sequence[str] = ("station", "year", "date", "depth", "temperature", "salinity", "dissolved_oxygen_ml_l"),
) -> DataFrame:
    """Casts of the stations, of later years, above a depth, between two days of the year (both excluded).

    The conditions are plain filters of the result; with ``spark.sql.python.filterPushdown.enabled`` the feed takes them over.
    """
    spark.dataSource.register(CastFeed)
    fields = list(columns) + [c for c in TAKEN if c not in columns and (c != "yday" or days is not None)]
    casts = spark.read.format(FORMAT).option("path", path).option("fields", ",".join(fields)).load()
    casts = casts.filter(F.col("station").isin(*stations))
    if after_year is not None:
        casts = casts.filter(F.col("year") > after_year)
    if deepest is not None:
        casts = casts.filter(F.col("depth") <= deepest)
    if days is not None:
        casts = casts.filter((F.col("yday") > days[0]) & (F.col("yday") < days[1]))
    return casts.select(*columns)


# the source travels with the task, so executors need no copy of this package
cloudpickle.register_pickle_by_value(sys.modules[__name__])
