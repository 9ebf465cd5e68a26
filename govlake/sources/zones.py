"""Zone log of a landing folder: which heights each landed file holds.

``ZoneLog.refresh`` notes files that it has not seen yet: for Parquet from the footers (or, without
statistics, the height column), else the caller gives the ranges (``index_landing`` lets Spark read them). Each refresh
that finds something writes one numbered log file, so the log's length says which files were known at a time.
Files are never removed from the log; a file that is landed again under its name is noted again.

The log serves two readers:

* ``files_between``: the files that a replay of a range of heights must read.
* ``HeightOrderedSource`` ("govlake_heights"): a streaming source whose offsets are heights. Its rows are file names with
  their ranges, so a consumer lets Spark read the blocks themselves. An offset (height, known) stands for all files that were
  among the first ``known`` log entries and end at or below ``height``. Both only grow: files arrive in order of height as
  long as they land at most ``lag`` heights late, a later one comes in a later batch, and none is lost or repeated
  by a restart.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

HEIGHT = "block.header.height"
ZONE = "file string, lowest bigint, highest bigint"


@dataclass(frozen=True)
class Zone:
    file: str
    lowest: int
    highest: int
    stamp: str  # size and time of the file, so that a new file under an old name is a new one


def _file_system(path: str):
    """(file system, path in it) of a path or URI."""
    from pyarrow import fs
    if path.startswith("file:"):
        path = "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def _parquet_range(system, path: str) -> tuple[int, int] | None:
    """Lowest and highest height of a Parquet file; None when it holds no block."""
    import pyarrow as pa
    import pyarrow.compute as pc
    import pyarrow.parquet as pq
    with system.open_input_file(path) as f:
        file = pq.ParquetFile(f)
        names = [file.schema.column(i).path for i in range(len(file.schema))]
        ranges = []
        for g in range(file.num_row_groups):
            stats = file.metadata.row_group(g).column(names.index(HEIGHT)).statistics
            if stats is not None and stats.has_min_max and stats.has_null_count:
                missing, ends = stats.null_count, (stats.min, stats.max)
            else:
                block = pa.chunked_array(file.read_row_group(g, [HEIGHT]).column("block")).combine_chunks()
                heights = pc.struct_field(block, ["header", "height"])
                missing, ends = heights.null_count, tuple(pc.min_max(heights).as_py().values())
            if missing:
                raise ValueError(f"block record without height in {path}")
            ranges += [ends] if ends[0] is not None else []
    return (min(r[0] for r in ranges), max(r[1] for r in ranges)) if ranges else None


class ZoneLog:
    def __init__(self, landing: str, log: str):
        self.landing, self.log = landing, log
        self._system, self._folder = _file_system(log)
        self._read = 0
        self._entries: list[list[Zone]] = []

    def _path(self, number: int) -> str:
        return f"{self._folder}/{number:012d}.json"

    def entries(self) -> list[list[Zone]]:
        """The zones of each log file, in order."""
        from pyarrow import fs
        while self._system.get_file_info(self._path(len(self._entries))).type != fs.FileType.NotFound:
            with self._system.open_input_stream(self._path(len(self._entries))) as f:
                self._entries.append([Zone(**z) for z in json.loads(f.read())])
        return self._entries

    def append(self, zones: list[Zone]) -> None:
        if not zones:
            return
        number = len(self.entries())
        self._system.create_dir(self._folder, recursive=True)
        part = f"{self._path(number)}.part"
        with self._system.open_output_stream(part) as f:
            f.write(json.dumps([asdict(z) for z in zones]).encode())
        self._system.move(part, self._path(number))  # readers see whole log files only

    def new_files(self) -> dict[str, str]:
        """Landed files that aren't in the log: path -> stamp."""
        from pyarrow import fs
        system, folder = _file_system(self.landing)
        noted = {(z.file, z.stamp) for zones in self.entries() for z in zones}
        infos = system.get_file_info(fs.FileSelector(folder, recursive=True, allow_not_found=True))
        folder = folder.rstrip("/")
        landed = {self.landing.rstrip("/") + i.path[len(folder):]: f"{i.size}-{i.mtime_ns}" for i in infos
                  if i.type == fs.FileType.File and not any(p[:1] in "._" for p in i.path[len(folder):].split("/") if p)}
        return {f: s for f, s in landed.items() if (f, s) not in noted}

    def refresh(self) -> None:
        """Note new Parquet files."""
        system, _ = _file_system(self.landing)
        zones = []
        for file, stamp in sorted(self.new_files().items()):
            if found := _parquet_range(system, _file_system(file)[1]):
                zones.append(Zone(file, *found, stamp))
        self.append(zones)

    def files_between(self, first: int | None, last: int | None) -> list[str]:
        """Files that hold a height of the range (both ends inclusive, None: open)."""
        zones = (z for some in self.entries() for z in some)
        return sorted({z.file for z in zones if (last is None or z.lowest <= last) and (first is None or z.highest >= first)})


def index_landing(spark: SparkSession, landing: str, log: str, fmt: str = "parquet") -> ZoneLog:
    """Note the new files of a landing folder; of formats without footers Spark reads the heights."""
    zones = ZoneLog(landing, log)
    if fmt == "parquet":
        zones.refresh()
    elif new := zones.new_files():
        from govlake.sources.blockfeed import landing_schema
        rows = spark.read.schema(landing_schema(fmt)).option("mode", "FAILFAST").format(fmt).load(list(new)).groupBy(
            F.col("_metadata.file_path").alias("file")).agg(F.min(HEIGHT).alias("low"), F.max(HEIGHT).alias("high"),
            F.count_if(F.col(HEIGHT).isNull()).alias("missing")).collect()  # one row per new file
        if bad := [r["file"] for r in rows if r["missing"]]:
            raise ValueError(f"block record without height in {bad[0]}")
        from urllib.parse import unquote, urlparse
        ranges = {unquote(urlparse(r["file"]).path): (r["low"], r["high"]) for r in rows}
        found = {f: ranges.get(urlparse(f).path, (None, None)) for f in new}
        zones.append([Zone(f, low, high, new[f]) for f, (low, high) in sorted(found.items()) if low is not None])
    return zones


class _Files(InputPartition):
    def __init__(self, zones: list[Zone]):
        self.zones = zones


class _HeightReader(DataSourceStreamReader):
    def __init__(self, options):
        self.zones = ZoneLog(options["path"], options["log"])
        self.lag = int(options.get("lag", "0"))
        self.footers = options.get("fileFormat", "parquet") == "parquet"

    def initialOffset(self) -> dict:
        return {"height": -1, "known": 0}

    def latestOffset(self) -> dict:
        if self.footers:
            self.zones.refresh()
        entries = self.zones.entries()
        top = max((z.highest for some in entries for z in some), default=-1)
        return {"height": max(top - self.lag, -1), "known": len(entries)}

    def _covered(self, offset: dict) -> list[Zone]:
        return [z for some in self.zones.entries()[:offset["known"]] for z in some if z.highest <= offset["height"]]

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        before = set(self._covered(start))
        new = sorted((z for z in self._covered(end) if z not in before), key=lambda z: (z.lowest, z.highest, z.file))
        return [_Files(new[i:i + 1000]) for i in range(0, len(new), 1000)] or [_Files([])]

    def read(self, partition: _Files) -> Iterator[tuple]:
        for z in partition.zones:
            yield z.file, z.lowest, z.highest

    def commit(self, end: dict) -> None:
        pass

    def stop(self) -> None:
        pass


class HeightOrderedSource(DataSource):
    """Options: path (landing folder), log (zone log folder), lag (heights that are held back), fileFormat."""

    @classmethod
    def name(cls) -> str:
        return "govlake_heights"

    def schema(self) -> str:
        return ZONE

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _HeightReader(self.options)


def files_by_height(spark: SparkSession, landing: str, log: str, lag: int = 0, fmt: str = "parquet") -> DataFrame:
    """Streaming (file, lowest, highest) of landed files in order of height."""
    spark.dataSource.register(HeightOrderedSource)
    return spark.readStream.format("govlake_heights").option("log", log).option("lag", str(lag)).option("fileFormat", fmt).load(landing)
