"""ZIP archives as a data source: the central directory is read once, and tasks read the byte ranges of runs of members.

An archive of any size is read by many tasks, none of which holds more than a run of members; a member's checksum is
tested where its content is read. Paths go through Arrow's file systems, which open files of local and remote stores.
"""

from __future__ import annotations

import struct
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from annoforge.functions.workers import reachable

MEMBERS = "archive string, member string, size_bytes bigint, crc32 string, safe boolean, content binary"
#: Compressed bytes of the members that one task reads, a single larger one aside, and the most members of a task.
RUN_BYTES, RUN_MEMBERS = 64 << 20, 10_000
_LOCAL = struct.Struct("<4s5H3L2H")


def unsafe_member(name: str, mode: int) -> bool:
    """Whether an archive member is absolute, climbs, names a drive, or is a link."""
    parts = name.replace("\\", "/").rstrip("/").split("/")
    return name.startswith(("/", "\\")) or any(p in ("", "..") for p in parts) or ":" in parts[0] or (mode & 0o170000) == 0o120000


def opened(path: str):
    from pyarrow import fs

    found, at = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
    return found, at


def archives_below(path: str, suffix: str = ".zip") -> list[str]:
    """Archives at a path or anywhere below it, as paths that opened() takes, in order."""
    from pyarrow import fs

    store, at = opened(path)
    prefix = path[: len(path) - len(at)] if path.endswith(at) else ""
    [info] = store.get_file_info([at])
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(at, recursive=True))
    return sorted(prefix + f.path for f in found if f.type == fs.FileType.File and f.path.lower().endswith(suffix))


class Run(InputPartition):
    """Members of one archive: (name, offset, compressed size, size, checksum, method, mode, encrypted)."""

    def __init__(self, archive: str, members: list[tuple]):
        self.archive, self.members = archive, members


class Members(DataSourceReader):
    def __init__(self, options: dict[str, str], suffix: str = ".zip"):
        self.path, self.suffix = options["path"], suffix
        self.content = options.get("content", "false").lower() == "true"
        self.most = int(options.get("runbytes", options.get("runBytes", RUN_BYTES)))

    def partitions(self) -> list[Run]:
        out = []
        for archive in archives_below(self.path, self.suffix):
            store, at = opened(archive)
            with store.open_input_file(at) as raw, zipfile.ZipFile(raw) as z:
                run, held = [], 0
                for i in z.infolist():
                    if i.is_dir():
                        continue
                    if run and (held + i.compress_size > self.most or len(run) >= RUN_MEMBERS):
                        out.append(Run(archive, run))
                        run, held = [], 0
                    run.append((i.filename, i.header_offset, i.compress_size, i.file_size, i.CRC, i.compress_type, i.external_attr >> 16, bool(i.flag_bits & 1)))
                    held += i.compress_size
                if run:
                    out.append(Run(archive, run))
        return out or [Run("", [])]

    def read(self, partition: Run) -> Iterator[tuple]:
        if not partition.members:
            return
        store, at = opened(partition.archive)
        with store.open_input_file(at) as raw:
            for name, offset, packed, size, crc, method, mode, locked in partition.members:
                safe = not unsafe_member(name, mode)
                content = self.unpacked(raw, name, offset, packed, size, crc, method, locked) if safe and self.content else None
                yield partition.archive, name, size, f"{crc:08X}", safe, content

    def unpacked(self, raw: pa.NativeFile, name: str, offset: int, packed: int, size: int, crc: int, method: int, locked: bool) -> bytes:
        """A member's content from its own bytes."""
        raw.seek(offset)
        head = _LOCAL.unpack(raw.read(_LOCAL.size))
        if head[0] != b"PK\x03\x04":
            raise zipfile.BadZipFile(f"no member at {offset}: {name}")
        if locked or method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
            raise NotImplementedError(f"cannot unpack {name}")
        raw.seek(offset + _LOCAL.size + head[9] + head[10])
        data = raw.read(packed)
        if method == zipfile.ZIP_DEFLATED:
            data = zlib.decompressobj(-15).decompress(data, size + 1)  # no more than is promised, and one to tell
        if len(data) != size or zlib.crc32(data) != crc:
            raise zipfile.BadZipFile(f"bad checksum of {name}")
        return data


class ZipSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "annoforge_zip"

    def schema(self) -> str:
        return MEMBERS

    def reader(self, schema) -> Members:
        return Members(self.options)


def archives(spark: SparkSession, path: str, content: bool = False, run_bytes: int = RUN_BYTES) -> DataFrame:
    """Members of the ZIP files at or below a path; unsafe ones are marked and never unpacked. A broken archive or a
    wrong checksum fails the read."""
    reachable(spark)
    spark.dataSource.register(ZipSource)
    return spark.read.format("annoforge_zip").option("content", str(content).lower()).option("runBytes", str(run_bytes)).load(path)
