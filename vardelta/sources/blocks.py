"""Block-compressed text (BGZF): a large gzip file as several tasks.

Such a file is a row of small gzip members, each with its compressed size in its header, so a reader can start at any
byte: it looks for the next header that another one, or the end, follows at the stated distance. A task takes the blocks that
begin in its range. Lines do not end with blocks: a task leaves out what comes before its first newline (but for the
first task) and reads on to the first newline behind its range, so every line is read once and by one task. Gzip files
without blocks are read by one task each.

A Python data source: the driver lists the files and cuts ranges, workers read them through the file system of their URI.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage

#: Compressed bytes of a task, about; text bytes of a written block (a block's sizes are 16-bit numbers) and of a batch.
RANGE, BLOCK, BATCH = 32 << 20, 0xFF00, 8 << 20
#: A header is 18 bytes; no block is longer than 64 KB.
HEADER, LONGEST = 18, 1 << 16
#: The empty block that ends a file.
END = bytes.fromhex("1f8b08040000000000ff0600424302001b0003000000000000000000")


def file_system(path: str):
    """The file system of a path or URI, and the path in it."""
    from pyarrow import fs

    if "://" not in path and path.startswith("file:"):
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def files_of(path: str) -> list[tuple[str, int]]:
    """(path, size) of a file, or of the files in a folder and below; names that begin with a dot or underscore are left out."""
    from pyarrow import fs

    files, place = file_system(path)
    info = files.get_file_info(place)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [info] if info.is_file else files.get_file_info(fs.FileSelector(place, recursive=True))
    hidden = lambda f: any(p[:1] in "._" for p in f.path.removeprefix(place).split("/") if p)
    return sorted((f.path, f.size) for f in found if f.is_file and not hidden(f))


def block_size(header: bytes) -> int | None:
    """Compressed size of the block that a header begins; None if these bytes begin none."""
    if len(header) < HEADER or header[:4] != b"\x1f\x8b\x08\x04" or header[12:16] != b"BC\x02\x00":
        return None
    return struct.unpack("<H", header[16:18])[0] + 1


def first_block(data: bytes, start: int, ends_file: bool) -> int | None:
    """Place of the first block at ``start`` or behind it: a header at whose stated distance another one, or the end, follows."""
    at = data.find(b"\x1f\x8b\x08\x04", start)
    while at >= 0:
        size = block_size(data[at : at + HEADER])
        if size is not None:
            following = data[at + size : at + size + HEADER]
            if block_size(following) is not None or (ends_file and at + size == len(data)):
                return at
        at = data.find(b"\x1f\x8b\x08\x04", at + 1)
    return None


@dataclass
class Range(InputPartition):
    path: str
    start: int
    stop: int
    blocks: bool


def texts(source, start: int, stop: int, size: int) -> Iterator[tuple[bool, bytes]]:
    """(whether it begins in the range, text) of each block from the first one at ``start`` on, until nobody asks."""
    source.seek(start)
    data, at, base = source.read(2 * LONGEST + HEADER), 0, start
    found = first_block(data, 0, base + len(data) >= size)
    if found is None:
        return
    at = found
    while True:
        if len(data) - at < LONGEST:
            base, data, at = base + at, data[at:] + source.read(1 << 20), 0
        length = block_size(data[at : at + HEADER])
        if length is None:
            if len(data) > at:
                raise ValueError(f"no block at byte {base + at}")
            return
        yield base + at < stop, zlib.decompress(data[at : at + length], wbits=31)
        at += length


def lines(source, start: int, stop: int, size: int) -> Iterator[list[bytes]]:
    """The lines of a range, some megabytes at a time."""
    held, opened = [], start == 0  # what stands before the first newline is the range's before
    total = 0
    for inside, text in texts(source, start, stop, size):
        if not inside:
            cut = text.find(b"\n")
            if opened:
                held.append(text if cut < 0 else text[: cut + 1])
            if cut >= 0 or not opened:
                break
            continue
        if not opened:
            cut = text.find(b"\n")
            if cut < 0:
                continue
            text, opened = text[cut + 1 :], True
        held.append(text)
        total += len(text)
        if total >= BATCH:
            whole, _, rest = b"".join(held).rpartition(b"\n")
            if whole or _:
                yield whole.split(b"\n")
            held, total = [rest], len(rest)
    last = b"".join(held)
    if last:
        yield last.removesuffix(b"\n").split(b"\n")


def plain_lines(source) -> Iterator[list[bytes]]:
    """The lines of a file that is gzip without blocks, or not compressed at all."""
    head = source.read(2)
    unpack = zlib.decompressobj(wbits=31) if head == b"\x1f\x8b" else None
    rest, chunk = b"", head
    while chunk:
        data = chunk
        if unpack:
            data = unpack.decompress(chunk)
            while unpack.eof and unpack.unused_data:
                tail, unpack = unpack.unused_data, zlib.decompressobj(wbits=31)
                data += unpack.decompress(tail)
        whole, found, rest = (rest + data).rpartition(b"\n")
        if found:
            yield whole.split(b"\n")
        chunk = source.read(1 << 20)
    if rest:
        yield rest.split(b"\n")


class BlockReader(DataSourceReader):
    def __init__(self, path: str, size: int):
        self.path, self.size = path, size

    def partitions(self) -> list[Range]:
        files, _ = file_system(self.path)
        out = []
        for path, size in files_of(self.path):
            with files.open_input_file(path) as source:
                blocks = block_size(source.read(HEADER)) is not None
            cuts = range(0, size, self.size) if blocks else range(0, min(size, 1))
            out += [Range(path, k, min(k + self.size, size) if blocks else size, blocks) for k in cuts]
        return out

    def read(self, part: Range) -> Iterator[pa.RecordBatch]:
        files, _ = file_system(self.path)
        with files.open_input_file(part.path) as source:
            found = lines(source, part.start, part.stop, source.size()) if part.blocks else plain_lines(source)
            for some in found:
                values = pa.array([x.removesuffix(b"\r") for x in some], pa.binary()).cast(pa.string())
                names = pa.array([part.path] * len(some), pa.string())
                yield pa.RecordBatch.from_arrays([values, names], names=["value", "file"])


@dataclass
class Written(WriterCommitMessage):
    place: str
    name: str


class BlockWriter(DataSourceWriter):
    """A file of blocks for each task, renamed into the folder when all tasks are done."""

    def __init__(self, path: str):
        self.path = path

    def write(self, rows: Iterator) -> Written:
        import uuid

        from pyspark import TaskContext

        files, place = file_system(self.path)
        files.create_dir(f"{place}/_writing", recursive=True)
        name = f"part-{TaskContext.get().partitionId():05d}.gz"
        there = f"{place}/_writing/{uuid.uuid4().hex}"
        held, total = [], 0
        with files.open_output_stream(there) as out:
            for row in rows:
                line = (row[0] or "").encode() + b"\n"
                held.append(line)
                total += len(line)
                if total >= 1 << 20:
                    data = b"".join(held)
                    whole = len(data) - len(data) % BLOCK
                    out.write(blocks(data[:whole]))
                    held, total = [data[whole:]], len(data) - whole
            out.write(blocks(b"".join(held)) + END)
        return Written(there, f"{place}/{name}")

    def commit(self, messages: list[Written | None]) -> None:
        files, place = file_system(self.path)
        for m in messages:
            files.move(m.place, m.name)
        files.delete_dir(f"{place}/_writing")

    def abort(self, messages: list[Written | None]) -> None:
        files, place = file_system(self.path)
        files.delete_dir_contents(f"{place}/_writing", missing_dir_ok=True)


def blocks(data: bytes) -> bytes:
    """``data`` as blocks."""
    out = []
    for k in range(0, len(data), BLOCK):
        part = data[k : k + BLOCK]
        packer = zlib.compressobj(6, zlib.DEFLATED, -15)
        packed = packer.compress(part) + packer.flush()
        head = b"\x1f\x8b\x08\x04\0\0\0\0\0\xff\x06\0BC\x02\0" + struct.pack("<H", len(packed) + 25)
        out.append(head + packed + struct.pack("<II", zlib.crc32(part), len(part)))
    return b"".join(out)


class BlockText(DataSource):
    """Format ``blocktext``: the lines (``value``) of block-compressed files, and the ``file`` of each."""

    @classmethod
    def name(cls) -> str:
        return "blocktext"

    def schema(self) -> str:
        return "value string, file string"

    def reader(self, schema) -> BlockReader:
        return BlockReader(self.options["path"], int(self.options.get("range", RANGE)))

    def writer(self, schema, overwrite: bool) -> BlockWriter:
        return BlockWriter(self.options["path"])


def read_lines(spark: SparkSession, path: str, size: int = RANGE) -> DataFrame:
    """(value, file) of every line of a file or folder, about ``size`` compressed bytes to a task."""
    spark.dataSource.register(BlockText)
    return spark.read.format("blocktext").option("range", size).load(path)


def write_lines(df: DataFrame, path: str) -> None:
    """The first column of ``df`` as block-compressed text in a new folder."""
    df.sparkSession.dataSource.register(BlockText)
    df.write.format("blocktext").mode("append").save(path)
