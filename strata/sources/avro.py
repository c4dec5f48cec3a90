"""Avro container files, read and written by Spark tasks without any package on the session.

``AvroFiles`` is a Python data source. A file is a header and blocks of rows, each followed by
the file's own marker. A reading task takes the blocks whose preceding marker starts within its
stretch of bytes, so one large file is read by many tasks; small files share one. Within a task
the blocks of a stretch are decoded side by side: numpy reads the first row of every block, then
the second of every block and so on, so no Python runs per row. Writing lays out whole Arrow
batches at once.

A write is staged next to its target and moved there on commit, partition folder by partition
folder; files of failed or repeated attempts are named by no commit message and are dropped.
"""

from __future__ import annotations

import json
import os
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceArrowWriter,
    DataSourceReader,
    InputPartition,
    WriterCommitMessage,
)
from pyspark.sql.pandas.types import from_arrow_schema, to_arrow_schema
from pyspark.sql.types import StringType, StructType

from strata.files import file_system

FORMAT = "strata_avro"

# The magic of the format, the length of its marker and the names of its metadata.
_MAGIC = b"Obj\x01"
_MARK = 16
_SCHEMA, _CODEC = b"avro.schema", b"avro.codec"
# Fixed value: the folder of rows whose partition value is NULL.
_NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"
# Characters that folder names of partitions escape.
_ESCAPED = re.compile(r"""[\x00-\x1f"#%'*/:=?\\\x7f{\[\]^]""")

# Bytes of rows in a block, of a file in a task, and of rows that are decoded at once.
BLOCK_BYTES = 16_000
SPLIT_BYTES = 64 << 20
_DECODED_BYTES = 16 << 20

# Avro types, with the logical ones, and their Arrow counterparts.
_TO_ARROW = {
    "string": pa.string(),
    "bytes": pa.binary(),
    "int": pa.int32(),
    "long": pa.int64(),
    "float": pa.float32(),
    "double": pa.float64(),
    "boolean": pa.bool_(),
    "date": pa.date32(),
    "timestamp-micros": pa.timestamp("us", "UTC"),
}
_LOGICAL = {"date": "int", "timestamp-micros": "long"}
_FIXED_WIDTH = {"float": "<f4", "double": "<f8"}


class TornFile(ValueError):
    """A container file that breaks off or whose bytes are not what they should be."""


# --- the format -------------------------------------------------------------------------


@dataclass(frozen=True)
class Column:
    """A field of a record: its type, and which branch of its union is null, if any."""

    name: str
    kind: str
    null_at: int | None

    @property
    def stored(self) -> str:
        return _LOGICAL.get(self.kind, self.kind)


def columns_of(schema: str) -> list[Column]:
    """The fields of a flat record schema."""
    record = json.loads(schema)
    if record.get("type") != "record":
        raise ValueError("an Avro record schema is needed")
    out = []
    for f in record["fields"]:
        union = f["type"] if isinstance(f["type"], list) else [f["type"]]
        kinds = [k for k in union if k != "null"]
        kind = kinds[0] if kinds else None
        if isinstance(kind, dict):
            kind = kind.get("logicalType") if kind.get("logicalType") in _LOGICAL else kind["type"]
        if len(kinds) != 1 or kind not in _TO_ARROW or len(union) > 2:
            raise ValueError(f"unsupported Avro type for field {f['name']}: {f['type']}")
        out.append(Column(f["name"], kind, union.index("null") if "null" in union else None))
    return out


def schema_text(schema: pa.Schema) -> tuple[str, list[Column]]:
    """A record schema for Arrow columns, every field nullable."""
    fields, columns = [], []
    for f in schema:
        kind = next((k for k, t in _TO_ARROW.items() if t == _plain(f.type)), None)
        if kind is None:
            raise ValueError(f"column {f.name} of type {f.type} has no Avro counterpart here")
        declared = {"type": _LOGICAL[kind], "logicalType": kind} if kind in _LOGICAL else kind
        fields.append({"name": f.name, "type": ["null", declared], "default": None})
        columns.append(Column(f.name, kind, 0))
    return json.dumps({"type": "record", "name": "row", "fields": fields}), columns


def _plain(kind: pa.DataType) -> pa.DataType:
    if pa.types.is_large_string(kind):
        return pa.string()
    if pa.types.is_large_binary(kind):
        return pa.binary()
    if pa.types.is_timestamp(kind):
        return _TO_ARROW["timestamp-micros"]
    return pa.int32() if kind in (pa.int8(), pa.int16()) else kind


def _long(value: int) -> bytes:
    value, out = (value << 1) ^ (value >> 63), bytearray()
    while value > 0x7F:
        out.append(value & 0x7F | 0x80)
        value >>= 7
    return bytes([*out, value])


def _read_long(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        byte, at = data[at], at + 1
        value |= (byte & 0x7F) << shift
        if byte < 0x80:
            return (value >> 1) ^ -(value & 1), at
        shift += 7


def _pack(block: bytes, codec: str) -> bytes:
    if codec == "snappy":
        packed = pa.Codec("snappy").compress(block, asbytes=True)
        return packed + zlib.crc32(block).to_bytes(4, "big")
    if codec == "deflate":
        packer = zlib.compressobj(6, zlib.DEFLATED, -15)
        return packer.compress(block) + packer.flush()
    return block


def _unpack(block: bytes, codec: str) -> bytes:
    try:
        if codec == "snappy":
            # The length in front is a plain varint, so half of it is not its sign.
            size = shift = at = 0
            while True:
                size |= (block[at] & 0x7F) << shift
                shift, at = shift + 7, at + 1
                if block[at - 1] < 0x80:
                    break
            plain = pa.Codec("snappy").decompress(block[:-4], size, asbytes=True)
            if zlib.crc32(plain) != int.from_bytes(block[-4:], "big"):
                raise TornFile("a block does not have its checksum")
            return plain
        if codec == "deflate":
            return zlib.decompress(block, -15)
    except (pa.ArrowException, OSError, zlib.error, IndexError) as broken:
        raise TornFile("a block cannot be decompressed") from broken
    if codec not in ("null", ""):
        raise ValueError(f"unsupported Avro codec {codec}")
    return block


# --- rows to bytes ----------------------------------------------------------------------


def _varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows x 10 bytes, lengths) of zigzag numbers."""
    zigzag = ((values << 1) ^ (values >> 63)).view(np.uint64)
    length = np.ones(len(values), np.int64)
    for k in range(1, 10):
        length += zigzag >= np.uint64(1 << (7 * k))
    widest = int(length.max(initial=1))
    out = np.zeros((len(values), widest), np.uint8)
    for k in range(widest):
        byte = ((zigzag >> np.uint64(7 * k)) & np.uint64(0x7F)).astype(np.uint8)
        out[:, k] = byte | np.where(length > k + 1, np.uint8(0x80), np.uint8(0))
    return out, length


def _spread(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All numbers from each start on, ``length`` of them each."""
    before = np.cumsum(length) - length
    return np.repeat(start - before, length) + np.arange(int(length.sum()))


def encode(batch: pa.RecordBatch, columns: list[Column]) -> tuple[np.ndarray, np.ndarray]:
    """The rows of a batch one after the other, and where each of them ends."""
    rows = batch.num_rows
    heads, head_sizes, tails = [], [], []
    for column, values in zip(columns, batch.columns, strict=True):
        there = values.is_valid().to_numpy(zero_copy_only=False)
        head, tail = _encoded(column, values, there)
        marked = np.concatenate([np.where(there, 2, 0).astype(np.uint8)[:, None], head[0]], axis=1)
        heads.append(marked)
        head_sizes.append(1 + np.where(there, head[1], 0))
        tails.append(tail)
    sizes = np.zeros((rows, 2 * len(columns)), np.int64)
    for i, tail in enumerate(tails):
        sizes[:, 2 * i] = head_sizes[i]
        if tail is not None:
            sizes[:, 2 * i + 1] = tail[2]
    ends = np.cumsum(sizes.ravel()).reshape(sizes.shape)
    starts = ends - sizes
    out = np.zeros(int(ends[-1, -1]) if rows and len(columns) else 0, np.uint8)
    for i, (head, size) in enumerate(zip(heads, head_sizes, strict=True)):
        for k in range(head.shape[1]):
            has = size > k
            out[starts[has, 2 * i] + k] = head[has, k]
        if tails[i] is not None:
            data, first, length = tails[i]
            out[_spread(starts[:, 2 * i + 1], length)] = data[_spread(first, length)]
    return out, ends[:, -1] if len(columns) else np.zeros(rows, np.int64)


def _encoded(column: Column, values: pa.Array, there: np.ndarray):
    """((bytes per row, their number), (data, start, length) of text or None)."""
    kind = column.stored
    if kind in ("string", "bytes"):
        raw = pc.fill_null(values.cast(pa.binary()), b"")
        if raw.null_count or isinstance(raw, pa.ChunkedArray):
            raise ValueError("unexpected layout of text")
        _, at, data = raw.buffers()
        offsets = np.frombuffer(at, np.int32)[raw.offset : raw.offset + len(raw) + 1]
        length = np.diff(offsets).astype(np.int64)
        bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        return _varints(length), (bytes_, offsets[:-1].astype(np.int64), length)
    if kind == "boolean":
        flags = pc.fill_null(values, False).to_numpy(zero_copy_only=False)
        return (flags.astype(np.uint8)[:, None], np.ones(len(flags), np.int64)), None
    if kind in _FIXED_WIDTH:
        numbers = pc.fill_null(values, 0).to_numpy(zero_copy_only=False)
        raw = numbers.astype(_FIXED_WIDTH[kind]).view(np.uint8).reshape(len(numbers), -1)
        return (raw, np.full(len(numbers), raw.shape[1] if len(numbers) else 0)), None
    if kind != column.kind:
        if column.kind == "timestamp-micros":
            values = values.cast(pa.timestamp("us", values.type.tz))
        values = values.view(pa.int32() if kind == "int" else pa.int64())
    whole = pc.fill_null(values.cast(pa.int64()), 0).to_numpy(zero_copy_only=False)
    return _varints(whole), None


class ContainerWriter:
    """One file, written block by block as rows come."""

    def __init__(self, path: str, schema: pa.Schema, codec: str):
        system, base = file_system(path)
        text, self.columns = schema_text(schema)
        self.codec, self.mark, self.rows = codec, os.urandom(_MARK), 0
        self._out = system.open_output_stream(base, compression=None)
        meta = {_SCHEMA: text.encode(), _CODEC: codec.encode()}
        pairs = b"".join(_long(len(x)) + x for pair in meta.items() for x in pair)
        self._out.write(_MAGIC + _long(len(meta)) + pairs + b"\0" + self.mark)

    def write(self, batch: pa.RecordBatch) -> None:
        if not batch.num_rows:
            return
        data, ends = encode(batch, self.columns)
        cuts = np.flatnonzero(np.diff(ends // BLOCK_BYTES)) + 1
        first = 0
        for last in (*cuts.tolist(), batch.num_rows):
            start = int(ends[first - 1]) if first else 0
            block = _pack(data[start : int(ends[last - 1])].tobytes(), self.codec)
            self._out.write(_long(last - first) + _long(len(block)) + block + self.mark)
            first = last
        self.rows += batch.num_rows

    def close(self) -> None:
        self._out.close()


# --- bytes to rows ----------------------------------------------------------------------


@dataclass(frozen=True)
class Header:
    schema: str
    codec: str
    mark: bytes
    size: int


def read_header(source) -> Header:
    """The header of an open file."""
    want = 1 << 14
    while True:
        source.seek(0)
        data = source.read(want)
        try:
            return _header(data)
        except IndexError:
            if len(data) < want:
                raise TornFile("a header breaks off") from None
            want *= 4


def _header(data: bytes) -> Header:
    if data[:4] != _MAGIC:
        raise TornFile("not an Avro container file")
    at, meta = 4, {}
    while True:
        count, at = _read_long(data, at)
        if not count:
            break
        if count < 0:
            _, at = _read_long(data, at)
        for _ in range(abs(count)):
            pair = []
            for _ in range(2):
                size, at = _read_long(data, at)
                if size < 0 or at + size > len(data):
                    raise IndexError
                pair.append(data[at : at + size])
                at += size
            meta[pair[0]] = pair[1]
    if at + _MARK > len(data):
        raise IndexError
    mark = data[at : at + _MARK]
    codec = meta.get(_CODEC, b"null").decode()
    return Header(meta[_SCHEMA].decode(), codec, mark, at + _MARK)


def blocks(source, size: int, header: Header, start: int, end: int) -> Iterator[tuple[int, bytes]]:
    """(rows, bytes) of the blocks whose preceding marker starts in ``start`` to ``end``."""
    at = _next_mark(source, size, header, max(start, header.size - _MARK), end)
    while at is not None and at < end and at + _MARK < size:
        source.seek(at + _MARK)
        front = source.read(20)
        try:
            rows, used = _read_long(front, 0)
            length, used = _read_long(front, used)
        except IndexError:
            raise TornFile("a block breaks off") from None
        at += _MARK + used + length
        if rows < 0 or length < 0 or at + _MARK > size:
            raise TornFile("a block breaks off")
        source.seek(at - length)
        block = source.read(length + _MARK)
        if block[length:] != header.mark:
            raise TornFile("a block is not followed by its marker")
        yield rows, _unpack(block[:length], header.codec)


def _next_mark(source, size: int, header: Header, at: int, end: int) -> int | None:
    """Where the next marker starts, before ``end``."""
    window = 1 << 20
    while at < min(end, size):
        source.seek(at)
        found = source.read(window + _MARK).find(header.mark)
        if found >= 0:
            return at + found if at + found < end else None
        at += window
    return None


def _read_longs(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The number at each place; the places move behind it."""
    byte = data[at]
    value = (byte & 0x7F).astype(np.uint64)
    at += 1
    more, shift = np.flatnonzero(byte >= 0x80), 7
    while len(more):
        if shift > 63:
            raise TornFile("a number is too long")
        byte = data[at[more]]
        value[more] |= (byte & 0x7F).astype(np.uint64) << np.uint64(shift)
        at[more] += 1
        more, shift = more[byte >= 0x80], shift + 7
    return (value >> np.uint64(1)).view(np.int64) ^ -(value & np.uint64(1)).view(np.int64)


def decode(parts: list[tuple[int, bytes]], columns: list[Column]) -> list[pa.Array]:
    """The columns of blocks, whose rows are read side by side, in the order of the blocks."""
    counts = np.array([n for n, _ in parts], np.int64)
    sizes = np.array([len(b) for _, b in parts], np.int64)
    # Room behind the end, so that a row that breaks off is noticed and not read past.
    data = np.frombuffer(b"".join(b for _, b in parts) + bytes(16), np.uint8)
    order = np.argsort(-counts, kind="stable")
    limit = np.cumsum(sizes)[order]
    at = limit - sizes[order]
    first = (np.cumsum(counts) - counts)[order]
    falling = -counts[order]
    total = int(counts.sum())
    found = [_Decoded(c, total) for c in columns]
    try:
        for row in range(int(counts.max(initial=0))):
            live = int(np.searchsorted(falling, -row, side="left"))
            here, target = at[:live], first[:live] + row
            for column in found:
                column.take(data, here, target)
            if (here > limit[:live]).any():
                raise TornFile("a row breaks off")
    except IndexError:
        raise TornFile("a row breaks off") from None
    if (at != limit).any():
        raise TornFile("a block holds more than its rows")
    return [column.array(data) for column in found]


class _Decoded:
    """One column as it is read: numbers, or where its texts lie."""

    def __init__(self, column: Column, rows: int):
        self.column = column
        self.missing = np.zeros(rows, bool)
        kind = column.stored
        self.is_text = kind in ("string", "bytes")
        self.values = np.zeros(rows, _FIXED_WIDTH.get(kind, np.int64))
        self.length = np.zeros(rows, np.int64) if self.is_text else None

    def take(self, data: np.ndarray, at: np.ndarray, target: np.ndarray) -> None:
        some = None
        if self.column.null_at is not None:
            branch = _read_longs(data, at)
            if ((branch < 0) | (branch > 1)).any():
                raise TornFile("a union has no such branch")
            there = branch != self.column.null_at
            if not there.all():
                self.missing[target[~there]] = True
                some = np.flatnonzero(there)
                target = target[some]
        own = at if some is None else at[some]
        kind = self.column.stored
        if kind in _FIXED_WIDTH:
            width = self.values.dtype.itemsize
            raw = data[own[:, None] + np.arange(width)]
            self.values[target] = np.ascontiguousarray(raw).view(self.values.dtype).ravel()
            own += width
        elif kind == "boolean":
            self.values[target] = data[own]
            own += 1
        else:
            number = _read_longs(data, own)
            if self.is_text:
                if (number < 0).any() or (number > len(data)).any():
                    raise TornFile("a text has no such length")
                self.values[target], self.length[target] = own, number
                own += number
            else:
                self.values[target] = number
        if some is not None:
            at[some] = own

    def array(self, data: np.ndarray) -> pa.Array:
        kind, missing = self.column.kind, self.missing
        target = _TO_ARROW[kind]
        if not self.is_text:
            values = self.values
            if kind == "boolean":
                values = values.astype(bool)
            if self.column.stored == "int":
                values = values.astype(np.int32)
            plain = pa.array(values, mask=missing)
            return plain if plain.type == target else plain.view(target)
        offsets = np.concatenate([[0], np.cumsum(self.length)]).astype(np.int32)
        text = data[_spread(self.values, self.length)]
        valid = None
        if missing.any():
            valid = pa.py_buffer(np.packbits(~missing, bitorder="little").tobytes())
        buffers = [valid, pa.py_buffer(offsets.tobytes()), pa.py_buffer(text.tobytes())]
        out = pa.Array.from_buffers(target, len(missing), buffers)
        out.validate(full=True)
        return out


def read_stretch(path: str, start: int, end: int) -> Iterator[pa.RecordBatch]:
    """The rows of the blocks that belong to a stretch of a file."""
    system, base = file_system(path)
    with system.open_input_file(base) as source:
        size, header = source.size(), read_header(source)
        columns = columns_of(header.schema)
        names = [c.name for c in columns]
        run, held = [], 0
        for block in blocks(source, size, header, start, end):
            run.append(block)
            held += len(block[1])
            if held >= _DECODED_BYTES:
                yield pa.RecordBatch.from_arrays(decode(run, columns), names)
                run, held = [], 0
        if run:
            yield pa.RecordBatch.from_arrays(decode(run, columns), names)


# --- the data source --------------------------------------------------------------------


def folder_name(column: str, value: str | None) -> str:
    """A partition's folder, as Spark's own file sources name it."""
    if value is None or value == "":
        return f"{column}={_NULL_FOLDER}"
    return f"{column}={_ESCAPED.sub(lambda m: f'%{ord(m[0]):02X}', value)}"


def folder_values(path: str, base: str) -> dict[str, str | None]:
    """Partition columns and values that the folders of a file say."""
    found = {}
    for part in path[len(base) :].split("/")[:-1]:
        name, equals, value = part.partition("=")
        if equals:
            plain = re.sub(r"%([0-9A-Fa-f]{2})", lambda m: chr(int(m[1], 16)), value)
            found[name] = None if value == _NULL_FOLDER else plain
    return found


@dataclass
class Stretches(InputPartition):
    """What one task reads: (file, start, end, partition values)."""

    parts: list[tuple[str, int, int, dict]] = field(default_factory=list)


@dataclass
class Written(WriterCommitMessage):
    """What one task wrote: (folder below the target, file name)."""

    files: list[tuple[str, str]] = field(default_factory=list)


class AvroFiles(DataSource):
    """Options: path; partition_by (a column); only (JSON list of its values, to read no others);
    compression (snappy, deflate, null); partitionOverwriteMode (dynamic, static); split_bytes."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> StructType:
        """That of the first file, with partition columns as text at the end."""
        base, listed = _listed(self.options)
        if not listed:
            raise FileNotFoundError(f"no Avro files under {self.options['path']}")
        first = listed[0].path
        system, _ = file_system(self.options["path"])
        with system.open_input_file(first) as source:
            columns = columns_of(read_header(source).schema)
        names = [(c.name, _TO_ARROW[c.kind]) for c in columns]
        own = from_arrow_schema(pa.schema(names))
        for name in folder_values(first, base):
            own = own.add(name, StringType())
        return own

    def reader(self, schema: StructType) -> AvroReader:
        return AvroReader(self.options, schema)

    def writer(self, schema: StructType, overwrite: bool) -> AvroWriter:
        return AvroWriter(self.options, schema, overwrite)


def _listed(options) -> tuple[str, list[fs.FileInfo]]:
    """The data files under the path, or of the wanted partitions' folders alone."""
    system, base = file_system(options["path"])
    folders = [base]
    if options.get("only") is not None:
        column = options["partition_by"]
        folders = [f"{base}/{folder_name(column, v)}" for v in json.loads(options["only"])]
    out = []
    for folder in dict.fromkeys(folders):
        selector = fs.FileSelector(folder, allow_not_found=True, recursive=True)
        for info in system.get_file_info(selector):
            hidden = any(p.startswith((".", "_")) and "=" not in p for p in _below(info.path, base))
            if info.type == fs.FileType.File and not hidden:
                out.append(info)
    return base, sorted(out, key=lambda i: i.path)


def _below(path: str, base: str) -> list[str]:
    return path[len(base) :].strip("/").split("/")


class AvroReader(DataSourceReader):
    def __init__(self, options, wanted: StructType):
        self.options, self.wanted = dict(options), wanted

    def partitions(self) -> list[InputPartition]:
        base, listed = _listed(self.options)
        most = int(self.options.get("split_bytes", SPLIT_BYTES))
        prefix = self.options["path"].rstrip("/")
        tasks, held = [Stretches([])], 0
        for info in listed:
            values = folder_values(info.path, base)
            for start in range(0, max(info.size, 1), most):
                end = min(start + most, info.size)
                if held and held + end - start > most:
                    tasks.append(Stretches([]))
                    held = 0
                tasks[-1].parts.append((prefix + info.path[len(base) :], start, end, values))
                held += end - start
        return tasks

    def read(self, partition: Stretches) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(self.wanted)
        for path, start, end, values in partition.parts:
            for batch in read_stretch(path, start, end):
                yield _as_wanted(batch, schema, values)


def _as_wanted(batch: pa.RecordBatch, schema: pa.Schema, values: dict) -> pa.RecordBatch:
    """The columns asked for, by name without regard to case; those of no file are NULL."""
    own = {n.lower(): i for i, n in enumerate(batch.schema.names)}
    values = {n.lower(): v for n, v in values.items()}
    columns = []
    for f in schema:
        at = own.get(f.name.lower())
        if at is not None:
            columns.append(batch.column(at).cast(f.type))
        else:
            value = pa.scalar(values.get(f.name.lower()), pa.string())
            columns.append(pa.repeat(value, batch.num_rows).cast(f.type))
    return pa.RecordBatch.from_arrays(columns, schema=schema)


class AvroWriter(DataSourceArrowWriter):
    def __init__(self, options, schema: StructType, overwrite: bool):
        self.path = options["path"].rstrip("/")
        self.partition_by = options.get("partition_by")
        self.codec = options.get("compression", "snappy")
        self.dynamic = options.get("partitionOverwriteMode", "static") == "dynamic"
        self.overwrite, self.schema = overwrite, to_arrow_schema(schema)
        self.staging = f"{self.path}/.staging-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        names, by = self.schema.names, self.partition_by
        kept = [n for n in names if n != by]
        schema = pa.schema([self.schema.field(n) for n in kept])
        system, staging = file_system(self.staging)
        out: dict[str, tuple[str, ContainerWriter]] = {}
        for batch in iterator:
            batch = batch.rename_columns(names)
            for folder, rows in self._by_folder(batch):
                if folder not in out:
                    name = f"part-{uuid.uuid4().hex}.{self.codec}.avro"
                    system.create_dir(f"{staging}/{folder}", recursive=True)
                    file = "/".join(filter(None, (self.staging, folder, name)))
                    out[folder] = name, ContainerWriter(file, schema, self.codec)
                out[folder][1].write(rows.select(kept))
        for _, file in out.values():
            file.close()
        return Written([(folder, name) for folder, (name, _) in out.items()])

    def _by_folder(self, batch: pa.RecordBatch) -> Iterator[tuple[str, pa.RecordBatch]]:
        if self.partition_by is None:
            yield "", batch
            return
        values = batch.column(batch.schema.names.index(self.partition_by)).cast(pa.string())
        folders = {v: folder_name(self.partition_by, v) for v in pc.unique(values).to_pylist()}
        for value, folder in folders.items():
            if len(folders) == 1:
                yield folder, batch
            else:
                same = pc.is_null(values) if value is None else pc.equal(values, value)
                yield folder, batch.filter(same)

    def commit(self, messages: list[Written | None]) -> None:
        """Move what was replaced aside and the new files in; one folder after the other."""
        system, base = file_system(self.path)
        _, staging = file_system(self.staging)
        files: dict[str, list[str]] = {}
        for message in messages:
            for folder, name in message.files if message else ():
                files.setdefault(folder, []).append(name)
        aside = f"{staging}/.replaced"
        system.create_dir(aside, recursive=True)
        if self.overwrite and not (self.dynamic and self.partition_by):
            for info in system.get_file_info(fs.FileSelector(base)):
                if not info.base_name.startswith(".staging-"):
                    system.move(info.path, f"{aside}/{info.base_name}")
        elif self.overwrite:
            for folder in files:
                if system.get_file_info(f"{base}/{folder}").type != fs.FileType.NotFound:
                    system.move(f"{base}/{folder}", f"{aside}/{folder}")
        for folder, names in files.items():
            system.create_dir(f"{base}/{folder}", recursive=True)
            for name in names:
                system.move(f"{staging}/{folder}/{name}", f"{base}/{folder}/{name}")
        system.delete_dir(staging)

    def abort(self, messages: list[Written | None]) -> None:
        system, staging = file_system(self.staging)
        if system.get_file_info(staging).type != fs.FileType.NotFound:
            system.delete_dir(staging)


def register(spark: SparkSession) -> None:
    """Make the source known to a session; doing it again changes nothing.

    Sources are looked up in the session that is active in the calling thread. In a new thread
    none is until it has made a DataFrame from local rows.
    """
    spark.createDataFrame([], "nothing int")
    spark.dataSource.register(AvroFiles)
