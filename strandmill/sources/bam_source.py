"""BAM files as a data source of Spark: spark.read.format("bam").load(path).

Partitions are ranges of files, from their indexes. Filters on rname (=, in), pos (<, <=, >, >=), mapq (the same)
and flag (=, in) are pushed down: places choose the ranges that are read at all, the rest drops records before they are
decoded. Only the columns of the schema that is asked for (.schema("qname string, pos long")) are decoded, a
few thousand records at once in numpy, and go to Spark as Arrow batches.

Options: chunk, compressed bytes of a range. Rows are those of bam.bam(); a file without an index is one range.
"""

from __future__ import annotations

import gzip
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from strandmill.schema import ALIGNMENT
from strandmill.sources import bam

#: Decompressed bytes that are decoded together.
BUFFER = 1 << 22
FAR = 1 << 62
#: Bytes of a record's fixed part: offset and numpy type of each field; fixed values of the format.
FIELDS = {"ref": (0, "<i4"), "pos": (4, "<i4"), "n_name": (8, "u1"), "mapq": (9, "u1"), "n_ops": (12, "<u2"), "flag": (14, "<u2"), "n_seq": (16, "<i4")}


@dataclass
class Wanted:
    """What the pushed filters leave: contigs, places from low to before high, least and most quality, flags."""

    contigs: set[str] | None = None
    low: int = -FAR
    high: int = FAR
    least: int = -FAR
    most: int = FAR
    flags: set[int] | None = None
    told: list[str] = field(default_factory=list)

    def take(self, f: Filter) -> bool:
        """Whether the filter is one of those that can be pushed; it is then."""
        column, value = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None, getattr(f, "value", None)
        kind = type(f)
        if column in ("rname", "flag") and kind in (EqualTo, In):
            new = set(value if kind is In else [value])
            if None in new:
                return False
            name = "contigs" if column == "rname" else "flags"
            old = getattr(self, name)
            setattr(self, name, new if old is None else old & new)
        elif column in ("pos", "mapq") and kind in (GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual) and isinstance(value, int):
            if kind in (GreaterThan, GreaterThanOrEqual):
                bound, name = value + (kind is GreaterThan), "low" if column == "pos" else "least"
                setattr(self, name, max(getattr(self, name), bound))
            else:
                bound = value + (kind is LessThanOrEqual)
                if column == "pos":
                    self.high = min(self.high, bound)
                else:
                    self.most = min(self.most, bound - 1)
        else:
            return False
        self.told.append(f"{kind.__name__}({column}, {value})")
        return True

    def keep(self, names: list[str], ref: np.ndarray, pos: np.ndarray, mapq: np.ndarray, flag: np.ndarray) -> np.ndarray:
        out = (pos >= self.low) & (pos < self.high) & (mapq >= self.least) & (mapq <= self.most)
        if self.contigs is not None:
            out &= np.isin(ref, [k for k, n in enumerate([*names, "*"]) if n in self.contigs] + ([-1] if "*" in self.contigs else []))
        if self.flags is not None:
            out &= np.isin(flag, list(self.flags))
        return out


@dataclass
class Range(InputPartition):
    """Records of a file between two virtual offsets (all, if none); only those of a contig, that begin before stop."""

    path: str
    begin: int | None = None
    end: int | None = None
    contig: str | None = None
    stop: int = FAR

    def __post_init__(self) -> None:
        super().__init__(None)


def _files(path: str) -> list[str]:
    if "://" in path or path.startswith("file:"):
        system, place = arrow_fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path))
        prefix = path[: path.rindex(place)] if place in path else ""
    else:
        system, place, prefix = arrow_fs.LocalFileSystem(), path, ""
    info = system.get_file_info(place)
    if info.type == arrow_fs.FileType.NotFound:
        raise FileNotFoundError(path)
    found = [place] if info.type == arrow_fs.FileType.File else [i.path for i in system.get_file_info(arrow_fs.FileSelector(place)) if i.path.endswith(".bam")]
    return [prefix + f for f in sorted(found)]


def _walk(buffer: bytes, at: int, limit: int) -> tuple[list[int], int]:
    """Where the whole records from at on begin, of those that begin before limit, and where the next one's length stands."""
    found, n = [], len(buffer)
    while at < limit and at + 4 <= n:
        after = at + 4 + int.from_bytes(buffer[at : at + 4], "little")
        if after > n:
            break
        found.append(at + 4)
        at = after
    return found, at


def _streamed(stream: gzip.GzipFile) -> Iterator[tuple[bytes, list[int]]]:
    rest = b""
    while data := stream.read(BUFFER):
        rest += data
        found, at = _walk(rest, 0, FAR)
        if found:
            yield rest, found
        rest = rest[at:]
    if rest:
        raise ValueError("the file ends inside a record")


def _ranged(file, begin: int, end: int | None) -> Iterator[tuple[bytes, list[int]]]:
    """(buffer, places of records) of the records that begin at virtual offsets from begin to before end."""
    rest, skip, limit = b"", begin & 0xFFFF, FAR
    parts: list[bytes] = []
    size = 0
    for at, data in bam._blocks(file, begin >> 16):
        if end is not None and limit == FAR and at >= end >> 16:
            limit = len(rest) + size + ((end & 0xFFFF) - skip if at == end >> 16 else 0)
        parts.append(data[skip:])
        size += len(data) - skip
        skip = 0
        if size >= BUFFER or limit < FAR:
            rest = rest + b"".join(parts)
            parts, size = [], 0
            found, after = _walk(rest, 0, limit)
            if found:
                yield rest, found
            if after >= limit:
                return
            rest, limit = rest[after:], limit - after if limit < FAR else FAR
    rest += b"".join(parts)
    found, after = _walk(rest, 0, limit)
    if found:
        yield rest, found
    if after < min(limit, len(rest)):
        raise ValueError("the file ends inside a record")


class Decoder:
    """Columns of the records of a buffer."""

    def __init__(self, names: list[str], columns: list[str]):
        self.names, self.columns = names, columns
        self.contigs = np.array([*names, "*"], object)

    def fixed(self, buffer: bytes, places: np.ndarray) -> dict[str, np.ndarray]:
        flat = np.frombuffer(buffer, np.uint8)
        out = {}
        for name, (offset, kind) in FIELDS.items():
            kind = np.dtype(kind)
            rows = flat[places[:, None] + offset + np.arange(kind.itemsize)]
            out[name] = np.ascontiguousarray(rows).view(kind).ravel().astype(np.int64)
        return out

    def arrays(self, buffer: bytes, places: np.ndarray, f: dict[str, np.ndarray]) -> dict[str, pa.Array]:
        after_name = places + 32 + f["n_name"]
        after_ops = after_name + 4 * f["n_ops"]
        after_seq = after_ops + (f["n_seq"] + 1) // 2
        made = {
            "qname": lambda: pa.array([buffer[a:b].decode() for a, b in zip((places + 32).tolist(), (after_name - 1).tolist())], pa.string()),
            "flag": lambda: pa.array(f["flag"].astype(np.int32)),
            "rname": lambda: pa.array(self.contigs[f["ref"]], pa.string()),
            "pos": lambda: pa.array(f["pos"]),
            "mapq": lambda: pa.array(f["mapq"].astype(np.int32)),
            "cigar": lambda: self.cigars(buffer, after_name, f["n_ops"]),
            "seq": lambda: self.sequences(buffer, after_ops, f["n_seq"]),
            "sa": lambda: pa.array([bam._supplementary(buffer[a:b], 0) if buffer.find(b"SAZ", a, b) >= 0 else None for a, b in zip((after_seq + f["n_seq"]).tolist(), f["stop"].tolist())], pa.string()),
        }
        return {c: made[c]() for c in self.columns}

    def cigars(self, buffer: bytes, begin: np.ndarray, n: np.ndarray) -> pa.Array:
        """All records' operations as one array of texts, joined by record."""
        total = int(n.sum())
        starts = np.append(0, np.cumsum(n))
        at = np.repeat(begin - 4 * starts[:-1], n) + 4 * np.arange(total)
        flat = np.frombuffer(buffer, np.uint8)
        ops = np.ascontiguousarray(flat[at[:, None] + np.arange(4)]).view("<u4").ravel() if total else np.array([], np.uint32)
        letters = "MIDNSHP=X"
        texts = [f"{size}{letters[kind]}" for size, kind in zip((ops >> 4).tolist(), (ops & 15).tolist())]
        return pa.array(["".join(texts[a:b]) or "*" for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())], pa.string())

    def sequences(self, buffer: bytes, begin: np.ndarray, n: np.ndarray) -> pa.Array:
        """All records' letters in one pass."""
        packed = (n + 1) // 2
        text = b"".join(buffer[a:b] for a, b in zip(begin.tolist(), (begin + packed).tolist())).hex().translate(bam.LETTERS)
        starts = 2 * np.append(0, np.cumsum(packed))[:-1]
        return pa.array([text[a : a + k] or "*" for a, k in zip(starts.tolist(), n.tolist())], pa.string())


class BamReader(DataSourceReader):
    def __init__(self, options: dict, columns: StructType):
        self.path, self.chunk = options["path"], int(options.get("chunk", bam.CHUNK))
        self.columns, self.wanted = columns, Wanted()

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            if not self.wanted.take(f):
                yield f

    def partitions(self) -> list[Range]:
        out: list[Range] = []
        for file in _files(self.path):
            index = next((raw for name in (file + ".bai", re.sub(r"\.bam$", ".bai", file)) if name != file and (raw := _read(name)) is not None), None)
            if index is None:
                out.append(Range(file))
                continue
            with bam._open(file) as f:
                names = bam._header(gzip.GzipFile(fileobj=f))
            w = self.wanted
            if w.contigs is None and w.low <= -1 and w.high == FAR:
                out += [Range(file, a, b) for a, b, *_ in bam.ranges(index, names, None, self.chunk)] or [Range(file)]
                continue
            for name in names if w.contigs is None else [n for n in names if n in w.contigs]:
                windows = len(bam._index(index)[names.index(name)][0])
                region = (name, max(0, w.low), min(w.high, windows << bam.WINDOW))
                if region[1] < region[2]:
                    out += [Range(file, a, b, name, region[2]) for a, b, *_ in bam.ranges(index, names, [region], self.chunk)]
            if (w.contigs is None or "*" in w.contigs) and w.low <= -1:
                out += [Range(file, a, b, "*") for a, b, *_ in bam.ranges(index, names, None, self.chunk)]
        return out

    def read(self, part: Range | None) -> Iterator[pa.RecordBatch]:
        if part is None:  # no range holds what is asked for
            return
        wanted, columns = self.wanted, [c.name for c in self.columns.fields]
        arrow = to_arrow_schema(self.columns)
        with bam._open(part.path) as f:
            stream = gzip.GzipFile(fileobj=f)
            names = bam._header(stream)
            decoder = Decoder(names, columns)
            contig = None if part.contig is None else names.index(part.contig) if part.contig != "*" else -1
            for buffer, found in _streamed(stream) if part.begin is None else _ranged(f, part.begin, part.end):
                places = np.array(found, np.int64)
                sizes = np.frombuffer(buffer, np.uint8)[(places - 4)[:, None] + np.arange(4)]
                fields = decoder.fixed(buffer, places) | {"stop": places + np.ascontiguousarray(sizes).view("<i4").ravel()}
                keep = wanted.keep(names, fields["ref"], fields["pos"], fields["mapq"], fields["flag"])
                past = False
                if contig is not None:
                    keep &= fields["ref"] == contig
                    past = contig >= 0 and bool(((fields["ref"] != contig) | (fields["pos"] >= part.stop)).any())
                if keep.any():
                    own = decoder.arrays(buffer, places[keep], {n: v[keep] for n, v in fields.items()})
                    yield pa.RecordBatch.from_arrays([own[c].cast(arrow.field(c).type) for c in columns], schema=arrow)
                if past:  # the file is sorted: nothing of the region follows
                    return


def _read(path: str) -> bytes | None:
    try:
        with bam._open(path) as f:
            return f.read()
    except FileNotFoundError:
        return None


class BamSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "bam"

    def schema(self) -> str:
        return ALIGNMENT

    def reader(self, schema: StructType) -> BamReader:
        known = [c.split(" ")[0] for c in ALIGNMENT.split(", ")]
        if wrong := [c.name for c in schema.fields if c.name not in known]:
            raise ValueError(f"a BAM file has no columns {wrong}")
        return BamReader(self.options, schema)


def register(spark: SparkSession) -> None:
    """Makes the format "bam" known to the session, with filters pushed down."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(BamSource)
