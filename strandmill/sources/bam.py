"""BAM files, whole or by regions, in ranges that tasks read on their own.

An index (a.bam.bai or a.bai) tells virtual offsets at which records begin: the block's place in the file times 2^16
plus the place inside the block. Files with one are cut there into ranges of about CHUNK compressed bytes; files
without one are streamed by a task each. No file is ever held whole.
"""

from __future__ import annotations

import gzip
import io
import math
import re
import struct
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pandas as pd
from pyarrow import fs as arrow_fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandmill import schema

CHUNK, BATCH = 1 << 26, 10_000
#: Fixed values of the format: bases of a linear window as a power of two, the bin that holds counts, widths of tag types.
WINDOW, COUNTS_BIN = 14, 37450
WIDTHS = {"A": 1, "c": 1, "C": 1, "s": 2, "S": 2, "i": 4, "I": 4, "f": 4}
Region = tuple[str, int, int]


def _open(path: str) -> io.BufferedReader:
    system, place = arrow_fs.FileSystem.from_uri(re.sub("^file:/+", "file:///", path)) if ":/" in path else (arrow_fs.LocalFileSystem(), path)
    return io.BufferedReader(system.open_input_file(place), 1 << 20)


def _int(raw: bytes, at: int = 0) -> int:
    return struct.unpack_from("<i", raw, at)[0]


def _header(stream: io.BufferedIOBase) -> list[str]:
    """Contig names; the stream stands at the first record then."""
    if stream.read(4) != b"BAM\1":
        raise ValueError("not a BAM file")
    stream.read(_int(stream.read(4)))
    names = []
    for _ in range(_int(stream.read(4))):
        names.append(stream.read(_int(stream.read(4)))[:-1].decode())
        stream.read(4)
    return names


def _streamed(stream: io.BufferedIOBase) -> Iterator[bytes]:
    while head := stream.read(4):
        yield stream.read(_int(head))


def _blocks(file: io.BufferedReader, at: int) -> Iterator[tuple[int, bytes]]:
    """(place, content) of each block from the one at a place on."""
    file.seek(at)
    while len(head := file.read(12)) == 12:
        fields, k, size = file.read(struct.unpack_from("<H", head, 10)[0]), 0, None
        while k < len(fields):
            n = struct.unpack_from("<H", fields, k + 2)[0]
            if fields[k : k + 2] == b"BC":
                size = struct.unpack_from("<H", fields, k + 4)[0] + 1
            k += 4 + n
        if size is None:
            raise ValueError("not a blocked gzip file")
        yield at, zlib.decompress(file.read(size - 12 - len(fields))[:-8], wbits=-15)
        at += size


def _ranged(file: io.BufferedReader, begin: int, end: int | None) -> Iterator[bytes]:
    """Records that begin at virtual offsets from begin to before end; a record may reach over blocks."""
    rest, rest_at, skip = b"", 0, begin & 0xFFFF
    for at, data in _blocks(file, begin >> 16):
        raw, origin, old, k = rest + data[skip:], (at << 16) + skip, len(rest), 0
        skip = 0
        while True:
            place = rest_at if k < old else origin + k - old
            if k < len(raw) and end is not None and place >= end:
                return
            if len(raw) - k < 4 or len(raw) - k - 4 < _int(raw, k):
                break
            size = _int(raw, k)
            yield raw[k + 4 : k + 4 + size]
            k += 4 + size
        rest, rest_at = raw[k:], place
    if rest:
        raise ValueError("the file ends inside a record")


def _supplementary(raw: bytes, k: int) -> str | None:
    """The SA tag among the tags from k on."""
    while k < len(raw):
        tag, kind = raw[k : k + 2], chr(raw[k + 2])
        k += 3
        if kind in "ZH":
            stop = raw.index(b"\0", k)
            if tag == b"SA":
                return raw[k:stop].decode()
            k = stop + 1
        elif kind == "B":
            k += 5 + WIDTHS[chr(raw[k])] * _int(raw, k + 1)
        else:
            k += WIDTHS[kind]
    return None


def _row(raw: bytes, names: list[str]) -> tuple:
    """(qname, flag, rname, pos, mapq, cigar, seq, sa) of a record."""
    ref, pos, n_name, mapq, _, n_ops, flag, n_seq = struct.unpack_from("<iiBBHHHi", raw)
    k = 32 + n_name
    ops = struct.unpack_from(f"<{n_ops}I", raw, k)
    k += 4 * n_ops
    seq = raw[k : k + (n_seq + 1) // 2].hex().translate(LETTERS)[:n_seq]
    sa = _supplementary(raw, k + (n_seq + 1) // 2 + n_seq)
    cigar = "".join(f"{o >> 4}{'MIDNSHP=X'[o & 15]}" for o in ops) or "*"
    return raw[32 : 31 + n_name].decode(), flag, names[ref] if ref >= 0 else "*", pos, mapq, cigar, seq or "*", sa


LETTERS = str.maketrans("0123456789abcdef", "=ACMGRSVTWYHKDBN")


def _stop(raw: bytes) -> int:
    """The place after a record's last reference base; one base if it has none."""
    pos, n_name, n_ops = _int(raw, 4), raw[8], struct.unpack_from("<H", raw, 12)[0]
    ops = struct.unpack_from(f"<{n_ops}I", raw, 32 + n_name)
    return pos + (sum(o >> 4 for o in ops if o & 15 in (0, 2, 3, 7, 8)) or 1)


def _index(raw: bytes) -> list[tuple[list[int], int, int]]:
    """Per contig: its linear offsets (0 where a window has none), where its first record begins and where its last ends."""
    if raw[:4] != b"BAI\1":
        raise ValueError("not a BAM index")
    at, out = 8, []
    for _ in range(_int(raw, 4)):
        first, last, bins = 1 << 64, 0, _int(raw, at)
        at += 4
        for _ in range(bins):
            number, chunks = struct.unpack_from("<Ii", raw, at)
            places = struct.unpack_from(f"<{2 * chunks}Q", raw, at + 8)
            at += 8 + 16 * chunks
            if number != COUNTS_BIN and chunks:
                first, last = min(first, *places[::2]), max(last, *places[1::2])
        windows = _int(raw, at)
        out.append((list(struct.unpack_from(f"<{windows}Q", raw, at + 4)), first, last))
        at += 4 + 8 * windows
    return out


def disjoint(regions: Iterable[Region]) -> list[Region]:
    """Regions (chrom, start, stop; stop excluded) sorted, touching ones merged."""
    out: list[Region] = []
    for chrom, start, stop in sorted(regions):
        if out and out[-1][0] == chrom and start <= out[-1][2]:
            out[-1] = (chrom, out[-1][1], max(stop, out[-1][2]))
        elif start < stop:
            out.append((chrom, start, stop))
    return out


def _cut(begin: int, end: int | None, offsets: Iterable[int], chunk: int) -> Iterator[tuple[int, int | None]]:
    for o in sorted(set(offsets)):
        if (o >> 16) - (begin >> 16) >= chunk and (end is None or o < end):
            yield begin, o
            begin = o
    yield begin, end


def ranges(raw: bytes, names: list[str], regions: list[Region] | None, chunk: int) -> list[tuple[int, int | None, str | None, int, int]]:
    """(begin, end, chrom, start, stop) of the ranges to read; all records if regions is None, to the end of the file."""
    contigs = _index(raw)
    if regions is None:
        begin = min((first for _, first, last in contigs if last), default=0)
        return [(a, b, None, 0, 0) for a, b in _cut(begin, None, [o for linear, _, _ in contigs for o in linear if o], chunk)] if begin else []
    out = []
    for chrom, start, stop in regions:
        linear, _, last = contigs[names.index(chrom)] if chrom in names else ([], 0, 0)
        inside = [o for o in linear[start >> WINDOW : ((stop - 1) >> WINDOW) + 1] if o]
        if inside:
            out += [(a, b, chrom, start, stop) for a, b in _cut(inside[0], last, inside[1:], chunk)]
    return out


def _wanted(records: Iterable[bytes], names: list[str], regions: list[Region] | None, only: tuple[str, int, int] | None) -> Iterator[tuple]:
    """Rows of the records that overlap the regions; only: the one region of a range of a sorted file, whose reads
    that an earlier region has too are left to that."""
    if regions is None:
        for raw in records:
            yield _row(raw, names)
        return
    places: dict[str, tuple[list[int], list[int]]] = {}
    for chrom, start, stop in regions:
        starts, stops = places.setdefault(chrom, ([], []))
        starts.append(start)
        stops.append(stop)
    for raw in records:
        ref, pos = _int(raw), _int(raw, 4)
        chrom = names[ref] if ref >= 0 else None
        if only and (chrom != only[0] or pos >= only[2]):
            return
        if chrom not in places:
            continue
        starts, stops = places[chrom]
        # of the disjoint regions, the first that ends after the read begins
        k = bisect_right(stops, pos)
        if k < len(starts) and starts[k] < _stop(raw) and (not only or starts[k] == only[1]):
            yield _row(raw, names)


def bam(spark: SparkSession, path: str, regions: list[Region] | None = None, chunk: int = CHUNK) -> DataFrame:
    """Alignments of BAM files; positions count from 0. regions (chrom, start, stop; stop excluded): only the reads that overlap one
    of them, once each; contigs that a file doesn't have give none. A file with an index is read in ranges of about chunk
    bytes, of the regions alone; one without is read whole by a task."""
    wanted = None if regions is None else disjoint(regions)
    columns = [c.split(" ")[0] for c in schema.ALIGNMENT.split(", ")]

    def index_of(file: str) -> bytes | None:
        for name in (file + ".bai", re.sub(r"\.bam$", ".bai", file)):
            try:
                if name != file:
                    with _open(name) as f:
                        return f.read()
            except FileNotFoundError:
                pass
        return None

    def plan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for file in batch["path"]:
                index = index_of(file)
                found = [(None, None, None, 0, 0)] if index is None else None
                if index is not None:
                    with _open(file) as f:
                        names = _header(gzip.GzipFile(fileobj=f))
                    found = ranges(index, names, wanted, chunk) or ([(None, None, None, 0, 0)] if wanted is None else [])
                yield pd.DataFrame([(file, *r) for r in found], columns=["path", "begin", "end", "chrom", "start", "stop"]).astype({"begin": "Int64", "end": "Int64"})

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples(index=False):
                with _open(r.path) as f:
                    stream = gzip.GzipFile(fileobj=f)
                    names = _header(stream)
                    only = None if r.chrom is None or pd.isna(r.chrom) else (r.chrom, r.start, r.stop)
                    records = _streamed(stream) if pd.isna(r.begin) else _ranged(f, int(r.begin), None if pd.isna(r.end) else int(r.end))
                    rows: list[tuple] = []
                    for row in _wanted(records, names, wanted, only):
                        rows.append(row)
                        if len(rows) == BATCH:
                            yield pd.DataFrame(rows, columns=columns)
                            rows = []
                    if rows:
                        yield pd.DataFrame(rows, columns=columns)

    files = spark.read.format("binaryFile").load(path).where(~F.col("path").endswith(".bai")).select("path", "length")
    size = files.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.ceil(F.col("length") / chunk)), F.lit(0)).alias("parts")).head()
    planned = files.select("path").mapInPandas(plan, "path string, begin long, end long, chrom string, start long, stop long")
    return planned.repartition(max(1, min(100_000, math.ceil(size["n"] + size["parts"])))).mapInPandas(read, schema.ALIGNMENT)
