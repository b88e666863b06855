"""FASTA and FASTQ as a Spark data source of byte ranges: each range finds its first record by itself, so a plain file is
read in parallel and no line is shuffled.

A record belongs to the range that its header line begins in. Whether a line of FASTQ is a header follows from the two
lines before it, which a range reads backwards from where it begins: a line with + is a separator unless one stands before
it, the line after a separator is quality whatever it begins with, and any other line with @ is a header. Files compressed
by gzip are known by their first bytes, whatever their name, and are one range. FASTA and FASTQ are told apart by the first
letter. Paths are what pyarrow opens: local or mounted folders, and object stores by their scheme.

Two files of mates are read in lock step: a first pass counts the records of each range, so that a range of the first file
knows by which range of the second its first mate is reached, however the files are split. No record is joined.
"""

from __future__ import annotations

import gzip
import json
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from strandline.sources.fastx import paired

MAX_LENGTH, SPLIT = 10_000, 64 << 20
_BLOCK, _ROWS = 1 << 20, 4096
#: Bytes, and parts, that are one task: files and ranges may be far smaller.
_TASK, _TOGETHER = 4 << 20, 2048
RECORD = "file string, start long, ord long, read_id string, header string, seq string, quality string"
PAIR = "read_id string, ord long, header1 string, seq1 string, quality1 string, header2 string, seq2 string, quality2 string"
EXTENTS = "file string, start long, header_bytes long, body_bytes long, header string, bases long"
COUNTS = "file string, start long, stop long, packed boolean, kind string, n long"


@dataclass
class Part(InputPartition):
    """Records of a file whose headers begin within start and stop; ord: how many records come before, where it is known."""

    file: str
    start: int
    stop: int
    packed: bool
    kind: str
    ord: int | None = None


@dataclass
class Bundle(InputPartition):
    """Parts that one task reads one after another."""

    parts: list[Part]


@dataclass
class PairPart(InputPartition):
    """Mates of the records of one part of the first file: the second's are `skip` records into what is read from `two`."""

    one: Part
    two: Part
    skip: int
    n: int


def _located(path: str) -> tuple[fs.FileSystem, str]:
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    return fs.FileSystem.from_uri("file://" + path.removeprefix("file:") if path.startswith("file:/") and not path.startswith("file://") else path)


def _files(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of a file, or of the files below a folder in the order of their names; hidden ones are left out."""
    store, place = _located(path)
    head = store.get_file_info(place)
    if head.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    if head.type == fs.FileType.File:
        return [(path, head.size)]
    below = [i for i in store.get_file_info(fs.FileSelector(place, recursive=True)) if i.type == fs.FileType.File and i.base_name[0] not in "._"]
    root = path[: len(path) - len(place)] if path.endswith(place) else path[: path.index("://") + 3] if "://" in path else ""
    return [(root + i.path if "://" not in i.path else i.path, i.size) for i in sorted(below, key=lambda i: i.path)]


def _kind(file: str, packed: bool) -> str:
    store, place = _located(file)
    with store.open_input_file(place) as raw:
        source = gzip.GzipFile(fileobj=raw) if packed else raw
        while block := source.read(_BLOCK):
            if block := block.lstrip():
                if block[:1] not in (b">", b"@"):
                    raise ValueError(f"neither FASTA nor FASTQ: {file}")
                return "fasta" if block[:1] == b">" else "fastq"
    return "fasta"  # of an empty file nothing is known, and nothing read


def parts(path: str, split: int) -> list[Part]:
    out = []
    for file, size in _files(path):
        store, place = _located(file)
        with store.open_input_file(place) as raw:
            packed = raw.read(2) == b"\x1f\x8b"
        kind = _kind(file, packed)
        ranges = [(0, 1 << 62)] if packed else [(b, min(b + split, size)) for b in range(0, size, split)]
        out += [Part(file, b, e, packed, kind) for b, e in ranges]
    return out


def _bundles(found: list[Part]) -> list[Bundle]:
    """Parts in their order, so many together that a task has about _TASK bytes; packed files are alone."""
    out: list[Bundle] = []
    room = 0
    for part in found:
        size = part.stop - part.start
        if not out or size > room or len(out[-1].parts) >= _TOGETHER:
            out.append(Bundle([]))
            room = _TASK
        out[-1].parts.append(part)
        room -= size
    return out


def _lines(source, at: int, size: int = _BLOCK) -> Iterator[tuple[int, int, bytes]]:
    """(offset, offset of what follows, line) from where source stands, `at`, read by `size` bytes."""
    rest = b""
    while block := source.read(size):
        lines = (rest + block).split(b"\n")
        rest = lines.pop()
        for line in lines:
            yield at, at + len(line) + 1, line.removesuffix(b"\r")
            at += len(line) + 1
    if rest:
        yield at, at + len(rest), rest.removesuffix(b"\r")


def _before(source, start: int) -> tuple[int, bytes, bytes]:
    """(offset of the first line that begins at start or later, first letters of the last line before it and of the one
    before that)."""
    back = 1 << 12
    while True:
        low = max(0, start - back)
        source.seek(low)
        block = source.read(start - low)
        one = block.rfind(b"\n", 0, len(block) - 1)
        two = block.rfind(b"\n", 0, max(one, 0))
        if low == 0 or two >= 0:
            break
        back *= 8
    first = block[one + 1 : one + 2].strip()
    second = block[two + 1 : two + 2].strip() if one >= 0 else b""
    source.seek(start - 1)
    at = start - 1
    while block := source.read(_BLOCK):
        if (end := block.find(b"\n")) >= 0:
            return at + end + 1, first, second
        at += len(block)
    return at, first, second


def _records(part: Part) -> Iterator[tuple[tuple[int, int, int], list[bytes], int]]:
    """(offsets, lines, number of the separator among them) of the records that begin in a part; 0 where there is none.
    Offsets are those of the record, of what follows its header, and of what follows it."""
    store, place = _located(part.file)
    with store.open_input_file(place) as raw:
        source, at, one, two = raw, 0, b"", b""
        if part.packed:
            source = gzip.GzipFile(fileobj=raw)
        elif part.start:
            at, one, two = _before(raw, part.start)
            raw.seek(at)
        fastq, begin, held, separator = part.kind == "fastq", -1, [], 0
        body = end = 0
        for offset, after, line in _lines(source, at, min(_BLOCK, max(part.stop - at, 1 << 12))):
            first = line[:1].strip()
            quality = fastq and one == b"+" and two != b"+"
            if not quality and first == (b"@" if fastq else b">"):
                if begin >= 0:
                    yield (begin, body, offset), held, separator
                if offset >= part.stop:
                    return
                begin, body, held, separator = offset, after, [line], 0
            elif begin >= 0:
                if fastq and not quality and first == b"+" and one != b"+":
                    if separator:
                        raise ValueError(f"not a FASTQ record: {held[0].decode('utf-8', 'replace')}")
                    separator = len(held)
                held.append(line)
            elif part.start == 0 and line.strip():
                raise ValueError(f"not a record: {line[:100].decode('utf-8', 'replace')}")
            elif offset >= part.stop:
                return
            one, two, end = first, one, after
        if begin >= 0:
            yield (begin, body, end), held, separator


def _parsed(part: Part, most: int) -> Iterator[tuple]:
    """(start, read_id, header, seq, quality) of a part's records. Qualities are cut, or filled up with their last letter,
    to the sequence; FASTQ reads are cut at `most`."""
    fastq = part.kind == "fastq"
    for (start, _, _), lines, separator in _records(part):
        header = lines[0][1:].decode()
        read_id = header.split(None, 1)[0] if header and not header[0].isspace() else ""
        if fastq:
            if not 1 < separator < len(lines) - 1:
                raise ValueError(f"not a FASTQ record: {header}")
            seq, quality = (b"".join(p).decode() for p in (lines[1:separator], lines[separator + 1 :]))
            quality = quality[: len(seq)].ljust(len(seq), quality[-1:] or "!")
            yield start, read_id, header, seq[:most], quality[:most]
        else:
            body = lines[1:]
            if not body or any(line[:1] in (b"@", b"+") for line in body):
                raise ValueError(f"not a FASTA record: {header}")
            yield start, read_id, header, b"".join(body).decode(), None


_TYPES = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_()}


def _batches(rows: Iterator[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    names, kinds = zip(*(f.split() for f in schema.split(", ")), strict=True)
    held: list[tuple] = []
    size = 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(c, _TYPES[k]) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], list(names))

    for row in rows:
        held.append(row)
        size += sum(len(v) for v in row if isinstance(v, str))
        if len(held) >= _ROWS or size >= 8 * _BLOCK:
            yield batch()
            held, size = [], 0
    if held:
        yield batch()


def _of(bundle: Bundle | None) -> list[Part]:
    return [] if bundle is None else bundle.parts  # there may be no parts


class _Reader(DataSourceReader):
    def __init__(self, options: dict):
        self.options, self.most = dict(options), int(options.get("maxlength", MAX_LENGTH))

    def partitions(self):
        if (index := self.options.get("index")) is not None:
            return _bundles([Part(**p) for p in json.loads(index)])
        return _bundles(parts(self.options["path"], int(self.options.get("splitbytes", SPLIT))))


class _RecordReader(_Reader):
    def rows(self, part: Part) -> Iterator[tuple]:
        known = part.ord is not None
        return ((part.file, start, part.ord + k if known else None, *rest) for k, (start, *rest) in enumerate(_parsed(part, self.most)))

    def read(self, bundle: Bundle | None):
        return _batches((r for part in _of(bundle) for r in self.rows(part)), RECORD)


class _CountReader(_Reader):
    def read(self, bundle: Bundle | None):
        return _batches(((part.file, part.start, part.stop, part.packed, part.kind, sum(1 for _ in _records(part))) for part in _of(bundle)), COUNTS)


class _ExtentReader(_Reader):
    def read(self, bundle: Bundle | None):
        rows = ((part.file, b, m - b, e - m, lines[0][1:].decode(), sum(len(x.strip()) for x in lines[1 : separator or None])) for part in _of(bundle) for (b, m, e), lines, separator in _records(part))
        return _batches(rows, EXTENTS)


class _PairReader(_Reader):
    def partitions(self):
        return [PairPart(Part(**p["one"]), Part(**p["two"]), p["skip"], p["n"]) for p in json.loads(self.options["index"])]

    def read(self, part: PairPart | None):
        if part is None:
            return iter(())
        bare = lambda i: i[:-2] if i[-2:] in ("/1", "/2") else i

        def rows():
            others = _parsed(part.two, self.most)
            for _ in range(part.skip):
                next(others)
            for k, (_, i, *one) in enumerate(_parsed(part.one, self.most)):
                _, j, *two = next(others)
                if bare(i) != bare(j):
                    raise ValueError(f"no pair: {i}, {j}")
                yield bare(i), part.one.ord + k, *one, *two

        return _batches(rows(), PAIR)


class _Source(DataSource):
    kind, columns, made = "", "", _Reader

    @classmethod
    def name(cls):
        return cls.kind

    def schema(self):
        return self.columns

    def reader(self, schema):
        return self.made(self.options)


class FastxRecords(_Source):
    kind, columns, made = "fastx", RECORD, _RecordReader


class FastxCounts(_Source):
    kind, columns, made = "fastx_counts", COUNTS, _CountReader


class FastxPairs(_Source):
    kind, columns, made = "fastx_pairs", PAIR, _PairReader


class FastxExtents(_Source):
    kind, columns, made = "fastx_extents", EXTENTS, _ExtentReader


def register(spark: SparkSession) -> None:
    for source in (FastxRecords, FastxCounts, FastxPairs, FastxExtents):
        spark.dataSource.register(source)


def _indexed(spark: SparkSession, path: str, split: int) -> list[tuple[Part, int]]:
    """The parts of a path, in order, with their numbers of records: a pass over the files, a row for each part."""
    register(spark)
    found = spark.read.format("fastx_counts").option("splitbytes", split).load(path).collect()
    out, before = [], 0
    order = {p.file: k for k, p in reversed(list(enumerate(parts(path, 1 << 62))))}
    for r in sorted(found, key=lambda r: (order[r["file"]], r["start"])):
        out.append((Part(r["file"], r["start"], r["stop"], r["packed"], r["kind"], before), r["n"]))
        before += r["n"]
    return out


def records(spark: SparkSession, path: str, numbered: bool = False, split: int = SPLIT, max_length: int = MAX_LENGTH) -> DataFrame:
    """(file, start, ord, read_id, header, seq, quality) of the records of a file or folder: start is the byte that a record
    begins at (in a packed file's content), ord its place among all records, null unless `numbered`, which costs a pass over
    the files beforehand. FASTA has no quality. The job fails where lines are no record."""
    register(spark)
    source = spark.read.format("fastx").option("splitbytes", split).option("maxlength", max_length)
    if numbered:
        source = source.option("index", json.dumps([asdict(p) for p, _ in _indexed(spark, path, split)]))
    return source.load(path)


def extents(spark: SparkSession, path: str, split: int = SPLIT) -> DataFrame:
    """(file, start, header_bytes, body_bytes, header, bases) of the records of a file or folder, line ends counted in bytes
    but not in bases."""
    register(spark)
    return spark.read.format("fastx_extents").option("splitbytes", split).load(path)


def records_in_ranges(spark: SparkSession, path: str, ranges: list[tuple[int, int]], split: int = SPLIT, max_length: int = MAX_LENGTH) -> DataFrame:
    """The records that begin within byte ranges (first, last; last included) of a plain file, or of a folder's files one
    after another by name. Ranges are cut to parts of at most `split` bytes; nothing else is read but the rest of the record
    that a part's last byte lies in."""
    register(spark)
    index, before = [], 0
    for whole, (_, size) in zip(parts(path, 1 << 62), [f for f in _files(path) if f[1]], strict=True):
        if whole.packed:
            raise ValueError(f"a packed file has no ranges: {whole.file}")
        here = [(max(first - before, 0), min(last - before, size - 1) + 1) for first, last in ranges]
        index += [asdict(Part(whole.file, b, min(b + split, stop), False, whole.kind)) for first, stop in here for b in range(first, stop, split)]
        before += size
    return spark.read.format("fastx").option("maxlength", max_length).option("index", json.dumps(index)).load(path)


def paired_files(spark: SparkSession, one: str, two: str, split: int = SPLIT, max_length: int = MAX_LENGTH) -> DataFrame:
    """(read_id, ord, header1, seq1, quality1, header2, seq2, quality2): records of two files, or folders, side by side by
    their place. Mates have one id but for /1 and /2. The job fails at mates of different fragments; a place with one
    mate only is refused at once. Counts are taken when this is called, rows when they are asked for."""
    first, second = (_indexed(spark, p, split) for p in (one, two))
    n, m = (sum(k for _, k in found) for found in (first, second))
    if n != m:
        raise ValueError(f"{n} records, but {m} mates: {one}, {two}")
    index, at = [], 0
    for part, count in first:
        if not count:
            continue
        while second[at][0].ord + second[at][1] <= part.ord:
            at += 1
        other = second[at][0]
        # a part is read to its file's end where its mates need more of it than their own range holds
        left, k, start = count, at, part.ord - other.ord
        rest = second[at][1] - start
        while left > rest and k + 1 < len(second) and second[k + 1][0].file == other.file:
            k += 1
            rest += second[k][1]
        if left > rest:
            return _across_files(spark, one, two, split, max_length)
        index.append({"one": asdict(part), "two": asdict(Part(other.file, other.start, second[k][0].stop, other.packed, other.kind)), "skip": start, "n": count})
    return spark.read.format("fastx_pairs").option("maxlength", max_length).option("index", json.dumps(index)).load(one)


def _across_files(spark: SparkSession, one: str, two: str, split: int, max_length: int) -> DataFrame:
    """Mates of folders whose files have other numbers of records: joined by their place."""
    keep = ["ord", "read_id", "header", "seq", "quality"]
    return paired(*(records(spark, p, True, split, max_length).select(*keep) for p in (one, two))).select("read_id", "ord", *(f"{c}{k}" for k in (1, 2) for c in keep[2:]))
