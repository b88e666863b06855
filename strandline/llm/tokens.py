"""Token ids by a public BPE vocabulary, the Simple-8b token files (3) and packing into windows (6).

A text within Latin-1 is lower-cased and cut into pieces as the vocabulary has it, and the library's BPE encodes each
distinct piece once per worker. Other texts are cut at white space, which the vocabulary drops, and the library's whole
chain encodes words beyond Latin-1 or with special tokens. Null texts are empty: they hold the end id alone.
"""

from __future__ import annotations

import functools
import heapq
import re
import zlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm.common import materialize, remembered, scratch, small_batches, table, text_chunks

VOCABULARY = "word_bpe_49k.json"
#: Pieces, and words beyond Latin-1, that a worker remembers. Those used since are kept when as many new ones have come.
REMEMBERED = 200_000


class _Remembered(dict):
    """A dict that fills itself and keeps at most 2 * REMEMBERED values: when full, it forgets what wasn't used since it
    was last full."""

    def __init__(self):
        self.before: dict[str, bytes] = {}

    def __missing__(self, key: str) -> bytes:
        if len(self) >= REMEMBERED:
            self.before = dict(self)
            self.clear()
        value = self.before.get(key)
        if value is None:
            value = self.made(key)
        self[key] = value
        return value


class _Pieces(_Remembered):
    def __init__(self, tokenizer):
        super().__init__()
        visible = [*range(33, 127), *range(161, 173), *range(174, 256)]
        hidden = [b for b in range(256) if b not in visible]
        byte = {b: chr(b) for b in visible} | {b: chr(256 + k) for k, b in enumerate(hidden)}
        self.byte_level = {c: "".join(byte[b] for b in chr(c).encode()) for c in range(256)}
        self.byte_pairs = tokenizer.model.tokenize

    def made(self, piece: str) -> bytes:
        level = piece if piece.isascii() and piece.isalnum() else piece.translate(self.byte_level)
        return array("I", [t.id for t in self.byte_pairs(level)]).tobytes()


#: The vocabulary's rule for pieces, within lower-case Latin-1. Letters are one piece as far as they go,
#: digits one each, endings after an apostrophe one, and anything else but white space one as far as it goes.
_LETTERS, _DIGITS, _SPACES = "a-zªµºß-öø-ÿ", "0-9²³¹¼½¾", r" \t\n\x0b\x0c\r\x85\xa0"
_CUT = re.compile(f"[{_LETTERS}]+|[{_DIGITS}]|'s|'t|'re|'ve|'m|'ll|'d|[^{_LETTERS}{_DIGITS}{_SPACES}]+").findall


class _Words(_Remembered):
    def __init__(self, path: str):
        super().__init__()
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.pieces = _Pieces(self.whole)

    def within_latin1(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, _CUT(text.lower())))

    def made(self, word: str) -> bytes:
        return self.within_latin1(word) if _is_latin1(word) and "<|" not in word else self.encoded(word)

    def encoded(self, text: str) -> bytes:
        return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def ids(self, text: str) -> bytes:
        """The ids of text as little-endian unsigned 32-bit integers."""
        if _is_latin1(text) and "<|" not in text:
            return self.within_latin1(text)
        if any(c in text for c in "\x1c\x1d\x1e\x1f"):  # split() takes these for space, the vocabulary doesn't
            return self.encoded(text)
        return b"".join([self[w] for w in text.split()])


def _is_latin1(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@functools.cache
def encoder(path: str) -> _Words:
    remembered["tokens"] = encoder.cache_clear
    return _Words(path)


def vocabulary(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# ------------------------------------------------------------------ Simple-8b
#: (ids per word, bits per id) of selectors 2 to 15; 0 is 120 zeros, 1 says that the next word is one whole id.
LAYOUTS = [(60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
ZEROS = 120
BLOCK = 4096
_BITS = np.array([i.bit_length() for i in range(1 << 16)], np.uint8)


def pack_ids(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, first word of each block): ids (unsigned) in blocks of 4096, each begun on a new word, in each word as
    many next ids as one selector holds. The low 4 bits of a word are its selector, ids follow from the low end."""
    n = len(ids)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(1, np.uint32)
    if ids.max() <= 0xFFFF:
        width, ids = _BITS[ids.astype(np.uint16)], ids.astype(np.uint64)
    else:
        ids = ids.astype(np.uint64)
        width = _BITS[np.minimum(ids, np.uint64(0xFFFF)).astype(np.uint16)]
        large = np.flatnonzero(ids > np.uint64(0xFFFF))
        width[large] = [int(i).bit_length() for i in ids[large]]
    left = np.tile(np.arange(BLOCK, 0, -1, dtype=np.int16), -(-n // BLOCK))[:n]
    left[n - n % BLOCK :] = np.arange(n % BLOCK, 0, -1)
    step, selector = np.ones(n, np.uint8), np.where(width > 60, 1, 15).astype(np.uint8)
    widest, held = width, 1  # the widest of the next `held` ids
    for s, (count, bits) in [*reversed(list(enumerate(LAYOUTS, 2)))][1:] + [(0, (ZEROS, 0))]:
        if n < count:
            break
        m = n - count + 1
        widest, held = np.maximum(widest[:m], widest[count - held :]), count  # a layout holds twice the one before at most
        fits = (widest <= bits) & (left[:m] >= count)
        if not fits.any():
            break  # wider windows of narrower ids fit nowhere either
        np.copyto(step[:m], count, where=fits)
        np.copyto(selector[:m], s, where=fits)
    at, i, go = array("q"), 0, step.tobytes()
    while i < n:
        at.append(i)
        i += go[i]
    at = np.frombuffer(at, np.int64)
    chosen = selector[at]
    place = np.cumsum(np.where(chosen == 1, 2, 1)) - np.where(chosen == 1, 2, 1)
    words = np.zeros(int(place[-1]) + (2 if chosen[-1] == 1 else 1), np.uint64)
    words[place] = chosen
    words[place[chosen == 1] + 1] = ids[at[chosen == 1]]
    for s, (count, bits) in enumerate(LAYOUTS, 2):
        here = np.flatnonzero(chosen == s)
        if len(here):
            first, word = at[here], np.full(len(here), s, np.uint64)
            for k in range(count):
                word |= ids[first + k] << np.uint64(4 + k * bits)
            words[place[here]] = word
    return words, place[np.searchsorted(at, np.arange(0, n, BLOCK))].astype(np.uint32)


def unpack_ids(words: np.ndarray, n: int) -> np.ndarray:
    """The ids that pack_ids was given; words may begin and end at any block."""
    chosen = (words & np.uint64(15)).astype(np.int64)
    if (chosen == 1).any():  # the word after an escape is no selector
        raw = np.zeros(len(words), bool)
        for i in np.flatnonzero(chosen == 1):
            if not raw[i]:
                raw[i + 1] = True
        chosen[raw] = -1
    counts = np.array([ZEROS, 1, *(c for c, _ in LAYOUTS), 0])[chosen]
    at = np.cumsum(counts) - counts
    out = np.zeros(n, np.uint64)
    escapes = np.flatnonzero(chosen == 1)
    out[at[escapes]] = words[escapes + 1] if len(escapes) else 0
    for s, (count, bits) in enumerate(LAYOUTS, 2):
        here = np.flatnonzero(chosen == s)
        for k in range(count if len(here) else 0):
            out[at[here] + k] = words[here] >> np.uint64(4 + k * bits) & np.uint64((1 << bits) - 1)
    return out


SEGMENT_IDS = 1 << 20
FILE_SCHEMA = "shard int, segment int, n_ids long, doc_ids array<long>, doc_tokens array<long>, blocks binary, words binary"


def write_token_files(docs: DataFrame, path: str, end_id: int, vocabulary_path: str) -> None:
    """Token files of documents (doc_id, text) in ascending doc_id order, a null id first. A file
    is a Parquet table of segments of about 2^20 ids: their documents with their lengths, the first word of each block
    and the words. Files are written by Spark's committer, so a lost executor leaves none half done."""

    def run(batches):
        enc, shard, end = encoder(vocabulary_path), TaskContext.get().partitionId(), np.array([end_id], "<u4").tobytes()
        ids, lengths, parts, held, segment = [], [], [], 0, 0

        def flush():
            words, blocks = pack_ids(np.frombuffer(b"".join(parts), "<u4"))
            row = [shard, segment, held, list(ids), list(lengths), blocks.astype("<u4").tobytes(), words.astype("<u8").tobytes()]
            kinds = [pa.int32(), pa.int32(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], ["shard", "segment", "n_ids", "doc_ids", "doc_tokens", "blocks", "words"])

        for some, texts in text_chunks(batches, operator="tokens"):
            for i, t in zip(some, texts, strict=True):
                parts.append(enc.ids(t) + end)
                ids.append(i)
                lengths.append(len(parts[-1]) // 4)
                held += lengths[-1]
                if held >= SEGMENT_IDS:
                    yield flush()
                    ids, lengths, parts, held, segment = [], [], [], 0, segment + 1
        if ids:
            yield flush()

    ordered = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    # by more than the id, so that neither very many rows of one id, nor of one text, nor without id are one file
    order = [F.asc_nulls_first("doc_id"), "h", "row"]
    ordered = ordered.withColumns({"h": F.xxhash64("text"), "row": F.monotonically_increasing_id()}).repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    ordered.mapInArrow(run, FILE_SCHEMA).write.parquet(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of the documents in token files; start counts the ids before them."""
    files = spark.read.schema(FILE_SCHEMA).parquet(path)

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                ids = unpack_ids(np.frombuffer(row["words"], "<u8"), row["n_ids"]).astype("<u4")
                ends = np.cumsum(row["doc_tokens"])
                starts = ends - row["doc_tokens"]
                crc = [zlib.crc32(ids[b:e].tobytes()) for b, e in zip(starts, ends, strict=True)]
                n = len(crc)
                yield pa.RecordBatch.from_arrays([pa.array([row["shard"]] * n, pa.int32()), pa.array([row["segment"]] * n, pa.int32()), pa.array(row["doc_ids"], pa.int64()), pa.array(starts, pa.int64()), pa.array(row["doc_tokens"], pa.int64()), pa.array(crc, pa.int64())], ["shard", "segment", "doc_id", "here", "n_tokens", "ids_crc32"])

    before = F.coalesce(F.sum("n_ids").over(Window.partitionBy("shard").orderBy("segment").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shards = files.groupBy("shard").agg(F.sum("n_ids").alias("ids"))  # a row for each file
    base = shards.select("shard", F.coalesce(F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    offsets = files.select("shard", "segment", before.alias("before")).join(base, "shard")
    docs = files.mapInArrow(run, "shard int, segment int, doc_id long, here long, n_tokens long, ids_crc32 long")
    return docs.join(offsets, ["shard", "segment"]).select("doc_id", (F.col("base") + F.col("before") + F.col("here")).alias("start"), "n_tokens", "ids_crc32")


def document_ids(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """(doc_id, ids) of single documents in token files: of each segment that holds one, only the blocks that its ids lie in
    are decoded, from the block offsets on. Documents of one id get a row each; ids that no file holds get none."""
    wanted = np.unique(np.array(doc_ids, np.int64))
    files = spark.read.schema(FILE_SCHEMA).parquet(path).where(F.arrays_overlap("doc_ids", F.array(*map(F.lit, wanted.tolist())).cast("array<long>")))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                words, first = np.frombuffer(row["words"], "<u8"), np.frombuffer(row["blocks"], "<u4").astype(np.int64)
                ends, held = np.cumsum(row["doc_tokens"]), np.array([-1 if i is None else i for i in row["doc_ids"]])
                found = []
                for k in np.flatnonzero(np.isin(held, wanted) & np.array([i is not None for i in row["doc_ids"]])).tolist():
                    begin, end = int(ends[k]) - row["doc_tokens"][k], int(ends[k])
                    low, high = begin // BLOCK, -(-end // BLOCK)
                    part = words[first[low] : first[high] if high < len(first) else len(words)]
                    ids = unpack_ids(part, min(high * BLOCK, row["n_ids"]) - low * BLOCK)
                    found.append((row["doc_ids"][k], ids[begin - low * BLOCK : end - low * BLOCK].astype(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in found], pa.int64()), pa.array([v for _, v in found], pa.list_(pa.int64()))], ["doc_id", "ids"])

    return files.select("n_ids", "doc_ids", "doc_tokens", "blocks", "words").mapInArrow(run, "doc_id long, ids array<long>")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark)
    write_token_files(table(spark, sf_dir, "documents"), path, 1, vocabulary())
    return read_token_files(spark, path)


# ------------------------------------------------------------------ packing
WINDOW = 4096
#: Rests of documents are cut to pieces of at most this length, so that a window holds several.
PIECE = 1024
#: Pieces that one task balances at once, on average.
GROUP_PIECES = 2048
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"
_DEALT = PIECES + ", task int, nth long"


def cut_points(n: int, window: int = WINDOW, piece: int = PIECE) -> list[int]:
    """Whole windows as long as there are any, then near-equal pieces of at most `piece`."""
    whole, rest = divmod(n, window)
    count = -(-rest // piece)
    return [*range(0, whole * window + 1, window), *(whole * window + rest * (k + 1) // count for k in range(count))]


def differenced(lengths: np.ndarray, k: int) -> np.ndarray:
    """Karmarkar-Karp: the window (0 to k-1) of each length. Every length is first a partition of its own into k sums;
    the two partitions of the largest spread merge, the largest sums of one with the smallest of the other."""
    n = len(lengths)
    parent = np.arange(n)

    def root(i):
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    heap = []
    for i, x in enumerate(lengths.tolist()):
        heap.append((-x if k > 1 else 0, i, np.concatenate(([x], np.zeros(k - 1, np.int64))), np.concatenate(([i], np.full(k - 1, -1)))))
    heapq.heapify(heap)
    while len(heap) > 1:
        _, tie, a, who = heapq.heappop(heap)
        _, _, b, whom = heapq.heappop(heap)
        total, whom = a + b[::-1], whom[::-1]
        both = np.flatnonzero((who >= 0) & (whom >= 0))
        for p, q in zip(who[both].tolist(), whom[both].tolist(), strict=True):
            parent[root(q)] = root(p)
        order = np.argsort(-total, kind="stable")
        total, who = total[order], np.where(who >= 0, who, whom)[order]
        heapq.heappush(heap, (int(total[-1] - total[0]), tie, total, who))
    number = {root(i): w for w, i in enumerate(heap[0][3].tolist()) if i >= 0}
    return np.array([number[root(i)] for i in range(n)])


def packed(lengths: np.ndarray, window: int = WINDOW) -> np.ndarray:
    """The window of each length (at most `window` each): as few windows as differencing fills within capacity."""
    out = np.zeros(len(lengths), np.int64)
    part = np.flatnonzero(lengths < window)
    whole = np.flatnonzero(lengths == window)
    k = 0
    if len(part):
        rest = lengths[part]
        k = -(-int(rest.sum()) // window)
        while np.bincount(at := differenced(rest, k), rest, k).max() > window:
            k += 1
        _, out[part] = np.unique(at, return_inverse=True)
        k = int(out[part].max()) + 1
    out[whole] = k + np.arange(len(whole))
    return out


def pack_documents(docs: DataFrame, end_id: int, vocabulary_path: str, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """A row per piece of a document's ids (end id included): where it begins and how long it is, the checksum of its
    ids, and its window with its offset there. Pieces are dealt into groups of about group_pieces, each balanced on its
    own: by a hash of what they are and of where they were cut (task and number there, written with them, so that a
    lost task is dealt alike again). Groups are thus bounded however many pieces one document or source has, and however
    often a row is repeated; repeated rows are packed as often as they occur."""

    def pieces(batches):
        enc, end = encoder(vocabulary_path), np.array([end_id], "<u4").tobytes()
        task, done = TaskContext.get().partitionId(), 0
        for ids, texts in text_chunks(batches, operator="tokens"):
            rows = []
            for i, t in zip(ids, texts, strict=True):
                data = memoryview(enc.ids(t) + end)
                n = len(data) // 4
                cuts = cut_points(n)
                rows += [(i, b, e - b, zlib.crc32(data[4 * b : 4 * e]), n) for b, e in zip(cuts, cuts[1:])]
            nth = np.arange(done, done := done + len(rows))
            yield pa.RecordBatch.from_arrays([*(pa.array(c, pa.int64()) for c in zip(*rows, strict=True)), pa.array(np.full(len(rows), task, np.int32)), pa.array(nth)], ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "task", "nth"])

    cut = materialize(small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(pieces, _DEALT))
    groups = max(1, cut.count() // group_pieces)

    def windows(part: pa.Table) -> pa.Table:
        part = part.sort_by([(c, "ascending") for c in ("doc_id", "start", "ids_crc32", "task", "nth")])
        length = part["length"].to_numpy()
        at = packed(length)
        order = np.argsort(at, kind="stable")
        before = np.cumsum(length[order]) - length[order]
        first = np.concatenate(([True], np.diff(at[order]) > 0))
        offset = np.empty(len(at), np.int64)
        offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
        ids = (part["part"].to_numpy() << 24) + at
        return part.drop_columns(["part", "task", "nth"]).append_column("sequence_id", pa.array(ids)).append_column("offset", pa.array(offset))

    dealt = cut.withColumn("part", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", "task", "nth"), F.lit(groups)))
    return dealt.groupBy("part").applyInArrow(windows, PIECES + ", sequence_id long, offset long")


def op6_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), 2, vocabulary())
