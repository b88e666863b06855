"""Token counts by overlap resynchronisation (13), for a sentencepiece BPE vocabulary with byte fallback.

A document of at most STRETCH characters is encoded whole. A longer one is cut into stretches, each with the OVERLAP
characters after it, which are dealt to tasks and encoded with offsets. Two neighbours are spliced at the first place of
their overlap where both have a token boundary that is proven stable: a place between two characters that no piece of the
vocabulary holds side by side. Byte-pair merges never cross such a place, whatever surrounds it, so the tokens before and
after it are those of the whole text. The overlap is searched in widths of NARROW characters and doubles of it; where even
all of it has no common stable boundary, the two stretches become one and are encoded again, so that the widest overlap
is the whole document.

Null and empty texts have no tokens. Strings of special tokens are ordinary text, as is the library's default. A row is
counted for each row, repeated or not, with a null doc_id or not; other columns are ignored.
"""

from __future__ import annotations

import functools

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strandline.llm.common import materialize, remembered, small_batches, table, text_chunks
from strandline.llm.tokens import vocabulary

VOCABULARY, LIMIT = "piece_bpe_32k.model", 4096
#: Characters of a stretch, of the overlap with the next one, and of the overlap's part that is searched first.
STRETCH, OVERLAP, NARROW = 32_768, 4096, 256
_SPACE, _MARK = 0x20, 0x2581


class Resynchroniser:
    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        self.encode = (library := SentencePieceProcessor(model_file=path)).encode
        ids = range(library.get_piece_size())
        names = [library.id_to_piece(i) for i in ids]
        merged = [n for i, n in zip(ids, names, strict=True) if not (library.is_byte(i) or library.is_control(i) or library.is_unknown(i))]
        # characters of each token; of a character's bytes the first stands for it, the others begin with it
        self.length = np.array([(0 if 0x80 <= int(n[1:-1], 16) < 0xC0 else 1) if library.is_byte(i) else len(n) for i, n in zip(ids, names, strict=True)])
        self.together = np.unique(np.array([ord(a) << 32 | ord(b) for n in merged for a, b in zip(n, n[1:])], np.uint64))

    def count(self, text: str) -> int:
        return len(self.encode(text))

    def starts(self, text: str) -> np.ndarray:
        """Where each token begins in text; the mark that the library puts before a text is before its first character."""
        length = self.length[self.encode(text)]
        return np.cumsum(length) - length - 1 - (length == 0)

    def stable(self, text: str, places: np.ndarray) -> np.ndarray:
        """Those of places (0 < place < len(text)) of whose two characters no piece holds both side by side."""
        codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        codes[codes == _SPACE] = _MARK
        pair = codes[places - 1] << np.uint64(32) | codes[places]
        return places[~np.isin(pair, self.together)]

    def boundary(self, text: str, starts: np.ndarray, at: int, overlap: int, narrow: int) -> int:
        """The first stable token boundary beyond `at`, at most `overlap` characters on; -1 if there is none."""
        width = narrow
        while True:
            width = min(width, overlap)
            here = starts[np.searchsorted(starts, at, "right") : np.searchsorted(starts, min(at + width, len(text)), "left")]
            found = self.stable(text[at : at + width + 1], here - at) if len(here) else here
            if len(found):
                return int(found[0]) + at
            if width == overlap:
                return -1
            width *= 2

    def spliced(self, text: str, first: bool, last: bool, core: int, overlap: int, narrow: int) -> tuple[int, int, int]:
        """(begin, end, tokens between) of a stretch of `core` characters and the overlap after it: from its first stable
        boundary to the next stretch's, as far as there are any (-1)."""
        starts = self.starts(text)
        begin = 0 if first else self.boundary(text, starts, 0, overlap, narrow)
        end = core if last else self.boundary(text, starts, core, overlap, narrow)
        if begin < 0 or end < 0:
            return begin, end, 0
        low = 0 if first else int(np.searchsorted(starts, begin))
        return begin, end, (len(starts) if last else int(np.searchsorted(starts, end))) - low


@functools.cache
def resynchroniser(path: str) -> Resynchroniser:
    remembered["counts"] = resynchroniser.cache_clear
    return Resynchroniser(path)


_COUNTED = "doc_id long, n_bytes long, n_tokens long"
_CUT = "row long, k long, last boolean, doc_id long, n_bytes long, begin long, text string"
_JOINTS = "row long, k long, last boolean, doc_id long, n_bytes long, begin long, starts long, ends long, n_tokens long"


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "boolean": pa.bool_(), "string": pa.string()}
    names, types = zip(*(f.split() for f in schema.split(", ")), strict=True)
    cols = zip(*rows, strict=True) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[t]) for c, t in zip(cols, types, strict=True)], list(names))


def token_counts(docs: DataFrame, vocabulary_path: str, limit: int = LIMIT, stretch: int = STRETCH, overlap: int = OVERLAP, narrow: int = NARROW) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), a row for each of docs (doc_id, text)."""
    if not 0 < narrow <= overlap <= stretch:
        raise ValueError("an overlap lies within a stretch")
    docs = small_batches(docs).select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    huge = F.coalesce(F.length("text"), F.lit(0)) > stretch

    def whole(batches):
        count = resynchroniser(vocabulary_path).count
        for ids, texts in text_chunks(batches, operator="counts"):
            yield _batch([(i, len(t.encode()), count(t)) for i, t in zip(ids, texts, strict=True)], _COUNTED)

    def cut(batches):
        row = TaskContext.get().partitionId() << 40
        for ids, texts in text_chunks(batches, operator="counts"):
            for i, t in zip(ids, texts, strict=True):
                row, n, size = row + 1, len(t.encode()), len(t)
                for k, at in enumerate(range(0, size, stretch)):
                    yield _batch([(row, k, at + stretch >= size, i, n, at, t[at : at + stretch + overlap])], _CUT)

    def encoded(batches):
        tool = resynchroniser(vocabulary_path)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                last, core = r["last"], len(r["text"]) if r["last"] else r["core"]
                begin, end, n = tool.spliced(r["text"], not r["k"], last, core, overlap, narrow)
                rows.append((r["row"], r["k"], last, r["doc_id"], r["n_bytes"], r["begin"], *(p + r["begin"] if p >= 0 else None for p in (begin, end)), n))
            yield _batch(rows, _JOINTS)

    in_document = Window.partitionBy("row").orderBy("k")  # as many rows as a document has stretches
    # written once, so that rows keep their numbers; dealt anew, as one file may hold all long documents
    cuts = materialize(docs.where(huge).mapInArrow(cut, _CUT))
    spread = lambda df: df.repartition("row", "k").mapInArrow(encoded, _JOINTS)
    joints = materialize(spread(cuts.withColumn("core", F.lit(stretch))))
    parted = F.lag("ends").over(in_document) == F.col("starts")
    joints = joints.withColumn("span", F.sum(F.when(parted, 1).otherwise(F.when(F.col("k") == 0, 1).otherwise(0))).over(in_document))
    joints = joints.withColumn("again", F.count("*").over(Window.partitionBy("row", "span")) > 1)
    one = joints.where(~F.col("again")).select("row", "doc_id", "n_bytes", "n_tokens")
    item = F.struct("k", "last", "begin", "text")
    glued = joints.where("again").select("row", "k", "span").join(cuts, ["row", "k"]).groupBy("row", "span", "doc_id", "n_bytes").agg(F.array_sort(F.collect_list(item)).alias("parts"))
    end = F.element_at("parts", -1)
    cores = F.transform(F.slice("parts", 1, F.size("parts") - 1), lambda p: F.substring(p["text"], 1, stretch))
    glued = glued.select("row", F.col("parts")[0]["k"].alias("k"), end["last"].alias("last"), "doc_id", "n_bytes", F.col("parts")[0]["begin"].alias("begin"), F.concat(F.array_join(cores, ""), end["text"]).alias("text"), (F.size("parts") * stretch).alias("core"))
    more = spread(glued).select("row", "doc_id", "n_bytes", "n_tokens")
    long = one.unionByName(more).groupBy("row", "doc_id", "n_bytes").agg(F.sum("n_tokens").alias("n_tokens")).drop("row")
    out = docs.where(~huge).mapInArrow(whole, _COUNTED).unionByName(long)
    return out.withColumn("over_limit", F.col("n_tokens") > limit)


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary(VOCABULARY))
