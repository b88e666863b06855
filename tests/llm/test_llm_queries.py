"""Every query of the operators over the smallest tables: against its SQL, or a row for each row of its table."""

import hashlib
import re
import zlib

import numpy as np
import pytest
from compare import connection, rows_of_spark, rows_of_sql

from strandline.llm import queries
from strandline.llm.tokens import encoder, vocabulary

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_sql(spark, name):
    assert rows_of_spark(queries.QUERIES[name](spark, SF)) == rows_of_sql(connection(SF), queries.ORACLES[name])


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", ["op2_secret_scan", "op5_quality", "op9_pii", "op10_lm_scores"])
def test_query_has_a_row_per_document(spark, texts, name):
    rows = queries.QUERIES[name](spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(texts)
    if name == "op2_secret_scan":
        for r in rows:
            found = [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", texts[r["doc_id"]]) if m.end() - m.start() >= 24]
            assert r["n_hex"] == len(found)
    if name == "op9_pii":
        for r in rows:
            mails = re.findall(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", texts[r["doc_id"]])
            assert r["n_email"] == len(mails) and (r["spans"] or r["base_sha256"] == hashlib.sha256(b"").hexdigest())
    if name == "op5_quality":
        assert all(0 <= r["score"] <= 1 and r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    if name == "op10_lm_scores":
        assert all(r["score"] < 0 and r["n_tokens"] == len(texts[r["doc_id"]].encode().lower().split()) + 1 for r in rows)


def test_token_queries(spark, texts):
    e, end = encoder(vocabulary()), {k: np.array([k], "<u4").tobytes() for k in (1, 2)}
    start = 0
    for r in sorted(queries.QUERIES["op3_token_files"](spark, SF).collect(), key=lambda r: r["doc_id"]):
        ids = e.encoded(texts[r["doc_id"]]) + end[1]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (start, len(ids) // 4, zlib.crc32(ids))
        start += len(ids) // 4
    pieces = queries.QUERIES["op6_pack"](spark, SF).collect()
    for i, text in texts.items():
        ids, at = e.encoded(text) + end[2], 0
        for r in sorted((r for r in pieces if r["doc_id"] == i), key=lambda r: r["start"]):
            assert r["start"] == at and r["ids_crc32"] == zlib.crc32(ids[4 * at : 4 * (at + r["length"])])
            at += r["length"]
        assert 4 * at == len(ids)


def test_language_query(spark):
    pages = {r["page_id"]: r for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    rows = queries.QUERIES["op7_language_id"](spark, SF).collect()
    assert sorted(r["page_id"] for r in rows) == sorted(pages) and all(0 < r["confidence"] <= 1 for r in rows)


def test_token_counts_query(spark, texts):
    from sentencepiece import SentencePieceProcessor

    encode = SentencePieceProcessor(model_file=vocabulary("piece_bpe_32k.model")).encode
    rows = queries.QUERIES["op13_token_counts"](spark, SF).collect()
    assert sorted(tuple(r) for r in rows) == sorted((i, len(t.encode()), n, n > 4096) for i, t in texts.items() for n in [len(encode(t))])
