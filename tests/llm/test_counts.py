"""Token counts against the library's own, whole text by whole text."""

import random

import numpy as np
import pytest

from strandline.llm.counts import VOCABULARY, resynchroniser, token_counts
from strandline.llm.tokens import vocabulary


@pytest.fixture(scope="module")
def tool():
    return resynchroniser(vocabulary(VOCABULARY))


def _mixed(rng, n):
    parts = ["the ", "word", "  ", "\n", "x" * 9, "中文", "é", "ß", "▁", "🙂", "<s>", "</s>", "<0x41>", "1234", ".", "\t", "ing", "\x00", "אב", "=" * 5]
    return "".join(rng.choice(parts) for _ in range(n))


def test_no_merge_crosses_a_stable_place(tool):
    rng = random.Random(1)
    for _ in range(60):
        text = _mixed(rng, 120)
        places = tool.stable(text, np.arange(1, len(text)))
        assert len(places)
        starts = set(tool.starts(text).tolist())
        assert set(places.tolist()) <= starts
        for p in places[:: max(1, len(places) // 8)].tolist():
            right = tool.starts(text[p - 1 :])  # a character before it, as the library marks the begin of a text
            assert tool.count(text) == int(np.searchsorted(tool.starts(text[: p + 1]), p)) + len(right) - int(np.searchsorted(right, 1))


def test_offsets_are_the_librarys(tool):
    text = "Hello  wörld\n中文🙂 end"
    starts = tool.starts(text).tolist()
    assert len(starts) == tool.count(text) and starts[0] == -1 and starts == sorted(starts)
    assert starts.count(text.index("🙂")) in (1, 4)  # one piece, or a byte each


@pytest.mark.parametrize("stretch, overlap, narrow", [(64, 16, 2), (64, 64, 8), (256, 32, 32), (1 << 15, 4096, 256)])
def test_counts_equal_those_of_whole_texts(spark, tool, stretch, overlap, narrow):
    rng = random.Random(2)
    texts = [_mixed(rng, rng.randrange(1, 400)) for _ in range(40)]
    texts += ["x" * 5000, "y" * 64 + " " + "x" * 700 + " tail", " " * 1000, "中" * 999, "ab" * 40_000, None, "", " "]
    rows = [(i, t) for i, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r for r in token_counts(docs, vocabulary(VOCABULARY), 100, stretch, overlap, narrow).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        n = tool.count(t or "")
        assert tuple(got[i]) == (i, len((t or "").encode()), n, n > 100), (i, t and t[:40])


def test_any_table(spark, tool, documents):
    rows = documents.select("doc_id", "text").collect()
    got = token_counts(documents, vocabulary(VOCABULARY), stretch=1000, overlap=100, narrow=10)
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = sorted(((r["doc_id"] if r["doc_id"] is not None else -1), len((r["text"] or "").encode()), tool.count(r["text"] or "")) for r in rows)
    assert sorted(((r["doc_id"] if r["doc_id"] is not None else -1), r["n_bytes"], r["n_tokens"]) for r in got.collect()) == want
    assert not token_counts(documents.limit(0), vocabulary(VOCABULARY)).collect()


def test_repeated_long_rows_are_counted_each(spark, tool):
    docs = spark.createDataFrame([(7, "long text " * 200)] * 30 + [(None, "long text " * 200)] * 20, "doc_id long, text string").repartition(4)
    rows = token_counts(docs, vocabulary(VOCABULARY), stretch=100, overlap=30, narrow=10).collect()
    n = tool.count("long text " * 200)
    assert len(rows) == 50 and {r["n_tokens"] for r in rows} == {n} and sum(r["doc_id"] is None for r in rows) == 20
