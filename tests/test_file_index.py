"""Places of references in files: indexed, fetched by ranges, sorted by length."""

import random

import pytest
from pyspark.sql import functions as F

from strandline.sources import file_index as FI
from strandline.sources import records as RC


@pytest.fixture(scope="module")
def references():
    rng = random.Random(13)
    out = []
    for k in range(120):
        seq = "".join(rng.choice("ACGT") for _ in range(rng.randrange(0 if k % 40 == 0 else 1, 400)))
        items = [f"A{k}.1 , name {k}", f"B{k}.2", f"C{k}.1 other, {k} "][: 1 + k % 3]
        out.append((items, seq))
    return out


@pytest.fixture(scope="module")
def path(references, tmp_path_factory):
    file = tmp_path_factory.mktemp("refs") / "nt.fa"
    text = ""
    for k, (items, seq) in enumerate(references):
        end = "\r\n" if k % 5 == 0 else "\n"
        text += ">" + "\x01".join(items) + end + "".join(seq[i : i + 70] + end for i in range(0, len(seq), 70))
    file.write_bytes(text.encode())
    return str(file)


def test_index_has_each_item_of_each_header(spark, references, path):
    data = open(path, "rb").read()
    for split in (200, 1 << 20):
        rows = FI.indexed(spark, path, split).collect()
        want = {(i.split(" ")[0], n, len(seq)) for items, seq in references if seq for n, i in enumerate(items)}
        assert {(r["accession"], r["nth"], r["bases"]) for r in rows} == want and len(rows) == len(want)
        for r in rows:
            record = data[r["start"] : r["start"] + r["header_bytes"] + r["body_bytes"]]
            assert record[:1] == b">" and r["accession"].encode() in record[: r["header_bytes"]] and record.count(b">") == 1
            assert (data + b">")[r["start"] + len(record)] == ord(">")
    assert {r["name"] for r in rows if r["accession"] == "C5.1"} == {"other, 5"}


@pytest.mark.parametrize("gap", [0, 1 << 20])
def test_fetched_references_are_a_semi_join_and_bytes_are_bounded(spark, references, path, gap):
    wanted = spark.createDataFrame([(f"{c}{k}.{n}",) for k in range(0, 120, 9) for c, n in (("A", 1), ("C", 1))] + [("none",), (None,)], "accession string")
    index = FI.indexed(spark, path, 1000)
    rows = FI.fetched(index, wanted.unionByName(wanted), gap=gap).collect()
    want = {i.split(" ")[0]: (items, seq) for items, seq in references if seq for i in items}
    asked = {r["accession"] for r in wanted.collect()} & set(want)
    assert {r["accession"]: r["seq"] for r in rows} == {a: want[a][1] for a in asked} and len(rows) == len(asked)
    assert all(r["header"] == "\x01".join(i.replace(" , ", " ") for i in want[r["accession"]][0]) for r in rows)
    needed = index.join(wanted.distinct(), "accession", "left_semi").groupBy("start").agg(F.max(F.col("header_bytes") + F.col("body_bytes")).alias("n")).agg(F.sum("n")).first()[0]
    read = sum(r["bytes_read"] for r in rows)
    assert read == needed if gap == 0 else needed <= read <= len(open(path, "rb").read())
    assert not FI.fetched(index, wanted, max_bytes=3).collect()


def test_ranges_of_a_file(spark, path):
    index = sorted({(r["start"], r["header_bytes"] + r["body_bytes"]) for r in FI.indexed(spark, path).collect()})
    (a, _), (b, n) = index[10], index[20]
    last = b + n - 1
    got = RC.records_in_ranges(spark, path, [(a, last), (index[40][0], index[40][0])], split=500).collect()
    assert sorted(r["start"] for r in got) == [s for s, _ in index if a <= s <= last] + [index[40][0]]


@pytest.mark.parametrize("part_bytes", [300, 5000, 1 << 20])
def test_places_are_those_of_the_sorted_files(spark, tmp_path, part_bytes):
    rng = random.Random(part_bytes)
    rows = [(rng.choice([1, 1, 2]), k, f"r{k} " + "x" * rng.randrange(9), "A" * rng.choice([0, 5, 5, 5, 5, 30, rng.randrange(90)])) for k in range(300)]
    frame = spark.createDataFrame(rows, "taxid int, ord long, header string, seq string").repartition(3)
    placed = FI.placed_by_length(frame, "taxid", "ord", part_bytes)
    want = {}
    for g in (1, 2):
        at = 0
        for _, k, h, s in sorted((r for r in rows if r[0] == g), key=lambda r: (-len(r[3]), r[1])):
            want[k] = at
            at += len(h) + len(s) + 3
    got = placed.collect()
    assert {r["ord"]: r["offset"] for r in got} == want
    sizes = {}
    for r in got:
        sizes.setdefault((r["taxid"], r["part"]), []).append(len(r["header"]) + len(r["seq"]) + 3)
    assert max(map(sum, sizes.values())) <= 2 * part_bytes + 200
    FI.write_by_length(placed, str(tmp_path / "out"), "taxid")
    for g in (1, 2):
        files = sorted((tmp_path / "out" / f"taxid={g}").glob("first_byte=*/part-*"), key=lambda f: f.parent.name)
        data = b""
        for f in files:
            assert int(f.parent.name.split("=")[1]) == len(data)
            data += f.read_bytes()
        for t, k, h, s in rows:
            if t == g:
                assert data[want[k] :].startswith(f">{h}\n{s}\n".encode())
