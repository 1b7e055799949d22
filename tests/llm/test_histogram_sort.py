import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from matchloom.llm import histogram_sort
from matchloom.llm.histogram_sort import cell_of, keyed, sharded, write_shards
from matchloom.llm.queries import queries


def make(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, size string, __key int")


def test_shards_are_even_and_gapless(spark, tmp_path):
    rows = [(k, f"copied text {k % 7} " * 20 if k % 3 == 0 else f"{k} " * (k % 97), "x", 1) for k in range(3000)]
    rows += [(None, None, None, None), (5, "a"), (5, "a"), (9000, "")]
    rows = [(*r, None, None)[:4] for r in rows]
    got = sharded(make(spark, rows)).collect()
    assert sorted((str(r["id"]), r["body"]) for r in got) == sorted((str(r[0]), r[1] or "") for r in rows)
    assert all(r["size"] == len(r["body"].encode()) + 1 for r in got)
    total = sum(r["size"] for r in got)
    for shard in range(8):
        mine = [r for r in got if r["shard"] == shard]
        assert sorted(r["slot"] for r in mine) == list(range(len(mine)))
        assert abs(sum(r["size"] for r in mine) - total / 8) < 600 + total / 8 * 0.02
    write_shards(make(spark, rows), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)


@pytest.mark.parametrize("copies", [1, 6])
def test_whole_result_matches_brute_force(spark, monkeypatch, copies):
    """The query against a plain version: rows in the order of their keys, borders by exact
    bytes, places by counting."""
    monkeypatch.setattr(histogram_sort, "GROUP_SLACK", 0.05)
    rng = random.Random(4)
    texts = [" ".join(rng.choice(["alpha", "é", "b"]) for _ in range(rng.randrange(60))) for _ in range(600)]
    rows = [(k * copies + c, t, None, None) for k, t in enumerate(texts) for c in range(copies)] + [(None, None, None, None), (70_000, None, None, None)]
    docs = make(spark, rows)
    order = sorted(((r["__key"], r["id"], r["size"], r["body"]) for r in keyed(docs, "doc_id", "text").collect()), key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2], r[3]))
    total = sum(r[2] for r in order)
    got = {(r["id"], r["body"]): r for r in sharded(docs).collect()}
    shard_of = [got[i, body]["shard"] for _, i, _, body in order]
    assert shard_of == sorted(shard_of)  # shards are runs of the order
    places = defaultdict(int)
    for (_, i, _, body), shard in zip(order, shard_of, strict=True):
        assert got[i, body]["slot"] == places[shard]
        places[shard] += 1
    largest = max(r[2] for r in order)
    for shard in range(1, 8):
        cut = shard_of.index(shard)
        before, target = sum(r[2] for r in order[:cut]), total * shard / 8
        group = [r for r in order if r[0] >> 24 == order[cut][0] >> 24]
        assert abs(before - target) <= max(total / 8 * 0.001, largest) + total / 8 * 0.05
        if order[cut - 1][0] >> 24 == order[cut][0] >> 24:  # a group is cut
            edge = sum(r[2] for r in order if r[0] >> 24 < order[cut][0] >> 24)
            assert min(abs(edge - target), abs(edge + sum(r[2] for r in group) - target)) > total / 8 * 0.05


def test_cells_are_found_as_by_counting(spark):
    rng = random.Random(5)
    for n in (0, 1, 2, 7, 40):
        keys = sorted(rng.randrange(1 << 63) for _ in range(n))
        probes = [0, (1 << 63) - 1, *keys, *(k - 1 for k in keys), *(rng.randrange(1 << 63) for _ in range(20))]
        df = spark.createDataFrame([(p,) for p in probes], "p long").withColumn("cell", cell_of(F.col("p"), keys))
        assert all(r["cell"] == sum(k <= r["p"] for k in keys) for r in df.collect())


def test_query_columns(spark):
    rows = queries()["op6_histogram_shards"](spark, "/root/testdata/sf0.001").collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()}
    assert len(rows) == len(docs)
    for r in rows:
        raw = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)


def test_small_tables(spark):
    assert sharded(make(spark, [])).count() == 0
    one = sharded(make(spark, [(1, "abc", None, None)])).collect()
    assert len(one) == 1 and one[0]["slot"] == 0
    copies = sharded(make(spark, [(1, "abc", None, None)] * 50)).collect()
    assert len(copies) == 50 and len({(r["shard"], r["slot"]) for r in copies}) == 50
