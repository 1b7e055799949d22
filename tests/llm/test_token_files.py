import random
import struct
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from matchloom.llm import range_coder, token_files
from matchloom.llm.store import new_path
from matchloom.llm.token_files import read_tokens, write_tokens

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_coder_round_trip_and_damage():
    rng = np.random.default_rng(1)
    blocks = [rng.integers(0, 65536, n) for n in (0, 1, 2, 300)] + [np.full(1500, 7), np.arange(400), rng.zipf(1.3, 800) % 50257]
    codes = range_coder.encode(blocks)
    assert [x.tolist() for x in range_coder.decode(codes)] == [x.tolist() for x in blocks]
    assert range_coder.decode([codes[4]])[0].tolist() == blocks[4].tolist()  # a block stands alone
    assert len(codes[4]) < 60
    for at in (5, 20):
        broken = bytearray(codes[3])
        broken[at] ^= 1
        with pytest.raises(ValueError):
            range_coder.decode([bytes(broken)])


@pytest.mark.parametrize("top", [100_000, 1 << 20, 1 << 22, (1 << 32) - 1])
def test_ids_of_large_vocabularies(top):
    rng = np.random.default_rng(2)
    blocks = [rng.integers(0, top, 300, dtype=np.uint64), np.array([top, 0, top, 0, top, 5]), np.arange(70), np.minimum(rng.zipf(1.2, 500), top), np.empty(0, int)]
    codes = range_coder.encode(blocks)
    assert [x.tolist() for x in range_coder.decode(codes + range_coder.encode([blocks[2]]))] == [x.tolist() for x in [*blocks, blocks[2]]]


def test_joined_checksums():
    rng = random.Random(4)
    for n in (0, 1, 4, 100, 4096):
        a, b = rng.randbytes(rng.randrange(50)), rng.randbytes(n)
        assert range_coder.joined_crc(zlib.crc32(a), zlib.crc32(b), n) == zlib.crc32(a + b)


def test_files_match_library(spark, monkeypatch):
    rng = random.Random(3)
    rows = [(k, " ".join(rng.choice(["alpha", "beta", "gamma", "<|endoftext|>", "é"]) for _ in range(rng.choice([1, 40, 700])))) for k in range(120)]
    rows += [(500, None), (501, ""), (None, "no id"), (7, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as part", "2 as id").repartition(5)
    library, want, before = Tokenizer.from_file(PATH), [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        want.append((i, before, len(ids), zlib.crc32(struct.pack(f"<{len(ids)}I", *ids))))
        before += len(ids)
    monkeypatch.setattr(token_files, "BLOCK", 200)
    path = new_path(spark, "tokens")
    write_tokens(docs, path, PATH)
    assert sorted((tuple(r) for r in read_tokens(spark, path).collect()), key=lambda r: r[1]) == want


def test_empty_table(spark):
    path = new_path(spark, "tokens")
    write_tokens(spark.createDataFrame([], "doc_id long, text string"), path, PATH)
    assert read_tokens(spark, path).count() == 0
