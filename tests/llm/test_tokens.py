import hashlib
import random
import struct
import zlib

import public_tokenizers
from tokenizers import Tokenizer

from matchloom.llm import trie_bpe
from matchloom.llm.token_cache import new_cache, token_counts
from matchloom.llm.trie_bpe import decoded, encoded, round_trip

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)


def texts():
    rng = random.Random(5)
    pool = [chr(c) for c in range(0x300)] + list("abcd  \n\t'") * 30 + ["'s", "'ll", " 't", "<|endoftext|>", "日", "　", "😀", "́", "Ⅷ"]
    out = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 40))) for _ in range(400)]
    return [*out, None, "", " ", "   ", "it's", "x" * 5000, "word " * 3000, out[0], out[0]]


def test_round_trip_matches_library(spark):
    rows = list(enumerate(texts()))
    got = {r["id"]: r for r in round_trip(spark.createDataFrame(rows, "doc_id long, text string"), PATH).collect()}
    for i, text in rows:
        ids = LIBRARY.encode(text or "", add_special_tokens=False).ids
        raw = struct.pack(f"<{len(ids)}I", *ids)
        back = LIBRARY.decode(ids, skip_special_tokens=False)
        assert tuple(got[i])[1:] == (len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest(), zlib.crc32(raw)), text


def test_encode_decode_tables(spark):
    rows = list(enumerate(texts()))
    back = decoded(encoded(spark.createDataFrame(rows, "doc_id long, text string"), PATH), PATH).collect()
    assert sorted((r["id"], r["text"]) for r in back) == sorted((i, t or "") for i, t in rows)


def test_counts_and_cache(spark):
    rows = [*enumerate(texts()), (None, "abc"), (3, "abc")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    cache = new_cache(spark)
    want = sorted((str(i), len((t or "").encode()), n := len(LIBRARY.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t in rows)
    for _ in range(2):
        assert sorted((str(r[0]), *r[1:]) for r in token_counts(docs, PATH, cache).collect()) == want
        assert spark.read.parquet(cache).count() == len({t or "" for _, t in rows})


def test_memory_stays_bounded_and_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(trie_bpe, "KNOWN_BYTES", 3000)
    monkeypatch.setattr(trie_bpe, "SEEN", 64)
    monkeypatch.setattr(trie_bpe, "FITS", 50)
    monkeypatch.setattr(trie_bpe, "BATCH_WORDS", 100)
    codec = trie_bpe.Codec(PATH)
    for text in 3 * [t for t in texts() if t]:
        assert codec.encode([text]) == [struct.pack(f"<{len(ids := LIBRARY.encode(text, add_special_tokens=False).ids)}I", *ids)]
        assert codec.n_bytes <= 3000 and codec.n_seen <= 32
    codec.forget()
    assert not codec.known


def test_very_long_word(spark):
    """A word's cost is linear in its length."""
    word = "".join(random.Random(1).choice("abcdefghij") for _ in range(300_000))
    got = round_trip(spark.createDataFrame([(1, word)], "doc_id long, text string"), PATH).first()
    assert got["decoded_sha256"] == hashlib.sha256(word.encode()).hexdigest()
    assert got["n_tokens"] == len(LIBRARY.encode(word, add_special_tokens=False).ids)


def test_empty_table(spark):
    none = spark.createDataFrame([], "doc_id long, text string, id int, body int")
    assert round_trip(none, PATH).count() == token_counts(none, PATH).count() == 0


def test_each_distinct_content_is_encoded_once(spark):
    from matchloom.llm.queries import tokenizer_file
    from matchloom.llm.token_cache import fill, new_cache

    rows = [(None, "a text without an id")] * 50 + [(1, "another text")] * 3 + [(k, "another text") for k in range(4)] + [(None, None)] * 5
    cache = new_cache(spark)
    for _ in range(2):
        fill(spark.createDataFrame(rows, "doc_id long, text string").repartition(6), tokenizer_file(), cache)
        assert spark.read.parquet(cache).count() == 3
