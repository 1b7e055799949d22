"""Texts longer than the pieces that are worked on at once, against plain versions."""

import hashlib
import random
import re
import struct
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from matchloom.llm.decontaminate import clean, contained
from matchloom.llm.histogram_sort import sharded
from matchloom.llm.log_templates import without_templates
from matchloom.llm.near_dup import keep_one, linked
from matchloom.llm.quality_rules import counts_of
from matchloom.llm.repeats import without_repeats
from matchloom.llm.simhash import linked as simhash_linked
from matchloom.llm.store import new_path
from matchloom.llm.token_cache import new_cache, token_counts
from matchloom.llm.token_files import read_tokens, write_tokens
from matchloom.llm.trie_bpe import round_trip
from matchloom.llm.words import PIECE, word_hashes

PATH = public_tokenizers.path("byte_bpe_50k.json")
ITEM = "the planted item is a question of twelve words across a border"


def make():
    """Two near copies and one other text of over a piece each, an item across the first's
    border, and short texts."""
    rng = random.Random(6)
    word = lambda: f"w{rng.randrange(90_000)}é"
    base = []
    size = 0
    while size < PIECE + 60_000:
        base.append(word())
        size += len(base[-1].encode()) + 1
    at = size = 0
    while size < PIECE - 20:  # the item is put where a piece ends
        size += len(base[at].encode()) + 1
        at += 1
    one = base[:at] + ITEM.split() + base[at:]
    near = [word() if rng.random() < 0.02 else w for w in base]
    other = [word() for _ in base]
    join = lambda words: "".join(w + ("\n" if k % 40 == 39 else " ") for k, w in enumerate(words))
    return [(1, join(one)), (2, join(near)), (3, join(other)), (4, "short text"), (5, ""), (6, None)]


@pytest.fixture(scope="module")
def rows():
    return make()


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string").repartition(3)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, n):
    w = words((text or "").lower())
    return {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()


def test_words_across_pieces_have_the_hashes_they_have_alone():
    rng = random.Random(1)
    some = ["x" * rng.choice([1, 3, 400]) + str(k % 900) for k in range(6000)] + ["y" * (2 * PIECE + 5), "z"] + ["é" * 700_000]
    for gap in (" ", "\n" * 300, " \t"):
        text = (gap.join(some) + gap).encode()
        assert len(text) > 3 * PIECE
        alone = {w: h[0] for w, (_, h) in zip(dict.fromkeys(some), word_hashes([w.encode() for w in dict.fromkeys(some)]), strict=True)}
        for texts in ([text], [b"a", text, b"b"]):
            got = [h for _, h in word_hashes(texts)][len(texts) // 2]
            assert (got == np.array([alone[w] for w in some])).all()


def test_near_duplicates(docs, rows):
    sets = {i: shingles(t, 4) for i, t in rows}
    assert 100 * len(sets[1] & sets[2]) >= 80 * len(sets[1] | sets[2])
    got = {r["id"]: (r["n_shingles"], r["component_id"]) for r in linked(docs, n=4).collect()}
    assert got == {i: (len(s), 1 if i == 2 else i) for i, s in sets.items()}
    assert {r["doc_id"] for r in keep_one(docs).collect()} == {1, 3, 4, 5, 6}


def test_fingerprints_of_near_copies_link(docs):
    got = {r["id"]: r["component_id"] for r in simhash_linked(docs).collect()}
    assert got[5] == got[6] == 5 and got[3] == 3 and got[4] == 4


def test_item_across_the_border_is_found(spark, docs, rows):
    item = spark.createDataFrame([(9, ITEM)], "item_id long, text string")
    assert [r["id"] for r in contained(docs, item).collect()] == [1]
    assert {r["doc_id"] for r in clean(docs, item).collect()} == {2, 3, 4, 5, 6}


def test_counts_of_words_and_lines(rows):
    got = counts_of([None if t is None else t.encode() for _, t in rows]).tolist()
    for (_, text), counts in zip(rows, got, strict=True):
        w, lines = words(text), [x for x in (text or "").split("\n") if words(x)]
        windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        times = Counter(windows)
        hit = {k + j for k, x in enumerate(windows) if times[x] > 1 for j in range(3)}
        assert counts[:5] == [len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text or ""), len(lines) - len(set(lines)), len(hit)]


def test_tokens(spark, docs, rows):
    library, before = Tokenizer.from_file(PATH), 0
    coded = {r["id"]: (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in round_trip(docs, PATH).collect()}
    counted = {r["id"]: r["n_tokens"] for r in token_counts(docs, PATH, new_cache(spark)).collect()}
    path = new_path(spark, "tokens")
    write_tokens(docs, path, PATH)
    filed = {r["id"]: (r["start"], r["n_tokens"], r["ids_crc32"]) for r in read_tokens(spark, path).collect()}
    for i, text in rows:
        ids = library.encode(text or "", add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert coded[i] == (len(ids), hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
        assert counted[i] == len(ids)
        assert filed[i] == (before, len(ids) + 1, zlib.crc32(struct.pack(f"<{len(ids) + 1}I", *ids, 0)))
        before += len(ids) + 1


def test_shards(docs, rows):
    got = {r["id"]: r for r in sharded(docs, shards=2).collect()}
    assert {i: r["size"] for i, r in got.items()} == {i: len((t or "").encode()) + 1 for i, t in rows}
    assert all(got[i]["body"] == (t or "") for i, t in rows)
    for shard in (0, 1):
        mine = sorted(r["slot"] for r in got.values() if r["shard"] == shard)
        assert mine == list(range(len(mine)))


def test_repeats_across_pieces(docs, rows):
    length = 200
    raw = {i: (t or "").encode() for i, t in rows}
    times = Counter(hash(b[k : k + length]) for b in raw.values() for k in range(len(b) - length + 1))
    got = {r["doc_id"]: r for r in without_repeats(docs, length).collect()}
    assert got[1]["n_removed"] > 1000
    for i, b in raw.items():
        gone = np.zeros(len(b) + 1, np.int32)
        starts = np.array([k for k in range(len(b) - length + 1) if times[hash(b[k : k + length])] > 1], np.int64)
        np.add.at(gone, starts, 1)
        np.add.at(gone, starts + length, -1)
        covered = np.cumsum(gone[:-1]) > 0
        spans = int((np.diff(covered.astype(np.int8), prepend=0) == 1).sum())
        kept = np.frombuffer(b, np.uint8)[~covered].tobytes()
        assert (got[i]["n_bytes"], got[i]["n_removed"], got[i]["n_spans"]) == (len(b), int(covered.sum()), spans)
        assert bytes(got[i]["kept"]) == kept


def test_one_line_longer_than_a_piece(spark):
    long = "q" * (PIECE + 7)
    common = "this line of many words comes in every one of them"
    data = [(k, f"{common}\nown{k} line {long}{k}\n{long} {long}") for k in range(4)]
    got = {r["doc_id"]: r["text"] for r in without_templates(spark.createDataFrame(data, "doc_id long, text string")).collect()}
    assert got[0] == data[0][1]
    for k in range(1, 4):
        assert common not in got[k] and f"{long}{k}" in got[k]
