import random
import re
from collections import Counter

import pyarrow as pa
import pytest

from matchloom.llm import collocations as C


def plain(rows, min_count=10, top=2000):
    f, n, words_of = {}, Counter(), {}
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", low):
            w = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(w)
            for size in (1, 2, 3):
                f.setdefault(lang, Counter()).update(tuple(w[k : k + size]) for k in range(len(w) - size + 1))
    out = []
    for lang, counts in f.items():
        found = {p: a for p, a in counts.items() if len(p) > 1 and a >= min_count}
        lines = []
        for p, a in found.items():
            score, _, left, right = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            if not any(len(q) > len(p) and any(q[k : k + len(p)] == p for k in range(len(q))) and 100 * b >= 50 * a for q, b in found.items()):
                lines.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, p, left, right) in enumerate(sorted(lines)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, n[lang], -score))
    return sorted(out)


def corpus(seed, docs, lines):
    rng = random.Random(seed)
    words = ["new", "york", "city", "of", "the", "été", "São", "über", "a", "x1", " nb", "NEW"] + [f"w{k}" for k in range(60)]
    fixed = ["New York City", "of the", "São  Paulo\tstate", "the of the", "one two three"]
    rows = []
    for k in range(docs):
        text = ""
        for _ in range(rng.randrange(lines)):
            text += rng.choice(fixed) if rng.random() < 0.4 else rng.choices(words, weights=[12 / (j + 1) for j in range(len(words))])[0]
            text += rng.choice([" ", " ", "  ", "\t", ". ", ", ", "\n", "! ", "; ", "\x0b"])
        rows.append((rng.choice([k, k, None]), text, rng.choice(["en", "en", "en", "pt", None, ""])))
    return rows


@pytest.mark.parametrize("chunk", [7, 60, 700, 1 << 22])
def test_texts_cut_anywhere_have_the_same_phrases(monkeypatch, chunk):
    rows = [((lang or "und"), k % 2, text) for k, (_, text, lang) in enumerate(corpus(5, 60, 90))]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[k : k + 25])], names=["lang", "shard", "body"]) for k in range(0, 60, 25)]

    def all_phrases():
        found = Counter()
        for size in (1, 2, 3):
            for lang, shard, phrases in C._by_cell(batches, size - 1):
                at, keys = phrases.keys(size)
                found.update((lang, shard, text, key) for text, key in zip(phrases.texts(at, size).to_pylist(), keys.tolist()))
        return found

    want = all_phrases()
    monkeypatch.setattr(C, "CHUNK", chunk)
    monkeypatch.setattr(C, "HELD", 4 * chunk)
    assert all_phrases() == want and len({k for *_, k in want}) == len({(x, t) for x, _, t, _ in want})


@pytest.mark.parametrize("seed", [1, 2])
def test_whole_result_matches_brute_force(spark, seed):
    rows = corpus(seed, 120, 90)
    rows += [(900, None, "en"), (901, "", "fr"), (902, " .,\n", "fr"), rows[0], rows[0], (903, "long tale " * 500_000 + "tail", "xx")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as key", "2 as shard", "3 as `a.b`", "4 as n")
    got = sorted(map(tuple, C.collocations(docs).collect()))
    assert got == plain(rows) and len(got) > 40
    few = sorted(map(tuple, C.collocations(docs, top=5).collect()))
    assert few == plain(rows, top=5)


def test_small_and_empty_tables(spark):
    schema = "doc_id long, text string, lang string"
    assert C.collocations(spark.createDataFrame([], schema)).count() == 0
    one = [(1, "a b " * 10, "en")]  # a single text lies in one shard
    assert sorted(map(tuple, C.collocations(spark.createDataFrame(one, schema)).collect())) == plain(one)


def test_large_counts_stay_exact(spark):
    n = 999_999_999_999_989
    counts = spark.createDataFrame([("en", 1, "p", n), ("en", 1, "q", n - 2), ("en", 2, "p q", n - 4)], "lang string, size int, phrase string, f long")
    assert [tuple(r) for r in C.scored(counts, 50).collect()] == [("en", "p q", n - 4, n, n - 2, 10**6 * (n - 4) ** 2 // (n * (n - 2)))]
