import random
from collections import Counter

import numpy as np

import matchloom.llm.repeats as repeats
from matchloom.llm.repeats import repeated_starts, without_repeats


def brute(texts, length):
    seen = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t) + 1, bool)
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                gone[k : k + length] = True
        spans = int((np.diff(gone[:-1].astype(int), prepend=0) == 1).sum())
        out.append((len(t), int(gone.sum()), spans, bytes(b for b, g in zip(t, gone, strict=False) if not g)))
    return out


def make(rng, n, alphabet="abcdefgh é"):
    text = lambda m: "".join(rng.choice(alphabet) for _ in range(m))
    shared = [text(rng.choice([150, 199, 200, 201, 260, 700])) for _ in range(12)]
    out = []
    for _ in range(n):
        t = text(rng.choice([0, 50, 300, 1500]))
        for _ in range(rng.choice([0, 1, 2])):
            s = list(rng.choice(shared))
            for _ in range(rng.choice([0, 0, 0, 1, 3])):
                s[rng.randrange(len(s))] = "X"
            at = rng.randrange(len(t) + 1)
            t = t[:at] + "".join(s) + t[at:]
        out.append(t)
    return out + [out[3], out[3], "ab" * 300, "z" * 500, "z" * 199, "y" * 201, text(400) * 2]


def test_transform_matches_brute_force():
    rng = random.Random(6)
    for length in (3, 8, 20):
        for _ in range(30):
            texts = list({"".join(rng.choice("ab") for _ in range(rng.randrange(60))).encode() for _ in range(rng.randrange(1, 12))})
            seen = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
            want = [[k for k in range(len(t) - length + 1) if seen[t[k : k + length]] > 1] for t in texts]
            assert [x.tolist() for x in repeated_starts(texts, length)] == want


def test_removal_matches_brute_force(spark, monkeypatch):
    for hot, piece in ((20_000, 1 << 20), (1, 1 << 20), (20_000, 900)):
        monkeypatch.setattr(repeats, "HOT", hot)
        monkeypatch.setattr(repeats, "PIECE", piece)
        texts = [None, *make(random.Random(7), 120)]
        rows = [(k if k % 9 else None, t, k) for k, t in enumerate(texts)]
        docs = spark.createDataFrame(rows, "doc_id long, text string, key int").selectExpr("*", "1 as content", "'x' as at", "2 as __body", "3 as __places", "4 as kept")
        got = sorted(without_repeats(docs).collect(), key=lambda r: r["key"])
        want = brute([(t or "").encode() for t in texts], 200)
        assert [(r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in got] == want
        assert got[0].asDict().keys() >= {"__body", "__places", "content", "at", "key"}


def test_empty_table(spark):
    assert without_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0
