import random

import numpy as np
import pytest
import xxhash

from matchloom.llm import simhash


def plain_fingerprint(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(str.maketrans("\t\n\v\f\r", "     ")).split(" ") if w]
    runs = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(r.encode(), seed=42).intdigest() for r in runs]
    return sum(1 << bit for bit in range(64) if sum(h >> bit & 1 for h in hashes) * 2 > len(hashes))


def plain_components(rows):
    """(id, fingerprint) -> least id reached, by every pair."""
    fps = [f for _, f in rows]
    up = list(range(len(rows)))

    def top(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if bin(fps[i] ^ fps[j]).count("1") <= 3:
                a, b = sorted((top(i), top(j)))
                up[b] = a
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(least.get(top(k), i), i)
    return [least.get(top(k)) for k in range(len(rows))]


def check(spark, data):
    docs = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 as fp", "2 as ID", "3 as run", "4 as `a.b`")
    fps = [plain_fingerprint(t) for _, t in data]
    want = [(i, f"{f:016x}", c) for (i, _), f, c in zip(data, fps, plain_components([(i, f) for (i, _), f in zip(data, fps)]))]
    got = [(r["id"], r["fp"], r["component_id"]) for r in simhash.linked(docs.drop("ID")).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    return want


@pytest.mark.parametrize("piece", [1, 9, 64])
def test_texts_taken_in_pieces_have_the_same_fingerprint(monkeypatch, piece):
    texts = ["a b c d e f g", "one", " two words ", "", None, "Aé bb\tccc\x0b dddd " * 30]
    monkeypatch.setattr(simhash, "PIECE", piece)
    monkeypatch.setattr(simhash, "HASHED", 16)
    assert simhash.fingerprints_of([None if t is None else t.encode() for t in texts]).tolist() == [plain_fingerprint(t) for t in texts]


def test_whole_result_matches_brute_force(spark):
    rng = random.Random(1)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5)))
    data = []
    for k in range(40):
        base = [word() for _ in range(rng.choice([1, 2, 3, 60, 900]))]
        for copy in range(rng.randint(1, 4)):
            words = list(base)
            for _ in range(copy - 1):
                words[rng.randrange(len(words))] = word()
            data.append((10 * k + copy, rng.choice([" ", "\n", " \t "]).join(w.upper() if rng.random() < 0.1 and w.isascii() else w for w in words)))
    data += [(900, None), (901, ""), (902, " \x0b\n"), (903, "very long text " * 100_000), (None, data[3][1]), (None, "alone and without an id"), (5, data[7][1]), (5, data[7][1])]
    rng.shuffle(data)
    want = check(spark, data)
    assert len({c for _, _, c in want}) < len(data) - 20


def test_empty_table(spark):
    assert simhash.linked(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@pytest.mark.parametrize("n", [1, 1 << 25, 1 << 40])
def test_arrangements_lose_no_pair(n):
    layouts = simhash.arrangements(n)
    rng = np.random.default_rng(2)
    fp = rng.integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    for layout in layouts:
        assert (simhash.restored(simhash.arranged(fp, layout), layout) == fp).all()
    for _ in range(200):
        x = int(fp[rng.integers(500)])
        y = x
        for bit in rng.choice(64, 3, replace=False):
            y ^= 1 << int(bit)
        pair = np.array([x, y], np.uint64)
        fronts = [simhash.arranged(pair, layout) >> np.uint64(64 - sum(w for _, w in layout[:-3])) for layout in layouts]
        assert any(a == b for a, b in fronts)


def test_tree_finds_what_all_pairs_do():
    rng = np.random.default_rng(3)
    for n, bits in ((1, 64), (2, 3), (17, 8), (300, 12), (700, 64)):
        x = rng.integers(0, 1 << bits if bits < 64 else (1 << 63), n, dtype=np.uint64)
        y = rng.integers(0, 1 << bits if bits < 64 else (1 << 63), max(1, n // 3), dtype=np.uint64)
        x, y = (simhash.of_rank(np.sort(simhash.gray_rank(np.unique(v)))) for v in (x, y))
        assert (simhash.of_rank(simhash.gray_rank(x)) == x).all()
        near = np.bitwise_count(x[:, None] ^ x[None, :]) <= 3
        a, b = simhash.close_pairs(x)
        assert set(zip(a.tolist(), b.tolist())) == {(i, j) for i, j in zip(*np.nonzero(near)) if i < j}
        near = np.bitwise_count(x[:, None] ^ y[None, :]) <= 3
        a, b = simhash.close_pairs(x, y)
        assert len(a) == near.sum() and set(zip(a.tolist(), b.tolist())) == set(zip(*(v.tolist() for v in np.nonzero(near))))


def test_crowded_fronts_are_split(spark, monkeypatch):
    """Fingerprints around a few centres, in runs of 8: most links lie between runs."""
    monkeypatch.setattr(simhash, "RUN", 8)
    rng = random.Random(4)
    centres = [rng.getrandbits(64) for _ in range(3)]
    fps = set()
    for _ in range(600):
        x = rng.choice(centres)
        for bit in rng.sample(range(64), rng.choice([2, 4, 6, 9])):
            x ^= 1 << bit
        fps.add(x)
    fps = sorted(fps)
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    nodes = spark.createDataFrame([(x,) for x in signed], "fp long")
    roots = {r["node"]: r["root"] for r in simhash.components(simhash.links(nodes, len(fps))).collect()}
    got = {}
    for k, x in enumerate(signed):
        got.setdefault(roots.get(x, x), set()).add(k)
    want = {}
    for k, c in enumerate(plain_components(list(enumerate(fps)))):
        want.setdefault(c, set()).add(k)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))
