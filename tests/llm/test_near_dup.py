import random
import re

from matchloom.llm.near_dup import linked


def brute(rows, n, num=80, den=100):
    sets = []
    for i, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        sets.append((i, {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()))
    root = {i: i for i, _ in sets if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, x in sets:
        for b, y in sets:
            if a is not None and b is not None and x and y and den * len(x & y) >= num * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return sorted((str(i), len(s), None if i is None else find(i), True if i is None else find(i) == i) for i, s in sets)


def texts(seed):
    rng = random.Random(seed)
    vocab = [f"w{k}" for k in range(300)]
    rows, base = [], []
    for k in range(60):
        base.append([rng.choice(vocab) for _ in range(rng.choice([3, 5, 30, 80, 200]))])
    for k in range(300):
        words = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 1, 2, 4])):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        rows.append((k, " ".join(w.upper() if rng.random() < 0.02 else w for w in words)))
    template = [rng.choice(vocab) for _ in range(120)]
    for k in range(300, 500):  # a large group of like texts
        words = list(template)
        for _ in range(rng.choice([1, 2, 3])):
            words[rng.randrange(len(words))] = rng.choice(vocab)
        rows.append((k, " ".join(words)))
    return rows + [(900, None), (901, ""), (902, " \n"), (903, None), (None, "a b c d e"), (904, "one two"), (905, "One\ttwo"), (7, rows[7][1])]


def test_components_match_brute_force(spark):
    rows = texts(3)
    for n in (4, 5):
        got = linked(spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed("x", "y"), n=n).collect()
        assert sorted((str(r["id"]), r["n_shingles"], r["component_id"], r["kept"]) for r in got) == brute(rows, n)


def test_empty_table(spark):
    assert linked(spark.createDataFrame([], "doc_id long, text string, id string, node int")).count() == 0
