import random
import re
from itertools import permutations

from matchloom.llm.filter_audit import audited


def plain(rows, labels):
    """Brute force: every filter on every document, every order one after the other."""
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    failed = []
    for i, text, lang in rows:
        text = text or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", text)
        f = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text), "D": bool(re.search("[#$%&*|]", text)), "E": i is not None and least[text] < i}
        failed.append((lang or "", {k for k, v in f.items() if v}, any(q == 1 for j, q, _ in labels if j == i is not None), any(t == 1 for j, _, t in labels if j == i is not None)))
    out = []
    for part in {p for p, *_ in failed}:
        mine, removed_by, lines = [x[1:] for x in failed if x[0] == part], dict.fromkeys("ABCDE", 0), []
        for order in map("".join, permutations("ABCDE")):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [x for x in left if f in x[0]]
                redundant = sum(f in x[0] for x in mine) - len(gone)
                left = [x for x in left if f not in x[0]]
                removed_by[f] += len(gone)
                lines.append((f, (part, order, step, len(left), len(gone), redundant, sum(x[0] == {f} for x in mine), sum(x[1] for x in gone), sum(x[2] for x in gone))))
        out += [(*line, removed_by[f]) for f, line in lines]
    return sorted(out)


def run(spark, rows, labels):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").selectExpr("*", "1 as id", "2 as hash", "3 as part", "4 as `a.b`", "5 as failed")
    return sorted(map(tuple, audited(docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()))


def test_whole_result_matches_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for k in range(120):
        words = [rng.choice(["a", "B", "cé", "dd", f"w{rng.randrange(400)}", f"x{rng.randrange(400)}", "GHI"][rng.choice([0, 4, 4, 4, 4, 5, 5]) :][:3]) for _ in range(rng.choice([0, 5, 99, 100, 101, 160]))]
        text = rng.choice([" ", "\n", "\x0b\t "]).join(words) + rng.choice(["", "", "", " 5%", "#", " "])
        rows += [(rng.randrange(10_000), text, rng.choice(["en", "en", "fr", None, ""])) for _ in range(rng.choice([1, 1, 1, 2, 5]))]
    rows += [(7, None, "en"), (8, "", "en"), (None, rows[3][1], "fr"), (None, "own", None), rows[5], rows[5], (rows[9][0], "another text of one id", "fr"), (20_000, "word " * 300_000, "en"), (20_001, " ".join(f"w{k}" for k in range(200_000)), "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 0, 1, None])) for i, *_ in rows if rng.random() < 0.6] + [(rows[0][0], 1, 1), (None, 1, 1), (99_999, 1, 1)]
    got = run(spark, rows, labels)
    assert got == plain(rows, labels) and len(got) == 600 * 3
    assert all(sum(r[k] for r in got) for k in range(3, 10))


def test_empty_tables(spark):
    assert run(spark, [], [(1, 1, 0)]) == []
    assert run(spark, [(1, None, None)], []) == plain([(1, None, None)], [])
