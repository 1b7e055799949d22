import random
import re

import matchloom.llm.decontaminate as decontaminate
from matchloom.llm.decontaminate import clean, contained


def shingles(text, n=5):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[k : k + n]) for k in range(max(1, len(words) - n + 1))} if words else set()


def make():
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(5000)}"
    items = [(k, [word() for _ in range(rng.choice([3, 8, 20, 60, 200]))]) for k in range(60)]
    docs = []
    for k in range(400):
        words = [word() for _ in range(rng.choice([2, 30, 400, 6000]))]
        if k % 4 == 0:
            item = list(rng.choice(items)[1])
            for _ in range(rng.choice([0, 0, 1, 3])):
                item[rng.randrange(len(item))] = word()
            at = rng.randrange(len(words))
            words = words[:at] + item + words[at:] if k % 8 else item
        docs.append((k, " ".join(words)))
    docs += [(None, None), (1000, ""), (None, " ".join(items[3][1]).upper()), (5, docs[0][1])]
    return docs, [(k, "\n".join(x)) for k, x in items] + [(70, None), (71, ""), (72, "Only three words")]


def test_pairs_match_brute_force(spark, monkeypatch):
    docs, items = make()
    table, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    want = sorted((str(d), i, len(s & t), len(s)) for d, text in docs for t in [shingles(text)] for i, item in items for s in [shingles(item)] if s and 5 * len(s & t) >= 4 * len(s))
    assert len(want) > 50
    for block in (1_000_000, 1000):
        monkeypatch.setattr(decontaminate, "BLOCK", block)
        assert sorted((str(r["id"]), *r[1:]) for r in contained(table, bench).collect()) == want
    left = clean(table, bench)
    assert left.columns == ["doc_id", "text"]
    assert {r["doc_id"] for r in left.collect()} == {d for d, _ in docs} - {int(d) for d, *_ in want if d != "None"}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, item_id long, text string, id int, run int")
    some = spark.createDataFrame([(1, 1, "a b c")], "doc_id long, item_id long, text string")
    for a, b in ((none, some), (some, none), (none, none)):
        assert contained(a, b).count() == 0
