import random
from collections import Counter

import pytest

from matchloom.llm.log_templates import generalised, keep_filled, leaf_of, masked, without_templates, words_of


def test_masking_and_generalising(spark):
    assert masked(b"  user 17   logged\tin at 10:30") == b"user <*> logged in at <*>"
    lines = [b"the job of user anna ended well today", b"the job of user bob ended well today", b"the job of user <*> ended well today", b"the job of all things is quite another", b"a b c x", b"a b c y"]
    rows = [(leaf_of(x), k, words_of(x), bytearray(x)) for k, x in enumerate(lines)]
    got = generalised(spark.createDataFrame(rows, "leaf long, line long, words long, masked binary")).collect()
    of = [{r["template"]: r["words"] for r in got if r["line"] == k} for k in range(6)]
    assert of[0].keys() & of[1].keys() == of[2].keys() and list(of[2].values()) == [7]
    assert sorted(of[0].values()) == [7, 8] and list(of[3].values()) == [8]
    assert [len(x) for x in of[4:]] == [1, 1] and of[4] != of[5]


def rows():
    rng = random.Random(1)
    names = ["anna", "bob", "carl", "dora"]
    out = []
    for k in range(60):
        own = [" ".join(f"{rng.choice('abcdefgh')}{rng.choice('xyz')}w" for _ in range(12)) + f" own{k}" for _ in range(3)]
        lines = [f"Page viewed by user {rng.choice(names)} from the main portal", own[0], f"code {k} of batch {k * 7} done", *own[1:]]
        if k < 5:
            lines.append("this line is in a few documents only")
        out.append((k, "\n".join(lines)))
    return out


def test_recurring_templates_are_dropped(spark):
    data = [*rows(), (100, None), (101, ""), (None, rows()[3][1]), (102, "code 5 of batch 9 done")]
    docs = spark.createDataFrame(data, "doc_id long, text string").selectExpr("*", "1 as line", "2 as __x", "3 as id", "4 as __id", "5 as __drop", "6 as __lines", "7 as leaf")
    got = without_templates(docs).collect()
    assert got[0].asDict().keys() == {"doc_id", "text", "line", "__x", "id", "__id", "__drop", "__lines", "leaf"}
    assert tuple(got[0])[2:] == (1, 2, 3, 4, 5, 6, 7)
    text = {r["doc_id"]: r["text"] for r in got}
    assert text[0] == data[0][1] and text[100] is None and text[101] == "" and text[None] == data[3][1]
    for k in range(1, 60):
        assert text[k] == "\n".join(x for x in data[k][1].split("\n") if not x.startswith(("Page", "code")))
    assert text[102] == ""
    assert {r["doc_id"] for r in keep_filled(docs).collect()} == {r[0] for r in data} - {102}


def test_copies_do_not_make_a_template(spark):
    copies = spark.createDataFrame([(k, "one line here of some words\nand another line of words") for k in range(50)], "doc_id long, text string")
    assert without_templates(copies).distinct().count() == 50
    assert without_templates(copies.limit(0)).count() == 0


def test_leaves_of_many_lines_follow_the_same_rule(spark):
    many = 6000  # different lines of one leaf
    docs = spark.createDataFrame([(k, f"Page viewed by user {'anbecidofu'[k % 10]}x{'name' * (k // 10 % 6)}{chr(97 + k // 60 % 10)}{chr(97 + k // 600)} from the main portal\nown{'abcdefghij'[k % 10]} words") for k in range(many)], "doc_id long, text string")
    assert docs.select("text").distinct().count() == many
    assert [r["doc_id"] for r in without_templates(docs).collect() if "portal" in r["text"]] == [0]


@pytest.mark.parametrize("parts", [1, 3, 40])
def test_random_lines_of_one_leaf_are_dropped_however_they_are_dealt(spark, parts):
    rng = random.Random(11)
    word = lambda n: "".join(rng.choice("abcdefghij") for _ in range(n))
    rows = [(k, " ".join(["in", "the", "end", *(word(rng.choice([1, 1, 2])) for _ in range(4))])) for k in range(4000)]
    want = whole_result(rows)
    assert 100 < sum(a != b for a, b in zip(sorted(((str(i), t) for i, t in rows), key=str), want)) < 3900
    rng.shuffle(rows)
    got = without_templates(spark.createDataFrame(rows, "doc_id long, text string").repartition(parts)).collect()
    assert sorted(((str(r["doc_id"]), r["text"]) for r in got), key=str) == want


def test_long_lines_recur_in_fewer_texts(spark):
    word = lambda k: "".join("abcdefghij"[int(c)] for c in str(k))
    planted = {"l": (12, 3), "m": (10, 19), "n": (9, 6), "o": (6, 10), "p": (12, 2), "q": (9, 5), "r": (4, 19), "s": (6, 9)}
    passage = {x: " ".join(x + word(k) for k in range(n)) for x, (n, _) in planted.items()}
    docs = [(k, "\n".join([f"own{word(k)} text", *(passage[x] for x, (_, n) in planted.items() if k < n)])) for k in range(25)]
    text = {r["doc_id"]: r["text"].split("\n") for r in without_templates(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for x, (_, n) in planted.items():
        assert sum(passage[x] in lines for lines in text.values()) == (1 if x in "lmno" else n), x


def whole_result(rows):
    """Brute force: the rule of the docstring on all lines at once."""
    mask = lambda x: " ".join("<*>" if any(c in "0123456789" for c in t) else t for t in x.split())
    texts, first, holders, leaves = {}, {}, {}, {}
    for i, text in rows:
        for m in {mask(x) for x in (text or "").split("\n")} - {""}:
            holders.setdefault(m, []).append((i, text))
    for m in holders:
        leaves.setdefault((m.count(" "), *m.split(" ")[:3]), []).append(m)
    of_line = {}
    for leaf, lines in leaves.items():
        support = Counter((k, t) for m in lines for k, t in enumerate(m.split(" ")[3:]))
        for m in lines:
            rest = [(k, t) for k, t in enumerate(m.split(" ")[3:]) if t != "<*>"]
            for least in [0, *(support[x] for x in rest)]:
                kept = [x for x in rest if support[x] >= least]
                if least == 0 or 2 * len(kept) >= len(rest):
                    words = sum(t != "<*>" for t in m.split(" ")[:3]) + len(kept)
                    of_line.setdefault(m, set()).add((words, leaf, tuple(kept)))
        for m in lines:
            for t in of_line[m]:
                for i, text in holders[m]:
                    texts.setdefault(t, set()).add(text)
                    if i is not None:
                        first[t] = min(first.get(t, i), i)
    bar = lambda words: 3 if words >= 10 else 6 if words >= 8 else 10 if words >= 5 else 20
    recurring = {t for t in texts if len(texts[t]) >= bar(t[0])}
    out = []
    for i, text in rows:
        kept = []
        for x in (text or "").split("\n"):
            m = mask(x)
            fewest = min((t[0] for t in of_line.get(m, ()) if t in recurring), default=None)
            general = [t for t in of_line.get(m, ()) if t in recurring and t[0] == fewest]
            if not m or i is None or not general or first[general[0]] == i:
                kept.append(x)
            assert len(general) < 2
        out.append((str(i), None if text is None else "\n".join(kept)))
    return sorted(out, key=str)


def test_whole_result_matches_brute_force(spark):
    rng = random.Random(9)
    forms = ["at {} the user {} logged in from host {} today", "{} of {}", "see also the page of {} for more on this old matter", "{} {} {} {} {} {}", "end", "call {} now and ask for {} at once please"]
    word = lambda: rng.choice(["anna", "bob", "carl", "dora", "7", "x12", "own" + rng.choice("abcdefgh") + rng.choice("xyz")])
    rows = []
    for k in range(150):
        lines = [rng.choice(forms) for _ in range(rng.randrange(6))]
        rows.append((k, "\n".join(f.format(*(word() for _ in range(6))) for f in lines) + rng.choice(["", "\n", "\n  \n"])))
    rows += [(200, None), (201, ""), (None, rows[3][1]), (5, rows[7][1]), (202, rows[9][1])]
    got = without_templates(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(((str(r["doc_id"]), r["text"]) for r in got), key=str) == whole_result(rows)
