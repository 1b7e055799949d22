import os
import re
from collections import Counter

import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from matchloom.llm import store
from matchloom.llm.queries import oracle_sql, queries
from matchloom.llm.store import table, written

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")


@pytest.fixture(scope="module")
def stages(spark):
    out, docs = [], table(spark, SF, "documents")
    out.append(docs)
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), name)
        out.append(docs)
    return out


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def sets(rows, n=5):
    out = {}
    for i, text in rows:
        w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    return out


def rows(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


def test_columns_stay(stages):
    assert [df.columns for df in stages[:-1]] == [stages[0].columns] * 5
    assert stages[-1].columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]


def test_quality_rules_reject_what_the_base_rule_does(stages):
    kept = {i for i, _ in rows(stages[1])}
    # With so few labels no cutoff is admissible, so the base rule is the whole verdict.
    for i, text in rows(stages[0]):
        w = words(text)
        windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        again = {x for x, c in Counter(windows).items() if c > 1}
        repeated = len({k + j for k, x in enumerate(windows) if x in again for j in range(3)})
        assert (i in kept) == (len(w) >= 50 and 100 * repeated <= 50 * len(w)), i


def test_line_dedup_takes_only_lines(stages):
    before = dict(rows(stages[1]))
    for i, text in rows(stages[2]):
        lines = iter(before[i].split("\n"))
        assert all(any(x == y for y in lines) for x in text.split("\n"))
    assert all(r["n_chars"] == len(r["text"]) for r in stages[2].collect())


def test_near_dedup_leaves_one_of_each_group(stages):
    before, kept = sets(rows(stages[2])), sets(rows(stages[3]))
    like = lambda x, y: x and y and 5 * len(x & y) >= 4 * len(x | y)
    ids = sorted(kept)
    assert not any(like(kept[a], kept[b]) for k, a in enumerate(ids) for b in ids[k + 1 :])
    root = {i: i for i in before}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    order = sorted(before)
    for k, a in enumerate(order):
        for b in order[k + 1 :]:
            if like(before[a], before[b]):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    assert set(kept) == {i for i in before if find(i) == i}


def test_decontamination_leaves_no_item(spark, stages):
    items = [s for s in sets([(r["item_id"], r["text"]) for r in table(spark, SF, "benchmark").collect()]).values() if s]
    hit = lambda s: any(5 * len(s & t) >= 4 * len(t) for t in items)
    assert {i for i, _ in rows(stages[4])} == {i for i, s in sets(rows(stages[3])).items() if not hit(s)}


def test_encoding_matches_library(stages):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: len(library.encode(t or "", add_special_tokens=False).ids) for i, t in rows(stages[4])}
    assert {r["doc_id"]: r["n_tokens"] for r in stages[5].collect()} == want


def test_run_gives_the_last_stage(spark, stages):
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == sorted(map(tuple, stages[-1].collect()))


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_queries_match_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "labels", "benchmark"):
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    out = con.execute(oracle_sql()[name])
    names = [d[0] for d in out.description]
    got = queries()[name](spark, SF)
    assert sorted(map(str, ([r[c] for c in names] for r in got.collect()))) == sorted(map(str, map(list, out.fetchall())))


@pytest.mark.parametrize("name", sorted(queries()))
def test_queries_run(spark, name):
    df = queries()[name](spark, SF)
    kinds = dict(df.dtypes)
    assert df.count() >= 0
    if name in ("op12_filter_audit", "op13_collocations"):  # reports by part and language
        assert set(kinds.values()) <= {"string", "int", "bigint"}
    else:
        assert kinds["doc_id"] == "bigint"


EXTRA = "1 as id, 2 as body, 3 as __kept, 4 as __drop, 5 as __gone, 6 as __hit, 7 as stratum, 8 as node, 9 as line, 10 as __quality"


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_empty_tables_and_nulls(spark, name, stage):
    docs = table(spark, SF, "documents").selectExpr("*", *EXTRA.split(", "))
    last = name == corpus_pipeline.STAGES[-1][0]
    empty = stage(spark, docs.limit(0), SF)
    assert empty.count() == 0 and (last or empty.columns == docs.columns)
    good = docs.where("length(text) > 2000 and lang = 'en'").limit(1).select("text").first()["text"]
    rows = [(None, None, None, None, None), (1, None, "en", "s", 0), (2, "", None, None, 0), (3, good, None, None, None), (3, good, None, None, None), (None, good, "en", None, 5)]
    got = stage(spark, spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").selectExpr("*", *EXTRA.split(", ")), SF)
    found = [(str(r["doc_id"]), None if last else r["text"]) for r in got.collect()]
    texts = {"quality_rules": [("3", good), ("3", good), ("None", good)]}.get(name, [("1", None), ("2", ""), ("3", good), ("3", good), ("None", None), ("None", good)])
    assert sorted(found, key=str) == sorted([(i, None if last else t) for i, t in texts], key=str)
    if not last:
        assert got.columns == docs.columns and all(tuple(r)[5:] == tuple(range(1, 11)) for r in got.collect())


def test_run_leaves_only_its_stages_behind(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store, "shared_folder", lambda spark: str(tmp_path))
    assert corpus_pipeline.run(spark, SF).count() >= 0
    assert sorted(p.name.split("-")[0] for p in tmp_path.iterdir()) == sorted(name for name, _ in corpus_pipeline.STAGES[:-1])


class Session:
    """A session of some master that names a shared folder or doesn't."""

    def __init__(self, master, named=None):
        self.conf = {"spark.checkpoint.dir": named}
        self.sparkContext = type("Context", (), {"master": master, "applicationId": f"{master} {named}"})


def test_no_machine_local_folder_on_a_cluster():
    assert store.shared_folder(Session("spark://a:1", "file:///shared/")) == "file:///shared"
    assert store.shared_folder(mine := Session("local[4]")) == store.shared_folder(mine)
    for master in ("spark://a:1", "yarn", "local-cluster[1,1,1024]"):
        with pytest.raises(ValueError):
            store.shared_folder(Session(master))
