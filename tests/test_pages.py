"""Rows from hand-made pages."""

import datetime
import random
import re
import time
import tracemalloc
from xml.etree import ElementTree

import pytest
import pyarrow as pa
from pyspark.sql import functions as F

from matchloom.operators import markup, pages
from matchloom.plans import page_queries

HOSTS, SITE = ["site.test"], "https://www.site.test"


def made(spark, *htmls):
    return spark.createDataFrame([(k, h) for k, h in enumerate(htmls)], "page_id int, html string")


def row(href, inner):
    return f'<div class="x" data-testid="game-row"> <a class="y" href="{href}"><div data-testid="game-row">{inner}</div></a></div>'


def people(*names):
    return '<div data-testid="event-participants">' + "".join(f'<a title="{n}"><p class="participant-name">{n}</p></a>' for n in names) + "</div>"


def listing(spark, html):
    return pages.listing_rows(made(spark, html), F.lit("2026-04-20").cast("date"), SITE, HOSTS).orderBy("pos").collect()


def test_listing(spark):
    html = (
        '<div data-testid="date-header">Hoje, 19 Abr  - Playoffs</div>'
        + row("/h2h/#a", '<div data-testid="time-item">22:30</div>' + people("A &amp; B", " C  D "))
        + '<div data-testid="secondary-header">1 2</div>'
        + row("https://m.site.test/#b", '<p data-testid="time-item">Finalizado</p>' + people("E", "F") + '<div data-testid="result-score">3-1</div>')
        + '<div data-testid="date-header">17 Abr 2026</div>'
        + row("/#c", '<div data-testid="time-item">Fim</div>' + people("G", "H") + "<p>2 : 0</p>")
        + row("/#d", '<div data-testid="time-item">Fim</div>' + people("G", "H") + "<p>10:12</p>")
        + row("/#c", '<div data-testid="time-item">Fim</div>' + people("Z", "Z2"))
        + row("https://site.test.evil.org/#e", people("I", "J"))
        + row("#f", people("I", "J"))
        + row("/#g", people("only"))
        + row("/#h", '<div data-testid="event-participants"><a title="K"></a><a title="L"></a><a title="K"></a></div>')
        + '<div data-testid="game-row"><p>no link</p></div>'
    )
    at = datetime.datetime
    assert [tuple(r)[2:] for r in listing(spark, html)] == [
        (f"{SITE}/h2h/#a", at(2026, 4, 20, 22, 30), "A & B", "C D", None, None, "scheduled"),
        ("https://m.site.test/#b", at(2026, 4, 20), "E", "F", 3, 1, "finished"),
        (f"{SITE}/#c", at(2026, 4, 17), "G", "H", 2, 0, "finished"),
        (f"{SITE}/#d", at(2026, 4, 17), "G", "H", None, None, "finished"),
        (f"{SITE}/#h", at(2026, 4, 17), "K", "L", None, None, "scheduled"),
    ]


@pytest.mark.parametrize("html", ["", "<html></html>", "<p>text", None])
def test_pages_without_rows(spark, html):
    assert listing(spark, html) == []
    df = made(spark, html)
    assert pages.fixed_outcome_odds(df, ["home", "away"]).count() == pages.line_odds(df, ["over"]).count() == pages.best_price_odds(df, ["over"]).count() == pages.grid_odds(df).count() == 0
    assert tuple(pages.match_headers(df, F.lit("2026-04-20").cast("date")).first())[1:] == (None, None, None, None, None, None, None, "scheduled")


def odds(book, *cells):
    return f'<div data-testid="over-under-expanded-row"><p data-testid="outrights-expanded-bookmaker-name">{book}</p>' + "".join(f'<div data-testid="odd-container"><p>{c}</p></div>' for c in cells) + '<div data-testid="payout-container">95%</div></div>'


def test_fixed_outcomes(spark):
    got = pages.fixed_outcome_odds(made(spark, odds("B1", "1.87", "+150", "x") + odds("", "2", "3") + odds("B2", "4")), ["home", "away"])
    assert [tuple(r) for r in got.collect()] == [(0, "95%", "B1", "home", 1.87), (0, "95%", "B1", "away", 2.5), (0, "95%", "B2", "home", 4.0)]


def test_lines(spark):
    held = odds("B0", "2") + '<div data-handicap="-1.5">' + odds("B1", "2") + '</div><div data-total=""><div><h3>Games <i>21.5</i></h3></div>' + odds("B2", "2") + "</div><div data-line=''></div><div data-line=\"\"><i>none</i>" + odds("B3", "2") + '</div><div data-testid="line-header">Over +3</div>' + odds("B4", "2")
    titled = '<div data-testid="total-line-box"><p class="line-value x">3.5</p>' + odds("B1", "2") + "</div>" + odds("B0", "2")
    empty = '<div data-line="2.5"></div>' + odds("B1", "2") + '<div data-testid="total-row">no number</div><div data-testid="line-header"><div>Over</div> +3</div>' + odds("B2", "2") + '<div data-testid="total-row">no number</div>' + odds("B3", "2")
    nested = '<div data-line="1"><div data-line="2"><div>' + odds("B1", "2") + '</div></div></div><div data-line="3">' + odds("", "2") + "</div>"
    unnamed = '<div data-line="3">' + odds("", "2") + "</div>" + odds("B1", "2")
    got = pages.line_odds(made(spark, held, titled, empty, nested, unnamed), ["over"]).collect()
    assert sorted((r["page_id"], r["bookmaker"], r["submarket"]) for r in got) == [
        (0, "B1", "-1.5"), (0, "B2", "21.5"), (0, "B3", ""), (1, "B1", "3.5"), (2, "B1", ""), (2, "B2", "+3"), (2, "B3", "+3"), (3, "B1", "1"), (3, "B1", "2"), (4, "B1", ""),
    ]


def test_markup(spark):
    html = """text <DIV class='a b' data-x="1>2">one<br><!-- <div data-x="9"> --><div>two</div></b>three</DIV>four<script>"<div>"</script><p data-y>five<img data-x="3"/>six"""
    page = markup.parsed(made(spark, html), "page_id", {"x": "[data-x]", "y": "p[data-y]", "a": "div.b", "part": '[data-x*=">"]', "start": "[data-x^='3']", "none": ".c, [data-z]"})
    got = {kind: [(r["pos"], r["text"]) for r in markup.elements(page, kind).select("pos", F.col("toks")[0]["text"].alias("text")).collect()] for kind in ("x", "y", "a", "part", "start", "none")}
    one = (0, "one two three")
    assert got == {"x": [one], "y": [(6, "five six")], "a": [one], "part": [one], "start": [], "none": []}
    for wrong in ("", "div > p", "[a~=b]"):
        with pytest.raises(ValueError, match="selector"):
            markup.selector(wrong)


def plain_lines(tree):
    """The rules for lines, on a tree of elements: (bookmaker, line) of each row with odds."""
    everything, number = list(tree.iter()), lambda t: (re.search(r"[+-]?\d+(?:\.\d+)?", "".join(t.itertext())) or [None])[0]
    rows_in = lambda e: [r for r in e.iter() if r is not e and r.get("data-testid") == "over-under-expanded-row"]

    def book(row):
        name = next(x for x in row.iter() if x.get("data-testid") == "outrights-expanded-bookmaker-name")
        return "".join(name.itertext()).strip()

    out = []
    for c in everything:
        if "line" in c.get("data-testid", "") or any(c.get(a) is not None for a in ("data-line", "data-total", "data-handicap")):
            value = c.get("data-line") or c.get("data-total") or c.get("data-handicap")
            if not value:
                title = next((x for x in c.iter() if x is not c and (x.tag in ("h2", "h3", "h4") or {"title", "line-value"} & set(x.get("class", "").split()))), None)
                value = number(title) if title is not None else None
            out += [(book(r), value or "") for r in rows_in(c) if book(r)]
    if not out:
        line = ""
        for e in everything:
            if e.get("data-testid") in ("line-header", "handicap-row", "total-row"):
                line = number(e) or line
            elif e.get("data-testid") == "over-under-expanded-row" and book(e):
                out.append((book(e), line))
    return sorted(out)


def test_lines_of_random_pages_match_a_tree_walk(spark):
    rng = random.Random(7)

    def part(depth, held):
        kinds = ["row", "row", "header", "title", "plain"] + ["box"] * 3 * held
        kind = rng.choice(kinds) if depth < 5 else "row"
        tag = rng.choice(["div", "div", "section"])
        inner = lambda: "".join(part(depth + 1, held) for _ in range(rng.randrange(4)))
        if kind == "row":
            return odds(rng.choice(["", *(f"B{k}" for k in range(9))]), "2").replace("<p>", "<div><div>").replace("</p></div>", "</div></div></div>")
        if kind == "header":
            return f'<{tag} data-testid="{rng.choice(["line-header", "handicap-row", "total-row"])}"><{tag}>{rng.choice(["Over 1.5", "-3", "none"])}</{tag}></{tag}>'
        if kind == "title":
            return rng.choice(["<h3>Games <b>4.5</b></h3>", '<p class="x title">+1</p>', '<div class="line-value">none</div>', "<h5>8</h5>"])
        if kind == "plain":
            return f"<{tag}>{inner()}</{tag}>"
        return f"<{tag} {rng.choice(['data-line=', 'data-total=', 'data-handicap=', 'data-testid='])}\"{rng.choice(['', '2.5', '-7', 'my-line-box'])}\">{inner()}</{tag}>"

    htmls = ["<body>" + "".join(part(0, k % 3 > 0) for _ in range(rng.randrange(9))) + "</body>" for k in range(90)]
    want = sorted((k, *x) for k, h in enumerate(htmls) for x in plain_lines(ElementTree.fromstring(h)))
    got = sorted((r["page_id"], r["bookmaker"], r["submarket"]) for r in pages.line_odds(made(spark, *htmls), ["over"]).collect())
    assert got == want and len({k for k, *_ in got}) > 40


def test_best_prices_and_grid(spark):
    best = '<div data-testid="over-under-collapsed-row"><div data-testid="over-under-collapsed-option-box"><p>Acima/Abaixo +199.5</p><p>x</p></div><div data-testid="odd-container-default"><p data-testid="odd-container-default">1.9</p></div><p data-testid="odd-container-default">2</p></div>'
    assert [tuple(r) for r in pages.best_price_odds(made(spark, best + best.replace("+199.5", "none")), ["over", "under"]).collect()] == [(0, "+199.5", "best", "over", 1.9), (0, "+199.5", "best", "under", 2.0)]
    grid = '<div data-testid="bookmaker-table-header-line"><div>Book</div><div>2:0</div></div>' + odds("B", "3", "4")
    in_table = "<table><thead><tr><th>Book</th><th><div>2:0</div></th></tr></thead><thead><tr><th>x</th><th>y</th></tr></thead></table>" + odds("B", "3", "4")
    by_class = '<div class="a table-header b"><div><div>Book</div><div>2:0</div></div></div>' + odds("B", "3", "4")
    got = pages.grid_odds(made(spark, grid, in_table, by_class, odds("B", "3", "4"))).collect()
    assert sorted((r["page_id"], r["submarket"], r["odds_closing"]) for r in got) == [(k, x, o) for k in range(3) for x, o in (("2:0", 3.0), ("col_1", 4.0))] + [(3, "col_0", 3.0), (3, "col_1", 4.0)]


def test_match_headers(spark):
    event = '<script type="application/ld+json">{broken</script><script type="application/ld+json">{"@type": "SportsEvent", "startDate": "2026-08-25T13:00:00+02:00", "homeTeam": {"name": " A "}, "awayTeam": {"name": ""}, "location": {"address": {"addressCountry": "PT"}}}</script><p data-testid="game-host">X</p><p data-testid="game-guest">B</p>'
    live = '<div data-testid="live-info">Resultado final <strong>2:1</strong> (6<sup>5</sup>:7, 7:6, 6:2)</div>'
    free = '<p data-testid="game-time-item">Sábado, 01 Out 2022, 10:10</p><div data-testid="live-info">Result 3 - 0</div>'
    other = '<div data-testid="game-participants">Lakers 107 – 98 Rockets</div><div data-testid="live-info">live 1:0</div>'
    got = [tuple(r)[1:] for r in pages.match_headers(made(spark, event + live, free, other), F.lit("2026-04-20").cast("date")).orderBy("page_id").collect()]
    at = datetime.datetime
    assert got == [
        ("A", "B", at(2026, 8, 25, 11), "PT", 2, 1, "6-7 7-6 6-2", "finished"),
        (None, None, at(2022, 10, 1, 10, 10), None, 3, 0, None, "finished"),
        (None, None, None, None, 107, 98, None, "finished"),
    ]


def test_a_page_takes_time_in_proportion_to_its_rows():
    def seconds(n):
        html, start = "".join(odds(f"B{k}", "2", "3") for k in range(n)), time.process_time()
        assert len(markup._elements_of(html, markup._Tags({"x": "[data-testid]"}), {})) == 5 * n
        return time.process_time() - start

    few = min(seconds(1_000) for _ in range(3))
    assert seconds(8_000) < 30 * few


def test_a_long_listing(spark):
    html = '<div data-testid="date-header">17 Abr 2026</div>' + "".join(row(f"/#{k}", '<div data-testid="time-item">22:30</div>' + people(f"A{k}", "B")) for k in range(12_000))
    got = listing(spark, html)
    assert len(got) == 12_000 and {r["dt"] for r in got} == {datetime.datetime(2026, 4, 17, 22, 30)} and got[-1]["home"] == "A11999"


def test_pages_leave_a_task_in_batches_of_bounded_size():
    batch = pa.RecordBatch.from_arrays([pa.array(range(3)), pa.array(["ab", None, "c" * 7])], names=["key", "html"])
    got = list(markup._pieces([batch], lambda html: html * 2_000, lambda out: {"x": pa.array(out)}))
    assert [len(b) for b in got] == [5_000, 5_000, 5_000, 3_000]
    assert [r["key"] for b in got for r in b.to_pylist()] == [0] * 4_000 + [2] * 14_000


def test_what_rows_ask_for(spark):
    html = '<b class="x">no</b><ul data-n="1"><h3>t</h3><ol data-n=""><li class="r" id="1"><b class="x"><i class="x">in</i></b><p><i>2</i></p><i>3</i></li></ol></ul><b class="x">8</b><li class="r">'
    asks = {"i": markup.Ask("i", first=False), "child": markup.Ask("i", child=True), "leaf": markup.Ask(".x", leaves=True, first=False), "held": markup.Ask(".x", inside="b", below=True, first=False), "id": markup.Ask("li", "id")}
    got = markup.rows(made(spark, html), "page_id", {"row": "li"}, asks, {"bold": markup.Ask("b", first=False)}, markup.Around("[data-n]", ("data-n",), "h3"), (".x", r"\d")).orderBy("pos").collect()
    assert [tuple(r)[2:] for r in got] == [
        (["row"], ["in", "2", "3"], ["3"], ["in"], ["in"], ["1"], ["no", "in", "8"], ["1", None], ["t", None], None),
        (["row"], [], [], [], [], [""], ["no", "in", "8"], [], [], "8"),
    ]


def test_plain_pages_are_cut_like_others():
    html = "".join(odds(f"B{k % 3}", "2", "3 &lt; 4") for k in range(50)) + "<p data-x='1'>five<img data-x/>six</P></i><ul><li data-x=2>seven"
    tags, other = markup._Tags({"x": "[data-testid], [data-x]"}), markup._Tags({"x": "[data-testid], [data-x]"})
    plain = markup._elements_of(html, tags, {})
    for odd in ("<", "< b", "<!-- <p> -->", "<script>'<p>'</script>", '<b title="<1>">', "<b title='>'>"):
        by_tag = markup._elements_of(f"{html} {odd}", other, {})
        assert [e | {"end": 0, "text": e["text"].split()[:1]} for e in by_tag] == [e | {"end": 0, "text": e["text"].split()[:1]} for e in plain]
    assert len(plain) == 253 and len(tags.tags) < 20  # tags that recur are read once


def test_pages_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(markup, "_STRETCH_CHARS", 60)
    monkeypatch.setattr(markup, "_STRETCH_TAGS", 3)
    rng = random.Random(11)
    bits = ["<li id='a'>", "<li>", "</li>", "</li>", "<b class='x'>", "</b>", "<i>", "</i>", "text 3", "<div data-n='4'>", "</div>", "<h3>T</h3>", "<br>", "</ul>", "<i class='x'/>", "&amp;"]
    odd = ["< b", "<!-- <li> -->", "<script>'<li>'</script>", '<b title="<1>">', "<!-- x", "<i"]
    htmls = ["".join(rng.choice(bits + odd * (k % 2)) for _ in range(rng.randrange(90))) for k in range(200)]
    kinds, asks = {"row": "li", "bold": "b"}, {"i": markup.Ask("i", first=False), "child": markup.Ask("i", child=True), "leaf": markup.Ask(".x", leaves=True, first=False)}

    def got(df, **how):
        out = markup.rows(df, "page_id", kinds, asks, None, markup.Around("[data-n]", ("data-n",), "h3"), (".x", r"\d"), **how)
        return sorted(map(repr, out.collect()))

    cut = []
    for k, html in enumerate(htmls):
        at = [0, *sorted(rng.randrange(len(html) + 1) for _ in range(rng.randrange(6))), len(html)]
        cut += [(k, n, html[a:b]) for n, (a, b) in enumerate(zip(at, at[1:], strict=False), 1)]
    pieces = spark.createDataFrame(cut, "page_id int, number int, html string").coalesce(1).sortWithinPartitions("page_id", "number")
    want = got(made(spark, *htmls))
    assert got(pieces, number="number") == want and len(want) > 1_000
    for lost in (pieces.where("number <> 2 or page_id <> 7"), pieces.sortWithinPartitions("number", "page_id")):
        with pytest.raises(Exception, match="doesn't follow"):
            got(lost, number="number")


def test_a_page_in_pieces_takes_no_more_memory_if_it_is_longer():
    def peak(n):
        tags = markup._Tags({"row": "[data-testid]"})
        tracemalloc.start()
        found = sum(len(page.found) for page in markup._read((odds(f"B{k % 9}", "2", "3") for k in range(n)), tags, whole=False))
        out = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert found == 5 * n
        return out

    assert peak(16_000) < 1.5 * peak(4_000)


def test_rows_that_need_an_answer(spark):
    html = '<li id="1"><a href="x">one</a></li><li id="2"><p><a href="y">two</a></p></li><b><a href="z">three</a></b>'
    asks = {"href": markup.Ask("a[href]", "href", child=True, of="row", need=True), "id": markup.Ask("li", "id", of="row"), "text": markup.Ask("a")}
    got = markup.rows(made(spark, html), "page_id", {"row": "li", "bold": "b"}, asks).orderBy("pos").collect()
    assert [tuple(r)[2:] for r in got] == [(["row"], ["x"], ["1"], ["one"]), (["bold"], [], [], ["three"])]


def test_pieces_of_a_page_are_the_page(spark):
    rows = spark.createDataFrame([(f"p{k % 3}", (k * 7) % 50, k) for k in range(50)], "page string, id int, v int")
    piece = lambda row, page: F.when(row["v"] != 4, F.concat(page, F.lit(" "), row["v"].cast("string")))
    whole = {r["page_id"]: r["html"] for r in page_queries.joined(rows, "page", ["id"], piece).collect()}
    pieces = page_queries.in_pieces(rows, "page", ["id"], piece).orderBy("number").collect()
    assert {p: "".join(r["html"] for r in pieces if r["page_id"] == p).split() for p in whole} == {p: h.split() for p, h in whole.items()}
