import datetime
import warnings

from pyspark.sql import functions as F

from matchloom.functions import scalars as S


def values(spark, texts, f):
    rows = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string").select("k", f(F.col("t")).alias("v")).collect()
    return [r["v"] for r in sorted(rows, key=lambda r: r["k"])]


def test_parse_odd(spark):
    cases = {"1.87": 1.87, "+150": 2.5, "-110": 1.9091, "2/5": 1.4, "-": None, "": None, "N/A": None, "150": 150.0, "1,5": 1.5, " 2.5 ": 2.5, "0.9": None, "1": None, "+0": 1.0, "-0": None, "0/1": 1.0, "3/0": None, "inf": None, "1_000": None, "1.5d": None, None: None, "x": None}
    assert values(spark, list(cases), S.parse_odd) == list(cases.values())


def test_parse_pt_datetime(spark):
    cases = {
        "Hoje, 19 Abr 2026, 00:30": "2026-04-19 00:30:00", "Ontem, 18 Abr 2026, 00:30": "2026-04-18 00:30:00", "17 Abr 2026  - Playoffs de Acesso": "2026-04-17 00:00:00",
        "Hoje, 19 Abr  - Playoffs": "2026-05-02 00:00:00", "ontem 9:05": "2026-05-01 09:05:00", "31 Dez": "2026-12-31 00:00:00", "31 Fev 2026": None, "10 Xyz 2026": None, "": None, None: None, "hoje 25:99": None,
    }
    got = values(spark, list(cases), lambda c: F.date_format(S.parse_pt_datetime(c, F.lit("2026-05-02").cast("date")), "yyyy-MM-dd HH:mm:ss"))
    assert got == list(cases.values())


def test_small_rules(spark):
    assert values(spark, ["a   b ", None, ""], S.normalize_name) == ["a b", None, ""]
    assert values(spark, ["2026-08-25T13:00:00+02:00", "soon"], S.offset_to_iso) == ["2026-08-25T11:00:00+00:00", None]
    assert values(spark, ["2020", "2023-2024", None, "x"], lambda c: S.season_is_final(c, 2022)) == [True, False, False, False]
    assert values(spark, ["2020", "2023-2024", None, "x"], S.season_end_year) == [2020, 2024, None, None]
    assert values(spark, ["nba-2023-2024", "atp-2020", "cup-1850", "x"], S.strip_season_suffix) == ["nba", "atp", "cup-1850", "x"]
    assert values(spark, ["https://a.b.com/x", "https://b.com", "https://xb.com", "nonsense", None], lambda c: S.host_allowed(c, ["b.com"])) == [True, True, False, False, False]
    assert values(spark, ["https://h/a##b", "https://h", None], S.url_fragment) == ["#b", "", None]
    assert values(spark, ["Final 2:1 (6:7, 7 - 6, 6:2) (1:1)", "no"], lambda c: S.set_scores(c, F.lit("finished"))) == ["6-7 7-6 6-2", None]
    pair = lambda c: F.concat_ws("-", S.score_pair(c)["home"], S.score_pair(c)["away"])
    assert values(spark, ["10 : 2", "A 1:2 B", "at 22:30", "98:95 now", "1:2:3"], pair) == ["10-2", "1-2", "", "", ""]
    assert values(spark, ["usa/atp-us-open", "usa/itf-m25-el-paso-homens", "uae"], S.venue_city) == ["New York", "El Paso", ""]
    assert values(spark, ["https://h/m/", "https://h/m"], lambda c: S.tab_url(c, F.lit("x"))) == ["https://h/m/#x"] * 2


def test_stable_id_keeps_empty_parts(spark):
    one = lambda c: S.stable_event_id(F.lit("t"), c, F.lit("a"), F.lit("b"), F.lit("2020-01-01T00:00:00"))
    got = values(spark, ["x", None], one)
    assert len(set(got)) == 2 and all(len(v) == 16 for v in got)


NOTATIONS = [
    "Thu Sep 25 10:36:28 2003", "2003-09-25T10:49:41.5-03:00", "2003-09-25T10:49", "20030925T104941", "20030925T1049", "20030925 10:49", "20030925", "2003-09-25",
    "Sep-25-2003", "25-Sep-2003", "25 Sep 2003", "2003-Sep-25", "Sep 25, 2003", "September 25th, 2003 at 1pm", "25th of September 2003", "10/09/2003", "25/09/2003", "09/25/2003",
    "2003/09/25", "2003.09.25", "09.25.2003", "25.09.2003", "10-09-03", "25-09-03", "Thursday, 25 September 2003 10:49 PM", "10:36:28 25 Sep 2003", "Wed, July 10, '96", "1996.07.10 AD at 15:08:56 PDT",
    "July 4, 1976 12:01:02 am", "Mon Jan  2 04:24:27 1995", "04.04.95 00:22", "Jan 1 1999 11:23:34.578", "3rd of May 2001", "5th of March 2001", "1st of May 2003", "99-12-31", "2003-09-25 10:49:41 UTC",
    "2003-09-25 10:49:41Z", "2003-09-25 10:49 +02", "Fri, 5 Dec 2025 23:59:59 GMT", "12h05 2003-09-25", "10 pm 2003-09-25", "31-12-1999", "13/13/2003", "2003-02-30", "2003-09-25 25:00", "no date", "soon 2003-09-25", "", " ", "2003-09-25 13 pm",
]


def test_dates_in_any_notation(spark):
    from dateutil import parser

    def plain(text, **options):
        try:
            at = parser.parse(text, **options) if text.strip() else None
        except (ValueError, OverflowError):
            return None
        return at and (at - at.utcoffset() if at.tzinfo else at).replace(tzinfo=None)

    rows = spark.createDataFrame([(k, t) for k, t in enumerate(NOTATIONS)], "k int, t string")
    default = datetime.datetime(2001, 3, 4)
    more = ["Sep 2003", "25 Sep", "10:36", "Sep", "2003-09", "09/25", "3 May 10:00"]
    got = {r["t"]: r["dt"] for r in rows.select("t", S.parse_datetime_any(F.col("t")).alias("dt")).collect()}
    with warnings.catch_warnings():
        warnings.simplefilter("ignore")
        assert got == {t: plain(t) for t in NOTATIONS}
        first = {r["t"]: r["dt"] for r in rows.select("t", S.parse_datetime_any(F.col("t"), day_first=True).alias("dt")).where("k in (15, 16, 17, 21, 22, 23)").collect()}
        assert first == {NOTATIONS[k]: plain(NOTATIONS[k], dayfirst=True) for k in (15, 16, 17, 21, 22, 23)}
        filled = spark.createDataFrame([(t,) for t in more], "t string").select("t", S.parse_datetime_any(F.col("t"), default=F.lit("2001-03-04").cast("date")).alias("dt"), S.parse_datetime_any(F.col("t")).alias("none")).collect()
        assert {r["t"]: r["dt"] for r in filled} == {t: plain(t, default=default) for t in more}
    assert [r["none"] for r in filled] == [None] * len(more)
