import pytest
from pyspark.sql import functions as F

from tidemark.functions import dates as DT
from tidemark.functions import decode as D
from tidemark.functions.fixed import CODED


def values(spark, rows, expr, kind="string"):
    df = spark.createDataFrame([(i, r) for i, r in enumerate(rows)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def test_levels_of_codes(spark):
    rows = ["0", "1", "2", "3", None, "4", " 1 ", "1.0", "", "x", "1e999", "NaN", "-0"]
    assert values(spark, rows, D.level) == ["allowed", "prohibited", "restricted", "unknown", "na", "na", "prohibited", "prohibited", "na", "na", "na", "na", "allowed"]


def test_numbers_and_text(spark):
    rows = ["1.5", " 2 ", "1d", "inf", "NaN", "", None, "1e999", ".5", "+3", "0x1"]
    assert values(spark, rows, D.safe_number) == [1.5, 2.0, None, None, None, None, None, None, 0.5, 3.0, None]
    assert values(spark, ["\t a \n", "﻿b", " \n", None], D.safe_string) == ["a", "b", None, None]


def test_whole_numbers_without_a_pattern(spark):
    rows = ["7", "-7", "-0", "007", "+7", "2147483647", "2147483648", "-2147483648", "1 2", "7.", "\x017", "7\u2003"]
    want = [7.0, -7.0, -0.0, 7.0, 7.0, 2147483647.0, 2147483648.0, -2147483648.0, None, 7.0, None, 7.0]
    assert list(map(repr, values(spark, rows, D.safe_number))) == list(map(repr, want))
    assert values(spark, [7.0, 7.5, float("nan"), float("inf")], D.safe_number, "double") == [7.0, 7.5, None, None]


@pytest.mark.parametrize(
    ("f", "rows", "want"),
    [
        (D.category_text, ["Vessel Restricted Area", "vessel restricted area", None, "Other"], ["6", "unknown", "unknown", "10"]),
        (D.wdpa_id, ["0", " ", "555542441; 555637321", "102534_B", None], [None, None, "555542441; 555637321", "102534_B", None]),
        (D.iucn, ["Unassigned", "Unassigned; VI", "II", None], [None, "Unassigned; VI", "II", None]),
        (D.tribal, ["0", "1", "2", None], [True, False, None, None]),
        (D.clean_text, ["a <BR> b<br/>c", "x \t<br />y ", "<br>", None, " "], ["a\n b\nc", "x\ny", "", None, None]),
        (D.removed, ["Removed", "REMOVED", "active", None], [True, True, False, False]),
        (D.high_seas, ["High Seas / International", "high seas / international", None], [True, False, False]),
        (lambda c: D.has_token(c, ("HighSeas",)), ["a_HighSeas_1", "HighSeasX", "", None], [True, False, False, False]),
        (DT.normalize_date, ["2026-05-28", "052826", "2026-02-30", "133126", "x", None, " 2026-05-28\t"], ["2026-05-28", "2026-05-28", None, None, None, None, "2026-05-28"]),
        (DT.page_date, ["Navigator_AllSites_052826_x Last update: 05-30-2026", "2026-05-28T00:00:00Z", "Last update: 04-01-2026", None], ["2026-05-30", None, "2026-04-01", None]),
    ],
)
def test_scalars(spark, f, rows, want):
    got = values(spark, rows, f)
    assert [str(x) if hasattr(x, "isoformat") else x for x in got] == want


def test_coarse_levels_and_unpivot(spark):
    codes = dict.fromkeys(CODED) | {"anchoring": "3", "dredging": "2", "dredging_dumping": "1", "artisanal_fishing": "0", "nets": "2", "removal_of_historic_artifacts": "1"}
    df = spark.createDataFrame([("a", *codes.values())], "id string, " + ", ".join(f"{c} string" for c in CODED))
    r = D.ranked(df)
    c = r.select(D.coarse().alias("x")).head()["x"].asDict()
    assert (c["anchoring"], c["dredging"], c["fishingArtisanal"], c["fishing"], c["entry"], c["removalOfArtifacts"]) == ("unknown", "prohibited", "allowed", "restricted", "na", "prohibited")
    long = {x["activity"]: x["level"] for x in D.unpivot_levels(r, ["id"]).collect()}
    assert len(long) == 43 and long["dredging_dumping"] == "prohibited" and long == r.select(D.raw_levels().alias("m")).head()["m"]


def test_freshness_and_days(spark):
    df = spark.sql("select * from values (null, date'2024-01-01'), (date'2024-01-02', null), (date'2024-01-02', date'2024-01-02'), (date'2024-01-03', date'2024-01-02') as t(u, p)")
    assert [r[0] for r in df.select(DT.is_newer(F.col("u"), F.col("p"))).collect()] == [False, True, False, True]
    assert [r[0] for r in df.select(DT.days_between(F.col("p"), F.col("u"))).collect()] == [DT.NEVER, DT.NEVER, 0, 1]


def test_trimming_takes_what_the_pattern_of_white_space_takes_without_a_pattern(spark, capsys):
    points = [i for i in range(1, 0x10000) if not 0xD800 <= i < 0xE000]
    df = spark.createDataFrame([(f"{chr(i)}a{chr(i)}b{chr(i)}",) for i in points], "x string")
    pattern = F.regexp_replace("x", r"(?U)^[\s\x{FEFF}]+|[\s\x{FEFF}]+$", "")
    assert not df.where(~D.trimmed(F.col("x")).eqNullSafe(pattern)).count()
    df.select(D.trimmed(F.col("x"))).explain()
    assert "regexp" not in capsys.readouterr().out


def test_summary_of_parts_that_are_absent_or_only_markup(spark):
    df = spark.createDataFrame([(1, None, " ", None), (2, "<br>", None, None), (3, "a<br/>b", None, " c ")], "i int, x string, y string, z string")
    got = [r["s"] for r in df.select("i", D.summary(*map(F.col, "xyz")).alias("s")).orderBy("i").collect()]
    assert got == [None, "", "a\nb\n\nc"]
