from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from boreline.llm import urlfilter


def at(hour, day=1):
    return datetime(2024, 1, day, hour)


def judged(spark, captures, entries):
    a = spark.createDataFrame([(*c, "x", "x") for c in captures], "page_id bigint, url string, fetched_at timestamp, target string, slot string")
    b = spark.createDataFrame([(*e, "x") for e in entries], "target string, at timestamp, listed boolean, rank string")
    return {r.page_id: (r.blocked, r.matched, r.listed_since, r.active) for r in urlfilter.judge(a, b).collect()}


LIST = [("bad.com", at(5), True), ("bad.com", at(9, 3), False), ("bad.com", at(9, 20), True), ("ok.org/ads/", at(1), True), ("sub.bad.com", at(7), True), ("both.net", at(5), True), ("both.net", at(5), False), (None, at(1), True), ("x.com", None, True), ("y.com", at(1), None)]
CASES = [
    ((1, "http://bad.com/a", at(4)), (False, None, None, 0)),
    ((2, "http://bad.com/a", at(5)), (True, "bad.com", at(5), 1)),
    ((3, "https://u:p@WWW.bad.COM:80/a", at(9, 2)), (True, "bad.com", at(5), 1)),
    ((4, "http://bad.com", at(9, 3)), (False, None, None, 0)),
    ((5, "http://bad.com", at(0, 28)), (True, "bad.com", at(9, 20), 1)),
    ((6, "http://sub.bad.com/", at(8)), (True, "sub.bad.com", at(7), 2)),
    ((7, "http://ok.org/ads/1", at(8)), (True, "ok.org/ads/", at(1), 1)),
    ((8, "http://ok.org/adsense", at(8)), (False, None, None, 0)),
    ((9, None, at(8)), (False, None, None, 0)),
    ((10, "no url", at(8)), (False, None, None, 0)),
    ((11, "http://bad.com", None), (False, None, None, 0)),
    ((12, "http://both.net./", at(6)), (True, "both.net", at(5), 1)),
    ((13, "http://notbad.com", at(6)), (False, None, None, 0)),
    ((None, "http://bad.com", at(6)), (True, "bad.com", at(5), 1)),
]


def test_entries_hold_from_their_date_to_the_next(spark):
    assert judged(spark, [c for c, _ in CASES] + [CASES[1][0]], LIST) == {c[0]: want for c, want in CASES}


def test_empty_tables(spark):
    assert judged(spark, [], LIST) == {}
    assert judged(spark, [CASES[1][0]], []) == {2: (False, None, None, 0)}


def test_intervals(spark):
    df = spark.createDataFrame([r for r in LIST if None not in r], "target string, at timestamp, listed boolean")
    got = {(r.target, r.valid_from): (r.listed, r.valid_to) for r in urlfilter.intervals(df).collect()}
    assert got["bad.com", at(5)] == (True, at(9, 3)) and got["bad.com", at(9, 20)] == (True, None) and got["both.net", at(5)] == (True, None)


URLS = [("http://a.b.c.d/x/y/z/w?q#f", ["a.b.c.d/x/y/z/w", "a.b.c.d/x/y/z/", "a.b.c.d/x/y/", "a.b.c.d/x/", "a.b.c.d", "b.c.d", "c.d"]), ("HTTP://A.b", ["a.b/", "a.b"]), ("http:///x", []), ("", [])]


@pytest.mark.parametrize(("url", "want"), URLS)
def test_targets(spark, url, want):
    def asked(slashes, labels):
        depths = spark.range(1).select(F.lit(slashes).cast("array<int>").alias("slashes"), F.lit(labels).cast("array<int>").alias("labels"))
        found = urlfilter.asked_targets(spark.range(1).select(F.lit(url).alias("url")), depths, "url").collect()
        return [r.target for r in sorted(found, key=lambda r: r.rank or 0) if r.target is not None]

    assert asked(list(range(20)), list(range(20))) == want
    assert asked([2], [3]) == [t for t in want if t.count("/") == 2 or ("/" not in t and t.count(".") == 2)]


def test_deep_entries_and_hosts(spark):
    """Prefixes of any length and parents of any host, against every way to cut a URL."""
    path = "/".join(f"s{k}" for k in range(12))
    host = ".".join(f"h{k}" for k in range(9)) + ".example.com"
    entries = [(f"deep.org/{path}/", at(1), True), ("deep.org/s0/s1/s2/s3/", at(2), True), ("example.com", at(1), True), ("com", at(1), True), ("h3.h4.h5.h6.h7.h8.example.com", at(1), True)]
    captures = [(1, f"http://deep.org/{path}/x.html", at(3)), (2, "http://deep.org/s0/s1/s2/s3/e.html", at(3)), (3, f"http://{host}/", at(3)), (4, "http://deep.org/s0/s1/s2/s3", at(3)), (5, "http://deep.org/" + "a/" * 3_000, at(3))]
    assert judged(spark, captures, entries) == {
        1: (True, entries[0][0], at(1), 2), 2: (True, entries[1][0], at(2), 1), 3: (True, entries[4][0], at(1), 2), 4: (False, None, None, 0), 5: (False, None, None, 0),
    }


def test_other_keys_and_clashing_columns(spark):
    rows = [("a", "http://bad.com/x", at(6)), ("a", "http://bad.com/x", at(6)), (None, "http://bad.com/x", at(6)), ("b", "http://fine.com", at(6))]
    captures = spark.createDataFrame(rows, "page_id string, url string, fetched_at timestamp").withColumns({c: F.lit("x") for c in "key rank slashes labels at match target active blocked _host".split()})
    entries = spark.createDataFrame(LIST, "target string, at timestamp, listed boolean").withColumns({c: F.lit("x") for c in "slot key slashes valid_to".split()})
    assert {r.page_id: (r.blocked, r.active) for r in urlfilter.judge(captures, entries).collect()} == {"a": (True, 1), None: (True, 1), "b": (False, 0)}
