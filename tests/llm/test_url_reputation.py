"""Rules, host parsing, shrinkage; the query itself is checked against SQL."""

from ledgerlens.llm import url_reputation as U
from ledgerlens.llm.catalog import URL_RULES


def judged(spark, urls, outcomes=()):
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    seen = spark.createDataFrame(list(outcomes), "host string, good boolean")
    return {r["page_id"]: r for r in U.judge(pages, seen, URL_RULES).collect()}


def test_host_path_and_rules(spark):
    urls = ["http://A.Example.ORG/en/1?x", "https://example.org/en/2", "http://badexample.org/es/x",
            "http://x.example.org/es/", "ftp://a.com/fr/1#y", "http://a.com/de/", "http://com/de/2",
            "http://a.net/de/2", "http://a.org", "http://ÄB.net?q=/de/", None, "no scheme", "://"]
    got = judged(spark, urls)
    seen = [(got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"])
            for i in range(len(urls))]
    assert seen == [
        ("a.example.org", "/en/1", "example.org/en/1", "block"),
        ("example.org", "/en/2", "org/", "allow"),
        ("badexample.org", "/es/x", "org/", "allow"),
        ("x.example.org", "/es/", "example.org/es/", "block"),
        ("a.com", "/fr/1", "com/fr/", "allow"), ("a.com", "/de/", "com/de/", "block"),
        ("com", "/de/2", "com/de/", "block"), ("a.net", "/de/2", None, "allow"),
        ("a.org", "", None, "allow"), ("Äb.net", "", None, "allow"),
        ("", "", None, "allow"), ("", "", None, "allow"), ("", "", None, "allow")]


def test_reputation_shrinks_and_blocks(spark):
    outcomes = ([("bad.spam.net", False)] * 40 + [("new.spam.net", None)]
                + [("also.spam.net", False)] * 30 + [("one.fine.net", False)]
                + [("two.fine.net", True)] * 60 + [("a.good.com", True)] * 80)
    rows = {r["host"]: r for r in
            U.reputation(spark.createDataFrame(outcomes, "host string, good boolean")).collect()}
    assert rows["bad.spam.net"]["verdict"] == "block"
    assert rows["new.spam.net"]["verdict"] == "block"       # nothing but its domain is known
    assert rows["one.fine.net"]["verdict"] == "allow"       # one bad page does not decide
    assert rows["a.good.com"]["verdict"] == "allow"
    assert (rows["bad.spam.net"]["labelled"], rows["bad.spam.net"]["good"]) == (40, 0)


def test_without_labels_or_rows(spark):
    got = judged(spark, ["http://a.net/x", "http://a.net/x"], [("a.net", None)])
    assert {r["verdict"] for r in got.values()} == {"allow"} and len(got) == 2
    assert judged(spark, ["http://a.net/x"])[0]["verdict"] == "allow"
    pages = spark.createDataFrame([], "page_id long, url string")
    assert U.judge(pages, spark.createDataFrame([], "host string, good boolean"),
                   URL_RULES).count() == 0


def test_third_level_names(spark):
    df = spark.createDataFrame([("www.a.co.uk",), ("a.b.com:8080",), ("localhost",), ("",)],
                               "host string")
    got = {r["host"]: (r["suffix"], r["domain"]) for r in U._levels(df).collect()}
    assert got == {"www.a.co.uk": ("co.uk", "a.co.uk"), "a.b.com:8080": ("com", "b.com"),
                   "localhost": ("localhost", "localhost"), "": ("", "")}
