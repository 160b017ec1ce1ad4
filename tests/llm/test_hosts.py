from compare import oracle, rows

from flowspark.llm.hosts import judge, registered_parts, with_outcome
from flowspark.llm.queries import hosts


def test_query_agrees_with_sql(spark, sf):
    df = hosts.query(spark, sf)
    rel = oracle(sf).sql(hosts.SQL)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(rel.columns, rel.fetchall())


def _pages(spark, urls):
    return spark.createDataFrame([(k, u, "mine") for k, u in enumerate(urls)], "page_id long, url string, verdict string")


def test_parts_and_rules(spark):
    urls = [
        "http://WWW.Example.ORG/en/12?x#y", "https://example.org/es/", "ftp://a.com/de/x", "http://xcom/de/", "http://org?x", "http://org/",
        "no host", None, "", "http://", "a://b://c/d", "http://sub.example.org/es", "http://Ä.com/fr/é",
    ]
    got = [(r["host"], r["path"], r["rule"]) for r in judge(_pages(spark, urls), _labels(spark, [])).orderBy("page_id").collect()]
    assert got == [
        ("www.example.org", "/en/12", "example.org/en/1"), ("example.org", "/es/", "example.org/es/"), ("a.com", "/de/x", "com/de/"),
        ("xcom", "/de/", None), ("org", "", None), ("org", "/", "org/"), ("", "", None), ("", "", None), ("", "", None), ("", "", None),
        ("b:", "//c/d", None), ("sub.example.org", "/es", "org/"), ("Ä.com", "/fr/é", "com/fr/"),
    ]


def _labels(spark, rows):
    return spark.createDataFrame(rows, "page_id long, good boolean")


def test_hosts_shrink_to_their_domain(spark):
    urls = [f"http://good.site.net/{k}" for k in range(60)] + [f"http://bad.spam.net/{k}" for k in range(60)] + [
        "http://new.site.net/", "http://new.spam.net/", "http://one.spam.net/"
    ]
    labels = [(k, k < 60) for k in range(120)] + [(122, True), (None, True), (5, None)]
    found = {r["host"]: r for r in judge(_pages(spark, urls), _labels(spark, labels)).collect()}
    assert found["good.site.net"]["verdict"] == "allow" and found["bad.spam.net"]["verdict"] == "block"
    assert found["new.spam.net"]["bound"] < found["one.spam.net"]["bound"] < found["good.site.net"]["bound"]
    assert found["new.spam.net"]["bound"] < found["new.site.net"]["bound"]


def test_empty_tables_and_long_suffixes(spark):
    assert judge(_pages(spark, []).limit(0), _labels(spark, [])).count() == 0
    assert {r["verdict"] for r in judge(_pages(spark, ["http://x.net/"]), _labels(spark, [])).collect()} == {"block"}
    from pyspark.sql import functions as F

    row = spark.createDataFrame([("a.b.co.uk",)], "h string").select(*registered_parts(F.col("h"), ["co.uk"])).first()
    assert tuple(row) == ("b.co.uk", "co.uk")


def test_outcomes_come_from_the_pages(spark):
    prose = " ".join(f"word{k}" for k in range(60))
    cases = [
        (f"<html><head><title>{'# ' * 90}</title></head><body><!-- {'$ ' * 90} --><nav>a > b</nav><p>{prose}</p></body>", True),
        (f"<p>{' '.join(prose.split()[:49])}</p><script>var a = '{prose}';</script>", False), (f"<p>{prose}{' &amp;' * 20}</p>", False),
        (f"<p>{prose}{' &amp;' * 15}</p>", True), (f"<p>{'buy cheap pills now ' * 40}</p>", False), (None, None), ("", False), (prose + " <p", True),
    ]
    table = spark.createDataFrame([(k, h, "x") for k, (h, _) in enumerate(cases)], "page_id long, html string, n string")
    assert [r["ok"] for r in with_outcome(table, "ok").orderBy("page_id").collect()] == [ok for _, ok in cases]
    pages = spark.createDataFrame(
        [(k, f"http://{'good' if k % 2 else 'spam'}.net/{k}", f"<p>{prose if k % 2 else 'win now ' * 50}</p>") for k in range(80)] + [(80, None, None)],
        "page_id long, url string, html string",
    )
    found = {r["host"]: r["verdict"] for r in judge(pages).collect()}
    assert found["good.net"] == "allow" and found["spam.net"] == "block" and len(found) == 3
