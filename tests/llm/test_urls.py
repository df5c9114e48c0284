from matchlake.llm import urls


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    n = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, after = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:n]), rest[n:]
    path = after[: min([after.find(c) for c in "?#" if c in after], default=len(after))]
    fit = [(len(h + p), len(h), h + p, a) for a, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=None)
    return host, path, best and best[2], best[3] if best else "allow"


def test_judge_equals_brute_force(spark):
    given = [None, "", "no scheme", "http://COM/en/", "https://a.example.com/en/7198#x", "http://example.com/en/8", "http://xexample.com/en/7", "ftp://b.example.net/de/80?x=/de/",
             "http://example.net/de/9", "http://org", "http://org?/es/", "http://a.org/es/é", "http://h/://com/en/", "http://a.com/en", "http://.com/en/x", "http://É.COM/en/"]
    pages = spark.createDataFrame([(i, u, "x") for i, u in enumerate(given)] + [(1, "", "y")], "page_id long, url string, host string")
    rows = urls.judge(pages).collect()
    assert len(rows) == len(given) + 1
    for r in rows:
        assert tuple(r)[1:] == brute(given[r["page_id"]]), given[r["page_id"]]


def test_other_columns_and_empty_rule_parts(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x", "http://b/"), (2, None, "http://c/")], "id long, link string, url string")
    rules = (("block", "", "/x"), ("allow", "a.com", ""), ("block", "", ""), ("allow", "a.com", "nosuch"))
    got = [tuple(r) for r in urls.judge(pages, rules, id_col="id", url_col="link").orderBy("id").collect()]
    assert got == [(1, "a.com", "/x", "a.com", "allow"), (2, "", "", "", "block")]


def test_cascade_is_exact_over_its_universe(spark, monkeypatch):
    monkeypatch.setattr(urls, "BITS_PER_KEY", 2)  # many false positives, so several levels
    universe = spark.range(4000).selectExpr("cast(id AS string) AS key")
    listed = universe.where("cast(key AS int) % 3 = 0")
    cascade = urls.Cascade(spark, listed, universe)
    assert len(cascade.levels) > 2
    hashed = universe.selectExpr("key", "xxhash64(key, 1) AS h", "xxhash64(key, 2) AS g").toPandas()
    got = urls.Cascade.contains(cascade.levels, hashed["h"].to_numpy(), hashed["g"].to_numpy())
    assert (got == (hashed["key"].astype(int) % 3 == 0)).all()


def test_empty_tables(spark):
    assert urls.judge(spark.createDataFrame([], "page_id long, url string")).collect() == []
    assert urls.judge(spark.createDataFrame([(1, "http://com/en/")], "page_id long, url string"), rules=()).first()["verdict"] == "allow"
