from tidemark.llm.queries import LISTED, ORACLES, QUERIES, URL_RULES
from tidemark.llm.urls import allowed, judge
from tests import oracle

ROWS = [
    (1, "http://Blog.Example.ORG/es/1?x"), (2, "https://example.org/es"), (3, "x://example.org/en/12#a"), (4, "http://a.com/fr/"),
    (5, "http://a.com/fr"), (6, "http://a.com/de/9"), (7, "http://acom/de/9"), (8, "http://org"), (9, "http://org/"), (10, "no url"),
    (11, None), (12, ""), (13, "http://"), (14, "http://adult-x.example.net"), (15, "http://m.adult-x.example.net/q"),
    (16, "http://xadult-x.example.net/q"), (17, "http://a.com?/de/"), (18, "a://b://c.com/de/"), (19, "http://ÀB.com/de/é"),
    (1, "http://Blog.Example.ORG/es/1?x"), (None, "http://t.org/x"),
]


def brute(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url[url.index("://") + 3 :]
    n = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:n])
    path = rest[n:].split("?")[0].split("#")[0]
    def fits(r):
        return ("." + host).endswith("." + r.split("/")[0]) and path.startswith(r[r.index("/") :] if "/" in r else "")

    rules = sorted((len(r), r, v) for v, r in URL_RULES if fits(r))
    if rules:
        return host, path, rules[-1][1], rules[-1][2]
    return host, path, None, "block" if any(fits(r) for r in LISTED) else "allow"


def test_against_brute_force(spark):
    pages = spark.createDataFrame([(k, u, "h") for k, u in ROWS], "page_id long, url string, host string")
    got = judge(pages, URL_RULES, LISTED).select("page_id", "host", "path", "rule", "verdict").collect()
    assert sorted(map(tuple, got), key=str) == sorted(((k, *brute(u)) for k, u in ROWS), key=str)
    kept = allowed(pages, URL_RULES, LISTED)
    assert kept.schema == pages.schema
    assert sorted(kept.select("page_id", "url").collect(), key=str) == sorted([r for r in ROWS if brute(r[1])[3] == "allow"], key=str)
    assert judge(pages.limit(0), URL_RULES, LISTED).collect() == []


def test_a_listed_host_needs_no_path(spark):
    urls = ["http://free-bets.example.com", "http://free-bets.example.com?x", "http://a.free-bets.example.com#y", "http://free-bets.example.com/", "http://bets.example.com"]
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(urls)], "page_id long, url string")
    assert [r.verdict for r in judge(pages, [], LISTED).orderBy("page_id").collect()] == ["block"] * 4 + ["allow"]
    assert [r.verdict for r in judge(pages, [], ["free-bets.example.com/"]).orderBy("page_id").collect()] == ["allow"] * 3 + ["block", "allow"]


def test_a_million_entries(tmp_path):
    from tidemark.llm.urls import Index, digest_array

    path = tmp_path / "index"
    path.write_bytes(digest_array([], [f"h{i}.example.org" for i in range(1_000_000)]))
    found = Index(str(path)).find([f"h{i}.example.org" for i in range(0, 2_000_000, 1000)])
    assert sorted(found) == sorted(f"h{i}.example.org" for i in range(0, 1_000_000, 1000))


def test_a_cut_file_is_written_anew(spark):
    """What a driver lost while writing may leave under the name is not read."""
    import hashlib

    from tidemark.llm.urls import digest_array
    from tidemark.session import shared_root

    raw = digest_array([], ["cut.example.org"])
    name = f"url-index-{hashlib.sha256(raw).hexdigest()[:20]}"
    import os

    os.makedirs(f"{shared_root(spark)}/tidemark", exist_ok=True)
    with open(f"{shared_root(spark)}/tidemark/{name}", "wb") as file:
        file.write(raw[:10])
    pages = spark.createDataFrame([(1, "http://cut.example.org")], "page_id long, url string")
    assert [r.verdict for r in judge(pages, [], ["cut.example.org"]).collect()] == ["block"]


def test_no_rules(spark):
    pages = spark.createDataFrame(ROWS, "page_id long, url string")
    assert {r.verdict for r in judge(pages, [], []).collect()} == {"allow"}


def test_colliding_keys_do_no_harm(spark, monkeypatch):
    import xxhash

    from tidemark.llm.urls import Index, digest_array

    monkeypatch.setattr(xxhash, "xxh64_intdigest", lambda x: 7)
    import tempfile

    with tempfile.NamedTemporaryFile(delete=False) as file:
        file.write(digest_array([("block", "a.com/"), ("allow", "b.com/x")], ["c.com/"]))
    assert {h: [e[4] for e in v] for h, v in Index(file.name).find(["a.com", "b.com", "d.com"]).items()} == {"a.com": ["a.com/"], "b.com": ["b.com/x"]}


def test_query(spark, small):
    name = "op5_url_filter"
    got = QUERIES[name](spark, small).select("page_id", "host", "path", "rule", "verdict")
    want = [(r.page_id, *brute(r.url)) for r in spark.read.parquet(f"{small}/pages.parquet").select("page_id", "url").collect()]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    sql = oracle.fetch(oracle.connect(small), ORACLES[name])
    assert oracle.compare(name, QUERIES[name](spark, small).toArrow(), sql) == []
