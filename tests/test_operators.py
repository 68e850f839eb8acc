import json

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from feedloom.operators import dedup
from feedloom.operators.validate import validate_responses
from feedloom.sources import feeds
from feedloom.functions.times import format_iso, parse_date

ATOM = """<?xml version="1.0"?><feed xmlns="http://www.w3.org/2005/Atom" xmlns:arxiv="http://arxiv.org/schemas/atom">
<entry><id>http://arxiv.org/abs/1907.00042v3</id><published>2019-07-01T06:30:00Z</published>
<title> Tide tables
   from buoys </title><summary>Data and code: https://github.com/tidal-lab/buoys.</summary>
<author><name>Mira Oss</name></author><author><name> </name></author><author><name>Jon Vale</name></author></entry>
<entry><id>http://arxiv.org/abs/2001.54321v1</id><published>2020-01-15T00:00:00Z</published><title>Salt</title>
<summary>A survey.</summary><arxiv:comment>see https://github.com/topics/salt</arxiv:comment></entry>
<entry><title>without an id</title></entry></feed>"""


def test_paper_feed_golden(spark):
    from feedloom.functions.extract import repo_link
    docs = spark.createDataFrame([(0, ATOM)], "feed_id long, body string")
    e = feeds.atom_paper_entries(docs, keep=["feed_id"]).withColumn("github_url", repo_link("search_text"))
    rows = e.orderBy("pos").collect()
    assert [(r.title, list(r.authors), r.paper_url, r.github_url) for r in rows] == [
        ("Tide tables from buoys", ["Mira Oss", "Jon Vale"], "https://arxiv.org/abs/1907.00042v3",
         "https://github.com/tidal-lab/buoys"),
        ("Salt", [], "https://arxiv.org/abs/2001.54321v1", None)]


def test_same_entry_twice_gives_one_record(spark):
    entry = ATOM[ATOM.index("<entry>"):ATOM.index("</entry>") + len("</entry>")]
    docs = spark.createDataFrame([(0, f'<feed xmlns="http://www.w3.org/2005/Atom">{entry}{entry}</feed>')], "feed_id long, body string")
    e = feeds.atom_paper_entries(docs, keep=["feed_id"])
    e = e.withColumn("t", parse_date("published_raw", "2024-01-21 00:00:00"))
    out = dedup.overfetch_dedup_limit(e, "feed_id", [F.col("t").desc(), F.col("paper_url"), F.col("pos")],
                                      "paper_url", 10)
    assert out.count() == 1


def test_links_items_and_rejects(spark):
    bodies = [
        '<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>Oak & ash</title><link rel="alternate" href="https://n/1"/>'
        '<link rel="edit" href="https://n/edit/1"/></entry><entry><title>two</title><link>https://n/2</link></entry></feed>',
        '<rdf:RDF xmlns:rdf="x"><channel><title>c</title></channel><item><title>r</title><link>https://r/1</link>'
        "<content:encoded><![CDATA[<b>e</b>]]></content:encoded></item><item><guid>4</guid></item></rdf:RDF>",
        "", None, "<html>moved</html>", "<rss><channel><!-- <item><title>no</title></item> --><item><title>t</title></item></channel></rss>"]
    docs = spark.createDataFrame([(i, "https://feed", b) for i, b in enumerate(bodies)], "feed_id long, source_url string, body string")
    got = sorted((r.feed_id, r.pos, r.title, r.url, r.body_html) for r in feeds.feed_items(docs, keep=["feed_id"]).collect())
    assert got == [(0, 0, "Oak & ash", "https://n/1", "Oak & ash"), (0, 1, "two", "https://n/2", "two"),
                   (1, 0, "r", "https://r/1", "<b>e</b>"), (5, 0, "t", "https://feed", "t")]
    lost = sorted((r.feed_id, r.pos, r.reason) for r in feeds.feed_rejects(docs, keep=["feed_id"]).collect())
    assert lost == [(1, 1, "unreadable_item"), (2, None, "empty_document"), (3, None, "empty_document"), (4, None, "no_items")]


def _read(spark, *bodies):
    docs = spark.createDataFrame([(i, "https://feed", b) for i, b in enumerate(bodies)], "feed_id long, source_url string, body string")
    return [(r.feed_id, r.pos, r.title, r.url, r.body_html) for r in feeds.feed_items(docs, keep=["feed_id"]).orderBy("feed_id", "pos").collect()]


def test_cdata_is_text_as_it_stands(spark):
    got = _read(spark, "<rss><item><title><![CDATA[R&D Lead at A&B]]></title><link><![CDATA[http://x/9?a=1&b=2]]></link>"
                       "<description><![CDATA[<p>x &amp; y</p><!-- kept --><item><title>quoted</title></item>]]></description></item></rss>")
    assert got == [(0, 0, "R&D Lead at A&B", "http://x/9?a=1&b=2", "<p>x &amp; y</p><!-- kept --><item><title>quoted</title></item>")]


def test_entities_and_stray_signs(spark):
    got = _read(spark, "<rss><item><title>Caf&eacute; A&nbsp;B &#8212; &#x41; &unknown; &amp;lt; 1 < 2 & 3<4</title><link>http://x/?q=1&copy=2&amp;r=3</link></item></rss>",
                "<rss><item><title>bad &#0; &#xD800; &#99999999;</title></item></rss>")
    assert got == [(0, 0, "Café A\u00a0B — A &unknown; &lt; 1 < 2 & 3<4", "http://x/?q=1&copy=2&r=3", "Café A\u00a0B — A &unknown; &lt; 1 < 2 & 3<4"),
                   (1, 0, "bad � � �", "https://feed", "bad � � �")]


def test_damaged_markup_is_recovered(spark):
    got = _read(spark, "<rss><item><title>one</b><link>http://1</link><item><title>two</title><description>cut <b>off</b",
                "<rss><item><title>a</title></channel></item><item><title>b</title><guid>1</item><item><title>c</title></item></rss>",
                "<feed><entry><source><title/></source><media:title>m</media:title><title>own</title><link href='http://e/1?x=1&amp;y=2' rel=\"a>b\"/></entry></feed>",
                "<rss><ITEM><title>no</title></ITEM><item/><item><title>yes</title><![CDATA[stray]]></item></rss>")
    assert [r[:4] for r in got] == [(0, 0, "onehttp://1", "http://1"), (0, 1, "two", "https://feed"), (1, 0, "a", "https://feed"), (1, 1, "b", "https://feed"),
                                    (1, 2, "c", "https://feed"), (2, 0, "", "http://e/1?x=1&y=2"), (3, 1, "yes", "https://feed")]
    assert got[1][4] == "cut off</b"


def test_markup_within_a_field(spark):
    got = _read(spark, "<feed><entry><title>t</title><summary type='xhtml'><div>a <b>bold</b> word</div></summary></entry></feed>")
    assert got[0][4] == "a bold word"


def test_paper_feeds_with_damage(spark):
    docs = spark.createDataFrame([(0, ATOM.replace("Salt", "Salt & <water> &eacute;")), (1, "<feed><entry><id> </id></entry></feed>"), (2, " "), (3, "<error/>"), (4, None)],
                                 "feed_id long, body string")
    e = feeds.atom_paper_entries(docs, keep=["feed_id"]).orderBy("pos").collect()
    assert [(r.feed_id, r.pos, r.title) for r in e] == [(0, 0, "Tide tables from buoys"), (0, 1, "Salt & é")]
    lost = sorted((r.feed_id, r.pos, r.reason) for r in feeds.paper_rejects(docs, keep=["feed_id"]).collect())
    assert lost == [(0, 2, "unreadable_item"), (1, 0, "unreadable_item"), (2, None, "empty_document"), (3, None, "no_items"), (4, None, "empty_document")]


def test_json_rejects_and_what_is_kept(spark):
    bodies = ['{"jobs": [{"t": "a"}, 5, null, {"t": 7}]}', '{"jobs": []}', '{"jobs": {"t": "a"}}', "{", "", None, '{"jobs": [{"t": {"x": 1}}]}']
    docs = spark.createDataFrame(list(enumerate(bodies)), "feed_id long, body string")
    kept = sorted((r.feed_id, r.pos, r.e.t) for r in feeds.json_array_entries(docs, "t:string", path="jobs", keep=["feed_id"]).collect())
    assert kept == [(0, 0, "a"), (0, 3, "7"), (6, 0, '{"x":1}')]
    lost = sorted((r.feed_id, -1 if r.pos is None else r.pos, r.reason) for r in feeds.json_rejects(docs, path="jobs", keep=["feed_id"]).collect())
    assert lost == [(0, 1, "unreadable_item"), (0, 2, "unreadable_item"), (1, -1, "no_items"), (2, -1, "no_items"), (3, -1, "unreadable_document"), (4, -1, "empty_document"), (5, -1, "empty_document")]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["<item>", "</item>", "<title>", "</title>", "<![CDATA[", "]]>", "<!--", "-->", "&amp;", "&", "<", ">", "x", "<link href='u'/>", "<a b=\"", "é"]), max_size=30).map("".join))
def test_any_document_is_read(text):
    from feedloom.sources.xml_items import scan
    found = scan(text, ("item",), frozenset(["title", "link"]))
    assert all(isinstance(e.text, str) for item in found["item"] for e in item)


def test_malformed_feed_gives_no_rows(spark):
    docs = spark.createDataFrame([(0, "<feed><entry>"), (1, None)], "feed_id long, body string")
    assert feeds.atom_paper_entries(docs, keep=["feed_id"]).count() == 0
    assert feeds.feed_items(docs.withColumn("source_url", F.lit("u")), keep=["feed_id"]).count() == 0


def test_rss_chains(spark):
    rss = ("<rss><channel><item><title>ML Engineer at OpenAI</title><link>https://j/1</link>"
           "<pubDate>Mon, 22 Jan 2024 10:00:00 GMT</pubDate><description>d</description></item>"
           "<item><title>t2</title><updated>2024-01-22T09:00:00Z</updated><summary>s</summary></item>"
           "</channel></rss>")
    docs = spark.createDataFrame([(0, "https://feed", rss)], "feed_id long, source_url string, body string")
    rows = feeds.feed_items(docs, keep=["feed_id"]).orderBy("pos").collect()
    assert [(r.url, r.date_raw, r.body_html) for r in rows] == [
        ("https://j/1", "Mon, 22 Jan 2024 10:00:00 GMT", "d"), ("https://feed", "2024-01-22T09:00:00Z", "s")]


def test_first_wins_order_and_uniqueness(spark):
    rows = [("k1", 2, 0, "late"), ("k1", 1, 5, "early"), ("k2", 3, 1, "only"), ("k1", 1, 6, "later")]
    df = spark.createDataFrame(rows, "k string, prio int, pos int, v string")
    out = {r.k: r.v for r in dedup.first_wins(df, "k", ["prio", "pos"]).collect()}
    assert out == {"k1": "early", "k2": "only"}


def test_new_only_and_ledger(spark):
    f = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3), ("c", 4)], "key string, id int")
    led = spark.createDataFrame([("a",)], "key string")
    assert sorted(r.key for r in dedup.new_only(f, led, "key").collect()) == ["b", "b", "c"]
    adds = dedup.ledger_additions(f, led, "key", extra=["id"]).collect()
    assert sorted((r.key, r.id) for r in adds) == [("b", 2), ("c", 4)]


def test_priority_fill(spark):
    df = spark.createDataFrame([("x", 1, 0), ("y", 1, 1), ("x", 2, 0), ("z", 2, 1), ("w", 3, 0)],
                               "k string, p int, pos int")
    assert [r.k for r in dedup.priority_fill(df, "k", ["p", "pos"], 3).collect()] == ["x", "y", "z"]


def test_pages_before_first_bad(spark):
    pages = spark.createDataFrame([(1, 1, True), (1, 2, True), (1, 3, False), (1, 4, True), (2, 1, True)],
                                  "q int, page int, ok boolean")
    kept = sorted((r.q, r.page) for r in feeds.pages_before_first_bad(pages, ["q"]).collect())
    assert kept == [(1, 1), (1, 2), (2, 1)]


def test_validation_golden(spark):
    paper = {"schemaVersion": "1.0", "recordType": "RESEARCH_PAPER"}
    paper_content = {"title": "T", "authors": ["A"], "paper_url": "https://arxiv.org/abs/1", "github_url": None,
                     "github_stars": None, "published_date": "2024-01-01T00:00:00+00:00"}
    rows = [(0, 1, "p", json.dumps(paper_content), None),
            (1, 1, "p", json.dumps({"startupName": "OpenAI", "pricingModel": "INVALID_PRICING_MODEL"}), None)]
    df = spark.createDataFrame(rows, "doc_id long, tier int, provider string, raw string, error string")
    assert validate_responses(df.where("doc_id = 0"), "RESEARCH_PAPER").first().outcome == "ok"
    bad = validate_responses(df.where("doc_id = 1"), "PRODUCT").first()
    assert bad.outcome == "schema_invalid" and list(bad.violations) == ["type:pricingModel"]
    assert paper  # envelope keys are plain strings, not validated


def test_lax_integers_and_booleans(spark):
    ints = ["12", '" 12 "', '"3.0"', "3.0", "true", "3.5", "null"]
    df = spark.createDataFrame([(i, 1, "p", '{"entityName": "a", "employeeCount": %s}' % v, None)
                                for i, v in enumerate(ints)], "doc_id long, tier int, provider string, raw string, error string")
    got = [(r.outcome, r.employeeCount) for r in validate_responses(df, "STARTUP").orderBy("doc_id").collect()]
    assert got == [("ok", 12), ("ok", 12), ("ok", 3), ("ok", 3), ("ok", 1), ("schema_invalid", None), ("ok", None)]
    bools = ['"yes"', "1", "2", "null"]
    df = spark.createDataFrame([(i, 1, "p", '{"company": "a", "date": "d", "is_remote": %s}' % v, None)
                                for i, v in enumerate(bools)], "doc_id long, tier int, provider string, raw string, error string")
    got = [(r.outcome, r.is_remote) for r in validate_responses(df, "JOB").orderBy("doc_id").collect()]
    assert got == [("ok", True), ("ok", True), ("schema_invalid", None), ("schema_invalid", None)]


def test_csv_and_json_sinks(spark, tmp_path):
    from feedloom.sources import store
    env = store.envelope(spark.range(1), "JOB", {"company": F.lit('Acme "Q", Inc'), "date": F.lit("d"),
                                                   "is_remote": F.lit(True), "role_family": F.lit("Engineering")},
                         F.lit("s"), F.lit("u"), format_iso(F.to_timestamp(F.lit("2024-01-01 00:00:00"))))
    tab = store.tab_frame(env, "jobs")
    store.write_csv(tab, str(tmp_path / "jobs"))
    data = []
    for part in (tmp_path / "jobs").glob("*.csv"):  # one file per non-empty task
        lines = part.read_text().splitlines()
        assert lines[0] == "Company,Date,Is Remote,Role Family,Source Name,Source URL"
        data += lines[1:]
    assert data == ['"Acme ""Q"", Inc",d,True,Engineering,s,u']
    store.write_json_lines(env, str(tmp_path / "json"))
    back = spark.read.json(str(tmp_path / "json")).first()
    assert back.content.company == 'Acme "Q", Inc'


def test_source_url_rule(spark):
    from feedloom.operators.validate import split_by_source_url
    from feedloom.sources import store
    base = spark.createDataFrame([("a", "u1"), ("b", ""), ("c", None)], "n string, u string")
    env = store.envelope(base, "STARTUP", {"entityName": F.col("n"), "employeeCount": F.lit(None).cast("bigint")},
                         F.lit("s"), F.col("u"), F.lit("t"))
    ok, bad = split_by_source_url(env)
    assert [r.content.entityName for r in ok.collect()] == ["a"]
    assert sorted((r.content.entityName, list(r.violations)) for r in bad.collect()) == [
        ("b", ["missing:source.url"]), ("c", ["missing:source.url"])]


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c", "d"]), st.integers(0, 3), st.integers(0, 50)),
                min_size=1, max_size=40))
def test_first_wins_property(spark, rows):
    rows = [(k, p, i, f"{k}-{p}-{i}-{n}") for n, (k, p, i) in enumerate(rows)]
    df = spark.createDataFrame(rows, "k string, p int, i int, v string")
    got = {r.k: (r.p, r.i, r.v) for r in dedup.first_wins(df, "k", ["p", "i", "v"]).collect()}
    expect = {}
    for k, p, i, v in sorted(rows, key=lambda r: (r[1], r[2], r[3])):
        expect.setdefault(k, (p, i, v))
    assert got == expect
    assert dedup.first_wins(df, "k", ["p", "i", "v"]).count() == len({r[0] for r in rows})


def test_save_records_returns_count_and_reads_back(spark):
    from feedloom.session import scratch_path
    from feedloom.sources import store
    env = store.envelope(spark.range(5), "STARTUP", {"entityName": F.concat(F.lit("n"), F.col("id").cast("string")),
                                                     "employeeCount": F.col("id")},
                         F.lit("s"), F.lit("u"), F.lit("t"))
    path = scratch_path(spark, "t-store")
    assert store.save_records(store.to_store_rows(env, "STARTUP"), path) == 5
    back = store.read_records(spark, path, "STARTUP")
    assert sorted(r.content.entityName for r in back.collect()) == [f"n{i}" for i in range(5)]
    assert {r.record_type: r.n for r in store.count_by_type(spark, path).collect()} == {"STARTUP": 5}


def test_first_valid_by_tier_with_docs_without_attempts(spark):
    from feedloom.operators.validate import first_valid_by_tier
    rows = [(1, 1, "p1", None, "429"), (1, 2, "p2", '{"startupName": "A"}', None),
            (2, 1, "p1", "{bad", None), (2, 2, "p2", '{"startupName": "B", "pricingModel": "FREE"}', None)]
    df = spark.createDataFrame(rows, "doc_id long, tier int, provider string, raw string, error string")
    docs = spark.createDataFrame([(1,), (2,), (3,)], "doc_id long")
    got = {r.doc_id: (r.tier, r.startupName, r.pricingModel)
           for r in first_valid_by_tier(validate_responses(df, "PRODUCT"), docs, "PRODUCT").collect()}
    assert got == {1: (2, "A", None), 2: (2, "B", "FREE"), 3: (None, None, None)}


def test_scan_partitions_only_by_setting(spark):
    from feedloom.sources.io import SCAN_PARTITIONS, read_table
    path = "/root/testdata/sf0.01/documents.parquet"  # one row group
    assert read_table(spark, path).rdd.getNumPartitions() == 1
    spark.conf.set(SCAN_PARTITIONS, "3")
    try:
        assert read_table(spark, path).rdd.getNumPartitions() == 3
    finally:
        spark.conf.unset(SCAN_PARTITIONS)


def test_ledger_additions_keep_whole_rows(spark):
    f = spark.createDataFrame([("k", 2, "a"), ("k", 1, "b"), ("m", 5, "c")], "key string, n int, v string")
    led = spark.createDataFrame([("m",)], "key string")
    assert [tuple(r) for r in dedup.ledger_additions(f, led, "key", extra=["n", "v"]).collect()] == [("k", 1, "b")]
    assert [tuple(r) for r in dedup.ledger_additions(f, led, "key", extra=["n"], order=["v"]).collect()] == [("k", 2)]


def test_stars_without_keys_are_not_joined(spark):
    from feedloom.operators.enrich import with_repo_stars
    papers = spark.createDataFrame([(1, "https://github.com/o/r"), (2, None), (3, "https://github.com/o/none"), (4, "https://x.org")],
                                   "id long, github_url string")
    stars = spark.createDataFrame([("o", "r", 5), ("o", "r", 9), (None, None, 7)], "owner string, repo string, stars long")
    got = {r.id: r.github_stars for r in with_repo_stars(papers, stars).collect()}
    assert got == {1: 9, 2: None, 3: None, 4: None}


def test_edges_of_all_kinds(spark):
    from feedloom.operators.enrich import relationship_edges
    df = lambda rows, cols: spark.createDataFrame(rows, cols)
    got = relationship_edges(df([("A",), ("A",), ("B",)], "name string"), df([("A", "p1"), ("C", "p2")], "name string, id string"),
                             df([("B", "j1"), ("A", "j2")], "name string, id string"),
                             df([("u1", "g1"), ("u2", None)], "paper_url string, github_url string"))
    assert sorted(map(tuple, got.collect())) == [("A", "LAUNCHED", "p1"), ("A", "POSTED", "j2"), ("B", "POSTED", "j1"), ("u1", "HAS_REPO", "g1")]


def test_large_integers_stay_exact(spark):
    df = spark.createDataFrame([(1, 1, "p", '{"entityName": "a", "employeeCount": 9007199254740993}', None)],
                               "doc_id long, tier int, provider string, raw string, error string")
    assert validate_responses(df, "STARTUP").first().employeeCount == 9007199254740993


def test_checkpoint_folder_must_be_shared_on_a_cluster():
    from types import SimpleNamespace

    import pytest
    from feedloom.session import ensure_checkpoint_dir
    none = SimpleNamespace(isDefined=lambda: False)
    sc = SimpleNamespace(master="spark://host:7077", _jsc=SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: none)))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        ensure_checkpoint_dir(SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: d), sparkContext=sc))


def test_staged_fill_reads_no_more_sources_than_needed(spark):
    df = spark.createDataFrame([("x", 1, 0), ("y", 1, 1), ("x", 2, 0), ("z", 2, 1), ("w", 3, 0), ("w", 3, 1)], "k string, p int, pos int")
    built = []

    def source(i):
        def make():
            built.append(i)
            return df.where(F.col("p") == i)
        return make
    for limit in range(0, 7):
        built.clear()
        got = dedup.staged_fill([source(1), source(2), source(3)], "k", ["p", "pos"], limit).collect()
        assert [tuple(r) for r in sorted(got, key=lambda r: (r.p, r.pos))] == \
            [tuple(r) for r in dedup.priority_fill(df, "k", ["p", "pos"], limit).collect()]
        assert built == {0: [1], 1: [1], 2: [1], 3: [1, 2]}.get(limit, [1, 2, 3])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.sampled_from("abcde"), min_size=1, max_size=20), st.integers(0, 6))
def test_log_is_cut_where_the_limit_is_reached(spark, names, limit):
    df = spark.createDataFrame(list(enumerate(names)), "pos int, k string")
    want, seen = [], set()
    for i, k in enumerate(names):
        if len(seen) >= limit:
            break
        want.append((i, k))
        seen.add(k)
    assert sorted(tuple(r) for r in dedup.cut_at_limit(df, "k", ["pos"], limit).collect()) == want


def test_last_seen_over_days_and_hot_links(spark):
    from feedloom.operators.history import last_seen
    rows = [(i, "hot" if i % 3 else f"l{i % 4}", f"2024-01-{1 + i * 7 % 5:02d} {i % 24:02d}:00:00") for i in range(60)]
    rows += [(100, None, "2024-01-01 00:00:00"), (101, "l0", None), (102, "hot", "2024-01-01 01:00:00"), (103, "hot", "2024-01-01 01:00:00")]
    df = spark.createDataFrame(rows, "id long, link string, t string").withColumn("t", F.col("t").cast("timestamp"))
    got = {r.id: None if r.last_seen is None else str(r.last_seen) for r in last_seen(df, "link", "t", "id").collect()}
    assert len(got) == len(rows)
    for i, link, t in rows:
        before = [u for j, other, u in rows if link and t and other == link and u and (u, j) < (t, i)]
        assert got[i] == (max(before) if before else None)


def test_variant_payload_keeps_every_type(spark, tmp_path):
    from feedloom.sources import store
    papers = spark.createDataFrame([("t", ["A", "B"], "https://p/1", None, 9007199254740993, "")], "title string, authors array<string>, paper_url string, "
                                   "github_url string, github_stars long, src string")
    env = store.envelope(papers, "RESEARCH_PAPER", {**{c: F.col(c) for c in ("title", "authors", "paper_url", "github_url", "github_stars")},
                                                    "published_date": F.lit("d")}, F.lit("arXiv"), F.col("src"), F.lit("now"))
    path = str(tmp_path / "store")
    # an empty source URL falls back to the paper's own
    assert store.save_records(store.to_store_rows(store.with_source_url(env), "RESEARCH_PAPER"), path) == 1
    row = spark.read.parquet(path).select("source_url", store.payload_field(F.col("payload"), "$.content.github_stars", "bigint").alias("stars"),
                                          store.payload_field(F.col("payload"), "$.content.none").alias("none"))
    assert spark.read.parquet(path).schema["payload"].dataType.simpleString() == "variant"
    assert tuple(row.first()) == ("https://p/1", 9007199254740993, None)
    back = store.read_records(spark, path, "RESEARCH_PAPER").first()
    assert back.content.asDict() == {"title": "t", "authors": ["A", "B"], "paper_url": "https://p/1", "github_url": None,
                                     "github_stars": 9007199254740993, "published_date": "d"} and back.source.url == "https://p/1"


def test_log_sink_returns_its_count(spark, tmp_path):
    from feedloom.sources import store
    log = spark.createDataFrame([("a", "A", "m")] * 3, "raw_name string, canonical_name string, match_method string")
    assert store.save_log(log, str(tmp_path / "log")) == 3 == spark.read.parquet(str(tmp_path / "log")).count()
