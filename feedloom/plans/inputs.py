"""Table loading and derived inputs shared by the plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from feedloom.functions.names import DEFAULT_SEEDS

# fixed "as of" instants of the plans (the reference's "now")
AS_OF_FRESH = "2024-01-15 12:00:00"
AS_OF_RELATIVE = "2024-02-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    from feedloom.sources.io import read_table
    return read_table(spark, f"{sf_dir.rstrip('/')}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with ``ts`` as an instant (the file holds wall-clock NTZ)."""
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


_SCHEME_HOST = r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)"


def url_variant(url: Column, k: Column) -> Column:
    """k=0 the URL; k=1 scheme+host upper-cased; k=2 a tracking parameter
    appended.  All three normalise to the same URL."""
    head = F.regexp_extract(url, _SCHEME_HOST, 1)
    upper = F.concat(F.upper(head), F.substring(url, F.length(head) + 1, 1 << 30))
    tracked = F.concat(url, F.when(url.contains("?"), F.lit("&utm_source=feed")).otherwise(F.lit("?utm_source=feed")))
    return F.when(k == 0, url).when(k == 1, upper).otherwise(tracked)


def page_variants(pages: DataFrame, *extra: str) -> DataFrame:
    """Every page three times (U1 of three crawls); ``priority`` rotates with
    the page so the first-wins winner differs between pages."""
    v = pages.select("page_id", "url", *extra, F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("variant"))
    return v.select("page_id", "variant", ((F.col("page_id") + F.col("variant")) % 3).alias("priority"),
                    url_variant(F.col("url"), F.col("variant")).alias("url"), *extra)


def html_title(html: Column) -> Column:
    return F.regexp_extract(html, r"<title>([^<]*)</title>", 1)


def html_lang(html: Column) -> Column:
    return F.regexp_extract(html, r"<html lang=\"([^\"]*)\"", 1)


# Company-like names derived from table rows: a seed name or the row's own
# name, with one of eight suffix/spelling variants.
NAME_VARIANTS = ["{}", "{} Inc.", "{}, Inc.", "{} LLC", "{} Labs", "{} Technologies Corp.", "lower", "nospace"]


def seed_array() -> Column:
    return F.array(*[F.lit(s) for s in DEFAULT_SEEDS])


def company_name(key: Column, own_name: Column) -> Column:
    """Derived raw company name for a row with integer ``key``."""
    base = F.when(key % 3 == 0, own_name).otherwise(F.element_at(seed_array(), (key % len(DEFAULT_SEEDS) + 1).cast("int")))
    k = ((key / 3).cast("bigint") % len(NAME_VARIANTS)).cast("int")
    out = F.lit(None).cast("string")
    cases = None
    for i, pat in enumerate(NAME_VARIANTS):
        if pat == "lower":
            val = F.lower(base)
        elif pat == "nospace":
            val = F.replace(base, F.lit(" "), F.lit(""))
        else:
            pre, post = pat.split("{}")
            val = F.concat(F.lit(pre), base, F.lit(post))
        cases = F.when(k == i, val) if cases is None else cases.when(k == i, val)
    return cases.otherwise(out)


def company_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(src, key, raw_name)`` from supplier and customer rows."""
    s = table(spark, sf_dir, "supplier").select(
        F.lit(1).alias("src"), F.col("s_suppkey").alias("key"),
        company_name(F.col("s_suppkey"), F.col("s_name")).alias("raw_name"))
    c = table(spark, sf_dir, "customer").select(
        F.lit(2).alias("src"), F.col("c_custkey").alias("key"),
        company_name(F.col("c_custkey"), F.col("c_name")).alias("raw_name"))
    return s.unionByName(c)


# ---------------------------------------------------------------- landed feeds
FEED_SIZE = 8  # entries per landed feed document (bounded group)


def assemble(df: DataFrame, feed_key: Column, order: Column, piece: Column, head: str | Column, tail: str | Column,
             sep: str = "") -> DataFrame:
    """Concatenate per-entry text pieces into one document per feed, in
    entry order, between ``head`` and ``tail`` (columns may use ``feed_id``).
    Feeds hold a bounded number of entries by construction."""
    head, tail = (F.lit(x) if isinstance(x, str) else x for x in (head, tail))
    g = df.groupBy(feed_key.alias("feed_id")).agg(
        F.array_sort(F.collect_list(F.struct(order.alias("o"), piece.alias("p")))).alias("__parts"))
    return g.select("feed_id", F.concat(head, F.array_join(F.transform("__parts", lambda x: x["p"]), sep),
                                        tail).alias("body"))


def esc(c: Column) -> Column:
    return F.replace(F.replace(F.replace(c, F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;")),
                     F.lit(">"), F.lit("&gt;"))


def cdata(c: Column) -> Column:
    return F.concat(F.lit("<![CDATA["), c, F.lit("]]>"))


def first_line(text: Column) -> Column:
    return F.split(text, "\n", -1)[0]


def paper_id(doc_id: Column, text: Column) -> Column:
    """arXiv-like id from the text hash (exact copies share an id)."""
    return F.concat(F.substring(F.sha2(text, 256), 1, 10), F.lit("v"), (doc_id % 2 + 1).cast("string"))


def doc_published(doc_id: Column) -> Column:
    return F.concat(F.lit("2024-01-"), F.lpad((doc_id % 28 + 1).cast("string"), 2, "0"), F.lit("T"),
                    F.lpad((doc_id % 24).cast("string"), 2, "0"), F.lit(":00:00Z"))


def atom_paper_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    authors = F.concat(
        F.lit("<author><name>Author "), (k % 5).cast("string"), F.lit("</name></author>"),
        F.when(k % 2 == 0, F.concat(F.lit("<author><name>Author "), (k % 3 + 5).cast("string"),
                                    F.lit("</name></author>"))).otherwise(F.lit("")),
        F.when(k % 5 == 0, F.lit("<author><name> </name></author>")).otherwise(F.lit("")))
    comment = F.when(k % 3 == 0, F.concat(F.lit("<arxiv:comment>Code: https://github.com/org"), F.col("lang"),
                                          F.lit("/r"), k.cast("string"), F.lit("</arxiv:comment>"))).otherwise(F.lit(""))
    # every fourth title stands in a CDATA section
    title = F.when(k % 4 == 3, cdata(first_line(F.col("text")))).otherwise(esc(first_line(F.col("text"))))
    entry = F.concat(
        F.lit("<entry><id>http://arxiv.org/abs/"), paper_id(k, F.col("text")), F.lit("</id><published>"),
        doc_published(k), F.lit("</published><title>"), title, F.lit("</title><summary>"),
        esc(F.col("text")), F.lit("</summary>"), authors, comment, F.lit("</entry>"))
    return assemble(d, (k / FEED_SIZE).cast("bigint"), k, entry,
                    '<?xml version="1.0" encoding="UTF-8"?><feed xmlns="http://www.w3.org/2005/Atom" '
                    'xmlns:arxiv="http://arxiv.org/schemas/atom">', "</feed>")


JOB_ROLES = ["Research Scientist", "Product Manager", "Data Analyst", "UI Designer", "Backend Engineer",
             "Build Engineer", "Shipment Lead"]


def job_title(k: Column, company: Column) -> Column:
    role = F.element_at(F.array(*[F.lit(r) for r in JOB_ROLES]), (k % len(JOB_ROLES) + 1).cast("int"))
    sep = F.element_at(F.array(F.lit(" at "), F.lit(" - "), F.lit(" : "), F.lit(" | ")), (k % 4 + 1).cast("int"))
    return F.concat(role, sep, company)


def job_rss_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """RSS job feeds; publish times step back from AS_OF_FRESH by the
    document number (hours), in mail format.  Every third title and link
    stands in a CDATA section, as it is; descriptions hold named entities and
    quoted tags."""
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    company = company_name(k, F.concat(F.initcap("source"), F.lit(" Group")))
    pub = to_ts_lit(AS_OF_FRESH) - F.make_dt_interval(F.lit(0), (k % 40).cast("int"))
    at = F.concat(F.lit("https://jobs.example.org/"), k.cast("string"))
    link = F.when(k % 5 == 0, F.lit("")).otherwise(F.concat(
        F.lit("<link>"), F.when(k % 3 == 0, at).when(k % 3 == 1, cdata(F.concat(at, F.lit("?a=1&b=2"))))
        .otherwise(F.concat(at, F.lit("?a=1&amp;b=2"))), F.lit("</link>")))
    title = F.when(k % 3 == 1, cdata(job_title(k, company))).otherwise(esc(job_title(k, company)))
    text = F.when(k % 4 == 1, cdata(F.concat(F.lit("<item><title>no &eacute;</title></item> <!-- "), F.col("text")))) \
        .otherwise(F.concat(F.lit("Caf&eacute;&nbsp;a < b: "), esc(F.col("text"))))
    item = F.concat(F.lit("<item><title>"), title, F.lit("</title>"), link,
                    F.lit("<pubDate>"), F.date_format(pub, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT</pubDate>"),
                    F.lit("<description>"), text, F.lit("</description></item>"))
    feeds = assemble(d, (k / FEED_SIZE).cast("bigint"), k, item, '<rss version="2.0"><channel>', "</channel></rss>")
    return feeds.withColumn("source_url", F.concat(F.lit("https://jobs.example.org/feed/"), F.col("feed_id").cast("string")))


def news_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """News feeds, bodies as escaped HTML.  Two in three are Atom (entries
    with ``href`` links, the alternate before the edit link; some without a
    link), every third is RDF (items beside the channel, link as text).
    Every second title has its ``&`` unescaped; of six titles one starts with
    named entities, one holds a stray ``<`` and one quotes a tag in a CDATA
    section; every fourth body is HTML in a CDATA section."""
    d = table(spark, sf_dir, "documents")
    k = F.col("doc_id")
    feed = (k / FEED_SIZE).cast("bigint")
    pub = to_ts_lit(AS_OF_FRESH) - F.make_dt_interval(F.lit(0), (k % 40).cast("int"))
    date_el = F.when(k % 2 == 0, F.concat(F.lit("<published>"), F.date_format(pub, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
                                          F.lit("</published>"))) \
        .otherwise(F.concat(F.lit("<updated>"), F.date_format(pub, "yyyy-MM-dd HH:mm:ss"), F.lit("</updated>")))
    body = F.concat(F.lit("<p>"), F.replace(F.col("text"), F.lit("&"), F.lit("and")), F.lit("</p>"))
    line = first_line(F.col("text"))
    bare = F.replace(F.replace(line, F.lit("<"), F.lit("&lt;")), F.lit(">"), F.lit("&gt;"))
    title = F.concat(F.lit("<title>"), F.when(k % 6 == 4, F.concat(F.lit("Caf&eacute;&nbsp;"), esc(line)))
                     .when(k % 6 == 1, F.concat(F.lit("1 < 2 "), bare)).when(k % 6 == 5, cdata(F.concat(F.lit("R&D <item> "), line)))
                     .when(k % 2 == 0, esc(line)).otherwise(bare), F.lit("</title>"))
    at = F.concat(F.lit("https://news.example.org/a/"), k.cast("string"))
    links = F.when(k % 7 == 0, F.lit("")).otherwise(F.concat(
        F.lit('<link rel="alternate" href="'), at, F.lit('"/><link rel="edit" href="https://news.example.org/edit/'),
        k.cast("string"), F.lit('"/>')))
    text_link = F.when(k % 7 == 0, F.lit("")).otherwise(F.concat(F.lit("<link>"), at, F.lit("</link>")))
    summary = F.concat(F.lit("<summary>"), F.when(k % 4 == 1, cdata(F.concat(body, F.lit("<!-- <p>no</p> -->")))).otherwise(esc(body)),
                       F.lit("</summary>"))
    rdf = feed % 3 == 2
    entry = F.when(rdf, F.concat(F.lit('<item rdf:about="urn:'), k.cast("string"), F.lit('">'), title, text_link, date_el, summary, F.lit("</item>"))) \
        .otherwise(F.concat(F.lit("<entry>"), title, links, date_el, summary, F.lit("</entry>")))
    is_rdf = F.col("feed_id") % 3 == 2
    head = F.when(is_rdf, F.lit('<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#"><channel><title>News</title></channel>')) \
        .otherwise(F.lit('<feed xmlns="http://www.w3.org/2005/Atom">'))
    tail = F.when(is_rdf, F.lit("</rdf:RDF>")).otherwise(F.lit("</feed>"))
    feeds = assemble(d, feed, k, entry, head, tail)
    return feeds.withColumn("source_url", F.concat(F.lit("https://news.example.org/feed/"), F.col("feed_id").cast("string")))


def broken_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job feeds, of which four in five are damaged: missing, not a feed,
    with an item in front that holds no field, blank."""
    return job_rss_feeds(spark, sf_dir).withColumn("body", damaged("<html><body>moved</body></html>", F.replace(
        F.col("body"), F.lit("<channel>"), F.lit("<channel><item><guid>7</guid></item>"))))


def damaged(other: str, odd: Column, cut: Column | None = None) -> Column:
    """A feed's body by its number: as it is, missing, another document, with
    an odd entry in front, and blank (or ``cut``)."""
    k = F.col("feed_id") % 5
    return (F.when(k == 1, F.lit(None)).when(k == 2, F.lit(other)).when(k == 3, odd)
             .when(k == 4, F.lit("  ") if cut is None else cut).otherwise(F.col("body")))


def broken_paper_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The paper feeds, damaged in the same way; the odd entry has no id."""
    odd = F.regexp_replace("body", "^(.*?<feed[^>]*>)", "$1<entry><title>none</title></entry>")
    return atom_paper_feeds(spark, sf_dir).withColumn("body", damaged("<error>busy</error>", odd))


def broken_org_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The organisation arrays: missing, of no array, with a string in front,
    cut off."""
    odd = F.concat(F.lit('["stray", '), F.substring(F.col("body"), 2, 1 << 30))
    return org_feeds(spark, sf_dir).withColumn("body", damaged('{"error": "busy"}', odd, F.expr("left(body, length(body) - 3)")))


def to_ts_lit(s: str) -> Column:
    return F.to_timestamp(F.lit(s))


def json_array_feeds(df: DataFrame, key: Column, element: Column, wrap_key: str | None = None) -> DataFrame:
    """JSON documents of FEED_SIZE elements each (``[..]`` or ``{k:[..]}``)."""
    head, tail = ("[", "]") if wrap_key is None else ('{"' + wrap_key + '": [', "]}")
    return assemble(df, (key / FEED_SIZE).cast("bigint"), key, F.to_json(element), head, tail, sep=", ")


def org_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC6 input: organisation arrays built from supplier rows."""
    s = table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey")
    ident = F.when(k % 6 == 5, F.lit(None)).otherwise(F.lower(F.replace(F.col("s_name"), F.lit("#"), F.lit("-"))))
    name = company_name(k, F.col("s_name"))
    full = F.when(k % 4 == 0, F.lit("")).when(k % 4 == 1, F.lit(None)).otherwise(F.concat(name, F.lit(" Inc.")))
    el = F.struct(ident.alias("id"), name.alias("name"), full.alias("fullname"))
    return json_array_feeds(s, k, el)


def model_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC7 input: model arrays (``owner/name`` ids) built from part rows."""
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    mid = (F.when(k % 13 == 0, F.lit(""))
            .when(k % 10 == 0, F.replace(F.col("p_name"), F.lit(" "), F.lit("-")))
            .otherwise(F.concat(F.replace(F.col("p_brand"), F.lit("#"), F.lit("")), F.lit("/"),
                                F.replace(F.col("p_name"), F.lit(" "), F.lit("-")))))
    return json_array_feeds(p, k, F.struct(mid.alias("id")))


def job_json_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC10 input: ``{"jobs": [...]}`` documents built from orders."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    company = F.when(k % 9 == 0, F.lit(None)).otherwise(company_name(k, F.concat(F.lit("Client "), F.col("o_custkey").cast("string"))))
    url = F.when(k % 7 == 0, F.lit(None)).otherwise(F.concat(F.lit("https://remote.example.org/job/"), k.cast("string")))
    pub = to_ts_lit(AS_OF_FRESH) - F.make_dt_interval(F.lit(0), (k % 40).cast("int"))
    el = F.struct(job_title(k, F.col("o_orderpriority")).alias("title"), company.alias("company_name"),
                  url.alias("url"), F.date_format(pub, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publication_date"))
    return json_array_feeds(o, k, el, "jobs").withColumn("source_url", F.lit("https://remote.example.org/api/jobs"))


PAGE_ITEMS = 10
PAGES_PER_QUERY = 20


def paged_feeds(df: DataFrame, key: Column, element: Column) -> DataFrame:
    """SRC8/SRC9 input: one JSON page of PAGE_ITEMS items per row, PAGES_PER_QUERY
    pages per query; per query one page fails (status 500) or comes back empty."""
    per_query = PAGE_ITEMS * PAGES_PER_QUERY
    d = df.select((key / per_query).cast("bigint").alias("query_id"),
                  ((key % per_query) / PAGE_ITEMS).cast("int").alias("__p"), key.alias("__k"), F.to_json(element).alias("__j"))
    pages = d.groupBy("query_id", "__p").agg(F.array_sort(F.collect_list(F.struct("__k", "__j"))).alias("__parts"))
    page = (F.col("__p") + 1).cast("bigint")
    q = F.col("query_id")
    status = F.when((q % 3 == 0) & (page == q % 5 + 10), F.lit(500)).otherwise(F.lit(200))
    body = F.when((q % 3 == 1) & (page == 12), F.lit('{"items": []}')).otherwise(
        F.concat(F.lit('{"items": ['), F.array_join(F.transform("__parts", lambda x: x["__j"]), ", "), F.lit("]}")))
    return pages.select("query_id", page.alias("page"), status.alias("status"), body.alias("body"))


def org_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    login = F.when(k % 11 == 0, F.lit("")).otherwise(F.concat(F.lit("org-"), F.lower(F.col("c_mktsegment")),
                                                               F.lit("-"), k.cast("string")))
    url = F.when(k % 4 == 0, F.lit(None)).otherwise(F.concat(F.lit("https://github.com/"), login))
    return paged_feeds(c, k, F.struct(login.alias("login"), url.alias("html_url")))


def repo_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    owner = F.concat(F.lit("team-"), F.replace(F.col("p_brand"), F.lit("Brand#"), F.lit("")))
    url = F.when(k % 17 == 0, F.lit("")).otherwise(
        F.concat(F.lit("https://github.com/"), owner, F.lit("/"), F.replace(F.col("p_name"), F.lit(" "), F.lit("-")),
                 F.lit("-"), k.cast("string")))
    desc = F.element_at(F.array(F.lit("Open-source toolkit"), F.lit("Freemium plan"), F.lit("Enterprise ready"),
                                F.lit("Paid $9"), F.lit("Limited preview"), F.lit("A tool")), (k % 6 + 1).cast("int"))
    el = F.struct(url.alias("html_url"), F.struct(owner.alias("login")).alias("owner"),
                  F.concat(desc, F.lit(" for "), F.col("p_type")).alias("description"))
    return paged_feeds(p, k, el)


CARD_PAGE = 10


def card_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC11 input: directory HTML, CARD_PAGE customers per page; even pages
    use the primary card markup, odd pages the fallback markup."""
    c = table(spark, sf_dir, "customer")
    k = F.col("c_custkey")
    pid = (k / CARD_PAGE).cast("bigint")
    name = company_name(k, F.col("c_name"))
    slug = F.lower(F.replace(F.col("c_name"), F.lit("#"), F.lit("-")))
    lo = k % 50 + 1
    hi = lo * (k % 9 + 2)
    emp = F.concat(lo.cast("string"), F.lit(" - "), hi.cast("string"), F.lit(" employees"))
    # every third card has a second name span inside the first
    inner = F.when(k % 3 == 0, F.lit(' <span class="_name_159g8_25">Group</span>')).otherwise(F.lit(""))
    primary = F.concat(F.lit('<a class="_company_159g8_11 x" href="/companies/'), slug, F.lit('"><span class="_name_159g8_25">'),
                       esc(name), inner, F.lit('</span><span class="s">'), emp, F.lit("</span></a>"))
    fallback = F.concat(F.lit('<a href="/companies/'), slug, F.lit('"><div><span class="font-bold">'), esc(name),
                        F.lit('</span></div><span>'), emp, F.lit("</span></a>"))
    card = F.when(pid % 2 == 0, primary).otherwise(fallback)
    pages = assemble(c, pid, k, card, '<html><body><nav><a href="/about">About</a></nav><div class="grid">',
                     "</div></body></html>")
    return pages.withColumnRenamed("feed_id", "page_id")


def product_rss_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    k = F.col("p_partkey")
    vendor = company_name(k, F.concat(F.lit("Maker "), F.col("p_brand")))
    title = F.when(k % 3 == 0, F.col("p_name")).otherwise(
        F.concat(F.col("p_name"), F.when(k % 3 == 1, F.lit(" by ")).otherwise(F.lit(" - ")), vendor))
    link = F.when(k % 8 == 0, F.lit("")).otherwise(
        F.concat(F.lit("<link>https://products.example.org/p/"), (k / 2).cast("bigint").cast("string"), F.lit("</link>")))
    desc = F.element_at(F.array(F.lit("Free trial available"), F.lit("Custom pricing"), F.lit("MIT licensed"),
                                F.lit("Subscription"), F.lit("New launch")), (k % 5 + 1).cast("int"))
    title = F.when(k % 4 == 1, cdata(title)).otherwise(esc(title))
    desc = F.when(k % 7 == 1, cdata(F.concat(desc, F.lit(" <item> R&D")))).otherwise(F.concat(desc, F.lit(" caf&eacute; & co")))
    item = F.concat(F.lit("<item><title>"), title, F.lit("</title>"), link, F.lit("<description>"), desc,
                    F.lit("</description></item>"))
    return assemble(p, (k / FEED_SIZE).cast("bigint"), k, item, "<rss><channel>", "</channel></rss>")


# ---------------------------------------------------------------- extraction responses
PRIORITY_TO_PRICING = [("1-URGENT", '"ENTERPRISE"'), ("2-HIGH", '"PAID"'), ("3-MEDIUM", '"FREEMIUM"'),
                       ("4-NOT SPECIFIED", '"INVALID_PRICING_MODEL"'), ("5-LOW", "null")]
PROVIDERS = ["primary", "secondary", "tertiary"]


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``responses(doc_id, tier, provider, raw, error)``: three attempts per
    order (one per provider tier), built from order columns."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    name = F.concat(F.lit("Client "), F.col("o_custkey").cast("string"))
    pm = None
    for pri, val in PRIORITY_TO_PRICING:
        pm = F.when(F.col("o_orderpriority") == pri, F.lit(val)) if pm is None else pm.when(F.col("o_orderpriority") == pri, F.lit(val))
    pm = pm.otherwise(F.lit("null"))
    r1 = F.concat(F.lit('```json\n{"startupName": "'), name, F.lit('", "pricingModel": '), pm, F.lit("}\n```"))
    e1 = F.when(F.col("o_orderstatus") == "F", F.lit("429 Too Many Requests"))
    r2 = (F.when(k % 4 == 0, F.concat(F.lit('{"startupName": "'), name))
           .when(k % 4 == 1, F.concat(F.lit('{"startupName": '), F.col("o_custkey").cast("string"), F.lit("}")))
           .when(k % 4 == 2, F.concat(F.lit('```\n{"startupName": "'), name, F.lit('", "pricingModel": "FREE"}```')))
           .otherwise(F.lit('{"pricingModel": "PAID"}')))
    e2 = F.when(k % 10 == 0, F.lit("Quota exceeded for project"))
    r3 = F.concat(F.lit('{"startupName": "'), name, F.lit('", "pricingModel": "FREE", "extra": 1}'))
    e3 = F.when(F.col("o_orderstatus") == "O", F.lit("upstream connect error 503"))
    att = F.array(
        F.struct(F.lit(1).alias("tier"), F.lit(PROVIDERS[0]).alias("provider"), r1.alias("raw"), e1.alias("error")),
        F.struct(F.lit(2).alias("tier"), F.lit(PROVIDERS[1]).alias("provider"), r2.alias("raw"), e2.alias("error")),
        F.struct(F.lit(3).alias("tier"), F.lit(PROVIDERS[2]).alias("provider"), r3.alias("raw"), e3.alias("error")))
    return o.select(k.alias("doc_id"), F.explode(att).alias("a")).select("doc_id", "a.*")


def typed_responses(spark: SparkSession, sf_dir: str, record_type: str) -> DataFrame:
    """``responses`` of one tier for a record type, whose fields take every
    form that the lax rules accept or refuse, by ``doc_id``."""
    source, key, name = {"STARTUP": ("supplier", "s_suppkey", "s_name"), "RESEARCH_PAPER": ("part", "p_partkey", "p_name"),
                         "JOB": ("orders", "o_orderkey", "o_clerk"), "NEWS": ("customer", "c_custkey", "c_name")}[record_type]
    d = table(spark, sf_dir, source)
    if name not in d.columns:
        name = key
    k = F.col(key)
    text = F.concat(F.lit('"'), F.replace(F.col(name).cast("string"), F.lit('"'), F.lit("'")), F.lit('"'))

    def pick(*forms: str) -> Column:
        out = None
        for i, f in enumerate(forms):
            out = F.when(k % len(forms) == i, F.lit(f)) if out is None else out.when(k % len(forms) == i, F.lit(f))
        return out

    raw = F.concat(F.lit("{"), {
        "STARTUP": F.concat(F.when(k % 7 == 3, F.lit('"entity": ')).otherwise(F.lit('"entityName": ')), text, pick(
            ', "employeeCount": 12', ', "employeeCount": "12"', ', "employeeCount": 12.0', ', "employeeCount": 12.5', ', "employeeCount": true',
            ', "employeeCount": null', ', "employeeCount": 9007199254740993', "", ', "employeeCount": "many"', ', "employeeCount": -3')),
        "RESEARCH_PAPER": F.concat(F.lit('"title": '), text, F.lit(', "paper_url": "u"'),
                                   pick(', "authors": ["A", "B"]', ', "authors": []', "", ', "authors": ["A", 1]', ', "authors": null', ', "authors": "A"'),
                                   pick(', "github_stars": 5', ', "github_stars": "5"', "", ', "github_stars": 5.0', ', "github_stars": false'),
                                   F.when(k % 11 == 0, F.lit("")).otherwise(F.lit(', "published_date": "2024-01-01"'))),
        "JOB": F.concat(F.lit('"company": '), text, F.lit(', "date": "2024-01-01"'),
                        pick(', "is_remote": true', ', "is_remote": "yes"', ', "is_remote": 0', ', "is_remote": 1.0', ', "is_remote": "maybe"', "",
                             ', "is_remote": null', ', "is_remote": 2', ', "is_remote": "OFF"'),
                        F.when(k % 2 == 0, F.lit(', "role_family": "Design"')).otherwise(F.lit(""))),
        "NEWS": F.concat(F.lit('"title": '), text, F.lit(', "publication_date": "2024-01-01"'),
                         pick(', "full_text": "t"', ', "full_text": null', ', "full_text": 5', "", ', "full_text": ""')),
    }[record_type], F.lit("}"))
    return d.select(k.cast("bigint").alias("doc_id"), F.lit(1).alias("tier"), F.lit(PROVIDERS[0]).alias("provider"), raw.alias("raw"),
                    F.lit(None).cast("string").alias("error"))


SECRET_PROPS = ["api_key", "session_token", "Authorization", "page"]


def event_props(e: DataFrame) -> Column:
    """Property map of an event: its JSON props plus derived attributes."""
    base = F.from_json(F.col("props"), "map<string,string>")
    extra = F.create_map(
        F.lit("api_key"), F.concat(F.lit("ak-"), F.col("user_id").cast("string")),
        F.lit("session_token"), F.concat(F.lit("st-"), F.col("event_id").cast("string")),
        F.lit("Authorization"), F.lit("Bearer x"),
        F.lit("page"), F.col("event_type"))
    return F.map_concat(base, extra)
