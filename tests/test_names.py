from feedloom.operators.resolve import resolution_log, resolve_names, resolution_rates

GOLDEN = [
    ("Lang Chain, Ltd.", "LangChain", "nospace_seed_match"),
    ("Core Weave", "CoreWeave", "nospace_seed_match"),
    ("Pinecone GmbH", "Pinecone", "exact_seed_match"),
    ("Weaviate, LLC", "Weaviate", "exact_seed_match"),
    ("Together AI Labs", "Together AI", "exact_seed_match"),
    ("Character.AI PBC", "Character.AI", "exact_seed_match"),
    ("Riverglass Tech Limited", "Riverglass", "normalized"),
    ("Foo Inc Bar", "Foo  Bar", "normalized"),
    ("Co-here", "-here", "normalized"),
    ("Labs", "Labs", "normalized"),
    ("  ", "Unknown", None),
    ("", "Unknown", None),
    (None, "Unknown", None),
]


def test_resolve_golden(spark):
    df = spark.createDataFrame([(i, g[0]) for i, g in enumerate(GOLDEN)], "id long, name string")
    r = resolve_names(df, "name").orderBy("id").collect()
    assert [(x.canonical_name, x.match_method) for x in r] == [(g[1], g[2]) for g in GOLDEN]


def test_log_has_one_row_per_nonblank_call(spark):
    names = ["OpenAI Inc.", "OpenAI Inc.", "", "Foo Inc Bar"]
    df = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id long, name string")
    log = resolution_log(resolve_names(df, "name"))
    rows = sorted(tuple(r) for r in log.collect())
    assert rows == [("Foo Inc Bar", "Foo  Bar", "normalized"), ("OpenAI Inc.", "OpenAI", "exact_seed_match"),
                    ("OpenAI Inc.", "OpenAI", "exact_seed_match")]
    rates = {r.match_method: (r.n, r.share_ppm) for r in resolution_rates(log).collect()}
    assert rates == {"exact_seed_match": (2, 666666), "normalized": (1, 333333)}


def test_resolve_idempotent_on_seeds(spark):
    from feedloom.functions.names import DEFAULT_SEEDS
    df = spark.createDataFrame([(i, s) for i, s in enumerate(DEFAULT_SEEDS)], "id long, name string")
    r = resolve_names(df, "name").collect()
    assert all(x.canonical_name == x.name for x in r)


def test_custom_seed_list_replaces_default(spark):
    df = spark.createDataFrame([(0, "Acme Corp."), (1, "OpenAI")], "id long, name string")
    r = resolve_names(df, "name", seeds=["Acme"]).orderBy("id").collect()
    assert [(x.canonical_name, x.match_method) for x in r] == [("Acme", "exact_seed_match"), ("OpenAI", "normalized")]
