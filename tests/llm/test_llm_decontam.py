import itertools
import random

import numpy as np
from fixtures_llm import empty, messy, prose, rows

from feedloom.llm.common import prepare
from feedloom.llm.decontam import EDITED, MASKS, WINDOW, benchmark_overlaps, decontaminate, op6_decontamination, overlaps_of_texts

ITEMS = [(1, prose(100, 40)), (2, prose(101, 15)), (3, "one two three four five six seven"), (4, None), (5, ""), (6, "too short"),
         (1, prose(100, 40))]


def bench(spark, items=ITEMS):
    return spark.createDataFrame(items, "item_id long, text string")


def planted():
    item = ITEMS[0][1].split(" ")
    edited = list(item)
    for i in range(3, 40, 8):
        edited[i] = "edited"
    many = [w if i % 3 else "lost" for i, w in enumerate(item)]
    return {
        "verbatim": prose(7, 30) + " " + ITEMS[0][1] + " " + prose(8, 30),
        "edited": prose(9, 30) + " " + " ".join(edited) + " " + prose(10, 5),
        "part": prose(11, 10) + " " + " ".join(item[5:20]) + " " + prose(12, 10),
        "upper": ITEMS[1][1].upper(),
        "short": "so ONE two three four five six seven so",
        "clean": prose(13, 200),
        "few": prose(14, 10) + " " + " ".join(item[5:15]) + " " + prose(15, 10),
        "torn": prose(16, 10) + " " + " ".join(many) + " " + prose(17, 10),
        "short edited": "so one two three other five six seven so",
        "two words": "it is TOO short for that",
        "two words apart": "too very short",
    }


def test_masks_cover_every_two_substitutions():
    for lost in itertools.chain(itertools.combinations(range(WINDOW), 1), itertools.combinations(range(WINDOW), 2)):
        assert any(all(c == "0" or i + j not in lost for j, c in enumerate(m)) for m in MASKS for i in range(WINDOW - len(m) + 1))


def test_masks_cover_the_substitutions_of_short_items():
    for n in range(EDITED, WINDOW):
        for lost in itertools.combinations(range(n), n - -(-n * 80 // 100)):
            assert any(all(c == "0" or i + j not in lost for j, c in enumerate(m)) for m in MASKS for i in range(n - len(m) + 1))


def test_short_items_with_substitutions(spark):
    items, texts = [], []
    for n in range(EDITED, WINDOW):
        item = prose(200 + n, n).split(" ")
        items.append((n, " ".join(item)))
        bad = n - -(-n * 80 // 100)
        for lose in (bad, bad + 1):
            texts.append((10 * n + lose - bad, " ".join([prose(300 + n, 9), *("edited" if 2 <= i < 2 + lose else w for i, w in enumerate(item)), prose(400 + n, 9)])))
    got = {r["doc_id"]: [o["item_id"] for o in r["overlaps"]] for r in benchmark_overlaps(messy(spark, texts), bench(spark, items)).collect()}
    assert got == {d: [] if d % 10 else [d // 10] for d, _ in texts}


def brute(text, items):
    """Windows of WINDOW words of which at least 11 agree; shorter items whole,
    from EDITED words on with 80 of 100 equal."""
    w = np.array((text or "").lower().split())
    for _, t in items:
        x = np.array((t or "").lower().split())
        size = min(WINDOW, len(x))
        need = -(-size * 80 // 100) if size >= EDITED else size
        if not size:
            continue
        for i in range(len(w) - size + 1):
            for j in range(len(x) - size + 1):
                if (w[i:i + size] == x[j:j + size]).sum() >= need:
                    return True
    return False


def test_planted_cases(spark):
    cases = planted()
    df = messy(spark, list(enumerate(cases.values())))
    got = {r["doc_id"]: len(r["overlaps"]) > 0 for r in benchmark_overlaps(df, bench(spark)).collect()}
    for i, (name, text) in enumerate(cases.items()):
        assert got[i] == brute(text, ITEMS), name
    assert [got[i] for i in range(len(cases))] == [True] * 5 + [False] * 4 + [True, False]


def test_spans(spark):
    df = messy(spark, [(1, planted()["verbatim"])])
    (o,) = benchmark_overlaps(df, bench(spark)).collect()[0]["overlaps"]
    assert (o["item_id"], o["first_word"], o["n_words"], o["n_equal"]) == (1, 30, 40, 40)


def test_random_texts_against_brute_force(spark):
    rng = random.Random(4)
    few = ["a", "b", "c", "d", "e"]
    items = [(n, " ".join(rng.choice(few) + str(rng.randrange(3)) for _ in range(n))) for n in (1, 2, 3, 4, 5, 7, 8, 9, 12, 13, 14, 20, 30)]
    items[0] = (1, "rare")
    texts = []
    for i in range(150):
        w = [rng.choice(few) + str(rng.randrange(3)) for _ in range(rng.randrange(1, 60))]
        if i % 2:
            item = items[rng.randrange(len(items))][1].split(" ")
            item = [x if rng.random() < 0.85 else "zz" for x in item]
            k = rng.randrange(len(w))
            w[k:k] = item[rng.randrange(3):]
        texts.append((i, " ".join(w)))
    got = {r["doc_id"]: {o["item_id"] for o in r["overlaps"]} for r in benchmark_overlaps(messy(spark, texts), bench(spark, items)).collect()}
    for i, t in texts:
        assert got[i] == {k for k, x in items if brute(t, [(k, x)])}, (i, t)


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r["doc_id"]: r["contaminated"] for r in op6_decontamination(spark, sf).collect()}
    assert set(got) == set(docs)
    # brute force over texts of moderate length; the others by their own windows
    for d, t in docs.items():
        if len(t or "") < 700:
            assert got[d] == brute(t, items), d
    assert any(got.values()) and not all(got.values())


def test_hot_phrase_in_every_text_and_item(spark):
    phrase = " ".join(f"common{i}" for i in range(9))
    items = [(i, phrase + " " + prose(600 + i, 20)) for i in range(20)]
    texts = [(i, prose(i, 10) + " " + phrase + " " + prose(50 + i, 10)) for i in range(200)] + [(900, items[7][1])]
    got = {r["doc_id"]: [o["item_id"] for o in r["overlaps"]] for r in benchmark_overlaps(messy(spark, texts), bench(spark, items)).collect()}
    assert got.pop(900) == [7] and not any(got.values())


def test_awkward_rows(spark):
    df = messy(spark)
    clean = decontaminate(df, bench(spark))
    assert clean.columns == df.columns and clean.count() == len(rows())
    none = bench(spark).where("false")
    assert decontaminate(df, none).count() == len(rows())
    assert decontaminate(empty(spark), bench(spark)).count() == 0


def test_one_python_step_a_task(spark):
    # two in a row are two workers a task, which stay for what follows
    docs = messy(spark, [(i, t) for i, t in enumerate(planted().values())])
    plan = overlaps_of_texts(docs, bench(spark))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
    prepare(spark)
    assert int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 4 << 20
