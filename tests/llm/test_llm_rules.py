"""Quality rules and decontamination against brute force."""

import hashlib
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cdcmart.llm import decontamination, divergence

WORD = re.compile(r"[^\x20\x09-\x0D]+")
TOKEN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def base_counts(text):
    w = WORD.findall(text)
    seen = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    hit = {p for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def test_base_counts(mixed, texts):
    found = divergence.quality_rules(mixed).collect()
    got = Counter((r["doc_id"], *[r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]) for r in found)
    assert got == Counter((i, *base_counts(t)) for i, t in texts(mixed))
    for r in found:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed
        assert not (failed and r["kept"])


def test_divergence_drops_shouting_and_keeps_prose(spark, documents):
    prose = [r["text"] for r in documents.where("lang = 'en' and n_chars between 1500 and 3000").select("text").limit(3).collect()]
    odd = spark.createDataFrame([(10**6 + i, t.upper(), "en") for i, t in enumerate(prose)], "doc_id bigint, text string, lang string")
    whole = documents.select("doc_id", "text", "lang").union(odd)
    got = {r["doc_id"]: r for r in divergence.quality_rules(whole).collect()}
    for i in range(len(prose)):
        assert not got[10**6 + i]["kept"] and not got[10**6 + i]["base_failed"]
    good = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").where("quality = 1").collect()
    passed = [got[r["doc_id"]] for r in good if not got[r["doc_id"]]["base_failed"]]
    assert sum(r["kept"] for r in passed) >= 0.99 * len(passed)


def test_unknown_language_has_no_reference(edges):
    for r in divergence.quality_rules(edges.withColumn("lang", F.lit("xx"))).collect():
        assert r["char_distance"] is None and r["word_distance"] is None
        assert r["kept"] == (not r["base_failed"])


def test_empty_tables(spark, empty, edges, documents):
    assert divergence.quality_rules(empty).count() == 0
    none = spark.createDataFrame([], "item_id bigint, text string")
    assert decontamination.decontaminate(empty, none).count() == 0
    assert decontamination.decontaminate(edges, none).where("contaminated or n_hit > 0 or n_items > 0").count() == 0
    assert decontamination.drop_contaminated(documents, none).count() == documents.count()


def test_quality_plan_is_native(documents):
    plan = divergence.quality_rules(documents)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_quality_reads_the_texts_once(documents):
    # What is left to do reads the histograms, not the documents.
    rest = divergence.quality_rules(documents)
    assert not set(rest.inputFiles()) & set(documents.inputFiles())
    assert "split(" not in rest._jdf.queryExecution().optimizedPlan().toString()
    first = divergence.features(documents, "doc_id", "text", "lang")._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", first) and first.count("FileScan") == 1


def lowered(text):
    return TOKEN.findall((text or "").translate({i: i + 32 for i in range(65, 91)}))


@pytest.fixture(scope="module")
def benchmark(spark):
    items = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    odd = [(900, "the OF"), (901, "É"), (902, None), (903, "..."), (904, "the"), (None, "die"), (905, "text HERE"), (905, "row without a key")]
    odd += [(906, "the of"), (907, " ".join(["same"] * 12)), (908, "a b c d e f g h i j"), (909, "日本語のテキスト")]
    return items.union(spark.createDataFrame(odd, items.schema)).withColumns({"window": F.lit(1), "pos": F.lit("x")})


@pytest.fixture(scope="module")
def probed(spark, mixed):
    more = [(2000, "same " * 30), (2001, "A, b. C d e f G h-i j k"), (2002, "a b c d e f g h i X j"), (2003, "É é the")]
    rows = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in more], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    return mixed.unionByName(rows, allowMissingColumns=True)


def test_decontamination(probed, benchmark, texts):
    windows = {}
    for r in benchmark.where("item_id is not null").collect():
        w = lowered(r["text"])
        for i in range(max(1, len(w) - 9) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(str(r["item_id"]))
    lengths = {len(k) for k in windows}

    def expected(text):
        w, hit, items = lowered(text), set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                found = windows.get(tuple(w[i : i + n]))
                if found:
                    hit.update(range(i, i + n))
                    items |= found
        return len(w), len(hit), len(items), hashlib.sha256(",".join(sorted(items)).encode()).hexdigest(), bool(hit)

    got = Counter(tuple(r) for r in decontamination.decontaminate(probed, benchmark).collect())
    assert got == Counter((i, *expected(t)) for i, t in texts(probed))
    kept = Counter(r["doc_id"] for r in decontamination.drop_contaminated(probed, benchmark).collect())
    assert kept == Counter(i for i, t in texts(probed) if not expected(t)[1])


def test_joins_by_shuffle_give_the_same(probed, benchmark, monkeypatch):
    by_broadcast = Counter(tuple(r) for r in decontamination.decontaminate(probed, benchmark).collect())
    monkeypatch.setattr(decontamination, "BROADCAST_ROWS", -1)
    assert Counter(tuple(r) for r in decontamination.decontaminate(probed, benchmark).collect()) == by_broadcast


def test_proximity(spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    docs = spark.createDataFrame(
        [(1, item), (2, item.replace("delta", "oops delta")), (3, item.replace("eta theta", "eta x theta")), (4, "alpha beta and nothing else")],
        "doc_id bigint, text string",
    )
    tests = decontamination.test_windows(spark.createDataFrame([(1, item)], "item_id bigint, text string"), "item_id", "text", 10)
    words = docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("h"), F.expr(decontamination._tokens("text")).alias("tokens"))
    postings = decontamination.index(words, tests)
    assert {r["id"] for r in decontamination.phrase_matches(postings, tests).collect()} == {1}
    assert {r["id"] for r in decontamination.near_matches(postings, tests, slop=3).collect()} == {1, 2, 3}


def test_proximity_with_tokens_replaced(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()

    def without(*places):
        return " ".join(f"other{k}" if k in places else w for k, w in enumerate(words))

    lead = "some words before it and "
    near = {(i, j): without(i, j) for i in range(10) for j in range(i, 10)}
    far = [without(i, i + 2, i + 4) for i in range(6)] + ["alpha " * 10, " ".join(words[::-1]), "kappa beta " * 6]
    texts = [" ".join(words), *near.values(), *(lead + t for t in near.values()), " ".join(["x"] * 995 + words), "alpha beta gamma x delta epsilon zeta eta theta y iota kappa", *far]
    docs = spark.createDataFrame(list(enumerate(texts)) + [(None, " ".join(words)), (900, None)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(1, " ".join(words)), (2, "omega"), (None, "some words")], "item_id bigint, text string")
    got = {r["doc_id"]: (r["n_near"], r["n_near_items"]) for r in decontamination.proximity(docs, bench).collect()}
    last = len(texts) - len(far)
    assert all(got[k] == (1, 1) for k in range(last)), [texts[k] for k in range(last) if got[k] != (1, 1)]
    assert all(got[k] == (0, 0) for k in range(last, len(texts))) and got[None] == (1, 1) and got[900] == (0, 0)
    exact = decontamination.decontaminate(docs, bench).where("contaminated").select("doc_id").collect()
    assert {0, None} <= {r["doc_id"] for r in exact} <= {k for k, v in got.items() if v[0]}
    tests = decontamination.test_windows(bench, "item_id", "text", 10)
    keyed = docs.select(F.col("doc_id").alias("id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), F.expr(decontamination._tokens("coalesce(text, '')")).alias("tokens"))
    by_index = {r["id"] for r in decontamination.near_matches(decontamination.index(keyed, tests), tests).collect()}
    assert {k for k in range(last) if k < 56 and len(set(list(near)[k - 1])) == 1 or k == 0} <= by_index


def test_registered_proximity(spark):
    import sys
    from pathlib import Path

    sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
    import __spark_entry__ as entry

    exact = {r["doc_id"]: r["n_items"] for r in entry.queries()["op7_decontamination"](spark, "/root/testdata/sf0.001").collect()}
    near = {r["doc_id"]: r["n_near_items"] for r in entry.queries()["op7_proximity"](spark, "/root/testdata/sf0.001").collect()}
    assert near.keys() == exact.keys() and all(near[k] >= n for k, n in exact.items()) and any(exact.values())
