"""Benchmark decontamination by a distributed positional inverted index.

The index stores where training tokens stand: (token, document, position). A posting is stored only where the token
and its neighbour are neighbours in some test item as well (or the token is an item of its own), since no other token
can be part of a phrase; the pairs come from the tests, so the stored part of the corpus stays small. Each window of a
test item then intersects its posting lists, shifted by their offsets, from its rarest token on: the rarest list gives
candidate starts, the next rarest thins them out, the rest confirm them. Proximity matches (altered copies) have a result of their own, ``proximity``.

Tokens are compared by 64-bit hash. Everything is DataFrame and SQL expressions.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cdcmart.llm.common import stored

WINDOW = 10
# Most rows of a table derived from the benchmark that are sent to all executors; larger ones are joined by shuffle.
BROADCAST_ROWS = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
DOC = ["id", "h"]  # a document: its key and the hash of its text


def _tokens(text: str) -> str:
    """SQL: hashes of the words of ``text``, with A-Z, and only these, in lower case."""
    words = f"filter(split({text}, r'{SEPARATORS}'), x -> x <> '')"
    lower = f"if(octet_length(x) = char_length(x), lower(x), translate(x, '{UPPER}', '{LOWER}'))"
    return f"transform({words}, x -> xxhash64({lower}))"


def _sent(df: DataFrame, rows: int) -> DataFrame:
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


class Tests(NamedTuple):
    """``windows``: window, tokens; ``items``: window, item; ``terms``: window, n, offset, token; with their sizes."""

    windows: DataFrame
    items: DataFrame
    n_windows: int
    pairs: DataFrame
    n_pairs: int
    singles: bool


def test_windows(benchmark: DataFrame, item_col: str, text_col: str, size: int) -> Tests:
    """Windows of ``size`` tokens of every item; an item of fewer is one window. Equal windows count once."""
    rows = benchmark.select(F.col(f"`{item_col}`").cast("string").alias("item"), F.col(f"`{text_col}`").cast("string").alias("text"))
    rows = rows.where(F.col("item").isNotNull() & F.col("text").isNotNull()).select("item", F.expr(_tokens("text")).alias("t"))
    cut = F.expr(f"transform(sequence(0, greatest(size(t) - {size}, 0)), i -> slice(t, i + 1, {size}))")
    cut = rows.where(F.size("t") > 0).select("item", F.explode(cut).alias("tokens")).dropDuplicates()
    cut = stored(cut.select("item", "tokens", F.xxhash64("tokens").alias("window")), "test_windows")
    items = cut.select("window", "item").dropDuplicates()
    windows = cut.select("window", "tokens").dropDuplicates(["window"])
    pair = F.expr("transform(sequence(1, size(tokens) - 1), i -> xxhash64(tokens[i - 1], tokens[i]))")
    pairs = windows.where(F.size("tokens") > 1).select(F.explode(pair).alias("pair")).dropDuplicates()
    # A token that is a window by itself is a pair with nothing.
    alone = windows.where(F.size("tokens") == 1).select(F.expr("xxhash64(tokens[0])").alias("pair"))
    singles = not alone.isEmpty()
    return Tests(windows, items, windows.count(), pairs.union(alone), pairs.count() + (alone.count() if singles else 0), singles)


def index(docs: DataFrame, tests: Tests) -> DataFrame:
    """Postings ``id, h, token, pos`` of the tokens that could be part of a phrase of the tests, written once."""
    # A position carries its token and the next one; behind the last one there is none.
    entry = """transform(array(tokens), a -> transform(a, (x, i) ->
        struct(i as pos, x as x, if(i + 1 < size(a), a[least(i + 1, size(a) - 1)], null) as n)))[0]"""
    at = docs.select("id", "h", F.explode(F.expr(entry)).alias("e")).select("id", "h", "e.*")
    if tests.singles:
        at = at.withColumn("pair", F.explode(F.array(F.xxhash64("x", "n"), F.xxhash64("x"))))
    else:
        at = at.withColumn("pair", F.xxhash64("x", "n"))
    at = at.join(_sent(tests.pairs, tests.n_pairs), "pair")
    ends = F.array(F.struct("pos", F.col("x").alias("token")), F.struct((F.col("pos") + 1).alias("pos"), F.col("n").alias("token")))
    found = at.select("id", "h", F.explode(ends).alias("e")).select("id", "h", "e.token", "e.pos").where(F.col("token").isNotNull())
    return stored(found.dropDuplicates(), "postings")


def phrase_matches(postings: DataFrame, tests: Tests) -> DataFrame:
    """Exact matches ``id, h, window, start, n``."""
    frequency = postings.groupBy("token").count()
    terms = tests.windows.select("window", F.size("tokens").alias("n"), F.posexplode("tokens").alias("offset", "token"))
    # Tokens of a window by rising frequency; one that the index lacks makes the window impossible.
    by_rarity = Window.partitionBy("window").orderBy("count", "offset")
    known = terms.join(frequency, "token").withColumn("rank", F.row_number().over(by_rarity))
    known = stored(known.withColumn("found", F.count("*").over(Window.partitionBy("window"))).where("found = n"), "ranked_terms")
    rows = tests.n_windows * WINDOW
    first = known.where("rank = 1").select("window", "n", "token", "offset")
    starts = postings.join(_sent(first, tests.n_windows), "token").withColumn("start", F.col("pos") - F.col("offset"))
    starts = starts.where("start >= 0").select(*DOC, "window", "n", "start")
    second = known.where("rank = 2").select("window", "token", "offset")
    lists = postings.select(*DOC, "token", "pos")

    def confirmed(candidates: DataFrame, by: DataFrame) -> DataFrame:
        wanted = candidates.join(_sent(by, rows), "window").withColumn("pos", F.col("start") + F.col("offset"))
        return wanted.join(lists, [wanted["id"].eqNullSafe(lists["id"])] + [wanted[c] == lists[c] for c in ("h", "token", "pos")]).select(
            wanted["id"], wanted["h"], "window", "n", "start"
        )

    two = confirmed(starts.where("n >= 2"), second)
    rest = known.where("rank > 2").select("window", "token", "offset")
    three = confirmed(two.where("n >= 3"), rest).groupBy(*DOC, "window", "n", "start").count().where("count = n - 2").drop("count")
    return stored(starts.where("n = 1").union(two.where("n = 2")).union(three), "phrases")


def _words(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    keyed = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    return keyed.select("id", F.xxhash64("text").alias("h"), F.expr(_tokens("text")).alias("tokens"))


def near_matches(postings: DataFrame, tests: Tests, slop: int = 3, share: float = 0.8) -> DataFrame:
    """``near_in`` for the tokens of an index alone; the places that it leaves out match nothing."""
    at = postings.groupBy(*DOC).agg(F.map_from_entries(F.collect_set(F.struct("pos", "token"))).alias("at"), F.max("pos").alias("last"))
    return near_in(at.select(*DOC, F.expr("transform(sequence(0, last), p -> try_element_at(at, p))").alias("tokens")), tests, slop, share)


def near_in(words: DataFrame, tests: Tests, slop: int = 3, share: float = 0.8) -> DataFrame:
    """Proximity matches ``id, h, window, start`` in ``id, h, tokens``: at least ``share`` of the tokens of a window, each
    within ``slop`` positions of where it belongs for the same start. Of the starts around one place, the best counts.

    If m tokens of a window may be missing, one of its rarest m + 1 is there. That one, beside another token of the
    window, both in the order of the window and at most m + 1 apart in window and text, makes a place to look at. So
    nothing with up to m tokens replaced is missed; what has none of these pairs is no match.
    """
    size = tests.windows.agg(F.max(F.size("tokens"))).first()[0] or 1
    need = f"cast(ceil(size(tokens) * {share} - 1e-9) as int)"
    windows = tests.windows.withColumn("need", F.expr(need)).withColumnRenamed("tokens", "w")
    apart = max(windows.agg(F.max(F.size("w") - F.col("need"))).first()[0] or 0, 0) + 1
    terms = windows.select("window", F.size("w").alias("n"), "need", F.posexplode("w").alias("offset", "token"))
    vocabulary = terms.select("token").dropDuplicates()
    frequency = words.select(F.explode("tokens").alias("token")).join(_sent(vocabulary, tests.n_windows * WINDOW), "token").groupBy("token").count()
    rarity = Window.partitionBy("window").orderBy(F.coalesce("count", F.lit(0)), "offset")
    rare = terms.join(frequency, "token", "left").withColumn("rank", F.row_number().over(rarity)).where("rank <= n - need + 1")
    rare = rare.groupBy("window").agg(F.collect_set("offset").alias("rare"))
    pair = """flatten(transform(sequence(0, size(w) - 1), i -> transform(
        filter(sequence(1, size(w) - need + 1), g -> i + g < size(w) and (array_contains(rare, i) or array_contains(rare, i + g))),
        g -> struct(xxhash64(w[i], w[i + g]) as pair, i as offset))))"""
    alone = "array(struct(xxhash64(w[0]) as pair, 0 as offset))"
    anchors = windows.join(rare, "window").select("window", F.explode(F.expr(f"if(size(w) = 1, {alone}, {pair})")).alias("a"))
    anchors = stored(anchors.select("window", "a.*").dropDuplicates(), "anchors")
    # Positions meet the anchors by their pairs alone. What stands around them is fetched for the places found only: from
    # parts of the texts, so that a row stays small however long a text is.
    beside = [f"xxhash64(tokens[p], get(tokens, p + {g}))" for g in range(1, apart + 1)]
    keys = f"array_distinct(array({', '.join(beside + ['xxhash64(tokens[p])'] * tests.singles)}))"
    entry = f"transform(sequence(0, size(tokens) - 1), p -> struct(p as pos, {keys} as pairs))"
    texts = words.where(F.size("tokens") > 0)
    at = texts.select(*DOC, F.explode(F.expr(entry)).alias("e")).select(*DOC, "e.pos", F.explode("e.pairs").alias("pair"))
    at = at.join(_sent(anchors, anchors.count()), "pair").withColumn("d", F.col("pos") - F.col("offset"))
    at = stored(at.groupBy(*DOC, "window", "d").agg(F.min("pos").alias("pos")), "near_places")
    around, part = size - 1 + 2 * slop, 1000
    parts = f"""transform(sequence(0, (size(tokens) - 1) div {part}), k -> struct(cast(k * {part} as int) as first,
        slice(tokens, cast(greatest(k * {part} - {around}, 0) as int) + 1, {part + 2 * around}) as c))"""
    cut = texts.select(F.col("id").alias("of_id"), F.col("h").alias("of_h"), F.explode(F.expr(parts)).alias("p")).select("of_id", "of_h", "p.*")
    same = F.col("id").eqNullSafe(F.col("of_id")) & (F.col("h") == F.col("of_h")) & (F.expr(f"pos - pos % {part}") == F.col("first"))
    begin = F.greatest(F.col("pos") - around, F.lit(0))
    shown = F.slice("c", begin - F.greatest(F.col("first") - around, F.lit(0)) + 1, F.lit(2 * around + 1)).alias("c")
    at = at.join(cut, same).select(*DOC, "window", "d", "pos", begin.alias("from"), shown)
    at = at.join(_sent(windows, tests.n_windows), "window")
    at = at.where("size(filter(w, x -> array_contains(c, x))) >= need")
    # A token that a window has twice must be there twice.
    twice = "aggregate(array_distinct(w), 0, (n, x) -> n + least(size(filter(w, y -> y = x)), size(filter(c, y -> y = x))))"
    at = at.where(f"{twice} >= need")
    low, high = f"greatest(s + i - {slop} - from, 0)", f"s + i + {slop} - from"
    count = f"size(filter(sequence(0, size(w) - 1), i -> array_contains(slice(c, {low} + 1, greatest({high} + 1 - {low}, 0)), w[i])))"
    best = f"array_max(transform(sequence(d - {slop}, d + {slop}), s -> struct({count} as n, -abs(s - d) as off, s as start)))"
    found = at.select(*DOC, "window", "need", F.expr(best).alias("best")).where("best.n >= need")
    return stored(found.select(*DOC, "window", "best.start").dropDuplicates(), "near")


def proximity(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", size: int = WINDOW,
) -> DataFrame:
    """``id_col, n_near, n_near_items, near_items_sha256`` per row of ``docs``: windows with a proximity match, and their
    items. Exact matches are among them. Rows, keys and NULLs as in ``decontaminate``, whose verdict this leaves alone."""
    tests = test_windows(benchmark, item_col, item_text_col, size)
    words = _words(docs, id_col, text_col)
    found = near_in(words, tests).select(*DOC, "window").dropDuplicates()
    windows = found.groupBy(*DOC).count()
    of_items = found.join(_sent(tests.items, tests.n_windows), "window").groupBy(*DOC).agg(F.array_sort(F.collect_set("item")).alias("items"))
    result = words.select(*DOC)
    for part in (windows, of_items):
        part = part.withColumnsRenamed({"id": "other_id", "h": "other_h"})
        result = result.join(part, result["id"].eqNullSafe(part["other_id"]) & (result["h"] == part["other_h"]), "left").drop("other_id", "other_h")
    return result.select(
        F.col("id").alias(id_col), F.coalesce("count", F.lit(0)).alias("n_near"),
        F.when(F.col("items").isNotNull(), F.size("items")).otherwise(0).cast("bigint").alias("n_near_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("near_items_sha256"),
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", size: int = WINDOW,
) -> DataFrame:
    """``id_col, n_words, n_hit, n_items, items_sha256, contaminated`` per row of ``docs``.

    A NULL text has no words. Items with a NULL id or without words match nothing; of items that share an id the
    windows are taken together. Repeated rows and NULL keys give a row each, with equal results for equal rows. Other
    columns are not read. An empty benchmark leaves every document clean.
    """
    tests = test_windows(benchmark, item_col, item_text_col, size)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    keyed = docs.select(F.col(f"`{id_col}`").alias("id"), text.alias("text"))
    words = keyed.select("id", F.xxhash64("text").alias("h"), F.expr(_tokens("text")).alias("tokens"))
    found = phrase_matches(index(words, tests), tests)
    # Covered positions: what each match adds to those that start before it.
    spans = found.groupBy(*DOC, "start").agg(F.max(F.col("start") + F.col("n")).alias("end"))
    before = F.max("end").over(Window.partitionBy(*DOC).orderBy("start").rowsBetween(Window.unboundedPreceding, -1))
    added = F.greatest(F.col("end") - F.greatest("start", F.coalesce(before, F.lit(0))), F.lit(0))
    hits = spans.withColumn("added", added).groupBy(*DOC).agg(F.sum("added").cast("bigint").alias("n_hit"))
    of_items = found.select(*DOC, "window").dropDuplicates().join(_sent(tests.items, tests.n_windows), "window")
    of_items = of_items.groupBy(*DOC).agg(F.array_sort(F.collect_set("item")).alias("items"))
    counts = keyed.select("id", F.xxhash64("text").alias("h"), F.expr(f"cast(size(filter(split(text, r'{SEPARATORS}'), x -> x <> '')) as bigint)").alias("n_words"))
    result = counts
    for part in (hits, of_items):
        part = part.withColumnsRenamed({"id": "other_id", "h": "other_h"})
        result = result.join(part, result["id"].eqNullSafe(part["other_id"]) & (result["h"] == part["other_h"]), "left").drop("other_id", "other_h")
    return result.select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_hit", F.lit(0)).alias("n_hit"),
        F.when(F.col("items").isNotNull(), F.size("items")).otherwise(0).cast("bigint").alias("n_items"),
        F.sha2(F.coalesce(F.array_join("items", ","), F.lit("")), 256).alias("items_sha256"),
        (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
    item_text_col: str = "text", size: int = WINDOW,
) -> DataFrame:
    """The rows of ``docs`` that hold no window of the benchmark, whole."""
    tests = test_windows(benchmark, item_col, item_text_col, size)
    id_, text = F.col(f"`{id_col}`"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    words = docs.select(id_.alias("id"), text.alias("text")).select("id", F.xxhash64("text").alias("h"), F.expr(_tokens("text")).alias("tokens"))
    hit = stored(phrase_matches(index(words, tests), tests).select(*DOC).dropDuplicates(), "contaminated")
    hit = _sent(hit.withColumnsRenamed({"id": "__id", "h": "__h"}), hit.count())
    return docs.join(hit, id_.eqNullSafe(F.col("__id")) & (F.xxhash64(text) == F.col("__h")), "left_anti")
