"""Quality rules from distributions: how far a document lies from its language.

Two histograms describe a document: its characters by class, and its words by a short list of common words of its
language with one bin for all others. The references are the same histograms summed over all documents of the
language that are long enough. A document whose Jensen-Shannon distance from a reference
exceeds the limit is dropped; below a least length a histogram says too little, and its rule abstains.

Everything is SQL expressions. One pass reads the texts and writes the histograms, a few numbers per document; the
references, a row for each of the listed languages, are added up from those and then applied to them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdcmart.llm.common import stored

# Frequent words by language.
COMMON_WORDS = {
    "en": ("the", "of", "and", "to", "a", "in", "that", "is", "was", "for", "it", "with"),
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "nicht"),
    "es": ("de", "la", "que", "el", "en", "y", "a", "los", "se", "del", "las", "un"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "dans"),
}
BINS = 1 + max(map(len, COMMON_WORDS.values()))
SPACE = r"\x20\x09-\x0D"
# What is left of a word's characters when all others are removed; the last class is the rest.
CLASSES = ("[^a-z]+", "[^A-Z]+", "[^0-9]+", r"[^!-/:-@\[-`{-~]+", r"[\x00-\x7F]+")

LEAST_WORDS, MOST_REPEATED = 50, 50  # base rules
LEAST_CHARS, LEAST_COUNTED = 200, 100  # characters and words a histogram needs to be judged
CHAR_LIMIT, WORD_LIMIT = 0.28, 0.3


def features(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """Histograms and the counts of the base rules. A text is split once: what depends on its words is computed inside
    a lambda over them."""
    known = ", ".join(f"'{w}'" for w in sorted({w for ws in COMMON_WORDS.values() for w in ws}))
    lists = " ".join(f"when '{k}' then array({', '.join(repr(w) for w in v)})" for k, v in COMMON_WORDS.items())
    classes = ", ".join(f"length(regexp_replace(j, r'{c}', ''))" for c in CLASSES)
    # Positions of 3-word windows that occur again: equal hashes are neighbours after sorting.
    repeated = """
        case when size(h) = size(array_distinct(h)) then 0L else
        transform(array(sort_array(transform(h, (x, i) -> struct(x as x, i as i)))), s ->
          transform(array(sort_array(transform(
              filter(s, (e, k) -> (k > 0 and s[greatest(k - 1, 0)].x = e.x)
                               or (k < size(s) - 1 and s[least(k + 1, size(s) - 1)].x = e.x)),
              e -> e.i))), p ->
            aggregate(transform(p, (x, k) -> if(k = 0, 3, least(3, x - p[greatest(k - 1, 0)]))), 0L, (a, x) -> a + x)
          )[0])[0] end"""
    base_fields = f"""
        , cast(length(array_join(w, '')) as bigint) as word_chars
        , case when size(w) < 3 then 0L else
          transform(array(transform(sequence(0, size(w) - 3), i -> xxhash64(w[i], w[i + 1], w[i + 2]))), h -> {repeated})[0]
          end as n_repeat_words"""
    of_words = f"""
        transform(array(case when t = '' then cast(array() as array<string>) else split(t, r'[{SPACE}]+') end), w ->
          struct(cast(size(w) as bigint) as n_words,
                 transform(array(array_join(w, '')), j -> array(cast(length(j) as int), {classes}))[0] as chars,
                 transform(array(filter(transform(w, x -> lower(x)), x -> x in ({known}))), m ->
                   transform(common, c -> size(filter(m, x -> x = c))))[0] as hits
                 {base_fields}))[0]"""
    lines = "transform(array(filter(split(text, '\\n'), l -> length(btrim(l, spaces)) > 0)), l -> cast(size(l) - size(array_distinct(l)) as bigint))[0]"
    rows = docs.select(
        F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
        F.col(f"`{lang_col}`").cast("string").alias("lang"), F.lit(" \t\n\x0b\f\r").alias("spaces"),
    )
    rows = rows.withColumns({"t": F.expr("btrim(text, spaces)"), "common": F.expr(f"case lang {lists} else cast(array() as array<string>) end")})
    symbols = r"cast(length(regexp_replace(text, r'[^#*$%&|<>]+', '')) as bigint)"
    columns = [F.col("id"), F.col("lang"), F.expr(of_words).alias("f"), F.expr(lines).alias("n_dup_lines"), F.expr(symbols).alias("n_symbols")]
    return rows.select(*columns).select("*", "f.*").drop("f")


def _bins(df: DataFrame) -> DataFrame:
    """Counts as columns: the classes ``c0..`` with the rest, the common words ``w0..`` with the others."""
    n = len(CLASSES)
    chars = {f"c{i}": F.col("chars")[i + 1].cast("double") for i in range(n)}
    chars[f"c{n}"] = F.col("chars")[0].cast("double") - sum((F.col("chars")[i + 1] for i in range(n)), F.lit(0))
    hits = {f"w{i}": F.coalesce(F.get("hits", F.lit(i)), F.lit(0)).cast("double") for i in range(BINS - 1)}
    hits[f"w{BINS - 1}"] = F.col("n_words").cast("double") - F.aggregate("hits", F.lit(0), lambda a, x: a + x)
    return df.withColumns({**chars, **hits}).drop("chars", "hits")


NAMES = {"c": [f"c{i}" for i in range(len(CLASSES) + 1)], "w": [f"w{i}" for i in range(BINS)]}


def references(rows: DataFrame) -> DataFrame:
    """One row per listed language with documents to learn from, of the histograms in ``rows``: ``lang`` and the shares
    ``r_c0.., r_w0..``."""
    names = NAMES["c"] + NAMES["w"]
    long_enough = rows.where(F.col("lang").isin(*COMMON_WORDS) & (F.col("n_words") >= LEAST_COUNTED))
    sums = long_enough.groupBy("lang").agg(*[F.sum(c).alias(c) for c in names])
    shares = [(F.col(c) / sum((F.col(o) for o in NAMES[c[0]]), F.lit(0.0))).alias(f"r_{c}") for c in names]
    return sums.select("lang", *shares)


def _distance(names: list[str]) -> Column:
    """Jensen-Shannon distance, base 2, between the counts in ``names`` and the shares in ``r_*``; NULL if either side
    is empty."""
    total = sum((F.col(c) for c in names), F.lit(0.0))
    terms = F.lit(0.0)
    for c in names:
        p, q = F.try_divide(F.col(c), total), F.col(f"r_{c}")
        m = (p + q) / 2
        terms = terms + F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)
    return F.when((total > 0) & F.col(f"r_{names[0]}").isNotNull(), F.sqrt(F.greatest(terms / 2, F.lit(0.0))))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``id_col, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, char_distance,
    word_distance`` per row of ``docs``.

    A NULL text has no words and fails the base rules. A NULL language, or one without a list or without documents to
    learn from, has no reference: both distances are NULL and only the base rules count. Repeated rows and NULL keys
    give a row each; other columns are not read. Windows are compared by 64-bit hash within one document.
    """
    rows = _bins(stored(features(docs, id_col, text_col, lang_col), "histograms"))
    # The references are at most one row per listed language.
    known = F.broadcast(references(rows))
    judged = rows.join(known, "lang", "left").withColumns({"char_distance": _distance(NAMES["c"]), "word_distance": _distance(NAMES["w"])})
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    far = F.coalesce(
        ((F.col("word_chars") >= LEAST_CHARS) & (F.col("char_distance") > CHAR_LIMIT))
        | ((F.col("n_words") >= LEAST_COUNTED) & (F.col("word_distance") > WORD_LIMIT)),
        F.lit(False),
    )
    return judged.select(
        F.col("id").alias(id_col), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~far).alias("kept"), "char_distance", "word_distance",
    )
