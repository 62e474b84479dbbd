"""The queries in DuckDB's SQL, where SQL can express them."""

from __future__ import annotations

from cdcmart.llm import divergence as d
from cdcmart.llm.decontamination import LOWER, UPPER, WINDOW

NOT_SPACE = r"[^\x20\x09-\x0D]+"


def _list(words: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _distance(p: str, q: str) -> str:
    """Jensen-Shannon distance between two lists of shares."""
    pair = f"list_zip({p}, {q})"
    term = "case when z[{i}] > 0 then z[{i}] * log2(z[{i}] / ((z[1] + z[2]) / 2)) else 0.0 end"
    return f"sqrt(greatest(list_sum(list_transform({pair}, lambda z: {term.format(i=1)} + {term.format(i=2)})) / 2, 0.0))"


def _quality() -> str:
    lists = " ".join(f"when '{k}' then {_list(v)}" for k, v in d.COMMON_WORDS.items())
    counts = ", ".join(f"length(regexp_replace(j, '{c}', '', 'g'))" for c in d.CLASSES)
    share = lambda x: f"list_transform({x}, lambda v: v / list_sum({x}))"
    n = len(d.CLASSES) + 1
    summed = lambda x, k: "[" + ", ".join(f"sum({x}[{i}])::double" for i in range(1, k + 1)) + "]"
    return rf"""
    with texts as (
      select doc_id, coalesce(text, '') as t, lang, regexp_extract_all(coalesce(text, ''), '{NOT_SPACE}') as w from documents),
    parts as (
      select *, array_to_string(w, '') as j, case lang {lists} else []::varchar[] end as common,
             list_transform(w, lambda x: lower(x)) as lw,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{NOT_SPACE}')) as ls
      from texts),
    counted as (
      select doc_id, lang, w, common, len(w) as n_words, length(j) as word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g')) as n_symbols, len(ls) - len(list_distinct(ls)) as n_dup_lines,
             [{counts}] as cls, list_transform(common, lambda c: len(list_filter(lw, lambda x: x = c))) as hits
      from parts),
    bins as (
      select *, list_append(cls, word_chars - list_sum(cls))::double[] as c,
             list_append(list_resize(hits, {d.BINS - 1}, 0), n_words - coalesce(list_sum(hits), 0))::double[] as b
      from counted),
    refs as (
      select lang, {summed("c", n)} as rc, {summed("b", d.BINS)} as rb from bins
      where n_words >= {d.LEAST_COUNTED} and lang in {tuple(d.COMMON_WORDS)} group by lang),
    positions as (select doc_id, w, unnest(range(1, len(w) - 1)) as i from bins),
    tri as (select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2]) as n from positions),
    repeated as (
      select doc_id, count(distinct i + k) as n_repeat_words from tri, (select unnest([0, 1, 2]) as k) where n > 1 group by doc_id),
    judged as (
      select doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) as n_repeat_words,
             n_words < {d.LEAST_WORDS} or 100 * coalesce(n_repeat_words, 0) > {d.MOST_REPEATED} * n_words as base_failed,
             case when word_chars > 0 and rc is not null then {_distance(share("c"), share("rc"))} end as cd,
             case when n_words > 0 and rb is not null then {_distance(share("b"), share("rb"))} end as wd
      from bins left join refs using (lang) left join repeated using (doc_id))
    select doc_id, n_words::bigint as n_words, word_chars::bigint as word_chars, n_symbols::bigint as n_symbols,
           n_dup_lines::bigint as n_dup_lines, n_repeat_words::bigint as n_repeat_words, base_failed,
           not base_failed and not coalesce(word_chars >= {d.LEAST_CHARS} and cd > {d.CHAR_LIMIT}, false)
             and not coalesce(n_words >= {d.LEAST_COUNTED} and wd > {d.WORD_LIMIT}, false) as kept
    from judged"""


def decontamination(documents: str = "documents") -> str:
    """The windows of the items looked up among all windows, of every length they have, of the documents."""
    words = r"regexp_extract_all(translate(coalesce(text, ''), '{}', '{}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')".format(UPPER, LOWER)
    return rf"""
    with tests as (select cast(item_id as varchar) as item, {words} as w from benchmark where item_id is not null),
    cut as (
      select item, unnest(list_transform(range(1, greatest(len(w) - {WINDOW - 1}, 1) + 1), lambda i: w[i : i + {WINDOW - 1}])) as win
      from tests where len(w) > 0),
    wins as (select distinct item, len(win) as n, array_to_string(win, ' ') as s from cut),
    docs as (select doc_id, {words} as w from {documents}),
    starts as (select doc_id, w, unnest(range(1, len(w) + 1)) as i from docs),
    found as (
      select doc_id, i, n, item from (
        select doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') as s from starts, (select distinct n from wins) where i + n - 1 <= len(w))
      join wins using (n, s)),
    hit as (
      select doc_id, count(distinct p) as n_hit from (select doc_id, unnest(range(i, i + n)) as p from (select distinct doc_id, i, n from found))
      group by doc_id),
    items as (select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as s from (select distinct doc_id, item from found) group by doc_id)
    select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
           sha256(coalesce(s, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
    from docs left join hit using (doc_id) left join items using (doc_id)"""


PREFIX_TRIE = """
WITH turns AS (
  SELECT conv_id, COALESCE(role, '') AS role, COALESCE(text, '') AS text,
         ROW_NUMBER() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(CONCAT(length(COALESCE(role, '')), ':', COALESCE(role, ''), ':', COALESCE(text, '')))) AS k
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base,
         -- CRC-32, a byte at a time
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
             lambda acc, b: list_reduce(list_prepend(xor(acc, b), range(8)),
                                        lambda v, i: xor(v >> 1, CASE WHEN v % 2 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)),
heads AS (
  SELECT c.conv_id, t.k AS depth, t.role, t.text FROM convs c JOIN turns t ON t.conv_id = c.base AND t.k <= c.h),
rebuilt AS (
  SELECT * FROM heads
  UNION ALL
  SELECT c.conv_id, COALESCE(n, 0) + t.k - c.h AS depth, t.role, t.text
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.k > c.h
  LEFT JOIN (SELECT conv_id, COUNT(*) AS n FROM heads GROUP BY conv_id) g ON g.conv_id = c.conv_id),
paths AS (
  SELECT conv_id, 0 AS depth, '' AS path, 0 AS bytes FROM convs
  UNION ALL
  SELECT conv_id, depth, string_agg(sha256(CONCAT(length(role), ':', role, ':', text)), '') OVER (PARTITION BY conv_id ORDER BY depth), strlen(text)
  FROM rebuilt),
marked AS (
  SELECT conv_id, depth, sha256(path) AS node, bytes, LAG(sha256(path)) OVER (PARTITION BY conv_id ORDER BY depth) AS up,
         depth = MAX(depth) OVER (PARTITION BY conv_id) AS ends
  FROM paths),
nodes AS (
  SELECT node, depth, MIN(conv_id) AS conv_id, ANY_VALUE(up) AS up, COUNT(*) AS n_convs, (COUNT(*) - 1) * ANY_VALUE(bytes) AS saved,
         sha256(COALESCE(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
  FROM marked GROUP BY node, depth),
children AS (SELECT up AS node, COUNT(*) AS n_children FROM nodes WHERE up IS NOT NULL GROUP BY up),
sums AS (
  SELECT m.node, SUM(n.saved) AS saved_tokens, SUM(CASE WHEN c.node IS NULL THEN 1 ELSE 0 END) AS n_leaves
  FROM nodes n JOIN marked m ON m.conv_id = n.conv_id AND m.depth <= n.depth LEFT JOIN children c ON c.node = n.node
  GROUP BY m.node)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, COALESCE(c.n_children, 0)::BIGINT AS n_children,
       s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes p ON p.node = n.up LEFT JOIN children c ON c.node = n.node JOIN sums s ON s.node = n.node"""

WINDOWS = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS k, len(w) AS n FROM docs),
windows AS (
  SELECT doc_id, k, n, md5(string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY k ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING)) AS h
  FROM words WHERE n >= 50),
least AS (SELECT h, MIN(doc_id) AS least FROM windows WHERE k + 50 <= n GROUP BY h),
begins AS (SELECT doc_id, k FROM windows JOIN least USING (h) WHERE k + 50 <= n AND least < doc_id),
marked AS (
  SELECT w.doc_id, w.k, w.word,
         COUNT(b.k) OVER (PARTITION BY w.doc_id ORDER BY w.k ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) > 0 AS gone
  FROM words w LEFT JOIN begins b ON b.doc_id = w.doc_id AND b.k = w.k),
kept AS (
  SELECT doc_id, COUNT(*) AS n_words, COUNT(*) FILTER (WHERE gone) AS n_removed, string_agg(word, ' ' ORDER BY k) FILTER (WHERE NOT gone) AS t
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, COALESCE(n_words, 0) AS n_words, COALESCE(n_removed, 0) AS n_removed, sha256(COALESCE(t, '')) AS kept_sha256
FROM docs d LEFT JOIN kept USING (doc_id)"""


ORACLE: dict[str, str] = {
    "op1_quality": _quality(),
    "op7_decontamination": decontamination(),
    "op12_prefix_trie": PREFIX_TRIE,
    "op13_windows": WINDOWS,
}
