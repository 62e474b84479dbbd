"""Alignment, prefix trie and repeated windows against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from cdcmart.llm import alignment, prefix_trie, window_dedup

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


# Alignment


def groups_of(own, text):
    """(a, b) of each group, by the sets of end offsets; None where a side does not give the bytes back."""
    if not text:
        return None
    data = b" " + text.encode()
    a = own.a.encode(" " + text, add_special_tokens=False).ids
    b = own.b.encode(text)
    if b"".join(own.a_bytes[i] for i in a) != data or b"".join(own.b_bytes[i] for i in b) != data:
        return None

    def ends(ids, table):
        out, at = [], 0
        for i in ids:
            at += len(table[i])
            out.append(at)
        return out

    a_ends, b_ends = ends(a, own.a_bytes), ends(b, own.b_bytes)
    out, i, j = [], 0, 0
    for end in sorted(set(a_ends) & set(b_ends)):
        p, q = a_ends.index(end, i) + 1, b_ends.index(end, j) + 1
        out.append((a[i:p], b[j:q]))
        i, j = p, q
    return out


def aligned_by_hand(texts):
    own = alignment.aligner("byte_bpe_50k.json", "piece_bpe_32k.model")
    groups = [groups_of(own, t) for _, t in texts]
    count = Counter((a[-1], b[-1]) for g in groups for a, b in g or ())
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    out = []
    for (i, _), g in zip(texts, groups):
        links = [(a[-1], b[-1]) for a, b in g or ()]
        text = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in g or ())
        out.append((
            i, sum(len(a) for a, _ in g or ()), sum(len(b) for _, b in g or ()), len(links), len(links),
            sum(count[p] == most[p[1]] for p in links), sum(count[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if g else "",
        ))
    return sorted(out, key=repr)


STRANGE = [
    (21, "a▁b ▁"), (22, " leading  and   inner  spaces "), (23, "x" * 3000), (24, "日本語テキスト" * 300), (25, "tab\tnul\x00 <0x0A> <s> </s> <unk> <|endoftext|>"),
    (26, "½ ﬁ é é 　 \xa0 ​ 😀👩‍👩‍👧"), (27, "a b c d e f g h i j k l m n o p q r s t u v w x y z " * 40), (28, "\n\n\n"), (29, " "),
]


@pytest.mark.parametrize("options", [{}, {"long_chars": 300, "range_bytes": 64, "fan_in": 3}, {"long_chars": 20, "range_bytes": 50, "fan_in": 2, "max_pairs": 10}])
def test_alignment(spark, documents, edges, texts, with_clash, options):
    docs = with_clash(documents.limit(60)).union(edges).union(with_clash(spark.createDataFrame([(i, t, "", "", 0) for i, t in STRANGE], COLUMNS)))
    got = alignment.align(docs, **options)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == aligned_by_hand(texts(docs))


def test_texts_put_together_from_pieces():
    own = alignment.Aligner("byte_bpe_50k.json", "piece_bpe_32k.model")
    rng = random.Random(9)
    words = ["a", "bc", "日本", "x\ny", "é", "12.5", "▁", "don't", "", "", "\n", "\t", "\xa0", "zz" * 40]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 12))) for _ in range(800)]
    for got, text in zip([r for k in range(0, 800, 100) for r in own.texts(texts[k : k + 100])], texts):
        want = alignment.whole(own.text(text))
        assert got[:3] == want[:3] and got[3].tolist() == want[3].tolist(), text


def test_alignment_of_nothing(empty):
    assert alignment.align(empty).collect() == []


def test_fragments_are_a_monoid():
    own = alignment.aligner("byte_bpe_50k.json", "piece_bpe_32k.model")
    text = "Zusammensetzungen unbelievably 12345 日本語 " * 20
    parts = [f for _, f in own.ranges(text, 0, 7)]
    want = alignment.whole(own.text(text))
    assert own.texts([text])[0][:3] == want[:3]
    rng = random.Random(3)
    for _ in range(20):
        fragments = [alignment.Fragment(), *parts, alignment.Fragment()]
        while len(fragments) > 1:  # any bracketing
            i = rng.randrange(len(fragments) - 1)
            fragments[i : i + 2] = [alignment.compose(*fragments[i : i + 2])]
        got = alignment.whole(fragments[0])
        assert got[:3] == want[:3] and got[3].tolist() == want[3].tolist()


# Prefix trie


def trie_by_hand(rows, heads=5, turns=9):
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role)}:{role}:{text}".encode()).hexdigest()
            convs[c].append((turn is not None, turn, digest, role, text))
    own = {c: [(r, t) for *_, r, t in sorted(v)] for c, v in convs.items()}
    nodes = defaultdict(list)
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % turns
        new = own.get(c - c % heads, [])[:h] + v[h:]
        for d in range(len(new) + 1):
            nodes[tuple(new[:d])].append((c, len(new)))
    children = defaultdict(list)
    for n in nodes:
        if n:
            children[n[:-1]].append(n)
    leaves, saved = {}, {}
    for n in sorted(nodes, key=len, reverse=True):
        leaves[n] = sum(leaves[x] for x in children[n]) or 1
        saved[n] = (len(nodes[n]) - 1) * (len(n[-1][1].encode()) if n else 0) + sum(saved[x] for x in children[n])
    out = []
    for n, members in nodes.items():
        ends = ",".join(str(c) for c in sorted(c for c, k in members if k == len(n)))
        parent = min(c for c, _ in nodes[n[:-1]]) if n else None
        out.append((min(c for c, _ in members), len(n), parent, len(members), len(children[n]), leaves[n], saved[n], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(rng, n, words="ab"):
    rows = []
    for c in range(n):
        for turn in range(rng.choice([0, 1, 1, 2, 3, 12])):
            rows.append((c, rng.choice([turn, turn, None]), rng.choice(["u", "a", None]) if c % 3 else "u", rng.choice([*words, "", None])))
    return rows + rng.sample(rows, min(3, len(rows)))


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("block_rows", [1, 7, 20_000])
def test_trie(spark, seed, block_rows):
    rng = random.Random(seed)
    rows = conversations(rng, [3, 40, 150][seed % 3])
    rows += [(None, 1, "u", "x")] * 2
    if seed == 4:  # a third of all conversations are alike
        rows += [(c, 0, "u", "hot") for c in range(200, 300)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").selectExpr("*", "'x' AS digests", "1 AS block", "2 AS first", "3 AS depth")
    got = prefix_trie.prefix_trie(df, block_rows=block_rows)
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted(map(tuple, got.collect()), key=repr) == trie_by_hand(rows)


def test_trie_of_turnless_conversations(spark):
    keys = [c for c in range(500) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 0][:50]  # nothing stands at their base
    rows = [(c, 0, "u", "gone") for c in keys]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    for block_rows in (1, 3, 100):
        assert sorted(map(tuple, prefix_trie.prefix_trie(df, block_rows=block_rows).collect()), key=repr) == trie_by_hand(rows)
    assert prefix_trie.prefix_trie(df.limit(0)).collect() == []


def test_trie_of_one_very_long_conversation(spark):
    rows = [(c, t, "u", f"turn {t}") for c in (5, 6, 7) for t in range(3000 - c)]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = prefix_trie.prefix_trie(df, block_rows=1)
    assert got.count() == 2996
    top = got.where("depth = 2000").first()
    assert (top["n_convs"], top["n_leaves"], top["conv_id"]) == (3, 1, 5)


def test_sample_trie(spark):
    df = spark.read.parquet(f"{SF}/conversations.parquet")
    got = prefix_trie.prefix_trie(df, block_rows=50)
    assert sorted(map(tuple, got.collect()), key=repr) == trie_by_hand([tuple(r) for r in df.select("conv_id", "turn", "role", "text").collect()])


# Repeated windows


def windows_by_hand(texts, window):
    docs = [(i, re.findall(rb"[^\x20\x09-\x0D]+", t.encode())) for i, t in texts]
    first = {}
    for i, words in docs:
        for k in range(len(words) - window + 1):
            w = tuple(words[k : k + window])
            if i is not None:
                first[w] = min(first.get(w, i), i)
    out = []
    for i, words in docs:
        gone = set()
        for k in range(len(words) - window + 1):
            if i is not None and first[tuple(words[k : k + window])] < i:
                gone.update(range(k, k + window))
        kept = b" ".join(w for k, w in enumerate(words) if k not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def test_windows_of_documents(mixed, texts):
    got = window_dedup.remove_repeated_windows(mixed)
    assert got.columns == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    want = windows_by_hand(texts(mixed), 50)
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert sum(r[2] for r in want) > 0


@pytest.mark.parametrize("large_bucket", [0, 3, 512])
@pytest.mark.parametrize("window,gram", [(5, 2), (8, 8), (12, 3)])
def test_windows_of_few_words(spark, texts, with_clash, large_bucket, window, gram):
    rng = random.Random(window)
    passage = [f"p{k}" for k in range(40)]
    rows = []
    for i in range(120):
        words = rng.choices("abc", k=rng.randint(0, 40)) if i % 2 else [f"w{rng.randrange(10**6)}" for _ in range(rng.randint(0, 30))]
        if i % 3 == 0:
            at, k = rng.randint(0, len(words)), rng.randrange(20)
            words[at:at] = passage[k : k + rng.randint(1, 30)]
        if i % 7 == 0:
            words.insert(0, "long" * 500)
        rows.append((rng.choice([i, i, i, None, 5]), rng.choice([" ", "\n", "\t \x0b"]).join(words) if i % 11 else None, "", "", 0))
    rows += [(i, "same words in all of these texts again and again and here the end " * 3, "", "", 0) for i in range(300, 340)]
    docs = with_clash(spark.createDataFrame(rows, COLUMNS))
    got = window_dedup.remove_repeated_windows(docs, window=window, gram=gram, large_bucket=large_bucket)
    assert sorted(map(tuple, got.collect()), key=repr) == windows_by_hand(texts(docs), window)


def test_windows_of_nothing(empty):
    assert window_dedup.remove_repeated_windows(empty).collect() == []
