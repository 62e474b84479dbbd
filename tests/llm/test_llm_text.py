"""Personal data, token counts, packing, licences and pages."""

import hashlib
import itertools
import random
import re
import time
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from cdcmart.llm import licenses, packing, pages, pii, token_counts

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
ODD = [
    "", " ", "  ", "a  b", " a", "a ", "x\n y", "x \n\n y  z", "<|endoftext|>", "a<|endoftext|>b <|endoftext|>", "don't  it's 'll",
    "naïve ½ ² x1y2", "\x1c a\x1d b", "a" * 3000, "😀😀 👩‍👧 x", "\t\ta\tb  \r\n c", "ééé" * 300, "日本語 テスト　全角",
]


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def base(text):
    found = [("email", *m.span()) for m in EMAIL.finditer(text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append(("phone", *m.span()))
    return found


def test_base_spans_are_those_of_the_patterns():
    rng = random.Random(4)
    for alphabet in ("ab.@-+ 1é", "0123456789 -.+()", "4012888888881881 -a"):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40)))
            assert [(pii.KINDS[k], s, e) for k, s, e in pii.base_spans(text)] == base(text), text


def test_pii_table(mixed, texts, empty):
    got = pii.pii_spans(mixed).collect()
    want = Counter()
    for i, t in texts(mixed):
        found = base(t)
        digest = hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in found).encode()).hexdigest()
        want[(i, *[sum(k == kind for k, _, _ in found) for kind in pii.KINDS], digest)] += 1
    assert Counter(tuple(r)[:6] for r in got) == want
    assert pii.pii_spans(empty).count() == 0


def test_skip_chain_adds_consistent_labels_only():
    text = "call +1 (988) 555-2485 or (988) 555-2485. bo.t.42@mail8.example.com, then bo.t.42; 555-1111 and 7654321"
    found, whole = pii.find([text])[0]
    assert set(found) < set(whole)
    added = [(pii.KINDS[k], text[s:e]) for k, s, e in whole if (k, s, e) not in found]
    assert added == [("email", "bo.t.42"), ("phone", "555-2485")]
    alone = "555-2485 and again 555-2485 and 555-2485 or 555-2485 555-2485 555-2485 555-2485"
    assert pii.find([alone])[0] == ([], [])


def test_masking(edges, spark):
    rows = [(1, "write to a.b@c.de or call +49 30 1234567", 40), (2, None, 0), (3, "nothing", 7)]
    out = pii.mask_pii(spark.createDataFrame(rows, "doc_id bigint, text string, n_chars bigint"), length_col="n_chars").orderBy("doc_id").collect()
    assert [tuple(r) for r in out] == [(1, "write to <email> or call <phone>", 32), (2, None, 0), (3, "nothing", 7)]
    assert pii.mask_pii(edges).columns == edges.columns


@pytest.fixture(scope="module")
def library():
    t = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    return lambda texts: [e.ids for e in t.encode_batch(texts, add_special_tokens=False)]


def drawn(n):
    rng = random.Random(1)
    return ODD + ["".join(rng.choice(" \n\ta's1!é日<|>endoftext😀 .-") for _ in range(rng.randint(0, 60))) for _ in range(n)]


def test_transducer_counts_as_the_library(library):
    texts = drawn(1500)
    want = [len(ids) for ids in library(texts)]
    counter = token_counts.counter("byte_bpe_50k.json")
    for chunk in (1 << 16, 1, 5, 50):
        assert counter.counts(texts, chunk) == want


def test_transducer_after_a_reset(library, monkeypatch):
    monkeypatch.setattr(token_counts, "KEPT_STATES", 50)
    texts = drawn(200)
    counter = token_counts.Counter(public_tokenizers.path("byte_bpe_50k.json"))
    counter.table.limit = 10
    assert [counter.counts([t])[0] for t in texts] == [len(ids) for ids in library(texts)]


def test_token_table(mixed, texts, empty, library):
    rows = texts(mixed)
    want = Counter((i, len(t.encode()), len(ids), len(ids) > 1024) for (i, t), ids in zip(rows, library([t for _, t in rows])))
    assert Counter(tuple(r) for r in token_counts.token_counts(mixed).collect()) == want
    assert token_counts.token_counts(empty).count() == 0


def test_encoder_gives_the_ids_of_the_library(library):
    texts = drawn(1500)
    encoded = packing.encoder("byte_bpe_50k.json").encode(texts)
    assert [np.frombuffer(e, "<u4").tolist() for e in encoded] == library(texts)


@pytest.mark.parametrize("limits", [(700_000, 8 << 20, 200_000), (10, 8 << 20, 200_000), (700_000, 40, 3)])
def test_encoder_in_batches(library, monkeypatch, limits):
    for name, value in zip(("KEPT_PIECES", "KEPT_IDS", "STAYING_PIECES"), limits):
        monkeypatch.setattr(packing, name, value)
    monkeypatch.setattr(packing, "GATHERED", 7)  # some stretches go over 16 ids a piece
    own = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    texts = drawn(300) + ODD + drawn(100)
    for at in range(0, len(texts), 23):
        some = texts[at : at + 23]
        assert [np.frombuffer(e, "<u4").tolist() for e in own.encode(some)] == library(some)
        if at % 4 == 1:
            own.thin()  # as at the end of a task
    assert own.encode([]) == []


class Recorded:
    def __init__(self, tokenizer):
        self.tokenizer, self.texts = tokenizer, []

    def encode_batch_fast(self, texts, **options):
        self.texts += texts
        return self.tokenizer.encode_batch_fast(texts, **options)


def test_encoder_meets_pieces_of_the_task_before(spark, monkeypatch, library):
    own = packing.Encoder(public_tokenizers.path("byte_bpe_50k.json"))
    monkeypatch.setattr(packing, "encoder", lambda name: own)
    monkeypatch.setattr(packing, "map_batches", lambda docs, make, schema: make)
    make = packing.pieces(spark.createDataFrame([], "id bigint, text string"), "id", "text", "byte_bpe_50k.json", 2048)
    text = "It was " + " ".join(f"word{i}" for i in range(500))
    batch = pa.RecordBatch.from_pydict({"id": [1], "text": [text]})
    for _ in range(2):
        step = make()
        want = step(batch).to_pydict()
        assert want["doc_tokens"] == [len(library([text])[0]) + 1]
        step(batch)
        step.close()
    own.tokenizer = Recorded(own.tokenizer)
    assert make()(batch).to_pydict() == want
    # Only the start of the text.
    assert sum(map(len, own.tokenizer.texts)) < 10


@pytest.mark.parametrize("together", [20_000, 50])
def test_packing(mixed, texts, library, monkeypatch, together):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", together)
    rows = packing.pack(mixed).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    want = defaultdict(Counter)
    documents = texts(mixed)
    for (i, _), ids in zip(documents, library([t for _, t in documents])):
        ids = [*ids, 1]
        for at in range(0, len(ids), 2048):
            part = np.array(ids[at : at + 2048], "<u4")
            want[i][(at, len(part), zlib.crc32(part.tobytes()), len(ids))] += 1
    for i, pieces in by_doc.items():
        assert Counter((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in pieces) == want.pop(i)
    assert not want
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 2048
    assert sum(r["length"] for r in rows) >= 0.95 * 2048 * len(by_sequence)
    assert sorted(by_sequence) == list(range(len(by_sequence)))


def test_packing_of_nothing(empty):
    assert packing.pack(empty).count() == 0


def test_histogram_packing_matches_one_by_one():
    rng = random.Random(9)
    for _ in range(200):
        histogram = {n: rng.randint(1, 6) for n in rng.sample(range(1, 33), 8)}
        patterns = packing.pack_histogram(histogram, 32)
        placed = Counter()
        for count, pack in patterns:
            assert sum(pack) <= 32 and count > 0
            for n in pack:
                placed[n] += count
        assert placed == histogram


def test_notices_are_told_by_family():
    m = licenses.model()
    for family, notices in licenses.TEMPLATES.items():
        for notice in notices:
            assert any(s in notice.lower() for s in licenses.STEMS)
            assert [f for _, f, _ in licenses.classify([notice], m)[0]] == [family]
            assert [f for _, f, _ in licenses.classify([f"Intro.\n\n{notice.upper()} See also the file.\nEnd"], m)[0]] == [family]
    assert not any(licenses.classify(list(licenses.OTHER), m))
    unseen = "The licensed driver had a version of the general public in his mind."
    assert licenses.classify([unseen], m) == [[]]


def test_license_table(mixed, texts, empty):
    m = licenses.model()
    got = Counter((r["doc_id"], r["n_paragraphs"], r["n_notices"], r["families"]) for r in licenses.license_scan(mixed).collect())
    want = Counter()
    for i, t in texts(mixed):
        found = licenses.classify([t], m)[0]
        want[(i, sum(bool(p.strip()) for p in t.split("\n")), len(found), ",".join(sorted({f for _, f, _ in found})))] += 1
    assert got == want
    assert licenses.license_scan(empty).count() == 0


def exact_labels(unary, chain, skip):
    """Labels of largest marginal probability, from the sum over all labellings."""
    n = len(unary)
    total = np.zeros((n, 5))
    for labels in itertools.product(range(5), repeat=n):
        weight = sum(unary[i][k] for i, k in enumerate(labels))
        weight += sum(pii.CHAIN for a, b in chain if labels[a] == labels[b] != 0) + sum(pii.DISAGREE for a, b in skip if labels[a] != labels[b])
        for i, k in enumerate(labels):
            total[i, k] += np.exp(weight)
    return total.argmax(axis=1).tolist()


def test_labels_against_all_labellings():
    rng = random.Random(8)
    for _ in range(60):
        n = rng.randint(2, 5)
        unary = np.full((n, 5), pii.UNSHAPED)
        unary[:, 0] = 0.0
        for i in range(n):
            if rng.random() < 0.4:
                unary[i] = -pii.OBSERVED
                unary[i, rng.randint(1, 4)] = 0.0
            else:
                unary[i, rng.sample(range(1, 5), 2)] = pii.SHAPED
        chain = np.array([(i, i + 1) for i in range(n - 1) if rng.random() < 0.5], np.int64).reshape(-1, 2)
        skip = np.array([(0, i) for i in range(1, n) if rng.random() < 0.6], np.int64).reshape(-1, 2)
        assert pii.marginals(unary, chain, skip).argmax(axis=1).tolist() == exact_labels(unary, chain.tolist(), skip.tolist())


def test_numbers_far_from_any_span_leave_the_graph():
    rng = random.Random(2)
    numbers = " ".join(str(rng.randrange(100)) for _ in range(200_000))
    near = "Call +49 170 5550123 or 1705550123 please. "
    alone = pii.find([near])[0]
    assert len(alone[1]) > len(alone[0])
    tracemalloc.start()
    found = pii.find([near + numbers])[0]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == alone and peak < 40 << 20


PAGE = """<!DOCTYPE html><html><head><title>T</title><script>var x = "</p><article>no</article>";</script></head><body>
<header><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></ul></nav><div class="cookie-notice">We use cookies.</div>
<div class="content post-{n}"><div class="body7"><h1>Title &amp; more</h1><p>First   <b>bold<br>text</b> &#8211; it&nbsp;goes on and on.<p>Second
paragraph &lt;tag&gt; with enough words to count.<ul><li>one<li>two</ul><!-- <p>hidden</p> --></div></div>
<aside><p>{side}</p></aside><div id="comments"><p>Reader says {side}</p></div><footer>&copy; x</footer></body></html>"""
TEXT = "Title & more\nFirst bold text – it goes on and on.\nSecond paragraph <tag> with enough words to count.\none\ntwo"


def test_pages(spark):
    rows = [(n, f"https://Host.example/{n}", PAGE.format(n=n, side="long " * n)) for n in range(6)]
    rows += [(10, "https://host.example/x", None), (11, None, ""), (12, "::bad::", "<p>plain <i>text</i></p>tail <b"), (13, "http://a.b/", "<article><p>open &amp")]
    rows += [(14, "http://a.b/", "x < y & z"), (14, "http://a.b/", "x < y & z"), (None, "http://a.b/", "<div class=ad>buy</div>")]
    # A page whose own best container would be the wrong one follows its host.
    short = '<html><body><div class="content post-9"><div class="body7"><p>Brief.</p></div></div><div class="other"><p>' + "Long filler text. " * 9 + "</p></div></body></html>"
    rows.append((15, "https://host.example/short", short))
    got = pages.main_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()
    by_id = defaultdict(list)
    for r in got:
        assert r["n_chars"] == len(r["text"])
        by_id[r["page_id"]].append(r["text"])
    assert all(by_id[n] == [TEXT] for n in range(6))
    assert by_id[10] == [""] and by_id[11] == [""]
    assert by_id[12] == ["plain text\ntail"] and by_id[13] == ["open &"]
    assert by_id[14] == ["x < y & z"] * 2 and by_id[None] == [""]
    assert by_id[15] == ["Brief."]


def test_names_of_what_a_page_has_are_no_boilerplate():
    page = (
        '<body><div class="page has-sidebar"><div class="post"><div class="entry-header"><h1>Title</h1></div><p>Some words of text.</p></div>'
        '<div class="sidebar"><p>Other words of text.</p></div></div></body>'
    )
    assert pages.extract(page, None) == "Title\nSome words of text."


P = "<p>A paragraph of some words, long enough to count.</p>"
COMMENT = "<p>A reader says something about that.</p>"


@pytest.mark.parametrize(
    "body",
    [
        "<article><h1>T</h1><button>Share</button>{P}{P}</article>",
        "<article><button>Share<h1>T</h1>{P}{P}</article>",
        "<article><label>Name</label><h1>T</h1>{P}{P}</article>",
        "<article><label>Name<h1>T</h1>{P}{P}</article>",
        "<article><h1>T</h1>{P}<select><option>a<option>b</select>{P}</article>",
        "<article><h1>T</h1>{P}<menu><li>a<li>b</menu>{P}</article>",
        "<form id='aspnetForm'><input type=hidden><div><h1>T</h1>{P}{P}</div></form>",
        "<div><h1>T</h1>{P}{P}</div><form><p>Your name</p><input></form>",
        '<div class="page-with-sidebar"><h1>T</h1>{P}{P}</div>',
        '<div class="site sidebar-right"><h1>T</h1>{P}{P}<div class="sidebar"><p>Other words.</p></div></div>',
        '<div class="site sidebar"><main><h1>T</h1>{P}{P}</main></div>',
        '<article class="post comments-open"><h1>T</h1>{P}{P}</article>',
        '<article class="post category-search"><h1>T</h1>{P}{P}</article>',
        "<article><h1>T</h1>{P}<p data-x=it's class=y>A paragraph of some words, long enough to count.</p></article>",
        "<article title='a > b' data-x=o'clock><h1>T</h1>{P}{P}</article><p>It's over.</p>",
        '<article class="a"><h1>T</h1>{P}</article><article class="b">{P}</article>',
        "<article><h1>T</h1>{P}{P}</article><div class='comments'>" + COMMENT * 40 + "</div>",
        "<div class=text><h1>T</h1>{P}{P}</div><div class='comment-list'>" + COMMENT * 40 + "</div>",
        "<article><h1>T</h1>{P}{P}<section id=comments>" + f"<article class=comment>{COMMENT}</article>" * 20 + "</section></article>",
        "<header><div class=top><h1>T</h1>{P}{P}</div></header>",
    ],
)
def test_ordinary_pages_keep_their_article(body):
    for head in ("<head><title>X</title></head>", "<head><meta charset=utf-8><title>X</title><style>p{}</style>"):
        page = f"<html>{head}<body>{body.replace('{P}', P)}</body></html>"
        text = "T\nA paragraph of some words, long enough to count.\nA paragraph of some words, long enough to count."
        assert pages.extract(page, pages.vote(page)[0]) == pages.extract(page, None) == text


@pytest.mark.parametrize("open_tags", ['<div class="row">', '<div class="row"><p>x</section>', "<ul><li><b>", "<table><tr><td>", "<a b='", '<p x="'])
def test_deep_pages_take_linear_time(open_tags):
    def seconds(n):
        page = f"<body><article><h1>T</h1>{P}</article>" + open_tags * (n // len(open_tags))
        start = time.process_time()
        assert pages.extract(page, pages.vote(page)[0]).startswith("T\nA paragraph")
        return time.process_time() - start

    assert seconds(400_000) < 6 * max(seconds(100_000), 0.1)


def test_sample_pages(spark):
    pages_table = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    got = {r["page_id"]: r["text"] for r in pages.main_text(pages_table).collect()}
    for r in pages_table.collect():
        inner = re.split("</article>|<footer>", r["html"].split("<article>", 1)[1])[0]
        parts = re.split("</?(?:p|h1)>", re.sub("</?b>|<br>", " ", inner))
        want = [" ".join(pages.html.unescape(p).split()) for p in parts]
        assert got[r["page_id"]] == "\n".join(p for p in want if p)


def test_no_pages(spark):
    assert pages.main_text(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0


def test_nothing_of_an_article_is_lost():
    body, lead = "Body words here. " * 40, "A short lead."
    for inner in ('div class="entry-content"', "section", "blockquote"):
        page = f"<body><article><h1>Title</h1><p>{lead}</p><{inner}><p>{body}</p></{inner.split()[0]}></article><div><p>Elsewhere.</p></div></body>"
        assert pages.extract(page, pages.vote(page)[0]) == f"Title\n{lead}\n{body.strip()}"
    sections = [f"Part {k} says. " * n for k, n in enumerate((3, 50, 1, 9))]
    for around in ("<article>{}</article>", "<main><div><div>{}</div></div></main>", "{}"):
        for name in ("", " class=part{}"):
            inner = "".join(f"<section{name.format('abcd'[k])}><p>{x}</p></section>" for k, x in enumerate(sections))
            page = f"<body><nav><p>Menu</p></nav>{around.format(inner)}<footer><p>End</p></footer></body>"
            assert pages.extract(page, pages.vote(page)[0]) == "\n".join(x.strip() for x in sections) == pages.extract(page, None)


def test_notices_inside_long_lines():
    m = licenses.model()
    fill = "the river ran past old houses while children played near trees and nobody spoke about how long winter had been".split()
    rng = random.Random(6)
    prose = lambda n: " ".join(rng.choice(fill) for _ in range(n))
    assert licenses.classify([prose(500) + " license " + prose(20)], m) == [[]]
    for family, notices in licenses.TEMPLATES.items():
        for notice in notices:
            for before in (0, 37, 250, 499):
                line = f"{prose(before)} {notice} {prose(500 - before)}"
                assert [f for _, f, _ in licenses.classify([line], m)[0]] == [family], (family, notice, before)
    two = "Licensed under the MIT license. " + "{} This work is licensed under the GNU General Public License, version 3."
    for between in ("", prose(30), prose(300)):
        assert [f for _, f, _ in licenses.classify([two.format(between)], m)[0]] == ["gpl", "mit"]
    assert [f for _, f, _ in licenses.classify(["CC BY 4.0"], m)[0]] == ["cc-by"]

# Notices in other words than the templates, and sentences and notices of licences that are none of the families.
NOTICES = {
    "agpl": [
        "The server is licensed under the GNU Affero General Public License version 3.",
        "You may use it under the AGPL version 3 only.",
    ],
    "apache-2.0": [
        "It is available under the Apache License, Version 2.0, a copy of which is enclosed.",
        "Code: Apache License 2.0",
    ],
    "bsd": [
        "All code here is under the BSD 3-Clause License.",
        "The module is distributed under the BSD license.",
    ],
    "cc-by": [
        "Text and images are licensed under a Creative Commons Attribution 4.0 International License.",
        "Photos: CC BY 4.0",
    ],
    "cc-by-nc": [
        "The data are licensed under CC BY-NC 4.0, see below.",
        "Creative Commons Attribution-NonCommercial 4.0 International License",
    ],
    "cc-by-nc-nd": [
        "This article is licensed under CC BY-NC-ND 4.0.",
    ],
    "cc-by-nc-sa": [
        "All course notes are licensed under CC BY-NC-SA 4.0.",
        "Creative Commons Attribution-NonCommercial-ShareAlike 4.0",
    ],
    "cc-by-nd": [
        "Creative Commons Attribution-NoDerivatives 4.0 International",
    ],
    "cc-by-sa": [
        "Content is available under CC BY-SA 4.0 unless noted.",
        "Creative Commons Attribution-ShareAlike 4.0",
    ],
    "cc0": [
        "The data set is released into the public domain under CC0 1.0.",
    ],
    "epl": [
        "Made available under the terms of the Eclipse Public License 2.0",
    ],
    "gpl": [
        "You can redistribute this program under the terms of the GNU General Public License, version 3.",
        "Licensed under the GPL version 2 or any later version.",
    ],
    "isc": [
        "Permission to use, copy, modify, and distribute this software for any purpose with or without fee is hereby granted",
    ],
    "lgpl": [
        "The library is licensed under the GNU Lesser General Public License version 2.1 or later.",
        "Use it under the LGPL, version 3.",
    ],
    "mit": [
        "The code is released under the MIT License.",
        "Published under MIT terms.",
    ],
    "mpl": [
        "Files are subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License 2.0, as is",
    ],
    "reserved": [
        "(c) 2020 Somebody. All rights reserved.",
        "Alle Rechte vorbehalten. 2019",
    ],
    "unlicense": [
        "This is free and unencumbered software released into the public domain by its author.",
    ],
}
NO_FAMILY = [
    "She is licensed under the state board.",
    "Licensed under the EUPL, version 1.2.",
    "Licensed under the Artistic License 2.0.",
    "This work is licensed under the Open Data Commons Attribution License.",
    "Released under the zlib license.",
    "Licensed under the Boost Software License, Version 1.0.",
    "Distributed under the terms of the Academic Free License version 3.0.",
    "Licensed under the Microsoft Public License.",
    "The Public License of the town was renewed.",
    "Released under the WTFPL.",
    "Licensed under the CeCILL license, version 2.1.",
    "Subject to the terms of the Common Development and Distribution License.",
    "Under the terms of the deal the public got a version for free.",
    "The general asked for a license for the library.",
    "Permission is granted to copy this page.",
    "He was granted permission to use the software.",
    "The terms of the public lease are version two.",
    "Source and binary forms of the word exist.",
    "All rights of the people were upheld.",
    "The Mozilla public meeting was free.",
    "Creative commons are a shared good.",
    "Copyright is a matter of law.",
    "She has a fishing license, version 2.",
    "Licensed under the Open Software License 3.0",
    "Licensed under the SIL Open Font License, Version 1.1.",
]


def test_notices_in_other_words():
    m = licenses.model()
    for family, notices in NOTICES.items():
        for notice in notices:
            assert [f for _, f, _ in licenses.classify([notice], m)[0]] == [family], notice
    named = [t for t in NO_FAMILY if licenses.classify([t], m)[0]]
    assert len(named) <= 0.05 * len(NO_FAMILY), named


def test_every_family_has_pairs_of_its_own():
    for family in licenses.TEMPLATES:
        assert licenses.telling(family)
        for notice in licenses.TEMPLATES[family]:
            assert licenses.confirmed(licenses.words_of(notice), family), notice
    assert not licenses.confirmed(licenses.words_of("licensed under the"), "lgpl")
