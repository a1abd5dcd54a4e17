"""Conversation prefix trie, lexical search and HTML extraction against plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest

from basketry.llm import html_extraction as html, lexical_search, prefix_trie

CONV = "conv_id long, turn long, role string, text string, path string, depth int, key string"


def brute_trie(rows):
    convs = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).digest()
            convs[conv].append(((turn is not None, turn or 0), tie, (role, text)))
    convs = {c: [t[2] for t in sorted(turns)] for c, turns in convs.items()}
    paths = {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        paths[c] = tuple(convs.get(c - c % 20, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, path in paths.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children, out = Counter(p[:-1] for p in members if p), []
    for node, own in members.items():
        below = [p for p in members if p[: len(node)] == node]
        saved = sum((len(members[p]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) for p in below if p)
        ends = ",".join(str(c) for c in sorted(own) if paths[c] == node)
        up = min(members[node[:-1]]) if node else None
        out.append((min(own), len(node), up, len(own), children[node], sum(not children[p] for p in below), saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, "k") for r in rows], CONV)


def trie(spark, rows):
    return sorted(map(tuple, prefix_trie.prefix_trie(conversations(spark, rows)).collect()), key=repr)


def test_trie_against_all_prefixes(spark):
    draw = random.Random(3)
    rows = []
    for c in [*range(0, 63), 400, 401, 2**40 + 7]:
        if c % 13 == 12:
            continue
        for turn in range(draw.randint(1, 5)):
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", draw.choice(["a b", "a  b c", "z", "", "é\tx"])))
    rows += [(7, None, None, None), (8, 1, "user", "tie"), (8, 1, "user", "tie"), (8, 1, "user", "other"), (None, 0, "user", "lost")]
    rows += [(1000 + i, t, "user", f"copied {t}") for i in range(200) for t in range(3)]  # a hot conversation
    rows += [(5, 9, "user", "long " * 50_000)]
    # Long ones: alone, shared up to turn 25 of 40, one inside another, and copied whole.
    rows += [(3000, t, "user", f"alone {t}") for t in range(37)]
    rows += [(c, t, "user", f"both {t if t < 25 else (t, c)}") for c in (3020, 3040) for t in range(40)]
    rows += [(3060, t, "user", f"both {t}") for t in range(19)]
    rows += [(c, t, "user", f"same {t}") for c in (3080, 3100, 3120) for t in range(33)]
    draw.shuffle(rows)
    assert trie(spark, rows) == brute_trie(rows)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    assert trie(spark, []) == []
    # conversation 1 borrows h turns of the absent conversation 0 and has fewer turns of its own than h
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    assert trie(spark, [(c, 0, "user", "gone")]) == [(c, 0, None, 1, 0, 1, 0, hashlib.sha256(str(c).encode()).hexdigest())]


def test_long_lists_of_ids_are_digested_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 7)
    ends = spark.createDataFrame([(bytearray(b"k" if i % 10 else b"other"), i) for i in range(1000, 0, -1)], "key binary, conv_id long")
    found = {bytes(r.key): r.ends_sha256 for r in prefix_trie.end_digests(ends.repartition(6)).collect()}
    own = lambda keep: hashlib.sha256(",".join(str(i) for i in range(1, 1001) if keep(i)).encode()).hexdigest()
    assert found == {b"k": own(lambda i: i % 10), b"other": own(lambda i: i % 10 == 0)}


DOCS = "doc_id long, text string, item_id string, score string, rank int, term string, n long"


def terms_of(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def brute_search(docs, items, k):
    terms = [(i, Counter(terms_of(t))) for i, t in docs]
    terms = [(i, c) for i, c in terms if c]
    n_docs, length = len(terms), sum(c.total() for _, c in terms)
    df = Counter(t for _, c in terms for t in c)
    wanted = defaultdict(Counter)
    for i, t in items:
        if i is not None:
            wanted[i] += Counter(terms_of(t))
    out = []
    for item, own in wanted.items():
        scored = []
        for i, c in terms:
            m = 25 + (75 * c.total() * n_docs) // length
            score = sum(
                times * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t, times in own.items()
                if c[t]
            )
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k])]
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_terms", [1 << 18, 5])
def test_search_against_brute_force(spark, block_terms):
    draw = random.Random(4)
    vocabulary = ["the", "The", "a", "Ä", "ä", "x1", "漢字", "\U0001f600", "end", "ends", "K", "İ", "e-mail", "o'clock", "é_è"] + [f"w{i}" for i in range(40)]
    text = lambda n: " ".join(draw.choice(vocabulary) + draw.choice(["", ",", ".\n", "\x00", "--"]) for _ in range(n))
    docs = [(i, text(draw.randint(0, 60))) for i in range(150)]
    docs += [(None, "the end"), (3, docs[3][1]), (500, docs[4][1]), (501, None), (502, " .,! "), (503, text(30_000)), (None, None)]
    items = [(i, text(draw.randint(1, 12))) for i in range(20)] + [(3, "ends"), (70, None), (71, ""), (None, "the"), (72, "unheard"), (73, "the the the")]
    table = spark.createDataFrame([(*r, None, None, None, None, None) for r in docs], DOCS).repartition(5)
    found = lexical_search.search(table, spark.createDataFrame(items, "item_id long, text string"), k=4, block_terms=block_terms)
    assert sorted(map(tuple, found.collect()), key=repr) == brute_search(docs, items, 4)


def test_search_of_nothing(spark):
    docs, items = spark.createDataFrame([], DOCS), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical_search.search(docs, items).collect() == []
    assert lexical_search.search(spark.createDataFrame([(1, "a")], "doc_id long, text string"), items.limit(0)).collect() == []


PAGES = "page_id long, url string, html string, host string, main string, text string, salt int"


def extracted(spark, rows):
    found = html.extract(spark.createDataFrame([(*r, "h", "m", "t", 0) for r in rows], PAGES).repartition(4)).collect()
    assert all(r.n_chars == len(r.text) for r in found)
    return {r.page_id: r.text for r in found}


def test_page_parts():
    page = """<!DOCTYPE html><html><head><title>No</title><style>p{}</style><script>var t="</p>";</script></head><body class="has-sidebar">
    <header class="site"><h1>Site</h1></header><nav><ul><li><a href="/a">Menu</a></ul></nav><!-- a <p>note</p> --><div class="cookie-notice">Cookies!</div>
    <article><header><h1>Title &amp; more</h1></header><p><b>First  para
    <a href="x>y">link</a>ed.<br>Next&nbsp;line<p>Caf&eacute; &#x41;&am<ul><li>one<li>two</ul><div class="share-buttons">Share</div><aside>pull</aside>
    <table><tr><td>a<td>b<tr><td>c</table><form>mail <input> <button>go</button></form></article>
    <section id="comments"><article><p>I disagree</p></article></section><div class="ad">Buy</div><footer>&copy; us</footer>"""
    _, blocks = html.read_page(page)
    assert html.main_text(blocks, frozenset(), False) == "Title & more First para linked. Next line Café A&am one two a b c"
    deep = "<div>" * 3000 + "x" + "</p>" * 3000
    assert html.main_text(html.read_page(deep)[1], frozenset(), False) == "x"


def test_template_without_telling_tags(spark):
    """Neither article nor telling class names: constants and the main slot come from the host's pages."""
    draw = random.Random(6)
    prose = lambda n: " ".join("".join(draw.choice("abcdefgh") for _ in range(4)) for _ in range(n))
    rows, expected = [], {}
    for i in range(40):
        paragraphs, title = [prose(draw.randint(20, 60)) for _ in range(draw.randint(1, 4))], prose(4)
        body = "".join(f"<p>{p}</p>" for p in paragraphs)
        notice = '<div class="x9"><span>Winter opening hours</span></div>' if i % 3 == 0 else ""
        rows.append((i, f"http://Shop.example:8080/{i}", f'<html><body><div class="x1"><a href="/">Start</a> <a href="/{i}">{prose(1)}</a></div><h1>{title}</h1>'
                     f'<div class="x2">{notice}<p>Printed with care by all of us</p>{body}</div><div class="x3"><p>{prose(3)}</p></div></body></html>'))
        expected[i] = " ".join([title, *paragraphs])
    rows += [(100, None, "<p>alone</p>"), (101, "http://one.example/", None), (102, "http://one.example/b", ""), (103, "not a url", "<p>x <b>y</b>z")]
    expected |= {100: "alone", 101: "", 102: "", 103: "x yz"}
    assert extracted(spark, rows) == expected


def test_copies_keep_their_text(spark):
    page = "<html><body><nav>Menu {}</nav><article><h1>T</h1><p>The same words on every page of this host.</p></article></body></html>"
    rows = [(i, "http://copies.example/x", page.format("a")) for i in range(30)] + [(30 + i, "http://near.example/x", page.format(i)) for i in range(30)]
    assert set(extracted(spark, rows).values()) == {"T The same words on every page of this host."}


def test_no_pages(spark):
    assert extracted(spark, []) == {}


def test_classes_need_a_tag_and_a_place_in_the_template():
    import pandas as pd

    columns = ["kind", "token", "parent", "pages", "total", "v1", "v2", "host_pages"]
    tag, text, mass = html._TAG, html._TEXT, html._MASS
    rows = [
        (tag, 1, 0, 9, 9, 5, 5, 9), (tag, 2, 1, 9, 9, 5, 5, 9), (text, 10, 2, 9, 9, 5, 5, 9),  # the root class
        (tag, 3, 2, 4, 8, 6, 6, 9), (text, 11, 3, 4, 8, 6, 6, 9),  # nests in it
        (text, 12, 2, 5, 5, 7, 7, 9), (text, 13, 2, 5, 5, 7, 7, 9),  # no tag: an article with copies
        (tag, 4, 99, 3, 3, 8, 8, 9), (text, 14, 4, 3, 3, 8, 8, 9),  # its place is in no valid class
        (tag, 5, 2, 2, 2, 9, 9, 9), (text, 15, 5, 2, 2, 9, 9, 9),  # on too few pages
        (mass, 2, 0, 9, 50, 1, 1, 9), (mass, 3, 0, 4, 700, 2, 2, 9),
    ]
    assert html.build_template(pd.DataFrame(rows, columns=columns)) == (3, [10, 11])
