from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from basketry.llm import (
    byte_pairs,
    components,
    decontamination,
    language_model,
    line_dedup,
    personal_data,
    quality_classifier,
    quality_rules,
    sharding,
    simhash,
    token_counts,
)

# Columns whose names operators use inside or return; they must not get in the way.
EXTRA = "score double, n_words long, _text string, _row string, kept boolean, shard int, block long, fp long, items string"
SCHEMA = f"doc_id long, text string, source string, lang string, n_chars long, {EXTRA}"


def table(spark, rows):
    """Documents from (doc_id, text) or (doc_id, text, source)."""
    full = [(r[0], r[1], r[2] if len(r) > 2 else "s", "en", len(r[1] or "")) + (None,) * 9 for r in rows]
    return spark.createDataFrame(full, SCHEMA)


@pytest.fixture(scope="module")
def texts():
    draw = random.Random(5)
    vocabulary = ["".join(draw.choice("abcdeé") for _ in range(draw.randint(1, 6))) for _ in range(300)]
    prose = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    base = prose(120)
    near = [base.replace(" a ", f" {w} ", 1) + f" {w}" for w in vocabulary[:5]]
    loud = " ".join(w.upper() + "!!" for w in prose(80).split())
    return [
        None, "", " \n\t ", "one", "One two\nthree", base, base, *near, base.upper(), loud, "x y z " * 60,
        "same line here\n" * 30 + prose(60), prose(4000), "漢字 ça \U0001f600 <|endoftext|> 12  34\n\n", "a" * 900,
        *[prose(draw.randint(5, 90)) + "\nfooter of the site\n" + prose(20) for _ in range(12)],
    ]


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, "one"), (3, "one")]
    return table(spark, rows).cache(), rows


def by_row(df, *columns):
    return sorted((tuple(r) for r in df.select("doc_id", *columns).collect()), key=repr)


def test_rules_and_score(spark, docs):
    df, rows = docs
    trusted = spark.createDataFrame([(5,), (5,), (None,), (20,)], "id long")
    ratios = quality_rules.bucket_log_ratios(df, "doc_id", "text", trusted, bits=8)
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    got = quality_rules.score_rules(df, "doc_id", "text", ratios)
    assert by_row(got, *names) == sorted(((i, *brute.rules(t)) for i, t in rows), key=repr)
    kept = {r.doc_id for r in got.filter("kept").collect()}
    assert kept == {r.doc_id for r in got.filter(f"NOT base_failed AND log_ratio >= {quality_rules.THRESHOLD}").collect()}
    left = quality_rules.filter_quality(df, trusted)
    assert left.columns == df.columns
    nothing = quality_rules.bucket_log_ratios(df, "doc_id", "text", trusted.limit(0), bits=8)
    assert set(nothing) == {0.0}
    assert quality_rules.filter_quality(df.limit(0), trusted).count() == 0


def test_log_ratios_are_the_multinomials(spark):
    df = table(spark, [(1, "a b a"), (2, "b c")])
    ratios = quality_rules.bucket_log_ratios(df, "doc_id", "text", spark.createDataFrame([(1,)], "id long"), bits=4)
    h = {r.w: r.h % 2**64 >> 60 for r in spark.createDataFrame([("a",), ("b",), ("c",)], "w string").select("w", F.xxhash64("w").alias("h")).collect()}
    p = {(a, b): r % 2**64 >> 60 for a, b, r in spark.createDataFrame([("a", "b"), ("b", "a"), ("b", "c")], "a string, b string").select("a", "b", F.xxhash64("a", "b")).collect()}
    target = Counter([h["a"], h["b"], h["a"], p["a", "b"], p["b", "a"], h["a"]])
    raw = target + Counter([h["b"], h["c"], p["b", "c"], h["c"]])
    want = [np.log((target[i] + 1) / (6 + 16)) - np.log((raw[i] + 1) / (10 + 16)) for i in range(16)]
    assert np.allclose(ratios, want, atol=1e-6)


def test_line_dedup(spark, texts):
    rows = [(i, t, None if i % 9 == 0 else f"s{i % 2}") for i, t in enumerate(texts)] + [(0, None, "s1")]
    df = table(spark, rows)
    got = line_dedup.drop_boilerplate(df, length_col="n_chars")
    assert got.columns == df.columns
    want = brute.without_boilerplate([(s, t) for _, t, s in rows])
    assert by_row(got, "text") == sorted(((r[0], t) for r, t in zip(rows, want)), key=repr)
    assert any(t != r[1] for r, t in zip(rows, want)) and got.filter("n_chars <> length(text)").count() == 0
    assert line_dedup.drop_boilerplate(df.limit(0), counts=True).count() == 0


def test_simhash(spark, docs):
    df, rows = docs
    fps = [(i, brute.fingerprint(t)) for i, t in rows]
    found = simhash.near_duplicates(df)
    want = sorted(((i, f - (f >> 63 << 64), c) for (i, f), c in zip(fps, brute.components(fps))), key=repr)
    assert by_row(found, "fp", "component_id") == want
    assert len({c for *_, c in want}) < len(want) - 3
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({c for *_, c in want if c is not None}) and ids.count(None) == 1
    assert simhash.near_duplicates(df.limit(0)).count() == 0


@pytest.mark.parametrize("groups", [5, 6, 8])
def test_links_connect_all_near_fingerprints(spark, groups):
    draw = random.Random(groups)
    fps = {draw.getrandbits(64) for _ in range(60)}
    for f in list(fps)[:12]:
        for _ in range(25):  # dense groups
            for _ in range(draw.randint(1, 5)):
                f ^= 1 << draw.randrange(64)
            fps.add(f)
    signed = {f: f - (f >> 63 << 64) for f in fps}
    df = spark.createDataFrame([(v,) for v in signed.values()], "fp long")
    roots = dict(components.components(simhash.links(df, len(fps), groups=groups)).collect())
    order = sorted(signed.values())
    want = brute.components([(v, v % 2**64) for v in order])
    assert [roots.get(v, v) for v in order] == want


def test_thermometer_bounds_the_bit_distance(spark):
    pairs = [(random.Random(i).getrandbits(63), random.Random(-i - 1).getrandbits(63)) for i in range(200)]
    df = spark.createDataFrame(pairs, "a long, b long")
    rows = df.select("a", "b", F.bit_count(simhash.thermometer(F.col("a")).bitwiseXOR(simhash.thermometer(F.col("b")))).alias("d")).collect()
    counts = lambda x: [(x >> 2 * i & 3).bit_count() for i in range(32)]
    for r in rows:
        assert r.d == sum(abs(p - q) for p, q in zip(counts(r.a), counts(r.b))) <= (r.a ^ r.b).bit_count()


@pytest.mark.parametrize("block_bytes", [1 << 20, 60])
def test_decontamination(spark, docs, texts, block_bytes):
    df, rows = docs
    items = [(1, " ".join(texts[5].split()[20:45])), (1, "three"), (2, None), (3, "..."), (None, "one"), (4, "ONE two"), (5, texts[16][300:420]), (6, "nowhere to be found")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontamination.contamination(df, benchmark, block_bytes=block_bytes)
    want = [(i, n, hit, len(ids), ids, hit > 0) for i, t in rows for n, hit, ids in [brute.contamination(t, items)]]
    assert by_row(found, "n_words", "n_hit", "n_items", "items", "contaminated") == sorted(want, key=repr)
    clean = decontamination.drop_contaminated(df, benchmark)
    assert clean.columns == df.columns and clean.count() == sum(not w[-1] for w in want)
    if block_bytes > 60:
        assert decontamination.contamination(df.limit(0), benchmark).count() == 0
        assert decontamination.contamination(df, benchmark.limit(0)).filter("contaminated").count() == 0


@pytest.fixture(scope="module")
def tiktoken_encoding():
    import base64

    import tiktoken

    with open(public_tokenizers.path(byte_pairs.VOCABULARY), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_byte_pairs(spark, docs, tiktoken_encoding):
    df, rows = docs
    want = []
    for i, t in rows:
        ids = tiktoken_encoding.encode_ordinary(t or "")
        want.append((i, len(ids), brute.sha(",".join(map(str, ids))), brute.sha(t or "")))
    for chunk, overlap in ((1 << 15, 1 << 11), (64, 32)):
        got = byte_pairs.encode_documents(df, chunk=chunk, overlap=overlap)
        assert by_row(got, "n_tokens", "ids_sha256", "decoded_sha256") == sorted(want, key=repr)
    assert byte_pairs.encode_documents(df.limit(0)).count() == 0


def test_long_pre_tokens_merge_alike(tiktoken_encoding):
    encoder = byte_pairs.Encoder(public_tokenizers.path(byte_pairs.VOCABULARY), public_tokenizers.PATTERN)
    draw = random.Random(2)
    for n in (1, 2, 31, 32, 33, 200, 3000):
        piece = "".join(draw.choice("aabcé") for _ in range(n))
        assert list(encoder.merge(piece.encode())) == tiktoken_encoding.encode_ordinary(piece)


def test_token_counts(spark, docs):
    from tokenizers import Tokenizer

    df, rows = docs
    model = Tokenizer.from_file(public_tokenizers.path(token_counts.VOCABULARY))
    want = [(i, len((t or "").encode()), len(model.encode(t or "", add_special_tokens=False).ids)) for i, t in rows]
    want = sorted(((*w, w[2] > 1024) for w in want), key=repr)
    assert by_row(token_counts.count_tokens(df), "n_bytes", "n_tokens", "over_limit") == want
    for head in (0, 40):  # all, and most, of the pre-tokens are joined
        assert by_row(token_counts.count_tokens(df, head=head), "n_bytes", "n_tokens", "over_limit") == want
    small = token_counts.count_tokens(df, block_bytes=300, block_rows=4, head=40)
    assert by_row(small, "n_bytes", "n_tokens", "over_limit") == want
    assert token_counts.count_tokens(df.limit(0)).count() == 0


def test_sharding(spark, docs):
    df, rows = docs
    got = sharding.shard_documents(df, shards=4).collect()
    assert len(got) == len(rows)
    texts = {i: t or "" for i, t in rows[:-2]} | {None: "one"}
    shard_of = {}
    for r in got:
        text = texts[r.doc_id]
        assert (r["size"], r.text_crc32) == (len(text.encode()) + 1, zlib.crc32(text.encode()))
        assert shard_of.setdefault(text, r.shard) == r.shard  # equal texts together
    for shard in range(4):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(sum(r.shard == shard for r in got)))
    assert sharding.shard_documents(df.limit(0), shards=4).count() == 0


def test_shards_are_near_equal_with_a_hot_group(spark):
    draw = random.Random(1)
    rows = [(i, "x" * 500) for i in range(1000)] + [(i, f"{i} " * draw.randint(1, 200)) for i in range(1000, 3000)]
    sizes = Counter()
    for r in sharding.shard_documents(table(spark, rows)).collect():
        sizes[r.shard] += r["size"]
    assert len(sizes) == 8 and max(sizes.values()) < 1.02 * min(sizes.values())
    copies = [(i, "x" * 50) for i in range(4000)]  # one group larger than a shard is cut
    rows = Counter(r.shard for r in sharding.shard_documents(table(spark, copies)).collect())
    assert len(rows) == 8 and max(rows.values()) < 1.5 * min(rows.values())


def test_quality_classifier(spark, texts):
    draw = random.Random(4)
    good = [(i, " ".join(draw.choice(["alpha", "beta", "gamma"]) for _ in range(60))) for i in range(60)]
    bad = [(i, " ".join(draw.choice(["alpha", "beta", "gamma"]) + "$$$" for _ in range(60))) for i in range(60, 120)]
    odd = [(200, None), (201, ""), (None, "alpha"), (1, good[1][1]), (202, "alpha " * 9000)]
    df = table(spark, good + bad + odd)
    marks = [(i, int(i < 60)) for i in range(120)] + [(None, 1), (3, None), (5, 1)]
    labels = spark.createDataFrame(marks, "doc_id long, quality int")
    got = quality_classifier.score_quality(df, labels).collect()
    assert len(got) == 125 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    unseen = [r for r in got if r.held_out and r.doc_id < 120]
    assert np.mean([r.predicted == (r.doc_id < 60) for r in unseen]) > 0.95
    assert {r.score for r in quality_classifier.score_quality(df, labels.limit(0)).collect()} == {0.5}
    assert quality_classifier.score_quality(df.limit(0), labels).count() == 0


def test_chunks_cover_the_document():
    for n in (0, 1, 255, 256, 257, 448, 449, 5000):
        text = "".join(chr(97 + i % 26) for i in range(n))
        chunks = quality_classifier.chunks_of(text)
        joined = chunks[0].tobytes() + b"".join(c.tobytes()[-quality_classifier.STEP :] for c in chunks[1:])
        assert joined.rstrip(b"\0") == text.encode()


def test_language_model(spark, docs):
    df, rows = docs
    got = language_model.score_documents(df).collect()
    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 7 == 2
    counts, end = Counter(), 0
    for i, t in rows:
        if not held(i):
            counts.update(brute.WORD.findall(brute.low(t)))
            end += 1
    n, v = sum(counts.values()) + end, len(counts) + 1
    assert len(got) == len(rows)
    for r in got:
        words = brute.WORD.findall(brute.low("one" if r.doc_id is None else rows[r.doc_id][1]))
        known = [counts[w] for w in words] + [end]
        assert (r.n_tokens, r.n_known, r.train_tokens) == (len(known), sum(c > 0 for c in known), n)
        assert r.base_score == pytest.approx(sum(np.log10((c + 1) / (n + v + 1)) for c in known))
        assert r.held_out == held(r.doc_id) and r.score < 0
    assert language_model.score_documents(df.limit(0)).count() == 0


def test_the_language_model_is_a_distribution():
    code = language_model.huffman([100 if 97 <= s < 100 else 0 for s in range(256)])
    assert sum(2.0**-n for n in code.length) == pytest.approx(1)
    draw = np.random.default_rng(1)
    tables = draw.integers(-60, 60, (language_model.CONTEXTS, 1 << language_model.TABLE_BITS)).astype(np.int8)
    model = language_model.Scorer(tables, code)
    one = "".join("abc"[i] for i in draw.integers(0, 3, 700))
    alone = model.score([one])[0]
    assert np.allclose(model.score(["zz", one, None, one[:300], one]), [*model.score(["zz"]), alone, *model.score([""]), *model.score([one[:300]]), alone])
    # The empty text ends at once; every other text starts with one of the remaining symbols.
    first = [s for s in range(256) if s != language_model.END]
    paths = []
    for s in first:
        raw = np.array([language_model.END] * language_model.BACK + [s], np.uint8)
        lengths, node, turn = language_model._decisions(raw[-1:], code)
        h = language_model.contexts(raw)
        x = [tables[k][language_model._slots(h[k], lengths, node)] / language_model.SCALE for k in range(language_model.CONTEXTS)]
        mix = np.clip(language_model.WEIGHT * sum(x), -7.9, 7.9)
        start = model.start_map[((mix + language_model.BUCKETS / 4) * 2).astype(int)]
        p = (1 / (1 + np.exp(-mix)) + start) / 2
        paths.append(np.prod(np.where(turn, p, 1 - p)))
    assert sum(paths) + 10 ** model.score([""])[0] == pytest.approx(1, abs=1e-4)


def test_personal_data(spark):
    import re

    card = "4929 3483 8514 6306"
    rows = [
        (1, f"mail ann.b@mail.example.com now, {card}."), (2, "ip 10.0.0.1 and 300.1.1.1"), (3, "call +1 (017) 555-7713 or 12345"),
        (4, f"+1 (017) 555-7713 {card} 4845168114407329"), (5, "bob at example dot com"), (6, None), (7, ""), (None, "x@y.z"), (8, "1" * 5000),
        *[(100 + i, f"n {i} ip 10.1.{i}.7 tel +1 ({200 + i}) 555-{7000 + i} card 4845168114407329 junk 48451681144073{i:02d} a{i}@b.example.org x@y") for i in range(40)],
    ]
    plain = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
    }

    def base(text):
        found = []
        for kind, pattern in plain.items():
            for m in re.finditer(pattern, text or ""):
                digits = re.sub("[^0-9]", "", m.group())
                good = {
                    "email": True, "ip": kind == "ip" and all(int(p) < 256 for p in m.group().split(".")),
                    "card": 14 <= len(digits) <= 19 and personal_data.luhn(digits), "phone": 10 <= len(digits) <= 15,
                }[kind]
                if good:
                    found.append((m.start(), m.end(), kind))
        return found

    got = personal_data.find_personal_data(table(spark, rows)).collect()
    assert len(got) == len(rows)
    texts = dict(rows)
    for r in got:
        want = base(texts[r.doc_id])
        assert r.base_spans == personal_data.written(want)
        assert [r[f"n_{k}"] for k in personal_data.KINDS] == [sum(s[2] == k for s in want) for k in personal_data.KINDS]
        assert set(filter(None, r.base_spans.split(","))) <= set(filter(None, r.spans.split(",")))
    spans = {r.doc_id: r.spans for r in got}
    assert spans[4] == "phone:0:17,card:18:37,card:38:54"  # the fixed patterns find none of these
    assert spans[5] == "email:0:22" and spans[8] == ""
    assert personal_data.find_personal_data(table(spark, rows).limit(0)).count() == 0


def test_base_patterns_on_random_texts():
    import re

    draw = random.Random(3)
    parts = ["a", "1", "23", "4929348385146306", ".", "@", "-", " ", "+", "+1 (234) 555-1234", "x.y", "(", ")", "%", "255.1.2.3", "é"]
    for _ in range(3000):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 14)))
        spans, _ = personal_data.base_spans(text)
        want = {m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)}
        assert {s[:2] for s in spans if s[2] == "email"} == want
        phones = [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)]
        assert {s[:2] for s in spans if s[2] == "phone"} == {(a, b) for a, b in phones if 10 <= len(re.sub("[^0-9]", "", text[a:b])) <= 15}


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    roots = dict(components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert roots == {i: 0 for i in range(1, 41)} | {i: 100 for i in range(101, 140)} | {201: 200}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_digest_of_no_items_is_that_of_the_empty_text():
    assert brute.sha("") == hashlib.sha256(b"").hexdigest()
