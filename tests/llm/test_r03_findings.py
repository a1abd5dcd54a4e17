"""Findings of round 3 on CPU time: the cheaper steps give what the plain ones give."""

import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
from pyspark.sql import functions as F

from basketry.llm import language_model, token_counts, token_sums
from basketry.llm.token_counts import VOCABULARY, _Splitter, in_ranges

LATIN = "".join(map(chr, range(256)))


def test_latin_texts_are_cut_by_re_and_as_regex_cuts_them():
    split = _Splitter(public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    assert isinstance(split.latin.__self__, re.Pattern)
    plain, draw = regex.compile(public_tokenizers.PATTERN).findall, random.Random(5)
    for alphabet in (LATIN, " \t\n\x1c\x85\xa0'sdl1aB²½·", LATIN + "Ⅷ一 　𝒜ß"):
        for _ in range(300):
            text = "".join(draw.choices(alphabet, k=80))
            assert split(text) == (plain(text), 0)


@pytest.mark.parametrize("pattern", [r"\w+|\s", r"[\p{L}&&[a-z]]", r"(?i)a|b", r"\p{L}++|.", r"a{2}|."])
def test_patterns_that_re_might_take_otherwise_stay_with_regex(pattern):
    assert in_ranges(pattern) is None
    split = token_counts._Splitter(public_tokenizers.path(VOCABULARY), pattern)
    assert split.latin == split.any


def test_word_contexts_from_running_sums_are_the_sums_byte_by_byte():
    draw = np.random.default_rng(4)
    back, end = language_model.BACK, language_model.END
    raw = draw.choice(np.array([end, 32, 10, 97, 98, 195, 33], np.uint8), 4000, p=[0.02, 0.03, 0.03, 0.3, 0.3, 0.3, 0.02])
    plain = []
    for at in range(back, len(raw)):
        total = 0
        for j in range(back):
            byte = int(raw[at - 1 - j])
            if byte <= 32 or byte == end:
                break
            total += (byte + 1) * pow(0x01000193, j + 2, 1 << 32)
        plain.append(total % (1 << 32))
    assert language_model._word_so_far(raw).tolist() == plain


def test_the_number_of_lanes_does_not_matter_to_a_score(monkeypatch):
    draw = np.random.default_rng(7)
    code = language_model.huffman(list(range(256)))
    tables = draw.integers(-60, 60, (language_model.CONTEXTS, 1 << language_model.TABLE_BITS)).astype(np.int8)
    texts = ["", None, *("".join(draw.choice(list("ab \n\u00e9\u4e00"), n)) for n in (1, 40, 255, 256, 900, 901))]
    scorer = language_model.Scorer(tables, code)
    together = scorer.score(texts)
    monkeypatch.setattr(language_model, "LANES", 2)
    assert scorer.score(texts).tolist() == together.tolist()


def test_what_a_task_remembers_of_tokens_is_bounded_within_a_block(spark, tmp_path, monkeypatch):
    class Watched(token_sums.Places):
        def of_lists(self, tokens):
            found = super().of_lists(tokens)
            with open(sizes, "a") as file:
                file.write(f"{len(self.numbers)}\n")
            return found

    sizes = str(tmp_path / "sizes")
    monkeypatch.setattr(token_sums, "Places", Watched)
    monkeypatch.setattr(token_sums, "_REMEMBERED", 50)
    texts = {i: " ".join(["of", *(f"w{i * 7 + j}" for j in range(9)), "of", "é"]) if i % 9 else "" for i in range(80)}
    values = {"of": 5, "é": 3} | {f"w{i}": i for i in range(0, 600, 2)}
    rows = spark.createDataFrame([*texts.items()], "doc_id long, text string").coalesce(1)
    tokens = spark.createDataFrame([(t, v, 1000 if t == "of" else 1) for t, v in values.items()], "token string, value long, n long")
    want = {i: ([len(t)], sum(values.get(w, 0) for w in t.split())) for i, t in texts.items()}
    for as_arrow in (False, True):

        def of_texts():
            def of_group(texts):
                found = [t.as_py().split() for t in texts]
                return pa.array(found, pa.list_(pa.string())) if as_arrow else found, np.array([[len(t.as_py())] for t in texts])

            return of_group

        found = token_sums.token_sums(rows, of_texts, tokens, [(lambda v: v, F.col("value"))], None, 5, group_bytes=100)
        assert {r.doc_id: (r.numbers, r.s0) for r in found.collect()} == want
    most = [int(x) for x in open(sizes)]
    assert len(most) > 20 and max(most) <= 50 + 4 * 12


def test_words_and_symbols_are_counted_in_one_pass(spark):
    rows = ["One  two\x1cthree\u3000x", "", None, " one\n\u00c9 one\t", "two\x0b\x0ctwo "] * 3
    frame = spark.createDataFrame([(t,) for t in rows], "text string").select(F.coalesce("text", F.lit("")).alias("text"))
    counted = language_model._token_counts(frame)
    got = {bytes(r.token): r.c for r in counted.filter(~language_model._is_symbol(F.col("token"))).collect()}
    lower = [(t or "").encode().lower() for t in rows]
    assert got == Counter(w for t in lower for w in t.split()) | {b" ": len(rows)}
    symbols = Counter(b"".join(lower)) | {language_model.END: len(rows)}
    assert language_model._symbol_counts(counted) == [symbols.get(s, 0) for s in range(256)]


def test_slots_count_what_texts_hold_however_they_are_cut(spark, monkeypatch):
    draw = np.random.default_rng(2)
    texts = ["a" * 70_000, "", *("".join(draw.choice(list("ab c\u00e9\n"), n)) for n in (1, 11, 700, 40))]
    frame = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    code = language_model.huffman(list(range(256)))
    total = np.zeros((language_model.CONTEXTS, 1 << language_model.TABLE_BITS, 2))
    for text in texts:
        raw = language_model._framed(text.encode())
        of, node, turn = language_model._decisions(raw[language_model.BACK :], code)
        for k, hashes in enumerate(language_model.contexts(raw)):
            np.add.at(total[k], (language_model._slots(hashes, of, node), turn), 1)
    odds = np.log((total[:, :, 1] + language_model.PRIOR) / (total[:, :, 0] + language_model.PRIOR)) * language_model.SCALE
    want = np.clip(np.rint(odds), -127, 127).astype(np.int8)
    for cut, held in ((1 << 14, 1 << 21), (100, 300), (4000, 1)):
        monkeypatch.setattr(language_model, "_HASH_BYTES", cut)
        monkeypatch.setattr(language_model, "_TRAIN_BYTES", held)
        rows = language_model._slot_odds(frame, code).collect()
        got = np.zeros_like(want).reshape(-1, 1 << language_model._PART_BITS)
        for r in rows:
            got[r["part"]] = np.frombuffer(r["odds"], np.int8)
        assert (got.reshape(want.shape) == want).all()


def test_a_score_is_the_mix_decision_by_decision():
    draw = np.random.default_rng(3)
    m = language_model
    code = m.huffman([50 if 97 <= s < 110 else 1 for s in range(256)])
    tables = draw.integers(-60, 60, (m.CONTEXTS, 1 << m.TABLE_BITS)).astype(np.int8)
    tables[draw.random(tables.shape) < 0.4] = 0
    scorer = m.Scorer(tables, code)
    texts = ["", "b", *("".join(draw.choice(list("abcdefghi \u00e9"), n)) for n in (255, 600, 256))]

    def plain(text):
        raw = m._framed(text.encode())
        weights, seen, hits, total = np.full((m.GATES, m.CONTEXTS), m.WEIGHT), np.full(m.BUCKETS, m.MAP_PRIOR), scorer.start_map * m.MAP_PRIOR, 0.0
        for at in range(m.BACK, len(raw), m.BLOCK):
            steps, counts, met = np.zeros_like(weights), np.full(m.GATES, 4.0), []
            ratio = hits / seen
            for i in range(at, min(at + m.BLOCK, len(raw))):
                hashes = m.contexts(raw[i - m.BACK : i + 1])
                _, node, turn = m._decisions(raw[i : i + 1], code)
                for h, t in zip(node, turn):
                    x = np.array([tables[k][m._slots(hashes[k], np.array([0]), np.array([h]))[0]] / m.SCALE for k in range(m.CONTEXTS)])
                    gate = int(x[1] != 0) + 2 * int(x[2] != 0)
                    mix = np.clip(weights[gate] @ x, -7.9, 7.9)
                    p, bucket = 1 / (1 + np.exp(-mix)), int(mix * 2 + m.BUCKETS / 2)
                    refined = (p + ratio[bucket]) / 2
                    total += np.log10(refined if t else 1 - refined)
                    steps[gate] += x * (t - p)
                    counts[gate] += 1
                    met.append((bucket, t))
            weights = weights + m.WEIGHT_RATE * steps / counts[:, None]
            for bucket, t in met:
                seen[bucket] += 1
                hits[bucket] += t
        return total

    assert scorer.score(texts) == pytest.approx([plain(t) for t in texts], rel=1e-3)


def test_no_lane_waits_for_a_longer_text(monkeypatch):
    """One text of eight blocks beside eight of one block: in two lanes these are eight blocks, with the scores of each text alone."""
    m = language_model
    draw = np.random.default_rng(8)
    tables = draw.integers(-60, 60, (m.CONTEXTS, 1 << m.TABLE_BITS)).astype(np.int8)
    scorer = m.Scorer(tables, m.huffman([9 if 97 <= s < 110 else 0 for s in range(256)]))
    texts = ["".join(draw.choice(list("abcdefg hij"), n)) for n in (30, 0, m.BLOCK - 1, 8 * m.BLOCK - 1, 7, 200, 1, 99, 100)]
    alone = [scorer.score([t])[0] for t in texts]
    blocks, found = [], m.contexts
    monkeypatch.setattr(m, "contexts", lambda raw: blocks.append(len(raw)) or found(raw))
    monkeypatch.setattr(m, "LANES", 2)
    assert scorer.score(texts) == pytest.approx(alone, rel=1e-9)
    assert len(blocks) == 8
    assert len(scorer.score([])) == 0
