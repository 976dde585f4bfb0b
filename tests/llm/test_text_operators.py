"""Rules, licenses, languages, packing: against plain Python on small inputs."""

from __future__ import annotations

import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from paystream.llm import langid, license, packing, quality
from paystream.llm.hashing import run_hashes, word_hashes

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (None, "no id here"), (5, "a b c d e a b c d e"),
    (6, "x" * 20000), (7, "same line\nsame line\n\nsame line"), (8, "% & # of the and É é"), (9, "w " * 5000),
]


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_quality_counts(docs):
    def brute(text):
        words = split(text)
        grams = Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
        covered = {k + j for k in range(len(words) - 4) if grams[tuple(words[k:k + 5])] > 1 for j in range(5)}
        lines = [x for x in (text or "").split("\n") if split(x)]
        symbols = sum(c in "#*$%&|<>" for c in text or "")
        return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered)

    rows = quality.verdicts(quality.measure(docs(ODD))).collect()
    assert len(rows) == len(ODD)
    found = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    assert found == Counter((i, *brute(t)) for i, t in ODD)


def test_quality_table(docs, spark):
    clean = "The cat sat on the mat and it was glad to be there with a friend.\nThen it left for home."
    junk = "| ".join(f"cell{k}" for k in range(30))
    failed = {r.doc_id: r.failed for r in quality.verdicts(quality.measure(docs([(1, clean), (2, junk)]))).collect()}
    assert failed == {1: [], 2: ["symbols"]}
    own = quality.verdicts(quality.measure(docs([(1, clean)])), [quality.Rule("few", "n_words", least=1000)])
    assert own.first().failed == ["few"]
    assert quality.verdicts(quality.measure(docs([]))).count() == 0


def test_license_places_and_suppression(docs):
    rows = [
        (1, "All rights reserved. CC BY. Released under the MIT License. all RIGHTS reserved"),
        (2, "licensed under the GNU General Public License, version 3."), (3, None), (4, ""), (5, "mit mitlicense"),
        (6, "ÀLL rights reserved"), (7, "cc by cc-by"), (7, "cc by cc-by"), (None, "SPDX-License-Identifier: Apache-2.0"),
        (8, "mit license " * 3000),
    ]
    out = {}
    for r in license.scan(docs(rows)).collect():
        out.setdefault(r.doc_id, []).append(r)
    one = out[1][0]
    assert [(d.start, d.label) for d in one.base] == [(0, "reserved"), (3, "cc-by"), (10, "reserved")]
    assert {d.label for d in one.detections} == {"mit", "cc-by", "reserved"}
    assert ("mit", 5, 10) in [(d.label, d.start, d.end) for d in one.detections]
    assert [d.label for d in out[2][0].detections] == ["gpl-3.0"]
    assert [d.label for d in out[2][0].base] == ["gpl"]
    assert out[3][0].n_words == out[4][0].n_words == 0 and out[3][0].detections == []
    assert out[5][0].n_words == 2 and out[5][0].detections == []
    assert out[6][0].base == []
    assert len(out[7]) == 2 and [d.start for d in out[7][0].base] == [0, 2]
    assert [d.label for d in out[None][0].detections] == ["apache-2.0"]
    assert len(out[8][0].detections) == 3000
    assert license.scan(docs([])).count() == 0


def test_license_rules_are_sound():
    assert len(license.RULES) > 200
    for rule in license.RULES:
        expression = re.compile(license.expression(rule))
        assert re.fullmatch(r"\w+", rule.keyword)
        assert not expression.match("")


def test_license_against_python(docs):
    import random

    random.seed(5)
    words = "licensed under the mit license gnu general public version 3 2 apache cc by sa 4 0 all rights reserved bsd clause".split()
    rows = [(k, " ".join(random.choices(words, k=random.randint(0, 40)))) for k in range(60)]

    def brute(text):
        tokens = text.split()
        found = []
        for at in range(len(tokens)):
            context = " ".join(tokens[at:at + license.REACH])
            for n, r in enumerate(license.RULES):
                if r.keyword == tokens[at] and (m := re.match(license.expression(r), context)):
                    found.append((at, at + len(m[1].split()), r.priority, r.label, n))
        return sorted(
            (d[0], d[1], d[3]) for d in found
            if not any(e[0] <= d[0] and e[1] >= d[1] and (e[2], d[1] - d[0] - e[1] + e[0], e[4]) < (d[2], 0, d[4]) for e in found)
        )

    for r in license.scan(docs(rows)).collect():
        assert sorted((d.start, d.end, d.label) for d in r.detections) == brute(rows[r.doc_id][1])


def test_language(spark, docs):
    english, german = "the cat and the dog were there with that thing ", "der Hund und die Katze waren nicht über das Haus "
    train = spark.createDataFrame(
        [(k, (english if k % 2 else german) * (1 + k % 3), "en" if k % 2 else "de") for k in range(40)] + [(99, "zzz", None)],
        "doc_id long, text string, lang string",
    )
    model = langid.train(train)
    assert model.langs == ["de", "en"]
    rows = [(1, "the dog with the cat"), (2, "die Katze und der Hund"), (3, None), (4, "12 34 !!"), (5, ""), (5, ""), (None, "that thing"), (6, english * 20000)]
    found = langid.identify(docs(rows), model).collect()
    assert [(r.doc_id, r.lang_pred) for r in found] == [
        (1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (5, "und"), (None, "en"), (6, "en")
    ]
    assert all(0 <= r.score <= 1 for r in found)
    nothing = langid.train(train.where("doc_id < 0"))
    assert [r.lang_pred for r in langid.identify(docs(rows), nothing).collect()] == ["und"] * 8
    assert langid.identify(docs([]), model).count() == 0
    bounded = langid.train(train, max_train=20)
    assert bounded.langs == ["de", "en"]


def test_language_score_against_brute_force(spark):
    rows = [(k, t, x) for k, (t, x) in enumerate([("abc abd", "x"), ("bcd bce", "y"), ("abce", "y")])]
    model = langid.train(spark.createDataFrame(rows, "doc_id long, text string, lang string"), bits=10)

    def buckets(text):
        return np.concatenate(list(langid._ngrams(text, 10, 3)))

    assert len(buckets("abcd")) == 4 + 3 + 2
    counts = {"x": Counter(buckets("abc abd")), "y": Counter(buckets("bcd bce")) + Counter(buckets("abce"))}
    for text in ("abc", "bce abd", ""):
        want = [
            np.log((1 if lang == "x" else 2) / 3) + sum(
                np.log((counts[lang][b] + 0.5) / (counts[lang].total() + 0.5 * 1024)) for b in buckets(text)) if text else
            np.log((1 if lang == "x" else 2) / 3) for lang in ("x", "y")
        ]
        assert np.allclose(model.score(text), want, atol=1e-3)


def test_packing_round_trip(docs):
    rows = [*ODD, (10, "Hello, world! It's <|endoftext|> a TEST. " * 900), (11, "é́İ ﬁ \x1c x.")]
    tokenizer = Tokenizer.from_file(TOKENIZER)
    pieces = packing.pack(docs(rows), TOKENIZER, chunk_tokens=6000).collect()
    want = Counter()
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        want[doc_id, len(ids), tuple(ids)] += 1
    texts = {k: ids for k, _, ids in want}
    total = sum(len(k[2]) * n for k, n in want.items())
    assert sum(p.length for p in pieces) == total
    for p in pieces:
        ids = texts[p.doc_id][p.start:p.start + p.length]
        assert p.doc_tokens == len(texts[p.doc_id]) and len(ids) == p.length
        assert p.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
    sequences = {}
    for p in sorted(pieces, key=lambda p: (p.sequence_id, p.offset)):
        assert p.offset == sequences.get(p.sequence_id, 0)
        sequences[p.sequence_id] = p.offset + p.length
    assert all(n <= 4096 and n & (n - 1) == 0 for n in sequences.values())
    for doc_id, ids in texts.items():
        spans = sorted((p.start, p.start + p.length) for p in pieces if p.doc_id == doc_id)
        covered = Counter(k for a, b in spans for k in range(a, b))
        times = sum(n for k, n in want.items() if k[0] == doc_id)
        assert covered == Counter({k: times for k in range(len(ids))})
    assert packing.pack(docs([]), TOKENIZER).count() == 0


def test_packing_balances_cost():
    import random

    random.seed(3)
    lengths = [int(2 ** random.uniform(3, 12)) for _ in range(2000)]
    placed = packing.assign(lengths, 4096, 1.0, 1 / 2048)
    full = [s for s in placed if sum(n for _, _, n in s) == 4096]
    costs = [sum(n + n * n / 2048 for _, _, n in s) for s in full]
    in_order, room, plain = [], 0, [0.0]
    for n in lengths:  # the same documents, one after the other
        while n:
            m = min(n, 4096 - room)
            plain[-1] += m + m * m / 2048
            room, n = (room + m) % 4096, n - m
            if not room:
                plain.append(0.0)
    in_order = plain[:-1]
    assert np.std(costs) < 0.7 * np.std(in_order)
    assert packing.sequence_lengths(4096 * 2 + 5, 4096) == [4096, 4096, 4, 1]


def test_hashes_of_words():
    import random

    random.seed(2)
    texts = [" ".join(random.choices(["a", "bb", "ab", "ba", "cé", ""], k=random.randint(0, 50))).encode() for _ in range(200)]
    texts.append(b"long " * 400_000)
    hashes, starts = word_hashes(texts)
    words = [w for t in texts for w in t.split()]
    assert len(hashes) == len(words) == starts[-1]
    assert [starts[k + 1] - starts[k] for k in range(len(texts))] == [len(t.split()) for t in texts]
    seen = {}
    assert all(seen.setdefault(w, h) == h for w, h in zip(words, hashes)) and len(set(seen.values())) == len(seen)
    runs = run_hashes(hashes[:1000], 3)
    known = {}
    assert all(known.setdefault(tuple(words[k:k + 3]), h) == h for k, h in enumerate(runs))
    assert len(set(known.values())) == len(known)


@pytest.mark.parametrize("text", ["a b. C, d!! 12. it's", "ÉCOLE, x́. <|startoftext|> <|x", "ß.  , A.B. (c)."])
def test_encoder_equals_tokenizer(text):
    encoder = packing._Encoder(TOKENIZER)
    assert next(iter(encoder.encode([text]))) == encoder._plain(text)
