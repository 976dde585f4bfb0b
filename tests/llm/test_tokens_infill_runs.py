"""Token counts, fill-in-middle and periodic runs: against the library and brute force."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from paystream.llm import infill, runs, tokens
from paystream.llm.queries import QUERIES

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
SF = "/root/testdata/sf0.001"
ODD = [
    (1, None), (2, ""), (3, " \t\n"), (4, "one"), (4, "one"), (None, "no id here"), (None, None), (5, "a\x00b <P> \x7f"),
    (6, "x" * 20000), (7, "É é 中文😀 ''s we'LL"), (8, "w " * 20000), (9, "<|endoftext|>a<|startoftext|> <|ENDOFTEXT|>"),
    (10, "1 2 3\x85 4\x1c5"), (11, "u v " * 8 + "w " + "u v w " * 5), (-12, "\n\n<S"),
]


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_token_counts(docs):
    library = Tokenizer.from_file(VOCABULARY)
    random.seed(3)
    signs = "abcAB eéÉ,.'’ Σςİıß́ \x85\x1c\x1f\x00\n\t1٣²ⅷ中文字😀🏽‍_-|<>endoftext"
    rows = ODD + [(100 + k, "".join(random.choices(signs, k=random.randint(0, 40)))) for k in range(2000)]
    found = tokens.count_tokens(docs(rows), VOCABULARY).collect()
    want = Counter((i, len((t or "").encode()), len(library.encode(t or "", add_special_tokens=False).ids)) for i, t in rows)
    assert Counter(map(tuple, found)) == want
    assert tokens.count_tokens(docs([]), VOCABULARY).count() == 0


def test_token_counts_of_tables(spark):
    library = Tokenizer.from_file(VOCABULARY)
    want = {
        (r.doc_id, len((r.text or "").encode()), n := len(library.encode(r.text or "", add_special_tokens=False).ids), n > 2048)
        for r in spark.read.parquet(f"{SF}/documents.parquet").collect()
    }
    assert {tuple(r) for r in QUERIES["op11_token_counts"](spark, SF).collect()} == want


def test_merging_takes_the_leftmost_of_equal_pairs():
    ranks = {("a", "a"): 0, ("aa", "b"): 1, ("a", "b"): 2}
    assert tokens.merged(list("aaab"), ranks) == 2  # aa ab
    assert tokens.merged(list("aaaab"), ranks) == 2  # aa aab
    assert tokens.merged([], ranks) == 0 and tokens.merged(["a"], ranks) == 1


def test_blanks_that_are_part_of_tokens(tmp_path):
    """A vocabulary in which a blank belongs to the word after it; other kinds are refused."""
    path = public_tokenizers.path("byte_bpe_50k.json")
    library, count = Tokenizer.from_file(path), tokens.Counter(path)
    assert not count.blanks_part
    for text in ("Hello  world\n\n a", " x<|endoftext|> y", "", "é 中"):
        assert count.count(text.encode()) == len(library.encode(text, add_special_tokens=False).ids)
    other = tmp_path / "other.json"
    other.write_text('{"model": {"type": "Unigram"}, "added_tokens": []}')
    with pytest.raises(ValueError):
        tokens.Counter(str(other))


def infilled(doc_id, text):
    text, units = text or "", re.findall(r"[A-Za-z]+|[^A-Za-z]", text or "")
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if not text or any(x in text for x in infill.MARKERS) or h[2] % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    if h[3] % 100 < 20:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def test_fill_in_middle_and_back(docs):
    random.seed(1)
    signs = "ab Z\n\x00é中😀<P>SM>\t\x7f0"
    rows = ODD + [(100 + k, "".join(random.choices(signs, k=random.randint(0, 40)))) for k in range(2000)]
    made = infill.fill_in_middle(docs(rows))
    out = made.collect()
    assert Counter(map(tuple, out)) == Counter(infilled(*r) for r in rows)
    assert {r.form for r in out} == {"plain", "psm", "spm"}
    back = Counter((r.doc_id, r.restored) for r in infill.restore(made).collect())
    assert back == Counter((i, t or "") for i, t in rows)
    assert infill.restore(infill.fill_in_middle(docs([]))).count() == 0
    with pytest.raises(ValueError):
        infill.fill_in_middle(docs(rows), markers=("a", "b", "c"))


def plain_runs(words, least=12):
    """Runs by looking at all periods and places."""
    found = []
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            inside = any(a <= start and start + length <= a + n for a, n, _ in found)
            if length >= max(least, 2 * q) and not inside:
                found.append((start, length, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {k for a, n, q in found for k in range(a + q, a + n)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def random_words(n):
    words = random.choices("abcde"[:random.choice([1, 2, 2, 3, 5])], k=n)
    if n > 3 and random.random() < 0.5:
        a, p = random.randint(0, n // 3), random.randint(1, n // 2)
        words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
    return words


def test_runs_of_short_sequences():
    random.seed(7)
    for _ in range(1500):
        words, least = random_words(random.randint(1, 60)), random.choice([2, 5, 12])
        want = plain_runs(words, least)
        assert [tuple(r) for r in runs.find_runs(list(map(ord, words)), least).tolist()] == want
        text = " ".join(words).encode()
        _, found, left = runs._judge([text, b"", text], least)
        assert found == [want, [], want] and left[0].decode() == collapsed(words, want)


def test_runs_of_documents(docs):
    random.seed(8)
    rows = ODD + [(100 + k, " ".join(random_words(random.randint(0, 80)))) for k in range(300)]
    long = [f"w{random.randrange(3000)}" for _ in range(6000)]
    rows.append((999, "\n".join(long + long[-700:] * 4 + long[:50] + ["z"] * 30)))
    out = runs.periodic_runs(docs(rows)).collect()
    want = Counter()
    for doc_id, text in rows:
        words = split(text)
        found = plain_runs(words) if len(words) < 15_000 else [(0, len(words), 1)]
        want[(doc_id, len(words), tuple(found), collapsed(words, found))] += 1
    assert Counter((r.doc_id, r.n_words, tuple((x.start, x.length, x.period) for x in r.runs), r.collapsed) for r in out) == want
    assert runs.periodic_runs(docs([])).count() == 0


def test_runs_of_tables(spark):
    """The whole query, its repeats included, next to plain Python."""
    sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
    want = set()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        words, h = split(r.text), zlib.crc32(str(r.doc_id).encode())
        n, g = len(words), zlib.crc32(str(r.doc_id).encode()) // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]
        found = plain_runs(words)
        best = min(found, key=lambda x: (-x[1], x[0], x[2]), default=None)
        fields = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        want.add((r.doc_id, len(found), *fields, sha("".join("%d,%d,%d\n" % x for x in found)), sha(collapsed(words, found))))
    assert any(x[1] for x in want)
    assert {tuple(r) for r in QUERIES["op13_periodic_runs"](spark, SF).collect()} == want


def test_suffix_tree_has_all_suffixes():
    random.seed(9)
    text = [random.randrange(3) for _ in range(200)]
    places = runs.np.array([(a, b) for a in range(201) for b in range(a + 1, 201)])
    common = runs.Extensions(text).of(places[:, 0], places[:, 1]).tolist()
    for (a, b), n in zip(places.tolist(), common):
        assert text[a:a + n] == text[b:b + n] and (b + n == 200 or text[a + n] != text[b + n])
