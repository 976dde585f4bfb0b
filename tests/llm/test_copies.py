"""Near duplicates, repeated passages, benchmark copies, toxicity: against brute force."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter

import numpy as np

from paystream.llm import decontaminate, minhash, substring, toxicity
from paystream.llm.hashing import word_hashes

ODD = [(900, None), (901, ""), (902, " \n"), (903, "one"), (904, "ONE"), (903, "one"), (None, "one"), (905, "w " * 3000)]


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lower(text):
    return "".join(c.lower() if c.isascii() else c for c in text or "")


def groups(rows, width, percent):
    def shingles(text):
        words = split(lower(text))
        if len(words) < width:
            return {tuple(words)} if words else set()
        return {tuple(words[k:k + width]) for k in range(len(words) - width + 1)}

    sets = [shingles(t) for _, t in rows]
    at = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if common and 100 * common >= percent * len(sets[i] | sets[j]):
                a, b = at[i], at[j]
                at = [b if x == a else x for x in at]
    least = {}
    for k, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[at[k]] = min(least.get(at[k], doc_id), doc_id)
    return Counter((rows[k][0], len(sets[k]), least.get(at[k], rows[k][0])) for k in range(len(rows)))


def edited(words, n, vocabulary):
    out = list(words)
    for _ in range(n):
        out[random.randrange(len(out))] = random.choice(vocabulary)
    return out


def test_near_duplicates(docs):
    random.seed(11)
    vocabulary = [f"w{k}" for k in range(400)]
    rows = list(ODD)
    for base in range(12):
        words = random.choices(vocabulary, k=random.choice([3, 12, 60, 200]))
        for _ in range(8):
            rows.append((len(rows), " ".join(edited(words, random.randint(0, max(1, len(words) // 12)), vocabulary))))
    # A chain: each is close to the next only.
    words = random.choices(vocabulary, k=100)
    for _ in range(25):
        words = edited(words, 3, vocabulary)
        rows.append((len(rows), " ".join(words)))
    random.shuffle(rows)
    for width in (2, 5):
        found = minhash.near_duplicates(docs(rows), width=width).collect()
        assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == groups(rows, width, 80)
        assert all(r.kept == (r.doc_id == r.component_id) for r in found if r.doc_id is not None)
    assert minhash.near_duplicates(docs([])).count() == 0


def test_one_row_of_each_group_stays(spark):
    """Rows without id, repeated rows and different texts of one id."""
    a, b, c, d = (" ".join(f"{x}{k}" for k in range(50)) for x in "abcd")
    rows = [(None, a), (None, a), (None, a + " x"), (5, b), (None, b), (5, b), (6, c), (6, d), (7, d), (None, None), (8, "")]
    frame = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    left = Counter((r.doc_id, r.text) for r in minhash.first_rows(frame).collect())
    assert left - Counter([(None, a), (None, a + " x")]) == Counter([(5, b), (6, c), (6, d), (None, None), (8, "")])
    assert sum(left.values()) == 6


def test_hub_that_is_not_the_least(docs):
    """Copies that are only close to a later document are found, though no center is the hub at first."""
    random.seed(4)
    vocabulary = [f"v{k}" for k in range(5000)]
    hub = random.sample(vocabulary, 300)
    rows = []
    for k in range(40):
        copy = list(hub)
        for at in random.sample(range(300), 14):
            copy[at] = random.choice(vocabulary)
        rows.append((k, " ".join(copy)))
    rows.append((1000, " ".join(hub)))
    found = minhash.near_duplicates(docs(rows), width=2).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in found) == groups(rows, 2, 80)


def test_densified_signature_estimates_similarity():
    random.seed(1)
    signer = minhash.Signer(128, 4)
    for size in (5, 40, 2000):
        close = []
        for _ in range(60):
            base = np.array(sorted({random.getrandbits(64) for _ in range(size)}), "u8")
            part = np.sort(base[random.sample(range(size), int(size * 0.8))])
            close.append((signer.sign(base) == signer.sign(part)).mean())
        assert abs(np.mean(close) - 0.8) < 0.06


def test_components(spark):
    random.seed(9)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(400, 440)]
    parent = {x: x for e in edges for x in e}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    found = minhash.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in found} == {x: root(x) for x in parent if root(x) != x}


def repeats(rows, window):
    words = [split(t) for _, t in rows]
    first = {}
    for (doc_id, _), w in zip(rows, words):
        for k in range(len(w) - window + 1):
            g = tuple(w[k:k + window])
            rank = float("inf") if doc_id is None else doc_id
            first[g] = min(first.get(g, rank), rank)
    out = Counter()
    for (doc_id, _), w in zip(rows, words):
        rank = float("inf") if doc_id is None else doc_id
        gone = {k + j for k in range(len(w) - window + 1) if first[tuple(w[k:k + window])] < rank for j in range(window)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def test_repeats(docs):
    random.seed(6)
    passage = [f"p{k}" for k in range(30)]
    rows = list(ODD) + [(10, " ".join(passage)), (10, " ".join(passage)), (11, " ".join(passage[:20]))]
    for k in range(60):
        words = random.choices("abcd", k=random.randint(0, 40))
        if k % 3 == 0:
            at = random.randrange(15)
            words[5:5] = passage[at:at + 14]
        rows.append((20 + k, random.choice([" ", "\n", "\t "]).join(words)))
    for window, group in ((13, 1_000_000), (5, 40)):
        found = substring.deduplicate(docs(rows), window=window, group_suffixes=group, block_words=500).collect()
        assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == repeats(rows, window)
        for r in found:
            assert sum(s.end - s.start for s in r.spans) == r.n_removed
            assert r.text is None or hashlib.sha256(" ".join(split(r.text)).encode()).hexdigest() == r.kept_sha256
            if not r.n_removed:
                assert (r.doc_id, r.text) in rows
    assert substring.deduplicate(docs([])).count() == 0


def test_repeats_of_many_rows_without_an_id_of_their_own(docs):
    """Thousands of different texts with a null id, and with one id, keep their own places."""
    random.seed(16)
    passage = [f"p{k}" for k in range(30)]
    rows = [(1, " ".join(passage)), (None, None), (None, ""), (None, "one")]
    for k in range(6000):
        words = [f"u{random.randrange(5000)}" for _ in range(random.randint(1, 60))]
        if k % 2:
            at = random.randint(0, len(words))
            words[at:at] = passage[:random.randint(13, 30)]
        rows.append((None if k % 3 else 77, " ".join(words)))
    rows += rows[-5:]
    found = substring.deduplicate(docs(rows)).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in found) == repeats(rows, 13)


def test_rows_without_an_id_go_to_all_blocks(docs):
    rows = [(None, f"w{k} " * 20) for k in range(400)] + [(None, ""), (7, "one")] * 100
    sizes = [r["count"] for r in substring._blocks_of(docs(rows, extra=False), 13, 8).groupBy("block").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 200


def test_repeats_carry_columns(spark):
    frame = spark.createDataFrame([(1, "a b c", "x", 7), (2, None, None, 8)], "doc_id long, text string, lang string, spans long")
    rows = substring.deduplicate(frame, carry=("lang",)).collect()
    assert {(r.doc_id, r.text, r.lang) for r in rows} == {(1, "a b c", "x"), (2, None, None)}


def smith_waterman(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = max(0, table[i][j] + (2 if x == y else -1), table[i][j + 1] - 1, table[i + 1][j] - 1)
    return max(map(max, table))


def test_alignment():
    random.seed(8)
    for _ in range(200):
        a, b = (np.array(random.choices(range(4), k=random.randint(1, 14)), "u8") for _ in range(2))
        assert decontaminate.align(a, b)[0] == smith_waterman(a.tolist(), b.tolist())


def test_benchmark_copies(docs, spark):
    random.seed(12)
    vocabulary = [f"t{k}" for k in range(3000)]
    text = lambda n: " ".join(random.choices(vocabulary, k=n))
    items = [(k, text(random.randint(20, 60))) for k in range(20)] + [(50, None), (51, ""), (52, "too short"), (3, "again, " * 9)]
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS doc_id", "'y' AS similarity")
    rows, want = list(ODD), set()
    for k in range(60):
        words = text(random.randint(0, 300)).split()
        if k % 3 == 0:
            item, copy = items[k % 20][0], items[k % 20][1].split()
            for _ in range(len(copy) // 10):
                copy[random.randrange(len(copy))] = random.choice(vocabulary)
            del copy[random.randrange(len(copy))]
            words[len(words) // 2:len(words) // 2] = [random.choice([w, w.upper() + ",", w + "%%"]) for w in copy]
            want.add((k, item))
        rows.append((k, " ".join(words)))
    found = decontaminate.find(docs(rows), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want
    assert all(0.5 <= r.similarity <= 1 and r.start < r.end for r in found)
    # Many small blocks give the same.
    small = decontaminate.find(docs(rows), benchmark, block_grams=100).collect()
    assert {(r.doc_id, r.item_id, r.similarity) for r in small} == {(r.doc_id, r.item_id, r.similarity) for r in found}
    left = decontaminate.remove(docs(rows), benchmark)
    assert sorted((r.doc_id or -1) for r in left.collect()) == sorted((i or -1) for i, _ in rows if i not in {d for d, _ in want})
    assert decontaminate.find(docs([]), benchmark).count() == 0
    assert decontaminate.find(docs(rows), benchmark.where("false")).count() == 0


def test_copies_that_were_copied_often(docs, spark):
    """Edited and partial copies are found in however many texts the same one stands."""
    random.seed(14)
    item = [f"q{k}" for k in range(40)]
    benchmark = spark.createDataFrame([(7, " ".join(item)), (8, " ".join(f"z{k}" for k in range(30)))], "item_id long, text string")
    kinds = {
        "fifth": ["x" if k % 5 == 4 else w for k, w in enumerate(item)],
        "fourth": ["x" if k % 4 == 3 else w for k, w in enumerate(item)],
        "half": item[:20],
    }
    for copy in kinds.values():
        for times in (5, 9, 50):
            rows = [(k, " ".join([f"a{random.randrange(900)}" for _ in range(60)] + copy * (k < times))) for k in range(times + 20)]
            found = decontaminate.find(docs(rows), benchmark).collect()
            assert {(r.doc_id, r.item_id) for r in found} == {(k, 7) for k in range(times)}
            assert {r.doc_id for r in decontaminate.remove(docs(rows), benchmark).collect()} == set(range(times, times + 20))


def test_passages_of_long_items(docs, spark):
    """Verbatim and slightly edited passages count whatever share of their item they are; shorter ones don't."""
    random.seed(17)
    items = {k: [f"i{k}x{j}" for j in range(n)] for k, n in ((1, 60), (2, 500), (3, 4000))}
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    near = ["x" if k % 10 == 9 else w for k, w in enumerate(items[2][300:340])]
    copies = [(1, items[1][10:39]), (2, items[2][100:300]), (2, near), (3, items[3][-25:]), (0, items[1][:20]), (0, items[3][50:74])]
    noise = lambda: [f"a{random.randrange(900)}" for _ in range(80)]
    rows = [(k, " ".join(noise() + copy + noise())) for k, (_, copy) in enumerate(copies)]
    found = decontaminate.find(docs(rows), benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(k, i) for k, (i, _) in enumerate(copies) if i}
    assert {r.doc_id: r.end - r.start for r in found} == {0: 29, 1: 200, 2: 39, 3: 25}


def edited_every(words, every, kind):
    """``words`` with each ``every``-th one replaced or deleted, or one inserted after it."""
    out = []
    for k, w in enumerate(words):
        hit = k % every == every - 1
        out += [w, "new"] if kind == "insert" and hit else ["new"] if kind == "replace" and hit else [] if hit else [w]
    return out


def test_all_copies_of_all_items(docs, spark):
    """What is found is what aligning every text with every item gives, whatever was edited and however often."""
    random.seed(23)
    common = [f"c{k}" for k in range(40)]
    draw = lambda n: [random.choice(common) if random.random() < 0.5 else f"r{random.randrange(4000)}" for _ in range(n)]
    items = {k: draw(n) for k, n in enumerate([3, 4, 5, 7, 12, 16, 20, 33, 40, 59, 60, 100])}
    items[12], items[13] = random.choices(common, k=30), ["c1", "c2"] * 10
    rows = []
    for i, words in items.items():
        for kind in ("insert", "replace", "delete"):
            for every in (1, 2, 3, 4, 5, 101):
                copy = edited_every(words, every, kind)
                rows += [(len(rows), " ".join([*draw(random.choice([0, 30])), *copy, *draw(random.choice([0, 80]))]))]
                if every == 3:  # the same copy in many texts
                    rows += [(len(rows) + k, " ".join(draw(20) + copy)) for k in range(12)]
    rows += [(len(rows) + k, " ".join(random.choices(common, k=random.choice([1, 30, 300])))) for k in range(30)]
    hashed = {k: word_hashes([decontaminate.plain(" ".join(w))])[0] for k, w in items.items()}
    want = {}
    for d, text in rows:
        passage = word_hashes([decontaminate.plain(text)])[0]
        for i, known in hashed.items():
            score = decontaminate.align(known, passage)[0]
            if score >= max(min(len(known), 2 * decontaminate.PASSAGE), 2 * min(len(known), decontaminate.FEWEST)):
                want[d, i] = score / (2 * len(known))
    assert {i for _, i in want} == set(items)
    benchmark = spark.createDataFrame([(k, " ".join(w)) for k, w in items.items()], "item_id long, text string")
    found = {(r.doc_id, r.item_id): r.similarity for r in decontaminate.find(docs(rows), benchmark).collect()}
    assert found == want
    clean = decontaminate.remove(docs(rows), benchmark)
    assert {r.doc_id for r in clean.collect()} == {d for d, _ in rows} - {d for d, _ in found}


def test_matches_in_turns(monkeypatch):
    """Texts with more hits than are held at once give the same."""
    random.seed(15)
    items = [(k, " ".join(random.choices("abcde", k=20))) for k in range(5)]
    texts = [" ".join(random.choices("abcde", k=random.choice([0, 2, 90]))).encode() for _ in range(12)]
    block = decontaminate.Block.of(items, 3)
    whole = list(decontaminate.matches(texts, block, block.sieve(), 0.5))
    for pairs in (1, 300):
        monkeypatch.setattr(decontaminate, "_PAIRS", pairs)
        assert whole and list(decontaminate.matches(texts, block, block.sieve(), 0.5)) == whole


def maximal(scores):
    """Maximal segments by their definition: the best one, then those to its left and right."""
    best = None
    for i in range(len(scores)):
        for j in range(i + 1, len(scores) + 1):
            s = sum(scores[i:j])
            if s > 1e-9 and (best is None or s > best[0] + 1e-9):
                best = s, i, j
    if not best:
        return []
    _, i, j = best
    return [*maximal(scores[:i]), (i, j), *((a + j, b + j) for a, b in maximal(scores[j:]))]


def test_segments():
    random.seed(1)
    for _ in range(400):
        scores = [random.choice([None, None, 1.3, -0.7, 2.1, 0.6]) for _ in range(random.randint(1, 13))]
        scores = [x + random.random() * 1e-3 if x else x for x in scores]
        found = toxicity.segments([(k, x) for k, x in enumerate(scores) if x is not None], 0.25)
        assert [(a, b) for a, b, _ in found] == maximal([-0.25 if x is None else x for x in scores])


def test_toxicity(docs, spark):
    random.seed(7)
    words = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for k in range(400):
        text = random.choices(words, k=random.randint(5, 400))
        bad = k % 8 == 0
        for _ in range(2 * bad):
            text[random.randrange(len(text))] = random.choice(["nastyA", "nastyB", "vile", "Foul!"])
        rows.append((k, " ".join(text)))
        labels.append((k, int(bad)))
    labels += [(1, None), (None, 1), (399, 0)]
    known = spark.createDataFrame(labels, "doc_id long, toxic int").selectExpr("*", "'q' AS text")
    model = toxicity.train(docs(rows), known.where("doc_id < 300"))
    odd = [(900, None), (901, ""), (902, "..."), (903, "vile"), (903, "vile"), (None, "nastya w1"), (904, "w1 " * 20000)]
    found = toxicity.score(docs(rows + odd), model).collect()
    assert len(found) == len(rows) + len(odd)
    told = {r.doc_id: r for r in found}
    assert all((told[k].score >= 0.7) == (k % 8 == 0) for k in range(400))
    assert all(told[k].passages == [] and told[k].score < 0.1 for k in (900, 901, 902, 904))
    assert told[903].score >= 0.7 and told[None].score >= 0.7 and told[903].passages[0].end == 1
    nothing = toxicity.train(docs(rows), known.where("toxic = 0"))
    assert {r.score for r in toxicity.score(docs(rows[:5]), nothing).collect()} == {0.0}
    assert toxicity.score(docs([]), model).count() == 0
    assert toxicity.train(docs([]), known).scores == {}
