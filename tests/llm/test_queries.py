"""The registered queries next to their SQL, and the pipeline next to plain Python."""

from __future__ import annotations

import hashlib

import pytest

import corpus_pipeline
from paystream.llm import decontaminate, toxicity
from paystream.llm.oracles import ORACLES
from paystream.llm.queries import QUERIES
from tests.compare import expected
from tests.llm.test_copies import groups, repeats, split

SF = "/root/testdata/sf0.001"


def rows_of(frame):
    columns = sorted(frame.columns)
    plain = frame[columns].astype(object).where(frame[columns].notna(), None)
    return sorted((tuple(v if v is None or isinstance(v, str) else round(float(v), 9) for v in r) for r in plain.itertuples(index=False)), key=repr)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    assert rows_of(QUERIES[name](spark, SF).toPandas()) == rows_of(expected(ORACLES[name], SF))


def test_every_query_covers_its_table(spark):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    for name in ("op2_toxicity", "op10_language_id"):
        found = QUERIES[name](spark, SF).toPandas()
        assert len(found) == n and found["score"].between(0, 1).all() and found["score"].notna().all()


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    langs = QUERIES["op10_language_id"](spark, sf).where("held_out").join(docs, "doc_id").where("lang_pred <> 'und'")
    assert langs.where("lang = lang_pred").count() >= 0.97 * langs.count()
    found = QUERIES["op2_toxicity"](spark, sf).where("held_out").join(labels, "doc_id").select("toxic", "predicted", "score").collect()
    clean = [r for r in found if not r.toxic]
    toxic = [r for r in found if r.toxic]
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    assert sum(r.predicted for r in toxic) >= 0.6 * len(toxic)


def test_pipeline_stages_one_by_one(spark, tmp_path):
    """Each stage against a plain version of it on the same input."""
    import random

    random.seed(21)
    words = [f"w{k}" for k in range(2000)]
    text = lambda n: random.choices(words, k=n)
    items = [" ".join(text(40)) for _ in range(5)]
    passage, rows, labels = text(60), [], []
    for k in range(240):
        own = text(random.randint(20, 200))
        if k % 8 == 0:
            own[3:3] = random.choices(["vile", "nasty"], k=3)
        if k % 10 == 1:
            own = list(passage) + own
        if k % 12 == 5:
            own[9:9] = items[k % 5].split()
        rows.append((k, " ".join(own), "en", "s", None))
        labels.append((k, 1, int(k % 8 == 0)))
    rows += [(500 + k, rows[k][1] + " end", "en", "s", 1) for k in range(20)] + [(900, None, None, None, None), (901, "", "en", "s", 0), (902, None, "en", "s", 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    names = docs.columns
    docs = docs.selectExpr("*", "1 AS kept", "2 AS spans")
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        path = str(tmp_path / name)
        stage(spark, docs, str(tmp_path)).write.parquet(path)
        docs = spark.read.parquet(path)
        after = {r.doc_id: r.asDict().get("text") for r in docs.collect()}
        if name == "toxicity":
            want = {k for k, t in before.items() if not {"vile", "nasty"} & set(split(t))}
        elif name == "near_duplicates":
            least = {i: c for i, _, c in groups(list(before.items()), 5, 80)}
            want = {k for k in before if least[k] == k}
            assert len(want) < len(before)
        elif name == "substring_dedup":
            want = set(before)
            digest = lambda t: hashlib.sha256(" ".join(split(t)).encode()).hexdigest()
            cut = {i: (gone, kept) for i, _, gone, kept in repeats(list(before.items()), 50)}
            assert any(gone for gone, _ in cut.values())
            for k, t in before.items():
                gone, kept = cut[k]
                assert after[k] == t if not gone else digest(after[k]) == kept
        elif name == "decontamination":
            want = {k for k, t in before.items() if not any(i in (t or "") for i in items)}
            assert 0 < len(want) < len(before)
        else:
            want = set(before)
            assert "sequence_id" in docs.columns
        assert set(after) == want, name
        if name != "packing":
            assert docs.columns == names
    empty = docs.sparkSession.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, str(tmp_path)).count() == 0


def test_models_are_plain_values():
    assert toxicity.Model({}, 0.1, 1, 1, 0, 0, 0.25).probability(0) == 0.25
    assert decontaminate.plain("A, b\n#É") == "a  b  é".encode()
