"""The pipeline stage by stage against plain versions, and the registration."""

import importlib

import corpus_pipeline
from kpitide.llm import languages, packing, toxicity
from kpitide.llm.common import table
from tests.compare import DATA
from tests.llm.test_pairs import plain_groups
from tests.llm.test_texts import WORDS, check_packing, plain_removal

SF_DIR = str(DATA / "sf0.001")


def test_stages(spark, tmp_path):
    docs = table(spark, SF_DIR, "documents")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)

    def step(name, docs):
        path = str(tmp_path / name.replace(" ", "-"))
        out = stages[name](spark, docs, SF_DIR)
        out.write.parquet(path)
        return spark.read.parquet(path)

    spoken = step("language ID", docs)
    assert spoken.columns == columns
    prototypes = languages.learn(docs)
    good = {r.doc_id for r in languages.predict(docs, prototypes).collect() if r.lang_pred != "und" and r.score > 0}
    assert {r.doc_id for r in spoken.collect()} == good and len(good) >= 0.99 * docs.count()

    clean = step("toxicity", spoken)
    model = toxicity.fit(spoken, table(spark, SF_DIR, "labels"))
    scored = toxicity.score(spoken, model).collect()
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in scored if r.score < toxicity.PREDICT_FROM}
    assert clean.columns == columns and clean.count() < spoken.count()

    single = step("n-gram Jaccard join", clean)
    groups = plain_groups([(r.doc_id, r.text) for r in clean.collect()], corpus_pipeline.NEAR)
    assert {r.doc_id for r in single.collect()} == {i for i, (_, c) in groups.items() if i == c}

    cut = step("substring dedup", single)
    expected = plain_removal([(r.doc_id, r.text) for r in single.collect()])
    assert {r.doc_id: r.text for r in cut.collect()} == expected
    assert all(r.n_chars == len(r.text) for r in cut.collect()) and cut.columns == columns

    texts = [(r.doc_id, r.text) for r in cut.collect()]
    assert check_packing(packing.pack(cut, WORDS).collect(), texts, packing.WINDOW) > 0.95
    last = step("packing", cut).collect()
    assert {r.doc_id for r in last} == {d for d, _ in texts}


def test_registration():
    entry = importlib.import_module("__spark_entry__")
    names = set(entry.queries())
    assert {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)} and "pipeline" in names
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language ID", "toxicity", "n-gram Jaccard join", "substring dedup", "packing"]
