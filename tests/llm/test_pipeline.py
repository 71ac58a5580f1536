"""The pipeline against plain code, stage by stage and as a whole."""

import corpus_pipeline
from profitlens.llm import queries, secrets, toxicity
from profitlens.session import stage
from tests.llm.odd import documents, nothing
from tests.llm.test_decontamination import plain as plain_hits
from tests.llm.test_packing import check_bins
from tests.llm.test_simhash import plain_components, plain_print


def test_stages_against_plain_code(spark, data):
    docs = queries.table(spark, data, "documents")
    columns = docs.columns
    model = queries.toxicity_model(spark, data)
    before = {r["doc_id"]: r["text"] for r in docs.collect()}
    steps = []
    for name, function in corpus_pipeline.STAGES:
        docs = stage(function(spark, docs, data), name)
        if name != "best_fit_packing":
            assert docs.columns == columns
            steps.append({r["doc_id"]: r["text"] for r in docs.collect()})

    def score(text):
        return toxicity.score_rows(model, [toxicity.term_buckets(text.encode(), model.bits, model.stems)])[0]

    assert steps[0] == {d: t for d, t in before.items() if score(t) < 0.5}
    prints = [(d, plain_print(steps[0][d])) for d in sorted(steps[0])]
    assert set(steps[1]) == set(plain_components(prints))
    items = [(r["item_id"], r["text"]) for r in queries.table(spark, data, "benchmark").collect()]
    clean = {}
    for d, text in steps[1].items():
        size, hit, _ = plain_hits(text, items, 13)
        if not hit or 20 * len(hit) < size:
            clean[d] = hit
    assert set(steps[2]) == set(clean)
    assert all(steps[2][d] == steps[1][d] for d, hit in clean.items() if not hit)
    assert set(steps[3]) == set(steps[2])
    keywords = secrets.automaton()
    for d, text in steps[2].items():
        data_ = text.encode()
        spans = [(a, b) for a, _, b in secrets.scan(data_, keywords)]
        assert steps[3][d] == secrets.cut(data_, spans, b"[secret]").decode()
    sources = {r["doc_id"]: r["source"] for r in queries.table(spark, data, "documents").collect()}
    check_bins(docs.collect(), {d: (t, sources[d]) for d, t in steps[3].items()}, 2048)


def test_run_returns_the_last_stage(spark, data):
    assert corpus_pipeline.run(spark, data).columns[:2] == ["doc_id", "piece"]


def test_odd_and_empty_tables_pass_every_stage(spark, data):
    for docs in (documents(spark), nothing(spark)):
        columns, rows = docs.columns, docs.count()
        for name, function in corpus_pipeline.STAGES:
            docs = stage(function(spark, docs, data), name)
            if name != "best_fit_packing":
                assert docs.columns == columns
        assert (docs.count() > 0) == (rows > 0)
