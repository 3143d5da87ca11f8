"""Toxicity on a small corpus with words that only toxic documents have."""

from abonados.llm import toxicity

WORDS = "river stone bread lamp garden window paper cloud winter table".split()


def test_toxic_documents_are_told_apart(spark):
    plain = [" ".join(WORDS[(i + k) % 10] for k in range(6)) for i in range(60)]
    rude = [f"{t} you {('zorgface', 'blatherskull')[i % 2]} {('zorgface', 'grumphead')[i // 2 % 2]}" for i, t in enumerate(plain)]
    rows = [(i, t) for i, t in enumerate(plain + rude)]
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i >= 60)) for i, _ in rows if i % 5], "doc_id long, toxic int")
    model = toxicity.train(documents, labels, documents)
    odd = spark.createDataFrame([(-1, None), (-2, "")], "doc_id long, text string")
    found = {r.doc_id: r for r in toxicity.score(documents.unionByName(odd), model).collect()}
    assert len(found) == 122
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in found.values())
    assert all(found[i].predicted == int(i >= 60) for i, _ in rows)
    assert found[-1].score == found[-2].score < 0.5


def test_without_labels_nothing_is_toxic(spark):
    documents = spark.createDataFrame([(1, "some text"), (2, None)], "doc_id long, text string")
    model = toxicity.train(documents, spark.createDataFrame([], "doc_id long, toxic int"), documents)
    assert [r.predicted for r in toxicity.score(documents, model).collect()] == [0, 0]
