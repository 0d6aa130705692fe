import random
import zlib

import numpy as np
import pytest

from martloom.llm import toxicity as tx


def corpus(n, seed=0):
    rng = random.Random(seed)
    rude = ["blarg", "snorf", "zwick", "krumble", "idiot"]
    docs, labels = [], []
    for i in range(n):
        words = [f"w{rng.randint(0, 300)}" for _ in range(rng.randint(5, 80))]
        toxic = rng.random() < 0.2
        if toxic:
            for _ in range(rng.randint(2, 5)):
                words.insert(rng.randrange(len(words)), rng.choice(rude) + rng.choice(["", ",", "."]))
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_held_out_accuracy(spark, make_docs):
    docs, labels = corpus(1500)
    truth = dict(labels)
    hidden = [(i, y) for i, y in labels if i % 3]
    hidden = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in hidden]  # never to be read
    frame = make_docs([*docs, (2000, None), (2001, ""), (None, "idiot"), (2002, "w1 " * 50_000)])
    out = tx.predict(frame, tx.fit(frame, spark.createDataFrame(hidden, "doc_id long, toxic int")))
    rows = out.withColumn("held_out", tx.held_out(out.doc_id)).collect()
    assert len(rows) == 1504 and out.columns.count("score") == 1
    assert all(r.held_out == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    scored = [r for r in rows if r.held_out and r.doc_id in truth]
    right = np.mean([truth[r.doc_id] == r.predicted for r in scored])
    assert right > 0.97
    assert {r.predicted for r in rows if r.doc_id in (2000, 2001, 2002)} == {0}


@pytest.mark.parametrize("labels", [[], [(0, 0), (1, 0), (2, 0)], [(None, 1), (3, None)]])
def test_without_labels_of_a_class(spark, make_docs, labels):
    docs, _ = corpus(50)
    frame = make_docs([*docs, (99, "you idiot")])
    model = tx.fit(frame, spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert {r.doc_id: r.predicted for r in tx.predict(frame, model).collect()}[99] == 1


def test_empty_tables(spark, make_docs):
    model = tx.fit(make_docs([]), spark.createDataFrame([], "doc_id long, toxic int"))
    assert tx.predict(make_docs([]), model).count() == 0


def test_label_model_recovers_accuracies_and_correlations():
    rng = np.random.default_rng(7)
    n, prior = 60_000, 0.2
    y = rng.random(n) < prior
    rates = np.array([(0.7, 0.05), (0.5, 0.02), (0.6, 0.1), (0.4, 0.05), (0.8, 0.2), (0.55, 0.03)])
    votes = rng.random((n, 6)) < np.where(y[:, None], rates[:, 0], rates[:, 1])
    votes = np.hstack([votes, votes[:, :1] ^ (rng.random((n, 1)) < 0.03)])  # a near copy of the first voter
    model = tx.fit_label_model(n, votes.sum(0), votes.T.astype(float) @ votes, prior)
    want = prior * rates[:, 0] + (1 - prior) * (1 - rates[:, 1])
    assert np.abs(model.accuracies[1:6] - want[1:]).max() < 0.05
    assert (0, 6) in model.correlated
    assert ((model.posterior(votes) > 0.5) == y).mean() > 0.95


def test_score_equals_a_plain_computation(spark, make_docs):
    docs, labels = corpus(400, seed=3)
    frame = make_docs([*docs, (900, None), (901, "IDIOT!! idiot, Krumble... krumble"), (902, "")])
    model = tx.fit(frame, spark.createDataFrame(labels[:300], "doc_id long, toxic int"))
    weight = dict(zip(model.features.tolist(), model.weights, strict=True))
    for r in tx.predict(frame, model).collect():
        names = set()
        for raw in (r.text or "").lower().split():
            word = raw.strip(tx.EDGE)
            names |= ({"w" + word} | ({"p" + word[:4]} if len(word) > 4 else set())) if word else set()
        z = model.bias + sum(weight.get(f, 0.0) for f in {zlib.crc32(n.encode()) for n in names})
        assert abs(r.score - 1 / (1 + np.exp(-z))) < 1e-9 and r.predicted == (r.score >= 0.5)


def test_posterior_equals_a_plain_computation():
    rng = np.random.default_rng(1)
    votes = rng.random((500, 5)) < 0.3
    model = tx.fit_label_model(500, votes.sum(0), votes.T.astype(float) @ votes, 0.2)
    for row, got in zip(votes, model.posterior(votes), strict=True):
        z = np.log(0.2 / 0.8) + sum(model.fires[i] if v else model.silent[i] for i, v in enumerate(row))
        assert abs(got - 1 / (1 + np.exp(-z))) < 1e-12


def test_few_labels_leave_a_seed_classifier(spark, make_docs):
    docs, _ = corpus(40, seed=5)
    docs = [(i, t.replace("idiot", "w1")) for i, t in docs]
    frame = make_docs([*docs, (900, "what an idiot you are, you moron and loser"), (901, "a clean text")])
    labels = spark.createDataFrame([(i, int(i % 5 == 1)) for i in range(40)], "doc_id long, toxic int")
    model = tx.fit(frame, labels)
    assert (model.labels.fires > 0).all()  # no voter is without a voice
    out = {r.doc_id: r.predicted for r in tx.predict(frame, model).collect()}
    assert out[900] == 1 and out[901] == 0


def test_patterns_vote():
    assert tx.patterns_of("You idiot! Such an IDIOT") == [True, False, True, True]
    assert tx.patterns_of("a clown and a loser met") == [False, True, False, True]
    assert tx.patterns_of("the idiot " + "word " * 40) == [False, False, False, False]
    assert tx.patterns_of(None) == tx.patterns_of("") == [False] * 4
