"""The convolutional scorer: gradients of the pooled net, held-out accuracy, and odd rows."""

import random
import zlib

import numpy as np

from tablecraft.llm.convnet import ConvNet, word_ids
from tablecraft.llm.toxicity import drop_toxic, score_texts, training_rows

SCHEMA = "doc_id long, text string, lang string, score double"
RUDE = {"en": ["idiot", "moron", "scum"], "de": ["loweiheit", "loweikeit", "loweiung"]}
PLAIN = {"en": "the of and to river house in is that old road".split(), "de": "der die das und haus nicht mit den alte weg".split()}


def corpus(n=900, seed=2):
    pick, rows, labels = random.Random(seed), [], []
    for i in range(n):
        lang = pick.choice(["en", "de"])
        words = [pick.choice(PLAIN[lang]) + pick.choice(["", "", "", "a", "o", "u"]) for _ in range(pick.randint(5, 60))]
        toxic = int(pick.random() < 0.3)
        for _ in range(pick.randint(2, 4) * toxic):
            words[pick.randrange(len(words))] = pick.choice(RUDE[lang]) + pick.choice(["", ".", "###", "!"])
        rows.append((i, " ".join(words), "xx", 0.1))
        labels.append((i, toxic, None))
    return rows, labels


def test_held_out_accuracy_and_rows(spark):
    rows, labels = corpus()
    odd = [(5000, None, "xx", None), (5001, "", None, 0.5), (5002, "idiot " * 30_000, "xx", 0.0), (None, "the river moron", None, None), rows[3], rows[3]]
    docs = spark.createDataFrame(rows + odd, SCHEMA)
    marks = spark.createDataFrame(labels + [(None, 1, None), (7, None, None), (9999, 1, "x")], "doc_id long, toxic int, text string")
    got = score_texts(docs, marks).collect()
    assert len(got) == len(rows) + len(odd) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    truth = dict((i, t) for i, t, _ in labels)
    fresh = [r for r in got if r.held_out and r.doc_id in truth]
    assert sum(r.predicted == truth[r.doc_id] for r in fresh) >= 0.95 * len(fresh)
    by = {r.doc_id: r.score for r in got}
    assert by[5002] >= 0.5 and by[5000] == by[5001] < 0.5
    kept = drop_toxic(docs, marks)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted == 0 for r in got)


def test_sample_is_bounded_and_leaves_the_held_out_fold_alone(spark):
    rows, labels = corpus(200)
    docs, marks = spark.createDataFrame(rows, SCHEMA), spark.createDataFrame(labels, "doc_id long, toxic int, text string")
    taken = training_rows(docs, marks, "doc_id", "text", "toxic", rows=50).toPandas()
    allowed = {word_ids(t.encode(), 1 << 14).tobytes() for i, t, *_ in rows if zlib.crc32(str(i).encode()) % 5}
    assert len(taken) == 50 and {bytes(x) for x in taken["ids"]} <= allowed


def test_without_labels_or_with_one_class(spark):
    docs = spark.createDataFrame([(1, "a b", "x", 0.0), (2, None, "x", 0.0)], SCHEMA)
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert [r.score for r in score_texts(docs, none).collect()] == [0.0, 0.0]
    one = spark.createDataFrame([(1, 1), (2, 1), (3, 1), (4, 1)], "doc_id long, toxic int")
    assert {r.score for r in score_texts(docs, one).collect()} == {1.0}
    assert score_texts(docs.limit(0), none).count() == 0


def test_looked_up_scores_equal_the_net():
    rows, labels = corpus(60)
    ids = [word_ids(t.encode(), 1 << 14) for _, t, *_ in rows] + [word_ids(b"", 1 << 14)]
    net = ConvNet().fit(ids[:60], np.array([t for _, t, _ in labels]), epochs=2)
    quick, _ = net.frozen().logits(ids)
    slow = []
    for i in ids:
        top, _ = net._pooled(np.concatenate([i, np.full((3, 2), net.buckets)]).astype(np.int64))
        slow.append(float((top * net.out).sum() + net.base))
    assert np.allclose(quick, slow, atol=1e-4)
