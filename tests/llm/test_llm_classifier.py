import zlib

import numpy as np
import pytest
from llm_fixtures import prose, rows, table

from tripfold.llm import quality_cnn as q


@pytest.fixture(scope="module")
def net():
    good = [prose(i, 120).encode() for i in range(150)]
    bad = [prose(500 + i, 120).replace(" ", "### ").encode() for i in range(75)] + [b"same word " * (20 + i) for i in range(75)]
    return q.train(good + bad, np.array([1] * 150 + [0] * 150))


def test_held_out_accuracy(net):
    good = [prose(2000 + i, 90).encode() for i in range(60)]
    middle = [prose(3000 + i, 90) + prose(i, 200).replace(" ", "### ") + prose(4000 + i, 90) for i in range(20)]  # junk in the middle
    bad = [prose(5000 + i, 90).replace(" ", "### ").encode() for i in range(40)] + [m.encode() for m in middle]
    tables = net.pair_tables()
    assert (q.score_texts(net, tables, good) >= q.THRESHOLD).mean() > 0.95
    assert (q.score_texts(net, tables, bad) < q.THRESHOLD).mean() > 0.95


def test_scores_do_not_depend_on_the_batch(net, monkeypatch):
    texts = [b"", b"x", prose(1, 40).encode(), prose(2, 9000).encode(), b"y" * q.HALF, b"z" * q.CHUNK]
    tables = net.pair_tables()
    together = q.score_texts(net, tables, texts)
    monkeypatch.setattr(q, "SCORED_BYTES", 4 * q.HALF)
    alone = [q.score_texts(net, tables, [t])[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-6) and ((together >= 0) & (together <= 1)).all()


def test_convolution_covers_the_whole_text(net):
    """Against sums over single bytes, chunk by chunk."""
    text = prose(9, 300).encode()
    data = np.frombuffer(text.ljust(q.padded_size(len(text)), b"\0") + bytes(q.WIDTH), np.uint8)
    pooled = []
    for begin in range(0, len(data) - q.WIDTH - q.HALF, q.HALF):
        places = range(begin, begin + q.CHUNK)
        conv = [sum(net.filters[k][data[p + k]] for k in range(q.WIDTH)) for p in places if p < len(data) - 2 * q.WIDTH + 1]
        pooled.append(np.maximum(np.max(conv, axis=0) + net.bias, 0))
    pooled = np.array(pooled)
    x = np.concatenate([pooled.mean(axis=0), pooled.max(axis=0), pooled.min(axis=0)])
    assert np.allclose(q.score_texts(net, net.pair_tables(), [text])[0], q.logistic(x @ net.weights + net.offset), atol=1e-5)


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(5)
    net = q.Network(rng.normal(0, 0.3, (q.WIDTH, 256, q.FILTERS)), rng.normal(0, 0.1, q.FILTERS), rng.normal(0, 0.5, 3 * q.FILTERS), 0.1)
    texts, wanted, weights = [prose(i, 20 + 150 * i).encode() for i in range(4)], np.array([1, 0, 1, 0]), np.array([1.0, 2.0, 0.5, 1.0])

    def loss():
        data, counts = q.lay_out(texts)
        pooled, chunks = q.pool_chunks(q.best_places(net.filters, data, counts)[0].astype(float), counts, net.bias)
        p = q.logistic(q.features(pooled, chunks) @ net.weights + net.offset)
        return float(-(weights * np.where(wanted == 1, np.log(p), np.log(1 - p))).mean())

    by_filters, by_bias, by_weights, by_offset = q.gradients(net, texts, wanted, weights)
    step = 1e-3
    for values, found in ((net.filters, by_filters), (net.bias, by_bias), (net.weights, by_weights)):
        for at in [np.unravel_index(i, found.shape) for i in np.argsort(-np.abs(found).ravel())[:6]]:
            was = values[at]
            values[at] = was + step
            up = loss()
            values[at] = was - step
            down = loss()
            values[at] = was
            assert abs((up - down) / (2 * step) - found[at]) < 0.03 * abs(found[at]) + 1e-5
    net.offset += step
    up = loss()
    net.offset -= 2 * step
    assert abs((up - loss()) / (2 * step) - by_offset[0]) < 1e-3


def test_documents(spark, net):
    docs = table(spark)
    found = q.score_documents(docs, net).collect()
    assert len(found) == len(rows())
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert r.predicted == int(r.score >= 0.7)
    kept = q.keep_good(docs, net)
    assert kept.schema == docs.schema and kept.count() == sum(r.predicted for r in found)
    clash = docs.withColumnsRenamed({"node": "scored text", "key": "text ___________"})
    assert q.keep_good(clash, net).schema == clash.schema and q.keep_good(clash, net).count() == kept.count()
    assert {r.score for r in q.score_documents(docs, None).collect()} == {0.5}
    assert q.score_documents(docs.limit(0), net).count() == 0


def test_sample(spark):
    data = [(i, prose(i, 60) if i % 3 else "### " * 50, None, None, 0, "", "", 0) for i in range(200)]
    docs = table(spark, [*data, data[0], (None, "x", None, None, 0, "", "", 0)])
    labels = [(i, int(i % 3 > 0), 0) for i in range(200)] + [(None, 1, 0), (5, None, 0), (9999, 1, 0), (0, 0, 0)]
    labels = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    texts, y = q.training_sample(docs, labels)
    expected = sorted(i for i in range(200) if zlib.crc32(str(i).encode()) % 4 != 2)
    assert len(texts) == len(expected) and y.sum() == sum(i % 3 > 0 for i in expected)
    assert q.learn(docs, labels.limit(0)) is None and q.learn(docs, labels.where("quality = 1")) is None
