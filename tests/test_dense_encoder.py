import random

import numpy as np
import pytest

from attriflux.operators import retrieval as re_
from attriflux.operators.dense_encoder import DenseEncoder, words_of


def matrix_of(encoder, texts):
    """The weighted matrix of documents and words, by the plain definition."""
    place = {w: i for i, w in enumerate(encoder.words)}
    x = np.zeros((len(texts), len(place)))
    for row, text in enumerate(texts):
        for word in text.split():
            x[row, place[word]] += 1
    x = np.where(x > 0, 1 + np.log(np.maximum(x, 1)), 0) * encoder.weights
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-300)


@pytest.fixture(scope="module")
def corpus():
    """Topics, each with ways of saying the same in other words: every document uses one of two wordings of its topic."""
    draws = random.Random(11)
    topics = [([f"t{t}a{i}" for i in range(6)], [f"t{t}b{i}" for i in range(6)], [f"t{t}c{i}" for i in range(6)]) for t in range(30)]
    texts, topic_of = [], []
    for n in range(1500):
        t = n % 30
        first, second, shared = topics[t]
        wording = first if n // 30 % 2 else second
        texts.append(" ".join(draws.choices(wording, k=6) + draws.choices(shared, k=5) + [f"noise{draws.randrange(200)}" for _ in range(6)]))
        topic_of.append(t)
    # questions use one wording only, without the words that both share
    questions = [(t, " ".join(draws.choices(topics[t][0], k=5))) for t in range(30)]
    return texts, topic_of, questions


def test_decomposition_against_all_of_it(spark, corpus):
    texts, _, _ = corpus
    df = spark.createDataFrame([(t,) for t in texts], "text string").repartition(6)
    encoder = DenseEncoder.fit(df, dimensions=40)
    x = matrix_of(encoder, texts)
    _, s, right = np.linalg.svd(x, full_matrices=False)
    assert np.allclose(encoder.values[:30], s[:30], rtol=0.01) and np.allclose(encoder.vectors.T @ encoder.vectors, np.eye(40), atol=1e-9)
    best = np.linalg.norm(x - x @ right[:40].T @ right[:40])
    mine = np.linalg.norm(x - x @ encoder.vectors @ encoder.vectors.T)
    assert mine < 1.01 * best
    again = DenseEncoder.fit(df.repartition(3), dimensions=40)
    assert again.words == encoder.words and np.allclose(again.values, encoder.values)


def test_other_words_for_the_same_are_found(spark, corpus):
    """Documents that share no word with the question, by their topic: dense vectors against hashed words."""
    texts, topic_of, questions = corpus
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    asked = spark.createDataFrame(questions, "query_id int, question string")
    dense, hashed = DenseEncoder.fit(docs, dimensions=40), re_.TextEncoder.fit(docs)
    share = {}
    for name, encoder in (("dense", dense), ("hashed", hashed)):
        hits = re_.query_topk(encoder.embed(docs), encoder.embed(asked, "question"), 50).collect()
        other = [topic_of[r.doc_id] == r.query_id and r.doc_id // 30 % 2 == 0 for r in hits]
        share[name] = sum(other) / (30 * 25)         # 25 documents of each topic use the other wording
    assert share["dense"] > 0.9 and share["hashed"] < 0.5


def test_save_and_edges(spark, tmp_path):
    docs = spark.createDataFrame([("red blue", 1), ("blue green green", 2), (None, 3), ("", 4), ("?!", 5)], "text string, id int")
    encoder = DenseEncoder.fit(docs, dimensions=8)
    encoder.save(spark, str(tmp_path))
    loaded = DenseEncoder.load(spark, str(tmp_path))
    one, two = ({r.id: r.vec for r in e.embed(docs).collect()} for e in (encoder, loaded))
    assert one == two and all(len(v) == 8 for v in one.values())
    assert [np.linalg.norm(one[i]) for i in (1, 2)] == pytest.approx([1, 1]) and all(not np.any(one[i]) for i in (3, 4, 5))
    empty = DenseEncoder.fit(docs.limit(0), dimensions=8)
    assert empty.words == () and empty.embed(docs).filter("size(vec) = 8").count() == 5
    assert docs.select(words_of(docs.text).alias("w")).first().w == ["red", "blue"]


def test_one_pass_is_the_plain_product_and_quick(spark):
    """X'(X B) of a pass equals the plain product, and a pass over many documents of a full vocabulary takes seconds."""
    import time

    from attriflux.operators.dense_encoder import _counted, _multiplied

    draws = np.random.default_rng(3)
    vocabulary = tuple(f"w{i}" for i in range(4096))
    texts = [[vocabulary[j] for j in draws.integers(0, 4096, 60)] for _ in range(40000)]
    weights = draws.uniform(1, 5, 4096)
    encoder = DenseEncoder(vocabulary, weights, np.zeros((4096, 1)), np.zeros(0))
    staged = spark.createDataFrame([(t,) for t in texts], "words array<string>").repartition(8).cache()
    rows = _counted(staged, vocabulary).cache()
    rows.count()
    block = draws.standard_normal((4096, 400))
    began = time.perf_counter()
    got = _multiplied(rows, weights, block)
    took = time.perf_counter() - began
    x = matrix_of(encoder, [" ".join(t) for t in texts])
    assert np.allclose(got, x.T @ (x @ block), rtol=1e-9, atol=1e-9)
    assert took < 8.0, took


def test_memory_of_a_batch_does_not_grow_with_its_words():
    """10,000 texts of 40 words in 384 dimensions once took 1.2 GB for a copy of every word's vector."""
    import tracemalloc

    import pyarrow as pa

    from attriflux.operators.dense_encoder import _encoded
    draws = np.random.default_rng(5)
    words = [f"w{i}" for i in range(4096)]
    vectors = draws.standard_normal((len(words), 384))
    said = draws.integers(0, len(words) + 10, (10_000, 40))                 # the last ten are not known
    texts = pa.array([[f"w{i}" for i in row] for row in said.tolist()])
    tracemalloc.start()
    got = _encoded(texts, pa.array(words), vectors)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200e6
    for i in (0, 255, 256, 9_999):
        known, times = np.unique(said[i][said[i] < len(words)], return_counts=True)
        one = (vectors[known] * (1 + np.log(times))[:, None]).sum(axis=0)
        assert np.allclose(got[i], one / np.linalg.norm(one))
