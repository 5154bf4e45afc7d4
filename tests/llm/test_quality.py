import numpy as np
from pyspark.sql import functions as F

from waybill.llm import quality
from waybill.llm.quality import Network, learn, padded, rate, train


def together(texts):
    raw = [text.encode() for text in texts]
    return np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(one) for one in raw])])


def test_gradients():
    random = np.random.default_rng(1)
    texts = ["some words of a text that is longer than one chunk " * 6, "SHOUTED!! " * 9, "x"]
    labels = np.array([1.0, 0.0, 1.0])
    network = Network.fresh()
    network.parameters = [(p + random.normal(0, 0.01, p.shape)).astype(np.float64) for p in network.parameters]
    data, offsets = together(texts)

    def loss():
        logit = network._forward(*padded(data, offsets))["logit"]
        return np.mean(np.log1p(np.exp(logit)) - labels * logit)

    for parameter, slope in zip(network.parameters, network.gradients(data, offsets, labels)):
        place = np.unravel_index(np.abs(slope).argmax(), slope.shape)
        kept, step = parameter[place], 1e-6
        parameter[place] = kept + step
        above = loss()
        parameter[place] = kept - step
        below = loss()
        parameter[place] = kept
        assert np.isclose(slope[place], (above - below) / (2 * step), rtol=2e-3, atol=1e-6)


def test_a_score_depends_on_the_text_alone():
    """Whatever stands before and after it in a slice."""
    network = train([b"plain words " * 30, b"LOUD!! " * 40] * 8, np.array([1.0, 0.0] * 8, np.float32), epochs=2)
    texts = ["", "a", "plain words " * 30, "é" * 200, "ab ab ab ab " * 20, "plain words " * 30]
    alone = [network.probabilities(*together([text]))[0] for text in texts]
    assert np.allclose(network.probabilities(*together(texts)), alone, atol=1e-6)
    assert np.allclose(network.probabilities(*together(texts[::-1])), alone[::-1], atol=1e-6)


def test_long_texts_in_parts():
    """A text gets its score whatever part of it is looked at at a time, in little memory."""
    import tracemalloc
    random = np.random.default_rng(4)
    network = train([b"plain words " * 30, b"LOUD!! " * 40] * 8, np.array([1.0, 0.0] * 8, np.float32), epochs=20)
    for size in (1, 63, 64, 100, 1000, 5000):
        text = bytes(random.choice(list(b"ab cd LOUD!! xyxyxy\n"), size).astype(np.uint8))
        data, offsets = np.frombuffer(text, np.uint8), np.array([0, size])
        whole = network.probabilities(data, offsets, 1 << 20)[0]
        for part in (64, 128, 300, 999):
            assert np.isclose(network.probabilities(data, offsets, part)[0], whole, atol=1e-6), (size, part)
    data = np.frombuffer(b"plain words and more of them \n" * 600_000, np.uint8)
    tracemalloc.start()
    network.probabilities(data, np.array([0, len(data)]))
    assert tracemalloc.get_traced_memory()[1] < 200_000_000
    tracemalloc.stop()


def test_the_end_of_a_long_text_counts():
    network = train([b"plain words and more of them " * 30, b"LOUD!! NOISE!! " * 40] * 20,
                    np.array([1.0, 0.0] * 20, np.float32), epochs=60)
    long = "plain words and more of them " * 4000
    assert network.probabilities(*together([long]))[0] > 0.5 > network.probabilities(*together([long + "LOUD!! NOISE!! " * 40]))[0]


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    network = learn(docs, labels, fold != 0, rows=1200)
    held = rate(docs, network).join(labels, "doc_id").filter(fold == 0)
    right = held.select(F.avg(((F.col("score") >= 0.3).cast("int") == F.col("quality")).cast("int"))).first()[0]
    assert right > 0.96


def test_held_out_accuracy_of_a_small_table(spark):
    """The smaller the sample, the more often it is gone through."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    fold = F.crc32(F.col("doc_id").cast("string")) % 5
    held = rate(docs, learn(docs, labels, fold != 0)).join(labels, "doc_id").filter(fold == 0)
    wrong = held.filter((F.col("score") >= 0.3).cast("int") != F.col("quality")).count()
    assert wrong <= 1 and held.count() > 40


def test_edge_rows(spark, documents, clashing):
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, 0), (3, None), (None, 1), (4, 1), (9, 0)], "doc_id bigint, quality int")
    docs = documents([(1, "plain words"), (2, "LOUD!!"), (3, "x"), (4, None), (None, ""), (2, "LOUD!!")])
    network = learn(docs, labels, F.lit(True))
    found = rate(clashing(docs, "Score"), network, ("doc_id", "Score")).collect()
    assert len(found) == 6 and all(0 <= r["score_"] <= 1 and r["Score"] == "own Score" for r in found)
    assert len({r["score_"] for r in found if r.doc_id == 2}) == 1
    nothing = learn(docs, labels, F.lit(False))
    assert {r.score for r in rate(docs, nothing).collect()} == {0.5}
    assert rate(documents([]), network).count() == 0


def test_the_sample_is_bounded(documents, spark, monkeypatch):
    docs = documents([(i, "word " * 100) for i in range(50)])
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)], "doc_id bigint, quality int")
    seen = []
    monkeypatch.setattr(quality, "train", lambda texts, labels: seen.append(len(texts)))
    learn(docs, labels, F.lit(True), rows=20)
    learn(docs, labels, F.lit(True), rows=20, size=1700)
    assert seen == [20, 3]


def test_a_long_text_shuts_out_no_other(documents, spark, monkeypatch):
    """Whatever stands first in the order of the sample."""
    labels = spark.createDataFrame([(i, i % 2) for i in range(30)], "doc_id bigint, quality int")
    seen = []
    monkeypatch.setattr(quality, "train", lambda texts, labels: seen.append((texts, labels)))
    for long in (range(30), range(0, 30, 3)):
        docs = documents([(i, f"{i:04d}" + "word " * (40_000 if i in long else 20) + "the end") for i in range(30)])
        learn(docs, labels, F.lit(True), rows=30, size=600_000)
        texts, kinds = seen.pop()
        assert len(texts) == 30 and sum(map(len, texts)) <= 600_000
        assert {(int(text[:4]), int(kind)) for text, kind in zip(texts, kinds)} == {(i, i % 2) for i in range(30)}
        assert all(text.endswith(b"the end") and len(text) >= (quality.ROW_BYTES - quality.PIECE if i in long else 111)
                   for text in texts for i in [int(text[:4])])


def test_the_level_of_a_sample():
    row = quality.ROW_BYTES
    assert quality.level([], 9) == 0 and quality.level([5, 70], 100) == 70
    assert quality.level([row * 9, 10, row * 2], row * 6 + 10) == row * 4
    assert quality.level([1 << 40] + [10] * 2999, quality.SAMPLE_BYTES) == quality.SAMPLE_BYTES - 29990
    assert quality.level([1 << 40] * 3000, quality.SAMPLE_BYTES) == row
