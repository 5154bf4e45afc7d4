import hashlib
import random

from hypothesis import given, settings
from hypothesis import strategies as st

from waybill.llm import sketch
from waybill.llm.sketch import Sketch, build, difference, digests_of, edited, fingerprints, likeness

NAMES = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def brute(rows):
    """Likeness from the digests themselves."""
    def alike(a, b):
        a, b = set(digests_of(a)), set(digests_of(b))
        return 1.0 if not a | b else len(a & b) / len(a | b)

    out = []
    for i, (name, text) in enumerate(rows):
        following = rows[(i + 1) % len(rows)][1] or ""
        text = text or ""
        keep = len(text) - len(text) // 4
        changed = text[:keep] + following[:len(text) // 4]
        out.append((name, len(text), hashlib.sha256(changed.encode()).hexdigest(), build(digests_of(text)).to_text(),
                    build(digests_of(changed)).to_text(), alike(text, changed), alike(text, following)))
    return out


def found(docs):
    return sorted(map(tuple, fingerprints(docs).select(*NAMES).collect()), key=str)


@settings(max_examples=60, deadline=None, derandomize=True)
@given(one=st.sets(st.integers(1, 2 ** 64 - 1), max_size=120), other=st.sets(st.integers(1, 2 ** 64 - 1), max_size=40),
       common=st.sets(st.integers(1, 2 ** 64 - 1), max_size=60))
def test_differences_are_recovered(one, other, common):
    a, b = one | common, other | common
    sketches = build(sorted(a)), build(sorted(b))
    more, less = difference(*sketches)
    assert (set(more), set(less)) == (a - b, b - a) and len(more) + len(less) == len(a ^ b)
    back = [Sketch.from_text(s.to_text()) for s in sketches]
    assert back == list(sketches)
    assert likeness(*back) == (1.0 if not a | b else len(a & b) / len(a | b))


def test_retry_with_more_cells(monkeypatch):
    """Too little room at first is made up for."""
    monkeypatch.setattr(sketch, "ROOM", 0.2)
    random.seed(4)
    a, b = ([random.getrandbits(63) for _ in range(90)] for _ in range(2))
    assert build(a).width * sketch.HASHES > 90
    assert set(difference(build(a), build(b))[0]) == set(a)


def test_documents_in_ranges(spark, documents, monkeypatch):
    monkeypatch.setattr(sketch, "RANGE_ROWS", 10)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(80).collect()]
    texts += [None, "", "a", "abc", "same\nsame\nsame", "x" * 300_000, "é" * 9]
    random.seed(1)
    ids = random.sample(range(-50, 10_000), len(texts))
    rows = list(zip(ids, texts))
    random.shuffle(rows)
    assert found(documents(rows)) == sorted(brute(sorted(rows)), key=str)


def test_edge_rows(documents, clashing):
    assert found(documents([])) == []
    assert found(documents([(7, "one\ntwo")])) == brute([(7, "one\ntwo")])
    docs = clashing(documents([(1, "same"), (1, "same"), (1, "same"), (None, "last")]), "range", "key", "packed")
    rows = found(docs)
    expected = brute([(1, "same"), (1, "same"), (1, "same"), (None, "last")])
    assert rows == sorted(expected, key=str)
    only = found(documents([(None, "a"), (None, "a")]))
    assert only == brute([(None, "a"), (None, "a")])


def test_equal_texts_have_equal_fingerprints():
    text = "one two three\n" * 50
    assert build(digests_of(text)).to_text() == build(digests_of(str(text))).to_text()
    assert build(digests_of(text)).to_text() != build(digests_of(text.upper())).to_text()


def test_an_edit_is_seen():
    random.seed(2)
    text, other = (" ".join(f"w{random.randrange(5000)}" for _ in range(600)) for _ in range(2))
    one = build(digests_of(text))
    assert 0.4 < likeness(one, build(digests_of(edited(text, other)))) < 0.8
    assert likeness(one, build(digests_of(other))) < 0.1


def test_long_texts_in_little_memory():
    import tracemalloc
    rng = random.Random(8)
    text = " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 9))) for _ in range(600_000))
    tracemalloc.start()
    one, other = (sketch.build(sketch.digests_of(part)) for part in (text, text[:-9] + "new end", ))
    assert tracemalloc.get_traced_memory()[1] < 150_000_000
    tracemalloc.stop()
    assert 0.999 < sketch.likeness(one, other) < 1


def test_repeated_and_missing_ids_in_ranges(documents, monkeypatch):
    """Rows of one id, or of none, fall into several ranges by their texts; equal rows stay together."""
    from pyspark.sql import functions as F
    monkeypatch.setattr(sketch, "RANGE_ROWS", 5)
    rng = random.Random(3)
    rows = [(rng.choice([None, 7, 7, 7, 8, -1]), f"text {rng.randrange(40)}\nof {rng.randrange(3)}") for _ in range(150)]
    rows += [(7, "the same")] * 12
    docs = documents(rows).withColumn("key", F.xxhash64("text"))
    ordered = [(row.doc_id, row.text) for row in docs.orderBy(F.col("doc_id").asc_nulls_last(), "key").collect()]
    ranges = sketch._borders(docs.select("doc_id", "key"))
    assert len(ranges) >= len(rows) // 5 - 12 and len({place[1] for place in ranges}) < len(ranges) / 4
    assert found(docs) == sorted(brute(ordered), key=str)
