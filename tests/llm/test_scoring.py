import math
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from waybill.llm import pitman_yor, scoring
from waybill.llm.codes import grouped
from waybill.llm.pitman_yor import Spelling, seat, spelling_codes
from waybill.llm.scoring import score


def tokens_of(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in lowered).split(" ") if w] + [None]


def base_scores(rows, learned):
    counts = Counter(t for i, text in rows if learned(i) for t in tokens_of(text))
    total, kinds = sum(counts.values()), len(counts)
    out = []
    for i, text in rows:
        own = tokens_of(text)
        out.append((i, len(own), sum(counts[t] > 0 for t in own), total,
                    sum(math.log10((counts[t] + 1) / (total + kinds + 1)) for t in own)))
    return sorted(out, key=str)


def test_base_over_many_packs_and_buckets(spark, documents, monkeypatch):
    monkeypatch.setattr(scoring, "PACK_BYTES", 20_000)
    monkeypatch.setattr(scoring, "BUCKET_BYTES", 30_000)
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(120).collect()]
    texts += [None, "", " \t", "The the THE", "É é", "x" * 6000, "end " * 40_000]
    rows = list(enumerate(texts)) + [(5, texts[5])]
    found = score(documents(rows), F.col("doc_id") % 7 != 2).collect()
    got = sorted(((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in found), key=str)
    expected = base_scores(rows, lambda i: i % 7 != 2)
    assert [g[:4] for g in got] == [e[:4] for e in expected]
    assert np.allclose([g[4] for g in got], [e[4] for e in expected], rtol=1e-10)
    held = [r for r in found if r.doc_id % 7 == 2]
    assert all(r.score < 0 and math.isclose(r.perplexity, 10 ** (-r.score / r.n_tokens), rel_tol=1e-9) for r in found)
    # The model says more of texts it has not seen than the base does.
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_probabilities_add_up(documents):
    """Over all words, the end and the unlearned word, in a context that was learned and in one that was not."""
    random.seed(1)
    words = ["alpha", "beta", "gamma", "delta", "a", "bb"]
    rows = [(i, " ".join(random.choices(words, [9, 5, 3, 2, 1, 1], k=30))) for i in range(40)]
    asked = [(1000 + 10 * k + j, " ".join([*first, word])) for k, first in enumerate([[], ["alpha"], ["zzz"]])
             for j, word in enumerate([*words, "unlearned"])]
    prefixes = [(2000 + k, " ".join(first)) for k, first in enumerate([[], ["alpha"], ["zzz"]])]
    empties = [(3000 + j, word) for j, word in enumerate([*words, "unlearned"])]
    found = {r.doc_id: r.score for r in score(documents(rows + asked + prefixes + empties), F.col("doc_id") < 1000).collect()}
    # log P(end | start) is known from the empty text; P(end | word) follows from P(word end) / P(word).
    start_end = 10 ** found[2000]
    singles = [10 ** found[3000 + j] for j in range(len(words) + 1)]  # P(word) * P(end | word)
    assert 0 < start_end + sum(singles) < 1
    model = Counter(w for _, t in rows for w in t.split(" "))
    assert found[3000] > found[3005] and model["alpha"] > model["bb"]
    # Chains of any length: all texts of at most one word have less than all the mass, those of two words fit in the rest.
    pairs = sum(10 ** found[1010 + j] for j in range(len(words) + 1))
    assert pairs < 1 - start_end - sum(singles) + 1e-6


def test_word_probabilities_of_a_bucket_are_proper():
    """Seating and predictions by the formulas: what the known words leave is what the unlearned word gets."""
    words = [b"alpha", b"beta", b"a", b""]
    spelled = np.frombuffer(b"".join(words), np.uint8)
    borders = np.concatenate([[0], np.cumsum([len(w) for w in words])])
    codes, places = spelling_codes(spelled, borders)
    order = np.argsort(codes, kind="stable")
    keys, counts, _ = grouped(codes[order], np.repeat([4, 3, 2, 6], np.diff(places))[order])
    spelling = Spelling(keys, counts, np.random.default_rng(1))
    base = np.exp(spelling.log_words(spelled, borders))
    customers = np.zeros(256, np.int64)
    tables = np.zeros(256, np.int64)
    context, c, t = np.array([0, 1, 1, 2]), np.array([5, 3, 4, 9]), np.array([2, 1, 2, 3])
    np.add.at(customers, context, c)
    np.add.at(tables, context, t)
    word_tables = np.array([1, 1, 2, 2])
    sweep = scoring.Sweep(2, spelling, customers, tables, int(t.sum()), int(word_tables.sum()), 0.4, 0.3)
    known = sweep.word_chances(t, word_tables, base)
    unknown = sweep.word_chances(0, 0, 1 - base.sum())
    assert math.isclose(known.sum() + unknown, 1, rel_tol=1e-12)
    for k in range(4):
        own = np.where(context == k, c - 0.4 * t, 0)
        weight = sweep.weights[k]
        total = ((own + weight * known).sum() + weight * unknown) / (pitman_yor.STRENGTH + customers[k])
        assert math.isclose(total, 1, rel_tol=1e-12)


def test_spelling_is_proper():
    spelled = np.frombuffer(b"thetheof", np.uint8)
    codes, _ = spelling_codes(spelled, np.array([0, 3, 6, 8]))
    keys, counts, _ = grouped(np.sort(codes), np.ones(len(codes), np.int64))
    model = Spelling(keys, counts, np.random.default_rng(1))
    for context in (int(keys[0]) >> 9, 12345):
        asked = (np.uint32(context) << np.uint32(9)) | np.arange(pitman_yor.SYMBOLS, dtype=np.uint32)
        assert math.isclose(model.predict(asked).sum(), 1, rel_tol=1e-12)
    for level, upper in zip(model.levels[1:], model.levels):
        assert level.tables.sum() == upper.customers.sum()


def test_seats():
    """Between one table and one per customer, near the mean of one by one seating."""
    random_ = np.random.default_rng(1)
    counts = np.array([1, 2, 50, 100_000])
    drawn = np.array([seat(counts, np.full(4, 2.0), 0.5, random_) for _ in range(300)])
    assert (drawn[:, 0] == 1).all() and (drawn >= 1).all() and (drawn <= counts).all()
    plain = []
    for _ in range(300):
        tables = 1
        for seated in range(1, 50):
            tables += random_.random() < 2 / (seated - 0.5 * tables + 2)
        plain.append(tables)
    assert abs(np.mean(plain) - drawn[:, 2].mean()) < 0.5


def test_edge_rows(documents):
    learn = F.col("doc_id") > 0
    assert score(documents([]), learn).count() == 0
    rows = score(documents([(-1, "one"), (None, ""), (0, None)]), learn).collect()
    assert {(r.doc_id, r.n_tokens, r.n_known, r.train_tokens, r.score) for r in rows} == {
        (-1, 2, 0, 0, 0.0), (None, 1, 0, 0, 0.0), (0, 1, 0, 0, 0.0)}
    only = score(documents([(1, None), (2, None), (-3, "new")]), learn).collect()
    assert {(r.doc_id, r.n_known, r.train_tokens) for r in only} == {(1, 1, 2), (2, 1, 2), (-3, 1, 2)}


def test_contexts_grow_with_the_corpus():
    assert [scoring.context_bits(size) for size in (0, 1 << 16, 1 << 24, 1 << 30, 1 << 40, 1 << 47)] == [8, 8, 12, 15, 20, 20]


def test_blocks_of_arrays():
    random = np.random.default_rng(3)
    hashes = np.sort(random.integers(0, 1 << 63, 500, dtype=np.uint64) * np.uint64(2) + np.uint64(1))
    others = random.integers(0, 1 << 30, 77).astype(np.uint32), random.random(9).astype(np.float32), np.zeros(0, np.uint8)
    found = scoring._spread(scoring._squeeze(scoring._steps(hashes), *others), "<u8", "<u4", "<f4", "u1")
    assert (scoring._from_steps(found[0]) == hashes).all()
    assert all((one == other).all() and len(one) == len(other) for one, other in zip(found[1:], others))
