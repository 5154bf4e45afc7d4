import hashlib
import math
from collections import Counter

from waybill.llm import mixing
from waybill.llm.mixing import rates, replicate


def brute_copies(name, rate, seed):
    """The inverse of the distribution function at a hash, part by part."""
    parts, total = max(math.ceil(rate / mixing.PART_RATE), 1), 0
    for part in range(1, parts + 1):
        chance = (int(hashlib.md5(f"{seed}|{name}|{part}".encode()).hexdigest()[:12], 16) + 0.5) / 2 ** 48
        events, term = 0, math.exp(-rate / parts)
        reached = term
        while reached < chance:
            events += 1
            term *= rate / parts / events
            reached += term
        total += events
    return total


def rows_of(sizes):
    rows, number = [], 0
    for source, size in sizes.items():
        for _ in range(size):
            rows.append((number, f"text {number}", "en", source))
            number += 1
    return rows


def test_against_brute_force(documents):
    sizes = {"a": 300, "b": 40, None: 9, "": 3}
    rows = rows_of(sizes)
    found = Counter(r.doc_id for r in replicate(documents(rows), seed=5).collect())
    weight = {source: math.sqrt(size) for source, size in sizes.items()}
    for number, _, _, source in rows:
        rate = sum(sizes.values()) * weight[source] / (sum(weight.values()) * sizes[source])
        assert found[number] == brute_copies(number, rate, 5), (number, source)


def test_targets_and_copies(documents):
    """Sources come close to their weights, copies are numbered, and the order does not depend on the input's."""
    docs = documents(rows_of({"a": 3000, "b": 300, "c": 30}))
    found = replicate(docs, {"a": 1, "c": 1}, epochs=2.0).collect()
    by_source = Counter(r.source for r in found)
    assert set(by_source) == {"a", "c"}
    assert all(abs(n - 3330) < 4 * math.sqrt(3330) for n in by_source.values())
    copies = {}
    for row in found:
        copies.setdefault(row.doc_id, []).append(row.copy)
    assert all(sorted(numbers) == list(range(len(numbers))) for numbers in copies.values())
    again = replicate(docs.repartition(7), {"a": 1, "c": 1}, epochs=2.0).collect()
    assert sorted(found) == sorted(again)
    # Shuffled: neighbours rarely come from neighbouring documents.
    assert sum(abs(a.doc_id - b.doc_id) < 2 for a, b in zip(found, found[1:])) < len(found) / 10


def test_large_rates(documents):
    """One document that stands for half of the output, in parts of the distribution."""
    docs = documents(rows_of({"a": 2000, "b": 1}))
    row = {r.source: r.rate for r in rates(docs, {"a": 1, "b": 1}).collect()}
    assert row["b"] == 1000.5
    found = replicate(docs, {"a": 1, "b": 1}).filter("source = 'b'").count()
    assert abs(found - 1000.5) < 4 * math.sqrt(1000.5)


def test_edge_rows(documents, clashing):
    assert replicate(documents([])).count() == 0
    assert replicate(documents(rows_of({"a": 3})), {"b": 1.0}).count() == 0
    docs = clashing(documents([(None, None), (1, ""), (1, ""), (1, "x" * 100_000)]), "Copy", "_source", "_order", "a b")
    found = replicate(docs, epochs=6.0)
    assert found.columns == [*docs.columns, "copy_"]
    rows = found.collect()
    # Rows with the same id draw the same number.
    assert len({sum(r.text == text for r in rows) / times for text, times in (("", 2), ("x" * 100_000, 1))}) == 1
    assert all(r["Copy"] == "own Copy" and r["a b"] == "own a b" for r in rows)
