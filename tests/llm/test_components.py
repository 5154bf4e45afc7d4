import random

from waybill.llm.components import connected
from waybill.llm.scratch import Scratch


def test_connected(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(200, 200), (7, 7)]
    edges += [(rng.randrange(300, 360), rng.randrange(300, 360)) for _ in range(40)]
    label = {n: n for e in edges if e[0] != e[1] for n in e}
    for a, b in edges * 60:
        if a != b:
            label[a] = label[b] = min(label[a], label[b])
    rng.shuffle(edges)
    found = connected(spark.createDataFrame(edges, "a bigint, b bigint"), Scratch(spark, "test")).collect()
    assert {r.node: r.label for r in found} == label and len(found) == len(label)


def test_no_links(spark):
    assert connected(spark.createDataFrame([], "a binary, b binary"), Scratch(spark, "test")).count() == 0
