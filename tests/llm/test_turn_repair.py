import hashlib
import random
import re
import zlib
from functools import cache

import pytest

from waybill.llm import turn_repair
from waybill.llm.queries import op11_turn_repair

SPACE = " \t\n\x0b\x0c\r"
SCHEMA = "conv_id bigint, turn bigint, role string, text string"


def text_of(value):
    return " " if value is None else value


def brute_damage(rows):
    made = []
    for conv, turn, role, text in rows:
        role, text = text_of(role), text_of(text)
        case = zlib.crc32(f"{text_of(conv)}:{text_of(turn)}".encode()) % 20
        if case == 0:
            continue
        text = "" if case == 1 else re.sub("[.!?]", "", text) if case == 2 else text
        made += [(conv, turn, "user" if case == 4 else role, text)] * (2 if case == 3 else 1)
    return made


def brute_cheapest(rows):
    """The least (cost, audit) of one conversation and its repaired rows, by trying all edits."""
    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.rstrip(SPACE)
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else
                      "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    following = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    names = {"u": "user", "a": "assistant"}

    @cache
    def best(i, state, inserted):
        ways = [(0, "", ())] if i == len(rows) and state in ("", "a") else []
        if inserted < 3:
            for role in "ua":
                if (state, role) in following:
                    cost, audit, out = best(i, role, inserted + 1)
                    ways.append((cost + 5, "I" + audit, ((names[role], ""), *out)))
        if i < len(rows):
            _, _, role, text = rows[i]
            cost, audit, out = best(i + 1, state, 0)
            ways.append((cost + 2, "D" + audit, out))
            if faults[i] not in ("blank", "duplicate"):
                extra = 5 * (faults[i] == "truncated")
                if (state, role[:1]) in following:
                    cost, audit, out = best(i + 1, following[state, role[:1]], 0)
                    ways.append((cost + extra, "K" + audit, ((role, text), *out)))
                for given in "ua":
                    if (state, given) in following:
                        cost, audit, out = best(i + 1, given, 0)
                        ways.append((cost + extra + 1, "R" + audit, ((names[given], text), *out)))
        return min(ways, default=(10 ** 9, "", ()))

    cost, audit, out = best(0, "", 0)
    assert re.fullmatch("(s?(ua)+)?", "".join(role[0] for role, _ in out))
    pairs = zip(rows, rows[1:])
    turns = {row[1] for row in rows if row[1] is not None}
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *[faults.count(name) for name in ("blank", "duplicate", "truncated")],
            sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in pairs), cost, audit,
            hashlib.sha256("\n".join(f"{role}:{text}" for role, text in out).encode()).hexdigest())


def said(row):
    return hashlib.sha256((hashlib.sha256(row[2].encode()).hexdigest() + row[3]).encode()).hexdigest()


def brute(rows, damage):
    made = damage(rows)
    found = {}
    for conv in {row[0] for row in rows}:
        own = [row for row in made if row[0] == conv]
        own.sort(key=lambda row: (row[1] is not None, row[1] or 0, said(row)))
        found[conv] = brute_cheapest(own)
    return found


NAMES = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def random_rows(conversations, most=9):
    draw = random.Random(11)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None, "us"]
    texts = ["Yes.", "No!", "Why?", "cut", "", " \t", None, "Yes. ", "Étè?\n"]
    rows = []
    for conv in [*range(conversations), None]:
        for turn in range(draw.randint(1, most)):
            rows.append((conv, None if draw.random() < 0.05 else turn + 2 * (draw.random() < 0.1),
                         draw.choice(roles), draw.choice(texts) if draw.random() < 0.4 else f"text {draw.random()}."))
    return rows + rows[::13]


def run(rows, spark, **sizes):
    repair = turn_repair.Repair(spark.createDataFrame(rows, SCHEMA), **sizes)
    digests = {row.conv_id: row.repaired_sha256 for row in turn_repair.text_digests(repair.rows()).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {row.conv_id: (*[row[name] for name in NAMES[:-1]], digests.get(row.conv_id, empty))
            for row in repair.summaries().collect()}


@pytest.mark.parametrize("segment_rows", [1, 2, 3, 8192])
def test_against_brute_force(spark, segment_rows):
    rows = random_rows(120)
    plain = [(conv, turn, text_of(role), text_of(text)) for conv, turn, role, text in rows]
    assert run(rows, spark, segment_rows=segment_rows) == brute(plain, lambda rows: rows)


def test_query_against_brute_force(spark, tmp_path):
    rows = random_rows(150) + [(1000 + i, i % 3, "user", "x") for i in range(60)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    found = {row.conv_id: tuple(row[name] for name in NAMES) for row in op11_turn_repair(spark, str(tmp_path)).collect()}
    want = brute(rows, brute_damage)
    assert found == want
    assert any(all(not part for part in one[:7]) for one in want.values())


def test_test_table(spark):
    rows = [tuple(row) for row in spark.read.parquet("/root/testdata/sf0.001/conversations.parquet").select(
        "conv_id", "turn", "role", "text").collect()]
    found = {row.conv_id: tuple(row[name] for name in NAMES) for row in op11_turn_repair(spark, "/root/testdata/sf0.001").collect()}
    assert found == brute(rows, brute_damage)


def plain_solution(codes):
    """Least cost and least audit by a table over all rows."""
    solver, after = turn_repair.Solver(), turn_repair.END
    vectors = [after]
    for code in reversed(codes):
        vectors.append(solver.back(code, vectors[-1])[0])
    vectors.reverse()
    state, edits = turn_repair.NOTHING, []
    for code, vector in zip(codes, vectors[1:]):
        edit, state = solver.walk(code, vector, state)
        edits.append(edit)
    return edits, state


def test_checkpoints_change_nothing():
    draw = random.Random(5)
    solver = turn_repair.Solver()
    for size in (*range(1, 40), 1000, 4096, 5000):
        codes = "".join(draw.choice("DsuaoSUAO") for _ in range(size))
        assert solver.edits(codes, turn_repair.END, turn_repair.NOTHING) == plain_solution(codes)
    assert len(solver._back) < 2000


def test_a_long_conversation_and_many_copies(spark):
    draw = random.Random(8)
    rows = [(1, i, draw.choice(["user", "assistant"]), f"line {i}." if i % 5 else "same.") for i in range(3000)]
    rows += [(1, 7, "user", "again.")] * 2000
    found = run(rows, spark, segment_rows=50)[1]
    ordered = sorted(rows, key=lambda row: (row[1], said(row)))
    seen, codes = set(), ""
    for _, _, role, text in ordered:
        codes += "D" if (role, text) in seen else role[0]
        seen.add((role, text))
    edits, state = plain_solution(codes)
    audit = ("".join(edits) + turn_repair.ending(state)).translate(turn_repair._INITIALS)
    assert found[6] == audit and found[2] == codes.count("D")
    cost = turn_repair.Solver().costs_before(codes, [1] * len(codes), turn_repair.END)[turn_repair.NOTHING]
    assert found[5] == cost


def test_long_text_and_edits(spark):
    long = "x. " * 400_000
    rows = [(1, 0, "system", "s."), (1, 1, "user", long), (1, 2, "user", long + "y."), (1, 3, "user", None)]
    made = turn_repair.Repair(spark.createDataFrame(rows, SCHEMA)).rows().orderBy("place", "step").collect()
    assert [(row.turn, row.role, len(row.text), row.edit) for row in made] == [
        (0, "system", 2, "keep"), (1, "user", len(long), "keep"), (2, "assistant", len(long) + 2, "rerole")]


def test_empty_and_clashing(spark, clashing):
    empty = turn_repair.Repair(spark.createDataFrame([], SCHEMA))
    assert empty.summaries().count() == 0 and empty.rows().count() == 0
    rows = clashing(spark.createDataFrame([(1, 0, "user", "a."), (1, 1, "assistant", "b.")], SCHEMA),
                    "place", "said", "copies", "edits", "_key", "_case", "_range")
    repair = turn_repair.Repair(turn_repair.damaged(rows))
    assert repair.rows().count() == 2 and repair.summaries().first().audit == "KK"
