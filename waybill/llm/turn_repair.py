"""Cheapest repairs of the turn structure of conversations.

A repaired conversation is empty, or an optional system turn and then user and
assistant turns in pairs. Each row is kept (0), given another role (1) or
deleted (2); turns without text are inserted anywhere (5); a row that is kept or
given a role although its text is cut off costs 5 more. Blank rows and rows
whose role and text were there before must be deleted.

What has been emitted so far is one of four states (nothing, a system turn, a
user turn, an assistant turn), so the costs of the rest from a row on are a
vector of four. The least costs are worked out from the last row backwards.
Vectors are stored at checkpoints only, one per square root of the rows; walking
forward, the vectors of one block at a time are made again from the checkpoint
after it, and the edit with the least letter is taken among those that cost no
more than the vectors say (D, I, K, R; a state allows one edit per letter).

Conversations may have any number of rows. All rows are put into one order and
cut into segments of bounded size. A segment's work is a table of least costs
between the states before and after it, so one number per pair of states tells
later rows' costs through it: a pass backwards over the segments of a
conversation gives each its vector, all segments are then walked side by side
from every state they may start in, and a pass forwards picks the real ones. Equal
rows are counted first; all but one of them are deleted anyway.

Only digests of texts take part until the edits are known.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from math import isqrt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from waybill.llm.scratch import Scratch
from waybill.llm.tasks import over_batches
from waybill.operators.ordering import in_order

DELETE, INSERT, REROLE, CUT_OFF = 2, 5, 1, 5
SPACES = " \t\n\x0b\x0c\r"
SEGMENT_ROWS = 8192

# States: what was emitted last. The pattern allows one inserted or given role in each.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
STATES = range(4)
_KEEP = {(NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
_NEXT = (USER, USER, ASSISTANT, USER)
_ROLE = "uuau"
_DONE = (NOTHING, ASSISTANT)
_NEVER = 1 << 60
_LEGAL = {"su", "ua", "au"}
_MOST = (1 << 63) - 1

Vector = tuple[int, ...]


def _closed(costs: list[int]) -> list[int]:
    """Least costs if turns may be inserted first."""
    for _ in range(3):
        costs = [min(cost, INSERT + costs[_NEXT[state]]) for state, cost in enumerate(costs)]
    return costs


def _normal(costs: list[int]) -> tuple[Vector, int]:
    least = min(costs)
    return tuple(_NEVER if cost >= _NEVER // 2 else cost - least for cost in costs), least


END, _ = _normal(_closed([0, _NEVER, _NEVER, 0]))


class Solver:
    """Steps over rows, remembered: normal vectors are few. A row is its code: 'D' if it must be deleted, else the
    initial of its role, in upper case if its text is cut off."""

    def __init__(self) -> None:
        self._back: dict[tuple[str, Vector], tuple[Vector, int]] = {}
        self._walk: dict[tuple[str, Vector, int], tuple[str, int]] = {}

    def back(self, code: str, after: Vector) -> tuple[Vector, int]:
        """The normal vector before a row, and what to add to it."""
        found = self._back.get((code, after))
        if found is None:
            found = self._back[code, after] = _normal(self._costs(code, after))
        return found

    def _costs(self, code: str, after: Vector) -> list[int]:
        if code == "D":
            return [DELETE + cost for cost in after]
        extra = CUT_OFF * code.isupper()
        costs = []
        for state in STATES:
            ways = [DELETE + after[state], REROLE + extra + after[_NEXT[state]]]
            kept = _KEEP.get((state, code.lower()))
            if kept is not None:
                ways.append(extra + after[kept])
            costs.append(min(ways))
        return _closed(costs)

    def walk(self, code: str, after: Vector, state: int) -> tuple[str, int]:
        """The edits at a row from a state: 'u' and 'a' insert a turn, 'U' and 'A' give the row a role."""
        found = self._walk.get((code, after, state))
        if found is None:
            found = self._walk[code, after, state] = self._edits(code, after, state)
        return found

    def _edits(self, code: str, after: Vector, state: int) -> tuple[str, int]:
        costs, edits = self._costs(code, after), ""
        extra = CUT_OFF * code.isupper()
        while True:
            to = _NEXT[state]
            if costs[state] == DELETE + after[state]:
                return edits + "D", state
            if costs[state] == INSERT + costs[to]:
                edits, state = edits + _ROLE[state], to
                continue
            kept = _KEEP.get((state, code.lower()))
            if kept is not None and costs[state] == extra + after[kept]:
                return edits + "K", kept
            return edits + _ROLE[state].upper(), to

    def costs_before(self, codes: str, copies: list[int], after: Vector) -> list[int]:
        """The vector before rows, of which all copies but one are deleted."""
        vector, total = _normal(list(after))
        for code, count in zip(reversed(codes), reversed(copies)):
            vector, more = self.back(code, vector)
            total += more + DELETE * (count - 1)
        return [cost if cost >= _NEVER // 2 else cost + total for cost in vector]

    def table(self, codes: str, copies: list[int]) -> list[int]:
        """Least costs by the state after the rows and the state before them."""
        return [cost for state in STATES for cost in self.costs_before(
            codes, copies, tuple(_closed([0 if one == state else _NEVER for one in STATES])))]

    def edits(self, codes: str, after: Vector, state: int) -> tuple[list[str], int]:
        """The edits at each row, and the state after them."""
        block = isqrt(max(len(codes) - 1, 0)) + 1
        vector, checkpoints = _normal(list(after))[0], {}
        for i in range(len(codes) - 1, -1, -1):
            if (i + 1) % block == 0 or i + 1 == len(codes):
                checkpoints[i // block] = vector
            vector, _ = self.back(codes[i], vector)
        made = []
        for low in range(0, len(codes), block):
            part = codes[low:low + block]
            vectors = [checkpoints[low // block]]
            for code in reversed(part[1:]):
                vectors.append(self.back(code, vectors[-1])[0])
            for code, vector in zip(part, reversed(vectors)):
                edit, state = self.walk(code, vector, state)
                made.append(edit)
        return made, state


def ending(state: int) -> str:
    """What is inserted after the last row."""
    made = ""
    while state not in _DONE:
        made, state = made + _ROLE[state], _NEXT[state]
    return made


def audit_text(edits: list[str], copies: list[int]) -> str:
    """The initials of edits, in order."""
    return "".join(edit + "D" * (count - 1) for edit, count in zip(edits, copies)).translate(_INITIALS)


_INITIALS = str.maketrans("uaUA", "IIRR")


def _records(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        yield from batch.to_pylist()


def _groups(records: Iterator[dict], key) -> Iterator[list[dict]]:
    held: list[dict] = []
    for record in records:
        if held and key(record) != key(held[-1]):
            yield held
            held = []
        held.append(record)
    if held:
        yield held


def _in_batches(rows: Iterator[dict], schema: pa.Schema, size: int = 2000) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) == size:
            yield pa.RecordBatch.from_pylist(held, schema)
            held = []
    if held:
        yield pa.RecordBatch.from_pylist(held, schema)


def _code(row: dict) -> str:
    if row["blank"] or not row["fresh"]:
        return "D"
    initial = row["initial"] if row["initial"] in ("s", "u", "a") else "o"
    return initial.upper() if row["cut_off"] else initial


def _segment(solver: Solver, rows: list[dict]) -> dict:
    codes, copies = "".join(map(_code, rows)), [row["copies"] for row in rows]
    turns = [row["turn"] for row in rows if row["turn"] is not None]
    pairs = zip(rows, rows[1:])
    return {
        "conv_id": rows[0]["conv_id"], "place": rows[0]["place"], "codes": codes, "copies": copies,
        "table": solver.table(codes, copies),
        "blank": sum(row["copies"] for row in rows if row["blank"]),
        "duplicate": sum(row["copies"] - row["fresh"] for row in rows if not row["blank"]),
        "truncated": sum(row["cut_off"] and row["fresh"] and not row["blank"] for row in rows),
        "illegal": sum(copies) - len(rows) + sum(a["initial"] + b["initial"] not in _LEGAL for a, b in pairs),
        "first": rows[0]["initial"], "last": rows[-1]["initial"],
        "low": turns[0] if turns else None, "high": turns[-1] if turns else None,
        "turns": len(turns) and 1 + sum(a != b for a, b in zip(turns, turns[1:])),
    }


def _backwards(segments: Iterator[dict]) -> Iterator[dict]:
    """From segments by conversation, the last first: the vector after each, which is the first, and its costs."""
    held, after, before = None, END, END
    for segment in segments:
        if held is not None:
            another = held["conv_id"] != segment["conv_id"]
            yield {**held, "opening": another, "before": before}
            after = END if another else before
        else:
            after = END
        table = segment["table"]
        before = tuple(min(min(table[4 * to + state] + after[to] for to in STATES), _NEVER) for state in STATES)
        held = {"conv_id": segment["conv_id"], "place": segment["place"], "after": after}
    if held is not None:
        yield {**held, "opening": True, "before": before}


def _walked(solver: Solver, segment: dict) -> dict:
    """A segment with its edits and the state after it, from each state it may start in."""
    after = tuple(segment["after"])
    ways = {state: solver.edits(segment["codes"], after, state)
            for state in ([NOTHING] if segment["opening"] else STATES)}
    return {**segment, "edits": [ways[state][0] if state in ways else None for state in STATES],
            "exits": [ways[state][1] if state in ways else None for state in STATES]}


def _forwards(segments: Iterator[dict]) -> Iterator[dict]:
    """From walked segments in order: their real edits, and with the last one of a conversation all that is to tell."""
    for conversation in _conversations(segments):
        state, audit, told, high = NOTHING, [], {}, None
        for segment, is_last in conversation:
            if segment["opening"]:
                told = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "turns": 0, "low": None,
                        "cost": segment["before"][NOTHING]}
            else:
                told["illegal"] += last + segment["first"] not in _LEGAL
            last = segment["last"]
            for name in ("blank", "duplicate", "truncated", "illegal"):
                told[name] += segment[name]
            if segment["low"] is not None:
                told["turns"] += segment["turns"] - (high == segment["low"])
                told["low"] = segment["low"] if told["low"] is None else told["low"]
                high = segment["high"]
            edits, state = segment["edits"][state], segment["exits"][state]
            audit.append(audit_text(edits, segment["copies"]))
            made = {"conv_id": segment["conv_id"], "place": segment["place"], "edits": edits, "last": is_last}
            if is_last:
                tail = ending(state)
                made["edits"] = [*edits[:-1], edits[-1] + tail]
                audit.append(tail.translate(_INITIALS))
                gaps = 0 if high is None else high - told["low"] + 1 - told["turns"]
                made |= {**{name: told[name] for name in ("blank", "duplicate", "truncated", "illegal", "cost")},
                         "gaps": min(gaps, _MOST), "audit": "".join(audit)}
            yield made


def _conversations(segments: Iterator[dict]) -> Iterator[Iterator[tuple[dict, bool]]]:
    """Segments of one conversation after the other, one at a time, and whether each is the last."""
    ahead = next(segments, None)

    def one() -> Iterator[tuple[dict, bool]]:
        nonlocal ahead
        while ahead is not None:
            segment, ahead = ahead, next(segments, None)
            is_last = ahead is None or ahead["opening"]
            yield segment, is_last
            if is_last:
                return

    while ahead is not None:
        yield one()


SEGMENT = ("place bigint, codes string, copies array<bigint>, table array<bigint>, blank bigint, duplicate bigint,"
           " truncated bigint, illegal bigint, first string, last string, low bigint, high bigint, turns bigint")
BACKWARDS = "place bigint, after array<bigint>, opening boolean, before array<bigint>"
FORWARDS = ("place bigint, edits array<string>, last boolean, gaps bigint, blank bigint, duplicate bigint,"
            " truncated bigint, illegal bigint, cost bigint, audit string")


def _prepared(conversations: DataFrame) -> DataFrame:
    """The four columns without nulls in role and text, with a digest of both (`said`)."""
    role, text = (F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("role", "text"))
    said = F.sha2(F.concat(F.sha2(role, 256), text), 256)
    return conversations.select("conv_id", F.col("turn").cast("bigint").alias("turn"), role.alias("role"),
                                text.alias("text"), said.alias("said"))


def _row_key() -> Column:
    """A row's conversation, turn, role and text as one value that is never null."""
    return F.sha2(F.concat(F.to_json(F.struct("conv_id", "turn")), F.col("said")), 256)


class Repair:
    """The repairs of all conversations of a table with `conv_id`, `turn`, `role` and `text`.

    A null role or text counts as one space. Rows go by turn, nulls first; rows of one turn by a digest of role and
    text, so equal ones stand together. A null `conv_id` is a conversation too. Other columns are not looked at. Making this runs jobs; an empty
    table gives empty results.
    """

    def __init__(self, conversations: DataFrame, segment_rows: int = SEGMENT_ROWS):
        self._rows = _prepared(conversations)
        scratch = Scratch(conversations.sparkSession, "turn-repair")
        stripped = F.rtrim("text", F.lit(SPACES))
        marked = self._rows.select(
            "conv_id", "turn", "said", F.substring("role", 1, 1).alias("initial"), (stripped == "").alias("blank"),
            (~F.right(stripped, F.lit(1)).isin(".", "!", "?")).alias("cut_off"))
        counted = marked.groupBy(*marked.columns).agg(F.count(F.lit(1)).alias("copies"))
        # Places are those of the whole order, and below it consecutive within a range.
        ordered = in_order(counted, "conv_id", "turn", "said", label="turns")
        self._placed = ordered.withColumn("place", F.shiftleft("_range", 33) + F.col("_position"))
        fresh = (self._placed.filter(~F.col("blank")).groupBy("conv_id", "said").agg(F.min("place").alias("place"))
                 .select("place", F.lit(True).alias("fresh")))
        known = (self._placed.join(fresh, "place", "left").withColumn("fresh", F.coalesce("fresh", F.lit(False)))
                 .withColumn("_segment", F.expr(f"_position div {segment_rows}"))
                 .repartition("_range", "_segment").sortWithinPartitions("place"))
        conv_id = conversations.select("conv_id").schema["conv_id"]

        def over(df: DataFrame, make, columns: str) -> DataFrame:
            schema = StructType([StructField("conv_id", conv_id.dataType), *StructType.fromDDL(columns)])
            arrow = _arrow(schema)
            return over_batches(df, lambda batches: _in_batches(make(_records(batches)), arrow), schema)

        def cut(records: Iterator[dict]) -> Iterator[dict]:
            solver = Solver()
            for rows in _groups(records, lambda row: (row["_range"], row["_segment"], row["conv_id"])):
                yield _segment(solver, rows)

        def forwards(records: Iterator[dict]) -> Iterator[dict]:
            return _forwards(records)

        def walked(records: Iterator[dict]) -> Iterator[dict]:
            solver = Solver()
            return (_walked(solver, segment) for segment in records)

        segments = scratch.store(over(known, cut, SEGMENT), "segments")
        costs = over(segments.select("conv_id", "place", "table").repartition("conv_id")
                     .sortWithinPartitions("conv_id", F.desc("place")), _backwards, BACKWARDS)
        both = segments.drop("table").join(costs.drop("conv_id"), "place")
        ways = over(both, walked, ", ".join((
            "place bigint, copies array<bigint>, blank bigint, duplicate bigint, truncated bigint, illegal bigint",
            "first string, last string, low bigint, high bigint, turns bigint, opening boolean, before array<bigint>",
            "edits array<array<string>>, exits array<int>")))
        # The segments of a conversation come one after the other; none is held longer than it is looked at.
        self._edits = scratch.store(over(ways.repartition("conv_id").sortWithinPartitions("conv_id", "place"),
                                         forwards, FORWARDS), "edits")
        scratch.drop(segments)

    def summaries(self) -> DataFrame:
        """Per conversation `gaps` (turns that are missing between the least and the greatest), `blank`, `duplicate`,
        `truncated` and `illegal` (neighbours that may not follow each other), the least `cost` and the `audit`, the initials of the edits."""
        return self._edits.filter("last").drop("place", "edits", "last")

    def rows(self) -> DataFrame:
        """The repaired conversations: `conv_id`, `place` and `step` that order the rows, `turn` (null if inserted),
        `role`, `text` and `edit`, the edit's name."""
        edits = self._edits.select(F.posexplode("edits").alias("_step", "_edits"), F.col("place").alias("_first")).select(
            (F.col("_first") + F.col("_step")).alias("place"), "_edits")
        wanted = (self._placed.join(edits.filter(F.col("_edits") != "D"), "place")
                  .select("conv_id", "place", "turn", "_edits", _row_key().alias("_key")))
        texts = (self._rows.select(_row_key().alias("_key"), "role", "text").groupBy("_key")
                 .agg(F.first("role").alias("_role"), F.first("text").alias("_text")))

        def edited(letter: Column) -> Column:
            inserted = letter.isin("u", "a")
            role = F.when(F.lower(letter) == "u", "user").when(F.lower(letter) == "a", "assistant").otherwise(F.col("_role"))
            name = F.when(letter == "K", "keep").when(inserted, "insert").otherwise("rerole")
            return F.struct(F.when(~inserted, F.col("turn")).alias("turn"), role.alias("role"),
                            F.when(inserted, "").otherwise(F.col("_text")).alias("text"), name.alias("edit"))

        letters = F.filter(F.split("_edits", ""), lambda letter: letter.isin("K", "u", "a", "U", "A"))
        return (wanted.join(texts, "_key").select("conv_id", "place", F.posexplode(F.transform(letters, edited)).alias("step", "_row"))
                .select("conv_id", "place", "step", "_row.*"))


def _arrow(schema: StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def text_digests(rows: DataFrame) -> DataFrame:
    """Per conversation `repaired_sha256` of its rows as `role:text`, joined by line ends. A digest is made from front
    to back, so the rows of a conversation pass through one task, one at a time."""
    schema = StructType([rows.schema["conv_id"], *StructType.fromDDL("repaired_sha256 string")])
    arrow = _arrow(schema)

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[dict]:
            current, state = None, None
            for row in _records(batches):
                line = f"{row['role']}:{row['text']}".encode()
                if state is None or row["conv_id"] != current:
                    if state is not None:
                        yield {"conv_id": current, "repaired_sha256": state.hexdigest()}
                    current, state = row["conv_id"], hashlib.sha256(line)
                else:
                    state.update(b"\n" + line)
            if state is not None:
                yield {"conv_id": current, "repaired_sha256": state.hexdigest()}
        yield from _in_batches(made(), arrow)

    ordered = (rows.select("conv_id", "place", "step", "role", "text").repartition("conv_id")
               .sortWithinPartitions("conv_id", "place", "step"))
    return over_batches(ordered, digest, schema)


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows spoiled by `crc32(conv_id:turn) % 20`: 0 goes, 1 loses its text, 2 its marks `.!?`, 3 comes twice, 4 gets
    the role user. A null counts as one space."""
    def known(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    case = F.crc32(F.concat(known("conv_id"), F.lit(":"), known("turn"))) % 20
    return (conversations.withColumn("_case", case).filter("_case != 0").select(
        "conv_id", "turn",
        F.when(F.col("_case") == 4, "user").otherwise(known("role")).alias("role"),
        F.when(F.col("_case") == 1, "").when(F.col("_case") == 2, F.translate(known("text"), ".!?", ""))
        .otherwise(known("text")).alias("text"),
        F.explode(F.when(F.col("_case") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"))
        .drop("_copy"))
