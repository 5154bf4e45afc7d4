"""Token counts by deterministic transducers compiled from a byte-level BPE tokenizer.

Two transducers run one after the other, and both add up what their transitions emit.

The word transducer reads character classes and says where words begin. It has
twelve states, so what a chunk of text does is a map of twelve states. Maps of
all chunks are made side by side, composed by a parallel prefix scan, and give
every chunk the state it starts in; a last pass over all chunks side by side
emits the borders. Two borders are known a character late (the space that goes
with the word after it, and a contraction that does not come about), so a
transition may emit a border before the character it read last.

The token transducer reads the bytes of a word. By the rules of byte-pair
encoding the last token of a prefix is the one suffix of it that is a token and
may stand next to the last token of the prefix before it. What decides about the
next byte is therefore the longest suffix that begins some token, and the last
tokens and counts of as many prefixes. These are the states; their number is
finite, and they are compiled when they are first reached. A transition carries
by how much the number of tokens changes: a byte that joins three tokens into
one takes two back.

Transitions and words seen lately are kept up to a bound and compiled again
after it; only work depends on that.
"""

from __future__ import annotations

import hashlib
import json
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from waybill.llm.arrow import text_slices, utf8
from waybill.llm.bpe import byte_characters
from waybill.llm.columns import with_text
from waybill.llm.tasks import over_batches, with_made

LIMIT = 1024
CHUNK = 256
# Characters that are worked on at a time.
PIECE = 1 << 20
STATES, WORDS = 250_000, 200_000
# Bytes that are read before the number of states is looked at.
BLOCK = 1 << 16

# Letters and numbers of Unicode 16 that an older `unicodedata` does not have.
LATER_LETTERS = (
    (0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105F3), (0x10D4A, 0x10D65), (0x10D6F, 0x10D85),
    (0x10EC2, 0x10EC4), (0x11380, 0x11389), (0x1138B, 0x1138B), (0x1138E, 0x1138E), (0x11390, 0x113B5),
    (0x113B7, 0x113B7), (0x113D1, 0x113D1), (0x113D3, 0x113D3), (0x11BC0, 0x11BE0), (0x13460, 0x143FA),
    (0x16100, 0x1611D), (0x16D40, 0x16D6C), (0x18CFF, 0x18CFF), (0x1E5D0, 0x1E5ED), (0x1E5F0, 0x1E5F0))
LATER_NUMBERS = ((0x10D40, 0x10D49), (0x116D0, 0x116E3), (0x11BF0, 0x11BF9), (0x16130, 0x16139), (0x16D70, 0x16D79),
                 (0x1CCF0, 0x1CCF9), (0x1E5F1, 0x1E5FA))

# Classes of characters. Letters that contractions end in have classes of their own; EDGE is no character of a text.
(LETTER, ENDS, R_OR_V, E, ELL, NUMBER, BLANK, SPACE, OTHER, QUOTE, EDGE) = range(11)
CLASSES = 11
# States: what the word read last is. ONE_* is a first space, MORE_* a later one; *_BLANK is the plain space, which
# goes with the word after it.
(FRESH, IN_LETTERS, IN_NUMBERS, IN_OTHERS, QUOTED, QUOTED_RV, QUOTED_L, CONTRACTED,
 ONE_BLANK, ONE_SPACE, MORE_BLANK, MORE_SPACE) = range(12)
# What a transition emits, as bits: a border before the character, and one before the character before it.
HERE, BACK = 1, 2


def _word_transducer() -> tuple[np.ndarray, np.ndarray]:
    """Next state and emission by state and class."""
    following = np.zeros((12, CLASSES), np.uint8)
    emitted = np.zeros((12, CLASSES), np.uint8)
    begun = {LETTER: IN_LETTERS, ENDS: IN_LETTERS, R_OR_V: IN_LETTERS, E: IN_LETTERS, ELL: IN_LETTERS,
             NUMBER: IN_NUMBERS, OTHER: IN_OTHERS, QUOTE: QUOTED, BLANK: ONE_BLANK, SPACE: ONE_SPACE, EDGE: FRESH}
    for state in range(12):
        for kind in range(CLASSES):
            to, out = begun[kind], HERE
            word = IN_OTHERS if kind == QUOTE else to
            if kind == EDGE:
                out = BACK if state in (QUOTED_RV, QUOTED_L) else 0
            elif kind in (BLANK, SPACE):
                if state in (ONE_BLANK, ONE_SPACE, MORE_BLANK, MORE_SPACE):
                    to, out = (MORE_BLANK if kind == BLANK else MORE_SPACE), 0
                elif state in (QUOTED_RV, QUOTED_L):
                    out = HERE | BACK
            elif state == ONE_BLANK:
                to, out = word, 0
            elif state == MORE_BLANK:
                to, out = word, BACK
            elif state == MORE_SPACE:
                out = HERE | BACK
            elif state in (IN_LETTERS, IN_NUMBERS, IN_OTHERS) and word == state:
                to, out = state, 0
            elif state == QUOTED:
                contraction = {ENDS: CONTRACTED, R_OR_V: QUOTED_RV, ELL: QUOTED_L}
                if kind in contraction:
                    to, out = contraction[kind], 0
                elif word == IN_OTHERS:
                    to, out = IN_OTHERS, 0
            elif (state, kind) in ((QUOTED_RV, E), (QUOTED_L, ELL)):
                to, out = CONTRACTED, 0
            elif state in (QUOTED_RV, QUOTED_L):
                out = BACK if word == IN_LETTERS else HERE | BACK
            following[state, kind], emitted[state, kind] = to, out
    return following, emitted


_NEXT, _OUT = _word_transducer()
_FLAT_NEXT, _FLAT_OUT = _NEXT.ravel(), _OUT.ravel()


def _class_table() -> np.ndarray:
    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for code in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(code))[0]
        if kind == "L":
            table[code] = LETTER
        elif kind == "N":
            table[code] = NUMBER
        elif chr(code).isspace() and not 0x1C <= code <= 0x1F:
            table[code] = SPACE
    for ranges, kind in ((LATER_LETTERS, LETTER), (LATER_NUMBERS, NUMBER)):
        for low, high in ranges:
            table[low:high + 1] = kind
    for characters, kind in (("stmd", ENDS), ("rv", R_OR_V), ("e", E), ("l", ELL), (" ", BLANK), ("'", QUOTE)):
        for character in characters:
            table[ord(character)] = kind
    return table


def compose(first: np.ndarray, then: np.ndarray) -> np.ndarray:
    """State maps, one per row: `first` and after it `then`."""
    return np.take_along_axis(then, first, axis=1)


def prefix_maps(maps: np.ndarray) -> np.ndarray:
    """Row i is the composition of the maps of chunks 0 to i, in log2 steps."""
    done = maps.copy()
    step = 1
    while step < len(done):
        done[step:] = compose(done[:-step], done[step:])
        step *= 2
    return done


def word_states(classes: np.ndarray, state: int = FRESH, chunk: int = CHUNK) -> tuple[np.ndarray, int]:
    """The state before each character, and the state at the end, from a state at the start."""
    n = len(classes)
    if n == 0:
        return np.zeros(0, np.uint8), state
    chunk = min(chunk, n)
    chunks = -(-n // chunk)
    # EDGE fills the last chunk; what follows the last character is not looked at.
    padded = np.full(chunks * chunk, EDGE, np.uint8)
    padded[:n] = classes
    columns = np.ascontiguousarray(padded.reshape(chunks, chunk).T)
    maps = np.tile(np.arange(12, dtype=np.uint8), (chunks, 1))
    for column in columns:
        maps = _FLAT_NEXT[maps * np.uint8(CLASSES) + column[:, None]]
    entered = np.empty(chunks, np.uint8)
    entered[0] = state
    entered[1:] = prefix_maps(maps[:-1])[:, state]
    before = np.empty((chunk, chunks), np.uint8)
    for row, column in zip(before, columns):
        row[:] = entered
        entered = _FLAT_NEXT[entered * np.uint8(CLASSES) + column]
    before = before.T.ravel()[:n]
    return before, int(_NEXT[before[-1], classes[-1]])


class TokenTransducer:
    """Counts the tokens of words by compiled transitions; made from the content of a tokenizer file."""

    def __init__(self, content: bytes, states: int = STATES, words: int = WORDS):
        described = json.loads(content)
        model = described["model"]
        vocabulary: dict[str, int] = model["vocab"]
        if model.get("ignore_merges") or described.get("normalizer") or model.get("end_of_word_suffix"):
            raise ValueError("only byte-level encodings that merge every word are compiled")
        byte_of = {character: byte for byte, character in enumerate(byte_characters())}
        self.special = [token["content"] for token in described["added_tokens"]]
        pairs = [pair if isinstance(pair, list) else pair.split(" ") for pair in model["merges"]]
        self._merges = {(vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b]) for rank, (a, b) in enumerate(pairs)}
        specials = set(self.special)
        self._bytes = {number: bytes(byte_of[c] for c in text) for text, number in vocabulary.items()
                       if text not in specials}
        self._token = {raw: number for number, raw in self._bytes.items()}
        self._byte = [self._token[bytes([byte])] for byte in range(256)]
        self._begins = {raw[:size] for raw in self._token for size in range(1, len(raw) + 1)}
        self._fits: dict[tuple[int, int], bool] = {}
        self._state_limit, self._word_limit = states, words
        self._young: dict[str, int] = {}
        self._old: dict[str, int] = {}
        self._reset()

    def _reset(self) -> None:
        # A state: the longest suffix that begins a token; the last token of the prefixes that end 0, 1, ... bytes
        # before (-1: the empty one); and how many tokens fewer these prefixes have.
        self._states: list[tuple[bytes, tuple[int, ...], tuple[int, ...]]] = [(b"", (-1,), (0,))]
        self._numbers = {self._states[0]: 0}
        self._moves: dict[int, int] = {}

    def _merged(self, raw: bytes) -> list[int]:
        """Byte-pair encoding of a few bytes, by the definition."""
        symbols = [self._byte[byte] for byte in raw]
        while len(symbols) > 1:
            best = min(((*self._merges[pair], i) for i, pair in enumerate(zip(symbols, symbols[1:]))
                        if pair in self._merges), default=None)
            if best is None:
                break
            symbols[best[2]:best[2] + 2] = [best[1]]
        return symbols

    def _fit(self, left: int, right: int) -> bool:
        """Whether two tokens stay as they are next to each other (-1: at the start of a word)."""
        found = self._fits.get((left, right))
        if found is None:
            pair = [right] if left < 0 else [left, right]
            found = self._merged(b"".join(self._bytes[token] for token in pair)) == pair
            if len(self._fits) >= 4 * self._state_limit:
                self._fits = {}
            self._fits[left, right] = found
        return found

    def _compile(self, state: int, byte: int) -> int:
        """The transition of a state by a byte: the next state, and the change of the count plus 128."""
        suffix, lasts, fewer = self._states[state]
        suffix += bytes([byte])
        while suffix not in self._begins:
            suffix = suffix[1:]
        for size in range(len(suffix), 0, -1):
            token = self._token.get(suffix[-size:])
            if token is not None and self._fit(lasts[size - 1], token):
                break
        else:
            raise ValueError("the merges of this vocabulary do not reach every text")
        change = 1 - fewer[size - 1]
        depth = len(suffix)
        made = (suffix, (token, *lasts[:depth]), (0, *[one + change for one in fewer[:depth]]))
        number = self._numbers.get(made)
        if number is None:
            number = self._numbers[made] = len(self._states)
            self._states.append(made)
        move = self._moves[state << 8 | byte] = number << 8 | change + 128
        return move

    def run(self, raw: bytes, state: int = 0) -> tuple[int, int]:
        """Read bytes from a state (0: the start of a word): the new state and the change of the count."""
        moves, total = self._moves.get, 0
        for byte in raw:
            move = moves(state << 8 | byte)
            if move is None:
                move = self._compile(state, byte)
            state = move >> 8
            total += (move & 255) - 128
        return state, total

    def _room(self, state: int = 0) -> int:
        """Forget compiled states beyond the bound, but for one: its number afterwards."""
        if len(self._states) <= self._state_limit:
            return state
        held = self._states[state]
        self._reset()
        if state:
            state = self._numbers[held] = len(self._states)
            self._states.append(held)
        return state

    def read(self, raw: bytes, state: int = 0) -> tuple[int, int]:
        """`run` over any number of bytes, with a bound on the states that it compiles."""
        total = 0
        for low in range(0, len(raw), BLOCK):
            state, change = self.run(raw[low:low + BLOCK], self._room(state))
            total += change
        return state, total

    def count(self, word: str) -> int:
        """The number of tokens of one word."""
        found = self._old.get(word)
        if found is None:
            found = self.read(word.encode())[1]
        if len(word) <= 64:
            if len(self._young) >= self._word_limit:
                self._old, self._young = self._young, {}
            self._young[word] = found
        return found

    def counts(self, words: list[str]) -> np.ndarray:
        found = list(map(self._young.get, words))
        for i, one in enumerate(found):
            if one is None:
                found[i] = self.count(words[i])
        return np.array(found, np.int64)


class TokenCounter:
    """Both transducers over texts."""

    def __init__(self, content: bytes, **bounds: int):
        self.tokens = TokenTransducer(content, **bounds)
        self._classes = _class_table()
        if any(len(special) < 2 for special in self.tokens.special):
            raise ValueError("special strings of one character are not handled")

    def _read(self, text: str) -> np.ndarray:
        return self._classes[np.frombuffer(text.encode("utf-32-le"), np.uint32)]

    def _specials(self, text: str) -> list[tuple[int, int]]:
        """Where special strings stand, the leftmost first and the longest of several."""
        found, low = [], 0
        while True:
            hits = [(place, -len(special)) for special in self.tokens.special if (place := text.find(special, low)) >= 0]
            if not hits:
                return found
            place, size = min(hits)
            found.append((place, place - size))
            low = place - size

    def count_all(self, texts: list[str]) -> np.ndarray:
        """The numbers of tokens of several texts, read as one with an edge between them."""
        joined = "\n".join(["", *texts])
        if not texts:
            return np.zeros(0, np.int64)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        edges = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
        classes = self._read(joined)
        classes[edges] = EDGE
        extra = np.zeros(len(texts), np.int64)
        if any(special in joined for special in self.tokens.special):
            for i, text in enumerate(texts):
                for low, high in self._specials(text):
                    classes[edges[i] + 1 + low:edges[i] + 1 + high] = EDGE
                    extra[i] += 1
        before, _ = word_states(classes)
        starts, ends = _cut(classes, before)
        words = [joined[low:high] for low, high in zip(starts.tolist(), ends.tolist())]
        totals = np.concatenate([[0], np.cumsum(self.tokens.counts(words))])
        first = np.searchsorted(starts, np.append(edges, len(classes)))
        return np.diff(totals[first]) + extra

    def count_long(self, text: str, piece: int = PIECE) -> int:
        """The number of tokens of one text, in pieces whose size does not depend on it.

        The word that a piece ends in goes on in the next one: its characters are held back, and beyond the size of a
        piece the token transducer reads all but the last of them.
        """
        total, low = 0, 0
        for left, right in self._specials(text):
            total += self._count_plain(text, low, left, piece) + 1
            low = right
        return total + self._count_plain(text, low, len(text), piece)

    def _count_plain(self, text: str, low: int, high: int, piece: int) -> int:
        total, held, state, open_state = 0, "", FRESH, 0
        for start in range(low, high, piece):
            part = text[start:min(start + piece, high)]
            classes = self._read(part)
            before, state = word_states(classes, state)
            borders = _borders(classes, before) + len(held)
            held += part
            if open_state and len(borders) and borders[0] == 0:
                open_state = 0  # the word that is open ended before the character held back
            cuts = np.append(borders[borders > 0], len(held)).tolist()
            words = [held[i:j] for i, j in zip([0, *cuts], cuts)]
            if len(words) > 1:
                if open_state:
                    total += self.tokens.read(words[0].encode(), open_state)[1]
                    words, open_state = words[1:], 0
                total += int(self.tokens.counts(words[:-1]).sum())
            held = words[-1]
            if len(held) > piece:
                open_state, change = self.tokens.read(held[:-1].encode(), open_state)
                total, held = total + change, held[-1:]
        if state in (QUOTED_RV, QUOTED_L):
            # The text ends before a contraction is whole.
            total += self.tokens.read(held[:-1].encode(), open_state)[1]
            held, open_state = held[-1:], 0
        return total + self.tokens.read(held.encode(), open_state)[1]


def _borders(classes: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Where words begin, ascending; -1 is the character before the first one."""
    out = _FLAT_OUT[before * np.uint8(CLASSES) + classes]
    return np.union1d(np.flatnonzero(out & HERE), np.flatnonzero(out & BACK) - 1)


def _cut(classes: np.ndarray, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of whole texts; EDGE stands before each text."""
    edge = classes == EDGE
    out = _FLAT_OUT[before * np.uint8(CLASSES) + classes]
    begins = (out & HERE) > 0
    begins[:-1] |= (out[1:] & BACK) > 0
    if len(before) and _NEXT[before[-1], classes[-1]] in (QUOTED_RV, QUOTED_L):
        begins[-1] = True
    begins[edge] = False
    places = np.flatnonzero(begins | edge)
    ends = np.append(places[1:], len(classes))
    words = ~edge[places]
    return places[words], ends[words]


_counters: dict[str, TokenCounter] = {}


def _counter(content: bytes) -> TokenCounter:
    """One counter for all tasks of a Python worker."""
    key = hashlib.sha256(content).hexdigest()
    if key not in _counters:
        _counters[key] = TokenCounter(content)
    return _counters[key]


def read_tokenizer(spark: SparkSession, path: str) -> Broadcast:
    """The tokenizer file, whose size is fixed, for all executors."""
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def token_counts(docs: DataFrame, tokenizer: Broadcast, keep: tuple[str, ...] = ("doc_id",),
                 limit: int = LIMIT) -> DataFrame:
    """The columns `keep`, `n_bytes` of the text in UTF-8, its `n_tokens` and
    whether they are more than `limit` (`over_limit`).

    Special strings inside a text count as one token each, and the text on
    either side is read by itself. A null text counts as empty and has none. A
    new name that is taken gets underscores appended. Rows are independent: they
    may repeat and come back as often; an empty table gives an empty result.
    Texts longer than `PIECE` are read in pieces.
    """
    schema = with_made(docs, keep, "n_bytes bigint, n_tokens bigint, over_limit boolean")
    names = schema.names

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter(tokenizer.value)
        for part in text_slices(batches):
            column = part.column("text")
            sizes = np.diff(utf8(column)[1])
            if len(column) == 1 and sizes[0] > PIECE:
                found = np.array([counter.count_long(column[0].as_py())])
            else:
                found = counter.count_all([text or "" for text in column.to_pylist()])
            columns = [part.column(name) for name in keep]
            columns += [pa.array(sizes, pa.int64()), pa.array(found, pa.int64()), pa.array(found > limit)]
            yield pa.RecordBatch.from_arrays(columns, names)

    return over_batches(with_text(docs, keep), count, schema)
