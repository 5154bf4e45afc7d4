"""Hierarchical Pitman-Yor processes: restaurants, seating, predictions.

A word is served by one restaurant whose customers are the tokens of the corpus.
Whenever a table is opened there, the word is drawn from the spelling model: a
hierarchy of restaurants over the bytes of a word and its end, one for every
context of up to four preceding bytes; the restaurant of a context has that of
the context without its earliest byte as parent, which is shared by all contexts
that end alike, and the root has the uniform distribution. Both parts are thus
one hierarchy, in which a table is a customer of the parent.

Contexts fall into classes whose number has fixed bits, and the class of a
shorter context is the leading bits of that of the longer one. The spelling
model therefore has a bound that does not depend on the corpus, and each of its
restaurants is a proper distribution.

Seating is sampled by Gibbs steps of blocks: all customers of one dish in one
restaurant leave, and come back one after the other given all other tables; from
the ninth customer on, customers in a row whose number is an eighth of those
seated see the same chances.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

from waybill.llm.codes import grouped

SYMBOL_BITS = 9
SYMBOLS = 257
END = 256
START = 256
# Bits of the class that each preceding byte adds, nearest first.
CONTEXT_BITS = (6, 5, 2, 2)
DEPTH = len(CONTEXT_BITS)
CONTEXT = sum(CONTEXT_BITS)
STRENGTH = 1.0
SWEEPS = 2


def _byte_classes() -> list[np.ndarray]:
    """Classes of a byte, or of the start of the word, in each place of a context."""
    number = np.arange(257)
    letter = (number >= 97) & (number <= 122)
    tables = [np.where(letter, number - 97, 26 + number * 29 % 37)]
    tables += [(number * factor >> 3) % ((1 << bits) - 1) for bits, factor in zip(CONTEXT_BITS[1:], (167, 211, 89))]
    for table, bits in zip(tables, CONTEXT_BITS):
        table[START] = (1 << bits) - 1
    return [table.astype(np.uint32) for table in tables]


_CLASSES = _byte_classes()


def spelling_codes(spelled: np.ndarray, borders: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The context class and symbol of every byte of the words and of their
    ends, as numbers below 2**24, and where each word's begin and end."""
    words = len(borders) - 1
    places = borders + np.arange(words + 1)
    symbols = np.full(len(spelled) + words, END, np.int64)
    inside = np.ones(len(symbols), bool)
    inside[places[1:] - 1] = False
    symbols[inside] = spelled
    first = np.repeat(places[:-1], np.diff(places))
    at = np.arange(len(symbols))
    code = np.zeros(len(symbols), np.uint32)
    for back, (bits, table) in enumerate(zip(CONTEXT_BITS, _CLASSES), 1):
        before = np.where(at - back >= first, symbols[np.maximum(at - back, 0)], START)
        code = code << np.uint32(bits) | table[before]
    return code << np.uint32(SYMBOL_BITS) | symbols.astype(np.uint32), places


def discount(counts: np.ndarray) -> float:
    """The usual estimate from the numbers of singles and pairs."""
    ones, twos = int((counts == 1).sum()), int((counts == 2).sum())
    return min(max(ones / (ones + 2 * twos), 0.05), 0.95) if ones and twos else 0.5


def seat(counts: np.ndarray, mass: np.ndarray, rebate: float, random: np.random.Generator) -> np.ndarray:
    """Numbers of tables after `counts` customers of each dish (at least one)
    have come back; `mass` is the weight of a new table for the dish."""
    tables = np.ones(len(counts), np.int64)
    seated = np.ones(len(counts), np.int64)
    open_ = np.flatnonzero(counts > 1)
    while len(open_):
        come = np.minimum(counts[open_] - seated[open_], np.maximum(seated[open_] // 8, 1))
        chance = mass[open_] / (seated[open_] - rebate * tables[open_] + mass[open_])
        tables[open_] += random.binomial(come, np.clip(chance, 0.0, 1.0))
        seated[open_] += come
        open_ = open_[seated[open_] < counts[open_]]
    return tables


@dataclass
class Level:
    """The restaurants of one context length: dishes as sorted numbers of
    context and symbol, with customers and tables; totals per context."""

    keys: np.ndarray
    customers: np.ndarray
    tables: np.ndarray
    rebate: float

    def __post_init__(self):
        owner = self.keys >> np.uint32(SYMBOL_BITS)
        self.contexts, self.all_customers, _ = grouped(owner, self.customers)
        _, self.all_tables, _ = grouped(owner, self.tables)

    def predict(self, keys: np.ndarray, parent: np.ndarray) -> np.ndarray:
        """Predictive probabilities, given those of the parent restaurants."""
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        own = np.where(self.keys[at] == keys, self.customers[at] - self.rebate * self.tables[at], 0.0)
        owner = keys >> np.uint32(SYMBOL_BITS)
        at = np.minimum(np.searchsorted(self.contexts, owner), len(self.contexts) - 1)
        known = self.contexts[at] == owner
        customers = np.where(known, self.all_customers[at], 0)
        tables = np.where(known, self.all_tables[at], 0)
        return (own + (STRENGTH + self.rebate * tables) * parent) / (STRENGTH + customers)


def _shorter(keys: np.ndarray, bits: int) -> np.ndarray:
    """The numbers with the earliest byte of the context left out."""
    symbol = keys & np.uint32((1 << SYMBOL_BITS) - 1)
    return (keys >> np.uint32(SYMBOL_BITS + bits)) << np.uint32(SYMBOL_BITS) | symbol


class Spelling:
    """Restaurants of all context lengths, shortest first."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, random: np.random.Generator,
                 before: Spelling | None = None, sweeps: int = SWEEPS):
        """Seat the customers `counts` of the longest contexts `codes` (ascending), starting from `before`."""
        self.levels: list[Level] = before.levels if before is not None else []
        for _ in range(sweeps):
            self.levels = self._swept(codes, counts, random)

    def _swept(self, codes: np.ndarray, counts: np.ndarray, random: np.random.Generator) -> list[Level]:
        levels: list[Level] = []
        keys, customers = codes, counts.astype(np.int64)
        for length in range(DEPTH, -1, -1):
            rebate = discount(customers)
            owner = keys >> np.uint32(SYMBOL_BITS)
            if self.levels:
                base = self.predict(keys, length)
                at = np.minimum(np.searchsorted(self.levels[length].contexts, owner),
                                len(self.levels[length].contexts) - 1)
                known = self.levels[length].contexts[at] == owner
                tables = np.where(known, self.levels[length].all_tables[at], 0)
                seats = seat(customers, (STRENGTH + rebate * tables) * base, rebate, random)
            else:
                seats = np.ones(len(keys), np.int64)
            levels.insert(0, Level(keys, customers, seats, rebate))
            if length:
                upper = _shorter(keys, CONTEXT_BITS[length - 1])
                order = np.argsort(upper, kind="stable")
                keys, customers, _ = grouped(upper[order], seats[order])
        return levels

    def predict(self, keys: np.ndarray, length: int = DEPTH + 1) -> np.ndarray:
        """Probabilities of the symbols under the restaurants with contexts
        shorter than `length`; `keys` hold contexts of `length` bytes, or of the
        greatest length."""
        chain = [keys]
        for own in range(min(length, DEPTH), 0, -1):
            chain.insert(0, _shorter(chain[0], CONTEXT_BITS[own - 1]))
        chance = np.full(len(keys), 1.0 / SYMBOLS)
        for level, own in list(zip(self.levels, chain))[:length]:
            chance = level.predict(own, chance)
        return chance

    def log_words(self, spelled: np.ndarray, borders: np.ndarray, block: int = 1 << 20) -> np.ndarray:
        """Natural log probabilities of whole words."""
        result = np.empty(len(borders) - 1)
        low = 0
        while low < len(result):
            high = max(int(np.searchsorted(borders, borders[low] + block, side="right")) - 1, low + 1)
            codes, places = spelling_codes(spelled[borders[low]:borders[high]], borders[low:high + 1] - borders[low])
            found = np.sort(codes)
            found = found[np.concatenate([[True], found[1:] != found[:-1]])]
            logs = np.log(self.predict(found))[np.searchsorted(found, codes)]
            sums = np.concatenate([[0.0], np.cumsum(logs)])
            result[low:high] = sums[places[1:]] - sums[places[:-1]]
            low = high
        return result
