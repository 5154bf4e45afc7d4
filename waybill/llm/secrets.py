"""Secrets in texts and in what the texts wrap.

A search starts with the text itself. Of every layer the secrets are noted, and
what it wraps becomes further layers: the layer with its URL escapes decoded, the
layer with its Unicode escapes decoded, base64 (also over several lines), and
compressed data inside base64. What cannot be decoded stays as it is beside what
can. A layer that equals one it came from is not opened again, nor is one that
was reached with the same spans before. Every character of a layer knows which
part of the original text it comes from, so a find in any depth has a span there.
Layers are told apart by digests, and a layer is dropped once the last one it
wraps is made, so depth costs no memory. An escape of the escape sign itself that
is escaped over and over (`%252525…`) is shortened to `CASCADE` rounds at once:
the layers in between differ in nothing but its length.

Compressed data is unfolded and searched in pieces, whatever its size. Pieces end
where no secret and no wrapped layer of any depth can go on; only a stretch of
over `MOST_HELD` bytes without such a place is cut inside.
"""

from __future__ import annotations

import base64
import bz2
import hashlib
import lzma
import re
import zlib
from array import array
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from waybill.llm.arrow import text_slices
from waybill.llm.columns import with_text
from waybill.llm.tasks import over_batches, with_made

# The kinds in the order in which equal starts are listed.
KINDS = ("assign", "access", "hex")
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                     re.IGNORECASE | re.ASCII)
_ASSIGN_WORDS = ("passw", "secret", "token", "api")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
_SHORTEST_VALUE = 6

_URL = re.compile(r"(?:%[0-9A-Fa-f]{2})+")
_ESCAPE = re.compile(r"\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
# What follows an escape of the escape sign that was escaped again, by the escape.
_ROUNDS = {"%25": re.compile(r"(?:25)++"), "\\u005c": re.compile(r"(?:u005[cC])++"), "\\x5c": re.compile(r"(?:x5[cC])++"),
           "\\U0000005c": re.compile(r"(?:U0000005[cC])++"), "&#38;": re.compile(r"(?:#38;)++"),
           "&#x26;": re.compile(r"(?:#[xX]26;)++")}
CASCADE = 16
_BASE64 = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
# Base64 goes on over line ends, which may themselves be written as escapes.
_LINE_END = r"[\t\x20]*+(?:\r?\n|\r|(?:\\r)?\\n)[\t\x20]*+"
_LINE_ENDS = re.compile(_LINE_END)
_MORE_LINES = re.compile(rf"(?:{_LINE_END}[A-Za-z0-9+/_-]++)++")
_PADDING = re.compile(r"={0,2}")
# Every find has at least so many of these characters on end, and what wraps it is no shorter.
_PLAIN = re.compile(rb"[\t-\r\x20-\x7e]{12}")
# Behind these a piece may end: characters that neither a secret nor a wrapping contains, lines that
# do not end like base64, empty lines, and blanks between words whose letters end no escape.
_SAFE = re.compile(rb"[^\t-\r\x20\x22\x23\x25-\x27+\x2d-;=A-Z\\_a-z]|[.\x22':=][\t\x20]*\r?\n|\n[\t\x20]*\r?\n"
                   rb"|[g-mo-qs-zG-Z]\x20(?=[A-Za-z0-9])")

# Compressed data is searched in pieces of about so many bytes, and of this many at most.
PIECE, MOST_HELD = 8 << 20, 64 << 20
_FED = 1 << 16

SCHEMA = "array<struct<kind:string,start:bigint,end:bigint,depth:int,value:string>>"


@dataclass
class Layer:
    """A text and the original span of each of its characters. All of an
    unfolded layer has the one span `whole`. Spans ascend."""

    text: str
    starts: Sequence[int] = ()
    ends: Sequence[int] = ()
    depth: int = 0
    whole: tuple[int, int] | None = None

    def span(self, low: int, high: int) -> tuple[int, int]:
        return self.whole or (self.starts[low], self.ends[high - 1])

    def mark(self) -> bytes:
        """Equal for layers of the same text and spans."""
        known = hashlib.blake2b(_digest(self.text), digest_size=16)
        known.update(repr(self.whole).encode())
        if self.whole is None:
            known.update(array("q", self.starts).tobytes() + array("q", self.ends).tobytes())
        return known.digest()


def _digest(text: str) -> bytes:
    return hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=16).digest()


def plain_finds(text: str) -> list[tuple[str, int, int]]:
    """The secrets that stand in a text as they are: kind, start, end."""
    found, lowered = [], text.lower()
    if any(word in lowered for word in _ASSIGN_WORDS):
        # A match with a short value is used up all the same.
        found += [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text)
                  if m.end(2) - m.start(2) >= _SHORTEST_VALUE]
    if "AKIA" in text:
        found += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    found += [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]
    return found


def _inner(layer: Layer, path: set[bytes], text: str, starts: Sequence[int], ends: Sequence[int]) -> Layer | None:
    """What a layer wraps, unless the layer or one above it has the same text; `path` has their digests."""
    if not text or _digest(text) in path:
        return None
    return Layer(text, starts, ends, layer.depth + 1, layer.whole)


def _shortened(text: str, escape: str, high: int) -> int:
    """Where an escape of the escape sign ends, with the rounds beyond `CASCADE` that follow it."""
    rounds = _ROUNDS.get(escape.lower() if escape[1] != "U" else "\\U" + escape[2:].lower())
    more = rounds.match(text, high) if rounds else None
    if more is None:
        return high
    width = len(escape) - 1
    return high + max((more.end() - high) // width - CASCADE, 0) * width


def _replaced(layer: Layer, path: set[bytes], found: Iterator[tuple[int, int, str]]) -> Layer | None:
    """The layer with other characters at some places, each given by its low and high end."""
    parts, starts, ends, at = [], array("q"), array("q"), 0
    for low, high, character in found:
        parts += (layer.text[at:low], character)
        if layer.whole is None:
            starts.extend(layer.starts[at:low])
            ends.extend(layer.ends[at:low])
            starts.append(layer.starts[low])
            ends.append(layer.ends[high - 1])
        at = high
    parts.append(layer.text[at:])
    if layer.whole is None:
        starts.extend(layer.starts[at:])
        ends.extend(layer.ends[at:])
    return _inner(layer, path, "".join(parts), starts, ends)


def _decoded(raw: bytes) -> str:
    """Bytes that are no UTF-8 become single surrogates, which no secret and no wrapping contains."""
    return raw.decode("utf-8", "surrogateescape")


def _width(character: str) -> int:
    return len(character.encode("utf-8", "surrogateescape"))


def _url_characters(text: str) -> Iterator[tuple[int, int, str]]:
    for run in _URL.finditer(text):
        at = run.start()
        for character in _decoded(bytes.fromhex(run.group().replace("%", ""))):
            high = at + 3 * _width(character)
            if not 0xDC80 <= ord(character) < 0xDD00:
                yield at, _shortened(text, "%25", high) if character == "%" else high, character
            at = high


def _from_url(layer: Layer, path: set[bytes]) -> Layer | None:
    return _replaced(layer, path, _url_characters(layer.text))


def _character(escape: str) -> str:
    if escape[0] == "&":
        body = escape[2:-1]
        code = int(body[1:], 16) if body[0] in "xX" else int(body)
    else:
        code = int(escape[2:], 16)
    return chr(code) if code < 0x110000 and not 0xD800 <= code < 0xE000 else "�"


def _from_escapes(layer: Layer, path: set[bytes]) -> Layer | None:
    return _replaced(layer, path, ((m.start(), _shortened(layer.text, m.group(), m.end()), _character(m.group()))
                                   for m in _ESCAPE.finditer(layer.text)))


def _unfolder(raw: bytes):
    if raw[:2] == b"\x1f\x8b" or (raw[:1] == b"\x78" and int.from_bytes(raw[:2], "big") % 31 == 0):
        return zlib.decompressobj(wbits=47)
    if raw[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if raw[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor()
    return None


def _unfolded(raw: bytes) -> Iterator[bytes]:
    """Compressed data unfolded bit by bit, one stream after the other, as far as
    it is whole; nothing if it is none of the known kinds."""
    while (unfolder := _unfolder(raw)) is not None:
        at, data = 0, b""
        try:
            while not unfolder.eof:
                if not data and getattr(unfolder, "needs_input", True):
                    data, at = raw[at:at + _FED], at + _FED
                    if not data:
                        return
                yield unfolder.decompress(data, PIECE)
                data = getattr(unfolder, "unconsumed_tail", b"")
        except (zlib.error, OSError, EOFError, lzma.LZMAError, ValueError):
            return
        raw = unfolder.unused_data + raw[at:]
        # Padding between streams.
        raw = raw.lstrip(b"\0")


def _safe_end(held: bytearray) -> int:
    """The last place where a piece may end, 0 if there is none."""
    reach = 1 << 12
    while True:
        low, last = max(len(held) - reach, 0), None
        for last in _SAFE.finditer(held, low):
            pass
        if last or low == 0:
            return last.end() if last else 0
        reach *= 8


def _pieces(parts: Iterator[bytes]) -> Iterator[bytes]:
    held, enough = bytearray(), PIECE
    for part in parts:
        held += part
        if len(held) < enough:
            continue
        high = _safe_end(held) or (len(held) if len(held) >= MOST_HELD else 0)
        if high:
            yield bytes(held[:high])
            del held[:high]
        enough = PIECE if high else 2 * len(held)
    if held:
        yield bytes(held)


def _coded(layer: Layer) -> Iterator[tuple[str, Sequence[int], int]]:
    """What may be base64, where its characters stand, and its end with the
    padding: unbroken runs, and runs over several lines. Of the latter the lines of equal length with the
    shorter last one, with and without the line before, and all together."""
    done = 0
    for run in _BASE64.finditer(layer.text):
        coded = run.group().rstrip("=")
        low, at = run.start(), run.start() + len(coded)
        if len(coded) % 4 != 1:
            yield coded, range(low, at), run.end()
        if low < done or not (more := _MORE_LINES.match(layer.text, at)):
            continue
        done, borders = more.end(), []
        for end in _LINE_ENDS.finditer(layer.text, at, done):
            borders.append((low, end.start()))
            low = end.end()
        borders.append((low, done))
        padded = _PADDING.match(layer.text, done).end()
        widths = [high - low for low, high in borders]
        groups, first = {(0, len(borders))}, 0
        while first < len(borders):
            last = first
            while last + 1 < len(borders) and widths[last + 1] == widths[first]:
                last += 1
            beyond = last + 2 if last + 1 < len(borders) and widths[last + 1] < widths[first] else last + 1
            groups |= {(first, beyond), (max(first - 1, 0), beyond)}
            first = last + 1
        for low, high in sorted(groups):
            if high - low > 1:
                places = array("q")
                for line in borders[low:high]:
                    places.extend(range(*line))
                yield ("".join(layer.text[a:b] for a, b in borders[low:high]), places,
                       padded if high == len(borders) else borders[high - 1][1])


def _from_base64(layer: Layer, path: set[bytes]) -> Iterator[Layer | None]:
    for coded, at, end in _coded(layer):
        if len(coded) % 4 == 1:  # of joined lines, the last of which may be no base64; this character has no byte
            coded = coded[:-1]
        raw = base64.b64decode(coded.translate({45: 43, 95: 47}) + "=" * (-len(coded) % 4))
        if _unfolder(raw) is not None:
            whole = layer.span(at[0], end)
            for piece in _pieces(_unfolded(raw)):
                text = _decoded(piece) if _PLAIN.search(piece) else ""
                if text and _digest(text) not in path:
                    yield Layer(text, depth=layer.depth + 1, whole=whole)
        if not _PLAIN.search(raw):
            continue
        text, starts, ends = _decoded(raw), array("q"), array("q")
        if layer.whole is None:
            byte, last = 0, len(at)
            for character in text:
                low = byte // 3 * 4
                byte += 1 if character < "\x80" else _width(character)
                starts.append(layer.starts[at[low]])
                high = (byte - 1) // 3 * 4 + 3
                ends.append(layer.ends[at[high] if high < last else end - 1])
        yield _inner(layer, path, text, starts, ends)


def _inside(layer: Layer, path: set[bytes]) -> Iterator[Layer | None]:
    """What a layer wraps, one after the other. Nothing here holds the layer any more when the last one is given."""
    yield from _from_base64(layer, path)
    url = "%" in layer.text and _URL.search(layer.text) is not None
    escapes = ("\\" in layer.text or "&#" in layer.text) and _ESCAPE.search(layer.text) is not None
    if url and escapes:
        yield _from_url(layer, path)
    if url or escapes:
        last = [_from_escapes(layer, path) if escapes else _from_url(layer, path)]
        del layer
        yield last.pop()


def find_secrets(text: str) -> list[tuple[str, int, int, int, str]]:
    """Kind, start, end, depth and value of every secret, by start, kind, end and
    depth. All that a compressed layer holds has one span, so different values
    at one span are different secrets; a value found there at a lesser depth is
    not listed again."""
    found: dict[tuple[int, int, int, str], int] = {}
    seen: dict[bytes, int] = {}  # layers, with the least depth so far
    path: set[bytes] = set()  # of the layers whose insides are being looked at
    work = [(iter([Layer(text, range(len(text)), range(1, len(text) + 1))]), b"")]
    while work:  # one layer of each depth at a time, as there may be very many
        layer = next(work[-1][0], work)
        if layer is work:
            path.discard(work.pop()[1])
            continue
        if layer is None:
            continue
        if layer.depth:
            mark = layer.mark()
            if seen.get(mark, layer.depth + 1) <= layer.depth:
                continue
            seen[mark] = layer.depth
        for kind, low, high in plain_finds(layer.text):
            start, end = layer.span(low, high)
            key = (start, KINDS.index(kind), end, layer.text[low:high])
            found[key] = min(found.get(key, layer.depth), layer.depth)
        digest = _digest(layer.text)
        path.add(digest)
        work.append((_inside(layer, path), digest))
    # Equal depths stay in the order of their layers.
    order = sorted(found.items(), key=lambda one: (one[0][:3], one[1]))
    return [(KINDS[kind], start, end, depth, value) for (start, kind, end, value), depth in order]


def scan(docs: DataFrame, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The columns `keep` and `secrets` (with underscores appended if that name
    is taken), the finds of the whole text.

    A null or empty text has none. Rows may repeat; an empty table gives an
    empty result. Positions are code points, ends are exclusive.
    """
    schema = with_made(docs, keep, f"secrets {SCHEMA}")
    columns = schema.names

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                                   ("depth", pa.int32()), ("value", pa.string())]))
        names = ("kind", "start", "end", "depth", "value")
        for part in text_slices(batches):
            finds = [[dict(zip(names, one)) for one in find_secrets(text or "")]
                     for text in part.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(part.column(name) for name in keep), pa.array(finds, kind)], columns)

    return over_batches(with_text(docs, keep), find, schema)


def _of_kind(kind: str):
    return lambda one: one["kind"] == kind


def digests(found: DataFrame) -> DataFrame:
    """Counts and digest of the finds that stand in the text itself, and the spans of all."""
    base = F.filter("secrets", lambda one: one["depth"] == 0)
    listed = lambda finds: F.array_join(
        F.transform(finds, lambda one: F.concat_ws(":", one["kind"], one["start"], one["end"])), ",")
    counts = [F.size(F.filter(base, _of_kind(kind))).cast("bigint").alias(f"n_{kind}")
              for kind in KINDS]
    return found.select("doc_id", *counts, F.sha2(listed(base), 256).alias("base_sha256"),
                        listed(F.col("secrets")).alias("spans"))
