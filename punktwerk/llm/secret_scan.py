"""Secret scans through nested encodings.

A text is the first layer of a worklist. Each layer is scanned for secrets,
then unwrapped: URL escapes and Unicode escapes are decoded in place, base64
runs become layers of their own, and so do the texts that compressed bytes
(gzip, zlib, zstandard, bzip2, xz) in a base64 run hold. New layers join the
worklist until none is left. A layer that was met before at the same place
(the digest of its text and the stretch of the document that it came from) is
not taken up again, so encodings that decode to themselves end. Every layer
knows for each of its characters which stretch of the document it stands for;
a secret in it is reported as the stretch from the first to the last of them.
Characters of a decompressed layer stand for its whole base64 run.

Kinds, by the digest query's contract: ``assign`` (a name, ``=`` or ``:``, a
value of 8 or more signs), ``access`` (``AKIA`` and capital letters or
digits, 16 or more) and ``hex`` (32 or more lower-case hexadecimal digits).
A span is the whole match. Base spans are those of the document's own text;
the layers add spans and take none away.

Compressed layers are unpacked and scanned in pieces of about ``PIECE``
characters, cut where no secret and no escape can go on, so memory stays
bounded however far a small run expands. Where a single run of token signs is
longer than a piece, it is cut too: pieces then overlap by ``OVERLAP``
characters, so only an encoded run that is longer than that and crosses the
border is not unwrapped; nothing else is left out.

A null text counts as empty: no span, and the digest of the empty text. Rows
that repeat a doc_id are scanned separately. Extra columns are ignored."""

from __future__ import annotations

import base64
import binascii
import bz2
import hashlib
import lzma
import re
import zlib
from collections.abc import Iterator
from urllib.parse import unquote_to_bytes

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from punktwerk.llm.common import prepare

#: The contract's kinds, in its order (fixed values); a match must have this
#: many characters in this group.
KINDS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 8),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    "hex": (re.compile(r"(?<![0-9a-f])[0-9a-f]{32,}"), 0, 32),
}

# An escaped escape sign, escaped over and over (%25252525): all but one layer
# of it is taken off at once, as each layer alone would make the work quadratic.
_CHAIN = r"(%25)(?:25){2,}|(\\x5[cC])(?:x5[cC]){2,}|(\\u005[cC])(?:u005[cC]){2,}|(&#38;)(?:#38;){2,}"
# A run of escapes is decoded as a whole: %C3%A9 is one character.
URL = re.compile(_CHAIN + r"|(?:%(?!(?:25){3})[0-9A-Fa-f]{2})+")
ESCAPE = re.compile(_CHAIN + r"|\\u\{[0-9A-Fa-f]{1,6}\}|\\u[0-9A-Fa-f]{4}|\\U[0-9A-Fa-f]{8}|\\x[0-9A-Fa-f]{2}|&#[0-9]{1,7};|&#[xX][0-9A-Fa-f]{1,6};")
# One run, or wrapped lines.
BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?:(?:[A-Za-z0-9+/]{60,76}\r?\n)+[A-Za-z0-9+/]*={0,2}|[A-Za-z0-9+/_-]{16,}={0,2})")
_READABLE = re.compile(rb"[\t\n\r\x20-\x7e]{12,}")
_CONTROL = re.compile(rb"[\x00-\x08\x0e-\x1f\x7f]")
_URL_SAFE = bytes.maketrans(b"-_", b"+/")
#: Signs that a secret or an encoded run can hold; a cut is safe at any other.
_TOKEN = re.compile(r"""[A-Za-z0-9+/_.=%\\&#;:{}"'\x20-]+\Z""")

PIECE = 1 << 20
OVERLAP = 1 << 12

Span = tuple[str, int, int]


def matches(text: str) -> Iterator[Span]:
    for kind, (pattern, group, least) in KINDS.items():
        for m in pattern.finditer(text):
            if m.end(group) - m.start(group) >= least:
                yield kind, m.start(), m.end()


class Layer:
    """A text and where its characters come from: character i stands for the
    document's [starts[i], ends[i]). Both arrays are None in the document
    itself; a single place stands for every character of a compressed layer."""

    def __init__(self, text: str, starts=None, ends=None):
        self.text, self.starts, self.ends = text, starts, ends

    def place(self, lo: int, hi: int) -> tuple[int, int]:
        if self.starts is None:
            return lo, hi
        if isinstance(self.starts, int):
            return self.starts, self.ends
        return int(self.starts[lo]), int(self.ends[hi - 1])

    def inner(self, text: str, lo: np.ndarray, hi: np.ndarray) -> "Layer":
        """A layer whose characters stand for [lo, hi) of this one."""
        if self.starts is None:
            return Layer(text, lo, hi)
        if isinstance(self.starts, int):
            return Layer(text, self.starts, self.ends)
        return Layer(text, self.starts[lo], self.ends[hi - 1])

    def key(self):
        at = self.place(0, len(self.text)) if self.text else (0, 0)
        return hashlib.blake2b(self.text.encode("utf-8", "surrogatepass"), digest_size=16).digest(), at


def _character(escape: str) -> str | None:
    digits = escape.strip("\\uUx{}&#;X")
    code = int(digits, 16 if escape[0] == "\\" or escape[2] in "xX" else 10)
    return chr(code) if code < 0xD800 or 0xDFFF < code < 0x110000 else None


def _edges(data: bytes) -> np.ndarray:
    """The first byte of each character of UTF-8 ``data``, and its length."""
    raw = np.frombuffer(data, np.uint8)
    return np.append(np.flatnonzero((raw & 0xC0) != 0x80), len(raw))


def replaced(layer: Layer, pattern: re.Pattern, decode) -> Layer | None:
    """The layer with every run of escapes decoded, or None without one.
    ``decode`` gives (text, starts, ends) of a match, or None to keep it."""
    text, parts, lo, hi, done = layer.text, [], [], [], 0
    for m in pattern.finditer(text):
        got = decode(m)
        if got is None:
            continue
        parts += [text[done:m.start()], got[0]]
        own = np.arange(done, m.start())
        lo += [own, got[1]]
        hi += [own + 1, got[2]]
        done = m.end()
    if not parts:
        return None
    own = np.arange(done, len(text))
    return layer.inner("".join([*parts, text[done:]]), np.concatenate([*lo, own]), np.concatenate([*hi, own + 1]))


def _chain(m: re.Match):
    """The last layer of a chain: its sign, for the whole chain."""
    if m.lastindex is None:
        return None
    kept, n = m.group(m.lastindex), len(m.group(m.lastindex))
    return kept, np.full(n, m.start()), np.full(n, m.end())


def _url(m: re.Match):
    if got := _chain(m):
        return got
    data = unquote_to_bytes(m.group())
    try:
        part, edges = data.decode(), _edges(data)
    except UnicodeDecodeError:
        part, edges = data.decode("latin-1"), np.arange(len(data) + 1)
    return part, m.start() + 3 * edges[:-1], m.start() + 3 * edges[1:]


def _escape(m: re.Match):
    if got := _chain(m):
        return got
    c = _character(m.group())
    return None if c is None else (c, np.array([m.start()]), np.array([m.end()]))


def _text(data: bytes) -> str | None:
    """The bytes as text, if they read as text."""
    if _CONTROL.search(data):
        return None
    try:
        return data.decode()
    except UnicodeDecodeError:
        return None


def _unpacker(data: bytes):
    """A decompressor for bytes that begin like a compressed stream."""
    if data[:2] == b"\x1f\x8b":
        return zlib.decompressobj(31)
    if data[:1] == b"\x78" and len(data) > 1 and int.from_bytes(data[:2], "big") % 31 == 0:
        return zlib.decompressobj()
    if data[:3] == b"BZh":
        return bz2.BZ2Decompressor()
    if data[:6] == b"\xfd7zXZ\x00":
        return lzma.LZMADecompressor(memlimit=1 << 28)
    if data[:4] == b"\x28\xb5\x2f\xfd":
        return zstandard.ZstdDecompressor(max_window_size=1 << 27)
    return None


def unpacked(data: bytes, piece: int) -> Iterator[bytes]:
    """The content of a compressed stream in chunks of at most ``piece``
    bytes; what is damaged ends it."""
    how = _unpacker(data)
    if how is None:
        return
    try:
        if isinstance(how, zstandard.ZstdDecompressor):
            with how.stream_reader(data) as stream:
                while got := stream.read(piece):
                    yield got
            return
        got = how.decompress(data, piece)
        while got:
            yield got
            rest = how.unconsumed_tail if hasattr(how, "unconsumed_tail") else b""
            if how.eof:
                return
            got = how.decompress(rest, piece)
    except (zlib.error, OSError, EOFError, lzma.LZMAError, zstandard.ZstdError):
        return


def _pieces(data: bytes, piece: int, overlap: int) -> Iterator[str]:
    """The text of a compressed stream in pieces that hold whole secrets."""
    held, rest = "", b""
    for chunk in unpacked(data, piece):
        chunk = rest + chunk
        whole = len(chunk)
        for back in range(1, 4):        # a character may go on in the next chunk
            if len(chunk) >= back and chunk[-back] >= 0xC0:
                whole = len(chunk) - back
                break
        rest = chunk[whole:]
        held += chunk[:whole].decode("utf-8", "replace")
        if len(held) >= piece:
            tail = _TOKEN.search(held, max(0, len(held) - piece // 2))
            cut = tail.start() if tail else len(held)
            if cut > len(held) - piece // 2:
                yield held[:cut]
                held = held[cut:]
            else:
                yield held
                held = held[-overlap:]
    if held + rest.decode("utf-8", "replace"):
        yield held + rest.decode("utf-8", "replace")


def _base64(layer: Layer, signs: np.ndarray, piece: int, overlap: int) -> Iterator[Layer]:
    """Layers out of the base64 signs at these places. The encoded part may
    begin up to three signs late (``/`` or a letter in front of it), so four
    starts are tried."""
    run = "".join(layer.text[i:j] for i, j in _stretches(signs)).encode().translate(_URL_SAFE)
    for late in range(4):
        body = run[late:]
        body = body[:len(body) - (len(body) % 4 == 1)]
        if len(body) < 12:
            return
        try:
            data = base64.b64decode(body + b"=" * (-len(body) % 4))
        except (binascii.Error, ValueError):
            continue
        text = _text(data)
        if text is not None:
            yield _decoded(layer, signs, late, text, _edges(data))
            return
        if _unpacker(data) is not None:
            at, found = layer.place(int(signs[0]), int(signs[-1]) + 1), False
            for part in _pieces(data, piece, overlap):
                found = True
                yield Layer(part, *at)
            if found:
                return
        # other signs in front or behind: the readable stretches
        for m in _READABLE.finditer(data):
            yield _decoded(layer, signs, late, m.group().decode(), np.arange(m.start(), m.end() + 1))


def _decoded(layer: Layer, signs: np.ndarray, late: int, text: str, edges: np.ndarray) -> Layer:
    """A layer of decoded base64: a character with bytes [edges[i], edges[i + 1])
    comes from the signs that hold their bits."""
    return layer.inner(text, signs[late + edges[:-1] * 8 // 6], signs[late - 1 - (-edges[1:] * 8 // 6)] + 1)


def _stretches(places: np.ndarray):
    cut = np.flatnonzero(np.diff(places) != 1) + 1
    return [(int(p[0]), int(p[-1]) + 1) for p in np.split(places, cut)]


def _runs(layer: Layer, m: re.Match, piece: int, overlap: int) -> Iterator[Layer]:
    """A base64 run; wrapped lines as one run or, where they aren't one, each."""
    lines = [np.arange(m.start() + x.start(), m.start() + x.end()) for x in re.finditer("[^\r\n=]+", m.group())]
    found = False
    for inner in _base64(layer, np.concatenate(lines), piece, overlap):
        found = True
        yield inner
    if not found and len(lines) > 1:
        for line in lines:
            yield from _base64(layer, line, piece, overlap)


def unwrapped(layer: Layer, piece: int = PIECE, overlap: int = OVERLAP) -> Iterator[Layer]:
    """The layers directly inside a layer."""
    text = layer.text
    if "%" in text and (inner := replaced(layer, URL, _url)):
        yield inner
    if ("\\" in text or "&#" in text) and (inner := replaced(layer, ESCAPE, _escape)):
        yield inner
    for m in BASE64.finditer(text):
        yield from _runs(layer, m, piece, overlap)


def all_spans(text: str, base: list[Span], piece: int = PIECE, overlap: int = OVERLAP) -> set[Span]:
    """Spans of the secrets in all layers of a text, its own ones (``base``)
    included.
    The worklist goes depth first and holds iterators, so the pieces of a
    compressed layer are unpacked one at a time."""
    first = Layer(text)
    spans, seen, work = set(base), set(), [unwrapped(first, piece, overlap)]
    while work:
        layer = next(work[-1], None)
        if layer is None:
            work.pop()
            continue
        if not layer.text or (key := layer.key()) in seen:
            continue
        seen.add(key)
        spans.update((kind, *layer.place(lo, hi)) for kind, lo, hi in matches(layer.text))
        work.append(unwrapped(layer, piece, overlap))
    return spans


_ORDER = {kind: i for i, kind in enumerate(KINDS)}


def listed(spans) -> str:
    """kind:start:end by start, then kind as listed, then end."""
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], _ORDER[s[0]], s[2])))


_FOUND = T.StructType([T.StructField(f"n_{k}", T.LongType()) for k in KINDS]
                      + [T.StructField(c, T.StringType()) for c in ("base_sha256", "spans")])


@F.pandas_udf(_FOUND)
def found_secrets(texts: pd.Series) -> pd.DataFrame:
    rows = []
    for text in texts:
        base = list(matches(text or ""))
        rows.append((*(sum(s[0] == k for s in base) for k in KINDS), hashlib.sha256(listed(base).encode()).hexdigest(), listed(all_spans(text or "", base))))
    return pd.DataFrame(rows, columns=_FOUND.names)


def scan(docs: DataFrame) -> DataFrame:
    """doc_id and the secrets of each text."""
    prepare(docs.sparkSession)
    return docs.select("doc_id", found_secrets("text").alias("_found")).select("doc_id", "_found.*")
