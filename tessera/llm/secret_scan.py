"""Secret scans with structural confirmation.

Pattern kinds (``assign``, ``access``, ``hex``) are reported as they match.
Two further kinds are reported only after their bytes have been decoded and
their structure checked:

* ``key``: base64 or hex text that decodes to a private key: DER whose nested
  lengths fill their parents exactly and whose fields are those of an RSA, EC or
  wrapped (PKCS#8) key, or the length-prefixed strings of an ``openssh-key-v1``
  container.  Decoding is tried wherever such a header can begin, inside runs
  too, and goes on over line breaks (also escaped ones), indentation, quotes
  and line prefixes until the header's length is reached.  An armoured block
  with a key inside is reported as a whole;
* ``token``: three base64url parts whose first decodes to a JSON object that
  names a signing algorithm, and whose second decodes to a JSON object.  Parts
  before them do not matter, and the first may begin inside its run.

Patterns run over the UTF-8 bytes (all are ASCII); offsets are code points, end
exclusive.  Null and empty texts have no spans.  Ties (same start) are ordered
by kind as in ``KINDS``.  Every input row gives one output row, repeated rows
too; other input columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import slices, text_bytes

KINDS = ("assign", "access", "hex", "key", "token")
#: Words of which one is in every ``assign`` match; without them the pattern is not run.
_NAMES = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
_ASSIGN = re.compile(rb"""(?:(?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
_HEX = re.compile(rb"[0-9a-f]{24,}")
_LONG_HEX = re.compile(rb"[0-9a-fA-F]{64,}")
_BASE64 = re.compile(rb"[A-Za-z0-9+/_-]{40,}={0,2}")
_ARMOUR = re.compile(rb"-----BEGIN ([A-Z0-9 ]{0,40}PRIVATE KEY)-----")
_EDGE = re.compile(rb"-----(?:BEGIN|END)")
_TOKEN = re.compile(rb"(?<![A-Za-z0-9_-])([A-Za-z0-9_-]{8,}+)\.([A-Za-z0-9_-]{2,}+)\.([A-Za-z0-9_-]{16,}+)")
_TOKEN_HEAD = re.compile(rb"e[wy]")  # { before white space or a quote
_B = rb"[A-Za-z0-9+/_-]"
#: Base64 of 0x30, a length (short, or of 1 to 4 bytes) and an integer's tag; the container's name.
_BASE64_HEAD = re.compile(
    rb"M(?:[A-H][AEIMQUYcgkosw048]C|I(?:[E-H]B{1}A[g-v]|[I-L]B{2}[AQgw][I-L]|[M-P]B{3}[AEIMQUYcgkosw048]C|[Q-T]B{5}A[g-v]))"
    .replace(b"B{", _B + b"{"))
_BASE64_SSH = re.compile(rb"b3BlbnNzaC1rZXktdjE")
#: What may stand between two digits of a key in hex.
_GAP = rb"(?:[\s:,;\"'-]|\\+[nrt]|\\+x|0[xX](?=[0-9a-fA-F]))*+"
_HEX_HEAD = re.compile(rb"30G(?:[0-7]H|81GHHG|82GHHGHHG|83GHHGHHGHHG|84GHHGHHGHHGHHG)G02"
                       .replace(b"HH", b"H[0-9a-fA-F]").replace(b"H", b"[0-9a-fA-F]").replace(b"G", _GAP))
_HEX_SSH = re.compile(_GAP.join(b"%02x" % c for c in b"openssh-key-v1\0"), re.IGNORECASE)
_DIGITS = rb"(?P<run>[A-Za-z0-9+/_-]{1,1024})|(?:\\+u00|%)(?P<code>2[bBfFdD])|\\+(?P<slash>/)"
_BREAK = rb"(?:\r?\n|\r|\\+[nrt]|\\+u000[aAdD]|%0[aAdD]|&\#(?:1[03]|[xX][aAdD]);|<br\x20?/?>)"
_DRESS = rb"""[\x20\t]*+(?:["'`][\x20\t]*+[+.,&\\]?|\\(?=[\r\n]))?[\x20\t]*+"""
#: Digits of a key in base64 or their escapes (groups), or a line's end and the next one's indentation, quote and prefix; the
#: second form also drops the marks of changed or commented lines, which are digits as well.
_PIECES = [re.compile(_DIGITS + b"|(?:" + _DRESS + _BREAK + rb")+[\x20\t]*+(?:[>\#*|]+[\x20\t]*+)?" + mark + rb"""["'`]?""")
           for mark in (b"", rb"(?:[+-]|//)?[\x20\t]*+")]
#: The same inside an armoured block, whose end is known: blanks and quotes alone may also part digits.
_BODY_PIECES = [re.compile(p.pattern + rb"""|["'`][\x20\t]*+[+.,&\\]?[\x20\t]*+["'`]|\\+["'`]|[\s"'`,;>\#*|]""") for p in _PIECES]
_HEX_PIECES = [re.compile(rb"0[xX](?=[0-9a-fA-F]{2}(?![0-9a-fA-F]))|(?P<run>[0-9a-fA-F]{2})|[\s:,;\"'-]+|\\+[nrtx]")]
#: Least digits of a key.
_LEAST_BASE64, _LEAST_HEX = 40, 64
#: Most bytes of a container's first three strings; digits that its strings' check looks at.
_LONGEST_NAME, _LOOKED_AT = 1024, 1 << 13
_INTEGER, _OCTETS, _OID, _SEQUENCE = 0x02, 0x04, 0x06, 0x30


def _fields(data: bytes) -> list[tuple[int, bytes]] | None:
    """(tag, value) of consecutive DER elements that fill ``data`` exactly, else None."""
    out, at = [], 0
    while at < len(data):
        if at + 2 > len(data):
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > len(data):
                return None
            size = int.from_bytes(data[at:at + n], "big")
            at += n
        if at + size > len(data):
            return None
        out.append((tag, data[at:at + size]))
        at += size
    return out


def is_der_key(data: bytes) -> bool:
    """Whether ``data`` is one DER sequence with the fields of a private key."""
    if data[:1] != bytes([_SEQUENCE]):
        return False
    outer = _fields(data)
    if outer is None or len(outer) != 1:
        return False
    inner = _fields(outer[0][1])
    if not inner or inner[0][0] != _INTEGER:
        return False
    tags = [t for t, _ in inner]
    if len(tags) >= 9 and tags[:9] == [_INTEGER] * 9:
        return len(inner[1][1]) >= 32
    if len(tags) >= 2 and tags[1] == _OCTETS:
        return len(inner[1][1]) >= 16
    if len(tags) >= 3 and tags[1:3] == [_SEQUENCE, _OCTETS]:
        algorithm = _fields(inner[1][1])
        return bool(algorithm) and algorithm[0][0] == _OID and len(inner[2][1]) >= 16
    return False


def is_openssh_key(data: bytes) -> bool:
    """Whether ``data`` is an openssh-key-v1 container whose three strings and key count fit."""
    if not data.startswith(b"openssh-key-v1\0"):
        return False
    at = 15
    for _ in range(3):
        if at + 4 > len(data):
            return False
        at += 4 + int.from_bytes(data[at:at + 4], "big")
    return at + 4 <= len(data) and 1 <= int.from_bytes(data[at:at + 4], "big") <= 64


def _decoded(run: bytes) -> bytes:
    body = run.rstrip(b"=").translate(bytes.maketrans(b"-_", b"+/"), b" \t\r\n")
    try:
        return base64.b64decode(body + b"=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return b""


class _Reader:
    """Bytes of base64 or hex digits of a text from ``start`` to ``stop``, over what may stand between the digits."""

    def __init__(self, text: bytes, start: int, stop: int, piece: re.Pattern, hexadecimal: bool, armoured: bool):
        self.text, self.at, self.stop, self.piece = text, start, stop, piece
        self.hexadecimal, self.armoured = hexadecimal, armoured
        self.digits, self.runs, self.lines = 0, [], [0]

    def need(self, n: int) -> int:
        """Digits of n bytes."""
        return 2 * n if self.hexadecimal else n + -(-n // 3)

    def first(self, n: int) -> bytes | None:
        """The first n bytes, None if there are fewer; ``at`` is then the end of their digits or beyond."""
        need = self.need(n)
        if need - self.digits > self.stop - self.at:
            return None
        while self.digits < need:
            m = self.piece.match(self.text, self.at, self.stop)
            if m is None or not m[0]:
                return None
            kind = m.lastgroup
            if kind is None:
                self.at = m.end()
                self.lines.append(0)
                continue
            if kind == "run":
                run = m[0][:need - self.digits]
                self.at += len(run)
            else:
                run = b"/" if kind == "slash" else bytes([int(m["code"], 16)])
                self.at = m.end()
            self.runs.append(run)
            self.digits += len(run)
            self.lines[-1] += len(run)
        body = b"".join(self.runs)[:need]
        if self.hexadecimal:
            return bytes.fromhex(body.decode())
        body = body.translate(bytes.maketrans(b"-_", b"+/"))
        try:
            return base64.b64decode(body + b"A" * (-len(body) % 4), validate=True)[:n]
        except (binascii.Error, ValueError):
            return None

    def end(self, n: int) -> int | None:
        """End in the text of n bytes that were read last, with their padding.

        None if the lines do not look like one key: outside armour, whole
        lines of one width between the first and the last, so that a key that
        was cut off is not completed from what follows it.
        """
        at = self.at
        for _ in range(0 if self.hexadecimal else -n % 3):
            at += self.text[at:min(at + 1, self.stop)] == b"="
        if len(self.lines) > 1 and not self.armoured:
            more = self.piece.match(self.text, self.at, self.stop)
            if more and more.lastgroup and not self.text.startswith(b"-----", self.at):
                return None
            if not self.hexadecimal and (len(set(self.lines[1:-1])) > 1 or len(self.lines) > 2 and self.lines[-1] > self.lines[-2]):
                return None
        return at


def _der_at(reader: _Reader) -> int | None:
    """End in the text of the DER key at a header."""
    head = reader.first(16)
    if head is None:
        return None
    n = head[1] & 0x7F if head[1] & 0x80 else 0
    size = 2 + n + (int.from_bytes(head[2:2 + n], "big") if n else head[1])
    second = 4 + n + head[3 + n]
    if second < 16 and not head[3 + n] & 0x80 and head[second] not in (_INTEGER, _OCTETS, _SEQUENCE):
        return None
    if reader.need(size) < (_LEAST_HEX if reader.hexadecimal else _LEAST_BASE64):
        return None
    if not _fields_follow(reader, 2 + n, size):
        return None
    data = reader.first(size)
    return reader.end(size) if data is not None and is_der_key(data) else None


def _fields_follow(reader: _Reader, at: int, size: int) -> bool:
    """Whether the first fields below a header can be a key's, read one header at a time.

    A run of headers without keys is left after the few bytes that its first wrong field takes.
    """
    tags: list[int] = []
    while at < size and len(tags) < 9:
        head = reader.first(min(at + 6, size))
        if head is None or len(head) < at + 2:
            return False
        tag, length, more = head[at], head[at + 1], 0
        if length & 0x80:
            more = length & 0x7F
            if not 1 <= more <= 4 or len(head) < at + 2 + more:
                return False
            length = int.from_bytes(head[at + 2:at + 2 + more], "big")
        tags.append(tag)
        at += 2 + more + length
        if at > size or tags[0] != _INTEGER:
            return False
        if len(tags) == 2 and tag == _OCTETS or len(tags) == 3 and tags[1] == _SEQUENCE:
            return tag == _OCTETS
        if len(tags) >= 2 and tag not in ((_INTEGER, _SEQUENCE) if len(tags) == 2 else (_INTEGER,)):
            return False
    return len(tags) == 9


def _openssh_at(reader: _Reader) -> int | None:
    """End in the text of the whole container at its name."""
    at, size = 15, 0
    for more in (3, 1):
        if more == 1:
            data = reader.first(at + 4)
            more = int.from_bytes(data[at:], "big") + 1 if data else 0
            if not 2 <= more <= 65:
                return None
            at += 4
        for _ in range(more):
            data = reader.first(at + 4)
            if data is None:
                return None
            size = int.from_bytes(data[at:], "big")
            if more == 3 and size > _LONGEST_NAME:  # names of a cipher and a function, and the latter's options
                return None
            at += 4 + size
    data = reader.first(at) if size else None  # the private part is never empty
    return reader.end(at) if data is not None and is_openssh_key(data) else None


def _run_at(text: bytes, start: int, hexadecimal: bool, ends: dict[bool, int]) -> int | None:
    """End of the unbroken run at a container's name, if its strings fit, whatever follows them.

    ``ends`` keeps the end of the last run, so that a run is walked once however many names it holds.
    """
    if ends.get(hexadecimal, 0) <= start:
        m = (_LONG_HEX if hexadecimal else _BASE64).match(text, start)
        if m is None:
            return None
        ends[hexadecimal] = m.end()
    stop = ends[hexadecimal]
    if stop - start < (_LEAST_HEX if hexadecimal else _LEAST_BASE64):
        return None
    size = stop - start & ~1 if hexadecimal else stop - start
    part = text[start:start + min(size, _LOOKED_AT)]
    return start + size if is_openssh_key(bytes.fromhex(part.decode()) if hexadecimal else _decoded(part)) else None


def _keys(text: bytes, start: int, stop: int, armoured: bool) -> list[tuple[int, int]]:
    """(start, end) of the keys at every header between ``start`` and ``stop``."""
    out, ends = [], {}
    pieces = _BODY_PIECES if armoured else _PIECES
    for head, check, forms, hexadecimal in ((_BASE64_HEAD, _der_at, pieces, False), (_BASE64_SSH, _openssh_at, pieces, False),
                                            (_HEX_HEAD, _der_at, _HEX_PIECES, True), (_HEX_SSH, _openssh_at, _HEX_PIECES, True)):
        m = head.search(text, start, stop)
        while m:
            at = m.start()
            end = next((e for p in forms if (e := check(_Reader(text, at, stop, p, hexadecimal, armoured)))), None)
            if end is None and check is _openssh_at:
                end = _run_at(text, at, hexadecimal, ends)
            if end is not None:
                out.append((at, end))
            m = head.search(text, end or at + 1, stop)
    return out


def _armoured(text: bytes) -> list[tuple[int, int]]:
    """Armoured blocks with a key inside."""
    out = []
    for m in _ARMOUR.finditer(text):
        edge = _EDGE.search(text, m.end())
        last = b"-----END " + m[1] + b"-----"
        if edge and text.startswith(last, edge.start()) and _keys(text, m.end(), edge.start(), True):
            out.append((m.start(), edge.start() + len(last)))
    return out


_JSON = json.JSONDecoder()


def _json_object(part: bytes) -> dict | None:
    try:
        value = json.loads(_decoded(part))
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def _token_start(part: bytes) -> int | None:
    """Where in ``part`` a header begins that names a signing algorithm and ends with the part.

    The part is decoded once for each of the four ways in which its digits can be grouped.
    """
    decoded: dict[int, str] = {}
    for m in _TOKEN_HEAD.finditer(part):
        at = m.start()
        if len(part) - at < 8 or (len(part) - at) % 4 == 1:
            continue
        if at % 4 not in decoded:
            decoded[at % 4] = _decoded(part[at % 4:]).decode("latin-1")  # a character a byte
        text = decoded[at % 4]
        try:
            value, end = _JSON.raw_decode(text, at // 4 * 3)
        except (ValueError, RecursionError):
            continue
        if isinstance(value, dict) and "alg" in value and not text[end:].strip(" \t\n\r"):
            header = _json_object(part[at:])  # once more as UTF-8
            if header is not None and isinstance(header.get("alg"), str):
                return at
    return None


def byte_spans(text: bytes) -> list[tuple[int, int, int]]:
    """(start, kind, end) in bytes, in order."""
    found = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[1]) >= 6]
    if b"AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    keys = _keys(text, 0, len(text), False)
    if b"PRIVATE KEY-----" in text:
        keys += _armoured(text)
    end = 0
    for start, stop in sorted(keys, key=lambda s: (s[0], -s[1])):  # a key inside an armoured block is part of it
        if start >= end:
            found.append((start, 3, stop))
            end = stop
    if b"." in text and (b"ey" in text or b"ew" in text):
        m = _TOKEN.search(text)
        while m:
            start = _token_start(m[1]) if _json_object(m[2]) is not None else None
            if start is not None:
                found.append((m.start() + start, 4, m.end()))
            m = _TOKEN.search(text, m.start(2) if start is None else m.end())
    return sorted(found)


def spans(text: bytes) -> list[dict]:
    """Spans of one text by start and kind, in code points."""
    found = byte_spans(text)
    if not found:
        return []
    if not text.isascii():
        cuts = sorted({p for s, _, e in found for p in (s, e)})
        points, at, n = {}, 0, 0
        for p in cuts:
            n += len(text[at:p].decode("utf-8"))
            at, points[p] = p, n
        found = [(points[s], k, points[e]) for s, k, e in found]
    return [{"kind": KINDS[k], "start": s, "end": e} for s, k, e in found]


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        found = [spans(t) for t in text_bytes(batch.column("text"))]
        yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(found, _SPANS)], ["id", "spans"])


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<kind, start, end>>) for every row."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    return (rows.mapInArrow(_scan, f"id {kind}, spans array<struct<kind string, start bigint, end bigint>>")
            .select(F.col("id").alias(id_col), "spans"))


def joined(spans_col: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans_col, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
