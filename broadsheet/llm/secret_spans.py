"""Where texts hold secrets: plain patterns, and candidates confirmed by their structure.

The patterns report assignments, access keys and long hex runs. Encoded candidates are reported
only if they decode and parse: private keys in DER, whose nested lengths must agree to the byte;
``openssh-key-v1`` blobs, whose fields must end where the blob ends; signed tokens, whose header
and payload must be JSON objects and whose signature must have the length of its algorithm.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from broadsheet.llm.common import text_of

# Kinds of the plain patterns, then of the confirmed candidates, in the order in which spans
# that start together are listed.
BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "der", "openssh", "jwt")

_NAMES = ("password", "passwd", "secret", "token", "api_key", "apikey")
_EITHER = "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
_ASSIGN = re.compile(rf"""({_EITHER})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")

# No key's encoding is longer (16,384-bit RSA takes about 9,300 bytes).
LONGEST_KEY = 1 << 16
_MAGIC = b"openssh-key-v1\0"
# DER starts with 0x30, an SSH blob with its magic; either may stand in hex.
_B64_START = re.compile(r"(?<![A-Za-z0-9+/_-])(?=M[A-P][A-Za-z0-9+/_-]{10}|b3BlbnNzaC1rZXktdjEA)")
_HEX_START = re.compile(r"(?<![0-9A-Fa-f])(?=30[0-9A-Fa-f]{22}|6[fF]70656[eE]7373682[dD]6[bB]65792[dD]763100)")
# Between the characters of a candidate: white space, also as escaped in a string.
_B64_RUN = re.compile(r"[A-Za-z0-9+/_-]+")
_HEX_RUN = re.compile(r"[0-9A-Fa-f]+")
_GAP = re.compile(r"(?:\s|\\[nrt]){1,8}")
# A header's first byte is "{", so its text starts with an e and one of these.
_TOKEN = re.compile(r"(?<![A-Za-z0-9_-])e[w-z0-9_-][A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
# Bytes of a signature by algorithm. RSA signatures are as long as the key.
_SIGNED = {"HS256": (32,), "HS384": (48,), "HS512": (64,), "ES256": (64,), "ES256K": (64,), "ES384": (96,), "ES512": (132,), "EdDSA": (64, 114)}
_RSA = ("RS256", "RS384", "RS512", "PS256", "PS384", "PS512")


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the plain patterns that are long enough, per kind leftmost and disjoint."""
    found = []
    lowered = text.lower()
    if any(name in lowered for name in _NAMES):
        # a match that is too short still uses up its text
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    return found + [("hex", *m.span()) for m in _HEX.finditer(text)]


def _element(data: bytes, at: int, end: int) -> tuple[int, int, int] | None:
    """``(tag, start, end)`` of the contents of the DER element at ``at``, if within ``end``."""
    if at + 2 > end:
        return None
    tag, size = data[at], data[at + 1]
    at += 2
    if size >= 0x80:
        n = size & 0x7F
        if not 1 <= n <= 4 or at + n > end:
            return None
        size = int.from_bytes(data[at : at + n], "big")
        if size < 0x80 or data[at] == 0:  # lengths are as short as can be
            return None
        at += n
    return (tag, at, at + size) if at + size <= end else None


def _children(data: bytes, start: int, end: int) -> list[tuple[int, int, int]] | None:
    """The elements that fill ``start`` to ``end`` exactly."""
    found = []
    while start < end:
        one = _element(data, start, end)
        if one is None:
            return None
        found.append(one)
        start = one[2]
    return found


def _algorithm(data: bytes, element: tuple[int, int, int]) -> bool:
    """A sequence that starts with an object identifier."""
    parts = _children(data, *element[1:]) if element[0] == 0x30 else None
    return bool(parts) and parts[0][0] == 0x06 and parts[0][2] > parts[0][1]


def is_private_key(data: bytes) -> bool:
    """DER of a private key: PKCS#1, DSA, SEC 1, PKCS#8 plain or encrypted."""
    outer = _element(data, 0, len(data))
    if outer is None or outer[0] != 0x30 or outer[2] != len(data):
        return False
    parts = _children(data, *outer[1:])
    if not parts:
        return False
    tags = [p[0] for p in parts]
    first = data[parts[0][1] : parts[0][2]]
    if tags[0] == 0x02 and first in (b"\0", b"\1"):
        if len(parts) in (6, 9, 10) and set(tags[1:9]) == {0x02}:
            return all(p[2] > p[1] for p in parts[1:])
        if first == b"\1" and tags[1:2] == [0x04] and set(tags[2:]) <= {0xA0, 0xA1}:
            return 16 <= parts[1][2] - parts[1][1] <= 72
        return tags[1:3] == [0x30, 0x04] and _algorithm(data, parts[1]) and parts[2][2] - parts[2][1] >= 16
    return tags == [0x30, 0x04] and _algorithm(data, parts[0]) and parts[1][2] - parts[1][1] >= 16


def ssh_key_length(data: bytes) -> int | None:
    """Bytes of the ``openssh-key-v1`` blob at the start of ``data``, if its fields are whole."""
    if not data.startswith(_MAGIC):
        return None
    at, fields = len(_MAGIC), []

    def take() -> bytes | None:
        nonlocal at
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data) or len(data) < at + 4:
            return None
        at += 4 + size
        return data[at - size : at]

    for _ in range(3):  # cipher, key derivation and its options
        fields.append(take())
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if None in fields or not fields[0] or not 1 <= keys <= 16:
        return None
    parts = [take() for _ in range(keys + 1)]
    if any(not p for p in parts):
        return None
    name = int.from_bytes(parts[0][:4], "big")
    secret = parts[-1]
    plain = fields[0] == b"none" and secret[:4] != secret[4:8]  # two equal check numbers
    return None if plain or not 0 < name < len(parts[0]) - 4 or len(secret) < 16 else at


def _gathered(text: str, at: int, run: re.Pattern, characters: int) -> tuple[str, int] | None:
    """So many characters from ``at`` on, white space left out, and where they end."""
    parts, have = [], 0
    while True:
        m = run.match(text, at, at + characters - have)
        if not m:
            return None
        parts.append(m[0])
        have, at = have + len(m[0]), m.end()
        if have == characters:
            return "".join(parts), at
        gap = _GAP.match(text, at)
        if not gap:
            return None
        at = gap.end()


def _decoded(code: str, is_hex: bool) -> bytes | None:
    if is_hex:
        return bytes.fromhex(code)
    code = code.translate({45: 43, 95: 47})
    if len(code) % 4 == 1:
        return None
    return base64.b64decode(code + "=" * (-len(code) % 4))


def _keys(text: str, start: re.Pattern, run: re.Pattern, is_hex: bool) -> Iterator[tuple[str, int, int]]:
    def characters(size: int) -> int:
        return 2 * size if is_hex else -(-4 * size // 3)

    def read(at: int, size: int) -> tuple[bytes, int] | None:
        found = _gathered(text, at, run, characters(size))
        data = found and _decoded(found[0], is_hex)
        return (data, found[1]) if data else None

    done = 0
    for m in start.finditer(text):
        at = m.start()
        if at < done:
            continue
        kind, end = None, at
        if text[at] in "bB6":
            whole = None
            size = 256
            while whole is None and size <= LONGEST_KEY:  # the fields tell the length as they come
                part = _prefix(text, at, run, characters(size))
                spare = len(part) % 2 if is_hex else len(part) % 4 == 1
                length = ssh_key_length(_decoded(part[: len(part) - spare], is_hex) or b"")
                if length:
                    whole = read(at, length)
                if len(part) < characters(size):
                    break
                size *= 2
            if whole:
                kind, end = "openssh", whole[1]
        else:
            head = read(at, 8)
            outer = head and _element(head[0] + b"\0" * LONGEST_KEY, 0, LONGEST_KEY + len(head[0]))
            # what follows is the version or an algorithm
            if outer and outer[2] <= LONGEST_KEY and head[0][outer[1] : outer[1] + 1] in (b"\x02", b"\x30"):
                whole = read(at, outer[2])
                if whole and is_private_key(whole[0][: outer[2]]):
                    kind, end = "der", whole[1]
        if kind:
            if not is_hex:
                while end < len(text) and text[end] == "=":
                    end += 1
            done = end
            yield kind, at, end


def _prefix(text: str, at: int, run: re.Pattern, characters: int) -> str:
    """Up to so many characters from ``at`` on."""
    parts, have = [], 0
    while have < characters and (m := run.match(text, at, at + characters - have)):
        parts.append(m[0])
        have += len(m[0])
        gap = _GAP.match(text, m.end())
        at = gap.end() if gap else m.end()
        if not gap:
            break
    return "".join(parts)


def _json(part: str) -> dict | None:
    try:
        value = json.loads(_decoded(part, False) or b"")
    except (ValueError, RecursionError):
        return None
    return value if isinstance(value, dict) else None


def is_signed_token(text: str) -> bool:
    """Header and payload are JSON objects; the signature fits the header's algorithm."""
    head, body, signature = text.split(".")
    header = _json(head)
    algorithm = header.get("alg") if header else None
    if not isinstance(algorithm, str) or _json(body) is None:
        return False
    size = len(signature) * 3 // 4
    if algorithm.lower() == "none":
        return not signature
    if algorithm in _RSA:
        return size >= 128
    return size in _SIGNED.get(algorithm, ()) and len(signature) % 4 != 1


def confirmed_spans(text: str) -> list[tuple[str, int, int]]:
    """Encoded keys and signed tokens that parse."""
    found = [*_keys(text, _B64_START, _B64_RUN, False), *_keys(text, _HEX_START, _HEX_RUN, True)]
    return found + [("jwt", *m.span()) for m in _TOKEN.finditer(text) if is_signed_token(m[0])]


def spans_of(text: str) -> list[tuple[str, int, int]]:
    """All spans by start, then kind as listed, then end."""
    return sorted({*base_spans(text), *confirmed_spans(text)}, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def _line(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    types = [pa.int64()] * 3 + [pa.string()] * 2
    for batch in batches:
        rows = []
        for text in batch.column("text"):
            spans = spans_of(text.as_py())
            base = [s for s in spans if s[0] in BASE_KINDS]
            counts = [sum(s[0] == kind for s in base) for kind in BASE_KINDS]
            rows.append((*counts, hashlib.sha256(_line(base).encode()).hexdigest(), _line(spans)))
        columns = [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names=["doc_id", *names])


def find_secrets(docs: DataFrame) -> DataFrame:
    """``(doc_id, n_assign, n_access, n_hex, base_sha256, spans)``, one row per input row.

    Spans are ``kind:start:end`` in code points, end exclusive, joined by commas. ``assign``,
    ``access`` and ``hex`` are matches of the plain patterns; ``der``, ``openssh`` and ``jwt`` are
    confirmed by their structure and may overlap them. ``base_sha256`` is of the plain ones.

    Null counts as empty and an empty text has no spans. Texts are scanned whole, whatever
    their length. Repeated rows and ids give repeated rows, an empty table an empty one; other
    columns are not read.
    """
    schema = docs.select("doc_id").schema
    for name in ("n_assign", "n_access", "n_hex"):
        schema = schema.add(name, "long")
    schema = schema.add("base_sha256", "string").add("spans", "string")
    return docs.select("doc_id", text_of().alias("text")).mapInArrow(_scan, schema)
