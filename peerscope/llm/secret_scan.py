"""Secret scans with structural confirmation.

Three plain kinds are matched by pattern.  Two further kinds are reported only
after their bytes have been decoded and parsed:

* ``der``: a key encoding by nested lengths.  Base64 or hex that decodes to an
  ASN.1 SEQUENCE whose nested elements (at least two) tile it; base64 is read
  from the start of a run on a line, over line ends (escaped ones and before
  indented lines too), for exactly as many characters as the SEQUENCE's length
  states, and must end there; hex digits from any ``30``, over colons, blanks
  and line ends, for exactly as many as it states.  Also the
  length-prefixed ssh formats: a public key (``ssh-rsa AAAA...``: its fields
  tile the run) and an ``openssh-key-v1`` file (its lengths state its end);
* ``jwt``: ``header.payload[.signature]`` whose header decodes from base64url
  to a JSON object (white space after its brace or not) with an ``alg`` member
  and whose payload is a JSON object.

One narrow pass per text, no shuffle.  A null text is empty; rows are kept as
they come (repeated rows give repeated results, a null id stays null); other
columns are not read.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# fixed values: the kinds in their reporting order
KINDS = ("assign", "access", "hex", "der", "jwt")
BASE_KINDS = KINDS[:3]

_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.IGNORECASE | re.ASCII
)
# a maximal run shorter than the least length can hold no reported match, so the bound may stand in the pattern
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
# a SEQUENCE tag, 0x30, gives M and a letter to P; the length of an ssh name AAAA; the name openssh-key-v1 b3BlbnNzaC1rZXktdjEA
# the letter n of an escaped line feed may stand before it
_BASE64_START = re.compile(r"(?:(?<![A-Za-z0-9+/])|(?<=\\n))(?:M[A-P]|AAAA|b3BlbnNzaC1rZXktdjEA)[A-Za-z0-9+/]{6,}")
_BASE64_LINE = re.compile(r"[A-Za-z0-9+/]+")
# line ends inside an encoding, as they are or escaped, before a line that may be indented
_LINE_END = re.compile(r"(?:\r?\n|(?:\\r)?\\n)[ \t]*(?=[A-Za-z0-9+/])")
_SSH_MAGIC = b"openssh-key-v1\0"
_SSH_NAME = re.compile(rb"(?:ssh|ecdsa-sha2|sk-ssh|sk-ecdsa-sha2)-[a-z0-9@.-]+")
_HEX_GAP = r"(?::?(?:\r?\n|(?:\\r)?\\n)[ \t]*|:|[ \t]+)"
_HEX_START = re.compile(rf"30(?={_HEX_GAP}?[0-9a-fA-F])")
_HEX_LINE = re.compile(r"[0-9a-fA-F]+")
_HEX_NEXT = re.compile(rf"{_HEX_GAP}(?=[0-9a-fA-F])")
# a header begins with a brace and a quote, or with a brace and a blank, tab or line end
_JWT = re.compile(r"(?:eyJ|(?:(?<![A-Za-z0-9_-])|(?<=\\n))e(?:y[ABI]|w[klop01]))[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+(?:\.[A-Za-z0-9_-]*)?")


def _element(data: bytes, at: int) -> tuple[int, int] | None:
    """Start and end of the content of the DER element at ``at``, if its length is well formed."""
    if at + 2 > len(data):
        return None
    n, body = data[at + 1], at + 2
    if n >= 0x80:
        width = n & 0x7F
        if not 1 <= width <= 4 or body + width > len(data):
            return None
        n, body = int.from_bytes(data[body : body + width], "big"), body + width
    return (body, body + n) if body + n <= len(data) else None


def is_key_encoding(data: bytes) -> bool:
    """A DER SEQUENCE that fills ``data`` and whose elements, two or more, fill it in turn."""
    if len(data) < 16 or data[0] != 0x30:
        return False
    outer = _element(data, 0)
    if outer is None or outer[1] != len(data):
        return False
    at, n = outer[0], 0
    while at < outer[1]:
        if data[at] not in (0x02, 0x03, 0x04, 0x05, 0x06, 0x30, 0x31, 0xA0, 0xA1):
            return False
        inner = _element(data, at)
        if inner is None:
            return False
        at, n = inner[1], n + 1
    return n >= 2


def _base64(text: str, alphabet: bytes | None = None) -> bytes | None:
    text = re.sub(r"\s", "", text).rstrip("=")
    if len(text) % 4 == 1:
        return None
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), altchars=alphabet, validate=True)
    except (binascii.Error, ValueError):
        return None


def _strings(data: bytes, at: int, most: int) -> tuple[int, list[bytes]] | None:
    """End and values of up to ``most`` ssh strings (a 4-byte length, then as many bytes) from ``at``."""
    out = []
    while at < len(data) and len(out) < most:
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + n > len(data):
            return None
        out.append(data[at + 4 : at + 4 + n])
        at += 4 + n
    return at, out


def is_ssh_public_key(data: bytes) -> bool:
    """Two ssh strings or more, the first a key type's name, that fill ``data``."""
    found = _strings(data, 0, 16)
    return found is not None and found[0] == len(data) and len(found[1]) >= 2 and bool(_SSH_NAME.fullmatch(found[1][0]))


def _ssh_file_end(data: bytes) -> int | None:
    """Where an openssh-key-v1 file at the beginning of ``data`` ends by its lengths."""
    if not data.startswith(_SSH_MAGIC):
        return None
    head = _strings(data, len(_SSH_MAGIC), 3)  # cipher, key derivation and its options
    if head is None or len(head[1]) < 3:
        return None
    n = int.from_bytes(data[head[0] : head[0] + 4], "big")
    keys = _strings(data, head[0] + 4, n + 1)  # n public keys and the private part
    if not 1 <= n < len(data) or keys is None or len(keys[1]) < n + 1 or not all(is_ssh_public_key(k) for k in keys[1][:n]):
        return None
    return keys[0]


def _run(text: str, at: int, most: int, line: re.Pattern = _BASE64_LINE, gap: re.Pattern = _LINE_END) -> tuple[str, int]:
    """Up to ``most`` characters of an alphabet (base64) from ``at`` on, over gaps (line ends), and where they end."""
    parts, n = [], 0
    while m := line.match(text, at, min(len(text), at + most - n)):
        parts.append(m.group())
        n, at = n + len(parts[-1]), m.end()
        if n == most or not (m := gap.match(text, at)):
            break
        at = m.end()
    return "".join(parts), at


def _stated(head: bytes) -> int | None:
    """Size of the SEQUENCE that begins so, by its length."""
    width = head[1] & 0x7F if len(head) > 1 and head[1] >= 0x80 else 0
    if len(head) < 2 + width or head[0] != 0x30 or width > 4 or head[1] == 0x80:
        return None
    return 2 + width + int.from_bytes(head[2 : 2 + width], "big") if width else 2 + head[1]


def _hex_key(text: str, at: int) -> int | None:
    """End of the key encoding whose hex digits begin at ``at``, if there is one: as many digits as its length states."""
    head = _run(text, at, 12, _HEX_LINE, _HEX_NEXT)[0]
    size = _stated(bytes.fromhex(head[: len(head) // 2 * 2]))
    if size is None or 2 * size > len(text) - at:
        return None
    digits, end = _run(text, at, 2 * size, _HEX_LINE, _HEX_NEXT)
    return end if len(digits) == 2 * size and is_key_encoding(bytes.fromhex(digits)) else None


def _encoded(text: str, at: int, size: int) -> tuple[bytes, int] | None:
    """``size`` bytes of base64 at ``at`` and where their padding ends, if the line's run ends with them."""
    n = (size * 4 + 2) // 3
    run, end = _run(text, at, n)
    if len(run) < n or _BASE64_LINE.match(text, end):
        return None
    data = _base64(run)
    if data is None:
        return None
    for _ in range(-n % 4):
        end += text.startswith("=", end)
    return data, end


def _key_encoding(text: str, at: int, line_end: int) -> int | None:
    """End of the key encoding whose base64 begins at ``at``, if there is one."""
    if text.startswith("M", at):
        size = _stated(_base64(_run(text, at, 8)[0]) or b"")
        if size is None:
            return None
        if size > len(text):
            return None
        found = _encoded(text, at, size)
        return found[1] if found and is_key_encoding(found[0]) else None
    if text.startswith("AAAA", at):
        data = _base64(text[at:line_end])
        if data is None or not is_ssh_public_key(data):
            return None
        return _encoded(text, at, len(data))[1]
    run = _run(text, at, len(text))[0]
    size = _ssh_file_end(base64.b64decode(run[: len(run) // 4 * 4]) + (_base64(run[len(run) // 4 * 4 :]) or b""))
    found = _encoded(text, at, size) if size else None
    return found[1] if found else None


def is_signed_token(text: str) -> bool:
    parts = text.split(".")
    try:
        head, body = (json.loads(_base64(p, b"-_") or b"") for p in parts[:2])
    except (ValueError, RecursionError):
        return False
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(body, dict)


def find_secrets(text: str | None) -> list[tuple[str, int, int]]:
    """(kind, start, end) in code points, by start, then kind; the end is exclusive."""
    if not text:
        return []
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    upto = 0
    for m in _BASE64_START.finditer(text):
        if m.start() >= upto and (end := _key_encoding(text, m.start(), m.end())):
            found.append(("der", m.start(), end))
            upto = end
    upto = 0
    for m in _HEX_START.finditer(text):
        if m.start() >= upto and (end := _hex_key(text, m.start())):
            found.append(("der", m.start(), end))
            upto = end
    found += [("jwt", *m.span()) for m in _JWT.finditer(text) if is_signed_token(m.group())]
    return sorted(set(found), key=lambda x: (x[1], KINDS.index(x[0]), x[2]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


SCHEMA = pa.schema(
    [("doc_id", pa.int64())] + [(f"n_{k}", pa.int64()) for k in KINDS] + [("base_spans", pa.string()), ("base_sha256", pa.string()), ("spans", pa.string())]
)
_DDL = "doc_id long, " + ", ".join(f"n_{k} long" for k in KINDS) + ", base_spans string, base_sha256 string, spans string"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, text in zip(batch.column(0), batch.column(1)):
            spans = find_secrets(text.as_py())
            base = joined([s for s in spans if s[0] in BASE_KINDS])
            kinds = [s[0] for s in spans]
            rows.append((doc.as_py(), *(kinds.count(k) for k in KINDS), base, hashlib.sha256(base.encode()).hexdigest(), joined(spans)))
        yield pa.RecordBatch.from_pylist([dict(zip(SCHEMA.names, r)) for r in rows], schema=SCHEMA)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: counts by kind, the base spans, their digest and all spans."""
    return docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("string").alias("text")).mapInArrow(_scan, _DDL)
