"""Secret scans with structural confirmation.

Pattern spans (assignments, access ids, hex runs) are reported as they match. Encoded candidates are decoded first and
reported only if what they hold has the structure of a key: DER with nested lengths that add up, an OpenSSH private key
container, or a signed token whose header and payload are JSON objects and whose header names an algorithm.
"""

from __future__ import annotations

import base64
import binascii
import hashlib
import json
import re
from bisect import bisect_right

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from chronolith.llm.text import map_rows, map_texts

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{16,}")  # leftmost maximal runs, as [0-9a-f]+ with the short ones dropped
_PEM_MARK = re.compile(r"-----(BEGIN|END) ([A-Z0-9 ]*PRIVATE KEY)-----")
_PEM_HEADER = re.compile(r"^([A-Za-z-]+):[ \t]*(.*)$", re.M)
#: Block sizes of the ciphers that an encrypted PEM body may name.
_BLOCKS = {"DES-CBC": 8, "DES-EDE3-CBC": 8, "BF-CBC": 8, "RC2-CBC": 8, "IDEA-CBC": 8, "AES-128-CBC": 16, "AES-192-CBC": 16, "AES-256-CBC": 16, "CAMELLIA-256-CBC": 16, "SEED-CBC": 16}
_TOKEN = re.compile(r"[A-Za-z0-9_.-]{20,}")
#: What base64 of a key can start with: DER's 0x30 gives an M, then there are an OpenSSH container's name and a PEM mark.
_BASE64 = re.compile(r"(?<![A-Za-z0-9+/_-])(?:M|b3BlbnNzaC1rZXkt|LS0tLS1CRUdJTi)[A-Za-z0-9+/_-]{39,}={0,2}")
_HEX_ANY = re.compile(r"(?<![0-9A-Fa-f])30[0-9A-Fa-f]{62,}")
#: Base kinds, then those that need confirmation; ties at one start are listed in this order.
KINDS = ("assign", "access", "hex", "pem", "openssh", "jwt", "der", "der_hex")


def _level(data: bytes, at: int, end: int) -> list[tuple[int, int, int]] | None:
    """(tag, start, size) of each DER element in data[at:end]; None if their lengths don't add up."""
    out = []
    while at < end:
        if at + 2 > end:
            return None
        tag, size, at = data[at], data[at + 1], at + 2
        if size & 0x80:
            n = size & 0x7F
            if not 1 <= n <= 4 or at + n > end or data[at] == 0:
                return None
            size, at = int.from_bytes(data[at : at + n], "big"), at + n
            if size < 0x80:  # DER takes the shortest form
                return None
        if at + size > end:
            return None
        out.append((tag, at, size))
        at += size
    return out


def _inside(data: bytes) -> list[tuple[int, int, int]] | None:
    """The elements of the one DER SEQUENCE that ``data`` is, if the lengths at every depth add up."""
    if len(data) < 24 or data[0] != 0x30:
        return None
    top = _level(data, 0, len(data))
    if not top or len(top) != 1:
        return None
    inner = _level(data, top[0][1], top[0][1] + top[0][2])
    open_ = list(inner or ())
    while open_:
        tag, at, size = open_.pop()
        if tag & 0x20:
            below = _level(data, at, at + size)
            if below is None:
                return None
            open_ += below
    return inner


def der_key(data: bytes) -> bool:
    """True if ``data`` is one DER SEQUENCE whose nested lengths add up and that holds an INTEGER version and key material."""
    inner = _inside(data) or []
    tags = [t for t, _, _ in inner]
    if tags[:3] == [0x02, 0x30, 0x04]:  # version, algorithm, key octets
        return inner[0][2] == 1
    if tags[:2] == [0x30, 0x03]:  # algorithm and public key bits
        return False
    if tags[:2] == [0x02, 0x04]:  # elliptic curve
        return inner[0][2] == 1 and inner[1][2] >= 16
    return len(tags) >= 6 and set(tags) == {0x02} and inner[0][2] == 1  # RSA and DSA: version and integers


def encrypted_key(data: bytes) -> bool:
    """True if ``data`` is a DER SEQUENCE of an algorithm, which begins with its identifier, and the octets of a key."""
    inner = _inside(data) or []
    return [t for t, _, _ in inner] == [0x30, 0x04] and inner[0][2] > 2 and data[inner[0][1]] == 0x06 and inner[1][2] >= 8


def _ssh_key(data: bytes) -> bool:
    head = b"openssh-key-v1\x00"
    if not data.startswith(head):
        return False
    at = len(head)
    for _ in range(3):  # cipher, key derivation, its options
        n = int.from_bytes(data[at : at + 4], "big")
        at += 4 + n
        if at + 4 > len(data):
            return False
    return 1 <= int.from_bytes(data[at : at + 4], "big") <= 16


def _decoded(text: str) -> bytes | None:
    text = re.sub(r"\s", "", text).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _json_object(part: str) -> dict | None:
    data = _decoded(part)
    try:
        found = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def _pem_spans(text: str) -> list[tuple[int, int, int]]:
    """Confirmed PEM and OpenSSH keys: a BEGIN mark and the next mark, if it is the END of the same label. Bodies do not overlap."""
    out, open_ = [], None
    for m in _PEM_MARK.finditer(text):
        if m[1] == "END" and open_ and open_[2] == m[2]:
            body = text[open_.end() : m.start()].replace("\\r", "").replace("\\n", "\n")  # line ends may be escaped in a string
            headers = {h[1].lower(): h[2].strip() for h in _PEM_HEADER.finditer(body)}
            data = _decoded(_PEM_HEADER.sub("", body))
            if data and _ssh_key(data):
                out.append((open_.start(), 4, m.end()))
            elif data and (der_key(data) or "ENCRYPTED" in m[2] and encrypted_key(data) or _enciphered(headers, data)):
                out.append((open_.start(), 3, m.end()))
        open_ = m if m[1] == "BEGIN" else None
    return out


def _enciphered(headers: dict[str, str], data: bytes) -> bool:
    """True for a body under Proc-Type 4,ENCRYPTED whose length and initial vector fit the cipher that it names."""
    if "".join(headers.get("proc-type", "").split()).upper() != "4,ENCRYPTED":
        return False
    cipher, _, start = headers.get("dek-info", "").partition(",")
    block = _BLOCKS.get(cipher.strip().upper())
    return block is not None and len(data) % block == 0 and re.fullmatch(rf"[0-9A-Fa-f]{{{2 * block}}}|[0-9A-Fa-f]{{16}}", start.strip()) is not None


def _jwt_spans(text: str) -> list[tuple[int, int, int]]:
    """Signed tokens: three parts between dots in a run of their alphabet, whose first two hold JSON objects."""
    out = []
    for run in _TOKEN.finditer(text):
        if "eyJ" not in run[0]:
            continue
        parts, at, i = run[0].split("."), run.start(), 0
        places = [at]
        for p in parts:
            places.append(places[-1] + len(p) + 1)
        while i + 2 < len(parts):
            head = parts[i].find("eyJ")
            if head >= 0 and parts[i + 1].startswith("eyJ"):
                names = _json_object(parts[i][head:])
                if names and isinstance(names.get("alg"), str) and _json_object(parts[i + 1]) is not None:
                    out.append((places[i] + head, 5, places[i + 2] + len(parts[i + 2])))
                    i += 2
            i += 1
    return out


def _held(data: bytes, kind: int) -> int | None:
    """The kind of key that decoded bytes hold: a DER key is of the candidate's own kind."""
    if der_key(data):
        return kind
    if _ssh_key(data):
        return 4
    if data.startswith(b"-----BEGIN ") and (inner := _pem_spans(data.decode("latin-1"))):
        return inner[0][1]
    return None


def spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind's place in ``KINDS``, end) of each secret, in code points, by start, then kind. Base spans always stay."""
    text = text or ""
    out = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 18]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    pem = _pem_spans(text) if "PRIVATE KEY-----" in text else []
    out += pem + (_jwt_spans(text) if "eyJ" in text else [])
    starts = [a for a, _, _ in pem]
    for kind, pattern, decode in ((6, _BASE64, _decoded), (7, _HEX_ANY, lambda s: bytes.fromhex(s[: len(s) // 2 * 2]))):
        for m in pattern.finditer(text):
            near = bisect_right(starts, m.start()) - 1
            if not (near >= 0 and m.start() < pem[near][2]) and (data := decode(m[0])) and (held := _held(data, kind)) is not None:
                out.append((m.start(), held, m.end()))
    return sorted(out)


def shown(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in found)


def _row(doc_id, text: str | None) -> tuple:
    found = spans(text)
    base = [x for x in found if x[1] < 3]
    count = [sum(x[1] == k for x in found) for k in range(3)]
    return doc_id, *count, len(found) - len(base), hashlib.sha256(shown(base).encode()).hexdigest(), shown(found)


def scanned(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_confirmed, base_sha256 and spans (kind:start:end) for each row of ``docs``.

    Null or empty text: no spans and the digest of the empty string. Long texts are scanned whole, in linear time. Ids may be
    null or repeated; spans of one start are listed by kind; columns other than doc_id and text are not read; an empty
    table gives no rows.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, n_assign long, n_access long, n_hex long, n_confirmed long, base_sha256 string, spans string"
    return map_texts(docs.select("doc_id", F.col("text").cast("string").alias("text")), _row, schema, "doc_id", "text")


def hidden(text: str | None) -> str | None:
    """``text`` with each secret replaced by ``[kind]``; of an assignment its value only, of overlapping spans the outermost."""
    found = spans(text)
    if not found:
        return text
    out, last = [], 0
    for a, k, b in sorted(found, key=lambda x: (x[0], -x[2])):
        if k == 0:
            a = _ASSIGN.match(text, a).start(2)
        if b <= last:
            continue
        if a >= last:
            out += [text[last:a], f"[{KINDS[k]}]"]
        last = b
    return "".join([*out, text[last:]])


def redacted(docs: DataFrame) -> DataFrame:
    """``docs`` with the secrets in their texts hidden; all rows and columns stay, and n_chars, if there, follows the text."""

    def change(batch: pa.RecordBatch) -> pa.RecordBatch:
        at = batch.schema.names.index("text")
        return batch.set_column(at, batch.schema.field(at), pa.array(map(hidden, batch.column(at).to_pylist()), batch.schema.field(at).type))

    out = map_rows(docs, change)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.coalesce(F.char_length("text").cast(docs.schema["n_chars"].dataType), "n_chars"))
    return out
