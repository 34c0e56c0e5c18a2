"""Secret scans: patterns, and candidates that are decoded and parsed before they are reported.

Pattern kinds, leftmost and non-overlapping within a kind: ``assign`` (a name such as password or
api_key, = or :, and a value of 8 or more characters), ``access`` (AKIA and 16 or more characters in
all), ``hex`` (32 or more digits). Structural kinds are reported only if their content holds:

``pem``      a private-key block whose base64 body is an OpenSSH key or a DER key structure; line ends may be
             escaped, as in JSON
``jwt``      a signed token: the header decodes to a JSON object with an ``alg``, the payload to JSON
``key64``    a run of base64 that decodes to an OpenSSH key, to a DER key structure or to text with a ``pem``
``keyhex``   a run of hex digits (of either case) that decodes to one of these

Every run of 39 characters of base64 or 40 hex digits is decoded, whatever it starts with.

DER is parsed with its nested lengths: each must end exactly where its parent says, and the
outermost must be one of the published private-key layouts. Spans of different kinds may overlap.
Null and empty texts have no spans; every row is scanned whole, in the task that reads it.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from gritstone.llm.store import map_text

BASE_KINDS = ("assign", "access", "hex")
KINDS = (*BASE_KINDS, "pem", "jwt", "key64", "keyhex")
ORDER = {kind: at for at, kind in enumerate(KINDS)}

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_HINTS = ("passw", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
PEM_BEGIN = re.compile(r"-----BEGIN ([A-Z0-9]+ )?PRIVATE KEY-----")
DOTTED = re.compile(r"(?<![A-Za-z0-9_-])[A-Za-z0-9_-]++(?:\.[A-Za-z0-9_-]*+){2,}")
BRACE64 = re.compile(r"e(?=[w-z0-9_-])")
OBJECT = re.compile(rb"\s*(?:\{\s*(?:\"|\Z)|\Z)")
RUN64 = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{39,}={0,2}")
RUNHEX = re.compile(r"(?<![0-9A-Fa-f])[0-9A-Fa-f]{40,}")
ESCAPED = re.compile(r"\\+([nrt/])")
OPENSSH = b"openssh-key-v1\0"
MAX_DEPTH = 12

SCHEMA = "spans array<struct<kind:string,start:int,end:int>>"


def decode64(run: str) -> bytes | None:
    """The bytes of standard or URL-safe base64, padded or not; None if it is neither."""
    body = "".join(run.split()).rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(body + "=" * (-len(body) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def der_items(data: bytes, depth: int = 0) -> list[tuple[int, object]] | None:
    """(tag, bytes or items) of a whole run of DER values; None unless every nested length fits exactly."""
    items: list[tuple[int, object]] = []
    at = 0
    while at < len(data):
        if at + 2 > len(data) or depth > MAX_DEPTH:
            return None
        tag, size = data[at], data[at + 1]
        at += 2
        if size >= 0x80:
            width = size & 0x7F
            if not 1 <= width <= 4 or at + width > len(data):
                return None
            size = int.from_bytes(data[at : at + width], "big")
            at += width
        if at + size > len(data):
            return None
        body: object = data[at : at + size]
        if tag & 0x20:
            body = der_items(data[at : at + size], depth + 1)
            if body is None:
                return None
        items.append((tag, body))
        at += size
    return items


def is_der_key(data: bytes) -> bool:
    """One of the private-key layouts: RSA, elliptic curve, PKCS #8 plain or encrypted."""
    top = der_items(data) if data[:1] == b"\x30" else None
    if not top or len(top) != 1 or not isinstance(top[0][1], list):
        return False
    inner = top[0][1]
    tags = [tag for tag, _ in inner]
    if len(tags) >= 9 and tags[:9] == [2] * 9:
        return True
    if tags[:3] == [2, 0x30, 4]:
        return bool(inner[1][1]) and inner[1][1][0][0] == 6
    if tags[:2] == [2, 4] and inner[0][1] == b"\x01":
        return set(tags[2:]) <= {0xA0, 0xA1}
    return tags == [0x30, 4] and bool(inner[0][1]) and inner[0][1][0][0] == 6


def is_key(data: bytes | None) -> bool:
    return data is not None and (data.startswith(OPENSSH) or is_der_key(data))


def holds_key(data: bytes | None) -> bool:
    """A key as such, or text with a private-key block."""
    return is_key(data) or data is not None and b"PRIVATE KEY-----" in data and bool(pem_spans(data.decode("latin-1")))


def is_json_object(part: str) -> dict | None:
    data = decode64(part)
    try:
        found = json.loads(data) if data else None
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def jwt_spans(text: str) -> list[tuple[int, int]]:
    """Signed tokens among runs joined by dots; the header may follow other characters of its run."""
    found = []
    for m in DOTTED.finditer(text):
        parts, at, free = m[0].split("."), m.start(), 0
        for n, (header, payload, last) in enumerate(zip(parts, parts[1:], parts[2:])):
            if n >= free and header and payload:
                starts = [k for k in (0, *(x.start() for x in BRACE64.finditer(header, 1)))
                          if OBJECT.match(decode64(header[k : k + 64]) or b"-")]
                if starts and is_json_object(payload) is not None:
                    for k in starts:
                        if isinstance((is_json_object(header[k:]) or {}).get("alg"), str):
                            found.append((at + k, at + len(header) + len(payload) + len(last) + 2))
                            free = n + 3
                            break
            at += len(header) + 1
    return found


def unescaped(body: str) -> str:
    return ESCAPED.sub(lambda m: "/" if m[1] == "/" else "\n", body)


def pem_spans(text: str) -> list[tuple[int, int]]:
    found, at, missing = [], 0, set()
    while begin := PEM_BEGIN.search(text, at):
        at = begin.end()
        mark = f"-----END {begin[1] or ''}PRIVATE KEY-----"
        end = -1 if mark in missing else text.find(mark, at)
        if end < 0:
            missing.add(mark)  # nor does any later block end so
            continue
        inner = text.rfind("-----BEGIN", at, end)
        if inner < 0 and is_key(decode64("".join(x for x in unescaped(text[at:end]).splitlines() if ":" not in x))):
            found.append((begin.start(), end + len(mark)))
            at = end + len(mark)
    return found


def spans(text: str) -> list[tuple[str, int, int]]:
    """All spans (kind, start, end) in code points, by start and then kind as listed."""
    found: list[tuple[str, int, int]] = []
    low = text.lower()
    if any(hint in low for hint in ASSIGN_HINTS):
        found += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [("hex", *m.span()) for m in HEX.finditer(text)]
    if "PRIVATE KEY-----" in text:
        found += [("pem", *span) for span in pem_spans(text)]
    if text.count(".") > 1:
        found += [("jwt", *span) for span in jwt_spans(text)]
    found += [("key64", *m.span()) for m in RUN64.finditer(text) if holds_key(decode64(m[0]))]
    found += [("keyhex", *m.span()) for m in RUNHEX.finditer(text) if len(m[0]) % 2 == 0 and holds_key(bytes.fromhex(m[0]))]
    return sorted(found, key=lambda x: (x[1], ORDER[x[0]], x[2]))


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``spans`` (a column of that name is replaced)."""
    kept = docs.drop("spans")
    names = kept.columns
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def work(rows: pa.RecordBatch) -> pa.RecordBatch:
        found = [[{"kind": k, "start": a, "end": b} for k, a, b in spans(x.as_py() or "")] for x in rows.column(text)]
        return pa.RecordBatch.from_arrays([*rows.columns, pa.array(found, kind)], [*names, "spans"])

    return map_text(kept, work, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema) + ", " + SCHEMA, text)


def redact(text: str, found: list[tuple[str, int, int]], mask: str = "[secret]") -> str:
    """The text with each maximal run of overlapping spans replaced by the mask."""
    out, at = [], 0
    for _, start, end in found:
        if start >= at or not out:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]])


def without_secrets(docs: DataFrame) -> DataFrame:
    """``docs`` with the secrets of ``text`` masked and ``n_chars``, where there is one, brought in line."""
    names, kinds = docs.columns, docs.schema

    def work(rows: pa.RecordBatch) -> pa.RecordBatch:
        columns = dict(zip(names, rows.columns))
        texts = [None if (t := x.as_py()) is None else redact(t, spans(t)) for x in rows.column("text")]
        columns["text"] = pa.array(texts, pa.string())
        if "n_chars" in columns:
            sizes = [len(t) if t is not None else old.as_py() for t, old in zip(texts, columns["n_chars"])]
            columns["n_chars"] = pa.array(sizes, rows.schema.field("n_chars").type)
        return pa.RecordBatch.from_arrays(list(columns.values()), names)

    return map_text(docs, work, kinds)


def _listed(found: Column) -> Column:
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def digests(found: DataFrame) -> DataFrame:
    """Counts by base kind, the digest of the base spans, and all spans as text."""
    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda x: x["kind"] == kind)).cast("long")

    base = F.filter("spans", lambda x: x["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id", *[count(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(_listed(base), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
    )
