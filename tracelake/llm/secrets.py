"""Secret scan: patterns find candidates, structure confirms them.

Base spans come from three patterns.  The method adds spans for what a pattern
alone cannot tell from chance: base64 or hex runs are decoded, and reported
only if the bytes parse as a key (DER with consistent nested lengths and the
shape of a private key, or the OpenSSH container with its counted fields), and
dotted tokens only if their first part decodes to a JSON header that names an
algorithm and the second to a JSON object.  Encoded runs broken into lines, by
line ends or by their escapes (a backslash and n or r), are decoded joined.

Kinds: ``assign, access, hex, jwt, der_key, openssh_key``.  Spans count code
points, end exclusive.

Defined results: a null or empty text has no spans; whole texts are scanned
whatever their length; equal rows give equal results row by row; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import binascii
import json
import re

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tracelake.llm.common import id_text, rows_of

# The base patterns and their least lengths.
KINDS = ("assign", "access", "hex", "jwt", "der_key", "openssh_key")
ASSIGN = re.compile(
    r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")  # the runs of [0-9a-f]+ that are long enough
ASSIGN_MIN, ACCESS_MIN, HEX_MIN = 6, 20, 24
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")

LONG_RUN = 20  # no span but assignments lies in a shorter stretch without white space
ENCODED = re.compile(r"[A-Za-z0-9+/_-]{40,}={0,2}")
ENCODED_MIN = 40
HEX_ANY = re.compile(r"[0-9A-Fa-f]+")
# "{" in base64 is "e" and one of the last sixteen letters of the alphabet.
TOKEN = re.compile(r"(?<![A-Za-z0-9_-])e[w-z0-9_-][A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
ARMOUR = re.compile(r"-----BEGIN ([A-Z ]*PRIVATE KEY)-----((?:[A-Za-z0-9+/=\s]|\\+[nrt/])+)-----END \1-----")
ESCAPE = re.compile(r"\\+[nrt]|\\+(?=/)|\s+")
LINE_MIN = 8  # characters of a first line
HEAD = 64  # characters of a run, over its lines, from which the start of a key is told
NESTED = re.compile(rb"[A-Za-z0-9+/_=-]+")
RUN = re.compile(r"[A-Za-z0-9+/_-]++(?:={0,2})")
# A line end between two runs, with what else stands at its sides (indents, quotes, commas, comment marks).
_SIDE = r"(?:[^\w+/=\r\n\\-]|\\+t)*+"
JOIN = re.compile(rf"{_SIDE}(?:(?:\\+[nr]|[\r\n]){_SIDE})++(?=[A-Za-z0-9+/_-])")
FIRST = re.compile(r"(?:(?<![A-Za-z0-9+/_\\-])|(?<=\\)(?![nrt])|(?<=\\[nrt]))[A-Za-z0-9+/_-]{%d,}+" % LINE_MIN)
OPENSSH = b"openssh-key-v1\0"


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the three base patterns."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_MIN]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_MIN]
    if any(len(w) >= HEX_MIN for w in text.split()):
        out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return out


def decoded(run: str) -> list[bytes]:
    """The bytes a run may stand for: hex, or base64 in either alphabet."""
    out = []
    if len(run) % 2 == 0 and HEX_ANY.fullmatch(run):
        out.append(bytes.fromhex(run))
    body = run.rstrip("=")
    if len(body) % 4 != 1:
        try:
            out.append(base64.b64decode(body + "=" * (-len(body) % 4), altchars=b"-_" if re.search("[-_]", body) else None, validate=True))
        except (binascii.Error, ValueError):
            pass
    return out


def der(data: bytes, start: int = 0, end: int | None = None, depth: int = 0) -> list | None:
    """``(tag, content or children)`` of DER bytes, or None unless every
    nested length fits its parent exactly."""
    end = len(data) if end is None else end
    out = []
    while start < end:
        if depth > 16 or end - start < 2:
            return None
        tag, n = data[start], data[start + 1]
        start += 2
        if n & 0x80:
            size = n & 0x7F
            if not 1 <= size <= 4 or start + size > end:
                return None
            n = int.from_bytes(data[start : start + size], "big")
            start += size
        if start + n > end:
            return None
        if tag & 0x20:
            inside = der(data, start, start + n, depth + 1)
            if inside is None:
                return None
            out.append((tag, inside))
        else:
            out.append((tag, data[start : start + n]))
        start += n
    return out


def is_der_key(data: bytes) -> bool:
    """PKCS#1 (RSA, DSA), PKCS#8 or SEC 1 private key."""
    if len(data) < 16 or data[0] != 0x30:
        return False
    tree = der(data)
    if not tree or len(tree) != 1:
        return False
    parts = tree[0][1]
    tags = [t for t, _ in parts]
    if len(parts) < 2 or tags[0] != 0x02:
        return False
    if tags == [0x02] * 9 or tags == [0x02] * 6:  # version and the numbers of an RSA or DSA key
        return parts[0][1] in (b"\0", b"\1")
    if tags[:3] == [0x02, 0x30, 0x04]:  # version, algorithm, key
        algorithm = parts[1][1]
        return bool(algorithm) and algorithm[0][0] == 0x06
    return tags[:2] == [0x02, 0x04] and parts[0][1] == b"\1" and len(parts[1][1]) >= 16


def is_openssh_key(data: bytes) -> bool:
    """``openssh-key-v1``: counted cipher, kdf, options, keys, private part."""
    if not data.startswith(OPENSSH):
        return False
    at = len(OPENSSH)

    def field() -> bytes | None:
        nonlocal at
        n = int.from_bytes(data[at : at + 4], "big")
        if at + 4 > len(data) or at + 4 + n > len(data):
            return None
        at += 4 + n
        return data[at - n : at]

    if any(field() is None for _ in range(3)) or at + 4 > len(data):
        return False
    keys = int.from_bytes(data[at : at + 4], "big")
    at += 4
    if not 1 <= keys <= 16 or any(field() is None for _ in range(keys)):
        return False
    return field() is not None and at == len(data)


def is_signed_token(token: str) -> bool:
    def part(x: str):
        try:
            return json.loads(base64.urlsafe_b64decode(x + "=" * (-len(x) % 4)))
        except (ValueError, RecursionError):
            return None

    head, body, _ = token.split(".")
    head = part(head)
    return isinstance(head, dict) and isinstance(head.get("alg"), str) and isinstance(part(body), dict)


def key_kind(run: str) -> int | None:
    for data in decoded(run):
        if is_openssh_key(data):
            return 5
        if is_der_key(data):
            return 4
        inner = data.strip()  # base64 or hex text that was encoded once more
        if len(inner) >= ENCODED_MIN and re.fullmatch(rb"[A-Za-z0-9+/_=-]+", inner):
            return key_kind(inner.decode())
    return None


class Chain:
    """Encoded runs that follow each other over line ends: their characters
    joined, without padding, and where in them each run starts and ends."""

    def __init__(self, text: str, start: int):
        runs, self.starts, self.ends = [], {}, {}
        at = 0
        run = RUN.match(text, start)
        while run:
            body = run[0].rstrip("=")
            self.starts[run.start()] = at
            at += len(body)
            self.ends[at] = run.end()
            runs.append(body)
            if len(body) < len(run[0]):
                break
            join = JOIN.match(text, run.end())
            run = join and RUN.match(text, join.end())
        self.joined = "".join(runs)

    def key(self, start: int) -> tuple[int, int] | None:
        """``(kind number, end)`` of the key that starts at ``start`` in the text."""
        at = self.starts[start]
        for n in sorted(key_sizes(lambda n: self.joined[at : at + n], len(self.joined) - at)):
            if n >= ENCODED_MIN and at + n in self.ends:
                kind = key_kind(self.joined[at : at + n])
                if kind is not None:
                    return kind, self.ends[at + n]
        return None


def key_sizes(first, limit: int) -> set[int]:
    """How many of ``limit`` characters the key takes that a run starts with, as
    its own lengths say.  ``first(n)`` gives the run's first n characters: its head is
    decoded, and more only as far as counted fields go."""
    out = set()
    head = first(HEAD)
    for decode, per, n in ((decoded_hex, 2, 1), (decoded_base64, 4, 3)):
        data, room = decode(head), limit * n // per
        if not data or len(data) < 6 or room < 16:
            continue

        def data_of(size: int, decode=decode, per=per, n=n) -> bytes:
            return decode(first(-(-size // n) * per)) or b""

        if data[0] == 0x30:
            size = data[1] & 0x7F if data[1] & 0x80 else 0
            if size <= 4 and data[2 + size : 3 + size] in (b"\2", b""):  # every private key starts with its version
                total = 2 + size + (int.from_bytes(data[2 : 2 + size], "big") if size else data[1])
                out.add(-(-total * per // n))
        elif data[: len(OPENSSH)] == OPENSSH[: len(data)]:
            total = openssh_size(data_of, room)
            if total:
                out.add(-(-total * per // n))
        elif NESTED.fullmatch(data):
            for size in key_sizes(lambda size, data_of=data_of: NESTED.match(data_of(size) + b"=")[0].decode("ascii")[:size], room):
                # with the inner padding and a line end after it
                out |= {-(-(size + more) * per // n) for more in range(5)}
    return out


def openssh_size(data_of, limit: int) -> int | None:
    """The bytes of an OpenSSH key by its counted fields, if there are so many;
    ``data_of(n)`` gives at least the first n of ``limit`` bytes."""
    data, at = data_of(256), len(OPENSSH)

    def number() -> int | None:
        nonlocal data, at
        if at + 4 > limit:
            return None
        if at + 4 > len(data):
            data = data_of(max(at + 4, 2 * len(data)))
            if data is None or at + 4 > len(data):
                return None
        at += 4
        return int.from_bytes(data[at - 4 : at], "big")

    fields = 3
    while fields:
        n = number()
        if n is None:
            return None
        at += n
        fields -= 1
    keys = number()
    if keys is None or not 1 <= keys <= 16:
        return None
    for _ in range(keys + 1):
        n = number()
        if n is None:
            return None
        at += n
    return at if at <= limit else None


def decoded_hex(run: str) -> bytes | None:
    return bytes.fromhex(run[: len(run) // 2 * 2]) if HEX_ANY.fullmatch(run) else None


def decoded_base64(run: str) -> bytes | None:
    run = run.rstrip("=")
    whole = run[: len(run) // 4 * 4]
    if len(run) % 4 > 1:
        whole = run + "=" * (-len(run) % 4)
    try:
        return base64.b64decode(whole.replace("-", "+").replace("_", "/"))
    except (binascii.Error, ValueError):
        return None


def confirmed_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of what decodes and parses."""
    out = []
    if "-----BEGIN " in text:
        for m in ARMOUR.finditer(text):
            kind = key_kind(ESCAPE.sub("", m[2]))
            if kind is not None:
                out.append((m.start(), kind, m.end()))
    seen = [(a, b) for a, _, b in out]
    at, chain = 0, None
    for m in FIRST.finditer(text):
        escaped = text[m.start() - 1 : m.start()] in ("n", "r", "t") and text[m.start() - 2 : m.start() - 1] == "\\"
        if m.start() >= at and (escaped or JOIN.match(text, RUN.match(text, m.start()).end())):
            if chain is None or m.start() not in chain.starts:
                chain = Chain(text, m.start())
            found = None if any(a <= m.start() < b for a, b in seen) else chain.key(m.start())
            if found:
                kind, at = found
                out.append((m.start(), kind, at))
    if any(len(w) >= LONG_RUN for w in text.split()):
        seen = [(a, b) for a, _, b in out]
        for m in ENCODED.finditer(text):
            if not any(a <= m.start() < b for a, b in seen):
                kind = key_kind(m[0])
                if kind is not None:
                    out.append((m.start(), kind, m.end()))
        out += [(m.start(), 3, m.end()) for m in TOKEN.finditer(text) if is_signed_token(m[0])]
    return out


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and ``spans``: array of (start, end, kind), base and
    confirmed ones, by start, then kind as listed."""

    def run(batches):
        import pyarrow as pa

        span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("kind", pa.string())]))
        for batch in batches:
            found = [
                [{"start": a, "end": b, "kind": KINDS[k]} for a, k, b in sorted({*base_spans(t), *confirmed_spans(t)})]
                for t in batch.column(1).to_pylist()
            ]
            yield rows_of([batch.column(0), found], ["doc_id", "spans"], [pa.int64(), span])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, spans array<struct<start:long,end:long,kind:string>>")


def digest(found: DataFrame) -> DataFrame:
    """The columns of the ``op4`` query."""
    base = F.filter("spans", lambda s: s["kind"].isin(*KINDS[:3]))

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id", count("assign"), count("access"), count("hex"),
        F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"),
    )
