"""Secrets in texts: three base patterns, and encoded keys and tokens confirmed by structure.

A run of base64 or hexadecimal characters is decoded and reported only if what it holds parses.
Runs may be broken into lines, indented ones and ones with written breaks too. Where the whole run
does not parse its parts are tried, after slashes and between dots, as in paths:

- ``der``: nested tag-length-value structures whose lengths add up exactly and whose fields are
  those of a private key: a version and big integers (RSA, DSA), a version and a secret (elliptic
  curves), an algorithm and what holds the key, encrypted or not, or a store of keys;
- ``der-public``: likewise a public key or a certificate. Signatures are neither;
- ``ssh-private``: the container of private keys, all its fields in place;
- ``ssh``: length-prefixed fields of a public key, the first its type;
- ``jwt``: three dot-separated parts, the first a JSON object that names an algorithm and the
  second a JSON object, however short.

All are reported; public ones are masked on request only.
"""

from __future__ import annotations

import base64
import binascii
import bisect
import hashlib
import json
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .texts import as_bytes, byte_set, quoted, with_text_columns

SPANS = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"

ASSIGN = re.compile(
    r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|"""
    r"""[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?)([A-Za-z0-9+/_.=-]+)"""
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 8, 16, 32
#: What a text must hold, in lower case, for an assignment to be possible.
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")

#: Shortest run that is decoded, and the runs: base64 of either alphabet, dots for tokens.
MIN_ENCODED = 40
ENCODED = re.compile(r"[A-Za-z0-9+/_=.-]{%d,}" % MIN_ENCODED)
#: A line break, or one written with backslashes, and blanks around it.
BREAK = re.compile(r"[\x20\t]*(?:\r?\n|(?:\\+r)?\\+n)[\x20\t]*")
#: Base64 text broken into lines of up to 76 characters, as in key files; not from the letter of
#: a written line break on.
BROKEN = re.compile(r"(?<!\\)(?:[A-Za-z0-9+/]{64,76}(?:%s))+[A-Za-z0-9+/]*={0,2}" % BREAK.pattern)
#: How the parts of a run begin that are worth a look, and where parts begin.
PART = re.compile(r"(?:(?<=[/=.])|\A)(?:M|30|AAAA|b3Bl|e)")
HEX_ANY = re.compile(r"[0-9A-Fa-f]+\Z")
HEX_PART = re.compile(r"[0-9A-Fa-f]+")
TOKEN_HEAD = re.compile(r"e[A-Za-z0-9+_-]*={0,2}\.")
SSH_TYPES = re.compile(rb"(ssh|ecdsa|sk)-[a-z0-9@.-]+\Z")

#: A token too short to be a run.
SHORT_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=.-])eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]*")
#: What a run may go on with; the empty text after the last character is not of these.
_MORE = tuple("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-")
SSH_CONTAINER = b"openssh-key-v1\0"

KINDS = ("assign", "access", "hex", "der", "jwt", "ssh", "der-public", "ssh-private")
PUBLIC = {"ssh", "der-public"}
_IN_HEX = byte_set(b"0123456789abcdef")
_IN_CODE = byte_set(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=.-")


# ---------------------------------------------------------------- structures


def _der_end(data: bytes, at: int, limit: int, depth: int = 0) -> int:
    """Where the structure at ``at`` ends, or -1 if its lengths do not fit within ``limit``."""
    if at + 2 > limit or depth > 16:
        return -1
    tag, size, body = data[at], data[at + 1], at + 2
    if tag in (0, 0xFF) or tag & 0x1F == 0x1F:
        return -1
    if size & 0x80:
        octets = size & 0x7F
        if not 1 <= octets <= 4 or body + octets > limit:
            return -1
        size = int.from_bytes(data[body : body + octets], "big")
        # The shortest form of a length is the only valid one.
        if size < 0x80 or size >> (8 * (octets - 1)) == 0:
            return -1
        body += octets
    end = body + size
    if end > limit:
        return -1
    if tag & 0x20:
        while body < end:
            body = _der_end(data, body, end, depth + 1)
            if body < 0:
                return -1
    return end


#: Tags of the structures that keys are made of. Fixed values.
INT, BITS, OCTETS, OID, SEQ = 0x02, 0x03, 0x04, 0x06, 0x30
#: Least bytes of a number or a secret that is a key, and most bytes of a public exponent.
LEAST_KEY, MOST_EXPONENT = 16, 8


def _fields(data: bytes) -> list[tuple[int, bytes]]:
    """Tags and contents of structures side by side; their lengths are known to fit."""
    found, at = [], 0
    while at < len(data):
        size, body = data[at + 1], at + 2
        if size & 0x80:
            octets = size & 0x7F
            size = int.from_bytes(data[body : body + octets], "big")
            body += octets
        found.append((data[at], data[body : body + size]))
        at = body + size
    return found


def _is_algorithm(field: tuple[int, bytes]) -> bool:
    return field[0] == SEQ and field[1][:1] == bytes([OID])


def _holds_key(secret: bytes) -> bool:
    """Whether the octets of an unencrypted key are one structure: numbers, a secret, or a number."""
    return len(secret) > 2 and secret[0] in (SEQ, OCTETS, INT) and _der_end(secret, 0, len(secret)) == len(secret)


def der_kind(data: bytes) -> str | None:
    """``der`` for a private key, ``der-public`` for a public one or a certificate."""
    if len(data) < 24 or data[0] != SEQ or _der_end(data, 0, len(data)) != len(data):
        return None
    fields = _fields(_fields(data)[0][1])
    tags, bodies = [tag for tag, _ in fields], [body for _, body in fields]
    if len(fields) < 2:
        return None
    if tags[0] == INT:
        version = int.from_bytes(bodies[0], "big") if len(bodies[0]) == 1 else None
        if set(tags) == {INT} or tags[-1] == SEQ and set(tags[:-1]) == {INT} and version == 1:
            if version in (0, 1) and len(fields) > 2:
                return "der" if max(map(len, bodies[1:])) >= LEAST_KEY else None
            # A modulus and an exponent; the two numbers of a signature are of one size.
            short = len(fields) == 2 and len(bodies[1]) <= MOST_EXPONENT < LEAST_KEY <= len(bodies[0])
            return "der-public" if short else None
        if version in (0, 1) and _is_algorithm(fields[1]) and tags[2:3] == [OCTETS]:
            return "der" if _holds_key(bodies[2]) and set(tags[3:]) <= {0xA0, 0xA1, 0x81} else None
        if version == 1 and tags[1] == OCTETS and len(bodies[1]) >= LEAST_KEY:
            return "der" if set(tags[2:]) <= {0xA0, 0xA1} else None
        return "der" if version == 3 and _is_algorithm(fields[1]) else None
    if _is_algorithm(fields[0]) and len(fields) == 2:
        return {OCTETS: "der", BITS: "der-public"}.get(tags[1])
    signed = len(fields) == 3 and tags[0] == SEQ and _is_algorithm(fields[1]) and tags[2] == BITS
    return "der-public" if signed else None


def _ssh_fields(data: bytes, at: int = 0, count: int | None = None) -> tuple[list[bytes], int]:
    """Length-prefixed fields, ``count`` or up to the end, and where they end; -1 if one does not fit."""
    fields = []
    while at < len(data) if count is None else len(fields) < count:
        size = int.from_bytes(data[at : at + 4], "big")
        if at + 4 + size > len(data):
            return fields, -1
        fields.append(data[at + 4 : at + 4 + size])
        at += 4 + size
    return fields, at


def _is_ssh_public(data: bytes) -> bool:
    fields, end = _ssh_fields(data)
    return end >= 0 and len(fields) > 1 and bool(SSH_TYPES.match(fields[0]))


def _is_ssh_container(data: bytes) -> bool:
    """Cipher, key derivation and its options, a count, so many public keys, and the private part.

    An unencrypted private part begins with one number twice.
    """
    head, at = _ssh_fields(data, len(SSH_CONTAINER), 3)
    if at < 0 or at + 4 > len(data):
        return False
    keys = int.from_bytes(data[at : at + 4], "big")
    if not 1 <= keys <= len(data):
        return False
    fields, end = _ssh_fields(data, at + 4, keys + 1)
    if end != len(data) or not all(_is_ssh_public(key) for key in fields[:-1]):
        return False
    secret = fields[-1]
    return len(secret) > 8 and (head[0] != b"none" or secret[:4] == secret[4:8])


def ssh_kind(data: bytes) -> str | None:
    """``ssh-private`` for a container of private keys, ``ssh`` for a public key."""
    if data.startswith(SSH_CONTAINER):
        return "ssh-private" if _is_ssh_container(data) else None
    return "ssh" if _is_ssh_public(data) else None


def is_ssh_head(data: bytes) -> bool:
    """Whether keys may begin so: the container's name, or a key type as the first field."""
    size = int.from_bytes(data[:4], "big")
    return data.startswith(SSH_CONTAINER) or 4 < size < 64 and bool(SSH_TYPES.match(data[4 : 4 + size]))


def _base64(text: str) -> bytes | None:
    text = text.rstrip("=").replace("-", "+").replace("_", "/")
    try:
        return base64.b64decode(text + "=" * (-len(text) % 4), validate=True)
    except (binascii.Error, ValueError):
        return None


def _json_object(part: str) -> dict | None:
    try:
        found = json.loads(_base64(part) or b"")
    except (ValueError, RecursionError):
        return None
    return found if isinstance(found, dict) else None


def is_jwt(text: str) -> bool:
    parts = text.split(".")
    if len(parts) != 3 or not parts[0]:
        return False
    header = _json_object(parts[0])
    return bool(header) and isinstance(header.get("alg"), str) and _json_object(parts[1]) is not None


def encoded_kind(text: str) -> str | None:
    """The kind of structure that the characters decode to, if to any."""
    if "." in text:
        return "jwt" if is_jwt(text) else None
    decoded = []
    if HEX_ANY.match(text) and len(text) % 2 == 0:
        decoded.append(bytes.fromhex(text))
    decoded.append(_base64(text))
    for data in decoded:
        kind = data and (der_kind(data) or ssh_kind(data))
        if kind:
            return kind
    return None


# ---------------------------------------------------------------- spans


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Spans of the base kinds, leftmost without overlap in each kind."""
    found, low = [], text.lower()
    if any(word in low for word in KEYWORDS):
        for m in ASSIGN.finditer(text):
            if m.end(2) - m.start(2) >= MIN_VALUE:
                found.append((m.start(), m.end(), "assign"))
    if "AKIA" in text:
        for m in ACCESS.finditer(text):
            if m.end() - m.start() >= MIN_ACCESS:
                found.append((m.start(), m.end(), "access"))
    return found + [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]


def _der_chars(text: str, begin: int) -> int:
    """Characters of the base64 structure that begins there by its own length, or zero."""
    head = _base64(text[begin : begin + 8])
    if not head or len(head) < 6 or head[0] != 0x30 or head[1] == 0x80 or head[1] > 0x84:
        return 0
    octets = head[1] & 0x7F if head[1] & 0x80 else 0
    size = 2 + octets + (int.from_bytes(head[2 : 2 + octets], "big") if octets else head[1])
    return -(-size * 4 // 3)


def _parts(run: str) -> Iterator[tuple[int, int]]:
    """Bounds of what may be a key or token inside a run: after slashes, between dots."""
    dots = [m.start() for m in re.finditer(r"\.", run)] + [len(run)]
    for m in PART.finditer(run):
        begin = m.start()
        at = bisect.bisect_left(dots, begin)
        end = dots[at]
        if run[begin] == "e":
            if TOKEN_HEAD.match(run, begin) and at + 1 < len(dots):
                # The third part ends at a dot, a slash or the end.
                end = dots[min(at + 2, len(dots) - 1)]
                slash = run.find("/", dots[at + 1], end)
                yield begin, end if slash < 0 else slash
        elif run[begin] == "M":
            stop = begin + _der_chars(run, begin)
            if begin < stop <= end and (stop == end or run[stop] in "=/"):
                padding = run[stop : min(end, stop + 2)]
                yield begin, stop + len(padding) - len(padding.lstrip("="))
        elif run[begin] == "3":
            stop = HEX_PART.match(run, begin).end()
            if stop == end or run[stop] == "/":
                yield begin, stop
        elif is_ssh_head(_base64(run[begin : min(end, begin + 96)]) or b""):
            yield begin, end


def _in_run(text: str, start: int, end: int) -> Iterator[tuple[int, int, str]]:
    """Spans in a run: the whole, else what follows an equals sign, else parts of it."""
    whole = text[start:end]
    after = start + whole.rstrip("=").rfind("=") + 1
    for begin in dict.fromkeys((start, after)):
        kind = encoded_kind(text[begin:end]) if end - begin >= MIN_ENCODED else None
        if kind:
            yield begin, end, kind
            return
    done = 0
    for low, high in _parts(whole):
        if low >= done and high - low >= MIN_ENCODED:
            kind = encoded_kind(whole[low:high])
            if kind:
                yield start + low, start + high, kind
                done = high


def structural_spans(text: str) -> list[tuple[int, int, str]]:
    found = []
    for m in BROKEN.finditer(text):
        # What follows the last break may be no part of it, and a last break is none.
        *_, last = BREAK.finditer(text, *m.span())
        for end in (last.start(),) if last.end() == m.end() else (m.end(), last.start()):
            kind = encoded_kind(BREAK.sub("", text[m.start() : end]))
            if kind:
                found.append((m.start(), end, kind))
                break
    broken, at = list(found), 0
    for m in ENCODED.finditer(text):
        start, end = m.span()
        # The letter of a written line break is not of the run.
        if text[start - 1 : start] == "\\" and text[start] in "nrt":
            start += 1
        # A sentence may end right after the token; dots and dashes may lead to it.
        while end > start and text[end - 1] in ".-":
            end -= 1
        while at < len(broken) and broken[at][1] <= start:
            at += 1
        if at == len(broken) or broken[at][0] >= end:
            found += _in_run(text, start, end)
    if "eyJ" in text:
        for m in SHORT_TOKEN.finditer(text):
            if m.end() - m.start() < MIN_ENCODED and text[m.end() : m.end() + 1] not in _MORE and is_jwt(m[0]):
                found.append((m.start(), m.end(), "jwt"))
    return found


def all_spans(text: str) -> tuple[list, list]:
    base = base_spans(text)
    spans = base + structural_spans(text)
    order = {kind: at for at, kind in enumerate(KINDS)}
    return [sorted(x, key=lambda s: (s[0], order[s[2]], s[1])) for x in (base, spans)]


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def _hot(data: bytes) -> bool:
    """Whether a text can hold any secret, decided by plain searches."""
    low = data.lower()
    if b"AKIA" in data or b"eyJ" in data or any(word.encode() in low for word in KEYWORDS):
        return True
    codes = np.frombuffer(data, np.uint8)
    for members, least in ((_IN_CODE, MIN_ENCODED), (_IN_HEX, MIN_HEX)):
        gaps = np.flatnonzero(~members[codes])
        if np.diff(gaps, prepend=-1, append=len(codes)).max(initial=0) > least:
            return True
    return False


_NOTHING = hashlib.sha256(b"").hexdigest()


def find(texts: pa.Array) -> dict[str, list]:
    counts = {kind: [] for kind in ("assign", "access", "hex")}
    digests, spans = [], []
    for data in as_bytes(texts):
        if not _hot(data):
            base, every = [], []
        else:
            base, every = all_spans(data.decode("utf-8", "replace"))
        kinds = [kind for *_, kind in base]
        for kind, found in counts.items():
            found.append(kinds.count(kind))
        digests.append(hashlib.sha256(joined(base).encode()).hexdigest() if base else _NOTHING)
        spans.append(joined(every))
    return {f"n_{kind}": found for kind, found in counts.items()} | {
        "base_sha256": digests,
        "spans": spans,
    }


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with ``n_assign``, ``n_access``, ``n_hex``, ``base_sha256`` and ``spans``.

    Offsets count code points, ends are exclusive. Null texts count as empty and have no span.
    Spans of different kinds may overlap; each row stands for itself, repeated ones included.
    """
    return with_text_columns(docs, text, find, SPANS)


def redacted(text: str, mask: str = "[SECRET]", public: bool = False) -> str:
    """The text with every stretch of secrets replaced; overlapping spans are one stretch.

    Public keys and certificates are no secrets and stay unless ``public`` is set.
    """
    spans = [span for span in all_spans(text)[1] if public or span[2] not in PUBLIC]
    out, at = [], 0
    for start, end, _ in spans:
        if start >= at:
            out += [text[at:start], mask]
        at = max(at, end)
    return "".join([*out, text[at:]]) if spans else text


def redact_secrets(docs: DataFrame, text: str = "text", public: bool = False) -> DataFrame:
    """``docs`` with ``[SECRET]`` for every secret in ``text``; null texts stay null.

    Public keys and certificates are masked, too, if ``public`` is set.
    """

    def redact(texts: pa.Array) -> dict[str, list]:
        out = []
        for text, data in zip(texts.to_pylist(), as_bytes(texts), strict=True):
            out.append(redacted(text, public=public) if text and _hot(data) else text)
        return {"_redacted": out}

    marked = with_text_columns(docs, text, redact, "_redacted string")
    kept = [F.col("_redacted").alias(c) if c == text else quoted(c) for c in docs.columns]
    return marked.select(*kept)
