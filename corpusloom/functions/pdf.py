"""Whether a PDF can be opened without a password and has pages: objects by their numbers, object streams, the page tree and the standard security handler."""

from __future__ import annotations

import hashlib
import re
import zlib

#: Fixed value of the format: what passwords are filled up with.
PAD = bytes.fromhex("28BF4E5E4E758A4164004E56FFFA01082E2E00B6D0683E802F0CA9FE6453697A")
OBJECT = re.compile(rb"(?<!\d)(\d{1,9})\s+\d{1,5}\s+obj\b")
ESCAPES = {b"n": b"\n", b"r": b"\r", b"t": b"\t", b"b": b"\b", b"f": b"\f"}


def objects(data: bytes) -> dict[int, bytes]:
    """Bodies of all objects; of several with a number the last one, as later changes are appended. Those of object streams stand in for numbers that aren't found plainly."""
    starts = list(OBJECT.finditer(data))
    found = {int(m[1]): data[m.end() : n.start() if n else len(data)] for m, n in zip(starts, [*starts[1:], None], strict=False)}
    found = {k: body if b"stream" in body else body.partition(b"endobj")[0] for k, body in found.items()}
    for body in list(found.values()):
        if re.search(rb"/Type\s*/ObjStm\b", body) and (m := re.search(rb"stream\r?\n", body)):
            count, first = (int(x[1]) if (x := re.search(rb"/%s\s+(\d+)" % k, body)) else 0 for k in (b"N", b"First"))
            try:
                packed = zlib.decompressobj().decompress(body[m.end() :]) if b"/FlateDecode" in body else body[m.end() :]
                places = [int(x) for x in packed[:first].split()[: 2 * count]]
            except (zlib.error, ValueError):
                continue  # encrypted or damaged: its objects are missing
            ends = [*places[3::2], len(packed) - first]
            for number, at, end in zip(places[::2], places[1::2], ends, strict=False):
                found.setdefault(number, packed[first + at : first + end])
    return found


def reference(body: bytes, key: bytes) -> int | None:
    m = re.search(rb"/%s\s+(\d+)\s+\d+\s+R\b" % key, body)
    return int(m[1]) if m else None


def string(body: bytes, key: bytes) -> bytes:
    """A string value, in brackets or as hexadecimal digits."""
    m = re.search(rb"/%s\s*[\[\s]*(?:<([0-9A-Fa-f\s]*)>|\(((?:\\.|[^\\()]|\((?:\\.|[^\\()])*\))*)\))" % key, body, re.DOTALL)
    if not m:
        return b""
    if m[1] is not None:
        digits = re.sub(rb"\s", b"", m[1])
        return bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
    return re.sub(rb"\\([0-7]{1,3}|\r?\n|.)", lambda e: bytes([int(e[1], 8) & 255]) if e[1][:1].isdigit() else b"" if e[1].strip(b"\r") == b"\n" else ESCAPES.get(e[1], e[1]), m[2], flags=re.DOTALL)


def rc4(key: bytes, text: bytes) -> bytes:
    box, j = list(range(256)), 0
    for i in range(256):
        j = (j + box[i] + key[i % len(key)]) % 256
        box[i], box[j] = box[j], box[i]
    out, j = bytearray(), 0
    for k, c in enumerate(text, 1):
        i = k % 256
        j = (j + box[i]) % 256
        box[i], box[j] = box[j], box[i]
        out.append(c ^ box[(box[i] + box[j]) % 256])
    return bytes(out)


def opens_without_password(handler: bytes, document: bytes) -> bool:
    """Whether the empty password is the user's, in revisions 2 to 5 of the standard handler; other handlers and revision 6 count as locked."""
    number = lambda key, default: int(m[1]) if (m := re.search(rb"/%s\s+(-?\d+)" % key, handler)) else default
    revision, size = number(b"R", 0), number(b"Length", 40) // 8 if number(b"V", 0) != 1 else 5
    owner, user = string(handler, b"O"), string(handler, b"U")
    if b"/Standard" not in handler or revision not in (2, 3, 4, 5) or not user or not size:
        return False
    if revision == 5:
        return hashlib.sha256(user[32:40]).digest() == user[:32]
    if revision == 4:
        size = 16
    plain = revision == 4 and re.search(rb"/EncryptMetadata\s+false", handler)
    key = hashlib.md5(PAD + owner[:32] + (number(b"P", 0) & 0xFFFFFFFF).to_bytes(4, "little") + document + (b"\xff" * 4 if plain else b"")).digest()
    if revision == 2:
        return rc4(key[:5], PAD) == user[:32]
    for _ in range(50):
        key = hashlib.md5(key[:size]).digest()
    made = hashlib.md5(PAD + document).digest()
    for i in range(20):
        made = rc4(bytes(b ^ i for b in key[:size]), made)
    return made == user[:16]


def pages(known: dict[int, bytes], root: int | None) -> int | None:
    """Pages below the catalog's tree, or None if a node of it is missing or stands twice."""
    top = reference(known.get(root, b""), b"Pages") if root is not None else None
    todo, seen, count = [top], set(), 0
    while todo:
        at = todo.pop()
        if at is None or at not in known or at in seen:
            return None
        seen.add(at)
        body = known[at]
        if (kids := re.search(rb"/Kids\s*(?:\[([^\]]*)\]|(\d+)\s+\d+\s+R)", body)) is None:
            if re.search(rb"/Type\s*/Pages\b", body):
                return None
            count += 1
            continue
        listed = kids[1] if kids[1] is not None else known.get(int(kids[2]), b"")
        todo += [int(x) for x in re.findall(rb"(\d+)\s+\d+\s+R\b", listed)]
    return count


def pdf_verdict(data: bytes | None) -> tuple[bool, str | None]:
    """Whether the file is whole, opens without a password and has pages, and why not.

    `missing`, `empty`, `no PDF header`, `truncated` (no end mark in the last 4096 bytes), `no catalog`, `encrypted` (not opened by the empty password), `broken page
    tree`, `no pages`. The cross-reference table isn't trusted: objects are found by their headers, as tolerant readers do where the table is wrong. Where
    objects are encrypted inside object streams, pages can't be counted, and a file that opens is taken as it is.
    """
    if data is None:
        return False, "missing"
    if not data:
        return False, "empty"
    if not data.startswith(b"%PDF-"):
        return False, "no PDF header"
    if b"%%EOF" not in data[-4096:]:
        return False, "truncated"
    known = objects(data)
    trailers = [*re.split(rb"\btrailer\b", data)[1:], *(b for b in known.values() if re.search(rb"/Type\s*/XRef\b", b))]
    heads = [t.partition(b"stream")[0].partition(b"startxref")[0] for t in trailers]
    root = next((r for t in reversed(heads) if (r := reference(t, b"Root")) is not None), None)
    if root is None:
        return False, "no catalog"
    locked = [t for t in heads if b"/Encrypt" in t]
    if locked:
        at = reference(locked[-1], b"Encrypt")
        handler = known.get(at, b"") if at is not None else locked[-1].partition(b"/Encrypt")[2]
        if not opens_without_password(handler, string(locked[-1], b"ID")):
            return False, "encrypted"
        if root not in known and b"/ObjStm" in data:
            return True, None
    count = pages(known, root)
    return (False, "broken page tree") if count is None else (False, "no pages") if not count else (True, None)
