import hashlib
import zlib

import pytest

from corpusloom.functions import pdf

TREE = {1: b"<</Type /Catalog /Pages 2 0 R>>", 2: b"<</Type /Pages /Kids [3 0 R 4 0 R] /Count 2>>", 3: b"<</Type /Page /Parent 2 0 R>>", 4: b"<</Type /Pages /Kids 6 0 R /Count 1>>", 5: b"<</Type /Page /Parent 4 0 R /Contents 7 0 R>>", 6: b"[5 0 R]", 7: b"<</Length 9>> stream\nq endobj Q\nendstream"}


def made(objects, extra=b"", packed=()):
    out = b"%PDF-1.7\n%\xe2\xe3\xcf\xd3\n" + b"".join(b"%d 0 obj\n%s\nendobj\n" % x for x in objects.items() if x[0] not in packed)
    if packed:
        bodies, places, at = b"", b"", 0
        for n in packed:
            places += b"%d %d " % (n, at)
            bodies += objects[n] + b" "
            at = len(bodies)
        data = zlib.compress(places + bodies)
        out += b"90 0 obj\n<</Type /ObjStm /N %d /First %d /Filter /FlateDecode /Length %d>>\nstream\r\n%s\nendstream\nendobj\n" % (len(packed), len(places), len(data), data)
        return out + b"91 0 obj\n<</Type /XRef /Root 1 0 R /Size 92 %s>>\nstream\nxx\nendstream\nendobj\nstartxref\n0\n%%%%EOF\n" % extra
    return out + b"trailer\n<</Root 1 0 R /Size 9 %s>>\nstartxref\n0\n%%%%EOF\n" % extra


def test_page_trees():
    assert pdf.pdf_verdict(made(TREE)) == (True, None) and pdf.pages(pdf.objects(made(TREE)), 1) == 2
    assert pdf.pdf_verdict(made(TREE, packed=(1, 2, 3, 4, 5, 6))) == (True, None)
    assert pdf.pages(pdf.objects(made(TREE, packed=(2, 4, 6))), 1) == 2
    assert pdf.pdf_verdict(made({k: v for k, v in TREE.items() if k != 5})) == (False, "broken page tree")
    assert pdf.pdf_verdict(made({k: v for k, v in TREE.items() if k != 2})) == (False, "broken page tree")
    assert pdf.pdf_verdict(made(TREE | {6: b"[2 0 R]"})) == (False, "broken page tree")  # a node above itself
    assert pdf.pdf_verdict(made(TREE | {2: b"<</Type /Pages /Kids [] /Count 0>>"})) == (False, "no pages")
    assert pdf.pdf_verdict(made(TREE | {2: b"<</Type /Pages>>"})) == (False, "broken page tree")
    assert pdf.pdf_verdict(made(TREE).replace(b"/Root", b"/Boot")) == (False, "no catalog")
    later = made({k: v for k, v in TREE.items() if k != 5}) + made({5: TREE[5]})  # a change appended
    assert pdf.pdf_verdict(later) == (True, None)
    broken = made(TREE, packed=(1, 2, 3, 4, 5, 6))
    at = broken.index(b"stream\r\n") + 12
    assert pdf.pdf_verdict(broken[:at] + b"zzzz" + broken[at + 4 :]) == (False, "broken page tree")


def handler(revision, password, document):
    """The entries of a security handler for a user's password, by the steps of the format."""
    owner, rights = bytes(range(32)), -44
    padded = (password + pdf.PAD)[:32]
    if revision == 5:
        salt = b"saltsalt"
        user = hashlib.sha256(password + salt).digest() + salt + b"keysalt!"
        return b"<</Filter /Standard /V 5 /R 5 /Length 256 /P %d /O <%s> /U <%s>>>" % (rights, owner.hex().encode(), user.hex().encode())
    size = {2: 5, 3: 16, 4: 16}[revision]
    key = hashlib.md5(padded + owner + (rights & 0xFFFFFFFF).to_bytes(4, "little") + document).digest()
    if revision == 2:
        user = pdf.rc4(key[:5], pdf.PAD)
    else:
        for _ in range(50):
            key = hashlib.md5(key[:size]).digest()
        user = hashlib.md5(pdf.PAD + document).digest()
        for i in range(20):
            user = pdf.rc4(bytes(b ^ i for b in key[:size]), user)
        user += bytes(16)
    escaped = b"".join(b"\\%03o" % c for c in user)  # as octal numbers in brackets
    return b"<</Filter /Standard /V %d /R %d /Length %d /P %d /O <%s> /U (%s)>>" % ({2: 1, 3: 2, 4: 4}[revision], revision, size * 8, rights, owner.hex().encode(), escaped)


@pytest.mark.parametrize("revision", [2, 3, 4, 5])
def test_encrypted_files_open_with_the_empty_password(revision):
    document = b"0123456789abcdef"
    extra = b"/Encrypt 8 0 R /ID [<%s> <00>]" % document.hex().encode()
    for password, want in ((b"", (True, None)), (b"secret", (False, "encrypted"))):
        assert pdf.pdf_verdict(made(TREE | {8: handler(revision, password, document)}, extra)) == want
    direct = b"/Encrypt %s /ID [<%s> <00>]" % (handler(revision, b"", document), document.hex().encode())
    assert pdf.pdf_verdict(made(TREE, direct)) == (True, None)
    assert pdf.pdf_verdict(made({k: v for k, v in TREE.items() if k != 5} | {8: handler(revision, b"", document)}, extra)) == (False, "broken page tree")


def test_other_handlers_are_locked():
    assert pdf.pdf_verdict(made(TREE, b"/Encrypt 8 0 R /ID [<00> <00>]")) == (False, "encrypted")
    assert pdf.pdf_verdict(made(TREE | {8: b"<</Filter /Other /V 1 /R 2>>"}, b"/Encrypt 8 0 R")) == (False, "encrypted")


def test_known_cipher():
    assert pdf.rc4(b"Key", b"Plaintext").hex() == "bbf316e8d940af0ad3"
