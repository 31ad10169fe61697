import base64
import bz2
import gzip
import hashlib
import io
import lzma
import random
import re
import urllib.parse
import zipfile
import zlib

from pricewright.llm import secret_scan
from pricewright.llm.secret_scan import PLACEHOLDER, find, redact, redact_documents, scan, secret_digests

KEY = "AKIA" + "Q" * 16
HEX = "0123456789abcdef01234567"


def brute(text):
    """The contract's patterns as written, failing matches dropped afterwards."""
    rules = [
        ("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6, re.I | re.A),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20, 0),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24, 0),
    ]
    found = [(m.start(), i, m.end()) for i, (_, p, ok, f) in enumerate(rules) for m in re.finditer(p, text, f) if ok(m)]
    return sorted(found)


def test_base_spans_are_the_patterns():
    texts = [
        f'password = "{HEX}" and token:abc secret=token: abcdef', f"AKIAAKIA {KEY}{KEY} {KEY[:-1]}", "ſecret=abcdefg toKen=abcdefg",
        "token=a.b, API_KEY : 'xyz-123_4' apikey=123456", HEX[:-1], HEX * 3 + "g" + HEX, "passwd==abcdef", "é" * 30 + f" token={HEX}",
    ]
    for text in texts:
        assert find(text) == brute(text), text


def test_layers_map_to_the_original():
    secret = f"password={HEX}"
    url = urllib.parse.quote(secret, safe="").replace("p", "%70", 1)
    escaped = "".join(f"\\u{ord(c):04x}" for c in KEY)
    packed = base64.b64encode(gzip.compress(f"x {KEY} y".encode())).decode()
    twice = base64.b64encode(base64.b64encode(f"api_key: {KEY} in here".encode())).decode()
    for code, inner in ((url, secret), (escaped, KEY), (packed, KEY), (twice, KEY)):
        text = f"Überall é {code} end."
        base, spans, layers, _ = scan(text)
        added = set(spans) - set(base)
        assert added and layers, code
        begin, end = text.index(code), text.index(code) + len(code)
        assert all(begin <= a < b <= end for a, _, b in added), (added, begin, end)
    begin = "see ".__len__()
    text = "see " + escaped + " now"
    assert (begin, 1, begin + len(escaped)) in scan(text)[1]


def test_no_endless_unwrapping():
    text = "%2525252541"
    for _ in range(12):
        text = base64.b64encode(text.encode()).decode()
    assert scan(text)[1] == scan(text)[1]
    assert scan("%25" * 500)[2] < 2000
    bomb = base64.b64encode(gzip.compress(b"a" * 50_000_000)).decode()
    assert scan(bomb)[3] == 1


def test_clean_texts_have_none():
    text = "Internationalization of incomprehensibilities, 100%%% sure & done. Misunderstandings_everywhere/and/everything"
    assert scan(text)[1] == []


def test_redaction():
    text = f"a token = {HEX} b"
    assert redact(text, scan(text)[1]) == f"a {PLACEHOLDER} b"


def test_rows_of_any_kind(spark):
    text = f"é token={HEX} x"
    rows = [(1, text, "s", 5), (1, text, "s", 5), (2, None, None, None), (None, "plain", "t", 5), (3, "", "t", 0), (4, "word " * 60_000, "t", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_chars long")
    got = {r.doc_id: r for r in secret_digests(docs).collect()}
    assert secret_digests(docs).count() == len(rows)
    joined = f"assign:2:{2 + 6 + 24},hex:8:{8 + 24}"
    assert got[1].spans == joined and got[1].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
    assert (got[1].n_assign, got[1].n_access, got[1].n_hex) == (1, 0, 1)
    assert got[2].spans == "" and got[2].base_sha256 == hashlib.sha256(b"").hexdigest()
    clean = redact_documents(docs, length="n_chars")
    assert clean.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in clean.filter("doc_id = 1 or doc_id is null").collect()) == [(0, "plain"), (1, f"é {PLACEHOLDER} x"), (1, f"é {PLACEHOLDER} x")]
    assert secret_digests(docs.limit(0)).collect() == []


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in secret_digests(docs).collect():
        want = ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in brute(texts[r.doc_id]))
        assert r.base_sha256 == hashlib.sha256(want.encode()).hexdigest()


def test_compressed_layers_are_read_to_their_end(monkeypatch):
    """A secret behind what one piece or one stream holds."""
    monkeypatch.setattr(secret_scan, "INFLATED_BYTES", 300_000)
    monkeypatch.setattr(secret_scan, "OVERLAP", 2_000)
    filler, secret = b"all work and no play. " * 30_000, f" {KEY} ".encode()
    noise = random.Random(4).randbytes(600_000)
    packed = {
        "beyond a piece": gzip.compress(filler + secret, mtime=0),
        "across pieces": zlib.compress(b"." * (300_000 - 10) + secret + filler),
        "second gzip member": gzip.compress(b"first. ", mtime=0) + b"\0" * 7 + gzip.compress(secret, mtime=0),
        "second bz2 stream": bz2.compress(b"first. ") + bz2.compress(secret),
        "second xz stream": lzma.compress(b"first. ") + b"\0" * 4 + lzma.compress(secret),
        "plain text behind a stream": gzip.compress(b"first. ", mtime=0) + secret,
        "nested beyond a piece": gzip.compress(filler + b" " + base64.b64encode(gzip.compress(secret * 3, mtime=0)) + b" ", mtime=0),
        "stream in a run longer than a piece": bz2.compress(b"x " + base64.b64encode(gzip.compress(noise + secret, mtime=0)) + b" ."),
        "behind a run longer than a piece": bz2.compress(b"x " + base64.b64encode(noise) + b" ." + secret),
    }
    for name, data in packed.items():
        code = base64.b64encode(data).decode()
        assert (2, 1, 2 + len(code)) in scan(f"é {code} .")[1], name


def test_redaction_beyond_a_piece(spark):
    code = base64.b64encode(gzip.compress(b"all work and no play. " * 900_000 + KEY.encode(), mtime=0)).decode()
    docs = spark.createDataFrame([(1, f"a {code} b")], "doc_id long, text string")
    assert [r.text for r in redact_documents(docs).collect()] == [f"a {PLACEHOLDER} b"]


def test_any_text_in_base64():
    for odd in ("\u00a0", "\ufeff", "\u200b", "\u3000", "\f", "\x00", "\U000e0001"):
        code = base64.b64encode(f"{odd} é password={HEX} x".encode()).decode()
        a = len("a ")
        found = {(b, e) for b, k, e in scan(f"a {code} b")[1] if k == 0}
        before = len(f"{odd} é ".encode())
        assert (a + before * 8 // 6, a + -(-(before + len(f"password={HEX}")) * 8 // 6)) in found, repr(odd)


def test_base64_over_several_lines():
    noise = random.Random(6).randbytes(600)
    prose = b"all work and no play makes it dull, " * 6
    for newline in ("\n", "\r\n"):
        for size in range(4):  # the last line and its padding
            plain = prose[:50] + KEY.encode() + prose[: 60 + size]
            for inner in (plain, gzip.compress(base64.b85encode(noise) + f" {KEY} ".encode() + noise[: 3 + size], mtime=0)):
                code = base64.b64encode(inner).decode()
                block = newline.join(code[i : i + 76] for i in range(0, len(code), 76))
                for lead, tail in (("see: ", " end"), ("attachment_of_the_message" + newline, newline * 2 + "Yours"), ("x" + newline * 2, newline + "- y")):
                    found = [(b, e) for b, k, e in scan(lead + block + tail)[1] if k == 1]
                    if inner is plain:
                        at = 50 * 8 // 6
                        assert len(lead) + at + at // 76 * len(newline) in [b for b, _ in found], (lead, tail)
                    else:
                        assert (len(lead), len(lead) + len(block)) in found, (lead, tail)
    text = f"a {block} b"
    assert redact(text, scan(text)[1]) == f"a {PLACEHOLDER} b"


def raw_deflate(data):
    made = zlib.compressobj(9, zlib.DEFLATED, -15)
    return made.compress(data) + made.flush()


def zipped(data):
    file = io.BytesIO()
    with zipfile.ZipFile(file, "w", zipfile.ZIP_DEFLATED) as archive:
        archive.writestr("notes.txt", data * 3)
    return file.getvalue()


def test_text_in_other_encodings():
    """Spans are those of the secret's bytes, whatever is glued to the run."""
    for encoding, before, width in (("latin-1", "é ü ", 1), ("utf-16-le", "é日 ", 2), ("utf-16-be", " é日 ", 2), ("utf-16-le", "", 2), ("utf-16-be", "", 2)):
        code = base64.b64encode(f"{before}{KEY} ü".encode(encoding)).decode()
        for lead in ("", "x", "xy", "xyz", "word", "see: "):
            begin = len(before) * width
            a, b = (len(lead) + 2 + begin * 8 // 6, len(lead) + 2 + -(-(begin + len(KEY) * width) * 8 // 6))
            assert (a, 1, b) in scan(f"( {lead}{code} )")[1], (encoding, before, lead)
    odd = base64.b64encode(b"a" + KEY.encode("utf-16-le")).decode()
    assert any(k == 1 for _, k, _ in scan(odd)[1])


def test_streams_behind_other_bytes():
    plain = f"all work {KEY} and no play".encode()
    packed = {
        "raw deflate": raw_deflate(plain), "lzma alone": lzma.compress(plain, format=lzma.FORMAT_ALONE), "zip": zipped(plain),
        "gzip of UTF-16": gzip.compress(plain.decode().encode("utf-16"), mtime=0), "zlib of Latin-1": zlib.compress(plain + "é".encode("latin-1")),
    }
    for name, make in {"gzip": gzip.compress, "zlib": zlib.compress, "bz2": bz2.compress, "xz": lzma.compress}.items():
        packed[name + " behind a header"] = b"HEAD\0\xff" + make(plain)
        packed[name + " behind another"] = gzip.compress(b"first", mtime=0) + b"HEAD\0\xff" + make(plain)
    for name, data in packed.items():
        code = base64.b64encode(data).decode()
        for lead in ("", "x", "xy", "xyz"):
            start = 2 + len(lead)
            assert (start, 1, start + len(code)) in scan(f"( {lead}{code} )")[1], (name, lead)


def test_random_nests():
    draw = random.Random(12)
    steps = {
        "base64": lambda d: base64.b64encode(d), "urlsafe": lambda d: base64.urlsafe_b64encode(d), "percent": lambda d: "".join(f"%{b:02x}" for b in d).encode(),
        "escapes": lambda d: "".join(f"\\x{b:02x}" for b in d).encode(), "gzip": lambda d: base64.b64encode(b"h" + gzip.compress(d, mtime=0)),
        "deflate": lambda d: base64.b64encode(raw_deflate(d)), "utf16": lambda d: base64.b64encode(d.decode("latin-1").encode("utf-16-le")),
        "glued": lambda d: b"ab." + d + b".", "spaced": lambda d: b"see " + d + b" there",
    }
    for _ in range(150):
        data, names = f"my {KEY} .".encode(), [draw.choice(list(steps)) for _ in range(draw.randrange(1, 5))]
        for name in names:
            data = steps[name](data)
        text = f"é ( {data.decode()} ) end"
        found = [(a, b) for a, k, b in scan(text)[1] if k == 1]
        assert any(4 <= a < b <= 4 + len(data) + 1 for a, b in found), names


def test_noise_has_no_secrets():
    noise = random.Random(3)
    for size in (12, 50, 5_000):
        for _ in range(20):
            assert scan(f"see {base64.b64encode(noise.randbytes(size)).decode()} there")[1] == []
