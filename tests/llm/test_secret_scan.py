import base64
import bz2
import gzip
import hashlib
import io
import lzma
import random
import re
import time
import urllib.parse
import zlib

import pytest
import zstandard

from punktwerk.llm import secret_scan as secrets

NAMES = "(password|passwd|secret|token|api_?key)"
KEY = "AKIA" + "Q" * 16
ASSIGN = 'api_key = "hunter2-hunter2"'


def base_spans(text):
    """The contract's words, plainly."""
    either = "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in NAMES)
    out = []
    for kind, pattern, group, least in (("assign", either + """["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
                                        ("access", "AKIA[A-Z0-9]+", 0, 16), ("hex", "[0-9a-f]+", 0, 32)):
        out += [(m.start(), i, kind, m.end()) for i, m in [(["assign", "access", "hex"].index(kind), m) for m in re.finditer(pattern, text)]
                if len(m.group(group)) >= least]
    return [(k, a, b) for a, _, k, b in sorted(out)]


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def spans_of(text, **options):
    return secrets.all_spans(text, list(secrets.matches(text)), **options)


def b64(x, safe=False):
    return (base64.urlsafe_b64encode if safe else base64.b64encode)(x if isinstance(x, bytes) else x.encode()).decode()


def percent(x):
    return "".join(f"%{b:02X}" for b in x.encode())


def unicode_escape(x):
    return "".join(f"\\u{ord(c):04x}" for c in x)


PACKERS = [gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.ZstdCompressor().compress]


def test_base_spans_on_hard_texts():
    rng = random.Random(1)
    parts = ["password", "Secret", "TOKEN", "api_key", "apikey", "passwd", "=", ":", " ", "   ", "'", '"', "abcdefgh", "x", "AKIA", "AKIAABCDEFGHIJKL",
             "0123456789abcdef" * 2, "deadbeef", "ſecret", "toKen", "é", "\n", ".", "="]
    for _ in range(3000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(1, 14)))
        found = sorted(secrets.matches(text), key=lambda s: (s[1], list(secrets.KINDS).index(s[0]), s[2]))
        assert found == base_spans(text), text


@pytest.mark.parametrize("pack", PACKERS)
def test_compressed(pack):
    run = b64(pack((ASSIGN + " and prose " * 40).encode()))
    text = f"x é {run} end"
    assert ("assign", 4, 4 + len(run.rstrip("="))) in spans_of(text)
    wrapped = base64.encodebytes(pack(random.Random(2).randbytes(300).hex().upper().encode() + ASSIGN.encode())).decode()
    assert any(k == "assign" for k, _, _ in spans_of("see\n" + wrapped + "end"))


def test_places_of_escaped_characters():
    for enc, width in ((percent, 3), (unicode_escape, 6), (lambda x: "".join(f"&#{ord(c)};" for c in x), None),
                       (lambda x: "".join(f"\\x{ord(c):02x}" for c in x), 4), (lambda x: "".join(f"\\u{{{ord(c):x}}}" for c in x), None)):
        run = enc(KEY)
        text = "é before " + run + " after"
        assert ("access", 9, 9 + len(run)) in spans_of(text)
    text = "token%3Dabcdefghij"
    assert spans_of(text) == {("assign", 0, len(text))}
    assert spans_of("p%C3%A9 token%3dabcdefghij.") == {("assign", 8, 27)}


def test_nested_at_random():
    rng = random.Random(3)
    for _ in range(300):
        x, kind = rng.choice([(KEY, "access"), (ASSIGN, "assign"), ("0f" * 20, "hex")])
        for _ in range(rng.randint(1, 4)):
            x = rng.choice([percent, unicode_escape, b64, lambda t: b64(t, True), lambda t: b64(rng.choice(PACKERS)(t.encode()))])(
                rng.choice(["", "some words "]) + x + rng.choice(["", " more"]))
        text = f"Début {x} fin"
        inner = [s for s in spans_of(text) if s[0] == kind and 6 <= s[1] < s[2] <= 6 + len(x)]
        assert inner, text
        assert set(base_spans(text)) <= spans_of(text)


def test_base64_behind_other_signs():
    for front in ("/", "a/", "ab/", "abc/", "url=", "x:"):
        run = b64("here is " + KEY)
        assert any(k == "access" for k, _, _ in spans_of(front + run)), front
    # the place of a secret inside the run, not the whole run
    run = b64("x" * 300 + KEY + "y" * 300)
    (_, a, b), = [s for s in spans_of(run) if s[0] == "access"]
    assert 400 <= a <= 400 + 2 and b - a <= 20 / 3 * 4 + 3


def test_cycles_end(monkeypatch):
    """A layer that unwraps to itself is met once."""
    same = lambda layer, piece, overlap: iter([secrets.Layer(layer.text, 0, 3)])
    monkeypatch.setattr(secrets, "unwrapped", same)
    assert spans_of(KEY) == {("access", 0, 20), ("access", 0, 3)}


def test_bombs_and_chains():
    # 200 MB of text in a few KB, scanned in pieces; the secret at the end counts
    sink = io.BytesIO()
    with gzip.GzipFile(fileobj=sink, mode="wb") as z:
        for _ in range(100):
            z.write(b"nothing to see here\n" * 100_000)
        z.write(ASSIGN.encode())
    started = time.time()
    assert any(k == "assign" for k, _, _ in spans_of("a " + b64(sink.getvalue())))
    for text in ("%" + "25" * 400_000 + "41" + percent(KEY), "\\" + "x5c" * 300_000 + "x41 " + unicode_escape(KEY), "&" + "#38;" * 200_000 + "#65; " + percent(KEY)):
        assert any(k == "access" for k, _, _ in spans_of(text))
    for text in ("a" * 10 ** 6, "password" * 10 ** 5, "%41" * 300_000, "0" * 31 + " " * 10 ** 6, "AKIA" * 10 ** 5, "password" + " " * 10 ** 6):
        spans_of(text)
    assert time.time() - started < 120


def test_pieces_give_the_same():
    rng = random.Random(5)
    lines = [rng.choice(["words here", KEY, ASSIGN, "f0" * 20, percent(KEY), b64(KEY + " x")]) for _ in range(300)]
    for sep in (" ", "\n", ", é"):
        data = sep.join(lines).encode()
        run = b64(zlib.compress(data))
        assert spans_of(run, piece=700, overlap=100) == spans_of(run)


def test_damaged_streams():
    good = gzip.compress((ASSIGN + " " + random.Random(1).randbytes(2000).hex()).encode())
    for cut in (0, 1, 5, 20, 500):
        spans_of(b64(good[:cut]) + " " + b64(good[:100] + b"\x00" * 30 + good[130:]))


def test_query_columns(spark, edge):
    rows = [(1, f"x {ASSIGN}"), (2, None), (3, ""), (None, KEY), (4, percent(KEY)), (4, percent(KEY))]
    df = spark.createDataFrame([(*r, "s") for r in rows], "doc_id long, text string, spans string").repartition(3)
    empty = hashlib.sha256(b"").hexdigest()
    want = [(1, 1, 0, 0, hashlib.sha256(b"assign:2:28").hexdigest(), "assign:2:28"), (2, 0, 0, 0, empty, ""), (3, 0, 0, 0, empty, ""),
            (None, 0, 1, 0, hashlib.sha256(b"access:0:20").hexdigest(), "access:0:20"), *[(4, 0, 0, 0, empty, "access:0:60")] * 2]
    assert sorted(map(tuple, secrets.scan(df).collect()), key=repr) == sorted(want, key=repr)
    assert secrets.scan(edge).count() == edge.count()
    assert secrets.scan(edge.limit(0)).count() == 0


def test_given_table(spark, sf_docs):
    found = {r["doc_id"]: r for r in secrets.scan(spark.createDataFrame(sf_docs)).collect()}
    assert len(found) == len(sf_docs)
    for doc, text in zip(sf_docs["doc_id"], sf_docs["text"]):
        base = base_spans(text or "")
        r = found[doc]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(s[0] == k for s in base) for k in ("assign", "access", "hex")]
        assert r["base_sha256"] == hashlib.sha256(joined(base).encode()).hexdigest()
        assert set(joined(base).split(",")) <= set(r["spans"].split(","))
