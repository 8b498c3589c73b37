import base64
import bz2
import gzip
import hashlib
import re
import zlib
from urllib.parse import quote

import pytest

from corploom.llm.queries import op1_secret_scan
from corploom.llm.secret_scan import KINDS, find, scan, scan_secrets
from tests.conftest import DATA
from tests.llm.cases import edge, empty, given

SECRET = 'api_key = "abcDEF123456"'
KEY = "AKIA" + "Q7ZX" * 4


def plain(text):
    """The contract, once more: leftmost matches, those too short dropped."""
    found = []
    for m in re.finditer(
        r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
        r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        text,
    ):
        if len(m[2]) >= 6:
            found.append((m.start(), 0, m.end()))
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def joined(spans):
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def b64(data):
    return base64.b64encode(data).decode()


def test_base_of_given_documents(spark):
    got = {r.doc_id: r for r in op1_secret_scan(spark, DATA).collect()}
    rows = given()
    assert len(got) == len(rows)
    for key, text in rows:
        base = plain(text or "")
        r = got[key]
        assert [r.n_assign, r.n_access, r.n_hex] == [sum(k == i for _, k, _ in base) for i in range(3)]
        assert r.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
        assert set(joined(base).split(",")) <= set(r.spans.split(","))


def test_letters_of_other_scripts_are_not_folded():
    assert find("toKen = abcdef123456") == [] and find("paſſword: abcdef123456") == []


@pytest.mark.parametrize(
    "wrap",
    [
        lambda s: quote(s, safe=""),
        lambda s: "".join(f"%{b:02x}" for b in s.encode()),
        lambda s: "".join(f"\\u{ord(c):04x}" for c in s),
        lambda s: "".join(f"\\x{ord(c):02X}" for c in s),
        lambda s: "".join(f"&#{ord(c)};" for c in s),
        lambda s: "".join(chr(ord(c) + 0xFEE0) if "!" <= c <= "~" else c for c in s),
        lambda s: b64(s.encode()),
        lambda s: b64(s.encode()).replace("+", "-").replace("/", "_").rstrip("="),
        lambda s: b64(gzip.compress(s.encode())),
        lambda s: b64(zlib.compress(s.encode())),
        lambda s: b64(gzip.compress(zlib.compress(s.encode()))),
        lambda s: b64(quote(b64(gzip.compress(s.encode())), safe="").encode()),
        lambda s: quote(quote(quote(s, safe=""), safe=""), safe=""),
        lambda s: "".join(f"\\u{ord(c):04x}" for c in b64(s.encode())),
    ],
)
def test_every_layer_is_unwrapped(wrap):
    inner = wrap(f"see {SECRET} and {KEY}!")
    text = f"héad\n{inner} tail"
    start, end = text.index(inner), text.index(inner) + len(inner)
    base, spans, _ = scan(text)
    kinds = {k for s, k, e in spans if start <= s and e <= end}
    assert {0, 1} <= kinds
    assert set(base) <= set(spans)


def test_spans_map_back_exactly():
    text = "x " + "".join(f"%{b:02X}" for b in b"ab token=abcdefgh z") + " y"
    _, spans, _ = scan(text)
    assert (2 + 9, 0, 2 + 9 + 3 * len("token=abcdefgh")) in spans
    inner = "ab token=abcdefgh zz"
    text = "é " + b64(inner.encode()) + "."
    _, spans, _ = scan(text)
    (span,) = [s for s in spans if s[1] == 0]
    raw = base64.b64decode(b64(inner.encode()))
    at, to = raw.index(b"token"), raw.index(b"token") + len("token=abcdefgh")
    assert span == (2 + at * 4 // 3, 0, 2 + -(-to * 4 // 3))


ODD = ["\ufeff", "\u00a0", "\u200d", "\x1b[0m", "\x00"]


@pytest.mark.parametrize("odd", [c.encode() for c in ODD] + [b"\xe9", b"\xff\xfe", b"x ", b"8n", b"hC", b"(S", b"BZh9"])
@pytest.mark.parametrize("zipped", (False, True))
def test_odd_bytes_do_not_hide_a_layer(odd, zipped):
    data = odd + b" see password=hunter22 now " + odd + b" " + b64(SECRET.encode()).encode()
    text = f"é {b64(gzip.compress(data) if zipped else data)} z"
    _, spans, depth = scan(text)
    assert depth >= 2
    if zipped:
        assert {(2, 0, len(text) - 2)} == set(spans)
    else:
        at = data.index(b"password")
        assert (2 + at * 4 // 3, 0, 2 + -(-(at + 17) * 4 // 3)) in spans and len(spans) == 2


def test_text_that_looks_compressed_inside_compressed_data():
    for head in (b"x ", b"hC", b"BZh", b"BZh9 "):
        text = b64(gzip.compress(head + SECRET.encode()))
        assert [k for _, k, _ in scan(text)[1]] == [0]
    twice = b64(gzip.compress(b"") + gzip.compress(zlib.compress(SECRET.encode())) + b"tail")
    assert {k for _, k, _ in scan(twice)[1]} == {0}


@pytest.mark.parametrize("wrap", (bytes, gzip.compress, zlib.compress, bz2.compress, lambda s: zlib.compress(s, 1)))
@pytest.mark.parametrize(
    "prefix", ("https://host/path/", "key-", "id_", "a/", "ab/", "abc/", "/", "k", "ke", "key", "x-y_z/a-", "0123456789abcdefg")
)
def test_base64_after_other_letters_of_it(prefix, wrap):
    inner = b64(wrap(f"see {SECRET} now".encode())).rstrip("=")
    text = f"é {prefix}{inner}. {prefix}{inner.replace('/', '_').replace('+', '-')}/more-of_it ."
    _, spans, _ = scan(text)
    first = 2 + len(prefix)
    second = first + len(inner) + 2 + len(prefix)
    assert any(k == 0 and first <= s and e <= first + len(inner) for s, k, e in spans)
    assert any(k == 0 and second <= s and e <= len(text) - 2 for s, k, e in spans)


def test_layers_after_other_letters_are_unwrapped_on():
    text = f"id_{b64(f'key-{b64(SECRET.encode())}'.encode())}"
    assert 0 in {k for _, k, _ in scan(text)[1]}


def test_a_text_that_unwraps_to_itself_ends():
    assert scan("%25" * 50)[2] < 50
    text = "%2525252525"
    assert scan(text)[2] == 5
    assert scan("\\u005cu005cu005c")[2] < 10


def test_large_unpacked_layers_are_scanned_to_the_end():
    inner = "a " * 3_000_000 + SECRET
    text = b64(gzip.compress(inner.encode()))
    assert [k for _, k, _ in scan(text)[1]] == [0]


def test_damaged_layers_are_left_alone():
    whole = b64(gzip.compress(SECRET.encode() * 50))
    scan(whole[: len(whole) // 2])
    scan("%GG %4 \\u12 \\U0011FFFF &#99999999; &#xD800; =====")


def test_edge_rows(spark):
    rows = scan_secrets(edge(spark)).collect()
    assert len(rows) == edge(spark).count()
    assert all(r.spans == [] for r in rows if r.doc_id in (1, 2, 3))
    assert scan_secrets(empty(spark)).collect() == []
