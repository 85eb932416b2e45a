"""Secrets in layers that are not plain, whole or alone."""

import base64
import bz2
import gzip
import lzma
import urllib.parse
import zlib

import pytest
import zstandard

from weighbridge.llm import secret_scan

SECRET = "password=hunter2abc"


def found(text):
    return secret_scan.secrets_in(text)[1]


@pytest.mark.parametrize("raw", [
    f"\0user\0{SECRET}\0".encode(), SECRET.encode("utf-16"), SECRET.encode("utf-16-be"), f"x{SECRET}".encode("utf-16-be")[1:],
    f"caf\xe9 {SECRET}".encode("latin-1"), f"\x1b[31m {SECRET}".encode(), b"\xff\xfe\x80\x01" * 9 + SECRET.encode(),
    f"\ufffd {SECRET}".encode(),
])
@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_layers_with_unreadable_bytes(raw, pack):
    text = f"before {base64.b64encode(pack(raw)).decode()} after"
    spans = found(text)
    assert spans and all(7 <= s < e <= len(text) - 6 for s, _, e in spans)


LONG = " ".join(f"é{n * n}" for n in range(300)) + f" {SECRET} " + " ".join(f"ü{n * n}" for n in range(300))


@pytest.mark.parametrize("pack", [bytes, gzip.compress])
@pytest.mark.parametrize("brk", ["\n", "\r\n", "\n    ", "\\n"])
@pytest.mark.parametrize("width", [17, 64, 76])
def test_wrapped_base64(pack, brk, width):
    for shift in range(8):
        blob = base64.b64encode(pack((" " * shift + LONG).encode())).decode()
        text = "before\n" + brk.join(blob[i : i + width] for i in range(0, len(blob), width)) + " after"
        spans = found(text)
        assert spans and all(7 <= s < e <= len(text) - 6 for s, _, e in spans)
        if pack is bytes:
            assert all(e - s < 50 for s, _, e in spans)


@pytest.mark.parametrize("prefix", ["blob/", "id_", "x-y-", "/a/b/", "v1", "abc", "q"])
@pytest.mark.parametrize("pack", [bytes, gzip.compress])
def test_base64_after_characters_of_its_class(prefix, pack):
    for encode in (base64.b64encode, base64.urlsafe_b64encode):
        assert found(f"see {prefix}{encode(pack(SECRET.encode())).decode()} there")


PACKS = [gzip.compress, zlib.compress, bz2.compress, lzma.compress, zstandard.compress]


@pytest.mark.parametrize("pack", PACKS)
@pytest.mark.parametrize("write", [
    urllib.parse.quote, urllib.parse.quote_plus, repr, lambda raw: "".join(f"%{b:02X}" for b in raw),
    lambda raw: "".join(f"\\x{b:02x}" for b in raw),
])
def test_compressed_bytes_as_escapes(write, pack):
    text = f"see {write(pack(f'a long {SECRET} here'.encode() * 5))} there, and more"
    spans = found(text)
    assert spans and all(s >= 4 and s < e <= text.index(" there") for s, _, e in spans)


@pytest.mark.parametrize("pack", PACKS)
@pytest.mark.parametrize("pad", [b"", b"\0" * 8])
def test_all_members_are_read(pack, pad):
    raw = pack(b"first") + pad + pack(b"second") + pack(SECRET.encode())
    assert found(f"see {base64.b64encode(raw).decode()} there")
    parts = pack(b"say password=hun") + pad + pack(b"ter2abc now")
    assert found(f"see {base64.b64encode(parts).decode()} there")


def test_a_long_run_takes_linear_time():
    import time

    began = time.time()
    assert not found("x" * 150_000)
    assert time.time() - began < 10
