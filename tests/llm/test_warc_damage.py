"""Intact records of damaged and padded archives."""

import gzip
import io

from ledgertide.llm import warc


def member(name, extra=b""):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + name
    return gzip.compress(b"WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <" + name + b">\r\n" + extra
                         + b"Content-Length: %d\r\n\r\n" % len(block) + block + b"\r\n\r\n")


def names(data):
    return [fields["warc-record-id"] for _, fields, _ in warc.records_in_range(io.BytesIO(data), len(data), 0, len(data))]


def test_records_before_damage_padding_and_with_folded_lines_are_read():
    a, b, c = member(b"a"), member(b"b"), member(b"c")
    assert names(a + b + c) == ["<a>", "<b>", "<c>"]
    assert names(a + b"\0\0" + b[2:] + c) == ["<a>", "<c>"]
    assert names(a + b"\0" * 512 + b + b"trailing") == ["<a>", "<b>"]
    assert names(member(b"d", b"WARC-Target-URI: http://x.example.org/\r\n  long\r\n") + a) == ["<d>", "<a>"]
