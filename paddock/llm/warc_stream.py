"""WARC archives read from a stream in chunks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

VERSION = b"WARC/1.0"
CHUNK = 1 << 16
#: A header line longer than this is an error.
LINE = 1 << 20


class Reader:
    """Records of a stream in order, each payload in chunks of ``CHUNK`` bytes at most.

    No more than one chunk and one header is in memory.  A chunk comes with its
    number, the bytes so far and the SHA-256 so far; a record without payload
    has one empty chunk.  A cut or malformed archive raises ValueError.
    """

    def __init__(self, stream):
        self.stream, self.buffer, self.at = stream, b"", 0

    def _fill(self) -> bool:
        """Read on; what was used up is let go."""
        more = self.stream.read(CHUNK)
        self.buffer, self.at = self.buffer[self.at:] + more, 0
        return bool(more)

    def _line(self) -> bytes:
        while (end := self.buffer.find(b"\r\n", self.at)) < 0:
            if len(self.buffer) - self.at > LINE or not self._fill():
                raise ValueError("archive ends inside a header")
        line, self.at = self.buffer[self.at:end], end + 2
        return line

    def _take(self, size: int) -> bytes:
        while len(self.buffer) - self.at < size:
            if not self._fill():
                raise ValueError("archive ends inside a record")
        self.at += size
        return self.buffer[self.at - size:self.at]

    def records(self) -> Iterator[tuple[dict, Iterator[tuple[int, bytes, int, str]]]]:
        while self.at < len(self.buffer) or self._fill():
            if self._line() != VERSION:
                raise ValueError("no record where one must begin")
            headers: dict = {}
            while line := self._line():
                name, _, value = line.decode("utf-8", "replace").partition(":")
                headers[name.strip().lower()] = value.strip()
            left = int(headers["content-length"])
            yield headers, self._chunks(left)
            if self._line() or self._line():
                raise ValueError("a record is longer than its header says")

    def _chunks(self, left: int) -> Iterator[tuple[int, bytes, int, str]]:
        digest, number, done = hashlib.sha256(), 0, 0
        while left or not number:
            data = self._take(min(left, CHUNK)) if left else b""
            left -= len(data)
            done += len(data)
            digest.update(data)
            yield number, data, done, digest.hexdigest()
            number += 1
