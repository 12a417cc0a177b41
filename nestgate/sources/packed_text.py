"""Text files that are packed and still read by splits.

A file is a sequence of Zstandard frames of whole lines, with a marker after each: a frame that decoders skip.
So it is an ordinary Zstandard file (``zstd -dc`` gives the text), although Spark names it ``.txt``.  Spark's text
source cuts it at the markers, like any text at its line ends; a row is a frame.

No frame holds the marker: it has bytes that no UTF-8 text has, and by chance its 24 bytes do not come.
"""

from __future__ import annotations

import pyarrow as pa

FRAME = 1 << 20                 # characters of text in a frame
MARK = bytes.fromhex("ff00fe01a7f3c05dff9be2fe6419d8ff")
SEPARATOR = (0x184D2A5E).to_bytes(4, "little") + len(MARK).to_bytes(4, "little") + MARK
OPTIONS = {"lineSep": SEPARATOR.decode("latin-1"), "encoding": "ISO-8859-1"}       # of the text source: the separator's


def pack(text: bytes) -> bytes:
    return pa.Codec("zstd", compression_level=1).compress(text, asbytes=True)


def unpack(frame: bytes | pa.Buffer) -> bytes:
    return pa.CompressedInputStream(pa.BufferReader(frame), "zstd").read()
