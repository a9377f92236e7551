"""Words of texts as bytes: lower-cased A-Z, cut in pieces so that a very long text is never a whole list of words."""

from collections.abc import Iterator

import pyarrow as pa

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
# Letters, digits and every byte of a character beyond ASCII stay; all else is a gap.
_TERMS = bytes(_LOWER[b] if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

PIECE_BYTES = 1 << 22
ROWS_AT_ONCE = 500


def _pieces(flat: bytes) -> Iterator[list[bytes]]:
    start = 0
    while len(flat) - start > PIECE_BYTES:
        # White space is found by splitting the end of the piece; a word as long as a piece makes it longer.
        stop = start + PIECE_BYTES
        while stop < len(flat) and not flat[stop : stop + 1].isspace():
            stop += 1
        yield flat[start:stop].split()
        start = stop
    yield flat[start:].split()


def terms(text: bytes | None) -> Iterator[list[bytes]]:
    """Runs of letters, digits and characters beyond ASCII, in lower case, in pieces of some megabytes of text."""
    return _pieces((text or b"").translate(_TERMS))


def words(text: bytes | None) -> Iterator[list[bytes]]:
    """Runs of anything but ASCII white space, in lower case, in pieces of some megabytes of text."""
    return _pieces((text or b"").translate(_LOWER))


def slices(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[bytes | None]]]:
    """Runs of rows of `batch` with their texts as bytes, so that only some are Python objects at a time."""
    for start in range(0, batch.num_rows, ROWS_AT_ONCE):
        part = batch.slice(start, ROWS_AT_ONCE)
        yield part, part["text"].cast(pa.binary()).to_pylist()
