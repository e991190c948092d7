"""Files read in tasks: opened, cut into byte ranges of whole lines, split at line ends.

A line belongs to the range in which it starts. ``\\n``, ``\\r`` and ``\\r\\n`` end a line. In an encoding of 2 or 4 byte units a line end
is a whole unit, at a multiple of its width, so ranges are aligned to units.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

from rowsmith.session import file_system, local_path

BLOCK = 1 << 16


def _units(data: bytes, width: int, big: bool) -> np.ndarray:
    return np.frombuffer(data[: len(data) // width * width], f"{'>' if big else '<'}u{width}")


def line_start(f, at: int, size: int, width: int = 1, big: bool = False, cr: bool = True) -> int:
    """The first byte from ``at`` on at which a line starts (``size`` where none does); ``cr``: a ``\\r`` ends a line too."""
    at = -(-at // width) * width
    if at <= 0:
        return 0
    if at >= size:
        return size
    f.seek(at - width)
    place, last = at - width, 0  # the unit before ``at`` may end a line
    while True:
        data = f.read(BLOCK * width)
        units = _units(data, width, big)
        if not len(units):
            return size
        # after a \r the line starts here, unless a \n follows
        if last == 13:
            return place + width if units[0] == 10 else place
        ends = units == 10
        if cr:
            ends[:-1] |= (units[:-1] == 13) & (units[1:] != 10)
        found = np.flatnonzero(ends)
        if len(found):
            return min(size, place + (int(found[0]) + 1) * width)
        last = int(units[-1]) if cr else 0
        place += len(units) * width


def range_chunks(f, start: int, end: int, chunk: int) -> Iterator[bytes]:
    """The bytes from ``start`` to ``end``, a chunk at a time."""
    f.seek(start)
    while start < end:
        data = f.read(min(chunk, end - start))
        if not data:
            return
        start += len(data)
        yield data


def open_archive(uri: str):
    """A seekable binary file object for a path on the local or a remote file system."""
    lp = local_path(uri)
    if lp is not None:
        return open(lp, "rb")
    fs, p = file_system(uri)
    return fs.open_input_file(p)


def line_arrays(chunks: Iterator[bytes]):
    """Split a byte stream at ``\\n``, ``\\r`` and ``\\r\\n`` like ``readLine``, a chunk at a time.

    Yields ``(lines, True)`` for the lines each chunk closes, as soon as it is
    read, then ``([rest], False)``: the bytes after the final line end (maybe
    empty). Lines are Arrow binary arrays built with numpy: every ``\\r`` and
    ``\\n`` byte belongs to a line end (a line cannot hold one), so the line
    bodies are the chunk without those bytes, and a line's end offset is the
    count of body bytes before its line end. A line end is a ``\\n``, or a
    ``\\r`` not followed by ``\\n`` (also in the next chunk). No Python runs per
    line, and the pieces of a line over many chunks are joined once.
    """
    import numpy as np
    import pyarrow as pa

    carry: list[bytes] = []
    skip_lf = False
    for chunk in chunks:
        if skip_lf and chunk:
            skip_lf = False
            if chunk[:1] == b"\n":
                chunk = chunk[1:]
        if not chunk:
            continue
        buf = np.frombuffer(chunk, dtype=np.uint8)
        lf = buf == 10
        cr = buf == 13
        ends_line = lf.copy()
        ends_line[:-1] |= cr[:-1] & ~lf[1:]
        if chunk[-1:] == b"\r":
            ends_line[-1] = True
            skip_lf = True
        ends = np.flatnonzero(ends_line)
        if len(ends) == 0:
            carry.append(chunk)
            continue
        body = ~(lf | cr)
        head = b"".join(carry)
        offsets = np.zeros(len(ends) + 1, dtype=np.int64)
        offsets[1:] = np.cumsum(body, dtype=np.int64)[ends] + len(head)
        tail_start = int(ends[-1]) + 1
        content = head + buf[:tail_start][body[:tail_start]].tobytes()
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(content)]
        yield pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(ends), buffers), True
        carry = [chunk[tail_start:]] if tail_start < len(chunk) else []
    yield pa.array([b"".join(carry)], pa.large_binary()), False
