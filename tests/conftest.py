import os
import re
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from rowsmith.session import local_session

    s = local_session("*", shuffle_partitions=8, app="rowsmith-tests")
    yield s
    s.stop()


def java_split_model(s: str, regex: str) -> list[str]:
    """Reference model of ``java.lang.String.split(regex)`` (limit 0) for the tests."""
    if s == "":
        return [""]
    parts, index, found = [], 0, False
    for m in re.finditer(regex, s):
        if index == 0 and m.start() == 0 and m.end() == 0:
            continue
        parts.append(s[index:m.start()])
        index = m.end()
        found = True
    if not found:
        return [s]
    parts.append(s[index:])
    while parts and parts[-1] == "":
        parts.pop()
    return parts


def read_line_model(data: str) -> list[str]:
    """Reference model of ``BufferedReader.readLine`` over a whole text."""
    out, cur, i = [], [], 0
    while i < len(data):
        ch = data[i]
        if ch in "\r\n":
            out.append("".join(cur))
            cur = []
            if ch == "\r" and i + 1 < len(data) and data[i + 1] == "\n":
                i += 1
        else:
            cur.append(ch)
        i += 1
    if cur:
        out.append("".join(cur))
    return out


def blank_model(line: str) -> bool:
    return line.strip("".join(chr(c) for c in range(33))) == "" or line[:1] in ("\r", "\n")
