"""Elements out of XML by a pull parser: one row element at a time, whatever the size of the document."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from xml.etree import ElementTree

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _bare(name: str) -> str:
    """A name without its name space."""
    return name.rsplit("}", 1)[-1]


def elements(pieces: Iterable[bytes], tag: str, root: str | None = None) -> Iterator[tuple[str | None, str | None]]:
    """(xml, None) for each element called ``tag``, without name spaces, prefixes, comments and CDATA marks; (None, error) if the document breaks.

    A document whose outermost element isn't ``root``, if that is given, breaks at once. Elements within an element of that name are part of it. What has been read is let go with each element.
    """
    parser = ElementTree.XMLPullParser(("start", "end"))
    path: list[ElementTree.Element] = []
    inside = 0
    try:
        for piece in pieces:
            parser.feed(piece)
            for event, e in parser.read_events():
                if event == "start":
                    if not path and root and _bare(e.tag) != root:
                        yield None, f"not a {root}"
                        return
                    inside += bool(inside) or _bare(e.tag) == tag
                    path.append(e)
                    continue
                path.pop()
                if inside:
                    inside -= 1
                    e.tag, attributes = _bare(e.tag), {_bare(k): v for k, v in e.attrib.items()}
                    e.attrib.clear()
                    e.attrib.update(attributes)
                    if not inside:
                        e.tail = None
                        yield ElementTree.tostring(e, "unicode"), None
                if not inside:
                    e.clear()
                    if path:
                        path[-1].remove(e)
        parser.close()
    except ElementTree.ParseError as e:
        yield None, str(e)


def records(document: Column, tag: str) -> Column:
    """The elements of documents in a binary column, as an array; null where the document isn't well formed, or null."""

    @F.pandas_udf("array<string>")
    def cut(documents: pd.Series) -> pd.Series:
        def one(d: bytes | None) -> list[str] | None:
            if d is None:
                return None
            found = list(elements([bytes(d)], tag))
            return None if found and found[-1][1] else [x for x, _ in found]

        return documents.map(one)

    return cut(document)
