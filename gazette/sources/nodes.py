"""Pages as node tables: the one step of HTML extraction that needs Python.

Real pages are not XML (unclosed tags), so Spark's ``xpath*`` functions fail
on them.  The standard-library HTML parser reads each page once inside
``mapInArrow`` and hands on its nodes in document order as one array of
structs; what is selected from them is up to column expressions
(``sources.extract``).

A node is an element, or the text between two tags (tag ``#text``, adjacent
texts of one parent merged).  ``at`` is its place in the array, ``parent`` that
of its parent, ``last`` that of its last descendant: the descendants of a node
are the slice from ``at + 1`` to ``last``.  Node 0 is the page itself.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as ST
from pyspark.sql.pandas.types import to_arrow_schema

TEXT = "#text"
#: Nodes that are handed on together, at least those of one page.
HELD = 100_000

# HTML elements that never have content, and implicit-close rules.
_VOID = frozenset(
    "area base br col embed hr img input link meta param source track wbr".split()
)
_CLOSES_P = frozenset(
    "address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 "
    "header hr main nav ol p pre section table ul".split()
)
_LIST_SCOPE = frozenset(("ul", "ol"))
_DEF_SCOPE = frozenset(("dl",))
_P_SCOPE = frozenset(("div", "td", "th", "li", "dd", "body"))
_LI, _DT_DD, _P = ("li",), ("dt", "dd"), ("p",)


class _Nodes(HTMLParser):
    """The nodes of one page as parallel lists; reused from page to page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.start()

    def start(self):
        self.reset()
        self.tags, self.parents, self.texts, self.attributes = ["#root"], [-1], [None], [{}]
        self.stack = [0]
        self.open: Counter = Counter()

    def _new(self, tag, attributes=(), text=None):
        self.tags.append(tag)
        self.parents.append(self.stack[-1])
        self.texts.append(text)
        self.attributes.append({k: (v if v is not None else "") for k, v in attributes})

    def _cut(self, i: int):
        for at in self.stack[i:]:
            self.open[self.tags[at]] -= 1
        del self.stack[i:]

    def _close_open(self, tags: tuple[str, ...], scope: frozenset):
        if not any(self.open[t] for t in tags):
            return
        for i in range(len(self.stack) - 1, 0, -1):
            t = self.tags[self.stack[i]]
            if t in scope:
                return
            if t in tags:
                self._cut(i)
                return

    def handle_starttag(self, tag, attrs):
        if tag == "li":
            self._close_open(_LI, _LIST_SCOPE)
        elif tag in _DT_DD:
            self._close_open(_DT_DD, _DEF_SCOPE)
        if tag in _CLOSES_P:
            self._close_open(_P, _P_SCOPE)
        self._new(tag, attrs)
        if tag not in _VOID:
            self.stack.append(len(self.tags) - 1)
            self.open[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self._new(tag, attrs)

    def handle_endtag(self, tag):
        if not self.open[tag]:
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.tags[self.stack[i]] == tag:
                self._cut(i)
                return

    def handle_data(self, data):
        if self.tags[-1] == TEXT and self.parents[-1] == self.stack[-1]:
            self.texts[-1].append(data)
        else:
            self._new(TEXT, text=[data])

    def lasts(self) -> list[int]:
        """The place of every node's last descendant."""
        out = list(range(len(self.tags)))
        for at in range(len(out) - 1, 0, -1):
            parent = self.parents[at]
            if out[parent] < out[at]:
                out[parent] = out[at]
        return out


_TAG = re.compile(
    r"""<(/?)([a-zA-Z][a-zA-Z0-9]*)((?:\s+[^\s"'<>/=]+(?:\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'=<>`/]+))?)*)\s*(/?)>"""
)
_ATTRIBUTE = re.compile(r"""([^\s"'<>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'=<>`/]+))?""")
_COMMENT = re.compile(r"<!--(?!-?>)[^-]*(?:-(?!-!?>)[^-]*)*-->|<!(?i:doctype)[^<>\[\]\"']*>")
# elements whose content is not markup, and what ends them
_RAW = {
    tag: re.compile(f"</{tag}>", re.IGNORECASE | re.ASCII)
    for tag in "iframe noembed noframes plaintext script style textarea title xmp".split()
}


def _attributes(text: str) -> list[tuple[str, str]]:
    found = []
    for name, value in _ATTRIBUTE.findall(text):
        if value[:1] in ('"', "'") and value:
            value = value[1:-1]
        found.append((name.lower(), html.unescape(value) if "&" in value else value))
    return found


def _feed_regular(b: _Nodes, text: str) -> bool:
    """Read a page whose markup is regular throughout (plain tags, comments,
    raw elements that end) by one expression per tag; False as soon as
    something else occurs."""
    at, size = 0, len(text)
    while at < size:
        tag_at = text.find("<", at)
        if tag_at != at:
            data = text[at:] if tag_at < 0 else text[at:tag_at]
            b.handle_data(html.unescape(data) if "&" in data else data)
            if tag_at < 0:
                return True
        m = _TAG.match(text, tag_at)
        if m is None:
            m = _COMMENT.match(text, tag_at)
            if m is None:
                return False
            at = m.end()
            continue
        at = m.end()
        close, tag, attributes, empty = m.groups()
        tag = tag.lower()
        if close:
            if attributes or empty:
                return False
            b.handle_endtag(tag)
        elif empty:
            if attributes and attributes[-1] not in "\"'":
                return False  # the slash belongs to an unquoted value
            b.handle_startendtag(tag, _attributes(attributes) if attributes else ())
        else:
            b.handle_starttag(tag, _attributes(attributes) if attributes else ())
            if tag in _RAW:
                end = _RAW[tag].search(text, at)
                if end is None:
                    return False
                data = text[at : end.start()]
                if (tag not in ("script", "style") and "<" in data) or "<!--" in data:
                    return False
                if data:
                    b.handle_data(data if tag in ("script", "style") or "&" not in data else html.unescape(data))
                at = end.start()
    return True


_READER: _Nodes | None = None


def read_nodes(text: str | None) -> _Nodes:
    """The nodes of one page, by the short way if its markup is regular.  One
    reader per Python worker is reused (workers run one task at a time), which
    saves its set-up on every small page."""
    global _READER
    if _READER is None:
        _READER = _Nodes()
    _READER.start()
    if text and not _feed_regular(_READER, text):
        _READER.start()
        _READER.feed(text)
        _READER.close()
    return _READER


def page_nodes(
    df: DataFrame, html_col: str = "html", keys: Sequence[str] = ("url",), attributes: Sequence[str] = ()
) -> DataFrame:
    """Pages ``(keys..., html)`` → ``(keys..., nodes)``, one row a page, with
    the named attributes of elements (in ``@name``; null where absent).

    A null or empty page has one node, itself; a page that the parser cannot
    read has null ``nodes``.  The ``html`` column is consumed here.
    """
    names = sorted(set(attributes))
    node = ST.StructType()
    for name in ("at", "parent", "last"):
        node = node.add(name, ST.IntegerType())
    for name in ("tag", "text", *(f"@{n}" for n in names)):
        node = node.add(name, ST.StringType())
    out = df.select(*keys).schema.add("nodes", ST.ArrayType(node))
    schema = to_arrow_schema(out)
    element = schema.field("nodes").type.value_type

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [batch.column(k) for k in keys]
            first, ends, missing = 0, [0], []
            flat: list[list] = [[] for _ in element]
            for i in range(batch.num_rows):
                try:
                    page = read_nodes(batch.column(html_col)[i].as_py())
                    texts = [t and "".join(t) for t in page.texts]
                    found = [range(len(texts)), page.parents, page.lasts(), page.tags, texts]
                    for column, values in zip(flat, found + [[a.get(n) for a in page.attributes] for n in names]):
                        column.extend(values)
                    missing.append(False)
                except Exception:  # noqa: BLE001 - one bad page must not fail the job
                    for column in flat:
                        del column[ends[-1] :]
                    missing.append(True)
                ends.append(len(flat[0]))
                if ends[-1] >= HELD or i == batch.num_rows - 1:
                    arrays = [pa.array(c, f.type) for c, f in zip(flat, element)]
                    lists = pa.ListArray.from_arrays(
                        pa.array(ends, pa.int32()),
                        pa.StructArray.from_arrays(arrays, fields=list(element)),
                        type=schema.field("nodes").type,
                        mask=pa.array(missing),
                    )
                    yield pa.RecordBatch.from_arrays([*(c.slice(first, len(missing)) for c in kept), lists], schema=schema)
                    first, ends, missing = i + 1, [0], []
                    flat = [[] for _ in element]

    return df.select(*keys, html_col).mapInArrow(run, out)
