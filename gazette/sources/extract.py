"""Structural HTML extraction as column expressions over a page's nodes.

``sources.nodes`` turns each page into one array of nodes; here Spark selects
from it.  Selectors are plain data (tuples of ``Step``), so a new site is a new
spec, not new code: every step becomes a ``filter`` over the slice of the array
that holds a node's descendants, first matches, pairing by position and item
numbers are array functions, and ``inline_outer`` makes the rows.  A page is
one row until then, so nothing is shuffled.

Every page yields at least one row: item rows with ``page_status = 'ok'``,
or one row whose status says why there are none (``no_container`` /
``no_items`` / ``parse_error``) — the health report counts those instead of
raising.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gazette.sources.nodes import TEXT, page_nodes


# ---------------------------------------------------------------------------
# selectors as data
# ---------------------------------------------------------------------------
@dataclass(frozen=True)
class Step:
    """One location step.  ``axis`` is ``child`` or ``desc``; predicates are
    ANDed; ``nth`` (1-based) picks among the matching children of a context
    node, as ``div[2]`` does."""

    tag: str = "*"
    axis: str = "desc"
    class_contains: str | None = None
    class_equals: str | None = None
    id: str | None = None
    href_contains: str | None = None
    text_contains: str | None = None  # on the first direct text node
    nth: int | None = None

    @property
    def attributes(self) -> set[str]:
        asked = (("class", self.class_contains), ("class", self.class_equals), ("id", self.id), ("href", self.href_contains))
        return {name for name, value in asked if value is not None}


def child(tag: str = "*", **kw) -> Step:
    return Step(tag=tag, axis="child", **kw)


def desc(tag: str = "*", **kw) -> Step:
    return Step(tag=tag, axis="desc", **kw)


@dataclass(frozen=True)
class Field:
    """``value``: ``text`` (text before the first child), ``text()`` (first
    direct text node), ``alltext`` (first descendant text node) or
    ``@attr``.  ``many`` returns every match as a list."""

    name: str
    steps: tuple[Step, ...]
    value: str = "text"
    many: bool = False
    side: str = "item"  # for pair specs: "left" or "right"


@dataclass(frozen=True)
class SourceSpec:
    """Where the items of a page are and which fields each item has.

    * ``container``: steps from the document to the list (first match);
      empty = the document.  ``container_rule='dl_or_body'`` takes the first
      ``dl`` unless the body's first element is a ``dt``.
    * ``items``: steps from the container to each item, or, for pair specs,
      ``left``/``right`` steps zipped by position (stops at the shorter).
    """

    name: str
    fields: tuple[Field, ...]
    container: tuple[Step, ...] = ()
    items: tuple[Step, ...] = ()
    left: tuple[Step, ...] = ()
    right: tuple[Step, ...] = ()
    container_rule: str | None = None
    whole_page: bool = False  # one item = the page itself

    @property
    def paired(self) -> bool:
        return bool(self.left)

    @property
    def attributes(self) -> set[str]:
        """The attributes that the spec's steps and fields read."""
        steps = [*self.container, *self.items, *self.left, *self.right, *(s for f in self.fields for s in f.steps)]
        read = {f.value[1:] for f in self.fields if f.value.startswith("@")}
        return read.union(*(s.attributes for s in steps))


# ---------------------------------------------------------------------------
# selection over the node array; nodes are named by their place in it
# ---------------------------------------------------------------------------
def _below(nodes: Column, at: Column) -> Column:
    """The descendants of a node."""
    return F.slice(nodes, at + 2, F.get(nodes, at)["last"] - at)


def _own_text(nodes: Column, at: Column) -> Column:
    """First direct text."""
    return F.get(F.filter(_below(nodes, at), lambda t: (t["tag"] == TEXT) & (t["parent"] == at)), F.lit(0))["text"]


def _matches(nodes: Column, e: Column, step: Step) -> Column:
    asked = (e["tag"] == step.tag) if step.tag != "*" else (e["tag"] != TEXT)
    if step.class_contains is not None:
        asked &= e["@class"].contains(step.class_contains)
    if step.class_equals is not None:
        asked &= e["@class"] == step.class_equals
    if step.id is not None:
        asked &= e["@id"] == step.id
    if step.href_contains is not None:
        asked &= e["@href"].contains(step.href_contains)
    if step.text_contains is not None:
        asked &= _own_text(nodes, e["at"]).contains(step.text_contains)
    return asked


def _hits(nodes: Column, at: Column, step: Step) -> Column:
    """Places of the nodes that one step finds from a node, in document order."""

    def fits(e: Column) -> Column:
        found = _matches(nodes, e, step)
        return (e["parent"] == at) & found if step.axis == "child" else found

    found = F.filter(_below(nodes, at), fits)
    if step.nth is not None:
        found = F.slice(found, step.nth, 1)
    return F.transform(found, lambda e: e["at"])


def select(nodes: Column, at: Column, steps: Sequence[Step]) -> Column:
    """Places of the nodes that the steps find from the node at ``at``, in
    document order, each once."""
    if not steps:
        return F.array(at)
    found = _hits(nodes, at, steps[0])
    for step in steps[1:]:
        found = _from_each(nodes, found, step)
    return found


def _from_each(nodes: Column, places: Column, step: Step) -> Column:
    each = F.flatten(F.transform(places, lambda p: _hits(nodes, p, step)))
    return F.sort_array(F.array_distinct(each))


def _value(nodes: Column, at: Column, how: str) -> Column:
    if how == "text":
        after = F.get(nodes, at + 1)
        return F.when((after["tag"] == TEXT) & (after["parent"] == at), after["text"])
    if how == "text()":
        return _own_text(nodes, at)
    if how == "alltext":
        return F.get(F.filter(_below(nodes, at), lambda t: t["tag"] == TEXT), F.lit(0))["text"]
    if how.startswith("@"):
        return F.get(nodes, at)[how]
    raise ValueError(f"unknown value kind {how!r}")


def _read(nodes: Column, at: Column, field: Field) -> Column:
    found = select(nodes, at, field.steps)
    if field.many:
        return F.filter(F.transform(found, lambda p: _value(nodes, p, field.value)), lambda v: v.isNotNull())
    # the first match is looked up once, though its value names it often
    return F.get(F.transform(F.slice(found, 1, 1), lambda p: _value(nodes, p, field.value)), F.lit(0))


def _container(spec: SourceSpec, nodes: Column) -> Column:
    """Place of the node that holds the items; null without one."""
    root = F.lit(0)
    first = lambda *steps: F.get(select(nodes, root, steps), root)
    if spec.container_rule == "dl_or_body":
        body = F.coalesce(first(desc("body")), first(desc("html")), root)
        bare = F.transform(
            F.array(body), lambda b: F.get(F.filter(_below(nodes, b), lambda e: (e["parent"] == b) & (e["tag"] != TEXT)), root)
        )
        return F.when(F.get(bare, root)["tag"] == "dt", body).otherwise(first(desc("dl")))
    return first(*spec.container) if spec.container else root


def extract(df: DataFrame, spec: SourceSpec, html_col: str = "html", keys: Sequence[str] = ("url",)) -> DataFrame:
    """Pages ``(keys..., html)`` → one row per extracted item: the keys,
    ``page_status``, ``item_pos`` and the spec's fields.  The ``html`` column
    never reaches a shuffle."""
    pages = page_nodes(df, html_col, keys, spec.attributes)
    nodes, box = F.col("nodes"), F.col("box")
    pages = pages.withColumn("box", _container(spec, nodes))
    if spec.whole_page:
        lefts = rights = F.array(box)
    elif spec.paired:
        lefts, rights = select(nodes, box, spec.left), select(nodes, box, spec.right)
    else:
        lefts = rights = select(nodes, box, spec.items)
    pages = pages.withColumn("lefts", lefts).withColumn("rights", rights if spec.paired else F.lit(None))

    def record(left: Column, i: Column) -> Column:
        right = F.get(F.col("rights"), i)
        own = [_read(nodes, right if f.side == "right" else left, f).alias(f.name) for f in spec.fields]
        return F.struct(F.lit("ok").alias("page_status"), (i + 1).cast("bigint").alias("item_pos"), *own)

    def without(status: str) -> Column:
        none = [F.lit(None).cast("array<string>" if f.many else "string").alias(f.name) for f in spec.fields]
        return F.array(F.struct(F.lit(status).alias("page_status"), F.lit(None).cast("bigint").alias("item_pos"), *none))

    # the status is part of the rows: a condition on it is asked of the rows,
    # not of every page's selection once more
    items = F.col("lefts")
    if spec.paired:
        items = F.slice(items, 1, F.least(F.size("lefts"), F.size("rights")))
    pages = pages.withColumn("items", items).select(
        *keys,
        F.when(nodes.isNull(), without("parse_error"))
        .when(box.isNull(), without("no_container"))
        .when(F.size("items") == 0, without("no_items"))
        .otherwise(F.transform("items", record))
        .alias("rows"),
    )
    return pages.select(*keys, F.inline_outer("rows"))
