"""Source specs: where each publication site keeps its items and fields.

FIXED VALUES — the element paths, class names and ids below must equal the
markup of the sites the publications come from; they are data, read by the
one generic extractor in ``sources.extract``.
"""

from __future__ import annotations

from gazette.sources.extract import Field, SourceSpec, child, desc

# Article card list: #main-content/div/div/main/div[2]/div/div/nav/ul, one
# card per div.collection__item.
CARD_LIST = SourceSpec(
    name="card_list",
    container=(
        desc(id="main-content"),
        child("div"),
        child("div"),
        child("main"),
        child("div", nth=2),
        child("div"),
        child("div"),
        child("nav"),
        child("ul"),
    ),
    items=(desc("div", class_contains="collection__item"),),
    fields=(
        Field("link", (desc("a", class_contains="teasable__link"),), "@href"),
        Field("title", (desc("div", class_contains="teasable__title--marked"), desc("div")), "text"),
        Field("description", (desc("div", class_contains="teasable__text"), desc("p")), "text"),
    ),
)

# Detail page attachment list: #main-content/div/div/main/nav/ul/li, first
# link of each item.
LINK_LIST = SourceSpec(
    name="link_list",
    container=(
        desc(id="main-content"),
        child("div"),
        child("div"),
        child("main"),
        child("nav"),
        child("ul"),
    ),
    items=(child("li"),),
    fields=(Field("href", (desc("a"),), "@href"),),
)

# Definition-list listing, first form: every dt of the page zipped with every
# dd of the page.
DL_DESCENDANTS = SourceSpec(
    name="dl_descendants",
    left=(desc("dt"),),
    right=(desc("dd"),),
    fields=(
        Field("date_text", (), "alltext", side="left"),
        Field("title", (desc("a"),), "text", side="right"),
        Field("link", (desc("a"),), "@href", side="right"),
        Field("related", (desc("dl"), desc("a")), "@href", many=True, side="right"),
    ),
)

# Definition-list listing, second form: the first dl (or the body when its
# first element is a dt), direct dt/dd children only.
DL_CHILDREN = SourceSpec(
    name="dl_children",
    container_rule="dl_or_body",
    left=(child("dt"),),
    right=(child("dd"),),
    fields=DL_DESCENDANTS.fields,
)

# Search result cards: li with class exactly "mas-search-page__result".
SEARCH_RESULTS = SourceSpec(
    name="search_results",
    items=(desc("li", class_equals="mas-search-page__result"),),
    fields=(
        Field("date_text", (desc("div", class_contains="ts:xs", text_contains="Date:"),), "text()"),
        Field("link", (desc("a", class_contains="mas-link--no-underline"),), "@href"),
        Field(
            "title",
            (desc("a", class_contains="mas-link--no-underline"), child("span", class_equals="mas-link__text")),
            "text()",
        ),
        Field("category", (desc("div", class_contains="mas-tag__text"),), "text()"),
    ),
)

# Detail page of a search result: PDF links, then links of related cards.
RELATED_CARDS = SourceSpec(
    name="related_cards",
    whole_page=True,
    fields=(
        Field("pdf_links", (desc("a", href_contains=".pdf"),), "@href", many=True),
        Field(
            "card_links",
            (
                desc("div", class_contains="related-to-this-regulation-listing--result"),
                desc("h1", class_contains="mas-search-card__title"),
                child("a"),
            ),
            "@href",
            many=True,
        ),
    ),
)

# Any page: every anchor with its href and text (used on the landed pages).
ANCHORS = SourceSpec(
    name="anchors",
    items=(desc("a"),),
    fields=(Field("href", (), "@href"), Field("text", (), "alltext")),
)

SPECS = {s.name: s for s in (CARD_LIST, LINK_LIST, DL_DESCENDANTS, DL_CHILDREN, SEARCH_RESULTS, RELATED_CARDS, ANCHORS)}
