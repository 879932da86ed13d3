"""Invented pages shaped like the publication sites (example.com hosts only)."""

BASE = "https://www.example.com"


def card(href, title, desc=None, extra_cls=""):
    d = f'<div class="teasable__text"><p>{desc}</p></div>' if desc is not None else ""
    a = f'<a class="teasable__link {extra_cls}" href="{href}">' if href is not None else '<a class="teasable__link">'
    return (
        f'<li><div class="collection__item"><div class="teasable">{a}'
        f'<div class="teasable__title teasable__title--marked"><div>{title}<span>x</span></div></div>'
        f"{d}</a></div></div></li>"
    )


def card_page(cards_html: str) -> str:
    return (
        "<html><body><div id='main-content'><div><div><main>"
        "<div>intro</div><div><div><div><nav><ul>" + cards_html + "</ul></nav></div></div></div>"
        "</main></div></div></div></body></html>"
    )


CARD_LISTING = card_page(
    card("/en/press/2025-01-29-rates.html", "Rates decision", "29.01.2025: Decision on rates")
    + card("/en/press/statement.html", "  Statement  ", "3.2.2025: A statement")
    + card("/en/press/no-date.html", "No date anywhere", None)
    + card("/en/press/2025-13-45-bad.html", "Bad URL date", "01.01.2025: text wins? no")
    + card("/files/report.pdf", "A report file", "05.01.2025: pdf")
    + card("/en/press/empty-title.html", "   ", "05.01.2025: x")
    + card(None, "Card without link", "05.01.2025: x")
)


def detail_page(links: list[str | None]) -> str:
    items = "".join(f'<li><a href="{h}">f</a></li>' if h is not None else "<li>no link</li>" for h in links)
    return (
        "<html><body><div id='main-content'><div><div><main><nav><ul>" + items + "</ul></nav></main></div></div></div>"
        "</body></html>"
    )


DETAIL_RATES = detail_page(["/files/a.pdf", "https://other.example.org/b.pdf", None, "c/d.html"])
DETAIL_STATEMENT = detail_page([f"/f/{i}.pdf" for i in range(51)])
DETAIL_NO_LIST = "<html><body><p>nothing</p></body></html>"


def dl_item(date, href, title, related=()):
    rel = ""
    if related:
        rel = "<dl><dt>Files</dt><dd>" + "".join(f'<a href="{r}">r</a>' for r in related) + "</dd></dl>"
    return f'<dt>{date}</dt><dd><div><a href="{href}">{title}</a></div>{rel}</dd>'


DL_PAGE = (
    "<html><body><h1>Accounts</h1><dl>"
    + dl_item("9 January 2024", "/press/a1.en.html", "Account one",
              ["/pdf/a1.en.pdf", "/pdf/a1.en.pdf?60b657", "/pdf/a1.de.pdf"])
    + dl_item("31 February 2024", "/press/a2.en.html", "Bad date")
    + dl_item("12 March 2024", "/press/a3.en.html", "Ｆｕｌｌ　ｗｉｄｔｈ title")
    + "<dt>1 April 2024</dt>"  # one dt too many: zip stops at the shorter side
    + "</dl></body></html>"
)

DL_BODY_PAGE = (
    "<dt>2 May 2024</dt><dd><a href='/press/b1.en.html'>Bare one</a></dd>"
    "<dt>3 May 2024</dt><dd><a href='/press/b2.en.html'>Bare two</a></dd>"
)


def result(date=True, link=True, title=True, category=True, title_text="Consultation paper"):
    parts = ['<li class="mas-search-page__result"><div class="card">']
    if date:
        parts.append('<div class="ts:xs text-muted">Date: 9 January 2024</div>')
    if link:
        span = f'<span class="mas-link__text">{title_text}</span>' if title else ""
        parts.append(f'<a class="mas-link mas-link--no-underline" href="/regulation/p{title_text[:3]}">{span}</a>')
    if category:
        parts.append('<div class="mas-tag mas-tag__text">Banking</div>')
    parts.append("</div></li>")
    return "".join(parts)


SEARCH_PAGE = (
    "<html><body><ul>"
    + result()
    + result(title_text="Ｆｕｌｌ　ｗｉｄｔｈ notice")
    + result(date=False, title_text="No date")
    + result(category=False, title_text="No category")
    + '<li class="mas-search-page__result extra"><div>not an exact class match</div></li>'
    + "</ul></body></html>"
)

RELATED_DETAIL = (
    "<html><body><a href='/files/x.pdf'>pdf</a><a href='/page'>no</a><a href=' /files/y.pdf '>pdf2</a>"
    "<div class='related-to-this-regulation-listing--result'><h1 class='mas-search-card__title'>"
    "<a href='/regulation/related-1'>r</a></h1></div></body></html>"
)

RSS_FEED = """<?xml version="1.0" encoding="utf-8"?>
<rss version="2.0"><channel><title>Feed</title>
<item><title>  Valid entry  </title><link>https://www.example.com/a</link>
  <pubDate>Wed, 29 Jan 2025 12:00:00 GMT</pubDate>
  <enclosure url="https://www.example.com/a.pdf" type="application/pdf"/>
  <enclosure url="ftp://files.example.com/a.pdf"/></item>
<item><title>Missing link</title><pubDate>Wed, 29 Jan 2025 12:00:00 GMT</pubDate></item>
<item><title>Bad date</title><link>https://www.example.com/b</link><pubDate>22/01/2025</pubDate></item>
<item><title>Zone offset</title><link>https://www.example.com/c</link><pubDate>Wed, 29 Jan 2025 12:00:00 +0100</pubDate></item>
<item><title>Not http</title><link>www.example.com/d</link><pubDate>Wed, 29 Jan 2025 12:00:00 GMT</pubDate></item>
<item><title>Many enclosures</title><link>https://www.example.com/e</link>
  <pubDate>Wed, 29 Jan 2025 12:00:00 GMT</pubDate>
  ENCLOSURES51</item>
</channel></rss>
""".replace(
    "ENCLOSURES51", "".join(f'<enclosure url="https://www.example.com/e{i}.pdf"/>' for i in range(51))
)

EMPTY_FEED = """<?xml version="1.0"?><rss version="2.0"><channel><title>Empty</title></channel></rss>"""
