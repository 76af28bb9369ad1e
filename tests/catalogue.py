"""A small catalogue in four sources, made for the rules of the normalisers, the router, the deduplication and the paging.

``ROWS`` has the records of each page; each says which rule it is there for.
"""

CONFIG = """
version: 1
run: {output_dir: out, formats: [csv, json]}
http: {max_attempts: 3, backoff_base_seconds: 0.01, backoff_max_seconds: 0.05, delay_seconds: 0.0}
dedupe: {key_fields: [sku], on_conflict: keep_first}
sources:
  - id: orchard
    start_url: "${BASE:-http://127.0.0.1:8090}/orchard/1"
    record_selector: "ul.goods > li"
    decimal_separator: dot
    pagination: {strategy: next_link, next_selector: "footer a[rel=next]", max_pages: 9}
    fields: &fields
      sku: {selector: "code"}
      title: {selector: "h4 a"}
      price: {selector: ".cost"}
      url: {selector: "h4 a", attr: href}
      availability: {selector: ".state"}
      rating: {selector: "i", attr: class}
      category: {selector: ".shelf"}
      listed_on: {selector: "time", attr: datetime}
  - id: grove
    kind: browser
    start_url: "${BASE:-http://127.0.0.1:8090}/grove"
    record_selector: "#made li"
    wait_for_selector: "#made"
    decimal_separator: dot
    pagination: {strategy: page_param, page_param: n, max_pages: 6}
    fields: {<<: *fields, rating: {selector: "i"}}
  - id: twin
    start_url: "${BASE:-http://127.0.0.1:8090}/unsteady/twin"
    record_selector: "ul.goods > li"
    decimal_separator: dot
    fields: *fields
  - id: barn
    start_url: "${BASE:-http://127.0.0.1:8090}/barn"
    record_selector: "ul.goods > li"
    fields: *fields
"""

CRATE = ("PL-310", "Walnut crate", "€18.40", "Ships within days", "stars Two", "Crates", "2026-05-02")
ROWS = {
    ("orchard", 1): [
        CRATE,
        ("\n PL-311\t", "Pear &amp;&nbsp;quince\n set", "1.080,00 €", "Sold out", "stars Five", "Boxes", "3/6/2026"),  # white space, entities, both separators
        ("PL-312", "Ladder", "GBP 74.5", "Preorder now", "stars One", "Tools", "May 9, 2026"),  # a code for a currency, a named month
        ("PL-313", "Press", "₩ 125,000", "Withdrawn", None, "Tools", "2 weeks ago"),  # no minor digits, no rating, a relative date
        ("PL-314", "Basket", "$9", "Made to order", "stars Zero", "Baskets", "today"),  # a wording that is not known: a warning
    ],
    ("orchard", 2): [
        ("PL-321", "Hoe", None, "In stock", None, None, None),  # no price element
        ("PL-322", " \n ", "£4.00", "In stock", None, None, None),  # a blank title
        ("PL-323", "Rake", "on request", "In stock", None, None, None),  # no currency
        ("PL-324", "Saw", "£3.005", "In stock", None, None, None),  # more decimals than the currency has
        ("PL-325", "Axe", "£6.00", "In stock", None, None, "30/02/2026"),  # no such day
        ("PL-326", "Net", "£7.00", "In stock", "stars Nine", None, None),  # no such rating
        (None, "Rope", "£8.00", "In stock", None, None, None),  # no sku
        ("PL-327", "Twine", "£2.20", "Coming soon", None, "Tools", None),
    ],
    ("orchard", 3): [
        CRATE,  # the same again
        ("PL-312", "Ladder", "GBP 79.5", "Preorder now", "stars One", "Tools", "May 9, 2026"),  # again at another price
        ("PL-330", "Bucket", "CHF 12.05", "Unavailable", None, None, None),
    ],
    ("grove", 1): [("PL-401", "Bench", "R$ 310,00", "Available", "9/10", "Garden", None), ("PL-402", "Stool", "$45.10", "In stock", "3.5/5", "Garden", None)],
    ("grove", 2): [("PL-403", "Table", "$88.00", "In stock", "5 of 5", "Garden", None), (*CRATE[:4], "2 of 5", *CRATE[5:])],  # the same, its rating written otherwise
    ("grove", 3): [],
    ("twin", 1): [(*CRATE[:2], "€17.90", *CRATE[3:]), ("PL-501", "Peg", "£0.35", None, None, None, None)],  # optional fields absent
    ("barn", 1): None,
}
URLS = {"orchard": "/orchard/{}", "grove": "/grove?n={}", "twin": "/unsteady/twin", "barn": "/barn"}


def page(source, number):
    records = ROWS[source, number]
    if records is None:
        return "<body><table><tr><td>PL-310<td>moved to another layout</table>"
    cells = []
    for sku, title, price, state, rating, shelf, listed in records:
        parts = [f"<code>{sku}</code>" if sku else "", f"<h4><a href='/item/{(sku or 'none').strip().lower()}#top'>{title}</a></h4>"]
        parts += [f"<span class='{c}'>{x}</span>" for c, x in (("cost", price), ("state", state), ("shelf", shelf)) if x is not None]
        if rating is not None:
            parts.append(f"<i class='{rating}'></i>" if rating.startswith("stars") else f"<i>{rating}</i>")
        if listed is not None:
            parts.append(f"<time datetime='{listed}'>listed</time>")
        cells.append("<li>" + "".join(parts) + "<!-- end of record -->")
    following = f"<a rel=next href='{number + 1}'>more</a>" if source == "orchard" and number < 3 else ""
    return f"<!doctype html><title>{source}</title><div id=made><ul class='wide goods'>{''.join(cells)}</ul></div><footer>{following}</footer><script>'</ul>'</script>"


def rows(base="http://127.0.0.1:8090"):
    """Rows of ``schemas.PAGES`` as a crawl gives them."""
    return [(s, n, base + URLS[s].format(n), base + URLS[s].format(n), 200, 3 if s == "twin" else 1, "static", page(s, n), None, None, None) for s, n in ROWS]
