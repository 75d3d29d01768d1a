"""Extraction against a plain reading of the profiles, page by page, on random markup."""

import random
import re

import pytest

from winnow import defaults
from winnow.operators import profiles as P
from winnow.operators.extract import extract
from winnow.sources.html import _NodeColumns

TITLES = ["FX TD", "Lead", "Cook", "Unity Developer", " ", "", "Read more", "X", "Head of Rigging", "Contact"]
HREFS = ["/posting/1", "/posting/2", "//h/jobs/3", "https://h/jobs/44", "/job/5", " /apply/6 ", "/other", "", "x/jobs/y", "career", "/1/application/2", "?gh_jid=1"]
CLASSES = ["opening", "opening x", "openings", "posting-title", "a posting-title", "block-grid-item", "job-list-item z",
           "opening-job", "location", "sort-by-location", "job-location", "text-md", "company-location", ""]
ATTRS = ['data-qa="posting-name"', 'data-automation-id="jobTitle"', 'data-automation-id="locations"', 'data-ui="job-opening"', 'title="t"', ""]
TAGS = ["div", "li", "span", "h3", "h4", "h5", "dd", "i", "ul", "a", "a", "a"]


def random_page(rnd):
    def element(depth):
        if depth > 4 or rnd.random() < 0.25:
            return rnd.choice(TITLES + ["Paris", "<br>"])
        tag = rnd.choice(TAGS)
        attrs = [rnd.choice(ATTRS), rnd.choice(ATTRS[-3:])]
        if rnd.random() < 0.5 and tag in ("li", "div"):
            attrs.append('class="opening-job opening"')
        elif rnd.random() < 0.7:
            attrs.append(f'class="{rnd.choice(CLASSES)}"')
        if tag == "a" and rnd.random() < 0.9:
            attrs.append(f'href="{rnd.choice(HREFS)}"')
        inner = "".join(element(depth + 1) for _ in range(rnd.randrange(1, 4)))
        return f"<{tag} {' '.join(attrs)}>{inner}" + (f"</{tag}>" if rnd.random() < 0.9 else "")

    return "".join(element(0) for _ in range(rnd.randrange(1, 8)))


def passes(select, node):
    attrs = dict(node["attrs"] or ())
    if node["tag"] == "#text" or (select.tags and node["tag"] not in select.tags):
        return False
    names = attrs.get("class", "").split()
    checks = [
        select.class_token is None or select.class_token in names,
        select.class_pattern is None or any(re.search(select.class_pattern, n) for n in names),
        select.attr is None or attrs.get(select.attr[0]) == select.attr[1],
        select.has_attr is None or select.has_attr in attrs,
        select.attr_pattern is None
        or re.search(select.attr_pattern[1].replace(r"\p{Nd}", r"\d"), attrs.get(select.attr_pattern[0], "")),
    ]
    return all(checks)


def read_page(profile, html, page_url):
    columns = _NodeColumns()
    columns.add_page(html)
    nodes = columns.arrays()[0].to_pylist()[0]

    def below(n):
        return nodes[n["pre"] + 1 : n["last"] + 1]

    def find(n, selects):
        return next((m for s in selects for m in below(n) if passes(s, m)), None)

    def pieces(n):
        return [m["text"] for m in below(n) if m["tag"] == "#text"]

    def address(href):
        if profile.address == "raw" or href.startswith("http"):
            return href.replace("https:https:", "https:") if profile.address == "scheme" else href
        if profile.address == "prefix":
            return profile.base + href
        if profile.address == "scheme":
            return ("https:" + href).replace("https:https:", "https:")
        if profile.address == "site":
            return "https://h" + href if href.startswith("/") else page_url.rstrip("/") + "/" + href
        if href.startswith("//"):
            return "https:" + href
        return (profile.base or page_url).rstrip("/") + "/" + href.lstrip("/")

    items = [n for n in nodes if passes(profile.items, n)]
    if not items and profile.items_fallback:
        items = [n for n in nodes if passes(profile.items_fallback, n)]
    out, seen = [], set()
    for item in items:
        own = profile.link_is_item is not None and passes(profile.link_is_item, item)
        link = item if own else find(item, (profile.link,))
        if link is None:
            continue
        href = dict(link["attrs"]).get("href")
        if profile.href_rule == "any":
            href = href or ""
        if href is None or (profile.href_rule == "nonempty" and not href):
            continue
        href = href.strip() if profile.href_strip else href
        pattern = (profile.href_pattern or "").replace("(?iu)", "(?i)")
        if not re.search(pattern, href):
            continue
        if profile.dedupe == "before":
            if href in seen:
                continue
            seen.add(href)
        tag = find(link if profile.title_in == "link" else item, profile.title)
        if tag is not None:
            title = profile.title_sep.join(pieces(tag))
        elif profile.title_first_piece:
            title = next(iter(pieces(link)), profile.title_default)
        elif profile.title_default is not None:
            title = profile.title_default
        else:
            title = profile.title_sep.join(pieces(link))
        low = title.lower()
        if len(title) < profile.title_min or any(t in low for t in profile.title_skip):
            continue
        if profile.roles is not None and not any(k in low for k in profile.roles):
            if not any(h in href.lower() for h in profile.role_hrefs):
                continue
        key = {"after": href, "url": address(href)}.get(profile.dedupe)
        if key is not None:
            if key in seen:
                continue
            seen.add(key)
        near = {"item": item, "link": link}.get(profile.place_in)
        if profile.place_in == "row":
            up = link["parent"]
            while up >= 0 and nodes[up]["tag"] != profile.row_tag:
                up = nodes[up]["parent"]
            near = nodes[up] if up >= 0 else None
        place = find(near, profile.place) if near else None
        if place is None and item["tag"] == "a":
            place = find(item, profile.place_for_link_items)
        out.append((title, "".join(pieces(place)) if place else profile.place_default, address(href)))
    return out


def test_all_profiles_on_random_pages(spark):
    rnd = random.Random(7)
    url = "https://h/jobs/"
    rows, want = [], {}
    for i in range(4000):
        name, html = rnd.choice(list(P.PROFILES)), random_page(rnd)
        rows.append((i, url, html, name))
        want[i] = read_page(P.PROFILES[name], html, url)
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, profile string")
    got = {i: [] for i in want}
    for r in extract(pages, P.PROFILES, keep=("page_id", "url")).orderBy("page_id", "pos").collect():
        got[r.page_id].append((r.title, r.location, r.url))
    wrong = [(rows[i][3], rows[i][2], got[i], want[i]) for i in want if got[i] != want[i]]
    assert not wrong, wrong[:2]
    by_profile = {name: sum(len(want[i]) for i in want if rows[i][3] == name) for name in P.PROFILES}
    assert min(by_profile.values()) > 5, by_profile


@pytest.mark.parametrize("words", [defaults.ROLE_KEYWORDS, defaults.POSITIVE_KEYWORDS, defaults.NEGATIVE_KEYWORDS])
def test_word_lists_have_no_repeats(words):
    assert len(words) == len(set(words))
