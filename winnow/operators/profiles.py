"""Page layouts as data: what an item is, where its link, title and place are."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace

from winnow import defaults
from winnow.functions.nodes import Select


# Patterns that are alternatives of plain text, so that a value that matches shows in the markup, and
# how that text can be written otherwise: by number, or by the names of letters and marks in it.
_PLAIN = re.compile(r"(?:\(\?[iu]+\))?[A-Za-z0-9/_|-]+")
REFERENCE = "&(?:#|sol|lowbar|UnderBar|imath|inodot|fjlig)"


@dataclass(frozen=True)
class Profile:
    """How listings are read off one page layout.

    ``items`` picks the elements; ``items_fallback`` is used when a page has none. The link
    is the item itself when it passes ``link_is_item``, else the first ``link`` below it.

    ``href_rule``  ``present`` the attribute is there; ``nonempty``; ``any`` missing counts
                   as empty.
    ``title_in``   ``link`` or ``item``: where ``title`` elements are looked for; the text of
                   the link is used when there is none, its first piece only with
                   ``title_first_piece``.
    ``place_in``   ``item``, ``link``, or ``row``: nearest ``row_tag`` ancestor of the link.
    ``dedupe``     ``before`` first of each href, then the title tests; ``after`` the title
                   tests, then first of each href; ``url`` likewise on the full address;
                   ``none``.
    ``address``    ``normalize`` against ``base`` (the page if None), ``prefix`` with
                   ``base``, ``scheme``, ``site`` or ``raw``.
    """

    name: str
    provider: str
    items: Select
    items_fallback: Select | None = None
    link_is_item: Select | None = None
    link: Select = Select(tags=("a",), has_attr="href")
    href_rule: str = "present"
    href_pattern: str | None = None
    href_strip: bool = False
    title: tuple[Select, ...] = ()
    title_in: str = "item"
    title_sep: str = ""
    title_first_piece: bool = False
    title_default: str | None = None
    title_min: int = 0
    title_skip: tuple[str, ...] = ()
    place: tuple[Select, ...] = ()
    place_in: str = "item"
    place_for_link_items: tuple[Select, ...] = ()
    row_tag: str = "li"
    place_default: str = "Remote/Unknown"
    roles: tuple[str, ...] | None = defaults.ROLE_KEYWORDS
    role_hrefs: tuple[str, ...] = ()
    dedupe: str = "before"
    address: str = "normalize"
    base: str | None = None

    def attributes(self) -> set[str]:
        """Names of the attributes that reading a page by this profile needs."""
        selects = [self.items, self.items_fallback, self.link_is_item, self.link]
        selects += [*self.title, *self.place, *self.place_for_link_items]
        return {"href"}.union(*(s.attributes() for s in selects if s is not None))

    def hints(self) -> list[str]:
        """Patterns that the markup of a page with listings matches, where no reference hides a letter.

        They come from what items and addresses must hold, as far as that is plain text.
        """
        needed = [self.href_pattern]
        if self.items_fallback is None:
            token, value = self.items.class_token, (self.items.attr or (None, None))[1]
            needed += [token, self.items.class_pattern, value]
        return [p for p in needed if p and _PLAIN.fullmatch(p)]


# The tags, classes, attributes, addresses and default places of each layout.
ANCHOR = Select(tags=("a",), has_attr="href")
IS_ANCHOR = Select(tags=("a",))
ANY_PLACE = Select(tags=("span",), class_pattern="location")

ASHBY = Profile(
    name="ashby",
    provider="ashby",
    items=ANCHOR,
    link_is_item=IS_ANCHOR,
    href_pattern="/application/|/posting/",
    title_sep=" ",
    title_min=1,
    base="https://jobs.ashbyhq.com",
)

GREENHOUSE = Profile(
    name="greenhouse",
    provider="greenhouse",
    items=Select(tags=("div",), class_token="opening"),
    place=(Select(tags=("span",), class_token="location"),),
    base="https://boards.greenhouse.io",
)

LEVER = Profile(
    name="lever",
    provider="lever",
    items=Select(tags=("a",), class_token="posting-title"),
    link_is_item=IS_ANCHOR,
    href_rule="nonempty",
    title=(Select(tags=("h5",), attr=("data-qa", "posting-name")),),
    title_in="link",
    place=(
        Select(tags=("span",), class_token="sort-by-location"),
        Select(tags=("span",), class_token="location"),
    ),
    place_in="link",
    base="https://jobs.lever.co",
)

TEAMTAILOR = Profile(
    name="teamtailor",
    provider="teamtailor",
    items=Select(
        tags=("li", "div", "a"),
        class_pattern="block-grid-item|job-list-item|candidate-job-item",
    ),
    items_fallback=Select(tags=("a",), attr_pattern=("href", r"/jobs/\p{Nd}+")),
    link_is_item=IS_ANCHOR,
    href_rule="any",
    href_pattern="/jobs/",
    title=(Select(tags=("span",), has_attr="title"),),
    title_in="link",
    title_first_piece=True,
    title_default="Unknown Role",
    place=(Select(class_pattern="location|meta-location|text-md"),),
    place_default="Remote/Stockholm",
    address="scheme",
)

WORKDAY = Profile(
    name="workday",
    provider="workday",
    items=Select(tags=("a",), attr=("data-automation-id", "jobTitle")),
    link_is_item=IS_ANCHOR,
    href_rule="nonempty",
    place=(Select(tags=("dd",), attr=("data-automation-id", "locations")),),
    place_in="row",
)

SMARTRECRUITERS = Profile(
    name="smartrecruiters",
    provider="smartrecruiters",
    items=Select(tags=("li",), class_token="opening-job"),
    title=(Select(tags=("h4",)),),
    place=(ANY_PLACE,),
    base="https://careers.smartrecruiters.com",
)

WORKABLE = Profile(
    name="workable",
    provider="workable",
    items=Select(tags=("li",), attr=("data-ui", "job-opening")),
    title=(Select(tags=("h3",)),),
    place=(ANY_PLACE,),
    base="https://apply.workable.com",
)

SIMPLE = Profile(
    name="simple",
    provider="simple_html",
    items=ANCHOR,
    link_is_item=IS_ANCHOR,
    href_pattern="(?iu)job|career|position|opening",
    title_min=1,
    dedupe="after",
)

SIMPLE_RELAXED = Profile(
    name="simple_relaxed",
    provider="simple_html",
    items=ANCHOR,
    link_is_item=IS_ANCHOR,
    href_strip=True,
    title_sep=" ",
    title_min=3,
    title_skip=defaults.RELAXED_SKIP_TEXTS,
    place_default="Stockholm/Remote",
    roles=defaults.RELAXED_ROLE_KEYWORDS,
    role_hrefs=defaults.RELAXED_HREFS,
    dedupe="url",
    address="site",
)

# The plain variants take every link of the layout, whatever its title.
ASHBY_PLAIN = replace(
    ASHBY, name="ashby_plain", title_min=0, roles=None, dedupe="none", address="prefix"
)

GREENHOUSE_PLAIN = replace(
    GREENHOUSE,
    name="greenhouse_plain",
    link=IS_ANCHOR,
    href_rule="any",
    href_pattern="gh_jid|/jobs/",
    roles=None,
    dedupe="none",
    address="prefix",
)

LEVER_PLAIN = replace(
    LEVER,
    name="lever_plain",
    href_rule="any",
    title_first_piece=False,
    title_default="Unknown Role",
    roles=None,
    dedupe="none",
    address="raw",
)

SMARTRECRUITERS_PLAIN = replace(
    SMARTRECRUITERS,
    name="smartrecruiters_plain",
    place_default="Unknown",
    roles=None,
    address="prefix",
)

TEAMTAILOR_PLAIN = replace(
    TEAMTAILOR,
    name="teamtailor_plain",
    link=IS_ANCHOR,
    place_for_link_items=(Select(tags=("span",), class_token="company-location"),),
    roles=None,
)

PROFILES = {
    p.name: p
    for p in (
        ASHBY, GREENHOUSE, LEVER, TEAMTAILOR, WORKDAY, SMARTRECRUITERS, WORKABLE, SIMPLE,
        SIMPLE_RELAXED, ASHBY_PLAIN, GREENHOUSE_PLAIN, LEVER_PLAIN, SMARTRECRUITERS_PLAIN,
        TEAMTAILOR_PLAIN,
    )
}
LIVE_PROFILES = {
    p.name: p
    for p in (ASHBY, GREENHOUSE, LEVER, TEAMTAILOR, WORKDAY, SMARTRECRUITERS, WORKABLE, SIMPLE)
}
