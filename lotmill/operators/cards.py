"""Listing cards out of web pages.

Only finding the card elements needs Python; it hands back the text of each
field and everything after that is column work.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from datetime import datetime
from html import unescape
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lotmill.functions import cards as rules
from lotmill.functions import dates, links
from lotmill.operators.dedup import first_visits
from lotmill.schemas import RAW_COLUMNS

# Element and class text that mark a listing card, the text of a
# challenge page, and where each field stands inside a card. A field lists
# alternatives; an alternative is a path of (tag, class text) steps, "/" for a
# direct child and "//" for any descendant.
CARD = ("li", "ListingsListstyle__ListingListItemWrapper")
CHALLENGE_TEXT = "Checking your browser"
FIELDS = {
    "link": [
        [
            ("//", "div", "slick-slide slick-active slick-current"),
            ("/", "a", "depth-listing-card-link"),
        ],
        [
            ("//", "div", "BasicCardstyle__ListingImageWrapper-iZfXFa kjZOzk"),
            ("/", "a", "depth-listing-card-link"),
        ],
        [
            ("//", "div", "ListingContactDetailsButtonstyle__ButtonsWrapper"),
            ("/", "button", "ListingContactDetailsButtonstyle__ButtonItem"),
            ("/", "a", "depth-listing-card-link"),
        ],
    ],
    "agent": [
        [("//", "div", "ListingHeadingstyle__HeadingTitle")],
        [("//", "div", "heading-name")],
    ],
    "posted": [
        [("//", "p", "ListingHeadingstyle__HeadingCreationDate")],
        [
            ("//", "div", "BasicCardstyle__HeadingWrapper-DxbUP knxJEk"),
            ("/", "p", "heading-creation-date"),
        ],
    ],
    "price": [
        [("//", "li", "ListingPricestyle__ItemWrapper")],
        [("//", "div", "ListingPricestyle__RangePriceWrapper")],
    ],
    "psf": [[("//", "div", "ListingPricestyle__PricePSFWrapper")]],
    "name": [
        [("//", "h2", "PremiumCardstyle__TitleWrapper")],
        [
            ("//", "div", "BasicCardstyle__DescriptionWrapper-dPdKmp fRMZJr"),
            ("//", "h2", "BasicCardstyle__TitleWrapper-eNIiIX dLdNwJ"),
        ],
    ],
    "location": [
        [("//", "div", "PremiumCardstyle__AddressWrapper")],
        [
            ("//", "div", "BasicCardstyle__DescriptionWrapper-dPdKmp fRMZJr"),
            ("//", "div", "BasicCardstyle__AddressWrapper-jUpzVZ jikSUL"),
        ],
    ],
    "attrs": [
        [("//", "p", "ListingAttributesstyle__ListingAttrsDescriptionItemWrapper")]
    ],
}

# Elements without content, elements that do not break a line of rendered text,
# elements whose content is text only or is not rendered, and elements before
# which an open paragraph ends.
VOID = set("area base br col embed hr img input link meta source track wbr".split())
INLINE = set(
    "a abbr b bdi bdo button cite code em i label mark q s small span strong sub sup u".split()
)
TEXT_ONLY = set("script style textarea title xmp iframe noembed noframes noscript".split())
UNSEEN = {*TEXT_ONLY, "template"}
ENDS_PARAGRAPH = set(
    "address article aside div dl footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p "
    "section table ul".split()
)

# A comment, a declaration, or a tag with its attributes. Quotes only count
# after "="; possessive repeats keep a broken page from being scanned again.
_ATTRS = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)*+"""
MARKUP = re.compile(
    rf"""<!--(?:-?>|.*?(?:--!?>|\Z))
    |<[!?][^>]*+>?
    |<(?P<end>/?)(?P<tag>[A-Za-z][^\s/>]*+)(?P<attrs>{_ATTRS})(?:>|\Z)""",
    re.S | re.X,
)
# The same, where an element of text only is one piece up to its end tag.
_SWALLOWED = "|".join(rf"(?i:{tag})(?=[\s/>]){_ATTRS}(?:>.*?(?=</(?i:{tag})[\s/>]|\Z)|\Z)" for tag in TEXT_ONLY)
PIECES = re.compile(
    rf"""(<(?:!--(?:-?>|.*?(?:--!?>|\Z))
    |[!?][^>]*+>?
    |(?:{_SWALLOWED})
    |/?[A-Za-z][^\s/>]*+{_ATTRS}(?:>|\Z)))""",
    re.S | re.X,
)
ATTRIBUTE = re.compile(r"""([^\s/>=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
# An address that is the same on every page and that urljoin would not change.
ABSOLUTE = re.compile(r"https?://[A-Za-z0-9.-]+(?:/[^?#;\s\x00-\x20]*)?")


def attributes(source: str) -> dict[str, str]:
    """Attributes of a tag by lower-case name; the first of a name counts."""
    found: dict[str, str] = {}
    for name, double, single, bare in ATTRIBUTE.findall(source):
        found.setdefault(name.lower(), unescape(double or single or bare))
    return found


class CardReader:
    """Collects the field texts of every card of a page, in page order.

    A field takes the first element, in document order, that any of its
    alternatives matches. One reader serves all pages of a task; what a tag means
    is worked out once for each text of a tag, as pages repeat theirs.
    """

    def __init__(self, card=CARD, fields=FIELDS):
        self.card = card
        self.by_tag: dict[str, list] = {}
        for field, paths in fields.items():
            for path in paths:
                self.by_tag.setdefault(path[-1][1], []).append((field, path))
        self.marked = {card[0], *(step[1] for ps in fields.values() for p in ps for step in p)}
        self.kinds: dict[str, tuple] = {}

    def read(self, page_url: str, html: str) -> list[dict]:
        self.page_url = page_url or ""
        stack, open_cards, captures = [], [], []
        self.stack, self.open_cards, self.captures = stack, open_cards, captures
        cards: list[dict] = []
        kinds, pieces = self.kinds, PIECES.split(html)
        # No text counts before the first tag; after it, each tag comes with the text behind it.
        for token, text in zip(pieces[1::2], pieces[2::2]):
            if (kind := kinds.get(token)) is None:
                kind = self._kind(token)
            closing, element, breaks, fields, is_card, special = kind
            if special:
                self._special(element[0])
            if breaks and captures:
                self._break_line()
            if closing:
                if stack and stack[-1][0] == element[0]:
                    at = len(stack) - 1
                    if captures and captures[-1][0] == at or open_cards and open_cards[-1][0] == at:
                        self._close_to(at)
                    else:
                        stack.pop()
                else:
                    self._end(element[0])
            elif element and not (special and element[0] in VOID):
                stack.append(element)
                if fields and open_cards:
                    self._match(fields, token)
                if is_card:
                    cards.append({})
                    open_cards.append((len(stack) - 1, cards[-1]))
            if captures and text and stack[-1][0] not in UNSEEN:
                # Blanks are settled when the element closes; until then a line break is only that of an element.
                text = unescape(text).replace("\n", " ")
                for _, _, _, parts in captures:
                    parts.append(text)
        self._close_to(0)
        return cards

    def _kind(self, token: str) -> tuple:
        """Of a token: if it closes, its element (tag and class; None for no tag), if it ends a line, the fields its
        own step may match, if it is a card, and if it does more than to open or close an element."""
        found = MARKUP.match(token)
        if not found["tag"]:
            kind = False, None, False, [], False, False
        else:
            end, tag, name, fields = found["end"], found["tag"].lower(), "", []
            if tag in self.marked and not end:
                name = attributes(found["attrs"]).get("class", "")
                fields = [(f, path) for f, path in self.by_tag.get(tag, ()) if path[-1][2] in name]
            is_card = not end and tag == self.card[0] and self.card[1] in name
            special = not end and (tag in ENDS_PARAGRAPH or tag in VOID)
            kind = bool(end), (tag, name), tag not in INLINE, fields, is_card, special
        if len(token) <= 500:
            if len(self.kinds) >= 10000:
                self.kinds.clear()
            self.kinds[token] = kind
        return kind

    def _special(self, tag: str) -> None:
        """What an element ends by beginning."""
        if tag in ENDS_PARAGRAPH:
            self._close_if_open("p", {"button", "li", "div", "td"})
            if tag == "li":
                self._close_if_open("li", {"ul", "ol"})

    def _match(self, fields: list, token: str) -> None:
        at = len(self.stack) - 1
        for floor, card in self.open_cards:
            for field, path in fields:
                if field not in card and self._reached(path, len(path) - 1, at, floor):
                    card[field] = None
                    if field == "link":
                        card[field] = self._absolute(attributes(MARKUP.match(token)["attrs"]).get("href"))
                    else:
                        self.captures.append((at, card, field, []))

    def _end(self, tag: str) -> None:
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == tag:
                self._close_to(at)
                return

    def _break_line(self) -> None:
        for _, _, _, parts in self.captures:
            parts.append("\n")

    def _reached(self, path, step: int, at: int, floor: int) -> bool:
        axis, tag, mark = path[step]
        here_tag, here_class = self.stack[at]
        if here_tag != tag or mark not in here_class:
            return False
        if step == 0:
            return True
        lowest = max(at - 1 if axis == "/" else 0, floor + 1)
        for up in range(at - 1, lowest - 1, -1):
            if self._reached(path, step - 1, up, floor):
                return True
        return False

    def _absolute(self, href: str | None) -> str | None:
        if href is None or ABSOLUTE.fullmatch(href):
            return href
        try:
            return urljoin(self.page_url, href)
        except ValueError:
            return href

    def _close_if_open(self, tag: str, within: set[str]) -> None:
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at][0] == tag:
                self._close_to(at)
                return
            if self.stack[at][0] in within:
                return

    def _close_to(self, at: int) -> None:
        del self.stack[at:]
        while self.captures and self.captures[-1][0] >= at:
            _, card, field, parts = self.captures.pop()
            text = "".join(parts).strip("\n")
            if "\n" in text:
                lines = (" ".join(line.split()) for line in text.split("\n"))
                card[field] = "\n".join(line for line in lines if line)
            else:
                card[field] = " ".join(text.split())
        while self.open_cards and self.open_cards[-1][0] >= at:
            self.open_cards.pop()


def card_texts(
    pages: DataFrame, card=CARD, fields=FIELDS, spread: int | None = None
) -> DataFrame:
    """One row per card: page, card number on the page, and field texts.

    Pages without the card mark, and challenge pages, never reach Python.
    Reading runs where the pages were scanned; ``spread`` first deals the
    pages out over that many tasks, for a scan that has too few.
    """
    names = list(fields)
    schema = "page_id bigint, url string, card_no int, " + ", ".join(f"`{n}` string" for n in names)
    columns = ["page_id", "url", "card_no", *names]

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = CardReader(card, fields)
        for batch in batches:
            rows: list[tuple] = []
            for page_id, url, html in zip(batch["page_id"], batch["url"], batch["html"]):
                for number, found in enumerate(reader.read(url, html)):
                    rows.append((page_id, url, number, *(found.get(n) for n in names)))
                if len(rows) >= 5000:
                    yield pd.DataFrame(rows, columns=columns)
                    rows = []
            if rows:
                yield pd.DataFrame(rows, columns=columns)

    wanted = without_challenges(pages).filter(F.col("html").contains(card[1]))
    wanted = wanted.select("page_id", "url", "html")
    return (wanted.repartition(spread) if spread else wanted).mapInPandas(read, schema)


def without_challenges(pages: DataFrame, text: str = CHALLENGE_TEXT) -> DataFrame:
    """Pages that are not a browser challenge."""
    return pages.filter(~F.coalesce(F.col("html").contains(text), F.lit(False)))


def _listings(cards: DataFrame, as_of: datetime) -> DataFrame:
    link, psf, attrs = F.col("link"), F.nullif("psf", F.lit("")), F.nullif("attrs", F.lit(""))
    source, psf_text = links.source_name(link), rules.psf_text(psf)
    values = {
        "Page_Link": link,
        "Source": source,
        "Agent_Name": F.col("agent"),
        "Posted_Date": F.col("posted"),
        "House_Price": F.col("price"),
        "Price_Square_Feet": psf_text,
        "House_Name": F.col("name"),
        "House_Location": F.col("location"),
        "House_Type": rules.house_type(attrs),
        "Lot_Type": rules.lot_type(attrs),
        "Square_Footage": rules.floor_area(attrs),
        "House_Furniture": rules.furniture(attrs),
        "Created_At": dates.stamp(as_of),
    }
    reason = F.when(link.isNotNull() & source.isNull(), "source").when(
        psf.isNotNull() & psf_text.isNull(), "price_square_feet"
    )
    return cards.select(
        "page_id",
        "url",
        "card_no",
        *[values[c].alias(c) for c in RAW_COLUMNS],
        reason.alias("reject_reason"),
    )


def extract_listings(
    pages: DataFrame, as_of: datetime, card=CARD, fields=FIELDS, spread: int | None = None
) -> DataFrame:
    """Raw listing rows of all cards, each page URL taken on its first visit that is no challenge.

    Cards that cannot be read carry a ``reject_reason`` and leave the other
    cards of their page alone. Repeat visits are dropped after extraction, so
    page bodies are never shuffled.
    """
    cards = first_visits(card_texts(pages, card, fields, spread), without_challenges(pages))
    return _listings(cards, as_of)
