"""Labelled pages to train the main-text model on: page layouts filled with made-up words.

A layout is a page of a site with its menus, notices, adverts and forms around one article. Every block comes with
its label, so a page is labelled by how it was made. Names of elements and classes are those that
sites commonly use.
"""

from __future__ import annotations

import random
from collections.abc import Iterator

# Tags and class names by the part of a page that they mark.
PARTS = {
    "menu": ["nav", "nav.navbar", "div.menu", "div.main-nav", "div.breadcrumbs", "ul.menu", "div#navigation", "ul.pagination", "div.topbar", "div.toolbar", "div.toc", "div@navigation"],
    "head": ["header", "div.header", "div#header", "div.site-header", "div.masthead", "div.branding", "div@banner"],
    "foot": ["footer", "div.footer", "div#footer", "div.site-footer", "div.copyright", "div.colophon", "div.bottom", "div.legal", "div@contentinfo"],
    "side": ["aside", "div.sidebar", "div#sidebar", "div.widget", "aside.related", "div.related-posts", "div.recommended", "div.rail", "div.trending", "div.tags", "div.author-bio", "div@complementary"],
    "note": ["div.cookie-banner", "div.notice", "div.alert", "div.consent", "div.gdpr", "div.popup", "div.modal", "div.newsletter", "div.subscribe", "div.paywall", "div.disclaimer", "dialog", "noscript", "div@alert", "div.hidden"],
    "ad": ["div.ad", "div.ads", "div.advert", "div.advertisement", "div.sponsored", "div.promo", "div.banner-ad", "ins.adsbygoogle", "aside.ad", "section.ad-slot", "div#ad-top", "p.ad", "div#ads"],
    "form": ["form", "form.search", "form.login", "div.search-form", "form.contact", "fieldset", "div@search"],
    "talk": ["section.comments", "div.comments", "div#comments", "ol.comment-list", "div.comment", "div.replies", "div.discussion", "div.respond", "ul.commentlist", "div.disqus-thread", "section.reviews"],
    "share": ["div.share", "ul.social", "div.share-buttons", "div.social-links", "p.byline", "div.post-meta", "p.date", "div.entry-meta"],
}
# Elements that hold the article.
ARTICLES = ["article", "main", "article.post", "div.content", "div#content", "div.article-body", "div.entry-content", "div.post-content", "div.story", "section.article", "div.text", "div.main", "div@main", "div.body"]
# Elements that say nothing of what they hold.
PLAIN = ["div", "div.wrapper", "div.container", "div#page", "div.row", "div.col", "section", "div.inner", "div#root", "center", "div.x1", "div.layout"]

_SYLLABLES = "ka to mi ren sol va ther in de la ou st ei an er qu or lu né ß по ра ни 日 本 語 ا ل".split()


class Maker:
    """Random pages; equal seeds make equal pages."""

    def __init__(self, seed: int):
        self.random = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        r = self.random
        return " ".join("".join(r.choices(_SYLLABLES, k=r.randint(1, 4))) for _ in range(r.randint(low, high)))

    def sentence(self, low: int = 3, high: int = 20) -> str:
        words = self.words(low, high).split(" ")
        return " ".join(w + "," * (self.random.random() < 0.12) for w in words).capitalize() + self.random.choice(".....!?。")

    def prose(self, most: int = 6) -> str:
        return " ".join(self.sentence() for _ in range(self.random.randint(1, most)))

    def opened(self, name: str) -> tuple[str, str]:
        """Start and end tag of ``tag``, ``tag.class``, ``tag#id`` or ``tag@role``."""
        for mark, attribute in ((".", "class"), ("#", "id"), ("@", "role")):
            tag, found, value = name.partition(mark)
            if found:
                return f'<{tag} {attribute}="{value}">', f"</{tag}>"
        return f"<{name}>", f"</{name}>"

    def within(self, name: str, parts: list[tuple[str, int]]) -> list[tuple[str, int]]:
        start, end = self.opened(name)
        return [(start, -1), *parts, (end, -1)]

    def links(self, tag: str) -> list[tuple[str, int]]:
        return [(f'<{tag}><a href="/{i}">{self.words(1, 3)}</a></{tag}>', 0) for i in range(self.random.randint(2, 7))]

    def part(self, kind: str) -> list[tuple[str, int]]:
        """A part of the page that is no article."""
        r, name = self.random, self.random.choice(PARTS[kind])
        if kind == "menu":
            inner = self.links("li") if name[:2] == "ul" else self.within("ul", self.links("li")) if r.random() < 0.7 else [(f'<a href="/">{self.words(1, 3)}</a> ' * 4, 0)]
        elif kind == "talk":
            inner = [(f"<h3>{self.words(1, 2)}</h3>", 0)] if name[0] != "o" and name[0] != "u" else []
            item = "li" if name[0] in "ou" else r.choice(["div", "article", "div.comment-body"])
            for _ in range(r.randint(1, 5)):
                own = [(f"<b>{self.words(1, 2)}</b>", 0)] * (r.random() < 0.5) + [(f"<p>{self.prose()}</p>", 0) for _ in range(r.randint(1, 3))]
                inner += self.within(item, own)
        elif kind == "form":
            inner = [(f"<label>{self.words(1, 3)}</label><input>", 0), (f"<p>{self.sentence()}</p>", 0), (f"<button>{self.words(1, 2)}</button>", 0)]
        elif kind == "foot":
            inner = [(f"&copy; {self.words(1, 3)} &middot; {self.sentence(2, 14)}", 0)] if r.random() < 0.6 else [(f"<p>&copy; {self.words(2, 6)} | {self.prose(2)}</p>", 0), *self.within("ul", self.links("li"))]
        elif kind == "head":
            inner = [(f"<{t}>{self.words(1, 5)}</{t}>", 0) for t in r.sample(["h1", "p", "span", "div"], 2)] + self.within("ul", self.links("li")) * (r.random() < 0.5)
        elif kind == "side":
            inner = [(f"<h3>{self.words(1, 4)}</h3>", 0)] + (self.within("ul", self.links("li")) if r.random() < 0.5 else [(f"<p>{self.prose(4)}</p>", 0) for _ in range(r.randint(1, 3))])
        elif kind == "share":
            inner = [(self.words(1, 6), 0)] if name[0] == "p" else self.within("span", [(self.words(1, 5), 0)]) if name[:2] != "ul" else self.links("li")
        else:
            inner = [(self.prose(6), 0)] if r.random() < 0.6 or name[:3] == "ins" else [(f"<p>{self.prose(3)}</p>", 0), (f'<a href="#">{self.words(1, 2)}</a>', 0)]
        return self.within(name, inner)

    def article(self) -> list[tuple[str, int]]:
        r, out = self.random, []
        if r.random() < 0.8:
            title = [(f"<h1>{self.words(2, 12)}</h1>", 1)]
            out += self.within("header", title) if r.random() < 0.15 else title
        broken, cuts = r.random() < 0.3, 0.45 if r.random() < 0.35 else 0.05
        block = r.choice(["p", "p", "p", "p", "div"])
        # Tables pasted as text, and signs that elsewhere tell menus and footers.
        between = r.choice([" | ", " · ", " &copy; ", " *** ", "&amp; "]) if r.random() < 0.2 else " "
        for _ in range(r.choice([0, 1, 2, 3, 5, 8, 14])):
            kind, text = r.random(), self.prose(r.choice([1, 2, 6]))
            if r.random() < 0.2:
                text = text.replace(" ", f' <a href="/x">{self.words(1, 3)}</a> ', 1)
            if r.random() < 0.2:
                text = self.words(1, 2) + "."
            if r.random() < 0.2:  # neither length nor a last stop tells an article
                text = self.words(1, 14) if r.random() < 0.5 else self.sentence(1, 14)[:-1]
            if between != " ":
                text = between.join(text.split(" ")) if "<" not in text else text
            if kind < 0.72:
                out.append((f"<p><b>{text}<br>" if broken and r.random() < 0.2 else f"<{block}>{text}</{block}>", 1))
            elif kind < 0.8:
                out.append((f"<{r.choice(['h2', 'h3', 'h4'])}>{self.words(1, 7)}</h2>", 1))
            elif kind < 0.86:
                out += self.within(r.choice(["ul", "ol"]), [(f"<li>{self.words(2, 12)}</li>", 1) for _ in range(r.randint(2, 5))])
            elif kind < 0.9:
                out += self.within("blockquote", [(f"<p>{text}</p>", 1)])
            elif kind < 0.93:
                out.append((f"<pre>{self.words(4, 20)}</pre>", 1))
            elif kind < 0.96:
                out += self.within("figure", [("<img src=x>", -1), (f"<figcaption>{self.sentence(3, 9)}</figcaption>", 1)])
            else:
                out += self.within("table", self.within("tr", [(f"<td>{self.words(1, 4)}</td>", 1) for _ in range(3)]))
            if r.random() < cuts:
                out += self.part(r.choice(["ad", "share", "side", "form", "note"]))
        return out

    def page(self) -> list[tuple[str, int]]:
        """(html, label) pieces of a page; 1 is article, 0 another part, -1 holds no text."""
        r, plain = self.random, self.random.random() < 0.15
        body: list[tuple[str, int]] = []
        if plain:
            body = [(self.prose(), 1)] if r.random() < 0.3 else self.article()
            body = self.within(r.choice(ARTICLES), body) if r.random() < 0.5 else body
            body += self.part(r.choice(["talk", "foot", "share"])) if r.random() < 0.3 else []
        else:
            few = r.random() < 0.2
            before = [] if few else [k for k in ("note", "head", "menu", "form", "side", "ad") if r.random() < (0.85 if k == "menu" else 0.4)]
            after = [k for k in ("share", "side", "talk", "ad", "form", "note", "menu") if r.random() < 0.3]
            for k in before:
                body += self.part(k)
            story = self.article()
            if r.random() < 0.15:
                story += self.part("talk")
            holder = self.within(r.choice(ARTICLES), story) if r.random() < 0.93 else story
            if r.random() < 0.3:
                holder = self.within(r.choice(PLAIN), holder + (self.part("side") if r.random() < 0.4 else []))
            body += holder
            for k in after:
                body += self.part(k)
            if r.random() < 0.85:
                body += self.part("foot")
        for _ in range(r.choice([0, 0, 1, 2])):
            body = self.within(r.choice(PLAIN), body)
        head = '<meta charset="utf-8"><title>t</title><style>p{margin:0}</style><script>var t="</p>";</script>'
        return [(f"<!DOCTYPE html><html><head>{head}</head><body>", -1), *body, ("</body></html>", -1)]


def labelled_pages(n: int, seed: int = 17) -> Iterator[list[tuple[str, int]]]:
    """``n`` labelled pages, the same ones for the same seed."""
    maker = Maker(seed)
    for _ in range(n):
        yield maker.page()
