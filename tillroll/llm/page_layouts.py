"""Training pages: texts of a sample set in many layouts, with known main parts.

The main part of a page is marked ``data-main="1"``, what is no part of it
``data-main="0"``; the nearest mark above a text holds.  Layouts differ in
elements (semantic ones, sections, tables), in class and id names or their
absence, in order, nesting and in what they have: menus, headers, footers,
sidebars, notices, adverts, forms, share bars, related links and reader
comments, before, after, beside and inside the main part.
"""

from __future__ import annotations

import random
from html import escape

# Names that parts of pages go by, and the elements they use.
NAMES = {
    "main": "article content post entry story main body text page blog news".split(),
    "menu": "nav menu navbar navigation breadcrumb breadcrumbs tabs toc links topnav".split(),
    "header": "header masthead banner logo top branding head".split(),
    "footer": "footer bottom copyright legal foot colophon".split(),
    "sidebar": "sidebar aside widget related rail recommended popular trending teaser more".split(),
    "notice": "notice cookie consent alert popup newsletter subscribe modal message gdpr paywall".split(),
    "ad": "ad ads advert advertisement sponsor sponsored promo promotion banner adbox".split(),
    "form": "form search login signup contact register".split(),
    "comments": "comments comment replies reply discussion respond disqus reviews".split(),
    "share": "share social sharing tools follow".split(),
    "wrap": "wrap wrapper container row col inner outer site layout grid box".split(),
}
ELEMENTS = {"main": ("article", "main"), "menu": ("nav",), "header": ("header",), "footer": ("footer",),
            "sidebar": ("aside",), "form": ("form",), "ad": ("aside", "div"), "comments": ("section", "div"),
            "notice": ("div", "aside"), "share": ("div", "ul"), "wrap": ("div",)}
PHRASES = ("Read more", "Log in", "Reply", "Share", "Next", "Contact", "About", "Accept", "Close", "Search")


class Layout:
    """Draws pages from a sample's long and short texts."""

    def __init__(self, seed: int, prose: list[str], shorts: list[str]):
        self.rng = random.Random(seed)
        self.prose = prose or [" ".join(self._word() for _ in range(40)) + "." for _ in range(50)]
        self.shorts = shorts or list(PHRASES)

    def _word(self) -> str:
        return "".join(self.rng.choice("bdfklmnprst") + self.rng.choice("aeiou") for _ in range(self.rng.randint(1, 4)))

    def _short(self, most: int = 6) -> str:
        if self.rng.random() < 0.3:
            return self.rng.choice(PHRASES)
        return escape(" ".join(self.rng.choice(self.shorts if self.rng.random() < 0.5 else self.prose).split()
                               [:self.rng.randint(1, most)]))

    def _sentences(self, least: int, most: int) -> str:
        words = self.rng.choice(self.prose).split()
        n = self.rng.randint(least, most)
        at = self.rng.randint(0, max(len(words) - n, 0))
        return escape(" ".join(words[at:at + n]))

    def _link(self, text: str) -> str:
        return f'<a href="/{self._word()}">{text}</a>'

    def _named(self, kind: str) -> str:
        """Attributes with a name of the kind, or none."""
        if self.rng.random() < self.plain:
            return ""
        name = self.rng.choice(NAMES[kind])
        more = self.rng.choice(["{}"] * 4 + ["site-{}", "{}-list", "{}_box", "page{}", "{}-wrapper", "{}-1", "my-{}", "c-{} x1"])
        key = self.rng.choice(("class", "class", "id"))
        return f' {key}="{more.format(name)}"'

    def _part(self, kind: str, inner: str, main: int | None = 0) -> str:
        tag = self.rng.choice(ELEMENTS[kind]) if self.rng.random() < self.semantic else self.rng.choice(("div", "div", "section"))
        attrs = self._named(kind)
        if not attrs and tag in ("div", "section") and kind not in ("wrap", "main", "menu"):
            attrs = f' class="{self.rng.choice(NAMES[kind])}"'  # else nothing tells a comment from an article
        mark = "" if main is None else f' data-main="{main}"'
        return f"<{tag}{attrs}{mark}>{inner}</{tag}>"

    def _menu(self) -> str:
        links = [self._link(self._short(3)) for _ in range(self.rng.randint(2, 12))]
        if self.rng.random() < 0.6:
            inner = "<ul>" + "".join(f"<li>{x}</li>" for x in links) + "</ul>"
        else:
            inner = self.rng.choice((" | ", " ", " &raquo; ")).join(links)
        return self._part("menu", inner)

    def _form(self) -> str:
        fields = "".join(f'<label>{self._short(3)}</label><input name="q">' for _ in range(self.rng.randint(1, 4)))
        return f'<form{self._named("form")} data-main="0">{fields}<button>{self._short(2)}</button></form>'

    def _notice(self) -> str:
        kind = self.rng.choice(("notice", "ad"))
        text = self._sentences(3, 30)
        return self._part(kind, self.rng.choice((f"<p>{text}</p>", text, f"{text} <button>OK</button>", f"<h4>{self._short()}</h4><p>{text}</p>")))

    def _ad(self) -> str:
        text = self._sentences(2, 25)
        return self._part("ad", self.rng.choice((text, f"<p>{text}</p>", self._link(text))))

    def _share(self) -> str:
        return self._part("share", " ".join(self._link(self._short(1)) for _ in range(self.rng.randint(2, 5))))

    def _side(self) -> str:
        items = []
        for _ in range(self.rng.randint(1, 5)):
            items.append(f"<h3>{self._short(4)}</h3>")
            kind = self.rng.random()
            if kind < 0.4:
                items.append("<ul>" + "".join(f"<li>{self._link(self._short(8))}</li>" for _ in range(self.rng.randint(2, 6))) + "</ul>")
            elif kind < 0.7:
                items.append(f"<p>{self._sentences(4, 40)} {self._link('Read more')}</p>")
            else:
                items.append(self._form() if kind < 0.8 else f"<p>{self._sentences(3, 25)}</p>")
        return self._part("sidebar", "".join(items))

    def _comments(self) -> str:
        parts = [f"<h3>{self._short(3)}</h3>"]
        for _ in range(self.rng.randint(1, 5)):
            text = "".join(f"<p>{self._sentences(3, 60)}</p>" for _ in range(self.rng.randint(1, 2)))
            parts.append(self._part("comments", f"<b>{self._short(2)}</b> <span>{self.rng.randint(1, 28)}.{self.rng.randint(1, 12)}.</span>{text}"
                                    + self._link("Reply"), None))
        if self.rng.random() < 0.5:
            parts.append(self._form())
        return self._part("comments", "".join(parts))

    def _footer(self) -> str:
        text = self.rng.choice((f"&copy; {self._word()}.example &middot; {self._sentences(2, 15)}", self._sentences(2, 20),
                                " ".join(self._link(self._short(2)) for _ in range(5))))
        return self._part("footer", self.rng.choice((text, f"<p>{text}</p>", f"<div>{text}</div><p>{self._short()}</p>")))

    def _article(self) -> str:
        title = escape(" ".join(self.rng.choice(self.prose).split()[:self.rng.randint(1, 12)]))
        blocks = []
        head = self.rng.random()
        if head < 0.8:
            blocks.append(f"<h1>{title}</h1>" if head < 0.7 else f"<header><h1>{title}</h1></header>")
        loose = self.rng.random() < 0.3  # paragraphs that nothing closes
        for _ in range(self.rng.choice((0, 1, 1, 2, 3, 4, 6, 8, 12))):
            text = self._sentences(1, 12) if self.rng.random() < 0.25 else self._sentences(10, 150)
            if self.rng.random() < 0.15:
                text = text.replace(" ", f" {self._link(self._short(2))} ", 1)
            kind = self.rng.random()
            if kind < 0.75:
                if loose and self.rng.random() < 0.4:
                    blocks.append(f"<p><b>{text}<br>")
                else:
                    blocks.append(f"<p>{text}</p>")
            elif kind < 0.82:
                blocks.append(f"<h2>{self._short(8)}</h2><p>{text}</p>")
            elif kind < 0.88:
                blocks.append("<ul>" + "".join(f"<li>{self._sentences(2, 20)}</li>" for _ in range(self.rng.randint(2, 5))) + "</ul>")
            elif kind < 0.92:
                blocks.append(f"<blockquote>{text}</blockquote>")
            elif kind < 0.96:
                blocks.append(f"<div>{text}</div>")
            else:
                blocks.append("<table>" + "".join(f"<tr><td>{self._short(3)}</td><td>{self._short(3)}</td></tr>" for _ in range(3)) + "</table>")
            if self.rng.random() < 0.12:
                blocks.append(self.rng.choice((self._ad, self._share, self._notice, self._form))())
        if not blocks:
            blocks.append(f"<p>{self._sentences(1, 60)}</p>")
        if self.rng.random() < 0.2:
            blocks.insert(self.rng.randint(0, len(blocks)), self._share())
        return self._part("main", "".join(blocks), 1)

    def _wrapped(self, inner: str) -> str:
        for _ in range(self.rng.choice((0, 0, 1, 1, 2, 3))):
            inner = self._part("wrap", inner, None)
        return inner

    def page(self) -> str:
        rng = self.rng
        self.semantic = rng.choice((0.0, 0.0, 0.5, 1.0))
        self.plain = rng.choice((0.0, 0.2, 1.0))
        chance = lambda p, f: [f()] if rng.random() < p else []
        middle = chance(0.3, self._side) + [self._article()] + chance(0.35, self._comments) + chance(0.35, self._side)
        if rng.random() < 0.15:
            middle = ["<table><tr>" + "".join(f"<td>{x}</td>" for x in middle) + "</tr></table>"]
        top = chance(0.25, self._notice)
        head = chance(0.8, self._menu) + chance(0.2, self._form) + chance(0.4, lambda: f"<h2>{self._short(4)}</h2>")
        rng.shuffle(head)
        top += [self._part("header", "".join(head))] if rng.random() < 0.5 else [
            x if "data-main" in x else f'<div data-main="0" class="{rng.choice(NAMES["header"])}">{x}</div>' for x in head]
        top += chance(0.4, self._ad)
        body = top + [self._wrapped("".join(middle))] + chance(0.85, self._footer) + chance(0.15, self._notice)
        return f"<html><head><title>x</title></head><body>{self._wrapped(''.join(body))}</body></html>"
