"""Labelled pages for training the extraction model: layouts written by hand,
rendered with made-up words.  ``data-y="c"`` marks main content and everything
below it, ``data-y="b"`` what is not, down to the next mark."""

from __future__ import annotations

import random
import re

_SYLLABLES = "ka lo mi ter no san ve ru pel du sta fi gon hal ixe jor bre ceth wyn zam oli qua".split()

#: Names in class and id attributes of the parts, as pages in the wild use them.
MAIN_NAMES = ["content", "main-content", "post-content", "entry-content", "article-body", "story", "post", "entry", "article", "text", "page-content", "body-text"]
AD_NAMES = ["ad", "ads", "advert", "advertisement", "ad-banner", "sponsored", "sponsor", "promo", "promotion"]
NOTICE_NAMES = ["cookie", "cookie-banner", "notice", "consent", "alert", "gdpr", "popup", "modal", "banner", "newsletter"]
SIDE_NAMES = ["sidebar", "side", "widget", "widgets", "aside", "related", "recommended", "trending", "more-stories", "tags"]
MENU_NAMES = ["menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "topbar", "links", "pagination", "toc"]
FOOT_NAMES = ["footer", "foot", "copyright", "site-footer", "legal", "bottom"]
HEAD_NAMES = ["header", "masthead", "site-header", "top", "logo", "branding"]
COMMENT_NAMES = ["comments", "comment-list", "comment", "replies", "discussion", "respond", "disqus"]
SHARE_NAMES = ["share", "social", "share-buttons", "follow", "byline-share", "tools"]
FORM_NAMES = ["search", "login", "subscribe", "signup", "contact-form", "newsletter-form"]


class _Page:
    def __init__(self, seed: int):
        self.r = random.Random(seed)

    def pick(self, names: list[str]) -> str:
        name = self.r.choice(names)
        return self.r.choice([f'class="{name}"', f'id="{name}"', f'class="{name} {self.r.choice("abc")}{self.r.randint(1, 9)}"'])

    def word(self) -> str:
        return "".join(self.r.choice(_SYLLABLES) for _ in range(self.r.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.r.randint(low, high)))

    def sentence(self) -> str:
        return self.words(3, 18).capitalize() + self.r.choice(".....?!")

    def link(self, low: int = 1, high: int = 4) -> str:
        return f'<a href="/{self.word()}">{self.words(low, high)}</a>'

    def prose(self) -> str:
        kind = self.r.random()
        if kind < 0.12:
            return self.words(1, 3) + self.r.choice(["", ".", "!!", " ###"])
        if kind < 0.16:
            return self.link()
        if kind < 0.2:
            return self.words(2, 9).upper()
        text = " ".join(self.sentence() for _ in range(self.r.randint(1, 8)))
        return text + (f" {self.link()} {self.sentence()}" if self.r.random() < 0.25 else "")

    def items(self, n: int) -> str:
        return "<ul>" + "".join(f"<li>{self.link()}</li>" for _ in range(n)) + "</ul>"

    def menu(self) -> str:
        inner = self.items(self.r.randint(2, 9)) if self.r.random() < 0.7 else " | ".join(self.link() for _ in range(self.r.randint(2, 7)))
        return self.r.choice([f'<nav data-y="b">{inner}</nav>', f'<nav {self.pick(MENU_NAMES)} data-y="b">{inner}</nav>',
                              f'<div {self.pick(MENU_NAMES)} data-y="b">{inner}</div>', f'<ul {self.pick(MENU_NAMES)} data-y="b"><li>{self.link()}</li></ul>'])

    def small(self, names: list[str], tags: list[str]) -> str:
        tag = self.r.choice(tags)
        inner = self.r.choice([self.words(2, 8), self.sentence(), f"<p>{self.sentence()}</p>", f"<p>{self.link()}</p>",
                               f"<h3>{self.words(1, 3)}</h3>{self.items(self.r.randint(1, 6))}"])
        name = "" if tag in ("aside", "footer", "header") and self.r.random() < 0.5 else self.pick(names)
        return f'<{tag} {name} data-y="b">{inner}</{tag}>'

    def form(self) -> str:
        inner = f'<label>{self.words(1, 3)}</label><input type="text"><button>{self.words(1, 2)}</button>'
        form = f"<form>{inner}</form>" if self.r.random() < 0.5 else f"<p>{self.sentence()}</p><form>{inner}</form>"
        return self.r.choice([f'<div {self.pick(FORM_NAMES)} data-y="b">{form}</div>', f'<form data-y="b">{inner}</form>',
                              f'<form {self.pick(FORM_NAMES)} data-y="b"><p>{self.sentence()}</p>{inner}</form>'])

    def comments(self) -> str:
        one = lambda: f"<div {self.pick(COMMENT_NAMES)}><b>{self.word()}</b><p>{self.prose()}</p></div>"
        inner = f"<h3>{self.words(1, 2)}</h3>" + "".join(one() for _ in range(self.r.randint(1, 5)))
        if self.r.random() < 0.5:
            inner = f"<h3>{self.words(1, 2)}</h3><ol>" + "".join(f"<li><p>{self.prose()}</p></li>" for _ in range(self.r.randint(1, 4))) + "</ol>"
        tag = self.r.choice(["div", "section", "aside"])
        return f'<{tag} {self.pick(COMMENT_NAMES)} data-y="b">{inner}</{tag}>'

    def footer(self) -> str:
        inner = self.r.choice([f"&copy; {self.words(1, 3)} &middot; {self.sentence()}", f"<p>&copy; {self.words(1, 4)}</p>{self.items(3)}", self.items(4), f"<p>{self.sentence()}</p>"])
        return self.r.choice([f'<footer data-y="b">{inner}</footer>', f'<div {self.pick(FOOT_NAMES)} data-y="b">{inner}</div>',
                              f'<footer {self.pick(FOOT_NAMES)} data-y="b">{inner}</footer>'])

    def header(self) -> str:
        inner = self.r.choice([f"<p>{self.words(1, 3)}</p>", self.words(1, 4), f"<h2>{self.words(1, 3)}</h2>", f"<h1>{self.words(1, 3)}</h1>",
                               f'<a href="/">{self.words(1, 2)}</a>', f"<h1>{self.link(1, 2)}</h1><p>{self.sentence()}</p>"])
        if self.r.random() < 0.3:
            inner += self.items(self.r.randint(2, 6)) if self.r.random() < 0.5 else f"<nav>{self.items(self.r.randint(2, 6))}</nav>"
        return self.r.choice([f'<header data-y="b">{inner}</header>', f'<div {self.pick(HEAD_NAMES)} data-y="b">{inner}</div>',
                              f'<header {self.pick(HEAD_NAMES)} data-y="b">{inner}</header>'])

    def inside(self) -> str:
        """A part of the main text."""
        kind = self.r.random()
        if kind < 0.6:
            return f"<p>{self.prose()}</p>"
        if kind < 0.68:
            return self.r.choice(["<h2>{}</h2>", "<h3>{}</h3>"]).format(self.words(1, 7))
        if kind < 0.86:
            return self.r.choice(["<ul>{}</ul>", "<ul>{}</ul>", "<ol>{}</ol>"]).format(
                "".join(f"<li>{self.prose()}</li>" for _ in range(self.r.randint(1, 5))))
        if kind < 0.9:
            return f"<blockquote><p>{self.prose()}</p></blockquote>"
        if kind < 0.93:
            return "<table>" + "".join(f"<tr><td>{self.word()}</td><td>{self.words(1, 3)}</td></tr>" for _ in range(self.r.randint(1, 4))) + "</table>"
        if kind < 0.95:
            return f"<div>{self.prose()}</div>"
        if kind < 0.97:
            return f"<figure><figcaption>{self.sentence()}</figcaption></figure>"
        return f"<pre>{self.words(2, 20)}</pre>"

    def main(self) -> str:
        parts = [f"<h1>{self.words(2, 10)}</h1>"] if self.r.random() < 0.85 else []
        if self.r.random() < 0.08 and parts:
            parts = [f"<header>{parts[0]}</header>"]
        parts += [self.inside() for _ in range(self.r.randint(1, 14))]
        for _ in range(self.r.randint(0, 2)):
            parts.insert(self.r.randint(0, len(parts)), self.r.choice([
                lambda: self.small(AD_NAMES, ["div", "aside", "section"]), lambda: self.small(SHARE_NAMES, ["div", "section"]),
                lambda: self.small(SIDE_NAMES, ["aside", "div"]), self.form, lambda: self.small(NOTICE_NAMES, ["div"]), self.comments, self.menu])())
        inner = "".join(parts)
        kind = self.r.random()
        if kind < 0.08:  # no element around the text
            return "".join(p if "data-y" in p.split(">")[0] else re.sub(r"^<(\w+)", r'<\1 data-y="c"', p) for p in parts)
        if kind < 0.38:
            return f'<article data-y="c">{inner}</article>'
        if kind < 0.45:
            return f'<article {self.pick(MAIN_NAMES)} data-y="c">{inner}</article>'
        if kind < 0.6:
            return f'<main data-y="c">{inner}</main>'
        if kind < 0.7:
            return f'<main><article data-y="c">{inner}</article></main>'
        if kind < 0.9:
            return f'<div {self.pick(MAIN_NAMES)} data-y="c">{inner}</div>'
        return f'<section {self.pick(MAIN_NAMES)} data-y="c">{inner}</section>'

    def render(self) -> str:
        before = [self.header, self.menu, lambda: self.small(NOTICE_NAMES, ["div", "section", "aside"]), self.form, lambda: self.small(AD_NAMES, ["div", "aside", "section"])]
        after = [lambda: self.small(SIDE_NAMES, ["aside", "div", "section"]), self.comments, lambda: self.small(AD_NAMES, ["div", "aside"]),
                 lambda: self.small(SHARE_NAMES, ["div", "section"]), self.form, self.menu, lambda: self.small(NOTICE_NAMES, ["div", "section"])]
        top = [f() for f in before if self.r.random() < 0.5]
        self.r.shuffle(top)
        end = [f() for f in after if self.r.random() < 0.3]
        self.r.shuffle(end)
        middle = self.main() + "".join(end)
        if self.r.random() < 0.4:
            middle = f"<div class=\"{self.r.choice(['wrapper', 'container', 'row', 'page', 'site', 'layout'])}\">{middle}</div>"
        foot = self.footer() if self.r.random() < 0.85 else ""
        return f"<!DOCTYPE html><html><head><title>{self.words(2, 6)}</title></head><body>{''.join(top)}{middle}{foot}</body></html>"


def labelled_pages(n: int = 1500, seed: int = 11) -> list[str]:
    return [_Page(seed * 1_000_003 + i).render() for i in range(n)]
