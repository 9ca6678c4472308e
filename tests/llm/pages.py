"""Invented web pages with their known main texts: what the weights of the HTML classifier are fitted on."""

from __future__ import annotations

import numpy as np

BESIDE = ("sidebar", "side-bar widget", "related", "related-posts", "promo", "ad", "advert box", "newsletter", "share", "social", "tags", "breadcrumbs", "menu", "notice", "cookie-notice", "comments", "popup", "footer-links", "banner")
AROUND = ("layout", "layout has-sidebar", "site menu-fixed", "page", "sidebar-left layout", "no-sidebar", "content with-sidebar", "notice-page", "tags-open", "wrapper", "")


class Maker:
    def __init__(self, seed: int) -> None:
        self.random = np.random.default_rng(seed)

    def one(self, of):
        return of[int(self.random.integers(len(of)))]

    def chance(self, p: float) -> bool:
        return bool(self.random.random() < p)

    def words(self, low: int, high: int) -> str:
        return " ".join("".join(self.one("abcdefghiklmnoprstuvw") for _ in range(int(self.random.integers(2, 9)))) for _ in range(int(self.random.integers(low, high))))

    def sentence(self, low: int = 3, high: int = 18) -> str:
        return self.words(low, high).capitalize() + self.one((*".....!?", "", " ***", "%"))

    def prose(self, most: int = 7) -> str:
        return " ".join(self.sentence() for _ in range(int(self.random.integers(1, most))))

    def links(self) -> str:
        return "".join(f"<li><a href=/{i}>{self.words(1, 4)}</a></li>" for i in range(int(self.random.integers(2, 9))))

    def beside(self, whole: bool) -> str:
        """Boilerplate; ``whole``: with marks that say so, else of links and scraps alone."""
        inner = self.one((lambda: f"<ul>{self.links()}</ul>", lambda: f"<p>{self.prose(3)}</p>", lambda: self.words(1, 8), lambda: f"<h3>{self.words(1, 4)}</h3><ul>{self.links()}</ul>", lambda: f"<p>{self.prose(8)}</p><p>{self.prose(8)}</p>", lambda: f"<article><h3>{self.words(2, 6)}</h3><p>{self.prose(4)}</p></article>"))
        if not whole:
            return self.one((lambda: f"<div><ul>{self.links()}</ul></div>", lambda: f"<div>{self.words(1, 4)}</div>", lambda: f"<table><tr><td><a href=/>{self.words(1, 3)}</a></td><td><a href=/>{self.words(1, 3)}</a></td></tr></table>"))()
        return self.one((lambda: f"<nav>{inner()}</nav>", lambda: f"<aside>{inner()}</aside>", lambda: f"<footer>{inner()}</footer>", lambda: f"<div class=\"{self.one(BESIDE)}\">{inner()}</div>", lambda: f"<section id=\"{self.one(BESIDE)}\">{inner()}</section>", lambda: f"<form><label>{self.words(1, 4)}</label> <input> {self.words(1, 3)}</form>", lambda: f"<header>{self.one(('<p>', '<h1>'))}{self.words(1, 9)}<ul>{self.links()}</ul></header>"))()

    def content(self) -> tuple[str, list[str]]:
        markup, lines = [], []

        def put(before: str, text: str, after: str) -> None:
            markup.append(f"{before}{text}{after}")
            lines.append(text)

        if self.chance(0.8):
            put("<h1>", self.words(2, 9).capitalize(), "</h1>")
        for _ in range(int(self.random.integers(1, 9))):
            kind = self.random.random()
            if kind < 0.5:
                put("<p>", self.prose(), "</p>")
            elif kind < 0.6:
                put("", self.one((self.prose, self.sentence, lambda: self.words(1, 8)))(), "<br>")
            elif kind < 0.63:
                put("<p>", self.prose(), "</p>")
            elif kind < 0.66:
                put("<p>", self.words(1, 30), "</p>")
            elif kind < 0.68:
                put("<div>", self.one((self.prose, self.sentence))(), "</div>")
            elif kind < 0.7:
                markup.append("<table>")
                for _ in range(int(self.random.integers(2, 7))):
                    put("<tr><td>", self.words(1, 4), "</td></tr>")
                markup.append("</table>")
            elif kind < 0.78:
                head = self.one(("h2", "h3"))
                put(f"<{head}>", self.words(1, 6).capitalize(), f"</{head}>")
            elif kind < 0.86:
                markup.append("<ul>")
                for _ in range(int(self.random.integers(2, 5))):
                    put("<li>", self.sentence(2, 9), "</li>")
                markup.append("</ul>")
            elif kind < 0.93:
                put("<blockquote>", self.prose(3), "</blockquote>")
            else:
                before, text = self.sentence(), self.sentence()
                markup.append(f"<p>{before} <a href=/x>{self.words(1, 3)}</a> {text}</p>")
                lines.append("")
                lines[-1] = markup[-1][3:-4].replace("<a href=/x>", "").replace("</a>", "")
        return "".join(markup), lines

    def page(self) -> tuple[str, str]:
        markup, lines = self.content()
        kind = self.random.random()
        main = kind < 0.75
        if main:
            if self.chance(0.4):
                # boilerplate within the article
                at = markup.find("</p>") + 4 if "</p>" in markup else len(markup)
                markup = markup[:at] + self.beside(True).replace("<article>", "<div>").replace("</article>", "</div>") + markup[at:]
            tag = self.one(("article", "main", "article class=\"post has-comments\"", "div role=main"))
            markup = f"<{tag}>{markup}</{tag.split()[0]}>"
        else:
            markup = f"<div{self.one((' id=content', ' class=body', '', ' class=story', '', ' id=text', ' class=notice'))}>{markup}</div>"
        if self.chance(0.6):
            markup = f"<div class=\"{self.one(AROUND)}\">{markup}</div>"
        before = "".join(self.beside(self.chance(0.7)) for _ in range(int(self.random.integers(0, 4))))
        after = "".join(self.beside(self.chance(0.7)) for _ in range(int(self.random.integers(0, 4))))
        return f"<html><head><title>{self.words(2, 5)}</title></head><body>{before}{markup}{after}</body></html>", "\n".join(lines)


def pages(n: int, seed: int) -> list[tuple[str, str]]:
    maker = Maker(seed)
    return [maker.page() for _ in range(n)]
