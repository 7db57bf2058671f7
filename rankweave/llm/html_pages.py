"""Labelled pages for training: layouts of many kinds with every block marked."""

from __future__ import annotations

import random

_SYLLABLES = "an ber con da el fi gra ho in ka lo mi nor os pel qui ra sen tu ver wo ya zin".split()
_SMALL = "the of and to a in is that for on with der die und le la de et el los que".split()


def _word(r: random.Random) -> str:
    if r.random() < 0.03:
        return str(r.randint(1, 10 ** r.randint(1, 12)))
    return r.choice(_SMALL) if r.random() < 0.35 else "".join(r.choices(_SYLLABLES, k=r.randint(1, 4)))


def _words(r: random.Random, n: int) -> str:
    return " ".join(_word(r) for _ in range(n))


def _sentence(r: random.Random) -> str:
    text = _words(r, r.randint(1, 22)).capitalize()
    if r.random() < 0.3:
        text = text.replace(" ", ", ", 1)
    return text + r.choice("....!?")


def _paragraph(r: random.Random) -> str:
    return " ".join(_sentence(r) for _ in range(r.choice((1, 1, 2, 3, 5, 8))))


class _Page:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        self.html: list[str] = []
        self.labels: list[int] = []

    def block(self, tag: str, text: str, label: int) -> None:
        self.html.append(f"<{tag}>{text}</{tag}>" if self.r.random() < 0.9 or tag != "p" else f"<p>{text}")
        self.labels.append(label)

    def link(self) -> str:
        return f'<a href="/{self.r.randint(1, 99)}">{_words(self.r, self.r.randint(1, 4))}</a>'

    def inside(self, choices: list[str], fill) -> None:
        opening = self.r.choice(choices)
        self.html.append(f"<{opening}>")
        fill()
        self.html.append(f"</{opening.split()[0]}>")

    def links(self) -> None:
        self.html.append("<ul>")
        for _ in range(self.r.randint(2, 8)):
            self.block("li", self.link(), 0)
        self.html.append("</ul>")

    def sentences(self, most: int = 2) -> None:
        for _ in range(self.r.randint(1, most)):
            self.block(self.r.choice(("p", "div", "span><p")).split(">")[0].replace("span", "p"), _sentence(self.r), 0)

    def bare(self, opening: list[str], text: str) -> None:
        held = self.r.choice(opening)
        self.html.append(f"<{held}>{text}</{held.split()[0]}>")
        self.labels.append(0)

    def form(self) -> None:
        for _ in range(self.r.randint(1, 3)):
            self.block(self.r.choice(("p", "div")), f"<label>{_words(self.r, 2)}</label><input name='q'>", 0)

    def comments(self) -> None:
        self.block("h3", f"{self.r.randint(1, 40)} {_words(self.r, 1)}", 0)
        for _ in range(self.r.randint(1, 5)):
            self.html.append(f'<{"div"} class="{self.r.choice(("comment", "reply", "comment-body"))}">')
            self.block("p", _paragraph(self.r), 0)
            self.html.append("</div>")

    def notice(self) -> None:
        self.bare([f'div class="{c}"' for c in ("notice", "cookie-notice", "alert", "banner", "consent", "gdpr", "warning")]
                  + ['div role="alert"'], _sentence(self.r))

    def advert(self) -> None:
        self.bare([f'div class="{c}"' for c in ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot")]
                  + ['div id="ad"', 'aside class="ad"'], _sentence(self.r))

    def article(self) -> None:
        r = self.r
        if r.random() < 0.85:
            self.block(r.choice(("h1", "h1", "h2")), _words(r, r.randint(2, 10)).capitalize(), 1)
        for i in range(r.randint(1, 12)):
            kind = r.random()
            if kind < 0.72 or not i:
                self.block("p", _paragraph(r), 1)
            elif kind < 0.8:
                self.html.append(f"<p><b>{_sentence(r)}<br>")
                self.labels.append(1)
                self.block("p", _paragraph(r), 1)
            elif kind < 0.86:
                self.block(r.choice(("h2", "h3")), _words(r, r.randint(1, 6)), 1)
            elif kind < 0.91:
                self.html.append("<ul>")
                for _ in range(r.randint(2, 5)):
                    self.block("li", _sentence(r), 1)
                self.html.append("</ul>")
            elif kind < 0.94:
                self.block("blockquote", _paragraph(r), 1)
            elif kind < 0.97:
                self.advert()
            else:
                self.bare([f'div class="{c}"' for c in ("share", "social", "related", "tags")], self.link())

    def build(self) -> tuple[str, list[int]]:
        r = self.r
        self.html.append("<html><head><title>t</title></head><body>")
        if r.random() < 0.5:
            self.inside(["header", 'div class="header"', 'div id="masthead"', 'div class="top"'],
                        lambda: self.block(r.choice(("h1", "p", "div")), _words(r, r.randint(1, 5)), 0))
        if r.random() < 0.85:
            self.inside(["nav", 'div class="menu"', 'ul class="nav"', 'div id="navigation"', 'div class="breadcrumb"'], self.links)
        if r.random() < 0.3:
            self.notice()
        if r.random() < 0.6:
            self.advert()
        side = r.random()
        aside = ["aside", 'div class="sidebar"', 'div id="side"', 'div class="widget"', 'aside class="related"']

        def beside() -> None:
            self.inside(aside, lambda: (self.block("h3", _words(r, 2), 0), self.links() if r.random() < 0.6 else self.sentences(3)))

        if side < 0.25:
            beside()
        self.inside(["article", "article", "article", "main", 'div class="content"', 'div id="content"', 'div class="post"',
                     'div class="entry-content"', 'section class="story"', 'div class="article-body"', "div"], self.article)
        if 0.25 < side < 0.5:
            beside()
        if r.random() < 0.3:
            self.inside(["form", 'form class="newsletter"', 'form id="search"', 'form class="subscribe"'], self.form)
        if r.random() < 0.35:
            self.inside(["section class=\"comments\"", 'div id="comments"', 'div class="comment-list"', 'ol class="commentlist"'], self.comments)
        if r.random() < 0.2:
            self.notice()
        if r.random() < 0.85:
            self.bare(["footer", "footer", 'div class="footer"', 'div id="footer"', 'div class="copyright"'],
                      f"&copy; {_words(r, 1)}.example.com &middot; {_sentence(r)}")
        self.html.append("</body></html>")
        return "".join(self.html), self.labels


def labelled_pages(n: int, seed: int = 0) -> list[tuple[str, list[int]]]:
    """``n`` pages with a label per leaf block: 1 for the article's."""
    return [_Page(seed * 1_000_003 + i).build() for i in range(n)]
