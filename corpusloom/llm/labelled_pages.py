"""Labelled pages to train the block model on: layouts in common use, filled with invented words.

Each page is markup of which every text carries its label, 1 for the article and 0 for what is around it.
"""

from __future__ import annotations

import html
import random
from collections.abc import Iterator

SYLLABLES = "ba be co da de el en er es fi ga ho in ka la le lo ma me mi na ne ni on or pa ra re ri sa se ta te ti to un va ve wi zo".split()

#: (element, class words) of parts around an article, by kind.
AROUND = {
    "menu": [("nav", ""), ("div", "menu"), ("ul", "navbar"), ("div", "main-menu"), ("div", "breadcrumb"), ("div", "nav"), ("header", "site-nav"), ("ul", "")],
    "header": [("header", ""), ("div", "header"), ("div", "site-header"), ("div", "masthead"), ("div", "top-bar"), ("div", "banner")],
    "footer": [("footer", ""), ("div", "footer"), ("div", "site-footer"), ("div", "copyright"), ("div", "bottom"), ("div", "colophon")],
    "aside": [("aside", ""), ("div", "sidebar"), ("div", "widget"), ("div", "related"), ("div", "right-column"), ("section", "related-posts"), ("div", "recommended"), ("div", "share social")],
    "notice": [("div", "cookie-notice"), ("div", "notice"), ("div", "consent"), ("div", "alert"), ("div", "popup"), ("div", "gdpr-banner"), ("div", "newsletter"), ("section", "subscribe"), ("div", "modal")],
    "advert": [("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "advertisement"), ("div", "sponsor"), ("div", "promo"), ("section", "ad-slot"), ("aside", "ad"), ("p", "ad"), ("div", "sponsored")],
    "form": [("form", ""), ("form", "search"), ("form", "login"), ("div", "signup-form")],
    "comments": [("section", "comments"), ("div", "comments"), ("div", "comment-list"), ("ol", "commentlist"), ("div", "responses"), ("div", "discussion"), ("section", "reader-comments"), ("div", "replies")],
}
MAIN = [("article", ""), ("main", ""), ("div", "content"), ("div", "article-body"), ("div", "post"), ("div", "entry-content"),
        ("section", "story"), ("div", "main-text"), ("div", "article"), ("td", ""), ("div", ""), ("section", ""), ("div", "body")]


class _Writer:
    def __init__(self, draw: random.Random):
        self.draw, self.labels, self.out = draw, [], []

    def word(self) -> str:
        return "".join(self.draw.choice(SYLLABLES) for _ in range(self.draw.randint(1, 4)))

    def words(self, low: int, high: int) -> str:
        return " ".join(self.word() for _ in range(self.draw.randint(low, high)))

    def sentence(self, low: int = 4, high: int = 22) -> str:
        body = self.words(low, high)
        if self.draw.random() < 0.5:
            body = body.replace(" ", ", ", 1)
        return body.capitalize() + self.draw.choice("....!?")

    def text(self, text: str, label: int) -> str:
        self.labels.append(label)
        return html.escape(text)

    def tag(self, name: str, words: str, inner: str) -> str:
        return f'<{name} class="{words}">{inner}</{name}>' if words else f"<{name}>{inner}</{name}>"

    def links(self, label: int = 0) -> str:
        n = self.draw.randint(3, 9)
        if self.draw.random() < 0.7:
            return "<ul>" + "".join(f'<li><a href="/{i}">{self.text(self.words(1, 3), label)}</a></li>' for i in range(n)) + "</ul>"
        self.labels.append(label)
        return " | ".join(f'<a href="/{i}">{self.words(1, 2)}</a>' for i in range(n))

    def prose(self, label: int, low: int, high: int, tags: str = "p") -> str:
        name = self.draw.choice(tags.split())
        return f"<{name}>{self.text(' '.join(self.sentence() for _ in range(self.draw.randint(low, high))), label)}</{name}>"

    def around(self, kind: str) -> str:
        name, words = self.draw.choice(AROUND[kind])
        draw = self.draw
        if kind == "menu":
            inner = self.links()
        elif kind == "header":
            inner = f"<div>{self.text(self.words(1, 4), 0)}</div>" + (self.prose(0, 1, 1) if draw.random() < 0.4 else "")
        elif kind == "footer":
            inner = self.text("© " * (draw.random() < 0.7) + self.words(1, 3) + draw.choice([" 2020", "", " · " + self.sentence()]), 0)
            if draw.random() < 0.4:
                inner = f"<p>{inner}</p>" + self.links()
        elif kind == "aside":
            inner = f"<h3>{self.text(self.words(1, 3), 0)}</h3>" + (self.links() if draw.random() < 0.6 else self.prose(0, 1, 3))
        elif kind == "form":
            inner = f"<label>{self.text(self.words(1, 3), 0)}</label><input name=q><button>{self.word()}</button>"
        elif kind == "comments":
            inner = f"<h3>{self.text(self.words(1, 2), 0)}</h3>"
            for _ in range(draw.randint(1, 5)):
                holder = draw.choice([("div", "comment"), ("li", ""), ("article", "comment"), ("div", "reply"), ("p", "")])
                inner += self.tag(*holder, (f"<b>{self.word()}</b> " if draw.random() < 0.5 else "") + self.text(" ".join(self.sentence() for _ in range(draw.randint(1, 4))), 0))
        else:
            inner = self.text(" ".join(self.sentence(3, 12) for _ in range(draw.randint(1, 2))), 0)
        return self.tag(name, words, inner)

    def article(self) -> str:
        draw = self.draw
        name, words = draw.choice(MAIN)
        inner = f"<h1>{self.text(self.words(3, 10).capitalize(), 1)}</h1>" if draw.random() < 0.8 else ""
        for _ in range(draw.randint(1, 12)):
            kind = draw.random()
            if kind < 0.7:
                inner += self.prose(1, 1, 7, "p p p p div blockquote pre section")
            elif kind < 0.78:
                inner += f"<h2>{self.text(self.words(1, 6).capitalize(), 1)}</h2>"
            elif kind < 0.84:
                inner += "<ul>" + "".join(f"<li>{self.text(self.sentence(3, 12), 1)}</li>" for _ in range(draw.randint(2, 5))) + "</ul>"
            elif kind < 0.88:
                inner += f"<p>{self.text(self.sentence(1, 3), 1)}</p>"
            elif kind < 0.92:
                inner += "<table>" + "".join(f"<tr><td>{self.text(self.words(1, 3), 1)}</td><td>{self.text(self.words(1, 3), 1)}</td></tr>" for _ in range(draw.randint(1, 4))) + "</table>"
            elif kind < 0.96:
                inner += self.around(draw.choice(["advert", "aside", "notice"]))
            else:
                inner += f'<figure><img src="x"><figcaption>{self.text(self.sentence(3, 10), 1)}</figcaption></figure>'
        if draw.random() < 0.15:
            inner += self.around("comments")
        if name == "td":
            return f"<table><tr><td>{inner}</td></tr></table>"
        return self.tag(name, words, inner)

    def page(self) -> str:
        draw = self.draw
        before = [k for k in ("notice", "header", "menu", "advert", "form", "aside") if draw.random() < 0.45]
        after = [k for k in ("comments", "aside", "advert", "notice", "form", "menu") if draw.random() < 0.35]
        draw.shuffle(after)
        body = "".join(self.around(k) for k in before) + self.article() + "".join(self.around(k) for k in after)
        body += self.around("footer") if draw.random() < 0.8 else ""
        if draw.random() < 0.3:
            body = self.tag("div", draw.choice(["", "wrapper", "container", "page", "layout"]), body)
        return f"<html><head><title>{self.word()}</title></head><body>{body}</body></html>"


def labelled_pages(n: int, seed: int) -> Iterator[tuple[str, list[int]]]:
    """``n`` pages and the label of each text of theirs in order."""
    draw = random.Random(seed)
    for _ in range(n):
        writer = _Writer(draw)
        page = writer.page()
        yield page, writer.labels
