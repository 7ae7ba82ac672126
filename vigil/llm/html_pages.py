"""Made-up pages with known labels, on which the block labeller is trained.

A page is a chain of fragments around one article.  Every text is drawn from
random syllables, so that a label cannot be learnt from whole texts but only
from tags, class names, a few telling words and the neighbours."""

from __future__ import annotations

import random

_SYLLABLES = ("an be ci do el fa go hu in ju ka lo mi no or pe qui ra so ta un ve wa xi yo za ther "
              "ing tion ment ous ble est ière ción heit ung schaft que").split()
_SMALL = "the of and to in is der die und das zu le la et les de en el los que y".split()
_LINKS = "Home About Contact Help Login Sign up Next Previous Archive Search Menu Top News".split()
_NOTICE = "cookies privacy accept consent settings subscribe newsletter email terms".split()
_ADVERT = "sponsored advertisement offer buy now sale discount shop free".split()
_COMMENT = "reply said comment posted ago like report anonymous user".split()

#: Words for class names by part of a page.
_CLASSES = {
    "main": "content post article entry story body main text",
    "menu": "nav menu navbar navigation breadcrumb links topbar tabs",
    "head": "header masthead banner branding logo top",
    "foot": "footer copyright bottom legal colophon",
    "side": "sidebar aside related widget recommended popular trending share social tags",
    "advert": "ad ads advert sponsor promo banner sponsored",
    "notice": "notice cookie alert gdpr consent popup modal newsletter subscribe",
    "comments": "comments comment replies discussion respond reply",
}


def _word(rng: random.Random) -> str:
    return rng.choice(_SMALL) if rng.random() < 0.3 else "".join(
        rng.choice(_SYLLABLES) for _ in range(rng.randint(1, 4)))


def _text(rng: random.Random, low: int, high: int, extra=(), rate: float = 0.3) -> str:
    words = [rng.choice(extra) if extra and rng.random() < rate else _word(rng)
             for _ in range(rng.randint(low, high))]
    if rng.random() < 0.2:  # repeated words and symbols occur in articles too
        words = [w + rng.choice(("", "!", "%%%", " |", "&amp;")) for w in words]
    if rng.random() < 0.1:
        words = [w for w in words for _ in range(3)]
    out = " ".join(words)
    return (out[:1].upper() + out[1:]) + rng.choice((".", ".", "", "!", "?"))


def _attr(rng: random.Random, part: str, rate: float = 0.8) -> str:
    if rng.random() > rate:
        return ""
    word = rng.choice(_CLASSES[part].split())
    word = rng.choice((word, f"{word}-{rng.choice(('box', 'wrap', 'main', 'x1'))}", f"site-{word}"))
    return f' {rng.choice(("class", "class", "id"))}="{word}"'


class _Page:
    def __init__(self, rng: random.Random):
        self.rng, self.labels, self.html = rng, {}, []

    def say(self, label: int, low: int, high: int, extra=(), rate: float = 0.3) -> str:
        text = _text(self.rng, low, high, extra, rate)
        self.labels[" ".join(text.replace("&amp;", "&").split())] = label
        return text

    def menu(self):
        r = self.rng
        items = [f'<a href="/{_word(r)}">{self.say(0, 1, 3, _LINKS)}</a>' for _ in range(r.randint(3, 8))]
        body = r.choice((
            "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>",
            "".join(f"<div>{x}</div>" for x in items)))
        tag = r.choice(("nav", "nav", "div", "ul"))
        self.html.append(f"<{tag}{_attr(r, 'menu', 0.5 if tag == 'nav' else 1)}>{body}</{tag}>")

    def head(self):
        r = self.rng
        tag = r.choice(("header", "header", "div"))
        inner = f"<{r.choice(('h1', 'h2', 'div', 'p'))}>".replace("<", "")[:-1]
        self.html.append(f"<{tag}{_attr(r, 'head', 0.4 if tag == 'header' else 1)}>"
                         f"<{inner}>{self.say(0, 1, 8)}</{inner}></{tag}>")

    def foot(self):
        r = self.rng
        tag = r.choice(("footer", "footer", "div"))
        text = r.choice(("&copy; ", "", "© 2024 ")) + self.say(0, 1, 12)
        self.labels[" ".join(text.replace("&copy;", "©").replace("&amp;", "&").split())] = 0
        more = f"<p>{self.say(0, 2, 15)}</p>" if r.random() < 0.4 else ""
        self.html.append(f"<{tag}{_attr(r, 'foot', 0.4 if tag == 'footer' else 1)}>{text}{more}</{tag}>")

    def box(self, part: str, tags: tuple, extra=()):
        r = self.rng
        tag = r.choice(tags)
        own = tag in ("aside", "form")
        title = f"<h3>{self.say(0, 1, 4, extra)}</h3>" if r.random() < 0.4 else ""
        body = r.choice((
            lambda: self.say(0, 1, 30, extra),
            lambda: f"<p>{self.say(0, 3, 30, extra)}</p>",
            lambda: f"<p>{self.say(0, 3, 20, extra)}</p><p>{self.say(0, 3, 20, extra)}</p>",
            lambda: "<ul>" + "".join(f'<li><a href="#">{self.say(0, 1, 6, extra)}</a></li>'
                                     for _ in range(r.randint(2, 5))) + "</ul>"))()
        self.html.append(f"<{tag}{_attr(r, part, 0.6 if own else 1)}>{title}{body}</{tag}>")

    def form(self):
        r = self.rng
        self.html.append(f"<form{_attr(r, 'notice', 0.3)}><label>{self.say(0, 1, 3, _NOTICE)}</label>"
                         f"<input><button>{self.say(0, 1, 2, _NOTICE)}</button></form>")

    def comments(self):
        r = self.rng
        tag = r.choice(("section", "div", "ol"))
        rows = "".join(f"<{c}{_attr(r, 'comments', 0.7)}><p>{self.say(0, 2, 30, _COMMENT, 0.15)}</p></{c}>"
                       for c in [r.choice(("div", "li", "article"))] * r.randint(1, 4))
        title = f"<h3>{self.say(0, 1, 3, _COMMENT)}</h3>" if r.random() < 0.6 else ""
        self.html.append(f"<{tag}{_attr(r, 'comments', 1)}>{title}{rows}</{tag}>")

    def boxes(self, rate: float):
        r = self.rng
        for make in (lambda: self.box("side", ("aside", "div", "section"), _LINKS),
                     lambda: self.box("advert", ("div", "div", "aside", "section"), _ADVERT),
                     lambda: self.box("advert", ("div",)),
                     lambda: self.box("notice", ("div", "section"), _NOTICE), self.form):
            if r.random() < rate:
                make()

    def article(self):
        r = self.rng
        tag = r.choice(("article", "article", "main", "div", "section"))
        self.html.append(f"<{tag}{_attr(r, 'main', 0.3 if tag in ('article', 'main') else 1)}>")
        if r.random() < 0.85:
            h = r.choice(("h1", "h1", "h2"))
            self.html.append(f"<{h}>{self.say(1, 1, 14)}</{h}>")
        for _ in range(r.choice((0, 1, 1, 2, 4, 8, 16, 30))):
            kind = r.random()
            if kind < 0.7:
                text = self.say(1, 1, r.choice((4, 20, 80, 150)))
                close = "</p>" if r.random() < 0.85 else r.choice(("", "<br>"))
                bold = r.random() < 0.15
                self.html.append(f"<p>{'<b>' if bold else ''}{text}"
                                 f"{'</b>' if bold and close == '</p>' and r.random() < 0.5 else ''}{close}")
            elif kind < 0.8:
                self.html.append("<ul>" + "".join(f"<li>{self.say(1, 1, 15)}</li>"
                                                  for _ in range(r.randint(2, 5))) + "</ul>")
            elif kind < 0.87:
                h = r.choice(("h2", "h3", "h4"))
                self.html.append(f"<{h}>{self.say(1, 1, 8)}</{h}>")
            elif kind < 0.93:
                self.html.append(f"<blockquote>{self.say(1, 3, 40)}</blockquote>")
            elif kind < 0.96:
                self.html.append(f"<table><tr><td>{self.say(1, 1, 5)}</td><td>{self.say(1, 1, 5)}</td>"
                                 "</tr></table>")
            else:
                self.box("advert", ("div", "aside"), _ADVERT)
        self.html.append(f"</{tag}>")


def labelled_page(rng: random.Random) -> tuple[str, dict[str, int]]:
    """A page and the label (1: main text) of each block text."""
    page = _Page(rng)
    page.html.append("<!DOCTYPE html><html><head><title>x</title><style>p{}</style></head><body>")
    if rng.random() < 0.2:
        page.html.append(f"<div{_attr(rng, 'main', 0.2)}>")
    for make, rate in ((page.head, 0.5), (page.menu, 0.8)):
        if rng.random() < rate:
            make()
    page.boxes(0.25)
    page.article()
    page.boxes(0.25)
    for make, rate in ((page.comments, 0.35), (page.foot, 0.85)):
        if rng.random() < rate:
            make()
    page.html.append("</body></html>")
    html = "".join(page.html)
    if rng.random() < 0.1:
        html = html[:rng.randint(len(html) // 3, len(html))]
    return html, page.labels
