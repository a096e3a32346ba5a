"""Labelled pages for the extraction model: built from a fixed seed out of page parts whose role is known.

A page is a list of parts; each part is a container with names and blocks; the label of a block says whether it
belongs to the article. Lengths overlap on purpose: short article paragraphs, long comments and adverts.
"""

from __future__ import annotations

import random

SYLLABLES = "an be co de er fi go ha in jo ka le mi no or pa qu re st ta un vi wa xe yo ze th ion ment est ung lich cion eau oi".split()

#: (tags, names) of containers that hold no article text.
OUTSIDE = {
    "menu": (("nav", "ul", "div", "menu"), "nav menu navbar navigation main-menu topnav breadcrumb breadcrumbs site-nav links pagination pager tabs toc skip".split()),
    "header": (("header", "div"), "header site-header masthead top-bar page-header brand logo tagline branding banner hero-bar".split()),
    "footer": (("footer", "div"), "footer site-footer copyright bottom legal colophon page-footer credits imprint foot".split()),
    "side": (("aside", "div", "section"), "sidebar side widget related recommended more-stories popular trending complementary rail teaser also-read recent".split()),
    "notice": (("div", "section", "aside", "p"), "notice cookie cookie-notice consent gdpr alert banner warning message popup modal overlay privacy announcement toast paywall disclaimer info-bar".split()),
    "advert": (("div", "aside", "section", "p"), "ad ads advert advertisement sponsored promo promotion ad-slot adsbygoogle sponsor partner-content commercial affiliate marketing".split()),
    "form": (("form", "div", "fieldset"), "form newsletter subscribe signup login search search-box contact register subscription poll feedback-form".split()),
    "comments": (("section", "div", "ol", "ul", "article", "aside"), "comments comment reader-comments responses replies reply discussion disqus respond comment-list feedback reviews user-comments thread".split()),
    "share": (("div", "ul", "p", "section"), "share social sharing tags byline meta author-box follow tools print toolbar buttons bookmark post-meta tag-list".split()),
}
ARTICLE = (("article", "main", "div", "section", "td"), "article content post post-body entry entry-content story main main-content article-body text body-text page-content".split())


class _Writer:
    def __init__(self, rnd: random.Random):
        self.rnd, self.html, self.labels = rnd, [], []

    def words(self, low: int, high: int, stop: bool) -> str:
        rnd = self.rnd
        words = ["".join(rnd.choices(SYLLABLES, k=rnd.randint(1, 3))) for _ in range(rnd.randint(low, high))]
        return " ".join(words).capitalize() + ("." if stop else "")

    def block(self, tag: str, text: str, label: int, close: bool = True) -> None:
        self.html.append(f"<{tag}>{text}" + (f"</{tag}>" if close else ""))
        self.labels.append(label)

    def opened(self, tags: tuple[str, ...], names: list[str], named: float = 0.75) -> str:
        rnd = self.rnd
        tag = rnd.choice(tags)
        # a neutral container says what it is by its name only
        speaks = tag not in ("div", "section", "ul", "ol", "p", "td")
        attribute = f' {rnd.choice(("class", "id"))}="{rnd.choice(names)}"' if not speaks or rnd.random() < named else ""
        self.html.append(f"<{tag}{attribute}>")
        return tag

    def outside(self, kind: str) -> None:
        rnd = self.rnd
        tag = self.opened(*OUTSIDE[kind])
        if tag == "p":
            self.html.append(self.words(2, rnd.choice((20, 110)), True))
            self.labels.append(0)
        elif kind == "menu" or (kind in ("side", "share", "footer") and rnd.random() < 0.5):
            for _ in range(rnd.randint(2, 7)):
                self.block("li" if rnd.random() < 0.8 else "div", f'<a href="/x">{self.words(1, 6, False)}</a>', 0)
        elif kind == "form":
            for _ in range(rnd.randint(1, 3)):
                self.block(rnd.choice(("p", "div", "button", "h3", "legend")), self.words(1, 12, rnd.random() < 0.5), 0)
                self.html.append('<input name="x">')
        elif rnd.random() < 0.35:  # text straight in the container
            self.html.append(self.words(2, rnd.choice((25, 110)), True))
            self.labels.append(0)
        else:
            if rnd.random() < (0.7 if kind == "header" else 0.3):
                self.block("h1" if kind == "header" else rnd.choice(("h2", "h3", "h4")), self.words(1, 5, False), 0)
            for _ in range(rnd.randint(1, 5 if kind == "comments" else 3)):
                if kind == "comments" and rnd.random() < 0.4:
                    self.html.append('<div class="comment">')
                    self.block("p", self.words(3, rnd.choice((50, 110)), True), 0)
                    self.html.append("</div>")
                else:
                    self.block(rnd.choice(("p", "p", "div", "li")), self.words(2, rnd.choice((40, 110)), rnd.random() < 0.8), 0)
        self.html.append(f"</{tag}>")

    def article(self) -> None:
        rnd = self.rnd
        bare = rnd.random() < 0.12  # blocks straight in the page's body
        tag = "" if bare else self.opened(*ARTICLE, named=0.3)
        headed = tag in ("article", "main") and rnd.random() < 0.3
        if rnd.random() < 0.85:
            if headed:
                self.html.append("<header>")
            self.block("h1", self.words(1, 10, rnd.random() < 0.5), 1)
            if headed:
                self.html.append("</header>")
        loose = rnd.random() < 0.4  # unclosed paragraphs
        for _ in range(rnd.choice((0, 1, 1, 2, 3, 4, 6, 9))):
            kind = rnd.random()
            if kind < 0.70:
                self.block("p", rnd.choice(("", "", "<b>")) + self.words(1, rnd.choice((3, 20, 60, 110)), rnd.random() < 0.9) + ("<br>" if loose else ""), 1, close=not loose)
            elif kind < 0.79:
                self.block(rnd.choice(("h2", "h3")), self.words(1, 7, False), 1)
            elif kind < 0.87:
                self.html.append("<ul>")
                for _ in range(rnd.randint(1, 4)):
                    self.block("li", self.words(1, 15, rnd.random() < 0.5), 1)
                self.html.append("</ul>")
            elif kind < 0.90:
                self.block(rnd.choice(("blockquote", "pre")), self.words(3, 25, True), 1)
            elif kind < 0.93:
                self.block("p", f'<a href="/y">{self.words(1, 5, False)}</a> {self.words(1, 15, True)}', 1)
            else:
                self.outside(rnd.choice(("advert", "share", "side", "notice", "form", "comments", "footer", "menu")))
        if rnd.random() < 0.3:
            self.outside(rnd.choice(("comments", "share", "side", "footer")))
        if tag:
            self.html.append(f"</{tag}>")


def labelled_pages(pages: int, seed: int = 7) -> list[tuple[str, list[int]]]:
    """(html, label of each leaf block in page order)."""
    out = []
    for number in range(pages):
        rnd = random.Random(seed * 100_003 + number)
        w = _Writer(rnd)
        w.html.append("<!DOCTYPE html><html><head>")
        if rnd.random() < 0.9:
            w.block("title", w.words(1, 10, False), 0)
        w.html.append("<style>p{margin:0}</style><script>var t = '</p>';</script></head><body>")
        before = [k for k in ("header", "menu", "notice", "advert", "form", "side") if rnd.random() < 0.4]
        after = [k for k in ("comments", "side", "header", "advert", "share", "form", "notice", "menu", "footer") if rnd.random() < 0.4]
        rnd.shuffle(before)
        wrapped = rnd.random() < 0.3
        for kind in before:
            w.outside(kind)
        if wrapped:
            w.html.append('<div class="wrapper container">')
        if rnd.random() < 0.95:
            w.article()
        if wrapped and rnd.random() < 0.5:
            w.html.append("</div>")
            wrapped = False
        for kind in after:
            w.outside(kind)
        w.html.append("</div></body></html>" if wrapped else "</body></html>")
        out.append(("".join(w.html), w.labels))
    return out
