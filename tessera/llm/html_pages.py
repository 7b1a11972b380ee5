"""Synthetic pages with known main text, to train the extractor on: every word of it begins with a mark."""

from __future__ import annotations

import random

MARK = "\ue000"

_SOUNDS = "an be co da el fi ga ho in ju ka lo mi no or pe qua ra si ta un ve wo ya zu é ñ ü ch tion ment er st".split()
_HOLDERS = ["article", "article", "main", "div.content", "div.post-body", "div.entry-content", "div.story", "section.article-text", "div#main-text", "div", "main>article", "div.page-content>div.text"]
_ADS = ["div.ad", "div.ads", "div.advert", "div.banner", "div.sponsored", "div.promo-box", "aside.ad", "div#ad-slot", "ins.adsbygoogle", "section.sponsor"]
_BARS = ["aside", "aside.sidebar", "div.sidebar", "div#side-bar", "div.widget", "div.related", "section.related-posts", "div.trending", "div.newsletter"]
_NOTES = ["div.cookie-notice", "div#cookies", "div.consent", "div.alert", "div.notice", "div.popup", "div.gdpr-banner", "p.disclaimer"]
_TALK = ["section.comments", "div#comments", "div.comment-list", "ol.commentlist", "div.discussion", "div.replies", "section#reader-comments", "div.disqus"]
_MENUS = ["nav", "nav", "nav.menu", "div.navbar", "ul.menu", "div#navigation", "div.breadcrumbs", "header>nav"]
_HEADS = ["header", "header.site-header", "div.header", "div#masthead", "div.topbar"]
_FEET = ["footer", "footer", "footer.site-footer", "div.footer", "div#footer", "div.copyright"]
_SHARE = ["div.share", "ul.social", "div.share-buttons", "div.tags", "p.byline-links"]


class _Writer:
    def __init__(self, seed: int):
        self.r = random.Random(seed)
        # Some sites' names say nothing, or not in words known here.
        self.dumb = random.Random(seed + 1).random() < 0.3

    def word(self) -> str:
        return "".join(self.r.choice(_SOUNDS) for _ in range(self.r.randint(1, 4)))

    def text(self, low: int, high: int, mark: bool, plain: bool = False) -> str:
        out = [self.word() for _ in range(self.r.randint(low, high))]
        if mark:
            out = [MARK + w for w in out]
        if not plain:
            for k in range(4, len(out), self.r.randint(6, 14)):
                out[k] += self.r.choice([".", ".", ",", "!", "&amp;", "?"])
            out[-1] += "."
        return " ".join(out)

    def wrap(self, spec: str, inner: str) -> str:
        for part in reversed(spec.split(">")):
            tag, attr = part, ""
            for sign, name in ((".", "class"), ("#", "id")):
                if sign in part:
                    tag, value = part.split(sign, 1)
                    if self.dumb:
                        tag, value = (tag if self.r.random() < 0.4 else "div"), f"{self.word()}-{self.r.randint(1, 99)}"
                    attr = f' {name}="{value}"'
            if attr and self.r.random() < 0.3:
                attr = f' data-x="{self.r.randint(1, 99)}"{attr}'
            inner = f"<{tag}{attr}>{inner}</{tag}>"
        return inner

    def links(self, n: int) -> str:
        items = [f'<a href="/{k}">{self.text(1, 4, False, True)}</a>' for k in range(n)]
        if self.r.random() < 0.7:
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return self.r.choice([" | ", " ", " &middot; "]).join(items)

    def paragraph(self, mark: bool, low: int = 8, high: int = 90) -> str:
        body = self.text(low, high, mark)
        if self.r.random() < 0.2:
            cut = body.split(" ")
            k = self.r.randrange(len(cut))
            tag = self.r.choice(["a href='#x'", "b", "em", "span", "strong", "code"])
            cut[k] = f"<{tag}>{cut[k]}</{tag.split(' ')[0]}>"
            body = " ".join(cut)
        if self.r.random() < 0.12:
            return f"<p><b>{body}<br>"
        return f"<p>{body}</p>" if self.r.random() < 0.93 else f"<div>{body}</div>"

    def advert(self) -> str:
        return self.wrap(self.r.choice(_ADS), self.r.choice([self.text(3, 30, False), self.paragraph(False, 4, 30), self.links(2)]))

    def form(self) -> str:
        return f"<form action='/s'><label>{self.text(1, 5, False)}</label><input name='q'><p>{self.text(3, 20, False)}</p><button>{self.word()}</button></form>"

    def comments(self) -> str:
        each = lambda: self.r.choice(["<li><b>{}</b><p>{}</p></li>", "<div><span>{}</span><p>{}</p></div>", "<div class='comment'><h4>{}</h4><p>{}</p></div>", "<article class='comment'><p>{}</p><p>{}</p></article>"])
        one = each()
        inner = f"<h3>{self.text(1, 3, False)}</h3>" * (self.r.random() < 0.6)
        return self.wrap(self.r.choice(_TALK), inner + "".join(one.format(self.text(1, 3, False, True), self.text(3, 60, False)) for _ in range(self.r.randint(1, 6))))

    def bar(self) -> str:
        inner = f"<h3>{self.text(1, 4, False)}</h3>" + self.r.choice([self.links(self.r.randint(2, 8)), self.paragraph(False, 4, 40) + self.links(2), self.paragraph(False, 5, 50), self.form()])
        return self.wrap(self.r.choice(_BARS), inner)

    def article(self) -> str:
        out = []
        if self.r.random() < 0.85:
            title = f"<h1>{self.text(2, 14, True, self.r.random() < 0.5)}</h1>"
            out.append(f"<header>{title}</header>" if self.r.random() < 0.15 else title)
        for _ in range(self.r.choice([0, 1, 1, 2, 3, 4, 6, 9, 14, 25])):
            kind = self.r.random()
            if kind < 0.78:
                out.append(self.paragraph(True, *self.r.choice([(1, 5), (5, 20), (10, 60), (40, 150)])))
            elif kind < 0.86:
                out.append(f"<h2>{self.text(1, 7, True, True)}</h2>")
            elif kind < 0.91:
                out.append("<ul>" + "".join(f"<li>{self.text(2, 20, True)}</li>" for _ in range(self.r.randint(2, 5))) + "</ul>")
            elif kind < 0.94:
                out.append(f"<blockquote><p>{self.text(5, 40, True)}</p></blockquote>")
            elif kind < 0.96:
                out.append("<table>" + "".join(f"<tr><td>{self.text(1, 4, True)}</td><td>{self.text(1, 4, True)}</td></tr>" for _ in range(3)) + "</table>")
            else:
                out.append(f"<pre>{self.text(5, 30, True)}</pre>")
            if self.r.random() < 0.1:
                out.append(self.r.choice([self.advert, self.bar, self.form])())
        if len(out) < 2:
            out.append(self.paragraph(True))
        if self.r.random() < 0.25:
            out.append(self.wrap(self.r.choice(_SHARE), self.links(3)))
        if self.r.random() < 0.15:
            out.append(self.comments())
        return self.wrap(self.r.choice(_HOLDERS), "".join(out))

    def page(self) -> str:
        gap, some = self.r.choice(["", "", "\n", "\n  "]), lambda p: self.r.random() < p
        parts = []
        if some(0.35):
            parts.append(self.wrap(self.r.choice(_NOTES), self.text(5, 40, False) + self.links(1) * some(0.5)))
        if some(0.4):
            parts.append(self.wrap(self.r.choice(_HEADS), f"<h{self.r.randint(1, 2)}>{self.text(1, 4, False, True)}</h1>" + f"<p>{self.text(3, 10, False)}</p>" * some(0.5)))
        if some(0.85):
            parts.append(self.wrap(self.r.choice(_MENUS), self.links(self.r.randint(2, 10))))
        if some(0.5):
            parts.append(self.advert())
        if some(0.25):
            parts.append(self.bar())
        if some(0.15):
            parts.append(self.form())
        parts.append(self.article())
        if some(0.3):
            parts.append(self.comments())
        if some(0.35):
            parts.append(self.bar())
        if some(0.25):
            parts.append(self.advert())
        if some(0.15):
            parts.append(self.form())
        if some(0.9):
            parts.append(self.wrap(self.r.choice(_FEET), self.r.choice([f"&copy; {self.text(2, 15, False)}", self.paragraph(False, 3, 30), self.links(4) + self.text(2, 9, False)])))
        body = gap.join(parts)
        if some(0.25):
            body = self.wrap(self.r.choice(["div.wrapper", "div#page", "div.container>div.row", "div"]), body)
        end = "</body></html>" * some(0.9)
        return f"<!DOCTYPE html><html><head><title>{self.text(2, 8, False)}</title></head><body>{body}{end}"


def pages(n: int, seed: int = 3) -> list[str]:
    return [_Writer(seed * 1_000_003 + k).page() for k in range(n)]
