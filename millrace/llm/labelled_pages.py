"""Pages with their main text marked, from which the HTML extractor learns its weights.

Most pages are made by rule: layouts, lengths, nesting, markup and names are drawn at random, names from
those that pages commonly use for a role, and many elements have none. ``PAGES`` are a few written by hand. ``[[`` and ``]]`` mark
the main text; W stands for a word.
"""

from __future__ import annotations

import random

#: Names by role. Wrapper names stand around anything, so they prove nothing.
NAMES = {
    "wrapper": "site page wrapper container layout row col grid inner outer main content body list widget header section block box left right center item search related",
    "content": "post entry story article text content main body blog-post entry-content post-content article-body site-content page-content post-list",
    "nav": "nav navbar menu main-menu topnav navigation breadcrumb breadcrumbs site-nav toolbar tabs pagination",
    "header": "header masthead site-header branding logo topbar banner",
    "footer": "footer site-footer bottom copyright colophon legal",
    "side": "sidebar aside sidenav side widget-area rail secondary",
    "ad": "ad ads advert advertisement ad-slot sponsored sponsor sponsor-box promo promotion banner-ad",
    "notice": "notice cookie cookie-banner consent alert popup modal gdpr message",
    "share": "share social sharing share-buttons follow",
    "related": "related-posts recommended more-stories read-next teaser",
    "form": "search-form newsletter subscribe signup login contact-form",
    "comments": "comments comment comment-list discussion replies respond reader-comments",
}


class Maker:
    def __init__(self, seed: int):
        self.rng = random.Random(seed)

    def words(self, low: int, high: int) -> str:
        return " ".join(["W"] * self.rng.randint(low, high))

    def some(self, low: int, high: int, make) -> str:
        return "".join(make() for _ in range(self.rng.randint(low, high)))

    def named(self, role: str, odds: float = 0.5) -> str:
        if self.rng.random() > odds:
            return ""
        names = NAMES[role].split()
        picked = " ".join(self.rng.sample(names, self.rng.choice((1, 1, 2))))
        return f" {self.rng.choice(('class', 'class', 'id'))}='{picked}'"

    def link(self, low: int = 1, high: int = 3) -> str:
        return f"<a href='/'>{self.words(low, high)}</a>"

    def links(self) -> str:
        if self.rng.random() < 0.7:
            return "<ul>" + self.some(3, 8, lambda: f"<li>{self.link()}</li>") + "</ul>"
        return " ".join(self.link() for _ in range(self.rng.randint(2, 7)))

    # what is not main text

    def nav(self) -> str:
        if self.rng.random() < 0.6:
            return f"<nav{self.named('nav')}>{self.links()}</nav>"
        return f"<div{self.named('nav', 1)}>{self.links()}</div>"

    def header(self) -> str:
        tag, odds = self.rng.choice((("header", 0.5), ("header", 0.5), ("div", 1)))
        return f"<{tag}{self.named('header', odds)}>{self.link()}<p>{self.words(2, 8)}</p></{tag}>"

    def footer(self) -> str:
        tag, odds = self.rng.choice((("footer", 0.4), ("footer", 0.4), ("div", 1)))
        inner = self.rng.choice((self.words(3, 25), f"<p>{self.words(3, 20)}</p>{self.link()}", f"{self.links()}<p>{self.words(3, 12)}</p>"))
        return f"<{tag}{self.named('footer', odds)}>{inner}</{tag}>"

    def ad(self) -> str:
        inner = self.rng.choice((self.words(3, 25), self.words(3, 25), f"<p>{self.words(4, 14)}</p>", f"{self.words(3, 9)} {self.link()}"))
        return f"<div{self.named('ad', 1)}>{inner}</div>"

    def notice(self) -> str:
        return f"<div{self.named('notice', 1)}>{self.words(6, 20)}<button>{self.words(1, 2)}</button></div>"

    def side(self) -> str:
        tag, odds = self.rng.choice((("aside", 0.5), ("div", 1)))
        return f"<{tag}{self.named('side', odds)}><h3>{self.words(1, 3)}</h3>{self.links()}<p>{self.words(3, 15)}</p></{tag}>"

    def form(self) -> str:
        return f"<form{self.named('form')}><label>{self.words(1, 4)}</label><input name='q'><button>W</button></form>"

    def share(self) -> str:
        return f"<div{self.named('share', 1)}>{self.links()}</div>"

    def related(self) -> str:
        return f"<div{self.named('related', 1)}><h3>{self.words(1, 3)}</h3>{self.links()}</div>"

    def comments(self) -> str:
        one = lambda: f"<div{self.named('comments', 1)}><p>{self.words(5, 40)}</p></div>"
        return f"<section{self.named('comments', 1)}><h3>{self.words(1, 2)}</h3>{self.some(1, 4, one)}</section>"

    # main text

    def inline(self) -> str:
        tag = self.rng.choice(("b", "i", "em", "strong", "a href='/'", "code", "span"))
        return f"{self.words(2, 20)} <{tag}>{self.words(1, 4)}</{tag.split()[0]}> {self.words(2, 20)}"

    def part(self) -> str:
        kind = self.rng.choice(("p",) * 12 + ("inline",) * 3 + ("head", "list", "quote", "table", "pre", "figure", "short", "short", "open", "div"))
        make = {
            "p": lambda: f"<p>{self.words(8, 70)}</p>",
            "inline": lambda: f"<p>{self.inline()}</p>",
            "head": lambda: f"<h2>{self.words(1, 6)}</h2><p>{self.words(8, 40)}</p>",
            "list": lambda: f"<ul{self.named('wrapper', 0.2)}>" + self.some(2, 5, lambda: f"<li>{self.words(2, 15)}</li>") + "</ul>",
            "quote": lambda: f"<blockquote>{self.words(8, 30)}</blockquote>",
            "table": lambda: f"<table><tr><td>{self.words(1, 3)}</td><td>{self.words(1, 5)}</td></tr></table>",
            "pre": lambda: f"<pre>{self.words(5, 30)}</pre>",
            "figure": lambda: f"<figure><img src='x'><figcaption>{self.words(3, 9)}</figcaption></figure>",
            "short": lambda: f"<p>{self.words(1, 4)}</p>",
            "open": lambda: f"<p><b>{self.words(3, 50)}.<br><p>{self.words(5, 50)}</p>",
            "div": lambda: f"<div{self.named('wrapper', 0.5)}><p>{self.words(8, 50)}</p></div>",
        }
        return make[kind]()

    def content(self) -> str:
        head = f"<h1>{self.words(2, 14)}</h1>" if self.rng.random() < 0.85 else ""
        if head and self.rng.random() < 0.15:
            head = f"<header>{head}</header>"
        parts = [self.part() for _ in range(self.rng.choice((1, 2, 3, 4, 6, 9, 14)))]
        if len(parts) > 2 and self.rng.random() < 0.35:
            extra = self.rng.choice((self.ad, self.ad, self.share, self.form, self.related, self.notice))()
            parts.insert(self.rng.randrange(1, len(parts)), f"]]{extra}[[")
        tag, odds = self.rng.choice((("article", 0.4),) * 4 + (("main", 0.4), ("section", 0.7), ("div", 1), ("div", 1), ("td", 0)))
        inner = f"<{tag}{self.named('content', odds)}>[[{head}{''.join(parts)}]]</{tag}>"
        return f"<table><tr><td>{self.nav()}</td>{inner}</tr></table>" if tag == "td" else inner

    def wrapped(self, inner: str) -> str:
        for _ in range(self.rng.choice((0, 0, 0, 1, 2))):
            tag = self.rng.choice(("div", "div", "main", "section"))
            inner = f"<{tag}{self.named('wrapper')}>{inner}</{tag}>"
        return inner

    def page(self) -> str:
        pick = lambda odds, *makes: "".join(m() for m in makes if self.rng.random() < odds)
        before = pick(0.5, self.header, self.nav, self.nav, self.notice, self.ad, self.form, self.side)
        near = pick(0.3, self.ad, self.nav)
        after = pick(0.35, self.share, self.related, self.comments, self.ad, self.side, self.form) + pick(0.85, self.footer)
        return f"<html><head><title>{self.words(2, 9)}</title><style>W</style><script>W</script></head><body>{before}{self.wrapped(near + self.content() + (after if self.rng.random() < 0.3 else ''))}{after}</body></html>"


def pages(n: int, seed: int = 20240601) -> list[str]:
    maker = Maker(seed)
    return [maker.page() for _ in range(n)]


W5, W9, W30 = " ".join(["W"] * 5), " ".join(["W"] * 9), " ".join(["W"] * 30)
NAV = "<nav><ul>" + f"<li><a href='/'>{W5}</a></li>" * 4 + "</ul></nav>"
MENU = "<div class='menu navbar'><ul>" + "<li><a href='/'>W</a></li>" * 6 + "</ul></div>"
HEAD = f"<html><head><title>{W5}</title></head><body>"
FOOT = f"<footer><p>{W9}</p><a href='/'>W</a></footer></body></html>"
FOOT_DIV = f"<div id='footer' class='site-footer'>{W9} <a href='/'>W</a></div></body></html>"
AD = f"<div class='ad advert'>{W9}</div>"
P, H1, H2 = f"<p>{W30}</p>", f"<h1>{W5}</h1>", f"<h2>{W5}</h2>"
SIDE = f"<aside class='sidebar widget'><h3>W W</h3><ul><li><a href='/'>{W5}</a></li><li><a href='/'>{W5}</a></li></ul></aside>"
FORM = "<form class='search newsletter'><label>W W</label><input name='q'><button>W</button></form>"
COMMENTS = f"<div id='comments' class='comments comment-list'><h3>W W</h3><div class='comment'><p>{W30}</p></div><div class='comment'><p>{W9}</p></div></div>"
NOTICE = f"<div class='notice cookie banner'>{W9}<button>W</button></div>"
SHARE = "<div class='share social'><a href='/'>W</a><a href='/'>W</a></div>"
RELATED = f"<div class='related recommended'><h3>W W</h3><ul><li><a href='/'>{W9}</a></li><li><a href='/'>{W9}</a></li></ul></div>"
HEADER = f"<header class='header masthead'><a href='/'>W W</a><p>{W5}</p></header>"
CRUMBS = "<div class='breadcrumb breadcrumbs'><a href='/'>W</a> <a href='/'>W</a></div>"
PROMO = f"<div class='promo sponsored'>{W9}<a href='/'>{W5}</a></div>"

RICH = f"<h3>{W9}</h3><p>{W30} <a href='/'>{W9}</a> {W30} <a href='/'>{W9}</a></p><ol><li>{W30}</li><li>{W9} <a href='/'>{W5}</a></li></ol><label>{W5}</label>"

PAGES = [
    f"{HEAD}{HEADER}{NAV}{AD}<article>[[{H1}{P}{P}{P}]]</article>{FOOT}",
    f"{HEAD}{NAV}{NOTICE}<main><article>[[{H1}<p>{W30} <b>W W</b> {W9}</p>{P}]]{AD}[[{P}{H2}{P}]]</article>{COMMENTS}</main>{FOOT}",
    f"{HEAD}{MENU}{CRUMBS}<div id='content' class='post'>[[{H1}{P}<ul><li>{W9}</li><li>{W9}</li></ul>{P}]]{SHARE}</div>{SIDE}{COMMENTS}{FOOT_DIV}",
    f"{HEAD}{HEADER}{FORM}{MENU}<div class='entry-content'>[[{P}<blockquote>{W30}</blockquote>{P}<p>{W30} <a href='/'>W W</a> {W9}</p>]]</div>{RELATED}{PROMO}{FOOT_DIV}",
    f"{HEAD}<table><tr><td>{MENU}</td><td>[[{H1}{P}{P}<table><tr><td>W</td><td>{W5}</td></tr></table>]]</td></tr></table>{FOOT_DIV}",
    f"{HEAD}{NAV}<section>[[{H2}<p>{W30}<br>{W9}</p><p><i>{W9}</i> {W30}</p><pre>{W9}</pre>]]</section>{SIDE}{FORM}{FOOT}",
    f"{HEAD}{NAV}<div class='ad'>{W9} {W9}</div><article>[[{H1}<p><b>{W30}<br><p>{W30}</p>]]</article>{FOOT}",
    f"{HEAD}{NAV}<div class='main body'>[[{H1}{P}{RICH}{RICH}]]</div>{SIDE}{FOOT_DIV}",
    f"{HEAD}{MENU}<article class='story'>[[{H1}<div>{RICH}</div><div>{RICH}{RICH}</div>]]</article>{COMMENTS}{FOOT}",
    f"{HEAD}{HEADER}{NAV}<main>[[{H1}{P}<figure><figcaption>{W5}</figcaption></figure>{P}]]{PROMO}[[{P}]]{RELATED}{COMMENTS}</main>{FOOT}",
    f"{HEAD}<div id='page' class='site'>{HEADER}{NAV}<div class='site-content'><main class='site-main'><div class='post-list'>[[{H1}{P}<ul class='list'><li>{W9}</li><li>{W9}</li></ul>{P}]]</div></main></div>{FOOT_DIV}",
]
