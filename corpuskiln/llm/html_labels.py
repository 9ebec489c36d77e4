"""Labelled pages that the weights of the HTML extractor are learned from.

Each is a page of our own invention with its article marked.  What isn't the
article is drawn by kind: an element that says so by its tag, a class, an id or
a role, or a bare one that says nothing.  The words are made up.
"""

from __future__ import annotations

import random

#: Marks of the article inside a page.
OPEN, SHUT = "\x02", "\x03"

#: kind -> (tags of its own, words of classes and ids, roles)
KINDS = {
    "menu": (("nav", "menu"), "nav navbar navigation menu menus submenu breadcrumb breadcrumbs topbar toolbar pager pagination sidenav", "navigation menu menubar toolbar"),
    "header": (("header",), "header masthead banner topbar branding logo", "banner"),
    "footer": (("footer",), "footer foot bottombar copyright disclaimer legal imprint colophon", "contentinfo"),
    "sidebar": (("aside",), "sidebar rail aside widget widgets secondary", "complementary"),
    "notice": (("dialog",), "cookie cookies consent gdpr notice notices notification notifications alert popup modal overlay banner", "dialog alertdialog alert"),
    "advert": ((), "ad ads advert adverts advertisement advertisements adsense adslot adbox adsbygoogle sponsor sponsored sponsors promo promos promotion outbrain taboola", ""),
    "form": (("form",), "form search searchbox newsletter subscribe subscription signup login signin register", "search form"),
    "comments": ((), "comment comments commentlist respond reply replies disqus discussion", ""),
    "social": ((), "share sharing social related recommended recommendations trending", ""),
    "hidden": ((), "hidden", ""),
}
#: Kinds that also stand inside an article.
INSIDE = ("advert", "notice", "social", "form", "sidebar", "hidden", "footer")
CONTENT_WORDS = "article body content entry main post story text prose copy blog single lead intro title"
NEUTRAL_WORDS = "container row wrapper col inner outer wrap clearfix grid layout page site group primary section block box area item list"


def _page(seed: int) -> str:
    rng = random.Random(seed)
    some = rng.choice

    def words(low: int, high: int) -> str:
        return " ".join("".join(some("abdeginorstu") for _ in range(rng.randint(2, 9))) for _ in range(rng.randint(low, high)))

    def link() -> str:
        return f"<a href='/{words(1, 1)}'>{words(1, 3)}</a>"

    def name(*parts: str) -> str:
        value = some("-_ ").join(p for p in parts if p)
        return f" {some(('class', 'class', 'id'))}={some(QUOTES).format(value)}"

    def filler(kind: str) -> str:
        links = "".join(f"<li>{link()}</li>" for _ in range(rng.randint(2, 8)))
        if kind in ("menu", "social") or rng.random() < 0.25:
            return some((f"<ul>{links}</ul>", " ".join(link() for _ in range(rng.randint(2, 6)))))
        if kind == "comments":
            return "".join(f"<div><b>{words(1, 2)}</b><p>{words(4, 50)}</p></div>" for _ in range(rng.randint(1, 4)))
        if kind == "form":
            return f"<label>{words(1, 3)}</label><input name=q><button>{words(1, 2)}</button>" + some(("", f"<p>{words(3, 12)}</p>"))
        if kind == "sidebar":
            return f"<h3>{words(1, 3)}</h3><ul>{links}</ul><p>{words(2, 25)}</p>"
        return some((f"<p>{words(3, 30)}</p>", words(2, 25), f"{words(2, 12)} {link()}"))

    def boilerplate(kind: str) -> str:
        own, classes, roles = KINDS[kind]
        how = rng.random()
        generic = some(("div", "div", "section", "ul" if kind == "menu" else "div", "p" if kind in ("notice", "advert") else "div"))
        if kind == "hidden":
            attribute = some((" hidden", " aria-hidden='true'", " style='display:none'", " style=\"visibility: hidden\"", name("hidden")))
        elif roles and how < 0.15:
            attribute = f" role='{some(roles.split())}'"
        elif own and how < 0.5:
            tag = some(own)
            return f"<{tag}>{filler(kind)}</{tag}>"
        else:
            beside = some(("", "", some(CONTENT_WORDS.split()), some(NEUTRAL_WORDS.split())))
            attribute = name(*rng.sample([some(classes.split()), beside], 2))
            if own and rng.random() < 0.3:
                generic = own[0]
        # a paragraph ends at the first block inside it
        return f"<{generic}{attribute}>{words(3, 30) if generic == 'p' else filler(kind)}</{generic}>"

    def bare() -> str:
        """Links that nothing marks: only their tags tell."""
        return some((f"<ul>{''.join(f'<li>{link()}</li>' for _ in range(rng.randint(3, 9)))}</ul>", f"<p>{' | '.join(link() for _ in range(rng.randint(3, 7)))}</p>", f"<div>{link()} {link()} {link()}</div>"))

    def neutral(inside: str, content: bool) -> str:
        tag = some(("div", "section"))
        kind = CONTENT_WORDS if content and rng.random() < 0.5 else NEUTRAL_WORDS
        return f"<{tag}{name(some(kind.split()), some(('', some(NEUTRAL_WORDS.split()))))}>{inside}</{tag}>"

    def paragraph() -> str:
        how = rng.random()
        if how < 0.08:
            return f"<ul>{''.join(f'<li>{words(2, 12)}</li>' for _ in range(rng.randint(2, 5)))}</ul>"
        if how < 0.16:
            return f"<h2>{words(1, 6)}</h2><p>{words(2, 40)}</p>"
        if how < 0.2:
            return f"<blockquote><p>{words(3, 30)}</p></blockquote>"
        if how < 0.24:
            return f"<table><tr><td>{words(1, 5)}</td><td>{words(1, 5)}</td></tr></table>"
        if how < 0.28:
            return neutral(f"<p>{words(4, 40)}</p>", True)
        return f"<p{some(('', '', name(some(CONTENT_WORDS.split()))))}>{words(1, 50)} <b>{words(1, 2)}</b> {words(0, 20)}{some(('', '', ' ' + link()))} {words(1, 30)}.</p>"

    title = f"<h1{some(('', name('entry', 'title'), name('page', 'header')))}>{words(2, 8)}</h1>"
    around = rng.random()
    # outside an article a header is the page's
    if around < 0.55 and rng.random() < 0.4:
        title = f"<header{some(('', name('entry', 'header')))}>{title}</header>"
    parts = [title, *(paragraph() for _ in range(rng.randint(2, 8)))]
    for _ in range(rng.choice((0, 0, 1, 2, 3))):
        parts.insert(rng.randint(1, len(parts) - 1), SHUT + boilerplate(some(INSIDE)) + OPEN)
    article = OPEN + "".join(parts) + SHUT
    if around < 0.35:
        article = f"<article{some(('', name(some(CONTENT_WORDS.split()))))}>{article}</article>"
    elif around < 0.55:
        article = f"<main{some(('', ' role=main'))}>{article}</main>"
    elif around < 0.85:
        article = f"<div{name(some(CONTENT_WORDS.split()), some(('', some(CONTENT_WORDS.split()))))}>{article}</div>"
    before = [boilerplate(some(("menu", "menu", "menu", "header", "notice", "advert", "form", "social", "hidden"))) for _ in range(rng.randint(1, 4))]
    after = [boilerplate(some(("sidebar", "footer", "comments", "social", "advert", "form", "hidden"))) for _ in range(rng.randint(1, 4))]
    if rng.random() < 0.4:
        before.insert(rng.randint(0, len(before)), bare())
    if rng.random() < 0.4:
        after.insert(rng.randint(0, len(after)), bare())
    inside = "".join([*before, article, *after])
    for _ in range(rng.choice((0, 0, 1, 2))):
        inside = neutral(inside, False)
    return f"<html><head><title>{words(1, 4)}</title><style>a{{b:c}}</style></head><body{some(('', name('with', 'sidebar')))}>{inside}</body></html>"


QUOTES = ("'{}'", '"{}"')


def labelled_pages(n: int = 600, first: int = 0) -> list[str]:
    """Pages with their articles between OPEN and SHUT."""
    return [_page(first + k) for k in range(n)]


def without_marks(page: str) -> str:
    return page.replace(OPEN, "").replace(SHUT, "")
