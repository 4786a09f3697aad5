"""Labelled pages to train the extraction on, made from a seed.

The attribute data-gold="1" marks an element whose text belongs to the
article, "0" one whose text does not; both hold down to the next mark.
"""

from __future__ import annotations

import random

# Words that sites use in class and id attributes, by the part they name.
PARTS = {
    "menu": "nav navbar navigation menu topnav breadcrumb breadcrumbs tabs pagination pager links toolbar".split(),
    "header": "header masthead top siteheader banner logo brand branding hero topbar".split(),
    "footer": "footer bottom copyright colophon legal credits sitefooter".split(),
    "sidebar": "sidebar side aside widget rail related recommended trending popular more secondary tags archive".split(),
    "ad": "ad ads advert advertisement adsense sponsor sponsored promo promotion banner dfp commercial".split(),
    "notice": "cookie cookies consent gdpr notice alert popup modal newsletter subscribe paywall overlay warning message".split(),
    "comments": "comments comment disqus respond replies reply discussion commentlist thread".split(),
    "share": "share sharing social follow tools buttons".split(),
    "form": "form search searchbox login signup contact feedback".split(),
}
CONTENT = "content article post entry body story text main articlebody postcontent entrycontent page copy prose".split()
WRAPPER = "wrapper container page site wrap outer inner layout row col grid app root".split()
SYLLABLES = "ka lo mi tra ven dor su pel qui na esh or tin ba rel mo chu fen ist al".split()


def _words(rng: random.Random, least: int, most: int) -> str:
    out = ["".join(rng.choices(SYLLABLES, k=rng.randint(1, 4))) for _ in range(rng.randint(least, most))]
    for k in range(len(out)):
        if rng.random() < 0.08:
            out[k] += ","
    return " ".join(out)


def _sentence(rng: random.Random, least: int = 4, most: int = 22) -> str:
    return _words(rng, least, most).capitalize() + rng.choice(["."] * 6 + ["?", "!", ""])


def _paragraph(rng: random.Random) -> str:
    text = " ".join(_sentence(rng) for _ in range(rng.choice((1, 1, 2, 3, 5, 8))))
    if rng.random() < 0.15:
        text = _sentence(rng, 1, 3)
    if rng.random() < 0.2:
        text += f" <{(t := rng.choice(('b', 'i', 'em', 'strong', 'span')))}>{_words(rng, 1, 4)}</{t}> {_sentence(rng)}"
    if rng.random() < 0.2:
        text += f' <a href="/{rng.random()}">{_words(rng, 1, 4)}</a> {_sentence(rng)}'
    if rng.random() < 0.1:
        text = "<b>" + text + "<br>"  # left open
    return text


def _attribute(rng: random.Random, words: list[str], always: bool = False) -> str:
    if not always and rng.random() < 0.3:
        return ""
    name = "-".join(rng.sample(words, 1)) + rng.choice(("", "", "-block", "-box", "1", "-item"))
    return f' {rng.choice(("class", "class", "id"))}="{name}"'


def _links(rng: random.Random) -> str:
    item = lambda: f'<a href="/{rng.random()}">{_words(rng, 1, 3)}</a>'
    many = rng.randint(2, 9)
    if rng.random() < 0.7:
        return "<ul>" + "".join(f"<li>{item()}</li>" for _ in range(many)) + "</ul>"
    return rng.choice((" | ", " ", "")).join(item() for _ in range(many))


def _part(rng: random.Random, part: str) -> str:
    tags = {
        "menu": ("nav", "div", "ul", "section"), "header": ("header", "div"), "footer": ("footer", "div"),
        "sidebar": ("aside", "div", "section"), "ad": ("div", "div", "aside", "ins", "section", "p"),
        "notice": ("div", "section", "aside", "dialog"), "comments": ("section", "div", "ol"),
        "share": ("div", "ul"), "form": ("form", "form", "div"),
    }[part]
    tag = rng.choice(tags)
    own = tag in ("nav", "header", "footer", "aside", "form", "ins", "dialog")
    if part in ("menu", "share"):
        body = _links(rng)
    elif part == "header":
        body = rng.choice((f"<h1>{_words(rng, 1, 4)}</h1>", f"<span>{_words(rng, 1, 3)}</span>", "")) + rng.choice((_links(rng), f"<p>{_sentence(rng)}</p>"))
    elif part == "footer":
        body = rng.choice((f"&copy; {_words(rng, 1, 3)} &middot; {_sentence(rng)}", f"<p>&copy; 2024 {_words(rng, 1, 4)}</p>", _links(rng) + _sentence(rng)))
    elif part == "sidebar":
        body = f"<h3>{_words(rng, 1, 4)}</h3>" + rng.choice((_links(rng), f"<p>{_sentence(rng)}</p>", f"<p>{_paragraph(rng)}</p>"))
    elif part in ("ad", "notice"):
        body = rng.choice((_sentence(rng), f"<p>{_paragraph(rng)}</p>", f'<a href="/x">{_sentence(rng)}</a>', f"<p>{_sentence(rng)}</p><button>{_words(rng, 1, 2)}</button>"))
    elif part == "comments":
        item = lambda: f'<div{_attribute(rng, PARTS["comments"])}><b>{_words(rng, 1, 2)}</b><p>{_paragraph(rng)}</p></div>'
        body = f"<h3>{_words(rng, 1, 3)}</h3>" + "".join(item() for _ in range(rng.randint(1, 5)))
    else:
        body = f'<label>{_words(rng, 1, 3)}</label><input type="text"><select><option>{_words(rng, 1, 2)}<option>{_words(rng, 1, 2)}</select><textarea>{_sentence(rng)}</textarea><button>{_words(rng, 1, 2)}</button>'
    return f'<{tag}{_attribute(rng, PARTS[part], not own)} data-gold="0">{body}</{tag}>'


def _article(rng: random.Random) -> str:
    tag = rng.choice(("article", "article", "main", "div", "section"))
    out = [f"<h1>{_words(rng, 3, 10)}</h1>"] if rng.random() < 0.75 else []
    for _ in range(rng.choice((1, 2, 3, 5, 8, 12))):
        kind = rng.random()
        if kind < 0.72:
            out.append(f"<p>{_paragraph(rng)}" + ("</p>" if rng.random() < 0.8 else ""))
        elif kind < 0.8:
            out.append(f"<h2>{_words(rng, 1, 7)}</h2>")
        elif kind < 0.86:
            out.append("<ul>" + "".join(f"<li>{_sentence(rng)}</li>" for _ in range(rng.randint(2, 5))) + "</ul>")
        elif kind < 0.89:
            out.append(f"<blockquote><p>{_paragraph(rng)}</p></blockquote>")
        elif kind < 0.92:
            out.append(f"<table><tr><td>{_words(rng, 1, 3)}<td>{_words(rng, 1, 3)}<tr><td>{_words(rng, 1, 3)}<td>{_words(rng, 1, 3)}</table>")
        elif kind < 0.94:
            out.append(f"<pre><code>{_words(rng, 2, 9)}</code></pre>")
        else:
            out.append(_part(rng, rng.choice(("ad", "share", "sidebar", "form", "notice"))))
    body = "".join(out)
    if rng.random() < 0.3:
        body = f"<div{_attribute(rng, CONTENT)}>{body}</div>"
    named = tag in ("article", "main")
    return f'<{tag}{_attribute(rng, CONTENT, not named)} data-gold="1">{body}</{tag}>'


def page(seed: int) -> str:
    """One labelled page."""
    rng = random.Random(seed)
    before = [p for p in ("notice", "header", "menu", "ad", "share", "form") if rng.random() < 0.45]
    after = [p for p in ("share", "ad", "sidebar", "comments", "form", "menu", "footer", "notice") if rng.random() < 0.4]
    body = "".join(_part(rng, p) for p in before) + "<!-- x -->" + _article(rng) + "".join(_part(rng, p) for p in after)
    for _ in range(rng.choice((0, 0, 1, 2))):
        body = f"<div{_attribute(rng, WRAPPER, True)}>{body}</div>"
    head = f'<head><meta charset="utf-8"><title>{_words(rng, 2, 8)}</title><style>p{{margin:0}}</style><script>var a="</p>";</script></head>'
    return f'<!DOCTYPE html><html data-gold="0">{head}<body>{body}</body></html>'


def pages(count: int) -> list[str]:
    return [page(seed) for seed in range(count)]
