"""Small labelled pages, made from layouts: which elements of common page designs hold the main text."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import cycle

from cellmart.llm.html_tree import parse

# fixed values: words that pages give elements around the main text, and elements that hold it
AROUND = (
    "nav navbar navigation menu submenu header masthead topbar banner footer bottom sidebar aside rail widget ad ads advert"
    " advertisement sponsor sponsored promo promotion notice cookie consent gdpr alert popup modal overlay dialog comment"
    " comments reply replies respond discussion disqus share sharing social follow related recommended recommendations more"
    " breadcrumb breadcrumbs pagination pager newsletter subscribe subscription signup login register search form feedback tags"
    " toolbar copyright legal disclaimer skip hidden rating poll survey trending popular archive teaser carousel"
).split()
MAIN = "article main content post entry story body text page blog news prose richtext markdown document".split()
_TAGS = ("div", "section", "div", "ul", "span", "aside")
_SENTENCE = "Here the writer tells at some length what happened, why it matters and what may come of it. "
_SHORT = ("Home", "Read more", "Sign in now", "We use cookies to improve this site.", "All rights reserved 2020")
# elements that are not main text whatever their class, each shown so often
_PLAIN, _OFTEN = ("nav", "aside", "footer", "header", "form"), 5
_KINDS = 6


def _around(word: str, tag: str, k: int) -> str:
    """An element that is not main text: links, short texts, or prose and headings that are not the article's."""
    items = "".join(f'<li><a href="/{i}">{_SHORT[i]}</a></li>' for i in range(3 + k % 3))
    short = _SHORT[k // _KINDS % len(_SHORT)]
    inner = (
        f"<ul>{items}</ul>",
        short,
        f"<p>{_SENTENCE * (1 + k % 4)}</p><p>{short}</p>",
        f"<h3>{short}</h3><p>{_SENTENCE * (1 + k % 3)}</p><div><p>{_SENTENCE}</p><p>{_SENTENCE * 2}</p></div>",
        f"<h2>{short}</h2><ul>{items}</ul>",
        f"<h2>{short}</h2><p>{short}</p><div>{_SENTENCE * (1 + k % 2)}</div>",
    )[k % _KINDS]
    return f'<{tag} class="{word}">{inner}</{tag}>' if word else f"<{tag}>{inner}</{tag}>"


def _article(k: int) -> str:
    """Headings, paragraphs of several lengths, a list, a quotation and a table, as articles have them."""
    paragraphs = "".join(f"<p>{_SENTENCE * (1 + (k + i) % 5)}</p>" for i in range(4))
    extras = (
        f"<ul><li>{_SENTENCE}</li><li>{_SENTENCE}</li></ul>",
        f"<blockquote><p>{_SENTENCE}</p></blockquote>",
        "<h2>What came next</h2><p>Nothing.</p>",
        f"<table><tr><th>Year</th><td>{_SENTENCE}</td></tr></table>",
        f"<figure><figcaption>{_SENTENCE}</figcaption></figure>",
        f"<ol><li>{_SENTENCE}</li></ol><pre>one line of code</pre>",
        "<ul><li>One</li><li>Two words</li><li>Three, or some more.</li></ul>",
        f"<dl><dt>Term</dt><dd>{_SENTENCE}</dd></dl><h3>Then</h3>",
    )
    return f"<h1>A title of some words</h1>{paragraphs}{extras[k % len(extras)]}<p><b>{_SENTENCE}</b> Yes.</p>"


def labelled_pages() -> Iterator[tuple[str, list[int]]]:
    """Pages with a label for each element of their tree: 1 if its text is main text.

    Every word stands around an article, before, after or inside it; every main word or element holds one. The label is carried by a word
    that is taken out again before the page is used.
    """
    tags, holders = cycle(_TAGS), cycle(["article", "main", *MAIN])
    shown = [(word, next(tags), i * _KINDS + kind) for i, word in enumerate(AROUND) for kind in range(_KINDS)]
    shown += [("", tag, i * _KINDS + kind) for i in range(_OFTEN) for tag in _PLAIN for kind in range(_KINDS)]
    for number, (word, tag, k) in enumerate(shown):
        holder, nested = next(holders), (number + number // _KINDS) % 2
        other = f'<div class="other-mark">{_around(word, tag, k)}</div>'
        start = f"<{holder}>" if holder in ("article", "main") and k % 2 else f'<div class="{holder}">'
        inside = other if nested else ""
        end = f"</{holder}>" if start == f"<{holder}>" else "</div>"
        article = f'<div class="main-mark">{start}{_article(k)}{inside}{end}</div>'
        before = f"<nav>{_around('menu', 'ul', 0)}</nav><header><a href='/'>Site</a></header>"
        after = f"<aside>{_around('', 'div', k)}</aside><form><p>Your name</p></form><footer><p>{_SHORT[4]}</p></footer>"
        page = f"<html><body><div>{before}{'' if nested else other}{article}{after}</div></body></html>"
        tree = parse(page)
        labels = [0]
        for node in tree.nodes[1:]:
            labels.append(1 if node.words[:2] == ("main", "mark") else 0 if node.words[:2] == ("other", "mark") else labels[node.parent])
        yield _unmarked(page), _kept(tree, labels)


def _unmarked(page: str) -> str:
    return page.replace(' class="other-mark"', "").replace(' class="main-mark"', "")


def _kept(tree, labels: list[int]) -> list[int]:
    """Labels of the page without marks: a wrapper around the main text is as little main text as what holds it."""
    return [0 if node.words[:2] == ("main", "mark") else label for node, label in zip(tree.nodes, labels, strict=True)]
