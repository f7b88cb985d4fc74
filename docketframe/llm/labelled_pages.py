"""Labelled training pages for the content model.

Each shape is a page with marks: ``x=1`` opens main content, ``x=0`` something else inside it; unmarked parts are not
content. ``~n`` stands for up to n words, ``~n.`` for sentences, ``@kind`` for one of the names that pages use for such a
part. The words are random syllables, so only structure, names and lengths can be learned.
"""

from __future__ import annotations

import random
import re

#: Class and id names in common use.
NAMES = {
    "menu": "menu nav navbar navigation main-nav topnav site-nav breadcrumbs breadcrumb menu-item pagination pager toc-nav skip-link".split(),
    "head": "header site-header masthead topbar page-header branding logo hero-bar".split(),
    "foot": "footer site-footer page-footer colophon bottom copyright legal footer-links credits".split(),
    "side": "sidebar side aside widget widgets related related-posts recommended more-stories popular trending rail tags archive".split(),
    "note": "notice cookie cookie-banner cookies consent gdpr alert banner-notice modal popup overlay newsletter subscribe paywall".split(),
    "ad": "ad ads advert advertisement adsbygoogle sponsor sponsored promo promoted banner ad-slot advertising".split(),
    "form": "form search search-form login signup contact-form subscribe-form poll".split(),
    "talk": "comments comment comment-list comment-body replies reply discussion disqus responses reader-comments respond".split(),
    "share": "share social share-buttons social-links byline meta post-meta author-box".split(),
    "main": "content article post entry story main post-content entry-content article-body story-body body-text page-content text".split(),
    "wrap": "wrapper container page row col wrap inner layout outer grid site".split(),
}
_MENU = "<ul><li><a href=#>~2</a></li><li><a href=#>~2</a></li><li><a href=#>~1</a></li><li><a href=#>~3</a></li></ul>"
_LINKS = "<ul><li><a href=#>~6</a><li><a href=#>~7</a><li><a href=#>~5</a></ul>"
_COMMENTS = "<h3>~2</h3><div class=@talk><p>~12.</p></div><div class=@talk><p>~25.</p></div><article class=@talk><p>~18.</p></article>"
_FORM = "<label>~2</label><input><p>~6.</p><button>~1</button>"
_SHORT = "<p>~3.</p>"
_END = "<p>© 2020 ~2 · <a href=#>~1</a> <a href=#>~2</a></p>"
#: Shapes of whole pages.
SHAPES = (
    f"<body><nav>{_MENU}</nav><div class=@ad>~9.</div><article x=1><h1>~8</h1><p>~60.</p><p>~40.</p><p>~9.</p></article><footer>© ~2 · ~8.</footer>",
    f"<body><nav>{_MENU}</nav><div class=@ad>~12.</div><article x=1><h1>~9</h1><p>~5.</p></article><footer>© ~2 · ~8. ~6.</footer>",
    f"<body><header class=@head><a href=#>~2</a>{_MENU}</header><main x=1><h1>~7</h1><p>~50.</p><h2>~4</h2><p>~70.</p><ul><li>~9.<li>~12.</ul><p>~30.</p></main>"
    f"<aside class=@side><h3>~2</h3>{_LINKS}</aside><footer class=@foot>{_END}</footer>",
    f"<body><div class=@wrap><div class=@head>~3</div><div class=@menu>{_MENU}</div><div class=@main x=1><h1>~8</h1><p>~45.</p><blockquote><p>~20.</p></blockquote>"
    f"<div class=@ad x=0>~10.</div><p>~55.</p></div><div class=@side>{_LINKS}<p>~14.</p></div><div class=@talk>{_COMMENTS}</div><div class=@foot>{_END}</div></div>",
    f"<body><div class=@note><p>~22.</p><button>~1</button></div><nav class=@menu>{_MENU}</nav><article class=@main x=1><header><h1>~9</h1></header><p>~65.</p>"
    f"<figure><img><figcaption>~9.</figcaption></figure><p>~35.</p><div class=@share x=0>~3 <a href=#>~1</a></div><aside class=@side x=0><p>~15.</p></aside><p>~50.</p>"
    f"<footer x=0>~5</footer></article><section id=@talk>{_COMMENTS}</section><footer>{_END}</footer>",
    f"<body><div class=@wrap><div class=@wrap><section class=@main x=1><h2>~6</h2><p>~80.</p><p>~15.</p><p>~22.</p><table><tr><td>~3<td>~4<tr><td>~2<td>~5</table></section>"
    f"<section class=@talk>{_COMMENTS}</section></div><form class=@form>{_FORM}</form></div><div id=@foot>{_END}</div>",
    f"<body><table><tr><td>{_MENU}</td><td x=1><h1>~6</h1><p>~60.</p><p>~40.</p></td><td><p><a href=#>~5</a></p><p><a href=#>~4</a></p></td></tr></table><p>© ~3</p>",
    "<body x=1><h1>~6</h1><p>~40.</p><p>~25.</p><p>~60.</p><p>~6.</p>",
    f"<body><div id=@head>~2</div><div id=@main x=1><div><p>~50.</p></div><div><p>~30.</p><p>~12.</p></div></div><div class=@side><div><p>~10.</p></div><div><p>~18.</p></div>"
    f"</div><div class=@note>~25.</div><div id=@foot>~12.</div>",
    f"<body><header><h1>~3</h1><p>~6</p><nav>{_MENU}</nav></header><main><article x=1><h1>~7</h1><p>~70.</p><ol><li>~8.<li>~10.</ol><pre>~12</pre><p>~20.</p></article>"
    f"<section class=@side><h2>~2</h2>{_LINKS}</section><section class=@talk>{_COMMENTS}</section></main><aside>{_LINKS}<form class=@form>{_FORM}</form></aside><footer>{_END}</footer>",
    f"<body><div class=@ad>~15.</div><div class=@main x=1><p>~90.</p><div class=@ad x=0><p>~12.</p></div><p>~35.</p><form class=@form x=0>{_FORM}</form><p>~45.</p></div>"
    f"<div class=@note><p>~9.</p></div><div class=@talk><ul><li><p>~20.</p><li><p>~35.</p></ul></div>",
    f"<body><nav>{_MENU}</nav><div class=@wrap><article x=1><h1>~8</h1><p>~3.</p><p>~8.</p><p>~5.</p></article></div><div role=complementary>{_LINKS}</div>"
    f"<div role=contentinfo>{_END}</div><div role=dialog><p>~16.</p></div>",
    f"<body><nav>{_MENU}</nav><div class=@ad>~12.</div><article x=1><h1>~8</h1><p>~60</p>{_SHORT * 18}</article><footer>© ~2 · ~8.</footer>",
    f"<body><nav>{_MENU}</nav><div class=@ad>~12.</div><article x=1><h1>~8</h1>{_SHORT * 9}<p>~4</p><p>~9</p></article><footer>© ~2 · ~8.</footer>",
    f"<body><div class=@head>~3</div><div class=@main x=1><h1>~8</h1>{_SHORT * 12}<p>~30.</p>{_SHORT * 9}</div><div class=@talk>{_COMMENTS}{_SHORT * 8}</div>"
    f"<div class=@side>{_SHORT * 9}<p>~30.</p></div><div class=@foot>{_SHORT * 5}</div>",
    f"<body><header>{_MENU}</header><main x=1><p>~6</p><ul>{'<li>~4</li>' * 14}</ul><h2>~3</h2><table>{'<tr><td>~1<td>~2' * 12}</table></main>"
    f"<aside>{_SHORT * 14}</aside><section class=@talk>{'<article><p>~9.</p></article>' * 9}</section><footer>{_END}</footer>",
    f"<body><div class=@side><h3>~2</h3><p>~25.</p></div><div class=@main x=1><h2>~4</h2><div class=@main><p>~16.</p><div class=@ad x=0><p>~8.</p></div><p>~9.</p></div></div>"
    f"<form class=@form>{_FORM}</form>",
    f"<body><div class=@wrap><div class=@wrap><div class=@main x=1><h1>~5</h1><div class=@share x=0>~4</div><div class=@main><p>~12.</p><p>~7.</p></div></div></div>"
    f"<div class=@talk><h3>~2</h3><div class=@talk><p>~12.</p></div></div></div>",
    f"<body><div id=@note>~14. <a href=#>~2</a></div><div id=@main x=1><div class=@main><h1>~5</h1><p>~18.</p><ul><li>~4<li>~6</ul></div></div><div class=@ad><p>~14.</p></div>",
    "<body x=1><p>~12.</p><div>~20.</div>~9 <div><p>~14.</p></div>",
    "<body x=1><div>~9</div><div>~6.<p>~4</p></div>",
    f"<body><div role=banner>~3</div><div role=navigation>{_MENU}</div><div role=main x=1><h1>~5</h1>~30.<br>~25.<p>~15.</p></div><aside><p>~30.</p><p>~20.</p></aside>"
    f"<div class=@talk><p>~40.</p><p>~15.</p></div><footer><p>~20.</p></footer>",
)
#: Pages made of each shape.
COPIES = 12
_SYLLABLES = "ba ce di fo gu la me ni po ru sa te vi xo zu an el or us im".split()


def labelled_pages(seed: int = 7) -> list[str]:
    """The training pages, marks included."""
    rng = random.Random(seed)

    def words(match: re.Match) -> str:
        most, sentence = int(match[1]), bool(match[2])
        text = " ".join("".join(rng.choices(_SYLLABLES, k=rng.randint(1, 4))) for _ in range(rng.randint(max(1, most // 3), most)))
        return text.capitalize() + "." if sentence else text

    def name(match: re.Match) -> str:
        return rng.choice(NAMES[match[1]])

    return [re.sub(r"~(\d+)(\.?)", words, re.sub(r"@(\w+)", name, shape)) for shape in SHAPES for _ in range(COPIES)]
