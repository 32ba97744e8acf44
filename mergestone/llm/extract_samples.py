"""Labelled pages that train the block classifier: layouts written by rule, text that carries no meaning.

Each layout holds {h}, {p0}..{p5} (content) and {b0}..{b9} (boilerplate).
"""

from __future__ import annotations

_WORDS = "river stone window carries slow amber under the and of a with every winter letter house walks again toward open field".split()
#: Layouts; in each, braces h and p mark content, braces b boilerplate.
LAYOUTS = [
    "<body><nav><ul><li><a>{b0}</a></li><li><a>{b1}</a></li></ul></nav><div class='ad'>{b8}</div><article><h1>{h}</h1><p>{p0}</p><p>{p1}<p><b>{p2}<br><p>{p3}</p></article><footer>{b9}</footer></body>",
    "<body><header><a>{b0}</a><p>{b8}</p></header><main><h1>{h}</h1><p>{p0}</p><ul><li>{p1}</li><li>{p2}</li></ul><p>{p3}</p></main><aside><h3>{b1}</h3><p>{b9}</p></aside></body>",
    "<body><div class='menu'><a>{b0}</a> <a>{b1}</a></div><div class='content'><h2>{h}</h2><p>{p0}</p><p>{p1}</p></div><div class='sidebar'><p>{b8}</p></div><div id='footer'>{b9}</div></body>",
    "<body><article><header><h1>{h}</h1></header><p>{p0}</p><div class='ad'><p>{b8}</p></div><p>{p1}</p><aside><p>{b9}</p></aside><pre>{p2}</pre><form><p>{b2}</p></form><section id='comments'><h3>{b1}</h3><p>{b7}</p><p>{b6}</p></section></article></body>",
    "<body><div class='cookie-notice'><p>{b8}</p></div><div><h1>{h}</h1><p>{p0}</p><p>{p1}</p><blockquote>{p2}</blockquote><p>{p3}</p></div><div class='comments'><p>{b9}</p><p>{b7}</p></div><footer><p>{b6}</p></footer></body>",
    "<body><article><h1>{h}</h1><p>{p0}</p><h2>{p5}</h2><p>{p1}</p><table><tr><td>{p2}</td><td>{p5}</td></tr></table></article><nav><a>{b0}</a><a>{b1}</a></nav><form>{b2}<button>{b3}</button></form></body>",
    "<body><ul><li><a>{b0}</a></li><li><a>{b1}</a></li><li><a>{b3}</a></li></ul><p>{p0}</p><p>{p1}</p><p>{p2}</p><div>{b4}</div></body>",
    "<body><article><p>{p0}</p><p class='advert'>{b8}</p><p>{p4}</p><ul><li>{p1}</li><li>{p5}</li></ul><div class='related'><a>{b0}</a></div><footer><p>{b9}</p></footer></article><aside class='widget'><p>{b7}</p></aside></body>",
    "<body><nav><p>{b8}</p><span>{b0}</span></nav><article><h1>{h}</h1><p>{p0}</p><nav><p>{b9}</p></nav><p>{p1}</p><form><p>{b7}</p><label>{b2}</label></form><p>{p2}</p><footer>{b6}</footer></article></body>",
    "<body><header><p>{b8}</p></header><form><p>{b9}</p></form><main><article><div class='entry-header'><h1>{h}</h1></div><p>{p0}</p><figure><figcaption>{p5}</figcaption></figure><p>{p1}</p></article><section class='comment-list'><article><p>{b7}</p></article></section></main><nav><ul><li>{b6}</li><li>{b1}</li></ul></nav></body>",
    "<body><div id='page'><div class='nav-menu'><ul><li><a>{b0}</a></li><li><a>{b1}</a></li></ul></div><div id='main'><h1>{h}</h1><h2>{p5}</h2><p>{p0}</p><ol><li>{p1}</li><li>{p4}</li></ol><p>{p2}</p></div><div>{b4}</div><div class='newsletter'><p>{b8}</p><input><button>{b3}</button></div></div></body>",
    "<body><main><section><h2>{h}</h2><p>{p0}</p></section><section><h3>{p5}</h3><p>{p1}</p><pre>{p4}</pre></section><section class='related'><h3>{b1}</h3><p>{b6}</p></section></main><footer><p>{b9}</p><a>{b0}</a></footer></body>",
    "<body><div class='popup' role='dialog'><p>{b8}</p><button>{b2}</button></div><div class='post'><div class='post-header'><h1>{h}</h1></div><div class='post-body'><p>{p0}</p><blockquote><p>{p1}</p></blockquote><dl><dt>{p5}</dt><dd>{p2}</dd></dl></div><div class='share'><a>{b0}</a><a>{b1}</a></div></div><div id='disqus'><p>{b7}</p></div></body>",
    "<body><table><tr><td><a>{b0}</a></td><td><a>{b1}</a></td></tr></table><div class='story'><h1>{h}</h1><table><tr><th>{p5}</th></tr><tr><td>{p0}</td><td>{p4}</td></tr></table><p>{p1}</p></div><div>{b5}</div><div class='copyright'>{b9}</div></body>",
    "<body><aside role='complementary'><p>{b8}</p><p>{b6}</p></aside><article><p>{p0}</p><div><p>{p1}</p><div><p>{p2}</p></div></div><p>{p4}</p><figure><img><figcaption>{p5}</figcaption></figure></article><section id='responses'><p>{b7}</p><form><textarea>{b2}</textarea></form></section></body>",
    "<body><div role='navigation'><a>{b0}</a><a>{b1}</a><a>{b3}</a></div><div role='main'><h1>{h}</h1><p>{p0}</p><p>{p1}</p><p>{p2}</p><ul><li>{p3}</li></ul></div><div role='contentinfo'><p>{b9}</p></div></body>",
    "<body><header class='masthead'><h1>{b1}</h1><p>{b8}</p></header><article><h2>{h}</h2><p>{p0}</p><p>{p5}</p><p class='sponsored'>{b6}</p><p>{p1}</p></article><div class='pagination'><a>{b0}</a> <a>{b2}</a></div><div class='gdpr'>{b9}</div></body>",
    "<body><h1>{h}</h1><p>{p0}</p><p>{p1}</p><h2>{p5}</h2><p>{p2}</p><p>{p4}</p><div class='signup'><p>{b8}</p></div><div>{b4}</div><nav>{b0} {b1}</nav><footer>{b9}</footer></body>",
]


def _line(seed: int, words: int, end: str) -> str:
    return " ".join(_WORDS[(seed * 7 + i * i + i * seed) % len(_WORDS)] for i in range(words)).capitalize() + f" {seed}{end}"


def labelled_blocks() -> list[tuple[str, set[str]]]:
    """(page, its content blocks): each layout with lines of several lengths."""
    out = []
    for number, layout in enumerate(LAYOUTS):
        for size in (1, 2, 4):
            seed = 100 * number + 10 * size
            lines = {"h": _line(seed, 2 + size, "")}
            lines |= {f"p{i}": _line(seed + 1000 * (i + 1), 4 * size * (i % 3 + 1) if i < 4 else 2, "." if i < 5 else "") for i in range(6)}
            lines |= {f"b{i}": _line(seed + 10_000 * (i + 1), 1 + i % 3 if i < 6 else 5 * size, "." if i >= 6 else "") for i in range(10)}
            out.append((layout.format(**lines), {v for k, v in lines.items() if k[0] != "b"}))
    return out
