import random

from tripfold.llm.html_extract import extract_pages, main_text

LONG = "A paragraph of some length, with commas, that says a thing or two about the matter at hand."
ARTICLE = f"<h1>Title &amp; more</h1><p>{LONG}</p><p>Short.</p><p>{LONG}</p>"
WANTED = f"Title & more\n\n{LONG}\n\nShort.\n\n{LONG}"
AROUND = (
    "<header>Site <a href=1>home</a></header><nav><ul><li><a href=1>a</a><li><a href=2>b</a></ul></nav>",
    f"<div id='cookieBanner'><p>{LONG}</p></div><div class='side-bar sidebar'><p>{LONG}</p></div><aside>{LONG}</aside>"
    f"<div class='ad-slot'>{LONG}</div><section id='comments'><p>{LONG}</p><p>{LONG}</p></section><form>{LONG}<input></form>"
    "<script>var a = '<p>no</p>';</script><style>p{}</style><footer>&copy; us</footer>",
)


def page(body):
    return f"<!DOCTYPE html><html><head><title>t</title><style>x</style></head><body>{AROUND[0]}{body}{AROUND[1]}</body></html>"


def test_containers():
    assert main_text(page(f"<article>{ARTICLE}</article>")) == WANTED
    assert main_text(page(f"<div class=wrap><div class=content>{ARTICLE}</div></div>")) == WANTED
    assert main_text(page(f"<main><div>{ARTICLE}</div></main>")) == WANTED
    assert main_text(page(f"<table><tr><td>{ARTICLE}</table>")) == WANTED
    assert main_text(page(ARTICLE)) == WANTED


def test_parts_inside_the_article():
    inside = f"<div class=share><a href=1>tweet</a></div><ul><li>one<li>two <b>bold</b></ul><div class='related'><p>{LONG}</p></div><blockquote>quote</blockquote><pre>a\n  b</pre>"
    assert main_text(page(f"<article>{ARTICLE}{inside}</article>")) == WANTED + "\n\none\n\ntwo bold\n\nquote\n\na b"


def test_siblings_and_layout_words():
    two = f"<div id=a><p>{LONG}</p><p>{LONG}</p></div><div id=b><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></div><div id=c>Buy now</div>"
    assert main_text(f"<body class='has-sidebar no-comments'><div class=page>{two}</div></body>") == "\n\n".join([LONG] * 5)


def test_broken_markup_and_references():
    assert main_text("<p>a &lt;b&gt; &#233;&eacute; &amp &nbsp;x<p>c < d <br>e") == "a <b> éé & x\n\nc < d e"
    assert main_text("<article><p><b>bold<br><p>next</b></i></p>tail") == "bold\n\nnext\n\ntail"
    assert main_text("<article><p>cut off in a <a href='") == "cut off in a"
    assert main_text("") == main_text("<html><body><nav>x</nav></body></html>") == main_text("<!-- only -->") == ""
    assert main_text("plain text") == "plain text"
    assert main_text("<div>" * 30_000 + "deep") == "deep"


PARAGRAPHS = [f"<p>Paragraph {i} of the article, long enough to earn points, and so on.</p>" for i in range(12)]


def numbers(html):
    """Which of the paragraphs come out."""
    text = main_text(html)
    return [i for i in range(12) if f"Paragraph {i} of" in text]


def test_strong_containers_meet():
    three = "".join(f"<section><div>{PARAGRAPHS[2 * i]}{PARAGRAPHS[2 * i + 1]}</div></section>" for i in range(3))
    assert numbers(f"<body><div>{three}</div></body>") == list(range(6))
    assert numbers(f"<body><div class=post><section>{PARAGRAPHS[0]}{PARAGRAPHS[1]}</section><section>{PARAGRAPHS[2]}</section></div></body>") == [0, 1, 2]
    far = f"<div><div><p>{LONG}</p><p>{LONG}</p></div></div><div><p>{LONG}</p><p>{LONG}</p></div>"
    assert main_text(f"<body><nav>x</nav>{far}</body>").count(LONG) == 4  # they meet in nothing but the page


def test_names_do_not_empty_a_page():
    two = PARAGRAPHS[0] + PARAGRAPHS[1]
    comments = f"<div id=comments>{''.join(PARAGRAPHS[3:12])}</div>"  # more than the article
    assert numbers(f'<body><article class="post category-social">{two}</article>{comments}</body>') == [0, 1]
    assert numbers(f'<body><div id=content class="single comments-open">{two}{comments}</div></body>') == [0, 1]
    assert numbers(f"<body><div class=widget>{two}</div></body>") == [0, 1]  # nothing else is left


def test_asides_without_a_name():
    inside = f"{PARAGRAPHS[0]}{PARAGRAPHS[1]}<div>Buy <b>our</b> things now</div><div><p>Short.</p></div><section><ul><li>item</ul></section>"
    assert main_text(f"<body><main><h1>Title</h1>{inside}</main></body>").split("\n\n")[3:] == ["Short.", "item"]
    assert "Buy" not in main_text(f"<body><main><h1>Title</h1><div>{PARAGRAPHS[0]}{PARAGRAPHS[1]}</div><div>Buy now</div></main></body>")
    assert main_text(f"<body><article><div>{LONG}</div><div>Yes.</div><div>{LONG}</div></article></body>") == f"{LONG}\n\nYes.\n\n{LONG}"


def test_choice_equals_brute_force():
    """Random pages of nested containers, scored by walking up from every paragraph anew."""
    rng = random.Random(12)

    def grow(depth):
        return [grow(depth + 1) if depth < 4 and rng.random() < 0.55 else f"w{rng.randrange(10**9)} " + "word, " * rng.choice([1, 6, 20]) for _ in range(rng.randrange(1, 4))]

    def html(tree):
        return "<div>" + "".join(html(t) if isinstance(t, list) else f"<p>{t}</p>" for t in tree) + "</div>"

    def walk(tree, path):
        for k, t in enumerate(tree):
            yield from walk(t, [*path, k]) if isinstance(t, list) else [(tuple(path), k, t)]

    several = 0
    for _ in range(300):
        tree = grow(0)
        leaves = list(walk(tree, []))  # (container, place in it, text)
        points = {(c, k): 1 + t.count(",") + min(len(" ".join(t.split())) / 100, 3) if len(" ".join(t.split())) >= 25 else 0 for c, k, t in leaves}
        direct, score = {}, {}
        for (c, _), x in points.items():
            direct[c] = direct.get(c, 0) + x
            for level in range(min(5, len(c) + 1)):
                up = c[: len(c) - level]
                score[up] = score.get(up, 0) + x / (1, 2, 6, 9, 12)[level]
        if not any(points.values()):
            continue
        strong = [c for c, x in direct.items() if x >= 0.4 * max(direct.values())]
        top = min((c for c in score if score[c] == max(score.values())), key=lambda c: [*c, -1])
        holder = top
        for c in strong:
            while c[: len(holder)] != holder:
                holder = holder[:-1]
        wanted = max(1.0, 0.2 * max(score.values()))
        near = [c for c, x in score.items() if len(c) == len(holder) and c[:-1] == holder[:-1] and x >= wanted] if holder else []
        expected = []
        for c, k, t in leaves:
            inside = any(c[: len(h)] == h for h in [holder, *near])
            sibling = holder and c == holder[:-1]  # a paragraph beside the container
            if inside or sibling:
                expected.append(" ".join(t.split()))
        several += len(strong) > 1
        assert main_text(f"<body>{html(tree)}</body>") == "\n\n".join(expected), tree
    assert several > 30


def test_pages(spark):
    rows = [(1, "u", page(f"<article>{ARTICLE}</article>"), "x"), (2, None, None, "x"), (2, "u", "", "x"), (None, "u", "<p>é</p>", "x"), (4, "v", "<p>" + LONG * 20_000, "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    found = extract_pages(pages).collect()
    expected = [(1, "u", WANTED), (2, None, ""), (2, "u", ""), (None, "u", "é"), (4, "v", LONG * 20_000)]
    assert sorted(map(tuple, found), key=str) == sorted(((*r, len(r[2])) for r in expected), key=str)
    assert extract_pages(pages.limit(0)).count() == 0
