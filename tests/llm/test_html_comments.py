"""Pages with long comments, hidden parts, teasers and open comments."""

from __future__ import annotations

import pytest

from annolytics.llm.html_text import main_text, page_parts

ARTICLE = [f"This is paragraph {i} of the article, with a clause, and enough words to count as running text." for i in range(4)]
COMMENT = "I do not agree with this at all, and, as a reader, I would like to say so at some length here today."
PARAGRAPHS = "".join(f"<p>{p}</p>" for p in ARTICLE)
WANT = " ".join(["A heading", *ARTICLE])


def comments(tag: str = "div", name: str = 'class="comments"', item: str = "div") -> str:
    return f"<{tag} {name}>" + "".join(f"<{item}><p>{i}: {COMMENT}</p></{item}>" for i in range(30)) + f"</{tag}>"


@pytest.mark.parametrize("name", ['class="comments"', 'id="respond"', 'class="discussion-thread"', 'class="post-replies"', 'id="disqus_thread"'])
@pytest.mark.parametrize("inside", [True, False])
@pytest.mark.parametrize("item", ["div", "article", 'article class="comment"'])
def test_comments_of_any_length_go(name, inside, item):
    block = comments(name=name, item=item.split()[0]) if item != 'article class="comment"' else comments(name=name, item="article").replace("<article>", '<article class="comment">')
    body = f"<article><h1>A heading</h1>{PARAGRAPHS}{block if inside else ''}</article>{'' if inside else block}"
    assert main_text(f"<html><body><nav>Home</nav>{body}</body></html>") == WANT


def test_comments_beside_an_article_without_its_element():
    assert main_text(f"<body><div class='post'><h1>A heading</h1>{PARAGRAPHS}</div>{comments('section')}</body>") == WANT


def test_names_of_a_page_are_no_comments():
    for name in ("no-comments", "has-comments", "comments-closed"):
        assert main_text(f"<body><div class='{name}'><h1>A heading</h1>{PARAGRAPHS}</div></body>") == WANT
    assert main_text(f"<body><div class='comments'>{PARAGRAPHS}</div></body>") == " ".join(ARTICLE)
    assert main_text(f"<body class='comments'><article><h1>A heading</h1>{PARAGRAPHS}<p>On <span class='comment'>comments</span> and other things that people have said, by and large.</p></article></body>").endswith("by and large.")


@pytest.mark.parametrize("part", ["<p hidden>{}</p>", '<div style="display: none"><p>{}</p></div>', '<p style="color:red;VISIBILITY:hidden">{}</p>', '<div class="adslot"><p>{}</p></div>'])
def test_hidden_parts_and_slots_go(part):
    assert main_text(f"<article><h1>A heading</h1>{part.format(COMMENT)}{PARAGRAPHS}</article>") == WANT


def test_hidden_text_is_not_visible_text():
    assert page_parts("<p>one</p><p hidden>two</p><div style='display:none'>three</div>")[2] == "one"


def test_teasers_are_other_articles():
    teaser = "<article><h2>Another</h2><p>Here is a longer teaser, which tells what another text is about, in two clauses.</p></article>"
    article = f"<article><h1>A heading</h1>{PARAGRAPHS}</article>"
    for rest in (teaser * 3, f"<div class='grid'>{teaser * 4}</div>"):
        assert main_text(f"<body>{article}{rest}</body>") == main_text(f"<body><main>{article}{rest}</main></body>") == WANT


def test_open_comments_end_with_the_page():
    page = f"<body><article><h1>A heading</h1>{PARAGRAPHS}</article><!-- not closed <p>{COMMENT}</p></body>"
    assert main_text(page) == WANT
    assert main_text(f"<script><!-- x()</script><article><h1>A heading</h1>{PARAGRAPHS}</article>") == WANT
