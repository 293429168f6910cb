from __future__ import annotations

import itertools
import random
import time
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.helpers import prose

from tabprep.llm import chat_format, decontamination, html_extraction, language_id, packing, queries, token_counts, topk_search, toxicity

DATA = "/root/testdata/sf0.01"


# Main text of pages.

PAGE = (
    '<!DOCTYPE html><html><head><title>T</title><script>var t="</p><b>";</script><style>p{}</style></head><body>'
    '<nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- <p>no</p> --><div class="ad">Buy &amp; win.</div>'
    "<article><header><h1>A &lt;title&gt; &copy;</h1></header><p><b>One <br>two.<p>Is.\n\t<a href='>'>linked</a> &nbsp; end</p>"
    '<form><p>Your mail</p></form><aside>side</aside><section id="comments"><p>A reader writes.</p></section>'
    "<p>Last.</p></article><footer>&copy; foot</footer>"
)


def test_main_text_of_a_page():
    assert html_extraction.main_text(PAGE) == "A <title> ©\n\nOne two.\n\nIs. linked end\n\nLast."
    assert html_extraction.main_text(PAGE + "</body></html>") == html_extraction.main_text(PAGE)


def test_main_text_without_an_article():
    page = (
        '<body><div class="menu"><a href=x>Home</a> <a href=y>About</a></div><div><h2>Head</h2><p>' + "Long text goes on. " * 8 + "</p><p>Is.</p><p>"
        + "More text of it. " * 8 + '</p></div><div>tiny</div><div class="cookie-notice">We use cookies, as all do, and tell you so.</div>'
    )
    text = html_extraction.main_text(page)
    assert text.startswith("Head\n\nLong") and "\n\nIs.\n\n" in text and "cookies" not in text and "Home" not in text and "tiny" not in text


LONG = "<p>" + "Long text goes on and on. " * 20 + "</p>"
SHORT = {
    "title": "<div>A title</div>{0}", "intro": "<div>Short intro.</div><div>{0}</div>", "heading after": "<div>{0}</div><div><h3>More</h3><p>Few</p></div>",
    "list": "<div>{0}<ul><li>one</li><li>two</li></ul>{0}</div>", "list at the end": "<div>{0}<ol><li>one</li></ol></div>", "linked list": "<div>{0}<ul><li><a href=x>one</a></li></ul>{0}</div>",
    "table": "<div>{0}</div><table><tr><td>a<td>1</table><div>{0}</div>", "own table": "{0}<table><tr><td>a</td></tr></table>",
    "divs": "<div><div>Short.</div><div>{0}</div><div>Few</div><div>{0}</div><div>The end.</div></div>",
    "sections": "<section><h2>A</h2><p>Few words.</p></section><section><h2>B</h2>{0}</section><section><h2>C</h2><p>Fewer</p></section>",
}


@pytest.mark.parametrize("name", SHORT)
def test_short_parts_without_an_article(name):
    page = '<body><ul><li><a href=a>Home</a></li><li><a href=b>About</a></li></ul><div class="main-menu">Go</div>' + SHORT[name].format(LONG) + "<div>© Us. All rights reserved.</div></body>"
    words = html_extraction._SPACE.sub(" ", html_extraction.re.sub("<[^>]*>", " ", SHORT[name].format(LONG))).split()
    assert html_extraction.main_text(page).split() == words


@pytest.mark.parametrize("name", ["layout has-sidebar", "no-sidebar", "search-page", "header-fixed", "search", "page-header", "sidebar", "with-comments nav-open"])
def test_wrappers_of_an_article(name):
    page = f'<body><div class="menu">Home</div><div class="{name}"><div class="ad">Buy.</div><article><p>Text of it.</p><div class="share">Tell all.</div></article></div></body>'
    assert html_extraction.main_text(page) == "Text of it."
    assert html_extraction.main_text(page.replace("article>", "main>")) == "Text of it."
    assert html_extraction.main_text(page.replace("<article>", "<footer><article>").replace("</article>", "</article></footer>")).count("Text") == 0


def test_named_parts_of_an_article():
    page = (
        '<article><div class="article-header"><h1>Title</h1></div><section id="related"><h2>Related work</h2><p>Others did it.</p></section>'
        '<section id="social-impact"><p>It matters.</p></section><div class="data-sharing"><p>Ask us.</p></div><div class="related-posts">Read on.</div>'
        '<section id="share"><a href=x>Send</a> <a href=y>Print</a></section><div class="comment-list"><article>A reply.</article></div><p>End.</p></article>'
    )
    assert html_extraction.main_text(page) == "Title\n\nRelated work\n\nOthers did it.\n\nIt matters.\n\nAsk us.\n\nEnd."
    beside = '<article>Text.</article><div id="comments"><article>A reply.</article></div><div class="sidebar"><article>Teaser.</article></div>'
    assert html_extraction.main_text(beside) == "Text."


@pytest.mark.parametrize("page", [None, "", "   ", "<", "<<p>", "<!--", "<script>x", "</div>", '<p class="', "<a" * 50, "<nav>only a menu</nav>"])
def test_main_text_of_odd_pages(page):
    assert isinstance(html_extraction.main_text(page), str)


@pytest.mark.parametrize("tag", ["<div>", "<span>", "<p><b>", "<div>a<span>", "</b><b><div>", "<ul><li>x"])
@pytest.mark.parametrize("start", ["", "<article>"])
def test_deep_markup_takes_linear_time(tag, start):
    page = start + "<p>Some words stand here, long enough to be a text of its own.</p>" + tag * 100_000
    began = time.process_time()
    assert html_extraction.main_text(page).startswith("Some words stand here")
    assert time.process_time() - began < 4


def test_windows_decide_in_an_article(monkeypatch):
    """How far the windows reach from the text settles which links at its end belong to it."""
    links = "".join(f"<p><a href=x>link {i}</a></p>" for i in range(6))
    page = "<article><h1>Title</h1>" + LONG * 2 + links + "</article>"
    found = {}
    for window in (2, 3, 5, 9):
        monkeypatch.setattr(html_extraction, "WINDOW", window)
        found[window] = html_extraction.main_text(page)
        assert found[window].startswith("Title\n\nLong text")
        assert found[window].count("link") == min(window - 1, 6)
    amid = page.replace("</article>", LONG + "</article>")
    assert html_extraction.main_text(amid).count("link") == 6
    listed = "<article>" + LONG + "<ul><li><a href=x>one</a></li><li><a href=y>two</a></li></ul></article>"
    assert "one" not in html_extraction.main_text(listed)
    assert html_extraction.main_text(listed.replace(LONG, "")) == "one\n\ntwo"


def slow_runs(weights, window, level):
    """Surges and dives from the definition: every window is summed anew, and marks the lines it covers."""
    windows = [range(i - window + 1, i + 1) for i in range(len(weights) + window - 1)]
    sums = [sum(weights[j] for j in w if 0 <= j < len(weights)) for w in windows]
    top = max(sums, default=0)
    marks, number, above = {}, 0, False
    for w, total in zip(windows, sums, strict=True):
        if total > 0 and total >= level * top:
            number += not above
            above = True
            for j in w:
                if 0 <= j < len(weights):
                    marks.setdefault(j, number)
        else:
            above = False
    return [
        (min(js), max(js) + 1, sum(weights[j] for j in js))
        for n in sorted(set(marks.values())) if (js := [j for j in marks if marks[j] == n])
    ]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([0, 0, 0, 1, 5, 40, 300]), max_size=40), st.integers(1, 6))
def test_surges_against_the_definition(weights, window):
    assert html_extraction.surges(weights, window) == slow_runs(weights, window, html_extraction.LEVEL)


PARTS = st.lists(st.tuples(st.sampled_from(["text", "short", "link", "head", "ul", "aside", "div"]), st.integers(1, 4)), min_size=1, max_size=9)


@settings(max_examples=200, deadline=None)
@given(PARTS)
def test_articles_against_a_tree(parts):
    """Main text of generated articles, from their tree: lines, containers, windows summed one by one."""
    html, lines = [], []  # line: (text, weight, container, heading); borders are empty lines
    border = [("", 0, None, False)] * html_extraction.WINDOW

    def line(kind, box, text):
        tag = {"head": "h2", "li": "li"}.get(kind, "p")
        linked = kind == "link" or kind == "li"
        html.append(f"<{tag}>{f'<a href=u>{text}</a>' if linked else text}</{tag}>")
        lines.append((text, 0 if linked else len(text), box, kind == "head"))

    for n, (kind, count) in enumerate(parts):
        if kind in ("ul", "aside", "div"):
            html.append(f"<{kind}>")
            shown = len(lines)
            lines.extend(border)
            for i in range(count):
                line("li" if kind == "ul" else "text", n + 1, f"inner words {n} {i} " * 4)
            if kind == "aside":
                del lines[shown + len(border) :]
                lines.extend(border)  # its lines weigh nothing and part windows as well
            lines.extend(border)
            html.append(f"</{kind}>")
        else:
            for i in range(count):
                line(kind, 0, {"text": f"Words of part {n}, {i}. " * 9, "short": f"s{n}{i}"}.get(kind, f"{kind} {n} {i}"))
    weights = [w for _, w, *_ in lines] if any(w for _, w, *_ in lines) else [len(t) for t, *_ in lines]
    runs = slow_runs(weights, html_extraction.WINDOW, html_extraction.LEVEL)
    top = max((w for *_, w in runs), default=0)
    heavy = {i for a, b, w in runs if w >= html_extraction.SHARE * top for i in range(a, b) if lines[i][0]}
    kept = []
    blocks, block = [], []
    for i, entry in enumerate([*lines, ("", 0, None, False)]):
        if entry[0]:
            block.append(i)
        elif block:
            blocks.append(block)
            block = []
    for block in blocks:
        own = [i for i in block if i in heavy or lines[i][3] or 2 * lines[i][1] > len(lines[i][0])]
        if heavy.intersection(block):
            kept += [i for i in block if own[0] <= i <= own[-1]]
        elif heavy:
            box = lines[block[0]][2]
            around = [i for i in heavy if lines[i][2] in (box, 0)]
            direct = [i for i in heavy if lines[i][2] == 0]
            amid = bool(around) and bool(direct) and min(direct) < block[0] < max(direct)
            weight, length = sum(lines[i][1] for i in block), sum(len(lines[i][0]) for i in block)
            if amid or 2 * weight > length or any(lines[i][3] for i in block):
                kept += block
    page = "<nav><a href=n>Menu</a></nav><article>" + "".join(html) + "</article><footer>Foot</footer>"
    assert html_extraction.main_text(page) == "\n\n".join(html_extraction._SPACE.sub(" ", lines[i][0]).strip() for i in kept)


def test_plain_text_is_a_page():
    assert html_extraction.main_text("just a < b text") == "just a < b text"


def test_extract(spark):
    long = "<article>" + "<p>word word.</p>" * 20_000 + "</article>"
    df = spark.createDataFrame([(1, "u", PAGE, 3), (1, "u", PAGE, 3), (None, None, None, 4), (3, "v", "", 5), (4, "w", long, 6)], "page_id bigint, url string, html string, n_chars int")
    rows = html_extraction.extract(df).collect()
    assert [r.n_chars for r in rows] == [len(r.text) for r in rows] and rows[0] == rows[1]
    assert [r.text for r in rows[2:4]] == ["", ""] and rows[4].text.count("\n\n") == 19_999
    assert html_extraction.extract(df.limit(0)).collect() == []


# Packing.


def check_bins(rows, sizes, sources, capacity):
    parts = {}
    for r in rows:
        if r.bin_id is not None:
            parts.setdefault(r.bin_id, []).append(r)
    for held in parts.values():
        held.sort(key=lambda r: r.offset)
        end = 0
        for r in held:
            assert r.offset >= end
            end = r.offset + r.n_bytes
        assert end <= capacity
        known = [sources[r.doc_id] for r in held if sources[r.doc_id] is not None]
        assert len(set(known)) == len(known)
    total = {}
    for r in rows:
        total[r.doc_id] = total.get(r.doc_id, 0) + r.n_bytes
    assert total == sizes
    return parts


def test_pack(spark):
    rng = np.random.default_rng(1)
    rows = [(i, "é" * int(rng.integers(0, 90)) + f"{i}" * (i % 3), f"s{rng.integers(0, 3)}" if i % 5 else None) for i in range(400)]
    rows += [(1000, "x" * 1234, "s0"), (1001, "y" * 200, "s1"), (1002, None, None)]
    df = spark.createDataFrame([(*r, "c") for r in rows], "doc_id bigint, text string, source string, part string")
    sizes = {i: len((t or "").encode()) for i, t, _ in rows}
    found = packing.pack(df, capacity=200, shard=150).collect()
    parts = check_bins(found, sizes, {i: s for i, _, s in rows}, 200)
    assert len(found) == len(rows) + 6 and len(parts) >= sum(sizes.values()) / 200
    assert packing.pack(df.limit(0)).collect() == []


def test_copies_are_kept_apart(spark):
    df = spark.createDataFrame([(i, "Same  words" if i % 2 else "same words ", f"s{i}") for i in range(6)], "doc_id bigint, text string, source string")
    assert len({r.bin_id for r in packing.pack(df).collect()}) == 6
    repeated = spark.createDataFrame([(1, "same", None)] * 5, "doc_id bigint, text string, source string")
    assert len(packing.pack(repeated).collect()) == 5


def test_near_copies_are_kept_apart(spark, tmp_path):
    words = prose(3, 60)
    near = [" ".join([*words[:k], "changed", *words[k + 1 :]]) for k in (0, 20, 40)]
    rows = [(i, t, f"s{i}") for i, t in enumerate([" ".join(words), *near, "alone", "by itself", None])]
    rows += [(None, "no id", "t0"), (None, "no id", "t1")]
    spark.createDataFrame(rows, "doc_id bigint, text string, source string").coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    found = queries.QUERIES["op2_best_fit_packing"](spark, str(tmp_path)).collect()
    bins = {r.doc_id: r.bin_id for r in found}
    assert len(found) == len(rows) and len({bins[i] for i in range(4)}) == 4 and bins[6] is None
    assert len({r.bin_id for r in found if r.doc_id is None}) == 2 and len({r.bin_id for r in found} - {None}) == 4


def test_best_fit_takes_the_tightest_compatible_bin():
    bins, offsets = packing.best_fit([8, 6, 2, 2, 4], ["a", "b", "a", "c", "a"], [None] * 5, 10)
    # The 4 fits behind the 6. A 2 of source a must pass by both bins that hold one; c takes the tightest.
    assert bins == [0, 1, 2, 0, 1] and offsets == [0, 0, 0, 8, 6]


@settings(max_examples=50, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 20), st.sampled_from([None, "a", "b", "c"]), st.sampled_from([None, 1, 2])), max_size=40))
def test_best_fit_equals_a_plain_search(items):
    sizes, sources, clusters = (list(c) for c in zip(*items, strict=True)) if items else ([], [], [])
    bins, _ = packing.best_fit(sizes, sources, clusters, 20)
    held = []
    for i in sorted(range(len(items)), key=lambda i: (-sizes[i], i)):
        fits = [
            (20 - sum(sizes[j] for j in b), n) for n, b in enumerate(held)
            if 20 - sum(sizes[j] for j in b) >= sizes[i]
            and not any(sources[j] == sources[i] is not None or clusters[j] == clusters[i] is not None for j in b)
        ]
        at = min(fits)[1] if fits else len(held)
        if at == len(held):
            held.append([])
        held[at].append(i)
        assert bins[i] == at


# Chat formatting.

PIECES = ["\\", "#", "##", "###", "</turn>", "\n", "### Assistant:", "\n</turn>\n", "a", " ", "\\\\", '"', "é", "### User:\n"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", 'odd "\\\n', ""]), st.lists(st.sampled_from(PIECES)).map("".join)), max_size=4))
def test_round_trip(turns):
    formatted = [chat_format.render_turn(*t) for t in turns]
    assert chat_format.parse("".join(f for f, _, _ in formatted)) == turns
    assert [chat_format.unescape(f[a:b]) for f, a, b in formatted] == [t for _, t in turns]


def test_text_is_escaped_only_where_it_conflicts():
    assert chat_format.render_turn("user", "a \\ b")[0] == "### User:\na \\ b\n</turn>\n"
    assert chat_format.render_turn("user", "x </turn>")[0] == "### User:\nx \\</turn>\n</turn>\n"
    assert chat_format.parse("### User:\nno end") is None and chat_format.parse("### Nobody:\nx\n</turn>\n") is None


def test_conversation_digests(spark):
    import hashlib

    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 2, "assistant", "</turn>"), (None, None, None, None), (2, 0, "user", "x"), (2, 0, "user", "x"), (3, 0, "assistant", "long " * 100_000)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id bigint, turn bigint, role string, text string, loss int")
    found = {r.conv_id: r for r in chat_format.conversation_digests(chat_format.format_turns(df)).collect()}
    assert found[1].turns_sha256 == hashlib.sha256(b"user\n\nassistant\nb\nassistant\n</turn>\n").hexdigest()
    assert (found[1].n_turns, found[1].loss_chars, found[1].loss_sha256) == (3, 8, hashlib.sha256(b"b</turn>").hexdigest())
    assert found[2].n_turns == 2 and found[None].n_turns == 1 and found[3].loss_chars == 500_000
    assert chat_format.conversation_digests(chat_format.format_turns(df.limit(0))).collect() == []


# Top-k search.


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(2)
    x = rng.integers(-40, 40, (700, 6))
    x[100:300] = x[7]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id bigint, v array<bigint>")
    found = sorted(tuple(r) for r in topk_search.top_k(df.filter("vec_id % 50 = 0"), df).collect())
    expected = []
    for q in range(0, 700, 50):
        scores = sorted((-int(x[q] @ x[i]), i) for i in range(700) if i != q)[:5]
        expected += [(q, k, i, -s) for k, (s, i) in enumerate(scores, 1)]
    assert found == sorted(expected)


def test_top_k_edge_cases(spark):
    rows = [(0, [1.0, 0.5]), (50, [0.25]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [1.0, 1.0]), (50, [0.25]), (5, [])]
    df = spark.createDataFrame([(*r, 7) for r in rows], "vec_id bigint, embedding array<float>, cell int")
    numbers = topk_search.whole_numbers(df)
    found = sorted(tuple(r) for r in topk_search.top_k(numbers.filter("vec_id % 50 = 0"), numbers).collect())
    assert found == [(0, 1, 50, 16384), (0, 2, 5, 0), (50, 1, 0, 16384), (50, 2, 5, 0)]
    assert topk_search.top_k(numbers, numbers.limit(0)).collect() == []


@pytest.mark.parametrize("size", [2**26, 2**29, 2**30])
def test_top_k_of_large_components(spark, size):
    rng = np.random.default_rng(5)
    x = [[size - int(c) for c in row] for row in rng.integers(0, 4, (200, 3))]
    df = spark.createDataFrame(list(enumerate(x)), "vec_id bigint, v array<bigint>")
    found = sorted(tuple(r) for r in topk_search.top_k(df.filter("vec_id % 50 = 0"), df).collect())
    expected = []
    for q in range(0, 200, 50):
        scores = sorted((-sum(a * b for a, b in zip(x[q], x[i])), i) for i in range(200) if i != q)[:5]
        expected += [(q, k, i, -s) for k, (s, i) in enumerate(scores, 1)]
    assert found == sorted(expected)


def test_top_k_refuses_what_a_score_cannot_hold(spark):
    df = spark.createDataFrame([(0, [2**32, 1]), (50, [2**32, 2])], "vec_id bigint, v array<bigint>")
    with pytest.raises(ValueError, match="cannot hold"):
        topk_search.top_k(df, df)


# Decontamination.


def test_masks_meet_every_overlap():
    length, wrong, masks = decontamination.OVERLAP, decontamination.SUBSTITUTIONS, decontamination.MASKS
    last = length - decontamination.SPAN
    for first, bad in itertools.product((0, 1), itertools.combinations(range(length), wrong)):
        assert any(not {at + o for o in masks[(first + at) % 2]} & set(bad) for at in range(last + 1))


def test_overlaps_with_substitutions(spark):
    items = [(k, " ".join(prose(k, 30))) for k in range(5)] + [(7, "only seven words stand in this item"), (8, None), (9, " ".join(prose(50, 9)))]
    def with_item(k, cut, at=()):
        w = items[k][1].split()[cut]
        for i in at:
            w[i] = "other"
        return " ".join([*prose(100 + k, 20), *w, *prose(200 + k, 5)])
    docs = [
        (0, with_item(0, slice(0, 30))), (1, with_item(1, slice(0, 30)).upper()), (2, with_item(2, slice(4, 17), (3, 9))), (3, with_item(3, slice(0, 13), (3, 6, 9))),
        (4, with_item(4, slice(0, 10))), (5, None), (6, ""), (7, items[5][1]), (8, "x"), (None, items[4][1]), (9, " ".join(prose(50, 7))), (10, " ".join(prose(50, 9)) + " more"), (0, with_item(0, slice(0, 30))),
    ]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id bigint, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    found = sorted(((r.doc_id, r.item_id) for r in decontamination.contaminated(df, bench).collect()), key=str)
    assert found == sorted([(0, 0), (1, 1), (2, 2), (None, 4), (7, 7), (10, 9)], key=str)
    kept = sorted((r.doc_id for r in decontamination.clean(df, bench).collect()), key=str)
    assert kept == sorted([3, 4, 5, 6, 8, 9, None], key=str)
    assert decontamination.contaminated(df.limit(0), bench).collect() == [] and decontamination.contaminated(df, bench.limit(0)).collect() == []


def test_short_items_with_a_substitution_at_any_place(spark):
    items = {n: prose(n, n, 10**6) for n in range(8, 14)}
    docs, expected = [], set()
    for (n, words), before in itertools.product(items.items(), (0, 1, 2, 5)):
        for wrong in [(), *itertools.combinations(range(n), 1), (0, n - 1), (2, n // 2), (0, 4, 8)]:
            i = len(docs)
            docs.append((i, " ".join([*["a"] * before, *("b" if k in wrong else w for k, w in enumerate(words)), "c"])))
            if len(wrong) <= 2 * n // 13:
                expected.add((i, n, n - len(wrong)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    bench = spark.createDataFrame([(n, " ".join(w)) for n, w in items.items()], "item_id bigint, text string")
    found = decontamination.contaminated(df, bench).collect()
    assert {(r.doc_id, r.item_id, r.matched) for r in found} == expected and len(found) == len(expected)


def test_items_of_few_words(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_SEEDS", 3)
    items = {n: prose(n, n, 40) for n in range(1, 8)}
    docs = {i: prose(1000 + i, 60, 40) for i in range(60)} | {100 + n: ["a", *w, "b", *w] for n, w in items.items()} | {200: [], 201: items[7][:6]}
    expected = {}
    for i, w in docs.items():
        for n, item in items.items():
            at = [k for k in range(len(w) - n + 1) if w[k : k + n] == item]
            if at:
                expected[i, n] = (len(at), at[0], n)
    df = spark.createDataFrame([(i, " ".join(w)) for i, w in docs.items()] * 2, "doc_id bigint, text string")
    bench = spark.createDataFrame([(n, " ".join(w).upper()) for n, w in items.items()] * 2 + [(9, ""), (10, None)], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): (r.n_hits, r.first_word, r.matched) for r in decontamination.contaminated(df, bench).collect()}
    assert found == expected and {n for _, n in expected} == set(items)
    fewer = {(r.doc_id, r.item_id) for r in decontamination.contaminated(df, bench, least_words=4).collect()}
    assert fewer == {(i, n) for i, n in expected if n >= 4}


def test_benchmark_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_SEEDS", 20)
    items = [(k, " ".join(prose(k, 30))) for k in range(5)]
    df = spark.createDataFrame([(k, f"a b {t} c") for k, t in items], "doc_id bigint, text string")
    found = decontamination.contaminated(df, spark.createDataFrame(items, "item_id bigint, text string")).collect()
    assert sorted((r.doc_id, r.item_id, r.matched) for r in found) == [(k, k, 13) for k in range(5)]


def test_decontamination_runs_no_python(spark):
    plan = queries.QUERIES["op6_decontamination"](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Python" not in plan and "Arrow" not in plan


# Token counts.


@settings(max_examples=200, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=60), st.sampled_from(["<|endoftext|>", "<|startoftext|>x", "it's I'LL we'd", "ÀÉ ½² \x1f\x85\xa0 ſtraße", "ΑΣ İ", "don''t __ 12345"])), max_size=6))
def test_counts_equal_the_library(texts):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path("word_bpe_49k.json")
    library = test_counts_equal_the_library.__dict__.setdefault("library", Tokenizer.from_file(path))
    counter = test_counts_equal_the_library.__dict__.setdefault("counter", token_counts.PieceCounter(path))
    assert counter.counts(texts) == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_token_counts(spark):
    df = spark.createDataFrame([(1, "Ünder 12", 0), (1, "Ünder 12", 0), (None, None, 0), (2, "", 0), (3, "word " * 3000, 0)], "doc_id bigint, text string, n_tokens int")
    rows = token_counts.token_counts(df, queries.tokenizer_path("word_bpe_49k.json")).collect()
    assert [(r.n_bytes, r.over_limit) for r in rows] == [(9, False), (9, False), (0, False), (0, False), (15000, True)]
    assert rows[4].n_tokens == 3000 and rows[2].n_tokens == 0
    assert token_counts.token_counts(df.limit(0), queries.tokenizer_path("word_bpe_49k.json")).collect() == []


# Languages and toxicity: held-out accuracy.


def test_language_of_held_out_documents(spark):
    rows = queries.QUERIES["op7_language_id"](spark, DATA).collect()
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang").collect()}
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(lang) and {r.doc_id for r in held} == {i for i in lang if zlib.crc32(str(i).encode()) % 3 == 1}
    assert sum(r.lang_pred == lang[r.doc_id] for r in held) / len(held) > 0.98 and all(0 <= r.score <= 1 for r in rows)


def test_language_edge_cases(spark):
    df = spark.createDataFrame([(1, "the cat and the dog", "en"), (2, "der Hund und die Katze", "de"), (3, None, "en"), (4, "x", None), (4, "x", None)], "doc_id bigint, text string, lang string")
    profiles = language_id.learn_profiles(df)
    asked = spark.createDataFrame([(1, "the dog", 1), (1, "the dog", 1), (2, "die Katze", 1), (3, None, 1), (4, "12 %% ", 1), (5, "", 1), (6, "und der " * 50_000, 1)], "doc_id bigint, text string, score int")
    found = [(r.doc_id, r.lang_pred) for r in language_id.identify(asked, profiles).collect()]
    assert found == [(1, "en"), (1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (6, "de")]
    none = language_id.learn_profiles(df.limit(0))
    assert {r.lang_pred for r in language_id.identify(asked, none).collect()} == {"und"}
    assert language_id.identify(asked.limit(0), profiles).collect() == []


def test_toxicity_of_held_out_documents(spark):
    rows = queries.QUERIES["op10_toxicity"](spark, "/root/testdata/sf0.1").filter("held_out").collect()
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet("/root/testdata/sf0.1/labels.parquet").collect()}
    labelled = [(toxic[r.doc_id], r.predicted) for r in rows if r.doc_id in toxic]
    right = sum(a == b == 1 for a, b in labelled)
    assert right / sum(a for a, _ in labelled) > 0.7 and right / sum(b for _, b in labelled) > 0.9


def test_offending_sentences(spark):
    texts = [f"Fine words number {i} stand here. And more of them. {'You utter clod!' if i % 3 == 0 else 'All good.'} The end." for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)] + [(None, 1), (3, None), (3, 1)], "doc_id bigint, toxic int")
    model = toxicity.learn_toxicity(df, labels)
    asked = spark.createDataFrame([(1, "A calm start. Well you utter clod.", 0), (2, "A calm start.", 0), (3, None, 0), (4, "", 0), (5, "?!", 0), (6, "Calm. " * 50_000, 0)], "doc_id bigint, text string, score int")
    found = {r.doc_id: r for r in toxicity.score_toxicity(asked, model).collect()}
    assert [asked.first().text[s.start : s.end].strip() for s in found[1].offending] == ["Well you utter clod"]
    assert found[1].score > 0.5 > found[2].score and all(0 <= r.score <= 1 for r in found.values())
    assert all(found[i].score == 0 and found[i].offending == [] for i in (3, 4, 5))
    nothing = toxicity.learn_toxicity(df, labels.limit(0))
    assert {r.score < 1e-6 for r in toxicity.score_toxicity(asked, nothing).collect()} == {True}
    assert toxicity.score_toxicity(asked.limit(0), model).collect() == []


# Plain versions of the two models.


def plain_bundle(text, dimensions):
    """Sum of a text's bound trigrams, letter by letter."""
    letters = [c if c.isalpha() else None for c in text.lower()]
    marked = [None]
    for c in [*letters, None]:
        if c is not None or marked[-1] is not None:
            marked.append(c)
    total = np.zeros(dimensions)
    for before, middle, after in zip(marked, marked[1:], marked[2:]):
        if middle is None:
            continue
        bound = np.ones(dimensions)
        for place, c in enumerate((before, middle, after)):
            vector = language_id._letter_vectors(np.array([ord(c) if c else 0]), dimensions)[0].astype(float)
            bound *= np.array([vector[(i - place) % dimensions] for i in range(dimensions)])
        total += bound
    return total


def plain_unit(x):
    return x / np.linalg.norm(x)


def test_language_against_plain_profiles(spark):
    learned = [
        ("de", "Der Hund läuft über die große Straße."), ("de", "Wir gehen heute nach Hause, und du?"), ("en", "The dog runs across the wide street."),
        ("en", "We walk home today -- do you?"), ("en", "The dog runs across the wide street."), ("fr", "Le chien court dans la rue, n'est-ce pas?"),
    ]
    asked = ["The street is wide.", "Die Straße ist groß.", "La rue est longue", "x", "a1b2--c3", "Straße street rue " * 40, "ΑΒΓ абв", "12 34", ""]
    dimensions = 64
    by_language = {lang: {t for l, t in learned if l == lang} for lang in ("de", "en", "fr")}  # each text once
    units = [plain_unit(sum(plain_unit(plain_bundle(t, dimensions)) for t in texts)) for texts in by_language.values()]
    mean = sum(units) / len(units)
    prototypes = [plain_unit(u - mean) for u in units]
    profiles = language_id.learn_profiles(spark.createDataFrame(learned, "lang string, text string"), dimensions=dimensions)
    assert profiles.names == list(by_language)
    np.testing.assert_allclose(profiles.vectors, prototypes, atol=1e-5)
    rows = language_id.identify(spark.createDataFrame(list(enumerate(asked)), "doc_id bigint, text string"), profiles).collect()
    for r in rows:
        if not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score) == ("und", 0.0)
            continue
        cosines = [plain_unit(plain_unit(plain_bundle(r.text, dimensions)) - mean) @ p for p in prototypes]
        assert r.lang_pred == list(by_language)[int(np.argmax(cosines))]
        assert r.score == pytest.approx(max(0.0, max(cosines)), abs=1e-4)


def test_languages_and_floors_are_learned_from_every_text(spark):
    drawn, dimensions = random.Random(3), 64
    texts = {lang: {"".join(drawn.choices(letters, k=drawn.randint(1, 60))) for _ in range(6000)} for lang, letters in (("one", "abcd e"), ("two", "bcdf o"))}
    rows = [(lang, t) for lang, some in texts.items() for t in some if t.strip()]
    df = spark.createDataFrame(rows + rows[:300], "lang string, text string")
    profiles = language_id.learn_profiles(df, dimensions=dimensions)
    grams = {lang: [language_id._trigrams(t) for l, t in rows if l == lang] for lang in texts}
    for lang, unit in zip(profiles.names, profiles.units, strict=True):
        np.testing.assert_allclose(unit, plain_unit(language_id._bundle(grams[lang], dimensions).sum(axis=0, dtype=float)), atol=1e-5)
    floors, likeness = language_id.learn_floors(df, profiles), {}
    for some in grams.values():
        for g, value in zip(some, profiles.likeness(some), strict=True):
            likeness.setdefault(language_id._length_class(g), []).append(float(value))
    assert set(floors) == set(likeness)
    for length, values in likeness.items():
        low = np.quantile(values, language_id.OUTLIERS, method="inverted_cdf")
        assert floors[length] == pytest.approx(min(low, language_id.NOISE / dimensions**0.5), abs=1e-5)


@settings(max_examples=100, deadline=None)
@given(st.text(alphabet="abAé.!?\n -1", max_size=60), st.dictionaries(st.sampled_from(["a", "b", "ab", "abab*", "é", "aaaa*", "aaaaa*"]), st.floats(-3, 3)), st.floats(-6, 2))
def test_toxicity_against_a_plain_noisy_or(text, weights, bias):
    """A product over sentences, split and scored character by character."""
    import pyarrow as pa

    spans, start = [], None
    for i, c in enumerate([*text, "\n"]):
        if c in ".!?\n":
            if start is not None:
                spans.append((start, i))
            start = None
        elif start is None:
            start = i
    clean, offending = 1.0, []
    for a, b in spans:
        words = set("".join(c if c.isalpha() else " " for c in text[a:b].lower()).split())
        if not words:
            continue
        score = bias
        for w in words:
            score += weights.get(w, 0) + sum(weights.get(w[:k] + "*", 0) for k in (4, 5, 6) if len(w) >= k)
        p = 1 / (1 + np.exp(-score))
        clean *= 1 - p
        if p >= 0.5:
            offending.append((a, b))
    batch = pa.record_batch([pa.array([text.encode()])], ["t"])
    (found,) = list(toxicity._score(iter([batch]), toxicity.Model(weights, bias), 0.5, "t", []))
    row = found.to_pylist()[0]
    assert row["score"] == pytest.approx(1 - clean, abs=1e-9)
    near = {(s["start"], s["end"]) for s in row["offending"] if abs(s["score"] - 0.5) < 1e-9}
    assert {(s["start"], s["end"]) for s in row["offending"]} - near == set(offending) - near


def test_toxicity_training_finds_the_maximum():
    """The slope of the balanced noisy-or likelihood, by differences, vanishes where training ends."""
    rng = np.random.default_rng(5)
    bags = []
    for i in range(80):
        toxic = int(i % 4 == 0)
        bag = [sorted(rng.choice(3, 2, replace=False).tolist()) for _ in range(3)]
        bags.append((toxic, [*bag, [3, 4]] if toxic else bag))
    weights, bias = toxicity._train(bags, np.zeros(5), rounds=4000)

    def likelihood(x):
        total = 0.0
        for toxic, bag in bags:
            clean = np.prod([1 - 1 / (1 + np.exp(-(sum(x[f] for f in s) + x[-1]))) for s in bag])
            share = sum(t == toxic for t, _ in bags) / len(bags)
            total += np.log(max(1 - clean if toxic else clean, 1e-300)) / (2 * share)
        return total / len(bags) - 0.5e-4 * float(np.sum(np.square(x[:-1])))

    x = np.append(weights, bias)
    slopes = []
    for i in range(len(x)):
        step = np.zeros(len(x))
        step[i] = 1e-4
        slopes.append((likelihood(x + step) - likelihood(x - step)) / 2e-4)
    assert likelihood(x) > likelihood(np.append(np.zeros(5), -5.0)) and np.abs(slopes).max() < 1e-3
    assert min(weights[3:]) > max(weights[:3])
