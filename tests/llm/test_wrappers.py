"""Wrapper induction without landmarks, at any depth, against a plain tree matching."""

import itertools

import numpy as np

from contract_lake.llm import wrappers


def page(k, rail="rail"):
    return (f"<body><div class=top>Daily paper</div><div class=story><p>Story {k} tells of thing {k * k}.</p><p>Always said here.</p></div>"
            f"<div class={rail}>Most read today: item {k}</div></body>")


def test_template_among_neighbours_and_region_without_landmarks():
    wrapper = wrappers.induce([page(k) for k in range(10)])
    for k in (0, 3, 77):
        assert wrappers.extract(page(k), wrapper) == f"Story {k} tells of thing {k * k}."


def test_a_page_of_another_layout_keeps_its_text():
    wrapper = wrappers.induce([page(k) for k in range(10)])
    other = "<body><div class=top>Daily paper</div><div class=rail>Only a rail, but long</div><div class=new>And a new part</div></body>"
    assert wrappers.extract(other, wrapper) == "Only a rail, but long And a new part"


def test_title_before_the_region_and_ids_tell_blocks_apart():
    def page(k):
        return (f"<body><div id=nav><a href=/>Home {k}</a></div><div class=head><h1>Title {k}</h1></div>"
                f"<div id=text><p>Body {k} with many more words of its own {k}</p></div><div id=more>Short {k}</div></body>")
    wrapper = wrappers.induce([page(k) for k in range(6)])
    assert wrappers.extract(page(9), wrapper) == "Title 9 Body 9 with many more words of its own 9"
    assert wrappers.extract(page(9)) == "Title 9 Body 9 with many more words of its own 9 Short 9"


def test_constant_items_stay_in_lists_and_constant_paragraphs_in_articles():
    def page(k):
        return f"<body><article><p>A {k}</p><p>As always.</p><ul><li>one {k}<li>two</ul></article><p>Out {k}</p></body>"
    wrapper = wrappers.induce([page(k) for k in range(6)])
    assert wrappers.extract(page(8), wrapper) == "A 8 As always. one 8 two"


def test_nested_beyond_any_recursion():
    for tag in ("div", "b", "blockquote"):
        deep = [f"<{tag}>" * 100_000 + f"deep {k}" + f"</{tag}>" * 100_000 for k in range(5)]
        wrapper = wrappers.induce(deep)
        assert wrappers.extract(deep[2], wrapper) == "deep 2"
        assert wrappers.extract("<p>flat</p>", wrapper) == "flat"


def test_many_alternating_children():
    pages = ["<dl>" + "".join(f"<dt>t{i} {k}<dd>d{i}" for i in range(20_000)) + "</dl>" for k in range(5)]
    text = wrappers.extract(pages[1], wrappers.induce(pages))
    assert text == " ".join(f"t{i} 1" for i in range(20_000))


def plain_match(a, b):
    """Simple tree matching as in the textbook, by its table of children."""
    if a.name != b.name:
        return 0
    m, n = len(a.children), len(b.children)
    table = np.zeros((m + 1, n + 1), int)
    for i, j in itertools.product(range(m), range(n)):
        table[i + 1, j + 1] = max(table[i, j + 1], table[i + 1, j], table[i, j] + plain_match(a.children[i], b.children[j]))
    return 1 + int(table[m, n])


def test_matching_against_a_plain_one():
    chance = np.random.default_rng(5)

    def tree(depth):
        if not depth:
            return "x"
        return "".join(f"<div class={c}>{tree(depth - 1)}</div>" for c in chance.permutation(list("abcd"))[:chance.integers(0, 5)])

    crossed = 0
    for _ in range(60):
        pages = [tree(3) for _ in range(4)]
        root = wrappers.Slot("html")
        for p in pages[:3]:
            group = wrappers.folded(wrappers.parse(p))
            wrappers.merge(root, group)
        group = wrappers.folded(wrappers.parse(pages[3]))
        weight, pairs = wrappers.matched(group, root)
        assert weight == len(pairs) == plain_match(group, root)
        assert all(g.name == s.name for g, s in pairs)
        crossed += any(len({c.name for c in s.children}) < len(s.children) for s in wrappers.in_order(root))
    assert crossed > 10


def odd_last(k, n):
    """All pages but the last two have the same words on top; the story says one thing in most pages, not in all."""
    rail = "Rail of the day" if k < n - 2 else f"Rail {k}"
    said = "Said on most pages." if k % 5 else f"Said on page {k}."
    return (f"<body><div class=top>Daily paper</div><div class=rail>{rail}</div><div class=story><h2>Part {k}</h2>"
            f"<p>Story {k} tells of many a thing {k * k}.</p><div class=box>{said}</div></div></body>")


def test_every_page_counts_and_odd_ones_spoil_only_their_group(spark):
    n = 60
    pages = [odd_last(k, n) for k in range(n)]
    expected = [f"Part {k} Story {k} tells of many a thing {k * k}. {'Said on most pages.' if k % 5 else f'Said on page {k}.'}" for k in range(n)]
    wrapper = wrappers.induce(pages)
    assert [wrappers.extract(p, wrapper) for p in pages] == expected
    # the same from blocks of pages joined; copies, of one page in many blocks too, change nothing
    rows = [(k, f"http://a.org/{k}", p) for k, p in enumerate(pages)] + [(n + k, "http://a.org/x", pages[3]) for k in range(40)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(5)
    for block in (1000, 20, 3):
        found = wrappers.host_wrappers(df, block).collect()
        marks = wrappers.json.loads(found[0].wrapper)
        assert len(found) == 1 and [wrappers.extract(p, marks) for p in pages] == expected, block
    assert {r.page_id: r.text for r in wrappers.main_text(df).collect()} == dict(enumerate(expected + [expected[3]] * 40))


def test_no_eight_pages_decide_for_a_host(spark):
    """A text that is constant in the pages of least hash, and only there, stays."""
    from pyspark.sql import functions as F

    first = {r.id for r in spark.range(400).orderBy(F.xxhash64("id"), "id").limit(8).collect()}
    said = ["Said here" if k in first else f"Said once {k}" for k in range(400)]
    pages = [f"<body><div class=a>{said[k]}</div><p>Words {k} of page {k * k}</p></body>" for k in range(400)]
    df = spark.createDataFrame([(k, "http://b.org/", p) for k, p in enumerate(pages)], "page_id long, url string, html string").repartition(4)
    assert {r.page_id: r.text for r in wrappers.main_text(df).collect()} == {k: f"{said[k]} Words {k} of page {k * k}" for k in range(400)}


def test_wrappers_joined_count_as_their_pages_would():
    chance = np.random.default_rng(9)

    def tree(depth):
        return "".join(f"<div class={c}>{tree(depth - 1) if depth else ''}{'same' if c < 'c' else chance.integers(9)}</div>"
                       for c in chance.permutation(list("abcd"))[:chance.integers(1, 5)])

    pages = list(dict.fromkeys(wrappers.flat(wrappers.parse(tree(2))) for _ in range(40)))
    groups = list(wrappers.grouped(pages))
    assert sorted(sum(groups, [])) == sorted(pages) and all(8 <= len(g) < 16 for g in groups)
    parts = [wrappers.of_group(g) for g in groups]
    for part in parts:
        copy = wrappers.unpacked(wrappers.packed(part))
        assert wrappers.packed(copy) == wrappers.packed(part)
    letters = sum(s.letters for p in parts for s in wrappers.in_order(p))
    whole = wrappers.joined(parts)
    assert whole.pages == whole.held == len(pages)
    assert sum(s.letters for s in wrappers.in_order(whole)) == letters
