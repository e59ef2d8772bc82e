"""Differencing: longest common subsequences of any size, templates without names, short pages, runs of copies."""

from __future__ import annotations

import random

import numpy as np
import pytest

from basewise.llm import maintext

PAGES = "page_id long, url string, html string"


def plain_length(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        diagonal = 0
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], diagonal + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


@pytest.mark.parametrize("cells", [4_000_000, 30, 1])
def test_shared_lines_are_a_longest_subsequence(monkeypatch, cells):
    monkeypatch.setattr(maintext, "TABLE", cells)
    rng = random.Random(cells)
    for _ in range(300):
        a = np.array([rng.randrange(6) for _ in range(rng.randrange(0, 25))], dtype=np.int64)
        b = np.array([rng.randrange(6) for _ in range(rng.randrange(0, 25))], dtype=np.int64)
        at = maintext.shared_lines(a, b)
        picked, j = a[at].tolist(), 0
        assert (np.diff(at) > 0).all() and len(at) == plain_length(a, b)
        for y in b.tolist():
            j += j < len(picked) and y == picked[j]
        assert j == len(picked)


def test_many_equal_lines_on_long_pages():
    """One rule at all sizes: repeated lines of very long pages are shared lines as on short ones."""
    for n in (399, 6000):
        a = np.concatenate((np.array([1]), np.full(n, 7), np.array([2]))).astype(np.int64)
        b = np.concatenate((np.array([3]), np.full(n - 5, 7), np.array([4]))).astype(np.int64)
        assert len(maintext.shared_lines(a, b)) == n - 5


def texts(spark, rows):
    pages = spark.createDataFrame(rows, PAGES).repartition(3)
    counts = {r["page_id"]: r.asDict() for r in maintext.deleted_lines(pages).collect()}
    return {r["page_id"]: counts[r["page_id"]] | r.asDict() for r in maintext.extract(pages).collect()}


def test_template_without_names_on_short_pages(spark):
    """Plain markup in which a short page has less text of its own than its template."""
    template = "<div>Home of the example site and all its friends</div><div>Terms of use, imprint and all the other small print</div>"
    own = {0: "a few own words", 1: "<p>" + "</p><p>".join(f"a long page has sentence {i}" for i in range(30)) + "</p>", 2: "nothing but this"}
    got = texts(spark, [(i, f"http://h/{i}", f"<body>{template}<div>{t}</div></body>") for i, t in own.items()])
    assert got[0]["text"] == "a few own words" and got[2]["text"] == "nothing but this"
    assert got[1]["text"].startswith("a long page has sentence 0\n") and got[1]["n_differenced"] == 2


def test_runs_of_copies(spark):
    """Inner pages of a run of copies lose the template like the pages at its ends."""
    page = "<body><div>Site header line</div><p>{}</p><div>Site footer line</div></body>"
    story = "</p><p>".join(f"the story that was copied, part {i}" for i in range(9))
    rows = [(0, "http://h/a", page.format("some first page with a text of its own that is long enough"))]
    rows += [(i, f"http://h/b{i:02}", page.format(story)) for i in range(1, 12)]
    rows += [(99, "http://h/c", page.format("some last page with a text of its own that is long enough"))]
    got = texts(spark, rows)
    assert {got[i]["text"] for i in range(1, 12)} == {story.replace("</p><p>", "\n")}
    assert got[0]["n_differenced"] == got[5]["n_differenced"] == got[99]["n_differenced"] == 2


def test_what_differencing_leaves_goes_by_its_name(spark):
    page = "<body><nav>menu {0}</nav><nav>all pages</nav><article><p>the text of page {0} is here</p></article><div class='ad'>buy {0}</div></body>"
    got = texts(spark, [(i, f"http://h/{i}", page.format(i)) for i in range(4)])
    for i, r in got.items():
        assert (r["text"], r["n_differenced"], r["n_marked"]) == (f"the text of page {i} is here", 1, 2)
