"""Main text: the window sums against a plain twin, weights, hostile and odd pages."""

from __future__ import annotations

import random
import time

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tasteloom.llm import html

PAGES = "/root/testdata/sf0.001/pages.parquet"


def _plain_stretches(lengths):
    """Every run of windows with some text, window by window."""
    n = html.WINDOW
    sums = [sum(lengths[max(i - n + 1, 0) : i + 1]) for i in range(len(lengths) + n)]
    out, at = [], 0
    while at < len(sums):
        if not sums[at]:
            at += 1
            continue
        end = next(i for i in range(at, len(sums)) if not sums[i])
        out.append((at, end - n + 1, max(sums[at:end])))
        at = end
    return out


def test_stretches_against_plain_windows():
    chance = random.Random(5)
    for _ in range(300):
        lengths = [chance.choice([0, 0, 0, 1, 7, 50]) for _ in range(chance.randrange(40))]
        assert html.stretches(lengths) == _plain_stretches(lengths)


def test_window_sums_decide_on_the_given_pages():
    """With menus, adverts and footers shown, the sums drop them; the names add little."""
    pages = pq.read_table(PAGES).column("html").to_pylist()
    same = dropped = 0
    for page in pages:
        lines = html.lines_of(page, hiding_parts=False)
        kept = html.chosen(lines)
        dropped += len(html.stretches([len(text) for text, _ in lines])) - len(kept)
        same += " ".join(t for a, b in kept for t, _ in lines[a:b] if t) == html.main_text(page)
    assert dropped > 2 * len(pages)
    assert same > 0.97 * len(pages)


def test_weights():
    inside, outside = ("x" * 30, 1), ("y" * 90, 0)
    gap = [("", 0)] * html.WINDOW
    # Nothing outside weighs beside an article with as much text; else it weighs half.
    assert html.weighted([inside] * 3 + gap + [outside]) == [2 * 30 * html.SURGE] * 3 + [0] * 4
    assert html.weighted([inside, *gap, outside]) == [60, 0, 0, 0, 90]
    assert html.weighted([outside]) == [180]
    # A short part of an article reaches the level by itself.
    lines = [("x", 1), *gap, *[inside] * 3, *gap, ("y" * 39, 0)]
    assert html.chosen(lines) == [(0, 1), (4, 7)]
    assert html.chosen([("few", 0), *gap, ("words", 0)]) == [(4, 5)]
    assert html.chosen([]) == html.chosen(gap) == []


@pytest.mark.parametrize(
    "page",
    [
        "<div>" * 100_000 + "</i>" * 100_000,
        "<span>" * 80_000 + "</b>" * 80_000,
        "<b><div>" + "<span>" * 80_000 + "</b>" * 80_000,
        '<a ">"' * 150_000,
        "<p><b>" * 150_000,
        "<li><ul>" * 60_000,
        "<article>" * 50_000 + "</article>" * 50_000,
        "<div class=ad>" * 70_000,
    ],
)
def test_hostile_pages_take_linear_time(page):
    began = time.process_time()
    html.main_text(page)
    assert time.process_time() - began < 6


def test_quotes_that_never_close():
    text = "a text that is long enough to be a paragraph of its own"
    assert html.main_text(f'<p class="x>{text}</p><p>{text}</p>') == f"{text} {text}"
    assert html.main_text(f'<p title="a > b">{text}</p>') == text


def test_whole_long_repeated_rows_and_other_columns(spark):
    words = " ".join(str(i) for i in range(200_000))
    page = f"<body><nav>menu</nav><article><p>{words}</p></article>"
    data = [(1, "u", page), (1, "u", page), (2, "v", "<p>one"), (2, "v", "<p>one"), (3, None, None)]
    pages = spark.createDataFrame(data, "page_id long, url string, html string")
    clash = pages.withColumn("text", F.lit("z")).withColumn("n_chars", F.lit(1))
    found = sorted(map(tuple, html.extract(clash).collect()))
    assert [(i, len(t), n) for i, _, t, n in found] == [
        (1, len(words), len(words)), (1, len(words), len(words)), (2, 3, 3), (2, 3, 3), (3, 0, 0)
    ]
    assert found[0][2] == words
