"""Sibling lists beyond the size of one table are matched as well as short ones."""

from __future__ import annotations

import random

import numpy as np

from cellscape.llm import html_text


def best_gain(tags_a, sizes_a, tags_b, sizes_b) -> int:
    best = [[0] * (len(tags_b) + 1) for _ in range(len(tags_a) + 1)]
    for i in range(len(tags_a) - 1, -1, -1):
        for j in range(len(tags_b) - 1, -1, -1):
            pair = min(sizes_a[i], sizes_b[j]) + best[i + 1][j + 1] if tags_a[i] == tags_b[j] else 0
            best[i][j] = max(best[i + 1][j], best[i][j + 1], pair)
    return best[0][0]


def test_long_lists_reach_the_largest_gain():
    draw = random.Random(3)
    for n, m in [(90, 70), (1, 4000), (4000, 1), (300, 120)]:
        lists = [np.array([draw.randrange(k) for _ in range(w)]) + s for w in (n, m) for k, s in ((4, 0), (6, 1))]
        pairs = html_text._match(*lists)
        assert all(a < c and b < d for (a, b), (c, d) in zip(pairs, pairs[1:]))
        assert all(lists[0][i] == lists[2][j] for i, j in pairs)
        assert sum(min(lists[1][i], lists[3][j]) for i, j in pairs) == best_gain(*lists)


def test_shifted_template_of_a_long_page_is_found():
    # one more box in front: paired by position, no row of the list would meet its own line
    rows = [f"<{'ul' if i % 3 else 'ol'}><li>line {i}</li></{'ul' if i % 3 else 'ol'}>" for i in range(80)]
    story = "the text that only this page has, and much more of it than of anything else " * 60
    first = html_text.Page(f"<section><b>x</b></section>{''.join(rows)}<dl><dt>{story}</dt></dl><table></table>")
    second = html_text.Page(f"<table></table><dl><dt>new</dt></dl>{''.join(rows)}<dl><dt>{story[::-1]}</dt></dl><section></section>")
    html_text.align(first.root, second.root)
    assert first.content() == f"x\n{story.strip()}"
