"""What the dealt methods make on their way: nodes, common prefixes, overlap counts, joins."""

from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from gridloom.llm import bwt, ngrams, subtrees


def brute_maximal(docs, width):
    """Every word sequence of at least width words that occurs twice, cannot be extended either way."""
    at = defaultdict(list)
    for d, doc in enumerate(docs):
        for i in range(len(doc)):
            for j in range(i + width, len(doc) + 1):
                at[tuple(doc[i:j])].append((d, i))
    out = []
    for s, found in at.items():
        before = {docs[d][i - 1] if i else (d, i) for d, i in found}
        after = {docs[d][i + len(s)] if i + len(s) < len(docs[d]) else (d, i) for d, i in found}
        if len(found) > 1 and len(before) > 1 and len(after) > 1:
            out.append((len(s), sorted(found)))
    return sorted(out)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.sampled_from([b"a", b"b", b"cc"]), max_size=16), min_size=1, max_size=6), st.sampled_from([1, 2, 4]), st.sampled_from([1, 3, 1000]))
def test_deep_nodes_are_the_maximal_repeats(docs, width, limit):
    assert sorted(subtrees.maximal_repeats([b" ".join(d) for d in docs], width, limit)) == brute_maximal(docs, width)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.sampled_from([b"a", b"b", b"cc"]), min_size=3, max_size=200), st.sampled_from([2, 5, 40]))
def test_prefix_groups_hold_every_repeat_and_no_more_than_fit(doc, limit):
    words, _ = subtrees.numbered([b" ".join(doc)])
    starts = np.arange(len(words) - 2)
    groups = list(subtrees.prefix_groups(words, starts, 3, limit))
    seen = np.concatenate(groups) if groups else np.zeros(0, int)
    assert len(set(seen.tolist())) == len(seen)
    windows = [tuple(words[s : s + 3]) for s in starts]
    group_of = {int(s): k for k, g in enumerate(groups) for s in g}
    for k, g in enumerate(groups):
        assert len(g) <= limit or len({windows[s] for s in g}) == 1
    for i, w in enumerate(windows):
        twins = [j for j, v in enumerate(windows) if v == w]
        assert len(twins) == 1 or {group_of[j] for j in twins} == {group_of[i]}


@settings(max_examples=120, deadline=None)
@given(st.lists(st.text("ab", min_size=1, max_size=40), min_size=1, max_size=9), st.sampled_from([4, 5, 6, 10, 20]), st.sampled_from([1, 2, 3]), st.data())
def test_merge_gives_order_and_common_prefixes(texts, width, shards, draw):
    strings = [t.encode() for t in texts]
    m = bwt.Merged(strings, width, shards, np.array([draw.draw(st.integers(0, 5)) for _ in strings]))
    data = {}
    for k, f in zip(m.at.tolist(), m.firsts.tolist(), strict=True):
        for i in range(len(strings[k])):
            data[f + i] = strings[k][i : i + width]
    rows = [r for r in m.rows().tolist() if len(data.get(r, b"")) == width]
    whole = [data[r] for r in rows]
    assert whole == sorted(whole)
    place = {r: i for i, r in enumerate(m.rows().tolist())}
    for a, b in zip(rows, rows[1:], strict=False):
        x, y, k = data[a], data[b], 0
        while k < m.depth and x[k * m.step : (k + 1) * m.step] == y[k * m.step : (k + 1) * m.step]:
            k += 1
        assert m.common[place[a] + 1 : place[b] + 1].min() == k


@settings(max_examples=120, deadline=None)
@given(st.lists(st.tuples(st.sets(st.integers(0, 60)), st.sets(st.integers(0, 60)), st.integers(0, 4)), max_size=20))
def test_blocks_of_columns_add_up_to_overlaps(pairs):
    spread = lambda s: np.array([(x * 0x9E3779B97F4A7C15) & ((1 << 48) - 1) for x in sorted(s)], np.uint64)
    sizes = np.array([(len(x) + more, len(y) + more) for x, y, more in pairs], np.int64).reshape(-1, 2)
    count, seen = ngrams.overlaps(sizes, [spread(x) for x, _, _ in pairs], [spread(y) for _, y, _ in pairs])
    for k, (x, y, _) in enumerate(pairs):
        needs = ngrams._needed(*sizes[k])
        assert (count[k] >= needs) == (len(x & y) >= needs)
        if seen[k] == ngrams.BLOCKS:
            assert count[k] == len(x & y)
        else:
            assert len(x & y) < needs
