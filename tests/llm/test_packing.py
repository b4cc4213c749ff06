from collections import defaultdict

import numpy as np
from hypothesis import given, settings, strategies as st

from conftest_llm import prose
from silverline.llm import packing


@given(st.lists(st.integers(1, 4096), max_size=200))
@settings(max_examples=60, deadline=None)
def test_pack(sizes):
    sizes = sorted(sizes, reverse=True)
    at, offsets, final = packing.pack(sizes)
    inside = defaultdict(list)
    for size, own, offset in zip(sizes, at, offsets):
        inside[own].append((offset, size))
    for own, items in inside.items():
        end = 0
        for offset, size in sorted(items):
            assert offset == end
            end += size
        assert final[own] == min(n for n in packing.LENGTHS if n >= end)
    assert sorted(inside) == list(range(len(final)))


def plain_pack(sizes, lengths, cost):
    """Best fit by looking at every open bin, opening by trying every length."""
    bins, at = [], []
    for i, size in enumerate(sizes):
        rest = sum(sizes[i + 1:])
        open_ = [(b["length"] - sum(b["items"]), n) for n, b in enumerate(bins)
                 if b["length"] - sum(b["items"]) >= size]
        if open_:
            n = min(open_)[1]
        else:
            price = {x: cost(x) / (size + min(x - size, rest)) for x in lengths if x >= size}
            n = len(bins)
            bins.append({"length": max(x for x in price if price[x] == min(price.values())), "items": []})
        bins[n]["items"].append(size)
        at.append(n)
    return at, [min(x for x in lengths if x >= sum(b["items"])) for b in bins]


@given(st.lists(st.integers(1, 64), max_size=60), st.sampled_from([(64,), (16, 64), (8, 16, 32, 64), (5, 33, 64)]),
       st.sampled_from([0, 1, 8, 100]), st.sampled_from([0.0, 1 / 64, 1.0]))
@settings(max_examples=300, deadline=None)
def test_same_bins_as_looking_at_every_bin(sizes, lengths, share, bend):
    cost = lambda n: n + bend * n * n + share
    sizes = sorted(sizes, reverse=True)
    at, offsets, final = packing.pack(sizes, lengths, cost)
    assert (at, final) == plain_pack(sizes, lengths, cost)
    filled = defaultdict(int)
    for own, size, offset in zip(at, sizes, offsets):
        assert offset == filled[own]
        filled[own] += size


def test_several_lengths_cost_less_than_one():
    rng = np.random.default_rng(0)
    sizes = sorted(rng.integers(1, 900, 3000).tolist(), reverse=True)
    _, _, final = packing.pack(sizes)
    assert sum(sizes) / sum(final) > 0.99
    one_size = -(-sum(sizes) // 4096) * 4096
    assert sum(map(packing.sequence_cost, final)) < packing.sequence_cost(4096) * one_size / 4096


def test_documents(docs):
    rng = np.random.default_rng(1)
    rows = [(i, prose(rng, int(rng.integers(1, 700)))) for i in range(60)]
    rows += [(100, prose(rng, 9000)), (101, prose(rng, 4096)), (102, None), (103, ""), (104, " \n"),
             (None, "one two"), (105, "same"), (105, "same")]
    got = packing.pack_documents(docs(rows), items_a_group=20).collect()
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id, r.row].append((r.start, r.n_words))
        bins[r.bin_id].append((r.bin_offset, r.n_words, r.bin_length))
    want = sorted((str(i), len((t or "").split())) for i, t in rows if (t or "").split())
    assert sorted((str(i), sum(n for _, n in p)) for (i, _), p in pieces.items()) == want
    for parts in pieces.values():
        end = 0
        for start, n in sorted(parts):
            assert start == end
            end += n
    for parts in bins.values():
        end = 0
        for offset, n, length in sorted(parts):
            assert offset == end
            end += n
        assert length == min(x for x in packing.LENGTHS if x >= end)
    assert packing.pack_documents(docs([])).collect() == []
