import random
import zlib

import numpy as np
import public_tokenizers
from coursewise.llm import packing as P
from tokenizers import Tokenizer

from .corpora import awkward, documents, none

PATH = public_tokenizers.path("byte_bpe_50k.json")


def reference():
    return Tokenizer.from_file(PATH)


def test_ids_are_the_tokenizers():
    t, mine = reference(), P.TokenIds(PATH, remember=50)
    odd = ["", "a", "  a  b\n\nc <|endoftext|> d's\t x\0y", "x <|endoftext|> y", "<|endoftext|>", "a<|endoftext|><|endoftext|>. b <|endof text|>",
           " x\n", " \n a \n b\n c  ", "it's 12 34\n5   z q", "a. b, 3.5 c'd. ?! x?!\n... y\n.",
           "a\x1cb\xa0c 　d", "don't, I'll: we've! 'tis's.", "日本。 語, ½. ².", "x\n", "\n", "a\nb", "é ü\nß.", "x" * 3000]
    for text in odd + [x or "" for _, x in awkward()]:
        assert np.frombuffer(mine.encode(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids


def replay(plan, counts):
    bins = {}
    length, first, bin_, per, offset = plan.arrays()
    for s, n in counts.items():
        own = [i for i in range(len(length)) if length[i] == s]
        for r in range(n):
            k = max(i for i in own if first[i] <= r)
            i = r - first[k]
            bins.setdefault(int(bin_[k] + i // per[k]), []).append((int(offset[k] + i % per[k] * s), s))
    return bins


def best(items, capacity):
    """Fewest bins, by trying everything."""
    items = sorted(items, reverse=True)

    def place(i, bins, limit):
        if len(bins) > limit:
            return False
        if i == len(items):
            return True
        tried = set()
        for k, b in enumerate(bins):
            if b >= items[i] and b not in tried:
                tried.add(b)
                if place(i + 1, bins[:k] + [b - items[i]] + bins[k + 1:], limit):
                    return True
        return place(i + 1, bins + [capacity - items[i]], limit)

    n = -(-sum(items) // capacity)
    while not place(0, [], n):
        n += 1
    return n


def test_plans_are_valid_and_reduction_loses_nothing():
    rng = random.Random(2)
    for _ in range(150):
        capacity = rng.choice([10, 16, 25])
        counts = {s: rng.randint(1, 3) for s in rng.sample(range(1, capacity + 1), rng.randint(1, 5))}
        plan = P.Plan(counts, capacity)
        bins = replay(plan, counts)
        assert len(bins) == plan.bins
        for b in bins.values():
            at = 0
            for offset, s in sorted(b):
                assert offset == at
                at += s
            assert at <= capacity
        items = [s for s, n in counts.items() for _ in range(n)]
        if len(items) <= 9:
            # the fixed bins belong to some best packing: the rest alone needs the difference
            rest = [s for k, b in bins.items() if k >= plan.reduced_bins for _, s in b]
            assert best(items, capacity) == plan.reduced_bins + (best(rest, capacity) if rest else 0)


def test_pack_round_trip(spark):
    rows = awkward()
    got = P.pack(documents(spark, rows), capacity=64).collect()
    t = reference()
    want = []
    for i, text in rows:
        ids = t.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % 64 or 64
        cuts = [0, *range(first, len(ids) + 1, 64)]
        for k, (a, z) in enumerate(zip(cuts, cuts[1:])):
            want.append((i, k, a, z - a, zlib.crc32(np.array(ids[a:z], "<u4").tobytes())))
    assert sorted(((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got), key=repr) == sorted(want, key=repr)
    bins = {}
    for r in got:
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, n in sorted(b):
            assert offset == at
            at += n
        assert at <= 64
    assert len(bins) <= 1.05 * -(-sum(r.length for r in got) // 64) + 1


def test_empty(spark):
    assert P.pack(none(spark)).count() == 0
