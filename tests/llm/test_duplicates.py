"""MinHash near-dedup and suffix-array dedup."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pyspark.sql import functions as F

from tripmart.llm import near_dups, suffix_dedup
from tripmart.llm.components import components, joined
from tripmart.llm.suffix_array import grouped, suffix_array

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


class Forest:
    def __init__(self):
        self.up = {}

    def find(self, x):
        while self.up.setdefault(x, x) != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def shingle_set(text):
    words = WORD.findall((text or "").translate(LOWER))
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def plain_clusters(texts):
    sets = {i: shingle_set(t) for i, t in texts.items()}
    forest, ids = Forest(), sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            both = len(sets[i] & sets[j])
            if sets[i] and 100 * both >= 75 * (len(sets[i]) + len(sets[j]) - both) and both:
                forest.join(i, j)
    return {i: (len(sets[i]), forest.find(i)) for i in ids}


def clusters(docs):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in near_dups.cluster(docs).collect()}


def variants(seed, base=40, words=120, edits=(0, 1, 3, 6, 12, 25)):
    """Texts with copies that differ in a few words, close to the threshold on both sides."""
    rng, texts = random.Random(seed), {}
    for _ in range(base):
        text = [f"w{rng.randrange(3000)}" for _ in range(words)]
        for n in edits:
            copy = list(text)
            for at in rng.sample(range(words), n):
                copy[at] = f"x{rng.randrange(3000)}"
            texts[len(texts)] = " ".join(copy).upper() if rng.random() < 0.2 else "  ".join(copy)
    return texts


def test_clusters_against_all_pairs(spark, documents):
    assert clusters(documents) == plain_clusters({r.doc_id: r.text for r in documents.collect()})
    texts = variants(3)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    assert clusters(docs) == plain_clusters(texts)


def test_a_dense_region_is_compared_completely(spark):
    """One large group of near copies, in which order alone would not find every link."""
    texts = variants(5, base=1, words=90, edits=[n % 9 for n in range(150)])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    assert clusters(docs) == plain_clusters(texts)


def test_leftovers_find_all_links_of_a_region(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK", 7)
    texts = variants(8, base=3, words=60, edits=[n % 5 for n in range(25)])
    rows = [(i, near_dups.signature(near_dups.shingles([t.lower().encode()])[0]), t) for i, t in texts.items()]
    nodes = spark.createDataFrame(rows, "node long, signature binary, text string")
    nothing = spark.createDataFrame([], "node long, root long")
    found = near_dups.leftovers(nodes.select("node", "signature"), nothing, nodes.select("node", "text"))
    forest = Forest()
    for r in found.collect():
        x, y = shingle_set(texts[r.a]), shingle_set(texts[r.b])
        assert 100 * len(x & y) >= 75 * len(x | y)
        forest.join(r.a, r.b)
    assert {i: forest.find(i) for i in texts} == {i: root for i, (_, root) in plain_clusters(texts).items()}


def test_leftovers_meet_a_large_component_as_a_whole(spark, monkeypatch):
    monkeypatch.setattr(near_dups, "BLOCK", 7)
    texts = variants(9, base=2, words=60, edits=[n % 6 for n in range(40)])
    rows = [(i, near_dups.signature(near_dups.shingles([t.lower().encode()])[0]), t) for i, t in texts.items()]
    nodes = spark.createDataFrame(rows, "node long, signature binary, text string")
    want = {i: root for i, (_, root) in plain_clusters(texts).items()}
    # all but every fifth node of each cluster are joined already
    known = [(i, root) for i, root in want.items() if i % 5 or i == root]
    found = near_dups.leftovers(
        nodes.select("node", "signature"), spark.createDataFrame(known, "node long, root long"), nodes.select("node", "text")
    )
    forest = Forest()
    for i, root in known:
        forest.join(i, root)
    for r in found.collect():
        forest.join(r.a, r.b)
    assert {i: forest.find(i) for i in texts} == want


def test_clusters_of_awkward_rows(awkward, nothing):
    rows = near_dups.cluster(awkward).collect()
    assert len(rows) == awkward.count()
    found = defaultdict(set)
    for r in rows:
        found[r.doc_id].add((r.n_shingles, r.component_id))
    assert found[1] == {(8, 1)} and found[2] == {(8, 1)}
    assert found[3] == {(0, 3)} and found[4] == {(0, 4)} and found[5] == {(0, 5)}
    assert found[None] == {(1, None), (0, None)}
    assert found[6] == {(len(shingle_set(next(r.text for r in awkward.collect() if r.doc_id == 6))), 6)}
    assert {c for _, c in found[7]} == {6}
    assert near_dups.cluster(nothing).count() == 0


def test_one_row_of_each_group_survives(spark, awkward, nothing):
    text, near, other = ("%s " * 30 % tuple(f"{c}{i}" for i in range(30)) for c in "aab")
    near = text.upper().replace("A29", "changed")
    rows = [
        (1, text), (1, text), (2, text), (3, near),  # repeated rows, a copy and a near copy
        (None, text), (None, other), (None, other), (5, other),  # without an id
        (7, "only here " * 3), (7, "nor there " * 3), (7, "NOR\tthere " * 3),  # one id, several texts
        (8, "alone with its words"), (9, ""), (9, ""), (None, None),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("count", F.lit("x")).repartition(3)
    found = near_dups.survivors(docs)
    assert found.columns == docs.columns
    kept = Counter((r.doc_id, (r.text or "").lower().split()[0] if (r.text or "").split() else "") for r in found.collect())
    assert kept == {(1, "a0"): 1, (5, "b0"): 1, (7, "only"): 1, (7, "nor"): 1, (8, "alone"): 1, (9, ""): 2, (None, ""): 1}
    assert near_dups.survivors(nothing).count() == 0
    rest = Counter((r.doc_id, r.text and r.text[:9]) for r in near_dups.survivors(awkward).collect())
    assert rest == {
        (1, "the quick"): 1, (3, None): 1, (None, "a text wi"): 1, (None, None): 1, (4, ""): 1, (5, " \n\t "): 1,
        (6, "word0 and"): 1, (8, "naïve caf"): 1,
    }


def test_survivors_are_the_first_of_their_components(spark, documents):
    found = {r.doc_id for r in near_dups.cluster(documents).collect() if r.doc_id == r.component_id}
    assert sorted(r.doc_id for r in near_dups.survivors(documents).collect()) == sorted(found)


def test_texts_that_share_an_id_are_told_apart(spark):
    a, b = "one two three four five six seven", "ten eleven twelve thirteen fourteen fifteen"
    docs = spark.createDataFrame([(1, a), (1, b), (2, b + " sixteen"), (3, b)], "doc_id long, text string")
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in near_dups.cluster(docs).collect())
    assert got == Counter([(1, 3, 1), (1, 2, 1), (2, 3, 2), (3, 2, 1)])


def test_signature_agreement_estimates_similarity():
    rng = np.random.default_rng(4)
    pool = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    x, y = pool[:2000], pool[500:2500]
    a, b = (np.frombuffer(near_dups.signature(s), ">u4") for s in (x, y))
    assert abs((a == b).mean() - 1500 / 2500) < 0.2 and near_dups.signature(x[:0]) == b""


def test_components_with_chains_stars_and_additions(spark):
    rng = random.Random(2)
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, 1000 + i) for i in range(1, 200)]
    rest = [(rng.randrange(2000, 2200), rng.randrange(2000, 2200)) for _ in range(120)]
    links = chain + star + rest
    rng.shuffle(links)

    def expected(pairs):
        forest = Forest()
        for a, b in pairs:
            if a != b:
                forest.join(a, b)
        return {x: forest.find(x) for x in list(forest.up)}

    first = components(spark.createDataFrame(links, "a long, b long"))
    assert {r.node: r.root for r in first.collect()} == expected(links)
    more = [(150, 1100), (2100, 5000), (6000, 6001), (7, 8)]
    both = joined(first, spark.createDataFrame(more, "a long, b long"))
    got = {r.node: r.root for r in both.collect()}
    assert {x: got.get(x, x) for x in expected(links + more)} == expected(links + more)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# ------------------------------------------------------------------ suffix arrays


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(0, 3), max_size=40), st.integers(1, 3))
def test_suffix_array_against_sorting(symbols, times):
    symbols = symbols * times
    assert suffix_array(np.array(symbols, int)).tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:])


def test_groups_share_their_longest_lyndon_prefix():
    def lyndon_prefix(s):
        return max(n for n in range(1, len(s) + 1) if all(s[:n] < s[k:n] for k in range(1, n)))

    rng = random.Random(6)
    for _ in range(50):
        s = [rng.randrange(3) for _ in range(30)]
        group, order, previous = grouped(np.array(s))
        prefix = [tuple(s[i : i + lyndon_prefix(s[i:])]) for i in range(len(s))]
        by_group = defaultdict(set)
        for i, g in enumerate(group):
            by_group[g].add(prefix[i])
        assert all(len(p) == 1 for p in by_group.values())
        assert [next(iter(by_group[g])) for g in order] == sorted(set(prefix))
        for i, p in enumerate(previous):
            smaller = [j for j in range(i) if s[j:] < s[i:]]
            # in a lower group, or none: the nearest smaller suffix that does not share the prefix
            assert p == max((j for j in smaller if prefix[j] != prefix[i] and prefix[j] < prefix[i]), default=-1)


def plain_cut(rows):
    """Kept bytes and spans, by every window of every text in order of id."""
    seen, out = set(), {}
    for i, text in sorted(rows):
        raw = (text or "").encode()
        covered = np.zeros(len(raw), bool)
        for at in range(len(raw) - 99):
            window = raw[at : at + 100]
            if window in seen:
                covered[at : at + 100] = True
            seen.add(window)
        out[i] = (len(raw), bytes(np.frombuffer(raw, np.uint8)[~covered]), int(covered.sum()))
    return out


def cut(docs):
    return {
        r.doc_id: (r.n_bytes, bytes(r.kept), sum(s.end - s.start for s in r.spans))
        for r in suffix_dedup.without_repeats(docs, keep=["doc_id"]).collect()
    }


def passages(seed, n=60):
    rng = random.Random(seed)
    words = ["".join(rng.choices("abcdeé", k=rng.randrange(1, 9))) for _ in range(400)]
    shared = [" ".join(rng.choices(words, k=rng.randrange(15, 60))) for _ in range(6)]
    rows = []
    for i in range(n):
        parts = [" ".join(rng.choices(words, k=rng.randrange(0, 60))) for _ in range(4)]
        for _ in range(rng.randrange(3)):
            parts.insert(rng.randrange(5), rng.choice(shared))
        rows.append((i, " ".join(parts)))
    rows += [(100, "a" * 350), (101, "a" * 99), (102, "ab" * 130), (103, "x" + "ab" * 60 + "y"), (104, rows[3][1] + "!")]
    return rows


@pytest.mark.parametrize("crowd", [512, 1])
def test_repeats_against_every_window(spark, documents, monkeypatch, crowd):
    monkeypatch.setattr(suffix_dedup, "CROWD", crowd)
    monkeypatch.setattr(suffix_dedup, "SLICES", 50)
    rows = passages(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert cut(docs) == plain_cut(rows)
    if crowd > 1:
        assert cut(documents) == plain_cut([(r.doc_id, r.text) for r in documents.collect()])


@pytest.mark.parametrize("length", [16, 1])
def test_slices_of_crowded_anchors_are_hashed_as_one_buffer(monkeypatch, length):
    rng = random.Random(3)
    raw, packed = [], []
    for _ in range(1500):
        count, offset, start = rng.randrange(1, 65), rng.randrange(64), rng.randrange(5000)
        packed.append(start << 12 | (count - 1) << 6 | offset)
        raw.append(b"".join(rng.choices([b"ab", b"ab" * 40, b"c"], k=count + 99))[: count + 99])
    built = []
    rolling = suffix_dedup.Rolling
    monkeypatch.setattr(suffix_dedup, "Rolling", lambda data: built.append(len(data)) or rolling(data))
    own, low, windows, place, x, y = (c.tolist() for c in suffix_dedup.runs_of(raw, np.array(packed), length))
    assert len(built) == 2
    # the runs of a slice hold each of its windows once and are cut at like distances from the anchor
    held = defaultdict(list)
    for i, a, n in zip(own, low, windows, strict=True):
        held[i] += range(a, a + n)
        assert 1 <= n <= length and (a == 0 or (a - (packed[i] & 63)) % length == 0)
    assert [held[i] for i in range(len(raw))] == [list(range((p >> 6 & 63) + 1)) for p in packed]
    assert [p >> 12 for p in place] == [(packed[i] >> 12) + a for i, a in zip(own, low, strict=True)]
    assert [(p >> 6 & 63) + 1 for p in place] == windows
    # equal hashes stand for equal bytes
    content = [raw[i][a : a + n + 99] for i, a, n in zip(own, low, windows, strict=True)]
    assert len(set(content)) == len(set(zip(x, y, strict=True))) == len(set(zip(x, y, content, strict=True))) < len(content)


def test_line_of_many_texts_amid_their_own(spark):
    """A line too short to go, with more different neighbours than ``CROWD``; some neighbours are equal as well."""
    rng = random.Random(4)
    line = "".join(rng.choices("abcdefgh ", k=76))
    own = ["".join(rng.choices("klmnopqr ", k=80)) for _ in range(900)]
    rows = [(i, rng.choice(own) + line + rng.choice(own)[: rng.randrange(81)]) for i in range(1500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert cut(docs) == plain_cut(rows)


def test_single_windows_travel_without_their_bytes(spark):
    slices = spark.createDataFrame([(1, 5 << 12 | 3 << 6 | 2, b"x" * 103)], "doc long, packed long, bytes binary")
    assert suffix_dedup._runs(slices, 1).columns == ["x", "y", "doc", "packed"]
    assert suffix_dedup._runs(slices, 16).columns == ["x", "y", "doc", "packed", "bytes"]
    assert suffix_dedup._runs(slices, 1).count() == 4


def test_texts_are_cut_as_by_every_window():
    rng = random.Random(8)
    for _ in range(200):
        texts = [bytes(rng.choices(b"abc", k=rng.choice([0, 5, 99, 100, 150, 400]))) for _ in range(rng.randrange(1, 8))]
        own, packed, mask, gone = [], [], [], [np.zeros(len(t), bool) for t in texts]
        for i, text in enumerate(texts):
            for _ in range(rng.randrange(5) if len(text) > 99 else 0):
                start = rng.randrange(len(text) - 99)
                count = rng.randrange(1, min(64, len(text) - 99 - start) + 1)
                marked = rng.choice([-1, rng.getrandbits(6), rng.getrandbits(63)])
                own.append(i), packed.append(start << 12 | (count - 1) << 6), mask.append(marked)
                for k in range(count):
                    if marked >> k & 1:
                        gone[i][start + k : start + k + 100] = True
        left, spans = suffix_dedup.cut_texts(texts, *(np.array(c, np.int64) for c in (own, packed, mask)))
        assert left == [bytes(np.frombuffer(t, np.uint8)[~g]) for t, g in zip(texts, gone, strict=True)]
        for found, g in zip(spans.to_pylist(), gone, strict=True):
            edge = np.flatnonzero(np.diff(np.concatenate([[0], g.astype(int), [0]])))
            assert [(f["start"], f["end"]) for f in found] == list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def test_long_texts_are_cut_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "PIECE", 64)
    rows = passages(2, n=25)
    assert cut(spark.createDataFrame(rows, "doc_id long, text string")) == plain_cut(rows)


def test_repeats_in_awkward_rows(spark, awkward, nothing):
    rows = suffix_dedup.without_repeats(awkward).collect()
    assert len(rows) == awkward.count()
    assert set(awkward.columns) <= set(suffix_dedup.without_repeats(awkward).columns)
    for r in rows:
        assert r.n_bytes == len((r.text or "").encode())
        assert r.n_bytes == len(r.kept) + sum(s.end - s.start for s in r.spans)
    text = next(r for r in rows if r.doc_id == 7)
    assert bytes(text.kept) == b"end"  # "and " precedes words everywhere
    # rows of one id and text are one text: neither is earlier than the other
    twin = "b " * 40 + "c " * 40
    same = spark.createDataFrame([(1, twin), (1, twin), (2, twin)], "doc_id long, text string")
    sizes = sorted((r.doc_id, len(r.kept)) for r in suffix_dedup.without_repeats(same).collect())
    once = plain_cut([(1, twin)])[1]
    assert sizes == [(1, len(once[1])), (1, len(once[1])), (2, 0)]
    assert suffix_dedup.without_repeats(nothing).count() == 0


@pytest.mark.parametrize("largest", [7, 2**63 - 1])
def test_texts_that_share_an_id_or_have_none_lose_nothing_of_their_own(spark, largest):
    """2,000 texts without an id and 2,000 of one id, some with a passage that others have; some rows twice."""
    rng = random.Random(5)
    passage = [" ".join(rng.choices(["lorem", "ipsum", "dolor", "sit"], k=40)) for _ in range(3)]
    rows = []
    for i in range(4000):
        own = "".join(rng.choices("abcdefghij ", k=rng.randrange(100, 160)))
        rows.append((None if i % 2 else largest, own + (rng.choice(passage) if i % 7 == 0 else "") + own[::-1]))
    rows += rows[:50] + [(3, rows[0][1]), (4, "a text of its own " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = suffix_dedup.without_repeats(docs).collect()
    assert len(found) == len(rows)

    def order(row):
        key, text = row
        return (2**63 - 1 if key is None else key, key is None, hashlib.md5(text.encode()).hexdigest())

    distinct = sorted(set(rows), key=order)
    plain = plain_cut([(n, text) for n, (_, text) in enumerate(distinct)])
    expected = {row: plain[n][1] for n, row in enumerate(distinct)}
    assert all(bytes(r.kept) == expected[r.doc_id, r.text] for r in found)
    # what is cut does repeat
    assert sum(len(r.kept) < r.n_bytes for r in found) > 500


def test_kept_text_has_no_broken_code_points(spark):
    shared = "é" * 80
    docs = spark.createDataFrame([(1, "x" + shared), (2, "yy" + shared + "z")], "doc_id long, text string")
    kept = {r.doc_id: r.kept for r in suffix_dedup.without_repeats(docs, as_text=True).collect()}
    assert kept[2].startswith("yy") and kept[2].endswith("z") and "�" not in kept[2]
