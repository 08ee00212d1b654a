"""Jaccard join and line dedup against brute force."""

import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from itemflow.llm import jaccard_join, line_dedup, setlinks
from itemflow.llm.connect import connected
from itemflow.llm.jaccard_join import jaccard_components
from itemflow.llm.line_dedup import dedup_lines, line_groups
from itemflow.llm.scratch import stored

AZ = bytes(range(65, 91))
LOWER = bytes.maketrans(AZ, AZ.lower())


def components(links, nodes):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def jaccard_brute(texts, percent=90):
    sets = []
    for t in texts:
        w = (t or "").encode().translate(LOWER).split()
        sets.append({tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set())
    links = [
        (i, j)
        for i in range(len(sets))
        for j in range(i)
        if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    found = components(links, range(len(sets)))
    return {i: (len(s), found[i]) for i, s in enumerate(sets)}


def near_copies(seed, families, copies):
    draw = random.Random(seed)
    word = lambda: "".join(draw.choice("abcdefgh") for _ in range(draw.randint(1, 5)))
    passage = [word() for _ in range(60)]
    out = []
    for _ in range(families):
        base = [word() for _ in range(draw.choice([1, 2, 3, 8, 30, 120, 300]))]
        if draw.random() < 0.5:
            base += passage
        for _ in range(draw.randint(1, copies)):
            own = list(base)
            for _ in range(draw.randint(0, 3)):
                own[draw.randrange(len(own))] = word()
            out.append(" ".join(own))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join_is_that_of_brute_force(docs, seed):
    texts = [None, "", " \n", "A b", "a B", "x" * 200_000, *near_copies(seed, 40, 12)]
    got = {r[0]: (r[1], r[2]) for r in jaccard_components(docs(*texts)).collect()}
    assert got == jaccard_brute(texts)


def test_many_near_copies_with_lists_beyond_pairs(docs, monkeypatch):
    """Small bounds, so that cells, parts and long lists are all used."""
    monkeypatch.setattr(setlinks, "SHORT", 3)
    monkeypatch.setattr(setlinks, "SETS", 8)
    texts = near_copies(5, 3, 60)
    got = {r[0]: (r[1], r[2]) for r in jaccard_components(docs(*texts)).collect()}
    assert got == jaccard_brute(texts)


def test_jaccard_rows_with_null_and_repeated_ids(spark):
    rows = [(None, "a b c d"), (3, "a b c d"), (3, "a b c d"), (2, "A B c d"), (9, None)]
    found = jaccard_components(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(map(str, found)) == sorted(
        ["Row(doc_id=None, n_shingles=2, component_id=2)", "Row(doc_id=3, n_shingles=2, component_id=2)"]
        + ["Row(doc_id=3, n_shingles=2, component_id=2)", "Row(doc_id=2, n_shingles=2, component_id=2)"]
        + ["Row(doc_id=9, n_shingles=0, component_id=9)"]
    )


def test_jaccard_of_no_rows(spark):
    assert jaccard_components(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_block_search_is_that_of_brute_force():
    draw = np.random.default_rng(3)
    base = draw.integers(0, 1 << 60, 200)
    sets = []
    for _ in range(80):
        own = base[draw.random(200) < draw.choice([0.5, 0.93, 0.99])]
        sets.append(np.unique(np.concatenate([own, draw.integers(0, 1 << 60, draw.integers(0, 12))])))
    same = [
        (i, j)
        for i in range(80)
        for j in range(i)
        if 100 * len(np.intersect1d(sets[i], sets[j])) >= 90 * len(np.union1d(sets[i], sets[j]))
    ]
    found = setlinks.linked(sets, list(range(80)), 90)
    assert components(found, range(80)) == components(same, range(80))
    assert all((max(p), min(p)) in same for p in found)
    few = line_dedup._alike(sets, list(range(80)), 90)
    assert {(max(p), min(p)) for p in few} == set(same)


def test_packed_values_come_back():
    values = np.array([0, 1, (1 << 48) - 1], np.uint64)
    assert setlinks.unpacked(setlinks.packed(values)).tolist() == values.tolist()


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(0, 60)]
    star = [(1000, i) for i in range(1001, 1100)]
    rows = [*path, *star, (5, 5), (None, 3), (7, None), *path]
    draw = random.Random(1)
    draw.shuffle(rows)
    got = dict(connected(spark.createDataFrame(rows, "a long, b long")).collect())
    assert got == {**dict.fromkeys(range(61), 0), **dict.fromkeys(range(1000, 1100), 1000)}


def test_components_of_no_pairs(spark):
    assert connected(spark.createDataFrame([], "a long, b long")).collect() == []


def line_brute(texts):
    """The line numbers that go, by exact similarity of all lines."""
    lines = [(d, n, x.encode().translate(LOWER).decode().strip(" \t\x0b\x0c\r")) for d, t in enumerate(texts) if t for n, x in enumerate(t.split("\n"))]
    lines = [(d, n, x) for d, n, x in lines if x]
    sets = [{x[i : i + 8] for i in range(max(1, len(x) - 7))} for _, _, x in lines]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    found = components(links, range(len(lines)))
    gone = defaultdict(list)
    for i, (d, n, _) in enumerate(lines):
        if found[i] != i:
            gone[d].append(n)
    return dict(gone)


def test_line_dedup_is_that_of_brute_force(docs):
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abcdefghijkéß") for _ in range(draw.randint(2, 7)))
    stock = [" ".join(word() for _ in range(draw.randint(5, 40))) for _ in range(30)]

    def line():
        own = draw.choice(stock).split() if draw.random() < 0.5 else [word() for _ in range(draw.randint(1, 30))]
        if draw.random() < 0.3:
            own[draw.randrange(len(own))] += "x"
        return draw.choice(["", "  "]) + " ".join(own).capitalize() + draw.choice(["", " \t"])

    texts = [None, "", "\n\n", *("\n".join(line() for _ in range(draw.randint(1, 8))) for _ in range(60))]
    want = line_brute(texts)
    rows = dedup_lines(docs(*texts)).collect()
    gone = {r.doc_id: r.lines_removed for r in rows if r.lines_removed}
    assert gone == {d: len(n) for d, n in want.items()}
    for r in rows:
        if texts[r.doc_id] is None:
            assert r.text is None
        else:
            drop = set(want.get(r.doc_id, ()))
            assert r.text == "\n".join(x for n, x in enumerate(texts[r.doc_id].split("\n")) if n not in drop)


def test_line_dedup_keeps_columns_and_rows_without_id(spark):
    line = "one two three four five six"
    rows = [(None, line, 1), (1, line, 2), (1, line, 3), (2, f"{line}\n{line}\nend", 4)]
    out = dedup_lines(spark.createDataFrame(rows, "doc_id long, text string, lines_removed int"))
    assert out.columns == ["doc_id", "text", "lines_removed"]
    assert sorted(map(tuple, out.collect()), key=str) == [(1, line, 0), (1, line, 0), (2, "end", 2), (None, line, 0)]


def test_line_groups_of_no_rows(spark):
    assert line_groups(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_short_lines_go_when_they_repeat(docs):
    """Equal lines of any length, and near ones of scripts without spaces."""
    han = "".join(chr(0x4E00 + k * 37 % 5000) for k in range(60))
    texts = ["All rights reserved.\n\nYes", "own\nall RIGHTS reserved. \n\n yes", han, han[:-1] + "x", "Yes!", "all rights reserved"]
    rows = {r.doc_id: (r.lines_removed, r.text) for r in dedup_lines(docs(*texts)).collect()}
    assert rows == {
        0: (0, texts[0]), 1: (2, "own\n"), 2: (0, han), 3: (1, ""), 4: (0, "Yes!"), 5: (1, ""),
    }


def test_short_lines_of_enough_similarity_go(docs):
    """Few characters more at an end, and a repeated stretch that adds no shingle."""
    pairs = [("Contact us now", "Contact us now."), ("read all of it", "read all of it!"), ("a" * 12, "a" * 15), ("ten chars1", "no ten chars1")]
    texts = [x for pair in pairs for x in pair]
    rows = dedup_lines(docs(*texts)).orderBy("doc_id").collect()
    assert [r.lines_removed for r in rows] == [0, 1, 0, 1, 0, 1, 0, 0]


def test_pairs_that_cannot_link_are_told_by_their_keys():
    """``enough`` holds for every pair that links, whatever the sizes."""
    draw = np.random.default_rng(8)
    for _ in range(300):
        base = np.unique(draw.integers(0, 5000, draw.integers(1, 400)))
        a, b = (np.unique(np.append(base[draw.random(len(base)) < draw.choice([0.9, 0.97, 1])], draw.integers(0, 5000, draw.integers(0, 9)))) for _ in "ab")
        if not len(a) or not len(b) or 100 * len(np.intersect1d(a, b)) < 90 * len(np.union1d(a, b)):
            continue
        first = [x[: len(x) + (-90 * len(x) // 100) + 1 + len(x) // 32] for x in (a, b)]
        shared = np.array([len(np.intersect1d(*first))])
        assert setlinks.enough(np.array([len(a)]), len(b), shared, 90, 32).all()


def test_keys_of_several_sets_are_found_by_one_shuffle(spark):
    rows = [(1, 5, 2), (1, 3, 2), (1, 5, 2), (2, 7, 2), (2, 7, 2), (3, 9, 2), (3, -4, 2), (3, 8, 2)]
    lists = setlinks._shared_lists(spark.createDataFrame(rows, "key long, node long, n int"))
    plan = lists._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Join" not in plan
    assert sorted((r.key, r.node, r.hub) for r in lists.collect()) == [(1, 3, 3), (1, 5, 3), (3, -4, -4), (3, 8, -4), (3, 9, -4)]


def test_small_blocks_of_lines_are_compared_together(monkeypatch):
    monkeypatch.setattr(line_dedup, "_alike", lambda *_: pytest.fail("one block by itself"))
    lines = [b"the same line of text", b"the same line of text!", b"quite another one", b"the same line of text", b"nothing like it at all"]
    a, b = line_dedup._linked_lines(pa.array(lines, pa.binary()), np.array([0, 3, 4, 5]), np.arange(5), 80, 8)
    assert list(zip(a.tolist(), b.tolist(), strict=True)) == [(0, 1)]


def test_frequent_shingles_stand_out_among_many_rare_ones(docs):
    texts = [" ".join([f"w{i}x{k}" for k in range(150)] + [f"often{k}" for k in range(20)] * (i < 4)) for i in range(2000)]
    source = docs(*texts).selectExpr("doc_id AS id", "text")
    seen = stored(jaccard_join._scan_sets(source, source.schema["id"].dataType, 3, jaccard_join.SKETCH_BITS), "test-sets")
    levels = jaccard_join._frequency_levels(seen, jaccard_join.SKETCH_BITS)
    four = 4 * np.log2(4) + 1
    assert (levels >= four).mean() < 0.01
