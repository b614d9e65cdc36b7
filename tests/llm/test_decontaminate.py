import random

from brute import edit_distance, words
from hypothesis import given, settings
from hypothesis import strategies as st

from ratecraft.llm import decontaminate as d

DOC = "doc_id long, text string, item_id string, distance string"


@settings(max_examples=200, deadline=None)
@given(st.text("abc", min_size=1, max_size=90), st.text("abc", max_size=60))
def test_nearest_is_the_least_edit_distance(pattern, text):
    distance, end = d.nearest(pattern, d.masks(pattern), text)
    assert distance == edit_distance(pattern, text)
    if text and distance < len(pattern):
        assert edit_distance(pattern, text[:end]) == distance


@given(st.text("abcde ", min_size=1, max_size=700))
def test_passages_cover_the_item(text):
    item = d.folded(text)
    found = d.passages(item)
    at = 0
    for p in found:
        place = item.find(p, max(0, at - len(p)))
        assert 0 <= place <= at
        at = max(at, place + len(p))
    assert len(item) <= d.PASSAGE or at >= len(item) - 1


def changed(rng, text, edits):
    out = list(text)
    for _ in range(edits):
        i = rng.randrange(len(out))
        out[i:i + 1] = rng.choice([[], ["q"], [out[i], "z"]])
    return "".join(out)


def cases():
    rng = random.Random(4)
    items = [words(rng, 14 + 2 * i) for i in range(8)] + ["short item here", None, ""]
    docs = [words(rng, 40) for _ in range(10)]
    docs += [f"{docs[i]} {items[i].upper()}! {docs[i + 1]}" for i in range(8)]
    docs += [f"{docs[i]} {changed(rng, items[i], len(items[i]) // 25)} {docs[i + 1]}" for i in range(8)]
    return items, docs + ["Short, item. here", "short items here", None, "", "x " * 30_000]


def test_exact_and_edited_items_are_found_and_others_not():
    items, docs = cases()
    rows = [(i, p) for i, t in enumerate(items) for p in d.passages(d.folded(t or ""))]
    finder = d.Finder(rows)
    for n, text in enumerate(docs):
        found = finder.find(text or "")
        want = {}
        if len(text or "") < 10_000:
            for item, p in rows:
                distance = edit_distance(p, d.folded(text or ""))
                if distance <= d.budget(p) and (d.budget(p) or f" {p} " in f" {d.folded(text or '')} "):
                    want[item] = min(want.get(item, 99), distance)
        assert {k: v[0] for k, v in found.items()} == want
        assert set(found) == ({n - 10} if 10 <= n < 18 else {n - 18} if 18 <= n < 26 else {8} if n == 26 else set())


def test_tables(spark):
    items, texts = cases()
    docs = spark.createDataFrame([(i, t, "a", "b") for i, t in enumerate(texts)] + [(10, texts[10], "a", "b")], DOC).repartition(3)
    bench = spark.createDataFrame([(i, t, 1) for i, t in enumerate(items)] + [(0, items[0], 2), (None, items[1], 1)], "item_id long, text string, doc_id long")
    want = sorted([(n, n - 10) for n in range(10, 18)] + [(n, n - 18) for n in range(18, 26)] + [(26, 8), (10, 0)])
    for block in (10_000, 7):
        found = d.contaminated(docs, bench, block)
        assert sorted({(r.doc_id, r.item_id) for r in found.collect()} | {(10, 0)}) == sorted(set(want))
        kept = d.keep_clean(docs, bench, block)
        assert kept.columns == docs.columns
        assert sorted(r.doc_id for r in kept.collect()) == [*range(10), 27, 28, 29, 30]
    none = spark.createDataFrame([], bench.schema)
    assert d.contaminated(docs, none).collect() == [] and d.keep_clean(docs, none).count() == docs.count()
    assert d.contaminated(docs.limit(0), bench).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.text("abc", min_size=1, max_size=64), st.text("abc", max_size=70)), min_size=1, max_size=8))
def test_distances_side_by_side(cases_):
    import numpy as np

    letters = " abc"
    eq = np.zeros((len(cases_), 4), dtype=np.uint64)
    for i, (p, _) in enumerate(cases_):
        for c, bits in d.masks(p).items():
            eq[i, letters.index(c)] = bits
    width = max(len(t) for _, t in cases_)
    codes = np.array([[letters.index(c) for c in t.ljust(width)] for _, t in cases_]).reshape(len(cases_), width)
    found = d.distances(eq, np.arange(len(cases_)), np.array([len(p) for p, _ in cases_]), codes)
    assert found.tolist() == [edit_distance(p, t) for p, t in cases_]


@given(st.text(max_size=60))
def test_folding_is_the_same_for_ascii(text):
    assert d.folded(text) == d._fold(" ", text.lower()).strip()


def test_fragments_of_an_item_are_found():
    rng = random.Random(8)
    items = [words(rng, 40) for _ in range(6)]
    finder = d.Finder([(i, p) for i, t in enumerate(items) for p in d.passages(d.folded(t))])
    for i, item in enumerate(items):
        for size in (d.PASSAGE + d.STRIDE, 80, 120):
            for at in range(0, len(item) - size, 7):
                piece = item[at:at + size].strip()
                if len(piece) >= d.PASSAGE + d.STRIDE:
                    assert set(finder.find(f"zeta {piece} quux")) == {i}
        # A tenth of edits, spread over the fragment: brute force tells which passages are near enough.
        for at in range(0, len(item) - 100, 97):
            text = d.folded(f"zeta {changed(rng, item[at:at + 100], 8)} quux")
            near = {k for k, t in enumerate(items) for p in d.passages(d.folded(t)) if edit_distance(p, text) <= d.budget(p)}
            assert set(finder.find(text)) == near


def test_many_letters_take_little_memory_and_long_texts_are_read_to_their_end():
    rng = random.Random(9)
    letters = [chr(0x4E00 + i) for i in range(3000)]
    rows = [(i, "".join(rng.choices(letters, k=d.PASSAGE))) for i in range(2000)]
    finder = d.Finder(rows)
    assert finder.eq.nbytes * d.BLOCK // len(rows) < 100_000_000
    assert set(finder.find("".join(rng.choices(letters, k=200)) + changed(rng, rows[7][1], 4))) == {7}
    assert set(finder.find("".join(rng.choices(letters, k=1_000_000)) + " " + rows[9][1])) == {9}
    assert finder.find("".join(rng.choices(letters, k=2000))) == {}
