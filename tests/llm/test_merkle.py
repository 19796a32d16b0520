import hashlib
import random
from collections import Counter

import pytest

from cargolens.llm import merkle

TEXT = "\n".join(f"Paragraph {i} has one sentence. And a second one, number {i * i}." for i in range(40))


def successors(rows):
    """Rows in descending order of id, each with the next one's text; rows of one id in either order."""
    own = sorted(((-1 if i is None else i, i, t or "") for i, t, *_ in rows), reverse=True, key=lambda r: r[0])
    return own


def test_query_against_brute_force(spark, edge_dir, rows):
    found = merkle.op8_fingerprints(spark, edge_dir).collect()
    assert len(found) == len(rows)
    own = successors(rows)
    texts = {}
    for key, _, text in own:
        texts.setdefault(key, []).append(text)
    order = list(texts)
    for r in found:
        key = -1 if r.doc_id is None else r.doc_id
        following = texts[order[(order.index(key) + 1) % len(order)]] + (texts[key] if len(texts[key]) > 1 else [])
        options = []
        for text in texts[key]:
            for after in following:
                new = merkle.edited(text, after)
                a, b, c = merkle.Tree(text), merkle.Tree(new), merkle.Tree(after)
                digest = hashlib.sha256(new.encode()).hexdigest()
                options.append((len(text), digest, a.fingerprint(), b.fingerprint(), merkle.likeness(a, b), merkle.likeness(a, c)))
        assert tuple(r)[1:7] in options


def test_ranges_do_not_change_successors(spark, unique_dir, monkeypatch):
    whole = sorted(map(tuple, merkle.op8_fingerprints(spark, unique_dir).collect()))
    monkeypatch.setattr(merkle, "RANGE_ROWS", 3)
    assert sorted(map(tuple, merkle.op8_fingerprints(spark, unique_dir).collect())) == whole


def test_edited_text_follows_the_contract():
    assert merkle.edited("abcdefg", "XYZ") == "abcdeXY"
    assert merkle.edited("abcdefghi", "X") == "abcdefX"
    assert merkle.edited("ab", "XYZ") == "ab"
    assert merkle.edited("", "XYZ") == ""


@pytest.mark.parametrize("text", ["", "a", "\n", "\n\n", "a\n\nb", "x" * 1000, "é. ü!\nß?", TEXT])
def test_spans_cover_the_text_and_equal_texts_are_equal(text):
    assert "".join(merkle.SPANS.findall(text)) == text
    assert merkle.Tree(text).fingerprint() == merkle.Tree(str(text)).fingerprint()
    assert merkle.Tree(text).root != merkle.Tree(text + "!").root
    assert merkle.likeness(merkle.Tree(text), merkle.Tree(text)) == 1.0


def test_differing_branches_locate_edits():
    changed = TEXT.replace("Paragraph 17 has", "Paragraph seventeen had")
    (start, end), = merkle.edits(TEXT, changed)
    assert "seventeen had" in changed[start:end] and end - start < 80
    assert merkle.edits(TEXT, TEXT) == []
    assert merkle.edits("", "new") == [(0, 3)]
    assert 0.95 < merkle.likeness(merkle.Tree(TEXT), merkle.Tree(changed)) < 1


def test_likeness_counts_shared_spans():
    a, b = merkle.Tree("one. two. three."), merkle.Tree("one. two. four. five.")
    assert merkle.likeness(a, b) == 2 / 4
    assert merkle.likeness(merkle.Tree(""), merkle.Tree("x")) == 0.0
    moved = "\n".join(reversed(TEXT.split("\n")))
    assert merkle.likeness(merkle.Tree(TEXT), merkle.Tree(moved)) > 0.9


def test_single_row_follows_itself(spark):
    docs = spark.createDataFrame([(5, "one two three. four five six.")], "doc_id long, text string")
    r = merkle.fingerprints(docs).first()
    assert r.near_next == 1.0 and r.edited_sha256 == hashlib.sha256(merkle.edited(*["one two three. four five six."] * 2).encode()).hexdigest()


def test_empty_table_and_clashing_columns(spark, empty_dir, clashing):
    assert merkle.op8_fingerprints(spark, empty_dir).count() == 0
    assert merkle.fingerprints(clashing).count() == 20


def rebuilt(old, new, found):
    """The new text from the old one and the changed ranges."""
    parts, at, put = [], 0, 0
    for a, b, c, d in found:
        assert at <= a <= b and put <= c <= d and old[at:a] == new[put:c]
        parts += [old[at:a], new[c:d]]
        at, put = b, d
    return "".join([*parts, old[at:]])


def test_changes_turn_one_text_into_the_other():
    pick = random.Random(2)
    words = ["one. ", "two! ", "three", "\n", "\n\n", "é? ", "x" * 200, " and ", "Same line.\n"]
    for _ in range(400):
        old = [pick.choice(words) for _ in range(pick.randrange(60))]
        new = list(old)
        for _ in range(pick.randrange(4)):
            at = pick.randrange(len(new) + 1)
            new[at : at + pick.randrange(3)] = [pick.choice(words) for _ in range(pick.randrange(3))]
        if pick.random() < 0.2:
            pick.shuffle(new)
        old, new = "".join(old), "".join(new)
        found = merkle.changes(merkle.Tree(old), merkle.Tree(new))
        assert rebuilt(old, new, found) == new and (found == []) == (old == new)


def test_changes_are_small_and_see_moves():
    lines = TEXT.split("\n")
    swapped = "\n".join([*lines[:10], lines[11], lines[10], *lines[12:]])
    found = merkle.changes(merkle.Tree(TEXT), merkle.Tree(swapped))
    assert found and sum(d - c for _, _, c, d in found) < 150
    without = "\n".join(lines[:20] + lines[21:])
    assert [(a, b, c, d) for a, b, c, d in merkle.changes(merkle.Tree(TEXT), merkle.Tree(without)) if c == d] == [
        (TEXT.index(lines[20]), TEXT.index(lines[21]), TEXT.index(lines[20]), TEXT.index(lines[20]))
    ]


def counted_likeness(left, right):
    """From two fingerprints' own characters: sections, then paragraphs, then spans that both have."""
    if left.split(";")[0] == right.split(";")[0]:
        return 1.0
    a, b = (Counter(f.split(";")[1:]) for f in (left, right))
    size = [sum(len(x.replace(",", "")) // 16 for x in f.split(";")[1:]) for f in (left, right)]
    shared = 0
    for cut in (lambda x: x.split(","), lambda x: [x[i : i + 16] for i in range(0, len(x), 16)], None):
        both = a & b
        shared += sum(n * len(x.replace(",", "")) // 16 for x, n in both.items())
        if cut:
            a, b = (Counter(y for x in (f - both).elements() for y in cut(x)) for f in (a, b))
    return min(shared / max(size), 1.0)


def test_likeness_follows_from_the_fingerprints(spark, edge_dir, rows):
    found = merkle.op8_fingerprints(spark, edge_dir).collect()
    of_text = {}
    for i, text, *_ in rows:
        of_text.setdefault(i, set()).add(text or "")
    for r in found:
        assert r.near_edited == pytest.approx(counted_likeness(r.fingerprint, r.edited_fingerprint))
        a, b = (merkle.Tree.of_fingerprint(f) for f in (r.fingerprint, r.edited_fingerprint))
        assert merkle.likeness(a, b) == r.near_edited and a.fingerprint() == r.fingerprint
        # what is kept of the text, and what is changed, gives the edited text again
        hits = 0
        for text in of_text[r.doc_id]:
            kept = len(text) - len(text) // 3
            hits += all(c["old_to"] <= len(text) and c["new_from"] <= r.n_chars for c in r.changes) and all(
                c["new_to"] >= kept - merkle.SPAN for c in r.changes
            )
        assert hits
