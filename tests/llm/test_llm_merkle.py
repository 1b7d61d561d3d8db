"""Merkle fingerprints against a plain loop over the sorted table, and the tree's own promises."""

import hashlib
import random
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import merkle as M
from basketry.llm.common import table

SF = "/root/testdata/sf0.001"


def plain_fingerprint(raw):
    """The fingerprint written out level by level, without the module's tree."""
    h = lambda x: hashlib.blake2b(x, digest_size=16).digest()
    paragraphs, leaves = [], []
    pieces = re.findall(rb"[^.!?\n]{1,160}[^.!?\s]*[.!?\s]*|[.!?\s]+", raw)
    for n, piece in enumerate(pieces):
        leaves.append(h(piece))
        if b"\n" in piece or n + 1 == len(pieces):
            paragraphs.append((leaves, piece.count(b"\n") > 1 or n + 1 == len(pieces)))
            leaves = []
    sections, open_ = [], []
    for leaves, last in paragraphs:
        open_.append(leaves)
        if last or h(b"".join(leaves))[0] % 8 == 0:
            sections.append((h(b"".join(h(b"".join(p)) for p in open_)), open_))
            open_ = []
    root = h(b"".join(d for d, _ in sections))
    return root.hex() + ":" + ";".join(d.hex()[:16] + "=" + ",".join("".join(x.hex()[:8] for x in p) for p in ps) for d, ps in sections)


def patched(text, edited, spans):
    """The text with each span replaced by the edited text's: must be the edited text."""
    raw, new, out, at = text.encode(), edited.encode(), b"", 0
    for span in filter(None, spans.split(",")):
        (i, j), (x, y) = (map(int, s.split(":")) for s in span.split(">"))
        out, at = out + raw[at:i] + new[x:y], j
    return (out + raw[at:]).decode()


def slow(rows, order):
    """rows in order."""
    out = []
    for i, (doc_id, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[:len(text) - half] + after[:half]
        f, e, a = (plain_fingerprint(t.encode()) for t in (text, edited, after))
        spans = ",".join(f"{i}:{j}>{x}:{y}" for i, j, x, y in M.edits(M.tree(text.encode()), M.tree(edited.encode())))
        assert patched(text, edited, spans) == edited
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), f, e, M.likeness(f, e), M.likeness(f, a), spans))
    return sorted(map(str, out))


def test_query_against_plain_loop(spark):
    from basketry.llm.queries import QUERIES
    docs = sorted((tuple(r) for r in table(spark, SF, "documents").select("doc_id", "text").collect()), reverse=True)
    rows = QUERIES["op8_merkle_fingerprint"](spark, SF).collect()
    assert sorted(str(tuple(r)) for r in rows) == slow(docs, None)
    long = [r for r in rows if r.n_chars > 1000]
    assert sum(r.near_edited > r.near_next for r in long) > 0.95 * len(long)


def test_odd_rows(spark):
    rows = [(i, f"Text number {i}. It goes on.\nAnd ends!") for i in range(5, 60, 7)] + [(100, None), (101, ""), (102, "é😀. ü " * 30000)]
    df = spark.createDataFrame([(*r, 3, "x") for r in rows], "doc_id long, text string, bucket int, guest string")
    want = slow(sorted(rows, reverse=True), None)
    for parts in (1, 3, 8):
        assert sorted(str(tuple(r)) for r in M.fingerprints(df, parts=parts).collect()) == want
    twice = M.fingerprints(df.union(df), parts=4).collect()
    assert len(twice) == 2 * len(rows) and sum(r.near_next == 1 for r in twice) >= len(rows)
    nulls = spark.createDataFrame([(None, "no id"), (None, "no id"), (3, "three"), (-2**63, "lowest"), (2**63 - 1, "highest")], "doc_id long, text string")
    got = M.fingerprints(nulls, parts=3).collect()
    assert sorted(str(tuple(r)) for r in got) == slow([(2**63 - 1, "highest"), (3, "three"), (-2**63, "lowest"), (None, "no id"), (None, "no id")], None)
    assert M.fingerprints(df.limit(0)).count() == 0
    assert [r.near_next for r in M.fingerprints(df.limit(1)).collect()] == [1.0]


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab é.!?\n ", max_size=400), st.text(alphabet="ab é.!?\n ", max_size=400))
def test_trees(a, b):
    x, y = M.tree(a.encode()), M.tree(b.encode())
    assert sum(s.size for s in x.sections) == len(a.encode())
    assert x.fingerprint() == plain_fingerprint(a.encode())
    assert patched(a, b, ",".join("%d:%d>%d:%d" % e for e in M.edits(x, y))) == b
    assert bool(M.edits(x, y)) == (a != b)
    assert (x.root == y.root) == (a == b)
    assert M.likeness(x.fingerprint(), y.fingerprint()) == M.tree_likeness(x, y) == M.tree_likeness(y, x)
    assert 0 <= M.tree_likeness(x, y) <= 1


def test_an_edit_is_found():
    rng = random.Random(3)
    text = "".join(" ".join(str(rng.randint(0, 9999)) for _ in range(9)) + rng.choice([". ", ".\n", "!\n\n"]) for _ in range(300))
    at = len(text) // 3
    (start, end, _, _), = M.edits(M.tree(text.encode()), M.tree((text[:at] + "###" + text[at:]).encode()))
    assert start <= at <= end and end - start < 400
    # three edits in one text are three places, each of a few leaves
    places, new = [len(text) * k // 4 for k in (1, 2, 3)], text
    for p in reversed(places):
        new = new[:p] + "###" + new[p:]
    found = M.edits(M.tree(text.encode()), M.tree(new.encode()))
    assert len(found) == 3 and all(i <= p <= j and j - i < 400 for (i, j, _, _), p in zip(found, places, strict=True))
    assert M.likeness(M.tree(text.encode()).fingerprint(), M.tree((text[:at] + "###" + text[at:]).encode()).fingerprint()) > 0.98
