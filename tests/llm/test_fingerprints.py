import hashlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from basketry.llm import fingerprints as fp
from tests.llm import fixtures


def slow_chunks(data):
    """Chunk ends of one text, byte by byte."""
    ends, start = [], 0
    while start < len(data):
        end = start
        while True:
            end += 1
            n = end - start
            if end == len(data) or n == fp.LONGEST:
                break
            if n < fp.SHORTEST:
                continue
            h = 0
            for b in data[end - 32:end]:
                h = (h << 1) + int(fp._GEAR[b]) & 0xFFFFFFFF
            h >>= 20
            if h & (fp._STRICT if n < fp.WANTED else fp._LOOSE) == 0:
                break
        ends.append(end)
        start = end
    return ends


@settings(max_examples=30, deadline=None)
@given(st.lists(st.binary(max_size=900), max_size=4))
def test_boundaries(texts):
    raw = np.frombuffer(b"".join(texts), np.uint8)
    offsets = np.cumsum([0] + [len(t) for t in texts])
    text, start, end = fp.boundaries(raw, offsets)
    for k, data in enumerate(texts):
        assert sorted((end[text == k] - offsets[k]).tolist()) == slow_chunks(data)


def test_an_insertion_changes_few_chunks():
    text = fixtures.prose(1, 2000)
    a, b = fp._of([text, text[:3000] + "inserted words " + text[3000:]])
    assert fp.containment(a, b) > 0.95
    assert fp.containment(a, a) == 1


def test_documents_against_plain_python(spark):
    docs = fixtures.edges(spark)
    rows = sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()),
                  key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    got = fixtures.rows(fp.compare_edited(docs))
    expected = []
    for (doc_id, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        changed = fp.edited(text, after)
        own, new, other = fp._of([text, changed, after])
        expected.append((
            str(doc_id), len(text), hashlib.sha256(changed.encode()).hexdigest(),
            own.tobytes().hex(), new.tobytes().hex(), fp.containment(own, new),
            fp.containment(own, other)))
    assert sorted((str(r["doc_id"]), *(r[c] for c in (
        "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
        "near_next"))) for r in got) == sorted(expected)


def test_one_row_follows_itself_and_empty_table(spark):
    got = fp.compare_edited(fixtures.table(spark, ["abcdef" * 40])).collect()
    assert len(got) == 1 and got[0]["near_next"] == 1
    assert fp.compare_edited(fixtures.empty(spark)).count() == 0
