import pyarrow as pa

from basketry.llm import texts


def test_memory_of_others_is_given_back(monkeypatch):
    given = []
    monkeypatch.setattr(texts, "_held", {})
    monkeypatch.setattr(texts, "_release", lambda release=texts._release: given.append(release()))
    batch = pa.record_batch([pa.array(["a", None])], ["text"])
    texts.held("one", dict)
    assert [p.num_rows for p in texts.slices(iter([batch]), "text", keep="one")] == [2]
    assert not given and list(texts._held) == ["one"]
    assert [p.num_rows for p in texts.slices(iter([batch]), "text")] == [2]
    assert len(given) == 1 and not texts._held
    list(texts.slices(iter([batch]), "text"))
    assert len(given) == 1
