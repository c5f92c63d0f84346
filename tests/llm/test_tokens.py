import json
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lexmill.llm import store, tokens

PATH = tokens.default_tokenizer()
TRICKY = [
    "", "  a  b\n\n c   d", "it's we'll  <|endoftext|> x<|endoftext|>y \t\n z ", "é è  x", " lead", "x\x1cy \x1c z \x85 q\u0085 r", "\x00 a \x1f b",
    "a.b,c;d: e!?f)g (h) 1.5 v2.0,x", "À-la ×3 ÷ naïve… ok…, word—dash", "漢字 かな　space em", "tail  ", "\n", "Word's 'quoted' O'Neil's", "aaaa" * 500,
]


def plain(texts):
    return [e.ids + [0] for e in tokens._tokenizer(PATH).encode_batch([t or "" for t in texts], add_special_tokens=False)]


def split(ids, starts):
    return [ids[a:b].tolist() for a, b in zip(starts[:-1], starts[1:])]


def test_ids_are_the_tokenizers_own():
    texts = TRICKY + [None]
    assert split(*tokens.token_ids(pa.array(texts), PATH, 0)) == plain(texts)


@settings(deadline=None, max_examples=200)
@given(st.lists(st.text(st.sampled_from("ab'sS .,!?)\n\t  é×÷1漢|<>_…"), max_size=30), min_size=1, max_size=5))
def test_ids_of_any_text(texts):
    assert split(*tokens.token_ids(pa.array(texts, pa.string()), PATH, 0)) == plain(texts)


@pytest.mark.parametrize("change", [None, {"pre_tokenizer": {"type": "ByteLevel", "add_prefix_space": True, "trim_offsets": True, "use_regex": True}}, {"normalizer": {"type": "Lowercase"}}])
def test_ids_of_other_tokenizers(tmp_path, change):
    path = PATH.replace("byte_bpe_50k", "word_bpe_49k")
    if change:
        path = str(tmp_path / "t.json")
        with open(PATH) as f, open(path, "w") as g:
            json.dump(json.load(f) | change, g)
    texts = ["Hello World café", "hello, world", "", "Hello World café", *TRICKY]
    want = [e.ids + [0] for e in tokens._tokenizer(path).encode_batch(texts, add_special_tokens=False)]
    assert not tokens._cuttable(path) and tokens._cuttable(PATH)
    assert split(*tokens.token_ids(pa.array(texts), path, 0)) == want


def test_random_access(tmp_path):
    rng = np.random.default_rng(1)
    ids = np.where(rng.random(5000) < 0.4, rng.integers(0, 256, 5000), rng.integers(0, 1 << 20, 5000)).astype(np.uint32)
    starts = np.array([0, 0, 1200, 5000])
    uri = f"{tmp_path}/x.dac"
    store.put(uri, *tokens.encode_file(ids, starts, np.array([3, 4, 9]), np.array([True, False, True])))
    file = tokens.TokenFile(uri)
    assert len(file.levels) == 3
    assert [file.token(i) for i in range(0, 5000, 7)] == ids[::7].tolist()
    for a, b in np.sort(rng.integers(0, 5001, (80, 2))):
        assert (file.slice(int(a), int(b)) == ids[a:b]).all()
    docs, present, at = file.directory()
    assert docs.tolist() == [3, 4, 9] and present.tolist() == [True, False, True] and at.tolist() == starts.tolist()
    with pytest.raises(IndexError):
        file.token(5000)


def test_written_and_read_back(documents, odd_texts, monkeypatch):
    monkeypatch.setattr(tokens, "FILE_IDS", 100)
    rows = [(i, t) for i, t in odd_texts if i != 7] + [(100 + i, t) for i, t in enumerate(TRICKY)]
    manifest = tokens.write_tokens(documents(rows), PATH, 0)
    got = tokens.read_tokens(manifest).orderBy("start").collect()
    want = {i: sorted(plain([t for k, t in rows if k == i])) for i, _ in rows}
    assert len(got) == len(rows)
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert keys == sorted(keys) and [r.start for r in got] == np.cumsum([0] + [r.n_tokens for r in got])[:-1].tolist()
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    for i in want:
        assert sorted((r.n_tokens, r.ids_crc32) for r in got if r.doc_id == i) == sorted((len(x), crc(x)) for x in want[i])
    whole = tokens.read_documents(manifest).collect()
    assert sorted((repr(r.doc_id), r.ids) for r in whole) == sorted((repr(i), x) for i in want for x in want[i])
    assert tokens.read_tokens(tokens.write_tokens(documents([]), PATH, 0)).collect() == []
