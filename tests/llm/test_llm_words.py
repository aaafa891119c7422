import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemill.llm import pretokens, token_counts, token_files, words
from tidemill.llm.shared import text_slices

SIGNS = "ab 's't re'll'd  \n\t\r\x0b.,!é1٣٢中文 　'm 've\x85​theaaa===-🙂 İ"
TEXT = st.text(alphabet=SIGNS, max_size=60)


def large(texts):
    return pa.array(texts, pa.large_string())


@given(st.lists(TEXT, max_size=20))
@settings(max_examples=60, deadline=None)
def test_shingles_are_the_distinct_runs_of_five_words(texts):
    found = list(words.shingles(large(texts)))
    assert [len(x) for x in found] == [len(words.shingle_texts(t)) for t in texts]
    for a, x in zip(texts, found):
        for b, y in zip(texts, found):
            assert len(np.intersect1d(x, y)) == len(words.shingle_texts(a) & words.shingle_texts(b))


def test_words_split_only_at_ascii_blanks_and_fold_only_ascii():
    assert words.shingle_texts("A\x0bÉ b") == {"a É b".encode()}
    assert words.shingle_texts("") == set() and words.shingle_texts(" \t") == set()
    assert len(words.shingle_texts("a b c d")) == 1 and len(words.shingle_texts("a b c d e f")) == 2


def test_words_longer_than_a_block(monkeypatch):
    rng = random.Random(2)
    texts = ["".join(rng.choice("ab  c\n") for _ in range(rng.randint(0, 90))) + "z" * rng.choice([0, 70]) for _ in range(60)]
    whole = words.words(large(texts))
    monkeypatch.setattr(words, "BLOCK", 16)
    cut = words.words(large(texts))
    assert (whole[0] == cut[0]).all() and (whole[1] == cut[1]).all()


@given(st.lists(TEXT, max_size=20))
@settings(max_examples=100, deadline=None)
def test_pretokens_follow_the_pattern(texts):
    pattern = regex.compile(public_tokenizers.PATTERN)
    s = pretokens.split(texts)
    found = [[] for _ in texts]
    for a, b, o in zip(s.starts, s.ends, s.owner):
        found[o].append(s.joined[a:b])
    assert found == [pattern.findall(t) for t in texts]


def test_known_numbers_survive_the_move_to_the_sorted_array():
    known = pretokens.Known(most=50, recent=4)
    h = np.arange(1, 41, dtype=np.uint64) * np.uint64(977)
    for i in range(0, 40, 3):
        known.put(h[i : i + 3], np.arange(i, min(i + 3, 40)))
    assert known.get(h).tolist() == list(range(40)) and known.get(h + np.uint64(1)).max() == -1


def test_counts_and_ids_equal_the_library():
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    library = Tokenizer.from_file(path)
    rng = random.Random(4)
    texts = ["".join(rng.choice(SIGNS) for _ in range(rng.randint(0, 50))) for _ in range(500)]
    texts += ["", "a" * 3000, "=" * 777, "the <|endoftext|> x  <|endoftext|>  ", "<|endoftext|>", "   ", "x<|endoftext|>'s <|endofte", " " * 50 + "a", "ab" * 2000]
    expected = [library.encode(t, add_special_tokens=False).ids for t in texts]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts))), pa.array(texts)], ["doc_id", "text"])
    counted = pa.Table.from_batches(list(token_counts._counted(path)(iter([batch]))))
    assert counted["n_tokens"].to_pylist() == [len(e) for e in expected]
    assert counted["n_bytes"].to_pylist() == [len(t.encode()) for t in texts]
    encode = token_files.Encoder(path)
    for most in (1, 100, 1000):  # whatever was met before
        for i in range(0, len(texts), most):
            ids, first = encode(texts[i : i + most])
            assert [ids[a:b].tolist() for a, b in zip(first[:-1], first[1:])] == expected[i : i + most]
            if most == 100:
                encode.clear()


def test_slices_cover_all_rows_and_read_null_as_empty():
    texts = ["x" * n for n in (5, 0, 900, 3)] + [None, "é"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(texts)], ["doc_id", "text"])
    parts = list(text_slices([batch, batch.slice(0, 0)], "text", 10))
    assert [x for p in parts for x in p.column(0).to_pylist()] == list(range(6))
    assert [x for p in parts for x in p.column(1).to_pylist()] == [t or "" for t in texts]
    for p in parts:
        raw, offsets = words.utf8(p.column(1))
        assert [bytes(raw[a:b]).decode() for a, b in zip(offsets[:-1], offsets[1:])] == p.column(1).to_pylist()
