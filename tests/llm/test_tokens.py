"""Token files and packing against the tokenizers library itself."""

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from mercaloom.llm import common, mixture_packing, token_files, tokens
from tests.llm.conftest import ODD_TEXTS

LIBRARY = Tokenizer.from_file(tokens.vocabulary_path())
OWN = tokens.Encoder(tokens.vocabulary_path())


def ids_of(text):
    return np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 0], "<u4")


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("ab .,'\n\t  é漢🙂19<|>\0"), max_size=30), max_size=5))
def test_remembered_words_give_the_ids_of_the_library(texts):
    flat, ends = OWN.encode(texts)
    found = [x.tolist() for x in np.split(flat, ends)[:-1]]
    assert found == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]


def test_slices_change_nothing():
    texts = ["a b c d e a b a", "f g h\n", "", "\na b, c\n\n", "x", "a  a", "<|endoftext|> b", "don't 12 é漢\t", "a b"]
    want = [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    for step in (1, 2, len(texts)):
        found = []
        for i in range(0, len(texts), step):
            flat, ends = OWN.encode(texts[i : i + step])
            found += [x.tolist() for x in np.split(flat, ends)[:-1]]
        assert found == want


def test_pieces_are_asked_for_once(monkeypatch):
    own, asked = tokens.Encoder(tokens.vocabulary_path()), []
    find = own._ids_of_pieces
    monkeypatch.setattr(own, "_ids_of_pieces", lambda pieces: asked.append(len(pieces)) or find(pieces))
    texts = [f"{' '.join(f'word{chr(97 + i)}' for i in range(26))} and {k}" for k in "xyz"]
    for text in texts + texts[:1]:
        flat, _ = own.encode([text])
        assert flat.tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
    assert asked == [28, 1, 1, 0]


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "REMEMBERED", 5)
    own = tokens.Encoder(tokens.vocabulary_path())
    for text in ("a b c", "d e f g h i j", "", "a " + "x" * 1000, "h i x y", "b j h"):
        flat, _ = own.encode([text])
        assert flat.tolist() == LIBRARY.encode(text, add_special_tokens=False).ids
        assert len(own.met.strings) <= 5 and len(own.met.ids) == len(own.met.strings)
    assert max(map(len, own.met.strings.to_pylist())) <= tokens.LONGEST


def test_gathered_batches_hold_all_rows():
    rows = ["x" * n for n in (1, 50, 300, 2, 2, 2, 1000, 0)]
    batches = [pa.RecordBatch.from_arrays([pa.array(rows[i : i + 3])], ["text"]) for i in (0, 3, 6)]
    found = [b.column(0).to_pylist() for b in common.gathered(batches, "text", 200)]
    assert sum(found, []) == rows and all(sum(map(len, x)) <= 200 or len(x) == 1 for x in found)
    assert list(common.gathered([], "text", 200)) == []


def test_token_files(spark, odd):
    path = common.shared_path(spark, "test-tokens")
    token_files.write_token_files(odd.withColumn("ids", odd["doc_id"]).withColumn("part", odd["text"]), path)
    found = sorted((r.doc_id if r.doc_id is not None else -1, r.start, r.n_tokens, r.ids_crc32) for r in token_files.digest(token_files.read_token_files(spark, path)).collect())
    want, at = [], 0
    for doc_id, text in sorted(ODD_TEXTS, key=lambda r: (-1 if r[0] is None else r[0], r[1] or "")):
        ids = ids_of(text)
        want.append((-1 if doc_id is None else doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    assert found == want


def test_empty_table(spark, documents):
    path = common.shared_path(spark, "test-tokens")
    token_files.write_token_files(documents(), path)
    assert token_files.read_token_files(spark, path).count() == 0
    assert mixture_packing.pack(documents()).count() == 0


def pieces_are_whole(rows, texts, length):
    """Every id of every text in one piece, every sequence without a gap and full but the last."""
    sequences, by_doc = defaultdict(list), defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        by_doc[r.doc_id].append((r.start, r.length, r.ids_crc32, r.doc_tokens))
    for number, parts in sequences.items():
        parts.sort()
        at = 0
        for offset, n in parts:
            assert offset == at and n > 0
            at += n
        assert at == length or number == max(sequences)
    assert sorted(sequences) == list(range(len(sequences)))
    for doc_id, text in texts:
        ids, at = ids_of(text), 0
        for start, n, crc, whole in sorted(by_doc[doc_id]):
            assert start == at and whole == len(ids) and crc == zlib.crc32(ids[start : start + n].tobytes())
            at += n
        assert at == len(ids)


@pytest.mark.parametrize("targets", [None, {"a": 0.7, "b": 0.1}])
def test_packing(documents, targets):
    rng = np.random.default_rng(5)
    texts = [(i, " ".join("word%d" % x for x in rng.integers(0, 50, rng.integers(0, 120)))) for i in range(60)] + [(99, None)]
    docs = documents(*((i, t, "en", [None, "a", "a", "a", "b", "c"][i % 6]) for i, t in texts))
    rows = mixture_packing.pack(docs, length=64, targets=targets).collect()
    pieces_are_whole(rows, texts, 64)
    if targets is None:
        return
    # while all queues last, every window holds the targets to within a token or two
    source = {i: [None, "a", "a", "a", "b", "c"][i % 6] for i, _ in texts}
    held = defaultdict(int)
    for r in rows:
        if r.sequence_id < 3:
            held[source[r.doc_id]] += r.length
    assert held["a"] > 4 * held["b"] > 0


def test_packing_of_odd_texts(odd):
    rows = mixture_packing.pack(odd).collect()
    assert sum(r.length for r in rows) == sum(len(ids_of(t)) for _, t in ODD_TEXTS)
    with_ids = mixture_packing.pack(odd, with_ids=True).collect()
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in with_ids)


def test_served_order_is_one_order():
    """The closed form against a round-robin that serves the most indebted queue."""
    sizes, weights = np.array([7, 20, 3, 11]), np.array([5, 9, 1, 5])
    done, order = np.zeros(4, int), []
    for _ in range(sizes.sum()):
        open_ = [q for q in range(4) if done[q] < sizes[q]]
        q = min(open_, key=lambda q: ((2 * done[q] + 1) / weights[q], q))
        order.append(q)
        done[q] += 1
    for q in range(4):
        places = [i for i, x in enumerate(order) if x == q]
        assert mixture_packing.merged_place(q, np.arange(sizes[q]), sizes, weights).tolist() == places
        upto = np.arange(sizes.sum() + 1)
        assert mixture_packing.served(q, upto, sizes, weights).tolist() == [order[:n].count(q) for n in upto]


def test_places_beyond_64_bits_of_products():
    """Twenty terabytes of tokens and more: the same places by whole numbers of any size."""
    for sizes in ([2 * 10**13, 5, 10**12], [10**14, 10**14, 3], [3 * 10**17, 1]):
        sizes = np.array(sizes)
        for weights in (mixture_packing.target_weights(sizes), np.array([1, 1 << 20, 7])[: len(sizes)], np.array([1 << 20, 1, 3])[: len(sizes)]):
            total = int(sizes.sum())
            for q, size in enumerate(sizes.tolist()):
                k = np.unique(np.clip(np.array([0, 1, size // 3, size // 2 + 1, size - 2, size - 1]), 0, size - 1))
                want = []
                for token in k.tolist():
                    place, own = 0, int(weights[q])
                    for other, (n, w) in enumerate(zip(sizes.tolist(), weights.tolist())):
                        x = (2 * token + 1) * w - own
                        place += min(max(x // (2 * own) + 1 if other < q else -(-x // (2 * own)), 0), n)
                    want.append(place)
                assert mixture_packing.merged_place(q, k, sizes, weights).tolist() == want
                places = np.array([0, 1, total // 7, total // 2, total - 1, total])
                got = mixture_packing.served(q, places, sizes, weights)
                for place, n in zip(places.tolist(), got.tolist()):
                    near = np.array([i for i in (n - 1, n) if 0 <= i < size])
                    below = mixture_packing.merged_place(q, near, sizes, weights) < place
                    assert dict(zip(near.tolist(), below.tolist())) == {i: i < n for i in near.tolist()}
