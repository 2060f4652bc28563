"""Token alignment against the two libraries and a plain comparison of all token ranges."""

import hashlib
import random
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from mercaloom.llm import token_alignment, tokens
from tests.llm.conftest import ODD_TEXTS

BYTE_PATH = tokens.vocabulary_path(token_alignment.BYTE_VOCABULARY)
PIECE_PATH = tokens.vocabulary_path(token_alignment.PIECE_VOCABULARY)
LIBRARY = Tokenizer.from_file(BYTE_PATH)
LIBRARY.encode_special_tokens = True
PIECES = sentencepiece.SentencePieceProcessor(model_file=PIECE_PATH)
LETTERS = {letter: b for b, letter in tokens._byte_letters().items()}
OWN = token_alignment.Aligner(token_alignment.Vocabularies(BYTE_PATH, PIECE_PATH))


def bytes_of_piece(name):
    return bytes([int(name[3:5], 16)]) if len(name) == 6 and name.startswith("<0x") else name.replace("▁", " ").encode()


def plain(text):
    """Ids of both sides, groups as text and linked pairs of one text, whole and by comparing all ranges."""
    if not text:
        return [], [], "", []
    a = LIBRARY.encode(" " + text, add_special_tokens=False)
    parts_a = [bytes(LETTERS[c] for c in token) for token in a.tokens]
    b = PIECES.encode(text)
    parts_b = [bytes_of_piece(PIECES.id_to_piece(i)) for i in b]
    if not b"".join(parts_a) == b"".join(parts_b) == (" " + text).encode():
        return [], [], "", []

    def ranges(parts):
        at, out = 0, []
        for p in parts:
            out.append((at, at + len(p)))
            at += len(p)
        return out

    of_a, of_b = ranges(parts_a), ranges(parts_b)
    both = sorted({e for _, e in of_a} & {e for _, e in of_b})
    groups, start = [], 0
    for end in both:
        groups.append("|".join(",".join(str(i) for i, r in zip(ids, spans) if start < r[1] <= end) for ids, spans in ((a.ids, of_a), (b, of_b))))
        start = end
    links = [(i, j) for i, r in zip(a.ids, of_a) for j, q in zip(b, of_b) if r[0] < q[1] and q[0] < r[1]]
    return a.ids, b, ";".join(groups), links


def expected(texts):
    found = [plain(t) for t in texts]
    counts = Counter(pair for x in found for pair in x[3])
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    return [
        (
            len(a), len(b), groups.count(";") + 1 if a else 0, len(links), sum(counts[p] == best[p[1]] for p in links),
            sum(counts[p] for p in links), hashlib.sha256(groups.encode()).hexdigest() if a else "",
        )
        for a, b, groups, links in found
    ]


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def found_by(df):
    return sorted((str(r.doc_id), *(r[c] for c in COLUMNS)) for r in df.collect())


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from("abthe .,'\n\t  é漢🙂19<|>\0▁"), max_size=30), max_size=4))
def test_groups_are_those_of_whole_texts(texts):
    units = OWN.place_all(texts)
    for text, found in zip(texts, units):
        a, b, groups, links = plain(text)
        assert (OWN.groups_of(found).decode() if OWN.is_whole(found) else "") == groups
        if a:
            assert OWN.counts[found].sum(0).tolist() == [len(a), len(b), groups.count(";") + 1, len(links)]
            pairs = np.concatenate([OWN.pairs[OWN.ends[u] : OWN.ends[u + 1]] for u in found])
            assert Counter(pairs.tolist()) == Counter(i * len(OWN.v.bytes_b) + j for i, j in links)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 500), min_size=1, max_size=60, unique=True), st.data())
def test_gallop_finds_the_first_that_is_not_below(values, data):
    target = np.array(sorted(values))
    x = np.array(data.draw(st.lists(st.integers(-5, int(target[-1])), min_size=1, max_size=20)))
    start = np.array(data.draw(st.lists(st.integers(0, len(target) - 1), min_size=len(x), max_size=len(x))))
    lo, hi = np.zeros(len(x), int), np.full(len(x), len(target))
    assert token_alignment.gallop(x, target, lo, hi, start).tolist() == np.searchsorted(target, x).tolist()


def test_special_tokens_and_their_strings_are_text():
    for text in ("<|endoftext|>", "a <|endoftext|> b", "</s><s> <unk>", "x▁y", "▁", " ", "  a", "end "):
        found = OWN.place_all([text])[0]
        assert (OWN.groups_of(found).decode() if OWN.is_whole(found) else "") == plain(text)[2]


def test_alignment_of_odd_texts(spark, odd, monkeypatch):
    texts = [(i, t) for i, t in ODD_TEXTS if i not in (10, 11)] + [(10, "long " * 300), (11, "x" * 700)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(3)
    clash = docs.withColumns({"block": docs["doc_id"], "n_a": docs["text"], "pair": docs["text"], "links": docs["doc_id"]})
    want = sorted((str(i), *row) for (i, _), row in zip(texts, expected([t for _, t in texts])))
    assert found_by(token_alignment.align(clash)) == want
    monkeypatch.setattr(token_alignment, "BLOCK_BYTES", 20)
    assert found_by(token_alignment.align(clash)) == want


def test_very_long_texts_and_empty_tables(spark, odd, documents):
    found = {r.doc_id: r for r in token_alignment.align(odd.where("doc_id in (10, 11)")).collect()}
    assert found[10].n_a >= 30_000 and found[11].n_links >= found[11].n_groups > 0
    assert token_alignment.align(documents()).count() == 0
    assert found_by(token_alignment.align(documents((1, None), (2, "")))) == [(k, 0, 0, 0, 0, 0, 0, "") for k in "12"]


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(token_alignment, "REMEMBERED_WORDS", 2)
    own = token_alignment.Aligner(OWN.v)
    for text in ("a b c d", "the cat", "a b", "x  y", "the the cat d"):
        assert own.groups_of(own.place_all([text])[0]).decode() == plain(text)[2]


def invented(n_words, seed=7):
    rng = random.Random(seed)
    return ["".join(rng.choices("abcdefghijklmnoprstuvwz", k=rng.randint(3, 12))) for _ in range(n_words)]


def test_rows_and_row_groups_of_blocks_are_small(spark, documents, monkeypatch):
    for name, size in (("PIECE_BYTES", 16 << 10), ("PIECE_PAIRS", 500), ("ROW_GROUP_BYTES", 64 << 10)):
        monkeypatch.setattr(token_alignment, name, size, raising=False)
    words = invented(12_000)
    texts = [(i, " ".join(words[400 * i : 400 * i + 800])) for i in range(30)]
    docs = documents(*texts).coalesce(1)
    blocks = token_alignment.aligned_blocks(docs)
    rows = blocks.toArrow()
    assert max(rows.slice(i, 1).nbytes for i in range(rows.num_rows)) < 32 << 10
    groups = [pq.ParquetFile(f.removeprefix("file://")).metadata for f in blocks.inputFiles()]
    assert max(m.row_group(i).total_byte_size for m in groups for i in range(m.num_row_groups)) < 256 << 10
    want = sorted((str(i), *row) for (i, _), row in zip(texts, expected([t for _, t in texts])))
    assert found_by(token_alignment.align(docs)) == want


def test_learning_takes_little_beside_what_is_kept():
    own = token_alignment.Aligner(OWN.v)
    text = " ".join(invented(60_000))
    tracemalloc.start()
    try:
        own.place_all([text])
        kept, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    assert peak - kept < 24 << 20, (kept, peak)


def test_tasks_of_a_worker_load_the_vocabularies_once(spark, documents):
    docs = documents(*((i, f"text number {i}") for i in range(60))).repartition(30)
    token_alignment.aligned_blocks(docs)

    def loads(batches):
        from mercaloom.llm import token_alignment as there

        for _ in batches:
            x = there.vocabularies.cache_info()
            yield pa.RecordBatch.from_pylist([{"misses": x.misses, "hits": x.hits}])

    found = spark.range(0, 64, numPartitions=64).mapInArrow(loads, "misses long, hits long").collect()
    assert max(r.misses for r in found) == 1 and max(r.hits for r in found) > 0


def test_groups_as_real_output(spark, documents):
    docs = documents((1, "The cat"), (2, None))
    assert {r.doc_id: r.groups for r in token_alignment.token_groups(docs).collect()} == {1: plain("The cat")[2], 2: ""}


def test_query(spark, small):
    from mercaloom.llm.queries import queries

    docs = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").collect()
    short = sorted(docs, key=lambda r: len(r.text or ""))[:120]
    table = spark.createDataFrame([(r.doc_id, r.text) for r in short], "doc_id long, text string")
    want = sorted((str(r.doc_id), *row) for r, row in zip(short, expected([r.text for r in short])))
    assert found_by(token_alignment.align(table)) == want
    found = queries()["op13_token_alignment"](spark, small)
    assert found.columns == ["doc_id", *COLUMNS] and found.count() == len(docs)
