"""Token ids of whole texts, as the tokenizers library gives them, with pieces of words remembered between slices.

A byte-level BPE file splits a text into pieces and merges within a piece only. So a text cut at single spaces has
the ids of its parts, each with the space before it, unless white space meets at a cut; such texts, and those that
hold a special token, are encoded whole. Words repeat, so the distinct words of a slice of texts are joined by single
spaces and split into pieces at once (a piece that begins with a space begins a word), and the library's model is asked
for the distinct pieces. All in between are Arrow columns. The pieces last met, at most `REMEMBERED`, are kept with their
ids, so only new ones are asked for; beyond these few MB, memory follows the slice.
"""

from __future__ import annotations

import codecs
import os
import re
from array import array
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
SLICE_BYTES = 6 << 20
REMEMBERED = 1 << 18
LONGEST = 64  # bytes of a piece that is remembered
# white space beyond the three usual ones, and the mark of a first word; looked for one by one, which is a fast search
_RARE_ASCII = [c for c in map(chr, range(128)) if c.isspace() and c not in " \n\t"] + ["\0"]
_RARE_WIDE = [c for c in map(chr, range(128, 0x3001)) if c.isspace()]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> dict[int, str]:
    """The letter a byte-level vocabulary writes for each byte: itself if printable, else one from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


def _cuts_alone(text: str) -> bool:
    """Whether no space of the text touches other white space or an end."""
    return not (
        text[0] == " " or text[-1] == " " or "  " in text or " \n" in text or "\n " in text
        or " \t" in text or "\t " in text or any(c in text for c in _RARE_ASCII)
        or not text.isascii() and any(c in text for c in _RARE_WIDE)
    )


class Places(dict):
    """Numbers words in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        number = self[word] = len(self)
        return number


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), values)


def _joined(strings: pa.Array, by: str | bytes) -> str | bytes:
    return pc.binary_join(_lists(np.array([0, len(strings)]), strings), by)[0].as_py()


class Memory:
    """The ids of the strings last asked for, `REMEMBERED` at most, none longer than `LONGEST` bytes."""

    def __init__(self):
        self.strings, self.ids = pa.array([], pa.string()), _lists(np.zeros(1), pa.array([], pa.uint32()))

    def ids_of(self, strings: pa.StringArray, find: Callable[[pa.StringArray], pa.ListArray]) -> pa.ListArray:
        """The ids of distinct strings; `find` is asked for the new ones."""
        at = pc.index_in(strings, value_set=self.strings)
        new, known = at.is_null(), np.zeros(len(self.strings), bool)
        is_new, at = new.to_numpy(zero_copy_only=False), at.fill_null(0).to_numpy()
        known[at[~is_new]] = True
        ids = pa.concat_arrays([self.ids, find(strings.filter(new))])
        found = ids.take(pa.array(np.where(is_new, len(self.strings) + np.cumsum(is_new) - 1, at)))
        kept = np.flatnonzero(pc.less_equal(pc.binary_length(strings), LONGEST).to_numpy(zero_copy_only=False))[:REMEMBERED]
        rest = np.flatnonzero(~known)[: REMEMBERED - len(kept)]
        self.strings = pa.concat_arrays([strings.take(pa.array(kept)), self.strings.take(pa.array(rest))])
        self.ids = pa.concat_arrays([found.take(pa.array(kept)), self.ids.take(pa.array(rest))])
        return found


class Encoder:
    """`encode(texts)` gives the ids of all texts in one flat array and the ends of the texts in it."""

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import regex
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(path)
        self.model = self.whole.model
        self.split = regex.compile(public_tokenizers.PATTERN).findall
        self.letters = _byte_letters()
        self.table = "".join(self.letters[b] for b in range(256))
        added = self.whole.get_added_tokens_decoder().values()
        self.special = re.compile("|".join(re.escape(t.content) for t in added) or r"(?!)")
        self.pieces: dict[str, tuple[int, ...]] = {}  # for callers that remember pieces
        self.met = Memory()

    def _ids_of_pieces(self, pieces: pa.StringArray) -> pa.ListArray:
        """The model's ids of distinct pieces, none of which holds a zero byte."""
        tokenize, flat, ends = self.model.tokenize, array("I"), array("i", [0])
        if len(pieces):
            written = codecs.charmap_decode(_joined(pieces.cast(pa.binary()), b"\0"), "strict", self.table)[0]
            for letters in written.split(self.table[0]):
                flat.extend([t.id for t in tokenize(letters)])
                ends.append(len(flat))
        return _lists(np.array(ends, np.int32), pa.array(np.array(flat, np.uint32)))

    def _ids_of_words(self, words: pa.StringArray) -> pa.ListArray:
        """The ids of distinct words; the first words of texts are marked by a zero byte."""
        first = pc.starts_with(words, "\0")
        spaced = words.filter(pc.invert(first))
        found = self.split(" " + _joined(spaced, " ")) if len(spaced) else []
        n_spaced, starts = len(found), []
        for word in words.filter(first).to_pylist():
            starts.append(len(found))
            found += self.split(word[1:])
        pieces = pa.array(found, pa.string()).dictionary_encode()
        number = pieces.indices.to_numpy()
        begins = pc.starts_with(pieces.dictionary, " ").to_numpy(zero_copy_only=False)[number[:n_spaced]]
        lists = self.met.ids_of(pieces.dictionary, self._ids_of_pieces).take(pieces.indices)
        edges = np.concatenate([np.flatnonzero(begins), np.array([*starts, len(found)], np.int64)])
        by_word = _lists(lists.offsets.to_numpy()[edges], lists.flatten())  # the first words are last
        is_first = first.to_numpy(zero_copy_only=False).astype(bool)
        at = np.where(is_first, len(spaced) + np.cumsum(is_first) - 1, np.cumsum(~is_first) - 1)
        return by_word.take(pa.array(at, pa.int64()))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        whole, cut = {}, []
        for i, text in enumerate(texts):
            if not text or self.special.search(text) or not _cuts_alone(text):
                whole[i] = self.whole.encode(text, add_special_tokens=False).ids if text else []
            else:
                cut.append("\0" + text)  # the first word has no space before it
        words = pc.split_pattern(pa.array(cut, pa.string()), " ")
        distinct = words.values.dictionary_encode()
        lists = self._ids_of_words(distinct.dictionary).take(distinct.indices)
        flat = lists.flatten().to_numpy()
        ends = lists.offsets.to_numpy()[words.offsets.to_numpy()].astype(np.int64)
        if whole:
            rest = iter(np.split(flat, ends[1:-1]))
            out = [np.array(whole[i], np.uint32) if i in whole else next(rest) for i in range(len(texts))]
            return np.concatenate(out), np.cumsum([len(x) for x in out], dtype=np.int64)
        return flat, ends[1:]


def encoder(path: str) -> Encoder:
    """A new one for each task."""
    return Encoder(path)
