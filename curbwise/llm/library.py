"""The tokenizers library over slices of texts, asked once for each distinct piece of text.

The library spends most of its time on words it has met before. With a
vocabulary whose pieces drop white space, no piece spans a white space and the
normalisation never reaches across one, so the encoding of a text is the
concatenation of the encodings of its stretches between spaces. Most stretches
are a word of plain Latin letters and marks after it, which are pieces of their
own. A slice of texts is split and its stretches are numbered by Arrow; the
stretches are taken apart into units (a word in lower case, marks, or a whole
stretch that is neither), the library is asked for the units not met before,
and the ids of the texts are gathered from the table of units.

Plain letters are those whose lower case is one plain letter and that no
normalisation changes; so U+0130, whose lower case is two characters, is none.
"""

from __future__ import annotations

import json
import os
import unicodedata
from collections.abc import Callable
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units a worker remembers before it starts afresh, and bytes of text it looks at together; only speed depends on them.
KEPT_UNITS, SLICE_BYTES = 500_000, 6 << 20


def _is_plain(char: str) -> bool:
    low = char.lower()
    return (
        char.isalpha() and len(low) == 1 and low.isalpha() and low.lower() == low
        and all(unicodedata.normalize("NFC", each) == each for each in (char, low))
        and pc.utf8_lower(pa.scalar(char)).as_py() == low
    )


#: Letters of the Latin blocks up to U+024F that are safe to look at apart.
PLAIN = "".join(char for code in (*range(0x41, 0x5B), *range(0x61, 0x7B), *range(0xC0, 0x250)) if _is_plain(char := chr(code)))


class IntLists:
    """A growing table of lists of integers; lists are gathered by row number."""

    def __init__(self, kind: type = np.int32) -> None:
        self.flat, self.starts, self.sizes = np.empty(0, kind), np.empty(0, np.int64), np.empty(0, np.int64)

    def append(self, flat: np.ndarray, sizes: np.ndarray) -> None:
        starts = len(self.flat) + np.cumsum(sizes) - sizes
        self.flat = np.concatenate([self.flat, flat.astype(self.flat.dtype, copy=False)])
        self.starts, self.sizes = np.concatenate([self.starts, starts]), np.concatenate([self.sizes, sizes])

    def gather(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The lists of ``rows`` one after another, and their sizes."""
        return gather(self.flat, self.starts, self.sizes, rows)


def gather(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    wanted = sizes[rows]
    shift = starts[rows] - (np.cumsum(wanted) - wanted)
    places = np.repeat(shift, wanted)
    places += np.arange(len(places))
    return flat[places], wanted


def split_words(texts: pa.Array, separator: str = " ") -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct stretches, the number of each stretch in order, and how many stretches each text has."""
    rows = pc.split_pattern(pc.fill_null(texts, ""), pattern=separator)
    coded = rows.flatten().dictionary_encode()
    sizes = pc.list_value_length(rows).to_numpy().astype(np.int64)
    return coded.dictionary, coded.indices.to_numpy(), sizes


class LibraryEncoder:
    """The library with a vocabulary file of lower-cased words, which drops white space."""

    def __init__(self, content: bytes) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the task has one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(content.decode("utf-8"))
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.specials = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.mark = self.tokenizer.token_to_id(self.specials[-1])
        # The same merges for words that are one piece each already.
        spec = json.loads(content)
        spelled = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}
        spec |= {"normalizer": None, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [{"type": "WhitespaceSplit"}, spelled]}}
        self.words = Tokenizer.from_str(json.dumps(spec))
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[number for token, number in vocabulary.items() if token.endswith("</w>")]] = True
        self.plain = f"^[{PLAIN}]+[.,]*$"
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.table = IntLists()

    def one_piece(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that are one piece each, one after another, and how many each has: a word ends with its piece."""
        ids = np.array(self.words.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, np.int32)
        return ids, np.diff(np.flatnonzero(self.ends[ids]), prepend=-1)

    def library(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of any units one after another, and how many each has."""
        joined = self.specials[-1].join(units)
        if sum(map(joined.count, self.specials)) >= len(units):  # special tokens in the texts
            found = [each.ids for each in self.tokenizer.encode_batch_fast(units, add_special_tokens=False)]
            return np.array(list(chain.from_iterable(found)), np.int32), np.array([len(each) for each in found], np.int64)
        # A special token between two units marks where one ends.
        ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int32)
        marks = ids == self.mark
        return ids[~marks], np.diff(np.append(np.flatnonzero(marks), len(ids)), prepend=-1) - 1

    def rows(self, units: list[str], ask: Callable[[list[str]], tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        """Row numbers of distinct units in the table, which gets those not met before."""
        known = self.known
        found = np.array([known.get(unit, -1) for unit in units], np.int64)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            new = [units[at] for at in missing.tolist()]
            self.table.append(*ask(new))
            found[missing] = np.arange(len(known), len(known) + len(new))
            known.update(zip(new, found[missing].tolist(), strict=True))
        return found

    def stretches(self, distinct: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the distinct stretches one after another, and how many each has."""
        if len(self.known) >= KEPT_UNITS:
            self.clear()
        plain = pc.match_substring_regex(distinct, self.plain)
        where = plain.to_numpy(zero_copy_only=False)
        units = np.empty((len(distinct), 2), np.int64)
        stretch = distinct.filter(plain)
        stems = pc.utf8_lower(pc.utf8_rtrim(stretch, characters=".,")).dictionary_encode()
        marks = pc.utf8_ltrim(stretch, characters=PLAIN).dictionary_encode()
        units[where, 0] = self.rows(stems.dictionary.to_pylist(), self.one_piece)[stems.indices.to_numpy()]
        units[where, 1] = self.rows(marks.dictionary.to_pylist(), self.library)[marks.indices.to_numpy()]
        units[~where, 0] = self.rows(distinct.filter(pc.invert(plain)).to_pylist(), self.library)
        units[~where, 1] = self.rows([""], self.library)[0]
        flat, sizes = self.table.gather(units.ravel())
        return flat, sizes.reshape(-1, 2).sum(axis=1)

    def encode_all(self, values: pa.Array, end: list[int]) -> pa.ListArray:
        """The ids of each text and after them ``end``; a null text reads as empty."""
        texts = pc.replace_substring(pc.fill_null(values, ""), "\n", " ")
        distinct, codes, many = split_words(texts)
        flat, sizes = self.stretches(distinct)
        # One more row: the end ids, after the last stretch of each text.
        flat, sizes = np.concatenate([flat, np.array(end, np.int32)]), np.append(sizes, len(end))
        last = np.cumsum(many)
        codes = np.insert(codes.astype(np.int64), last, len(distinct))
        ids, sizes = gather(flat, np.cumsum(sizes) - sizes, sizes, codes)
        ends = np.cumsum(sizes)[last + np.arange(len(last))] if len(last) else np.empty(0, np.int64)
        offsets = np.concatenate([[0], ends]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids))


_encoders: dict[int, LibraryEncoder] = {}


def encoder(content: bytes) -> LibraryEncoder:
    """The encoder of a vocabulary file, one for each worker process."""
    key = hash(content)
    if key not in _encoders:
        _encoders[key] = LibraryEncoder(content)
    return _encoders[key]
