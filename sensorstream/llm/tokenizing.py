"""Token ids of whole texts, in batches, with the tokenizers library.

The vocabulary of the contract splits a text at white space before anything else,
so the ids of a text are those of its words one after the other. Each distinct
word of a batch goes through the library once; the ids of all words are then
gathered with numpy. A worker keeps a bounded number of words.

It also lower-cases, and ends a word between a letter
and a punctuation mark; doing both before the split (in ASCII and Latin-1, where
nothing can combine across the cut) leaves fewer distinct words.

Which way a vocabulary splits is read from its file; whole texts of all others go through the library.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sensorstream.llm.words import held

#: Words a worker keeps with their ids; beyond it, it starts afresh.
KEPT_WORDS = 400_000
#: Text handled at once, in bytes, so that memory does not follow the batch.
SLICE_BYTES = 4_000_000
#: Letters that nothing else in a line can change, and how many such words go through the library at once.
PLAIN_WORD, AT_ONCE = re.compile("[a-zß-öø-ÿ]+"), 200
WORD_END = "</w>"
#: A letter before a mark that is no apostrophe: two words to the vocabulary.
LETTER_THEN_MARK = "([a-zß-öø-ÿ])([!-&(-/:-@\\[-`{-~])"

#: How a file says that it lower-cases and drops white space between words.
WORD_NORMALIZERS = [
    {"type": "NFC"},
    {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
    {"type": "Lowercase"},
]
WORD_SPLIT = {
    "type": "Split",
    "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"},
    "behavior": "Removed",
    "invert": True,
}


def public_path(name: str) -> str:
    """Where a public vocabulary file lies on this machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def slices(texts: pa.Array, most_bytes: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Consecutive ranges of rows of bounded text, one row at least."""
    lengths = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    begin, held = 0, 0
    for row, length in enumerate(lengths.tolist()):
        if held and held + length > most_bytes:
            yield begin, row
            begin, held = row, 0
        held += length
    if begin < len(lengths):
        yield begin, len(lengths)


def _plain(texts: pa.Array) -> pa.Array:
    """Lower case, and marks apart from letters; texts that may name special tokens stay."""
    plain = pc.replace_substring_regex(pc.ascii_lower(texts), LETTER_THEN_MARK, r"\1 \2")
    return pc.if_else(pc.match_substring(texts, "<|"), texts, plain)


def splits_words(description: dict) -> bool:
    """True if a tokenizer gives a text the ids of its lower-cased words at white space, one after the other."""
    normalizer, splitter = description.get("normalizer") or {}, description.get("pre_tokenizer") or {}
    added = [token["content"] for token in description.get("added_tokens", [])]
    return (
        normalizer.get("normalizers") == WORD_NORMALIZERS
        and (splitter.get("pretokenizers") or [None])[0] == WORD_SPLIT
        and description["model"].get("end_of_word_suffix") == WORD_END
        and all(text.startswith("<|") and not re.search(r"\s", text) for text in added)
    )


class BatchTokenizer:
    """Ids of texts, each text closed by ``end_id``. Null counts as empty."""

    def __init__(self, path: str, end_id: int, kept_words: int = KEPT_WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.end_id = end_id
        self.kept_words = kept_words
        vocabulary = self.library.get_vocab()
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)  # ids that end a word
        self.by_words = splits_words(json.loads(self.library.to_str()))
        self.closes[[i for token, i in vocabulary.items() if token.endswith(WORD_END)]] = True
        self._forget()

    @classmethod
    def of_worker(cls, path: str, end_id: int) -> "BatchTokenizer":
        """One per Python worker: loading the vocabulary takes a while."""
        return held(("tokenizer", path, end_id), lambda: cls(path, end_id))

    def _forget(self) -> None:
        self.slot: dict[str, int] = {}
        self.ids = np.empty(1 << 20, np.uint32)
        self.bounds = np.zeros(self.kept_words + 1, np.int64)

    def _slots(self, words: list[str]) -> np.ndarray:
        if len(self.slot) + len(words) > self.kept_words:
            self._forget()
            if len(words) > self.kept_words:
                self.bounds = np.zeros(len(words) + 1, np.int64)
        known = self.slot
        fresh = [word for word in words if word not in known]
        if fresh:
            plain = list(filter(PLAIN_WORD.fullmatch, fresh))
            others = [word for word in fresh if not PLAIN_WORD.fullmatch(word)]
            for some, found in ((plain, self._ids_of_lines(plain)), (others, self._ids_of_each(others))):
                if some:
                    self._keep(some, *found)
        return np.fromiter(map(known.__getitem__, words), np.int64, len(words))

    def _keep(self, words: list[str], ids: np.ndarray, counts: np.ndarray) -> None:
        first = len(self.slot)
        begin = self.bounds[first]
        ends = np.cumsum(counts) + begin
        self.bounds[first + 1 : first + 1 + len(words)] = ends
        if ends[-1] > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty(int(ends[-1]), np.uint32)])
        self.ids[begin : ends[-1]] = ids
        self.slot.update(zip(words, range(first, first + len(words))))

    def _ids_of_each(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        found = [e.ids for e in self.library.encode_batch_fast(words, add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], np.uint32), np.array([len(ids) for ids in found], int)

    def _ids_of_lines(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Words of letters go in lines: the ids that end a word part them again."""
        lines = [" ".join(words[k : k + AT_ONCE]) for k in range(0, len(words), AT_ONCE)]
        ids, _ = self._ids_of_each(lines)
        ends = np.flatnonzero(self.closes[ids]) + 1
        if len(ends) != len(words):  # not a vocabulary that marks them
            return self._ids_of_each(words)
        return ids, np.diff(ends, prepend=0)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids on end, and the bounds of each text's ids (one more than texts)."""
        ids, bounds = [np.empty(0, np.uint32)], [np.zeros(1, np.int64)]
        for begin, end in slices(texts):
            encode = self._encode_slice if self.by_words else self._encode_whole
            some, ends = encode(texts.slice(begin, end - begin))
            bounds.append(ends + bounds[-1][-1])
            ids.append(some)
        return np.concatenate(ids), np.concatenate(bounds)

    def _encode_whole(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        ids, counts = self._ids_of_each(pc.fill_null(texts, "").to_pylist())
        ends = np.cumsum(counts)
        return np.insert(ids, ends, self.end_id).astype(np.uint32), ends + np.arange(1, len(texts) + 1)

    def _encode_slice(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        lists = pc.ascii_split_whitespace(_plain(pc.fill_null(texts, "")))
        words = lists.flatten().dictionary_encode()
        which = words.indices.to_numpy()
        slots = self._slots(words.dictionary.to_pylist())
        first = self.bounds[slots][which]
        count = self.bounds[slots + 1][which] - first
        upto = np.concatenate([np.zeros(1, np.int64), np.cumsum(count)])
        word_ends = np.cumsum(pc.list_value_length(lists).to_numpy())
        ends = upto[word_ends] + np.arange(1, len(texts) + 1)  # an end id for each text
        text_of_word = np.repeat(np.arange(len(texts)), np.diff(word_ends, prepend=0))
        steps = np.arange(upto[-1])
        out = np.empty(ends[-1], np.uint32)
        out[ends - 1] = self.end_id
        out[np.repeat(text_of_word, count) + steps] = self.ids[
            np.repeat(first - upto[:-1], count) + steps
        ]
        return out, ends
