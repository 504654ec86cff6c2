"""Token ids of whole Arrow text columns through a public tokenizer, each distinct word encoded once.

A lower-casing BPE with word ends that drops white space never lets a token cross white space, nor a lone comma
or full stop between letters, so a text's ids are its words' ids in a row.  A file is checked for these
properties when it is opened; with any other tokenizer whole texts are encoded.
Words are looked up in a direct-mapped cache of fixed size, keyed by a 64-bit hash; words that
miss are encoded in bulk.  ``public_tokenizers.path("word_bpe_49k.json")`` is such a file; its
path is always a parameter and the file is opened on the executors.
"""

from __future__ import annotations

import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from cohortlift.llm.words import SEPARATOR, Texts, text_slices

_SLOTS = 1 << 20
_FLAT_LIMIT = 6_000_000
_GROUP = 256

_LETTER = np.zeros(256, dtype=bool)
_LETTER[ord("A") : ord("Z") + 1] = _LETTER[ord("a") : ord("z") + 1] = True
_POINT = np.zeros(256, dtype=bool)
_POINT[[ord(","), ord(".")]] = True

#: How a tokenizer file describes the splitting that keeps words apart.
_SPLIT = {
    "type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"},
    "behavior": "Removed", "invert": True,
}
_NORMAL = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]

_encoders: dict[str, "WordEncoder"] = {}


def goes_by_word(spec: dict) -> bool:
    """Whether the ids of a text are those of its words one after the other."""
    def steps(part: dict | None, inside: str) -> list[dict]:
        return [] if not part else part.get(inside, [part])

    splits = steps(spec.get("pre_tokenizer"), "pretokenizers")
    rest = all(s["type"] == "ByteLevel" and not s["add_prefix_space"] and not s["use_regex"] for s in splits[1:])
    model = spec["model"]
    return (
        steps(spec.get("normalizer"), "normalizers") == _NORMAL and splits[:1] == [_SPLIT] and rest
        and model["type"] == "BPE" and model.get("end_of_word_suffix") == "</w>" and not model.get("dropout")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec.get("added_tokens", []))
    )


def encoder(path: str) -> "WordEncoder":
    """This worker process's encoder; its cache lives on from task to task."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


class WordEncoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.by_word = goes_by_word(spec)
        if not self.by_word:
            return
        vocabulary = spec["model"]["vocab"]
        self.word_end = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.word_end[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._clear()

    def _clear(self) -> None:
        self.keys = np.zeros(_SLOTS, dtype=np.uint64)
        self.places = np.zeros(_SLOTS, dtype=np.int32)
        self.lengths = np.zeros(_SLOTS, dtype=np.int32)
        self.flat = np.zeros(1 << 16, dtype=np.int32)
        self.used = 0

    def _store(self, ids: np.ndarray) -> int:
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
        self.flat[self.used : self.used + len(ids)] = ids
        self.used += len(ids)
        return self.used - len(ids)

    def _encode(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words in a row, and how many each word has."""
        plain = np.array([word.isalpha() for word in words], dtype=bool)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        groups = [order[i : i + _GROUP] for i in range(0, int(plain.sum()), _GROUP)]
        groups[-1:] = [g[: int(plain.sum()) - _GROUP * (len(groups) - 1)] for g in groups[-1:]]
        joined = self.tokenizer.encode_batch_fast(
            [" ".join(words[i] for i in group) for group in groups], add_special_tokens=False
        )
        parts, counts, alone = [], np.zeros(len(words), dtype=np.int64), []
        done = []
        for group, encoding in zip(groups, joined):
            ids = np.array(encoding.ids, dtype=np.int32)
            ends = np.flatnonzero(self.word_end[ids])
            if len(ends) == len(group):  # letters give one word each unless lower-casing adds a mark
                counts[group] = np.diff(ends, prepend=-1)
                parts.append(ids)
                done.append(group)
            else:
                alone.extend(group)
        alone.extend(np.flatnonzero(~plain))
        for i, encoding in zip(alone, self.tokenizer.encode_batch_fast([words[i] for i in alone], add_special_tokens=False)):
            counts[i] = len(encoding.ids)
            parts.append(np.array(encoding.ids, dtype=np.int32))
            done.append(np.array([i]))
        # Back into the order of the words.
        source = np.concatenate(done) if done else np.zeros(0, dtype=np.int64)
        flat = np.concatenate(parts) if parts else np.zeros(0, dtype=np.int32)
        begins = np.zeros(len(words), dtype=np.int64)
        begins[source] = np.cumsum(counts[source]) - counts[source]
        return flat[_ranges(begins, counts)], counts

    def encode(self, texts: Texts, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all rows, ``end_id`` after each, and where each row's ids begin (one more than rows)."""
        if not self.by_word:
            return self._encode_whole(texts, end_id)
        if self.used > _FLAT_LIMIT:
            self._clear()
        starts, ends, first = _word_spans(texts)
        hashes = texts.word_hashes(starts, ends, fold_case=False)
        slots = (hashes & np.uint64(_SLOTS - 1)).astype(np.int64)
        places, lengths = self.places[slots].astype(np.int64), self.lengths[slots].astype(np.int64)
        missing = np.flatnonzero((self.keys[slots] != hashes) | (hashes == 0))
        if len(missing):
            fresh, at, back = np.unique(hashes[missing], return_index=True, return_inverse=True)
            data = texts.data.tobytes()
            words = [data[s:e].decode("utf-8", "replace") for s, e in zip(starts[missing[at]], ends[missing[at]])]
            ids, counts = self._encode(words)
            begins = self._store(ids) + np.cumsum(counts) - counts
            places[missing], lengths[missing] = begins[back], counts[back]
            into = (fresh & np.uint64(_SLOTS - 1)).astype(np.int64)
            self.keys[into], self.places[into], self.lengths[into] = fresh, begins, counts
            # Of words that share a slot the last one written stays, with all its values.
        total = np.zeros(len(lengths) + 1, dtype=np.int64)
        np.cumsum(lengths, out=total[1:])
        offsets = total[first] + np.arange(texts.rows + 1)
        out = np.full(offsets[-1], end_id, dtype=np.int32)
        row = np.repeat(np.arange(texts.rows), np.diff(total[first]))
        out[np.arange(total[-1]) + row] = self.flat[_ranges(places, lengths)]
        return out, offsets


    def _encode_whole(self, texts: Texts, end_id: int) -> tuple[np.ndarray, np.ndarray]:
        data, offsets = texts.data.tobytes(), texts.offsets.tolist()
        rows = [data[a:b].decode("utf-8", "replace") for a, b in zip(offsets[:-1], offsets[1:])]
        parts = [[*e.ids, end_id] for e in self.tokenizer.encode_batch_fast(rows, add_special_tokens=False)]
        ids = np.fromiter((i for part in parts for i in part), dtype=np.int32)
        return ids, np.concatenate(([0], np.cumsum([len(part) for part in parts]))).astype(np.int64)


def _ranges(begins: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """begins[0], begins[0] + 1, ... counts[0] of them, then the same for the next."""
    ends = np.cumsum(counts)
    return np.repeat(begins - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)


def _word_spans(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words between white space, a lone comma or full stop after a letter being a word of its own."""
    data, size = texts.data, len(texts.data)
    row_starts = texts.offsets[:-1][texts.offsets[:-1] < size]
    gap = SEPARATOR[data]
    letter = _LETTER[data]
    open_before = np.zeros(size, dtype=bool)  # a letter of the same row stands before
    open_before[1:] = letter[:-1]
    open_before[row_starts] = False
    closed_after = np.ones(size + 1, dtype=bool)  # white space, a letter or the row's end follows
    closed_after[:-1] = gap | letter
    closed_after[row_starts] = True
    point = _POINT[data] & open_before & closed_after[1:]
    border = np.ones(size + 1, dtype=bool)  # a word may begin here, or end before here
    border[1:size] = gap[:-1] | point[:-1] | point[1:] | gap[1:]
    border[row_starts] = True
    inside = ~gap
    starts = np.flatnonzero(inside & border[:-1])
    ends = np.flatnonzero(inside & border[1:]) + 1
    return starts, ends, np.searchsorted(starts, texts.offsets)


def encoded(column: pa.Array, path: str, end_id: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """For slices of rows: the first row, all ids, and where each row's ids begin."""
    words = encoder(path)
    for texts in text_slices(column):
        ids, offsets = words.encode(texts, end_id)
        yield texts.first, ids, offsets
