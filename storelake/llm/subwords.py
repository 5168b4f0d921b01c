"""Subword ids of a public word tokenizer, with the ids of known words kept.

The tokenizer drops white space and never merges across it, so a text's ids are those of
its words in turn. Texts repeat their words, so each task encodes a word once and
gathers the rest by position.
"""

from __future__ import annotations

import os
from itertools import chain

import numpy as np
import regex

#: Words of these characters only go through the pieces below. They are unchanged by
#: composition, and lower-case one by one; the tokenizer itself takes all other words.
_SAFE = regex.compile(r"(?:(?!<\|)[\x21-\x7E\xA1-\u012F\u0131-\u024F])+")
_ODD = regex.compile(r"<\||[^\x20-\x7E\xA1-\u012F\u0131-\u024F]")
#: The tokenizer's own pattern for the pieces that its merges work on (a fixed value),
#: and the space that stands between words here.
_ITEMS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+|\x20")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class Spans:
    """Runs of ids by number: one flat array, with where each run starts and how long it is."""

    def __init__(self):
        self.flat, self.count = np.empty(0, np.int32), np.empty(0, np.int64)
        self.first = np.empty(0, np.int64)

    def add(self, flat: np.ndarray, count: np.ndarray) -> None:
        self.flat = np.concatenate([self.flat, flat.astype(np.int32)])
        self.count = np.concatenate([self.count, count])
        self.first = np.cumsum(self.count) - self.count

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the runs ``at`` one after another, and where each run ends in them."""
        count = self.count[at]
        ends = np.cumsum(count)
        place = np.repeat(self.first[at] - (ends - count), count)
        place += np.arange(len(place))
        return self.flat[place], ends


class Numbers(dict):
    """Numbers words in the order in which they come; ``new`` are those still to be coded."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        self.new.append(word)
        return number


class Subwords:
    """Ids of whole texts. Keeps at most about ``most_words`` words between calls."""

    def __init__(self, path: str, most_words: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.whole = Tokenizer.from_file(path)
        self.pieces = Tokenizer.from_file(path)
        self.pieces.normalizer = normalizers.Sequence([])
        self.pieces.pre_tokenizer = pre_tokenizers.Sequence(
            [
                pre_tokenizers.WhitespaceSplit(),
                pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False),
            ]
        )
        vocabulary = self.whole.get_vocab()
        self.size = max(vocabulary.values()) + 1
        self.ends = np.zeros(self.size, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.most_words = most_words
        self.clear()

    def clear(self) -> None:
        self.number = Numbers()
        self.words = Spans()
        self.piece: dict[str, int] = {" ": 0}
        self.runs = Spans()
        self.runs.add(np.empty(0, np.int32), np.zeros(1, np.int64))

    def _learn_pieces(self, new: list[str]) -> None:
        joined = [" ".join(new[i : i + 500]) for i in range(0, len(new), 500)]
        coded = self.pieces.encode_batch_fast(joined, add_special_tokens=False)
        ids = np.fromiter(chain.from_iterable(e.ids for e in coded), np.int32)
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) == len(new):  # each piece has one last subword
            count = np.diff(stops, prepend=0)
        else:
            each = [self.pieces.encode(p, add_special_tokens=False).ids for p in new]
            ids = np.array([i for x in each for i in x], np.int32)
            count = np.array([len(x) for x in each], np.int64)
        self.piece.update(zip(new, range(len(self.piece), len(self.piece) + len(new)), strict=True))
        self.runs.add(ids, count)

    def _learn(self) -> None:
        """Codes the words that have got a number since the last time, in its order."""
        words, self.number.new = self.number.new, []
        if not words:
            return
        text = b" ".join(words).decode()
        if not _ODD.search(text):
            self.words.add(*self._coded(text, len(words)))
            return
        safe = [i for i, w in enumerate(words) if _SAFE.fullmatch(w.decode())]
        odd = sorted(set(range(len(words))).difference(safe))
        each = [self.whole.encode(words[i].decode(), add_special_tokens=False).ids for i in odd]
        mixed = Spans()
        mixed.add(np.fromiter(chain.from_iterable(each), np.int32), np.array([len(x) for x in each], np.int64))
        if safe:
            mixed.add(*self._coded(b" ".join([words[i] for i in safe]).decode(), len(safe)))
        back = np.argsort(np.array([*odd, *safe]))
        self.words.add(mixed.take(back)[0], mixed.count[back])

    def _coded(self, text: str, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The ids of ``n`` safe words one after another, and how many each has."""
        items = _ITEMS.findall(text.lower())
        self._learn_pieces(list(set(items).difference(self.piece)))
        at = np.fromiter(map(self.piece.__getitem__, items), np.int64, len(items))
        ids, _ = self.runs.take(at)
        sizes = np.bincount(np.cumsum(at == 0), weights=self.runs.count[at], minlength=n)
        return ids, sizes.astype(np.int64)

    def codes(self, words: list[bytes]) -> np.ndarray:
        """Numbers of lower-case words in ``self.words``; only ``clear`` forgets them."""
        out = np.fromiter(map(self.number.__getitem__, words), np.int32, len(words))
        self._learn()
        return out

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each text has."""
        words = [t.lower().split() for t in texts]
        if len(self.number) > self.most_words:
            self.clear()
        per_text = np.array([len(ws) for ws in words], np.int64)
        number = map(self.number.__getitem__, chain.from_iterable(words))
        at = np.fromiter(number, np.int64, int(per_text.sum()))
        self._learn()
        ids, ends = self.words.take(at)
        upto = np.concatenate([[0], ends])
        stops = np.cumsum(per_text)
        return ids, upto[stops] - upto[stops - per_text]


_LOADED: dict[str, Subwords] = {}


def loaded(path: str) -> Subwords:
    """The encoder of this Python worker, which keeps its words between tasks."""
    if path not in _LOADED:
        _LOADED[path] = Subwords(path)
    return _LOADED[path]


def in_blocks(texts: list[bytes], most_bytes: int = 2_000_000):
    """(from, to) of runs of whole texts, of about so many bytes; a longer text is alone."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        if i > start and size + len(t) > most_bytes:
            yield start, i
            start, size = i, 0
        size += len(t)
    if start < len(texts):
        yield start, len(texts)
