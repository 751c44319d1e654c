"""Byte-level BPE ids with the tokenizers library, a piece at a time.

The library's own splitting rule never joins text across a single space that
precedes a word, nor across a line break that stands alone between words, so a
text can be cut there and the ids of each piece remembered: a corpus repeats
its words far more often than it brings new ones.  A batch of texts is cut and
its distinct pieces numbered by Arrow; only those are looked up, and the ids
are laid out by numpy.  Texts where a cut could matter (runs of spaces, a space
at the end) go to the library whole.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

_REMEMBERED = 700_000       # words a worker remembers before it starts afresh
_GROUP = 8 << 20            # bytes of texts cut and numbered together
_LAID_OUT = 1 << 20         # ids laid out at a time, about
_SLICE = 1 << 20            # characters of a longer text that are cut as texts of their own
_SPACE = r"[\s\p{Z}\x0b\x1c-\x1f\x{85}]"
_NO_CUT = f"  | $|\\x00|{_SPACE} {_SPACE}|{_SPACE}\n|\n{_SPACE}"      # no cuts in texts with one of these
_LATIN = "\u0250"           # letters below are letters for every Unicode version


def default_path() -> str:
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for
    the code points from 256 on."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {**{b: chr(b) for b in printable}, **{b: chr(256 + i) for i, b in enumerate(others)}}


class Encoder:
    """Ids of texts as little-endian integers of `width` bytes."""

    def __init__(self, path: str, remembered: int = _REMEMBERED, group: int = 0):
        """`remembered` words and `group` bytes of texts at a time: less memory for more time."""
        self.remembered, self.group = remembered, group or _GROUP
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True     # their strings are ordinary text
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.dtype = np.dtype(f"<u{self.width}")
        self._code = "H" if self.width == 2 else "I"
        self._letters = _byte_letters()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self._cut = (pre.get("type") == "ByteLevel" and pre.get("use_regex", True)
                     and not pre.get("add_prefix_space") and spec.get("normalizer") is None
                     and not (spec["model"].get("dropout") or spec["model"].get("ignore_merges")))
        self._ends = {end: self._whole(end) for end in ",."}
        # raw ids of words after a space, and of words that open a line
        self._spaced: dict[str, bytes] = {}
        self._opening: dict[str, bytes] = {}

    def _raw(self, ids) -> bytes:
        return array(self._code, ids).tobytes()

    def _whole(self, text: str) -> bytes:
        return self._raw(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _fresh(self, word: str, lead: str, known: dict[str, bytes]) -> bytes:
        """Raw ids of a word not seen before, `lead` (a space or nothing) before it.  A run of
        letters is one unit of the library's splitting rule, and a comma or full stop after
        it another: the model merges such a run without the rest of the library's steps."""
        stem, end = (word[:-1], word[-1]) if word[-1:] in self._ends else (word, "")
        if stem.isalpha() and (stem.isascii() or max(stem) < _LATIN):
            raw = known.get(stem) if end else None
            if raw is None:
                letters = (lead + stem).encode().decode("latin1").translate(self._letters)
                raw = self._raw([t.id for t in self.tokenizer.model.tokenize(letters)])
            return raw + self._ends[end] if end else raw
        return self._whole(lead + word)

    def _look_up(self, words: list[str], known: dict[str, bytes], lead: str) -> list[bytes]:
        found = list(map(known.get, words))
        merge, code, start = self.tokenizer.model.tokenize, self._code, self._letters[32] if lead else ""
        for i in [i for i, raw in enumerate(found) if raw is None]:
            word = words[i]
            if word.isascii() and word.isalpha():       # the common case of `_fresh`
                raw = array(code, [t.id for t in merge(start + word)]).tobytes()
            else:
                raw = self._fresh(word, lead, known)
            known[word] = found[i] = raw
        return found

    def batch(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text (null: none), in order."""
        texts = pc.fill_null(texts, "")
        sizes = pc.binary_length(texts).to_numpy()
        whole = pc.match_substring_regex(texts, _NO_CUT).to_numpy(zero_copy_only=False) if self._cut else \
            np.ones(len(texts), bool)
        a = 0
        while a < len(texts):
            if whole[a]:
                yield np.frombuffer(self._whole(texts[a].as_py()), self.dtype)
                a += 1
                continue
            if sizes[a] > self.group:
                yield np.concatenate(list(self._slices(texts[a].as_py())))
                a += 1
                continue
            b, total = a, 0
            while b < len(texts) and not whole[b] and total + sizes[b] <= self.group:
                total += sizes[b]
                b += 1
            yield from self._group(texts.slice(a, b - a))
            a = b

    def ids(self, text: str | None) -> np.ndarray:
        return next(self.batch(pa.array([text], pa.string())))

    def _slices(self, text: str) -> Iterator[np.ndarray]:
        """Ids of a very long text; slices begin with their space."""
        at = 0
        while at < len(text):
            end = text.find(" ", at + _SLICE)
            end = len(text) if end < 0 else end
            yield from self._group(pa.array([text[at:end]], pa.string()))
            at = end

    def _group(self, texts: pa.Array) -> Iterator[np.ndarray]:
        if len(self._spaced) + len(self._opening) > self.remembered:
            self._spaced.clear()
            self._opening.clear()
        lines = pc.split_pattern(texts, "\n")
        words = pc.split_pattern(lines.flatten(), " ")
        coded = words.flatten().dictionary_encode()
        codes, n = coded.indices.to_numpy(), len(coded.dictionary)
        per_line, per_text = (pc.list_value_length(x).to_numpy().astype(np.int64) for x in (words, lines))
        first = np.cumsum(per_line) - per_line                  # word that opens each line: it has no space before
        opens = np.zeros(len(codes), bool)
        opens[first] = True
        # pieces: words after a space, then words that open a line, a line break, nothing
        codes = codes + np.where(opens, n, 0)
        used = np.zeros(2 * n, bool)
        used[codes] = True
        entries = []
        for part, known, lead in ((used[:n], self._spaced, " "), (used[n:], self._opening, "")):
            names = coded.dictionary.filter(pa.array(part)).to_pylist()
            entries += self._look_up(names, known, lead)
        number, n_pieces = np.cumsum(used) - 1, len(entries)
        entries += [self._whole("\n"), b""]
        length = np.fromiter(map(len, entries), np.int64, n_pieces + 2) // self.width
        offset = np.cumsum(length) - length
        ids = np.frombuffer(b"".join(entries), self.dtype)
        # one place before each line: a line break, or nothing at the start of a text
        place = first + np.arange(len(first))
        order = np.empty(len(codes) + len(first), np.int64)
        inner = np.ones(len(order), bool)
        inner[place] = False
        order[inner] = number[codes]
        order[place] = n_pieces
        opening = place[np.cumsum(per_text) - per_text]
        order[opening] = n_pieces + 1
        length = length[order]
        end = np.cumsum(length)
        bounds = [*opening, len(order)]                         # in places
        at = np.concatenate([[0], end])[bounds]                 # in ids
        i = 0
        while i < len(opening):
            j = max(i + 1, int(np.searchsorted(at, at[i] + _LAID_OUT, "right")) - 1)
            here = slice(bounds[i], bounds[j])
            start = end[here] - length[here] - at[i]
            out = ids[np.repeat(offset[order[here]] - start, length[here]) + np.arange(at[j] - at[i])]
            for k in range(i, j):
                yield out[at[k] - at[i]:at[k + 1] - at[i]]
            i = j


_ENCODERS: dict[tuple, Encoder] = {}


def encoder(path: str, remembered: int = _REMEMBERED, group: int = 0) -> Encoder:
    """One encoder a worker process, vocabulary and memory setting."""
    key = (path, remembered, group)
    if key not in _ENCODERS:
        _ENCODERS[key] = Encoder(path, remembered, group)
    return _ENCODERS[key]
