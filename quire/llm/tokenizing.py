"""Exact ids and counts of public tokenizers, with every distinct piece encoded once per worker.

The tokenizers library gives every id here. What is added is reuse: texts of ASCII and Latin-1 characters are cut
where the tokenizer itself must cut, and a piece is encoded the first time a worker meets it. Texts with any other
character, control character or added token go to the library whole.
"""

from __future__ import annotations

import json
import os
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from quire.llm import kernels as K

#: Pieces that a worker remembers; at about 200 bytes each, 200 MB.
REMEMBERED = 1_000_000
_WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"

_loaded: dict[tuple, object] = {}


def load(kind, path: str):
    """One encoder per worker process and file."""
    if (kind, path) not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _loaded[kind, path] = kind(path)
    return _loaded[kind, path]


class _Pieces:
    """What both encoders share: the distinct pieces of a batch of texts."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.spec = json.load(f)
        self.added = [x["content"] for x in self.spec.get("added_tokens", [])]
        self.plain = Tokenizer.from_file(path)
        self.plain.normalizer = None
        #: By the 64-bit hash of a piece: a new piece meets a remembered one's hash in fewer than 1 of 10**13 cases.
        self.known: dict[int, object] = {}

    def distinct(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[list, np.ndarray]:
        """What is known of each distinct piece, and which of them each span is."""
        keys, first, which = np.unique(K.hashed(buf, starts, ends), return_index=True, return_inverse=True)
        if len(self.known) > REMEMBERED:
            self.known.clear()
        keys = keys.tolist()
        found = list(map(self.known.get, keys))
        if None in found:
            new = [i for i, f in enumerate(found) if f is None]
            spans = zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)
            self.known.update(zip([keys[i] for i in new], self.learn([buf[a:b].tobytes().decode() for a, b in spans]), strict=True))
            found = list(map(self.known.__getitem__, keys))
        return found, which

    def learn(self, pieces: list[str]) -> list:
        raise NotImplementedError

    def _marked(self, pieces: list[str], marks: np.ndarray, glue: str, first: bool) -> list:
        """Encode many pieces as one text in which each has one marked token, its first or last; None where that fails."""
        lines = [pieces[i : i + 400] for i in range(0, len(pieces), 400)]
        out: list = []
        for line, e in zip(lines, self.plain.encode_batch_fast([glue.join(x) for x in lines], add_special_tokens=False), strict=True):
            ids = np.asarray(e.ids, "<u4")
            cuts = np.flatnonzero(marks[ids])
            cuts = np.append(cuts, len(ids)) if first else np.concatenate([[0], cuts + 1])
            whole = len(cuts) == len(line) + 1 and cuts[0] == 0 and cuts[-1] == len(ids)
            out += [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)] if whole else [None] * len(line)
        return out


class WordIds(_Pieces):
    """Ids of texts as unsigned 32-bit numbers, for any tokenizers file.

    Pieces are reused for files that lower-case, drop white space, cut contractions, letter runs, digits and other
    runs, and mark the last token of a piece. Then the ids of a text are those of its pieces, one after the other.
    """

    def __init__(self, path: str):
        super().__init__(path)
        first, *_ = (self.spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        steps = [x.get("type") for x in (self.spec.get("normalizer") or {}).get("normalizers", [])]
        mark = self.spec["model"].get("end_of_word_suffix")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.largest = max(vocabulary.values())
        self.reuse = bool(mark) and steps == ["NFC", "Replace", "Lowercase"] and first.get("behavior") == "Removed" and bool(first.get("invert")) and first.get("pattern", {}).get("Regex") == _WORDS
        if self.reuse:
            self.last = np.zeros(self.largest + 1, bool)
            self.last[[i for t, i in vocabulary.items() if t.endswith(mark)]] = True

    def whole(self, text: str) -> np.ndarray:
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    def learn(self, pieces: list[str]) -> list[bytes]:
        encoded = zip(pieces, self._marked(pieces, self.last, " ", first=False), strict=True)
        return [(self.whole(p) if ids is None else ids).tobytes() for p, ids in encoded]

    def encode(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the number of each text's ids."""
        buf, at = K.buffer_of(column)
        kind, second = K.kinds(buf)
        odd = K.odd_texts(buf, at, kind, [a.encode() for a in self.added]) if self.reuse else np.ones(len(column), bool)
        if odd.all():
            each = [self.whole(t or "") for t in column.to_pylist()]
            return np.concatenate([np.zeros(0, "<u4"), *each]), np.array([len(x) for x in each], np.int64)
        low = K.lowered(buf)
        if odd.any():
            kind[np.repeat(odd, np.diff(at))] = K.BLANK
            second = second[kind[second] != K.BLANK]
            low[kind == K.BLANK] = 32
        starts, ends = K.word_pieces(low, at, kind, second)
        found, which = self.distinct(low, starts, ends)
        flat = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        firsts = np.cumsum(sizes) - sizes
        ids = K.gathered(flat, firsts[which], sizes[which])
        bounds = np.concatenate([[0], np.cumsum(sizes[which])])[np.searchsorted(starts, at)]
        counts = np.diff(bounds)
        if odd.any():
            parts, done = [], 0
            for i in np.flatnonzero(odd).tolist():
                own = self.whole(column[i].as_py() or "")
                parts += [ids[done : bounds[i]], own]
                done, counts[i] = bounds[i], len(own)
            ids = np.concatenate([*parts, ids[done:]])
        return ids, counts


class PieceCounts(_Pieces):
    """Numbers of tokens: each distinct pre-token is counted once, then joined to a text's pre-token frequencies."""

    def __init__(self, path: str):
        super().__init__(path)
        pre = self.spec.get("pre_tokenizer") or {}
        self.splits = not self.spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        self.cut = re.compile("|".join(re.escape(x) for x in self.added)) if self.added else None
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.first = np.zeros(max(vocabulary.values()) + 1, bool)
        self.first[[i for t, i in vocabulary.items() if t.startswith("Ġ")]] = True

    def _sizes(self, texts: list[str]) -> list[int]:
        return [len(e) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, pieces: list[str]) -> list[int]:
        spaced = [p for p in pieces if p[0] == " " and p[1:2].isalpha()]
        counts = {p: len(ids) for p, ids in zip(spaced, self._marked(spaced, self.first, "", first=True), strict=True) if ids is not None}
        rest = [p for p in pieces if p not in counts]
        counts.update(zip(rest, self._sizes(rest), strict=True))
        return [counts[p] for p in pieces]

    def _by_library(self, text: str) -> int:
        """A text that can't be cut here: the library cuts it into pre-tokens."""
        segments = self.cut.split(text) if self.cut is not None else [text]
        found: Counter = Counter()
        for s in segments:
            found.update(s[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(s))
        return len(segments) - 1 + sum(n * k for n, k in zip(found.values(), self._sizes(list(found)), strict=True))

    def count(self, column: pa.Array) -> np.ndarray:
        if not self.splits:
            return np.array(self._sizes([t or "" for t in column.to_pylist()]), np.int64)
        buf, at = K.buffer_of(column)
        kind, second = K.kinds(buf)
        odd = K.odd_texts(buf, at, kind, [a.encode() for a in self.added])
        out = np.zeros(len(at) - 1, np.int64)
        if not odd.all():
            starts, ends = K.byte_pieces(buf, at, kind, second)
            if odd.any():
                keep = ~odd[np.searchsorted(at, starts, "right") - 1]
                starts, ends = starts[keep], ends[keep]
            found, which = self.distinct(buf, starts, ends)
            # One row for each text and distinct pre-token, with its frequency, joined to the pre-tokens' counts.
            text = np.repeat(np.arange(len(out)), np.diff(np.searchsorted(starts, at)))
            pairs = np.sort(text * max(1, len(found)) + which)
            first = np.flatnonzero(np.diff(pairs, prepend=-1))
            frequency = np.diff(first, append=len(pairs))
            text, which = np.divmod(pairs[first], max(1, len(found)))
            out = np.bincount(text, np.array(found, np.int64)[which] * frequency, len(out)).astype(np.int64)
        for i in np.flatnonzero(odd).tolist():
            out[i] = self._by_library(column[i].as_py())
        return out
